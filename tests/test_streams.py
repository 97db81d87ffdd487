"""Message log, session state with an end, scoring of repeated turns."""

from pyspark.sql import functions as F

from tessera.operators import classify as CL
from tessera.operators import tokens as TK
from tessera.session import scratch_path
from tessera.streaming import messages as MS
from tessera.streaming import scoring as SS
from tessera.streaming import sessions as SE

COLUMNS = "conv_id BIGINT, turn BIGINT, role STRING, text STRING"
TIMED = f"{COLUMNS}, {SE.TIME} STRING"


def publish(spark, path, rows, at=1_000_000):
    """(conv, turn, role, text[, event second]) rows; the event second is the turn by default."""
    full = [(*r[:4], at + (r[4] if len(r) > 4 else r[1])) for r in rows]
    df = spark.createDataFrame(full, f"{COLUMNS}, s BIGINT").withColumn(SE.TIME, F.timestamp_seconds("s")).drop("s")
    MS.publish(df, path, partitions=3)


class Sessions:
    """A stream that is stopped and started again for every step."""

    def __init__(self, spark, delay="2 seconds", idle=20):
        self.spark, self.delay, self.idle = spark, delay, idle
        self.path, self.sink, self.checkpoint = (scratch_path(spark, n) for n in ("log", "sink", "ckpt"))

    def step(self, rows):
        publish(self.spark, self.path, rows)
        stream = MS.read_stream(self.spark, self.path, TIMED).withColumn(SE.TIME, F.col(SE.TIME).cast("timestamp"))
        kept = SE.until_exit(stream, ("exit", "quit"), self.delay, self.idle)
        q = (kept.writeStream.format("parquet").option("path", self.sink)
             .option("checkpointLocation", self.checkpoint).start())
        try:
            q.processAllAvailable()
            self.state = [o.numRowsTotal for p in q.recentProgress for o in p.stateOperators][-1]
        finally:
            q.stop()
        got = self.spark.read.schema(COLUMNS).parquet(self.sink).collect()
        return sorted((r.conv_id, r.turn) for r in got if r.conv_id is not None)


def test_sessions_end_in_any_order_and_state_goes(spark):
    s = Sessions(spark)
    # a turn after the exit arrives before the exit itself: it waits, and goes
    first = [(1, 0), (2, 0), (3, 0)]  # the watermark is at second 0
    assert s.step([(1, 0, "user", "hi"), (1, 2, "user", "after the end"), (2, 0, "user", None), (3, 0, "user", " exit")]) == first
    assert s.step([(1, 1, "user", "EXIT"), (2, 1, "assistant", "exit"), (2, 1, "assistant", "exit"), (3, 1, "user", "Quit")]) == first
    got = s.step([(2, 6, "user", "ok")])
    assert got == sorted([*first, (2, 1), (2, 1)])  # a repeated turn is two turns; ' exit' is no exit word
    assert s.step([(1, 7, "user", "still ended"), (2, 7, "user", "ok")]) == got
    got = sorted([*got, (2, 6), (2, 7)])
    assert s.step([(9, 20, "user", "x")]) == got
    alive = s.state
    # long after: every state but that of the last key has gone, and 1 may open anew
    assert s.step([(9, 500, "user", "x")]) == sorted([*got, (9, 20)]) and s.state < alive
    one = s.state
    assert (1, 600) in s.step([(1, 600, "user", "a new session"), (9, 700, "user", "x")])
    s.step([(9, 2000, "user", "x")])
    assert s.state == one  # bounded by the keys alive, not by those that were


def test_log_restarts_without_loss_or_repeat(spark):
    path, sink, checkpoint = (scratch_path(spark, n) for n in ("log", "out", "ckpt"))
    sent = []
    for k in range(3):
        rows = [(i, k, "user", f"é\n\"{i}\" {k}") for i in range(7)] + [(None, k, None, None), (3, 0, "user", "again")]
        sent += rows
        MS.publish(spark.createDataFrame(rows, COLUMNS), path, partitions=3)
        q = (MS.read_stream(spark, path).writeStream.format("parquet").option("path", sink)
             .option("checkpointLocation", checkpoint).start())
        q.processAllAvailable()
        q.stop()
        got = sorted(map(tuple, spark.read.schema(COLUMNS).parquet(sink).collect()), key=repr)
        assert got == sorted(sent, key=repr)
    assert sorted(map(tuple, MS.read_log(spark, path).collect()), key=repr) == sorted(sent, key=repr)
    assert MS.read_log(spark, scratch_path(spark, "nothing")).count() == 0
    ends = MS._ends(path)
    assert sum(ends.values()) == len(sent)
    part = max(ends, key=ends.get)  # a read from the middle opens the segments it needs only
    some = MS._stretches(path, {part: ends[part] - 1}, {part: ends[part]})
    assert [(x.end - x.start) for x in some] == [1]


def test_log_as_a_sink_publishes_a_batch_once(spark):
    source, target, checkpoint = (scratch_path(spark, n) for n in ("log", "copy", "ckpt"))
    MS.publish(spark.createDataFrame([(i, 0, "user", "x") for i in range(9)], COLUMNS), source)
    q = (MS.read_stream(spark, source).writeStream.format(MS.FORMAT).options(path=target, partitions="2")
         .option("checkpointLocation", checkpoint).start())
    q.processAllAvailable()
    q.stop()
    assert MS.read_log(spark, target).count() == 9
    # the same batch again, as after a failure between publishing and Spark's own record of it
    schema = spark.createDataFrame([], COLUMNS).schema
    writer = MS.LogStreamWriter(schema, {"path": target, "partitions": "2"})
    rows = [r for r in spark.createDataFrame([(i, 0, "user", "x") for i in range(9)], COLUMNS).collect()]
    writer.commit([writer.write(iter(rows))], 0)
    assert MS.read_log(spark, target).count() == 9
    first = writer.write(iter(rows[:2]))
    writer.commit([first], 7)
    writer.commit([first], 7)
    writer.abort([writer.write(iter(rows))], 8)
    assert MS.read_log(spark, target).count() == 11


def test_repeated_turns_are_scored_each(spark):
    docs = spark.createDataFrame([(0, "bad bad bad", 1), (1, "good good", 0), (2, "bad", 1), (3, "good", 0)],
                                 "doc_id BIGINT, text STRING, class INT")
    tokens = TK.word_tokens(docs.select("doc_id", "text")).join(docs.select("doc_id", "class"), "doc_id")
    path = scratch_path(spark, "nb")
    CL.train_naive_bayes(tokens, docs.select("doc_id", "class"), "class").save(path)
    log, sink = scratch_path(spark, "log"), scratch_path(spark, "scored")
    MS.publish(spark.createDataFrame([(1, 0, "user", "bad bad bad"), (1, 0, "user", "good good"), (1, 0, "user", "good good"),
                                      (2, 0, "user", "")], COLUMNS), log)
    SS.score_batches(MS.read_stream(spark, log), CL.NaiveBayes.load(spark, path), sink, scratch_path(spark, "ckpt"))
    got = sorted((r.text, r.verdict) for r in spark.read.schema(SS.SCORED_SCHEMA).parquet(f"{sink}/*").collect())
    assert [g for g in got if g[0]] == [("bad bad bad", "spam"), ("good good", "not spam"), ("good good", "not spam")]
    assert len(got) == 4
