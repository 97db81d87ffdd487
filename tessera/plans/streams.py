"""Registered queries: streaming scoring and streaming session end.

The conversations table is published to a message log band by band, oldest
turns first; a turn's event time follows its number.  The stream is stopped
after the first half and goes on from its checkpoint, as a restarted job does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import classify as CL
from tessera.plans import common as C
from tessera.plans.models import nb_model
from tessera.plans.registry import query
from tessera.session import load_table, scratch_path
from tessera.streaming import messages as MS
from tessera.streaming import scoring as SS
from tessera.streaming import sessions as SE

TURN_BANDS = 2
#: Event time of turn 0, in seconds.
START = 1_600_000_000
LOG_SCHEMA = f"{MS.SCHEMA}, {SE.TIME} STRING"


def _at(turn):
    return F.timestamp_seconds(F.lit(START) + turn).alias(SE.TIME)


def published(spark, d):
    """(log path, seconds a band spans, a function that publishes band k).  After
    the last band come two marks that move the watermark past every turn."""
    path = scratch_path(spark, "messages")
    conv = load_table(spark, d, "conversations").select("conv_id", F.coalesce("turn", F.lit(0)).alias("turn"), "role", "text")
    top = conv.agg(F.max("turn")).first()[0] or 0
    width = top // TURN_BANDS + 1

    def publish(band: int) -> None:
        own = F.least(F.greatest(F.floor(F.col("turn") / width), F.lit(0)), F.lit(TURN_BANDS - 1)) == band
        MS.publish(conv.where(own).withColumn(SE.TIME, _at(F.col("turn"))), path)
        if band == TURN_BANDS - 1:
            mark = spark.range(1).select(*[F.lit(None).cast(t).alias(n) for n, t in (
                ("conv_id", "long"), ("turn", "long"), ("role", "string"), ("text", "string"))],
                _at(F.lit(top + 3 * width + 1)))
            MS.publish(mark, path)
    return path, width, publish


def sessions(spark, path: str, width: int) -> DataFrame:
    stream = MS.read_stream(spark, path, LOG_SCHEMA).withColumn(SE.TIME, F.col(SE.TIME).cast("timestamp"))
    return SE.until_exit(stream, C.EXIT_WORDS, f"{width} seconds", idle_seconds=10 * width)


@query("stream_score")
def stream_score(spark, d):
    """A saved classifier scores the user's messages as they arrive; nothing is
    scored from a conversation's exit word on."""
    model = scratch_path(spark, "stream-model")
    nb_model(spark, d).save(model)
    path, width, publish = published(spark, d)
    sink, checkpoint = scratch_path(spark, "scored"), scratch_path(spark, "scored-ckpt")
    for band in range(TURN_BANDS):
        publish(band)
        SS.score_batches(sessions(spark, path, width).where(F.col("role") == "user"),
                         CL.NaiveBayes.load(spark, model), sink, checkpoint)
    return spark.read.schema(SS.SCORED_SCHEMA).parquet(f"{sink}/*")


@query("stream_until_exit")
def stream_until_exit(spark, d):
    path, width, publish = published(spark, d)
    sink, checkpoint = scratch_path(spark, "sessions"), scratch_path(spark, "sessions-ckpt")
    for band in range(TURN_BANDS):
        publish(band)
        SS.run_to_parquet(sessions(spark, path, width), sink, checkpoint)
    return spark.read.schema("conv_id long, turn long, role string, text string").parquet(sink).select(
        "conv_id", "turn", "text")


@query("message_log")
def message_log(spark, d):
    """Messages published to the log and read back as a table."""
    path = scratch_path(spark, "log")
    MS.publish(load_table(spark, d, "conversations").select("conv_id", "turn", "role", "text"), path)
    return MS.read_log(spark, path)
