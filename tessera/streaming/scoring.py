"""Structured Streaming forms of the interactive robot.

* ``score_messages``: every arriving message is classified by a saved model and
  emitted with its verdict; exit words are not scored.  Stateless: the model
  is a fitted ``PipelineModel`` whose stages all transform streams.
* ``score_batches``: the same with the naive Bayes tables, per micro-batch.

Sessions that end are in ``sessions``, the message log in ``messages``.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tessera.operators.classify import NaiveBayes, class_name, classify_naive_bayes, with_tokens
from tessera.operators.conversations import exit_predicate
from tessera.operators.tokens import token_blocks
from tessera.session import materialize

CONVERSATION_SCHEMA = "conv_id BIGINT, turn BIGINT, role STRING, text STRING"


def read_message_stream(spark: SparkSession, path: str, schema: str,
                        files_per_batch: int = 1) -> DataFrame:
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
            .parquet(path))


def score_messages(stream: DataFrame, model: PipelineModel, words, id_cols: list[str],
                   text_col: str = "text") -> DataFrame:
    msgs = stream.where(~F.coalesce(exit_predicate(text_col, words), F.lit(False)))  # null texts are scored
    scored = model.transform(with_tokens(msgs, text_col))
    return scored.select(*id_cols, text_col, F.col("prediction").cast("bigint").alias("predicted"),
                         class_name("prediction").alias("verdict"))


SCORED_SCHEMA = "conv_id BIGINT, turn BIGINT, text STRING, predicted BIGINT, verdict STRING"


def score_batches(stream: DataFrame, model: NaiveBayes, sink: str, checkpoint: str) -> None:
    """Score every message of a micro-batch with the tables of ``model``,
    repeated (conversation, turn) rows each by itself.  A batch writes
    its own folder, replacing it when the batch is run again after a failure,
    so every message is scored exactly once."""
    def one(batch: DataFrame, number: int) -> None:
        rows = materialize(batch.withColumn("_id", F.monotonically_increasing_id()))  # fixed before it is read twice
        scored = classify_naive_bayes(model, token_blocks(rows, "_id", counted=True), rows, "_id")
        out = rows.join(scored, "_id").select("conv_id", "turn", "text", "predicted", class_name().alias("verdict"))
        out.write.mode("overwrite").parquet(f"{sink}/batch-{number}")

    drain(stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint))


def drain(writer: DataStreamWriter) -> None:
    """Run a stream over everything there is, with the batches that only move
    the watermark, then stop it; its checkpoint lets it go on later."""
    q = writer.start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()


def run_to_parquet(df: DataFrame, sink: str, checkpoint: str) -> None:
    """Process everything available, append to parquet, stop (exactly-once
    file sink + checkpoint: a restarted job resumes where it stopped)."""
    drain(df.writeStream.format("parquet").option("path", sink)
          .option("checkpointLocation", checkpoint).outputMode("append"))
