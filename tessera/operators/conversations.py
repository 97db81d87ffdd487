"""Conversation sessions that end at an exit word."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def exit_predicate(text_col: str, words) -> F.Column:
    """lower(text) is one of the exit words — no trimming: ' exit' does not stop."""
    return F.lower(F.col(text_col)).isin(*[w.lower() for w in words])


def until_exit(conv: DataFrame, words, id_col: str = "conv_id", order_col: str = "turn",
               text_col: str = "text", role_col: str | None = "role",
               speaker: str = "user") -> DataFrame:
    """Keep the turns before a conversation's first exit message (the exit
    message itself is not answered, later input is ignored).

    The first exit per conversation is a partial/final ``min`` aggregate
    (map-side combined, so one huge conversation does not form a hot group);
    it joins back on the conversation key as a one-row-per-key table."""
    is_exit = exit_predicate(text_col, words)
    if role_col is not None:
        is_exit = is_exit & (F.col(role_col) == F.lit(speaker))
    first_exit = (conv.where(is_exit).groupBy(id_col)
                  .agg(F.min(order_col).alias("_stop")))
    return (conv.join(first_exit, id_col, "left")
            .where(F.col("_stop").isNull() | (F.col(order_col) < F.col("_stop")))
            .drop("_stop"))
