"""Session end in a stream, with state that has an end itself.

A conversation ends at its first exit word.  Turns may arrive out of order, so
they wait in the conversation's state until the watermark has passed their
event time; by then every earlier turn has arrived, and the due turns before
the exit are emitted in order.  What an earlier exit would have cut off is
therefore never emitted.

State of a conversation: the waiting turns, and the turn it ended at.  Both go
when the watermark is ``idle`` seconds past the last turn, so the state follows
the conversations that are alive, not those that ever were.  A turn that
arrives later than the watermark allows is dropped by Spark; one that
arrives after the state has gone, with a newer event time, opens the conversation anew.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

TIME = "sent_at"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


class SessionEnd(StatefulProcessor):
    """Waiting turns as a list, the end as a value, a timer per event time."""

    def __init__(self, words: tuple[str, ...], speaker: str, idle_seconds: int):
        self.words, self.speaker, self.idle = frozenset(w.lower() for w in words), speaker, idle_seconds * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "turn BIGINT, role STRING, text STRING, at BIGINT, conv_id BIGINT")
        self.stop = handle.getValueState("stop", "turn BIGINT")
        self.last = handle.getValueState("last", "at BIGINT")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        stop = self.stop.get()[0] if self.stop.exists() else None
        last = self.last.get()[0] if self.last.exists() else None
        times: set[int] = set()
        for chunk in rows:  # a chunk at a time, never the whole group
            new = [(None if pd.isna(t) else int(t), r, x, int(at.timestamp() * 1000), None if pd.isna(c) else int(c))
                   for t, r, x, at, c in zip(chunk["turn"], chunk["role"], chunk["text"], chunk[TIME],
                                             chunk["conv_id"], strict=True)]
            new = [n for n in new if stop is None or n[0] is None or n[0] < stop]
            if new:
                self.waiting.appendList(new)
                times |= {n[3] for n in new}
            newest = int(chunk[TIME].max().timestamp() * 1000)
            last = newest if last is None else max(last, newest)
        for at in times:
            self.handle.registerTimer(at)
        self.last.update((last,))
        self.handle.registerTimer(last + self.idle)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        now = expiredTimerInfo.getExpiryTimeInMs()
        stop = self.stop.get()[0] if self.stop.exists() else None
        due, later = [], []
        for row in self.waiting.get() if self.waiting.exists() else ():
            (due if row[3] <= now else later).append(tuple(row))
        ends = [t for t, role, text, *_ in due
                if t is not None and role == self.speaker and text is not None and text.lower() in self.words]
        if ends:
            stop = min(ends) if stop is None else min(stop, *ends)
            self.stop.update((stop,))
            later = [x for x in later if x[0] is None or x[0] < stop]
        if due:
            if later:
                self.waiting.put(later)
            else:
                self.waiting.clear()
        if self.last.exists() and now >= self.last.get()[0] + self.idle and not later:
            self.waiting.clear()
            self.stop.clear()
            self.last.clear()
        out = sorted((x for x in due if x[0] is None or stop is None or x[0] < stop),
                     key=lambda x: (x[0] is not None, x[0] or 0))
        if out:
            # the id comes from the turns: timers do not tell a null key apart
            yield pd.DataFrame({"conv_id": pd.array([x[4] for x in out], "Int64"), "turn": pd.array([x[0] for x in out], "Int64"),
                                "role": [x[1] for x in out], "text": [x[2] for x in out]})


def until_exit(stream: DataFrame, words, delay: str, idle_seconds: int = 3600, speaker: str = "user") -> DataFrame:
    """(conv_id, turn, role, text) of the turns before each conversation's exit.
    ``stream`` has these columns and the event time ``sent_at``; ``delay`` is how
    much later than the newest turn one may arrive."""
    use_state_store(stream.sparkSession)
    return (stream.withWatermark(TIME, delay).groupBy("conv_id").transformWithStateInPandas(
        SessionEnd(tuple(words), speaker, idle_seconds), "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
        outputMode="Append", timeMode="EventTime"))


def use_state_store(spark: SparkSession) -> None:
    """State with timers needs the RocksDB store."""
    spark.conf.set(_PROVIDER, ROCKS)
