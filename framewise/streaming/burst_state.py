"""The greatest letter of every burst, with a state that ends.

The plain aggregate by burst name (``queries.max_letter_per_key``) has no event time in its key, so
its state only grows.  Here every burst is a value in the state store with an event-time timer: each
batch emits the running letter of the bursts it changed, and a burst whose last frame the watermark
has passed is dropped.  Late frames of a dropped burst are behind the watermark, too, and do not come
back as a new burst.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..schemas import WATERMARK

#: The state store that timers and state variables need.
STATE_STORE = ("spark.sql.streaming.stateStore.providerClass",
               "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class GreatestLetter(StatefulProcessor):
    """State of a burst: its greatest letter and the time of its last frame, when its timer is due."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.best = handle.getValueState("best", "letter string, last_ms long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        letter, last = self.best.get() if self.best.exists() else (None, None)
        due = last
        for row in rows:
            if row.letter is not None and (letter is None or row.letter > letter):
                letter = row.letter
            due = row.at_ms if due is None or row.at_ms > due else due
        if due != last:
            if last is not None:
                self.handle.deleteTimer(last)
            self.handle.registerTimer(due)
        self.best.update((letter, due))
        yield Row(burst=key[0], max_letter=letter)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.best.clear()
        return iter(())

    def close(self) -> None:
        pass


def greatest_letters(stream: DataFrame, key: str, letter: str, ts: str) -> DataFrame:
    """Running ``(burst, max_letter)`` in update mode.  Rows with a null time or key are not looked at:
    they belong to the gate (``rejects``)."""
    rows = (stream.where(F.col(ts).isNotNull() & F.col(key).isNotNull()).withWatermark(ts, WATERMARK)
                  .select(F.col(key).alias("burst"), F.col(letter).alias("letter"), ts, F.unix_millis(ts).alias("at_ms")))
    return rows.groupBy("burst").transformWithState(GreatestLetter(), "burst string, max_letter string", "Update", "EventTime")
