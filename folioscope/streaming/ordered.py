"""Events judged in order of time over a stream, whatever batches they come in.

Events of a key wait in a list of its state until the watermark has passed them. Then a timer takes up all that are due, sorted by time and
id, so nothing depends on how the stream was cut into batches, and no batch of a key is held beside its state. Rows behind the
watermark are dropped before they reach any state; Spark counts them (``numRowsDroppedByWatermark``). Rows without key or time take no part;
repeated rows are judged each. State is in RocksDB (``use_rocksdb``), which this kind of operator needs.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Events appended to the list at once.
SOME = 1000


def use_rocksdb(spark: SparkSession) -> None:
    """Keeps the state of streams that start afterwards in RocksDB, on disk, instead of the executors' heap."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


class InOrder(StatefulProcessor):
    """Hands the due events (at, id, what) of a key, times in microseconds, to ``take``; its rows are completed by the key."""

    def __init__(self, key: str):
        self.key = key

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "at long, id long, what string")

    def take(self, due: list[tuple], now: int) -> Iterator[dict]:
        """Rows for the events up to the watermark ``now``; also called when a timer of its own is due and no event is."""
        raise NotImplementedError

    def wake(self, at: int) -> None:
        """Sees to it that ``take`` is called once the watermark has passed ``at``."""
        self.handle.registerTimer(at // 1000 + 1)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        last, some = 0, []
        for r in rows:
            some.append((r["_at"], r["_id"], r["_what"]))
            last = max(last, r["_at"])
            if len(some) >= SOME:
                self.waiting.appendList(some)
                some = []
        if some:
            self.waiting.appendList(some)
        self.handle.registerTimer(-(-last // 1000))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs() * 1000
        waiting = sorted((tuple(x) for x in self.waiting.get()), key=lambda x: (x[0], x[1] is not None, x[1] or 0, x[2] or "")) if self.waiting.exists() else []
        due = [x for x in waiting if x[0] <= now]
        rows = list(self.take(due, now))
        if due:
            left = waiting[len(due) :]
            self.waiting.clear()
            if left:
                self.waiting.put(left)
        for row in rows:
            yield Row(**{self.key: key[0], **row})

    def close(self) -> None:
        pass


def judged(events: DataFrame, processor: InOrder, event_id: str, what: str, columns: str, delay: str) -> DataFrame:
    """The stream of a processor's rows, key first, over events (key, at, event_id, what), each once the watermark, ``delay`` behind the latest time, has passed it."""
    key = processor.key
    rows = events.where(F.col(key).isNotNull() & F.col("at").isNotNull())
    rows = rows.select(key, "at", F.unix_micros("at").alias("_at"), F.col(event_id).cast("long").alias("_id"), F.col(what).cast("string").alias("_what"))
    kind = rows.schema[key].dataType.simpleString()
    return rows.withWatermark("at", delay).groupBy(key).transformWithState(processor, f"{key} {kind}, {columns}", "append", "eventTime")
