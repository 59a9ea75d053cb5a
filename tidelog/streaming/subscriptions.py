"""Subscriptions as a stream: reference counts in keyed state, eviction by timer."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

OUTPUT = "stream STRING, kind STRING, ref_count BIGINT, at_ms BIGINT"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class SubscriptionTracker(StatefulProcessor):
    """State per stream: its open handles (one state entry each), ttl and last close.

    Emits ``active`` when a stream gets its first handle, ``unreferenced`` when the last one
    goes, ``evicted`` when its ttl has passed since or all subscriptions are dropped.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "handle BIGINT", "seq BIGINT")
        self.info = handle.getValueState("info", "ref_count BIGINT, ttl BIGINT")

    def _load(self) -> tuple[int, int]:
        found = self.info.get()
        return (int(found[0]), int(found[1])) if found is not None else (0, 0)

    def _drop_timers(self) -> None:
        for at in list(self.handle.listTimers()):
            self.handle.deleteTimer(at)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        count, ttl = self._load()
        out = []
        batch = pd.concat(list(rows), ignore_index=True).sort_values("seq")
        for row in batch.itertuples(index=False):
            before = count
            if row.kind == "subscribe":
                if not self.open.containsKey((int(row.handle),)):
                    count += 1
                self.open.updateValue((int(row.handle),), (int(row.seq),))
                ttl = int(row.ttl)
                if before == 0:
                    self._drop_timers()
                    out.append((key[0], "active", count, int(row.at_ms)))
            elif row.kind == "unsubscribe":
                if self.open.containsKey((int(row.handle),)):
                    self.open.removeKey((int(row.handle),))
                    count -= 1
                    if count == 0:
                        self.handle.registerTimer(int(row.at_ms) + ttl * 1000)
                        out.append((key[0], "unreferenced", 0, int(row.at_ms)))
            elif row.kind == "unsubscribe_all":
                self.open.clear()
                self._drop_timers()
                count = 0
                out.append((key[0], "evicted", 0, int(row.at_ms)))
        self.info.update((count, ttl))
        yield pd.DataFrame(out, columns=["stream", "kind", "ref_count", "at_ms"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        count, _ = self._load()
        out = []
        if count == 0:
            self.info.clear()
            out.append((key[0], "evicted", 0, int(expiredTimerInfo.getExpiryTimeInMs())))
        yield pd.DataFrame(out, columns=["stream", "kind", "ref_count", "at_ms"])

    def close(self) -> None:
        pass


def track_subscriptions(events: DataFrame, lateness: str = "0 seconds") -> DataFrame:
    """A stream of ``(seq, stream, kind, handle, ttl, at, at_ms)`` as subscription changes.

    ``at`` is the event time; a stream is evicted once the watermark passes its expiry. The
    session needs the RocksDB state store, which keeps handles out of memory.
    """
    return (
        events.withWatermark("at", lateness)
        .groupBy("stream")
        .transformWithStateInPandas(
            statefulProcessor=SubscriptionTracker(),
            outputStructType=OUTPUT,
            outputMode="append",
            timeMode="EventTime",
        )
    )
