"""Throttling a stream per key, in processing time."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUTPUT = "key STRING, seq BIGINT, emitted_ms BIGINT"
STATE = "pause_until BIGINT, pending BIGINT"


def throttle_stream(events: DataFrame, window_ms: int) -> DataFrame:
    """``(key, seq, emitted_ms)`` of a stream of ``(key, seq)``.

    The first event of a key passes; then the newest one seen during each pause, when it ends.
    State is two numbers per key, and only the newest event of a micro-batch is kept.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.getCurrentProcessingTimeMs()
        pause_until, pending = state.get if state.exists else (0, None)
        out = []
        if state.hasTimedOut:
            if pending is not None:
                out.append((key[0], pending, now))
                pause_until, pending = now + window_ms, None
        else:
            for batch in batches:
                if batch.empty:
                    continue
                if now >= pause_until and pending is None and not out:
                    first = int(batch["seq"].min())
                    out.append((key[0], first, now))
                    pause_until = now + window_ms
                    rest = batch[batch["seq"] > first]["seq"]
                else:
                    rest = batch["seq"]
                if len(rest):
                    pending = max(int(rest.max()), pending if pending is not None else -1)
        if pending is None and now >= pause_until:
            state.remove()
        else:
            state.update((pause_until, pending))
            state.setTimeoutDuration(max(1, pause_until - now))
        yield pd.DataFrame(out, columns=["key", "seq", "emitted_ms"])

    return events.groupBy("key").applyInPandasWithState(
        step, OUTPUT, STATE, "append", GroupStateTimeout.ProcessingTimeTimeout
    )
