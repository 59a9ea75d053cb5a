"""Progress after every line of a feed that runs over several checkpoints."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions.scalars import FULL_SYNC
from tidelog.operators.history import checkpoint_history
from tidelog.operators.ordered import scan_before
from tidelog.operators.skew import lookup_join
from tidelog.operators.status import unpivot_priorities
from tidelog.session import written

COUNTERS = "seq bigint, bucket string, priority int, target_count bigint, at_last bigint, since_last bigint"


def _walk_counters(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counters of one bucket at its checkpoint lines, in line order.

    ``dropped`` is what had been received when the bucket last started over: because its target
    fell below what is stored, or because it was not listed for a while.
    """
    dropped, previous = 0, None
    for batch in batches:
        at_last, since = [], []
        for row in batch.itertuples(index=False):
            if previous is not None and row.line_no != previous + 1:
                dropped = row.received
            if row.target_count < row.received - dropped:
                dropped = row.received
            synced = max(0, row.received_at_completion - dropped)
            at_last.append(synced)
            since.append(row.received - dropped - synced)
            previous = row.line_no
        yield batch[["seq", "bucket", "priority", "target_count"]].assign(at_last=at_last, since_last=since)


def bucket_counters(targets: DataFrame, data: DataFrame, completions: DataFrame) -> DataFrame:
    """Counters of every listed bucket at every checkpoint line.

    ``targets`` has ``(seq, bucket, priority, target_count, removed, full)``, ``data``
    ``(seq, bucket, ops)``, and ``completions`` the ``seq`` of full completions. Partial ones
    do not change the counters.
    """
    fields = ["priority", "target_count"]
    head = ["seq", "bucket", *fields]
    listed = written(
        checkpoint_history(
            targets.where("full").select(head), targets.where(~F.col("full")).select(*head, "removed"), fields=fields
        ),
        "timeline-lists",
    )
    nothing = F.lit(None).cast("bigint")
    lines = listed.select("seq").distinct().withColumn("_done", nothing)
    marks = lines.unionByName(completions.select("seq", F.col("seq").alias("_done")))
    completed = scan_before(marks, "seq", lasts={"completed": F.col("_done")}).where(F.col("_done").isNull())
    placed = written(listed.join(completed.select("seq", "completed"), "seq"), "timeline-placed")
    points = (
        placed.select("bucket", "seq")
        .unionByName(placed.where(F.col("completed").isNotNull()).select("bucket", F.col("completed").alias("seq")))
        .distinct()
    )
    received = written(
        scan_before(
            data.select("bucket", "seq", "ops", F.lit(False).alias("_point")).unionByName(
                points.select("bucket", "seq", F.lit(0).cast("bigint").alias("ops"), F.lit(True).alias("_point"))
            ),
            "seq",
            by=["bucket"],
            sums={"received": F.col("ops")},
        )
        .where("_point")
        .select("bucket", "seq", "received"),
        "timeline-received",
    )
    at_completion = received.select(
        "bucket", F.col("seq").alias("completed"), F.col("received").alias("received_at_completion")
    )
    rows = (
        placed.join(received, ["bucket", "seq"])
        .join(at_completion, ["bucket", "completed"], "left")
        .fillna(0, ["received_at_completion"])
        .select(*head, "line_no", "received", "received_at_completion")
    )
    # A bucket's checkpoint lines arrive in order and in batches.
    ordered = rows.repartition("bucket").sortWithinPartitions("bucket", "seq")
    return ordered.groupBy("bucket").applyInPandas(_walk_counters, COUNTERS)


def feed_timeline(
    targets: DataFrame, data: DataFrame, completions: DataFrame, priorities: Sequence[int] = (FULL_SYNC,)
) -> DataFrame:
    """``(seq, priority, downloaded, total)`` after every line of the feed, from its first checkpoint on.

    Between a full completion and the next checkpoint line nothing is downloading and both
    numbers are NULL. Between two checkpoint lines the targets do not change: progress is what
    held at the first of them plus a running sum over the data lines of listed buckets.
    """
    counters = written(bucket_counters(targets, data, completions), "timeline-counters")
    upto = lambda value, p: F.coalesce(F.sum(F.when(F.col("priority") <= p, value)), F.lit(0).cast("bigint"))
    starts = counters.groupBy(F.col("seq").alias("section")).agg(
        *[upto(F.col("target_count") - F.col("at_last"), p).alias(f"total_{i}") for i, p in enumerate(priorities)],
        *[upto(F.col("since_last"), p).alias(f"start_{i}") for i, p in enumerate(priorities)],
    )
    zero, nothing = F.lit(0).cast("bigint"), F.lit(None).cast("bigint")
    lines = (
        data.select("seq", "bucket", "ops", nothing.alias("_section"), nothing.alias("_done"))
        .unionByName(
            targets.select("seq").distinct().select(
                "seq", F.lit(None).cast("string").alias("bucket"), zero.alias("ops"), F.col("seq").alias("_section"), nothing.alias("_done")
            )
        )
        .unionByName(
            completions.select(
                "seq", F.lit(None).cast("string").alias("bucket"), zero.alias("ops"), nothing.alias("_section"), F.col("seq").alias("_done")
            )
        )
    )
    in_section = scan_before(
        lines, "seq", lasts={"_section_before": F.col("_section"), "_done_before": F.col("_done")}
    ).select(
        "seq",
        "bucket",
        "ops",
        F.coalesce("_section", "_section_before").alias("section"),
        F.coalesce("_done", "_done_before").alias("done"),
    )
    listed = counters.select(F.col("seq").alias("section"), "bucket", "priority")
    marked = written(
        lookup_join(
            in_section.where(F.col("section").isNotNull()), listed, ["section", "bucket"], "left", spread=F.xxhash64("seq")
        ),
        "timeline-marked",
    )
    own = {f"since_{i}": F.when(F.col("priority") <= p, F.col("ops")).otherwise(zero) for i, p in enumerate(priorities)}
    running = scan_before(marked, "seq", by=["section"], sums=own)
    joined = lookup_join(running, starts, ["section"], "left", spread=F.xxhash64("seq"))
    downloading = F.col("done").isNull() | (F.col("done") < F.col("section"))
    shown = joined.select(
        "seq",
        *[
            F.when(downloading, F.coalesce(f"start_{i}", zero) + F.col(f"since_{i}") + own[f"since_{i}"]).alias(f"downloaded_{i}")
            for i in range(len(priorities))
        ],
        *[F.when(downloading, F.coalesce(f"total_{i}", zero)).alias(f"total_{i}") for i in range(len(priorities))],
    )
    return unpivot_priorities(shown, priorities, ["seq"], ["downloaded", "total"])
