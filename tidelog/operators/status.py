"""Download progress and sync status.

Priorities are codes: a lower code is synced earlier, and "up to p" means code <= p.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidelog.functions.scalars import FULL_SYNC, progress_fraction
from tidelog.operators.ordered import scan_before
from tidelog.operators.skew import lookup_join

ENTRY = "STRUCT<priority: INT, last_synced_at: BIGINT, has_synced: BOOLEAN>"
STREAM = (
    "STRUCT<name: STRING, parameters: STRING, priority: INT, progress: STRUCT<downloaded: BIGINT, total: BIGINT>, "
    "active: BOOLEAN, is_default: BOOLEAN, has_explicit_subscription: BOOLEAN, expires_at: BIGINT, "
    "last_synced_at: BIGINT>"
)
STATUS_SCHEMA = (
    "STRUCT<connected: BOOLEAN, connecting: BOOLEAN, "
    "downloading: STRUCT<buckets: MAP<STRING, STRUCT<priority: INT, at_last: BIGINT, since_last: BIGINT, "
    f"target_count: BIGINT>>>, priority_status: ARRAY<{ENTRY}>, streams: ARRAY<{STREAM}>>"
)


def unpivot_priorities(rows: DataFrame, priorities: Sequence[int], keep: Sequence[str], names: Sequence[str]):
    """Columns ``<name>_<i>`` of the i-th priority as one row per priority."""
    per_priority = F.array(
        *[
            F.struct(F.lit(p).alias("priority"), *[F.col(f"{n}_{i}").alias(n) for n in names])
            for i, p in enumerate(priorities)
        ]
    )
    return rows.select(*keep, F.explode(per_priority).alias("_p")).select(*keep, "_p.*")


def download_progress(buckets: DataFrame, priorities: Sequence[int] = (FULL_SYNC,)) -> DataFrame:
    """Total and downloaded ops up to each asked priority, over all buckets in one pass."""

    def upto(value: Column, p: int) -> Column:
        summed = F.sum(F.when(F.col("priority") <= p, value))
        return F.coalesce(summed, F.lit(0)).cast("bigint")

    sums = buckets.agg(
        *[
            c
            for i, p in enumerate(priorities)
            for c in (
                upto(F.col("target_count") - F.col("at_last"), p).alias(f"total_{i}"),
                upto(F.col("since_last"), p).alias(f"downloaded_{i}"),
            )
        ]
    )
    rows = unpivot_priorities(sums, priorities, [], ["total", "downloaded"])
    return rows.withColumn("fraction", progress_fraction(F.col("downloaded"), F.col("total")))


def progress_resume(stored: DataFrame, targets: DataFrame) -> DataFrame:
    """Counters of each target bucket from what is stored.

    ``stored`` has ``(bucket, at_last, since_last)``, ``targets`` ``(bucket, priority,
    target_count)``. A target below what is stored means the bucket was rebuilt: it starts over.
    """
    zero = F.lit(0).cast("bigint")
    at_last, since = F.coalesce("at_last", zero), F.coalesce("since_last", zero)
    rebuilt = F.col("target_count") < at_last + since
    return targets.join(stored.select("bucket", "at_last", "since_last"), "bucket", "left").select(
        "bucket",
        "priority",
        "target_count",
        F.when(rebuilt, zero).otherwise(at_last).alias("at_last"),
        F.when(rebuilt, zero).otherwise(since).alias("since_last"),
    )


def complete_download(buckets: DataFrame) -> DataFrame:
    """Counters after a full completion: all that was received counts as synced."""
    return buckets.withColumns(
        {"at_last": F.col("at_last") + F.col("since_last"), "since_last": F.lit(0).cast("bigint")}
    )


def progress_timeline(
    buckets: DataFrame, lines: DataFrame, priorities: Sequence[int] = (FULL_SYNC,)
) -> DataFrame:
    """Progress after every data line ``(seq, bucket, ops)`` of one download.

    ``buckets`` are the counters at its start. Targets do not change within a download,
    so the progress over all buckets is a running sum over lines; lines of buckets that the
    checkpoint does not list count nothing.
    """
    start = download_progress(buckets, priorities)
    marked = lookup_join(
        lines.select("seq", "bucket", "ops"),
        buckets.select("bucket", "priority"),
        ["bucket"],
        "left",
        spread=F.xxhash64("seq"),
    )
    own = {f"since_{i}": F.when(F.col("priority") <= p, F.col("ops")).otherwise(F.lit(0)) for i, p in enumerate(priorities)}
    running = scan_before(marked, "seq", sums=own).select(
        "seq", *[(F.col(n) + e).alias(n) for n, e in own.items()]
    )
    rows = unpivot_priorities(running, priorities, ["seq"], ["since"])
    # One row per asked priority: the list is an argument of the call.
    return rows.join(F.broadcast(start), "priority").select(
        "seq", "priority", (F.col("downloaded") + F.col("since")).alias("downloaded"), "total"
    )


def status_snapshot(statuses: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Status JSON (column ``status``) and client-side errors as one typed status row.

    ``statuses`` also has ``uploading``, ``upload_error`` and ``download_error``.
    """
    parsed = statuses.withColumn("_s", F.from_json("status", STATUS_SCHEMA))
    entries = F.col("_s.priority_status")
    full = F.filter(entries, lambda e: e.priority == FULL_SYNC)
    return parsed.select(
        *keep,
        F.col("_s.connected").alias("connected"),
        F.col("_s.connecting").alias("connecting"),
        F.col("_s.downloading").isNotNull().alias("downloading"),
        "uploading",
        (F.size(full) > 0).alias("has_synced"),
        F.try_element_at(full, F.lit(1)).getField("last_synced_at").alias("last_synced_at"),
        F.size(entries).alias("n_entries"),
        F.coalesce("download_error", "upload_error").alias("any_error"),
    )


def tracked_streams(statuses: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One row per stream a status JSON names, with whether a download is running."""
    parsed = statuses.withColumn("_s", F.from_json("status", STATUS_SCHEMA))
    streams = parsed.select(
        *keep, F.col("_s.downloading").isNotNull().alias("downloading"), F.explode("_s.streams").alias("_t")
    )
    return streams.select(
        *keep,
        "downloading",
        F.col("_t.*"),
        F.col("_t.progress.downloaded").alias("downloaded"),
        F.col("_t.progress.total").alias("total"),
    ).drop("progress")


def asof_priority(requests: DataFrame, entries: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per ``(by, priority)`` request the entry with the smallest code >= the priority.

    Requests and entries are brought to one row per key and code first, so that a window
    holds no more rows than there are priority codes in use.
    """
    key = [*by, "priority"]
    asked = requests.select(*key).distinct()
    known = entries.groupBy(*key).agg(
        F.max("last_synced_at").alias("last_synced_at"), F.max("has_synced").alias("has_synced")
    )
    value = ["last_synced_at", "has_synced"]
    onward = Window.partitionBy(*by).orderBy("priority").rowsBetween(0, Window.unboundedFollowing)
    both = asked.withColumn("_asked", F.lit(True)).join(
        known.withColumn("entry_priority", F.col("priority")), key, "full_outer"
    )
    entry = F.when(F.col("entry_priority").isNotNull(), F.struct("entry_priority", *value))
    return (
        both.withColumn("_e", F.first(entry, ignorenulls=True).over(onward))
        .where("_asked")
        .select(*key, "_e.*")
    )


def status_for_priority(entries: DataFrame, by: Sequence[str], priorities: Sequence[int]) -> DataFrame:
    """The status of each asked priority per ``by`` key, from its per-priority entries.

    Completion at a code includes every lower code, so the entry with the smallest code that
    is not below the asked one answers; a full sync is the entry with the largest code.
    """
    found = [
        F.min(F.when(F.col("priority") >= p, F.col("priority"))).alias(f"entry_priority_{i}")
        for i, p in enumerate(priorities)
    ]
    times = [
        F.min_by("last_synced_at", F.when(F.col("priority") >= p, F.col("priority"))).alias(f"last_synced_at_{i}")
        for i, p in enumerate(priorities)
    ]
    kept = entries.groupBy(*by).agg(*found, *times)
    rows = unpivot_priorities(kept, priorities, list(by), ["entry_priority", "last_synced_at"])
    return rows.withColumn("has_synced", F.col("entry_priority").isNotNull())


def first_sync_time(events: DataFrame, by: Sequence[str], priority: int | None = None) -> DataFrame:
    """Per key the first status event at which a full sync, or one up to a priority, is done."""
    wanted = F.col("priority") >= (FULL_SYNC if priority is None else priority)
    return events.where(wanted).groupBy(*by).agg(F.min("seq").alias("first_seq"))


def sync_state_upsert(events: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row per key and priority with its last sync, however often it was synced."""
    return events.groupBy(*by, "priority").agg(F.max("seq").alias("last_synced_at"))
