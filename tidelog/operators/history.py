"""The bucket list after each checkpoint line of a feed, as intervals of lines or line by line."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.operators.ordered import scan_before
from tidelog.session import written

STEP = 65_536


FIELDS = ("priority", "target_count", "checksum")


def checkpoint_intervals(checkpoints: DataFrame, diffs: DataFrame, lines: DataFrame | None = None, fields: Sequence[str] = FIELDS) -> DataFrame:
    """For each entry of a bucket the lines it is in force: ``seq, from_line, to_line`` (exclusive), ``bucket`` and ``fields``.

    ``checkpoints`` has ``(seq, bucket, *fields)`` with a row per
    bucket of a full checkpoint line, ``diffs`` the same plus ``removed`` for diff lines. Lines
    are numbered densely; a bucket's entry is in force from its line up to the bucket's next
    entry or the next full checkpoint. There are no more rows than entries.
    ``lines`` has ``(seq, full)`` of every line and is needed when some name no bucket.
    """
    return _intervals(checkpoints, diffs, lines, fields)[0]


def checkpoint_history(checkpoints: DataFrame, diffs: DataFrame, lines: DataFrame | None = None, fields: Sequence[str] = FIELDS) -> DataFrame:
    """Per checkpoint line, the buckets in force after it: the intervals, written out once for each of their lines."""
    intervals, numbered = _intervals(checkpoints, diffs, lines, fields)
    # In two steps, so that an entry in force for many lines is spread and needs no long array.
    last = F.least(F.col("_from") + (STEP - 1), F.col("to_line") - 1)
    return (
        intervals.drop("seq")
        .withColumn("_from", F.explode(F.sequence(F.col("from_line"), F.col("to_line") - 1, F.lit(STEP).cast("bigint"))))
        .repartition("_from", "bucket")
        .select(F.explode(F.sequence(F.col("_from"), last)).alias("line_no"), "bucket", *fields)
        .join(numbered, "line_no")
        .select("seq", "line_no", "bucket", *fields)
    )


def _intervals(checkpoints: DataFrame, diffs: DataFrame, lines: DataFrame | None, fields: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The intervals, and ``(seq, line_no)`` of every line."""
    entries = checkpoints.withColumn("removed", F.lit(False)).withColumn("full", F.lit(True)).unionByName(
        diffs.withColumn("full", F.lit(False))
    )
    if lines is None:
        lines = entries.groupBy("seq").agg(F.max("full").alias("full"))
    numbered = scan_before(lines, "seq", sums={"line_no": F.lit(1).cast("bigint")})
    # Backwards over the lines: the next full checkpoint of each, or the end of the feed.
    forward = written(
        scan_before(
            numbered.withColumn("_back", -F.col("line_no")),
            "_back",
            lasts={"next_full": F.when(F.col("full"), F.col("line_no"))},
        ).select("seq", "line_no", "next_full"),
        "history-lines",
    )
    end = lines.agg(F.count(F.lit(1)).alias("_n")).scalar()
    placed = entries.drop("full").join(forward, "seq").withColumn("_back", -F.col("line_no"))
    until = scan_before(placed, "_back", by=["bucket"], lasts={"next_entry": F.col("line_no")})
    stop = F.least(F.coalesce("next_entry", end), F.coalesce("next_full", end))
    intervals = until.where(~F.col("removed")).select("seq", F.col("line_no").alias("from_line"), stop.alias("to_line"), "bucket", *fields)
    return intervals, forward.select("seq", "line_no")
