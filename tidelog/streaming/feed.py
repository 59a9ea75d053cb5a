"""Applying an arriving feed: ops are staged as they come and published on completion lines.

Staging appends ops to the log, one folder per micro-batch. A completion line decides up to which op each
bucket is visible, so a publish takes the ops between the bounds before and after, merges them into the slices of
the state that they touch, and commits those slices together with the new bounds. What has been published is never
read from the log again. Everything is written to folders named after the micro-batch or the version, so a batch
that is run again replaces its own output.
"""

from __future__ import annotations

from threading import Lock
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.window import Window

from tidelog.operators.feed import declared_rows, op_sums, untyped_rows
from tidelog.operators.skew import Measured, lookup_join, measured
from tidelog.schema import Schema
from tidelog.session import written
from tidelog.sources.lines import (
    classify_lines,
    explode_checkpoints,
    explode_diffs,
    explode_ops,
    number_lines,
)
from tidelog.sources.state import StateStore, child_names, delete_paths

STREAM_LINE = "value STRING"
SEQ = "seq STRUCT<batch: BIGINT, line: BIGINT>"
OPLOG = "bucket STRING, op_id BIGINT, op STRING, row_type STRING, row_id STRING, subkey STRING, data STRING, checksum BIGINT"
TARGETS = f"{SEQ}, bucket STRING, priority INT, checksum BIGINT, removed BOOLEAN, full BOOLEAN, write_checkpoint BIGINT"
COMPLETIONS = f"{SEQ}, priority INT, last_op_id BIGINT"
BUCKETS = "bucket STRING, priority INT, last_op_id BIGINT, visible BOOLEAN, cleared BIGINT, actual BIGINT, op_count BIGINT"
KEYS = "bucket STRING, row_type STRING, row_id STRING, sub STRING, op_id BIGINT, data STRING"
ROWS = "row_id STRING, data STRING, row_type STRING"
MEMBERS = "slice INT, bucket STRING, n BIGINT"


class LocalWrites(Protocol):
    """Local writes that wait for their upload."""

    def local_state(self) -> tuple[bool, int | None]:
        """Whether none waits, and the write checkpoint that the feed must have reached; None without any so far."""


def visible_bounds(targets: DataFrame, completions: DataFrame, published: DataFrame | None = None) -> DataFrame:
    """``(bucket, priority, checksum, last_op_id)``: up to which op each bucket is to be visible.

    ``seq`` is anything with an order, such as a struct of micro-batch and line number.
    ``targets`` has a row per bucket that a checkpoint line sets or a diff removes, with
    ``full`` marking full checkpoints (also by a row without a bucket); ``completions`` has ``(seq, priority, last_op_id)``
    with a NULL priority for full ones. A full completion makes the whole bucket list visible;
    partial ones after it move the buckets whose code they cover on. Without a full completion the
    others stay as ``published`` has them.
    """
    full = completions.where(F.col("priority").isNull())
    full_seq = full.agg(F.max("seq").alias("s")).scalar()
    full_op = full.agg(F.max("last_op_id").alias("o")).scalar()
    partial = completions.where(F.col("priority").isNotNull() & F.coalesce(F.col("seq") > full_seq, F.lit(True)))
    partial_seq = partial.agg(F.max("seq").alias("s")).scalar()
    ahead = _bucket_list(targets, partial_seq)
    # A partial completion covers its own code and all lower ones. One row per code in use.
    reached = partial.groupBy("priority").agg(F.max("last_op_id").alias("_reached"))
    onward = Window.orderBy("priority").rowsBetween(0, Window.unboundedFollowing)
    reach = (
        ahead.select("priority")
        .distinct()
        .join(reached, "priority", "full_outer")
        .select(F.col("priority").alias("code"), F.max("_reached").over(onward).alias("last_op_id"))
        .where(F.col("last_op_id").isNotNull())
    )
    columns = ("bucket", "priority", "checksum", "last_op_id")
    moved = ahead.join(reach, F.col("priority") == F.col("code")).select(*columns)
    if published is None:
        complete = _bucket_list(targets, full_seq).withColumn("last_op_id", full_op)
    else:
        complete = published.withColumn("checksum", F.lit(None).cast("bigint"))
    return complete.join(moved, "bucket", "left_anti").select(*columns).unionByName(moved)


def _bucket_list(targets: DataFrame, upto) -> DataFrame:
    """Buckets in force at a line: the newest entry of each since the last full checkpoint."""
    seen = targets.where(F.col("seq") <= upto)
    start = seen.where("full").agg(F.max("seq").alias("s")).scalar()
    return (
        seen.where(F.col("bucket").isNotNull() & F.coalesce(F.col("seq") >= start, F.lit(True)))
        .groupBy("bucket")
        .agg(*[F.max_by(c, "seq").alias(c) for c in ("removed", "priority", "checksum")])
        .where(~F.col("removed"))
        .drop("removed")
    )


def slice_of(slices: int) -> Column:
    """The slice of a row: all its keys are in the same one, whatever their bucket."""
    return F.pmod(F.xxhash64("row_type", "row_id"), F.lit(slices)).cast("int")


class FeedApplier:
    """Stages and publishes a feed below one state folder.

    The published state is what each bucket holds per key, with its payload, cut into ``slices`` by row, and per
    bucket the bound and the checksum of all it has applied. A publish reads the ops that arrived since, and the
    slices whose rows they touch; the other slices stay as they are, file by file. ``slices`` is fixed when the
    folder is first used: about the final size divided by what one task should rewrite.

    With a ``queue`` of local writes, completions other than those of priority 0 wait until it is empty and the
    feed has reached its write checkpoint. Waiting completions are part of the state: ``retry`` publishes them when
    the queue has drained, without a new line.
    """

    def __init__(
        self, spark: SparkSession, root: str, schema: Schema, compact_after: int = 100, slices: int = 16, queue: LocalWrites | None = None
    ) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.schema = schema
        self.store = StateStore(spark, f"{self.root}/published")
        self.compact_after = compact_after
        self.slices = slices
        self.queue = queue
        #: Slices that the last publish read, for a look at what it cost.
        self.touched: list[int] = []
        self._one_at_a_time = Lock()

    def _path(self, table: str, batch_id: int) -> str:
        return f"{self.root}/{table}/batch={batch_id}"

    def _staged_batches(self) -> list[int]:
        return sorted(int(n.removeprefix("batch=")) for n in child_names(self.spark, f"{self.root}/completions") if n.startswith("batch="))

    def _arrived(self, table: str, kept: str, schema: str, batches: list[int], paths: dict[str, str]) -> DataFrame:
        """What the last publish left in table ``kept``, and what has been staged since."""
        folders = [self._path(table, b) for b in batches]
        folders += [paths[kept]] if kept in paths else []
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def _table(self, name: str, schema: str, paths: dict[str, str]) -> DataFrame:
        return self.spark.read.schema(schema).parquet(paths[name]) if name in paths else self.spark.createDataFrame([], schema)

    def _ready(self, targets: DataFrame, paths: dict[str, str]) -> Column:
        """Whether a completion may be published over the local writes."""
        first = F.coalesce(F.col("priority") == 0, F.lit(False))
        empty, target = self.queue.local_state() if self.queue else (True, None)
        if not empty:
            return first
        if target is None or int(paths.get("@write_checkpoint", -1)) >= target:
            return F.lit(True)
        since = targets.where(F.col("write_checkpoint") >= target).agg(F.min("seq").alias("s")).scalar()
        return first | F.coalesce(F.col("seq") >= since, F.lit(False))

    def apply_batch(self, lines: DataFrame, batch_id: int) -> None:
        """Stages one micro-batch of ``(value, file, block)`` lines; publishes if a completion may be published."""
        with self._one_at_a_time:
            if batch_id <= int(self.store.current()[1].get("@batch", -1)):
                return  # run again after its publish
            self._stage(lines, batch_id)
            self._publish()

    def retry(self) -> bool:
        """Publishes completions that waited for local writes, if they may be published now."""
        with self._one_at_a_time:
            return self._publish()

    def _stage(self, lines: DataFrame, batch_id: int) -> None:
        lines = lines.withColumn("position", F.monotonically_increasing_id())
        seq = F.struct(F.lit(batch_id).cast("bigint").alias("batch"), F.col("seq").alias("line")).alias("seq")
        classified = classify_lines(number_lines(lines)).select(seq, "kind", "content")
        stage = self._path("lines", batch_id)
        # Written once: the ops, targets and completions below are read from this table.
        classified.write.mode("overwrite").parquet(stage)
        staged = self.spark.read.parquet(stage)
        explode_ops(staged).write.mode("overwrite").parquet(self._path("oplog", batch_id))
        fields = ["seq", "bucket", "priority", "checksum", "removed", "full", "write_checkpoint"]
        targets = explode_checkpoints(staged, keep=("seq",)).withColumns({"removed": F.lit(False), "full": F.lit(True)})
        point = lambda kind: F.col(f"content.{kind}.write_checkpoint").cast("bigint").alias("write_checkpoint")
        marks = staged.where(F.col("kind") == "checkpoint").select("seq", F.lit(True).alias("full"), point("checkpoint"))
        # A diff line may name a write checkpoint without any bucket.
        points = staged.where(F.col("kind") == "checkpoint_diff").select("seq", F.lit(False).alias("full"), point("checkpoint_diff"))
        diffs = explode_diffs(staged, keep=("seq",)).withColumn("full", F.lit(False))
        control = targets.select(fields).unionByName(diffs.select(fields))
        for more in (marks, points):
            control = control.unionByName(more, allowMissingColumns=True)
        control.write.mode("overwrite").parquet(self._path("targets", batch_id))
        completions = staged.where(F.col("kind").isin("checkpoint_complete", "partial_checkpoint_complete")).select(
            "seq",
            F.col("content.partial_checkpoint_complete.priority").alias("priority"),
            F.coalesce("content.checkpoint_complete.last_op_id", "content.partial_checkpoint_complete.last_op_id")
            .cast("bigint")
            .alias("last_op_id"),
        )
        completions.write.mode("overwrite").parquet(self._path("completions", batch_id))

    def _publish(self) -> bool:
        version, paths = self.store.current()
        done = int(paths.get("@batch", -1))
        batches = [b for b in self._staged_batches() if b > done]
        completions = self._arrived("completions", "held", COMPLETIONS, batches, paths)
        targets = self._arrived("targets", "targets", TARGETS, batches, paths)
        completions = written(completions.withColumn("ready", self._ready(targets, paths)), "feed-completions")
        is_full = F.col("priority").isNull()
        some, full = completions.where("ready").agg(F.count(F.lit(1)), F.count(F.when(is_full, 1))).first()
        if not some:
            return False
        before = self._table("buckets", BUCKETS, paths)
        published = before.where("visible").select("bucket", "priority", "last_op_id")
        wanted = written(visible_bounds(targets, completions.where("ready"), None if full else published), "feed-wanted")
        fresh = self._fresh(self._arrived("oplog", "pending", OPLOG, batches, paths), before, wanted)
        # Ops that were delivered more than once count once.
        narrow = fresh.where("due").select("bucket", "op_id", "op", "row_type", "row_id", "sub", "slice", "checksum")
        narrow = written(narrow.dropDuplicates(["bucket", "op_id"]), "feed-due")
        buckets = measured(self._buckets(before, wanted, narrow), "feed-buckets")
        state = buckets.frame.where("known").select(*[f.strip().split()[0] for f in BUCKETS.split(",")])

        entries = self._slices(version + 1, paths, fresh, narrow, buckets)
        pending = lookup_join(fresh, buckets.part("known", "bucket", "last_op_id"), ["bucket"], "left", spread=F.xxhash64("op_id"))
        pending = pending.where(F.col("op_id") > F.coalesce("last_op_id", F.lit(-1))).dropDuplicates(["bucket", "op_id"])
        held = completions.where(~F.col("ready"))
        if full:  # a later full completion stands for those before it
            held = held.where(F.col("seq") > completions.where(F.col("ready") & is_full).agg(F.max("seq").alias("s")).scalar())
        # Lines before the full checkpoint that the next completion builds on are not needed again.
        next_seq = held.agg(F.min("seq").alias("s")).scalar()
        start = targets.where(F.col("full") & F.coalesce(F.col("seq") <= next_seq, F.lit(True))).agg(F.max("seq").alias("s")).scalar()
        point = targets.agg(F.max("write_checkpoint")).first()[0]
        entries["@write_checkpoint"] = str(max(int(paths.get("@write_checkpoint", -1)), -1 if point is None else point)) if full else paths.get("@write_checkpoint")
        entries["@batch"] = str(max([done, *batches]))
        self.store.publish(
            version + 1,
            {
                "buckets": state,
                "pending": pending.select(*[f.strip().split()[0] for f in OPLOG.split(",")]),
                "targets": targets.where(F.coalesce(F.col("seq") >= start, F.lit(True))),
                "held": held.drop("ready"),
                "failed": buckets.frame.where("failed").select("bucket", "expected", F.col("found").alias("actual")),
            },
            entries=entries,
        )
        if len(self._staged_batches()) >= self.compact_after:
            self.compact()
        return True

    def _fresh(self, ops: DataFrame, before: DataFrame, wanted: DataFrame) -> DataFrame:
        """The arrived ops; ``due`` marks those that become visible, if their bucket's checksum is right."""
        limits = before.select("bucket", F.col("last_op_id").alias("_from")).join(
            wanted.select("bucket", F.col("last_op_id").alias("_upto")), "bucket", "full_outer"
        )
        bounded = lookup_join(ops, limits, ["bucket"], "left", spread=F.xxhash64("op_id"))
        new = F.coalesce(F.col("op_id") > F.col("_from"), F.lit(True))
        due = F.coalesce(F.col("op_id") <= F.col("_upto"), F.lit(False)) & new
        sub = F.coalesce(F.concat(F.lit("="), "subkey"), F.lit(""))
        marked = bounded.where(new).withColumns({"due": due, "sub": sub, "slice": slice_of(self.slices)})
        return written(marked.drop("_from", "_upto"), "feed-fresh")

    def _buckets(self, before: DataFrame, wanted: DataFrame, narrow: DataFrame) -> DataFrame:
        """Every bucket's state after the publish; one with a wrong checksum stays at what was published before."""
        modulus = F.lit(4294967296)
        sums = op_sums(narrow).select("bucket", F.col("actual").alias("_sum"), F.col("op_count").alias("_count"))
        clears = narrow.where(F.col("op") == "CLEAR").groupBy("bucket").agg(F.max("op_id").alias("_clear"))
        new = wanted.select("bucket", F.lit(True).alias("_wanted"), *[F.col(c).alias(f"_{c}") for c in ("priority", "checksum", "last_op_id")])
        joined = before.withColumn("_was", F.lit(True)).join(new, "bucket", "full_outer").join(sums, "bucket", "left").join(clears, "bucket", "left")
        zero = F.lit(0).cast("bigint")
        found = F.pmod(F.coalesce("actual", zero) + F.coalesce("_sum", zero), modulus)
        expected = F.pmod(F.col("_checksum"), modulus)
        moves = F.coalesce("_wanted", F.lit(False)) & F.coalesce(expected == found, F.lit(True))
        failed = F.coalesce("_wanted", F.lit(False)) & ~moves

        def after(new_value: Column, old: str) -> Column:
            return F.when(moves, new_value).otherwise(F.col(old)).alias(old)

        visible = F.when(moves, True).otherwise(failed & F.coalesce("visible", F.lit(False)))
        cleared = F.greatest("cleared", "_clear")
        changed = ~F.coalesce("visible", F.lit(False)).eqNullSafe(visible) | (moves & F.col("_clear").isNotNull())
        return joined.select(
            "bucket",
            after(F.col("_priority"), "priority"),
            after(F.greatest("last_op_id", "_last_op_id"), "last_op_id"),
            visible.alias("visible"),
            after(cleared, "cleared"),
            after(found, "actual"),
            after(F.coalesce("op_count", zero) + F.coalesce("_count", zero), "op_count"),
            (moves | F.col("_was").isNotNull()).alias("known"),
            moves.alias("moves"),
            changed.alias("changed"),
            failed.alias("failed"),
            expected.alias("expected"),
            found.alias("found"),
        )

    def _slices(self, version: int, paths: dict[str, str], fresh: DataFrame, narrow: DataFrame, buckets: Measured) -> dict[str, str | None]:
        """Writes the slices that the due ops and the changed buckets touch; returns their entries for the commit."""
        key = ["bucket", "row_type", "row_id", "sub"]
        due = lookup_join(narrow, buckets.part("moves", "bucket"), ["bucket"], "left_semi", spread=F.xxhash64("op_id")).where(F.col("op").isin("PUT", "REMOVE"))
        newest = due.groupBy(*key, "slice").agg(F.max("op_id").alias("newest"), F.max(F.when(F.col("op") == "PUT", F.col("op_id"))).alias("op_id"))
        newest = measured(newest, "feed-newest")
        members = self._table("members", MEMBERS, paths)
        changed = members.join(buckets.frame.where("changed").select("bucket"), "bucket", "left_semi")
        touched = newest.frame.select("slice").union(changed.select("slice")).distinct()
        self.touched = sorted(r["slice"] for r in touched.collect())  # fewer than there are slices
        old = self.store.read_slices("keys", KEYS, paths, self.touched)
        kept = lookup_join(old, newest.part("true", *key), key, "left_anti", spread=F.xxhash64("op_id"))
        payload = fresh.where(F.col("due") & (F.col("op") == "PUT")).select("op_id", "data")
        puts = lookup_join(payload, newest.part(F.col("newest") == F.col("op_id"), "op_id", *key), ["op_id"], "inner").dropDuplicates(["op_id"])
        columns = [f.strip().split()[0] for f in KEYS.split(",")]
        merged = kept.select(*columns).unionByName(puts.select(*columns))
        merged = lookup_join(merged, buckets.part("known", "bucket", "cleared"), ["bucket"], "left", spread=F.xxhash64("op_id"))
        merged = merged.where(F.coalesce(F.col("op_id") > F.col("cleared"), F.lit(True))).drop("cleared")
        entries = self.store.stage_slices(version, "keys", merged.withColumn("slice", slice_of(self.slices)), self.touched)

        staged = {name: path for name, path in entries.items() if path}
        keys = self.store.read_slices("keys", KEYS, staged)
        seen = lookup_join(keys, buckets.part("visible", "bucket"), ["bucket"], "left_semi", spread=F.xxhash64("op_id"))
        winners = seen.groupBy("row_type", "row_id").agg(F.max("op_id").alias("op_id")).select("op_id")
        rows = seen.select("op_id", "row_type", "row_id", "data").join(winners, "op_id", "left_semi").drop("op_id")
        entries |= self.store.stage_slices(version, "rows", rows.withColumn("slice", slice_of(self.slices)), self.touched, ["row_type"])
        counted = keys.withColumn("slice", slice_of(self.slices)).groupBy("slice", "bucket").agg(F.count(F.lit(1)).alias("n"))
        path = f"{self.store.root}/tables/members/v={version}"
        members.where(~F.col("slice").isin(self.touched)).unionByName(counted).write.mode("overwrite").parquet(path)
        return entries | {"members": path}

    def compact(self) -> None:
        """Removes staged batches that are published, and versions before the last two."""
        done = int(self.store.current()[1].get("@batch", -1))
        old = [b for b in self._staged_batches() if b <= done]
        delete_paths(self.spark, [self._path(t, b) for b in old for t in ("lines", "oplog", "targets", "completions")])
        self.store.retain(2)

    def _rows(self) -> DataFrame:
        return self.store.read_slices("rows", ROWS, self.store.current()[1])

    def rows(self) -> DataFrame | None:
        """The published rows of declared types, or None before the first completion."""
        return None if self.store.current()[0] < 0 else declared_rows(self._rows(), self.schema)

    def held(self) -> DataFrame | None:
        """Completions that wait for local writes, as of the last publish: ``(seq, priority, last_op_id)``."""
        return None if self.store.current()[0] < 0 else self.store.read("held")

    def failed(self) -> DataFrame | None:
        """Buckets held back at the last completion: ``(bucket, expected, actual)`` checksums."""
        return None if self.store.current()[0] < 0 else self.store.read("failed")

    def untyped(self) -> DataFrame:
        return untyped_rows(self._rows(), self.schema)


def start_feed(
    applier: FeedApplier,
    lines_path: str,
    checkpoint: str,
    max_files_per_trigger: int = 1000,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Starts applying the NDJSON files that arrive below ``lines_path``."""
    lines = (
        applier.spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger)
        .text(lines_path)
        .select(
            "value",
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
        )
        .where(F.trim("value") != "")
    )
    return (
        lines.writeStream.foreachBatch(applier.apply_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
