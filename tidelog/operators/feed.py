"""Folding an op log into current rows, at checkpoints, by bucket and priority.

Rules this module defines for itself, where the feed's protocol leaves them open:

* The newest op of each ``(bucket, row_type, row_id, subkey)`` decides whether that bucket
  still holds the row; among the buckets that hold it the newest PUT supplies the data. A
  row held by two buckets therefore survives its removal from one.
* A bucket's checksum is the sum of its op checksums modulo 2**32; every op kind counts.
* CLEAR hides every earlier op of its bucket. MOVE carries a checksum and no row.
* Rows whose type is not declared are kept apart and appear once the schema has the type.

Op ids are unique in a log. The folds aggregate bigints only, so they run as hash
aggregates over a narrow scan; payloads join in afterwards on the winners' op ids.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.scalars import sum_modulo_32_bits
from tidelog.operators.skew import lookup_join
from tidelog.schema import Schema

OP_KEY = ("bucket", "row_type", "row_id", "subkey")


def last_op(checkpoint: DataFrame) -> Column:
    """The op id a checkpoint stands for, as a scalar subquery."""
    return checkpoint.agg(F.max("last_op_id").alias("_cut")).scalar()


def newest_per_key(oplog: DataFrame) -> DataFrame:
    """Per op key the newest op id, and the newest PUT's op id (NULL when there is none)."""
    return (
        oplog.where(F.col("op").isin("PUT", "REMOVE"))
        .groupBy(*OP_KEY)
        .agg(
            F.max("op_id").alias("newest"),
            F.max(F.when(F.col("op") == "PUT", F.col("op_id"))).alias("put"),
        )
    )


def newest_clear(oplog: DataFrame) -> DataFrame:
    return oplog.where(F.col("op") == "CLEAR").groupBy("bucket").agg(F.max("op_id").alias("cleared"))


def drop_cleared(rows: DataFrame, oplog: DataFrame, op_id: str) -> DataFrame:
    """``rows`` without those that a later CLEAR of their bucket hides."""
    joined = lookup_join(
        rows, newest_clear(oplog), ["bucket"], "left", spread=F.xxhash64(op_id), key_sample=oplog
    )
    return joined.where(F.col("cleared").isNull() | (F.col(op_id) > F.col("cleared"))).drop("cleared")


def with_payload(winners: DataFrame, oplog: DataFrame) -> DataFrame:
    """``(row_type, row_id, data)`` of winning PUTs, joined on their unique op ids."""
    puts = oplog.where(F.col("op") == "PUT").select("op_id", "data")
    return winners.join(puts, "op_id").select("row_type", "row_id", "data")


def live_puts(oplog: DataFrame, buckets: DataFrame | None = None) -> DataFrame:
    """``(bucket, row_type, row_id, put)``: what each bucket holds after its newest ops.

    With ``buckets`` only those count. Membership and the newest CLEAR come from one lookup
    per folded key, after the log has been reduced.
    """
    held = newest_per_key(oplog).where(F.col("newest") == F.col("put"))
    held = held.select("bucket", "row_type", "row_id", "put")
    if buckets is None:
        return drop_cleared(held, oplog, "put")
    known = buckets.select("bucket").join(newest_clear(oplog), "bucket", "left")
    joined = lookup_join(held, known, ["bucket"], "inner", spread=F.xxhash64("put"), key_sample=oplog)
    return joined.where(F.col("cleared").isNull() | (F.col("put") > F.col("cleared"))).drop("cleared")


def newest_put(held: DataFrame) -> DataFrame:
    return held.groupBy("row_type", "row_id").agg(F.max("put").alias("op_id"))


def apply_oplog(oplog: DataFrame) -> DataFrame:
    """Current rows ``(row_type, row_id, data)`` after every op of the log."""
    return with_payload(newest_put(live_puts(oplog)), oplog)


def lww_latest(oplog: DataFrame) -> DataFrame:
    """The newest op of each op key with all its columns: the last writer wins."""
    keys = newest_per_key(oplog).select(F.col("newest").alias("op_id"))
    return oplog.join(keys, "op_id", "left_semi")


def checkpoint_cut(oplog: DataFrame, checkpoint: DataFrame) -> DataFrame:
    """The ops a completed checkpoint makes visible: of its buckets, up to its last op."""
    visible = oplog.where(F.col("op_id") <= last_op(checkpoint))
    return lookup_join(
        visible, checkpoint.select("bucket"), ["bucket"], "left_semi", spread=F.xxhash64("op_id")
    )


def checkpoint_rows(oplog: DataFrame, checkpoint: DataFrame) -> DataFrame:
    """Current rows at a completed checkpoint; the op id bound is applied while scanning."""
    visible = oplog.where(F.col("op_id") <= last_op(checkpoint))
    return with_payload(newest_put(live_puts(visible, checkpoint)), visible)


def partial_cuts(
    checkpoint: DataFrame, priority: int, published: DataFrame | None = None
) -> DataFrame:
    """``(bucket, last_op_id)`` visible after completion at a priority.

    Buckets with code <= ``priority`` move to the checkpoint; the others stay where
    ``published``, the state before, has them.
    """
    moved = checkpoint.where(F.col("priority") <= priority).select("bucket", "last_op_id")
    if published is None:
        return moved
    kept = published.select("bucket", "last_op_id").join(moved, "bucket", "left_anti")
    return moved.unionByName(kept)


def partial_checkpoint(
    oplog: DataFrame, checkpoint: DataFrame, priority: int, published: DataFrame | None = None
) -> DataFrame:
    """Current rows after a partial completion at ``priority``."""
    cuts = partial_cuts(checkpoint, priority, published)
    narrow = oplog.where(F.col("op_id") <= last_op(cuts)).select(*OP_KEY, "op", "op_id")
    visible = lookup_join(
        narrow, cuts, ["bucket"], "inner", spread=F.xxhash64("op_id"), key_sample=oplog
    ).where(F.col("op_id") <= F.col("last_op_id"))
    return with_payload(newest_put(live_puts(visible)), oplog)


def checkpoint_diff(
    checkpoint: DataFrame, updated: DataFrame, removed: DataFrame, last_op_id: int, write_checkpoint: int | None = None
) -> DataFrame:
    """The bucket list after a diff: old without removed, overridden by updated."""
    columns = ["bucket", "priority", "target_count", "checksum"]
    kept = anti_removed(checkpoint, removed).join(updated, "bucket", "left_anti")
    return (
        kept.select(*columns)
        .unionByName(updated.select(*columns))
        .withColumn("last_op_id", F.lit(last_op_id).cast("bigint"))
        .withColumn("write_checkpoint", F.lit(write_checkpoint).cast("bigint"))
    )


def anti_removed(state: DataFrame, removed: DataFrame) -> DataFrame:
    """Per-bucket state without the removed buckets."""
    return state.join(removed.select("bucket"), "bucket", "left_anti")


def op_sums(oplog: DataFrame) -> DataFrame:
    """``(bucket, actual, op_count)``: checksum and number of a bucket's ops."""
    return oplog.groupBy("bucket").agg(
        sum_modulo_32_bits(F.col("checksum")).alias("actual"), F.count(F.lit(1)).alias("op_count")
    )


def add_sums(sums: DataFrame, others: DataFrame, sign: int = 1) -> DataFrame:
    """Sums of two parts of a log together, or with ``sign`` -1 the sums of ``sums`` without ``others``."""
    both = sums.unionByName(others.select("bucket", (F.col("actual") * sign).alias("actual"), (F.col("op_count") * sign).alias("op_count")))
    total = F.pmod(F.sum("actual"), F.lit(4294967296)).alias("actual")
    return both.groupBy("bucket").agg(total, F.sum("op_count").alias("op_count"))


def bucket_checksums(oplog: DataFrame, checkpoint: DataFrame, dropped: DataFrame | None = None) -> DataFrame:
    """Per checkpoint bucket the checksum and count of its ops, and whether they match.

    For a compacted log ``dropped`` has the sums of what compaction dropped (``dropped_sums``).
    """
    sums = op_sums(oplog.where(F.col("op_id") <= last_op(checkpoint)))
    if dropped is not None:
        sums = add_sums(sums, dropped)
    zero = F.lit(0).cast("bigint")
    actual = F.coalesce("actual", zero)
    expected = F.pmod(F.col("checksum"), F.lit(4294967296))
    return checkpoint.join(sums, "bucket", "left").select(
        "bucket",
        expected.alias("expected"),
        actual.alias("actual"),
        F.coalesce("op_count", zero).alias("op_count"),
        (expected == actual).alias("valid"),
    )


def visible_ops(oplog: DataFrame) -> DataFrame:
    """PUT and REMOVE ops that no later CLEAR of their bucket hides."""
    return drop_cleared(oplog.where(F.col("op").isin("PUT", "REMOVE")), oplog, "op_id")


def compact_oplog(oplog: DataFrame) -> DataFrame:
    """A smaller log with the same fold: the newest op per key, and the newest CLEAR per bucket.

    The checksums of a bucket need what is dropped as well: keep ``dropped_sums`` with the log.
    """
    newest = drop_cleared(newest_per_key(oplog).select("bucket", F.col("newest").alias("op_id")), oplog, "op_id")
    keep = newest.select("op_id").unionByName(newest_clear(oplog).select(F.col("cleared").alias("op_id")))
    return oplog.join(keep, "op_id", "left_semi")


def dropped_sums(oplog: DataFrame, kept: DataFrame) -> DataFrame:
    """``(bucket, actual, op_count)`` of the ops of ``oplog`` that are not in ``kept``, a part of it."""
    return add_sums(op_sums(oplog), op_sums(kept), -1)


def gate_checkpoints(attempts: DataFrame) -> DataFrame:
    """Per attempt whether a complete checkpoint may be published over local writes.

    It may when the upload queue is empty and the checkpoint's write checkpoint has reached
    the local target.
    """
    ready = F.col("queue_empty") & (F.col("write_checkpoint") >= F.col("target_op"))
    return attempts.withColumn("publishable", ready)


def local_gate(rows: DataFrame, queue: DataFrame, write_checkpoint: int, target_op: int) -> DataFrame:
    """``rows`` when the checkpoint may be published, else no rows."""
    pending = queue.limit(1).agg(F.count(F.lit(1)).alias("_n")).scalar()
    return rows.where((pending == 0) & F.lit(write_checkpoint >= target_op))


def declared_rows(rows: DataFrame, schema: Schema) -> DataFrame:
    return rows.where(F.col("row_type").isin(schema.declared_names))


def untyped_rows(rows: DataFrame, schema: Schema) -> DataFrame:
    """Rows whose type no declared table has."""
    return rows.where(~F.col("row_type").isin(schema.declared_names))


def clear_state(
    state: Mapping[str, DataFrame], clear_local: bool = False, soft: bool = False
) -> dict[str, DataFrame]:
    """State tables after a disconnect-and-clear.

    ``rows`` and ``crud`` are emptied, ``local_rows`` only with ``clear_local``; a soft clear
    keeps ``oplog`` and ``buckets``.
    """
    emptied = {"rows", "crud"}
    if clear_local:
        emptied.add("local_rows")
    if not soft:
        emptied |= {"oplog", "buckets"}
    return {n: df.limit(0) if n in emptied else df for n, df in state.items()}
