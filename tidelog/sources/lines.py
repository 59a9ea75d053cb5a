"""The NDJSON feed: reading, classifying and unfolding its lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidelog.functions.scalars import DEFAULT_PRIORITY

# The line kinds and the members of each.
BUCKET_FIELDS = (
    "bucket STRING, priority INT, checksum BIGINT, count BIGINT, last_op_id STRING, "
    "subscriptions ARRAY<STRUCT<sub: INT>>"
)
LINE_SCHEMAS = {
    "checkpoint": (
        f"STRUCT<last_op_id: STRING, write_checkpoint: STRING, buckets: ARRAY<STRUCT<{BUCKET_FIELDS}>>, "
        "streams: ARRAY<STRUCT<name: STRING, is_default: BOOLEAN>>>"
    ),
    "checkpoint_diff": (
        "STRUCT<last_op_id: STRING, write_checkpoint: STRING, removed_buckets: ARRAY<STRING>, "
        f"updated_buckets: ARRAY<STRUCT<{BUCKET_FIELDS}>>>"
    ),
    "checkpoint_complete": "STRUCT<last_op_id: STRING>",
    "partial_checkpoint_complete": "STRUCT<last_op_id: STRING, priority: INT>",
    "data": (
        "STRUCT<bucket: STRING, has_more: BOOLEAN, after: STRING, next_after: STRING, "
        "data: ARRAY<STRUCT<checksum: BIGINT, op_id: STRING, object_id: STRING, object_type: STRING, "
        "op: STRING, subkey: STRING, data: STRING>>>"
    ),
    "token_expires_in": "INT",
}
KINDS = tuple(LINE_SCHEMAS)
LINE_SCHEMA = f"STRUCT<{', '.join(f'{kind}: {ddl}' for kind, ddl in LINE_SCHEMAS.items())}>"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(value, file, block, position)`` of every non-empty line below ``path``.

    File, block start and position in the block give the order of lines also when a large
    file is read in several splits.
    """
    return (
        spark.read.text(path)
        .select(
            "value",
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("position"),
        )
        .where(F.trim("value") != "")
    )


def number_lines(lines: DataFrame) -> DataFrame:
    """Adds ``seq``, a unique bigint in file, block and line order.

    Only the list of blocks is ranked in one task: one row per split, not per line.
    """
    blocks = lines.groupBy("file", "block").agg(F.min("position").alias("_first"))
    ranked = blocks.withColumn("_rank", F.row_number().over(Window.orderBy("file", "block")) - 1)
    return (
        lines.join(ranked, ["file", "block"])
        .withColumn("seq", F.shiftleft(F.col("_rank").cast("bigint"), 33) + F.col("position") - F.col("_first"))
        .drop("_first", "_rank")
    )


def classify_lines(lines: DataFrame) -> DataFrame:
    """Adds ``kind`` and the parsed ``content`` of each line.

    A line is an object with exactly one known key. Anything that is not an object, such as
    a truncated last line, is ``malformed``; several keys or an unknown key make it ``unknown``.
    """
    keys = F.json_object_keys("value")
    kind = (
        F.when(keys.isNull(), F.lit("malformed"))
        .when((F.size(keys) == 1) & keys[0].isin(*KINDS), keys[0])
        .otherwise(F.lit("unknown"))
    )
    # Read through its kind: a bare from_json is pruned to the members a query uses.
    return lines.withColumn("kind", kind).withColumn("content", F.from_json("value", LINE_SCHEMA))


def explode_ops(classified: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per op of the ``data`` lines; ``keep`` names line columns to carry along."""
    data = F.col("content.data")
    return (
        classified.where(F.col("kind") == "data")
        .select(*keep, data.getField("bucket").alias("bucket"), F.explode(data.getField("data")).alias("o"))
        .select(
            *keep,
            "bucket",
            F.col("o.op_id").cast("bigint").alias("op_id"),
            F.col("o.op").alias("op"),
            F.col("o.object_type").alias("row_type"),
            F.col("o.object_id").alias("row_id"),
            F.col("o.subkey").alias("subkey"),
            F.col("o.data").alias("data"),
            F.col("o.checksum").alias("checksum"),
        )
    )


def _targets(buckets: str) -> list:
    return [
        F.col(f"{buckets}.bucket").alias("bucket"),
        F.coalesce(f"{buckets}.priority", F.lit(DEFAULT_PRIORITY)).alias("priority"),
        F.col(f"{buckets}.checksum").alias("checksum"),
        F.col(f"{buckets}.count").alias("target_count"),
        F.col(f"{buckets}.subscriptions").alias("subscriptions"),
    ]


def explode_checkpoints(classified: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per bucket target of the ``checkpoint`` lines."""
    c = F.col("content.checkpoint")
    return (
        classified.where(F.col("kind") == "checkpoint")
        .select(
            *keep,
            c.getField("last_op_id").cast("bigint").alias("last_op_id"),
            c.getField("write_checkpoint").cast("bigint").alias("write_checkpoint"),
            F.explode(c.getField("buckets")).alias("b"),
        )
        .select(*keep, "last_op_id", "write_checkpoint", *_targets("b"))
    )


def explode_diffs(classified: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per bucket that a ``checkpoint_diff`` line updates or removes."""
    c = F.col("content.checkpoint_diff")
    head = [
        *keep,
        c.getField("last_op_id").cast("bigint").alias("last_op_id"),
        c.getField("write_checkpoint").cast("bigint").alias("write_checkpoint"),
    ]
    diffs = classified.where(F.col("kind") == "checkpoint_diff")
    updated = diffs.select(*head, F.explode(c.getField("updated_buckets")).alias("b")).select(
        *keep, "last_op_id", "write_checkpoint", F.lit(False).alias("removed"), *_targets("b")
    )
    removed = diffs.select(
        *head, F.lit(True).alias("removed"), F.explode(c.getField("removed_buckets")).alias("bucket")
    )
    return updated.unionByName(removed, allowMissingColumns=True)


def lines_of_ops(oplog: DataFrame, ops_per_line: int = 100) -> DataFrame:
    """The inverse of ``explode_ops``: ``data`` lines of neighbouring ops of a bucket.

    A line covers a fixed range of op ids, so it holds at most ``ops_per_line`` ops.
    """
    op = F.struct(
        F.col("checksum"),
        F.col("op_id").cast("string").alias("op_id"),
        F.col("row_id").alias("object_id"),
        F.col("row_type").alias("object_type"),
        "op",
        "subkey",
        "data",
    )
    grouped = (
        oplog.withColumn("_line", F.floor(F.col("op_id") / ops_per_line))
        .groupBy("bucket", "_line")
        .agg(
            F.min("op_id").alias("seq"),
            F.sort_array(F.collect_list(F.struct(F.col("op_id").alias("at"), op.alias("op")))).alias("ops"),
        )
    )
    content = F.struct(
        F.col("bucket"),
        F.lit(False).alias("has_more"),
        F.col("seq").cast("string").alias("after"),
        F.element_at("ops", -1).getField("at").cast("string").alias("next_after"),
        F.col("ops.op").alias("data"),
    )
    return grouped.select("seq", F.to_json(F.struct(content.alias("data"))).alias("value"))
