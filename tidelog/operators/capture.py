"""Change capture between snapshots, and applying change entries to a table.

An entry has ``op`` (PUT, PATCH, DELETE), ``type``, ``row_id``, ``data`` and optionally ``old``
and ``metadata``. A PUT carries the non-NULL columns, a PATCH the changed columns with
their NULLs, a DELETE nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions.json import json_columns, json_object, json_object_without_nulls
from tidelog.operators.skew import lookup_join
from tidelog.schema import Column, Options, RawTable


def capture_changes(
    before: DataFrame,
    after: DataFrame,
    table: str,
    columns: Sequence[str],
    options: Options | None = None,
    touched: str | None = None,
) -> DataFrame:
    """Entries that lead from snapshot ``before`` to snapshot ``after``.

    ``touched`` names a boolean column of ``after`` that marks rows written without a change;
    they give a PATCH with an empty object unless empty updates are ignored.
    """
    options = options or Options()
    metadata = "_metadata" if options.track_metadata else None
    old_side = before.select("id", F.lit(True).alias("_was"), *[F.col(c).alias(f"_b_{c}") for c in columns])
    extra = [c for c in (touched, metadata) if c]
    new_side = after.select(
        "id", F.lit(True).alias("_is"), *[F.col(c).alias(f"_a_{c}") for c in columns], *extra
    )
    pairs = old_side.join(new_side, "id", "full_outer")
    inserted, deleted = F.col("_was").isNull(), F.col("_is").isNull()
    changed = {c: ~F.col(f"_b_{c}").eqNullSafe(F.col(f"_a_{c}")) for c in columns}
    written = reduce(lambda a, b: a | b, changed.values())
    if touched and not options.ignore_empty_updates:
        written = written | F.coalesce(touched, F.lit(False))
    new_values = {c: F.col(f"_a_{c}") for c in columns}
    data = (
        F.when(inserted, json_object_without_nulls(new_values))
        .when(~deleted, json_object(new_values, keep=changed))
    )
    entries = pairs.where(inserted | deleted | written).select(
        F.when(inserted, "PUT").when(deleted, "DELETE").otherwise("PATCH").alias("op"),
        F.lit(table).alias("type"),
        F.col("id").alias("row_id"),
        data.alias("data"),
        *_old_values(columns, changed, inserted | deleted, options),
        *([F.col(metadata).alias("metadata")] if metadata else []),
    )
    return entries.where(F.col("op") == "PUT") if options.insert_only else entries


def _old_values(columns, changed, not_update, options: Options) -> list:
    tracked = options.previous_values
    if tracked is None:
        return []
    names = [c for c in columns if tracked.columns is None or c in tracked.columns]
    keep = {c: changed[c] for c in names} if tracked.only_when_changed else None
    old = json_object({c: F.col(f"_b_{c}") for c in names}, keep=keep)
    return [F.when(~not_update, old).alias("old")]


def capture_raw(before: DataFrame, after: DataFrame, table: RawTable) -> DataFrame:
    """Capture on a user-made table, limited to its synced columns."""
    synced = table.schema.synced_columns or tuple(c for c in after.columns if c != "id")
    return capture_changes(before, after, table.name, synced, table.schema.options)


def apply_crud(target: DataFrame, entries: DataFrame, columns: Sequence[Column]) -> DataFrame:
    """``target`` after the entries, which count in ``id`` order for each row.

    A PUT creates the row or sets the columns it names, a PATCH sets the columns it names
    if the row exists, a DELETE removes the row. ``entries`` has ``(id, op, row_id, data)``.

    What a row ends up as follows from its last DELETE, its first PUT after that, and for each
    column the last entry naming it, so the entries of a row are never brought together: all
    are plain aggregates that combine before the shuffle.
    """
    narrow = entries.select(F.col("id").alias("at"), "op", "row_id", "data")
    deletes = (
        narrow.where(F.col("op") == "DELETE").groupBy("row_id").agg(F.max("at").alias("deleted_at"))
    )
    tail = lookup_join(
        narrow, deletes, ["row_id"], "left", spread=F.xxhash64("at"), key_sample=entries
    ).where(F.col("deleted_at").isNull() | (F.col("at") >= F.col("deleted_at")))
    keys = F.json_object_keys("data")
    names = [c.name for c in columns]
    parsed = tail.select(
        "row_id",
        "at",
        "op",
        *[F.when(F.array_contains(keys, n), F.col("at")).alias(f"_at_{n}") for n in names],
        *[v.alias(f"_new_{n}") for n, v in zip(names, json_columns(F.col("data"), columns))],
    )
    folded = parsed.groupBy(F.col("row_id").alias("id")).agg(
        F.max(F.col("op") == "DELETE").alias("_deleted"),
        F.min(F.when(F.col("op") == "PUT", F.col("at"))).alias("_born"),
        *[F.max(f"_at_{n}").alias(f"_at_{n}") for n in names],
        *[F.max_by(f"_new_{n}", f"_at_{n}").alias(f"_new_{n}") for n in names],
    )
    base = target.select("id", F.lit(True).alias("_is"), *[F.col(n).alias(f"_b_{n}") for n in names])
    lives = F.col("_is").isNotNull() & ~F.coalesce("_deleted", F.lit(False))
    value = {
        n: F.when(
            F.col(f"_at_{n}").isNotNull() & (lives | (F.col(f"_at_{n}") >= F.col("_born"))),
            F.col(f"_new_{n}"),
        ).when(lives, F.col(f"_b_{n}"))
        for n in names
    }
    return (
        base.join(folded, "id", "full_outer")
        .where(lives | F.col("_born").isNotNull())
        .select("id", *[v.alias(n) for n, v in value.items()])
    )


def optimistic_view(published: DataFrame, queue: DataFrame, columns: Sequence[Column]) -> DataFrame:
    """What a reader sees while local changes wait: the published rows overlaid with them."""
    return apply_crud(published, queue, columns)
