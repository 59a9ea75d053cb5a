"""Typed tables over JSON rows: views, modes and raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions.json import json_columns, json_rest
from tidelog.functions.scalars import internal_table_name
from tidelog.operators.writes import delete_where
from tidelog.schema import ID, RawTable, Schema, Table


def json_table_view(rows: DataFrame, table: Table) -> DataFrame:
    """``(id, data)`` rows as the declared, typed columns; a missing key reads as NULL."""
    return rows.select(F.col("id"), *json_columns(F.col("data"), list(table.columns)))


def table_view(rows: DataFrame, table: Table) -> DataFrame:
    """One declared table of the folded rows ``(row_type, row_id, data)``."""
    own = rows.where(F.col("row_type") == table.name)
    return json_table_view(own.select(F.col("row_id").alias("id"), "data"), table)


def register_views(rows: DataFrame, schema: Schema) -> None:
    """A temporary view per declared table, under its view name."""
    for table in schema.tables:
        view = table_view(rows, table)
        (view.limit(0) if table.options.insert_only else view).createOrReplaceTempView(table.view_name)


def table_modes(rows: DataFrame) -> DataFrame:
    """Per row whether a read returns it, whether a change of it is queued, and where it is stored."""
    return rows.withColumns(
        {
            "readable": F.col("mode") != "insert",
            "queued": F.col("mode") != "local",
            "storage": internal_table_name(F.col("row_type"), F.col("mode") == "local"),
        }
    )


def raw_table_put(rows: DataFrame, table: RawTable) -> DataFrame:
    """``(id, data)`` rows as the columns of a raw table's put mapping.

    The rest parameter takes the JSON members that no column parameter names.
    """
    named = [p.column for p in table.put.values() if p.kind == "column"]

    def fill(parameter):
        if parameter.kind == "id":
            return F.col("id")
        if parameter.kind == "rest":
            return json_rest(F.col("data"), named)
        return F.get_json_object("data", f"$['{parameter.column}']")

    return rows.select(*[fill(p).alias(name) for name, p in table.put.items()])


def raw_table_delete(existing: DataFrame, removed: DataFrame, table: RawTable) -> DataFrame:
    """The rows of a raw table that stay when the ``(id, data)`` rows of ``removed`` are deleted.

    Columns of the delete mapping are compared as the table's types, NULL matching nothing. ``removed``
    needs ``data``, the last payload, only where the mapping names a column.
    """
    types = {f.name: f.dataType for f in existing.schema.fields}
    keys = {name: F.col("id") if p.kind == "id" else F.get_json_object("data", f"$['{p.column}']") for name, p in (table.delete or {"id": ID}).items()}
    gone = removed.select(*[value.try_cast(types[name]).alias(name) for name, value in keys.items()])
    return existing.join(gone, list(keys), "left_anti")


def raw_table_clear(existing: DataFrame, table: RawTable) -> DataFrame:
    """The rows of a raw table that stay after a disconnect-and-clear."""
    return existing if table.clear is None else delete_where(existing, F.expr(table.clear))


def raw_table_infer(existing: DataFrame, rows: DataFrame, table: RawTable) -> DataFrame:
    """A raw table after a sync whose mapping is inferred from the synced columns.

    Rows missing from ``rows`` are deleted; columns that are not synced keep their values. With a put
    mapping, which must fill ``id``, its columns are the synced ones and it says what they get.
    """
    types = {f.name: f.dataType for f in existing.schema.fields}
    if table.put is not None:
        synced = [c for c in table.put if c != "id"]
        incoming = raw_table_put(rows, table).select("id", *[F.col(c).try_cast(types[c]).alias(c) for c in synced])
    else:
        synced = table.schema.synced_columns or tuple(c for c in existing.columns if c != "id")
        incoming = rows.select("id", *[F.get_json_object("data", f"$['{c}']").try_cast(types[c]).alias(c) for c in synced])
    local = [c for c in existing.columns if c != "id" and c not in synced]
    return incoming.join(existing.select("id", *local), "id", "left").select(*existing.columns)
