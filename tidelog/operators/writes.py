"""Writes as frames: the table after the write, or the rows it changed."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.operators.skew import lookup_join


def insert_rows(table: DataFrame, rows: DataFrame, id_: Column | None = None) -> DataFrame:
    """``table`` with new rows, whose ids are generated unless an expression is given."""
    return table.unionByName(rows.withColumn("id", id_ if id_ is not None else F.uuid()))


def update_where(table: DataFrame, condition: Column, changes: Mapping[str, Column]) -> DataFrame:
    hit = F.coalesce(condition, F.lit(False))
    return table.withColumns({c: F.when(hit, v).otherwise(F.col(c)) for c, v in changes.items()})


def affected_rows(table: DataFrame, condition: Column) -> DataFrame:
    return table.where(condition).agg(F.count(F.lit(1)).alias("changes"))


def update_returning(table: DataFrame, condition: Column, changes: Mapping[str, Column]) -> DataFrame:
    """Only the changed rows, after the change."""
    return table.where(condition).withColumns(dict(changes))


def delete_where(table: DataFrame, condition: Column) -> DataFrame:
    return table.where(~F.coalesce(condition, F.lit(False)))


def delete_children(children: DataFrame, parents: DataFrame, condition: Column, foreign_key: str) -> DataFrame:
    """Child rows that stay when the parents matching ``condition`` are deleted."""
    gone = parents.where(condition).select(F.col("id").alias(foreign_key))
    return lookup_join(children, gone, [foreign_key], "left_anti", spread=F.xxhash64("id"))


def insert_or_replace(table: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows replace those with the same id; both sides have unique ids."""
    return table.join(rows.select("id"), "id", "left_anti").unionByName(rows, allowMissingColumns=True)


def atomic_batch(changes: DataFrame, failed: Column) -> DataFrame:
    """The changes of transactions without a failed change: all of a transaction or nothing."""
    broken = changes.where(failed).select("tx_id").distinct()
    return lookup_join(changes, broken, ["tx_id"], "left_anti", spread=F.xxhash64("id"))
