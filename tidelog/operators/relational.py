"""Reads: parameterised SQL, getters, joins, counts, pages and set operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.operators.skew import lookup_join

# Fixed value: the message of a single-row read without a row.
NO_ROW = "get() called with query that returned no rows"


class NoRowError(LookupError):
    """A single-row read found no row."""


PARAMETER_TYPES = (bool, str, int, float, bytes, bytearray, type(None))


def get_all(spark: SparkSession, sql: str, parameters: Sequence = ()) -> DataFrame:
    """A read with positional ``?`` parameters."""
    for value in parameters:
        if not isinstance(value, PARAMETER_TYPES):
            raise TypeError(f"Unsupported parameter type {type(value).__name__}")
    return spark.sql(sql, args=list(parameters)) if parameters else spark.sql(sql)


def get_optional(rows: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """The first row in a total order, or no row."""
    return rows.orderBy(*order).limit(1)


def get_one(rows: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """The first row in a total order; the query fails when there is none."""
    first = get_optional(rows, order).withColumn("_one", F.lit(1))
    some = F.when(F.col("_n") == 0, F.raise_error(F.lit(NO_ROW)).cast("boolean")).otherwise(F.lit(True))
    # The check is a filter on the side that always has a row, so no plan can skip it.
    checked = first.agg(F.count(F.lit(1)).alias("_n")).where(some).select(F.lit(1).alias("_one"))
    return checked.join(first, "_one", "left").drop("_one")


def first_row(rows: DataFrame, order: Sequence[str | Column]):
    """The first row as a value of the caller."""
    row = get_optional(rows, order).first()
    if row is None:
        raise NoRowError(NO_ROW)
    return row


def unique_names(names: Sequence[str]) -> list[str]:
    """Result names made unique: a repeated ``name`` becomes ``name&JOIN1``, then ``name&JOIN2``."""
    taken: dict[str, int] = {}  # in order of appearance; the number of repeats seen so far
    for name in names:
        candidate, n = name, taken.get(name, 0)
        while candidate in taken:
            n += 1
            candidate = f"{name}&JOIN{n}"
        if candidate != name:
            taken[name] = n
        taken[candidate] = 0
    return list(taken)


def dedupe_join_columns(joined: DataFrame) -> DataFrame:
    return joined.toDF(*unique_names(joined.columns))


def required(rows: DataFrame, name: str, type_: str) -> Column:
    """A strict getter: a missing column is an error, and so is a NULL when the query runs."""
    if name not in rows.columns:
        raise KeyError(f"no column named {name}")
    value = _as_type(F.col(name), type_)
    missing = F.raise_error(F.lit(f"Null value for column {name}"))
    return F.when(F.col(name).isNull(), missing.cast(type_)).otherwise(value).alias(name)


def optional(rows: DataFrame, name: str, type_: str) -> Column:
    """A lenient getter: NULL for a NULL and for a missing column."""
    value = _as_type(F.col(name), type_) if name in rows.columns else F.lit(None).cast(type_)
    return value.alias(name)


def _as_type(value: Column, type_: str) -> Column:
    return (value.cast("bigint") != 0) if type_ == "boolean" else value.cast(type_)


def filter_param(rows: DataFrame, column: str, value: object) -> DataFrame:
    return rows.where(F.col(column) == F.lit(value)).orderBy("id")


def filter_not_null(rows: DataFrame, column: str) -> DataFrame:
    return rows.where(F.col(column).isNotNull()).select("id", column)


def left_join_group(lists: DataFrame, todos: DataFrame) -> DataFrame:
    """Every list once, with the number of its todos. The todos are counted before the join."""
    counts = todos.groupBy("list_id").agg(F.count(F.lit(1)).alias("_n"))
    return (
        lists.join(counts, lists["id"] == counts["list_id"], "left")
        .withColumn("n_todos", F.coalesce("_n", F.lit(0).cast("bigint")))
        .select(*lists.columns, "n_todos")
    )


def left_join_lookup(rows: DataFrame, lookup: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Rows with columns of the record their key refers to, where there is one."""
    side = lookup.select(F.col("id").alias(key), *columns)
    return lookup_join(rows, side, [key], "left", spread=F.xxhash64("id"))


def inner_join_scope(todos: DataFrame, lists: DataFrame, owner: str) -> DataFrame:
    """Todos of the lists one user owns."""
    own = lists.where(F.col("owner_id") == owner).select(F.col("id").alias("list_id"))
    return lookup_join(todos, own, ["list_id"], "inner", spread=F.xxhash64("id"))


def semi_in_list(rows: DataFrame, column: str, json_list: str, type_: str = "bigint") -> DataFrame:
    """Rows whose column is a member of a JSON array given as an argument."""
    members = rows.sparkSession.range(1).select(
        F.explode(F.from_json(F.lit(json_list), f"array<{type_}>")).alias(column)
    )
    return rows.join(F.broadcast(members), column, "left_semi")


def self_join_next(entries: DataFrame) -> DataFrame:
    """Each entry with the one whose id follows directly, in the same transaction."""
    following = entries.select((F.col("id") - 1).alias("id"), "tx_id", F.col("id").alias("next_id"))
    return entries.select("id", "tx_id").join(following, ["id", "tx_id"])


def count_rows(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("n"))


def min_after(entries: DataFrame, after: int) -> DataFrame:
    return entries.where(F.col("id") > after).agg(F.min("id").alias("next_id"))


def offset_page(rows: DataFrame, order: Sequence[Column], offset: int, limit: int) -> DataFrame:
    return rows.orderBy(*order).offset(offset).limit(limit)


def ordered_scan(rows: DataFrame, order: Sequence[str] = ("timestamp", "id")) -> DataFrame:
    return rows.where(F.col("id").isNotNull()).orderBy(*order)


def set_intersect(changes: DataFrame, watched: Sequence[str]) -> DataFrame:
    """Changes (array column ``tables``) that touch a watched table, with the tables they share."""
    shared = F.array_sort(F.array_intersect("tables", F.array(*[F.lit(t) for t in watched])))
    return changes.withColumn("tables", shared).where(F.size("tables") > 0)
