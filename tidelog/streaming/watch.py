"""Watched queries: run again when one of their source tables changes."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidelog.functions.scalars import friendly_table_name

CHANGE_SCHEMA = "tx_id BIGINT, table_name STRING, committed BOOLEAN"


def source_tables(rows: DataFrame) -> set[str]:
    """Names of the tables a query reads: the last part of each scanned folder or file name.

    Version folders (``v=3``) are skipped, so a table keeps its name over its versions.
    """
    names = set()
    leaves = rows._jdf.queryExecution().analyzed().collectLeaves()
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() != "LogicalRelation":
            continue
        for path in leaf.relation().location().rootPaths().mkString("\n").split("\n"):
            parts = [p for p in path.split("/") if p and "=" not in p]
            names.add(parts[-1].removesuffix(".parquet"))
    return names


def watch(
    spark: SparkSession,
    change_log: str,
    query: Callable[[], DataFrame],
    emit: Callable[[DataFrame, int], None],
    checkpoint: str,
    tables: Sequence[str] | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Emits the query's result at once, and again after commits that touch its tables.

    The change log is a folder of parquet rows ``(tx_id, table_name, committed)``. Rolled-back
    writes emit nothing. A micro-batch emits at most once, so the trigger is the throttle.
    ``emit`` gets the result and the number of the micro-batch, 0 for the first result; a
    restarted batch emits its number again.
    """
    sources = set(tables) if tables is not None else source_tables(query())
    emit(query(), 0)

    def on_batch(changes: DataFrame, batch_id: int) -> None:
        touched = changes.where(
            F.col("committed") & friendly_table_name(F.col("table_name")).isin(sorted(sources))
        )
        if not touched.isEmpty():
            emit(query(), batch_id + 1)

    return (
        spark.readStream.schema(CHANGE_SCHEMA)
        .parquet(change_log)
        .writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def on_change_stream(
    spark: SparkSession,
    change_log: str,
    tables: Sequence[str],
    emit: Callable[[list[str], int], None],
    checkpoint: str,
    trigger_immediately: bool = True,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Emits the set of changed tables per micro-batch, and first the empty set.

    The set is collected: it holds names of watched tables only.
    """
    if trigger_immediately:
        emit([], 0)

    def on_batch(changes: DataFrame, batch_id: int) -> None:
        name = friendly_table_name(F.col("table_name"))
        changed = changes.where(F.col("committed") & name.isin(list(tables))).select(name.alias("t")).distinct()
        names = sorted(r["t"] for r in changed.collect())
        if names:
            emit(names, batch_id + 1)

    return (
        spark.readStream.schema(CHANGE_SCHEMA)
        .parquet(change_log)
        .writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
