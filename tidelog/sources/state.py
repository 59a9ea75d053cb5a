"""State tables as versioned parquet folders, published all at once.

A version is a set of tables. Each table is written to a folder of its own; then one small
commit file naming the folders makes the version visible. A reader looks the newest commit
up once and keeps reading its folders, whatever is published meanwhile. A write that fails
before its commit leaves nothing that anyone reads.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.operators.feed import declared_rows, untyped_rows
from tidelog.schema import Schema

COMMIT_SCHEMA = "version BIGINT, table_name STRING, path STRING"


def child_names(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder, on whatever file system it lies; none when there is no such folder."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []


def delete_paths(spark: SparkSession, paths: Iterable[str]) -> None:
    """Removes files and folders; what is gone already is left out."""
    for path in paths:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


class StateStore:
    """Published versions below one folder that all executors can reach.

    Besides whole tables a version may have sliced ones, of which only the slices that change are written, and
    values: names that begin with ``@``, with a text in place of a folder.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    @property
    def _commits(self) -> str:
        return f"{self.root}/commits"

    def current(self) -> tuple[int, dict[str, str]]:
        """The newest version and the folder of each of its tables; version -1 when there is none."""
        if not child_names(self.spark, self._commits):
            return -1, {}
        commits = self.spark.read.schema(COMMIT_SCHEMA).parquet(self._commits)
        newest = commits.agg(F.max("version").alias("v")).scalar()
        rows = commits.where(F.col("version") == newest).distinct().collect()
        if not rows:
            return -1, {}
        return rows[0]["version"], {r["table_name"]: r["path"] for r in rows}

    def read(self, name: str, paths: Mapping[str, str] | None = None) -> DataFrame:
        """A table of the newest version, or of the version whose ``paths`` are given."""
        return self.spark.read.parquet((paths if paths is not None else self.current()[1])[name])

    def slice_paths(self, name: str, paths: Mapping[str, str], slices: Iterable[int] | None = None) -> list[str]:
        """The folders of a sliced table, of all or of the given slices."""
        if slices is not None:
            return [paths[key] for key in (f"{name}/{s}" for s in slices) if key in paths]
        return [path for key, path in paths.items() if key.startswith(f"{name}/")]

    def read_slices(self, name: str, schema: str, paths: Mapping[str, str], slices: Iterable[int] | None = None) -> DataFrame:
        """Rows of a sliced table; only the folders of the given slices are opened."""
        folders = self.slice_paths(name, paths, slices)
        if not folders:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).option("basePath", f"{self.root}/tables/{name}").parquet(*folders)
        return rows.drop("v", "slice")

    def stage_slices(self, version: int, name: str, rows: DataFrame, slices: Iterable[int], partition_by: Sequence[str] = ()) -> dict[str, str | None]:
        """Writes ``slices`` of a table anew from ``rows``, which have a column ``slice``; a commit makes them visible.

        Returns the entries for ``commit``: a folder for each slice, None for one that has no rows any more.
        """
        base = f"{self.root}/tables/{name}/v={version}"
        rows.hint("rebalance", "slice").write.mode("overwrite").partitionBy("slice", *partition_by).parquet(base)
        there = set(child_names(self.spark, base))
        return {f"{name}/{s}": f"{base}/slice={s}" if f"slice={s}" in there else None for s in slices}

    def publish(
        self,
        version: int,
        tables: Mapping[str, DataFrame],
        partition_by: Mapping[str, str] | None = None,
        entries: Mapping[str, str | None] | None = None,
    ) -> None:
        """Makes ``version`` current: the given tables and entries, and the others as they were.

        A table that is already published in this version is not written again, so a restarted
        micro-batch changes nothing under its readers; an older version is ignored. ``entries`` has staged
        slices and values; None takes one out.
        """
        newest, paths = self.current()
        if version < newest:
            return
        folder = {name: f"{self.root}/tables/{name}/v={version}" for name in tables}
        missing = [name for name in tables if paths.get(name) != folder[name]]
        for name in missing:
            df, key = tables[name], (partition_by or {}).get(name)
            if key:
                # Rebalancing splits a partition value that holds much of the data over files.
                df.hint("rebalance", key).write.mode("overwrite").partitionBy(key).parquet(folder[name])
            else:
                df.write.mode("overwrite").parquet(folder[name])
        after = {name: path for name, path in {**paths, **folder, **(entries or {})}.items() if path is not None}
        if missing or after != paths:
            rows = [(version, name, path) for name, path in sorted(after.items())]
            commit = self.spark.createDataFrame(rows, COMMIT_SCHEMA).coalesce(1)
            commit.write.mode("append").parquet(self._commits)

    def retain(self, versions: int = 2) -> None:
        """Removes all but the newest ``versions``: their commits, and the folders that no other version has.

        A reader that still reads an older version fails, so keep as many as readers may lag behind.
        """
        if not child_names(self.spark, self._commits):
            return
        commits = self.spark.read.schema(COMMIT_SCHEMA).parquet(self._commits)
        known = sorted(r["version"] for r in commits.select("version").distinct().collect())
        if len(known) <= versions:
            return
        oldest = known[-versions]
        named = commits.where(~F.col("table_name").startswith("@")).groupBy("path").agg(F.max("version").alias("last"))
        gone = [r["path"] for r in named.where(F.col("last") < oldest).collect()]
        old = commits.select("version", F.col("_metadata.file_path").alias("file")).where(F.col("version") < oldest)
        # Commits go first: a folder without a commit is read by nobody.
        delete_paths(self.spark, [r["file"] for r in old.select("file").distinct().collect()])
        delete_paths(self.spark, gone)


def publish_rows(store: StateStore, version: int, rows: DataFrame, **others: DataFrame) -> None:
    """Publishes folded rows in one folder per row type, declared or not."""
    store.publish(version, {"rows": rows, **others}, partition_by={"rows": "row_type"})


def declared_table_rows(store: StateStore, schema: Schema) -> DataFrame:
    """Published rows of declared types: only their folders are read."""
    return declared_rows(store.read("rows"), schema)


def undeclared_table_rows(store: StateStore, schema: Schema) -> DataFrame:
    """Published rows kept apart until the schema has their type."""
    return untyped_rows(store.read("rows"), schema)
