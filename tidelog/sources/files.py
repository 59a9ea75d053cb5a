"""Files of attachments: listing a folder and running queued copies as a Spark job."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.operators.attachments import QUEUED_DELETE, QUEUED_DOWNLOAD, QUEUED_UPLOAD
from tidelog.session import shared_dir
from tidelog.sources.state import child_names

COPY_CHUNK = 8 * 1024 * 1024
OUTCOME_SCHEMA = "id STRING, ok BOOLEAN, size BIGINT, error STRING"
LOG_SCHEMA = f"{OUTCOME_SCHEMA}, attempt INT"


def list_files(spark: SparkSession, directory: str) -> DataFrame:
    """``(path, length)`` of the files below a folder; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(directory)
        .select("path", "length")
    )


def local_files(spark: SparkSession, directory: str, prefix: str = "attachments") -> DataFrame:
    """The files of a folder by the local uri that queue rows use."""
    name = F.element_at(F.split("path", "/"), -1)
    return list_files(spark, directory).select(F.concat(F.lit(f"{prefix}/"), name).alias("local_uri"))


def transfer_plan(queue: DataFrame, local_dir: str, remote_dir: str) -> DataFrame:
    """``(id, action, source, target)`` of the queued rows."""
    local = F.concat(F.lit(f"{local_dir.rstrip('/')}/"), "filename")
    remote = F.concat(F.lit(f"{remote_dir.rstrip('/')}/"), "filename")
    state = F.col("state")
    return queue.where(state.isin(QUEUED_DOWNLOAD, QUEUED_UPLOAD, QUEUED_DELETE)).select(
        "id",
        F.when(state == QUEUED_DELETE, "delete").otherwise("copy").alias("action"),
        F.when(state == QUEUED_DOWNLOAD, remote).otherwise(local).alias("source"),
        F.when(state == QUEUED_DOWNLOAD, local).otherwise(remote).alias("target"),
    )


def _open(uri: str):
    """The file system of a path and the path in it; a plain path is local."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def _replace(filesystem, path: str, chunks: Iterator[bytes]) -> int:
    """Writes a file under a name of its own first: a lost task leaves no half-written target."""
    filesystem.create_dir(path.rsplit("/", 1)[0], recursive=True)
    partial, size = f"{path}.{uuid.uuid4().hex}.partial", 0
    with filesystem.open_output_stream(partial) as writer:
        for chunk in chunks:
            writer.write(chunk)
            size += len(chunk)
    filesystem.move(partial, path)
    return size


def _transfer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from pyarrow import fs

    def run(action: str, source: str, target: str) -> int:
        target_fs, target_path = _open(target)
        source_fs, source_path = _open(source)
        if action == "delete":
            for filesystem, path in ((target_fs, target_path), (source_fs, source_path)):
                if filesystem.get_file_info(path).type != fs.FileType.NotFound:
                    filesystem.delete_file(path)
            return 0
        with source_fs.open_input_stream(source_path) as reader:
            return _replace(target_fs, target_path, iter(lambda: reader.read(COPY_CHUNK), b""))

    for batch in batches:
        results = []
        for row in batch.itertuples(index=False):
            try:
                results.append((row.id, True, run(row.action, row.source, row.target), None))
            except Exception as error:  # noqa: BLE001 - the outcome of the attempt
                results.append((row.id, False, None, f"{type(error).__name__}: {error}"))
        yield pd.DataFrame(results, columns=["id", "ok", "size", "error"]).astype({"size": "Int64"})


def transfer_files(plan: DataFrame, log: str | None = None, tasks: int | None = None) -> DataFrame:
    """Runs a transfer plan once and returns ``(id, ok, size, error)`` per row, read from the outcome log.

    Rows are dealt out evenly over tasks and each file is streamed in chunks, so neither
    many files nor a large one gathers in memory. The files are moved when this is called: a task's outcomes are
    committed with the task, so a lost task is repeated alone (it writes the same files), and reading the result
    again moves nothing. With ``log``, a folder of one round of the queue, a call after a lost driver leaves out
    what the log holds as done; a failed row is tried again, and its newest outcome counts.
    """
    spark = plan.sparkSession
    width = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = log or shared_dir(spark, "transfers")
    attempts = [int(name.split("=")[1]) for name in child_names(spark, path) if name.startswith("attempt=")]
    rest = plan
    if attempts:
        rest = plan.join(spark.read.schema(LOG_SCHEMA).parquet(path).where("ok").select("id"), "id", "left_anti").select(*plan.columns)
    attempt = max(attempts, default=-1) + 1
    rest.repartition(width, "id").mapInPandas(_transfer, OUTCOME_SCHEMA).write.parquet(f"{path}/attempt={attempt}")
    outcomes = spark.read.schema(LOG_SCHEMA).parquet(path)
    newest = F.max_by(F.struct("ok", "size", "error"), "attempt").alias("last")
    return outcomes.groupBy("id").agg(newest).select("id", "last.*")


def save_files(rows: DataFrame, content: str, directory: str, suffix: str = "") -> DataFrame:
    """Writes one file ``<id><suffix>`` per row; returns ``(id, ok, size, error)``."""
    root = directory.rstrip("/")

    def save(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            results = []
            for id_, value in zip(batch["id"], batch[content]):
                try:
                    data = value.encode() if isinstance(value, str) else bytes(value)
                    filesystem, path = _open(f"{root}/{id_}{suffix}")
                    results.append((id_, True, _replace(filesystem, path, iter([data])), None))
                except Exception as error:  # noqa: BLE001 - the outcome of the attempt
                    results.append((id_, False, None, f"{type(error).__name__}: {error}"))
            yield pd.DataFrame(results, columns=["id", "ok", "size", "error"]).astype({"size": "Int64"})

    return rows.select("id", content).mapInPandas(save, OUTCOME_SCHEMA)
