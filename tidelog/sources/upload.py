"""The durable upload queue: captured changes become entries, entries are uploaded and acknowledged.

The queue is a version store: each batch of entries is a table of its own, and the newest id, the newest transaction,
the id up to which entries are acknowledged and the local target are values of the commit. Whatever is not in the
newest commit has not happened: an append that dies leaves no ids behind, an upload that dies is acknowledged
by nobody.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator
from itertools import chain, groupby
from operator import itemgetter
from threading import Lock
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.window import Window

from tidelog.functions.scalars import MAX_OP_ID, is_fatal_error
from tidelog.operators.ordered import scan_before
from tidelog.operators.queue import with_runs
from tidelog.operators.skew import lookup_join
from tidelog.session import shared_dir, written
from tidelog.sources.state import COMMIT_SCHEMA, StateStore, child_names, delete_paths

ENTRIES = "id BIGINT, tx_id BIGINT, data STRING"
PLANNED = "first_id BIGINT, taken_before BIGINT, id BIGINT, tx_id BIGINT, data STRING"
UPLOADED = "first_id BIGINT, last_id BIGINT, tx_id BIGINT, n_entries BIGINT, error_code STRING"


class Transaction(NamedTuple):
    """What an upload function gets: entries are ``(id, data)`` in order, read while they are iterated."""

    tx_id: int | None
    first_id: int
    entries: Iterator[tuple[int, str]]


#: Called once per partition, in a task: yields the error code of each transaction in turn, None for success.
Upload = Callable[[Iterator[Transaction]], Iterator[str | None]]


def entry_text(changes: DataFrame) -> Column:
    """The queue's JSON text of changes as ``capture_changes`` returns them; absent members are left out."""
    plain = {"op": "op", "type": "type", "id": "row_id"} | ({"metadata": "metadata"} if "metadata" in changes.columns else {})
    head = F.to_json(F.struct(*[F.col(column).cast("string").alias(name) for name, column in plain.items()]))
    parts = [F.substring(head, F.lit(1), F.length(head) - 1)]
    for member in ("data", "old"):
        if member in changes.columns:
            parts.append(F.coalesce(F.concat(F.lit(f',"{member}":'), F.col(member)), F.lit("")))
    return F.concat(*parts, F.lit("}"))


def dense_ids(rows: DataFrame, after: int) -> DataFrame:
    """Rows of a written table with ``id`` from ``after`` + 1 without gaps, in any order.

    A row's id is its place in its file plus the rows of the files before: one count per file, and no shuffle of the rows.
    """
    placed = rows.withColumns({"_file": F.col("_metadata.file_path"), "_at": F.col("_metadata.row_index")})
    counts = placed.groupBy("_file").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_file", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    numbered = lookup_join(placed, offsets, ["_file"], "inner", spread=F.col("_at"))
    return numbered.withColumn("id", F.lit(after).cast("bigint") + F.col("_before") + F.col("_at") + 1).drop("_file", "_at", "_before")


class UploadQueue:
    """Entries that wait for their upload, below one folder that all executors can reach."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.store = StateStore(spark, f"{self.root}/queue")
        self._one_at_a_time = Lock()

    @staticmethod
    def _value(paths: dict[str, str], name: str, default: int = -1) -> int:
        """A value of the commit; ids are never negative, so -1 is before all of them."""
        return int(paths.get(f"@{name}", default))

    def append(self, changes: DataFrame) -> int | None:
        """Queues changes (``op``, ``type``, ``row_id``, ``data``, maybe ``old`` and ``metadata``) as one transaction.

        Returns its ``tx_id``, or None without any change. The local target becomes the maximum: what the feed has
        so far does not cover these writes.
        """
        with self._one_at_a_time:
            version, paths = self.store.current()
            tx_id = self._value(paths, "tx", 0) + 1
            staged = f"{self.root}/staged/v={version + 1}"
            changes.select(entry_text(changes).alias("data")).write.mode("overwrite").parquet(staged)
            rows = self.spark.read.schema("data STRING").parquet(staged)
            high = self._value(paths, "high", 0)
            numbered = dense_ids(rows, high).select("id", F.lit(tx_id).cast("bigint").alias("tx_id"), "data")
            done = self._add(version + 1, tx_id, numbered, rows.count(), high, tx_id)
            delete_paths(self.spark, [staged])
            return tx_id if done else None

    def load(self, entries: DataFrame) -> None:
        """Takes over queue rows ``(id, tx_id, data)`` whose ids are beyond all of this queue."""
        with self._one_at_a_time:
            version, paths = self.store.current()
            n, low, high, tx = entries.agg(F.count(F.lit(1)), F.min("id"), F.max("id"), F.max("tx_id")).first()
            before = self._value(paths, "high")
            if n and low <= before:
                raise ValueError(f"entry {low} is not beyond the newest entry {before}")
            columns = [F.col(c).cast("bigint").alias(c) for c in ("id", "tx_id")]
            self._add(version + 1, f"v{version + 1}", entries.select(*columns, "data"), n, (high or 0) - n, max(tx or 0, self._value(paths, "tx", 0)))

    def _add(self, version: int, name: object, entries: DataFrame, n: int, high: int, tx: int) -> bool:
        if n:
            values = {"@high": str(high + n), f"@last/{name}": str(high + n), "@tx": str(tx), "@target": str(MAX_OP_ID)}
            self.store.publish(version, {f"entries/{name}": entries}, entries=values)
        return n > 0

    def entries(self) -> DataFrame:
        """``(id, tx_id, data)`` of all entries that are not acknowledged."""
        return self._entries(self.store.current()[1])

    def _entries(self, paths: dict[str, str]) -> DataFrame:
        folders = self.store.slice_paths("entries", paths)
        if not folders:
            return self.spark.createDataFrame([], ENTRIES)
        return self.spark.read.schema(ENTRIES).parquet(*folders).where(F.col("id") > self._value(paths, "acked"))

    def local_state(self) -> tuple[bool, int | None]:
        """Whether all entries are acknowledged, and the local target; None before the first write."""
        _, paths = self.store.current()
        target = paths.get("@target")
        return self._value(paths, "acked") >= self._value(paths, "high"), None if target is None else int(target)

    def outcomes(self) -> DataFrame:
        """``(first_id, last_id, tx_id, n_entries, error_code, outcome, attempt)`` of every transaction that is acknowledged."""
        _, paths = self.store.current()
        folders = self.store.slice_paths("uploads", paths)
        schema = f"{UPLOADED}, outcome STRING, attempt INT"
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def drain(
        self,
        upload: Upload,
        batch_entries: int = 100_000,
        write_checkpoint: Callable[[], int] | None = None,
        on_empty: Callable[[], object] | None = None,
        fatal: Column | None = None,
    ) -> bool:
        """Uploads the queue in batches of whole transactions; True when it is empty.

        ``upload`` is called once per partition of a batch. Its results are written, then the longest run of transactions
        from the head without a retry is acknowledged in one commit; a fatal error code discards its transaction. At
        a retry the drain ends, and the next call goes on from there. When it dies after the results are written, they are
        acknowledged by the next call without another upload; when it dies before, the batch is uploaded again, so an upload
        should know its transactions by ``first_id``.

        When the queue is empty, ``write_checkpoint`` gives the target that the feed must reach, unless entries
        arrived meanwhile, and ``on_empty`` (such as ``FeedApplier.retry``) is called.
        """
        planned, plan = None, ""
        try:
            while True:
                with self._one_at_a_time:
                    version, paths = self.store.current()
                    if self._value(paths, "acked") >= self._value(paths, "high"):
                        break
                    if planned != (high := self._value(paths, "high")) and not self._has_results(paths):
                        planned, plan = high, self._planned(paths, plan)
                    if not self._upload_batch(version, paths, upload, batch_entries, fatal, plan):
                        return False
        finally:
            delete_paths(self.spark, [plan] if plan else [])
        if write_checkpoint and self._value(paths, "target") == MAX_OP_ID:
            point = write_checkpoint()
            with self._one_at_a_time:
                version, after = self.store.current()
                if self._value(after, "high") != self._value(paths, "high"):
                    return False
                self.store.publish(version + 1, {}, entries={"@target": str(point)})
        if on_empty:
            on_empty()
        return True

    def _results(self, paths: dict[str, str]) -> str:
        return f"{self.root}/results/acked={self._value(paths, 'acked')}-attempt={self._value(paths, 'attempt', 1)}"

    def _has_results(self, paths: dict[str, str]) -> bool:
        return "_SUCCESS" in child_names(self.spark, self._results(paths))

    def _planned(self, paths: dict[str, str], old: str) -> str:
        """Writes the waiting entries with their transactions, in order, and returns their folder.

        ``taken_before`` has the entries before the transaction. The files are cut by id, so a batch reads those that hold it:
        transactions are looked for once for all batches, not in the whole rest of the queue for each.
        """
        delete_paths(self.spark, [old] if old else [])
        entries = self._entries(paths)
        runs = written(with_runs(entries.select("id", "tx_id")), "upload-runs")
        per_tx = runs.groupBy("tx_id", "run").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("n_entries"))
        taken = scan_before(per_tx, "first_id", sums={"taken_before": F.col("n_entries")})
        taken = taken.select("first_id", "taken_before", "run", F.col("tx_id").alias("_tx"))
        placed = lookup_join(runs, taken, ["run"], "inner", spread=F.xxhash64("id")).where(F.col("tx_id").eqNullSafe(F.col("_tx")))
        placed = placed.select("id", "first_id", "taken_before")
        rows = entries.join(placed, "id").select("first_id", "taken_before", "id", "tx_id", "data")
        width = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        plan = shared_dir(self.spark, "upload-plan")
        rows.repartitionByRange(width, "taken_before", "id").sortWithinPartitions("taken_before", "id").write.parquet(plan)
        return plan

    def _upload_batch(
        self, version: int, paths: dict[str, str], upload: Upload, batch_entries: int, fatal: Column | None, plan: str
    ) -> bool:
        """Uploads the head of the queue and acknowledges it; False when a transaction must be tried again."""
        acked, attempt = self._value(paths, "acked"), self._value(paths, "attempt", 1)
        results = self._results(paths)
        if not self._has_results(paths):
            waiting = self.spark.read.schema(PLANNED).parquet(plan).where(F.col("id") > acked)
            start = waiting.agg(F.min("taken_before")).first()[0]
            rows = waiting.where(F.col("taken_before").between(start, start + batch_entries - 1)).drop("taken_before")
            dealt = rows.repartition("first_id").sortWithinPartitions("first_id", "id")
            dealt.mapInArrow(lambda b: _uploaded(b, upload), UPLOADED).write.mode("overwrite").parquet(results)
        code = F.col("error_code")
        is_fatal = fatal if fatal is not None else is_fatal_error(code)
        outcome = F.when(code.isNull(), "completed").when(is_fatal, "discarded").otherwise("retry")
        done = self.spark.read.schema(UPLOADED).parquet(results).withColumn("outcome", outcome)
        stuck, upto = done.agg(F.min(F.when(F.col("outcome") == "retry", F.col("first_id"))), F.max("last_id")).first()
        kept = done
        if stuck is not None:
            kept = done.where(F.col("first_id") < stuck)
            upto = kept.agg(F.max("last_id")).first()[0]
        values: dict[str, str | None] = {"@attempt": str(attempt + (stuck is not None))}
        tables = {}
        if upto is not None:
            values["@acked"] = str(upto)
            over = [k.removeprefix("@last/") for k, v in paths.items() if k.startswith("@last/") and int(v) <= upto]
            values |= {k: None for name in over for k in (f"entries/{name}", f"@last/{name}")}
            tables[f"uploads/{acked}"] = kept.withColumn("attempt", F.lit(attempt))
        self.store.publish(version + 1, tables, entries=values)
        delete_paths(self.spark, [results])
        return stuck is None


class _Current:
    """The transaction that the upload function has in hand."""

    first = last = tx_id = None
    n, entries = 0, None


def _uploaded(batches: Iterator[pa.RecordBatch], upload: Upload) -> Iterator[pa.RecordBatch]:
    """Hands the transactions of a partition, sorted, to ``upload`` one after the other; a row for each."""
    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
    now, done = _Current(), []

    def counted(group: Iterator[tuple]) -> Iterator[tuple[int, str]]:
        for _, number, _, data in group:
            now.n, now.last = now.n + 1, number
            yield number, data

    def transactions() -> Iterator[Transaction]:
        for first, group in groupby(rows, key=itemgetter(0)):
            if now.entries is not None:
                raise ValueError("an upload function yields a transaction's outcome before it takes the next one")
            head = next(group)
            now.first, now.tx_id, now.n = first, head[2], 0
            now.entries = counted(chain([head], group))
            yield Transaction(now.tx_id, first, now.entries)

    def result() -> pa.RecordBatch:
        out = pa.RecordBatch.from_pydict(dict(zip(_UPLOADED.names, zip(*done))), schema=_UPLOADED)
        done.clear()
        return out

    for error in upload(transactions()):
        deque(now.entries, maxlen=0)  # what the function left unread belongs to the transaction as well
        done.append((now.first, now.last, now.tx_id, now.n, error))
        now.entries = None
        if len(done) >= 1000:
            yield result()
    if now.entries is not None or next(rows, None) is not None:
        raise ValueError("an upload function yields an outcome for every transaction")
    if done:
        yield result()


_UPLOADED = pa.schema([("first_id", pa.int64()), ("last_id", pa.int64()), ("tx_id", pa.int64()), ("n_entries", pa.int64()), ("error_code", pa.string())])


def start_uploads(queue: UploadQueue, upload: Upload, checkpoint: str, trigger: dict | None = None, **options) -> StreamingQuery:
    """Drains the queue whenever something has been committed to it."""
    commits = queue.spark.readStream.schema(COMMIT_SCHEMA).parquet(f"{queue.store.root}/commits")
    return (
        commits.writeStream.foreachBatch(lambda _, __: queue.drain(upload, **options))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
