"""The upload queue: decoding, transactions, batches, completion and outcomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidelog.functions.scalars import MAX_OP_ID, is_fatal_error
from tidelog.operators.ordered import scan_before


def crud_scan(queue: DataFrame) -> DataFrame:
    """Queue rows ``(id, tx_id, data)`` as typed entries; an unknown op is an error."""
    op = F.get_json_object("data", "$.op")
    known = F.when(op.isin("PUT", "PATCH", "DELETE"), op).otherwise(
        F.raise_error(F.concat(F.lit("unknown op in queue entry "), F.col("id").cast("string")))
    )
    return queue.select(
        F.col("id").alias("client_id"),
        "tx_id",
        known.alias("op"),
        F.get_json_object("data", "$.type").alias("table_name"),
        F.get_json_object("data", "$.id").alias("row_id"),
        F.get_json_object("data", "$.data").alias("op_data"),
        F.get_json_object("data", "$.old").alias("old"),
        F.get_json_object("data", "$.metadata").alias("metadata"),
    )


def with_runs(entries: DataFrame) -> DataFrame:
    """Adds ``run``: with ``tx_id`` it names an entry's transaction.

    Entries of a transaction have consecutive ids and one non-NULL ``tx_id``, so the id minus
    the entry's rank within its tx_id is the same for all of them. The rank comes from a
    ranged scan; a tx_id that holds much of the queue is spread over many tasks. An entry
    without a tx_id is a transaction of its own.
    """
    grouped = scan_before(
        entries.where(F.col("tx_id").isNotNull()), "id", by=["tx_id"], sums={"_rank": F.lit(1).cast("bigint")}
    )
    single = entries.where(F.col("tx_id").isNull()).withColumn("run", F.col("id"))
    return grouped.withColumn("run", F.col("id") - F.col("_rank")).drop("_rank").unionByName(single)


def crud_transactions(entries: DataFrame) -> DataFrame:
    """``(tx_id, first_id, last_id, n_entries)`` of every transaction in the queue."""
    return (
        with_runs(entries.select("id", "tx_id"))
        .groupBy("tx_id", "run")
        .agg(
            F.min("id").alias("first_id"),
            F.max("id").alias("last_id"),
            F.count(F.lit(1)).alias("n_entries"),
        )
        .drop("run")
    )


def take_until_size(transactions: DataFrame, size: int) -> DataFrame:
    """The oldest transactions, while fewer than ``size`` entries were taken before each.

    The running number of entries comes from a ranged scan, whatever ``size`` is.
    """
    taken = scan_before(transactions, "first_id", sums={"taken_before": F.col("n_entries")})
    return taken.where(F.col("taken_before") < size)


def next_transaction(entries: DataFrame) -> DataFrame:
    """The oldest open transaction, or no row. Only entries with its tx_id are grouped."""
    narrow = entries.select("id", "tx_id")
    head = narrow.orderBy("id").limit(1)
    head_tx, head_id = head.select("tx_id").scalar(), head.select("id").scalar()
    candidates = narrow.where((F.col("tx_id") == head_tx) | (F.col("id") == head_id))
    return crud_transactions(candidates).orderBy("first_id").limit(1)


def entries_until(entries: DataFrame, transactions: DataFrame) -> DataFrame:
    """The entries of transactions taken from the head of the queue: an id range."""
    return entries.where(F.col("id") <= transactions.agg(F.max("last_id").alias("_last")).scalar())


def walk_transaction(entries: DataFrame, start_id: int) -> DataFrame:
    """The entries of the transaction that begins at ``start_id``, in id order.

    Only entries with the start's tx_id are looked at.
    """
    start_tx = entries.where(F.col("id") == start_id).select("tx_id").scalar()
    same = entries.where(
        (F.col("id") >= start_id) & ((F.col("tx_id") == start_tx) | (F.col("id") == start_id))
    )
    runs = with_runs(same)
    start_run = runs.where(F.col("id") == start_id).select("run").scalar()
    return runs.where(F.col("run") == start_run).drop("run").orderBy("id")


def crud_batch(entries: DataFrame, limit: int = 100) -> DataFrame:
    """The first ``limit`` entries with ``has_more``; a batch may split a transaction."""
    seen = entries.select("id").limit(limit + 1).agg(F.count(F.lit(1)).alias("_n")).scalar()
    return entries.orderBy("id").limit(limit).withColumn("has_more", seen > limit)


def complete_upto(entries: DataFrame, last_id: int) -> DataFrame:
    """The queue after entries up to ``last_id`` are done."""
    return entries.where(F.col("id") > last_id)


def local_target(remaining: DataFrame, write_checkpoint: int | None = None) -> DataFrame:
    """One row: the local target after a completion.

    It is the write checkpoint when one is given and the queue is empty, else the maximum.
    """
    count = remaining.limit(1).agg(F.count(F.lit(1)).alias("_n"))
    given = F.lit(write_checkpoint).cast("bigint")
    target = F.when((F.col("_n") == 0) & given.isNotNull(), given).otherwise(F.lit(MAX_OP_ID))
    return count.select(target.alias("target_op"))


def update_local_target(attempts: DataFrame) -> DataFrame:
    """Per attempt whether the local target is set, and to what.

    It is set only while it is the maximum, the queue is empty, and the queue's sequence did
    not move while the checkpoint was fetched.
    """
    ok = (
        (F.col("target_op") == MAX_OP_ID)
        & F.col("queue_empty")
        & (F.col("seq_before") == F.col("seq_after"))
    )
    return attempts.withColumns(
        {"updated": ok, "new_target": F.when(ok, F.col("write_checkpoint")).otherwise(F.col("target_op"))}
    )


def upload_outcome(entries: DataFrame, fatal: Column | None = None) -> DataFrame:
    """Per transaction what an upload attempt with the given error codes ends in.

    Without errors it is completed. If the first error is fatal the rest is discarded and the
    transaction completed; otherwise the whole transaction is retried. ``fatal`` overrides
    the rule for fatal codes. Only ids are aggregated: the first error is fatal when it
    is also the first fatal one.
    """
    failed = F.col("error_code").isNotNull()
    is_fatal = failed & (fatal if fatal is not None else is_fatal_error(F.col("error_code")))
    marked = entries.select("id", "tx_id", failed.alias("_failed"), is_fatal.alias("_fatal"))
    per_tx = (
        with_runs(marked)
        .groupBy("tx_id", "run")
        .agg(
            F.min("id").alias("first_id"),
            F.count(F.lit(1)).alias("n_entries"),
            F.min(F.when(F.col("_failed"), F.col("id"))).alias("first_error_id"),
            F.min(F.when(F.col("_fatal"), F.col("id"))).alias("_first_fatal"),
        )
    )
    error = F.col("first_error_id")
    return per_tx.select(
        "tx_id",
        "first_id",
        "n_entries",
        "first_error_id",
        F.when(error.isNull(), "completed")
        .when(error == F.col("_first_fatal"), "discarded")
        .otherwise("retry")
        .alias("outcome"),
    )


def stalled_queue(rounds: DataFrame) -> DataFrame:
    """Per client and upload round whether the head entry is the one of the round before."""
    seen = scan_before(rounds, "round_no", by=["client"], lasts={"previous_head": F.col("head_id")})
    return seen.withColumn(
        "stalled", F.coalesce(F.col("previous_head") == F.col("head_id"), F.lit(False))
    )


def queue_stats(queue: DataFrame) -> DataFrame:
    """Entries of the queue, their size in bytes, and the size in whole kB as displayed."""
    size = F.coalesce(F.sum(F.octet_length("data").cast("bigint")), F.lit(0).cast("bigint"))
    return queue.agg(F.count(F.lit(1)).alias("entries"), size.alias("size_bytes")).withColumn(
        "size_kb", F.floor(F.col("size_bytes") / 1024)
    )


def queue_head(entries: DataFrame) -> DataFrame:
    return entries.orderBy("id").limit(1)


def exists_any(rows: DataFrame) -> DataFrame:
    """One row: whether there is any row. Reads until the first one."""
    return rows.limit(1).agg((F.count(F.lit(1)) > 0).alias("found"))
