"""Queries that go through files and streams, in folders below the shared one."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from tidelog.operators import capture, feed, queue, relational
from tidelog.operators.attachments import QUEUED_DELETE, QUEUED_DOWNLOAD, QUEUED_UPLOAD
from tidelog.plans.feed import CUT, DECLARED, FOLD
from tidelog.plans.fixtures import Fixtures
from tidelog.plans.queue import CAPTURED, PAIRS, RUNS, entry_texts
from tidelog.plans.registry import query
from tidelog.schema import Options, PreviousValues
from tidelog.session import shared_dir, written
from tidelog.sources import files, lines
from tidelog.sources.state import StateStore, declared_table_rows, publish_rows
from tidelog.sources.upload import UploadQueue
from tidelog.streaming.feed import FeedApplier, start_feed
from tidelog.streaming.watch import watch


@query("state_sink", f"WITH visible AS ({CUT}), {FOLD} SELECT * FROM current WHERE row_type IN ('lists', 'todos')")
def state_sink(fx: Fixtures):
    store = StateStore(fx.spark, shared_dir(fx.spark, "state-sink"))
    publish_rows(store, 0, feed.checkpoint_rows(fx.fx_oplog, fx.fx_checkpoint))
    return declared_table_rows(store, DECLARED).select("row_type", "row_id", "data")


@query("stream_apply_oplog", f"WITH visible AS (SELECT * FROM ({CUT}) cut WHERE bucket <> 'b5'), {FOLD} SELECT * FROM current WHERE row_type IN ('lists', 'todos')")
def stream_apply_oplog(fx: Fixtures):
    """The op log as arriving lines: a checkpoint, a diff line per bucket, the data, the completion.

    Bucket b5 states a wrong checksum, so it is held back.
    """
    root = shared_dir(fx.spark, "stream-apply")
    _write_feed(fx, f"{root}/lines")
    applier = FeedApplier(fx.spark, f"{root}/state", DECLARED)
    start_feed(applier, f"{root}/lines/*", f"{root}/checkpoint").awaitTermination()
    return applier.rows().select("row_type", "row_id", "data")


def _write_feed(fx: Fixtures, path: str, write_checkpoint: int | None = None, first_priority: bool = False) -> None:
    marks = fx.fx_checkpoint
    last = F.col("last_op_id").cast("string").alias("last_op_id")
    point = F.lit(write_checkpoint).cast("string").alias("write_checkpoint")
    target = F.struct("bucket", "priority", "checksum", F.col("target_count").alias("count"))
    diff = F.to_json(F.struct(F.struct(last, point, F.array(target).alias("updated_buckets")).alias("checkpoint_diff")))
    marks.select(diff.alias("value")).write.text(f"{path}/part=0")
    lines.lines_of_ops(fx.fx_oplog).select("value").write.text(f"{path}/part=1")
    complete = F.to_json(F.struct(F.struct(last).alias("checkpoint_complete")))
    done = marks.select(last).distinct().select(complete.alias("value"))
    if first_priority:
        partial = F.to_json(F.struct(F.struct(last, F.lit(0).alias("priority")).alias("partial_checkpoint_complete")))
        done = marks.select(last).distinct().select(F.explode(F.array(partial, complete)).alias("value"))
    done.coalesce(1).write.text(f"{path}/part=2")


def _fold(name: str, visible: str) -> str:
    """The fold over a set of ops of its own, with its parts named after it."""
    text = f"visible AS ({visible}), {FOLD}"
    for part in ("visible", "newest", "clears", "held", "folded", "current"):
        text = re.sub(rf"\b{part}( AS \(| n LEFT JOIN| c ON| GROUP| WHERE|\)| f JOIN|$)", rf"{part}_{name}\1", text)
    return text


@query(
    "publish_hold",
    f"""WITH {_fold("first", f"SELECT * FROM ({CUT}) cut WHERE priority = 0")}, {_fold("all", f"SELECT * FROM ({CUT}) cut WHERE bucket <> 'b5'")}
        SELECT 'held' AS moment, * FROM current_first WHERE row_type IN ('lists', 'todos')
        UNION ALL SELECT 'drained', * FROM current_all WHERE row_type IN ('lists', 'todos')""",
)
def publish_hold(fx: Fixtures):
    """The feed beside a queue of local writes: only priority 0 is published until the queue has drained.

    No line arrives after the upload; the completion that waited is published by the drain.
    """
    root = shared_dir(fx.spark, "publish-hold")
    local = UploadQueue(fx.spark, f"{root}/queue")
    local.load(entry_texts(fx))
    _write_feed(fx, f"{root}/lines", write_checkpoint=42, first_priority=True)
    applier = FeedApplier(fx.spark, f"{root}/state", DECLARED, queue=local)
    start_feed(applier, f"{root}/lines/*", f"{root}/checkpoint").awaitTermination()
    held = applier.rows().select("row_type", "row_id", "data")
    local.drain(lambda transactions: (None for _ in transactions), write_checkpoint=lambda: 42, on_empty=applier.retry)
    drained = applier.rows().select("row_type", "row_id", "data")
    return held.select(F.lit("held").alias("moment"), "*").unionByName(drained.select(F.lit("drained").alias("moment"), "*"))


_BACK = (
    PAIRS.replace("{fx_before} b FULL JOIN {fx_after} a", "{fx_after} b FULL JOIN {fx_before} a")
    .replace("coalesce(a.touched, false)", "false")
    .replace("a._metadata", "NULL")
    .replace("pairs", "back_pairs")
    .replace("parts", "back_parts")
    .replace("entries", "back_entries")
)
_CHANGED = "WHERE inserted OR deleted OR cs OR cp OR cpr"


@query(
    "enqueue_changes",
    f"""WITH {PAIRS}, {_BACK},
        queued AS (SELECT CAST(1 AS BIGINT) AS tx_id, op, row_id, data AS op_data, old_all AS old FROM entries {_CHANGED}
                   UNION ALL SELECT 2, op, row_id, data, NULL FROM back_entries {_CHANGED}),
        txs AS (SELECT tx_id, count(*) AS n_entries, sum(count(*)) OVER (ORDER BY tx_id) AS last_id FROM queued GROUP BY tx_id)
        SELECT q.*, 'orders' AS table_name, CAST(last_id - n_entries + 1 AS BIGINT) AS first_id, CAST(last_id AS BIGINT) AS last_id, n_entries
        FROM queued q JOIN txs USING (tx_id)""",
)
def enqueue_changes(fx: Fixtures):
    """Two batches of captured changes as queue entries with dense ids, read back as typed entries and transactions."""
    local = UploadQueue(fx.spark, shared_dir(fx.spark, "enqueue"))
    options = Options(previous_values=PreviousValues())
    local.append(capture.capture_changes(fx.fx_before, fx.fx_after, "orders", CAPTURED, options))
    local.append(capture.capture_changes(fx.fx_after, fx.fx_before, "orders", CAPTURED))
    waiting = local.entries()
    entries = queue.crud_scan(waiting).drop("client_id", "metadata")
    return entries.join(F.broadcast(queue.crud_transactions(waiting)), "tx_id")  # one transaction for each batch


def _answers(errors: dict[int, str]):
    """An upload function that fails a transaction at its first entry whose id is a multiple of a key."""

    def upload(transactions):
        for transaction in transactions:
            codes = (code for number, _ in transaction.entries for every, code in errors.items() if number % every == 0)
            yield next(codes, None)

    return upload


@query(
    "upload_drain",
    f"""WITH {RUNS}, judged AS (SELECT *, coalesce(regexp_matches(first_code, '^(22...|23...|42501)$'), false) AS fatal FROM txs),
        stuck AS (SELECT min(first_id) AS stuck_at FROM judged WHERE first_code IS NOT NULL AND NOT fatal)
        SELECT first_id, last_id, CAST(tx_id AS BIGINT) AS tx_id, n_entries, CASE WHEN fatal THEN first_code END AS error_code,
               CASE WHEN fatal THEN 'discarded' ELSE 'completed' END AS outcome, CASE WHEN stuck_at IS NULL OR first_id < stuck_at THEN 1 ELSE 2 END AS attempt
        FROM judged, stuck""",
)
def upload_drain(fx: Fixtures):
    """The queue is uploaded until a transaction must be retried, and the rest by a second drain."""
    local = UploadQueue(fx.spark, shared_dir(fx.spark, "drain"))
    local.load(entry_texts(fx))
    local.drain(_answers({211: "23505", 307: "08006"}))
    local.drain(_answers({211: "23505"}))
    return local.outcomes()


@query(
    "watch",
    """SELECT l.id, l.name, l.owner_id, count(t.id) AS n_todos, e.emission
       FROM (SELECT CAST(unnest([0, 1]) AS INTEGER) AS emission) e, {fx_lists} l LEFT JOIN {fx_todos} t ON t.list_id = l.id GROUP BY ALL""",
)
def watch_query(fx: Fixtures):
    """Lists with their todo counts, emitted at once and again after the events' changes."""
    root = shared_dir(fx.spark, "watch")
    changes = fx.events.select(
        F.col("event_id").alias("tx_id"),
        F.when(F.col("event_type") == "view", "ps_data__orders").otherwise("ps_data__other").alias("table_name"),
        (F.col("user_id") % 2 == 0).alias("committed"),
    )
    changes.write.parquet(f"{root}/log")

    def emit(result, number):
        result.withColumn("emission", F.lit(number).cast("int")).write.mode("overwrite").parquet(f"{root}/out/v={number}")

    watch(
        fx.spark,
        f"{root}/log",
        lambda: relational.left_join_group(fx.fx_lists, fx.fx_todos),
        emit,
        f"{root}/checkpoint",
    ).awaitTermination()
    return fx.spark.read.parquet(f"{root}/out").drop("v")


@query(
    "transfer_files",
    """SELECT CAST(page_id AS VARCHAR) AS id, CASE page_id % 5 WHEN 0 THEN 'download' WHEN 1 THEN 'upload' ELSE 'delete' END AS direction, true AS ok,
              CASE WHEN page_id % 5 = 2 THEN 0 ELSE CAST(octet_length(encode(html)) AS BIGINT) END AS size,
              page_id % 5 <> 2 AS in_local, page_id % 5 <> 2 AS in_remote
       FROM {pages} WHERE page_id % 5 IN (0, 1, 2)""",
)
def transfer_files(fx: Fixtures):
    """Every page saved where its attachment starts from; those queued for download, upload or delete are moved.

    ``in_local`` and ``in_remote`` tell where the file is found afterwards.
    """
    root = shared_dir(fx.spark, "transfer")
    state = F.col("state")
    direction = F.when(state == QUEUED_DOWNLOAD, "download").when(state == QUEUED_UPLOAD, "upload").when(state == QUEUED_DELETE, "delete")
    queued = fx.fx_attachments.withColumn("direction", direction).where("direction IS NOT NULL")
    pages = fx.pages.select(F.col("page_id").cast("string").alias("id"), "html").join(queued.select("id", "direction"), "id")
    saved = []
    for side, absent in (("local", "download"), ("remote", "upload")):
        rows = files.save_files(pages.where(F.col("direction") != absent), "html", f"{root}/{side}", ".html")
        saved.append(written(rows.where("ok").select("id"), f"saved-{side}"))
    there = saved[0].union(saved[1]).distinct()
    plan = files.transfer_plan(queued.join(there, "id", "left_semi"), f"{root}/local", f"{root}/remote")
    moved = files.transfer_files(plan, f"{root}/log").select("id", "ok", "size").join(queued.select("id", "direction"), "id")
    for side in ("local", "remote"):
        found = files.list_files(fx.spark, f"{root}/{side}").select(F.regexp_extract("path", r"([^/]+)\.html$", 1).alias("id"), F.lit(True).alias(f"in_{side}"))
        moved = moved.join(found, "id", "left").withColumn(f"in_{side}", F.coalesce(f"in_{side}", F.lit(False)))
    return moved
