"""Queries over the attachment queue."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelog.functions.scalars import attachment_filename
from tidelog.operators import attachments, relational
from tidelog.plans.fixtures import Fixtures
from tidelog.plans.registry import query

QUEUE_COLUMNS = "id, timestamp, filename, state, local_uri, media_type, size, has_synced"


@query(
    "reconcile_attachments",
    """SELECT w.id, NULL::BIGINT AS timestamp, coalesce(w.filename, concat(w.id, '.', w.file_extension)) AS filename, 0 AS state,
              NULL::VARCHAR AS local_uri, NULL::VARCHAR AS media_type, NULL::BIGINT AS size, false AS has_synced
       FROM {fx_watched} w WHERE w.id NOT IN (SELECT id FROM {fx_attachments})
       UNION ALL
       SELECT id, timestamp, filename, CASE WHEN has_synced THEN 3 WHEN local_uri IS NULL THEN 0 ELSE 1 END, local_uri, media_type, size, has_synced
       FROM {fx_attachments} WHERE state = 4 AND id IN (SELECT id FROM {fx_watched})
       UNION ALL
       SELECT id, timestamp, filename, 4, local_uri, media_type, size, has_synced
       FROM {fx_attachments} WHERE id NOT IN (SELECT id FROM {fx_watched}) AND (state NOT IN (1, 2) OR has_synced)""",
)
def reconcile_attachments(fx: Fixtures):
    return attachments.reconcile_attachments(fx.fx_attachments, fx.fx_watched)


@query(
    "reconcile_full_outer",
    """SELECT coalesce(a.id, w.id) AS id, a.id IS NOT NULL AS tracked, w.id IS NOT NULL AS watched
       FROM {fx_attachments} a FULL JOIN {fx_watched} w ON w.id = a.id""",
)
def reconcile_full_outer(fx: Fixtures):
    tracked = fx.fx_attachments.select("id", F.lit(True).alias("tracked"))
    watched = fx.fx_watched.select("id", F.lit(True).alias("watched"))
    return tracked.join(watched, "id", "full_outer").select(
        "id",
        F.coalesce("tracked", F.lit(False)).alias("tracked"),
        F.coalesce("watched", F.lit(False)).alias("watched"),
    )


@query(
    "verify_files",
    """SELECT id, timestamp, filename, 4 AS state, NULL::VARCHAR AS local_uri, media_type, size, has_synced FROM {fx_attachments}
       WHERE local_uri IS NOT NULL AND state IN (1, 3) AND local_uri NOT IN (SELECT local_uri FROM {fx_files})""",
)
def verify_files(fx: Fixtures):
    return attachments.verify_files(fx.fx_attachments, fx.fx_files)


@query("active_queue", f"SELECT {QUEUE_COLUMNS} FROM {{fx_attachments}} WHERE state IN (0, 1, 2)")
def active_queue(fx: Fixtures):
    return attachments.active_queue(fx.fx_attachments)


@query("filter_or_states", "SELECT id, state, timestamp FROM {fx_attachments} WHERE state = 0 OR state = 1 OR state = 2")
def filter_or_states(fx: Fixtures):
    return attachments.active_queue(fx.fx_attachments).select("id", "state", "timestamp")


@query(
    "archive_expiry",
    """SELECT id, timestamp FROM (SELECT *, row_number() OVER (ORDER BY timestamp DESC, id DESC) AS rn FROM {fx_attachments} WHERE state = 4)
       WHERE rn > 10""",
)
def archive_expiry(fx: Fixtures):
    return attachments.archive_expiry(fx.fx_attachments, 10).select("id", "timestamp")


@query(
    "sync_outcome",
    """WITH tried AS (SELECT a.*, o.retry, o.ok AND NOT (a.state = 1 AND a.local_uri IS NULL) AS done
                      FROM {fx_attachments} a JOIN {fx_outcomes} o ON o.id = a.id WHERE a.state IN (0, 1, 2))
       SELECT id, timestamp, filename, CAST(CASE WHEN done THEN (CASE WHEN state = 2 THEN 4 ELSE 3 END) WHEN NOT retry THEN 4 ELSE state END AS INTEGER) AS state,
              CASE WHEN done AND state = 0 THEN concat('attachments/', filename) ELSE local_uri END AS local_uri, media_type, size,
              CASE WHEN done AND state <> 2 THEN true ELSE has_synced END AS has_synced FROM tried""",
)
def sync_outcome(fx: Fixtures):
    return attachments.sync_outcome(fx.fx_attachments, fx.fx_outcomes)


def _saved(fx: Fixtures):
    """A saved file for every new watched item."""
    return fx.fx_watched.where(F.col("id").startswith("new")).select(
        "id",
        F.length("id").cast("bigint").alias("timestamp"),
        "filename",
        "file_extension",
        F.lit("text/html").alias("media_type"),
        (F.length("id") * 10).cast("bigint").alias("size"),
    )


@query(
    "queue_upload",
    """SELECT id, CAST(length(id) AS BIGINT) AS timestamp, coalesce(filename, concat(id, '.', file_extension)) AS filename, 1 AS state,
              concat('attachments/', coalesce(filename, concat(id, '.', file_extension))) AS local_uri, 'text/html' AS media_type,
              CAST(length(id) * 10 AS BIGINT) AS size, false AS has_synced FROM {fx_watched} WHERE id LIKE 'new%'""",
)
def queue_upload(fx: Fixtures):
    return attachments.queue_upload(_saved(fx))


@query(
    "queue_delete",
    """SELECT id, timestamp, filename, 2 AS state, local_uri, media_type, size, false AS has_synced FROM {fx_attachments}
       WHERE CAST(id AS BIGINT) % 3 = 1""",
)
def queue_delete(fx: Fixtures):
    asked = fx.pages.where(F.col("page_id") % 3 == 1).select(F.col("page_id").cast("string").alias("id"))
    return attachments.queue_delete(fx.fx_attachments, asked)


@query(
    "ignore_or_delete",
    "SELECT id, CASE WHEN id = '11' THEN 4 ELSE state END AS state FROM {fx_attachments} WHERE id <> '12'",
)
def ignore_or_delete(fx: Fixtures):
    ignored = attachments.ignore_attachment(fx.fx_attachments, "11")
    return attachments.delete_attachment(ignored, "12").select("id", "state")


@query("clear_queue", "SELECT count(*) AS n FROM {fx_attachments} WHERE id IS NULL")
def clear_queue(fx: Fixtures):
    return relational.count_rows(attachments.clear_queue(fx.fx_attachments))


@query(
    "attachment_filename",
    "SELECT id, coalesce(filename, concat(id, '.', file_extension)) AS filename FROM {fx_watched}",
)
def attachment_filename_query(fx: Fixtures):
    name = attachment_filename(F.col("filename"), F.col("id"), F.col("file_extension"))
    return fx.fx_watched.select("id", name.alias("filename"))


@query(
    "offset_page",
    "SELECT id, timestamp FROM {fx_attachments} WHERE state = 4 ORDER BY timestamp DESC, id DESC LIMIT 20 OFFSET 10",
)
def offset_page(fx: Fixtures):
    archived = fx.fx_attachments.where(F.col("state") == 4).select("id", "timestamp")
    return relational.offset_page(archived, [F.col("timestamp").desc(), F.col("id").desc()], 10, 20)


@query("ordered_scan", f"SELECT {QUEUE_COLUMNS} FROM {{fx_attachments}} WHERE id IS NOT NULL ORDER BY timestamp, id")
def ordered_scan(fx: Fixtures):
    return relational.ordered_scan(fx.fx_attachments)
