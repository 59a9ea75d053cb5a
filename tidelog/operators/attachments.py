"""The attachment queue: reconciling it with the rows that use it, and its state changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.scalars import attachment_filename

# States of an attachment.
QUEUED_DOWNLOAD, QUEUED_UPLOAD, QUEUED_DELETE, SYNCED, ARCHIVED = range(5)
ACTIVE_STATES = (QUEUED_DOWNLOAD, QUEUED_UPLOAD, QUEUED_DELETE)
DEFAULT_ARCHIVE_LIMIT = 100


def reconcile_attachments(
    queue: DataFrame, watched: DataFrame, downloads: bool = True, filename: Column | None = None
) -> DataFrame:
    """The queue rows that change when the watched items are taken as what should exist.

    New items are queued for download. An archived item that is watched again is synced if it
    was, else queued for upload or download by whether it has a local file. A row no
    longer watched is archived; one waiting for upload or deletion only if it has synced.
    ``filename`` overrides how new items are named, as an expression over the watched columns. When both sides
    have ``meta_data``, a new item brings its own.
    """
    described = "meta_data" in queue.columns and "meta_data" in watched.columns
    item = watched.select(
        "id",
        F.lit(True).alias("_watched"),
        (filename if filename is not None else attachment_filename(
            F.col("filename"), F.col("id"), F.col("file_extension")
        )).alias("_filename"),
        *([F.col("meta_data").alias("_meta_data")] if described else []),
    )
    tracked = queue.withColumn("_tracked", F.lit(True))
    both = tracked.join(item, "id", "full_outer")
    state = F.col("state")
    new_state = (
        F.when(F.col("_tracked").isNull(), F.lit(QUEUED_DOWNLOAD) if downloads else F.lit(None).cast("int"))
        .when(
            F.col("_watched"),
            F.when(state != ARCHIVED, None)
            .when(F.col("has_synced"), SYNCED)
            .when(F.col("local_uri").isNull(), QUEUED_DOWNLOAD)
            .otherwise(QUEUED_UPLOAD),
        )
        .when(~state.isin(QUEUED_DELETE, QUEUED_UPLOAD) | F.col("has_synced"), ARCHIVED)
    )
    return (
        both.withColumn("_new", new_state)
        .where(F.col("_new").isNotNull())
        .select(
            *[
                {
                    "state": F.col("_new").cast("int").alias("state"),
                    "filename": F.coalesce("filename", "_filename").alias("filename"),
                    "has_synced": F.coalesce("has_synced", F.lit(False)).alias("has_synced"),
                    **({"meta_data": F.coalesce("meta_data", "_meta_data").alias("meta_data")} if described else {}),
                }.get(c, F.col(c))
                for c in queue.columns
            ]
        )
    )


def verify_files(queue: DataFrame, files: DataFrame) -> DataFrame:
    """Rows whose local file is gone: synced and to-be-uploaded ones are archived."""
    checked = queue.where(
        F.col("local_uri").isNotNull() & F.col("state").isin(SYNCED, QUEUED_UPLOAD)
    )
    gone = checked.join(files.select("local_uri"), "local_uri", "left_anti")
    return gone.withColumns(
        {"state": F.lit(ARCHIVED), "local_uri": F.lit(None).cast("string")}
    ).select(*queue.columns)


def active_queue(queue: DataFrame) -> DataFrame:
    return queue.where(F.col("state").isin(*ACTIVE_STATES)).orderBy("timestamp", "id")


def archive_keep(queue: DataFrame, limit: int = DEFAULT_ARCHIVE_LIMIT) -> DataFrame:
    """The newest archived rows, which stay."""
    archived = queue.where(F.col("state") == ARCHIVED)
    return archived.orderBy(F.col("timestamp").desc(), F.col("id").desc()).limit(limit)


def archive_expiry(queue: DataFrame, limit: int = DEFAULT_ARCHIVE_LIMIT) -> DataFrame:
    """Archived rows beyond the newest ``limit``, which are to be deleted."""
    keep = archive_keep(queue, limit).select("id")
    return queue.where(F.col("state") == ARCHIVED).join(keep, "id", "left_anti")


def sync_outcome(queue: DataFrame, outcomes: DataFrame, directory: str = "attachments") -> DataFrame:
    """Rows after an attempt; ``outcomes`` has ``(id, ok, retry)``, retry NULL without a handler.

    An upload without a local file counts as failed.
    """
    tried = queue.where(F.col("state").isin(*ACTIVE_STATES)).join(outcomes, "id")
    state = F.col("state")
    ok = F.col("ok") & ~((state == QUEUED_UPLOAD) & F.col("local_uri").isNull())
    done = F.when(state == QUEUED_DELETE, ARCHIVED).otherwise(SYNCED)
    gives_up = ~ok & (F.col("retry") == F.lit(False))
    downloaded = ok & (state == QUEUED_DOWNLOAD)
    changes = {
        "state": F.when(ok, done).when(gives_up, ARCHIVED).otherwise(state).cast("int"),
        "has_synced": F.when(ok & (state != QUEUED_DELETE), F.lit(True)).otherwise(F.col("has_synced")),
        "local_uri": F.when(downloaded, F.concat(F.lit(f"{directory}/"), F.col("filename"))).otherwise(
            F.col("local_uri")
        ),
    }
    return tried.select(*[changes[c].alias(c) if c in changes else F.col(c) for c in queue.columns])


def queue_upload(files: DataFrame, directory: str = "attachments") -> DataFrame:
    """New queue rows for saved files ``(id, timestamp, filename, file_extension, media_type, size)``.

    A ``meta_data`` column of the files is kept.
    """
    name = attachment_filename(F.col("filename"), F.col("id"), F.col("file_extension"))
    return files.select(
        "id",
        "timestamp",
        name.alias("filename"),
        F.lit(QUEUED_UPLOAD).alias("state"),
        F.concat(F.lit(f"{directory}/"), name).alias("local_uri"),
        "media_type",
        "size",
        F.lit(False).alias("has_synced"),
        *[c for c in files.columns if c == "meta_data"],
    )


def queue_delete(queue: DataFrame, requests: DataFrame) -> DataFrame:
    """Rows asked to be deleted, queued for it; a request for an unknown id is an error."""
    asked = requests.select("id", F.lit(True).alias("_asked")).distinct()
    joined = asked.join(queue.withColumn("_known", F.lit(True)), "id", "left")
    found = F.when(F.col("_known"), F.lit(QUEUED_DELETE)).otherwise(
        F.raise_error(
            F.concat(F.lit("Attachment record with id "), F.col("id"), F.lit(" was not found."))
        ).cast("int")
    )
    return joined.withColumns({"state": found, "has_synced": F.lit(False)}).select(*queue.columns)


def ignore_attachment(queue: DataFrame, attachment_id: str) -> DataFrame:
    hit = F.col("id") == attachment_id
    return queue.withColumn("state", F.when(hit, F.lit(ARCHIVED)).otherwise(F.col("state")))


def delete_attachment(queue: DataFrame, attachment_id: str) -> DataFrame:
    return queue.where(F.col("id") != attachment_id)


def clear_queue(queue: DataFrame) -> DataFrame:
    return queue.limit(0)
