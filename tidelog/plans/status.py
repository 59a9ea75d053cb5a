"""Queries over progress, sync status and subscriptions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelog.functions.json import params_to_json
from tidelog.functions.scalars import FULL_SYNC, epoch_to_timestamp, progress_fraction, timestamp_to_epoch
from tidelog.operators import status, subscriptions
from tidelog.plans.fixtures import Fixtures
from tidelog.plans.registry import query

ASKED = (0, 1, 2, 3, FULL_SYNC)
ASKED_SQL = "(SELECT CAST(unnest([0, 1, 2, 3, 2147483647]) AS INTEGER) AS priority)"

# Counters a restarted download resumes from: rebuilt buckets start over.
RESUMED = """
 resumed AS (SELECT t.bucket, t.priority, t.target_count,
   CASE WHEN t.target_count < s.at_last + s.since_last THEN 0 ELSE s.at_last END AS at_last,
   CASE WHEN t.target_count < s.at_last + s.since_last THEN 0 ELSE s.since_last END AS since_last
   FROM {fx_bucket_state} t JOIN {fx_bucket_state} s ON s.bucket = t.bucket)
"""


def _resumed(fx: Fixtures):
    state = fx.fx_bucket_state
    return status.progress_resume(state, state.select("bucket", "priority", "target_count"))


@query("progress_resume", f"WITH {RESUMED} SELECT * FROM resumed")
def progress_resume(fx: Fixtures):
    return _resumed(fx)


@query(
    "progress_fold",
    "SELECT CAST(2147483647 AS INTEGER) AS priority, CAST(sum(target_count - at_last) AS BIGINT) AS total, CAST(sum(since_last) AS BIGINT) AS downloaded, sum(since_last) / sum(target_count - at_last) AS fraction FROM {fx_bucket_state}",
)
def progress_fold(fx: Fixtures):
    return status.download_progress(fx.fx_bucket_state)


@query(
    "download_progress",
    f"""WITH {RESUMED} SELECT p.priority, CAST(coalesce(sum(target_count - at_last), 0) AS BIGINT) AS total,
          CAST(coalesce(sum(since_last), 0) AS BIGINT) AS downloaded,
          CASE WHEN coalesce(sum(target_count - at_last), 0) = 0 THEN 0.0 ELSE sum(since_last) / sum(target_count - at_last) END AS fraction
        FROM {ASKED_SQL} p LEFT JOIN resumed r ON r.priority <= p.priority GROUP BY p.priority""",
)
def download_progress(fx: Fixtures):
    return status.download_progress(_resumed(fx), ASKED)


@query(
    "progress_fraction",
    """SELECT bucket, CASE WHEN target_count - at_last = 0 THEN 0.0 ELSE since_last / (target_count - at_last) END AS fraction
       FROM {fx_bucket_state}""",
)
def progress_fraction_query(fx: Fixtures):
    total = F.col("target_count") - F.col("at_last")
    return fx.fx_bucket_state.select("bucket", progress_fraction(F.col("since_last"), total).alias("fraction"))


@query(
    "progress_timeline",
    """WITH lines AS (SELECT o.op_id AS seq, o.bucket, c.priority AS code FROM {fx_oplog} o LEFT JOIN {fx_checkpoint} c ON c.bucket = o.bucket)
       SELECT l.seq, p.priority,
         CAST(sum(CASE WHEN code <= p.priority THEN 1 ELSE 0 END) OVER (PARTITION BY p.priority ORDER BY l.seq) AS BIGINT) AS downloaded,
         CAST((SELECT sum(target_count) FROM {fx_checkpoint} c WHERE c.priority <= p.priority) AS BIGINT) AS total
       FROM lines l, (SELECT CAST(unnest([0, 2, 2147483647]) AS INTEGER) AS priority) p""",
)
def progress_timeline(fx: Fixtures):
    zero = F.lit(0).cast("bigint")
    targets = fx.fx_checkpoint.select("bucket", "priority", "target_count", zero.alias("at_last"), zero.alias("since_last"))
    ops = fx.fx_oplog.select(F.col("op_id").alias("seq"), "bucket", F.lit(1).cast("bigint").alias("ops"))
    return status.progress_timeline(targets, ops, (0, 2, FULL_SYNC))


@query(
    "status_snapshot",
    """SELECT seq, connected, NOT connected AS connecting, seq % 3 = 0 AS downloading, seq % 7 = 0 AS uploading,
              priority = 2147483647 AS has_synced, CASE WHEN priority = 2147483647 THEN seq END AS last_synced_at,
              CAST(1 AS INTEGER) AS n_entries, coalesce(download_error, upload_error) AS any_error FROM {fx_status_events}""",
)
def status_snapshot(fx: Fixtures):
    entry = F.struct("priority", F.col("seq").alias("last_synced_at"), F.lit(True).alias("has_synced"))
    document = F.struct(
        "connected",
        (~F.col("connected")).alias("connecting"),
        F.when(F.col("seq") % 3 == 0, F.struct(F.create_map().cast("map<string,string>").alias("buckets"))).alias("downloading"),
        F.array(entry).alias("priority_status"),
        F.array().cast("array<string>").alias("streams"),
    )
    statuses = fx.fx_status_events.select(
        "seq", F.to_json(document).alias("status"), (F.col("seq") % 7 == 0).alias("uploading"), "upload_error", "download_error"
    )
    return status.status_snapshot(statuses, keep=["seq"])


def _sync_state(fx: Fixtures):
    return status.sync_state_upsert(fx.fx_status_events.where("connected"), ["client"])


SYNC_STATE = "state AS (SELECT client, priority, max(seq) AS last_synced_at FROM {fx_status_events} WHERE connected GROUP BY ALL)"


@query("sync_state_upsert", f"WITH {SYNC_STATE} SELECT * FROM state")
def sync_state_upsert(fx: Fixtures):
    return _sync_state(fx)


@query(
    "status_for_priority",
    f"""WITH {SYNC_STATE} SELECT c.client, p.priority, min(s.priority) AS entry_priority, arg_min(s.last_synced_at, s.priority) AS last_synced_at,
          min(s.priority) IS NOT NULL AS has_synced
        FROM (SELECT DISTINCT client FROM state) c CROSS JOIN {ASKED_SQL} p LEFT JOIN state s ON s.client = c.client AND s.priority >= p.priority
        GROUP BY c.client, p.priority""",
)
def status_for_priority(fx: Fixtures):
    return status.status_for_priority(_sync_state(fx), ["client"], ASKED)


@query(
    "asof_priority",
    f"""WITH {SYNC_STATE}, asked AS (SELECT DISTINCT user_id % 16 AS client, CAST(event_id % 6 AS INTEGER) AS priority FROM {{events}})
        SELECT a.client, a.priority, min(s.priority) AS entry_priority, arg_min(s.last_synced_at, s.priority) AS last_synced_at,
               CASE WHEN min(s.priority) IS NOT NULL THEN true END AS has_synced
        FROM asked a LEFT JOIN state s ON s.client = a.client AND s.priority >= a.priority GROUP BY ALL""",
)
def asof_priority(fx: Fixtures):
    entries = _sync_state(fx).withColumn("has_synced", F.lit(True))
    requests = fx.events.select((F.col("user_id") % 16).alias("client"), (F.col("event_id") % 6).cast("int").alias("priority"))
    return status.asof_priority(requests, entries, ["client"])


@query(
    "first_sync_time",
    """SELECT coalesce(f.client, p.client) AS client, f.first_seq AS full_seq, p.first_seq AS partial_seq FROM
         (SELECT client, min(seq) AS first_seq FROM {fx_status_events} WHERE priority >= 2147483647 GROUP BY client) f
         FULL JOIN (SELECT client, min(seq) AS first_seq FROM {fx_status_events} WHERE priority >= 2 GROUP BY client) p ON p.client = f.client""",
)
def first_sync_time(fx: Fixtures):
    full = status.first_sync_time(fx.fx_status_events, ["client"]).withColumnRenamed("first_seq", "full_seq")
    partial = status.first_sync_time(fx.fx_status_events, ["client"], 2).withColumnRenamed("first_seq", "partial_seq")
    return full.join(partial, "client", "full_outer")


SUBSCRIPTIONS = """
 begun AS (SELECT stream, handle, max(seq) AS opened, arg_max(ttl, seq) AS ttl, arg_max(priority, seq) AS priority
   FROM {fx_subscription_events} WHERE kind = 'subscribe' GROUP BY ALL),
 handles AS (SELECT b.stream, b.handle, b.opened, b.ttl, b.priority, min(e.seq) AS closed
   FROM begun b LEFT JOIN {fx_subscription_events} e ON e.stream = b.stream AND e.handle = b.handle AND e.kind = 'unsubscribe' AND e.seq > b.opened
   GROUP BY ALL),
 cleared AS (SELECT stream, max(seq) AS cleared FROM {fx_subscription_events} WHERE kind = 'unsubscribe_all' GROUP BY stream),
 alive AS (SELECT h.*, closed IS NULL AS open FROM handles h LEFT JOIN cleared c ON c.stream = h.stream
   WHERE opened > coalesce(cleared, -1)),
 subs AS (SELECT stream, CAST(count(*) FILTER (open) AS BIGINT) AS ref_count, arg_max(ttl, opened) AS ttl, arg_max(priority, opened) AS priority,
   max(closed) FILTER (NOT open) AS last_closed FROM alive GROUP BY stream)
"""


@query("subscription_fold", f"WITH {SUBSCRIPTIONS} SELECT stream, ref_count, ttl, priority FROM subs WHERE ref_count > 0")
def subscription_fold(fx: Fixtures):
    return subscriptions.subscription_fold(fx.fx_subscription_events)


def _many_streams(fx: Fixtures):
    """Subscription events with a stream per handle, so that some streams are unreferenced."""
    return fx.fx_subscription_events.withColumns(
        {"stream": F.concat("stream", F.lit("/"), F.col("handle").cast("string")), "at": timestamp_to_epoch(F.col("ts").cast("timestamp"))}
    )


@query(
    "subscription_expiry",
    "WITH ev AS (SELECT * REPLACE (concat(stream, '/', CAST(handle AS VARCHAR)) AS stream), CAST(floor(epoch(ts)) AS BIGINT) AS at_s FROM {fx_subscription_events}), "
    + SUBSCRIPTIONS.replace("{fx_subscription_events}", "ev")
    + """, expiring AS (SELECT s.stream, s.ref_count, s.ttl, s.priority, CASE WHEN ref_count = 0 THEN e.at_s + s.ttl END AS expires_at
           FROM subs s LEFT JOIN ev e ON e.seq = s.last_closed)
         SELECT * FROM expiring WHERE ref_count > 0 OR expires_at > (SELECT max(at_s) - 40000 FROM ev)""",
)
def subscription_expiry(fx: Fixtures):
    events = _many_streams(fx)
    now = events.agg((F.max("at") - 40000).alias("now")).scalar()
    return subscriptions.subscription_expiry(events, now)


@query(
    "subscription_request",
    f"""WITH {SUBSCRIPTIONS}, items AS (SELECT CAST(priority % 2 AS INTEGER) AS client,
          concat('{{"stream":"', stream, '","parameters":{{"refs":', ref_count, '}},"override_priority":', priority, '}}') AS item FROM subs WHERE ref_count > 0)
        SELECT client, concat('{{"include_defaults":true,"subscriptions":[', array_to_string(list_sort(list(DISTINCT item)), ','), ']}}') AS request
        FROM items GROUP BY client""",
)
def subscription_request(fx: Fixtures):
    active = subscriptions.subscription_fold(fx.fx_subscription_events)
    asked = active.withColumns(
        {"parameters": F.struct(F.col("ref_count").alias("refs")), "client": (F.col("priority") % 2).cast("int")}
    )
    return subscriptions.subscription_request(asked, "client")


@query(
    "stream_status",
    """SELECT concat('s', CAST(user_id % 10 AS VARCHAR)) AS name, concat('{"u":', user_id, '}') AS parameters, event_type <> 'error' AS active,
              event_type = 'view' AS is_default, event_type <> 'view' AS has_explicit_subscription, event_id + 5 AS expires_at,
              CASE WHEN event_id % 2 = 0 THEN event_id END AS last_synced_at, event_id % 2 = 0 AS has_synced,
              CASE WHEN event_id % 3 = 0 THEN event_id END AS downloaded, CASE WHEN event_id % 3 = 0 THEN event_id + 9 END AS total,
              CASE WHEN event_type = 'click' THEN 2147483647 ELSE CAST(user_id % 4 AS INTEGER) END AS priority
       FROM {events} WHERE user_id % 10 IN (SELECT c_custkey % 5 FROM {customer})
         AND user_id IN (SELECT c_custkey FROM {customer})""",
)
def stream_status(fx: Fixtures):
    user = F.col("user_id")
    parameters = params_to_json({"u": user})
    tracked = fx.events.select(
        F.concat(F.lit("s"), (user % 10).cast("string")).alias("name"),
        parameters.alias("parameters"),
        (F.col("event_type") != "error").alias("active"),
        (F.col("event_type") == "view").alias("is_default"),
        (F.col("event_type") != "view").alias("has_explicit_subscription"),
        (F.col("event_id") + 5).alias("expires_at"),
        F.when(F.col("event_id") % 2 == 0, F.col("event_id")).alias("last_synced_at"),
        (F.col("event_id") % 3 == 0).alias("downloading"),
        F.col("event_id").alias("downloaded"),
        (F.col("event_id") + 9).alias("total"),
        F.when(F.col("event_type") != "click", (user % 4).cast("int")).alias("priority"),
    )
    key = F.col("c_custkey")
    wanted = fx.customer.where(key % 10 < 5).select(
        F.concat(F.lit("s"), (key % 10).cast("string")).alias("name"), params_to_json({"u": key}).alias("parameters")
    )
    return subscriptions.stream_status(tracked, wanted)


@query("stream_priority_synced", "SELECT sub, max(priority) <= 2 AS synced FROM {fx_bucket_subscription} GROUP BY sub")
def stream_priority_synced(fx: Fixtures):
    return subscriptions.stream_priority_synced(fx.fx_bucket_subscription, 2)


@query(
    "bucket_scope",
    """SELECT 'lists' AS source, id, concat('my_lists:', owner_id) AS bucket FROM {fx_lists}
       UNION ALL SELECT 'todos', t.id, concat('my_todos:', l.owner_id) FROM {fx_todos} t JOIN {fx_lists} l ON l.id = t.list_id""",
)
def bucket_scope(fx: Fixtures):
    own = subscriptions.bucket_scope("my_lists", fx.fx_lists, F.col("owner_id"))
    children = subscriptions.child_scope("my_todos", fx.fx_todos, fx.fx_lists, "list_id", "owner_id")
    return own.select(F.lit("lists").alias("source"), "id", "bucket").unionByName(
        children.select(F.lit("todos").alias("source"), "id", "bucket")
    )


@query(
    "default_streams",
    f"""WITH {SUBSCRIPTIONS}, defaults AS (SELECT DISTINCT concat('s', CAST(c_nationkey AS VARCHAR)) AS stream FROM {{customer}})
        SELECT coalesce(d.stream, s.stream) AS stream, d.stream IS NOT NULL AS is_default, s.stream IS NOT NULL AS has_explicit_subscription
        FROM defaults d FULL JOIN (SELECT * FROM subs WHERE ref_count > 0) s ON s.stream = d.stream""",
)
def default_streams(fx: Fixtures):
    defaults = fx.customer.select(F.concat(F.lit("s"), F.col("c_nationkey").cast("string")).alias("stream")).distinct()
    return subscriptions.default_streams(defaults, subscriptions.subscription_fold(fx.fx_subscription_events))


@query(
    "epoch_to_ts",
    "SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS seconds, CAST(floor(epoch(ts)) AS BIGINT) AS back FROM {events}",
)
def epoch_to_ts(fx: Fixtures):
    seconds = timestamp_to_epoch(F.col("ts").cast("timestamp"))
    return fx.events.select("event_id", seconds.alias("seconds")).withColumn(
        "back", timestamp_to_epoch(epoch_to_timestamp(F.col("seconds")))
    )


@query(
    "params_to_json",
    """SELECT event_id, concat('{"user":', user_id, ',"type":"', event_type, '","none":null,"list":[', event_id, ',', user_id, '],"nested":{"flag":', event_type = 'view', '}}') AS params
       FROM {events}""",
)
def params_to_json_query(fx: Fixtures):
    tree = params_to_json(
        {
            "user": F.col("user_id"),
            "type": F.col("event_type"),
            "none": F.lit(None).cast("string"),
            "list": F.array("event_id", "user_id"),
            "nested": F.struct((F.col("event_type") == "view").alias("flag")),
        }
    )
    return fx.events.select("event_id", tree.alias("params"))
