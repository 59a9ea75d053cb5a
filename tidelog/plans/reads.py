"""Queries over reads, joins, writes and change notifications."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelog.functions.scalars import friendly_table_name, internal_table_name, now_epoch, now_text
from tidelog.operators import reactive, relational, writes
from tidelog.plans.fixtures import Fixtures
from tidelog.plans.registry import query

HOUR = 3_600_000_000


@query("get_all", "SELECT id, list_id, description FROM {fx_todos} WHERE completed = 1 AND description <> '5-LOW'")
def get_all(fx: Fixtures):
    fx.fx_todos.createOrReplaceTempView("tidelog_todos")
    return relational.get_all(
        fx.spark,
        "SELECT id, list_id, description FROM tidelog_todos WHERE completed = ? AND description <> ?",
        [1, "5-LOW"],
    )


@query("get_optional", "SELECT id, name FROM {fx_lists} WHERE owner_id = '3' ORDER BY name, id LIMIT 1")
def get_optional(fx: Fixtures):
    return relational.get_optional(fx.fx_lists.where(F.col("owner_id") == "3"), ["name", "id"]).select("id", "name")


@query("get_one", "SELECT id, name FROM {fx_lists} ORDER BY name DESC, id LIMIT 1")
def get_one(fx: Fixtures):
    return relational.get_one(fx.fx_lists, [F.col("name").desc(), F.col("id")]).select("id", "name")


@query(
    "dedupe_join_columns",
    """SELECT t.id, t.list_id, l.id AS "id&JOIN1", l.name, t.description AS "name&JOIN1" FROM {fx_todos} t JOIN {fx_lists} l ON l.id = t.list_id""",
)
def dedupe_join_columns(fx: Fixtures):
    todos = fx.fx_todos.select(F.col("id").alias("t_id"), F.col("list_id").alias("t_list_id"), F.col("description").alias("t_name"))
    lists = fx.fx_lists.select(F.col("id").alias("l_id"), F.col("name").alias("l_name"))
    joined = relational.lookup_join(todos.withColumn("l_id", F.col("t_list_id")), lists, ["l_id"], "inner")
    raw = joined.select("t_id", "t_list_id", "l_id", "l_name", "t_name").toDF("id", "list_id", "id", "name", "name")
    return relational.dedupe_join_columns(raw)


@query(
    "typed_getters",
    "SELECT id, completed <> 0 AS completed, CAST(photo_id AS BIGINT) AS photo_id, CAST(NULL AS VARCHAR) AS absent FROM {fx_todos}",
)
def typed_getters(fx: Fixtures):
    todos = fx.fx_todos
    return todos.select(
        relational.required(todos, "id", "string"),
        relational.required(todos, "completed", "boolean"),
        relational.optional(todos, "photo_id", "bigint"),
        relational.optional(todos, "absent", "string"),
    )


@query("filter_param", "SELECT id, list_id, description, completed, photo_id FROM {fx_todos} WHERE list_id = '7' ORDER BY id")
def filter_param(fx: Fixtures):
    return relational.filter_param(fx.fx_todos, "list_id", "7")


@query("filter_not_null", "SELECT id, photo_id FROM {fx_todos} WHERE photo_id IS NOT NULL")
def filter_not_null(fx: Fixtures):
    return relational.filter_not_null(fx.fx_todos, "photo_id")


@query(
    "left_join_group",
    """SELECT l.id, l.name, l.owner_id, count(t.id) AS n_todos FROM {fx_lists} l LEFT JOIN {fx_todos} t ON t.list_id = l.id
       GROUP BY l.id, l.name, l.owner_id""",
)
def left_join_group(fx: Fixtures):
    return relational.left_join_group(fx.fx_lists, fx.fx_todos)


@query(
    "left_join_lookup",
    """SELECT t.id, t.photo_id, a.local_uri, a.state FROM {fx_todos} t LEFT JOIN {fx_attachments} a ON a.id = t.photo_id""",
)
def left_join_lookup(fx: Fixtures):
    return relational.left_join_lookup(fx.fx_todos, fx.fx_attachments, "photo_id", ["local_uri", "state"]).select(
        "id", "photo_id", "local_uri", "state"
    )


@query(
    "inner_join_scope",
    "SELECT t.id, t.list_id, t.description FROM {fx_todos} t JOIN {fx_lists} l ON l.id = t.list_id WHERE l.owner_id = '3'",
)
def inner_join_scope(fx: Fixtures):
    return relational.inner_join_scope(fx.fx_todos, fx.fx_lists, "3").select("id", "list_id", "description")


@query("semi_in_list", "SELECT event_id, user_id FROM {events} WHERE user_id IN (3, 5, 8, 13)")
def semi_in_list(fx: Fixtures):
    return relational.semi_in_list(fx.events, "user_id", "[3,5,8,13]").select("event_id", "user_id")


@query("count_rows", "SELECT count(*) AS n FROM {fx_todos}")
def count_rows(fx: Fixtures):
    return relational.count_rows(fx.fx_todos)


@query(
    "insert_rows",
    """SELECT id, name, owner_id FROM {fx_lists} UNION ALL
       SELECT concat('s', CAST(s_suppkey AS VARCHAR)), s_name, CAST(s_nationkey AS VARCHAR) FROM {supplier}""",
)
def insert_rows(fx: Fixtures):
    rows = fx.supplier.select(
        "s_suppkey", F.col("s_name").alias("name"), F.col("s_nationkey").cast("string").alias("owner_id")
    )
    with_id = rows.select("name", "owner_id", F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("key"))
    return writes.insert_rows(fx.fx_lists, with_id.select("name", "owner_id", F.col("key").alias("id")), F.col("id"))


@query(
    "update_where",
    "SELECT id, status, CASE WHEN status = 'F' THEN price * 2 ELSE price END AS price, priority FROM {fx_before}",
)
def update_where(fx: Fixtures):
    return writes.update_where(fx.fx_before, F.col("status") == "F", {"price": F.col("price") * 2})


@query("affected_rows", "SELECT count(*) AS changes FROM {fx_before} WHERE status = 'F'")
def affected_rows(fx: Fixtures):
    return writes.affected_rows(fx.fx_before, F.col("status") == "F")


@query("delete_where", "SELECT id, list_id FROM {fx_todos} WHERE list_id NOT IN (SELECT id FROM {fx_lists} WHERE owner_id = '3')")
def delete_where(fx: Fixtures):
    kept = writes.delete_children(fx.fx_todos, fx.fx_lists, F.col("owner_id") == "3", "list_id")
    return kept.select("id", "list_id")


@query(
    "insert_or_replace",
    """SELECT id, status, price, priority FROM {fx_after}
       UNION ALL SELECT id, status, price, priority FROM {fx_before} WHERE id NOT IN (SELECT id FROM {fx_after})""",
)
def insert_or_replace(fx: Fixtures):
    return writes.insert_or_replace(fx.fx_before, fx.fx_after.select("id", "status", "price", "priority"))


@query("update_returning", "SELECT id, status, concat(priority, status) AS priority FROM {fx_before} WHERE status = 'P'")
def update_returning(fx: Fixtures):
    changed = writes.update_returning(fx.fx_before, F.col("status") == "P", {"priority": F.concat("priority", "status")})
    return changed.select("id", "status", "priority")


@query("concat_update", "SELECT id, status || priority AS content FROM {fx_before}")
def concat_update(fx: Fixtures):
    return fx.fx_before.select("id", F.concat("status", "priority").alias("content"))


@query(
    "atomic_batch",
    """SELECT id, tx_id, op FROM {fx_crud} WHERE tx_id IS NULL OR tx_id NOT IN (SELECT tx_id FROM {fx_crud} WHERE error_code IS NOT NULL AND tx_id IS NOT NULL)""",
)
def atomic_batch(fx: Fixtures):
    return writes.atomic_batch(fx.fx_crud, F.col("error_code").isNotNull()).select("id", "tx_id", "op")


@query(
    "friendly_table_name",
    """SELECT event_id, event_type AS plain, event_type AS synced, event_type AS local_only, 'ps_data__' AS bare FROM {events}""",
)
def friendly_table_name_query(fx: Fixtures):
    t = F.col("event_type")
    return fx.events.select(
        "event_id",
        friendly_table_name(t).alias("plain"),
        friendly_table_name(internal_table_name(t, F.lit(False))).alias("synced"),
        friendly_table_name(internal_table_name(t, F.lit(True))).alias("local_only"),
        friendly_table_name(F.lit("ps_data__")).alias("bare"),
    )


@query(
    "internal_table_name",
    """SELECT event_id, CASE WHEN user_id % 2 = 0 THEN concat('ps_data_local__', event_type) ELSE concat('ps_data__', event_type) END AS storage FROM {events}""",
)
def internal_table_name_query(fx: Fixtures):
    return fx.events.select("event_id", internal_table_name(F.col("event_type"), F.col("user_id") % 2 == 0).alias("storage"))


@query(
    "now_text",
    "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS text, CAST(floor(epoch(ts)) AS BIGINT) AS epoch FROM {events}",
)
def now_text_query(fx: Fixtures):
    at = F.col("ts")
    return fx.events.select("event_id", now_text(at).alias("text"), now_epoch(at.cast("timestamp")).alias("epoch"))


@query(
    "on_change",
    """SELECT watcher, CAST(epoch_us(ts) // 3600000000 AS BIGINT) AS slot, list_sort(list(DISTINCT table_name)).array_to_string(',') AS tables
       FROM {fx_changes} GROUP BY ALL""",
)
def on_change(fx: Fixtures):
    slot = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / HOUR).cast("bigint")
    stored = fx.fx_changes.withColumn("table_name", F.concat(F.lit("ps_data__"), "table_name"))
    return reactive.on_change(stored, slot, ["watcher"]).withColumn("tables", F.concat_ws(",", "tables"))


@query(
    "set_intersect",
    """WITH sets AS (SELECT watcher, CAST(epoch_us(ts) // 3600000000 AS BIGINT) AS slot, list_sort(list(DISTINCT table_name)) AS tables
                     FROM {fx_changes} GROUP BY ALL),
            shared AS (SELECT watcher, slot, list_sort(list_intersect(tables, ['click', 'view'])) AS tables FROM sets)
       SELECT watcher, slot, array_to_string(tables, ',') AS tables FROM shared WHERE len(tables) > 0""",
)
def set_intersect(fx: Fixtures):
    slot = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / HOUR).cast("bigint")
    changed = reactive.on_change(fx.fx_changes, slot, ["watcher"])
    return relational.set_intersect(changed, ["click", "view"]).withColumn("tables", F.concat_ws(",", "tables"))


# One emission follows from the one before: the pause's end, or the next event if that is later.
THROTTLED = """
 ev AS (SELECT watcher, epoch_us(ts) AS at_us, seq FROM {fx_changes} WHERE $FILTER),
 emitted(watcher, emitted_at, seq) AS (
   SELECT watcher, min(at_us), min(seq) FROM ev GROUP BY watcher
   UNION ALL
   SELECT n.watcher, n.next_at, max(v.seq) FROM (
       SELECT m.watcher, greatest(m.emitted_at + $PAUSE, min(v.at_us)) AS next_at FROM emitted m JOIN ev v ON v.watcher = m.watcher AND v.seq > m.seq
       GROUP BY m.watcher, m.emitted_at) n
     JOIN ev v ON v.watcher = n.watcher AND v.at_us <= n.next_at GROUP BY n.watcher, n.next_at)
"""


@query(
    "throttle",
    "WITH RECURSIVE " + THROTTLED.replace("$FILTER", "true").replace("$PAUSE", str(HOUR)) + " SELECT watcher, emitted_at, seq FROM emitted",
)
def throttle(fx: Fixtures):
    changes = fx.fx_changes.withColumn("at", F.unix_micros(F.col("ts").cast("timestamp")))
    return reactive.throttle(changes, "watcher", "at", "seq", HOUR).drop("n_events")


@query(
    "upload_trigger",
    "WITH RECURSIVE " + THROTTLED.replace("$FILTER", "table_name = 'purchase'").replace("$PAUSE", str(4 * HOUR)) + """
       SELECT watcher, emitted_at, seq, 'change' AS cause FROM emitted
       UNION ALL SELECT watcher, min(epoch_us(ts)), min(seq), 'first_data' FROM {fx_changes} WHERE table_name = 'view' GROUP BY watcher""",
)
def upload_trigger(fx: Fixtures):
    changes = fx.fx_changes.withColumn("at", F.unix_micros(F.col("ts").cast("timestamp")))
    first = changes.where(F.col("table_name") == "view")
    return reactive.upload_trigger(changes, first, "watcher", "at", "seq", 4 * HOUR, queue="purchase")


@query(
    "changed_only",
    """SELECT watcher, seq, table_name FROM (SELECT *, lag(table_name) OVER (PARTITION BY watcher ORDER BY seq) AS prev FROM {fx_changes})
       WHERE prev IS NULL OR prev <> table_name""",
)
def changed_only(fx: Fixtures):
    return reactive.changed_only(fx.fx_changes, ["watcher"], "seq", F.col("table_name")).select("watcher", "seq", "table_name")


@query(
    "reconnect_edges",
    """SELECT client, seq FROM (SELECT *, lag(connected) OVER (PARTITION BY client ORDER BY seq) AS was FROM {fx_status_events})
       WHERE connected AND NOT coalesce(was, false)""",
)
def reconnect_edges(fx: Fixtures):
    return reactive.reconnect_edges(fx.fx_status_events, ["client"], "seq").select("client", "seq")
