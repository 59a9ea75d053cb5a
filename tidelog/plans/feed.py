"""Queries over the op feed: scans, folds, checkpoints and checksums."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelog.functions.json import json_columns, json_extract_cast
from tidelog.operators import feed, history, tables, timeline
from tidelog.operators.skew import lookup_join
from tidelog.plans.fixtures import Fixtures
from tidelog.plans.registry import query
from tidelog.schema import ID, REST, Column, RawSchema, RawTable, Schema, Table, from_column
from tidelog.sources import lines

LISTS = Table("lists", [Column.integer("k"), Column.text("missing")])
DECLARED = Schema([LISTS, Table("todos", [Column.integer("k")])])

# The oracle's fold: newest op per key, then the newest surviving PUT per row.
FOLD = """
 newest AS (SELECT bucket, row_type, row_id, subkey, max(op_id) AS newest, max(op_id) FILTER (op = 'PUT') AS put
            FROM visible WHERE op IN ('PUT', 'REMOVE') GROUP BY ALL),
 clears AS (SELECT bucket, max(op_id) AS cleared FROM visible WHERE op = 'CLEAR' GROUP BY bucket),
 held AS (SELECT n.* FROM newest n LEFT JOIN clears c ON n.bucket = c.bucket
          WHERE newest = put AND (cleared IS NULL OR put > cleared)),
 folded AS (SELECT row_type, row_id, max(put) AS op_id FROM held GROUP BY ALL),
 current AS (SELECT f.row_type, f.row_id, o.data FROM folded f JOIN {fx_oplog} o ON o.op_id = f.op_id)
"""
CUT = "SELECT * FROM {fx_oplog} WHERE op_id <= (SELECT max(last_op_id) FROM {fx_checkpoint}) AND bucket IN (SELECT bucket FROM {fx_checkpoint})"


@query(
    "sync_lines_scan",
    """SELECT kind, count(*) AS n FROM (
         SELECT 'data' AS kind FROM (SELECT DISTINCT bucket, (op_id // 100) AS l FROM {fx_oplog})
         UNION ALL SELECT 'checkpoint_complete' FROM {fx_checkpoint}
         UNION ALL SELECT 'malformed' FROM {fx_checkpoint}
         UNION ALL SELECT CASE WHEN priority = 0 THEN 'token_expires_in' ELSE 'unknown' END FROM {fx_checkpoint})
       GROUP BY kind""",
)
def sync_lines_scan(fx: Fixtures):
    data = lines.lines_of_ops(fx.fx_oplog).select("value")
    marks = fx.fx_checkpoint
    complete = F.to_json(F.struct(F.struct(F.col("last_op_id").cast("string").alias("last_op_id")).alias("checkpoint_complete")))
    other = F.when(F.col("priority") == 0, '{"token_expires_in":60}').when(
        F.col("priority") == 1, '{"checkpoint_complete":{},"data":{}}'
    ).otherwise('{"something_else":1}')
    feed_lines = (
        data.unionByName(marks.select(complete.alias("value")))
        .unionByName(marks.select(F.substring(complete, 1, 20).alias("value")))
        .unionByName(marks.select(other.alias("value")))
    )
    return lines.classify_lines(feed_lines).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query(
    "oplog_explode",
    """SELECT bucket, op_id, op, row_type, row_id, subkey, data, checksum FROM {fx_oplog}""",
)
def oplog_explode(fx: Fixtures):
    return lines.explode_ops(lines.classify_lines(lines.lines_of_ops(fx.fx_oplog).select("value")))


@query(
    "checkpoint_explode",
    """SELECT bucket, CASE WHEN priority = 3 THEN 3 ELSE priority END AS priority, checksum, target_count,
              last_op_id, last_op_id + 1 AS write_checkpoint FROM {fx_checkpoint}""",
)
def checkpoint_explode(fx: Fixtures):
    bucket = F.struct(
        "bucket",
        F.when(F.col("priority") != 3, F.col("priority")).alias("priority"),
        "checksum",
        F.col("target_count").alias("count"),
    )
    content = F.struct(
        F.col("last_op_id").cast("string").alias("last_op_id"),
        (F.col("last_op_id") + 1).cast("string").alias("write_checkpoint"),
        F.array(bucket).alias("buckets"),
    )
    text = fx.fx_checkpoint.select(F.to_json(F.struct(content.alias("checkpoint"))).alias("value"))
    return lines.explode_checkpoints(lines.classify_lines(text)).drop("subscriptions")


@query(
    "json_table_view",
    f"""WITH visible AS ({CUT}), {FOLD}
        SELECT row_id AS id, CAST(json_extract_string(data, '$.k') AS BIGINT) AS k, CAST(NULL AS VARCHAR) AS missing
        FROM current WHERE row_type = 'lists'""",
)
def json_table_view(fx: Fixtures):
    return tables.table_view(feed.checkpoint_rows(fx.fx_oplog, fx.fx_checkpoint), LISTS)


@query(
    "table_modes",
    """SELECT row_id AS id, op_id, mode <> 'insert' AS readable, mode <> 'local' AS queued,
              concat(CASE WHEN mode = 'local' THEN 'ps_data_local__' ELSE 'ps_data__' END, row_type) AS storage
       FROM (SELECT *, CASE row_type WHEN 'lists' THEN 'synced' WHEN 'todos' THEN 'local' ELSE 'insert' END AS mode
             FROM {fx_oplog} WHERE op = 'PUT')""",
)
def table_modes(fx: Fixtures):
    mode = F.when(F.col("row_type") == "lists", "synced").when(F.col("row_type") == "todos", "local").otherwise("insert")
    rows = fx.fx_oplog.where(F.col("op") == "PUT").withColumn("mode", mode)
    return tables.table_modes(rows).select(F.col("row_id").alias("id"), "op_id", "readable", "queued", "storage")


RAW_LISTS = RawTable("lists", put={"id": ID, "k": from_column("k"), "_rest": REST})


@query(
    "raw_table_put",
    """SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS k,
              concat('{"status":"', o_orderstatus, '","prio":"', o_orderpriority, '"}') AS _rest FROM {orders}""",
)
def raw_table_put(fx: Fixtures):
    data = F.to_json(
        F.struct(
            F.col("o_custkey").alias("k"),
            F.col("o_orderstatus").alias("status"),
            F.col("o_orderpriority").alias("prio"),
        )
    )
    rows = fx.orders.select(F.col("o_orderkey").cast("string").alias("id"), data.alias("data"))
    return tables.raw_table_put(rows, RAW_LISTS)


@query(
    "raw_table_infer",
    f"""WITH visible AS ({CUT}), {FOLD}
        SELECT row_id AS id, CAST(json_extract_string(data, '$.k') AS BIGINT) AS k, c_mktsegment AS local_note
        FROM current LEFT JOIN {{customer}} ON CAST(c_custkey AS VARCHAR) = row_id WHERE row_type = 'lists'""",
)
def raw_table_infer(fx: Fixtures):
    existing = _raw_lists(fx)
    rows = feed.checkpoint_rows(fx.fx_oplog, fx.fx_checkpoint).where(F.col("row_type") == "lists")
    raw = RawTable("lists", schema=RawSchema(synced_columns=("k",)))
    return tables.raw_table_infer(existing, rows.select(F.col("row_id").alias("id"), "data"), raw)


def _raw_lists(fx: Fixtures):
    return fx.customer.select(
        F.col("c_custkey").cast("string").alias("id"),
        F.col("c_nationkey").cast("bigint").alias("k"),
        F.col("c_mktsegment").alias("local_note"),
    )


@query(
    "raw_table_delete",
    "WITH visible AS (SELECT * FROM {fx_oplog}), " + FOLD + """
       SELECT CAST(c_custkey AS VARCHAR) AS id, CAST(c_nationkey AS BIGINT) AS k, c_mktsegment AS local_note FROM {customer}
       WHERE CAST(c_custkey AS VARCHAR) NOT IN (SELECT row_id FROM {fx_oplog} WHERE row_type = 'lists' AND op IN ('PUT', 'REMOVE')
                                                EXCEPT SELECT row_id FROM current WHERE row_type = 'lists')""",
)
def raw_table_delete(fx: Fixtures):
    """Rows of the log that no bucket holds any more leave the raw table."""
    lists = F.col("row_type") == "lists"
    known = fx.fx_oplog.where(lists & F.col("op").isin("PUT", "REMOVE")).select("row_type", "row_id").distinct()
    removed = known.join(feed.apply_oplog(fx.fx_oplog).where(lists), ["row_type", "row_id"], "left_anti")
    raw = RawTable("lists", schema=RawSchema(), delete={"id": ID})
    return tables.raw_table_delete(_raw_lists(fx), removed.select(F.col("row_id").alias("id")), raw)


@query(
    "raw_table_clear",
    """SELECT CAST(c_custkey AS VARCHAR) AS id, CAST(c_nationkey AS BIGINT) AS k, c_mktsegment AS local_note
       FROM {customer} WHERE NOT coalesce(c_nationkey < 10, false)""",
)
def raw_table_clear(fx: Fixtures):
    return tables.raw_table_clear(_raw_lists(fx), RawTable("lists", schema=RawSchema(), clear="k < 10"))


@query("apply_oplog", "WITH visible AS (SELECT * FROM {fx_oplog}), " + FOLD + "SELECT * FROM current")
def apply_oplog(fx: Fixtures):
    return feed.apply_oplog(fx.fx_oplog)


@query(
    "lww_latest",
    """SELECT bucket, row_type, row_id, subkey, max(op_id) AS op_id, arg_max(op, op_id) AS op
       FROM {fx_oplog} WHERE op IN ('PUT', 'REMOVE') GROUP BY ALL""",
)
def lww_latest(fx: Fixtures):
    return feed.lww_latest(fx.fx_oplog).select("bucket", "row_type", "row_id", "subkey", "op_id", "op")


@query("checkpoint_cut", f"WITH visible AS ({CUT}), {FOLD} SELECT * FROM current")
def checkpoint_cut(fx: Fixtures):
    return feed.checkpoint_rows(fx.fx_oplog, fx.fx_checkpoint)


@query("checkpoint_ops", "SELECT bucket, op_id, op, row_id FROM (" + CUT + ")")
def checkpoint_ops(fx: Fixtures):
    return feed.checkpoint_cut(fx.fx_oplog, fx.fx_checkpoint).select("bucket", "op_id", "op", "row_id")


@query(
    "partial_checkpoint",
    """WITH cuts AS (SELECT bucket, CASE WHEN priority <= 1 THEN last_op_id ELSE last_op_id // 2 END AS cut FROM {fx_checkpoint}),
       visible AS (SELECT o.* FROM {fx_oplog} o JOIN cuts c ON o.bucket = c.bucket AND o.op_id <= c.cut), """
    + FOLD
    + "SELECT * FROM current",
)
def partial_checkpoint(fx: Fixtures):
    published = fx.fx_checkpoint.withColumn("last_op_id", F.floor(F.col("last_op_id") / 2))
    return feed.partial_checkpoint(fx.fx_oplog, fx.fx_checkpoint, 1, published)


def _updates(fx: Fixtures):
    """Buckets of priority 1 grown by ten ops, and a new bucket for each of priority 2."""
    c = fx.fx_checkpoint
    grown = c.where(F.col("priority") == 1).withColumn("target_count", F.col("target_count") + 10)
    new = c.where(F.col("priority") == 2).withColumn("bucket", F.concat(F.lit("new-"), "bucket"))
    return grown.unionByName(new)


@query(
    "checkpoint_diff",
    """WITH updated AS (SELECT bucket, priority, target_count + 10 AS target_count, checksum FROM {fx_checkpoint} WHERE priority = 1
                        UNION ALL SELECT concat('new-', bucket), priority, target_count, checksum FROM {fx_checkpoint} WHERE priority = 2)
       SELECT *, CAST(900001 AS BIGINT) AS last_op_id, CAST(7 AS BIGINT) AS write_checkpoint FROM (
         SELECT bucket, priority, target_count, checksum FROM {fx_checkpoint}
         WHERE priority <> 0 AND bucket NOT IN (SELECT bucket FROM updated)
         UNION ALL SELECT * FROM updated)""",
)
def checkpoint_diff(fx: Fixtures):
    removed = fx.fx_checkpoint.where(F.col("priority") == 0)
    return feed.checkpoint_diff(fx.fx_checkpoint, _updates(fx), removed, 900001, 7)


@query(
    "anti_removed",
    """SELECT bucket, at_last, since_last FROM {fx_bucket_state}
       WHERE bucket NOT IN (SELECT bucket FROM {fx_checkpoint} WHERE priority = 0)""",
)
def anti_removed(fx: Fixtures):
    removed = fx.fx_checkpoint.where(F.col("priority") == 0)
    return feed.anti_removed(fx.fx_bucket_state, removed).select("bucket", "at_last", "since_last")


# A feed of checkpoint lines: every 50th event is a full checkpoint of three buckets, every
# other event a diff of one bucket, which it removes when the user id is a multiple of 3.
HISTORY_ENTRIES = """
  SELECT event_id AS seq, concat('h', CAST((user_id + d) % 7 AS VARCHAR)) AS bucket, CAST(user_id % 4 AS INTEGER) AS priority,
         event_id + d AS target_count, user_id AS checksum, false AS removed, true AS full_line
  FROM {events}, (SELECT unnest([0, 1, 2]) AS d) WHERE event_id % 50 = 0
  UNION ALL
  SELECT event_id, concat('h', CAST(user_id % 7 AS VARCHAR)), CAST(user_id % 4 AS INTEGER), event_id, user_id,
         user_id % 3 = 0, false
  FROM {events} WHERE event_id % 50 <> 0
"""


@query(
    "checkpoint_history",
    "WITH entries AS (" + HISTORY_ENTRIES + """),
     lines AS (SELECT seq, full_line, row_number() OVER (ORDER BY seq) - 1 AS line_no, count(*) OVER () AS n_lines
               FROM (SELECT DISTINCT seq, full_line FROM entries)),
     ahead AS (SELECT seq, line_no, n_lines, min(CASE WHEN full_line THEN line_no END)
                 OVER (ORDER BY seq ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_full FROM lines),
     placed AS (SELECT e.*, line_no, least(coalesce(lead(line_no) OVER (PARTITION BY bucket ORDER BY e.seq), n_lines), coalesce(next_full, n_lines)) AS to_line
                FROM entries e JOIN ahead a ON a.seq = e.seq)
     SELECT seq, line_no AS from_line, to_line, bucket, priority, target_count, checksum FROM placed WHERE NOT removed""",
)
def checkpoint_history(fx: Fixtures):
    """Every event is a checkpoint line; each entry with the lines it is in force."""
    return history.checkpoint_intervals(*_checkpoint_lines(fx, 1))


def _checkpoint_lines(fx: Fixtures, every: int):
    def columns(offset):
        return [
            F.col("event_id").alias("seq"),
            F.concat(F.lit("h"), ((F.col("user_id") + offset) % 7).cast("string")).alias("bucket"),
            (F.col("user_id") % 4).cast("int").alias("priority"),
            (F.col("event_id") + offset).alias("target_count"),
            F.col("user_id").alias("checksum"),
        ]

    number = F.col("event_id")
    full = fx.events.where(number % 50 == 0).withColumn("d", F.explode(F.sequence(F.lit(0), F.lit(2))))
    diffs = fx.events.where((number % every == 0) & (number % 50 != 0))
    return full.select(*columns(F.col("d"))), diffs.select(*columns(F.lit(0)), (F.col("user_id") % 3 == 0).alias("removed"))


@query("feed_timeline")
def feed_timeline(fx: Fixtures):
    """Every event is a line: checkpoints and diffs as above, some completions, the rest data.

    Whether a bucket starts over depends on all its lines before, so there is no plain SQL; the
    operator is compared with a line-by-line replay on small feeds.
    """
    full, diffs = _checkpoint_lines(fx, 10)
    targets = full.withColumns({"removed": F.lit(False), "full": F.lit(True)}).unionByName(
        diffs.withColumn("full", F.lit(False))
    )
    number = F.col("event_id")
    others = fx.events.where(number % 10 != 0)
    done = others.where(number % 35 == 17).select(number.alias("seq"))
    data = others.where(number % 35 != 17).select(
        number.alias("seq"),
        F.concat(F.lit("h"), (F.col("user_id") % 7).cast("string")).alias("bucket"),
        (number % 5).alias("ops"),
    )
    return timeline.feed_timeline(targets.drop("checksum"), data, done, (0, 1, 3))


@query(
    "bucket_checksum",
    """SELECT c.bucket, c.checksum AS expected, CAST(sum(o.checksum) % 4294967296 AS BIGINT) AS actual,
              count(*) AS op_count, c.checksum = sum(o.checksum) % 4294967296 AS valid
       FROM {fx_checkpoint} c JOIN {fx_oplog} o ON o.bucket = c.bucket AND o.op_id <= c.last_op_id
       GROUP BY c.bucket, c.checksum""",
)
def bucket_checksum(fx: Fixtures):
    return feed.bucket_checksums(fx.fx_oplog, fx.fx_checkpoint)


@query(
    "op_clear_move",
    """SELECT o.op_id, o.bucket, o.op, o.row_type, o.row_id FROM {fx_oplog} o
       LEFT JOIN (SELECT bucket, max(op_id) AS cleared FROM {fx_oplog} WHERE op = 'CLEAR' GROUP BY bucket) c ON o.bucket = c.bucket
       WHERE op IN ('PUT', 'REMOVE') AND (cleared IS NULL OR op_id > cleared)""",
)
def op_clear_move(fx: Fixtures):
    return feed.visible_ops(fx.fx_oplog).select("op_id", "bucket", "op", "row_type", "row_id")


@query(
    "compact_oplog",
    """WITH clears AS (SELECT bucket, max(op_id) AS cleared FROM {fx_oplog} WHERE op = 'CLEAR' GROUP BY bucket),
       newest AS (SELECT bucket, max(op_id) AS op_id FROM {fx_oplog} WHERE op IN ('PUT', 'REMOVE')
                  GROUP BY bucket, row_type, row_id, subkey),
       keep AS (SELECT op_id FROM newest n LEFT JOIN clears c ON n.bucket = c.bucket WHERE cleared IS NULL OR op_id > cleared
                UNION ALL SELECT cleared FROM clears),
       dropped AS (SELECT bucket, CAST(sum(checksum) % 4294967296 AS BIGINT) AS dropped_sum, CAST(count(*) AS BIGINT) AS dropped_count
                FROM {fx_oplog} WHERE op_id NOT IN (SELECT op_id FROM keep) GROUP BY bucket)
       SELECT op_id, o.bucket, op, row_type, row_id, subkey, data, checksum, coalesce(dropped_sum, 0) AS dropped_sum, coalesce(dropped_count, 0) AS dropped_count
       FROM {fx_oplog} o LEFT JOIN dropped d ON d.bucket = o.bucket WHERE op_id IN (SELECT op_id FROM keep)""",
)
def compact_oplog(fx: Fixtures):
    kept = feed.compact_oplog(fx.fx_oplog).select("op_id", "bucket", "op", "row_type", "row_id", "subkey", "data", "checksum")
    dropped = feed.dropped_sums(fx.fx_oplog, kept).select(
        "bucket", F.col("actual").alias("dropped_sum"), F.col("op_count").alias("dropped_count")
    )
    return lookup_join(kept, dropped, ["bucket"], "left", spread=F.xxhash64("op_id"))


@query(
    "local_gate",
    """SELECT round_no, queue_empty AND write_checkpoint >= target_op AS publishable FROM {fx_upload_rounds}""",
)
def local_gate(fx: Fixtures):
    return feed.gate_checkpoints(fx.fx_upload_rounds).select("round_no", "publishable")


@query(
    "untyped_rows",
    "WITH visible AS (SELECT * FROM {fx_oplog}), " + FOLD + "SELECT * FROM current WHERE row_type NOT IN ('lists', 'todos')",
)
def untyped_rows(fx: Fixtures):
    return feed.untyped_rows(feed.apply_oplog(fx.fx_oplog), DECLARED)


@query(
    "clear_state",
    """SELECT 'rows' AS part, CAST(0 AS BIGINT) AS n UNION ALL SELECT 'crud', 0
       UNION ALL SELECT 'local_rows', count(*) FROM {fx_attachments}
       UNION ALL SELECT 'oplog', count(*) FROM {fx_oplog} UNION ALL SELECT 'buckets', count(*) FROM {fx_checkpoint}""",
)
def clear_state(fx: Fixtures):
    state = feed.clear_state(
        {
            "rows": fx.fx_lists,
            "crud": fx.fx_crud,
            "local_rows": fx.fx_attachments,
            "oplog": fx.fx_oplog,
            "buckets": fx.fx_checkpoint,
        },
        soft=True,
    )
    counted = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("part"), "n") for name, df in state.items()
    ]
    out = counted[0]
    for part in counted[1:]:
        out = out.unionByName(part)
    return out


@query(
    "json_extract_cast",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
              CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k_real, json_extract_string(props, '$.k') AS k_text FROM {events}""",
)
def json_extract_cast_query(fx: Fixtures):
    data = F.col("props")
    return fx.events.select(
        "event_id",
        json_extract_cast(data, Column.integer("k")).alias("k"),
        json_extract_cast(data, Column.real("k")).alias("k_real"),
        *[c.alias("k_text") for c in json_columns(data, [Column.text("k")])],
    )
