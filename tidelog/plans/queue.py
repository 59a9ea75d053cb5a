"""Queries over the upload queue and change capture."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelog.functions.json import typed_payload, typed_value
from tidelog.functions.scalars import is_fatal_error
from tidelog.operators import capture, queue, relational
from tidelog.plans.fixtures import Fixtures
from tidelog.plans.registry import query
from tidelog.schema import Column, Options, PreviousValues, RawSchema, RawTable

CAPTURED = ("status", "price", "priority")
USER_COLUMNS = [Column.integer("k")]

PAIRS = """
 pairs AS (SELECT coalesce(b.id, a.id) AS row_id, b.id IS NULL AS inserted, a.id IS NULL AS deleted,
            b.status AS bs, a.status AS s, b.price AS bp, a.price AS p, b.priority AS bpr, a.priority AS pr,
            b.status IS DISTINCT FROM a.status AS cs, b.price IS DISTINCT FROM a.price AS cp,
            b.priority IS DISTINCT FROM a.priority AS cpr, coalesce(a.touched, false) AS touched, a._metadata AS metadata
           FROM {fx_before} b FULL JOIN {fx_after} a ON a.id = b.id),
 parts AS (SELECT *,
   concat('"status":', coalesce(('"' || s || '"'), 'null')) AS js,
   concat('"price":', coalesce(CAST(p AS VARCHAR), 'null')) AS jp,
   concat('"priority":', coalesce(('"' || pr || '"'), 'null')) AS jpr,
   concat('"status":', coalesce(('"' || bs || '"'), 'null')) AS obs,
   concat('"price":', coalesce(CAST(bp AS VARCHAR), 'null')) AS obp,
   concat('"priority":', coalesce(('"' || bpr || '"'), 'null')) AS obpr FROM pairs),
 entries AS (SELECT *, CASE WHEN inserted THEN 'PUT' WHEN deleted THEN 'DELETE' ELSE 'PATCH' END AS op,
   CASE WHEN inserted THEN concat('{', concat_ws(',', CASE WHEN s IS NOT NULL THEN js END, CASE WHEN p IS NOT NULL THEN jp END, CASE WHEN pr IS NOT NULL THEN jpr END), '}')
        WHEN NOT deleted THEN concat('{', concat_ws(',', CASE WHEN cs THEN js END, CASE WHEN cp THEN jp END, CASE WHEN cpr THEN jpr END), '}') END AS data,
   CASE WHEN NOT inserted AND NOT deleted THEN concat('{', concat_ws(',', obs, obp, obpr), '}') END AS old_all,
   CASE WHEN NOT inserted AND NOT deleted THEN concat('{', concat_ws(',', CASE WHEN cs THEN obs END, CASE WHEN cp THEN obp END), '}') END AS old_changed
   FROM parts)
"""


@query(
    "capture_changes",
    f"WITH {PAIRS} SELECT op, 'orders' AS type, row_id, data FROM entries WHERE inserted OR deleted OR cs OR cp OR cpr OR touched",
)
def capture_changes(fx: Fixtures):
    return capture.capture_changes(fx.fx_before, fx.fx_after, "orders", CAPTURED, touched="touched")


@query(
    "ignore_empty_updates",
    f"WITH {PAIRS} SELECT op, 'orders' AS type, row_id, data FROM entries WHERE inserted OR deleted OR cs OR cp OR cpr",
)
def ignore_empty_updates(fx: Fixtures):
    options = Options(ignore_empty_updates=True)
    return capture.capture_changes(fx.fx_before, fx.fx_after, "orders", CAPTURED, options, touched="touched")


@query(
    "previous_values",
    f"WITH {PAIRS} SELECT op, row_id, data, old_all AS old FROM entries WHERE inserted OR deleted OR cs OR cp OR cpr",
)
def previous_values(fx: Fixtures):
    options = Options(previous_values=PreviousValues())
    return capture.capture_changes(fx.fx_before, fx.fx_after, "orders", CAPTURED, options).drop("type")


@query(
    "previous_values_changed",
    f"WITH {PAIRS} SELECT op, row_id, data, old_changed AS old FROM entries WHERE inserted OR deleted OR cs OR cp OR cpr",
)
def previous_values_changed(fx: Fixtures):
    options = Options(previous_values=PreviousValues(columns=("status", "price"), only_when_changed=True))
    return capture.capture_changes(fx.fx_before, fx.fx_after, "orders", CAPTURED, options).drop("type")


@query(
    "metadata_column",
    f"WITH {PAIRS} SELECT op, row_id, metadata FROM entries WHERE inserted OR deleted OR cs OR cp OR cpr",
)
def metadata_column(fx: Fixtures):
    options = Options(track_metadata=True)
    return capture.capture_changes(fx.fx_before, fx.fx_after, "orders", CAPTURED, options).select(
        "op", "row_id", "metadata"
    )


@query(
    "raw_capture",
    """WITH """ + PAIRS + """ SELECT op, row_id,
         CASE WHEN inserted THEN CASE WHEN s IS NULL THEN '{}' ELSE concat('{', js, '}') END
              WHEN NOT deleted THEN concat('{', js, '}') END AS data FROM entries WHERE inserted OR deleted OR cs""",
)
def raw_capture(fx: Fixtures):
    raw = RawTable("orders", schema=RawSchema(synced_columns=("status",), options=Options(ignore_empty_updates=True)))
    return capture.capture_raw(fx.fx_before, fx.fx_after, raw).drop("type")


# The oracle's fold of entries onto customers: last DELETE, first PUT after it, last write.
APPLIED = """
 base AS (SELECT CAST(c_custkey AS VARCHAR) AS id, CAST(c_nationkey AS BIGINT) AS k FROM {customer}),
 dels AS (SELECT row_id, max(id) AS d FROM crud WHERE op = 'DELETE' GROUP BY row_id),
 tail AS (SELECT c.*, d FROM crud c LEFT JOIN dels ON c.row_id = dels.row_id WHERE c.op <> 'DELETE' AND (d IS NULL OR c.id > d)),
 born AS (SELECT row_id, min(id) FILTER (op = 'PUT') AS born FROM tail GROUP BY row_id),
 rows_after AS (SELECT coalesce(b.id, n.row_id) AS id, b.id IS NOT NULL AND x.d IS NULL AS lives, n.born, b.k AS base_k
   FROM base b FULL JOIN born n ON b.id = n.row_id LEFT JOIN dels x ON x.row_id = coalesce(b.id, n.row_id)),
 last_set AS (SELECT r.id, arg_max(CAST(json_extract_string(t.data, '$.k') AS BIGINT), t.id) AS k
   FROM rows_after r JOIN tail t ON t.row_id = r.id AND (r.lives OR t.id >= r.born) GROUP BY r.id),
 applied AS (SELECT r.id, coalesce(l.k, CASE WHEN r.lives THEN r.base_k END) AS k
   FROM rows_after r LEFT JOIN last_set l ON l.id = r.id WHERE r.lives OR r.born IS NOT NULL)
"""


def _users(fx: Fixtures):
    return fx.customer.select(F.col("c_custkey").cast("string").alias("id"), F.col("c_nationkey").cast("bigint").alias("k"))


@query("apply_crud", "WITH crud AS (SELECT * FROM {fx_crud}), " + APPLIED + "SELECT * FROM applied")
def apply_crud(fx: Fixtures):
    return capture.apply_crud(_users(fx), fx.fx_crud, USER_COLUMNS)


@query(
    "apply_captured",
    "SELECT id, status, price, priority FROM {fx_after}",
)
def apply_captured(fx: Fixtures):
    entries = capture.capture_changes(fx.fx_before, fx.fx_after, "orders", CAPTURED).withColumn("id", F.lit(1).cast("bigint"))
    return capture.apply_crud(
        fx.fx_before, entries, [Column.text("status"), Column.real("price"), Column.text("priority")]
    )


@query(
    "optimistic_view",
    "WITH crud AS (SELECT * FROM {fx_crud} WHERE id > (SELECT max(id) // 2 FROM {fx_crud})), " + APPLIED + "SELECT * FROM applied",
)
def optimistic_view(fx: Fixtures):
    half = fx.fx_crud.agg(F.floor(F.max("id") / 2).alias("h")).scalar()
    return capture.optimistic_view(_users(fx), queue_after(fx, half), USER_COLUMNS)


def queue_after(fx: Fixtures, position):
    return fx.fx_crud.where(F.col("id") > position)


@query(
    "crud_scan",
    """SELECT id AS client_id, tx_id, op, type AS table_name, row_id, replace(data, ': ', ':') AS op_data,
              CAST(NULL AS VARCHAR) AS old, CAST(NULL AS VARCHAR) AS metadata FROM {fx_crud}""",
)
def crud_scan(fx: Fixtures):
    return queue.crud_scan(entry_texts(fx))


def entry_texts(fx: Fixtures):
    """The queue as it is stored: ``(id, tx_id, data)`` with the JSON text of each entry."""
    text = F.concat(
        F.lit('{"op":"'), "op", F.lit('","type":"'), "type", F.lit('","id":"'), "row_id", F.lit('"'),
        F.coalesce(F.concat(F.lit(',"data":'), "data"), F.lit("")), F.lit("}"),
    )
    return fx.fx_crud.select("id", "tx_id", text.alias("data"))


RUNS = """
 flagged AS (SELECT *, CASE WHEN tx_id IS NOT NULL AND tx_id = lag(tx_id) OVER (ORDER BY id) AND id = lag(id) OVER (ORDER BY id) + 1
                            THEN 0 ELSE 1 END AS starts FROM {fx_crud}),
 runs AS (SELECT *, sum(starts) OVER (ORDER BY id) AS run FROM flagged),
 txs AS (SELECT run, any_value(tx_id) AS tx_id, min(id) AS first_id, max(id) AS last_id, count(*) AS n_entries,
                min(id) FILTER (error_code IS NOT NULL) AS first_error_id, arg_min(error_code, id) FILTER (error_code IS NOT NULL) AS first_code
         FROM runs GROUP BY run)
"""


@query("crud_transactions", f"WITH {RUNS} SELECT tx_id, first_id, last_id, n_entries FROM txs")
def crud_transactions(fx: Fixtures):
    return queue.crud_transactions(fx.fx_crud)


@query(
    "take_until_size",
    f"""WITH {RUNS}, cum AS (SELECT *, coalesce(sum(n_entries) OVER (ORDER BY first_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before_n FROM txs)
        SELECT tx_id, first_id, last_id, n_entries, CAST(before_n AS BIGINT) AS taken_before FROM cum WHERE before_n < 100""",
)
def take_until_size(fx: Fixtures):
    return queue.take_until_size(queue.crud_transactions(fx.fx_crud), 100)


@query(
    "next_transaction",
    f"WITH {RUNS} SELECT tx_id, first_id, last_id, n_entries FROM txs ORDER BY first_id LIMIT 1",
)
def next_transaction(fx: Fixtures):
    return queue.next_transaction(fx.fx_crud)


@query(
    "crud_batch",
    """SELECT id, tx_id, op, row_id, (SELECT count(*) > 100 FROM {fx_crud}) AS has_more FROM {fx_crud} ORDER BY id LIMIT 100""",
)
def crud_batch(fx: Fixtures):
    return queue.crud_batch(fx.fx_crud, 100).select("id", "tx_id", "op", "row_id", "has_more")


@query("complete_upto", "SELECT id, tx_id, op FROM {fx_crud} WHERE id > 500")
def complete_upto(fx: Fixtures):
    return queue.complete_upto(fx.fx_crud, 500).select("id", "tx_id", "op")


@query(
    "local_target",
    "SELECT CASE WHEN (SELECT count(*) FROM {fx_crud} WHERE id > 900000000) = 0 THEN 77 ELSE 9223372036854775807 END AS target_op",
)
def local_target(fx: Fixtures):
    return queue.local_target(queue.complete_upto(fx.fx_crud, 900000000), 77)


@query(
    "update_local_target",
    """SELECT round_no, target_op = 9223372036854775807 AND queue_empty AND seq_before = seq_after AS updated,
              CASE WHEN target_op = 9223372036854775807 AND queue_empty AND seq_before = seq_after THEN write_checkpoint ELSE target_op END AS new_target
       FROM {fx_upload_rounds}""",
)
def update_local_target(fx: Fixtures):
    return queue.update_local_target(fx.fx_upload_rounds).select("round_no", "updated", "new_target")


@query(
    "upload_outcome",
    f"""WITH {RUNS} SELECT tx_id, first_id, n_entries, first_error_id,
          CASE WHEN first_code IS NULL THEN 'completed' WHEN regexp_matches(first_code, '^(22...|23...|42501)$') THEN 'discarded' ELSE 'retry' END AS outcome
        FROM txs""",
)
def upload_outcome(fx: Fixtures):
    return queue.upload_outcome(fx.fx_crud)


@query(
    "stalled_queue",
    """SELECT client, round_no, head_id, coalesce(lag(head_id) OVER (PARTITION BY client ORDER BY round_no) = head_id, false) AS stalled
       FROM {fx_upload_rounds}""",
)
def stalled_queue(fx: Fixtures):
    return queue.stalled_queue(fx.fx_upload_rounds).select("client", "round_no", "head_id", "stalled")


@query(
    "queue_stats",
    """SELECT count(*) AS entries, CAST(coalesce(sum(strlen(data)), 0) AS BIGINT) AS size_bytes,
              CAST(coalesce(sum(strlen(data)), 0) // 1024 AS BIGINT) AS size_kb FROM {fx_crud}""",
)
def queue_stats(fx: Fixtures):
    return queue.queue_stats(fx.fx_crud)


@query("exists_any", "SELECT count(*) > 0 AS found FROM {fx_crud}")
def exists_any(fx: Fixtures):
    return queue.exists_any(fx.fx_crud)


@query("queue_head", "SELECT id, tx_id, op, row_id FROM {fx_crud} ORDER BY id LIMIT 1")
def queue_head(fx: Fixtures):
    return queue.queue_head(fx.fx_crud).select("id", "tx_id", "op", "row_id")


@query("limit_plus_one", "SELECT id, tx_id FROM {fx_crud} ORDER BY id LIMIT 101")
def limit_plus_one(fx: Fixtures):
    return fx.fx_crud.select("id", "tx_id").orderBy("id").limit(100 + 1)


@query(
    "recursive_union_all",
    """WITH RECURSIVE walk AS (
         SELECT id, tx_id, op FROM {fx_crud} WHERE id = 21
         UNION ALL SELECT c.id, c.tx_id, c.op FROM walk w JOIN {fx_crud} c ON c.id = w.id + 1 AND c.tx_id = w.tx_id)
       SELECT * FROM walk""",
)
def recursive_union_all(fx: Fixtures):
    return queue.walk_transaction(fx.fx_crud.select("id", "tx_id", "op"), 21)


@query(
    "fatal_error_code",
    """SELECT id, coalesce(regexp_matches(error_code, '^(22...|23...|42501)$'), false) AS fatal FROM {fx_crud}""",
)
def fatal_error_code(fx: Fixtures):
    return fx.fx_crud.select("id", is_fatal_error(F.col("error_code")).alias("fatal"))


@query(
    "typed_json_value",
    """WITH members AS (SELECT id, name, json_extract_string(payload, '$.' || name) AS v,
            CASE json_type(payload, '$.' || name) WHEN 'NULL' THEN 'null' WHEN 'VARCHAR' THEN 'text' WHEN 'BOOLEAN' THEN 'flag'
              WHEN 'DOUBLE' THEN 'real' WHEN 'ARRAY' THEN 'nested' ELSE 'whole' END AS kind
          FROM (SELECT id, payload, unnest(json_keys(payload)) AS name FROM {fx_payloads}) p)
       SELECT id, name, kind, CASE WHEN kind IN ('text', 'nested') THEN v END AS text, CASE WHEN kind = 'flag' THEN CAST(v AS BOOLEAN) END AS flag,
              CASE WHEN kind = 'real' THEN CAST(v AS DOUBLE) END AS real, CASE WHEN kind = 'whole' THEN CAST(v AS BIGINT) END AS whole
       FROM members""",
)
def typed_json_value(fx: Fixtures):
    """Every member of every payload: texts that look like numbers, flags, reals, nulls, arrays and whole numbers."""
    members = fx.fx_payloads.select("id", F.explode(typed_payload(F.col("payload"))).alias("name", "value"))
    return members.select("id", "name", typed_value(F.col("value")).alias("v")).select("id", "name", "v.*")


@query(
    "self_join_next",
    "SELECT a.id, a.tx_id, b.id AS next_id FROM {fx_crud} a JOIN {fx_crud} b ON b.id = a.id + 1 AND b.tx_id = a.tx_id",
)
def self_join_next(fx: Fixtures):
    return relational.self_join_next(fx.fx_crud)


@query("min_after", "SELECT min(id) AS next_id FROM {fx_crud} WHERE id > 500")
def min_after(fx: Fixtures):
    return relational.min_after(fx.fx_crud, 500)
