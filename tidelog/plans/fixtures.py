"""Feed, queue, attachment and subscription frames derived from the given tables.

Each text is plain SQL that Spark and DuckDB answer alike. ``{name}`` stands for a
given table or for another derived frame.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

FIXTURE_SQL = {
    "fx_oplog": """
SELECT op_id, bucket, priority, op,
       CASE WHEN op IN ('PUT','REMOVE') THEN row_type END AS row_type,
       CASE WHEN op IN ('PUT','REMOVE') THEN row_id END AS row_id,
       CASE WHEN op IN ('PUT','REMOVE') THEN subkey END AS subkey,
       CASE WHEN op = 'PUT' THEN props END AS data, checksum, ts
FROM (SELECT event_id + 1 AS op_id,
       concat('b', cast((user_id + event_id % 2) % 8 AS string)) AS bucket,
       cast(((user_id + event_id % 2) % 8) % 4 AS int) AS priority,
       CASE WHEN event_id % 499 = 250 THEN 'CLEAR' WHEN event_type = 'signup' AND event_id % 3 = 0 THEN 'MOVE'
            WHEN event_type IN ('error','view') THEN 'REMOVE' ELSE 'PUT' END AS op,
       CASE WHEN user_id % 3 = 0 THEN 'lists' WHEN user_id % 3 = 1 THEN 'todos' ELSE 'notes' END AS row_type,
       cast(user_id AS string) AS row_id,
       CASE WHEN user_id % 5 = 0 THEN concat('k', cast(cast(floor(event_id / 2) AS bigint) % 2 AS string)) END AS subkey,
       props, (event_id * 2654435761) % 4294967296 AS checksum, ts
      FROM {events}) e""",
    "fx_checkpoint": """
SELECT bucket, priority, cp AS last_op_id,
       count(*) AS target_count,
       (cast(sum(checksum) AS bigint) + (CASE WHEN bucket = 'b5' THEN 1 ELSE 0 END)) % 4294967296 AS checksum
FROM (SELECT o.*, (SELECT cast(floor(max(op_id) * 0.75) AS bigint) FROM {fx_oplog}) AS cp FROM {fx_oplog} o) x
WHERE op_id <= cp GROUP BY bucket, priority, cp""",
    "fx_crud": """
SELECT event_id AS id,
       CASE WHEN event_id % 50 = 0 THEN NULL ELSE cast(floor(event_id / 7) AS int) END AS tx_id,
       CASE event_type WHEN 'error' THEN 'DELETE' WHEN 'purchase' THEN 'PATCH' ELSE 'PUT' END AS op,
       'users' AS type, cast(user_id AS string) AS row_id,
       CASE WHEN event_type = 'error' THEN NULL ELSE props END AS data,
       CASE WHEN event_id % 211 = 0 THEN '23505' WHEN event_id % 307 = 0 THEN '08006' ELSE NULL END AS error_code
FROM {events} WHERE event_id % 97 <> 13""",
    "fx_payloads": """
SELECT id, CASE WHEN data IS NOT NULL THEN concat(substr(data, 1, length(data) - 1), ', "t": "', row_id, '", "b": ',
         CASE WHEN id % 2 = 0 THEN 'true' ELSE 'false' END, ', "r": ', cast(id AS string), '.5, "z": null, "a": [', cast(id AS string), ', "x"]', chr(125)) END AS payload
FROM {fx_crud}""",
    "fx_before": """
SELECT cast(o_orderkey AS string) AS id, o_orderstatus AS status, o_totalprice AS price, o_orderpriority AS priority
FROM {orders}""",
    "fx_after": """
SELECT cast(o_orderkey AS string) AS id,
       CASE WHEN o_orderkey % 10 = 2 THEN 'X' WHEN o_orderkey % 10 = 5 THEN NULL ELSE o_orderstatus END AS status,
       CASE WHEN o_orderkey % 10 = 1 THEN o_totalprice + 1 ELSE o_totalprice END AS price,
       o_orderpriority AS priority, o_orderkey % 10 = 3 AS touched,
       CASE WHEN o_orderkey % 10 = 1 THEN 'bump' ELSE NULL END AS _metadata
FROM {orders} WHERE o_orderkey % 10 <> 0
UNION ALL
SELECT concat('n', cast(o_orderkey AS string)), o_orderstatus, o_totalprice, CAST(NULL AS string), false, 'new'
FROM {orders} WHERE o_orderkey % 10 = 4""",
    "fx_attachments": """
SELECT cast(page_id AS string) AS id, page_id * 1000 AS timestamp, concat(cast(page_id AS string), '.html') AS filename,
       cast(page_id % 5 AS int) AS state,
       CASE WHEN page_id % 4 = 0 THEN NULL ELSE concat('attachments/', cast(page_id AS string), '.html') END AS local_uri,
       'text/html' AS media_type, cast(length(html) AS bigint) AS size, page_id % 3 = 0 AS has_synced
FROM {pages}""",
    "fx_watched": """
SELECT cast(page_id AS string) AS id, 'html' AS file_extension, CAST(NULL AS string) AS filename
FROM {pages} WHERE page_id % 2 = 0
UNION ALL
SELECT concat('new', cast(page_id AS string)), 'html', CASE WHEN page_id % 14 = 0 THEN 'named.html' ELSE NULL END
FROM {pages} WHERE page_id % 7 = 0""",
    "fx_subscription_events": """
SELECT event_id AS seq, concat('s', cast(user_id % 10 AS string)) AS stream,
       CASE WHEN event_id % 401 = 0 THEN 'unsubscribe_all' WHEN event_type = 'signup' THEN 'subscribe' ELSE 'unsubscribe' END AS kind,
       user_id AS handle, CASE WHEN user_id % 2 = 0 THEN 3600 ELSE 86400 END AS ttl, cast(user_id % 4 AS int) AS priority, ts
FROM {events} WHERE event_type IN ('signup', 'error') OR event_id % 401 = 0""",
    "fx_lists": """
SELECT cast(c_custkey AS string) AS id, c_name AS name, cast(c_nationkey AS string) AS owner_id FROM {customer}""",
    "fx_todos": """
SELECT cast(o_orderkey AS string) AS id, cast(o_custkey AS string) AS list_id, o_orderpriority AS description,
       CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS completed,
       CASE WHEN o_orderkey % 4 = 0 THEN cast(o_orderkey % 250 AS string) ELSE NULL END AS photo_id
FROM {orders}""",
    "fx_changes": """
SELECT event_id AS seq, ts, event_type AS table_name, user_id % 16 AS watcher FROM {events}""",
    "fx_bucket_state": """
SELECT c.bucket, c.priority, CASE WHEN c.bucket = 'b2' THEN 10 ELSE c.target_count END AS target_count,
       count(CASE WHEN o.op_id <= c.last_op_id * 0.5 THEN 1 END) AS at_last,
       count(CASE WHEN o.op_id > c.last_op_id * 0.5 AND o.op_id <= c.last_op_id * 0.6 THEN 1 END) AS since_last
FROM {fx_checkpoint} c JOIN {fx_oplog} o ON o.bucket = c.bucket
GROUP BY c.bucket, c.priority, c.target_count, c.last_op_id""",
    "fx_bucket_subscription": """
SELECT DISTINCT bucket, priority, concat('sub', cast(priority % 3 AS string)) AS sub FROM {fx_checkpoint}
UNION ALL SELECT 'b7', 3, 'sub1'""",
    "fx_status_events": """
SELECT event_id AS seq, user_id % 16 AS client, event_type <> 'error' AS connected,
       CASE WHEN event_type = 'purchase' AND event_id % 5 = 0 THEN 2147483647 ELSE cast(user_id % 4 AS int) END AS priority,
       CASE WHEN event_id % 29 = 0 THEN 'upload failed' END AS upload_error,
       CASE WHEN event_id % 31 = 0 THEN 'download failed' END AS download_error, ts
FROM {events}""",
    "fx_upload_rounds": """
SELECT event_id AS round_no, user_id % 16 AS client, cast(floor(event_id / 40) AS bigint) AS head_id,
       event_id AS seq_before, event_id + (CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END) AS seq_after,
       event_type = 'click' AS queue_empty,
       CASE WHEN event_id % 4 = 0 THEN event_id ELSE 9223372036854775807 END AS target_op, event_id + 1000 AS write_checkpoint
FROM {events}""",
    "fx_outcomes": """
SELECT id, cast(id AS bigint) % 3 <> 0 AS ok, cast(id AS bigint) % 2 = 0 AS retry
FROM {fx_attachments} WHERE state IN (0, 1, 2)""",
    "fx_files": """
SELECT local_uri FROM {fx_attachments} WHERE local_uri IS NOT NULL AND cast(id AS bigint) % 7 <> 0""",
}


def references(sql: str) -> list[str]:
    """Names of the tables and derived frames a text reads."""
    return sorted(set(re.findall(r"\{(\w+)\}", sql)))


class Fixtures:
    """The given tables of one folder, and the frames derived from them, by name."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._frames: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or (name not in BASE_TABLES and name not in FIXTURE_SQL):
            raise AttributeError(name)
        if name not in self._frames:
            self._frames[name] = self._load(name)
        return self._frames[name]

    def _load(self, name: str) -> DataFrame:
        if name in BASE_TABLES:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        sql = FIXTURE_SQL[name]
        return self.spark.sql(sql, **{r: getattr(self, r) for r in references(sql)})


def with_fixtures(sql: str) -> str:
    """An oracle text for DuckDB: the derived frames it reads become its WITH clause."""
    needed: list[str] = []

    def visit(name: str) -> None:
        if name in FIXTURE_SQL and name not in needed:
            for inner in references(FIXTURE_SQL[name]):
                visit(inner)
            needed.append(name)

    for name in references(sql):
        visit(name)
    plain = re.compile(r"\{(\w+)\}")
    ctes = [f"{n} AS ({plain.sub(r'\1', FIXTURE_SQL[n])})" for n in needed]
    body = plain.sub(r"\1", sql).strip()
    if not ctes:
        return body
    if body[:4].upper() == "WITH":
        head, rest = ("WITH RECURSIVE", body[14:]) if body[:14].upper() == "WITH RECURSIVE" else ("WITH", body[4:])
        return f"{head} {', '.join(ctes)}, {rest.strip()}"
    return f"WITH {', '.join(ctes)} {body}"
