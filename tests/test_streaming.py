"""File and stream edges: state versions, the arriving feed, watched queries, transfers."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from tidelog.schema import Column, Schema, Table
from tidelog.sources.files import list_files, local_files, transfer_files, transfer_plan
from tidelog.sources.lines import classify_lines, explode_ops, number_lines, read_lines
from tidelog.sources.state import StateStore
from tidelog.streaming.feed import FeedApplier, start_feed
from tidelog.streaming.subscriptions import ROCKSDB, track_subscriptions
from tidelog.streaming.throttle import throttle_stream
from tidelog.streaming.watch import on_change_stream, source_tables, watch

SCHEMA = Schema([Table("users", [Column.text("name")])])


def put(bucket, op_id, row_id, name, op="PUT", row_type="users"):
    entry = {"checksum": 1, "op_id": str(op_id), "object_id": row_id, "object_type": row_type, "op": op}
    if op == "PUT":
        entry["data"] = json.dumps({"name": name})
    return {"data": {"bucket": bucket, "data": [entry]}}


def bucket(name, priority=3, count=1):
    return {"bucket": name, "priority": priority, "checksum": count, "count": count}


def checkpoint(last, *buckets):
    return {"checkpoint": {"last_op_id": str(last), "buckets": list(buckets)}}


def complete(last, priority=None):
    if priority is None:
        return {"checkpoint_complete": {"last_op_id": str(last)}}
    return {"partial_checkpoint_complete": {"last_op_id": str(last), "priority": priority}}


class Feed:
    """Pushes files of lines into a folder and applies what has arrived."""

    def __init__(self, spark, tmp_path):
        self.lines, self.n = tmp_path / "lines", 0
        self.lines.mkdir()
        self.checkpoint = str(tmp_path / "ckpt")
        self.applier = FeedApplier(spark, str(tmp_path / "state"), SCHEMA)

    def push(self, *lines):
        (self.lines / f"{self.n:04d}.json").write_text("\n".join(json.dumps(line) for line in lines) + "\n")
        self.n += 1
        start_feed(self.applier, str(self.lines), self.checkpoint, max_files_per_trigger=1).awaitTermination()

    def names(self):
        rows = self.applier.rows()
        if rows is None:
            return []
        return sorted(json.loads(r["data"])["name"] for r in rows.collect())


def test_partial_checkpoints_publish_by_priority(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.push(checkpoint(4, *[bucket(f"b{p}", p) for p in range(4)]))
    assert feed.names() == []
    for p in (0, 2):
        data = [put(f"b{c}", c + 1, str(c), f"user{c}") for c in (range(1) if p == 0 else (1, 2))]
        feed.push(*data, complete(4, p))
        assert len(feed.names()) == p + 1
    feed.push(put("b3", 4, "3", "user3"))
    assert len(feed.names()) == 3
    feed.push(complete(4))
    assert feed.names() == ["user0", "user1", "user2", "user3"]


def test_redelivery_diffs_and_compaction(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.push(checkpoint(2, bucket("a"), bucket("b")), put("a", 1, "1", "one"), put("b", 2, "2", "two"), complete(2))
    assert feed.names() == ["one", "two"]
    feed.push(put("a", 1, "1", "one"), complete(2))
    assert feed.names() == ["one", "two"]
    feed.applier.compact()
    diff = {"checkpoint_diff": {"last_op_id": "4", "updated_buckets": [bucket("a", count=3)], "removed_buckets": ["b"]}}
    feed.push(diff, put("a", 3, "1", None, op="REMOVE"), put("a", 4, "3", "three"))
    assert feed.names() == ["one", "two"]
    feed.push(complete(4))
    assert feed.names() == ["three"]


@pytest.mark.parametrize("batch_id", [1, 32767, 32768, 100_000])
def test_later_batches_go_on_whatever_their_number(spark, tmp_path, batch_id):
    applier = FeedApplier(spark, str(tmp_path / "state"), SCHEMA)

    def apply(number, *lines):
        rows = [(json.dumps(line), "f", 0) for line in lines]
        applier.apply_batch(spark.createDataFrame(rows, "value STRING, file STRING, block BIGINT").coalesce(1), number)

    apply(0, checkpoint(1, bucket("a")), put("a", 1, "1", "one"), complete(1))
    apply(batch_id, checkpoint(2, bucket("b")), put("b", 2, "2", "two"), complete(2))
    assert [json.loads(r["data"])["name"] for r in applier.rows().collect()] == ["two"]


def test_a_bucket_with_a_wrong_checksum_is_held_back(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.push(checkpoint(2, bucket("a"), bucket("b", count=12345)), put("a", 1, "1", "one"), put("b", 2, "2", "two"), complete(2))
    assert feed.names() == ["one"]
    assert [tuple(r) for r in feed.applier.failed().collect()] == [("b", 12345, 1)]
    feed.push(checkpoint(3, bucket("a", count=7), bucket("b")), put("a", 3, "3", "three"), complete(3))
    assert feed.names() == ["one", "two"]
    feed.push(checkpoint(3, bucket("a", count=2), bucket("b")), complete(3))
    assert feed.names() == ["one", "three", "two"] and feed.applier.failed().isEmpty()


def test_checksums_outlive_compaction_and_redelivery(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    old = [put("a", i, "1", f"v{i}") for i in range(1, 5)]
    feed.push(checkpoint(4, bucket("a", count=4)), *old, complete(4))
    for last in (5, 6):
        feed.applier.compact()
        feed.push(checkpoint(last, bucket("a", count=last)), *old, put("a", last, "1", f"v{last}"), complete(last))
        assert feed.names() == [f"v{last}"] and feed.applier.failed().isEmpty()


def test_untyped_rows_are_kept_apart(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.push(checkpoint(2, bucket("a", count=2)), put("a", 1, "1", "one"), put("a", 2, "9", "x", row_type="later"), complete(2))
    assert feed.names() == ["one"]
    assert feed.applier.untyped().select("row_type", "row_id").collect() == [("later", "9")]


def test_one_batch_equals_many(spark, tmp_path):
    lines = [checkpoint(6, bucket("a", count=3), bucket("b", 1, count=3))]
    lines += [put("ab"[i % 2], i + 1, str(i % 3), f"n{i}") for i in range(6)] + [complete(6)]
    (tmp_path / "x").mkdir()
    (tmp_path / "y").mkdir()
    one, many = Feed(spark, tmp_path / "x"), Feed(spark, tmp_path / "y")
    one.push(*lines)
    for part in (lines[:3], lines[3:5], lines[5:]):
        many.push(*part)
    assert one.names() == many.names() and len(one.names()) == 3


def test_truncated_last_line_is_malformed(spark, tmp_path):
    path = tmp_path / "lines.json"
    path.write_text('{"token_expires_in":60}\n{"data":{"bucket":"a","data":[]}}\n{"a":1,"b":2}\n{"checkpoint_comp')
    kinds = classify_lines(number_lines(read_lines(spark, str(path)))).orderBy("seq")
    assert [r["kind"] for r in kinds.collect()] == ["token_expires_in", "data", "unknown", "malformed"]


def test_line_numbers_follow_files_and_blocks(spark, tmp_path):
    for f in range(3):
        (tmp_path / f"{f}.json").write_text("".join(json.dumps(put("a", f * 500 + i, "1", "x" * 50)) + "\n" for i in range(500)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = explode_ops(classify_lines(number_lines(read_lines(spark, str(tmp_path)))), keep=("seq",))
        assert [r["op_id"] for r in rows.orderBy("seq").collect()] == list(range(1500))
        assert rows.select("seq").distinct().count() == 1500
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_state_versions(spark, tmp_path):
    store = StateStore(spark, str(tmp_path / "s"))
    assert store.current() == (-1, {})
    store.publish(0, {"a": spark.range(3), "b": spark.range(1)})
    held = store.current()[1]
    store.publish(1, {"a": spark.range(5)})
    assert (store.read("a").count(), store.read("b").count(), store.read("a", held).count()) == (5, 1, 3)
    store.publish(0, {"a": spark.range(9)})
    assert store.read("a").count() == 5
    with pytest.raises(Exception):
        store.publish(2, {"a": spark.range(2).select(F.raise_error(F.lit("boom")).alias("x")), "b": spark.range(7)})
    assert (store.current()[0], store.read("b").count()) == (1, 1)


def write_changes(spark, path, rows):
    spark.createDataFrame(rows, "tx_id BIGINT, table_name STRING, committed BOOLEAN").coalesce(1).write.mode("append").parquet(path)


def test_watch_emits_on_committed_source_changes(spark, tmp_path):
    users, log = str(tmp_path / "users"), str(tmp_path / "log")
    spark.range(1).write.parquet(users)
    seen = []

    def run():
        query = watch(
            spark, log, lambda: spark.read.parquet(users), lambda df, n: seen.append(df.count()), str(tmp_path / "c")
        )
        query.awaitTermination()

    write_changes(spark, log, [(1, "ps_data__other", True)])
    run()
    assert seen == [1]
    spark.range(2).write.mode("append").parquet(users)
    write_changes(spark, log, [(2, "ps_data__users", True), (2, "ps_data__users", True)])
    run()
    assert seen == [1, 1, 3] or seen == [1, 3, 3]
    write_changes(spark, log, [(3, "ps_data__users", False)])
    seen.clear()
    run()
    assert seen == [3]


def test_source_tables_of_a_join(spark, tmp_path):
    for name in ("lists", "todos"):
        spark.range(1).write.parquet(str(tmp_path / name / "v=1"))
    lists, todos = (spark.read.parquet(str(tmp_path / n / "v=1")) for n in ("lists", "todos"))
    assert source_tables(lists.join(todos, "id")) == {"lists", "todos"}


def test_on_change_stream_starts_with_the_empty_set(spark, tmp_path):
    log, seen = str(tmp_path / "log"), []
    write_changes(spark, log, [(1, "ps_data__users", True), (1, "ps_data_local__drafts", True)])
    on_change_stream(spark, log, ["users"], lambda names, n: seen.append(names), str(tmp_path / "c")).awaitTermination()
    assert seen == [[], ["users"]]


def test_transfer_files_and_listing(spark, tmp_path):
    local, remote = tmp_path / "local", tmp_path / "remote"
    local.mkdir(), remote.mkdir()
    (local / "up.txt").write_text("upload me")
    (remote / "down.txt").write_text("download me")
    (remote / "old.txt").write_text("delete me")
    queue = spark.createDataFrame(
        [("u", "up.txt", 1), ("d", "down.txt", 0), ("x", "old.txt", 2), ("m", "missing.txt", 0), ("s", "kept.txt", 3)],
        "id STRING, filename STRING, state INT",
    )
    moved = transfer_files(plan := transfer_plan(queue, str(local), str(remote)), log := str(tmp_path / "log"), tasks=3)
    rows = {r["id"]: r for r in moved.collect()}
    assert {i: r["ok"] for i, r in rows.items()} == {"u": True, "d": True, "x": True, "m": False}
    assert rows["u"]["size"] == 9 and "FileNotFoundError" in rows["m"]["error"]
    assert sorted(os.listdir(remote)) == ["down.txt", "up.txt"]
    assert (local / "down.txt").read_text() == "download me"
    assert list_files(spark, str(local)).count() == 2
    assert {r[0] for r in local_files(spark, str(local)).collect()} == {"attachments/up.txt", "attachments/down.txt"}
    # Another action and another call with the log move nothing that is done, and try what failed again.
    (remote / "up.txt").unlink()
    (remote / "missing.txt").write_text("late")
    assert moved.count() == 4 and not (remote / "up.txt").exists()
    again = {r["id"]: (r["ok"], r["size"]) for r in transfer_files(plan, log, tasks=3).collect()}
    assert again == {"u": (True, 9), "d": (True, 11), "x": (True, 0), "m": (True, 4)}
    assert not (remote / "up.txt").exists() and (local / "missing.txt").read_text() == "late"


EPOCH = 1_700_000_000_000


def subscription_rows(rows):
    return [{"seq": s, "stream": st, "kind": k, "handle": h, "ttl": 10, "at_ms": EPOCH + ms} for s, st, k, h, ms in rows]


def test_subscription_stream_counts_handles_and_evicts(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    try:
        source, out = tmp_path / "in", str(tmp_path / "out")
        source.mkdir()
        files = [
            [(1, "a", "subscribe", 1, 0), (2, "a", "subscribe", 2, 0), (3, "a", "unsubscribe", 1, 1000), (4, "a", "unsubscribe", 1, 1500)],
            [(5, "a", "unsubscribe", 2, 2000), (6, "b", "subscribe", 3, 2000)],
            [(7, "c", "subscribe", 4, 20000)],
            [(8, "c", "unsubscribe_all", 0, 21000)],
        ]
        for i, rows in enumerate(files):
            (source / f"{i}.json").write_text("\n".join(json.dumps(r) for r in subscription_rows(rows)))
            os.utime(source / f"{i}.json", (1000 + i, 1000 + i))
        events = (
            spark.readStream.schema("seq BIGINT, stream STRING, kind STRING, handle BIGINT, ttl BIGINT, at_ms BIGINT")
            .option("maxFilesPerTrigger", 1)
            .json(str(source))
            .withColumn("at", F.timestamp_millis("at_ms"))
        )
        query = (
            track_subscriptions(events)
            .writeStream.format("parquet")
            .option("path", out)
            .option("checkpointLocation", str(tmp_path / "c"))
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        changes = {(r["stream"], r["kind"], r["at_ms"] - EPOCH) for r in spark.read.parquet(out).collect()}
        assert changes == {
            ("a", "active", 0),
            ("a", "unreferenced", 2000),
            ("a", "evicted", 12000),
            ("b", "active", 2000),
            ("c", "active", 20000),
            ("c", "evicted", 21000),
        }
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def test_throttle_stream_passes_first_and_newest(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "0.json").write_text("\n".join(json.dumps({"key": "k", "seq": i}) for i in range(1, 6)))
    events = spark.readStream.schema("key STRING, seq BIGINT").json(str(source))
    seen = []
    query = (
        throttle_stream(events, 2000)
        .writeStream.foreachBatch(lambda df, n: seen.extend(r["seq"] for r in df.collect()))
        .outputMode("append")
        .option("checkpointLocation", str(tmp_path / "c"))
        .trigger(processingTime="500 milliseconds")
        .start()
    )
    try:
        deadline = time.time() + 60
        while len(seen) < 2 and time.time() < deadline:
            time.sleep(0.5)
    finally:
        query.stop()
    assert seen == [1, 5]
