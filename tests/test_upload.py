"""The upload queue, completions that wait for it, and what an incremental publish reads."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tests.test_streaming import SCHEMA, bucket, checkpoint, complete, put
from tidelog.functions.scalars import MAX_OP_ID
from tidelog.operators.queue import crud_scan, crud_transactions
from tidelog.sources import upload as upload_source
from tidelog.sources.state import StateStore
from tidelog.sources.upload import UploadQueue, start_uploads
from tidelog.streaming.feed import FeedApplier


def changes(spark, n, start=0):
    rows = [("PUT", "users", f"r{start + k}", json.dumps({"name": f'n"{k}'}), None) for k in range(n)]
    return spark.createDataFrame(rows, "op STRING, type STRING, row_id STRING, data STRING, metadata STRING").repartition(3)


def test_entries_have_dense_ids_and_one_transaction_a_batch(spark, tmp_path):
    queue = UploadQueue(spark, str(tmp_path / "q"))
    assert queue.local_state() == (True, None) and queue.entries().isEmpty()
    assert queue.append(changes(spark, 7)) == 1
    assert queue.append(changes(spark, 0)) is None
    assert queue.append(changes(spark, 5, 7).withColumn("old", F.lit('{"name":null}')).withColumn("metadata", F.lit('say "hi"'))) == 2
    entries = crud_scan(queue.entries()).orderBy("client_id").collect()
    assert [r.client_id for r in entries] == list(range(1, 13))
    assert {r.row_id for r in entries[:7]} == {f"r{k}" for k in range(7)}
    assert {(r.old, r.metadata) for r in entries[7:]} == {('{"name":null}', 'say "hi"')} and entries[0].old is None
    assert all(json.loads(r.op_data)["name"].startswith('n"') for r in entries)
    assert sorted(tuple(r) for r in crud_transactions(queue.entries()).collect()) == [(1, 1, 7, 7), (2, 8, 12, 5)]
    assert queue.local_state() == (False, MAX_OP_ID)
    with pytest.raises(ValueError):
        queue.load(spark.createDataFrame([(12, 3, "{}")], "id BIGINT, tx_id BIGINT, data STRING"))


def loaded(spark, path):
    queue = UploadQueue(spark, str(path))
    tx = [1, 1, None, None, 2, 2, 2, 3, 4, 4]
    queue.load(spark.createDataFrame([(k, t, f"d{k}") for k, t in enumerate(tx)], "id BIGINT, tx_id BIGINT, data STRING").repartition(3))
    return queue


def answering(log, errors):
    """Notes each transaction in a file of its own and answers with the stated code."""

    def upload(transactions):
        for t in transactions:
            ids = [number for number, _ in t.entries]
            n = sum(f.startswith(f"{t.first_id}-") for f in os.listdir(log))
            open(f"{log}/{t.first_id}-{n}", "w").write(json.dumps(ids))
            yield errors.get(t.first_id)

    return upload


def times(log):
    return sorted(os.listdir(log), key=lambda f: [int(p) for p in f.split("-")])


@pytest.mark.parametrize("batch", [100, 3])
def test_drain_stops_at_a_retry_and_discards_fatal_errors(spark, tmp_path, batch):
    queue, log = loaded(spark, tmp_path / "q"), str(tmp_path / "log")
    os.mkdir(log)
    assert not queue.drain(answering(log, {2: "23505", 7: "08006"}), batch_entries=batch)
    done = {r.first_id: (r.last_id, r.tx_id, r.n_entries, r.outcome) for r in queue.outcomes().collect()}
    assert done == {0: (1, 1, 2, "completed"), 2: (2, None, 1, "discarded"), 3: (3, None, 1, "completed"), 4: (6, 2, 3, "completed")}
    assert sorted(r.id for r in queue.entries().collect()) == [7, 8, 9] and not queue.local_state()[0]
    reached = []
    assert queue.drain(answering(log, {}), batch_entries=batch, write_checkpoint=lambda: 9, on_empty=lambda: reached.append(queue.local_state()))
    assert reached == [(True, 9)] and queue.entries().isEmpty()
    assert queue.outcomes().groupBy("first_id").count().where("count > 1").isEmpty()
    assert json.load(open(f"{log}/4-0")) == [4, 5, 6]


def test_transactions_are_looked_for_once_for_all_batches(spark, tmp_path, monkeypatch):
    queue, log, looked = loaded(spark, tmp_path / "q"), str(tmp_path / "log"), []
    os.mkdir(log)
    with_runs = upload_source.with_runs
    monkeypatch.setattr(upload_source, "with_runs", lambda entries: looked.append(1) or with_runs(entries))
    assert queue.drain(answering(log, {}), batch_entries=3) and len(looked) == 1
    assert [f"{n}-0" for n in (0, 2, 3, 4, 7, 8)] == times(log)
    assert queue.entries().isEmpty() and queue.outcomes().count() == 6
    queue.append(changes(spark, 4))
    assert queue.drain(answering(log, {}), batch_entries=3) and len(looked) == 2


def test_nothing_is_lost_or_acknowledged_twice(spark, tmp_path, monkeypatch):
    queue, log = loaded(spark, tmp_path / "q"), str(tmp_path / "log")
    os.mkdir(log)

    def dies(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:  # between the upload and its acknowledgement
        m.setattr(queue.store, "publish", dies)
        with pytest.raises(RuntimeError):
            queue.drain(answering(log, {}))
    assert len(os.listdir(log)) == 6 and not queue.local_state()[0] and queue.outcomes().isEmpty()
    again = UploadQueue(spark, str(tmp_path / "q"))
    assert again.drain(answering(log, {}))
    assert len(os.listdir(log)) == 6  # the written results were acknowledged, nothing was sent again
    assert sorted(r.first_id for r in again.outcomes().collect()) == [0, 2, 3, 4, 7, 8]

    def stops(transactions):
        next(transactions)
        yield None
        raise RuntimeError("lost")

    again.append(changes(spark, 4))
    with pytest.raises(Exception):  # in the middle of an upload: all of it is sent again
        again.drain(stops)
    assert not again.local_state()[0] and again.drain(answering(log, {}))
    assert len(os.listdir(log)) == 7 and again.outcomes().count() == 7


def test_writes_during_the_checkpoint_request_keep_the_target(spark, tmp_path):
    queue = UploadQueue(spark, str(tmp_path / "q"))
    queue.append(changes(spark, 1))

    def request():
        queue.append(changes(spark, 1, 1))
        return 5

    fine = lambda transactions: (None for _ in transactions)
    assert not queue.drain(fine, write_checkpoint=request) and queue.local_state() == (False, MAX_OP_ID)
    assert queue.drain(fine, write_checkpoint=lambda: 6) and queue.local_state() == (True, 6)
    with pytest.raises(Exception, match="outcome"):
        queue.append(changes(spark, 1, 2))
        queue.drain(lambda transactions: iter(()))


def test_upload_stream_drains_what_is_committed(spark, tmp_path):
    queue = loaded(spark, tmp_path / "q")
    start_uploads(queue, lambda transactions: (None for _ in transactions), str(tmp_path / "c")).awaitTermination()
    assert queue.local_state()[0]


class Lines:
    def __init__(self, spark, applier):
        self.spark, self.applier, self.n = spark, applier, 0

    def push(self, *lines):
        rows = [(json.dumps(line), "f", 0) for line in lines]
        self.applier.apply_batch(self.spark.createDataFrame(rows, "value STRING, file STRING, block BIGINT").coalesce(1), self.n)
        self.n += 1

    def names(self):
        rows = self.applier.rows()
        return sorted(json.loads(r["data"])["name"] for r in rows.collect()) if rows is not None else []


def test_completions_wait_for_local_writes(spark, tmp_path):
    queue = UploadQueue(spark, str(tmp_path / "q"))
    feed = Lines(spark, FeedApplier(spark, str(tmp_path / "s"), SCHEMA, slices=4, queue=queue))
    queue.append(changes(spark, 1))
    first = checkpoint(2, bucket("a", 0), bucket("b", 1))
    feed.push(first, put("a", 1, "1", "one"), put("b", 2, "2", "two"), complete(2, 0))
    assert feed.names() == ["one"]  # priority 0 does not wait
    feed.push(complete(2))
    assert feed.names() == ["one"] and not feed.applier.retry()
    uploaded = queue.drain(lambda transactions: (None for _ in transactions), write_checkpoint=lambda: 7, on_empty=feed.applier.retry)
    assert uploaded and feed.names() == ["one"]  # the feed has not reached the write checkpoint
    second = checkpoint(3, bucket("a", 0), bucket("b", 1, count=2))
    second["checkpoint"]["write_checkpoint"] = "7"
    queue.append(changes(spark, 1, 1))
    feed.push(second, put("b", 3, "3", "three"), complete(3))
    assert feed.names() == ["one"]
    queue.drain(lambda transactions: (None for _ in transactions), write_checkpoint=lambda: 7, on_empty=feed.applier.retry)
    assert feed.names() == ["one", "three", "two"] and not feed.applier.retry()  # published without a new line


def test_a_publish_reads_what_changed(spark, tmp_path):
    applier = FeedApplier(spark, str(tmp_path / "s"), SCHEMA, slices=16)
    feed = Lines(spark, applier)
    ops = [put("a", k + 1, str(k), f"n{k}") for k in range(200)]
    feed.push(checkpoint(200, bucket("a", count=200)), *ops, complete(200))
    assert len(applier.touched) == 16 and len(feed.names()) == 200
    version, before = applier.store.current()
    feed.push(checkpoint(201, bucket("a", count=201)), put("a", 201, "7", "new"), complete(201))
    after = applier.store.current()[1]
    assert len(applier.touched) == 1
    changed = {k for k in after if k.startswith(("keys/", "rows/")) and after[k] != before[k]}
    assert changed == {f"{t}/{applier.touched[0]}" for t in ("keys", "rows")}
    assert applier.store.read("pending").isEmpty() and "new" in feed.names() and "n7" not in feed.names()
    applier.compact()
    assert [n for n in os.listdir(tmp_path / "s" / "oplog")] == []
    feed.push(checkpoint(202, bucket("a", count=202)), put("a", 202, "7", None, op="REMOVE"), complete(202))
    assert len(feed.names()) == 199


def test_retained_versions_bound_the_disk(spark, tmp_path):
    store = StateStore(spark, str(tmp_path / "s"))
    for v in range(12):
        rows = spark.range(8).select((F.col("id") % 4).cast("int").alias("slice"), "id")
        entries = store.stage_slices(v, "part", rows.where(F.lit(v == 0) | (F.col("slice") == v % 4)), [v % 4] if v else range(4))
        store.publish(v, {"whole": spark.range(v + 1)}, entries={**entries, "@n": str(v)})
        store.retain(2)
    _, paths = store.current()
    assert paths["@n"] == "11" and store.read("whole").count() == 12
    assert store.read_slices("part", "id BIGINT", paths).count() == 8
    assert len(os.listdir(tmp_path / "s" / "tables" / "whole")) == 2
    assert spark.read.parquet(str(tmp_path / "s" / "commits")).select("version").distinct().count() == 2
