"""Golden cases and properties of capture, apply and the upload queue."""

import itertools
import json
import random

import pytest
from pyspark.sql import functions as F

from tidelog.functions.json import typed_payload, typed_value
from tidelog.operators import capture, queue
from tidelog.operators.capture import apply_crud, capture_changes, capture_raw
from tidelog.schema import Column, Options, PreviousValues, RawSchema, RawTable


def lists(spark, *rows):
    return spark.createDataFrame(list(rows), "id STRING, name STRING, content STRING, _metadata STRING")


def entry(df):
    rows = df.collect()
    assert len(rows) == 1
    return {k: json.loads(v) if k in ("data", "old") and v is not None else v for k, v in rows[0].asDict().items()}


BEFORE = ("1", "entry", "content", None)


def test_metadata(spark):
    got = entry(capture_changes(lists(spark), lists(spark, ("1", "entry", None, "so meta")), "lists", ["name"], Options(track_metadata=True)))
    assert (got["op"], got["metadata"], got["data"]) == ("PUT", "so meta", {"name": "entry"})


@pytest.mark.parametrize(
    "tracked, after, expected",
    [
        (PreviousValues(), ("new name", "content"), {"name": "entry", "content": "content"}),
        (PreviousValues(columns=("name",)), ("new name", "new content"), {"name": "entry"}),
        (PreviousValues(only_when_changed=True), ("new name", "content"), {"name": "entry"}),
    ],
)
def test_old_values(spark, tracked, after, expected):
    changed = lists(spark, ("1", *after, None))
    got = entry(capture_changes(lists(spark, BEFORE), changed, "lists", ["name", "content"], Options(previous_values=tracked)))
    assert got["old"] == expected


def test_empty_update(spark):
    after = lists(spark, BEFORE).withColumn("touched", F.lit(True))
    ignoring = Options(ignore_empty_updates=True)
    assert capture_changes(lists(spark, BEFORE), after, "lists", ["name"], ignoring, touched="touched").count() == 0
    got = entry(capture_changes(lists(spark, BEFORE), after, "lists", ["name"], touched="touched"))
    assert (got["op"], got["data"]) == ("PATCH", {})


def test_a_patch_has_what_differs_with_its_type(spark):
    """Every pair of rows over some values of each type, against a plain comparison."""
    values = {"label": ["plain", 'quoted "x"', "é\n", None], "pieces": [0, -7, 2**40, None], "weight": [0.5, -2.25, None]}
    kinds = "id STRING, label STRING, pieces BIGINT, weight DOUBLE"
    rows = list(itertools.product(*values.values()))
    pairs = [(f"{i}-{j}", rows[i], rows[j]) for i in range(0, len(rows), 5) for j in range(0, len(rows), 7)]
    before, after = (spark.createDataFrame([(k, *p[side]) for k, *p in pairs], kinds) for side in (0, 1))
    tracked = Options(previous_values=PreviousValues(only_when_changed=True))
    got = {r["row_id"]: r for r in capture_changes(before, after, "parcels", list(values), tracked).collect()}
    for key, old, new in pairs:
        changed = {c: (o, n) for c, o, n in zip(values, old, new) if o != n}
        if changed:
            assert json.loads(got[key]["data"]) == {c: n for c, (_, n) in changed.items()}
            assert json.loads(got[key]["old"]) == {c: o for c, (o, _) in changed.items()}
        else:
            assert key not in got
    puts = capture_changes(before.limit(0), after, "parcels", list(values), tracked).collect()
    assert len(puts) == len(pairs) and all(r["op"] == "PUT" and r["old"] is None for r in puts)


def test_raw_capture_looks_at_declared_columns_only(spark):
    kinds = "id STRING, title STRING, draft STRING"
    states = [[("p", "first", "d1")], [("p", "second", "d1")], [("p", "second", "d2")], [("p", "third", "d3")]]
    frames = [spark.createDataFrame(rows, kinds) for rows in states]
    options = Options(ignore_empty_updates=True, previous_values=PreviousValues())
    posts = RawTable("posts_raw", schema=RawSchema("posts", ("title",), options))
    found = [[(r["op"], json.loads(r["data"]), json.loads(r["old"])) for r in capture_raw(a, b, posts).collect()] for a, b in zip(frames, frames[1:])]
    patch = lambda old, new: [("PATCH", {"title": new}, {"title": old})]
    assert found == [patch("first", "second"), [], patch("second", "third")]


def test_typed_values_keep_strings_apart_from_numbers(spark):
    data = '{"a":"42","b":42,"c":13.37,"d":true,"e":null,"f":1e3,"g":9000000000}'
    df = spark.createDataFrame([(data,)], "data STRING")
    got = {
        k: df.select(typed_value(typed_payload(F.col("data")).getItem(k)).alias("v")).first()["v"] for k in "abcdefg"
    }
    assert {k: v["kind"] for k, v in got.items()} == dict(a="text", b="whole", c="real", d="flag", e="null", f="real", g="whole")
    assert (got["a"]["text"], got["b"]["whole"], got["c"]["real"], got["d"]["flag"], got["f"]["real"]) == ("42", 42, 13.37, True, 1000.0)
    assert got["g"]["whole"] == 9_000_000_000


COLUMNS = [Column.text("a"), Column.integer("b")]


def brute_apply(base, entries):
    table = {k: dict(v) for k, v in base.items()}
    for _, op, row, data in entries:
        if op == "DELETE":
            table.pop(row, None)
        elif op == "PUT" or row in table:
            table.setdefault(row, {"a": None, "b": None}).update(json.loads(data))
    return table


@pytest.mark.parametrize("seed", range(3))
def test_apply_matches_row_by_row_replay(spark, seed):
    r = random.Random(seed)
    base = {str(i): {"a": f"base{i}", "b": i} for i in range(12)}
    entries = []
    for i in range(300):
        row = "3" if r.random() < 0.4 else str(r.randrange(20))
        op = r.choice(["PUT", "PATCH", "PATCH", "DELETE"])
        data = {c: v for c, v in (("a", r.choice([None, f"v{i}"])), ("b", i)) if r.random() < 0.6}
        entries.append((i, op, row, None if op == "DELETE" else json.dumps(data)))
    target = spark.createDataFrame([(k, v["a"], v["b"]) for k, v in base.items()], "id STRING, a STRING, b BIGINT")
    log = spark.createDataFrame(entries, "id BIGINT, op STRING, row_id STRING, data STRING").repartition(3)
    got = {x["id"]: {"a": x["a"], "b": x["b"]} for x in apply_crud(target, log, COLUMNS).collect()}
    assert got == brute_apply(base, entries)


def test_capture_then_apply_gives_the_new_snapshot(spark):
    r = random.Random(5)
    make = lambda: spark.createDataFrame(
        [(str(i), r.choice([None, "x", "y"]), r.choice([None, 1, 2])) for i in range(60) if r.random() < 0.7],
        "id STRING, a STRING, b BIGINT",
    )
    before, after = make(), make()
    entries = capture_changes(before, after, "t", ["a", "b"]).withColumn("id", F.lit(1).cast("bigint"))
    assert sorted(apply_crud(before, entries, COLUMNS).collect(), key=str) == sorted(after.collect(), key=str)


def test_optimistic_view_then_server_rows(spark):
    published = spark.createDataFrame([], "id STRING, a STRING, b BIGINT")
    pending = spark.createDataFrame([(1, "PUT", "l", '{"a":"local write"}')], "id BIGINT, op STRING, row_id STRING, data STRING")
    assert [r["a"] for r in capture.optimistic_view(published, pending, COLUMNS).collect()] == ["local write"]
    server = spark.createDataFrame([("s", "from server", None)], "id STRING, a STRING, b BIGINT")
    assert [r["a"] for r in capture.optimistic_view(server, pending.limit(0), COLUMNS).collect()] == ["from server"]


def crud(spark, sizes, start=1):
    rows, i = [], start
    for tx, size in enumerate(sizes, 1):
        rows += [(i + k, tx, None) for k in range(size)]
        i += size
    return spark.createDataFrame(rows, "id BIGINT, tx_id INT, error_code STRING")


def test_transactions_of_5_10_15(spark):
    txs = queue.crud_transactions(crud(spark, [5, 10, 15]))
    taken = queue.take_until_size(txs, 10)
    assert taken.agg(F.sum("n_entries")).first()[0] == 15
    entries = crud(spark, [5, 10, 15])
    assert queue.entries_until(entries, taken).count() == 15
    rest = queue.complete_upto(entries, 15)
    assert queue.next_transaction(rest).first()["n_entries"] == 15


def test_batch_of_three_with_limit_two(spark):
    entries = crud(spark, [3])
    first = queue.crud_batch(entries, 2).collect()
    assert [(r["id"], r["has_more"]) for r in first] == [(1, True), (2, True)]
    rest = queue.complete_upto(entries, 2)
    assert [(r["id"], r["has_more"]) for r in queue.crud_batch(rest, 2).collect()] == [(3, False)]
    assert queue.crud_batch(queue.complete_upto(rest, 3), 2).count() == 0


def test_runs_partition_a_queue_with_gaps_nulls_and_a_hot_transaction(spark):
    r = random.Random(3)
    rows, i = [], 0
    for _ in range(120):
        tx = r.choice([None, 1, 1, 1, 2, 3])
        for _ in range(r.randrange(1, 5)):
            rows.append((i, tx))
            i += 1 if r.random() < 0.9 else 70_000
    expected, previous = [], None
    for id_, tx in rows:
        if tx is not None and previous and previous == (id_ - 1, tx):
            expected[-1][1] = id_
        else:
            expected.append([id_, id_])
        previous = (id_, tx)
    entries = spark.createDataFrame(rows, "id BIGINT, tx_id INT").repartition(4)
    got = queue.crud_transactions(entries)
    assert sorted((x["first_id"], x["last_id"]) for x in got.collect()) == [tuple(e) for e in expected]
    assert got.agg(F.sum("n_entries")).first()[0] == len(rows)
    head = queue.next_transaction(entries).first()
    assert [head["first_id"], head["last_id"]] == expected[0]
    start = expected[5]
    walked = [x["id"] for x in queue.walk_transaction(entries, start[0]).collect()]
    assert walked == list(range(start[0], start[1] + 1))


@pytest.mark.parametrize("size, taken", [(0, 0), (1, 1), (4, 2), (5, 3), (12, 5), (13, 5), (14, 5), (15, 6), (1000, 8)])
def test_take_until_size_counts_entries_before_each_transaction(spark, size, taken):
    txs = queue.crud_transactions(crud(spark, [3, 1, 4, 1, 5, 9, 2, 6]))
    first = sorted(x["first_id"] for x in txs.collect())
    assert sorted(x["first_id"] for x in queue.take_until_size(txs, size).collect()) == first[:taken]


def test_local_target(spark):
    entries = crud(spark, [2])
    target = lambda last, cp: queue.local_target(queue.complete_upto(entries, last), cp).first()["target_op"]
    assert (target(2, 7), target(1, 7), target(2, None)) == (7, 2**63 - 1, 2**63 - 1)


def test_unknown_op_is_an_error(spark):
    bad = spark.createDataFrame([(1, 1, '{"op":"UPSERT","id":"1","type":"t"}')], "id BIGINT, tx_id INT, data STRING")
    with pytest.raises(Exception, match="unknown op"):
        queue.crud_scan(bad).collect()


def test_upload_outcome_rules(spark):
    rows = [(1, 1, None), (2, 1, None), (3, 2, None), (4, 2, "42501"), (5, 2, "08006"), (6, 3, "08006"), (7, 3, "23505"), (8, 4, "2350")]
    got = queue.upload_outcome(spark.createDataFrame(rows, "id BIGINT, tx_id INT, error_code STRING"))
    outcomes = {r["tx_id"]: r["outcome"] for r in got.collect()}
    assert outcomes == {1: "completed", 2: "discarded", 3: "retry", 4: "retry"}


def test_stats_in_whole_kilobytes(spark):
    q = spark.createDataFrame([(1, "x" * 1500), (2, "é" * 300)], "id BIGINT, data STRING")
    assert queue.queue_stats(q).first() == (2, 2100, 2)
