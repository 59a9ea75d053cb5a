"""Golden cases and properties of the feed operators."""

import random

import pytest
from pyspark.sql import functions as F

from tidelog.operators import feed, ordered, skew
from tidelog.operators.history import checkpoint_history
from tidelog.operators.ordered import scan_before
from tidelog.operators.skew import heavy_keys, lookup_join

OPLOG = "op_id BIGINT, bucket STRING, op STRING, row_type STRING, row_id STRING, subkey STRING, data STRING, checksum BIGINT"


def oplog(spark, rows):
    full = [(o, b, op, "users" if r else None, r, None, d, 10) for o, b, op, r, d in rows]
    return spark.createDataFrame(full, OPLOG)


def state(df):
    return {r["row_id"]: r["data"] for r in df.collect()}


def test_row_id_is_the_object_id(spark):
    log = oplog(spark, [(1, "a", "PUT", "1", '{"id":"test1"}'), (2, "a", "PUT", "2", '{"id":"test1"}')])
    assert len(state(feed.apply_oplog(log))) == 2


def test_row_in_two_buckets_survives_removal_from_one(spark):
    log = oplog(spark, [(1, "a", "PUT", "1", "old"), (2, "b", "PUT", "1", "new"), (3, "b", "REMOVE", "1", None)])
    assert state(feed.apply_oplog(log)) == {"1": "old"}


def test_clear_hides_earlier_ops_of_its_bucket_only(spark):
    log = oplog(
        spark,
        [(1, "a", "PUT", "1", "x"), (2, "b", "PUT", "2", "y"), (3, "a", "CLEAR", None, None), (4, "a", "MOVE", None, None), (5, "a", "PUT", "3", "z")],
    )
    assert state(feed.apply_oplog(log)) == {"2": "y", "3": "z"}


def test_partial_completion_counts(spark):
    log = oplog(spark, [(p + 1, f"b{p}", "PUT", str(p), "d") for p in range(4)])
    cp = spark.createDataFrame([(f"b{p}", p, 4) for p in range(4)], "bucket STRING, priority INT, last_op_id BIGINT")
    assert [feed.partial_checkpoint(log, cp, p).count() for p in range(4)] == [1, 2, 3, 4]


def test_checksum_of_one_op_matches_its_bucket(spark):
    log = oplog(spark, [(1, "a", "PUT", "1", "x"), (2, "b", "MOVE", None, None)])
    cp = spark.createDataFrame([("a", 10, 2), ("b", 11, 2), ("c", 0, 2)], "bucket STRING, checksum BIGINT, last_op_id BIGINT")
    valid = {r["bucket"]: r["valid"] for r in feed.bucket_checksums(log, cp).collect()}
    assert valid == {"a": True, "b": False, "c": True}


def test_checksum_halves_equal_the_plain_sum(spark):
    df = spark.range(1000).select(((F.col("id") * 2654435761) % 4294967296).alias("c"))
    from tidelog.functions.scalars import sum_modulo_32_bits

    row = df.agg(sum_modulo_32_bits(F.col("c")).alias("m"), (F.sum("c") % 4294967296).alias("p")).first()
    assert row["m"] == row["p"]


def random_log(seed, n=400):
    r = random.Random(seed)
    kinds = ["PUT"] * 6 + ["REMOVE"] * 3 + ["MOVE", "CLEAR"]
    rows = []
    for i in range(1, n + 1):
        op = r.choice(kinds) if r.random() > 0.02 else "CLEAR"
        bucket = "hot" if r.random() < 0.4 else f"b{r.randrange(4)}"
        rows.append((i, bucket, op, str(r.randrange(25)) if op in ("PUT", "REMOVE") else None, f"d{i}" if op == "PUT" else None))
    return rows


def brute_force(rows):
    held = {}
    for op_id, bucket, op, row, data in rows:
        if op == "CLEAR":
            held = {k: v for k, v in held.items() if k[0] != bucket}
        elif op == "PUT":
            held[(bucket, row)] = (op_id, data)
        elif op == "REMOVE":
            held.pop((bucket, row), None)
    best = {}
    for (_, row), value in held.items():
        best[row] = max(best.get(row, (0, None)), value)
    return {row: data for row, (_, data) in best.items()}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_fold_matches_brute_force_in_any_partitioning(spark, seed):
    rows = random_log(seed)
    shuffled = list(rows)
    random.Random(seed).shuffle(shuffled)
    expected = brute_force(rows)
    assert state(feed.apply_oplog(oplog(spark, rows).repartition(5))) == expected
    assert state(feed.apply_oplog(oplog(spark, shuffled))) == expected


def test_fold_with_large_lookups(spark, monkeypatch):
    monkeypatch.setattr(skew, "BROADCAST_ROWS", 0)
    rows = random_log(11)
    assert state(feed.apply_oplog(oplog(spark, rows))) == brute_force(rows)


def test_compacted_log_folds_to_the_same_rows(spark):
    log = oplog(spark, random_log(7))
    compacted = feed.compact_oplog(log)
    assert compacted.count() < log.count()
    assert state(feed.apply_oplog(compacted)) == state(feed.apply_oplog(log))
    sums = lambda df: {tuple(r) for r in df.select("bucket", "actual", "op_count").collect()}
    assert sums(feed.add_sums(feed.op_sums(compacted), feed.dropped_sums(log, compacted))) == sums(feed.op_sums(log))


def test_local_gate_holds_while_writes_wait(spark):
    rows, queue = spark.range(2), spark.createDataFrame([(1,)], "id BIGINT")
    assert feed.local_gate(rows, queue, 5, 5).count() == 0
    assert feed.local_gate(rows, queue.limit(0), 5, 5).count() == 2
    assert feed.local_gate(rows, queue.limit(0), 4, 5).count() == 0


def test_clear_state_flags(spark):
    tables = {n: spark.range(1) for n in ("rows", "crud", "local_rows", "oplog", "buckets")}
    kept = lambda **flags: {n for n, df in feed.clear_state(tables, **flags).items() if df.count()}
    assert kept() == {"local_rows"}
    assert kept(clear_local=True) == set()
    assert kept(soft=True) == {"local_rows", "oplog", "buckets"}


def test_checkpoint_history_with_empty_lines(spark):
    full = spark.createDataFrame([(1, "a", 3, 10, 0), (1, "b", 3, 5, 0)], "seq BIGINT, bucket STRING, priority INT, target_count BIGINT, checksum BIGINT")
    diffs = spark.createDataFrame([(2, "a", 3, 12, 0, False), (3, "b", 3, 0, 0, True)], "seq BIGINT, bucket STRING, priority INT, target_count BIGINT, checksum BIGINT, removed BOOLEAN")
    lines = spark.createDataFrame([(1, True), (2, False), (3, False), (4, True)], "seq BIGINT, full BOOLEAN")
    rows = checkpoint_history(full, diffs, lines).select("seq", "bucket", "target_count").collect()
    assert {tuple(r) for r in rows} == {(1, "a", 10), (1, "b", 5), (2, "a", 12), (2, "b", 5), (3, "a", 12)}


@pytest.mark.parametrize("stride, top", [(1, 9), (997, 9), (70_000, 9), (2**37 + 5, 9), (70_000, 10**6)])
def test_scan_before_crosses_ranges(spark, stride, top, monkeypatch):
    monkeypatch.setattr(ordered, "TOP_ROWS", top)
    n = 300
    df = spark.range(n).select(
        (F.col("id") * stride - 1000).alias("at"), F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("g"), F.when(F.col("id") % 4 == 0, F.col("id")).alias("v")
    ).repartition(4)
    rows = scan_before(df, "at", by=["g"], sums={"s": F.coalesce("g", F.lit(0)) + 1}, lasts={"l": F.col("v")}).orderBy("at").collect()
    seen = {}
    for i, r in enumerate(rows):
        total, last = seen.get(i % 3, (0, None))
        assert (r["s"], r["l"]) == (total, last)
        seen[i % 3] = (total + i % 3 + 1, i if i % 4 == 0 else last)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("broadcast_rows", [0, 100])
def test_lookup_join_equals_a_plain_join_under_skew(spark, how, broadcast_rows, monkeypatch):
    monkeypatch.setattr(skew, "BROADCAST_ROWS", broadcast_rows)
    rows = spark.range(2000).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 11 == 0, None).otherwise(F.col("id") % 40).alias("k")
    )
    lookup = spark.range(5, 30).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    assert (7,) in heavy_keys(rows, ["k"], share=5).collect()
    ours, plain = lookup_join(rows, lookup, ["k"], how), rows.join(lookup, "k", how)
    key = lambda r: tuple(str(v) for v in (r["id"], r["k"], r.asDict().get("v")))
    assert sorted(map(key, ours.collect())) == sorted(map(key, plain.collect()))
