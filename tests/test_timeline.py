"""Progress over several checkpoints: the golden sequences, and a line-by-line replay."""

import random

import pytest

from tidelog.operators.timeline import feed_timeline

TARGETS = "seq BIGINT, bucket STRING, priority INT, target_count BIGINT, removed BOOLEAN, full BOOLEAN"


def run(spark, targets, data, done, priorities):
    rows = feed_timeline(
        spark.createDataFrame(targets, TARGETS),
        spark.createDataFrame(data, "seq BIGINT, bucket STRING, ops BIGINT"),
        spark.createDataFrame([(s,) for s in done], "seq BIGINT"),
        priorities,
    )
    out = {}
    for r in rows.collect():
        out.setdefault(r["seq"], {})[r["priority"]] = None if r["total"] is None else (r["downloaded"], r["total"])
    return {seq: [out[seq][p] for p in priorities] for seq in sorted(out)}


def test_two_checkpoints_without_priorities(spark):
    targets = [(1, "a", 3, 10, False, True), (4, "a", 3, 12, False, False)]
    got = run(spark, targets, [(2, "a", 10), (5, "a", 2)], [3, 6], (3,))
    assert [got[s][0] for s in range(1, 7)] == [(0, 10), (10, 10), None, (0, 2), (2, 2), None]


def test_rebuilt_bucket_starts_over(spark):
    targets = [(1, "a", 3, 10, False, True), (3, "a", 3, 4, False, True)]
    assert run(spark, targets, [(2, "a", 5)], [], (3,)) == {1: [(0, 10)], 2: [(5, 10)], 3: [(0, 4)]}


def test_different_priorities(spark):
    targets = [
        (1, "a", 0, 5, False, True), (1, "b", 2, 5, False, True),
        (4, "a", 0, 8, False, False), (4, "b", 2, 6, False, False),
    ]
    got = run(spark, targets, [(2, "a", 5), (3, "b", 2), (5, "a", 3), (6, "b", 4)], [7], (0, 2))
    assert [got[s] for s in range(1, 8)] == [
        [(0, 5), (0, 10)], [(5, 5), (5, 10)], [(5, 5), (7, 10)], [(5, 8), (7, 14)], [(8, 8), (10, 14)], [(8, 8), (14, 14)], [None, None],
    ]


def replay(lines, priorities):
    stored, synced, listed, downloading, out = {}, {}, {}, False, {}
    for seq, kind, body in lines:
        if kind == "target":
            if body[0][5]:
                listed = {}
            for _, bucket, priority, count, removed, _ in body:
                listed.pop(bucket, None)
                if not removed:
                    listed[bucket] = (priority, count)
            for bucket in list(stored):
                if bucket not in listed:
                    stored[bucket] = synced[bucket] = 0
            for bucket, (_, count) in listed.items():
                if count < stored.get(bucket, 0):
                    stored[bucket] = synced[bucket] = 0
            downloading = True
        elif kind == "data":
            if body[0] in listed or not downloading:
                stored[body[0]] = stored.get(body[0], 0) + body[1]
                synced.setdefault(body[0], 0)
        else:
            synced, downloading = dict(stored), False
        if not listed and not out and kind != "target":
            continue
        show = lambda p: (
            sum(stored.get(b, 0) - synced.get(b, 0) for b, (c, _) in listed.items() if c <= p),
            sum(n - synced.get(b, 0) for b, (c, n) in listed.items() if c <= p),
        )
        out[seq] = [show(p) if downloading else None for p in priorities]
    return out


@pytest.mark.parametrize("seed", range(2))
def test_timeline_matches_a_replay(spark, seed):
    r = random.Random(seed)
    lines, listed, counts = [], {}, {}
    for seq in range(1, 160):
        roll = r.random()
        if seq == 1 or roll < 0.06:
            names = r.sample("abcde", 3)
            listed = {b: "abcde".index(b) % 3 for b in names}
            body = [(seq, b, c, counts.get(b, 0) + r.randrange(-3, 12), False, True) for b, c in listed.items()]
            counts = {b: n for b, n in counts.items() if b in listed}
            lines.append((seq, "target", body))
        elif roll < 0.2:
            b = r.choice("abcde")
            removed = b in listed and len(listed) > 1 and r.random() < 0.4
            lines.append((seq, "target", [(seq, b, "abcde".index(b) % 3, counts.get(b, 0) + r.randrange(-2, 9), removed, False)]))
            listed.pop(b, None) if removed else listed.__setitem__(b, 0)
            if removed:
                counts.pop(b, None)
        elif roll < 0.26:
            lines.append((seq, "done", None))
        else:
            b = r.choice(sorted(listed))
            n = r.randrange(1, 4)
            counts[b] = counts.get(b, 0) + n
            lines.append((seq, "data", (b, n)))
    targets = [row for _, kind, body in lines if kind == "target" for row in body]
    data = [(s, *body) for s, kind, body in lines if kind == "data"]
    done = [s for s, kind, _ in lines if kind == "done"]
    assert run(spark, targets, data, done, (0, 1, 2)) == replay(lines, (0, 1, 2))
