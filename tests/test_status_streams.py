"""Golden cases of progress, status, subscriptions and attachments."""

import json

import pytest
from pyspark.sql import functions as F

from tidelog.functions.scalars import FULL_SYNC, progress_fraction
from tidelog.operators import attachments, status, subscriptions

COUNTERS = "bucket STRING, priority INT, target_count BIGINT, at_last BIGINT, since_last BIGINT"


def counters(spark, *rows):
    return spark.createDataFrame(list(rows), COUNTERS)


def shown(df, priorities=(FULL_SYNC,)):
    rows = {r["priority"]: (r["downloaded"], r["total"]) for r in status.download_progress(df, priorities).collect()}
    return [rows[p] for p in priorities]


def target(spark, count):
    return spark.createDataFrame([("a", 3, count)], "bucket STRING, priority INT, target_count BIGINT")


def test_progress_of_two_checkpoints(spark):
    lines = spark.createDataFrame([(1, "a", 10)], "seq BIGINT, bucket STRING, ops BIGINT")
    start = status.progress_resume(counters(spark).drop("priority", "target_count"), target(spark, 10))
    assert shown(start) == [(0, 10)]
    assert status.progress_timeline(start, lines).select("downloaded", "total").collect() == [(10, 10)]
    done = status.complete_download(start.withColumn("since_last", F.lit(10).cast("bigint")))
    again = status.progress_resume(done, target(spark, 12))
    assert shown(again) == [(0, 2)]
    assert shown(again.withColumn("since_last", F.lit(2).cast("bigint"))) == [(2, 2)]


@pytest.mark.parametrize("count, expected", [(10, (5, 10)), (12, (5, 12)), (4, (0, 4))])
def test_interrupted_download_resumes(spark, count, expected):
    stored = counters(spark, ("a", 3, 10, 0, 5))
    assert shown(status.progress_resume(stored, target(spark, count))) == [expected]


def test_progress_by_priority_over_two_checkpoints(spark):
    asked = (0, 2)
    steps = lambda df, *lines: [
        tuple((r["downloaded"], r["total"]) for r in status.progress_timeline(df, spark.createDataFrame([line], "seq BIGINT, bucket STRING, ops BIGINT"), asked).orderBy("priority").collect())
        for line in lines
    ]
    first = counters(spark, ("a", 0, 5, 0, 0), ("b", 2, 5, 0, 0))
    assert shown(first, asked) == [(0, 5), (0, 10)]
    lines = spark.createDataFrame([(1, "a", 5), (2, "b", 2)], "seq BIGINT, bucket STRING, ops BIGINT")
    timeline = status.progress_timeline(first, lines, asked).orderBy("seq", "priority")
    assert [(r["downloaded"], r["total"]) for r in timeline.collect()] == [(5, 5), (5, 10), (5, 5), (7, 10)]
    stored = counters(spark, ("a", 0, 5, 0, 5), ("b", 2, 5, 0, 2))
    second = status.progress_resume(
        stored, spark.createDataFrame([("a", 0, 8), ("b", 2, 6)], "bucket STRING, priority INT, target_count BIGINT")
    )
    assert shown(second, asked) == [(5, 8), (7, 14)]
    assert steps(second, (1, "a", 3)) == [((8, 8), (10, 14))]
    lines = spark.createDataFrame([(1, "a", 3), (2, "b", 4), (3, "unlisted", 9)], "seq BIGINT, bucket STRING, ops BIGINT")
    last = status.progress_timeline(second, lines, asked).where("seq = 3").orderBy("priority").collect()
    assert [(r["downloaded"], r["total"]) for r in last] == [(8, 8), (14, 14)]


def test_fraction(spark):
    df = spark.createDataFrame([(0, 10), (5, 10), (10, 10), (0, 0)], "d BIGINT, t BIGINT")
    assert [r[0] for r in df.select(progress_fraction(F.col("d"), F.col("t"))).collect()] == [0.0, 0.5, 1.0, 0.0]


def test_status_of_a_priority_comes_from_the_next_code(spark):
    entries = spark.createDataFrame([("c", 2, 20), ("c", FULL_SYNC, 10)], "client STRING, priority INT, last_synced_at BIGINT")
    got = {r["priority"]: (r["entry_priority"], r["last_synced_at"]) for r in status.status_for_priority(entries, ["client"], (0, 2, 3)).collect()}
    assert got == {0: (2, 20), 2: (2, 20), 3: (FULL_SYNC, 10)}
    requests = spark.createDataFrame([("c", 1), ("c", 1), ("d", 1)], "client STRING, priority INT")
    asof = status.asof_priority(requests, entries.withColumn("has_synced", F.lit(True)), ["client"])
    assert {(r["client"], r["entry_priority"]) for r in asof.collect()} == {("c", 2), ("d", None)}


def events(spark, *rows):
    return spark.createDataFrame(
        [(i, s, k, h, 10, 1, i) for i, (s, k, h) in enumerate(rows, 1)],
        "seq BIGINT, stream STRING, kind STRING, handle BIGINT, ttl INT, priority INT, at BIGINT",
    )


def test_unsubscribing_twice_has_no_effect(spark):
    log = events(spark, ("a", "subscribe", 1), ("a", "subscribe", 2), ("a", "unsubscribe", 1), ("a", "unsubscribe", 1))
    assert [(r["stream"], r["ref_count"]) for r in subscriptions.subscription_fold(log).collect()] == [("a", 1)]


def test_unsubscribe_all_wins_over_older_handles(spark):
    log = events(spark, ("a", "subscribe", 1), ("a", "unsubscribe_all", None), ("a", "subscribe", 2), ("a", "unsubscribe", 1))
    assert [r["ref_count"] for r in subscriptions.subscription_fold(log).collect()] == [1]
    assert subscriptions.subscription_fold(log.where("seq <= 2")).count() == 0


def test_expiry_runs_from_the_last_unsubscribe(spark):
    log = events(spark, ("a", "subscribe", 1), ("b", "subscribe", 2), ("a", "unsubscribe", 1))
    at = lambda now: {r["stream"]: r["expires_at"] for r in subscriptions.subscription_expiry(log, F.lit(now)).collect()}
    assert at(12) == {"a": 13, "b": None}
    assert at(13) == {"b": None}


def test_only_the_first_unsubscribe_closes_a_handle(spark):
    log = events(spark, ("a", "subscribe", 1), ("a", "unsubscribe", 1), ("a", "unsubscribe", 1), ("a", "unsubscribe", 1))
    once = events(spark, ("a", "subscribe", 1), ("a", "unsubscribe", 1))
    expiry = [subscriptions.subscription_expiry(e, F.lit(0)).first()["expires_at"] for e in (log, once)]
    assert expiry[0] == expiry[1]
    again = events(spark, ("a", "subscribe", 1), ("a", "unsubscribe", 1), ("a", "subscribe", 1))
    assert subscriptions.subscription_fold(again).first()["ref_count"] == 1


def test_request_documents(spark):
    subs = spark.createDataFrame([("c", "stream", '{"foo":"a"}', None), ("c", "stream", '{"foo":"b"}', 1)], "client STRING, stream STRING, p STRING, priority INT")
    doc = subscriptions.subscription_request(subs.withColumn("parameters", F.parse_json("p")), "client", False).first()
    body = json.loads(doc["request"])
    assert body["include_defaults"] is False
    items = [json.dumps(i, separators=(",", ":")) for i in body["subscriptions"]]
    assert sorted(items) == [
        '{"stream":"stream","parameters":{"foo":"a"},"override_priority":null}',
        '{"stream":"stream","parameters":{"foo":"b"},"override_priority":1}',
    ]
    nested = spark.createDataFrame([("stream", '{"a":["foo","bar"],"b":{"foo":"bar"}}', None)], "stream STRING, p STRING, priority INT")
    item = subscriptions.request_items(nested.withColumn("parameters", F.parse_json("p"))).first()["item"]
    assert item == '{"stream":"stream","parameters":{"a":["foo","bar"],"b":{"foo":"bar"}},"override_priority":null}'
    none = nested.withColumn("parameters", F.lit(None).cast("variant"))
    assert '"parameters":null' in subscriptions.request_items(none).first()["item"]


def test_default_streams_and_flags(spark):
    defaults, explicit = (spark.createDataFrame([(s,) for s in names], "stream STRING") for names in ("ab", "bc"))
    rows = lambda **kw: {tuple(r) for r in subscriptions.default_streams(defaults, explicit, **kw).collect()}
    assert rows() == {("a", True, False), ("b", True, True), ("c", False, True)}
    assert {r[0] for r in rows(include_defaults=False)} == {"b", "c"}


QUEUE = "id STRING, timestamp BIGINT, filename STRING, state INT, local_uri STRING, media_type STRING, size BIGINT, has_synced BOOLEAN"


def queue(spark, *rows):
    return spark.createDataFrame([(i, 1, f"{i}.x", s, uri, None, None, synced) for i, s, uri, synced in rows], QUEUE)


def watched(spark, *ids):
    return spark.createDataFrame([(i, "jpg", None) for i in ids], "id STRING, file_extension STRING, filename STRING")


def states(df):
    return {r["id"]: r["state"] for r in df.collect()}


def test_every_branch_of_reconciling(spark):
    q = queue(
        spark,
        ("archived_synced", 4, "f", True), ("archived_no_file", 4, None, False), ("archived_file", 4, "f", False), ("kept", 3, "f", True),
        ("gone_synced", 3, "f", True), ("gone_download", 0, None, False), ("gone_upload", 1, "f", False),
        ("gone_upload_synced", 1, "f", True), ("gone_delete", 2, "f", False), ("gone_delete_synced", 2, "f", True),
    )
    w = watched(spark, "new", "archived_synced", "archived_no_file", "archived_file", "kept")
    assert states(attachments.reconcile_attachments(q, w)) == {
        "new": 0, "archived_synced": 3, "archived_no_file": 0, "archived_file": 1,
        "gone_synced": 4, "gone_download": 4, "gone_upload_synced": 4, "gone_delete_synced": 4,
    }
    assert "new" not in states(attachments.reconcile_attachments(q, w, downloads=False))
    named = attachments.reconcile_attachments(q, w, filename=F.concat(F.lit("f-"), "id")).where("id = 'new'").first()
    assert named["filename"] == "f-new" and named["has_synced"] is False


def test_removed_and_watched_again(spark):
    archived = attachments.reconcile_attachments(queue(spark, ("a", 3, "f", True)), watched(spark))
    assert states(archived) == {"a": 4}
    assert states(attachments.reconcile_attachments(archived, watched(spark, "a"))) == {"a": 3}


def test_verify_archives_both_states(spark):
    q = queue(spark, ("s", 3, "x/s", True), ("u", 1, "x/u", False), ("d", 0, "x/d", False), ("ok", 3, "x/ok", True), ("n", 3, None, True))
    files = spark.createDataFrame([("x/ok",)], "local_uri STRING")
    gone = attachments.verify_files(q, files)
    assert states(gone) == {"s": 4, "u": 4} and {r["local_uri"] for r in gone.collect()} == {None}


def test_outcomes(spark):
    q = queue(spark, ("up", 1, "f", False), ("down", 0, None, False), ("del", 2, "f", False), ("noretry", 0, None, False), ("retry", 0, None, False), ("nohandler", 1, "f", False), ("nofile", 1, None, False))
    out = spark.createDataFrame(
        [("up", True, None), ("down", True, None), ("del", True, None), ("noretry", False, False), ("retry", False, True), ("nohandler", False, None), ("nofile", True, False)],
        "id STRING, ok BOOLEAN, retry BOOLEAN",
    )
    after = attachments.sync_outcome(q, out)
    assert states(after) == {"up": 3, "down": 3, "del": 4, "noretry": 4, "retry": 0, "nohandler": 1, "nofile": 4}
    down = after.where("id = 'down'").first()
    assert (down["local_uri"], down["has_synced"]) == ("attachments/down.x", True)


def test_queue_delete_of_an_unknown_id_fails(spark):
    q = queue(spark, ("a", 3, "f", True))
    asked = lambda i: spark.createDataFrame([(i,)], "id STRING")
    row = attachments.queue_delete(q, asked("a")).first()
    assert (row["state"], row["has_synced"]) == (2, False)
    with pytest.raises(Exception, match="Attachment record with id zz was not found."):
        attachments.queue_delete(q, asked("zz")).collect()


def test_filename_needs_name_or_extension(spark):
    with pytest.raises(Exception, match="filename or a file extension"):
        attachments.reconcile_attachments(queue(spark), watched(spark, "a").withColumn("file_extension", F.lit(None).cast("string"))).collect()


def test_archive_limit_keeps_the_newest(spark):
    q = spark.range(10).select(F.col("id").cast("string").alias("id"), F.col("id").alias("timestamp"), F.lit(4).alias("state"))
    assert {r["id"] for r in attachments.archive_expiry(q, 3).collect()} == {str(i) for i in range(7)}
    assert {r["id"] for r in attachments.archive_keep(q, 3).collect()} == {"7", "8", "9"}
