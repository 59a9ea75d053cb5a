"""Schema checks, reads, table views, throttling and edges."""

import random

import pytest
from pyspark.sql import functions as F

from tidelog.functions.scalars import friendly_table_name
from tidelog.operators import reactive, relational, tables, writes
from tidelog.schema import (
    ID,
    REST,
    Column,
    Index,
    Options,
    PreviousValues,
    RawSchema,
    RawTable,
    Schema,
    SchemaError,
    Table,
    from_column,
)


def invoice(*columns, indexes=(), **more):
    return Table("invoices", [Column.text(c) for c in columns], list(indexes), **more)


def message_of(table):
    with pytest.raises(SchemaError) as caught:
        Schema([table])
    return str(caught.value)


@pytest.mark.parametrize("sign", ['"', "'", "%", ",", ".", "#", "[", "]"])
def test_signs_that_no_name_may_hold(sign):
    bad = f"due{sign}date"
    assert message_of(invoice(bad)) == f"Invalid characters in column name: invoices.{bad}"
    assert message_of(Table(bad, [])) == f"Invalid characters in table name: {bad}"
    assert message_of(invoice("total", view_name_override=bad)) == f"Invalid characters in view name: {bad}"
    assert message_of(invoice("total", indexes=[Index(bad, ("total",))])) == f"Invalid characters in index name: invoices.{bad}"


def test_columns_and_indexes_of_a_table():
    by_total = Index("by_total", ("total",))
    assert message_of(invoice("total", "due", "total")) == "Duplicate column invoices.total"
    assert message_of(invoice("total", indexes=[by_total, by_total])) == "Duplicate index invoices.by_total"
    assert message_of(invoice("due", indexes=[by_total])) == "Column invoices.total not found for index by_total"
    assert message_of(invoice("due", "id")) == "invoices: id column is automatically added, custom id columns are not supported"
    assert message_of(invoice(*[f"line_{i}" for i in range(2000)])) == "Table invoices has more than 1999 columns, which is not supported"
    Schema([invoice(*[f"line_{i}" for i in range(1999)], indexes=[Index("first", ("line_0",))])])


def test_what_a_local_table_cannot_track():
    for option, message in (
        ({"track_metadata": True}, "Can't track metadata for local-only tables."),
        ({"previous_values": PreviousValues()}, "Can't track old values for local-only tables."),
    ):
        assert message_of(invoice("total", options=Options(local_only=True, **option))) == message
        Schema([invoice("total", options=Options(**option))])


def test_duplicate_table_names():
    with pytest.raises(SchemaError, match="Duplicate table name: a"):
        Schema([Table("a"), Table("a")])
    with pytest.raises(SchemaError, match="Duplicate table name: a"):
        Schema([Table("a")], [RawTable("a", schema=RawSchema())])


def test_column_limit_is_inclusive():
    Schema([Table("users", [Column.text(f"c{i}") for i in range(1999)])])


def test_view_types_and_malformed_text(spark):
    table = Table("t", [Column.integer("n"), Column.real("r"), Column.text("s"), Column.integer("missing")])
    data = ['{"n":"42","r":1,"s":7}', '{"n":13.37,"r":"x","s":null}', '{"n":true,"r":false,"s":"é"}', '{"n":"abc"}', "not json"]
    rows = spark.createDataFrame([(str(i), d) for i, d in enumerate(data)], "id STRING, data STRING")
    got = [tuple(r)[1:] for r in tables.json_table_view(rows, table).orderBy("id").collect()]
    assert got == [(42, 1.0, "7", None), (13, None, None, None), (1, 0.0, "é", None), (None,) * 4, (None,) * 4]
    one = Table("t", [Column.integer("n")])
    assert [r["n"] for r in tables.json_table_view(rows, one).orderBy("id").collect()] == [42, 13, 1, None, None]


def test_registered_views_and_insert_only(spark):
    rows = spark.createDataFrame([("users", "1", '{"name":"a"}'), ("log", "2", "{}")], "row_type STRING, row_id STRING, data STRING")
    schema = Schema([Table("users", [Column.text("name")], view_name_override="people"), Table("log", [Column.text("x")], options=Options(insert_only=True))])
    tables.register_views(rows, schema)
    assert relational.get_all(spark, "SELECT name FROM people WHERE id = ?", ["1"]).first()["name"] == "a"
    assert spark.sql("SELECT count(*) AS n FROM log").first()["n"] == 0


def test_raw_put_rest_keeps_other_members(spark):
    table = RawTable("lists", put={"id": ID, "name": from_column("name"), "_rest": REST})
    rows = spark.createDataFrame([("1", '{"name":"n","shelf":"upper"}')], "id STRING, data STRING")
    assert tuple(tables.raw_table_put(rows, table).first()) == ("1", "n", '{"shelf":"upper"}')


def test_raw_delete_and_clear(spark):
    existing = spark.createDataFrame([("1", 7, "a"), ("2", 8, "b"), ("3", None, "c")], "id STRING, owner INT, note STRING")
    removed = spark.createDataFrame([("2", '{"owner":7}'), ("9", "{}")], "id STRING, data STRING")
    left = lambda table: [r["id"] for r in tables.raw_table_delete(existing, removed, table).orderBy("id").collect()]
    put = {"id": ID}
    assert left(RawTable("t", put=put)) == ["1", "3"]
    assert left(RawTable("t", put=put, delete={"owner": from_column("owner")})) == ["2", "3"]
    kept = lambda clear: [r["id"] for r in tables.raw_table_clear(existing, RawTable("t", put=put, clear=clear)).orderBy("id").collect()]
    assert kept("owner < 8") == ["2", "3"]
    assert kept(None) == ["1", "2", "3"]
    with pytest.raises(SchemaError):
        RawTable("t", put=put, delete={"x": REST}).check()


def test_put_beside_a_schema_decides_what_is_synced(spark):
    existing = spark.createDataFrame([("1", 5, "mine"), ("2", 6, "x")], "id STRING, pages INT, local STRING")
    rows = spark.createDataFrame([("1", '{"length":"9","local":"theirs"}')], "id STRING, data STRING")
    table = RawTable("t", put={"id": ID, "pages": from_column("length")}, schema=RawSchema())
    table.check()
    assert [tuple(r) for r in tables.raw_table_infer(existing, rows, table).collect()] == [("1", 9, "mine")]
    with pytest.raises(SchemaError):
        RawTable("t").check()


def test_inferred_raw_table_deletes_and_keeps_local_columns(spark):
    existing = spark.createDataFrame([("1", "old", "mine"), ("2", "gone", "x")], "id STRING, name STRING, local STRING")
    rows = spark.createDataFrame([("1", '{"name":"new"}'), ("3", '{"name":"add"}')], "id STRING, data STRING")
    table = RawTable("u", schema=RawSchema(synced_columns=("name",)))
    assert sorted(map(tuple, tables.raw_table_infer(existing, rows, table).collect())) == [("1", "new", "mine"), ("3", "add", None)]


def test_join_names():
    assert relational.unique_names(["id", "name", "name", "name", "id"]) == ["id", "name", "name&JOIN1", "name&JOIN2", "id&JOIN1"]


def test_single_row_reads(spark):
    none = spark.range(0)
    with pytest.raises(Exception, match="get\\(\\) called with query that returned no rows"):
        relational.get_one(none, ["id"]).collect()
    with pytest.raises(relational.NoRowError):
        relational.first_row(none, ["id"])
    assert relational.get_one(spark.range(3), [F.col("id").desc()]).first()["id"] == 2
    assert relational.get_optional(none, ["id"]).count() == 0


def test_parameters_and_getters(spark):
    with pytest.raises(TypeError):
        relational.get_all(spark, "SELECT ?", [object()])
    df = spark.createDataFrame([(1, None)], "flag BIGINT, empty STRING")
    assert df.select(relational.required(df, "flag", "boolean")).first()[0] is True
    with pytest.raises(KeyError):
        relational.required(df, "nope", "string")
    with pytest.raises(Exception, match="Null value for column empty"):
        df.select(relational.required(df, "empty", "string")).collect()
    assert tuple(df.select(relational.optional(df, "empty", "string"), relational.optional(df, "nope", "bigint")).first()) == (None, None)


def test_friendly_names(spark):
    names = ["ps_data__users", "ps_data_local__drafts", "ps_crud", "ps_data__", "users"]
    df = spark.createDataFrame([(n,) for n in names], "t STRING")
    assert [r[0] for r in df.select(friendly_table_name(F.col("t"))).collect()] == ["users", "drafts", "ps_crud", "ps_data__", "users"]


def test_failed_transactions_leave_nothing(spark):
    rows = [(1, 1, False), (2, 1, True), (3, 2, False), (4, None, False)]
    df = spark.createDataFrame(rows, "id BIGINT, tx_id INT, bad BOOLEAN")
    assert {r["id"] for r in writes.atomic_batch(df, F.col("bad")).collect()} == {3, 4}


def test_generated_ids_are_unique(spark):
    table = spark.createDataFrame([("1", "a")], "id STRING, name STRING")
    grown = writes.insert_rows(table, spark.range(50).select(F.col("id").cast("string").alias("name")))
    assert grown.select("id").distinct().count() == 51


def emissions(spark, at, pause):
    rows = [("k", t, i) for i, t in enumerate(at)]
    df = spark.createDataFrame(rows, "key STRING, at BIGINT, seq BIGINT").repartition(3)
    return [(r["emitted_at"], r["seq"]) for r in reactive.throttle(df, "key", "at", "seq", pause).orderBy("emitted_at").collect()]


def replay(at, pause):
    out, pause_until, pending = [], None, None
    for i, t in enumerate(at):
        while pending is not None and pause_until < t:
            out.append((pause_until, pending))
            pause_until, pending = pause_until + pause, None
        if pause_until is None or (pending is None and t > pause_until):
            out.append((t, i))
            pause_until = t + pause
        else:
            pending = i
    if pending is not None:
        out.append((pause_until, pending))
    return out


def test_throttle_emits_first_and_newest(spark):
    assert [s for _, s in emissions(spark, [0, 10, 30, 130], max(100, 1000))] == [0, 3]


def test_throttle_pauses_do_not_add_up(spark):
    assert [s for _, s in emissions(spark, [0, 10, 20, 30, 40], max(5, 6))] == [0, 1, 2, 3, 4]


@pytest.mark.parametrize("seed, spread", [(1, 5), (2, 12), (3, 16), (4, 40), (5, 15)])
def test_throttle_matches_a_replay(spark, seed, spread):
    r, t, at = random.Random(seed), 100, []
    for _ in range(250):
        at.append(t)
        t += r.randrange(0, spread) if seed != 5 else 15
    assert emissions(spark, at, 10) == replay(at, 10)


def test_changed_only_and_edges(spark):
    v = spark.createDataFrame([("q", i, x) for i, x in enumerate("aabba")], "q STRING, version BIGINT, result STRING")
    assert [r["version"] for r in reactive.changed_only(v, ["q"], "version", F.col("result")).orderBy("version").collect()] == [0, 2, 4]
    s = spark.createDataFrame([("c", i, x) for i, x in enumerate([True, True, False, True, False, False, True])], "client STRING, seq BIGINT, connected BOOLEAN")
    assert [r["seq"] for r in reactive.reconnect_edges(s, ["client"], "seq").orderBy("seq").collect()] == [0, 3, 6]


def test_on_change_uses_declared_names(spark):
    rows = [(0, "ps_data__users"), (0, "ps_data_local__drafts"), (0, "ps_data__users"), (1, "ps_crud")]
    df = spark.createDataFrame(rows, "slot BIGINT, table_name STRING").withColumn("db", F.lit("d"))
    got = {r["slot"]: r["tables"] for r in reactive.on_change(df, F.col("slot"), ["db"]).collect()}
    assert got == {0: ["drafts", "users"], 1: ["ps_crud"]}
    watched = reactive.on_change(df, F.col("slot"), ["db"], ["users"]).collect()
    assert [(r["slot"], r["tables"]) for r in watched] == [(0, ["users"])]
