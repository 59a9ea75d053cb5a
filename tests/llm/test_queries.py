"""Registered queries against their SQL, and the pipeline stage by stage on a small corpus."""

import os
import random
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.compare import differences
from tidelog.llm.queries import MIX, ORACLES, QUERIES
from tidelog.llm.raking import mix, word_count
from tidelog.llm.tokenfile import PieceEncoder
from tidelog.session import written

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no tables to run on")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    assert differences(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) == []


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def sentence(draw, n):
    return " ".join("".join(draw.choice("abcdefgh") for _ in range(4)) for _ in range(n))


def test_stages_take_effect(spark, tmp_path):
    draw = random.Random(1)
    item = sentence(draw, 30)
    texts = {}
    for i in range(160):
        texts[i] = sentence(draw, 40) + (" vilewort " if i % 4 == 0 else " ") + sentence(draw, 40)
    for i in range(160, 200):
        texts[i] = texts[i - 99].replace("a", "A")  # copies of documents 61 to 100, but for case
    for i in range(200, 206):
        texts[i] = f"{sentence(draw, 40)} {item} {sentence(draw, 40)}"
    texts[206], texts[207] = None, ""
    docs = [(i, t, ["en", "de", None][i % 3], f"s{i % 2}", len(t or "")) for i, t in texts.items()]
    frames = {
        "documents": spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long"),
        "labels": spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(160)], "doc_id long, quality int, toxic int"),
        "benchmark": spark.createDataFrame([(0, item)], "item_id long, text string"),
    }
    for name, frame in frames.items():
        frame.write.parquet(f"{tmp_path}/{name}.parquet")
    rows, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    columns = rows.columns
    for name, stage in corpus_pipeline.STAGES:
        rows = written(stage(spark, rows, str(tmp_path)), "stage")
        kept.append({r.doc_id for r in rows.collect()})
        assert rows.columns == columns or name == "token files"
    toxic = {i for i, t in texts.items() if "vilewort" in (t or "").lower()}
    clean = set(texts) - toxic
    # The network has seen about 32 toxic texts here; its accuracy is tested on its own.
    assert len(kept[0] & toxic) <= 0.4 * len(toxic) and len(kept[0] & clean) >= 0.9 * len(clean)
    first = {}
    for i in sorted(kept[0]):
        first.setdefault((texts[i] or "").lower(), i)
    assert kept[1] == set(first.values())
    assert kept[2] == {i for i in kept[1] if item not in (texts[i] or "")}
    assert kept[3] < kept[2] and kept[4] == kept[3]
    tokenizer, start = PieceEncoder(public_tokenizers.path("word_bpe_49k.json")).tokenizer, 0
    for r in rows.orderBy("doc_id").collect():
        ids = [*tokenizer.encode(texts[r.doc_id] or "", add_special_tokens=False).ids, 1]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_mixing_keeps_its_size_beside_a_tiny_source(spark):
    draw = random.Random(4)
    rows = [(i, sentence(draw, 60), ["en", "de", "fr", "es"][i % 4], "hot") for i in range(2000)]
    rows += [(2000, sentence(draw, 20), "en", "tiny"), (2001, " ", "en", "tiny"), (2002, None, "en", "tiny")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(4)
    total = 2000 * 60 + 20
    goal = 20**0.5 / (20**0.5 + (2000 * 60) ** 0.5) * total  # tokens of the tiny source, tempered
    drawn = corpus_pipeline.mixed(spark, docs, "")
    words = {r[0]: r[1] for r in drawn.groupBy("source").agg(F.sum(word_count(F.col("text")))).collect()}
    assert abs(words["tiny"] - goal) <= 20 and abs(words["hot"] / (total - goal) - 1) < 0.05
    assert drawn.where("doc_id > 2000").groupBy("doc_id").count().where("count > 1").isEmpty()
    langs = {r[0]: r[1] / total for r in drawn.groupBy("lang").agg(F.sum(word_count(F.col("text")))).collect()}
    assert all(abs(langs[v] - share) < 0.02 for v, share in MIX["lang"].items())
    rates = mix(docs, MIX, size=0.5)
    assert rates.where("probability > 1 or probability <= 0").isEmpty()
    assert abs(rates.agg(F.sum("n_tokens")).first()[0] / (total / 2) - 1) < 0.05
