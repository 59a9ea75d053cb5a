"""The registered query of each operator, and its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.chat import read_chats, write_chats
from tidelog.llm.decontam import contaminated
from tidelog.llm.maxsketch import ranked
from tidelog.llm.ngramjoin import similar_sets
from tidelog.llm.onebit import nearest
from tidelog.llm.pii import BASE_KINDS, personal_data
from tidelog.llm.probminhash import near_duplicates
from tidelog.llm.raking import MEASUREMENTS, ROUNDS, TOLERANCE, mix
from tidelog.llm.secretscan import BASE, secrets
from tidelog.llm.spans import digest_columns
from tidelog.llm.spelling import variants
from tidelog.llm.tokenfile import read_blocks, token_files
from tidelog.llm.toxicity import held_out, score, trained
from tidelog.llm.urlrules import judge

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


@_query
def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the class of its near-duplicates."""
    members, _ = near_duplicates(_table(spark, sf_dir, "documents"))
    return members.select("doc_id", "class_id", "class_size")


@_query
def op5_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place, size and checksum, read back from the token files."""
    path = token_files(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return read_blocks(spark, path, with_ids=False)


@_query
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, with the nearest passage."""
    return contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


@_query
def op7_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url judged by the nested rules."""
    return judge(_table(spark, sf_dir, "pages"), spark.createDataFrame(RULES, "host string, path string, verdict string"))


_FITS = " ".join(
    f"WHEN (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}') THEN '{verdict} {host}{path}'"
    for host, path, verdict in sorted(RULES, key=lambda r: -len(r[0] + r[1]))
)
ORACLES["op7_url_rules"] = f"""
WITH rest AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
judged AS (SELECT *, CASE {_FITS} END AS best FROM parts)
SELECT page_id, host, path, split_part(best, ' ', 2) AS rule, coalesce(split_part(best, ' ', 1), 'allow') AS verdict FROM judged"""


#: Sources and topics are tempered, languages have stated shares.
MIX = {"source": 0.5, "lang": {"en": 0.5, "de": 0.18, "fr": 0.18, "es": 0.14}, "topic": 0.8}
#: Tokens that are drawn in expectation, as a part of the present ones.
MIX_SIZE = 0.5


@_query
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents drawn to meet the target shares at half the tokens, a row for each copy, with their probabilities."""
    drawn = mix(_table(spark, sf_dir, "documents"), MIX, size=MIX_SIZE)
    return drawn.withColumn("probability", F.round("probability", 6))


def _mix_sql() -> str:
    signs = "length(t) - length(translate(t, '%$#*&@|<>{}=_~^+', ''))"
    digits = "length(t) - length(translate(t, '0123456789', ''))"
    parts = [
        "d AS (SELECT doc_id, coalesce(source, '(none)') AS source, coalesce(lang, '(none)') AS lang, coalesce(text, '') AS t FROM documents)",
        f"""r AS MATERIALIZED (SELECT doc_id, source, lang, CASE WHEN ({signs}) * 100 > length(t) * 8 THEN 'symbols' WHEN ({digits}) * 100 > length(t)
          THEN 'figures' WHEN length(t) > 5000 THEN 'long' ELSE 'prose' END AS topic,
          len(regexp_extract_all(t, '[^ \\t\\n\\r]+')) AS n_tokens FROM d)""",
        "c0 AS MATERIALIZED (SELECT source, lang, topic, sum(n_tokens)::DOUBLE AS tokens, 1.0::DOUBLE AS factor FROM r GROUP BY ALL)",
    ]
    for margin, target in MIX.items():
        if isinstance(target, dict):
            cases = " ".join(f"WHEN '{v}' THEN {x}::DOUBLE" for v, x in target.items())
            share = f"CASE {margin} {cases} ELSE sum(tokens) / (SELECT sum(tokens) FROM c0) END"
        else:
            share = f"pow(sum(tokens), {target}::DOUBLE)"
        parts.append(f"s_{margin} AS (SELECT {margin}, {share} AS share FROM c0 GROUP BY {margin})")
        parts.append(
            f"g_{margin} AS MATERIALIZED (SELECT {margin}, share / (SELECT sum(share) FROM s_{margin}) * (SELECT sum(tokens) FROM c0) AS target FROM s_{margin})"
        )
    goals = ", ".join(f"g_{m}.target AS t_{m}" for m in MIX)
    step, factor = "w", "factor"
    for margin in MIX:
        now = f"sum(tokens * {factor}) OVER (PARTITION BY {margin})"
        step = f"(SELECT *, {factor} * CASE WHEN {now} > 0 THEN t_{margin} / {now} ELSE 1 END AS f_{margin} FROM {step} WHERE NOT ended)"
        factor = f"f_{margin}"
    errors = ", ".join(f"CASE WHEN t_{m} > 0 THEN abs(sum(tokens * {factor}) OVER (PARTITION BY {m}) / t_{m} - 1) ELSE 0 END" for m in MIX)
    measured = f"(SELECT *, greatest({errors}) AS error FROM {step})"
    worst = f"(SELECT *, max(error) OVER () AS now_worst, (n + 1) % {ROUNDS} = 0 AS due FROM {measured})"
    carried = f"source, lang, topic, tokens, {', '.join(f't_{m}' for m in MIX)}"
    return f"""WITH RECURSIVE {", ".join(parts)},
    w AS (SELECT 0 AS n, source, lang, topic, tokens, {goals}, factor, 'inf'::DOUBLE AS worst, false AS ended
      FROM c0 {" ".join(f"JOIN g_{m} USING ({m})" for m in MIX)}
      UNION ALL SELECT n + 1, {carried}, {factor}, CASE WHEN due THEN now_worst ELSE worst END,
        due AND (now_worst <= {TOLERANCE} OR now_worst > 0.9 * worst OR n + 1 = {ROUNDS * MEASUREMENTS}) FROM {worst}),
    raked AS MATERIALIZED (SELECT * FROM w WHERE ended),
    scale AS (SELECT sum(tokens * factor) / sum(tokens) / {MIX_SIZE}::DOUBLE AS unit FROM raked),
    rates AS (SELECT source, lang, topic, factor / unit AS rate FROM raked, scale),
    expected AS (SELECT r.*, CASE WHEN n_tokens > 0 THEN rate ELSE least(rate, 1) END AS copies FROM r JOIN rates USING (source, lang, topic)),
    drawn AS (SELECT *, list_concat([1.0::DOUBLE FOR i IN range(floor(copies)::BIGINT)],
      CASE WHEN ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT::DOUBLE / 281474976710656.0::DOUBLE < copies - floor(copies)
      THEN [copies - floor(copies)] ELSE [] END) AS chances FROM expected)
    SELECT doc_id, source, lang, topic, n_tokens, round(probability, 6) AS probability
    FROM (SELECT doc_id, source, lang, topic, n_tokens, unnest(chances) AS probability FROM drawn)"""


ORACLES["op2_mixing"] = _mix_sql()


@_query
def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets of every document."""
    found = secrets(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", *digest_columns(F.col("spans"), [r.kind for r in BASE]))


@_query
def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth vector."""
    return nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@_query
def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation's digests, read back from the formatted output."""
    control = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", control), (-1, 1, "assistant", control)], "conv_id long, turn long, role string, text string")
    rows = _table(spark, sf_dir, "conversations").select(extra.columns).union(extra)
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return read_chats(spark, write_chats(rows, tokenizer), tokenizer)


@_query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity, learned from the labels of rows that are not held out."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, trained(docs, _table(spark, sf_dir, "labels"))).withColumnRenamed("toxic_score", "score")
    predicted = F.when(F.col("score") >= 0.5, 1).otherwise(0)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted"))


@_query
def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The personal data of every document."""
    found = personal_data(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", *digest_columns(F.col("spans"), BASE_KINDS))


@_query
def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's number of shingles and the component that links of 80 % overlap make."""
    members, _ = similar_sets(_table(spark, sf_dir, "documents"))
    return members.select("doc_id", "n_shingles", "component_id")


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLES["op11_ngram_join"] = f"""
WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS MATERIALIZED (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE list_distinct([array_to_string(w[i : i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS s FROM words),
held AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS MATERIALIZED (SELECT x.doc_id AS a, y.doc_id AS b FROM held x JOIN held y ON x.shingle = y.shingle AND x.doc_id < y.doc_id
  GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM sets UNION SELECT reach.doc_id, l.b FROM reach JOIN both_ways l ON l.a = reach.other),
lowest AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id FROM sets JOIN lowest USING (doc_id)"""


@_query
def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frequent word with its near words, the form it is a variant of, and the root of its forms."""
    return variants(_table(spark, sf_dir, "documents"))


@_query
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten documents that rank highest for every benchmark item."""
    return ranked(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), k=10)


_TERMS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
ORACLES["op13_ranked_search"] = f"""
WITH tf AS MATERIALIZED (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({_TERMS}) AS term FROM documents) GROUP BY ALL),
size AS MATERIALIZED (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id),
total AS MATERIALIZED (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM size),
weight AS MATERIALIZED (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, total GROUP BY term, docs),
norm AS MATERIALIZED (SELECT doc_id, 100 - 90 + (90 * n * docs) // terms AS m FROM size, total),
item AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
scored AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM item JOIN weight USING (term) JOIN tf USING (term) JOIN norm USING (doc_id) GROUP BY item_id, doc_id),
placed AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= 10"""
