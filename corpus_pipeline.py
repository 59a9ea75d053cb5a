"""A training corpus from ``documents``: five stages, each calling one operator of ``tidelog.llm``.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last
return rows with the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.decontam import decontaminate
from tidelog.llm.probminhash import deduplicated
from tidelog.llm.queries import MIX
from tidelog.llm.raking import mixed_rows
from tidelog.llm.rows import free_name
from tidelog.llm.tokenfile import read_blocks, token_files
from tidelog.llm.toxicity import score, trained
from tidelog.session import written

#: Expected tokens after mixing, as a multiple of those before.
SIZE = 1.0


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network, fitted on the labelled ones, rejects go."""
    net = trained(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    name = free_name(docs, "toxic_score")
    return score(docs, net, name).where(F.col(name) < 0.5).drop(name)


def without_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return deduplicated(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, up to its error budget, go."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are drawn, some several times, so that sources, languages and topics meet their target shares at the size that came in."""
    return mixed_rows(docs, MIX, size=SIZE)


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the corpus; each document's place, size and checksum as read back from them."""
    path = token_files(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return read_blocks(spark, path, with_ids=False)


STAGES = [
    ("toxicity", without_toxic),
    ("near-duplicates", without_duplicates),
    ("decontamination", without_benchmark),
    ("mixing", mixed),
    ("token files", tokenized),
]

#: A trained network decides the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
