"""From raw documents to token ids: toxicity, exact dedup, near dedup, mixing, BPE.

Each stage takes ``(spark, docs, sf_dir)``; between stages the documents are written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edugauge.llm import bpe, exact_dedup, mixing, ngram_join, queries, toxicity
from edugauge.llm.common import crc_of_id, quoted, store


def set_aside(docs: DataFrame) -> DataFrame:
    """Columns that no stage reads under numbered names, so that no operator takes them for its own or writes over them."""
    read = {"doc_id", "text", "source"}
    return docs.toDF(*(c if c in read else f"__kept_{i}" for i, c in enumerate(docs.columns)))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity below 0.5, by a model of the labelled ones among them that are not held out."""
    apart = set_aside(docs)
    model = toxicity.fit(apart, queries.table(spark, sf_dir, "labels"), crc_of_id("doc_id") % 5 == 0)
    scored = toxicity.score(apart.withColumn("__llm_copy", F.col("text")), model, text_col="__llm_copy")
    return scored.filter("score < 0.5").select(*(quoted(c) for c in apart.columns)).toDF(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, A-Z in lower case: the largest id."""
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links by five-word shingles with a similarity of 0.8 or more: the smallest id."""
    return ngram_join.one_of_each(docs, shingle=5, num=80, den=100)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that the sources have equal shares."""
    apart = set_aside(docs)
    mixed = mixing.mix(apart, queries.MIX_WEIGHTS, epochs=1.0, seed=queries.MIX_SEED)
    return mixed.select(*(quoted(c) for c in apart.columns)).toDF(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, decoded again as a check of the round trip."""
    ranks, pattern = queries.vocabulary(spark)
    decoded = bpe.round_trip(docs.select("doc_id", "source", "text"), ranks, pattern)
    return decoded.select("doc_id", "source", bpe.token_count("ids").alias("n_tokens"), "ids", queries.sha(F.col("decoded")).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("ngram_join", drop_near_copies), ("mixing", mix_sources), ("bpe", encode)
]

#: Seeded training decides the first stage; SQL has no twin for it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored before the next."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
