"""The corpus pipeline: documents in, packed training sequences out.

Each stage reads what its predecessor stored and decides on all of it, and hands
on every column of documents. Null texts count as empty, and empty ones are
scored, deduplicated and packed like others. Of rows that repeat an id, exact
copies of one text leave one row, and all rows of an id that is a near copy go.
An empty table stays empty through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saldero.llm import exact_index, near_duplicates, packing, toxicity
from saldero.llm.frames import fresh, quoted, read_table
from saldero.llm.queries import tokenizer_path
from saldero.session import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    labels = read_table(spark, sf_dir, "labels")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    weights = toxicity.learn(docs, labels, ~held_out)
    name = fresh(docs, "toxic_score")
    scored = toxicity.score(docs, weights, keep=docs.columns, score_col=name)
    return scored.where(F.col(name) < 0.5).drop(name)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text: the one with the largest id."""
    return exact_index.drop_copies(docs, scratch_path(spark, "digest-index"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the one with the smallest id."""
    groups = near_duplicates.near_duplicates(docs)
    dropped = groups.where("NOT kept").select("doc_id").distinct()
    kept = docs.join(dropped, "doc_id", "left_anti")
    return kept.select(*[F.col(quoted(c)) for c in docs.columns])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 4096 tokens."""
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("minhash_near_dedup", drop_near_copies),
    ("best_fit_packing", pack_sequences),
]

# The classifier and the tokenizer are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored before the next one reads it."""
    docs, folder = read_table(spark, sf_dir, "documents"), scratch_path(spark, "pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
