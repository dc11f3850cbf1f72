"""The document pipeline: toxicity, exact copies, near copies, the mix, tokens.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's ``docs``.  All but the last
return the columns of ``documents``, however many there are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textprep.llm import bpe, exact_dedup, mixing, shared, simhash, toxicity
from textprep.llm.queries import table, tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored under the threshold.  Labels of held-out rows are not learned from.
    Null and empty texts score like a text without features; null identifiers are scored too."""
    labels = table(spark, sf_dir, "labels").where(~toxicity.held_out(F.col("doc_id")))
    model = toxicity.train(docs, labels)
    score = shared.fresh("score", docs.columns)
    return toxicity.score(docs, model, out=score).where(F.col(score) < toxicity.THRESHOLD).select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of equal texts: the one with the largest identifier."""
    return exact_dedup.dedup(docs, keep="largest")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every SimHash component: the one with the smallest identifier; where
    that repeats, one of its rows.  Other rows of a repeated identifier are judged on their own.
    Documents without an identifier stay."""
    return simhash.drop_near(docs, shingle=3, max_bits=3)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the mix takes, once per copy, range-sorted by training position."""
    order = mixing.training_order(mixing.assign(docs))
    return order.select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per row of the mix: its token ids (packed little-endian 32-bit) and the digests of ids and decoded text."""
    return bpe.round_trip(docs.select("doc_id", "source", "text"), tokenizer_path()).select(
        "doc_id", "source", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("mixing sources", mix),
    ("BPE encoding and decoding", tokens),
]

# SQL expresses neither the classifier, the components nor the tokenizer: the
# tests hold every stage against a brute-force version instead (the mix: its
# copies, not their positions).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = shared.written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
