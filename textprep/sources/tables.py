"""Parquet corpora (the given tables)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str, least: int | None = None) -> DataFrame:
    """Hash-partition ``df`` by ``key`` when its scan has fewer splits than ``least`` (the cores).

    A large corpus arrives in many splits and is left alone.  A small file with
    a single row group would otherwise put every regex and gram of the corpus
    in one task.  The spread copy is checkpointed, so the branches that read
    it do not repeat the shuffle.
    """
    from ..session import materialize

    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= (cores if least is None else least):
        return df
    n = max(cores, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return materialize(df.repartition(n, key))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ord, text, lang, doc_id): ``doc_id`` is already the input order."""
    d = table(spark, sf_dir, "documents")
    return spread(d.select(F.col("doc_id").alias("ord"), "text", "lang", "doc_id"), "ord")


def conversation_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ord, text): conversation turns in (conv_id, turn) order, as a second corpus."""
    from ..operators.rank import global_rank

    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    return global_rank(c, [F.col("conv_id"), F.col("turn")], "ord").select("ord", "text")
