"""Exact de-duplication.

First-copy-wins without a window over the key: a window partitioned by the
key would send a hot key (one text copied into a third of the corpus) to a
single task.  Instead ``groupBy(scope, key).agg(min(ord))`` aggregates
map-side (a hot key becomes one row per task before the shuffle), and the
winners are joined back on ``ord``, which is unique and spreads evenly.
Only (scope, 32-byte key, ord) is shuffled, never the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def text_key(text: Column | str) -> Column:
    """Dedup key: SHA-256 of the lower-cased text, as 32 bytes."""
    t = F.col(text) if isinstance(text, str) else text
    return F.unhex(F.sha2(F.lower(t), 256))


def mark_first(df: DataFrame, key_col: str, ord_col: str = "ord", scope_col: str | None = None,
               eligible: Column | None = None, out: str = "is_first") -> DataFrame:
    """Add ``out``: true for the lowest ``ord`` of each key (within scope).

    ``eligible`` limits which rows take part; others get null.
    """
    cand = df if eligible is None else df.where(eligible)
    keys = [key_col] if scope_col is None else [scope_col, key_col]
    firsts = cand.groupBy(*keys).agg(F.min(ord_col).alias(ord_col)).select(
        ord_col, F.lit(True).alias("_first")
    )
    marked = df.join(firsts, ord_col, "left")
    flag = F.coalesce(F.col("_first"), F.lit(False))
    if eligible is not None:
        flag = F.when(eligible, flag)
    return marked.withColumn(out, flag).drop("_first")


def sequence_key(tokens: Column | str) -> Column:
    """Key of a token sequence."""
    t = F.col(tokens) if isinstance(tokens, str) else tokens
    return F.unhex(F.sha2(F.array_join(t.cast("array<string>"), ","), 256))


def duplicate_counts(df: DataFrame, tokens_col: str = "tokens") -> DataFrame:
    """(total, unique, duplicates, duplicate_share) over token sequences."""
    k = df.select(sequence_key(tokens_col).alias("k"))
    per = k.groupBy("k").agg(F.count(F.lit(1)).alias("c"))
    return per.agg(
        F.coalesce(F.sum("c"), F.lit(0)).cast("long").alias("total"),
        F.count(F.lit(1)).alias("unique"),
    ).select(
        "total", "unique", (F.col("total") - F.col("unique")).alias("duplicates"),
        F.when(F.col("total") > 0, (F.col("total") - F.col("unique")) / F.col("total") * 100)
        .otherwise(F.lit(0.0)).alias("duplicate_pct"),
    )
