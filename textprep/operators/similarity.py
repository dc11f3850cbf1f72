"""Bag-of-tokens cosine similarity.

* ``token_bag``: sparse count vectors, ``explode -> groupBy(seq, token)``.
* ``mean_cosine``: the exact mean of all pairwise cosines of a whole corpus
  without forming pairs: with unit vectors u_i,
  ``sum_{i<j} u_i.u_j = (|sum_i u_i|^2 - #non-empty) / 2``, one aggregation by
  token.
* ``centroid_cosines``: each sequence's cosine to the corpus centroid
  ``sum_i u_i``, over all sequences.  The centroid's ``HOT_TOKENS`` most
  frequent tokens are broadcast, the others joined by token, so no join key
  holds more than a ``HOT_TOKENS``-th of the entries.
* ``shifted_pairs``: cosines of a linear number of pairs over all sequences: the
  seeded shuffle order shifted by the offsets 1..k, so every sequence meets k
  sequences behind it and k before it.  Sequences travel once, in blocks of
  consecutive positions plus the k that follow.  ``pair_sample_bound`` is the
  error bound of its mean and of its distribution function.
* ``pair_cosines``: the pairwise values of a bounded sample (the reference's
  first-N sequences).  Pairs are formed inside blocks: sequences are cut into
  blocks of ``block`` rows, each block's entries are replicated to its
  partner blocks, and the join is on (block pair, token); no join group holds
  more than ``block`` x ``block`` products whatever the token frequency.
  Pairs sharing no token are not materialised: their number comes from the
  count, and they are zeros below every other value.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, rows_frame
from . import stats

COSINE_DIGITS = 12
HOT_TOKENS = 16_384
PAIR_OFFSETS = 8
PAIR_BLOCK = 256  # consecutive positions of one task's group


def token_bag(df: DataFrame, id_col: str = "pos", tokens_col: str = "tokens") -> DataFrame:
    """(id, token, n): count of each token in each sequence."""
    return (
        df.select(F.col(id_col).alias("id"), F.explode_outer(tokens_col).alias("token"))
        .where(F.col("token").isNotNull())
        .groupBy("id", "token").agg(F.count(F.lit(1)).alias("n"))
    )


def unit_vectors(bag: DataFrame) -> DataFrame:
    """(id, token, w) with |w_id| = 1."""
    norms = bag.groupBy("id").agg(F.sqrt(F.sum(F.col("n") * F.col("n"))).alias("norm"))
    return bag.join(norms, "id").select("id", "token", (F.col("n") / F.col("norm")).alias("w"))


def mean_cosine(df: DataFrame, id_col: str = "pos", tokens_col: str = "tokens") -> DataFrame:
    """One row: sequences, pairs, mean pairwise cosine over the whole input."""
    n_seq = df.count()
    u = unit_vectors(token_bag(df, id_col, tokens_col))
    # one pass: per token the sum of unit weights and of their squares;
    # sum_i |u_i|^2 (= the number of non-empty sequences) is the second total
    per_token = u.groupBy("token").agg(F.sum("w").alias("s"), F.sum(F.col("w") * F.col("w")).alias("q"))
    r = per_token.agg(F.sum(F.col("s") * F.col("s")).alias("sq"), F.sum("q").alias("nq")).first()
    sq, nq = (r["sq"] or 0.0), (r["nq"] or 0.0)
    pairs = n_seq * (n_seq - 1) // 2
    mean = (sq - nq) / 2.0 / pairs if pairs else None
    return rows_frame(
        df.sparkSession, [(n_seq, pairs, mean)], "sequences long, pairs long, mean_cosine double"
    )


def row_vectors(df: DataFrame, id_col: str = "pos", tokens_col: str = "tokens") -> DataFrame:
    """(id, token, w) with |w_id| = 1, as ``unit_vectors`` of ``token_bag``, for ids that each have one row:
    made in the row, so nothing is shuffled.

    In the sorted tokens a token's count is the distance to where the next one begins.
    """
    t = df.select(F.col(id_col).alias("id"), F.sort_array(F.filter(tokens_col, lambda x: x.isNotNull())).alias("t"))
    t = t.where((F.size("t") > 0) & F.col("id").isNotNull())
    starts = F.filter(F.sequence(F.lit(1), F.size("t")),
                      lambda i: (i == 1) | (F.get("t", i - 1) != F.get("t", F.greatest(i - 2, F.lit(0)))))
    t = t.withColumn("at", starts)
    counts = F.transform("at", lambda i, k: F.coalesce(F.get("at", k + 1), F.size("t") + 1) - i)
    t = t.withColumn("n", counts)
    squares = F.aggregate("n", F.lit(0).cast("long"), lambda a, n: a + n.cast("long") * n)
    t = t.withColumn("norm", F.sqrt(squares.cast("double")))
    entries = F.inline(F.transform("at", lambda i, k: F.struct(
        F.get("t", i - 1).alias("token"), (F.get("n", k) / F.col("norm")).alias("w"))))
    return t.select("id", entries)


def centroid_cosines(df: DataFrame, id_col: str = "pos", tokens_col: str = "tokens") -> DataFrame:
    """(id, cosine): every sequence's cosine to the centroid of the unit vectors; 0 without tokens.

    Rows of one id are one sequence.  ``df`` is read several times: pass a checkpoint.
    """
    ids = df.select(F.col(id_col).alias("id"))
    if ids.groupBy("id").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > 1).isEmpty():
        u = row_vectors(df, id_col, tokens_col)
    else:
        u = materialize(unit_vectors(token_bag(df, id_col, tokens_col)))
    centroid = materialize(u.groupBy("token").agg(F.sum("w").alias("s"), F.count(F.lit(1)).alias("k")))
    length = centroid.agg(F.sqrt(F.sum(F.col("s") * F.col("s")))).first()[0] or 1.0
    hot = F.broadcast(centroid.orderBy(F.col("k").desc(), "token").limit(HOT_TOKENS).select("token", "s"))
    cold = u.join(hot, "token", "left_anti").join(centroid.select("token", "s"), "token")
    entries = u.join(hot, "token").select("id", "w", "s").unionByName(cold.select("id", "w", "s"))
    dots = entries.groupBy("id").agg((F.sum(F.col("w") * F.col("s")) / F.lit(length)).alias("c"))
    return ids.join(dots, "id", "left").select(
        "id", F.round(F.coalesce("c", F.lit(0.0)), COSINE_DIGITS).alias("cosine"))


def pair_sample_bound(n: int, confidence: float = 0.95) -> float | None:
    """With probability ``confidence`` over the shuffle, the mean of ``shifted_pairs`` is within
    this bound of the mean over all pairs, and so is, at any fixed cosine, the share of pairs
    up to it.

    Swapping two sequences of the order changes at most 4k of its kn pairs, each
    by at most 1, so the mean by at most 4/n; a bounded-difference inequality
    over random orders gives 2 exp(-2 t^2 / (n (4/n)^2)) for an error beyond t.
    With at most 2k + 1 sequences all pairs are taken, and the error is 0.
    """
    if n < 2:
        return None
    return 0.0 if n <= 2 * PAIR_OFFSETS + 1 else min(1.0, math.sqrt(8 * math.log(2 / (1 - confidence)) / n))


def shifted_pairs(df: DataFrame, id_col: str = "pos", tokens_col: str = "tokens",
                  offsets: int = PAIR_OFFSETS, block: int = PAIR_BLOCK) -> DataFrame:
    """(i, j, cosine): position i with positions i + 1 .. i + ``offsets``, round the end of the order.

    ``id_col``: dense 0-based position in a seeded shuffle.  No pair is taken
    twice: with n sequences the offsets end at n/2, which pairs only the first
    half.  A sequence without tokens (null or empty) has cosine 0 to all others.
    A group has ``block`` + ``offsets`` sequences, so no task holds more.  Dots and squared
    norms are whole numbers, so the cosines do not depend on any order of summing.
    """
    if block < offsets:
        raise ValueError("block must be at least the number of offsets")
    src = df.select(F.col(id_col).cast("long").alias("i"), F.col(tokens_col).cast("array<long>").alias("t"))
    n = src.count()
    reach = min(offsets, n // 2)
    if not reach:
        return rows_frame(df.sparkSession, [], "i long, j long, cosine double")
    last = (n - 1) // block
    # a row lies in its own block, in the one before for that block's last rows, and
    # once more behind the end of the order if it is among the first
    place = F.explode(F.array(F.col("i"), F.when(F.col("i") < reach, F.col("i") + n)))
    home = F.floor(F.col("v") / block)
    blocks = F.explode(F.array(home, F.when(F.col("v") % block < reach, home - 1)))
    rows = (
        src.select("t", place.alias("v")).where(F.col("v").isNotNull())
        .select("v", "t", blocks.alias("b")).where(F.col("b").between(0, last))
    )

    def pairs(key, pdf):
        pdf = pdf.sort_values("v")
        v = pdf["v"].to_numpy()
        bags = [np.unique(np.asarray([x for x in t if x is not None] if t is not None else [], np.int64), return_counts=True)
                for t in pdf["t"]]
        norm = np.array([float((c * c).sum()) for _, c in bags])
        sizes = [len(t) for t, _ in bags]
        row = np.repeat(np.arange(len(v)), sizes)
        token, count = (np.concatenate([b[k] for b in bags]) for k in (0, 1))
        _, token = np.unique(token, return_inverse=True)
        width = int(token.max()) + 1 if len(token) else 1
        at = row * width + token  # ascending
        begin = int(key[0]) * block
        own = (v >= begin) & (v < min(begin + block, n))
        out = []
        for d in range(1, reach + 1):
            left = np.flatnonzero(own & (v < n // 2) if 2 * d == n else own)
            right = np.searchsorted(v, v[left] + d)
            # each left row's entries among those of the row d places on
            mine = np.isin(row, left)
            partner = np.searchsorted(v, v[row[mine]] + d)
            want = partner * width + token[mine]
            found = np.minimum(np.searchsorted(at, want), len(at) - 1) if len(at) else want
            hit = at[found] == want if len(at) else np.zeros(0, bool)
            dot = np.bincount(row[mine][hit], count[mine][hit] * count[found[hit]], len(v))[left]
            length = np.sqrt(norm[left] * norm[right])
            cosine = np.divide(dot, length, out=np.zeros(len(left)), where=length > 0)
            out.append(pd.DataFrame({"i": v[left], "j": (v[left] + d) % n, "cosine": cosine}))
        return pd.concat(out)

    return rows.groupBy("b").applyInPandas(pairs, "i long, j long, cosine double")


def pair_cosines(df: DataFrame, id_col: str = "pos", tokens_col: str = "tokens",
                 block: int = 128) -> DataFrame:
    """(i, j, cosine) for i < j over pairs sharing at least one token.

    ``id_col`` must be a dense 0-based position (the sample's shuffled rank),
    which fixes the block of each sequence.
    """
    u = materialize(unit_vectors(token_bag(df, id_col, tokens_col)).withColumn(
        "b", F.floor(F.col("id") / F.lit(block)).cast("int")
    ))
    n_blocks = u.agg(F.max("b")).first()[0]
    if n_blocks is None:
        return rows_frame(df.sparkSession, [], "i long, j long, cosine double")
    # block pair (bi <= bj): left rows of block bi are sent to every bj >= bi,
    # right rows of block bj to every bi <= bj; a (bi, bj, token) group holds
    # at most ``block`` rows on each side.
    left = u.select(
        F.col("id").alias("i"), "token", F.col("w").alias("wi"), F.col("b").alias("bi"),
        F.explode(F.sequence(F.col("b"), F.lit(n_blocks))).alias("bj"),
    )
    right = u.select(
        F.col("id").alias("j"), "token", F.col("w").alias("wj"), F.col("b").alias("bj"),
        F.explode(F.sequence(F.lit(0), F.col("b"))).alias("bi"),
    )
    prod = left.join(right, ["bi", "bj", "token"]).where(F.col("i") < F.col("j"))
    # canonical to 12 places: a cosine that is exactly a bin edge (0.72 = 18/25)
    # must not fall on either side depending on the order of the float sum
    return prod.groupBy("i", "j").agg(F.round(F.sum(F.col("wi") * F.col("wj")), COSINE_DIGITS).alias("cosine"))


def sample_cosine_stats(df: DataFrame, id_col: str = "pos", tokens_col: str = "tokens",
                        bins: int = 50, block: int = 128) -> tuple[DataFrame, DataFrame]:
    """(summary, histogram) of all pairwise cosines of ``df`` including zero pairs.

    Summary: sequences, pairs, zero_pairs, mean, median.  Histogram: H1 with
    ``bins`` bins over [min, max]; zero pairs land in the first bin.
    """
    spark = df.sparkSession
    n_seq = df.count()
    pairs = n_seq * (n_seq - 1) // 2
    # read four times below (summary, median, range, bins): computed once
    pc = materialize(pair_cosines(df, id_col, tokens_col, block))
    agg = pc.agg(F.count(F.lit(1)).alias("k"), F.sum("cosine").alias("s"),
                 F.min("cosine").alias("lo"), F.max("cosine").alias("hi")).first()
    k = agg["k"]
    zeros = pairs - k
    mean = ((agg["s"] or 0.0) / pairs) if pairs else None
    median = stats.exact_quantiles(pc, "cosine", [0.5], offset_zeros=zeros)[0.5] if pairs else None
    summary = rows_frame(
        spark, [(n_seq, pairs, zeros, mean, median)],
        "sequences long, pairs long, zero_pairs long, mean double, median double",
    )
    if not pairs:
        return summary, rows_frame(spark, [], "bin int, lo double, hi double, n long, density double")
    lo = 0.0 if zeros else float(agg["lo"])
    hi = float(agg["hi"]) if k else 0.0
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / bins
    counts = pc.groupBy(stats.equal_width_bin(F.col("cosine"), lo, hi, bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("n")
    )
    zero_bin = int(min((0.0 - lo) * bins // (hi - lo), bins - 1))
    skeleton = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    n = F.coalesce(F.col("n"), F.lit(0)) + F.when(F.col("bin") == zero_bin, F.lit(zeros)).otherwise(F.lit(0))
    hist = skeleton.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        (F.lit(lo) + F.col("bin") * F.lit(width)).alias("lo"),
        (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("hi"),
        n.cast("long").alias("n"),
        (n / F.lit(pairs * width)).alias("density"),
    )
    return summary, hist
