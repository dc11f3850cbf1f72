"""Approximate nearest neighbours by a permutation index.

A vector is represented by the order of its ``prefix`` nearest pivots.  The
index is a set of inverted files: for each pivot, the vectors that have it in
their prefix, with its place there.  A query opens the files of its own
``opened`` nearest pivots, and vectors are ranked by the footrule distance of
the two orders over those pivots (one that a vector lacks counts as at place
``prefix``).  The best ``share`` of the vectors, at least ``least``, is reranked
by the exact measure.

Layout: the vectors are dealt by a hash of their identifier into shards of
about ``SHARD`` vectors.  A shard's inverted files and vectors are a few packed
rows; the index is written once.  Queries come in blocks of about ``BLOCK``; a
task takes one shard and one block, both of bounded size, and returns the best
k of the shard for each query; the best k of all shards are the result.

Equal vectors in a shard share one entry, which lists their identifiers in
order, so a vector that is very common crowds out no candidate, and ties go to
the smaller identifier.

Only the pivots are a sample: ``pivots`` of the first 4 x ``pivots`` distinct
vectors by a seeded hash.  Directions are taken from the sample's mean, so vectors
in a narrow cone are told apart too.  Pivots under cosine ``APART`` of those
before them come first, so a dense cluster has no more than a few; where these
are too few, closer ones fill up, farthest first.  Every vector is indexed.
"""

from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize, ship_package
from . import shared

PIVOTS = 256
PREFIX = 128
OPENED = 32
SHARE = 0.12
APART = 0.8
LEAST = 500
SHARD = 8_192
BLOCK = 2_048


def vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec): the rows that take part, vec as packed doubles.

    A vector is scaled by the power of two that brings its largest component near 1: exact, with no
    effect on cosines, and squares neither overflow nor vanish.

    Left out: null identifiers, and vectors that are null or empty, all zero, hold null or
    non-finite components, or differ in length from the most common length
    (of equally common ones, the smaller).
    """
    v = F.col("v")
    d = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    big = F.array_max(F.transform(v, F.abs))
    d = d.where(F.col("id").isNotNull() & v.isNotNull() & (F.size(v) > 0)).where(~bad).where(big > 0)
    # in two steps, as the factor of the smallest numbers is itself out of range
    power = F.floor(F.log2(big))
    half = F.floor(power / 2)
    two = F.lit(2.0)
    # the row is bound in a lambda of its own, so the factors are worked out once a row, not once a component
    row = F.struct(v.alias("v"), F.pow(two, -half).alias("a"), F.pow(two, half - power).alias("b"))
    scaled = F.transform(F.array(row), lambda r: F.transform(r["v"], lambda x: x * r["a"] * r["b"]))[0]
    d = d.select("id", scaled.alias("v"))
    dim = d.groupBy(F.size("v").alias("dim")).count().orderBy(F.col("count").desc(), "dim").first()
    return d.where(F.size("v") == (dim["dim"] if dim else 0))


class Pivots(NamedTuple):
    directions: np.ndarray  # unit vectors
    mean: np.ndarray        # of the sample, taken off every unit vector


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


def orders(x: np.ndarray, pivots: Pivots, prefix: int) -> np.ndarray:
    """The ``prefix`` nearest pivots of each vector, nearest first; ties to the smaller pivot number."""
    near = (unit(x) - pivots.mean) @ pivots.directions.T
    return np.argsort(-near, axis=1, kind="stable")[:, :prefix].astype(np.int16)


def choose(pool: np.ndarray, n: int) -> Pivots:
    """``n`` distinct directions of ``pool``, fewer only where it has fewer."""
    x = unit(pool)
    mean = x.mean(0)
    d = x - mean
    off = np.linalg.norm(d, axis=1) > 1e-9
    if not off.any():  # one direction: nothing to tell apart
        return Pivots(x[:1], np.zeros_like(mean))
    d = unit(d[off])
    closest = np.full(len(d), -1.0)  # each one's highest cosine to a pivot
    used: list[int] = []

    def use(i: int) -> None:
        used.append(i)
        np.maximum(closest, d @ d[i], out=closest)

    for i in range(len(d)):
        if len(used) < n and closest[i] < APART:
            use(i)
    while len(used) < n and closest.min() < 1 - 1e-12:
        use(int(closest.argmin()))
    return Pivots(d[used], mean)


def pick_pivots(vecs: DataFrame, n: int, seed: int) -> Pivots:
    """At most ``n`` pivots, from the first 4 n distinct vectors by hash."""
    hashed = vecs.select("v", F.xxhash64(F.lit(seed), "v").alias("h"))
    first = [r["h"] for r in hashed.select("h").distinct().orderBy("h").limit(4 * n).collect()]
    rows = hashed.where(F.col("h").isin(first)).groupBy("h").agg(F.min("v").alias("v")).orderBy("h").collect()
    if not rows:
        return Pivots(np.empty((0, 0)), np.empty(0))
    return choose(np.array([r["v"] for r in rows], np.float64), n)


# rows of the index: file >= 0 is a pivot's inverted file (members, places);
# -1 the entries' vectors, -2 their identifiers with the entry each belongs to
INDEX = "shard long, file int, members binary, places binary"


def build_index(vecs: DataFrame, pivots: Pivots, prefix: int = PREFIX, shard_rows: int = SHARD) -> DataFrame:
    """The inverted files of every shard, from ``vectors``; written to the shared folder."""
    shards = max(1, -(-vecs.count() // shard_rows))
    ship_package(vecs.sparkSession)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id", kind="stable")
        x, entry = np.unique(np.stack(pdf["v"].to_numpy()).astype("<f8"), axis=0, return_inverse=True)
        entry = entry.ravel()
        near = orders(x, pivots, prefix)
        pivot, place = near.ravel(), np.tile(np.arange(near.shape[1], dtype="<i2"), len(x))
        member = np.repeat(np.arange(len(x), dtype="<i4"), near.shape[1])
        by = np.argsort(pivot, kind="stable")
        cut = np.searchsorted(pivot[by], np.arange(len(pivots.directions) + 1))
        rows = [(i, member[by[a:b]].tobytes(), place[by[a:b]].tobytes()) for i, (a, b) in enumerate(zip(cut, cut[1:])) if b > a]
        rows.append((-1, x.tobytes(), b""))
        rows.append((-2, pdf["id"].to_numpy("<i8").tobytes(), entry.astype("<i4").tobytes()))
        out = pd.DataFrame(rows, columns=["file", "members", "places"])
        out.insert(0, "shard", int(pdf["shard"].iloc[0]))
        return out

    dealt = vecs.withColumn("shard", F.pmod(F.xxhash64(F.lit(7), "id"), F.lit(shards)))
    return shared.written(dealt.groupBy("shard").applyInPandas(run, INDEX), "ann-index")


def search_shard(index: pd.DataFrame, queries: pd.DataFrame, pivots: Pivots, k: int, prefix: int,
                 opened: int, share: float, least: int) -> pd.DataFrame:
    """Best k of a shard for every query of a block."""
    files = {f: (m, p) for f, m, p in zip(index["file"], index["members"], index["places"])}
    dim = len(pivots.mean)
    x = np.frombuffer(files[-1][0], "<f8").reshape(-1, dim)
    ids, entry = np.frombuffer(files[-2][0], "<i8"), np.frombuffer(files[-2][1], "<i4")
    by = np.lexsort((ids, entry))
    ids, start = ids[by], np.searchsorted(entry[by], np.arange(len(x) + 1))
    files = {f: (np.frombuffer(m, "<i4"), np.frombuffer(p, "<i2").astype(np.int32)) for f, (m, p) in files.items() if f >= 0}
    length = np.sqrt((x * x).sum(1))
    top = min(len(x), max(least, int(np.ceil(share * len(x)))))
    out: list[tuple[int, int, float]] = []
    qid, q = queries["id"].to_numpy(np.int64), np.stack(queries["v"].to_numpy()).astype(np.float64)
    near = orders(q, pivots, opened)
    for i in range(len(q)):
        # footrule distance, less what a vector without any of the query's pivots has
        score = np.zeros(len(x), np.int32)
        for place, pivot in enumerate(near[i].tolist()):
            if pivot in files:
                member, at = files[pivot]
                score[member] += prefix - np.abs(at - place)
        found = np.argpartition(-score, top - 1)[:top] if top < len(x) else np.arange(len(x))
        # per row sums, so that equal vectors score equally in every shard
        cos = (x[found] * q[i]).sum(1) / (length[found] * np.sqrt((q[i] * q[i]).sum()))
        cut = np.sort(cos)[-(k + 1)] if len(cos) > k + 1 else -np.inf
        hits: list[tuple[float, int]] = []
        for c, e in zip(cos[cos >= cut].tolist(), found[cos >= cut].tolist()):
            own = [v for v in ids[start[e]: min(start[e + 1], start[e] + k + 1)].tolist()]
            hits += [(-c, v) for v in own if v != qid[i]]
        hits.sort()
        out += [(int(qid[i]), v, -c) for c, v in hits[:k]]
    return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])


def search(index: DataFrame, queries: DataFrame, pivots: Pivots, k: int = 5, prefix: int = PREFIX,
           opened: int = OPENED, share: float = SHARE, least: int = LEAST, block_rows: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest found, by cosine, ties to the smaller identifier."""
    spark = index.sparkSession
    blocks = max(1, -(-queries.count() // block_rows))
    shards = index.agg(F.max("shard")).first()[0] + 1
    numbers = lambda n: F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))
    # each block of queries goes to every shard: a stated query set against all rows, in blocks
    left = index.withColumn("block", F.explode(numbers(blocks)))
    right = queries.withColumn("block", F.pmod(F.xxhash64(F.lit(11), "id"), F.lit(blocks))).withColumn(
        "shard", F.explode(numbers(shards)))

    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype(
                {"query_id": "int64", "vec_id": "int64", "score": "float64"})
        return search_shard(a, b, pivots, k, prefix, opened, share, least)

    ship_package(spark)
    found = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInPandas(
        run, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def nearest(df: DataFrame, queries, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 5,
            pivots: int = PIVOTS, prefix: int = PREFIX, opened: int = OPENED, share: float = SHARE,
            least: int = LEAST, seed: int = 42) -> DataFrame:
    """Each query's k nearest other rows of ``df`` by cosine: (query_id, rank, vec_id, score).

    ``queries`` is a condition on the identifier.  Rows that take no part (see
    ``vectors``) are neither queries nor candidates.  An identifier occurs
    once; rows that repeat one with the same vector are candidates once each,
    never for a query of that identifier.  With k or fewer candidates all are
    returned; an empty table gives no rows.
    """
    shared.require(df, id_col, vec_col)
    vecs = materialize(vectors(df, id_col, vec_col))
    p = pick_pivots(vecs, pivots, seed)
    if not len(p.directions):
        return vecs.sparkSession.range(0).selectExpr("id AS query_id", "int(id) AS rank", "id AS vec_id", "double(id) AS score")
    prefix = min(prefix, len(p.directions))
    index = build_index(vecs, p, prefix)
    return search(index, vecs.where(queries(F.col("id"))), p, k, prefix, opened, share, least)
