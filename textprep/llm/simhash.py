"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints: texts are lower-cased (A-Z), split at ASCII white space and cut
into word shingles, repeats included.  A bit of the 64-bit fingerprint is 1 if
it is set in over half of the shingles' XXH64 hashes.

Search: the 64 bits are split into m partitions, correlated bits together.
Partition i gets a threshold t_i >= -1 with ``sum(t_i) = max_bits - m + 1``.
By the generalised pigeonhole principle two fingerprints within ``max_bits``
are within t_i in some partition i.  Dynamic programming picks the thresholds
(and m) with the least estimated rows and candidate pairs.  The estimate takes
the bits' co-occurrence counts over all fingerprints, and for each partition a
tree of its strongest dependencies.

Probe: a fingerprint posts its partition's value with up to t_i of its set
bits cleared, and the number of cleared bits as its level.  Values x and y
within t_i meet at ``x & y`` with levels that sum to at most t_i.

Verify: in each bucket of equal (partition, value) the full distance is
computed in numpy, over blocks of bounded size.  Buckets with many rows are
split into pairs of blocks, each pair a group of its own.  Linked fingerprints
leave a task as a spanning forest, never as all pairs.  Components follow from
alternating star contraction in Spark, each round checkpointed.

Only distinct fingerprints are searched; copies share theirs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import broadcast_if_small, materialize, ship_package
from . import shared

SEED = 42
BLOCK = 4_096  # fingerprints of a bucket that meet in one group
FOLD = 500_000  # links held before they are folded into a forest
CUT = 200_000  # shingles hashed at once
MAX_BROADCAST_BUCKETS = 200_000


# ------------------------------------------------------------ fingerprints

def fingerprint(text: bytes, shingle: int = 3) -> int:
    """Unsigned fingerprint of a UTF-8 text; no words: 0."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        cuts = [(0, len(line))]
    else:
        size = np.fromiter(map(len, words), np.int64, len(words))
        end = np.cumsum(size + 1) - 1
        cuts = list(zip((end - size)[: len(words) - shingle + 1].tolist(), end[shingle - 1:].tolist()))
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, len(cuts), CUT):
        h = np.array([digest(line[a:b], SEED) for a, b in cuts[at: at + CUT]], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(cuts), bitorder="little").view("<u8")[0])


def text_key(text_col: str = "text") -> Column:
    """SHA-256 of a text; null counts as empty."""
    return F.unhex(F.sha2(F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")), 256))


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                 keyed: bool = False) -> DataFrame:
    """(id, fp), ``keyed`` also key, the text's: fp is the fingerprint as a signed long.  Null text counts as empty."""
    shared.require(df, id_col, text_col)
    ship_package(df.sparkSession)
    extra = ["key"] if keyed else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [fingerprint(t or b"", shingle) for t in b.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.array(fps, np.uint64).view(np.int64)), *b.columns[2:]], names=["id", "fp", *extra])

    key = [text_key(text_col).alias("key")] if keyed else []
    return df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), *key).mapInArrow(
        run, "id long, fp long" + (", key binary" if keyed else ""))


# ------------------------------------------------------------ the plan

def co_occurrence(fps: DataFrame) -> tuple[int, np.ndarray]:
    """(rows, 64 x 64 counts of rows with both bits set), over all fingerprints."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, both = 0, np.zeros((64, 64))
        for b in batches:
            v = np.ascontiguousarray(b.column(0).to_numpy(zero_copy_only=False)).view(np.uint8)
            x = np.unpackbits(v.reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            n, both = n + len(x), both + (x.T @ x).astype(np.float64)
        cells = np.append(both.ravel(), n).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(4097)), pa.array(cells)], names=["cell", "n"])

    rows = fps.select("fp").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    cells = np.zeros(4097)  # 4,097 rows whatever the input
    for r in rows:
        cells[r["cell"]] = r["n"]
    return int(cells[4096]), cells[:4096].reshape(64, 64)


def correlation(n: int, both: np.ndarray) -> np.ndarray:
    p = np.diag(both) / max(n, 1)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    return np.abs((both / max(n, 1) - np.outer(p, p)) / np.outer(sd, sd))


def groups(corr: np.ndarray, m: int) -> list[list[int]]:
    """m partitions of the bits: each starts at the strongest pair left and grows by the most correlated bit."""
    corr = corr - 2 * np.eye(64)
    left, out = set(range(64)), []
    for i in range(m):
        width = 64 // m + (i < 64 % m)
        free = sorted(left)
        a, b = np.unravel_index(np.argmax(corr[np.ix_(free, free)]), (len(free), len(free)))
        group = [free[a], free[b]]
        while len(group) < width:
            rest = sorted(left - set(group))
            group.append(rest[int(np.argmax(corr[np.ix_(rest, group)].sum(1)))])
        out.append(sorted(group))
        left -= set(group)
    return out


def distances(n: int, both: np.ndarray, corr: np.ndarray, bits: list[int], upto: int) -> np.ndarray:
    """Chance that two fingerprints differ in 0..upto of ``bits``, cumulated.

    Bits form a tree (each joins the most correlated bit before it); a pair's
    state at a bit is (x, y), and a polynomial in the distance runs up the tree.
    """
    def table(child: int, parent: int) -> np.ndarray:  # P(child | parent)
        c, p, cp = both[child, child], both[parent, parent], both[child, parent]
        joint = np.array([[n - c - p + cp, c - cp], [p - cp, cp]]) + 0.5
        return joint / joint.sum(1, keepdims=True)

    parent, order = {}, [bits[0]]
    for _ in bits[1:]:
        rest = [b for b in bits if b not in order]
        c = corr[np.ix_(rest, order)]
        k, j = np.unravel_index(np.argmax(c), c.shape)
        parent[rest[k]] = order[j]
        order.append(rest[k])
    poly = {b: np.zeros((2, 2, upto + 1)) for b in bits}
    for b in bits:
        for x in (0, 1):
            for y in (0, 1):
                if (x != y) <= upto:
                    poly[b][x, y, int(x != y)] = 1.0
    for b in reversed(order[1:]):
        t = table(b, parent[b])
        up = np.einsum("px,qy,xyd->pqd", t, t, poly[b])
        own, new = poly[parent[b]], np.zeros((2, 2, upto + 1))
        for d in range(upto + 1):
            new[:, :, d:] += own[:, :, d, None] * up[:, :, : upto + 1 - d]
        poly[parent[b]] = new
    p1 = both[bits[0], bits[0]] / max(n, 1)
    root = np.array([1 - p1, p1])
    return np.cumsum(np.einsum("x,y,xyd->d", root, root, poly[bits[0]]))


def allocate(n: int, both: np.ndarray, max_bits: int, pair_cost: float = 0.1) -> list[tuple[int, int]]:
    """[(bit mask, threshold)] of the cheapest plan: rows posted + ``pair_cost`` x candidate pairs."""
    from math import comb

    corr, best = correlation(n, both), (float("inf"), [])
    for m in range(2, max_bits + 2):
        parts = groups(corr, m)
        cost = []
        for bits in parts:
            chance = distances(n, both, corr, bits, max_bits)
            ones = round(sum(both[b, b] for b in bits) / max(n, 1))
            cost.append([0.0] + [n * sum(comb(ones, i) for i in range(t + 1)) + pair_cost * n * n / 2 * chance[t]
                                 for t in range(max_bits + 1)])
        total = max_bits - m + 1
        # table: sum of (threshold + 1) so far -> (cost, thresholds)
        table = {0: (0.0, [])}
        for row in cost:
            new: dict[int, tuple[float, list[int]]] = {}
            for used, (c, ts) in table.items():
                for t, x in enumerate(row):
                    k = used + t
                    if k <= total + m and (k not in new or c + x < new[k][0]):
                        new[k] = (c + x, [*ts, t - 1])
            table = new
        c, ts = table[total + m]
        if c < best[0]:
            best = (c, [(sum(1 << b for b in bits), t) for bits, t in zip(parts, ts) if t >= 0])
    return best[1]


# ------------------------------------------------------------ probe, verify

def signatures(fps: DataFrame, plan: list[tuple[int, int]]) -> DataFrame:
    """(part, value, level, fp): every fingerprint at its partitions' values with up to t set bits cleared."""

    def cleared(fp: np.ndarray, value: np.ndarray, mask: int, most: int):
        level = [(fp, value, np.full(len(fp), 64, np.int64))]  # the next bit to clear lies below the last
        yield 0, fp, value
        bits = [b for b in range(64) if mask >> b & 1]
        for depth in range(1, most + 1):
            new = []
            for f, v, last in level:
                for b in bits:
                    on = ((v >> np.uint64(b)) & np.uint64(1)).astype(bool) & (last > b)
                    if on.any():
                        new.append((f[on], v[on] & ~np.uint64(1 << b), np.full(int(on.sum()), b, np.int64)))
            level = new
            for f, v, _ in level:
                yield depth, f, v

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for i, (mask, most) in enumerate(plan):
                for level, f, v in cleared(fp, fp & np.uint64(mask), mask, most):
                    n = len(f)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, i, np.int32)), pa.array(v.view(np.int64)),
                         pa.array(np.full(n, level, np.int32)), pa.array(f.view(np.int64))],
                        names=["part", "value", "level", "fp"])

    return fps.select("fp").mapInArrow(run, "part int, value long, level int, fp long")


def in_blocks(sigs: DataFrame, block: int = BLOCK) -> DataFrame:
    """Signatures with their group: the whole bucket (lo = hi = 0), or for a bucket over
    ``block`` rows every pair of blocks (lo, hi) that holds the row's own block."""
    big = (sigs.groupBy("part", "value").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block)
           .select("part", "value", F.ceil(F.col("n") / F.lit(block)).cast("int").alias("blocks")))
    big, _ = broadcast_if_small(big, MAX_BROADCAST_BUCKETS)
    own = F.pmod(F.xxhash64("fp", "level"), F.col("blocks")).cast("int")
    out = sigs.join(big, ["part", "value"], "left").withColumn("own", F.when(F.col("blocks").isNull(), 0).otherwise(own))
    other = F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(0)))
                      .otherwise(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return out.withColumn("other", other).select(
        "part", "value", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"),
        "level", "fp")


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) for every node of the links a-b that is not its component's smallest node."""
    nodes, inv = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = inv[: len(a)], inv[len(a):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        while (new != new[new]).any():
            new = new[new]
        if (new == root).all():
            break
        root = new
    own = root != np.arange(len(nodes))
    return nodes[own], nodes[root[own]]


def links_in(key: np.ndarray, level: np.ndarray, fp: np.ndarray, most: np.ndarray, max_bits: int):
    """Spanning links (a, b) of the pairs within ``max_bits`` in runs of equal ``key``.

    Rows are sorted by key and level.  Of a valid pair one level is at most
    ``most // 2``, so step k pairs the k-th such row of every run with the
    rows behind it.
    """
    n = len(key)
    start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    run = np.repeat(start, np.diff(np.r_[start, n]))  # first row of each row's run
    at = np.arange(n)
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size, k = 0, 0
    rows = at
    while True:
        # rows behind the k-th row of their run, while that row can be the lower partner
        rows = rows[rows - run[rows] > k]
        if not len(rows):
            break
        lead = run[rows] + k
        ok = level[lead] <= most[lead] // 2
        rows, lead = rows[ok], lead[ok]
        good = level[lead] + level[rows] <= most[rows]
        near = good & (np.bitwise_count(fp[lead] ^ fp[rows]) <= max_bits) & (fp[lead] != fp[rows])
        if near.any():
            held.append((fp[lead[near]], fp[rows[near]]))
            size += int(near.sum())
            if size > FOLD:
                held = [forest(np.concatenate([x for x, _ in held]), np.concatenate([y for _, y in held]))]
                size = len(held[0][0])
        k += 1
    if held:
        return forest(np.concatenate([x for x, _ in held]), np.concatenate([y for _, y in held]))
    return np.empty(0, np.uint64), np.empty(0, np.uint64)


def links(fps: DataFrame, max_bits: int, block: int = BLOCK) -> DataFrame:
    """(a, b): links that connect exactly the fingerprints of ``fps`` which pairs within ``max_bits`` connect."""
    n, both = co_occurrence(fps)
    plan = allocate(n, both, max_bits)
    top = np.array([t for _, t in plan])
    sigs = in_blocks(signatures(fps, plan), block)
    sigs = sigs.repartition("part", "value", "lo", "hi").sortWithinPartitions("part", "value", "lo", "hi", "level", "fp")

    def flush(d: pd.DataFrame) -> pa.RecordBatch:
        cols = [d[c].to_numpy() for c in ("part", "value", "lo", "hi")]
        new = np.zeros(len(d), bool)
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
        a, b = links_in(np.cumsum(new), d["level"].to_numpy(), d["fp"].to_numpy().view(np.uint64),
                        top[cols[0]], max_bits)
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None  # rows of the last group seen, which may go on in the next batch
        for b in batches:
            d = b.to_pandas()
            if not len(d):
                continue
            d = d if rest is None else pd.concat([rest, d], ignore_index=True)
            key = d[["part", "value", "lo", "hi"]].to_numpy()
            other = np.flatnonzero((key != key[-1]).any(axis=1))
            cut = int(other[-1]) + 1 if len(other) else 0
            if cut:
                yield flush(d.iloc[:cut])
            rest = d.iloc[cut:]
        if rest is not None:
            yield flush(rest)

    return sigs.mapInArrow(run, "a long, b long")


# ------------------------------------------------------------ components

def components(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the component's smallest node.

    Alternates large-star and small-star contraction until nothing changes;
    every round is checkpointed.  Stars shrink in map-side combined minima; the
    join back on a hub is an ordinary join, which adaptive execution splits.
    """
    e = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    mark = None
    for _ in range(rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        e = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = e.groupBy("u").agg(F.min("v").alias("m"))
        e = e.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("u"), F.col("m").alias("v")),
            F.struct(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")))).alias("e")).select("e.*")
        e = materialize(e.where("u <> v").distinct())
        new = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if new == mark:
            break
        mark = new
    else:
        raise RuntimeError(f"components not settled after {rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))


def cluster(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
            max_bits: int = 3) -> DataFrame:
    """(id_col, fp, component_id) for every row of ``df``.

    ``fp`` is the fingerprint as a signed long; ``component_id`` the smallest
    identifier reachable over links of at most ``max_bits`` differing bits,
    the row's own included.  Null texts count as empty; texts without words
    have fingerprint 0 and link like any other.  Rows with a null identifier
    take part and get their component's identifier (null if it has none).
    Repeated rows give repeated results.  An empty table gives an empty result.
    """
    fps = materialize(fingerprints(df, id_col, text_col, shingle))
    return fps.join(smallest(fps, F.col("id"), max_bits), "fp").select(
        F.col("id").alias(id_col), "fp", F.col("least").alias("component_id"))


def smallest(fps: DataFrame, what: Column, max_bits: int) -> DataFrame:
    """(fp, least): the smallest ``what``, nulls aside, of the component of each fingerprint."""
    distinct = materialize(fps.groupBy("fp").agg(F.min(what).alias("least")))
    parts = materialize(components(links(distinct, max_bits)))
    rooted = distinct.join(parts, distinct["fp"] == parts["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("least"))
    return rooted.drop("least").join(least, "root").select("fp", "least")


def drop_near(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
              max_bits: int = 3) -> DataFrame:
    """One row of every component of ``cluster``: that of the smallest identifier, and of its
    texts, where the identifier repeats, of the smallest SHA-256.

    A row goes by its identifier and text: other rows of the identifier are judged by their
    own component.  Of rows that repeat both, one stays (any, where other columns differ).
    Rows without an identifier take part in the links but stay.
    """
    fps = materialize(fingerprints(df, id_col, text_col, shingle, keyed=True))
    row = F.struct("id", "key")
    first = smallest(fps, F.when(F.col("id").isNotNull(), row), max_bits)
    rows = fps.where(F.col("id").isNotNull()).groupBy("id", "key").agg(
        F.first("fp").alias("fp"), F.count(F.lit(1)).alias("n"))
    judged = materialize(rows.join(first, "fp").select("id", "key", "n", (row == F.col("least")).alias("stays")))
    key = shared.fresh("key", df.columns)
    same = lambda a, b: (a[id_col] == b["id"]) & (a[key] == b["key"])
    keyed = df.withColumn(key, text_key(text_col))
    dropped = judged.where(~F.col("stays")).select("id", "key")
    out = keyed.join(dropped, same(keyed, dropped), "left_anti")
    repeated = judged.where(F.col("stays") & (F.col("n") > 1)).select("id", "key")
    if not repeated.isEmpty():
        once = out.join(repeated, same(out, repeated), "left_semi").dropDuplicates([id_col, key])
        out = out.join(repeated, same(out, repeated), "left_anti").unionByName(once)
    return out.select(*df.columns)
