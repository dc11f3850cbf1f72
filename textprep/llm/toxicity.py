"""Toxicity scores: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Texts are lower-cased, ASCII other than letters and digits becomes a space,
and every 4- and 5-gram of characters is hashed to one of 2^20 features.  A
feature counts once per text, so one passage weighs the same in a short text
and in a long one.

Training (in Spark, then one small fit):

1. ``max_labelled`` labelled rows at most, the smallest by a seeded hash of
   their identifier, so the choice never depends on order or partitioning.
   They are broadcast (that many narrow rows) to the scan of the documents.
2. One pass counts, per feature, the toxic and the clean texts that have it;
   their smoothed log ratio r is the feature's scale.  The ``max_features``
   features whose counts stray furthest from independence are used.
3. A second pass gives each sampled text its used features (small integers);
   a logistic regression on r-scaled presence with an L2 penalty is fitted to
   them.  Sample and feature bounds limit what reaches the driver.

Scoring is one pass without a shuffle; the model is a few hundred KB.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from . import shared

BITS = 20
SIZES = (4, 5)
MAX_LABELLED = 20_000
MAX_FEATURES = 4_096
THRESHOLD = 0.3
SMOOTH = 0.5
PENALTY = 10.0
PIECE = 1 << 20  # characters hashed at once

_PLAIN = np.arange(128, dtype=np.uint32)
_PLAIN[[i for i in range(128) if not chr(i).isalnum()]] = 32
_SEEN = np.zeros(1 << BITS, np.int32)


def grams(text: str) -> Iterator[np.ndarray]:
    """Feature numbers of a text, repeats included, a bounded piece at a time."""
    for at in range(0, max(len(text), 1), PIECE):
        # pieces overlap by the longest gram, so none is lost at a seam
        part = text[max(0, at - max(SIZES) + 1): at + PIECE].lower()
        c = np.frombuffer(f" {part} ".encode("utf-32-le", "surrogatepass"), "<u4")
        c = np.where(c < 128, _PLAIN[np.minimum(c, 127)], c).astype(np.uint32)
        h = np.zeros(len(c), np.uint32)
        with np.errstate(over="ignore"):
            for n in range(1, max(SIZES) + 1):
                h = h[: max(0, len(c) - n + 1)] * np.uint32(0x01000193) + c[n - 1:]
                if n in SIZES:
                    yield ((h ^ (h >> np.uint32(15))) * np.uint32(0x9E3779B1) + np.uint32(n)) >> np.uint32(32 - BITS)


def distinct_grams(text: str) -> np.ndarray:
    """Each feature of a text once."""
    f = np.concatenate(list(grams(text)))
    at = np.arange(1, len(f) + 1, dtype=np.int32)
    _SEEN[f] = at
    return f[_SEEN[f] == at]


@dataclass(frozen=True)
class Model:
    features: np.ndarray  # sorted feature numbers
    weights: np.ndarray   # of the scaled features: coefficient x log-count ratio
    bias: float

    def table(self) -> np.ndarray:
        slots = np.zeros(1 << BITS, np.int32)
        slots[self.features] = np.arange(1, len(self.features) + 1)
        return slots

    def used(self, text: str, slots: np.ndarray) -> np.ndarray:
        """Sorted positions of the model's features that a text has."""
        return np.unique(np.concatenate([s[s > 0] for s in (slots[g] for g in grams(text))])) - 1

    def score(self, text: str, slots: np.ndarray) -> float:
        z = self.bias + float(self.weights[self.used(text, slots)].sum())
        return float(1 / (1 + np.exp(-z))) if z >= 0 else float(np.exp(z) / (1 + np.exp(z)))


def labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
             max_labelled: int, seed: int) -> DataFrame:
    """(id, text, label) of the sampled rows; texts meet their labels by broadcast."""
    one = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(
        F.col(id_col).alias("key")).agg(F.max(label_col).alias("label"))
    few = one.orderBy(F.xxhash64(F.lit(seed), "key"), "key").limit(max_labelled)
    return docs.select(F.col(id_col).alias("key"), F.coalesce(text_col, F.lit("")).alias("text")).join(
        F.broadcast(few), "key")


def fit_logistic(indptr: np.ndarray, cols: np.ndarray, scale: np.ndarray, y: np.ndarray,
                 penalty: float = PENALTY, steps: int = 120) -> tuple[np.ndarray, float]:
    """L2-penalised logistic regression on presence x ``scale`` (accelerated gradient)."""
    rows = np.repeat(np.arange(len(y)), np.diff(indptr))
    val = scale[cols]
    share = max(float(y.mean()), 1e-6)
    k, w, b = len(scale), np.zeros(len(scale)), float(np.log(share / max(1 - share, 1e-6)))
    norm = np.bincount(rows, val * val, minlength=len(y))  # per-row squared length
    # a step per feature group would be finer; diagonal scaling by feature mass is enough
    mass = np.bincount(cols, val * val, minlength=k) * 0.25 + penalty
    lift = np.sqrt(np.maximum(norm.mean(), 1.0))
    rate, mw, mb = 1.0 / lift, np.zeros(k), 0.0
    for step in range(steps):
        look_w, look_b = w + 0.9 * mw, b + 0.9 * mb
        z = np.bincount(rows, val * look_w[cols], minlength=len(y)) + look_b
        err = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        gw = np.bincount(cols, val * err[rows], minlength=k) + penalty * look_w
        gb = err.sum()
        mw = 0.9 * mw - rate * gw / mass
        mb = 0.9 * mb - rate * gb / (0.25 * len(y) + 1)
        w, b = w + mw, b + mb
    return w, b


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", max_labelled: int = MAX_LABELLED, max_features: int = MAX_FEATURES,
          seed: int = 42) -> Model:
    """Model of ``label_col`` (0 or 1), learned from the texts of ``docs`` that ``labels`` marks.

    Labels other than 0 and 1 and rows without an identifier are left out; of
    repeated labels the larger holds; repeated documents count as often as they
    occur.  Without labelled texts, or with one class only, the model has no
    features and scores every text by the (smoothed) share of that class.
    """
    shared.require(docs, id_col, text_col)
    shared.require(labels, id_col, label_col)
    ship_package(docs.sparkSession)
    sample = labelled(docs, labels, id_col, text_col, label_col, max_labelled, seed)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((2, (1 << BITS) + 1), np.int64)
        for b in batches:
            for text, label in zip(b.column("text").to_pylist(), b.column("label").to_pylist()):
                n[label, distinct_grams(text)] += 1
                n[label, -1] += 1
        f = np.flatnonzero(n.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(f), pa.array(n[0, f]), pa.array(n[1, f])], names=["f", "n0", "n1"])

    counted = sample.mapInArrow(count, "f long, n0 long, n1 long").groupBy("f").agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    sums = counted.where(F.col("f") == 1 << BITS).first()
    docs0, docs1 = (sums["n0"], sums["n1"]) if sums else (0, 0)
    bias = float(np.log((docs1 + 0.5) / (docs0 + 0.5)))
    if not docs0 or not docs1:
        return Model(np.empty(0, np.int64), np.empty(0), bias)

    n = F.col("n0") + F.col("n1")
    share = docs1 / (docs0 + docs1)
    stray = F.pow(F.col("n1") - n * share, 2) / (n * share * (1 - share))
    top = (counted.where((F.col("f") < 1 << BITS) & (n >= 3)).orderBy(stray.desc(), "f")
           .limit(max_features).toPandas().sort_values("f"))
    feats = top["f"].to_numpy(np.int64)
    ratio = np.log(((top["n1"].to_numpy() + SMOOTH) / (docs1 + 2 * SMOOTH))
                   / ((top["n0"].to_numpy() + SMOOTH) / (docs0 + 2 * SMOOTH)))
    bare = Model(feats, ratio, bias)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = bare.table()
        for b in batches:
            has = [bare.used(t, slots).astype("<u2").tobytes() for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("key"), b.column("label").cast(pa.int32()), pa.array(has, pa.binary())],
                                             names=["key", "label", "has"])

    rows = sample.select(F.col("key").cast("long").alias("key"), "text", "label").mapInArrow(
        pick, "key long, label int, has binary").toPandas().sort_values(["key", "has"], kind="stable")
    has = [np.frombuffer(h, "<u2").astype(np.int64) for h in rows["has"]]
    indptr = np.r_[0, np.cumsum([len(h) for h in has])]
    w, b = fit_logistic(indptr, np.concatenate(has), ratio, rows["label"].to_numpy(np.float64))
    return Model(feats, w * ratio, b)


def score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score") -> DataFrame:
    """Every row of ``docs`` with ``out``: 0 to 1, higher the likelier label 1.

    Whole texts are read; null counts as empty, and an empty text gets the
    model's score of no feature at all.  An existing column ``out`` is replaced.
    """
    shared.require(docs, text_col)
    ship_package(docs.sparkSession)
    docs = docs.drop(*[c for c in docs.columns if c.lower() == out.lower() and c != text_col])

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        slots = model.table()
        return pd.Series([model.score(t or "", slots) for t in texts], dtype="float64")

    return docs.withColumn(out, scored(F.col(text_col)))


def held_out(id_col: Column, part: int = 2, of: int = 4) -> Column:
    """Rows never learned from: CRC-32 of the identifier's text, modulo ``of``, is ``part``."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % of == part, F.lit(False))
