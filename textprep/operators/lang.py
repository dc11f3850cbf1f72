"""Language identification as a Spark job.

A character 3-gram naive Bayes with add-``alpha`` smoothing.

* Training counts (lang, gram) pairs: each task counts its batch's grams with
  numpy (``lang_vec``) and emits one row per distinct pair, which Spark sums
  by key (so frequent grams never skew a task).
* The profile is one row per gram with a fixed-order weight array, one entry
  per language; it is checkpointed and its size measured.
* Scoring, fast path: the profile (under a size bound) is broadcast as sparse
  rows of gram codes (codes, row pointers, language index, weight) and each
  task scores the texts it reads with numpy: no gram rows, no shuffle.  Fallback for a larger profile: explode the
  grams, join the profile (broadcast under a row bound, else a shuffle join
  where AQE splits hot grams) and sum the weight arrays per document (partial
  sums map-side).

Score of language L for a document with K known grams (grams in the profile):
``log prior_L + K * log(alpha / (N_L + alpha * V)) + sum_g c_g * (log(n_gL + alpha) - log alpha)``,
which is the multinomial naive Bayes log-likelihood restricted to known grams.
Posterior by a stable softmax; the best language is the first maximum in
name order.  No known gram: ``unknown`` with probability 0.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import char_grams, clean_text
from ..session import BROADCAST_MAX_ROWS, broadcast_if_small, materialize, ship_package

UNKNOWN = "unknown"
MAX_LANGUAGES = 1000  # labels are collected to the driver; refuse anything unbounded
# the vectorised path broadcasts codes + weights; bound on their size in bytes
VEC_MAX_BYTES = 256 << 20


@dataclass
class LangProfile:
    langs: list[str]            # name order
    log_prior: list[float]
    log_unseen: list[float]     # log(alpha / (N_L + alpha * V))
    grams: DataFrame            # gram: string, w: array<double>
    n_grams: int
    broadcast: bool
    gram_size: int = 3
    arrays: object = None       # broadcast (codes, weights, ...) for the vectorised path, or None
    counts: DataFrame | None = None   # (lang, gram, n): the trained tables, for save/load
    docs: DataFrame | None = None     # (lang, d)
    alpha: float = 0.5


def _grams_of(text: Column, gram_size: int, sample_chars: int | None) -> Column:
    t = clean_text(text)
    if sample_chars is not None:
        t = F.substring(t, 1, sample_chars)
    return char_grams(t, gram_size)


def padded(text: Column, sample_chars: int | None = None, cleaned: bool = False) -> Column:
    """The string grams are taken from: `` lower(clean(text)) `` (optionally its first chars).

    ``cleaned``: the text is already whitespace-normalised, skip that pass.
    """
    t = text if cleaned else clean_text(text)
    if sample_chars is not None:
        t = F.substring(t, 1, sample_chars)
    return F.concat(F.lit(" "), F.lower(t), F.lit(" "))


def gram_counts(df: DataFrame, text_col: str = "text", label_col: str = "lang",
                gram_size: int = 3, vectorised: bool = True) -> DataFrame:
    """(lang, gram, n) over labelled rows.

    Vectorised (3-grams): each task counts its grams with numpy and emits one
    row per distinct (lang, gram) of its batch; Spark sums them by key.
    Otherwise one row per gram occurrence, aggregated map-side.
    """
    if vectorised and gram_size == 3:
        from . import lang_vec

        ship_package(df.sparkSession)
        src = df.select(F.col(label_col).alias("lang"), padded(F.col(text_col)).alias("u"))
        part = src.mapInArrow(lang_vec.count_arrow, "lang string, code long, n long")
        summed = part.groupBy("lang", "code").agg(F.sum("n").cast("long").alias("n"))
        return summed.select("lang", code_to_gram(F.col("code")).alias("gram"), "n")
    g = df.select(
        F.col(label_col).alias("lang"),
        F.explode_outer(_grams_of(F.col(text_col), gram_size, None)).alias("gram"),
    ).where(F.col("gram").isNotNull() & F.col("lang").isNotNull())
    return g.groupBy("lang", "gram").agg(F.count(F.lit(1)).alias("n"))


_M21 = (1 << 21) - 1


def code_to_gram(code: Column) -> Column:
    """The 3-code-point string of a gram code (21 bits per code point)."""
    hex8 = lambda e: F.lpad(F.hex(e), 8, "0")
    return F.decode(F.unhex(F.concat(
        hex8(F.shiftright(code, 42)), hex8(F.shiftright(code, 21).bitwiseAND(_M21)), hex8(code.bitwiseAND(_M21))
    )), "UTF-32")


def gram_to_code(gram: Column) -> Column:
    """Code of a 3-code-point gram: its UTF-32 code points packed into 63 bits."""
    b = F.encode(gram, "UTF-32")
    cp = [F.conv(F.hex(F.substring(b, 4 * i + 1, 4)), 16, 10).cast("long") for i in range(3)]
    return F.shiftleft(cp[0], 42).bitwiseOR(F.shiftleft(cp[1], 21)).bitwiseOR(cp[2])


def _vector_arrays(counts: DataFrame, nnz: int, v: int, langs, log_prior, log_unseen, alpha: float):
    """Broadcast the sparse profile when its size is under the bound (else None).

    Entries travel to the driver as Arrow (one row per (lang, gram), count
    measured first); the broadcast holds codes, row pointers, language
    indexes and weights.
    """
    from . import lang_vec

    if v * 16 + nnz * 12 > VEC_MAX_BYTES:
        return None
    names = F.array(*[F.lit(x) for x in langs])
    t = counts.select(
        (F.array_position(names, F.col("lang")) - 1).cast("int").alias("li"),
        gram_to_code(F.col("gram")).alias("code"),
        (F.log(F.col("n") + F.lit(alpha)) - F.lit(math.log(alpha))).alias("w"),
    ).toArrow()
    li = t.column("li").to_numpy()
    codes = t.column("code").to_numpy()
    w = t.column("w").to_numpy()
    payload = (*lang_vec.build_csr(li, codes, w), np.array(log_prior), np.array(log_unseen), list(langs), UNKNOWN)
    return counts.sparkSession.sparkContext.broadcast(payload)


def train_profile(df: DataFrame, text_col: str = "text", label_col: str = "lang",
                  gram_size: int = 3, alpha: float = 0.5,
                  broadcast_max_rows: int = BROADCAST_MAX_ROWS, vectorised: bool = True) -> LangProfile:
    """Train the gram profile from labelled rows (whole texts).

    ``vectorised`` selects numpy gram counting/scoring inside tasks; the
    row-wise join path is used otherwise, or when the profile is too large.
    """
    counts = materialize(gram_counts(df, text_col, label_col, gram_size, vectorised))
    docs = df.where(F.col(label_col).isNotNull()).groupBy(F.col(label_col).alias("lang")).agg(
        F.count(F.lit(1)).alias("d"))
    return profile_from_counts(counts, docs, gram_size, alpha, broadcast_max_rows, vectorised)


def profile_from_counts(counts: DataFrame, docs: DataFrame, gram_size: int = 3, alpha: float = 0.5,
                        broadcast_max_rows: int = BROADCAST_MAX_ROWS, vectorised: bool = True) -> LangProfile:
    """The profile from its tables: ``counts`` (lang, gram, n) and ``docs`` (lang, d)."""
    doc_n = {r["lang"]: r["d"] for r in docs.limit(MAX_LANGUAGES + 1).collect()}  # labels: a small set
    if len(doc_n) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} labels")
    # (lang, gram) pairs are unique, so entries are plain counts; distinct grams are one narrow aggregate
    per_lang = counts.groupBy("lang").agg(F.sum("n").alias("N"), F.count(F.lit(1)).alias("g")).collect()
    big_n = {r["lang"]: r["N"] for r in per_lang}
    nnz = sum(r["g"] for r in per_lang)
    langs = sorted(big_n)
    v = counts.select("gram").distinct().count()
    total_docs = sum(doc_n[lang] for lang in langs)
    log_prior = [math.log(doc_n[lang] / total_docs) for lang in langs]
    log_unseen = [math.log(alpha / (big_n[lang] + alpha * v)) for lang in langs]
    w = F.log(F.col("n") + F.lit(alpha)) - F.lit(math.log(alpha))
    weights = counts.groupBy("gram").agg(
        *[F.sum(F.when(F.col("lang") == lang, w)).alias(f"_w{i}") for i, lang in enumerate(langs)]
    ).select("gram", F.array(*[F.coalesce(F.col(f"_w{i}"), F.lit(0.0)) for i in range(len(langs))]).alias("w"))
    arrays = (_vector_arrays(counts, nnz, v, langs, log_prior, log_unseen, alpha)
              if vectorised and gram_size == 3 else None)
    if arrays is None:
        grams, hinted = broadcast_if_small(weights, broadcast_max_rows)
    else:  # only the fallback and the profile export read the row form; kept lazy
        grams, hinted = weights, False
    return LangProfile(langs, log_prior, log_unseen, grams, v, hinted, gram_size, arrays,
                       counts=counts, docs=docs, alpha=alpha)


def save_profile(profile: LangProfile, path: str) -> None:
    """Write the profile's tables (counts, docs per language) as Parquet."""
    profile.counts.write.mode("overwrite").parquet(f"{path}/counts")
    profile.docs.write.mode("overwrite").parquet(f"{path}/docs")


def load_profile(spark, path: str, alpha: float = 0.5, vectorised: bool = True) -> LangProfile:
    """A profile saved by ``save_profile`` (or any (lang, gram, n) + (lang, d) tables)."""
    return profile_from_counts(spark.read.parquet(f"{path}/counts"), spark.read.parquet(f"{path}/docs"),
                               3, alpha, BROADCAST_MAX_ROWS, vectorised)


def score(df: DataFrame, profile: LangProfile, text_col: str = "text", id_col: str = "ord",
          sample_chars: int | None = None) -> DataFrame:
    """(id, lang, prob) for every row that has at least one known gram."""
    k = len(profile.langs)
    grams = df.select(
        F.col(id_col),
        F.explode_outer(_grams_of(F.col(text_col), profile.gram_size, sample_chars)).alias("gram"),
    )
    joined = grams.join(profile.grams, "gram")
    sums = joined.groupBy(id_col).agg(
        F.count(F.lit(1)).alias("_k"), *[F.sum(F.col("w")[i]).alias(f"_s{i}") for i in range(k)]
    )
    scores = F.array(*[
        F.lit(profile.log_prior[i]) + F.col("_k") * F.lit(profile.log_unseen[i]) + F.col(f"_s{i}")
        for i in range(k)
    ])
    best = F.array_max(F.col("_sc"))
    denom = F.aggregate(F.col("_sc"), F.lit(0.0), lambda acc, s: acc + F.exp(s - best))
    langs = F.array(*[F.lit(x) for x in profile.langs])
    return (
        sums.select(F.col(id_col), scores.alias("_sc"))
        .select(
            F.col(id_col),
            F.element_at(langs, F.array_position(F.col("_sc"), best).cast("int")).alias("lang"),
            (F.lit(1.0) / denom).alias("prob"),
        )
    )


def detect_with(df: DataFrame, profile: LangProfile, text_col: str, keep: list[str],
                sample_chars: int | None = None, cleaned: bool = False) -> DataFrame:
    """``keep`` columns of every row plus its (lang, prob), scored in the task that
    holds the text when the profile is broadcastable (no shuffle, no gram rows);
    otherwise through the row-wise join of ``score`` on ``keep[0]`` (a unique id)."""
    if profile.arrays is None:
        det = detect(df.select(keep[0], text_col), profile, text_col, keep[0], sample_chars)
        return df.select(*keep).join(det, keep[0], "left")
    from . import lang_vec

    ship_package(df.sparkSession)
    bc = profile.arrays
    src = df.select(*keep, padded(F.col(text_col), sample_chars, cleaned).alias("u"))
    fields = [f for f in src.schema.fields if f.name in keep]
    schema = T.StructType(fields + [T.StructField("lang", T.StringType()), T.StructField("prob", T.DoubleType())])
    return src.mapInArrow(lambda it: lang_vec.score_arrow(it, bc, keep), schema)


def detect(df: DataFrame, profile: LangProfile, text_col: str = "text", id_col: str = "ord",
           sample_chars: int | None = None) -> DataFrame:
    """Every row of ``df`` (id, text) with its detected (lang, prob); unknown when no grams."""
    if profile.arrays is not None:
        return detect_with(df, profile, text_col, [id_col], sample_chars)
    s = score(df, profile, text_col, id_col, sample_chars)
    return (
        df.select(id_col).join(s, id_col, "left")
        .select(
            id_col,
            F.coalesce(F.col("lang"), F.lit(UNKNOWN)).alias("lang"),
            F.coalesce(F.col("prob"), F.lit(0.0)).alias("prob"),
        )
    )
