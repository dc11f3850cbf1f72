"""Input and output reports as tables (C8, C9; A3-A19).

Per-record metrics are computed as columns in one pass; reports are small
aggregates over them.  Plots of the reference become tables (bins, shares,
quartiles).  Long report form: (section, metric, value).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ..functions import text as T
from ..operators import stats
from ..session import rows_frame

# the pairwise sample of the output report needs this many sequences
MIN_SIMILARITY_SEQUENCES = 10


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round every floating column (engines sum floats in different orders)."""
    return df.select(*[
        F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, (DoubleType, FloatType))
        else F.col(f.name)
        for f in df.schema.fields
    ])


def pii_summary(df: DataFrame, total_col: str = "total") -> DataFrame:
    """texts, texts_with_pii, pii_rate_pct, total_pii, mean_pii_per_text."""
    t = F.col(total_col)
    return df.agg(
        F.count(F.lit(1)).alias("texts"),
        F.count_if(t > 0).alias("texts_with_pii"),
        F.coalesce(F.sum(t), F.lit(0)).cast("long").alias("total_pii"),
    ).select(
        "texts", "texts_with_pii",
        F.when(F.col("texts") > 0, F.col("texts_with_pii") / F.col("texts") * 100).otherwise(0.0).alias("pii_rate_pct"),
        "total_pii",
        F.when(F.col("texts") > 0, F.col("total_pii") / F.col("texts")).otherwise(0.0).alias("mean_pii_per_text"),
    )


def residual_pii(kept: DataFrame, warn_pct: float = 1.0, text_col: str = "text") -> DataFrame:
    """Report-pattern PII left in output texts, with the >warn_pct flag (A10)."""
    p = kept.select(T.pii_counts(text_col)["total"].alias("total"))
    return pii_summary(p).withColumn("warn", F.col("pii_rate_pct") > F.lit(warn_pct))


def lang_counts(detected: DataFrame) -> DataFrame:
    return stats.with_share(detected.groupBy("lang").agg(F.count(F.lit(1)).alias("n")))


def lang_top(detected: DataFrame, k: int = 5) -> DataFrame:
    """Top-k languages by count with share; ties by name."""
    return lang_counts(detected).orderBy(F.col("n").desc(), F.col("lang")).limit(k)


def lang_rollup(detected: DataFrame, min_share: float = 0.001) -> DataFrame:
    """Languages under ``min_share`` of the rows roll up into ``Others`` (A5)."""
    c = lang_counts(detected)
    g = F.when(F.col("pct") >= F.lit(min_share * 100), F.col("lang")).otherwise(F.lit("Others"))
    return stats.with_share(c.groupBy(g.alias("lang_group")).agg(F.sum("n").cast("long").alias("n")))


def reliability(df: DataFrame, bins: int = 10) -> DataFrame:
    """(bin, n, correct, accuracy, mean_prob, gap) per confidence bin of (label, lang, prob) rows.

    Confidence is binned at report precision (4 places).  Rows without a label
    take no part; empty bins are absent.
    """
    p = F.round("prob", 4)
    d = df.where(F.col("label").isNotNull()).select(
        F.least(F.floor(p * bins).cast("int"), F.lit(bins - 1)).alias("bin"), p.alias("p"),
        (F.col("label") == F.col("lang")).cast("int").alias("ok"))
    g = d.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.sum("ok").cast("long").alias("correct"), F.avg("p").alias("mean_prob"))
    acc = F.col("correct") / F.col("n")
    return g.select("bin", "n", "correct", acc.alias("accuracy"), "mean_prob", (F.col("mean_prob") - acc).alias("gap"))


def lang_confidence(detected: DataFrame) -> DataFrame:
    """docs, languages, mean and quartiles of detection confidence."""
    r = detected.agg(
        F.count(F.lit(1)).alias("docs"),
        F.count_distinct("lang").alias("languages"),
        F.avg("prob").alias("mean"), F.min("prob").alias("min"), F.max("prob").alias("max"),
    ).first()
    q = stats.exact_quantiles(detected, "prob", [0.25, 0.5, 0.75])
    row = (r["docs"], r["languages"], r["mean"], r["min"], q[0.25], q[0.5], q[0.75], r["max"])
    return rows_frame(
        detected.sparkSession, [row], "docs long, languages long, mean double, min double, q1 double, median double, q3 double, max double"
    )


def describe_table(df: DataFrame, col: str) -> DataFrame:
    """One-row table of ``stats.describe``."""
    d = stats.describe(df, col)
    return rows_frame(
        df.sparkSession, [(d["count"], d["mean"], d["median"], d["min"], d["max"], d["std"])],
        "count long, mean double, median double, min double, max double, std double",
    )


def flow(acc: DataFrame) -> DataFrame:
    """Data flow (A18): input, dropped, output with shares of input.

    ``input`` is output + true drops; ``input_reference`` adds ``pii_replaced``
    the way the reference draws it.
    """
    a = acc.select(
        (F.col("kept") + F.col("dropped_true")).alias("inp"), F.col("dropped_true").alias("drp"),
        F.col("kept").alias("out"), (F.col("kept") + F.col("dropped_ref")).alias("inp_ref"),
    )
    rows = F.array(
        F.struct(F.lit("input").alias("stage"), F.col("inp").alias("n")),
        F.struct(F.lit("dropped").alias("stage"), F.col("drp").alias("n")),
        F.struct(F.lit("output").alias("stage"), F.col("out").alias("n")),
        F.struct(F.lit("input_reference").alias("stage"), F.col("inp_ref").alias("n")),
    )
    return a.select(F.col("inp"), F.explode(rows).alias("r")).select(
        F.col("r.stage").alias("stage"), F.col("r.n").cast("long").alias("n"),
        F.when(F.col("inp") > 0, F.col("r.n") / F.col("inp") * 100).otherwise(0.0).alias("pct"),
    )


def vocab_richness(kept: DataFrame, text_col: str = "text") -> DataFrame:
    """Mean distinct lower-cased words and mean lexical diversity; texts without words skipped."""
    m = kept.select(
        T.word_count(text_col).alias("w"), T.unique_words_lower(text_col).alias("u"),
    ).where(F.col("w") > 0)
    return m.agg(
        F.count(F.lit(1)).alias("texts"),
        F.avg("u").alias("mean_unique_words"),
        F.avg(F.col("u") / F.col("w")).alias("mean_lexical_diversity"),
    )


def _long(spark, section: str, values: dict) -> DataFrame:
    rows = [(section, k, None if v is None else float(v)) for k, v in values.items()]
    return rows_frame(spark, rows, "section string, metric string, value double")


def input_report(records: DataFrame, detected: DataFrame, limit: int | None = None) -> DataFrame:
    """Input report (C8) as (section, metric, value).

    ``records``: (ord, text, blank, malformed) as from the JSON-lines scan, or
    any (ord, text) table; ``detected``: (ord, lang, prob) over the valid,
    non-empty records.  ``limit`` keeps the first N lines (L3).
    """
    spark = records.sparkSession
    r = records if limit is None else records.where(F.col("ord") < F.lit(limit))
    cols = r.columns
    blank = F.col("blank") if "blank" in cols else F.lit(False)
    mal = F.col("malformed") if "malformed" in cols else F.lit(False)
    err = blank | mal
    stripped_empty = T.clean_text(F.coalesce(F.col("text"), F.lit(""))) == ""
    pii_total = T.pii_counts(F.coalesce(F.col("text"), F.lit("")))["total"]
    m = r.select(
        err.alias("err"), (~err & stripped_empty).alias("empty"),
        F.when(~err & ~stripped_empty, pii_total).alias("pii"),
    ).agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if("err").alias("json_errors"),
        F.count_if("empty").alias("empty"),
        F.count("pii").alias("valid"),
        F.count_if(F.col("pii") > 0).alias("pii_texts"),
        F.coalesce(F.sum("pii"), F.lit(0)).alias("pii_total"),
    ).first()
    lc = lang_confidence(detected).first()
    valid = m["valid"]
    values = {
        "lines": m["lines"], "json_errors": m["json_errors"], "empty": m["empty"], "valid": valid,
        "languages": lc["languages"], "mean_confidence": lc["mean"], "median_confidence": lc["median"],
        "pii_texts": m["pii_texts"], "pii_rate_pct": (m["pii_texts"] / valid * 100) if valid else 0.0,
        "pii_total": m["pii_total"], "pii_mean_per_text": (m["pii_total"] / valid) if valid else 0.0,
    }
    return _long(spark, "input", values)


def output_report(corpus: DataFrame, fate_acc: DataFrame | None = None, runtime_sec: float | None = None,
                  warn_pct: float = 1.0) -> DataFrame:
    """Output report (C9) as (section, metric, value).

    ``corpus``: (text, tokens, shard_id) of the written output.  Records without
    a token list or a decoded text still count as records; duplicates and
    lengths are over the token lists, vocabulary and PII over the texts.
    ``fate_acc``: the one-row accounting table, for drops and flow.
    """
    from ..operators import dedup

    spark = corpus.sparkSession
    tot = corpus.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("shard_id").alias("shards")).first()
    listed = corpus.where(F.col("tokens").isNotNull())
    texts = corpus.where(F.col("text").isNotNull())
    dup = dedup.duplicate_counts(listed).first()
    lens = stats.describe(listed.select(F.size("tokens").alias("len")), "len")
    vr = vocab_richness(texts).first()
    rp = residual_pii(texts, warn_pct).first()
    values = {
        "records": tot["n"], "shards": tot["shards"],
        "duplicates": dup["duplicates"], "duplicate_pct": dup["duplicate_pct"],
        "token_len_mean": lens["mean"], "token_len_median": lens["median"], "token_len_min": lens["min"],
        "token_len_max": lens["max"], "token_len_std": lens["std"],
        "mean_unique_words": vr["mean_unique_words"], "mean_lexical_diversity": vr["mean_lexical_diversity"],
        "residual_pii_texts": rp["texts_with_pii"], "residual_pii_rate_pct": rp["pii_rate_pct"],
        "residual_pii_total": rp["total_pii"], "residual_pii_warn": float(rp["warn"]),
    }
    if fate_acc is not None:
        a = fate_acc.first()
        values.update({"dropped_true": a["dropped_true"], "dropped_reference": a["dropped_ref"],
                       "pii_replaced": a["pii_replaced"], "input_true": a["kept"] + a["dropped_true"]})
    if runtime_sec:
        values["records_per_sec"] = tot["n"] / runtime_sec  # A17: only when runtime > 0
    return _long(spark, "output", values)


def input_report_files(spark, raw_dir: str, profile, cfg=None) -> dict[str, DataFrame]:
    """The input report (C8) on ``*.jsonl`` files: summary and distribution tables."""
    from ..config import PrepConfig
    from ..operators import lang
    from ..sources import jsonl

    cfg = cfg or PrepConfig()
    recs = jsonl.read_records(spark, raw_dir)
    if cfg.report_sample_lines is not None:  # L3
        recs = recs.where(F.col("ord") < F.lit(cfg.report_sample_lines))
    valid = recs.where(~F.col("blank") & ~F.col("malformed") & (T.clean_text(F.col("text")) != ""))
    det = lang.detect(valid.select("ord", "text"), profile)
    return {
        "summary": input_report(recs, det),
        "languages_top": lang_top(det, 5),
        "languages_rollup": lang_rollup(det, cfg.others_share),
        "confidence": lang_confidence(det),
        "confidence_hist": stats.histogram(det.select(F.round("prob", 4).alias("prob")), "prob", 50),
        "pii_hist": stats.integer_histogram(valid.select(T.pii_counts("text")["total"].alias("total")), "total", 20, overflow=True),
    }


def read_output(spark, out_dir: str, decode_sample: int | None = None) -> DataFrame:
    """Written shards back as (pos, shard_id, tokens, text) in numeric shard order.

    ``text`` is decoded with the written vocabulary; with ``decode_sample`` only
    the first N positions are decoded (the rest keep a null text).
    """
    import os

    from ..operators import rank, tokens

    from ..sources import jsonl

    lines = jsonl.shard_lines(spark, os.path.join(out_dir, "shards"))
    value, tokens_of = jsonl.token_list(F.col("value"))
    sh = lines.select("shard_id", tokens_of.alias("tokens"), value.isNull().alias("_bad"), "_block", "_m")
    sh = sh.where(~F.col("_bad")).drop("_bad")
    ranked = rank.global_rank(sh, [F.col("shard_id"), F.col("_block"), F.col("_m")], "pos").drop("_block", "_m")
    vocab = spark.read.parquet(os.path.join(out_dir, "vocab"))
    todo = ranked if decode_sample is None else ranked.where(F.col("pos") < F.lit(decode_sample))
    text = tokens.decode(todo, vocab, "tokens", "pos", "text")
    return ranked.join(text, "pos", "left")


def similarity_distribution(corpus: DataFrame, id_col: str = "pos", tokens_col: str = "tokens",
                            bins: int = 50) -> tuple[DataFrame, DataFrame]:
    """(summary, histogram) of every sequence's cosine to the corpus centroid (how alike the
    corpus is as a whole; the pairs' own distribution, A22, is ``pair_distribution``)."""
    from ..operators import similarity
    from ..session import materialize

    cos = materialize(similarity.centroid_cosines(corpus, id_col, tokens_col))
    return describe_table(cos, "cosine"), stats.histogram(cos, "cosine", bins)


def pair_distribution(corpus: DataFrame, id_col: str = "pos", tokens_col: str = "tokens",
                      bins: int = 50) -> tuple[DataFrame, DataFrame]:
    """(summary, histogram) of pairwise cosines over all sequences (A22), estimated from a
    linear number of pairs; the summary's ``bound95`` is the error bound of its mean, and
    of the rank of its median."""
    from ..operators import similarity
    from ..session import materialize

    pairs = materialize(similarity.shifted_pairs(corpus, id_col, tokens_col))
    n = corpus.count()
    d = stats.describe(pairs, "cosine")
    summary = rows_frame(corpus.sparkSession, [(n, d["count"], d["mean"], d["median"], similarity.pair_sample_bound(n))],
                         "sequences long, pairs long, mean double, median double, bound95 double")
    return summary, stats.histogram(pairs, "cosine", bins)


def output_report_files(spark, out_dir: str, cfg=None) -> dict[str, DataFrame]:
    """The output report (C9) on a written output folder: summary and tables.

    Similarity is over all sequences: ``pair_cosine`` is the distribution over pairs,
    each sequence meeting a fixed number of others.  ``cosine_sample`` and ``cosine_hist``, the
    reference's pairs of the first sequences, are empty unless
    ``similarity_sample`` is set.
    """
    import os

    from ..config import DROP_REASONS, PrepConfig
    from ..operators import rank, similarity
    from ..session import materialize
    from .run import read_json_object

    cfg = cfg or PrepConfig()
    corpus = materialize(read_output(spark, out_dir, cfg.decode_sample))
    texts = corpus.where(F.col("text").isNotNull())
    meta = read_json_object(spark, os.path.join(out_dir, "pipeline_summary.json"))
    reasons = rows_frame(
        spark, sorted((meta.get("drop_reasons") or {}).items()), "reason string, n long"
    )
    dropped_true = sum(n for r, n in (meta.get("drop_reasons") or {}).items() if r in DROP_REASONS)
    pii = (meta.get("drop_reasons") or {}).get("pii_replaced", 0)
    kept = corpus.count()
    acc = rows_frame(spark, [(kept, dropped_true, dropped_true + pii, pii)],
                                "kept long, dropped_true long, dropped_ref long, pii_replaced long")
    runtime = meta.get("runtime_sec") or None
    centroid, centroid_hist = similarity_distribution(corpus)
    pairs, pairs_hist = pair_distribution(corpus)
    sample = rank.first_n(corpus, cfg.similarity_sample or 0, "pos")
    cos_summary, cos_hist = similarity.sample_cosine_stats(sample, "pos", "tokens", 50)
    if cos_summary.first()["sequences"] < MIN_SIMILARITY_SEQUENCES:  # the report's minimum
        cos_summary, cos_hist = cos_summary.limit(0), cos_hist.limit(0)
    lengths = corpus.where(F.col("tokens").isNotNull()).select(F.size("tokens").alias("len"))
    return {
        "summary": output_report(corpus, acc, runtime, cfg.residual_pii_warn_pct),
        "drop_shares": stats.with_share(reasons).orderBy(F.col("n").desc(), F.col("reason")),
        "flow": flow(acc),
        "token_length": describe_table(lengths, "len"),
        "token_length_hist": stats.histogram(lengths, "len", 50),
        "unique_words_hist": stats.histogram(texts.select(T.unique_words_lower("text").alias("u")), "u", 30),
        "lexical_diversity_hist": stats.histogram(texts.select(T.lexical_diversity("text").alias("d")), "d", 30),
        "residual_pii_hist": stats.integer_histogram(texts.select(T.pii_counts("text")["total"].alias("t")), "t", 10, overflow=True),
        "pair_cosine": pairs,
        "pair_cosine_hist": pairs_hist,
        "cosine_to_centroid": centroid,
        "cosine_to_centroid_hist": centroid_hist,
        "cosine_sample": cos_summary,
        "cosine_hist": cos_hist,
        "cosine_mean_all": similarity.mean_cosine(corpus, "pos", "tokens"),
    }
