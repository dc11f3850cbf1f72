"""

Every query reads the given tables (mostly ``documents``) whole.  Parameters
that would not bite at sf0.01 (1,000 documents, one dedup batch) are set so
100 and a 12 % roll-up threshold.  Floating results are rounded in both
engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textprep.config import PrepConfig
from textprep.functions import text as T
from textprep.operators import dedup, lang, rank, similarity, stats, tokens
from textprep.operators.key_index import KeyIndex
from textprep.plans import pipeline as PL
from textprep.plans import reports as R
from textprep.session import ensure_checkpoint_dir, materialize, rows_frame, scratch_path
from textprep.sources import jsonl, manifest, tables

SMOKE_DIR = "/root/testdata/sf0.001"

# query parameters (see module docstring)
QCFG = PrepConfig(batch_size=100, shard_size=100, others_share=0.12)

_CACHE: dict[tuple, object] = {}


def _key(spark: SparkSession, *parts) -> tuple:
    return (spark.sparkContext.applicationId, *parts)


def _docs(spark: SparkSession, sf: str) -> DataFrame:
    k = _key(spark, "docs", sf)
    if k not in _CACHE:
        ensure_checkpoint_dir(spark)
        _CACHE[k] = tables.documents(spark, sf)
    return _CACHE[k]


def _profile(spark: SparkSession, sf: str) -> lang.LangProfile:
    k = _key(spark, "profile", sf)
    if k not in _CACHE:
        _CACHE[k] = lang.train_profile(_docs(spark, sf))
    return _CACHE[k]


def _clean_docs(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf).select("doc_id", "ord", T.clean_text(F.col("text")).alias("text"))


def _fates(spark: SparkSession, sf: str, cfg: PrepConfig = QCFG) -> DataFrame:
    k = _key(spark, "fates", sf, cfg)
    if k not in _CACHE:
        _CACHE[k] = materialize(PL.fates(_docs(spark, sf), _profile(spark, sf), cfg))
    return _CACHE[k]


def _kept(spark: SparkSession, sf: str, cfg: PrepConfig = QCFG) -> DataFrame:
    k = _key(spark, "kept", sf, cfg)
    if k not in _CACHE:
        _CACHE[k] = materialize(PL.kept_texts(_docs(spark, sf), _fates(spark, sf, cfg), cfg))
    return _CACHE[k]


def _kept_tokens(spark: SparkSession, sf: str, cfg: PrepConfig = QCFG) -> DataFrame:
    """(ord, text, n_tokens, tokens, pos, shard_id): the pipeline's output corpus."""
    k = _key(spark, "kept_tokens", sf, cfg)
    if k not in _CACHE:
        kept = _kept(spark, sf, cfg)
        vocab = tokens.build_vocab(kept)
        enc = tokens.encode(kept, vocab, "text", "ord")
        out = PL.shuffle_and_shard(kept.join(enc, "ord"), cfg)
        _CACHE[k] = materialize(out)
    return _CACHE[k]


def _r(c, n=4):
    return F.round(c, n)


# ---------------------------------------------------------------- text, PII

def q_clean_text(spark, sf):
    return _docs(spark, sf).select("doc_id", T.clean_text("text").alias("clean_text"))


def q_pii_replace(spark, sf):
    c = T.clean_text("text")
    r = T.replace_pii(c)
    return _docs(spark, sf).select("doc_id", r.alias("pii_text"), T.pii_found(c, r).alias("pii_found"))


def q_pii_replace_by_lang(spark, sf):
    c = T.clean_text("text")
    found = T.pii_found(c, T.replace_pii(c))
    return _docs(spark, sf).groupBy("lang", found.alias("pii_found")).agg(F.count(F.lit(1)).alias("n"))


def _pii_counts(spark, sf):
    return _docs(spark, sf).select("doc_id", T.pii_counts("text").alias("p")).select(
        "doc_id", *[F.col(f"p.{k}").cast("long").alias(k) for k in ("emails", "phones", "ssns", "total")]
    )


def q_pii_counts(spark, sf):
    return _pii_counts(spark, sf)


def q_pii_summary(spark, sf):
    return R.rounded(R.pii_summary(_pii_counts(spark, sf), "total"))


def q_pii_histogram(spark, sf):
    return R.rounded(stats.integer_histogram(_pii_counts(spark, sf), "total", 20, overflow=True))


# ---------------------------------------------------------------- language

def q_lang_profile(spark, sf):
    return lang.gram_counts(_docs(spark, sf))


def _detected(spark, sf):
    d = _docs(spark, sf)
    return lang.detect(d.select("ord", "text"), _profile(spark, sf), "text", "ord")


def q_lang_detect(spark, sf):
    return _detected(spark, sf).select(F.col("ord").alias("doc_id"), "lang", _r(F.col("prob")).alias("prob"))


def q_english_filter(spark, sf):
    return _detected(spark, sf).select(F.col("ord").alias("doc_id"), (F.col("lang") == "en").alias("is_english"))


def _held_out(spark, sf):
    """(ord, label, lang, prob) of documents with an odd id, by a profile trained on those with an even one."""
    k = _key(spark, "held_out", sf)
    if k not in _CACHE:
        d = _docs(spark, sf)
        profile = lang.train_profile(d.where(F.col("doc_id") % 2 == 0))
        odd = d.where(F.col("doc_id") % 2 != 0)
        det = lang.detect(odd.select("ord", "text"), profile, "text", "ord")
        _CACHE[k] = materialize(odd.select("ord", F.col("lang").alias("label")).join(det, "ord"))
    return _CACHE[k]


def q_lang_reliability(spark, sf):
    """Held-out accuracy by tenth of confidence: how far a confidence can be believed."""
    return R.rounded(R.reliability(_held_out(spark, sf), 10))


def q_lang_accuracy(spark, sf):
    """Accuracy on held-out documents (P5)."""
    j = _held_out(spark, sf)
    return j.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") == F.col("lang")).alias("correct")
    )


def q_lang_distribution(spark, sf):
    return R.rounded(R.lang_top(_detected(spark, sf), 5))


def q_lang_major_others(spark, sf):
    return R.rounded(R.lang_rollup(_detected(spark, sf), QCFG.others_share))


def q_lang_confidence(spark, sf):
    return R.rounded(R.lang_confidence(_detected(spark, sf)))


# ---------------------------------------------------------------- tokens

def q_token_pieces(spark, sf):
    return _clean_docs(spark, sf).select("doc_id", T.piece_count("text").cast("long").alias("n_pieces"))


def _doc_vocab(spark, sf):
    k = _key(spark, "doc_vocab", sf)
    if k not in _CACHE:
        _CACHE[k] = tokens.build_vocab(_clean_docs(spark, sf))
    return _CACHE[k]


def q_token_vocab(spark, sf):
    return _doc_vocab(spark, sf).select(F.col("token_id").cast("long").alias("token_id"), "piece", "freq")


def _doc_tokens(spark, sf):
    return tokens.encode(_clean_docs(spark, sf), _doc_vocab(spark, sf), "text", "ord")


def q_token_encode(spark, sf):
    return _doc_tokens(spark, sf).select(
        F.col("ord").alias("doc_id"),
        F.size("tokens").cast("long").alias("n_tokens"),
        F.array_join("tokens", " ").alias("tokens"),
    )


def q_token_decode(spark, sf):
    dec = tokens.decode(_doc_tokens(spark, sf), _doc_vocab(spark, sf), "tokens", "ord", "text")
    return dec.select(F.col("ord").alias("doc_id"), "text")


def q_token_special_errors(spark, sf):
    c = _clean_docs(spark, sf)
    return c.agg(F.count_if(T.has_special_token("text")).alias("n_special"), F.count(F.lit(1)).alias("n_docs"))


def q_length_filter(spark, sf):
    n = T.piece_count("text")
    return _clean_docs(spark, sf).select(
        "doc_id", n.cast("long").alias("n_tokens"), tokens.length_ok(n, 10, 1000).alias("in_window")
    )


def q_text_stats(spark, sf):
    s = T.text_stats("text")
    return _clean_docs(spark, sf).select(
        "doc_id",
        s["char_count"].cast("long").alias("char_count"),
        s["word_count"].cast("long").alias("word_count"),
        s["token_count"].cast("long").alias("token_count"),
        _r(s["avg_token_length"]).alias("avg_token_length"),
    )


def q_quality_score(spark, sf):
    return _docs(spark, sf).select("doc_id", _r(T.quality_score("text")).alias("score"))


# ---------------------------------------------------------------- dedup

def _dedup(spark, sf, scope):
    c = _clean_docs(spark, sf).select("ord", T.replace_pii(F.col("text")).alias("pt"))
    c = c.withColumn("key", dedup.text_key("pt"))
    scope_col = None
    if scope == "batch":
        b = rank.ordinal_rank(c.select("ord"), "ord", "sv").select(
            "ord", F.floor(F.col("sv") / F.lit(QCFG.batch_size)).alias("batch_id"))
        c = c.join(b, "ord")
        scope_col = "batch_id"
    m = dedup.mark_first(c, "key", "ord", scope_col)
    return m.select(F.col("ord").alias("doc_id"), "is_first")


def q_dedup_global(spark, sf):
    return _dedup(spark, sf, "global")


def q_dedup_batch(spark, sf):
    return _dedup(spark, sf, "batch")


def q_dedup_deliveries(spark, sf):
    """All documents in two deliveries, even and odd doc_id, through a stored key index (D1 over runs)."""
    c = _clean_docs(spark, sf).select("ord", dedup.text_key(T.replace_pii(F.col("text"))).alias("key"))
    c = materialize(c)
    index = KeyIndex(scratch_path(spark, f"keys-{abs(hash(sf))}"), 64)
    done = [index.first_ever(dedup.mark_first(c.where(F.col("ord") % 2 == d), "key"), d) for d in (0, 1)]
    return done[0].unionByName(done[1]).select(F.col("ord").alias("doc_id"), "is_first")


def q_token_duplicates(spark, sf):
    return R.rounded(dedup.duplicate_counts(_doc_tokens(spark, sf)))


# ---------------------------------------------------------------- pipeline

def q_record_fates(spark, sf):
    f = _fates(spark, sf)
    k = _kept(spark, sf).select("ord", "text")
    return f.join(k, "ord", "left").select(
        F.col("ord").alias("doc_id"), "reason", "lang", "pii_found",
        F.col("n_tokens").cast("long").alias("n_tokens"), "text",
    )


def q_drop_reasons(spark, sf):
    return PL.drop_reasons(_fates(spark, sf))


def q_drop_shares(spark, sf):
    return R.rounded(stats.with_share(PL.drop_reasons(_fates(spark, sf))))


def q_fate_accounting(spark, sf):
    return PL.accounting(_fates(spark, sf))


def q_data_flow(spark, sf):
    return R.rounded(R.flow(PL.accounting(_fates(spark, sf))))


def q_prepare_tokens(spark, sf):
    kt = _kept_tokens(spark, sf)
    return kt.select(F.col("ord").alias("doc_id"), F.size("tokens").cast("long").alias("n_tokens"),
                     F.array_join("tokens", " ").alias("tokens"))


def q_shuffle_rank(spark, sf):
    return _kept_tokens(spark, sf).select(F.col("ord").alias("doc_id"), "pos")


def q_shard_sizes(spark, sf):
    return _kept_tokens(spark, sf).groupBy("shard_id").agg(F.count(F.lit(1)).alias("n"))


def q_token_length_stats(spark, sf):
    return R.rounded(R.describe_table(_kept_tokens(spark, sf).select(F.size("tokens").alias("len")), "len"))


def q_token_length_histogram(spark, sf):
    return R.rounded(stats.histogram(_kept_tokens(spark, sf).select(F.size("tokens").alias("len")), "len", 50), 6)


def q_vocab_richness(spark, sf):
    return R.rounded(R.vocab_richness(_kept(spark, sf)), 6)


def q_vocab_histogram(spark, sf):
    k = _kept(spark, sf).select(T.unique_words_lower("text").alias("u"))
    return R.rounded(stats.histogram(k, "u", 30), 6)


def q_residual_pii(spark, sf):
    return R.rounded(R.residual_pii(_kept(spark, sf), QCFG.residual_pii_warn_pct))


def q_cosine_mean_all(spark, sf):
    return R.rounded(similarity.mean_cosine(_kept_tokens(spark, sf), "pos", "tokens"), 6)


def q_cosine_to_centroid(spark, sf):
    summary, hist = R.similarity_distribution(_kept_tokens(spark, sf))
    one = summary.select(F.col("count").alias("sequences"), "mean", "median")
    return R.rounded(hist.crossJoin(F.broadcast(one)), 6)


def q_cosine_pairs(spark, sf):
    """Mean, median and histogram of pairwise cosines over all output sequences."""
    summary, hist = R.pair_distribution(_kept_tokens(spark, sf))
    return R.rounded(hist.crossJoin(F.broadcast(summary)), 6)


def q_input_report(spark, sf):
    d = _docs(spark, sf)
    det = lang.detect(d.where(T.clean_text("text") != "").select("ord", "text"), _profile(spark, sf))
    return R.rounded(R.input_report(d.select("ord", "text"), det))


def q_output_report(spark, sf):
    acc = PL.accounting(_fates(spark, sf))
    return R.rounded(R.output_report(_kept_tokens(spark, sf), acc, None, QCFG.residual_pii_warn_pct))


def _derived_jsonl(spark, sf) -> str:
    """JSON-lines files derived from the tables, with the scan's edge cases:
    every document as an object line and as its raw text (not JSON), and every
    conversation turn as an object without ``text``."""
    k = _key(spark, "jsonl", sf)
    if k not in _CACHE:
        path = scratch_path(spark, f"jsonl-{abs(hash(sf))}")
        d = tables.table(spark, sf, "documents")
        c = tables.table(spark, sf, "conversations")
        lines = (
            d.select(F.to_json(F.struct("text")).alias("value"))
            .unionByName(d.select(F.regexp_replace("text", "[\\r\\n]+", " ").alias("value")))
            .unionByName(c.select(F.to_json(F.struct("conv_id", "turn", "role")).alias("value")))
        )
        lines.write.mode("overwrite").text(path, compression="gzip")
        _CACHE[k] = path
    return _CACHE[k]


def q_jsonl_tolerant_scan(spark, sf):
    path = _derived_jsonl(spark, sf)
    return jsonl.line_counters(jsonl.read_records(spark, path, "part-*"))


def q_jsonl_fates(spark, sf):
    """The waterfall over the derived JSON-lines files: every line's fate."""
    recs = jsonl.read_records(spark, _derived_jsonl(spark, sf), "part-*")
    f = PL.fates(recs, _profile(spark, sf), QCFG)
    return f.groupBy(F.coalesce(F.col("reason"), F.lit("kept")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def q_jsonl_line_order(spark, sf):
    """Global line numbers of documents written as ordered JSON lines and read back."""
    k = _key(spark, "ordered_jsonl", sf)
    if k not in _CACHE:
        _CACHE[k] = scratch_path(spark, f"ordered-{abs(hash(sf))}")
        d = tables.table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("text"), "doc_id")
        jsonl.write_text_jsonl(d, _CACHE[k], "doc_id")
    recs = jsonl.read_records(spark, _CACHE[k])
    return recs.select("ord", F.col("text").cast("long").alias("doc_id"))


def q_shard_record_shapes(spark, sf):
    """Shard lines as objects, bare lists and other JSON, read back by shape."""
    k = _key(spark, "shapes", sf)
    if k not in _CACHE:
        kt = _kept_tokens(spark, sf)
        path = scratch_path(spark, f"shapes-{abs(hash(sf))}")
        lines = (
            kt.select(F.to_json(F.struct("tokens")).alias("value"))
            .unionByName(kt.select(F.to_json(F.col("tokens")).alias("value")))
            .unionByName(tables.table(spark, sf, "documents").select(F.to_json(F.struct("doc_id")).alias("value")))
        )
        lines.write.mode("overwrite").text(path, compression="gzip")
        _CACHE[k] = path
    r = jsonl.read_token_records(spark, _CACHE[k], "part-*")
    return r.groupBy("shape").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when(F.col("tokens").isNotNull(), F.size("tokens")).otherwise(0)).cast("long").alias("tokens"),
    )


def q_prepare_text(spark, sf):
    return _kept(spark, sf).select(F.col("ord").alias("doc_id"), "text")


def q_prepare_dual(spark, sf):
    return _kept_tokens(spark, sf).select(F.col("ord").alias("doc_id"), "text",
                                          F.array_join("tokens", " ").alias("tokens"))


def _conv_fates(spark, sf):
    k = _key(spark, "conv_fates", sf)
    if k not in _CACHE:
        _CACHE[k] = materialize(PL.fates(tables.conversation_turns(spark, sf), _profile(spark, sf), QCFG))
    return _CACHE[k]


def q_drop_reasons_merged(spark, sf):
    """Reasons of the documents run plus those of the conversation-turns run."""
    return PL.merge_reasons(PL.drop_reasons(_fates(spark, sf)), PL.drop_reasons(_conv_fates(spark, sf)))


def q_residual_pii_histogram(spark, sf):
    """Residual report-pattern PII per output text, unit bins capped at 10."""
    k = _kept(spark, sf).select(T.pii_counts("text")["total"].alias("total"))
    return R.rounded(stats.integer_histogram(k, "total", 10, overflow=True))


def q_lexical_diversity_histogram(spark, sf):
    """Lexical diversity of output texts with words, 30 bins."""
    k = _kept(spark, sf).select(T.lexical_diversity("text").alias("d"))
    return R.rounded(stats.histogram(k, "d", 30), 6)


def q_token_bag(spark, sf):
    """Sparse bag-of-tokens vectors of the output sequences."""
    b = similarity.token_bag(_kept_tokens(spark, sf), "ord", "tokens")
    return b.select(F.col("id").alias("doc_id"), F.col("token").cast("long").alias("token"), "n")


def q_lang_confidence_histogram(spark, sf):
    """Distribution of detection confidence, 50 equal bins (A7's violin as a table).

    Confidence is binned at report precision (4 places): near 1.0 the bin
    width is tiny and the last bits of a float sum, which differ between
    engines, would otherwise move edges and densities.
    """
    p = _detected(spark, sf).select(F.round("prob", 4).alias("prob"))
    return R.rounded(stats.histogram(p, "prob", 50), 6)


def q_light_filter_counts(spark, sf):
    """Light filter over the derived JSON-lines records (P1, A3): lines, blank,
    malformed, light_empty (no text after stripping) and survivors."""
    recs = jsonl.read_records(spark, _derived_jsonl(spark, sf), "part-*")
    empty = ~F.col("malformed") & T.is_blank(F.coalesce(F.col("text"), F.lit("")))
    return recs.agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if("blank").alias("blank"),
        F.count_if("malformed").alias("malformed"),
        F.count_if(empty).alias("light_empty"),
        F.count_if(~F.col("malformed") & ~empty).alias("survivors"),
    )


def q_shard_assign(spark, sf):
    return _kept_tokens(spark, sf).select(F.col("ord").alias("doc_id"), "shard_id")


def q_shard_manifest(spark, sf):
    """Rows and checksum of every token shard the job's writer wrote, from the manifest beside them."""
    path = scratch_path(spark, f"shards-{abs(hash(sf))}")
    jsonl.write_shards(_kept_tokens(spark, sf), path)
    return materialize(manifest.read(spark, path))


def q_run_summary(spark, sf):
    """The run summary without its runtime (S11, A19): (key, value)."""
    acc = PL.accounting(_fates(spark, sf)).first()
    kt = _kept_tokens(spark, sf).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("shard_id").alias("s")).first()
    rows = [("records_after_cleaning", kt["n"]), ("shards", kt["s"]), ("shard_size", QCFG.shard_size),
            ("dropped_true", acc["dropped_true"]), ("dropped_reference", acc["dropped_ref"])]
    return rows_frame(spark, rows, "key string, value long")


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "clean_text": q_clean_text,
    "pii_replace": q_pii_replace,
    "pii_replace_by_lang": q_pii_replace_by_lang,
    "pii_counts": q_pii_counts,
    "pii_summary": q_pii_summary,
    "pii_histogram": q_pii_histogram,
    "lang_profile": q_lang_profile,
    "lang_detect": q_lang_detect,
    "english_filter": q_english_filter,
    "lang_accuracy": q_lang_accuracy,
    "lang_reliability": q_lang_reliability,
    "lang_distribution": q_lang_distribution,
    "lang_major_others": q_lang_major_others,
    "lang_confidence": q_lang_confidence,
    "token_pieces": q_token_pieces,
    "token_vocab": q_token_vocab,
    "token_encode": q_token_encode,
    "token_decode": q_token_decode,
    "token_special_errors": q_token_special_errors,
    "length_filter": q_length_filter,
    "text_stats": q_text_stats,
    "quality_score": q_quality_score,
    "dedup_global": q_dedup_global,
    "dedup_batch": q_dedup_batch,
    "dedup_deliveries": q_dedup_deliveries,
    "token_duplicates": q_token_duplicates,
    "record_fates": q_record_fates,
    "drop_reasons": q_drop_reasons,
    "drop_shares": q_drop_shares,
    "fate_accounting": q_fate_accounting,
    "data_flow": q_data_flow,
    "prepare_tokens": q_prepare_tokens,
    "shuffle_rank": q_shuffle_rank,
    "shard_sizes": q_shard_sizes,
    "token_length_stats": q_token_length_stats,
    "token_length_histogram": q_token_length_histogram,
    "vocab_richness": q_vocab_richness,
    "vocab_histogram": q_vocab_histogram,
    "residual_pii": q_residual_pii,
    "cosine_mean_all": q_cosine_mean_all,
    "cosine_to_centroid": q_cosine_to_centroid,
    "cosine_pairs": q_cosine_pairs,
    "input_report": q_input_report,
    "output_report": q_output_report,
    "jsonl_tolerant_scan": q_jsonl_tolerant_scan,
    "jsonl_line_order": q_jsonl_line_order,
    "jsonl_fates": q_jsonl_fates,
    "shard_record_shapes": q_shard_record_shapes,
    "prepare_text": q_prepare_text,
    "prepare_dual": q_prepare_dual,
    "drop_reasons_merged": q_drop_reasons_merged,
    "residual_pii_histogram": q_residual_pii_histogram,
    "lexical_diversity_histogram": q_lexical_diversity_histogram,
    "token_bag": q_token_bag,
    "lang_confidence_histogram": q_lang_confidence_histogram,
    "light_filter_counts": q_light_filter_counts,
    "shard_assign": q_shard_assign,
    "shard_manifest": q_shard_manifest,
    "run_summary": q_run_summary,
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the drop waterfall's reason counts on sf0.001 documents."""
    return q_drop_reasons(spark, SMOKE_DIR)


def _llm():
    """(queries, SQL) of the optional subpackage and pipeline; empty where they are not installed."""
    try:
        import corpus_pipeline
        from textprep.llm import queries as q
    except ModuleNotFoundError as e:
        if e.name not in ("corpus_pipeline", "textprep.llm"):  # a missing library is an error, not an absent subpackage
            raise
        return {}, {}
    sql = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return {**q.QUERIES, "pipeline": corpus_pipeline.run}, {**q.ORACLE, **sql}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**_QUERIES, **_llm()[0]}


def oracle_sql() -> dict[str, str]:
    from oracle_queries import ORACLE

    return {**ORACLE, **_llm()[1]}
