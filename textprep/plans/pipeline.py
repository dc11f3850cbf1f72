"""The drop waterfall and the pipeline around it.

Every input row gets exactly one fate, in this order::

    malformed -> light_empty -> empty -> non_english
      -> [annotate pii_found; rewrite text] -> duplicate
      -> tokenization_error -> length_filtered -> kept

Physical shape (what crosses a shuffle):

* the text is read and cleaned map-side into a narrow feature row per
  record: (ord, pii_found, 32-byte dedup key, piece count, special flag);
* the language is scored next to the features, in the same task (numpy over
  the Arrow batch, sparse broadcast profile), and the narrow table is
  checkpointed;
* the batch number (parity scope) comes from a two-level rank of that
  table by ord;
* first copies: ``groupBy(batch, key).min(ord)`` joined back on ord;
* only kept rows meet their text again, in one join on ``ord``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..config import DROP_REASONS, FATES, LIBRARY_DEFAULTS, PII_REPLACED, PrepConfig
from ..functions import text as T
from ..operators import dedup, lang, rank, tokens
from ..operators.key_index import KeyIndex
from ..session import materialize


def normalize_input(df: DataFrame) -> DataFrame:
    """(ord, text, malformed): a missing text is '' (hence empty), as in the reference."""
    cols = df.columns
    mal = F.col("malformed") if "malformed" in cols else F.lit(False)
    return df.select(
        F.col("ord").cast("long").alias("ord"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
        F.coalesce(mal, F.lit(False)).alias("malformed"),
    )


def _with_batch_ids(dec: DataFrame, cfg: PrepConfig) -> tuple[DataFrame, str | None]:
    """Checkpoint the decision table; for the batch scope, number its rows in
    ``ord`` order (distributed rank) and cut batches."""
    if cfg.dedup_scope not in ("batch", "global"):
        raise ValueError(f"dedup_scope must be 'batch' or 'global', got {cfg.dedup_scope!r}")
    # checkpoint first: the rank and both sides of the first-copy join read
    # this table, and each read would otherwise rerun the text features and
    # the language model
    dec = materialize(dec)
    if cfg.dedup_scope == "global":
        return dec, None
    ranked = rank.ordinal_rank(dec, "ord", "_sv")
    return ranked.withColumn("batch_id", F.floor(F.col("_sv") / F.lit(cfg.batch_size))).drop("_sv"), "batch_id"


def pii_text(clean: Column, cfg: PrepConfig) -> Column:
    return T.replace_pii(clean) if cfg.do_pii else clean


def fates(df: DataFrame, profile: lang.LangProfile, cfg: PrepConfig = PrepConfig(),
          index: KeyIndex | None = None, delivery: int = 0) -> DataFrame:
    """One row per input row: (ord, reason, lang, prob, pii_found, n_tokens).

    ``reason`` is null for kept rows; ``malformed`` and ``light_empty`` are
    bookkeeping fates outside the reference's drop reasons.  With ``index`` (global
    scope only) copies of texts of earlier deliveries are duplicates too, and the
    delivery's first copies are stored in it when this is called.
    """
    if index is not None and cfg.dedup_scope != "global":
        raise ValueError("a key index needs dedup_scope='global'")
    base = normalize_input(df)
    clean = T.clean_text(F.col("text"))
    staged = base.select("ord", "malformed", clean.alias("clean"))
    blank = F.col("clean") == ""
    survivors = staged.where(~F.col("malformed") & ~blank) if cfg.light_filter else staged.where(~F.col("malformed"))

    # narrow per-record features, computed where the text is read
    pt = pii_text(F.col("clean"), cfg)
    feats = survivors.select(
        "ord",
        "clean",
        (F.col("clean") == "").alias("is_empty"),
        (T.pii_found(F.col("clean"), pt) if cfg.do_pii else F.lit(False)).alias("pii_found"),
        dedup.text_key(pt).alias("key"),
        T.piece_count(pt).alias("n_tokens"),
        T.has_special_token(pt).alias("special"),
    )
    # language of each record next to its features (same task when the
    # profile is broadcastable, else one narrow join on ord)
    keep = ["ord", "is_empty", "pii_found", "key", "n_tokens", "special"]
    dec = lang.detect_with(feats, profile, "clean", keep, cfg.lang_sample_chars, cleaned=True)
    # the narrow decision table feeds both sides of the first-copy join: it is
    # checkpointed (for the batch scope by the sort that numbers survivors in
    # input order), so the text work and the language model run once
    dec, scope_col = _with_batch_ids(dec, cfg)
    english = ~F.col("is_empty") & (F.col("lang") == F.lit(cfg.target_lang))
    dec = dedup.mark_first(dec, "key", "ord", scope_col, eligible=english)
    if index is not None:
        dec = index.first_ever(dec, delivery)
    in_len = tokens.length_ok(F.col("n_tokens"), cfg.min_tokens, cfg.max_tokens)
    reason = (
        F.when(F.col("is_empty"), F.lit("empty"))
        .when(F.col("lang") != F.lit(cfg.target_lang), F.lit("non_english"))
        .when(~F.col("is_first"), F.lit("duplicate"))
        .when(F.col("special"), F.lit("tokenization_error"))
        .when(~in_len, F.lit("length_filtered"))
    )
    decided = dec.select(
        "ord",
        reason.alias("reason"),
        F.when(~F.col("is_empty"), F.col("lang")).alias("lang"),
        F.when(~F.col("is_empty"), F.col("prob")).alias("prob"),
        F.when(english, F.col("pii_found")).otherwise(F.lit(False)).alias("pii_found"),
        "n_tokens",
    )
    # records outside the waterfall (the anchored blank test stops at the first
    # non-space character, so this branch does not clean every text again)
    raw_blank = T.is_blank(F.col("text"))
    outside = base.where(F.col("malformed") | (raw_blank if cfg.light_filter else F.lit(False))).select(
        "ord",
        F.when(F.col("malformed"), F.lit("malformed")).otherwise(F.lit("light_empty")).alias("reason"),
        F.lit(None).cast("string").alias("lang"),
        F.lit(None).cast("double").alias("prob"),
        F.lit(False).alias("pii_found"),
        F.lit(None).cast("int").alias("n_tokens"),
    )
    return decided.unionByName(outside)


def kept_texts(df: DataFrame, fate: DataFrame, cfg: PrepConfig = PrepConfig()) -> DataFrame:
    """(ord, text, n_tokens) of kept rows: cleaned, PII-replaced text."""
    base = normalize_input(df)
    keep = fate.where(F.col("reason").isNull()).select("ord", "n_tokens")
    return base.join(keep, "ord").select(
        "ord", pii_text(T.clean_text(F.col("text")), cfg).alias("text"), "n_tokens"
    )


def drop_reasons(fate: DataFrame) -> DataFrame:
    """(reason, n): the reference's drop reasons plus ``pii_replaced`` (A1).

    Reasons with no rows are absent, like keys of a Counter.
    """
    drops = fate.where(F.col("reason").isin(*DROP_REASONS)).groupBy("reason").agg(
        F.count(F.lit(1)).alias("n")
    )
    pii = fate.agg(F.count_if(F.col("pii_found")).alias("n")).where(F.col("n") > 0).select(
        F.lit(PII_REPLACED).alias("reason"), "n"
    )
    return drops.unionByName(pii)


def merge_reasons(*tables: DataFrame) -> DataFrame:
    """Sum (reason, n) tables by reason (C2: caller's counts plus a batch's)."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out.groupBy("reason").agg(F.sum("n").cast("long").alias("n"))


def accounting(fate: DataFrame) -> DataFrame:
    """One row: total, malformed, light_empty, dropped_true, dropped_ref, pii_replaced, kept (A2)."""
    is_drop = F.col("reason").isin(*DROP_REASONS)
    return fate.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("reason") == "malformed").alias("malformed"),
        F.count_if(F.col("reason") == "light_empty").alias("light_empty"),
        F.count_if(is_drop).alias("dropped_true"),
        F.count_if(F.col("pii_found")).alias("pii_replaced"),
        F.count_if(F.col("reason").isNull()).alias("kept"),
    ).withColumn("dropped_ref", F.col("dropped_true") + F.col("pii_replaced"))


def accounting_from_counts(per_reason: list[tuple[str | None, int, int]]) -> tuple[dict, dict]:
    """(accounting, drop reasons) from (reason, rows, pii rows) triples.

    At most one triple per fate (eight), so they fit the driver; reasons follow ``drop_reasons``, accounting ``accounting``.
    """
    n = {r: c for r, c, _ in per_reason}
    pii = sum(p for _, _, p in per_reason)
    dropped = sum(n.get(r, 0) for r in DROP_REASONS)
    acc = {
        "total": sum(n.values()), "malformed": n.get("malformed", 0), "light_empty": n.get("light_empty", 0),
        "dropped_true": dropped, "pii_replaced": pii, "kept": n.get(None, 0), "dropped_ref": dropped + pii,
    }
    reasons = {r: n[r] for r in DROP_REASONS if n.get(r)}
    if pii:
        reasons[PII_REPLACED] = pii
    return acc, reasons


def observe_fates(fate: DataFrame) -> tuple[DataFrame, Observation]:
    """``fate`` with its counts observed by the action that writes it (A1, A2): no job of their own.

    The metrics sit on top of the plan, in the tasks that write, whose results Spark
    counts once however often a task is tried or a stage before it is run again.
    """
    seen = Observation()
    by_reason = [F.count_if(F.col("reason").eqNullSafe(F.lit(r))).alias(r or "kept") for r in FATES]
    return fate.observe(seen, *by_reason, F.count_if("pii_found").alias(PII_REPLACED)), seen


def observed_accounting(seen: Observation) -> tuple[dict, dict]:
    """(accounting, drop reasons) of ``observe_fates``, after the action."""
    m = seen.get
    return accounting_from_counts([(r, m[r or "kept"], 0 if r else m[PII_REPLACED]) for r in FATES])


def prepare(df: DataFrame, profile: lang.LangProfile, cfg: PrepConfig = LIBRARY_DEFAULTS,
            output: str = "dual", vocab: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Batch -> kept records + drop reasons (C1 tokens, C3 text, C4 dual).

    The default limits are the library functions' (5..1000 tokens); the whole
    job (``plans.run``) uses the pipeline's 10..1000.

    ``output``: "tokens" -> (ord, tokens); "text" -> (ord, text);
    "dual" -> (ord, text, tokens), one row each so 1:1 holds by construction.
    Token ids come from ``vocab`` or a vocabulary built over the kept texts.
    """
    fate = fates(df, profile, cfg)
    kept = kept_texts(df, fate, cfg)
    reasons = drop_reasons(fate)
    if output == "text":
        return kept.select("ord", "text"), reasons
    v = vocab if vocab is not None else tokens.build_vocab(kept)
    enc = tokens.encode(kept, v, "text", "ord")
    if output == "tokens":
        return enc, reasons
    if output != "dual":
        raise ValueError(f"output must be tokens, text or dual, got {output!r}")
    return kept.join(enc, "ord").select("ord", "text", "tokens"), reasons


def shuffle_and_shard(records: DataFrame, cfg: PrepConfig = PrepConfig(), id_col: str = "ord") -> DataFrame:
    """Seeded shuffle then consecutive shards (C6): adds pos, shard_id.

    Only the record ids are sorted (and checkpointed); positions join back on
    the id, so the token arrays are not sorted or written an extra time.
    """
    positions = rank.seeded_shuffle(records.select(id_col), id_col, cfg.seed, "pos")
    return rank.assign_shards(records.join(positions, id_col), cfg.shard_size, "pos")
