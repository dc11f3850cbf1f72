"""The whole job (C5, C6, C7, S7-S11): records in, text + token shards + metadata out."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import PrepConfig
from ..operators import lang, tokens
from ..operators.key_index import KeyIndex
from ..session import materialize
from ..sources import jsonl
from . import pipeline as PL


def run_pipeline(spark: SparkSession, records: DataFrame, out_dir: str, profile: lang.LangProfile,
                 cfg: PrepConfig = PrepConfig(), vocab: DataFrame | None = None,
                 index: KeyIndex | None = None, delivery: int = 0) -> dict:
    """Run the waterfall on ``records`` (ord, text[, malformed]) and write under ``out_dir``:

    (each folder appears whole, when its write is committed)

    * ``text/``      cleaned kept texts as ``{"text": ...}`` lines, input order (S8)
    * ``shards/``    ``{"tokens": [...]}`` lines, ``shard_NNNN.jsonl`` (S7)
    * ``combined/``  every shard record, shard by shard (S9)
    * ``vocab/``     (token_id, piece, freq) parquet
    * ``drop_reasons.json``, ``pipeline_summary.json`` (S10, S11)

    Reasons, accounting and totals are observed by the jobs that write (A1, A2, A19).

    ``index``, ``delivery``: drop copies of earlier deliveries' texts (``pipeline.fates``).

    Returns the summary.
    """
    t0 = time.time()
    fate, seen = PL.observe_fates(PL.fates(records, profile, cfg, index, delivery))
    fate = materialize(fate)
    acc, reasons = PL.observed_accounting(seen)
    kept = materialize(PL.kept_texts(records, fate, cfg))
    jsonl.write_text_jsonl(kept, os.path.join(out_dir, "text"))
    v = vocab if vocab is not None else tokens.build_vocab(kept)
    v.write.mode("overwrite").parquet(os.path.join(out_dir, "vocab"))
    enc = tokens.encode(kept, v, "text", "ord")
    sharded = PL.shuffle_and_shard(enc, cfg)  # positions come from a checkpointed sort
    shards_dir = os.path.join(out_dir, "shards")
    written = jsonl.write_shards(sharded, shards_dir)
    jsonl.combine_shards(spark, shards_dir, os.path.join(out_dir, "combined"))
    n_shards = -(-acc["kept"] // cfg.shard_size)  # consecutive shards of shard_size
    runtime = time.time() - t0
    summary = {
        "records_after_cleaning": acc["kept"],
        "tokens_written": written["tokens"],
        "shards": n_shards,
        "shard_size": cfg.shard_size,
        "drop_reasons": reasons,
        "runtime_sec": runtime,
        # Records written per second, only when a runtime was measured
        "throughput_records_per_sec": (acc["kept"] / runtime) if runtime > 0 else None,
        "text_output": os.path.join(out_dir, "text"),
        "token_output": os.path.join(out_dir, "combined"),
        "accounting": acc,
    }
    _write_json(spark, os.path.join(out_dir, "drop_reasons.json"), reasons)
    _write_json(spark, os.path.join(out_dir, "pipeline_summary.json"), summary)
    return summary


def _write_json(spark: SparkSession, path: str, obj: dict) -> None:
    """Small metadata object as one JSON document (written by one task)."""
    # a one-row JVM-side frame: no Python-side job for a tiny write
    spark.range(1).select(F.lit(json.dumps(obj)).alias("value")).write.mode("overwrite").text(path)


def read_json_object(spark: SparkSession, path: str) -> dict:
    """Metadata written by ``_write_json`` back as a dict."""
    rows = spark.read.text(path).collect()
    return json.loads(rows[0]["value"]) if rows else {}


def run_jsonl(spark: SparkSession, src_dir: str, out_dir: str, profile: lang.LangProfile,
              cfg: PrepConfig = PrepConfig(), index: KeyIndex | None = None, delivery: int = 0) -> dict:
    """The reference's entry point: ``*.jsonl`` files in, outputs written."""
    recs = jsonl.read_records(spark, src_dir)
    return run_pipeline(spark, recs.select("ord", "text", "malformed",
                                           F.col("blank")), out_dir, profile, cfg, index=index, delivery=delivery)
