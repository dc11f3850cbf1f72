"""Benchmark: the whole preparation job and its reports on ``$BENCH_SF_DIR``.

Prints one JSON line.  ``value`` is the end-to-end pipeline time (train the
language profile, waterfall, kept texts, vocabulary, encode, shuffle, shard,
write text/shards/combined/metadata); the other entries time individual
operators and the reports on the same data.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from textprep.config import PrepConfig  # noqa: E402
from textprep.functions import text as T  # noqa: E402
from textprep.operators import dedup, lang, similarity, stats, tokens  # noqa: E402
from textprep.plans import pipeline as PL  # noqa: E402
from textprep.plans import reports as R  # noqa: E402
from textprep.plans.run import run_pipeline  # noqa: E402
from textprep.session import build_session, materialize  # noqa: E402
from textprep.sources import tables  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    scratch = tempfile.mkdtemp(prefix="textprep-bench-")
    spark = build_session(cpus, shuffle_partitions=int(cpus) * 2)  # sets a checkpoint folder only if none is set
    docs = tables.documents(spark, sf_dir)
    n_docs = docs.count()
    cfg = PrepConfig()
    q: dict[str, float] = {}

    def timed(name, fn):
        t = time.time()
        out = fn()
        q[name] = round(time.time() - t, 3)
        return out

    # headline: the whole job
    t_all = time.time()
    profile = timed("lang_train", lambda: lang.train_profile(docs))
    summary = timed("prepare_run", lambda: run_pipeline(spark, docs, os.path.join(scratch, "out"), profile, cfg))
    total = time.time() - t_all

    # operators and reports on the same data
    timed("lang_detect", lambda: lang.detect(docs.select("ord", "text"), profile).agg(F.count_if(F.col("lang") == "en")).first())
    timed("dedup_global", lambda: dedup.mark_first(
        docs.select("ord", dedup.text_key(T.replace_pii(T.clean_text("text"))).alias("k")), "k", "ord"
    ).agg(F.count_if("is_first")).first())
    fate = timed("waterfall_batch", lambda: materialize(PL.fates(docs, profile, cfg)))
    kept = materialize(PL.kept_texts(docs, fate, cfg))
    vocab = timed("vocab", lambda: tokens.build_vocab(kept))
    enc = timed("encode", lambda: materialize(tokens.encode(kept, vocab)))
    timed("decode", lambda: tokens.decode(enc, vocab).count())
    sh = timed("shuffle_shard", lambda: materialize(PL.shuffle_and_shard(enc, cfg)))
    timed("input_report", lambda: (
        R.lang_confidence(lang.detect(docs.select("ord", "text"), profile)).collect(),
        R.pii_summary(docs.select(T.pii_counts("text")["total"].alias("total"))).collect(),
    ))
    timed("output_report", lambda: (
        R.describe_table(sh.select(F.size("tokens").alias("n")), "n").collect(),
        stats.histogram(sh.select(F.size("tokens").alias("n")), "n", 50).collect(),
        R.vocab_richness(kept).collect(),
        R.residual_pii(kept).collect(),
        dedup.duplicate_counts(sh).collect(),
    ))
    timed("cosine_to_centroid", lambda: [d.collect() for d in R.similarity_distribution(sh)])
    timed("cosine_mean_all", lambda: similarity.mean_cosine(sh, "pos", "tokens").collect())

    kept_n = summary["records_after_cleaning"]
    print(json.dumps({
        "metric": "prepare_end_to_end_sec",
        "value": round(total, 3),
        "unit": "sec",
        "queries": q,
        "sf": os.path.basename(sf_dir.rstrip("/")),
        "documents": n_docs,
        "records_kept": kept_n,
        "records_per_sec": round(n_docs / total, 1) if total else None,     # input records processed / s
        "kept_per_sec": round(kept_n / total, 1) if total else None,        # the reference's formula
        "drop_reasons": summary["drop_reasons"],
    }))
    spark.stop()


if __name__ == "__main__":
    main()
