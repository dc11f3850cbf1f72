"""Print the physical plans of the main operators in their at-scale form.

Auto-broadcast is switched off, so plans show what a large input gets:
only the explicit, size-checked broadcasts remain.
Usage: python tools/plans.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from textprep.config import PrepConfig  # noqa: E402
from textprep.operators import dedup, lang, tokens  # noqa: E402
from textprep.plans import pipeline as PL  # noqa: E402
from textprep.session import build_session, materialize  # noqa: E402
from textprep.sources import tables  # noqa: E402


def tree(df) -> str:
    plan = df._jdf.queryExecution().executedPlan().toString()
    keep = []
    for line in plan.splitlines():
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r"\[plan_id=\d+\]", "", line)
        keep.append(line[:160])
    return "\n".join(keep)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(8, 16)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    docs = tables.documents(spark, sf)
    prof = lang.train_profile(docs)
    cfg = PrepConfig()
    fate = materialize(PL.fates(docs, prof, cfg))
    kept = materialize(PL.kept_texts(docs, fate, cfg))
    vocab = tokens.build_vocab(kept)
    sections = {
        "language scoring with the features (one task, no shuffle)":
            lang.detect_with(docs.select("ord", T_clean(docs)), prof, "clean", ["ord"], cleaned=True),
        "first copies (dedup by key, join back on ord)":
            dedup.mark_first(docs.select("ord", dedup.text_key("text").alias("key")), "key", "ord"),
        "kept texts (the one text join)": PL.kept_texts(docs, fate, cfg),
        "encode (hot ids broadcast, partial collect_list per text)": tokens.encode(kept, vocab),
        "shuffle and shard (ids ranked, positions joined on ord)":
            PL.shuffle_and_shard(tokens.encode(kept, vocab), cfg)
            .repartition("shard_id").sortWithinPartitions("shard_id", "pos"),
    }
    for title, df in sections.items():
        print(f"### {title}\n\n```\n{tree(df)}\n```\n")


def T_clean(df):
    from textprep.functions.text import clean_text

    return clean_text(F.col("text")).alias("clean")


if __name__ == "__main__":
    main()
