"""Command line: input report, the whole job, output report.

    python -m textprep RAW_DIR OUT_DIR (--train TABLE | --profile DIR) [options]

``--train`` is a Parquet table with ``text`` and ``lang`` columns; the
trained profile is saved under ``OUT_DIR/profile``.  Report tables are
written as JSON under ``OUT_DIR/reports``; the run summary is printed.
"""

from __future__ import annotations

import argparse
import json
import os

from pyspark.sql import SparkSession

from .config import PrepConfig
from .operators import lang
from .plans import reports
from .plans.run import run_jsonl
from .session import ensure_checkpoint_dir


def main(argv: list[str] | None = None, spark=None) -> dict:
    p = argparse.ArgumentParser(prog="python -m textprep")
    p.add_argument("raw_dir")
    p.add_argument("out_dir")
    src = p.add_mutually_exclusive_group(required=True)
    src.add_argument("--train", help="Parquet table with text and lang columns")
    src.add_argument("--profile", help="folder written by lang.save_profile")
    p.add_argument("--min-tokens", type=int, default=PrepConfig.min_tokens)
    p.add_argument("--max-tokens", type=int, default=PrepConfig.max_tokens)
    p.add_argument("--batch-size", type=int, default=PrepConfig.batch_size)
    p.add_argument("--dedup-scope", choices=["batch", "global"], default=PrepConfig.dedup_scope)
    p.add_argument("--shard-size", type=int, default=PrepConfig.shard_size)
    p.add_argument("--seed", type=int, default=PrepConfig.seed)
    p.add_argument("--no-pii", action="store_true")
    p.add_argument("--skip-reports", action="store_true")
    a = p.parse_args(argv)

    # master, memory and partitions are spark-submit's to set
    spark = spark or SparkSession.builder.appName("textprep").getOrCreate()
    ensure_checkpoint_dir(spark)
    cfg = PrepConfig(min_tokens=a.min_tokens, max_tokens=a.max_tokens, batch_size=a.batch_size,
                     dedup_scope=a.dedup_scope, shard_size=a.shard_size, seed=a.seed, do_pii=not a.no_pii)
    if a.train:
        profile = lang.train_profile(spark.read.parquet(a.train))
        lang.save_profile(profile, os.path.join(a.out_dir, "profile"))
    else:
        profile = lang.load_profile(spark, a.profile)

    def write(tables: dict, prefix: str) -> None:
        for name, df in tables.items():
            df.coalesce(1).write.mode("overwrite").json(os.path.join(a.out_dir, "reports", f"{prefix}_{name}"))

    if not a.skip_reports:
        write(reports.input_report_files(spark, a.raw_dir, profile, cfg), "input")
    summary = run_jsonl(spark, a.raw_dir, a.out_dir, profile, cfg)
    if not a.skip_reports:
        write(reports.output_report_files(spark, a.out_dir, cfg), "output")
    print(json.dumps(summary, default=str))
    return summary


if __name__ == "__main__":
    main()
