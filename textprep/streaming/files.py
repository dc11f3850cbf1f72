"""Arriving JSON-lines files through the same waterfall (re-aims the
reference's file-generator "streaming" reader).

``readStream`` picks up new ``*.jsonl`` files; each micro-batch runs the
batch waterfall with dedup scoped to the micro-batch (the counterpart of the
reference's per-batch dedup), or, with ``index``, over all micro-batches so far:
the micro-batch is a delivery of that key index.  Outputs are written per micro-batch id with
dynamic partition overwrite, so a replayed batch replaces its own output
instead of duplicating it (exactly-once files with the streaming checkpoint).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import PrepConfig
from ..operators import lang, rank
from ..operators.key_index import KeyIndex
from ..plans import pipeline as PL
from ..session import materialize
from ..sources import jsonl


def _batch(profile: lang.LangProfile, cfg: PrepConfig, out_dir: str, index: KeyIndex | None):
    def run(batch: DataFrame, batch_id: int) -> None:
        lines = rank.global_rank(
            batch.select("value", F.monotonically_increasing_id().alias("_m")), [F.col("_m")], "ord"
        ).select("ord", "value")
        recs = jsonl.parse_records(lines)
        fate = PL.fates(recs, profile, cfg.with_(dedup_scope="global"), index, batch_id)
        fate = materialize(fate)
        kept = PL.kept_texts(recs, fate, cfg).withColumn("batch_id", F.lit(batch_id))
        reasons = PL.drop_reasons(fate).withColumn("batch_id", F.lit(batch_id))
        for df, name in ((kept, "text"), (reasons, "drop_reasons")):
            (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("batch_id").parquet(os.path.join(out_dir, name)))
    return run


def start(spark: SparkSession, src_dir: str, out_dir: str, checkpoint: str,
          profile: lang.LangProfile, cfg: PrepConfig = PrepConfig(),
          available_now: bool = True, files_per_batch: int | None = None,
          index: KeyIndex | None = None) -> StreamingQuery:
    """Start the file stream; ``available_now`` processes what is there and stops."""
    reader = spark.readStream.option("pathGlobFilter", jsonl.GLOB)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    w = reader.text(src_dir).writeStream.foreachBatch(_batch(profile, cfg, out_dir, index)).option(
        "checkpointLocation", checkpoint
    )
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def merged_reasons(spark: SparkSession, out_dir: str) -> DataFrame:
    """Drop reasons summed over all micro-batches so far (A1)."""
    return PL.merge_reasons(spark.read.parquet(os.path.join(out_dir, "drop_reasons")).select("reason", "n"))
