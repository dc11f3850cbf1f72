"""File stream: two arriving files, one micro-batch each."""

import json
import os

from pyspark.sql import functions as F

from textprep.config import PrepConfig
from textprep.operators import lang
from textprep.streaming import files


def test_stream_two_batches(spark, scratch):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    batches = [["one two three", "ONE TWO THREE", "hi"], ["one two three", "four five six", ""]]
    for i, texts in enumerate(batches):
        with open(os.path.join(src, f"f{i}.jsonl"), "w") as f:
            f.write("\n".join(json.dumps({"text": t}) for t in texts) + "\n")
    train = spark.createDataFrame([(t, "en") for b in batches for t in b if t], "text string, lang string")
    prof = lang.train_profile(train)
    out = os.path.join(scratch, "out")
    q = files.start(spark, src, out, os.path.join(scratch, "ckpt"), prof,
                    PrepConfig(min_tokens=3, max_tokens=6), files_per_batch=1)
    q.awaitTermination(120)
    kept = spark.read.parquet(os.path.join(out, "text"))
    per_batch = {r["batch_id"]: r["count"] for r in kept.groupBy("batch_id").count().collect()}
    # the copy in the second file is not a duplicate: dedup scope is the micro-batch
    assert sorted(per_batch.values()) == [1, 2]
    reasons = {r["reason"]: r["n"] for r in files.merged_reasons(spark, out).collect()}
    assert reasons == {"duplicate": 1, "length_filtered": 1}
    assert kept.where(F.col("text") == "one two three").count() == 2
