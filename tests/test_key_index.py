"""First copies over deliveries: the stored keys against one run over everything."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from textprep.config import PrepConfig
from textprep.operators import dedup, lang
from textprep.operators.key_index import KeyIndex
from textprep.plans import pipeline as PL
from textprep.streaming import files

WORDS = ["one", "two", "three", "four", "five"]


def random_texts(n, seed):
    r = random.Random(seed)
    return [" ".join(r.choices(WORDS, k=r.randint(0, 4))) for _ in range(n)]


def keyed(spark, texts, start):
    df = spark.createDataFrame([(start + i, t) for i, t in enumerate(texts)], "ord long, text string")
    return dedup.mark_first(df.withColumn("key", dedup.text_key("text")), "key")


def flags(df):
    return {r["ord"]: r["is_first"] for r in df.collect()}


def test_deliveries_keep_what_one_run_keeps(spark, scratch):
    index = KeyIndex(os.path.join(scratch, "keys"), 16)
    parts = [random_texts(60, s) + ["hot text"] * 40 for s in range(3)]
    parts.insert(2, [])  # an empty delivery
    got, seen, want = [], set(), {}
    for d, texts in enumerate(parts):
        got.append(flags(index.first_ever(keyed(spark, texts, 1000 * d), d)))
        for i, t in enumerate(texts):
            want[1000 * d + i] = t.lower() not in seen
            seen.add(t.lower())
    assert {k: v for g in got for k, v in g.items()} == want
    stored = index.keys(spark)
    assert stored.count() == stored.select("key").distinct().count() == len(seen)
    # a delivery run again, after later ones, decides as before and stores nothing twice
    assert flags(index.first_ever(keyed(spark, parts[1], 1000), 1)) == got[1]
    assert index.keys(spark).count() == len(seen)


def test_first_result_outlives_a_replay(spark, scratch):
    index = KeyIndex(os.path.join(scratch, "keys"))
    index.first_ever(keyed(spark, ["a", "b"], 0), 0)
    later = index.first_ever(keyed(spark, ["b", "c"], 10), 1)
    index.first_ever(keyed(spark, ["a", "b"], 0), 0)
    assert flags(later) == {10: False, 11: True}


def test_probe_reads_the_delivery_s_buckets_only(spark, scratch):
    index = KeyIndex(os.path.join(scratch, "keys"), 32)
    index.first_ever(keyed(spark, [str(i) for i in range(300)], 0), 0)
    assert index.keys(spark).select("bucket").distinct().count() == 32
    plan = index.earlier(spark, 1, [3, 7])
    read = {f.split("bucket=")[1].split("/")[0] for (f,) in plan.select(F.input_file_name()).distinct().collect()}
    assert read == {"3", "7"}
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in text and "bucket" in text.split("PartitionFilters")[1].split("]")[0]


def test_null_and_ineligible_rows_and_bad_arguments(spark, scratch):
    index = KeyIndex(os.path.join(scratch, "keys"), 1)
    df = spark.createDataFrame([(1, "a", True), (2, None, None), (3, "a", False)], "ord long, text string, ok boolean")
    df = df.withColumn("key", dedup.text_key("text"))
    marked = dedup.mark_first(df, "key", eligible=F.coalesce("ok", F.lit(False)))
    assert flags(index.first_ever(marked, 0)) == flags(marked)
    assert index.keys(spark).count() == 1
    for n in (0, 1 << 17):
        with pytest.raises(ValueError):
            KeyIndex("x", n)
    with pytest.raises(ValueError):
        PL.fates(df, None, PrepConfig(), index)


def test_waterfall_in_deliveries(spark, scratch):
    texts = random_texts(150, 9)
    rows = spark.createDataFrame(list(enumerate(texts)), "ord long, text string")
    prof = lang.train_profile(spark.createDataFrame([(w, "en") for w in WORDS], "text string, lang string"))
    cfg = PrepConfig(min_tokens=2, max_tokens=8, dedup_scope="global")
    want = {r["ord"]: r["reason"] for r in PL.fates(rows, prof, cfg).collect()}
    index = KeyIndex(os.path.join(scratch, "keys"), 8)
    got = {}
    for d, (lo, hi) in enumerate([(0, 40), (40, 41), (41, 150)]):
        part = PL.fates(rows.where((F.col("ord") >= lo) & (F.col("ord") < hi)), prof, cfg, index, d)
        got.update({r["ord"]: r["reason"] for r in part.collect()})
    assert got == want and "duplicate" in got.values()


def test_stream_drops_copies_of_earlier_batches(spark, scratch):
    src, out, ckpt = (os.path.join(scratch, x) for x in ("in", "out", "ckpt"))
    os.makedirs(src)
    batches = [["one two three", "ONE TWO THREE", "hi"], ["one two three", "four five six"], ["Four five six", "two two two"]]
    prof = lang.train_profile(spark.createDataFrame([(t, "en") for b in batches for t in b], "text string, lang string"))
    cfg = PrepConfig(min_tokens=3, max_tokens=6)
    index = KeyIndex(os.path.join(scratch, "keys"), 8)

    def run(i):
        with open(os.path.join(src, f"f{i}.jsonl"), "w") as f:
            f.write("\n".join(json.dumps({"text": t}) for t in batches[i]) + "\n")
        files.start(spark, src, out, ckpt, prof, cfg, index=index).awaitTermination(120)
        return sorted(r["text"] for r in spark.read.parquet(os.path.join(out, "text")).collect())

    assert run(0) == ["one two three"]
    assert run(1) == ["four five six", "one two three"]        # restarted from its checkpoint
    assert run(2) == ["four five six", "one two three", "two two two"]
    reasons = {r["reason"]: r["n"] for r in files.merged_reasons(spark, out).collect()}
    assert reasons == {"duplicate": 3, "length_filtered": 1}
