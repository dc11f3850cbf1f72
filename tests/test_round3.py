"""Linear e-mail replacement, quantiles by selection, pair similarity, line order, sinks, histograms."""

import glob
import math
import os
import random
import re
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textprep.config import PrepConfig
from textprep.functions import text as T
from textprep.operators import lang, rank, similarity, stats, tokens
from textprep.plans import reports as R
from textprep.plans.run import run_jsonl
from textprep.session import broadcast_if_small
from textprep.sources import jsonl
from textprep.sources.commit import committed


# ------------------------------------------------------------ e-mails

@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="a@. \n\x1c é,", max_size=30), min_size=1, max_size=20))
def test_email_replacement_equals_python(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    want = {i: re.sub(r"\S+@\S+", "[EMAIL]", t) for i, t in enumerate(texts)}
    assert {r["i"]: r["r"] for r in df.select("i", T.replace_pii("t").alias("r")).collect()} == want


def test_email_replacement_is_linear(spark):
    run = "x" * 1_000_000
    df = spark.createDataFrame([(0, "a@b " + run), (1, run + "@"), (2, "@" + run), (3, run + "@" + run)], "i int, t string")
    df.select(T.replace_pii(F.lit("a@b")).alias("r")).limit(1).collect()
    t0 = time.time()
    got = {r["i"]: r["r"] for r in df.select("i", T.replace_pii("t").alias("r")).collect()}
    assert time.time() - t0 < 20  # quadratic work would take hours
    assert got == {0: "[EMAIL] " + run, 1: run + "@", 2: "@" + run, 3: "[EMAIL]"}


# ------------------------------------------------------------ quantiles

@pytest.mark.parametrize("values", [
    [0.0] * 900 + [float(i) for i in range(100)],
    [1e-300, 1e300, -1e300, 0.0, 5e-324] * 7,
    [math.exp(random.Random(1).gauss(0, 40)) for _ in range(1)] + [math.exp(random.Random(i).gauss(0, 40)) for i in range(500)],
    [3.0], [1.0, 2.0],
])
def test_quantiles_equal_numpy(spark, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),), (float("inf"),)], "x double")
    qs = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = stats.exact_quantiles(df, "x", qs)
    assert [got[q] for q in qs] == pytest.approx(np.quantile(np.array(values), qs).tolist(), rel=1e-12, abs=0)


def test_quantiles_of_nothing_and_zeros(spark):
    df = spark.createDataFrame([(4.0,), (6.0,)], "x double")
    assert stats.exact_quantiles(df.limit(0), "x", [0.5]) == {0.5: None}
    assert stats.exact_quantiles(df, "x", [0.5], offset_zeros=2)[0.5] == np.quantile([0, 0, 4, 6], 0.5)


def test_quantiles_do_not_gather_a_frequent_value(spark):
    """400,000 rows, 90 % equal: each task hands on one row for the value, and nothing is sorted."""
    df = spark.range(400_000, numPartitions=8).select(F.when(F.col("id") % 10 > 0, 1.0).otherwise(F.col("id") / 7).alias("x"))
    assert stats.exact_quantiles(df, "x", [0.5])[0.5] == 1.0
    table = df.groupBy("x").agg(F.count(F.lit(1)).alias("n"))
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "partial_count" in plan
    at = table.where("x = 1.0").collect()
    assert [r["n"] for r in at] == [360_000]


# ------------------------------------------------------------ pairs

def sequences(n, seed=7):
    r = random.Random(seed)
    return [None if i == 3 else [] if i == 5 else [r.choice([1, 2, 2, 3, 5, 8, 13, r.randrange(40)]) for _ in range(r.randrange(1, 30))]
            for i in range(n)]


def cosine(a, b):
    va, vb = (np.bincount(x or [], minlength=64).astype(float) for x in (a, b))
    length = math.sqrt((va @ va) * (vb @ vb))
    return float(va @ vb) / length if length else 0.0


@pytest.mark.parametrize("n,block", [(0, 8), (1, 8), (2, 8), (3, 8), (9, 8), (16, 8), (17, 8), (18, 8), (25, 8), (61, 16), (64, 16), (65, 300)])
def test_shifted_pairs_equal_brute_force(spark, n, block):
    seqs = sequences(n)
    df = spark.createDataFrame(list(enumerate(seqs)), "pos long, tokens array<int>")
    got = [(r["i"], r["j"], r["cosine"]) for r in similarity.shifted_pairs(df, block=block).collect()]
    want = {(i, (i + d) % n): cosine(seqs[i], seqs[(i + d) % n])
            for d in range(1, min(8, n // 2) + 1) for i in range(n // 2 if 2 * d == n else n)}
    assert len(got) == len(want)
    assert {(i, j): c for i, j, c in got} == pytest.approx(want)
    assert len({frozenset((i, j)) for i, j, _ in got}) == len(got)  # no pair twice
    if 1 < n <= 17:
        assert len(got) == n * (n - 1) // 2  # few sequences: all pairs


def test_exact_mean_lies_within_the_bound(spark):
    seqs = sequences(600, 3)
    df = spark.createDataFrame([(i, s) for i, s in enumerate(seqs)], "ord long, tokens array<int>")
    df = rank.seeded_shuffle(df, "ord", 42, "pos")
    exact = similarity.mean_cosine(df).first()["mean_cosine"]
    summary, hist = R.pair_distribution(df)
    s = summary.first()
    assert s["pairs"] == 600 * 8 and abs(s["mean"] - exact) <= s["bound95"]
    assert abs(s["mean"] - exact) < 0.02  # far inside: the bound holds for any values
    assert sum(r["n"] for r in hist.collect()) == s["pairs"]
    every = sorted(cosine(a, b) for i, a in enumerate(seqs) for b in seqs[i + 1:])
    below = np.searchsorted(every, s["median"], "right") / len(every)
    assert abs(below - 0.5) <= s["bound95"]


# ------------------------------------------------------------ histograms, language

def test_integer_histogram_counts_what_lies_past_the_last_edge(spark):
    df = spark.createDataFrame([(x,) for x in (0, 0, 1, 25, 99, None)], "v int")
    rows = stats.integer_histogram(df, "v", 20, overflow=True).orderBy("bin").collect()
    assert len(rows) == 20
    assert [(r["bin"], r["n"], r["density"]) for r in rows[:2]] == [(0, 2, pytest.approx(2 / 3)), (1, 1, pytest.approx(1 / 3))]
    assert (rows[19]["bin"], rows[19]["lo"], rows[19]["hi"], rows[19]["n"], rows[19]["density"]) == (19, 19, 99, 2, None)
    assert sum(r["share"] for r in rows) == pytest.approx(1)
    assert sum(r["density"] or 0 for r in rows) == pytest.approx(1)


def test_reliability(spark):
    rows = [("en", "en", 0.95), ("en", "fr", 0.91), ("fr", "fr", 1.0), ("de", "de", 0.31), (None, "de", 0.31)]
    got = R.reliability(spark.createDataFrame(rows, "label string, lang string, prob double")).orderBy("bin").collect()
    assert [(r["bin"], r["n"], r["correct"]) for r in got] == [(3, 1, 1), (9, 3, 2)]
    assert got[1]["gap"] == pytest.approx((0.95 + 0.91 + 1) / 3 - 2 / 3)


# ------------------------------------------------------------ line order, sinks

def test_line_order_over_many_splits(spark, scratch):
    want = []
    for k in range(7):
        lines = [f"file {k} line {i} " + "x" * (i % 50) for i in range(400 * (k % 3) + 1)]
        want += lines
        with open(os.path.join(scratch, f"f{k}.jsonl"), "w") as f:
            f.write("\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = jsonl.read_lines(spark, scratch)
        rows = sorted((r["ord"], r["value"]) for r in df.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert rows == list(enumerate(want))


def test_prefix_sum(spark):
    df = spark.range(1000, numPartitions=7).select(F.format_string("%05d", "id").alias("k"), (F.col("id") % 13).alias("v"))
    got = [r["s"] for r in rank.prefix_sum(df, ["k"], "v", "s").orderBy("k").collect()]
    assert got == np.r_[0, np.cumsum([i % 13 for i in range(1000)])[:-1]].tolist()


def test_broadcast_is_bounded_by_bytes(spark):
    df = spark.range(50).select("id", F.expr("repeat('x', 1000)").alias("piece"))
    assert broadcast_if_small(df)[1] and not broadcast_if_small(df, max_bytes=20_000)[1]
    vocab = df.select(F.col("id").cast("int").alias("token_id"), "piece", F.lit(1).alias("freq"))
    end, n = tokens.hot_ids(vocab, 256, 20_000)
    assert n == 50 and 0 < end < 25
    assert tokens.hot_ids(vocab, 256)[0] == 256


def test_a_run_reads_the_output_of_a_run(spark, scratch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    src = os.path.join(scratch, "raw")
    jsonl.write_text_jsonl(docs.withColumnRenamed("doc_id", "ord"), src)
    prof = lang.train_profile(docs)
    cfg = PrepConfig(shard_size=20, dedup_scope="global")
    one = run_jsonl(spark, src, os.path.join(scratch, "one"), prof, cfg)
    two = run_jsonl(spark, os.path.join(scratch, "one", "text"), os.path.join(scratch, "two"), prof, cfg)
    assert two["accounting"]["total"] == one["records_after_cleaning"] > 0
    first, second = ([r["text"] for r in jsonl.read_records(spark, os.path.join(scratch, x, "text")).orderBy("ord").collect()]
                     for x in ("one", "two"))
    assert set(second) <= set(first) and len(second) == two["records_after_cleaning"]
    shards = sorted(os.path.basename(p) for p in glob.glob(os.path.join(scratch, "one", "shards", "*")))
    assert shards == [f"shard_{k:04d}.jsonl" for k in range(one["shards"])]
    assert not [p for p in os.listdir(os.path.join(scratch, "one")) if p.startswith("_")]  # nothing hidden is left


def test_a_failed_write_leaves_the_old_output(spark, scratch):
    path = os.path.join(scratch, "out")
    jsonl.write_text_jsonl(spark.createDataFrame([(0, "old")], "ord long, text string"), path)
    bad = spark.range(10).select(F.col("id").alias("ord"), F.expr("if(id = 7, raise_error('x'), 'new')").alias("text"))
    with pytest.raises(Exception):
        jsonl.write_text_jsonl(bad, path)
    assert [r["text"] for r in jsonl.read_records(spark, path).collect()] == ["old"]
    with pytest.raises(RuntimeError):
        with committed(spark, path, lambda k, n, f: "x") as raw:
            os.makedirs(raw.removeprefix("file:"))
            raise RuntimeError
    assert os.listdir(scratch) == ["out"]
