"""Rank, tokens, dedup, statistics and similarity operators."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from textprep.operators import dedup, lang, rank, similarity, stats, tokens


def test_global_rank_matches_sort(spark):
    vals = list(range(5000))
    random.Random(1).shuffle(vals)
    df = spark.createDataFrame([(v, f"k{v % 97:03d}") for v in vals], "v long, k string").repartition(9)
    got = rank.global_rank(df, [F.col("k"), F.col("v").desc()], "pos").collect()
    expected = sorted(vals, key=lambda v: (f"k{v % 97:03d}", -v))
    assert [r["v"] for r in sorted(got, key=lambda r: r["pos"])] == expected
    assert sorted(r["pos"] for r in got) == list(range(5000))


def test_seeded_shuffle_and_shards(spark):
    df = spark.range(1234).withColumnRenamed("id", "ord").repartition(5)
    a = rank.assign_shards(rank.seeded_shuffle(df, "ord", 42), 100)
    b = rank.assign_shards(rank.seeded_shuffle(df.repartition(3), "ord", 42), 100)
    pa = {r["ord"]: r["pos"] for r in a.collect()}
    assert pa == {r["ord"]: r["pos"] for r in b.collect()}  # independent of partitioning
    sizes = sorted((r["shard_id"], r["count"]) for r in a.groupBy("shard_id").count().collect())
    assert len(sizes) == math.ceil(1234 / 100)
    assert all(n == 100 for _, n in sizes[:-1]) and sizes[-1][1] == 34
    assert rank.first_n(a, 10).count() == 10


def test_vocab_encode_decode_roundtrip(spark):
    texts = ["the cat sat on the mat", "the dog, the cat!", "Ünïcode 123456 ok", ""]
    df = spark.createDataFrame(list(enumerate(texts)), "ord long, text string")
    v = tokens.build_vocab(df)
    ids = [(r["token_id"], -r["freq"], r["piece"]) for r in v.collect()]
    assert [i for i, _, _ in sorted(ids, key=lambda t: (t[1], t[2]))] == list(range(len(ids)))
    enc = tokens.encode(df, v, "text", "ord")
    dec = {r["ord"]: r["text"] for r in tokens.decode(enc, v, "tokens", "ord").collect()}
    assert [dec.get(i, "") for i in range(4)] == texts
    assert {r["ord"]: len(r["tokens"]) for r in enc.collect()}[3] == 0


def test_decode_unknown_id_skips_row(spark):
    v = spark.createDataFrame([(0, "a", 1), (1, " b", 1)], "token_id int, piece string, freq long")
    seqs = spark.createDataFrame([(0, [0, 1]), (1, [0, 9])], "ord long, tokens array<int>")
    got = {r["ord"]: r["text"] for r in tokens.decode(seqs, v).collect()}
    assert got == {0: "a b"}


def test_dedup_hot_key(spark):
    # one text holds a third of the rows; the first copy wins
    rows = [(i, "same" if i % 3 == 0 else f"t{i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "ord long, text string").repartition(6)
    m = dedup.mark_first(df.withColumn("k", dedup.text_key("text")), "k", "ord")
    firsts = {r["ord"] for r in m.where("is_first").collect()}
    assert 0 in firsts and 3 not in firsts and len(firsts) == 2001


def test_duplicate_counts(spark):
    df = spark.createDataFrame([([1, 2],), ([1, 2],), ([3],), ([],)], "tokens array<int>")
    r = dedup.duplicate_counts(df).first()
    assert (r["total"], r["unique"], r["duplicates"]) == (4, 3, 1)
    assert r["duplicate_pct"] == pytest.approx(25.0)


def test_histogram_last_bin_closed(spark):
    df = spark.createDataFrame([(float(i),) for i in range(101)], "x double")
    h = stats.histogram(df, "x", 50).orderBy("bin").collect()
    counts, edges = np.histogram(np.arange(101), bins=50, density=False)
    assert [r["n"] for r in h] == list(counts)
    assert h[-1]["n"] == 3  # 98, 99, 100
    dens, _ = np.histogram(np.arange(101), bins=50, density=True)
    assert [r["density"] for r in h] == pytest.approx(list(dens))


def test_histogram_constant(spark):
    df = spark.createDataFrame([(7.0,)] * 5, "x double")
    h = stats.histogram(df, "x", 50).orderBy("bin").collect()
    assert h[0]["lo"] == pytest.approx(6.5) and h[-1]["hi"] == pytest.approx(7.5)
    assert sum(r["n"] for r in h) == 5


def test_integer_histogram_cap(spark):
    df = spark.createDataFrame([(0,), (0,), (1,), (25,)], "x long")
    h = stats.integer_histogram(df, "x", 20).orderBy("bin").collect()
    assert len(h) == 19 and h[0]["lo"] == 0 and h[-1]["hi"] == 19
    counts, _ = np.histogram([0, 0, 1, 25], bins=range(20), density=True)
    assert [r["density"] for r in h] == pytest.approx(list(counts))


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(3)
    xs = rng.normal(size=1001).round(3)
    df = spark.createDataFrame([(float(x),) for x in xs], "x double").repartition(4)
    q = stats.exact_quantiles(df, "x", [0.25, 0.5, 0.75])
    assert [q[k] for k in (0.25, 0.5, 0.75)] == pytest.approx(list(np.quantile(xs, [0.25, 0.5, 0.75])))
    q2 = stats.exact_quantiles(df.where("x > 0"), "x", [0.5], offset_zeros=2000)
    assert q2[0.5] == 0.0


def test_similarity_fixture(spark):
    df = spark.createDataFrame([(0, [1, 1, 2]), (1, [1, 2]), (2, [3])], "pos long, tokens array<int>")
    pc = {(r["i"], r["j"]): r["cosine"] for r in similarity.pair_cosines(df, block=2).collect()}
    assert pc == {(0, 1): pytest.approx(3 / math.sqrt(10))}
    summary, hist = similarity.sample_cosine_stats(df, bins=50, block=2)
    s = summary.first()
    assert s["pairs"] == 3 and s["zero_pairs"] == 2
    assert s["mean"] == pytest.approx(0.3162, abs=1e-4) and s["median"] == 0.0
    assert sum(r["n"] for r in hist.collect()) == 3
    m = similarity.mean_cosine(df).first()
    assert m["mean_cosine"] == pytest.approx(s["mean"])


def test_blocked_pairs_match_brute_force(spark):
    rng = random.Random(5)
    seqs = [[rng.randrange(30) for _ in range(rng.randrange(1, 12))] for _ in range(60)]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(seqs)], "pos long, tokens array<int>")
    got = {(r["i"], r["j"]): r["cosine"] for r in similarity.pair_cosines(df, block=7).collect()}
    vec = [np.bincount(s, minlength=30).astype(float) for s in seqs]
    for i in range(60):
        for j in range(i + 1, 60):
            c = vec[i] @ vec[j] / (np.linalg.norm(vec[i]) * np.linalg.norm(vec[j]))
            if c > 0:
                assert got[(i, j)] == pytest.approx(c)
            else:
                assert (i, j) not in got


def test_language_model_on_documents(spark):
    from textprep.sources import tables

    docs = tables.documents(spark, "/root/testdata/sf0.001")
    prof = lang.train_profile(docs)
    assert prof.langs == ["de", "en", "es", "fr"]
    det = lang.detect(docs.select("ord", "text"), prof)
    j = det.join(docs.select("ord", F.col("lang").alias("truth")), "ord")
    acc = j.where(F.col("lang") == F.col("truth")).count() / j.count()
    assert acc > 0.98
    probs = [r["prob"] for r in det.collect()]
    assert all(0.25 <= p <= 1.0 for p in probs)
    empty = spark.createDataFrame([(0, ""), (1, "   ")], "ord long, text string")
    assert {r["lang"] for r in lang.detect(empty, prof).collect()} == {"unknown"}


def test_vectorised_and_join_paths_agree(spark):
    from textprep.operators import lang_vec
    from textprep.sources import tables

    docs = tables.documents(spark, "/root/testdata/sf0.001")
    fast = lang.train_profile(docs)
    slow = lang.train_profile(docs, vectorised=False)
    assert fast.arrays is not None and slow.arrays is None
    assert fast.n_grams == slow.n_grams and fast.log_unseen == pytest.approx(slow.log_unseen)
    a = {r["ord"]: (r["lang"], r["prob"]) for r in lang.detect(docs.select("ord", "text"), fast).collect()}
    b = {r["ord"]: (r["lang"], r["prob"]) for r in lang.detect(docs.select("ord", "text"), slow).collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert a[k][0] == b[k][0] and a[k][1] == pytest.approx(b[k][1], abs=1e-9)
    counts_v = {(r["lang"], r["gram"]): r["n"] for r in lang.gram_counts(docs).collect()}
    counts_j = {(r["lang"], r["gram"]): r["n"] for r in lang.gram_counts(docs, vectorised=False).collect()}
    assert counts_v == counts_j
    assert lang_vec.code_gram(lang_vec.gram_code("a\U0001F600é")) == "a\U0001F600é"


def test_encode_decode_split_vocabulary(spark):
    from textprep.sources import tables
    from textprep.functions import text as T

    docs = tables.documents(spark, "/root/testdata/sf0.001").select("ord", T.clean_text("text").alias("text"))
    v = tokens.build_vocab(docs)
    full = {r["ord"]: r["tokens"] for r in tokens.encode(docs, v).collect()}
    split = {r["ord"]: r["tokens"] for r in tokens.encode(docs, v, broadcast_max_rows=50).collect()}
    assert full == split
    enc = tokens.encode(docs, v, broadcast_max_rows=50)
    dec = {r["ord"]: r["text"] for r in tokens.decode(enc, v, broadcast_max_rows=50).collect()}
    assert dec == {r["ord"]: r["text"] for r in docs.collect()}


def test_profile_save_and_load(spark, scratch):
    from textprep.sources import tables

    docs = tables.documents(spark, "/root/testdata/sf0.001")
    prof = lang.train_profile(docs)
    lang.save_profile(prof, scratch + "/profile")
    again = lang.load_profile(spark, scratch + "/profile")
    assert again.langs == prof.langs and again.n_grams == prof.n_grams
    a = {r["ord"]: r["lang"] for r in lang.detect(docs.select("ord", "text"), prof).collect()}
    b = {r["ord"]: r["lang"] for r in lang.detect(docs.select("ord", "text"), again).collect()}
    assert a == b


def test_bucketed_and_ordinal_rank(spark):
    import random as _r

    vals = list(range(0, 30000, 3))
    _r.Random(2).shuffle(vals)
    df = spark.createDataFrame([(v,) for v in vals], "v long").repartition(7)
    got = {r["v"]: r["pos"] for r in rank.ordinal_rank(df, "v").collect()}
    assert got == {v: i for i, v in enumerate(sorted(vals))}
    # a hot range (most values in one bucket) falls back to the sort-based rank
    skewed = spark.createDataFrame([(v,) for v in list(range(5000)) + [10**12]], "v long")
    got2 = {r["v"]: r["pos"] for r in rank.ordinal_rank(skewed, "v").collect()}
    assert got2[10**12] == 5000 and got2[4999] == 4999


def test_centroid_cosines_of_all_sequences(spark, monkeypatch):
    """More sequences than the reference's sample, hot and cold tokens, sequences without tokens."""
    from textprep.plans import reports

    rng = random.Random(8)
    seqs = [[min(rng.randrange(40), rng.randrange(40)) for _ in range(rng.randrange(1, 12))] for _ in range(700)] + [[], None]
    df = spark.createDataFrame(list(enumerate(seqs)), "pos long, tokens array<int>")
    x = np.array([np.bincount(s or [], minlength=40).astype(float) for s in seqs])
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
    want = x @ x.sum(0) / np.linalg.norm(x.sum(0))
    for hot in (3, similarity.HOT_TOKENS):
        monkeypatch.setattr(similarity, "HOT_TOKENS", hot)
        got = {r["id"]: r["cosine"] for r in similarity.centroid_cosines(df).collect()}
        assert [got[i] for i in range(len(seqs))] == pytest.approx(list(want))
    summary, hist = reports.similarity_distribution(df)
    s = summary.first()
    assert s["count"] == 702 and s["mean"] == pytest.approx(want.mean()) and s["median"] == pytest.approx(np.median(want))
    bins = hist.orderBy("bin").collect()
    assert [r["n"] for r in bins] == np.histogram(want.round(12), 50)[0].tolist()
    empty = reports.similarity_distribution(df.limit(0))
    assert empty[0].first()["count"] == 0 and empty[1].count() == 0


# ------------------------------------------------------------ what crosses a shuffle

def _exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def _sequences(spark, n=120):
    import random
    rng = random.Random(8)
    rows = [(i, [rng.choice([1, 2, 3, 7, 2_000_000_000, None]) for _ in range(rng.randrange(0, 30))]) for i in range(n)]
    return spark.createDataFrame([*rows, (n, None), (n + 1, [])], "pos long, tokens array<int>").repartition(3)


def test_row_vectors_equal_unit_vectors_without_a_shuffle(spark):
    from textprep.operators import similarity
    df = _sequences(spark).localCheckpoint()
    got = similarity.row_vectors(df)
    want = {(r.id, r.token): r.w for r in similarity.unit_vectors(similarity.token_bag(df)).collect()}
    assert len(want) > 300 and {(r.id, r.token): r.w for r in got.collect()} == want
    assert _exchanges(got) == 0


def test_centroid_cosines_take_repeated_and_null_ids(spark):
    """Rows of one id are one sequence; a null id has cosine 0."""
    import collections
    import math
    from textprep.operators import similarity
    df = _sequences(spark, 40)
    data = [(r.pos, r.tokens) for r in df.collect()]
    for extra in ([], [(3, [1, 1, 9]), (None, [1, 2])]):
        rows = data + extra
        bags = collections.defaultdict(collections.Counter)
        for i, t in rows:
            if i is not None:
                bags[i].update(x for x in t or [] if x is not None)
        unit = {i: {t: n / math.sqrt(sum(c * c for c in b.values())) for t, n in b.items()} for i, b in bags.items()}
        total = collections.Counter()
        for u in unit.values():
            for t, w in u.items():
                total[t] += w
        length = math.sqrt(sum(x * x for x in total.values()))
        want = sorted((repr(i), round(sum(w * total[t] for t, w in unit.get(i, {}).items()) / length, 9)) for i, _ in rows)
        got = similarity.centroid_cosines(spark.createDataFrame(rows, "pos long, tokens array<int>")).collect()
        assert sorted((repr(r.id), round(r.cosine, 9)) for r in got) == want


def test_encode_deals_texts_out_once_and_keeps_the_order(spark, monkeypatch):
    """With the vocabulary broadcast the texts cross one shuffle and their pieces none; cold pieces give the same ids."""
    from textprep.operators import tokens
    rows = [(i, " ".join(f"w{(i * k) % 37} x{k}" for k in range(300))) for i in range(20)] + [(90, ""), (None, "a b"), (None, "b a"), (91, None)]
    df = spark.createDataFrame(rows, "ord long, text string").repartition(3)
    vocab = tokens.build_vocab(df).localCheckpoint()
    got = tokens.encode(df, vocab)
    assert _exchanges(got) == 1
    plain = lambda d: sorted((repr(r.ord), r.tokens) for r in d.collect())
    cold = tokens.encode(df, vocab, broadcast_max_rows=3)
    assert plain(got) == plain(cold)
    back = {r.ord: r.text for r in tokens.decode(cold, vocab, broadcast_max_rows=3).collect()}
    assert {i: t for i, t in back.items() if i is not None} == {i: t or "" for i, t in rows if i is not None}
    monkeypatch.setattr(tokens, "TASK_PIECES", 100)
    many = tokens.encode(df, vocab)
    found = sum(r.freq for r in vocab.collect())
    assert f", {-(-found // 100)})" in many._jdf.queryExecution().executedPlan().toString() or found <= 100
    assert plain(many) == plain(got)


def test_lines_are_dealt_out_again_only_where_splits_are_few(spark, tmp_path, monkeypatch):
    from textprep import session
    from textprep.sources import jsonl, tables
    df = spark.range(0, 1000, 1, 4)
    assert tables.spread(df, "id", 4) is df and tables.spread(df, "id", 5).count() == 1000
    made, dealt = session.materialize, []
    monkeypatch.setattr(session, "materialize", lambda d: dealt.append(1) or made(d))
    half = spark.sparkContext.defaultParallelism // 2
    lines = spark.range(0, 4_000 * half, 1, half).selectExpr("concat('{\"text\": \"', sha2(cast(id as string), 512), '\"}') as value")
    lines.write.text(str(tmp_path / "l"), compression="gzip")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")  # a split a file
    try:
        recs = jsonl.read_records(spark, str(tmp_path / "l"), "part-*")
        assert recs.count() == 4_000 * half and len(dealt) == 1  # the offsets of the splits
        assert [r.ord for r in recs.orderBy("ord").limit(3).collect()] == [0, 1, 2]
        jsonl.read_records(spark, str(tmp_path / "l"), "part-00000*")
        assert len(dealt) == 3 or half < 2  # the offsets, and the lines
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_derived_lines_are_compressed(spark):
    import glob
    import __spark_entry__ as entry
    path = entry._derived_jsonl(spark, "/root/testdata/sf0.001")
    files = glob.glob(f"{path}/part-*")
    assert files and all(f.endswith(".gz") for f in files)
    r = entry.q_light_filter_counts(spark, "/root/testdata/sf0.001").first()
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
    assert r.lines == 2 * d + spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").count()
