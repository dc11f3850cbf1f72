"""Exact dedup, mixing and URL rules against brute force."""

import hashlib
import random
import re

import pytest

from textprep.llm import exact_dedup, mixing, queries, url_rules

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\\x20\\x09-\\x0D]+")


# ------------------------------------------------------------ exact dedup

def marked(rows, keep):
    """(id, text) rows -> sorted (id, keep_id, size, kept) by brute force."""
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        best = (min(known) if keep == "smallest" else max(known)) if known else None
        done = False
        for i in ids:
            kept = not done and i == best
            done = done or kept
            out.append((i, best, len(ids), kept, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=repr)


def edge_rows():
    rng = random.Random(3)
    rows = [(1, None), (2, ""), (3, ""), (None, "null id"), (4, "null id"), (None, "only"), (None, "only"),
            (5, "tie"), (5, "tie"), (6, "tie"), (7, "x" * 200_000), (8, "x" * 200_000), (9, "x" * 200_000 + "y"),
            (10, "Case"), (11, "case"), (12, "é"), (13, "e\u0301"), (14, " pad"), (15, "pad")]
    rows += [(100 + i, "hot text") for i in range(300)] + [(None, "hot null")] * 100 + [(600, "hot tie")] * 90
    rows += [(1000 + i, f"common beginning of all {rng.randrange(60)}") for i in range(200)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_exact_dedup_edges(spark, keep):
    rows = edge_rows()
    df = spark.createDataFrame([(i, t, "a", 1) for i, t in rows], "doc_id long, text string, pre string, H int").repartition(5)
    got = exact_dedup.mark(df, keep=keep)
    out = sorted([(r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got.collect()], key=repr)
    assert out == marked(rows, keep)
    assert got.columns == ["doc_id", "text", "pre", "H", "keep_id", "group_size", "kept", "text_sha256"]
    left = exact_dedup.dedup(df, keep=keep)
    assert left.columns == df.columns and left.count() == sum(m[3] for m in marked(rows, keep))


def test_exact_dedup_replaces_clashing_columns_and_takes_empty(spark):
    df = spark.createDataFrame([(1, "a", 7), (2, "a", 8)], "doc_id long, text string, keep_id int")
    assert [(r.doc_id, r.keep_id) for r in exact_dedup.mark(df).orderBy("doc_id").collect()] == [(1, 1), (2, 1)]
    assert exact_dedup.mark(df.limit(0)).count() == 0


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_exact_dedup_spreads_copies_without_an_identifier_of_their_own(spark, keep):
    rows = [(None, "null ids", i) for i in range(4_000)] + [(7, "one id", i) for i in range(4_000)] + [(8, "one id", -1), (6, "one id", -2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, other int").repartition(5)
    placed, names = exact_dedup._sorted(df, "doc_id", "text", keep, None)
    assert max(r["count"] for r in placed.groupBy(names[0], names[1]).count().collect()) < 400
    got = [r.asDict() for r in exact_dedup.mark(df, keep=keep).collect()]
    best = {"smallest": 6, "largest": 8}[keep]
    assert len(got) == len(rows)
    assert {(r["text"], r["keep_id"], r["group_size"]) for r in got} == {("null ids", None, 4_000), ("one id", best, 4_002)}
    assert sorted((r["text"], r["doc_id"]) for r in got if r["kept"]) == [("null ids", None), ("one id", best)]
    # ties of the best identifier over several runs: one row stays
    tied = exact_dedup.dedup(df.where("doc_id is null or doc_id = 7"), keep=keep).collect()
    assert sorted((r.text, r.doc_id) for r in tied) == [("null ids", None), ("one id", 7)]


def test_exact_dedup_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    out = queries.op1_exact_dedup(spark, SF).collect()
    assert sorted([tuple(r) for r in out], key=repr) == marked(docs, "largest")


# ------------------------------------------------------------ mixing

def fair_targets(sizes, weights=(5, 2, 1), times=3.0):
    """{source: target}: share by weight, cut at ``times`` x size, reshare until none is above."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    capped, total = {}, sum(sizes.values())
    while True:
        free = [s for s in order if s not in capped]
        rest = total - sum(capped.values())
        share = {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        over = {s: times * sizes[s] for s in free if share[s] > times * sizes[s]}
        if not over:
            return capped | share
        capped |= over


def check_mix(rows, texts):
    sizes, taken = {}, {}
    for r in rows:
        assert r["size"] == len(WORD.findall(texts[r["doc_id"]] or ""))
        assert r["taken"] <= 3 * r["size"] and len(r["positions"]) == r["copies"] and r["taken"] == r["copies"] * r["size"]
        assert all(0 <= p <= 1 for p in r["positions"])
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    want = fair_targets(sizes)
    largest = max((r["size"] for r in rows), default=0)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]], rel=1e-9)
    for s, t in taken.items():
        assert abs(t - want[s]) <= largest


def test_mix_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = mixing.assign(docs.select("doc_id", "text", "source"))
    rows = [r.asDict() for r in out.collect()]
    assert len(rows) == docs.count()
    check_mix(rows, {r["doc_id"]: r["text"] for r in rows})
    again = mixing.assign(docs.select("doc_id", "text", "source").repartition(7))
    plain = lambda d: sorted((r.doc_id, r.taken, r.positions) for r in d.collect())
    assert plain(out) == plain(again)


def test_mix_edges(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(["w"] * rng.randrange(1, 40)), rng.choice(["a", "a", "a", "b", "c", None, "é", ""])) for i in range(400)]
    rows += [(500, None, "a"), (501, "", "only empty"), (502, "big " * 50_000, "b"), (503, " \t\n", None)]
    df = spark.createDataFrame([(*r, 9) for r in rows], "doc_id long, text string, source string, size int")
    out = mixing.assign(df.repartition(6))
    got = [r.asDict() for r in out.collect()]
    assert len(got) == len(rows)
    check_mix(got, {i: t for i, t, _ in rows})
    assert mixing.training_order(out).count() == sum(r["copies"] for r in got)
    assert mixing.assign(df.limit(0)).count() == 0
    nulls = spark.createDataFrame([(None, f"word {i}", "s") for i in range(5_000)], "doc_id long, text string, source string")
    key = mixing.stream_key(42, "doc_id", "text", "source")
    assert nulls.select(key.alias("key")).distinct().count() > 4_900  # no bucket holds all rows without an identifier
    assert sum(r.taken for r in mixing.assign(nulls).collect()) == 10_000
    twice = spark.createDataFrame([(1, "a b", "s"), (1, "a b", "s"), (None, "a b", "s")], "doc_id long, text string, source string")
    assert sum(r.taken for r in mixing.assign(twice).collect()) == 6


def test_mix_query_counts_the_written_mix(spark, monkeypatch):
    """The query writes the mix in training order, and takes what that holds, not what the targets say."""
    mixes, order = [], mixing.training_order
    written = mixing.shared.written
    monkeypatch.setattr(mixing.shared, "written", lambda df, name: mixes.append(written(df, name)) or mixes[-1])
    rows = queries.op4_mixing(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count() and len(mixes) == 1
    copies, words = {}, {}
    for r in mixes[0].collect():
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
        words[r.doc_id] = words.get(r.doc_id, 0) + r["size"]
    assert sum(copies.values()) > len(rows)
    assert all((r.copies, r.taken) == (copies.get(r.doc_id, 0), words.get(r.doc_id, 0)) for r in rows)
    by_part = {}
    for r in mixes[0].select("position", mixing.F.input_file_name().alias("f")).collect():
        by_part.setdefault(r.f, []).append(r.position)
    at = [p for f in sorted(by_part) for p in by_part[f]]
    assert at == sorted(at)
    # a mix of the first half of the training time takes less of every source
    half = lambda d, i="doc_id": order(d, i).where("position < 0.5")
    monkeypatch.setattr(mixing, "training_order", half)
    less = {r.doc_id: r.taken for r in queries.op4_mixing(spark, SF).collect()}
    assert all(less[r.doc_id] == len([p for p in r.positions if p < 0.5]) * r["size"] for r in rows)


def test_draw_takes_repeated_and_null_identifiers(spark):
    data = [(1, "a b", "s"), (1, "a b", "s"), (1, "c", "s"), (None, "a b", "s"), (None, None, "s"), (2, "", None)]
    df = spark.createDataFrame(data, "doc_id long, text string, source string")
    assigned = mixing.assign(df)
    rows, mix = mixing.draw(assigned)
    assert rows.columns == assigned.columns
    plain = lambda d: sorted((tuple(r) for r in d.drop("positions").collect()), key=repr)
    assert plain(rows) == plain(assigned)
    assert mix.count() == 4 and sum(r["size"] for r in mix.collect()) == 7
    assert [d.count() for d in mixing.draw(mixing.assign(df.limit(0)))] == [0, 0]


def test_mix_spreads_rows_of_one_identifier(spark, monkeypatch):
    """Rows of one identifier are placed by their texts when they are many, and the mix stays whole."""
    monkeypatch.setattr(mixing, "CELL_ROWS", 40)
    data = [(7, " ".join(["w"] * (i % 9)) + f" {i}", "s") for i in range(3_000)] + [(i, "a b", "tu"[i % 2]) for i in range(100, 300)]
    df = spark.createDataFrame(data, "doc_id long, text string, source string").repartition(4)
    out = mixing.assign(df)
    rows = [r.asDict() for r in out.collect()]
    assert sorted((r["doc_id"], r["text"], r["source"]) for r in rows) == sorted(data)
    for s in "stu":
        of = [r for r in rows if r["source"] == s]
        assert abs(sum(r["taken"] for r in of) - of[0]["target"]) <= 10
        first = sorted((r["positions"][0], r["size"]) for r in of if r["copies"])
        assert len({p for p, _ in first}) == len(first)


def test_positions_follow_the_schedules(spark):
    """A heavy source's documents lead, a light one's come late; the order is the range sort of positions."""
    df = spark.createDataFrame([(i, "a b c", "xyz"[i % 3]) for i in range(900)], "doc_id long, text string, source string")
    order = mixing.training_order(mixing.assign(df))
    mean = {r.source: r.p for r in order.groupBy("source").agg({"position": "avg"}).withColumnRenamed("avg(position)", "p").collect()}
    assert mean["x"] < 0.5 < mean["z"] and mean["y"] == pytest.approx(0.5, abs=0.02)
    at = [r.position for r in order.select("position").collect()]
    assert at == sorted(at)


# ------------------------------------------------------------ URL rules

def judged(url, rules=url_rules.RULES):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        m = re.match(r"([^/?#]*)([^?#]*)", rest, re.S)
        host, path = m[1].translate(str.maketrans(url_rules.UPPER, url_rules.LOWER)), m[2]
    fits = [(len(h), len(p), f"{h}{p}", v) for v, h, p in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits) if fits else (0, 0, None, "allow")
    return host, path, best[2], best[3]


URLS = [None, "", "no scheme", "http://", "http://com/", "http://com", "https://Example.COM/en/x?q#f", "http://example.com/en",
        "http://www.example.com/en/a", "http://a.www.example.com/en/", "http://badexample.com/en/", "x://net/es/", "x://NET/fr/1",
        "x://a.b.net/es", "x://net.com/es/", "http://example.com:80/en/", "http://example.com./en/", "http://u://example.com/en/",
        "http://example.com?/en/", "http://example.com#/en/", "http://-net/es/", "http://a-net/es/", "http://net!/es/",
        "http://example.com\n/en/", "http://\u00c9xample.com/en/", "http://..com/", "http://.net/es/", "http://net/" + "es/" * 50_000]


def test_url_rules(spark):
    rows = [(i, u, "mine") for i, u in enumerate(URLS + ["http://hot.net/es/1"] * 200)]
    df = spark.createDataFrame(rows, "page_id long, url string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_rules.judge(df).collect()}
    assert got == {i: judged(u) for i, u, _ in rows}
    assert url_rules.judge(df.limit(0)).count() == 0
    assert {r.verdict for r in url_rules.judge(df, rules=[]).collect()} == {"allow"}


def test_url_rules_nested(spark):
    rng = random.Random(11)
    labels = ["a", "b", "a-b", "c", "com"]
    name = lambda: ".".join(rng.choice(labels) for _ in range(rng.randrange(1, 5)))
    rules = sorted({(rng.choice(["allow", "block"]), name(), rng.choice(["/", "/x", "/x/y"])) for _ in range(60)})
    one = {}
    for v, h, p in rules:  # of repeated rules block holds
        one[h, p] = "block" if one.get((h, p)) == "block" else v
    rows = [(i, f"http://{name()}{rng.choice(['', '/', '/x/y/z', '/y'])}") for i in range(500)]
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in
           url_rules.judge(spark.createDataFrame(rows, "page_id long, url string"), rules=rules).collect()}
    assert got == {i: judged(u, [(v, h, p) for (h, p), v in one.items()]) for i, u in rows}


def test_url_query(spark):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in queries.op3_url_filter(spark, SF).collect()}
    assert got == {i: judged(u) for i, u in pages.items()}
