"""Vector search, archives, page layout and the pipeline."""

import hashlib
import random
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from textprep.llm import ann, arc2warc, bpe, html_layout, queries
from textprep.llm.queries import table, tokenizer_path

from .test_dedup_mix_url import WORD, fair_targets
from .test_text_ops import plain_components, plain_fingerprint, reference

SF, SF_VECTORS = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


# ------------------------------------------------------------ vectors

def exact(rows, queries_, k):
    """{query: [(vec_id, cosine)]} over all rows, in double precision."""
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float64)
    out = {}
    for i, v in rows:
        if i in queries_:
            v = np.asarray(v, np.float64)
            cos = (x * v).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((v * v).sum()))
            best = sorted((-c, j) for c, j in zip(cos.tolist(), ids.tolist()) if j != i)[:k]
            out[i] = [(j, -c) for c, j in best]
    return out


def test_ann_recall_and_scores(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_VECTORS}/embeddings.parquet").collect()
            if r.embedding and all(c is not None and np.isfinite(c) for c in r.embedding) and any(r.embedding)]
    want = exact(rows, {i for i, _ in rows if i % 50 == 0}, 5)
    got = {}
    for r in queries.op2_ann(spark, SF_VECTORS).orderBy("query_id", "rank").collect():
        assert r.rank == len(got.setdefault(r.query_id, [])) + 1
        got[r.query_id].append((r.vec_id, r.score))
    assert got.keys() == want.keys()
    vec = {i: np.asarray(v, np.float64) for i, v in rows}
    hit = 0
    for q, found in got.items():
        assert len(found) == len(want[q])
        hit += sum(j in {j for j, _ in want[q]} for j, _ in found)
        for j, s in found:
            assert s == pytest.approx(vec[q] @ vec[j] / np.linalg.norm(vec[q]) / np.linalg.norm(vec[j]), abs=1e-12)
    recall = hit / sum(map(len, want.values()))
    print(f"recall {recall:.4f}")
    assert recall >= 0.9


def test_ann_edges(spark):
    rng = random.Random(1)
    good = [(i, [rng.gauss(0, 1) for _ in range(4)]) for i in range(1, 40)] + [(50, [1.0, 0, 0, 0]), (100, [2.0, 0, 0, 0]), (101, [3.0, 0, 0, 0])]
    bad = [(200, None), (250, []), (300, [0.0] * 4), (350, [1.0, None, 0, 0]), (400, [float("nan"), 1, 1, 1]), (450, [float("inf"), 1, 1, 1]),
           (None, [1.0, 1, 1, 1]), (500, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v and [None if c is None else float(c) for c in v], 1) for i, v in good + bad], "vec_id long, embedding array<double>, rank int")
    got = {}
    for r in ann.nearest(df, lambda i: i % 50 == 0, k=3).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, pytest.approx(r.score)))
    assert got == exact(good, {50, 100}, 3)
    few = spark.createDataFrame(good[:3], "vec_id long, embedding array<double>")
    assert ann.nearest(few, lambda i: i == 1, k=5).count() == 2
    assert ann.nearest(df.limit(0), lambda i: i % 50 == 0).count() == 0


def recall(spark, rows, k=5, every=40, **kw):
    want = exact(rows, {i for i, _ in rows if i % every == 0}, k)
    df = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in rows], "vec_id long, embedding array<double>")
    found = ann.nearest(df, lambda i: i % every == 0, k=k, **kw).collect()
    assert len(found) == sum(map(len, want.values()))
    out = sum(r.vec_id in {j for j, _ in want[r.query_id]} for r in found) / len(found)
    print(f"recall {out:.4f}")
    return out


def test_ann_recall_in_a_narrow_cone(spark):
    """Vectors with a shared mean, eight times as many as are reranked at least."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(100, 32))[rng.integers(0, 100, 8 * ann.LEAST)] + 0.6 * rng.normal(size=(8 * ann.LEAST, 32)) + 4.0
    assert recall(spark, list(enumerate(x))) >= 0.9


def test_ann_recall_of_the_index(spark):
    """The 2,000 given vectors, of which 240 are reranked for a query."""
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    assert len(rows) == 2000
    assert recall(spark, rows, least=0) >= 0.9


# ------------------------------------------------------------ archives

def plain_archive(rows, least=100):
    first, out = {}, {}
    for i, html in sorted(rows, key=lambda r: r[0]):
        raw = (html or "").encode()
        d = hashlib.sha256(raw).hexdigest()
        one = first.setdefault(d, i)
        again = len(raw) >= least and one != i
        out[i] = (len(raw), d, "revisit" if again else "response", one if again else None)
    return out


def test_warc_query(spark):
    rows = [(r.page_id, r.html) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    got = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in queries.op7_warc(spark, SF).collect()}
    assert got == plain_archive(rows)


def test_warc_edges(spark):
    long = "y" * 99 + "é"
    rows = [(1, None), (2, ""), (3, "x" * 99), (4, "x" * 99), (12, long), (5, long), (100, long), (6, "\r\n\r\nWARC/1.1\r\n" * 20),
            (7, "\r\n\r\nWARC/1.1\r\n" * 20), (8, "\x00\x01 \n" * 40), (9, "z" * 3_000_000), (10, "\n"), (11, "HTTP/1.1 200 OK\r\n\r\n" * 9)]
    urls = [None, "", "http://a b/\n", "http://é/", "-"]
    df = spark.createDataFrame([(i, urls[i % 5], h, "k") for i, h in rows], "page_id long, url string, html string, key string")
    got = {int(r.key): (r.payload_bytes, r.payload_digest, r.record_type, int(r.refers_to) if r.refers_to else None)
           for r in arc2warc.archive(df).collect()}
    assert got == plain_archive(rows)
    nulls = spark.createDataFrame([(None, "u", long), (None, "u", long)], "page_id long, url string, html string")
    assert [(r.key, r.record_type) for r in arc2warc.archive(nulls).collect()] == [(None, "response")] * 2
    assert arc2warc.archive(df.limit(0)).count() == 0


def test_arc_versions_and_blocks(spark, scratch):
    """Header lines of both versions, a URL with spaces, and records without an HTTP response."""
    one = "filedesc://a 0.0.0.0 20010203040506 text/plain 10\n1 0 org\nx\nhttp://a b/ 1.2.3.4 20010203040506 image/png 4\nab\nc\n"
    two = ("filedesc://a 0.0.0.0 20010203040506 text/plain 200 - - 0 f 8\n2 0 org\n\n"
           "http://c/ 1.2.3.4 20010203040506 text/html 200 sum - 77 f 3\nabc\n")
    for name, body in (("a.arc", one), ("b.arc", two)):
        with open(f"{scratch}/{name}", "w", newline="") as f:
            f.write(body)
    got = sorted((r.version, r.url, r.date, r.mime, bytes(r.block)) for r in arc2warc.read_arc(spark, scratch).collect())
    assert got == [(1, "http://a b/", "20010203040506", "image/png", b"ab\nc"), (2, "http://c/", "20010203040506", "text/html", b"abc")]
    arc2warc.convert(spark, [scratch], f"{scratch}/out")
    warc = sorted((r.target_uri, r.record_type, r.date, bytes(r.block)) for r in arc2warc.read_warc(spark, f"{scratch}/out").collect())
    assert warc == [("http://a b/", "resource", "2001-02-03T04:05:06Z", b"ab\nc"), ("http://c/", "resource", "2001-02-03T04:05:06Z", b"abc")]


# ------------------------------------------------------------ layout

LAYOUT = [
    ("<p>one<p>two", "one\n\ntwo"),
    ("<ul><li>a<li>b<ul><li>c</ul></ul>", "- a\n- b\n  - c"),
    ("<ol start=3><li>x<li>y</ol>", "3. x\n4. y"),
    ("<table><tr><td>a<td>bb<tr><td>ccc<td>d</table>", "a    bb\nccc  d"),
    ("<table><tr><td colspan=2>wide</td><td>z</td></tr><tr><td>a</td><td>b</td><td>c</td></tr></table>", "wide  z\na  b  c"),
    ("a<br>b<script>no()</script><!-- no --> c", "a\nb c"),
    ("<pre>\n x\n  y</pre>", " x\n  y"),
    ("<div hidden>no</div><div style='display: none'>no</div>yes", "yes"),
    ("<div style='visibility:hidden'>no<b style='visibility:visible'>yes</b></div>", "yes"),
    ("<title>no</title><b>x</b>y &amp; &lt;z&gt;", "xy & <z>"),
    ("<blockquote>q</blockquote>after", "  q\n\nafter"),
    ("1 < 2 and <b>3", "1 < 2 and 3"),
    ("", ""), ("<", "<"), ("</p></div></table>", ""), ("<div" * 5, "<div" * 5),
]


@pytest.mark.parametrize("page,text", LAYOUT)
def test_layout(page, text):
    assert html_layout.page_text(page).split("\n") == text.split("\n")


EMBEDDED = [
    ("so <math><mi>x</mi><mo>=</mo><mfrac><mn>1</mn><mn>2</mn></mfrac></math>.", "so x=1 2."),
    ("<math><semantics><mi>y</mi><annotation encoding='application/x-tex'>\\no</annotation></semantics></math>", "y"),
    ("<svg><title>no</title><defs><text>no</text></defs><g>no<text x=1>A<tspan>B</tspan></text><text>C</text></g></svg>", "AB C"),
    ("<svg><g display=none><text>no</text></g><foreignObject><p>in</p></foreignObject></svg>", "in"),
    ("<svg><text><a href=x>link</a></text><path d=z><p>after", "link\n\nafter"),
    ("<filter>html</filter> <desc>text</desc>", "html text"),
    ("size <select><option>S<option selected>M<option>L</select> now", "size M now"),
    ("<select><option disabled>pick<optgroup label=g><option>first</optgroup></select>", "first"),
    ("<select multiple><optgroup label=g><option>a<option label=bee>b</select>", "g\na\nbee"),
    ("<select><option>a<input value=b><p>c", "a b\n\nc"),
    ("<object data=x.pdf><param name=n>see <a href=x.pdf>file</a></object>", "see file"),
]


@pytest.mark.parametrize("page,text", EMBEDDED)
def test_layout_of_embedded_text(page, text):
    assert html_layout.page_text(page).split("\n") == text.split("\n")


def test_layout_of_odd_pages(spark):
    deep = "<div>" * 20_000 + "in" + "</li>" * 1000 + "</div>" * 20_000
    nested = "<ul><li>" * 500 + "x"
    rows = [(1, None, "t"), (2, "", "t"), (3, deep, "t"), (4, nested, "t"), (5, "<table><tr>" * 300 + "<td>y", "t"), (6, "w " * 300_000, "t"), (6, "<p>a", "t")]
    got = html_layout.extract(spark.createDataFrame(rows, "page_id int, html string, layout_text string")).collect()
    text = {(r.page_id, len(r.layout_text)): r.layout_text for r in got}
    assert len(got) == len(rows) and text[1, 0] == text[2, 0] == "" and text[3, 2] == "in"
    assert sum(r.layout_text.endswith("x") for r in got if r.page_id == 4) == 1
    assert any("y" in r.layout_text for r in got if r.page_id == 5)
    assert html_layout.extract(spark.createDataFrame(rows, "page_id int, html string, z string").limit(0)).count() == 0


def test_layout_query(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = queries.op8_html_extraction(spark, SF).collect()
    assert {r.page_id: r.text for r in got} == {i: html_layout.page_text(h or "") for i, h in pages.items()}


class Visible(HTMLParser):
    """Shown characters of a page in order, without white space; a dash for every item."""

    def __init__(self):
        super().__init__()
        self.out, self.unseen = [], 0

    def handle_starttag(self, tag, attrs):
        self.unseen += tag in ("title", "script", "style")
        if tag == "li":
            self.out.append("-")

    def handle_endtag(self, tag):
        self.unseen -= tag in ("title", "script", "style")

    def handle_data(self, data):
        if not self.unseen:
            self.out += data.split()


def test_layout_query_against_another_parser(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in queries.op8_html_extraction(spark, SF).collect():
        assert "<ol" not in pages[r.page_id]
        page = Visible()
        page.feed(pages[r.page_id])
        page.close()
        assert "".join(r.text.split()) == "".join(page.out)


# ------------------------------------------------------------ pipeline

def test_mix_stage_copies(spark):
    """Every document as often as a running count over its source's whole stream says."""
    docs = table(spark, SF, "documents")
    key = F.shiftrightunsigned(F.xxhash64(F.lit(42), "doc_id", "source"), 33)
    stream = sorted((r.key, r.doc_id, len(WORD.findall(r.text or "")), r.source)
                    for r in docs.select("doc_id", "source", "text", key.alias("key")).collect())
    sizes = Counter()
    for _, _, n, s in stream:
        sizes[s] += n
    target, want = fair_targets(dict(sizes)), Counter()
    for s in sizes:
        done = 0
        for _ in range(3):
            for _, i, n, source in stream:
                if source == s and n:
                    want[i] += done + n / 2 <= target[s]
                    done += n
    got = Counter(r.doc_id for r in corpus_pipeline.mix(spark, docs, SF).collect())
    assert got and got == +want


def test_pipeline_stages(spark):
    """Every stage on what its predecessor kept, against brute force."""
    docs = table(spark, SF, "documents")
    cols, toxic, kept, near, mixed = docs.columns, *[f for _, f in corpus_pipeline.STAGES[:-1]]
    seen = docs
    out = toxic(spark, seen, SF)
    scores = {r.doc_id: r.score for r in queries.op9_toxicity(spark, SF).collect()}
    assert {r.doc_id for r in out.collect()} == {i for i, s in scores.items() if s < 0.3}

    seen, out = out, kept(spark, out, SF)
    last = {}
    for r in seen.collect():
        last[r.text or ""] = max(r.doc_id, last.get(r.text or "", -1))
    assert {r.doc_id for r in out.collect()} == set(last.values())

    seen, out = out, near(spark, out, SF)
    rows = [(r.doc_id, plain_fingerprint(r.text)) for r in seen.collect()]
    assert {r.doc_id for r in out.collect()} == set(plain_components(rows))

    seen, out = out, mixed(spark, out, SF)
    assert out.columns == cols
    used = {r.doc_id for r in out.collect()}
    assert used <= {r.doc_id for r in seen.collect()}

    got = corpus_pipeline.run(spark, SF).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in out.collect())
    want = dict(zip(used, reference([texts[i] for i in used])))
    assert all((r.n_tokens, bytes(r.ids)) == want[r.doc_id][:2] for r in got)


def test_near_copies_of_repeated_identifiers(spark):
    """A clean row stays beside a near copy of its identifier; of one component one row stays."""
    rng = random.Random(4)
    a, b, c, d = (" ".join(rng.choice("abcdefghij") * 3 + str(rng.randrange(999)) for _ in range(200)) for _ in range(4))
    rows = [(1, a), (2, a.upper()), (2, b), (3, c), (3, c.upper()), (4, d), (4, d), (None, a)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.text) for r in corpus_pipeline.drop_near_copies(spark, df, SF).collect()), key=repr)
    least = min((c, c.upper()), key=lambda t: hashlib.sha256(t.encode()).digest())
    assert got == sorted([(1, a), (2, b), (3, least), (4, d), (None, a)], key=repr)


def test_pipeline_takes_empty_and_odd_documents(spark):
    rows = [(None, None, None, None, None, 1), (1, "", "en", "s", 0, 2), (2, "a b", "en", None, 3, 3), (2, "a b", "en", None, 3, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score int")
    for frame in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, frame, SF).columns == docs.columns
        corpus_pipeline.STAGES[-1][1](spark, frame, SF).collect()
    assert bpe.round_trip(docs, tokenizer_path()).count() == 4
