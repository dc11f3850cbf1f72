"""Tags by attribute states, hidden elements, binary archive records, vectors of extreme size."""

import hashlib
import os
import random

import numpy as np
import pytest

from textprep.llm import ann, arc2warc, html_layout

from .test_ann_web_pipeline import exact

TAGS = [
    ("<a title=it's href=x>one</a> and <b class=don't>two</b>", "one and two"),
    ("<p title=it's>hello</p>", "hello"),
    ('<img alt="5" 6">after', "after"),
    ("<!-->x", "x"), ("<!--->y", "y"), ("a<!-- b > c -->d", "ad"), ("a<!-- b --!>c", "ac"), ("a</ b>c</>d", "acd"),
    ('<p data-x="a>b" title=\'c>d\'>e</p>', "e"),
    ("<p a=1/b=2 =c ==d e = 'f>' g>h</p>", "h"),
    ("1 < 2 and 3 > 2", "1 < 2 and 3 > 2"),
    ("x<b class=\"open>never closed", "xnever closed"), ("x<b class", "x<b class"), ("x<b <i>y</i>", "x<b y"),
    ("a<dialog>no</dialog>b", "ab"), ("<dialog open>yes</dialog>", "yes"),
    ("<details><p>no<summary>title</summary>no<details open>no</details></details>after", "title\nafter"),
    ("<details open><summary>title</summary>body</details>", "title\nbody"),
    ("<ruby>kan<rp>(</rp><rt>ji</rt><rp>)</rp></ruby>", "kanji"),
]


@pytest.mark.parametrize("page,text", TAGS)
def test_tags_and_hidden_elements(page, text):
    assert html_layout.page_text(page) == text


def test_no_attribute_hides_or_leaks_text():
    r = random.Random(1)
    for _ in range(3000):
        attrs = []
        for _ in range(r.randrange(4)):
            name = "".join(r.choice("ab\"'-:") for _ in range(r.randrange(1, 5)))
            value = "".join(r.choice("xy <>/&=\"'") for _ in range(r.randrange(6)))
            bare = "".join(c for c in value if c not in " <>&").lstrip("\"'")
            attrs.append(r.choice([name, f'{name}="{value.replace(chr(34), "")}"', f"{name} = '{value.replace(chr(39), '')}'",
                                   f"{name}={bare}" if bare else name]))
        page = f"one<i {' '.join(attrs)} >two</i>three"
        assert html_layout.page_text(page) == "onetwothree", page


def test_tags_of_long_pages_are_linear():
    for page in ("<a " + "x=' " * 100_001, "<a " * 200_000, "<a x='" * 100_001, "<a " + "b " * 300_000, "<" * 300_000, "<a =" + "=" * 300_000, "<a " + '"' * 300_001):
        html_layout.page_text(page)


def test_binary_records_are_converted(spark, scratch):
    blocks = [b"HTTP/1.1 200 OK\r\nContent-Type: image/png\r\n\r\n\x89PNG\r\n\x1a\n\x00\xff\xfe" + bytes(range(256)) * 3,
              "naïve café".encode("latin-1"), b"\xff" * 500, b""]
    head = b"1 0 test\nURL IP-address Archive-date Content-type Archive-length\n"
    raw = b"filedesc://t.arc 0.0.0.0 20200101000000 text/plain %d\n" % len(head) + head
    for i, b in enumerate(blocks):
        raw += b"\nhttp://h/%d 1.2.3.4 2020010100000%d image/png %d\n" % (i, i, len(b)) + b
    os.makedirs(f"{scratch}/arc")
    with open(f"{scratch}/arc/t.arc", "wb") as f:
        f.write(raw + b"\n")
    arc2warc.convert(spark, [f"{scratch}/arc"], f"{scratch}/warc")
    got = {r["target_uri"]: r for r in arc2warc.read_warc(spark, f"{scratch}/warc").collect()}
    assert len(got) == len(blocks)
    for i, b in enumerate(blocks):
        r = got[f"http://h/{i}"]
        payload = b.partition(b"\r\n\r\n")[2] if b.startswith(b"HTTP/") else b
        assert bytes(r["block"]) == b
        assert (r["payload_bytes"], r["payload_digest"]) == (len(payload), hashlib.sha256(payload).hexdigest())


def test_vectors_of_extreme_size(spark):
    rows = [(50, [1e200, 1.0]), (1, [1.0, 0.0]), (2, [1.0, 0.5]), (3, [1e-200, 0.0]), (4, [0.0, 1e-170]), (5, [5e-324, 0.0]),
            (6, [1.7e308, 1.7e308]), (7, [0.0, 0.0]), (8, [-0.0, 0.0]), (9, [0.0, -3.0])]
    got = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), lambda i: i % 50 == 0, k=9)
    got = [(r["vec_id"], r["score"]) for r in got.orderBy("rank").collect()]
    scaled = [(i, (np.array(v) / max(map(abs, v))).tolist()) for i, v in rows if any(v)]
    want = exact(scaled, {50}, 9)[50]
    assert [i for i, _ in got] == [1, 3, 5, 2, 6, 4, 9] == [i for i, _ in want]
    assert [s for _, s in got] == pytest.approx([s for _, s in want], abs=1e-15)
