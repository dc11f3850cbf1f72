"""SentencePiece, fill-in-middle and alignment against the public libraries and brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from textprep.llm import align, fim, piece
from textprep.llm.queries import BYTES, PIECES, QUERIES, tokenizer_path

SF = "/root/testdata/sf0.001"
ODD = [None, "", " ", "   \n", "a", " a  b ", "don't stop", "x</s>y <s> <unk> <0x0A>", "<|endoftext|> end", "▁a ▁", "a\0b",
       "é e\u0301 ß 中文 ابن 😀", "tab\tand\r\nlines\x0b\x0c", "a" * 5000, " " * 300, "ab " * 3000, "a<P>b", "a<S", "M><M >",
       "zero\u200bwidth \u00a0nbsp\u3000wide", "===" * 40 + "    if x:\n        y"]


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def random_texts(n: int, seed: int) -> list[str]:
    r = random.Random(seed)
    al = "abcdehlnorstu  ▁.,'\n\té中語ßΣ0123456789=-_/*()😀ابن<>"
    return ["".join(r.choice(al) for _ in range(r.randrange(60))) for _ in range(n)]


def frame(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(PIECES))


# ------------------------------------------------------------ SentencePiece

def test_piece_ids_equal_the_library(library):
    v = piece.Vocabulary(tokenizer_path(PIECES))
    e, d = piece.Encoder(v), piece.Decoder(v)
    r = random.Random(3)
    words = [p.replace("▁", " ") for p, t in zip(v.pieces, v.types) if t == piece.NORMAL]
    texts = [t or "" for t in ODD] + random_texts(4000, 1) + [
        "".join(r.choice(words) for _ in range(r.randrange(1, 7))) for _ in range(4000)]
    texts += [c * n + end for c in " ▁a=\n-" for n in range(70) for end in ("", "b")]
    for t in texts:
        ids = np.frombuffer(e.encode(t), "<i4").tolist()
        assert ids == library.encode(t), t
        assert d.decode(ids) == library.decode(ids), t


def test_piece_pairs_follow_as_merging_says():
    """The walk over both sides' merges equals merging the characters of both tokens."""
    v = piece.Vocabulary(tokenizer_path(PIECES))
    e = piece.Encoder(v)
    r = random.Random(5)

    def tokens(text):
        part = list(text)
        while True:
            at = [(v.rank[a + b], i) for i, (a, b) in enumerate(zip(part, part[1:])) if a + b in v.rank]
            if not at:
                return part
            i = min(at)[1]
            part[i: i + 2] = [part[i] + part[i + 1]]

    for _ in range(5000):
        a, b = r.choice(v.tokens), r.choice(v.tokens)
        assert e.may_follow(a << 32 | b) == (tokens(v.symbols[a] + v.symbols[b]) == [v.symbols[a], v.symbols[b]])


def test_piece_decodes_any_ids_like_the_library(library):
    d = piece.Decoder(piece.Vocabulary(tokenizer_path(PIECES)))
    r = random.Random(2)
    for _ in range(4000):
        ids = [r.choice([0, 1, 2, 259, r.randrange(3, 259), r.randrange(32000)]) for _ in range(r.randrange(9))]
        assert d.decode(ids) == library.decode(ids), ids


def test_piece_long_texts_in_windows(library, monkeypatch):
    monkeypatch.setattr(piece, "WINDOW", 7)
    e = piece.Encoder(piece.Vocabulary(tokenizer_path(PIECES)))
    for t in [t or "" for t in ODD] + random_texts(500, 9):
        assert np.frombuffer(e.encode(t), "<i4").tolist() == library.encode(t)


def test_piece_tables_stay_bounded(library, monkeypatch):
    monkeypatch.setattr(piece, "KNOWN", 20)
    monkeypatch.setattr(piece, "PAIRS", 20)
    e = piece.Encoder(piece.Vocabulary(tokenizer_path(PIECES)))
    for t in random_texts(300, 4):
        assert np.frombuffer(e.encode(t), "<i4").tolist() == library.encode(t)
    assert max(len(e.known), len(e.known.older), len(e.follows), len(e.follows.older)) <= 20


def test_piece_frames(spark, library):
    path = tokenizer_path(PIECES)
    df = frame(spark, ODD * 2).withColumn("IDS", F.lit(1)).withColumn("a.b", F.lit(2)).withColumn("source", F.lit("s"))
    got = piece.round_trip(df, path)
    assert got.columns == ["doc_id", "a.b", "source", "n_tokens", "ids", "decoded"]
    split = {r["doc_id"]: r["decoded"] for r in piece.decode(piece.encode(df, path), path).collect()}
    for r in got.collect():
        want = library.encode((ODD * 2)[r["doc_id"]] or "", add_eos=True)
        assert (r["ids"], r["n_tokens"], r["decoded"]) == (want, len(want), library.decode(want))
        assert split[r["doc_id"]] == r["decoded"]
    assert piece.round_trip(df.limit(0), path).count() == 0


def test_piece_query(spark, library):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op11_sentencepiece"](spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = library.encode(docs[r["doc_id"]] or "", add_eos=True)
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (
            len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids)))


# ----------------------------------------------------------- fill in middle

def fim_by_hand(doc_id, text):
    t = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", t)
    digest = sha("42:" + ("" if doc_id is None else str(doc_id)))
    h = [int(digest[8 * i: 8 * i + 8], 16) for i in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not t or any(s in t for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", None, None, t
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_fim_equals_units_cut_one_by_one(spark):
    texts = (ODD + random_texts(800, 6)) * 2
    rows = [(None if i % 97 == 5 else i % 500, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("N", F.lit(1)).withColumn("output", F.lit("x"))
    got = fim.transform(df).withColumn("back", fim.restored("output", "form")).collect()
    want = Counter((i, *fim_by_hand(i, t), t or "") for i, t in rows)
    assert Counter((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"], r["back"]) for r in got) == want
    assert {r["form"] for r in got} == {"plain", "spm", "psm"}


def test_fim_empty_table_and_slices(spark, monkeypatch):
    from textprep.llm import shared

    df = frame(spark, ODD)
    assert fim.transform(df.limit(0)).count() == 0
    whole = {r["doc_id"]: r["output"] for r in fim.transform(df).collect()}
    assert {i: fim_by_hand(i, t)[4] for i, t in enumerate(ODD)} == whole
    import pyarrow as pa

    b = pa.RecordBatch.from_arrays([pa.array(ODD)], names=["t"])
    cut = list(shared.in_bytes(iter([b]), 0, limit=100, rows=3))
    assert [x for c in cut for x in c.column(0).to_pylist()] == ODD and max(c.num_rows for c in cut) <= 3


# ---------------------------------------------------------------- alignment

def align_by_hand(texts):
    """Per text (n_a, n_b, n_groups, n_links, n_best, count_sum, groups), every pair of tokens compared."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(tokenizer_path(BYTES))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(PIECES))
    char = {}
    extra = 256
    for x in range(256):
        if 33 <= x <= 126 or 161 <= x <= 172 or x >= 174:
            char[chr(x)] = x
        else:
            char[chr(extra)] = x
            extra += 1

    def spans(tokens):
        out, at = [], 0
        for i, raw in tokens:
            out.append((i, at, at + len(raw)))
            at += len(raw)
        return out

    docs = []
    for t in texts:
        ta = [(i, bytes(char[c] for c in a.id_to_token(i))) for i in a.encode(" " + t, add_special_tokens=False).ids] if t else []
        tb = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode())
              for i in b.encode(t)] if t else []
        raw = (" " + t).encode() if t else b""
        if not t or b"".join(x for _, x in ta) != raw or b"".join(x for _, x in tb) != raw:
            ta = tb = []
        sa, sb = spans(ta), spans(tb)
        ends = sorted({e for _, _, e in sa} & {e for _, _, e in sb})
        groups = ";".join(",".join(str(i) for i, _, e in sa if lo < e <= hi) + "|" + ",".join(str(i) for i, _, e in sb if lo < e <= hi)
                          for lo, hi in zip([0, *ends], ends))
        links = [(x, y) for x, s, e in sa for y, u, w in sb if s < w and u < e]
        docs.append((len(sa), len(sb), len(ends), links, groups))
    count = Counter(p for d in docs for p in d[3])
    top = defaultdict(int)
    for (_, y), n in count.items():
        top[y] = max(top[y], n)
    return [(na, nb, ng, len(ls), sum(count[p] == top[p[1]] for p in ls), sum(count[p] for p in ls), g)
            for na, nb, ng, ls, g in docs]


def test_align_in_blocks_with_small_tables(monkeypatch):
    with open(tokenizer_path(BYTES), "rb") as f, open(tokenizer_path(PIECES), "rb") as g:
        pair = align.Pair(f.read(), g.read())
    monkeypatch.setattr(align, "BLOCK", 3)
    monkeypatch.setattr(align, "REMEMBERED", 5_000)
    texts = [(t or "")[:400] for t in ODD] + random_texts(300, 15)
    for (x, y), want in zip(pair.tokens(texts), align_by_hand(texts)):
        groups, n, links = pair.aligned(x, y)
        assert (len(x), len(y), n, len(links), groups) == (*want[:4], want[6])
    assert len(pair.windows.now) + len(pair.windows.older) < 60


@pytest.mark.parametrize("hot", [0, 40, align.HOT])
def test_align_equals_all_pairs(spark, hot):
    texts = [t if t is None or len(t) < 400 else t[:400] for t in ODD] + random_texts(150, 8) + ["the cat sat on the mat"] * 30
    df = frame(spark, texts).withColumn("N_A", F.lit(1)).withColumn("row", F.lit(7)).withColumn("rare", F.lit("q")).repartition(5)
    linked = align.link(df, tokenizer_path(BYTES), tokenizer_path(PIECES)).cache()
    got = align.counted(linked, hot=hot).collect()
    assert len(got) == len(texts)
    want = align_by_hand(texts)
    names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")
    for r in got:
        assert tuple(r[n] for n in names) == want[r["doc_id"]], texts[r["doc_id"]]
        assert (r["row"], r["rare"]) == (7, "q")


def test_align_in_parts_gives_the_same_ids(monkeypatch):
    from tokenizers import Tokenizer

    with open(tokenizer_path(BYTES), "rb") as f, open(tokenizer_path(PIECES), "rb") as g:
        pair = align.Pair(f.read(), g.read())
    a = Tokenizer.from_file(tokenizer_path(BYTES))
    a.encode_special_tokens = True
    monkeypatch.setattr(align, "PIECE", 5)
    monkeypatch.setattr(align, "REMEMBERED", 20_000)
    texts = [t for t in ODD + random_texts(600, 12) if t and "▁" not in t]
    for t, (x, y) in zip(texts, pair.tokens(texts)):
        assert x.tolist() == a.encode(" " + t, add_special_tokens=False).ids, t
        assert y.tolist() == pair.b.encode(t), t


def align_pair():
    with open(tokenizer_path(BYTES), "rb") as f, open(tokenizer_path(PIECES), "rb") as g:
        return align.Pair(f.read(), g.read())


@pytest.mark.parametrize("together, block, remembered", [(1 << 16, 1 << 16, 128 << 20), (200, 3, 20_000)])
def test_align_linked_equals_all_pairs(monkeypatch, together, block, remembered):
    for name, value in (("TOGETHER", together), ("BLOCK", block), ("REMEMBERED", remembered)):
        monkeypatch.setattr(align, name, value)
    pair, texts = align_pair(), [(t or "")[:400] for t in ODD] + random_texts(300, 16)
    texts += ["it's we've l'été don't 'tis they'LL 's 'd x'll", "a <|endoftext|> b<s> 12½ ²3 4,5-6", "größe ſo œuvre, “q” …", "q" * 70 + " r"] * 3
    for got, want in zip(pair.linked(texts) + pair.linked(texts[::-1])[::-1], align_by_hand(texts + texts)):
        assert (got[0], got[1], got[3], len(got[4]) // 8, got[2]) == (*want[:4], want[6])
    if remembered < 1 << 20:
        assert len(pair.windows.now) + len(pair.windows.older) < 200


def test_align_plain_windows_have_the_library_ids():
    pair, rng = align_pair(), random.Random(17)
    assert pair.model is not None
    letters = [c for c in map(chr, range(33, 0x180)) if align.PLAIN.match(c)]
    assert all(c.isalpha() for c in letters if c > "~") and all(chr(c) in letters for c in range(33, 127))
    words = ["".join(rng.choices(letters, k=rng.randint(1, 9))) for _ in range(3_000)]
    words += ["".join(rng.choices("'strevmldSTa1.", k=rng.randint(1, 7))) for _ in range(3_000)]
    for at in range(0, len(words), 50):
        text = " ".join(words[at: at + 50])
        assert pair.plain(text) == pair.whole(text), text


def test_align_works_on_a_new_window_once(monkeypatch):
    """New windows of a lookup are aligned together, by one merge of both tokenizers' ends and no other
    pass; plain ones do not go through the library's pre-tokenizer; known ones cost a lookup."""
    pair, merges, merged = align_pair(), [], align.merged
    monkeypatch.setattr(align, "merged", lambda x, y: merges.append(len(x)) or merged(x, y))
    texts = [" ".join(f"word{i}x{k}, ein" for k in range(20)) for i in range(50)]
    first = pair.linked(texts)
    assert len(merges) == 1
    pair.whole = None
    assert pair.linked(texts) == first and len(merges) == 1
    assert pair.linked([t.replace("x", "y") for t in texts]) and len(merges) == 2


def test_align_empty_table(spark):
    linked = align.link(frame(spark, ["x"]).limit(0), tokenizer_path(BYTES), tokenizer_path(PIECES))
    assert align.counted(linked).count() == 0


def test_align_query(spark, tmp_path):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    docs = [(i, t) for i, t in docs if t is None or len(t) < 1500]  # the brute force compares all pairs of a text's tokens
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want = dict(zip((i for i, _ in docs), align_by_hand([t for _, t in docs])))
    rows = QUERIES["op13_align"](spark, str(tmp_path)).collect()
    assert len(rows) == len(docs)
    for r in rows:
        *numbers, groups = want[r["doc_id"]]
        assert [r[n] for n in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")] == numbers
        assert r["groups_sha256"] == (sha(groups) if groups else "")
