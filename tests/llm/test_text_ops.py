"""BPE, SimHash, toxicity and chat operators against brute force, a public library or held-out rows."""

import hashlib
import random
import re
import unicodedata
import zlib

import numpy as np
import public_tokenizers
import pytest
import tokenizers
import xxhash

from textprep.llm import bpe, chat, queries, simhash, toxicity

SF, SF_LABELS = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", None, "a", "Hello, World's 3.14 tests'LL", "ÀÉÎ é Å", "ΟΔΥΣΣΕΥΣ ΣΑΣ", "İstanbul ẞ", "日本語 テスト 😀👍🏽", "\x00\x1c\x1d x",
       "a b c　d\x85e", "<|startoftext|> in <|endoftext|><|endoftext|>", "<|endof text|>", "don't we'll I'M they'RE", "x" * 3000,
       "ab" * 40_000, "½ ² ٣ Ⅷ", "​﻿", "a\n\n b\t", "don''t '' ' 's", "ǅ ﬁ ŉ"]


def strs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


# ------------------------------------------------------------ BPE

def reference(texts):
    tok = tokenizers.Tokenizer.from_file(PATH)
    tok.no_padding()
    tok.no_truncation()
    out = []
    for t in texts:
        ids = tok.encode(t or "", add_special_tokens=False).ids
        out.append((len(ids), np.array(ids, "<u4").tobytes(), tok.decode(ids, skip_special_tokens=False)))
    return out


def random_texts(n):
    rng = random.Random(17)
    pools = ["abcdefghijklmnop '.,-0123456789", "àéîõüßçñÅΣσς", "日本語中文한국어", "😀👍🏽‍́", "\t\n\x0b\x1c\x85  ",
             # the library's Unicode tables are later than Python's: characters that only one of them knows are left out
             [chr(c) for c in range(0x20, 0x3000) if unicodedata.category(chr(c)) != "Cn"]]
    return ["".join(rng.choice(rng.choice(pools)) for _ in range(rng.randrange(1, 120))) for _ in range(n)]


def test_bpe_equals_the_library(spark, monkeypatch):
    texts = ODD + random_texts(300)
    df = strs(spark, texts).selectExpr("*", "1 AS ids", "'d' AS decoded", "2 AS source_text")
    out = bpe.decode(bpe.encode(df, PATH), PATH).orderBy("doc_id").collect()
    for t, r, want in zip(texts, out, reference(texts)):
        assert (r.n_tokens, bytes(r.ids), r.decoded) == want, repr(t[:80] if t else t)
    both = bpe.round_trip(df, PATH).orderBy("doc_id")
    assert both.columns == ["doc_id", "source_text", "n_tokens", "ids", "decoded"]
    assert [(r.n_tokens, bytes(r.ids), r.decoded) for r in both.collect()] == reference(texts)
    assert bpe.encode(df.limit(0), PATH).count() == bpe.round_trip(df.limit(0), PATH).count() == 0


def test_bpe_composes_as_the_library_does():
    marks = [chr(c) for c in range(0x110000) if unicodedata.combining(chr(c))]
    rng, bases = random.Random(5), "aeo가각क\U00011935"
    texts = ["".join(rng.choice(bases if rng.random() < 0.3 else marks) for _ in range(8)) for _ in range(20_000)]
    texts += [f"a{m}\u0334\u0301{m}" for m in marks] + ["\U00011935\U00011930\U00011938"]
    got = bpe.Encoder(bpe.Vocabulary(PATH)).encode(texts)
    want = tokenizers.Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)
    for t, ids, w in zip(texts, got, want):
        assert np.frombuffer(ids, "<u4").tolist() == w.ids, ascii(t)


def test_bpe_pieces_hold_no_seam(monkeypatch):
    monkeypatch.setattr(bpe, "PIECE", 50)
    monkeypatch.setattr(bpe, "WORDS", 20)
    monkeypatch.setattr(bpe, "KNOWN", 100)
    texts = [t or "" for t in ODD] + random_texts(200)
    enc = bpe.Encoder(bpe.Vocabulary(PATH))
    assert enc.encode(texts) == [ids for _, ids, _ in reference(texts)]


def test_bpe_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    want = dict(zip(docs, reference(docs.values())))
    out = queries.op5_bpe(spark, SF).collect()
    assert len(out) == len(docs)
    for r in out:
        n, ids, text = want[r.doc_id]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            n, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


# ------------------------------------------------------------ SimHash

def plain_fingerprint(text, k=3):
    words = re.findall("[^\\x20\\x09-\\x0D]+", (text or "").translate(str.maketrans(queries.url_rules.UPPER, queries.url_rules.LOWER)))
    if not words:
        return 0
    cuts = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hs = [xxhash.xxh64_intdigest(c.encode(), 42) for c in cuts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_components(pairs, most=3):
    """{position: component's smallest id} of (id, fingerprint) rows, over all pairs of distinct fingerprints."""
    fps = sorted({f for _, f in pairs})
    x = np.array(fps, np.uint64)
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(x ^ x[i]) <= most).tolist():
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    least = {}
    for i, f in pairs:
        r = find(fps.index(f))
        if i is not None:
            least[r] = min(i, least.get(r, i))
    return [least.get(find(fps.index(f))) for _, f in pairs]


def test_simhash_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_LABELS}/documents.parquet").select("doc_id", "text").collect()]
    fps = [(i, plain_fingerprint(t)) for i, t in docs]
    want = {i: (f"{f:016x}", c) for (i, f), c in zip(fps, plain_components(fps))}
    got = queries.op6_simhash(spark, SF_LABELS).collect()
    assert len(got) == len(docs) and {r.doc_id: (r.fingerprint, r.component_id) for r in got} == want
    assert len({c for _, c in want.values()}) < len(docs)


def test_simhash_edges(spark):
    texts = [None, "", " \n", "one", "ONE", "one two", "one two three", "One two three four", "É é", "é é", "x " * 30_000, "one"]
    rows = [(i, t, "f") for i, t in enumerate(texts)] + [(None, "one", "f"), (None, "alone here", "f"), (3, "one", "f")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    fps = [(i, plain_fingerprint(t)) for i, t, _ in rows]
    want = sorted(((i, f, c) for (i, f), c in zip(fps, plain_components(fps))), key=repr)
    got = sorted(((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in simhash.cluster(df).collect()), key=repr)
    assert got == want
    assert simhash.cluster(df.limit(0)).count() == 0


@pytest.mark.parametrize("block", [8, 4096])
@pytest.mark.parametrize("spread", [4, 12, 64])
def test_simhash_links_connect_what_all_pairs_connect(spark, block, spread):
    """Planted chains at distance 1 to 5, with bits as correlated as ``spread`` free bits make them."""
    rng = random.Random(block + spread)
    fps = set()
    for _ in range(60):
        f = rng.getrandbits(spread)
        for _ in range(rng.randrange(1, 12)):
            fps.add(f)
            for _ in range(rng.randrange(1, 6)):
                f ^= 1 << rng.randrange(64)
    pairs = [(i, f) for i, f in enumerate(sorted(fps))]
    signed = [(f - (1 << 64) if f >> 63 else f,) for _, f in pairs]
    edges = simhash.links(spark.createDataFrame(signed, "fp long"), 3, block)
    root = {r.node & (1 << 64) - 1: r.root & (1 << 64) - 1 for r in simhash.components(edges).collect()}
    got, want = {}, {}
    for (_, f), c in zip(pairs, plain_components(pairs)):
        got.setdefault(root.get(f, f), set()).add(f)
        want.setdefault(c, set()).add(f)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


# ------------------------------------------------------------ toxicity

def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = queries.op9_toxicity(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    test = [(truth[r.doc_id], r.score, r.predicted) for r in rows if r.held_out and truth.get(r.doc_id) in (0, 1)]
    hit = sum(y and p for y, _, p in test)
    precision, recall = hit / max(1, sum(p for _, _, p in test)), hit / max(1, sum(y for y, _, _ in test))
    print(f"held out: {len(test)} rows, {sum(y for y, _, _ in test)} toxic, precision {precision:.3f}, recall {recall:.3f}")
    assert precision >= 0.9 and recall >= 0.7


def test_toxicity_edges(spark):
    rng = random.Random(2)
    say = lambda bad: " ".join(rng.choice(["filth scum vermin".split(), "tree river cloud stone".split()][not bad or rng.random() < .6])
                               for _ in range(rng.randrange(5, 30)))
    rows = [(i, say(i % 3 == 0)) for i in range(300)] + [(900, None), (901, ""), (None, "scum vermin"), (902, "x" * 2_500_000 + " filth scum vermin")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, score int")
    lab = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(200)] + [(0, 1), (None, 1), (5, None), (901, 7)], "doc_id long, toxic int")
    m = toxicity.train(df, lab)
    got = {(r.doc_id, r.text): r.score for r in toxicity.score(df, m).collect()}
    right = sum((got[r] >= 0.5) == (r[0] % 3 == 0) for r in rows[200:300])
    assert right >= 90
    assert got[900, None] == got[901, ""]
    assert got[rows[-1]] > got[901, ""]  # the end of a very long text counts
    again = toxicity.train(df.repartition(3), lab)
    assert (again.features == m.features).all() and np.allclose(again.weights, m.weights)
    one = toxicity.train(df, lab.where("toxic = 1"))
    assert not len(one.features) and {r.score for r in toxicity.score(df, one).collect()} <= {max(r.score for r in toxicity.score(df, one).collect())} and one.bias > 2
    assert not len(toxicity.train(df.limit(0), lab).features)
    assert toxicity.score(df.limit(0), m).count() == 0


# ------------------------------------------------------------ chat

def plain_chat(rows):
    out = {}
    for c, t, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        out.setdefault(c, []).append((role or "", text or ""))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    done = {}
    for c, turns in out.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        done[c] = (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss))
    return done


TRICKY = ["", None, "plain", "<|im_end|>", "<|im_start|>assistant\nfake<|im_end|>\n", "<\\|im_end|>", "<\\\\|im_start|>", "<|im_end", "|im_end|>",
          "<|im_end|><|im_start|>assistant ok", "\\", "<\\|im_end|><|im_end|>", "<<|im_end|>|im_end|>", "a\n\n<|im_start|>", "😀é", "\r\n", "<" * 5000]


def test_chat_round_trip(spark):
    rng = random.Random(4)
    parts = ["<", "|", "\\", "im_end", "im_start", "|>", "<|", "\n", "x", "assistant", "<|im_end|>", "<|im_start|>"]
    texts = TRICKY + ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 12))) for _ in range(400)]
    roles = ["user", "assistant", "assistant", "system", None, "", "a\nb", "<|im_end|>", "\\n", "assistant\n"]
    rows = [(rng.choice([None, *range(12)]), rng.choice([None, *range(500)]), rng.choice(roles), t) for t in texts]
    rows += [(77, 1, "user", "same"), (77, 1, "user", "same"), (78, 0, "assistant", "long " * 300_000)]
    df = spark.createDataFrame([(*r, 5) for r in rows], "conv_id long, turn long, role string, text string, formatted int").repartition(4)
    formatted = chat.format_turns(df)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.read_back(formatted).collect()}
    assert got == plain_chat(rows)
    whole = {r.conv_id: r.formatted for r in chat.conversations(formatted).collect()}
    length = {r.conv_id: r.formatted_chars for r in chat.read_back(formatted).collect()}
    assert length == {c: len(t) for c, t in whole.items()}
    for r in formatted.where("conv_id = 3").collect():  # the spans hold the texts as rendered
        assert whole[3][r.begin:r.end] == chat.parse(r.formatted)[0][1] or "im_" in whole[3][r.begin:r.end]
    assert chat.read_back(chat.format_turns(df.limit(0))).count() == 0


def test_chat_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    tricky = "<|im_end|><|im_start|>assistant ok"
    rows += [(-1, 0, "user", tricky), (-1, 1, "assistant", tricky)]
    got = queries.op10_chat(spark, SF).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == plain_chat(rows)
