"""In-task numpy gram code: chunking, windows and sparse expansion give the
same counts and scores as one pass (no Spark needed)."""

import collections
import random

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from textprep.operators import lang_vec


class _Bc:
    def __init__(self, value):
        self.value = value


def _texts(seed=3, n=40):
    rng = random.Random(seed)
    alphabet = "ab cdé\U0001F600xyz"
    return [" " + "".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 300))) + " " for _ in range(n)]


def _brute(texts):
    c = collections.Counter()
    for t in texts:
        for i in range(len(t) - 2):
            c[lang_vec.gram_code(t[i:i + 3])] += 1
    return c


def _payload(texts):
    grams = sorted(_brute(texts))
    rng = np.random.default_rng(0)
    li, codes, w = [], [], []
    for g in grams:
        for j in range(3):
            if rng.random() < 0.6:
                li.append(j), codes.append(g), w.append(float(rng.random()))
    csr = lang_vec.build_csr(np.array(li), np.array(codes, dtype=np.int64), np.array(w))
    return (*csr, np.log(np.array([0.2, 0.3, 0.5])), np.array([-9.0, -8.5, -9.5]), ["a", "b", "c"], "unknown")


def _score(texts, payload):
    pdf = pd.DataFrame({"ord": range(len(texts)), "u": texts})
    out = pd.concat(lang_vec.score_batches(iter([pdf]), _Bc(payload), "ord", ["ord"]))
    return list(out["lang"]), list(out["prob"])


def _counts(texts):
    pdf = pd.DataFrame({"lang": ["x"] * len(texts), "u": texts})
    c = collections.Counter()
    for part in lang_vec.count_batches(iter([pdf])):
        for code, n in zip(part["code"], part["n"]):
            c[int(code)] += int(n)
    return c


def test_chunks_windows_and_slices_agree(monkeypatch):
    texts = _texts()
    payload = _payload(texts[:20])
    lang_big, prob_big = _score(texts, payload)
    counts_big = _counts(texts)
    assert counts_big == _brute(texts)
    monkeypatch.setattr(lang_vec, "CHUNK_CODEPOINTS", 37)   # windows inside single texts
    monkeypatch.setattr(lang_vec, "EXPAND_MAX", 5)          # many expansion slices
    lang_small, prob_small = _score(texts, payload)
    assert lang_small == lang_big
    assert prob_small == pytest.approx(prob_big)
    assert _counts(texts) == counts_big


def test_code_round_trip():
    for g in ["abc", " é ", "\U0001F600\U0001F600x", "\x00\x01\x02"]:
        assert lang_vec.code_gram(lang_vec.gram_code(g)) == g


def test_arrow_batches_are_cut_by_bytes_and_agree(monkeypatch):
    """A batch of any size is worked on in slices of bounded text; kept columns pass through, nulls included."""
    texts = _texts(n=60) + ["x" * 5_000]
    payload = _payload(texts[:20])
    lang, prob = _score(texts, payload)
    monkeypatch.setattr(lang_vec, "SLICE_BYTES", 700)
    ids = [None if i % 7 == 0 else i for i in range(len(texts))]
    batch = pa.RecordBatch.from_pydict({"ord": ids, "lang": ["x", None] * 30 + ["y"], "u": texts})
    seen, scored = [], lang_vec._scored
    monkeypatch.setattr(lang_vec, "_scored", lambda t, p: seen.append(t) or scored(t, p))
    out = pa.Table.from_batches(lang_vec.score_arrow(iter([batch]), _Bc(payload), ["ord"]))
    assert out.column("ord").to_pylist() == ids and out.schema.names == ["ord", "lang", "prob"]
    assert out.column("lang").to_pylist() == lang and out.column("prob").to_pylist() == pytest.approx(prob)
    assert len(seen) > 5 and all(len(t) == 1 or sum(len(x.encode()) for x in t) <= 700 for t in seen)
    c = {"x": collections.Counter(), "y": collections.Counter()}
    for b in lang_vec.count_arrow(iter([batch])):
        for name, code, n in zip(*(b.column(k).to_pylist() for k in ("lang", "code", "n"))):
            c[name][code] += n
    assert c == {"x": _brute(texts[:60:2]), "y": _brute(texts[60:])}
