"""The toxicity model against one made in plain Python: grams, counts, ratios, scores, and the optimum by Newton's method."""

import numpy as np
import pytest

from textprep.llm import toxicity

SF = "/root/testdata/sf0.001"


def features(text):
    """Hashed 4- and 5-grams of a text, character by character."""
    s = "".join(c if ord(c) > 127 or c.isalnum() else " " for c in f" {text.lower()} ")
    out = set()
    for n in (4, 5):
        for i in range(len(s) - n + 1):
            h = 0
            for c in s[i:i + n]:
                h = (h * 0x01000193 + ord(c)) % 2**32
            out.add((((h ^ (h >> 15)) * 0x9E3779B1 + n) % 2**32) >> 12)
    return out


def optimum(x, y, penalty):
    """Weights and bias at the minimum of the penalised logistic loss."""
    x = np.c_[x, np.ones(len(x))]
    ridge = np.r_[np.full(x.shape[1] - 1, penalty), 0.0]
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-x @ w))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + np.diag(ridge), x.T @ (p - y) + ridge * w)
        w -= step
        if abs(step).max() < 1e-9:
            break
    return w[:-1], w[-1]


@pytest.fixture(scope="module")
def brute(spark):
    """(model, its scores, features by plain Python, presence of them in each text, labels), texts by doc_id."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    text = {r.doc_id: r.text or "" for r in docs.collect()}
    label = {r.doc_id: r.toxic for r in labels.select("doc_id", "toxic").collect() if r.toxic in (0, 1) and r.doc_id in text}
    has = {i: features(t) for i, t in text.items()}
    n = {0: {}, 1: {}}
    for i, c in label.items():
        for f in has[i]:
            n[c][f] = n[c].get(f, 0) + 1
    d1 = sum(label.values())
    d0 = len(label) - d1
    assert d0 and d1
    share = d1 / (d0 + d1)

    def stray(f):
        both = n[0].get(f, 0) + n[1].get(f, 0)
        return (n[1].get(f, 0) - both * share) ** 2 / (both * share * (1 - share))

    often = [f for f in {*n[0], *n[1]} if n[0].get(f, 0) + n[1].get(f, 0) >= 3]
    top = sorted(sorted(often, key=lambda f: (-stray(f), f))[:toxicity.MAX_FEATURES])
    ratio = np.log([(n[1].get(f, 0) + 0.5) / (d1 + 1) / ((n[0].get(f, 0) + 0.5) / (d0 + 1)) for f in top])

    model = toxicity.train(docs, labels)
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    rows = sorted(text)
    present = np.array([[f in has[i] for f in top] for i in rows])
    return model, [got[i] for i in rows], top, ratio, present, [label.get(i) for i in rows]


def test_features_and_scores_equal_brute_force(brute):
    model, got, top, _, present, _ = brute
    assert model.features.tolist() == top
    assert got == pytest.approx((1 / (1 + np.exp(-(present @ model.weights + model.bias)))).tolist(), abs=1e-9)


@pytest.mark.xfail(strict=True, reason="the fit's 120 steps end short of the optimum, and more steps do not settle (README)")
def test_weights_are_at_the_optimum(brute):
    _, got, _, ratio, present, label = brute
    x = present * ratio
    known = [k for k, c in enumerate(label) if c is not None]
    w, b = optimum(x[known], np.array([label[k] for k in known], float), toxicity.PENALTY)
    assert got == pytest.approx((1 / (1 + np.exp(-(x @ w + b)))).tolist(), abs=0.01)
