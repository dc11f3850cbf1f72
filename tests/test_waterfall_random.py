"""Randomised waterfall check against a sequential brute force written from
the semantics (SURVEY §2.8): in input order, blank records are skipped
uncounted; per batch of `batch_size` survivors the first copy of a lower-cased,
PII-replaced text wins, and the key is remembered even if that copy later
fails the length test."""

import random
import re

import pytest
import regex
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st

from textprep.config import PrepConfig
from textprep.operators import lang
from textprep.plans import pipeline as PL

# fixed values: the cleaner's patterns and the pre-token pattern in Python form
PY_EMAIL = re.compile(r"\S+@\S+")
PY_PHONE = re.compile(r"\+?\d[\d\s\-]{7,}\d")
PY_PIECE = regex.compile(r"'(?i:[sdmt]|ll|ve|re)|[^\r\n\p{L}\p{N}]?\p{L}+|\p{N}{1,3}| ?[^\s\p{L}\p{N}]+|\s+")
SPECIAL = "<|endoftext|>"

EN = "abcdefghijklm"
OTHER = "nopqrstuvwxyz"


def _word(rng, letters):
    return "".join(rng.choice(letters) for _ in range(rng.randrange(1, 6)))


def _corpus(seed: int, n: int) -> list[str]:
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        kind = rng.random()
        if kind < 0.08:
            out.append(rng.choice(["", "   ", "\t\n"]))
        elif kind < 0.2 and out:
            base = rng.choice(out)
            out.append(base.upper() if rng.random() < 0.5 else "  " + base + " ")
        else:
            letters = EN if rng.random() < 0.7 else OTHER
            words = [_word(rng, letters) for _ in range(rng.randrange(1, 9))]
            if rng.random() < 0.15:
                words.insert(rng.randrange(len(words) + 1), rng.choice(["me@x.io", "555 123 4567", SPECIAL]))
            out.append(" ".join(words))
    return out


def _brute(texts, langs, batch_size, lo, hi):
    fates, seen, survivors = {}, {}, 0
    for i, t in enumerate(texts):
        c = " ".join(t.split())
        if not c:
            fates[i] = "light_empty"
            continue
        batch = survivors // batch_size
        survivors += 1
        if langs[i] != "en":
            fates[i] = "non_english"
            continue
        pt = PY_PHONE.sub("[PHONE]", PY_EMAIL.sub("[EMAIL]", c))
        key = pt.lower()
        keys = seen.setdefault(batch, set())
        if key in keys:
            fates[i] = "duplicate"
            continue
        keys.add(key)
        if SPECIAL in pt:
            fates[i] = "tokenization_error"
        elif not lo <= len(PY_PIECE.findall(pt)) <= hi:
            fates[i] = "length_filtered"
        else:
            fates[i] = None
    return fates


@pytest.fixture(scope="module")
def profile(spark):
    rng = random.Random(0)
    rows = [(" ".join(_word(rng, EN) for _ in range(8)), "en") for _ in range(40)]
    rows += [(" ".join(_word(rng, OTHER) for _ in range(8)), "zz") for _ in range(40)]
    rows += [("me@x.io 555 123 4567 [EMAIL] [PHONE] <|endoftext|>", "en")]
    return lang.train_profile(spark.createDataFrame(rows, "text string, lang string"))


@settings(max_examples=6, deadline=None, derandomize=True, phases=[Phase.explicit, Phase.generate],
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seed=st.integers(0, 10_000), n=st.integers(1, 120), batch=st.integers(1, 40))
def test_waterfall_matches_brute_force(spark, profile, seed, n, batch):
    texts = _corpus(seed, n)
    df = spark.createDataFrame(list(enumerate(texts)), "ord long, text string").repartition(3)
    cfg = PrepConfig(min_tokens=2, max_tokens=9, batch_size=batch)
    rows = PL.fates(df, profile, cfg).collect()
    got = {r["ord"]: r["reason"] for r in rows}
    # language detection is checked elsewhere; the brute force takes the
    # detected language and re-derives every other decision independently
    langs = {r["ord"]: r["lang"] for r in rows}
    assert _brute(texts, langs, batch, 2, 9) == got
