"""Property checks: the Java forms of the cleaner's patterns against Python's
``re`` semantics on random Unicode text (many examples per Spark call)."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from textprep.functions import text as T

# fixed values: the cleaner's patterns in their Python form
PY_EMAIL = re.compile(r"\S+@\S+")
PY_PHONE = re.compile(r"\+?\d[\d\s\-]{7,}\d")
PY_WS = re.compile(r"\s+")

ALPHABET = st.sampled_from(
    list("ab Z9+-@.") + ["\t", "\n", " ", " ", "　", "\x1c", "\x1f", "\x0b", "٠", "٩",
                         "۵", "é", "\U0001F600", "٣", "​"]
)
TEXTS = st.lists(st.text(alphabet=ALPHABET, max_size=40), min_size=1, max_size=60)


def _py_clean(t: str) -> str:
    return PY_WS.sub(" ", t.strip())


def _py_pii(t: str) -> str:
    return PY_PHONE.sub("[PHONE]", PY_EMAIL.sub("[EMAIL]", t))


@settings(max_examples=8, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(TEXTS)
def test_clean_and_pii_match_python(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    c = T.clean_text("t")
    rows = df.select("i", c.alias("c"), T.replace_pii(c).alias("p"), T.words("t").alias("w")).collect()
    for r in rows:
        t = texts[r["i"]]
        assert r["c"] == _py_clean(t)
        assert r["p"] == _py_pii(_py_clean(t))
        assert r["w"] == t.split()


@settings(max_examples=5, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(TEXTS)
def test_cleaning_is_idempotent_and_pieces_round_trip(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    c = T.clean_text("t")
    rows = df.select(c.alias("c"), T.clean_text(c).alias("cc"), T.pieces(c).alias("p"),
                     T.piece_count(c).alias("n")).collect()
    for r in rows:
        assert r["cc"] == r["c"]
        assert "".join(r["p"]) == r["c"]
        assert r["n"] == len(r["p"])


@settings(max_examples=5, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(TEXTS)
def test_blank_matches_python_strip(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for r in df.select("i", T.is_blank("t").alias("b")).collect():
        assert r["b"] == (texts[r["i"]].strip() == "")
