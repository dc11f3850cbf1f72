"""Cleaning, PII and score fixtures (FIXTURES.md sections 4 and 6)."""

import pytest
from pyspark.sql import functions as F

from textprep.functions import text as T

PII_CASES = [
    ("Contact bob.smith@example.com, now", "Contact [EMAIL] now", True, (1, 0, 0)),
    ("mail <a.b@c.org>, ok", "mail [EMAIL] ok", True, (1, 0, 0)),
    ("call 555-123-4567 today", "call [PHONE] today", True, (0, 1, 0)),
    ("call 555.123.4567 today", "call 555.123.4567 today", False, (0, 1, 0)),
    ("ssn 123-45-6789", "ssn [PHONE]", True, (0, 0, 1)),
    ("years 1999 2001 2003", "years [PHONE]", True, (0, 0, 0)),
    ("id 12345678", "id 12345678", False, (0, 0, 0)),
    ("id 123456789", "id [PHONE]", True, (0, 0, 0)),
    ("x@y +44 20 7946 0958", "[EMAIL] [PHONE]", True, (0, 0, 0)),
    ("a@b.co|m", "[EMAIL]", True, (1, 0, 0)),
    ("a b c\u001cd", "a b c d", False, (0, 0, 0)),
    ("١٢٣٤٥٦٧٨٩٠", "[PHONE]", True, (0, 1, 0)),
]


def _row(spark, s):
    return spark.createDataFrame([(s,)], "t string")


@pytest.mark.parametrize("raw,expected,found,counts", PII_CASES)
def test_clean_and_replace(spark, raw, expected, found, counts):
    df = _row(spark, raw)
    c = T.clean_text("t")
    r = T.replace_pii(c)
    p = T.pii_counts("t")
    got = df.select(r.alias("r"), T.pii_found(c, r).alias("f"), p.alias("p")).first()
    assert got["r"] == expected
    assert got["f"] == found
    assert (got["p"]["emails"], got["p"]["phones"], got["p"]["ssns"]) == counts


def test_report_after_clean_residual(spark):
    df = _row(spark, "call 555.123.4567 today")
    got = df.select(T.pii_counts(T.replace_pii(T.clean_text("t"))).alias("p")).first()["p"]
    assert got["phones"] == 1  # survives cleaning, found by the output report


def test_python_whitespace_semantics(spark):
    df = _row(spark, "　 a \t\n b \x1f")
    assert df.select(T.clean_text("t")).first()[0] == "a b"
    assert df.select(T.words("t")).first()[0] == ["a", "b"]
    assert _row(spark, "   ").select(T.words("t")).first()[0] == []


@pytest.mark.parametrize("text,score", [
    ("", 0.63),
    ("hello", 0.7 * 0.8 * 0.9),
    ("Hello world.", 0.7),
    (" ".join(["the"] * 20), 0.8 * 0.9 * 0.6),
    ("Alpha Beta Gamma Delta Epsilon Zeta Eta Theta Iota Kappa.", 1.0),
])
def test_quality_score(spark, text, score):
    got = _row(spark, text).select(T.quality_score("t")).first()[0]
    assert got == pytest.approx(score)


def test_case_predicates(spark):
    rows = [("ABC 1",), ("abc 1",), ("Abc",), ("123",), ("ǅ",)]
    df = spark.createDataFrame(rows, "t string")
    got = df.select(T.is_all_upper("t"), T.is_all_lower("t")).collect()
    py = [(s.isupper(), s.islower()) for (s,) in rows]
    assert [tuple(r) for r in got] == py


def test_text_stats_and_diversity(spark):
    r = _row(spark, "The cat the CAT.").select(
        T.text_stats("t").alias("s"), T.unique_words_lower("t").alias("u"), T.lexical_diversity("t").alias("d")
    ).first()
    assert r["s"]["char_count"] == 16 and r["s"]["word_count"] == 4
    assert r["s"]["token_count"] == 5  # The, " cat", " the", " CAT", "."
    assert r["u"] == 3 and r["d"] == pytest.approx(0.75)
    assert _row(spark, "").select(T.lexical_diversity("t")).first()[0] is None


def test_pieces_roundtrip(spark):
    s = "He's here, isn't he? 12345 dollars...  ok"
    got = _row(spark, s).select(T.pieces(T.clean_text("t"))).first()[0]
    assert "".join(got) == "He's here, isn't he? 12345 dollars... ok"
    assert "'s" in got and "123" in got and "45" in got


def test_special_tokens(spark):
    df = spark.createDataFrame([("x <|endoftext|> y",), ("x <|endoftext y",), ("<|fim_middle|>",)], "t string")
    assert [r[0] for r in df.select(T.has_special_token("t")).collect()] == [True, False, True]


def test_char_grams_linear_and_unicode(spark):
    got = _row(spark, "Ab é").select(T.char_grams("t")).first()[0]
    assert got == [" ab", "ab ", "b é", " é "]
    assert _row(spark, "").select(F.size(T.char_grams("t"))).first()[0] == 0
