"""Per-row text functions as Spark ``Column`` expressions.

All of these are built-in JVM expressions (whole-stage codegen, no Python
workers).  Each takes and returns a ``Column``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(text: Column | str) -> Column:
    """Strip and collapse every whitespace run to one space."""
    return F.trim(F.regexp_replace(_col(text), P.WHITESPACE, " "))


def is_blank(text: Column | str) -> Column:
    """True when the text is only whitespace (Python ``not t.strip()``).

    Anchored, so it stops at the first non-space character instead of
    rewriting the whole text like ``clean_text(t) == ''`` would.
    """
    return _col(text).rlike(P.BLANK)


def replace_pii(text: Column | str) -> Column:
    """E-mails, then phones, replaced by placeholders.

    Linear in the text: the e-mail pattern is tried once per run of non-blanks,
    and only on texts holding an ``@``.
    """
    t = _col(text)
    no_mail = F.when(
        F.instr(t, "@") > 0, F.regexp_replace(t, P.EMAIL, P.EMAIL_TOKEN)
    ).otherwise(t)
    return F.regexp_replace(no_mail, P.PHONE, P.PHONE_TOKEN)


def pii_found(original: Column | str, replaced: Column | str) -> Column:
    """True when PII replacement changed the text."""
    return _col(original) != _col(replaced)


def count_matches(text: Column | str, pattern: str) -> Column:
    """Number of non-overlapping matches of ``pattern`` (no array is built)."""
    return F.regexp_count(_col(text), F.lit(pattern))


def pii_counts(text: Column | str) -> Column:
    """Struct of report-pattern hits: emails, phones, ssns, total."""
    t = _col(text)
    e = count_matches(t, P.REPORT_EMAIL)
    p = count_matches(t, P.REPORT_PHONE)
    s = count_matches(t, P.REPORT_SSN)
    return F.struct(
        e.alias("emails"), p.alias("phones"), s.alias("ssns"), (e + p + s).alias("total")
    )


def words(text: Column | str) -> Column:
    """``str.split()``: words of the whitespace-collapsed text; '' -> []."""
    c = clean_text(text)
    return F.when(c == "", F.array().cast("array<string>")).otherwise(F.split(c, " "))


def word_count(text: Column | str) -> Column:
    return F.size(words(text))


def pieces(text: Column | str) -> Column:
    """Pre-token pieces of a (cleaned) text, in order (P8, first half)."""
    return F.regexp_extract_all(_col(text), F.lit(P.PIECE), F.lit(0))


def piece_count(text: Column | str) -> Column:
    """Token-length unit used by the length filter."""
    return count_matches(text, P.PIECE)


def has_special_token(text: Column | str) -> Column:
    """Text the encoder refuses: holds a literal special token."""
    return _col(text).rlike(P.special_token_regex())


def text_stats(text: Column | str, n_tokens: Column | None = None) -> Column:
    """Struct char_count, word_count, token_count, avg_token_length."""
    t = _col(text)
    n = piece_count(t) if n_tokens is None else n_tokens
    chars = F.length(t)
    return F.struct(
        chars.alias("char_count"),
        word_count(t).alias("word_count"),
        n.alias("token_count"),
        F.when(n > 0, chars / n).otherwise(F.lit(0.0)).alias("avg_token_length"),
    )


def is_all_upper(text: Column | str) -> Column:
    """Python ``str.isupper``: a cased character and no lower/title case."""
    t = _col(text)
    return t.rlike(r"\p{IsUppercase}") & ~t.rlike(r"[\p{IsLowercase}\p{Lt}]")


def is_all_lower(text: Column | str) -> Column:
    """Python ``str.islower``: a cased character and no upper/title case."""
    t = _col(text)
    return t.rlike(r"\p{IsLowercase}") & ~t.rlike(r"[\p{IsUppercase}\p{Lt}]")


def quality_score(text: Column | str) -> Column:
    """Heuristic 0..1 quality score (P13); words are case-sensitive."""
    t = _col(text)
    w = words(t)
    n = F.size(w)
    punct = "[" + "".join("\\" + ch for ch in P.SENTENCE_END) + "]"
    f_len = F.when((n < 10) | (n > 2000), F.lit(0.7)).otherwise(F.lit(1.0))
    f_case = F.when(is_all_upper(t) | is_all_lower(t), F.lit(0.8)).otherwise(F.lit(1.0))
    f_punct = F.when(t.rlike(punct), F.lit(1.0)).otherwise(F.lit(0.9))
    f_rep = F.when(
        (n > 0) & (F.size(F.array_distinct(w)) / n < 0.3), F.lit(0.6)
    ).otherwise(F.lit(1.0))
    return f_len * f_case * f_punct * f_rep


def unique_words_lower(text: Column | str) -> Column:
    """Distinct lower-cased words."""
    return F.size(F.array_distinct(words(F.lower(_col(text)))))


def lexical_diversity(text: Column | str) -> Column:
    """Distinct lower-cased words / words; null for a text without words."""
    n = word_count(text)
    return F.when(n > 0, unique_words_lower(text) / n)


def char_grams(text: Column | str, n: int = 3) -> Column:
    """Overlapping character n-grams of `` lower(text) `` padded with spaces.

    One regex pass with a look-ahead capture, linear in the text length
    (``substring`` per position would rescan the UTF-8 prefix each time).
    """
    padded = F.concat(F.lit(" "), F.lower(_col(text)), F.lit(" "))
    return F.regexp_extract_all(padded, F.lit("(?s)(?=(.{%d}))" % n), F.lit(1))
