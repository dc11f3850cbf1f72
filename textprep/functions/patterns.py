"""Regular expressions and literal lists whose values fix the results.

Everything here is a fixed value: changing any string changes which rows
are cleaned, replaced, counted or dropped.  Patterns are Java regular
expressions (Spark's regex engine).  ``(?U)`` turns on Unicode classes so
that ``\\s``, ``\\d`` and ``\\b`` follow Unicode like Python's ``re`` does
for text; Python's ``\\s`` also covers U+001C..U+001F, which Java's does
not, so that range is added by hand.
"""

# --- fixed values: cleaner -------------------------------------------------
# Python ``\s+`` (whitespace run), expressed for Java.
WHITESPACE = r"(?U)[\s\x1c-\x1f]+"
# a text that is only Python whitespace (``not t.strip()``), anchored
BLANK = r"(?U)\A[\s\x1c-\x1f]*\z"
# Python ``\S+@\S+`` (greedy e-mail, swallows neighbouring punctuation).  A match that
# begins inside a run of non-blanks also begins at the run's start, so the look-behind
# changes no match; without it every character of a long run would rescan the run.
EMAIL = r"(?U)(?<![^\s\x1c-\x1f])[^\s\x1c-\x1f]+@[^\s\x1c-\x1f]+"
# Python ``\+?\d[\d\s\-]{7,}\d`` (phone: any run of 9+ digits/spaces/dashes).
PHONE = r"(?U)\+?\d[\d\s\x1c-\x1f\-]{7,}\d"
EMAIL_TOKEN = "[EMAIL]"
PHONE_TOKEN = "[PHONE]"

# --- fixed values: report (detection only, stricter than the cleaner) -------
REPORT_EMAIL = r"(?U)\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b"
REPORT_PHONE = r"(?U)\b\d{3}[-.]?\d{3}[-.]?\d{4}\b"
REPORT_SSN = r"(?U)\b\d{3}-\d{2}-\d{4}\b"

# --- fixed values: tokeniser ----------------------------------------------
# Pre-token split of the public cl100k pattern, in the form that is exact on
# cleaned text (single spaces, no line breaks).
PIECE = (
    r"'(?i:[sdmt]|ll|ve|re)|[^\r\n\p{L}\p{N}]?\p{L}+|\p{N}{1,3}"
    r"| ?[^\s\p{L}\p{N}]+|\s+"
)
# Special tokens of the public cl100k encoding; text containing any of them
# cannot be encoded (tokenization_error).
SPECIAL_TOKENS = (
    "<|endoftext|>",
    "<|fim_prefix|>",
    "<|fim_middle|>",
    "<|fim_suffix|>",
    "<|endofprompt|>",
)

# --- fixed values: quality heuristic --------------------------------------
SENTENCE_END = ".!?"


def special_token_regex() -> str:
    """Alternation of the special tokens, each quoted literally."""
    return "|".join(r"\Q" + t + r"\E" for t in SPECIAL_TOKENS)
