"""Run parameters (C10).  Defaults are the reference's pipeline values."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class PrepConfig:
    # waterfall
    min_tokens: int = 10            # inclusive (pipeline value; the library default is 5)
    max_tokens: int = 1000          # inclusive
    do_pii: bool = True
    target_lang: str = "en"
    lang_sample_chars: int | None = None   # None = whole cleaned text; 500 = the reference's sample
    light_filter: bool = True       # drop blank records before the waterfall, uncounted
    # de-duplication scope: "batch" (reference parity: runs of batch_size
    # light-filter survivors in input order) or "global" (whole corpus)
    dedup_scope: str = "batch"
    batch_size: int = 1000
    # shuffle and shards
    seed: int = 42
    shard_size: int = 5000
    # reports
    # reports run over whole inputs; the reference's caps (first 50,000 lines,
    # first 1,000 decoded texts) are available as parameters for parity
    report_sample_lines: int | None = None       # input report: first N lines
    decode_sample: int | None = None             # output report: first N decoded texts
    similarity_sample: int | None = None         # pairwise cosine: first N shuffled sequences (quadratic); 500 = the reference's
    others_share: float = 0.001                  # languages under this share roll up to "Others"
    residual_pii_warn_pct: float = 1.0

    def __post_init__(self) -> None:
        if not 0 <= self.min_tokens <= self.max_tokens:
            raise ValueError("need 0 <= min_tokens <= max_tokens")
        if self.dedup_scope not in ("batch", "global"):
            raise ValueError("dedup_scope must be 'batch' or 'global'")
        for name in ("batch_size", "shard_size"):
            if getattr(self, name) <= 0:
                raise ValueError(f"{name} must be positive")
        for name in ("lang_sample_chars", "similarity_sample"):
            if getattr(self, name) is not None and getattr(self, name) <= 0:
                raise ValueError(f"{name} must be positive or None")

    def with_(self, **kw) -> "PrepConfig":
        return replace(self, **kw)


# the library functions' defaults (batch-level prepare): 5..1000 tokens
LIBRARY_DEFAULTS = PrepConfig(min_tokens=5)

# drop reasons in waterfall order (fixed values: the reference's reason names)
DROP_REASONS = ("empty", "non_english", "duplicate", "tokenization_error", "length_filtered")
PII_REPLACED = "pii_replaced"
# every fate of a record; None is kept
FATES = (None, "malformed", "light_empty", *DROP_REASONS)
