"""Vectorised gram counting and scoring inside tasks (fast path of ``lang``).

A character 3-gram is stored exactly as one 63-bit integer: three code
points of 21 bits each.  Per Arrow batch the texts are turned into one
code-point array (UTF-32), every gram code is computed with shifts, looked
up in the sorted profile codes with ``searchsorted`` and summed per text
with ``bincount``.  No gram becomes a row, and scoring needs no shuffle: the
language comes out in the task that read the text.

The profile travels as a broadcast variable in sparse row form: sorted gram
codes, row pointers, and per entry a language index and a weight (most grams
occur in few languages).  It is only used when its measured size is under a
bound, else the row-wise join path of ``lang`` runs instead.  Per text the
(gram, count) pairs are pre-aggregated before the sparse rows are expanded,
in slices of at most ``EXPAND_MAX`` entries.  Chunks of at most
``CHUNK_CODEPOINTS`` code points bound the memory of one task, whatever the
batch holds (a single longer text is processed alone): a batch stays in Arrow,
and only about ``SLICE_BYTES`` of its texts are Python strings at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

if TYPE_CHECKING:  # a worker that only meets Arrow does not load pandas
    import pandas as pd

CHUNK_CODEPOINTS = 1 << 18
EXPAND_MAX = 1 << 18
SLICE_BYTES = 1 << 20
MASK21 = (1 << 21) - 1


def gram_code(gram: str) -> int:
    a, b, c = (ord(ch) for ch in gram)
    return (a << 42) | (b << 21) | c


def code_gram(code: int) -> str:
    return chr(code >> 42) + chr((code >> 21) & MASK21) + chr(code & MASK21)


def _chunks(texts: list[str]) -> Iterator[tuple[int, int]]:
    start, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t)
        if size and size + n > CHUNK_CODEPOINTS:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(gram codes, owning text index) of all texts, grams never crossing texts."""
    lens = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
    total = int(lens.sum())
    if total < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    cp = np.frombuffer("".join(texts).encode("utf-32-le"), dtype="<u4").astype(np.int64)
    g = (cp[:-2] << 42) | (cp[1:-1] << 21) | cp[2:]
    owner = np.repeat(np.arange(len(texts), dtype=np.int64), lens)[: total - 2]
    ends = np.cumsum(lens)[owner]
    ok = np.arange(total - 2, dtype=np.int64) + 3 <= ends
    return g[ok], owner[ok]


def _blocks(texts: list[str]) -> Iterator[tuple[int, int, Iterator[tuple[np.ndarray, np.ndarray]]]]:
    """(a, b, parts) for texts[a:b]; ``parts`` yields (codes, owner) arrays.

    A text longer than a chunk is cut into windows that overlap by two code
    points, so every gram start is counted exactly once and memory stays
    bounded by the chunk size.
    """
    for a, b in _chunks(texts):
        if b - a == 1 and len(texts[a]) > CHUNK_CODEPOINTS:
            t = texts[a]
            step = CHUNK_CODEPOINTS
            yield a, b, (_codes([t[i:i + step + 2]]) for i in range(0, max(len(t) - 2, 0), step))
        else:
            yield a, b, iter([_codes(texts[a:b])])


def _slices(batches: Iterator[pa.RecordBatch], text_col: str = "u") -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``SLICE_BYTES`` of text (a longer text is a slice of its own)."""
    for b in batches:
        sizes = pc.fill_null(pc.binary_length(b.column(text_col)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        at = 0
        while at < b.num_rows:
            before = int(ends[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + SLICE_BYTES, side="right")))
            yield b.slice(at, to - at)
            at = to


def _counted(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(codes, counts) of each chunk of the texts."""
    for _, _, parts in _blocks(texts):
        for g, _ in parts:
            if len(g):
                codes, counts = np.unique(g, return_counts=True)
                yield codes, counts.astype(np.int64)


def count_arrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, code, n) per chunk from (lang, u) rows: per-task partial counts."""
    for rows in _slices(batches):
        for lang in rows.column("lang").unique().drop_null():
            texts = rows.filter(pc.equal(rows.column("lang"), lang)).column("u").to_pylist()
            for codes, counts in _counted(texts):
                yield pa.RecordBatch.from_arrays([pa.repeat(lang, len(codes)), pa.array(codes), pa.array(counts)],
                                                 names=["lang", "code", "n"])


def count_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """``count_arrow`` from and to pandas."""
    import pandas as pd

    for pdf in batches:
        for lang, grp in pdf[pdf["lang"].notna()].groupby("lang", sort=False):
            for codes, counts in _counted(grp["u"].tolist()):
                yield pd.DataFrame({"lang": lang, "code": codes, "n": counts})


def build_csr(lang_idx: np.ndarray, codes: np.ndarray, weights: np.ndarray):
    """Sparse rows from (lang index, code, weight) entries: (codes, indptr, lang, w)."""
    order = np.lexsort((lang_idx, codes))
    c, li, w = codes[order], lang_idx[order].astype(np.int32), weights[order]
    uniq, first = np.unique(c, return_index=True)
    indptr = np.append(first, len(c)).astype(np.int64)
    return uniq, indptr, li, w


def _scored(texts: list[str], profile: tuple) -> tuple[np.ndarray, np.ndarray]:
    """(languages, probabilities) of the texts."""
    codes, indptr, lidx, wts, log_prior, log_unseen, langs, unknown = profile
    v = len(codes)
    n_lang = len(langs)
    lang_arr = np.array(langs, dtype=object)
    out_lang = np.empty(len(texts), dtype=object)
    out_prob = np.zeros(len(texts))
    for a, b, parts in _blocks(texts):
        m = b - a
        k = np.zeros(m)
        s = np.zeros(m * n_lang)
        for g, owner in parts:
            if not (len(g) and v):
                continue
            idx = np.minimum(np.searchsorted(codes, g), v - 1)
            hit = codes[idx] == g
            o, ix = owner[hit], idx[hit]
            k += np.bincount(o, minlength=m)
            pair, cnt = np.unique(o * v + ix, return_counts=True)
            po, pix = pair // v, pair % v
            st = indptr[pix]
            ln = indptr[pix + 1] - st
            ends = np.cumsum(ln)
            lo = 0
            while lo < len(pair):  # slices of at most EXPAND_MAX expanded entries
                hi = int(np.searchsorted(ends, ends[lo] - ln[lo] + EXPAND_MAX, side="right"))
                hi = max(hi, lo + 1)
                sl_ln = ln[lo:hi]
                tot = int(sl_ln.sum())
                rep = np.repeat(np.arange(lo, hi), sl_ln)
                pos = st[rep] + (np.arange(tot) - np.repeat(np.cumsum(sl_ln) - sl_ln, sl_ln))
                s += np.bincount(po[rep] * n_lang + lidx[pos], weights=wts[pos] * cnt[rep],
                                 minlength=m * n_lang)
                lo = hi
        sc = log_prior[None, :] + k[:, None] * log_unseen[None, :] + s.reshape(m, n_lang)
        best = sc.max(axis=1)
        arg = sc.argmax(axis=1)
        prob = 1.0 / np.exp(sc - best[:, None]).sum(axis=1)
        known = k > 0
        out_lang[a:b] = np.where(known, lang_arr[arg], unknown)
        out_prob[a:b] = np.where(known, prob, 0.0)
    return out_lang, out_prob


def score_arrow(batches: Iterator[pa.RecordBatch], bc, keep: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows of (keep..., lang, prob) from rows of (keep..., u); kept columns stay in Arrow."""
    for rows in _slices(batches):
        lang, prob = _scored(rows.column("u").to_pylist(), bc.value)
        yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in keep), pa.array(lang, pa.string()), pa.array(prob)],
                                         names=[*keep, "lang", "prob"])


def score_batches(batches: Iterator[pd.DataFrame], bc, id_col: str, keep: list[str]) -> Iterator[pd.DataFrame]:
    """``score_arrow`` from and to pandas."""
    for pdf in batches:
        res = pdf[keep].copy()
        res["lang"], res["prob"] = _scored(pdf["u"].tolist(), bc.value)
        yield res
