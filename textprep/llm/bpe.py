"""BPE encoding and decoding with a public tokenizer file (``word`` kind: end-of-word suffix).

A text is NFC-normalised (Unicode 9, as the library does), lower-cased character by character and split into
words; a word's UTF-8 bytes are its first symbols, the last one with the end
suffix.  Merging uses a segment tree over the ranks of adjacent pairs: leaf i
holds (rank, i) of the pair that begins at symbol i, every node the smaller of
its children, so the root is the leftmost pair of lowest rank.  A merge changes
three leaves and their paths to the root, and a word is done when the root is
empty.  Words of similar length are merged together: numpy runs the same step
of all their trees at once.  Longer words have a tree of their own.

Texts are worked on in pieces cut at white space, where no word, composition or
control token can span, so memory is bounded for any text length.  Each worker
keeps a bounded table of the words it has met, alone and as they stand between
white space.

Control tokens written out in a text become their ids, as the tokenizers
library does.
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from ..session import ship_package
from . import shared

SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


def _class(kind: str, below: int) -> str:
    """Ranges of the characters whose category begins with ``kind``, as in a regex class.

    ``regex`` knows a later Unicode version than ``unicodedata`` does.
    """
    every = "".join(chr(c) for c in range(below) if not 0xD800 <= c < 0xE000)
    hit = np.zeros(below, bool)
    hit[[ord(c) for c in regex.findall(rf"\p{{{kind}}}", every)]] = True
    edge = np.flatnonzero(np.diff(np.r_[0, hit.astype(np.int8), 0]))
    return "".join(f"\\U{a:08x}-\\U{b - 1:08x}" for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()))


def _below(text: str) -> int:
    return 0x80 if text.isascii() else 0x10000 if max(text) < "\U00010000" else 0x110000


@functools.cache
def words_of(below: int) -> re.Pattern:
    """The word pattern for texts whose characters lie below ``below`` (a smaller class is faster)."""
    letter, number = _class("L", below), _class("N", below)
    return re.compile(f"[{letter}]+|'s|'t|'re|'ve|'m|'ll|'d|[{number}]|[^{SPACE}{letter}{number}]+")


# Combining marks of Unicode 10 and later, and a late composite's second half.
# The library composes by Unicode 9, where none of them has a class or composes.
LATE_MARKS = """
    7fd 898-89f 8ca-8d3 9fe c3c d3b-d3c eba 1715 1abf-1ace 1df6-1dfa a82c 10d24-10d27 10eab-10eac
    10efd-10eff 10f46-10f50 10f82-10f85 11070 1133b 1145e 11839-1183a 11930 1193d-1193e 11943 119e0
    11a34 11a47 11a99 11d42 11d44-11d45 11d97 11f41-11f42 16ff0-16ff1 1e08f 1e130-1e136 1e2ae
    1e2ec-1e2ef 1e4ec-1e4ef
"""
LATE = re.compile("([" + "".join("-".join(chr(int(x, 16)) for x in span.split("-")) for span in LATE_MARKS.split()) + "])")

GAP = re.compile(f"[{SPACE}]")
SEPARATORS = re.compile("[\\x1c-\\x1f]")  # white space for str.split, but not for the tokenizer
PIECE = 1 << 20       # characters of a piece, before the next white space
WORDS = 250_000       # chunks looked up at once
KNOWN = 200_000       # words and chunks a worker remembers
ROWS = 256            # rows handed on at once; decoded texts are large
TOGETHER = 32         # words of under twice as many bytes are merged together with others
WIDTH = 4_096        # words merged together
NONE = np.iinfo(np.int32).max


class Vocabulary:
    """Tokens, merges and control tokens of a tokenizer file; small enough to broadcast (a few MB)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, suffix = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
        self.control = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.control.values()]) + 1
        self.tokens: list[str | None] = [None] * size
        for t, i in [*vocab.items(), *self.control.items()]:
            self.tokens[i] = t
        # bytes without a printable Latin-1 form are written from U+0100 on, in order
        plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        rest = [b for b in range(256) if b not in plain]
        char = {**{b: chr(b) for b in plain}, **{b: chr(256 + i) for i, b in enumerate(rest)}}
        self.inner = np.array([vocab[char[b]] for b in range(256)], np.int64)
        self.final = np.array([vocab[char[b] + suffix] for b in range(256)], np.int64)
        pairs = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        code = np.array([vocab[a] << 20 | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(code, kind="stable")
        self.code, self.rank = code[order], order.astype(np.int32)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)  # by rank
        self._table: dict[int, int] | None = None

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each adjacent pair, NONE where it never merges."""
        want = a.astype(np.int64) << 20 | b
        at = np.minimum(np.searchsorted(self.code, want), len(self.code) - 1)
        return np.where(self.code[at] == want, self.rank[at], NONE)

    def ranked(self) -> dict[int, int]:
        if self._table is None:
            self._table = dict(zip(self.code.tolist(), self.rank.tolist()))
        return self._table


def composed(text: str) -> str:
    """NFC as of Unicode 9: later marks stay where they are, and nothing composes across them."""
    return "".join(unicodedata.normalize("NFC", x) for x in LATE.split(text))


def merge_together(v: Vocabulary, words: list[bytes]) -> list[bytes]:
    """Packed ids of short words, all trees stepped at once."""
    n = len(words)
    size = np.fromiter(map(len, words), np.int64, n)
    longest = int(size.max())
    leaves = 1 << longest.bit_length()  # > longest: the slot after the last symbol is a leaf too
    shift = leaves.bit_length() - 1
    col = np.repeat(np.arange(n), size)
    row = np.arange(len(col)) - np.repeat(np.cumsum(size) - size, size)
    raw = np.frombuffer(b"".join(words), np.uint8)
    sym = np.full((longest + 1, n), -1, np.int32)  # -1: no symbol, in no pair
    sym[row, col] = v.inner[raw]
    ends = np.cumsum(size) - 1
    sym[size - 1, np.arange(n)] = v.final[raw[ends]]
    after = np.minimum(np.arange(1, longest + 2, dtype=np.int32), longest)[:, None].repeat(n, 1)
    after[size - 1, np.arange(n)] = longest
    before = np.maximum(np.arange(-1, longest, dtype=np.int32), 0)[:, None].repeat(n, 1)
    before[0] = longest
    tree = np.full((2 * leaves, n), NONE, np.int32)

    def keys(at: np.ndarray, w: np.ndarray) -> np.ndarray:
        a, b = sym[at, w], sym[after[at, w], w]
        r = np.where((a >= 0) & (b >= 0), v.ranks(a, b), NONE)
        return np.where(r == NONE, NONE, (r.astype(np.int64) << shift) | at).astype(np.int32)

    tree[leaves + row, col] = keys(row, col)
    for level in range(leaves - 1, 0, -1):
        np.minimum(tree[2 * level], tree[2 * level + 1], out=tree[level])
    live = np.flatnonzero(tree[1] != NONE)
    while len(live):
        top = tree[1, live]
        i = top & (leaves - 1)
        j = after[i, live]
        sym[i, live] = v.merged[top >> shift]
        sym[j, live] = -1
        k = after[j, live]
        after[i, live] = k
        before[k, live] = np.where(k < longest, i, before[k, live])
        p = before[i, live]
        tree[leaves + j, live] = NONE
        tree[leaves + i, live] = keys(i, live)
        tree[leaves + p, live] = np.where(p < longest, keys(p, live), NONE)
        for up in range(1, shift + 1):
            for leaf in (p, i, j):
                node = (leaves + leaf) >> up
                tree[node, live] = np.minimum(tree[2 * node, live], tree[2 * node + 1, live])
        live = live[tree[1, live] != NONE]
    left = (sym[:longest] >= 0).T
    ids = sym[:longest].T[left].astype("<u4").tobytes()
    cut = np.r_[0, np.cumsum(left.sum(1)) * 4].tolist()
    return [ids[a:b] for a, b in zip(cut, cut[1:])]


def merge_alone(v: Vocabulary, word: bytes) -> bytes:
    """Packed ids of one word of any length."""
    ranked, merged, n = v.ranked(), v.merged.tolist(), len(word)
    raw = np.frombuffer(word, np.uint8)
    sym = v.inner[raw].tolist()
    sym[-1] = int(v.final[raw[-1]])
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    leaves = 1 << (n - 1).bit_length()
    empty = 1 << 62

    def key(i: int) -> int:
        if i < 0 or after[i] >= n:
            return empty
        r = ranked.get(sym[i] << 20 | sym[after[i]])
        return empty if r is None else r << 40 | i

    tree = [empty] * (2 * leaves)
    tree[leaves: leaves + n] = [key(i) for i in range(n)]
    for node in range(leaves - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])

    def put(i: int, value: int) -> None:
        node = leaves + i
        tree[node] = value
        while node > 1:
            node >>= 1
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

    while leaves > 1 and tree[1] != empty:
        i, rank = tree[1] & ((1 << 40) - 1), tree[1] >> 40
        j = after[i]
        sym[i], sym[j], after[i] = merged[rank], -1, after[j]
        if after[j] < n:
            before[after[j]] = i
        put(j, empty)
        put(i, key(i))
        if before[i] >= 0:
            put(before[i], key(before[i]))
    return np.array([s for s in sym if s >= 0], "<u4").tobytes()


class Encoder:
    """Per-worker state: the vocabulary and the words met so far."""

    def __init__(self, v: Vocabulary):
        self.v, self.known = v, {}
        self.control = re.compile("|".join(map(re.escape, sorted(v.control, key=len, reverse=True))) or "(?!)")

    def learn(self, chunks: set[str]) -> None:
        """Merges the words that the chunks consist of, then joins them up."""
        pattern = words_of(_below("".join(chunks)))
        known, words, split = self.known, set(), {}
        for c in chunks:
            ws = pattern.findall(c)
            if len(ws) == 1:
                words.add(c)
            else:
                split[c] = ws
                words.update(ws)
        words -= known.keys()
        by_size: dict[int, list[bytes]] = {}
        for b in "\n".join(words).encode().split(b"\n") if words else ():
            by_size.setdefault(len(b).bit_length(), []).append(b)
        for bits, same in by_size.items():
            if 1 << bits <= 2 * TOGETHER:
                for at in range(0, len(same), WIDTH):
                    part = same[at: at + WIDTH]
                    known.update(zip(map(bytes.decode, part), merge_together(self.v, part)))
            else:
                known.update((b.decode(), merge_alone(self.v, b)) for b in same)
        get = known.__getitem__
        for c, ws in split.items():
            known[c] = b"".join(map(get, ws))

    def plain(self, piece: str) -> list[str]:
        """Chunks between white space of a piece without control tokens."""
        if not piece.isascii():
            # each capital sigma on its own, whatever stands around it
            piece = composed(piece).replace("Σ", "σ")
        piece = piece.lower()
        return [c for c in GAP.split(piece) if c] if SEPARATORS.search(piece) else piece.split()

    def parts(self, text: str) -> Iterator[list[str] | int]:
        """The text's chunks, a bounded number at a time, and its control tokens' ids."""
        for piece in pieces(text):
            at = 0
            for m in self.control.finditer(piece) if "<" in piece else ():
                yield self.plain(piece[at:m.start()])
                yield self.v.control[m[0]]
                at = m.end()
            yield self.plain(piece[at:] if at else piece)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed little-endian 32-bit ids of each text."""
        out: list[list[bytes]] = [[] for _ in texts]
        held: list[tuple[int, list[str] | int]] = []
        size = 0
        for n, text in enumerate(texts):
            for part in self.parts(text):
                held.append((n, part))
                size += 1 if isinstance(part, int) else len(part)
                if size >= WORDS:
                    self.flush(held, out)
                    held, size = [], 0
        self.flush(held, out)
        return [b"".join(x) for x in out]

    def flush(self, held: list[tuple[int, list[str] | int]], out: list[list[bytes]]) -> None:
        every = set().union(*(part for _, part in held if isinstance(part, list)))
        new = every - self.known.keys()
        if len(self.known) + len(new) > KNOWN:
            self.known.clear()
            new = every
        if new:
            self.learn(new)
        for n, part in held:
            if isinstance(part, int):
                out[n].append(part.to_bytes(4, "little"))
            else:
                out[n].append(b"".join(map(self.known.__getitem__, part)))


def pieces(text: str) -> Iterator[str]:
    """The text cut at white space, about PIECE characters each."""
    at = 0
    while len(text) - at > PIECE:
        m = GAP.search(text, at + PIECE)
        if not m:
            break
        yield text[at:m.start()]
        at = m.start()
    yield text[at:] if at else text


_MADE: dict[str, Encoder] = {}


def encoder(v: Vocabulary, key: str) -> Encoder:
    """One per worker process and vocabulary, so its word table serves all tasks of the worker."""
    if key not in _MADE:
        _MADE[key] = Encoder(v)
    return _MADE[key]


def _extended(df: DataFrame, fields: list[StructField]) -> tuple[DataFrame, StructType]:
    names = {f.name.lower() for f in fields}
    df = df.drop(*[c for c in df.columns if c.lower() in names])
    return df, StructType([*df.schema.fields, *fields])


def encode(df: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """Every row of ``df`` with ``n_tokens`` (long) and ``ids`` (binary, little-endian unsigned 32-bit).

    ``path``: tokenizer file, read on the driver.  Null counts as empty; empty
    texts have no tokens.  Existing columns of those names are replaced.
    """
    shared.require(df, text_col)
    spark = df.sparkSession
    ship_package(spark)
    shipped = spark.sparkContext.broadcast(Vocabulary(path))
    source = shared.fresh("source_text", df.columns)
    df, schema = _extended(df.withColumn(source, F.col(text_col)),
                           [StructField("n_tokens", LongType()), StructField("ids", BinaryType())])
    keep = [i for i, c in enumerate(df.columns) if c != source]
    schema = StructType([f for f in schema.fields if f.name != source])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(shipped.value, path)
        for b in in_rows(batches):
            ids = e.encode([t or "" for t in b.column(source).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i) for i in keep), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                names=[f.name for f in schema.fields])

    return df.mapInArrow(run, schema)


def in_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, max(1, b.num_rows), ROWS):
            yield b.slice(at, ROWS)


def joined(ids: bytes | None, tokens: list[str | None]) -> str:
    """The tokens of packed ids, joined by spaces; ids that no token has are skipped."""
    numbers = np.frombuffer(ids or b"", "<u4")
    if len(numbers) and int(numbers.max()) >= len(tokens):
        numbers = numbers[numbers < len(tokens)]
    return " ".join([t for t in map(tokens.__getitem__, numbers.tolist()) if t is not None])


def decode(df: DataFrame, path: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """Every row of ``df`` with ``out``: the tokens of its packed ids, joined by spaces.

    The tokenizer file has no decoder of its own, so tokens are joined as they
    are, control tokens included.  Ids that no token has are skipped; null ids
    count as none.  An existing column ``out`` is replaced.
    """
    shared.require(df, ids_col)
    spark = df.sparkSession
    ship_package(spark)
    shipped = spark.sparkContext.broadcast(Vocabulary(path).tokens)
    df, schema = _extended(df, [StructField(out, StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = shipped.value
        for b in in_rows(batches):
            texts = [joined(x, tokens) for x in b.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())],
                                             names=[f.name for f in schema.fields])

    return df.mapInArrow(run, schema)


def round_trip(df: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """``decode(encode(df))`` without ``text_col``, in one pass: adds ``n_tokens``, ``ids`` and ``decoded``.

    Texts cross to Python once, and a task holds one worker instead of one for
    each direction.  The decoded text is made from the packed ids alone.
    """
    shared.require(df, text_col)
    spark = df.sparkSession
    ship_package(spark)
    shipped = spark.sparkContext.broadcast(Vocabulary(path))
    fields = [StructField("n_tokens", LongType()), StructField("ids", BinaryType()), StructField("decoded", StringType())]
    taken = {text_col.lower(), *(f.name for f in fields)}
    keep = [c for c in df.columns if c.lower() not in taken]
    source = shared.fresh("source_text", df.columns)
    schema = StructType([*df.select(*keep).schema.fields, *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(shipped.value, path)
        for b in in_rows(batches):
            ids = e.encode([t or "" for t in b.column(len(keep)).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()),
                 pa.array([joined(x, e.v.tokens) for x in ids], pa.string())],
                names=[f.name for f in schema.fields])

    return df.select(*keep, F.col(text_col).alias(source)).mapInArrow(run, schema)
