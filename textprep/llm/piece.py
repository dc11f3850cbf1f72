"""SentencePiece encoding and decoding for BPE models with byte fallback.

For every prefix of a text the last token of its encoding is unique.  The
prefix table stores that token: an automaton over all pieces reports the pieces
that end at each character, and the one that may follow the last token of the
prefix before it is entered.  Two tokens may follow each other when merging
their characters yields just these two.  The ids are recovered from the table
backwards, so encoding is linear in the text and no merge is replayed over it.

Characters in no piece never merge; they become their UTF-8 bytes' ids.  A
piece with a space mark behind another character would let merges cross from
one word to the next; the vocabulary is tested for that when it is read, and
texts are then worked on in segments (space marks and the word behind them)
whose ids are remembered in a bounded table.
"""

from __future__ import annotations

import codecs
import itertools
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from ..session import ship_package
from . import shared

MARK = "▁"  # stands for a space
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6  # piece types of the model format
BPE = 2                 # model type of the model format
WINDOW = 1 << 20        # characters segmented at once
KNOWN = 150_000         # segments remembered, twice
PAIRS = 400_000         # pair tests remembered, twice
NEVER = 1 << 30         # rank of what does not merge
LONGEST = 64            # longer segments are not remembered
SEGMENT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
EDGE = re.compile(f"[^{MARK}]{MARK}")


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protocol buffer message's fields."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = varint() if kind == 2 else 8 if kind == 1 else 4
        yield key >> 3, data[at: at + size]
        at += size


class Vocabulary:
    """Pieces of a model file, by id; small enough to broadcast (a few MB).

    Refuses models that are not BPE with byte fallback, normalise texts beyond
    marking spaces, or have user-defined or unused pieces.
    """

    def __init__(self, path: str):
        with open(path, "rb") as f:
            model = list(_fields(f.read()))
        self.pieces: list[str] = []
        self.scores: list[float] = []
        self.types: list[int] = []
        for number, value in model:
            if number == 1:
                p = dict(_fields(value))
                self.pieces.append(p.get(1, b"").decode())
                self.scores.append(struct.unpack("<f", p[2])[0] if 2 in p else 0.0)
                self.types.append(p.get(3, NORMAL))
        trainer = dict(_fields(next(v for n, v in model if n == 2)))
        spec = dict(_fields(next(v for n, v in model if n == 3)))
        bytes_ = [p for p, t in zip(self.pieces, self.types) if t == BYTE]
        if trainer.get(3, 1) != BPE or bytes_ != [f"<0x{b:02X}>" for b in range(256)]:
            raise ValueError(f"{path}: not a BPE model with byte fallback")
        if spec.get(2, b"") or not spec.get(3, 1) or spec.get(4, 1) or not spec.get(5, 1) or spec.get(6, b""):
            raise ValueError(f"{path}: normalises texts beyond marking spaces")
        if not {NORMAL, UNKNOWN, CONTROL, BYTE}.issuperset(self.types):
            raise ValueError(f"{path}: has user-defined or unused pieces")
        self.byte0 = self.types.index(BYTE)
        self.end = self.pieces.index("</s>")
        normal = {p: i for i, (p, t) in enumerate(zip(self.pieces, self.types)) if t == NORMAL and p}
        #: no piece goes on behind a word, so none spans two segments
        self.apart = not any(map(EDGE.search, normal))
        order = {s: i for i, s in enumerate(sorted({self.scores[i] for i in normal.values()}, reverse=True))}
        #: merges go by rank, then from the left; pieces of one score share a rank
        self.rank = {p: order[self.scores[i]] for p, i in normal.items()}
        # characters that occur inside pieces only take part in merges, and end as bytes
        self.symbols = [*self.pieces, *sorted({c for p in normal for c in p} - normal.keys())]
        #: ids that a text can have: those whose own characters merge to them
        self.tokens = [i for i in [*normal.values(), *range(len(self.pieces), len(self.symbols))]
                       if len(self.symbols[i]) == 1 or self.merges(self.symbols[i])[-1][1] == self.symbols[i]]

    def merges(self, text: str) -> list[tuple[int, str, str]]:
        """The merges of a short string in order: (rank, first part, last part afterwards), from its characters on."""
        part, rank = list(text), self.rank
        done = [(-1, part[0], part[-1])]
        while len(part) > 1:
            r, at = min((rank.get(part[i] + part[i + 1], NEVER), i) for i in range(len(part) - 1))
            if r == NEVER:
                break
            part[at: at + 2] = [part[at] + part[at + 1]]
            done.append((r, part[0], part[-1]))
        return done

    def token_bytes(self) -> list[bytes]:
        """What each id stands for; control ids for nothing."""
        return [bytes([int(p[3:5], 16)]) if t == BYTE else b"" if t == CONTROL else b" \xe2\x81\x87 " if t == UNKNOWN
                else p.replace(MARK, " ").encode() for p, t in zip(self.pieces, self.types)]


class Recent(dict):
    """A bounded table of computed values: when full it becomes the older half, and the half before is forgotten."""

    def __init__(self, make, limit: int, keep=lambda key: True):
        super().__init__()
        self.make, self.limit, self.keep, self.older = make, limit, keep, {}

    def __missing__(self, key):
        if key in self.older:
            value = self.older[key]
        else:
            value = self.make(key)
            if not self.keep(key):
                return value
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class Encoder:
    """Per-worker state: the automaton, pair tests and segments met so far."""

    def __init__(self, v: Vocabulary):
        import ahocorasick

        self.v = v
        self.text, self.size = v.symbols, [len(p) for p in v.symbols]
        self.automaton = ahocorasick.Automaton()
        for i in v.tokens:
            self.automaton.add_word(self.text[i], i)
        self.automaton.make_automaton()
        self.merges = Recent(lambda i: v.merges(self.text[i]), len(v.symbols))
        self.follows = Recent(self.may_follow, PAIRS)
        self.known = Recent(self.packed, KNOWN, lambda s: len(s) <= LONGEST)

    def may_follow(self, pair: int) -> bool:
        """Whether no merge crosses the boundary between two tokens while both are merged from their characters.

        Both sides' merges and the one of the parts that meet at the boundary
        are taken in the order of merging; equal ranks go from the left.
        """
        left, right, rank = self.merges[pair >> 32], self.merges[pair & 0xFFFFFFFF], self.v.rank
        i = j = 0
        while True:
            across = rank.get(left[i][2] + right[j][1], NEVER)
            a = left[i + 1][0] if i + 1 < len(left) else NEVER
            b = right[j + 1][0] if j + 1 < len(right) else NEVER
            if across < a and across <= b:
                return False
            if a == b == NEVER:
                return True
            if a <= b:
                i += 1
            else:
                j += 1

    def packed(self, segment: str) -> bytes:
        """Packed ids of a segment: the prefix table, then its ids from the end backwards."""
        size, follows = self.size, self.follows
        last = [-1] * len(segment)  # -1: a character of no piece, or not reached yet
        for end, token in self.automaton.iter(segment):
            if last[end] < 0:
                before = end - size[token]
                if before < 0 or last[before] < 0 or follows[last[before] << 32 | token]:
                    last[end] = token
        ids, at, pieces = [], len(segment) - 1, len(self.v.pieces)
        while at >= 0:
            token = last[at]
            if 0 <= token < pieces:
                ids.append(token)
            else:
                ids.extend(self.v.byte0 + b for b in reversed(segment[at].encode()))
            at -= size[token] if token >= 0 else 1
        return np.array(ids[::-1], "<i4").tobytes()

    def encode(self, text: str) -> bytes:
        """Packed ids of a whole text, without control ids; the empty text has none."""
        if not text:
            return b""
        marked = MARK + text.replace(" ", MARK)
        if not self.v.apart:
            return self.packed(marked)
        return b"".join([b"".join(map(self.known.__getitem__, SEGMENT.findall(w))) for w in windows(marked)])


def windows(marked: str) -> Iterator[str]:
    """The marked text cut before space marks behind a word, about WINDOW characters each."""
    at = 0
    while len(marked) - at > WINDOW:
        m = EDGE.search(marked, at + WINDOW)
        if not m:
            break
        yield marked[at: m.start() + 1]
        at = m.start() + 1
    yield marked[at:]


# an invalid byte becomes one replacement character, and decoding goes on behind it
codecs.register_error("textprep-bytewise", lambda e: ("�", e.start + 1))


class Decoder:
    def __init__(self, v: Vocabulary):
        self.table = v.token_bytes()
        self.control = {i for i, t in enumerate(v.types) if t == CONTROL}
        self.marked = {i for i, (p, t) in enumerate(zip(v.pieces, v.types)) if t == NORMAL and p.startswith(MARK)}

    def decode(self, ids: list[int]) -> str:
        """The text of the ids; the space that encoding put in front is taken off again."""
        if self.control.intersection(ids):  # a control id ends a run of byte ids
            runs = [list(g) for control, g in itertools.groupby(ids, self.control.__contains__) if not control]
        else:
            runs = [ids] if ids else []
        texts = [b"".join(map(self.table.__getitem__, r)).decode("utf-8", "textprep-bytewise") for r in runs]
        if runs and runs[0][0] in self.marked:
            texts[0] = texts[0][1:]
        return "".join(texts)


_MADE: dict[str, tuple[Encoder, Decoder]] = {}


def workers(v: Vocabulary, key: str) -> tuple[Encoder, Decoder]:
    """One pair per worker process and model, so its tables serve all tasks of the worker."""
    if key not in _MADE:
        _MADE[key] = Encoder(v), Decoder(v)
    return _MADE[key]


def _id_lists(packed: list[bytes]) -> pa.Array:
    sizes = np.fromiter((len(x) // 4 for x in packed), np.int64, len(packed))
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()),
                                    pa.array(np.frombuffer(b"".join(packed), "<i4")))


N, IDS, DECODED = StructField("n_tokens", LongType()), StructField("ids", ArrayType(IntegerType())), StructField("decoded", StringType())


def _mapped(df: DataFrame, path: str, column: str, fields: list[StructField], work) -> DataFrame:
    """``df`` without ``column`` and with ``fields``, made by ``work(encoder, decoder, values)``."""
    shared.require(df, column)
    ship_package(df.sparkSession)
    shipped = df.sparkSession.sparkContext.broadcast(Vocabulary(path))
    taken = {column.lower(), *(f.name.lower() for f in fields)}
    keep = [F.col(f"`{c}`") for c in df.columns if c.lower() not in taken]
    k = len(keep)
    schema = StructType([*df.select(*keep).schema.fields, *fields])
    is_text = dict(df.dtypes)[column] == "string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = workers(shipped.value, path)
        for b in shared.in_bytes(batches, k) if is_text else batches:
            made = work(encoder, decoder, b.column(k).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns[:k], *made], names=schema.fieldNames())

    return shared.positional(df, *keep, F.col(column)).mapInArrow(run, schema)


def _encoded(encoder: Encoder, texts: list[str | None], end: bool) -> list[bytes]:
    tail = np.array([encoder.v.end] * end, "<i4").tobytes()
    return [encoder.encode(t or "") + tail for t in texts]


def encode(df: DataFrame, path: str, text_col: str = "text", end: bool = True) -> DataFrame:
    """Every row of ``df`` without ``text_col``, with ``n_tokens`` and ``ids`` (array of int).

    ``path``: model file, read on the driver.  ``end``: append the end id.  Null
    counts as empty; an empty text has the end id only.  Strings of control
    pieces in texts are plain text.  An empty table gives an empty table;
    existing columns of the new names are replaced.
    """
    def work(encoder, _, texts):
        ids = _encoded(encoder, texts, end)
        return [pa.array([len(x) // 4 for x in ids], pa.int64()), _id_lists(ids)]

    return _mapped(df, path, text_col, [N, IDS], work)


def decode(df: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """Every row of ``df`` without ``ids_col``, with ``decoded``: the text of its ids.

    Control ids are left out, bytes that are no UTF-8 become U+FFFD each.  Null
    counts as no ids; an id outside the model fails the job.
    """
    return _mapped(df, path, ids_col, [DECODED],
                   lambda _, decoder, ids: [pa.array([decoder.decode(x or []) for x in ids], pa.string())])


def round_trip(df: DataFrame, path: str, text_col: str = "text", end: bool = True) -> DataFrame:
    """``encode`` and ``decode`` in one pass: ``n_tokens``, ``ids`` and ``decoded``, which is made from the ids alone."""
    def work(encoder, decoder, texts):
        ids = _encoded(encoder, texts, end)
        back = [decoder.decode(np.frombuffer(x, "<i4").tolist()) for x in ids]
        return [pa.array([len(x) // 4 for x in ids], pa.int64()), _id_lists(ids), pa.array(back, pa.string())]

    return _mapped(df, path, text_col, [N, IDS, DECODED], work)
