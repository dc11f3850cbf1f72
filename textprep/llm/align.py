"""Alignment of two tokenizers' tokens over the same texts, and corpus-wide counts of linked ids.

Tokenizer A is a byte-level BPE file (tokenizers library), B a SentencePiece
model; both see a space and the text.  What stands between two lone spaces, a
window, has ids and links that do not depend on its neighbours, so its
alignment is remembered by its text in a bounded table.  New windows are
tokenised and aligned together, a block at a time.

Linking (``link``) needs no shuffle.  Counting (``counted``) sums the id pairs
of all documents, a pair of a batch at a time.  The most frequent pairs, a fixed
number, are broadcast and meet each document where it lies; only occurrences of
rarer pairs are shuffled to their counts, so no pair holds more than a sliver.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from ..session import ship_package
from . import shared

SHIFT = 32               # an id pair is A's id << SHIFT | B's id
REMEMBERED = 128 << 20   # bytes of windows remembered, twice
PIECE = 1 << 20          # characters of a text looked up at once
TOGETHER = 1 << 16       # characters of short texts looked up at once
BLOCK = 1 << 16          # windows tokenised and aligned at once
HOT = 1 << 18            # pairs whose counts are broadcast (a few MB)
#: a lone space between a word's end and a letter, digit or ASCII mark: no token of either tokenizer goes across
GAP = re.compile(r" (?<=[^\s▁] )(?=[^\W_]|[!-~])")
#: what may stand between two gaps
INNER = re.compile(r"(?=[^\W_]|[!-~])[^▁]*(?<=\S)\Z")
#: short windows of ASCII marks, digits and Latin letters, which `BYTE_LEVEL` splits as any version of Unicode does
LETTER = "A-Za-zÀ-ÖØ-öø-ſ"
PLAIN = re.compile(f"[!-~{LETTER}]{{1,64}}\\Z")
BYTE_LEVEL = re.compile(f"'(?:s|t|re|ve|m|ll|d)| ?[{LETTER}]+| ?[0-9]+| ?[^ 0-9{LETTER}]+")


class Met:
    """Values made before, by key; when full the table becomes the older half, and the half before is forgotten.

    ``make`` takes a list of keys; an entry is taken to have ``each`` bytes and 8 times its key's length.  Only the keys of one call come on top of the bound.
    """

    def __init__(self, make: Callable, each: int):
        self.make, self.each, self.bytes, self.now, self.older = make, each, 0, {}, {}

    def values(self, keys: list) -> list:
        """The value of every key."""
        if self.bytes > REMEMBERED:
            self.older, self.now, self.bytes = self.now, {}, 0
        now, older = self.now, self.older
        got = list(map(now.get, keys))
        holes = [i for i, v in enumerate(got) if v is None]
        if holes:
            missing = {keys[i] for i in holes}
            new = [k for k in missing if k not in older]
            if len(new) < len(missing):
                now.update((k, older[k]) for k in missing if k in older)
            if new:
                now.update(zip(new, self.make(new)))
            self.bytes += self.each * len(missing) + 8 * sum(map(len, missing))
            for i in holes:
                got[i] = now[keys[i]]
        return got


class Pair:
    """Both tokenizers of a worker, their token bytes, and the windows met so far."""

    NONE = (0, 0, "", 0, b"")  # of a window whose bytes differ

    def __init__(self, path_a: str | bytes, path_b: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_buffer(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=path_b)
        plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        rest = [b for b in range(256) if b not in plain]
        byte = {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(rest)}}
        #: bytes as the model's characters, a line feed as it is; the model itself where `BYTE_LEVEL` is all that stands before it
        self.char = {b: c for c, b in byte.items() if b != 10}
        spec = json.loads(path_a)
        kind = spec["pre_tokenizer"] or {}
        byte_level = (kind.get("type"), kind.get("add_prefix_space"), kind.get("use_regex")) == ("ByteLevel", False, True)
        self.model = self.a.model if byte_level and not spec["normalizer"] and all(t["special"] for t in spec["added_tokens"]) else None
        size = self.a.get_vocab_size()
        self.bytes_a = [bytes(byte[c] for c in t) if all(c in byte for c in t) else t.encode()
                        for t in (self.a.id_to_token(i) or "" for i in range(size))]
        b = self.b
        self.bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
                        for i in range(b.get_piece_size())]
        self.len_a, self.len_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        #: an id as it stands in groups, by the mark behind it
        self.text_a, self.text_b = ([f"{i}{m}" for i in range(n) for m in marks]
                                    for n, marks in ((len(self.bytes_a), ",|"), (len(self.bytes_b), ",;")))
        self.text = self.text_a + self.text_b
        self.text_length = np.array(list(map(len, self.text)))
        self.windows = Met(self.window, 450)

    def linked(self, texts: list[str]) -> list[tuple[int, int, str, int, bytes]]:
        """(A's tokens, B's, groups, their number, packed id pair per link) of whole texts; nothing
        where a tokenizer's bytes are not those of the text."""
        out = []
        for some in together(texts):
            if len(some) > 1:
                out += self.of_windows([GAP.split(t) if t else [] for t in some])
                continue
            made = [self.NONE]
            for part in parts(some[0]) if some[0] else ():
                made += self.of_windows([GAP.split(part)])
                if not made[-1][0]:
                    made = made[:1]
                    break
            a, b, groups, n, links = zip(*made)
            out.append((sum(a), sum(b), ";".join(groups[1:]), sum(n), b"".join(links)))
        return out

    def of_windows(self, lists: list[list[str]]) -> list[tuple[int, int, str, int, bytes]]:
        """As ``linked``, of texts cut at their gaps; looked up together."""
        met, out, at = self.windows.values([w for x in lists for w in x]), [], 0
        for x in lists:
            a, b, groups, n, links = zip(*met[at: at + len(x)]) if x else ((),) * 5
            at += len(x)
            out.append((sum(a), sum(b), ";".join(groups), sum(n), b"".join(links)) if all(a) else self.NONE)
        return out

    def window(self, windows: list[str]) -> list[tuple[int, int, str, int, bytes]]:
        """As ``linked``, of windows; all zeros where a tokenizer's bytes differ."""
        made = dict.fromkeys(windows, self.NONE)
        for some, a, b, sizes in self.encoded(windows):
            made.update(zip(some, self.align(a, b, np.cumsum(sizes))))
        return list(made.values())

    def tokens(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Both tokenizers' ids of whole texts; empty where their bytes are not those of the text."""
        out, none = [], np.zeros(0, np.int32)
        for text in texts:
            ids = [(none, none)]
            for part in parts(text) if text else ():
                windows, made = GAP.split(part), {}
                for some, a, b, sizes in self.encoded(list(dict.fromkeys(windows))):
                    end = np.cumsum(sizes)[:-1]
                    made.update(zip(some, zip(*(np.split(x, np.searchsorted(np.cumsum(n[x]), end) + 1)
                                                for x, n in ((a, self.len_a), (b, self.len_b))))))
                if len(made) < len(set(windows)):
                    ids = ids[:1]
                    break
                ids += map(made.__getitem__, windows)
            out.append(tuple(map(np.concatenate, zip(*ids))))
        return out

    def same(self, text: str, a: list[int], b: list[int]) -> bool:
        """Whether both tokenizers' bytes are a space and the text."""
        return (" " + text).encode() == b"".join(map(self.bytes_a.__getitem__, a)) == b"".join(map(self.bytes_b.__getitem__, b))

    def plain(self, text: str) -> list[int]:
        """A's ids of plain windows with a space in front: its model's, of the words that `BYTE_LEVEL` splits off."""
        words = BYTE_LEVEL.findall(" " + text)
        words = "\n".join(words).encode().decode("latin-1").translate(self.char).split("\n")
        return [t.id for w in words for t in self.model.tokenize(w)]

    def whole(self, text: str) -> list[int]:
        """A's ids of any text with a space in front."""
        return self.a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids

    def encoded(self, windows: list[str]) -> Iterator[tuple[list[str], np.ndarray, np.ndarray, list[int]]]:
        """Different windows, a block at a time: (windows, A's ids, B's, each window's bytes) of the
        windows with a space in front.  Those that may stand between gaps are tokenised as one text.
        Windows where a tokenizer's bytes are not those of the window are left out."""
        for at in range(0, len(windows), BLOCK):
            block = windows[at: at + BLOCK]
            plain = [w for w in block if PLAIN.match(w)] if self.model else []
            done = set(plain)
            inner = [w for w in block if w not in done and INNER.match(w)]
            some, ids_a, ids_b = [], [], []
            for these, ids in ((plain, self.plain), (inner, self.whole)):
                text = " ".join(these)
                a, b = (ids(text), self.b.encode(text)) if these else ([], [])
                if these and self.same(text, a, b):
                    some += these
                    ids_a += a
                    ids_b += b
            done = set(some)
            other = [w for w in block if w not in done]
            for w, a, b in zip(other, self.a.encode_batch_fast([" " + w for w in other], add_special_tokens=False),
                               self.b.encode(other, num_threads=1)) if other else ():
                if self.same(w, a.ids, b):
                    some.append(w)
                    ids_a += a.ids
                    ids_b += b
            if some:
                sizes = [1 + (len(w) if w.isascii() else len(w.encode())) for w in some]
                yield some, np.array(ids_a, np.int32), np.array(ids_b, np.int32), sizes

    def align(self, a: np.ndarray, b: np.ndarray, last: np.ndarray) -> list[tuple[int, int, str, int, bytes]]:
        """As ``linked``, of each window of the ids; ``last`` are the windows' ends in bytes."""
        end_a, end_b = np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b])
        ends, cut = merged(end_a, end_b)
        groups = np.searchsorted(cut, last, "right")
        if not np.array_equal(cut[groups - 1], last):
            raise ValueError("a token goes across a gap between words; these tokenizers cannot be cut there")
        # groups as text: A's ids of a group, then B's, each with the mark behind it
        group_a, group_b = np.searchsorted(cut, end_a), np.searchsorted(cut, end_b)
        size_a, size_b = np.cumsum(np.bincount(group_a)), np.cumsum(np.bincount(group_b))
        words = np.empty(len(a) + len(b), np.int64)
        words[np.arange(len(a)) + np.r_[0, size_b][group_a]] = 2 * a.astype(np.int64) + (end_a == cut[group_a])
        words[np.arange(len(b)) + size_a[group_b]] = len(self.text_a) + 2 * b.astype(np.int64) + (end_b == cut[group_b])
        n_a, n_b = size_a[groups - 1], size_b[groups - 1]
        stop = np.cumsum(self.text_length[words])[n_a + n_b - 1].tolist()
        text = "".join(map(self.text.__getitem__, words.tolist()))
        # every stretch between neighbouring ends lies in one token of each: one link
        pairs = a[np.searchsorted(end_a, ends)].astype(np.int64) << SHIFT | b[np.searchsorted(end_b, ends)]
        raw, reach = pairs.tobytes(), (8 * np.searchsorted(ends, last, "right")).tolist()
        n_a, n_b, groups = (np.diff(x, prepend=0).tolist() for x in (n_a, n_b, groups))
        return [(x, y, text[i:k - 1], n, raw[u:w]) for x, y, i, k, n, u, w in zip(
            n_a, n_b, [0, *stop], stop, groups, [0, *reach], reach)]

    def aligned(self, a: np.ndarray, b: np.ndarray) -> tuple[str, int, np.ndarray]:
        """(groups, their number, id pair per link) of a document's ids."""
        groups, n, links = self.align(a, b, self.len_a[a].sum(keepdims=True))[0][2:] if len(a) else self.NONE[2:]
        return groups, n, np.frombuffer(links, np.int64)


def merged(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of two ascending arrays without repeats, and those in both."""
    both = np.sort(np.concatenate([x, y]), kind="stable")
    twice = both[1:] == both[:-1]
    return both[np.r_[~twice, True]] if len(both) else both, both[1:][twice]


def together(texts: list[str]) -> Iterator[list[str]]:
    """The texts in runs of about TOGETHER characters; a longer one stands alone."""
    at, held = 0, 0
    for i, text in enumerate(texts):
        if i > at and held + len(text) > TOGETHER:
            yield texts[at:i]
            at, held = i, 0
        held += len(text)
    if texts:
        yield texts[at:]


def parts(text: str) -> Iterator[str]:
    """The text cut at gaps, about PIECE characters each; a gap's space is left out, as the
    tokenizers put one in front of each part."""
    at = 0
    while len(text) - at > PIECE:
        m = GAP.search(text, at + PIECE)
        if not m:
            break
        yield text[at: m.start()]
        at = m.end()
    yield text[at:] if at else text


_MADE: dict[tuple[str, str], Pair] = {}

LINKED = StructType([StructField("n_a", LongType()), StructField("n_b", LongType()), StructField("n_groups", LongType()),
                     StructField("n_links", LongType()), StructField("groups", StringType()),
                     StructField("pairs", ArrayType(LongType())), StructField("times", ArrayType(IntegerType()))])


def link(df: DataFrame, path_a: str, path_b: str, text_col: str = "text") -> DataFrame:
    """Every row of ``df`` without ``text_col``, aligned: ``n_a``, ``n_b`` tokens, ``n_groups``,
    ``n_links``, ``groups`` (`a1,a2|b1;a3|b2`), and the distinct linked id ``pairs``
    (A's id << 32 | B's id) with their ``times`` in the text.

    Null, empty and differing texts (where a tokenizer's bytes are not a space
    and the text) have no tokens: zeros, an empty ``groups``.  Strings of special
    tokens are plain text.  Texts are tokenised whole, long ones a megabyte at a
    time between a word's end and a letter, which changes no id.  Repeated rows are aligned one by
    one; an empty table gives an empty table; existing columns of the new names
    are replaced.
    """
    shared.require(df, text_col)
    spark = df.sparkSession
    ship_package(spark)
    with open(path_a, "rb") as f, open(path_b, "rb") as g:
        shipped = spark.sparkContext.broadcast((f.read(), g.read()))
    taken = {text_col.lower(), *LINKED.fieldNames()}
    keep = [F.col(f"`{c}`") for c in df.columns if c.lower() not in taken]
    k = len(keep)
    schema = StructType([*df.select(*keep).schema.fields, *LINKED.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (path_a, path_b) not in _MADE:
            _MADE[path_a, path_b] = Pair(*shipped.value)
        pair = _MADE[path_a, path_b]
        for b in shared.in_bytes(batches, k, rows=512):
            met = pair.linked([t or "" for t in b.column(k).to_pylist()])
            distinct = [np.unique(np.frombuffer(m[4], np.int64), return_counts=True) for m in met]
            starts = pa.array(np.r_[0, np.cumsum([len(d[0]) for d in distinct])], pa.int32())
            lists = [pa.ListArray.from_arrays(starts, pa.array(np.concatenate([d[i] for d in distinct]).astype(t)))
                     for i, t in ((0, np.int64), (1, np.int32))]
            columns = [[m[0] for m in met], [m[1] for m in met], [m[3] for m in met], [len(m[4]) // 8 for m in met]]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:k], *(pa.array(c, pa.int64()) for c in columns), pa.array([m[2] for m in met], pa.string()), *lists],
                names=schema.fieldNames())

    return shared.positional(df, *keep, F.col(text_col)).mapInArrow(run, schema)


def _batches(batches: Iterator[pa.RecordBatch], rows: int = 4_096) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def pair_counts(linked: DataFrame) -> DataFrame:
    """(pair, n, best): the links of every id pair over all rows, and whether no pair of its B id has more.

    Pairs are summed per batch in the scan tasks before the shuffle; a B id has
    at most as many pairs as A has ids.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _batches(batches):
            flat, times = (b.column(i).flatten().to_numpy(zero_copy_only=False) for i in (0, 1))
            pair, where = np.unique(flat, return_inverse=True)
            n = np.bincount(where, times, len(pair)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n)], names=["pair", "n"])

    summed = linked.select("pairs", "times").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    return summed.withColumn("b", F.col("pair").bitwiseAND(F.lit((1 << SHIFT) - 1))).select(
        "pair", "n", (F.col("n") == F.max("n").over(Window.partitionBy("b"))).alias("best"))


def counted(linked: DataFrame, counts: DataFrame | None = None, hot: int = HOT) -> DataFrame:
    """Every row of ``linked`` without ``pairs`` and ``times``, with ``n_best`` (links whose pair
    is its B id's most frequent, ties included) and ``count_sum`` (of its links' pairs' counts).

    ``linked``: output of ``link``, written to a table, as it is read more than once.  The
    ``hot`` most frequent pairs are broadcast; the occurrences of the others are joined
    to ``counts`` by shuffle, and each has at most a ``hot``-th of all links.  Rows
    without links get zeros.
    """
    spark = linked.sparkSession
    counts = shared.written(pair_counts(linked), "pair-counts") if counts is None else counts
    top = counts.orderBy(F.col("n").desc(), "pair").limit(hot).toArrow()
    order = np.argsort(top["pair"].to_numpy())
    shipped = spark.sparkContext.broadcast(tuple(top[c].to_numpy()[order] for c in ("pair", "n", "best")))
    keep = [c for c in linked.columns if c not in ("pairs", "times")]
    extra = StructType([StructField("n_best", LongType()), StructField("count_sum", LongType()),
                        StructField("rare", ArrayType(LongType())), StructField("rare_times", ArrayType(IntegerType()))])
    names = {f: shared.fresh(f, linked.columns) for f in ("row", "rare", "rare_times")}
    clean = [c for c in keep if c.lower() not in ("n_best", "count_sum")]
    k = len(clean)
    schema = StructType([*linked.select(*[F.col(f"`{c}`") for c in clean]).schema.fields, *extra.fields[:2],
                         *(StructField(names[f.name], f.dataType) for f in extra.fields[2:])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = shipped.value
        for b in _batches(batches):
            sizes = np.diff(b.column(k).offsets.to_numpy())
            flat, times = (b.column(i).flatten().to_numpy(zero_copy_only=False) for i in (k, k + 1))
            row = np.repeat(np.arange(b.num_rows), sizes)
            at = np.minimum(np.searchsorted(pair, flat), max(len(pair) - 1, 0))
            hit = pair[at] == flat if len(pair) else np.zeros(len(flat), bool)
            total, wins = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, np.int64)
            np.add.at(total, row[hit], n[at[hit]] * times[hit])
            np.add.at(wins, row[hit], best[at[hit]] * times[hit].astype(np.int64))
            left = ~hit
            starts = pa.array(np.r_[0, np.cumsum(np.bincount(row[left], minlength=b.num_rows))], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:k], pa.array(wins), pa.array(total), pa.ListArray.from_arrays(starts, pa.array(flat[left])),
                 pa.ListArray.from_arrays(starts, pa.array(times[left].astype(np.int32)))], names=schema.fieldNames())

    source = shared.positional(linked, *[F.col(f"`{c}`") for c in clean], F.col("pairs"), F.col("times")).mapInArrow(run, schema)
    met = shared.written(source.withColumn(names["row"], F.monotonically_increasing_id()), "aligned")
    rare = met.select(names["row"], F.explode(F.arrays_zip(F.col(names["rare"]).alias("pair"), F.col(names["rare_times"]).alias("times")))
                      .alias("x")).select(F.col(names["row"]).alias("row"), "x.pair", "x.times")
    sums = rare.join(counts, "pair").groupBy("row").agg(
        F.sum(F.col("n") * F.col("times")).alias("more"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("wins"))
    return met.join(sums, met[names["row"]] == sums["row"], "left").select(
        *[met[f"`{c}`"] for c in clean],
        (met["n_best"] + F.coalesce(sums["wins"], F.lit(0))).alias("n_best"),
        (met["count_sum"] + F.coalesce(sums["more"], F.lit(0))).alias("count_sum"))
