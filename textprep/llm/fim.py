"""Fill-in-middle transformation of whole texts as a ``pyarrow.compute`` pipeline.

A batch's texts are split into units (white space with the word after it; white
space at the end) as one list array, flattened with the index of its parent
text; a unit's ordinal in its text gives its role (prefix, middle, suffix).
Each role's units are filtered out, rebuilt into lists and joined per text, and
the joined pieces are put in the order of the text's form.  No row is handled
on its own.

The draws hash the identifier, so they do not depend on partitioning or on
which worker ran.  The unit's separator is a byte that no UTF-8 text contains.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from . import shared

UNIT = r"([ \t-\r]*[^ \t-\r]+|[ \t-\r]+)"
SENTINELS = ("<P>", "<S>", "<M>")  # prefix, suffix, middle; none may begin with the end of another
CUT = b"\xff"  # in no UTF-8 text
BYTES = pa.large_binary()


def draws(id_col: str, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers of the row's identifier; null counts as the empty string."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def _mod(x: pa.Array, m: pa.Array | int) -> pa.Array:
    return pc.subtract(x, pc.multiply(pc.divide(x, m), m))


def _starts(counts: pa.Array) -> pa.Array:
    """List offsets from list lengths."""
    return pa.array(np.r_[0, np.cumsum(counts.to_numpy(zero_copy_only=False))], pa.int32())


def pieces(texts: pa.Array, h1: pa.Array, h2: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array, pa.Array]:
    """(units, prefix, middle, suffix) of each text: the number of units and the joined pieces."""
    marked = pc.replace_substring_regex(texts, pattern=UNIT, replacement=CUT + b"\\1")
    units = pc.split_pattern(marked, pattern=CUT)  # a text's list begins with the empty piece before its first unit
    n = pc.subtract(pc.cast(pc.list_value_length(units), pa.int64()), 1)
    points = pc.add(n, 1)
    d1, d2 = _mod(h1, points), _mod(h2, points)
    first, second = pc.min_element_wise(d1, d2), pc.max_element_wise(d1, d2)

    flat, parent = pc.list_flatten(units), pc.list_parent_indices(units)
    starts = pc.cast(units.offsets.slice(0, len(units)), pa.int64())
    ordinal = pc.subtract(pa.array(np.arange(len(flat))), pc.take(starts, parent))  # 0: the empty piece
    low, high = pc.take(first, parent), pc.take(second, parent)
    before, after = pc.less_equal(ordinal, low), pc.greater(ordinal, high)
    between = pc.invert(pc.or_(before, after))

    def joined(role: pa.Array, counts: pa.Array) -> pa.Array:
        lists = pa.ListArray.from_arrays(_starts(counts), pc.filter(flat, role))
        return pc.binary_join(lists, pa.scalar(b"", BYTES))

    return (n, joined(before, pc.add(first, 1)), joined(between, pc.subtract(second, first)),
            joined(after, pc.subtract(n, second)))


def transformed(texts: pa.Array, h: list[pa.Array], rate: int, spm_rate: int,
                sentinels: tuple[str, str, str]) -> list[pa.Array]:
    """Columns n, form, prefix_chars, middle_chars, output of a batch's texts."""
    t = pc.cast(pc.fill_null(texts, ""), BYTES)
    n, prefix, middle, suffix = pieces(t, h[0], h[1])
    plain = pc.or_(pc.equal(pc.binary_length(t), 0), pc.greater_equal(_mod(h[2], 100), rate))
    for s in sentinels:
        plain = pc.or_(plain, pc.match_substring(t, pattern=s.encode()))
    spm = pc.less(_mod(h[3], 100), spm_rate)
    p, s, m = (pa.scalar(x.encode(), BYTES) for x in sentinels)
    none = pa.scalar(b"", BYTES)
    output = pc.if_else(plain, t, pc.if_else(
        spm, pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, none),
        pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, none)))

    def chars(x: pa.Array) -> pa.Array:
        length = pc.cast(pc.utf8_length(pc.cast(x, pa.large_string())), pa.int64())
        return pc.if_else(plain, pa.scalar(None, pa.int64()), length)

    form = pc.if_else(plain, "plain", pc.if_else(spm, "spm", "psm"))
    return [n, form, chars(prefix), chars(middle), pc.cast(output, pa.string())]


OUT = StructType([StructField("n", LongType()), StructField("form", StringType()), StructField("prefix_chars", LongType()),
                  StructField("middle_chars", LongType()), StructField("output", StringType())])


def transform(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 42, rate: int = 50,
              spm_rate: int = 80, sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """Every row of ``df`` without ``text_col``, with ``n`` (units), ``form`` (plain, psm, spm),
    ``prefix_chars``, ``middle_chars`` (code points; null if plain) and ``output``.

    ``rate`` percent of the rows are cut, ``spm_rate`` percent of these suffix
    first.  Null texts count as empty; empty texts and those that contain a
    sentinel stay plain.  A null identifier draws as the empty string, rows of a
    repeated identifier draw alike.  An empty table gives an empty table, and
    existing columns of the new names (in any case) are replaced.  Memory is bounded by a slice of
    some megabytes, or by the longest text (below 2 GB, an Arrow string's limit).
    """
    shared.require(df, id_col, text_col)
    names = {f.name for f in OUT.fields} | {text_col.lower()}
    keep = [F.col(f"`{c}`") for c in df.columns if c.lower() not in names]
    schema = StructType([*df.select(*keep).schema.fields, *OUT.fields])
    k = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in shared.in_bytes(batches, k):
            made = transformed(b.column(k), b.columns[k + 1:], rate, spm_rate, sentinels)
            yield pa.RecordBatch.from_arrays([*b.columns[:k], *made], names=schema.fieldNames())

    return shared.positional(df, *keep, F.col(text_col), *draws(id_col, seed)).mapInArrow(run, schema)


def restored(output: Column | str, form: Column | str, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The original text, from an output and its form alone.

    A cut text has no sentinel of its own, so each stands once in the output.
    """
    out = F.col(output) if isinstance(output, str) else output
    kind = F.col(form) if isinstance(form, str) else form
    p, s, m = sentinels

    def between(a: str, b: str) -> Column:
        return F.substring_index(F.substring_index(out, a, -1), b, 1)

    middle = F.substring_index(out, m, -1)
    psm = F.concat(between(p, s), middle, between(s, m))
    spm = F.concat(between(p, m), middle, between(s, p))
    return F.when(kind == "psm", psm).when(kind == "spm", spm).otherwise(out)
