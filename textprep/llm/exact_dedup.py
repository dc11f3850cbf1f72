"""Exact duplicate removal by a distributed content sort (DataFrame functions only).

1. Rows are range-partitioned on a short key: the leading characters of the
   normalised text, then its 64-bit hash, then a salt.  Spark samples that key for its
   splitters, so whole texts never reach the driver, and texts with a common
   beginning still spread by their hash.
2. Within a partition an external (spilling) sort places equal texts adjacent;
   the window compares each text whole with its neighbour, and every run of
   equal texts gets its winner and its length.  The sorted rows are written once.
3. A text with more rows than ``max(64, rows / 65,536)`` by the counts of its hash
   (map-side combined) is salted by its whole rows over several runs.  After the sort the
   winners of these runs are compared with one another.  That takes one narrow row per
   run, at most some 131,072 whatever the size of the input, so it is broadcast.

All other texts are one run.  Either way the sort finds the copies.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize
from . import shared

PREFIX = 16  # leading characters in the range key
RUN_ROWS = 64  # rows of a text from which it is salted, on small inputs
MAX_HOT = 65_536  # bound of the salted texts


ADDED = ("keep_id", "group_size", "kept", "text_sha256")


def _added(df: DataFrame, *but: str) -> list[str]:
    """Columns of ``df`` that the result replaces."""
    return [c for c in df.columns if c.lower() in ADDED and c not in but]


def _sorted(df: DataFrame, id_col: str, text_col: str, keep: str,
            normalise: Callable[[Column], Column] | None) -> tuple[DataFrame, tuple[str, ...]]:
    """Every row with its place in its run of equal texts, and the names of (hash, salt, place,
    winner, run length, salted runs)."""
    shared.require(df, id_col, text_col)
    if keep not in ("smallest", "largest"):
        raise ValueError("keep must be 'smallest' or 'largest'")
    best = F.min if keep == "smallest" else F.max
    taken = [*df.columns, *ADDED]
    text, pre, h, salt, rn, size, win, runs = (
        shared.fresh(n, taken) for n in ("t", "pre", "h", "salt", "rn", "size", "win", "runs"))
    value = F.coalesce(F.col(text_col), F.lit(""))
    value = normalise(value) if normalise else value
    rows = df.withColumn(text, value).withColumn(h, F.xxhash64(text))

    limit = max(RUN_ROWS, df.count() // MAX_HOT)
    hot = rows.groupBy(h).agg(F.count(F.lit(1)).alias(runs)).where(F.col(runs) > limit)
    hot = materialize(hot.select(h, F.ceil(F.col(runs) / F.lit(limit)).cast("long").alias(runs)))

    # the other columns spread rows that share an identifier, or have none; maps cannot be hashed
    hashed = [f.name for f in df.schema.fields
              if f.name != text_col and not any(t in f.dataType.simpleString() for t in ("map<", "variant"))]
    salted = (
        rows.join(F.broadcast(hot), h, "left")
        .withColumn(salt, F.when(F.col(runs).isNull(), F.lit(0).cast("long"))
                    .otherwise(F.pmod(F.xxhash64(F.lit(1), *hashed), F.col(runs))))
        .withColumn(pre, F.substring(text, 1, PREFIX))
        .repartitionByRange(shared.partitions(df.sparkSession), pre, h, salt)
    )
    run = Window.partitionBy(pre, h, salt, text)
    order = F.col(id_col).asc_nulls_last() if keep == "smallest" else F.col(id_col).desc_nulls_last()
    ranked = (
        salted.withColumn(rn, F.row_number().over(run.orderBy(order)))
        .withColumn(win, best(F.col(id_col)).over(run))
        .withColumn(size, F.count(F.lit(1)).over(run))
    )
    sha = F.sha2(F.col(text).cast("binary"), 256).alias("text_sha256")
    return (ranked.select(*df.drop(*_added(df, id_col, text_col)).columns, h, salt, rn, win, size, runs, sha),
            (h, salt, rn, win, size, runs))


def _merged(rows: DataFrame, names: tuple[str, ...], keep: str) -> DataFrame:
    """Sorted rows with ``keep_id``, ``group_size`` and ``kept``: the runs of a salted text become one."""
    h, salt, rn, win, size, runs = names
    firsts = rows.where(F.col(runs).isNotNull() & (F.col(rn) == 1)).select(h, salt, win, size, "text_sha256")
    all_runs = Window.partitionBy(h, "text_sha256")
    order = F.col(win).asc_nulls_last() if keep == "smallest" else F.col(win).desc_nulls_last()
    runs_of_text = firsts.select(
        h, salt, "text_sha256",
        (F.min if keep == "smallest" else F.max)(win).over(all_runs).alias("keep_id"),
        F.sum(size).over(all_runs).alias("group_size"),
        (F.row_number().over(all_runs.orderBy(order, salt)) == 1).alias("kept"))
    got = rows.join(F.broadcast(runs_of_text), [h, salt, "text_sha256"], "left")
    first = F.col(rn) == 1
    return (got.withColumn("kept", first & F.coalesce(F.col("kept"), F.lit(True)))
            .withColumn("keep_id", F.when(F.col("group_size").isNull(), F.col(win)).otherwise(F.col("keep_id")))
            .withColumn("group_size", F.coalesce("group_size", F.col(size))))


def mark(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest",
         normalise: Callable[[Column], Column] | None = None) -> DataFrame:
    """Every row of ``df`` with ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    ``keep``: ``smallest`` or ``largest`` identifier stays.  ``normalise`` maps
    the text column; none compares the texts as they are.  Existing columns of
    those four names are replaced.

    A null text counts as empty.  A null identifier stays only if its text has
    no other, and rows equal in text and identifier are ties: exactly one of
    them is kept.  Copies that are equal in every column share a run, whatever their
    number.  An empty table gives an empty result.
    """
    out = [*df.drop(*_added(df, id_col, text_col)).columns, *ADDED]
    rows, names = _sorted(df, id_col, text_col, keep, normalise)
    return _merged(materialize(rows), names, keep).select(*out)


def dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest",
          normalise: Callable[[Column], Column] | None = None) -> DataFrame:
    """The rows that stay, with the columns of ``df``; only the first row of each run is written."""
    rows, names = _sorted(df, id_col, text_col, keep, normalise)
    return _merged(materialize(rows.where(F.col(names[2]) == 1)), names, keep).where("kept").select(*df.columns)
