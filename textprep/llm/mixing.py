"""Mixing sources to target weights by a time-varying curriculum (DataFrame functions only).

Every source has a weight schedule: its weight times a piecewise-linear
multiplier over training time 0..1.  Integrating the schedule gives the
source's cumulative demand, scaled so that it ends at the source's target.
Inverting that demand at a document's place in its source's word stream gives
the document's training position; range-sorting by position is the mix.

Targets: the sources share ``budget`` times all words by weight; none takes
more than ``max_epochs`` times its own size, and what exceeds that is shared
among the others by weight until none is above (solved in closed form).

``assign`` gives every document its places; ``draw`` writes the mix itself, one
row per copy in training order, and counts from it what each document gave.

A source's stream is its documents in a seeded hash order, epoch after epoch.
The running word count of that order comes from two levels: buckets of the
hash, about ``BUCKET_ROWS`` rows each, whose totals are summed in order, and a
window inside each bucket.  No source is ever in one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import broadcast_if_small, materialize
from . import shared

WORD = "[^\\x20\\x09-\\x0D]+"
BUCKET_ROWS = 500
CELL_ROWS = 8 * BUCKET_ROWS  # of one identifier, about: more are placed by their texts too
MAX_BROADCAST_SOURCES = 100_000  # counted; more sources are joined by shuffle
WEIGHTS = (5.0, 2.0, 1.0)
# (time, multiplier) knots by position in the weight cycle: heavy sources lead,
# light ones come late.  Multipliers integrate to 1, so they move no target.
SCHEDULES = (((0.0, 1.2), (1.0, 0.8)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)))


def words(text: Column) -> Column:
    """Size of a text: its runs of characters other than ASCII white space; null: 0."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, max_epochs: float = 3.0,
            budget: float = 1.0) -> DataFrame:
    """(source, source_no, source_size, rows, weight_no, target) from (source, source_size, rows).

    One row per source.  Weights repeat over the sources in code point order,
    null last.  Sorted by cap / weight, the capped sources are a prefix: a
    source is capped while the level (words per unit of weight) left by those
    before it is at least its own cap / weight.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_level = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("weight_no") + 1).cast("int"))
    t = (
        sizes.withColumn("source_no", F.row_number().over(by_name).cast("long") - 1)
        .withColumn("weight_no", F.col("source_no") % F.lit(len(weights)))
        .withColumn("weight", w)
        .withColumn("cap", F.lit(float(max_epochs)) * F.col("source_size"))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("total", F.lit(float(budget)) * F.sum("source_size").over(everything))
        .withColumn("weights", F.sum("weight").over(everything))
        .withColumn("cap_before", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("weight_before", F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("level", (F.col("total") - F.col("cap_before")) / (F.col("weights") - F.col("weight_before")))
        .withColumn("capped", F.col("ratio") <= F.col("level"))
        # the level of the first source that is not capped holds for all after it
        .withColumn("final", F.min(F.when(~F.col("capped"), F.struct("ratio", "level"))).over(everything)["level"])
    )
    return t.select("source", "source_no", "source_size", "rows", "weight_no",
                    F.when(F.col("capped"), F.col("cap")).otherwise(F.col("final") * F.col("weight")).alias("target"))


def position(share: Column, weight_no: Column, schedules: Sequence[Sequence[tuple[float, float]]]) -> Column:
    """Time at which the cumulative demand reaches ``share`` (0..1) of its end."""
    table = []
    for knots in schedules:
        areas = [(t1 - t0) * (m0 + m1) / 2 for (t0, m0), (t1, m1) in zip(knots, knots[1:])]
        total, done, segs = sum(areas), 0.0, []
        for ((t0, m0), (t1, m1)), a in zip(zip(knots, knots[1:]), areas):
            segs.append(F.struct(*[F.lit(float(v)).alias(n) for n, v in (
                ("begin", done / total), ("t0", t0), ("m0", m0 / total),
                ("slope", (m1 - m0) / (t1 - t0) / total))]))
            done += a
        table.append(F.array(*segs))
    segs = F.element_at(F.array(*table), (weight_no + 1).cast("int"))
    seg = F.element_at(F.filter(segs, lambda s: s["begin"] <= share), -1)
    # m0 x + slope x^2 / 2 = share - begin, solved in the form that holds for slope 0 too
    rest = share - seg["begin"]
    root = F.sqrt(F.greatest(F.lit(0.0), seg["m0"] * seg["m0"] + 2 * seg["slope"] * rest))
    return F.least(F.lit(1.0), seg["t0"] + F.when(rest > 0, 2 * rest / (seg["m0"] + root)).otherwise(0.0))


def stream_key(seed: int, id_col: str, text_col: str, source_col: str, spread: bool = False) -> Column:
    """A row's place in its source's stream, 0 <= key < 2^31.

    Ties go by identifier and size, then rows are equal for the mix.  The text
    spreads rows that have no identifier, and with ``spread`` those that share one.
    """
    text = F.col(text_col) if spread else F.when(F.col(id_col).isNull(), F.col(text_col))
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), id_col, source_col, text), 33)


def assign(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
           weights: Sequence[float] = WEIGHTS, schedules=SCHEDULES, max_epochs: float = 3.0,
           budget: float = 1.0, seed: int = 42) -> DataFrame:
    """Every row of ``df`` with its place in the mix.

    Adds ``size``, ``source_size``, ``target``, ``copies`` (whole uses of the
    row), ``taken`` (= copies x size) and ``positions`` (one training position
    in 0..1 per copy).  Existing columns of those names are replaced.

    An epoch's last document is taken when the target lies past its middle, so
    a source ends within half a document of its target.  Null texts have size
    0; rows of size 0 take no words and get no copy.  Null sources form one
    source, sorted last.  Null identifiers and repeated rows are rows like any
    other; rows with the same identifier and text are interchangeable.  Where more
    than ``CELL_ROWS`` rows fall on one 2^20th of the keys, as those of one
    identifier do, these rows are placed by their texts too.  An empty table gives
    an empty result.
    """
    shared.require(df, id_col, text_col, source_col)
    out = ["size", "source_size", "target", "copies", "taken", "positions"]
    df = df.drop(*[c for c in df.columns if c.lower() in out and c not in (id_col, text_col, source_col)])
    sized = df.withColumn("size", words(F.col(text_col)))
    names = [*df.columns, *out]
    key, bucket, begin, no, src, n = (shared.fresh(x, names) for x in ("key", "bucket", "begin", "no", "src", "n"))
    sized = sized.withColumn(key, stream_key(seed, id_col, text_col, source_col))

    def cells() -> DataFrame:
        return materialize(sized.groupBy(F.col(source_col).alias("source"), F.shiftright(key, 11).alias("fine"))
                           .agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("rows")))

    small = cells()
    full = small.where(F.col("rows") > CELL_ROWS).select(F.col("source").alias(src), F.col("fine").alias(n))
    if not full.isEmpty():
        full, _ = broadcast_if_small(full.withColumn(bucket, F.lit(True)))
        spread = F.when(F.col(bucket), stream_key(seed, id_col, text_col, source_col, spread=True)).otherwise(F.col(key))
        at = F.col(source_col).eqNullSafe(F.col(src)) & (F.shiftright(key, 11) == F.col(n))
        sized = sized.join(full, at, "left").withColumn(key, spread).drop(src, n, bucket)
        small = cells()
    sources = materialize(targets(
        small.groupBy("source").agg(F.sum("words").alias("source_size"), F.sum("rows").alias("rows")),
        weights, max_epochs, budget))
    by_source, _ = broadcast_if_small(
        sources.select(F.col("source").alias(src), F.col("source_no").alias(no), F.col("rows").alias(n)),
        MAX_BROADCAST_SOURCES, materialized=True)

    def numbered(rows: DataFrame, source: str, key20: Column) -> DataFrame:
        """With the source's number and the row's bucket: about BUCKET_ROWS rows, at most 2^20 buckets."""
        buckets = F.least(F.lit(1 << 20), F.ceil(F.col(n) / F.lit(BUCKET_ROWS)))
        return (rows.join(by_source, F.col(source).eqNullSafe(F.col(src)))
                .withColumn(bucket, F.floor(key20 * buckets / F.lit(1 << 20))).drop(src, n))

    ahead = Window.partitionBy(no).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    plan = (
        numbered(small, "source", F.col("fine")).groupBy(no, bucket).agg(F.sum("words").alias("words"))
        .select(no, bucket, F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias(begin))
        .join(sources.select(F.col("source_no").alias(no), "source_size", "target", "weight_no"), no)
    )
    rows = numbered(sized, source_col, F.shiftright(key, 11)).join(plan, [no, bucket])
    inside = (Window.partitionBy(no, bucket).orderBy(key, F.col(id_col).asc_nulls_first(), "size")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    start = F.col(begin) + F.sum("size").over(inside) - F.col("size")
    rows = rows.withColumn(begin, start.cast("double"))
    # copy e begins at e * source_size + begin; it is taken while the target lies past its middle
    reach = F.col("target") - F.col(begin) - F.col("size") / 2.0
    copies = F.when((F.col("size") > 0) & (reach >= 0),
                    F.least(F.floor(reach / F.col("source_size")) + 1, F.lit(math.ceil(max_epochs)))).otherwise(F.lit(0))
    share = lambda e: (e * F.col("source_size") + F.col(begin)) / F.col("target")
    rows = rows.withColumn("copies", copies.cast("long")).withColumn(
        "positions",
        F.when(F.col("copies") > 0, F.transform(
            F.sequence(F.lit(0).cast("long"), F.greatest(F.col("copies") - 1, F.lit(0).cast("long"))),
            lambda e: position(share(e), F.col("weight_no"), schedules))).otherwise(F.array().cast("array<double>")))
    return rows.select(*[F.col(c) for c in df.columns], "size", "source_size", "target", "copies",
                       (F.col("copies") * F.col("size")).alias("taken"), "positions")


def training_order(assigned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per copy, range-sorted by ``position`` (ties by identifier)."""
    rows = assigned.withColumn("position", F.explode("positions")).drop("positions")
    return (rows.repartitionByRange(shared.partitions(assigned.sparkSession), "position", id_col)
            .sortWithinPartitions("position", id_col))


def draw(assigned: DataFrame, id_col: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(rows, mix) of assigned rows: the mix as written, and the rows with what it takes of them.

    The mix has the rows' columns and ``position``, one row per copy, in files that follow
    each other in training order.  ``copies`` and ``taken`` of a row are counted in the
    written mix.  Rows are followed by a number of their own, so identifiers may repeat or be null.
    """
    row, copies, taken = (shared.fresh(x, [*assigned.columns, "position"]) for x in ("row", "copies", "taken"))
    placed = materialize(assigned.withColumn(row, F.monotonically_increasing_id()))
    order = training_order(placed.drop("copies", "taken"), id_col)
    mix = shared.written(order, "mix")
    counted = mix.groupBy(row).agg(F.count(F.lit(1)).alias(copies), F.sum("size").alias(taken))
    none = F.lit(0).cast("long")
    given = placed.join(counted, row, "left").withColumns(
        {"copies": F.coalesce(copies, none), "taken": F.coalesce(taken, none)})
    return given.select(*assigned.columns), mix.drop(row)
