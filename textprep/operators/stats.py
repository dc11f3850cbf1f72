"""Histograms, shares and summary statistics as tables.

Only the one-row range of a column (min/max) goes to the driver, to fix the
bin edges; counting is a distributed ``groupBy(bin)``.  The bin skeleton is a
``range`` of the requested bin count, so empty bins appear with zero.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import rows_frame


def equal_width_bin(x: Column, lo: float, hi: float, bins: int) -> Column:
    """Bin index of ``x`` in [lo, hi] cut into ``bins``; the last bin is closed."""
    return F.least(
        F.floor((x - F.lit(lo)) * F.lit(float(bins)) / F.lit(hi - lo)).cast("int"),
        F.lit(bins - 1),
    )


def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """Equal-width histogram with density (H1): (bin, lo, hi, n, density).

    Edges run from min to max; when min = max the range is widened by 0.5 on
    each side.  Nulls are ignored.  Empty input gives an empty table.
    """
    spark = df.sparkSession
    x = F.col(col).cast("double")
    vals = df.select(x.alias("x")).where(F.col("x").isNotNull())
    r = vals.agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.count(F.lit(1)).alias("n")).first()
    if r is None or r["n"] == 0:
        return rows_frame(spark, [], "bin int, lo double, hi double, n long, density double")
    lo, hi, total = float(r["lo"]), float(r["hi"]), int(r["n"])
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / bins
    counts = vals.groupBy(equal_width_bin(F.col("x"), lo, hi, bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("n")
    )
    skeleton = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (
        skeleton.join(F.broadcast(counts), "bin", "left")
        .select(
            "bin",
            (F.lit(lo) + F.col("bin") * F.lit(width)).alias("lo"),
            (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("hi"),
            F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n"),
            (F.coalesce(F.col("n"), F.lit(0)) / F.lit(total * width)).alias("density"),
        )
    )


def integer_histogram(df: DataFrame, col: str, cap: int, overflow: bool = False) -> DataFrame:
    """Unit-width histogram over edges 0..E, E = min(max + 2, cap) - 1 (H2).

    Bins [i, i+1), the last one closed.  Values past E are left out, as in the
    reference's plot, or with ``overflow`` counted in a last row of their own, from E
    to the greatest value (``bin`` = E; only if there are any).  ``density`` follows the plotted range, as in the reference: values past
    E are not in its denominator, and their row has none; ``share`` is of the
    counted values and adds up to 1.  Nulls and negative values take no part.
    """
    spark = df.sparkSession
    x = F.col(col).cast("long")
    vals = df.select(x.alias("x")).where(F.col("x").isNotNull())
    r = vals.agg(F.max("x").alias("mx")).first()
    mx = 0 if r is None or r["mx"] is None else int(r["mx"])
    last_edge = min(mx + 2, cap) - 1
    if last_edge < 1:
        return rows_frame(spark, [], "bin int, lo long, hi long, n long, density double, share double")
    bin_ = F.when(F.col("x") > last_edge, last_edge).otherwise(F.least(F.col("x"), F.lit(last_edge - 1))).cast("int")
    counts = vals.where((F.col("x") >= 0) & (F.lit(overflow) | (F.col("x") <= last_edge))).groupBy(bin_.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    inside = F.col("bin") < last_edge
    total = F.sum(F.when(inside, F.col("n"))).over(Window.partitionBy())
    every = F.sum("n").over(Window.partitionBy())
    skeleton = spark.range(last_edge + (overflow and mx > last_edge)).select(F.col("id").cast("int").alias("bin"))
    return (
        skeleton.join(F.broadcast(counts), "bin", "left")
        .select("bin", F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n"))
        .select(
            "bin",
            F.col("bin").cast("long").alias("lo"),
            F.when(inside, F.col("bin") + 1).otherwise(mx).cast("long").alias("hi"),
            "n",
            F.when(inside, F.when(total > 0, F.col("n") / total).otherwise(F.lit(0.0))).alias("density"),
            F.when(every > 0, F.col("n") / every).otherwise(F.lit(0.0)).alias("share"),
        )
    )


def with_share(df: DataFrame, count_col: str = "n", out: str = "pct") -> DataFrame:
    """Share of each row in percent of the column total; 0 when the total is 0.

    For small tables (reasons, languages): the window has no partition key.
    """
    total = F.sum(count_col).over(Window.partitionBy())
    return df.withColumn(out, F.when(total > 0, F.col(count_col) / total * 100).otherwise(F.lit(0.0)))


NARROW = 4096  # buckets per round and open range


def exact_quantiles(df: DataFrame, col: str, qs: list[float], offset_zeros: int = 0) -> dict[float, float | None]:
    """Exact quantiles with linear interpolation (numpy/DuckDB ``quantile_cont``).

    Selection without sorting.  The values become a (value, count) table, summed
    map-side, so a value that most rows share is one row per task.  Each round
    cuts the ranges that hold a wanted position into ``NARROW`` buckets, counts
    them, and goes on with the wanted buckets' own least and greatest values,
    until a bucket is a single value.  A round brings ``NARROW`` small rows per
    open range to the driver (two ranges per quantile at most), and separates at
    least the ends of a range, so it ends for any values.

    Nulls, NaN and infinite values take no part.  ``offset_zeros`` counts extra
    zeros that sort before every value (all values must be >= 0 then), without
    materialising them.
    """
    x = F.col("x")
    table = (
        df.select(F.col(col).cast("double").alias("x"))
        .where(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        .groupBy("x").agg(F.count(F.lit(1)).alias("n")).persist()
    )
    try:
        r = table.agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.sum("n").alias("n")).first()
        n = (r["n"] or 0) + offset_zeros
        if n == 0:
            return {q: None for q in qs}
        need: dict[float, tuple[int, int, float]] = {}
        for q in qs:
            h = (n - 1) * q
            lo = int(h // 1)
            need[q] = (lo, min(lo + 1, n - 1), h - lo)
        wanted = {p - offset_zeros for lo, hi, _ in need.values() for p in (lo, hi) if p >= offset_zeros}
        got = _select(table, float(r["lo"]), float(r["hi"]), wanted) if wanted else {}
    finally:
        table.unpersist()
    at = lambda p: 0.0 if p < offset_zeros else got[p - offset_zeros]
    return {q: at(lo) + frac * (at(hi) - at(lo)) for q, (lo, hi, frac) in need.items()}


def _select(table: DataFrame, lo: float, hi: float, wanted: set[int]) -> dict[int, float]:
    """Values at 0-based positions of the (x, n) table, by narrowing ranges."""
    got: dict[int, float] = {}
    open_ranges = [(lo, hi, 0, wanted)]  # least value, greatest value, values below, positions
    while open_ranges:
        got.update((p, lo) for lo, hi, _, ps in open_ranges if lo == hi for p in ps)
        open_ranges = [r for r in open_ranges if r[0] < r[1]]
        if not open_ranges:
            break
        bucket = F.lit(None).cast("int")
        for k, (lo, hi, _, _) in enumerate(open_ranges):
            cut = F.lit(k * NARROW) + equal_width_bin(F.col("x"), lo, hi, NARROW)
            bucket = F.when(F.col("x").between(lo, hi), cut).otherwise(bucket)
        counts = (
            table.select("x", "n", bucket.alias("b")).where(F.col("b").isNotNull())
            .groupBy("b").agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.sum("n").alias("n"))
        )
        rows = sorted(counts.collect(), key=lambda r: r["b"])
        narrower = []
        for k, (_, _, below, positions) in enumerate(open_ranges):
            for r in rows:
                if r["b"] // NARROW == k:
                    inside = {p for p in positions if below <= p < below + r["n"]}
                    if inside:
                        narrower.append((r["lo"], r["hi"], below, inside))
                    below += r["n"]
        open_ranges = narrower
    return got


def describe(df: DataFrame, col: str) -> dict[str, float | None]:
    """mean, median, min, max, population std and count of ``col``."""
    x = F.col(col).cast("double")
    r = df.agg(
        F.avg(x).alias("mean"), F.min(x).alias("min"), F.max(x).alias("max"),
        F.stddev_pop(x).alias("std"), F.count(x).alias("count"),
    ).first()
    out = r.asDict()
    out["median"] = exact_quantiles(df, col, [0.5])[0.5]
    return out
