"""Global positions without a single-task window (S5, L1, L2, L4, vocabulary ids).

``row_number()`` over an un-partitioned window pulls every row into one task.
Instead the rows are range-sorted (a distributed sort), checkpointed so the
partition layout is fixed, counted per partition, and each row gets
``offset(partition) + index within partition``.  The only table that meets
in one place is the per-partition count, bounded by the number of
partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def global_rank(df: DataFrame, order: list[Column | str], out: str = "pos") -> DataFrame:
    """Add a 0-based dense position ``out`` following ``order`` (keys must be unique).

    The range sort samples ``df`` in a pass of its own: pass a checkpoint or a
    cheap plan, not one that repeats expensive work.
    """
    ordered = materialize(df.orderBy(*order))
    tagged = ordered.select(
        "*",
        F.spark_partition_id().alias("_part"),
        F.monotonically_increasing_id().alias("_mono"),
    )
    local = F.col("_mono") - F.shiftleft(F.col("_part").cast("long"), 33)
    counts = tagged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    return (
        tagged.join(F.broadcast(offsets), "_part")
        .withColumn(out, F.col("_off") + local)
        .drop("_part", "_mono", "_off")
    )


def prefix_sum(df: DataFrame, order: list[str], value: str, out: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` over all rows before this one in ``order`` (keys must be unique).

    Two levels: a running sum inside each range partition, and the partitions'
    totals in front of it.  Only the totals, one row per partition, meet in one place.
    """
    ordered = materialize(df.orderBy(*order)).withColumn("_part", F.spark_partition_id())
    totals = ordered.groupBy("_part").agg(F.sum(value).alias("_t"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_part", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        ordered.withColumn("_run", F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .join(F.broadcast(offsets), "_part")
        .withColumn(out, F.col("_off") + F.col("_run"))
        .drop("_part", "_run", "_off")
    )


MAX_BUCKETS = 1 << 16


def bucketed_rank(df: DataFrame, bucket: Column, order: list[Column | str], out: str = "pos",
                  skew_factor: float = 4.0) -> DataFrame:
    """Dense 0-based position by ``order`` using a bucket monotone in that order.

    Two levels: rows per bucket are counted (a table of at most
    ``MAX_BUCKETS`` rows; only its size and largest count reach the driver),
    offsets follow from the bucket order, and ``row_number()`` runs within
    each bucket.  Deterministic, so no
    checkpoint is needed.  When some bucket holds more than ``skew_factor``
    times the average (a hot key range), the sort-based ``global_rank`` is
    used instead, so no task gets an outsized bucket.
    """
    b = df.withColumn("_b", bucket)
    counts = b.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    st = counts.agg(F.count(F.lit(1)).alias("k"), F.max("_n").alias("mx"), F.sum("_n").alias("tot")).first()
    if not st["k"]:
        return df.withColumn(out, F.lit(None).cast("long")).limit(0)
    if st["k"] > MAX_BUCKETS or st["mx"] > skew_factor * st["tot"] / st["k"] + 10_000:
        return global_rank(df, order, out)
    # offsets from the small counts table, all JVM-side (at most MAX_BUCKETS rows)
    w_off = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select("_b", F.coalesce(F.sum("_n").over(w_off), F.lit(0)).alias("_off"))
    w = Window.partitionBy("_b").orderBy(*order)
    return (
        b.join(F.broadcast(offs), "_b")
        .withColumn(out, F.col("_off") + F.row_number().over(w) - 1)
        .drop("_b", "_off")
    )


def ordinal_rank(df: DataFrame, col: str, out: str = "pos", buckets: int | None = None) -> DataFrame:
    """Dense rank of a unique integer column, bucketed by value range."""
    r = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    if r is None or r["lo"] is None:
        return df.withColumn(out, F.lit(None).cast("long")).limit(0)
    n = buckets or 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    width = max(1, -(-(int(r["hi"]) - int(r["lo"]) + 1) // n))
    bucket = F.floor((F.col(col) - F.lit(int(r["lo"]))) / F.lit(width)).cast("long")
    return bucketed_rank(df, bucket, [F.col(col)], out)


def shuffle_key(id_col: Column | str, seed: int = 42) -> Column:
    """Seeded pseudo-random order key (L1); independent of partitioning."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.md5(F.concat(F.lit(f"{seed}:"), c.cast("string")))


def seeded_shuffle(df: DataFrame, id_col: str = "ord", seed: int = 42, out: str = "pos") -> DataFrame:
    """Reproducible global shuffle: position by ``md5(seed:id)``, ties by id (L1).

    md5 is uniform, so its first three hex digits make 4096 even buckets in
    key order for the two-level rank.
    """
    keyed = df.withColumn("_skey", shuffle_key(id_col, seed))
    bucket = F.conv(F.substring(F.col("_skey"), 1, 3), 16, 10).cast("int")
    return bucketed_rank(keyed, bucket, [F.col("_skey"), F.col(id_col)], out).drop("_skey")


def assign_shards(df: DataFrame, shard_size: int, pos_col: str = "pos") -> DataFrame:
    """Consecutive shards of ``shard_size`` positions; last one short (L2)."""
    return df.withColumn("shard_id", F.floor(F.col(pos_col) / F.lit(shard_size)).cast("int"))


def first_n(df: DataFrame, n: int | None, pos_col: str = "pos") -> DataFrame:
    """Sample of the first ``n`` positions (L3, L4); ``None`` keeps all rows."""
    return df if n is None else df.where(F.col(pos_col) < F.lit(n))
