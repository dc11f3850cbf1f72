"""First copies over deliveries: a stored table of the text keys met before.

A run's exact dedup ends with the run.  ``KeyIndex`` keeps the 32-byte key of every
first copy in a Parquet folder partitioned by delivery and key bucket, so a later
delivery drops what an earlier one kept and the runs together keep what one run over
all of them would.  A delivery is compared only with deliveries of a lower number and
replaces its own keys, so one that is run again, after a failure or by a restarted
stream, decides as it did the first time.

Only keys and row numbers of first copies are joined: one row per distinct key on both
sides, so no key is hot.  Buckets the delivery has no key in are pruned before the scan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..session import materialize

SCHEMA = "key binary, delivery long, bucket int"


@dataclass(frozen=True)
class KeyIndex:
    """Keys under ``path``, in a folder all executors reach; ``buckets`` (at most 65,536) is fixed for its lifetime."""

    path: str
    buckets: int = 256

    def __post_init__(self) -> None:
        if not 1 <= self.buckets <= 1 << 16:
            raise ValueError("buckets must be 1 to 65,536")

    def bucket(self, key: Column) -> Column:
        return (F.conv(F.hex(F.substring(key, 1, 2)), 16, 10).cast("int") % self.buckets).cast("int")

    def keys(self, spark: SparkSession) -> DataFrame:
        """(key, delivery, bucket): all stored keys, each once; none where nothing was stored yet."""
        try:
            return spark.read.schema(SCHEMA).parquet(self.path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], SCHEMA)

    def earlier(self, spark: SparkSession, delivery: int, buckets: list[int]) -> DataFrame:
        """Keys of the deliveries before ``delivery``, of the given buckets only."""
        return self.keys(spark).where((F.col("delivery") < delivery) & F.col("bucket").isin(buckets))

    def first_ever(self, df: DataFrame, delivery: int, key_col: str = "key", ord_col: str = "ord",
                   first_col: str = "is_first") -> DataFrame:
        """``df`` with ``first_col`` false where an earlier delivery has the key, and the new keys stored.

        ``df`` is a delivery after ``dedup.mark_first``: at most one row per key is
        first, ``ord_col`` is unique in it.  Rows whose ``first_col`` is null or false
        stay as they are; an empty delivery stores nothing.  ``df`` is read
        twice: pass a checkpoint or a cheap plan.
        """
        spark = df.sparkSession
        firsts = materialize(df.where(first_col).select(
            F.col(ord_col).alias("ord"), F.col(key_col).alias("key"), self.bucket(F.col(key_col)).alias("bucket")))
        buckets = [r["bucket"] for r in firsts.select("bucket").distinct().collect()]  # at most ``buckets`` numbers
        before = self.earlier(spark, delivery, buckets).select("key", F.lit(True).alias("_old"))
        met = materialize(firsts.join(before, "key", "left"))
        (met.where(F.col("_old").isNull()).select("key", "bucket").repartitionByRange("bucket", "key").sortWithinPartitions("bucket", "key")
         .write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/delivery={int(delivery)}"))
        old = met.where("_old").select(F.col("ord").alias(ord_col), "_old")
        return (df.join(old, ord_col, "left")
                .withColumn(first_col, F.when(F.col("_old"), F.lit(False)).otherwise(F.col(first_col))).drop("_old"))
