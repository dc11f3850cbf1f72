"""Manifests of written folders: rows and a checksum per file, held against what is read later.

The checksum is the sum of the lines' first 60 md5 bits: it does not depend on the
order of lines, and a line that is changed, lost or doubled changes it.  A folder's
manifest lies in its ``.manifest``, which Spark's readers and ``*.jsonl`` consumers
pass over, and appears with the folder's files in one commit.  Files without
lines are not listed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

FOLDER = ".manifest"
SCHEMA = "file string, n long, checksum string"


def describe(spark: SparkSession, path: str, glob: str = "*.jsonl") -> DataFrame:
    """(file, n, checksum) of the files under ``path``, from their lines; summed where they are read."""
    lines = spark.read.option("pathGlobFilter", glob).text(path)
    bits = F.conv(F.substring(F.md5(F.col("value").cast("binary")), 1, 15), 16, 10).cast("decimal(20,0)")
    return lines.groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(bits).cast("string").alias("checksum"))


def write(spark: SparkSession, path: str, glob: str = "*.jsonl") -> None:
    """The manifest of ``path``, from a pass over its files: one small row per file."""
    describe(spark, path, glob).coalesce(1).write.mode("overwrite").json(f"{path}/{FOLDER}")


def read(spark: SparkSession, path: str) -> DataFrame:
    """(file, n, checksum) as written; ``FileNotFoundError`` where there is no manifest."""
    try:
        return spark.read.schema(SCHEMA).json(f"{path}/{FOLDER}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"no manifest under {path}") from e


def problems(spark: SparkSession, path: str, glob: str = "*.jsonl") -> DataFrame:
    """(file, problem, n, n_expected): files that are ``lost`` (or have no lines), ``extra``, or ``changed``
    in any line; no rows if all is as written."""
    want = read(spark, path).select("file", F.col("n").alias("n_expected"), F.col("checksum").alias("_sum"))
    both = describe(spark, path, glob).join(want, "file", "full")
    problem = (F.when(F.col("n").isNull(), "lost").when(F.col("n_expected").isNull(), "extra")
               .when((F.col("n") != F.col("n_expected")) | (F.col("checksum") != F.col("_sum")), "changed"))
    return both.select("file", problem.alias("problem"), "n", "n_expected").where(F.col("problem").isNotNull())


def check(spark: SparkSession, path: str, glob: str = "*.jsonl") -> None:
    """Raises ``ValueError`` that counts the files with problems and names the first twenty."""
    found = problems(spark, path, glob)
    some = found.orderBy("file").limit(20).collect()
    if some:
        names = ", ".join(f"{r['file']} {r['problem']}" for r in some)
        raise ValueError(f"{found.count()} files under {path} are not as written: {names}")
