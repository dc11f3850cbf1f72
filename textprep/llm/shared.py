"""Small helpers of the subpackage: written tables, column names, partition counts, batches of bounded size."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession

from ..session import ensure_checkpoint_dir


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder under the session's checkpoint folder, which every executor reaches."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: lineage ends
    there, so a lost executor costs only the tasks it was running."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(name: str, taken: Iterable[str]) -> str:
    """``name``, with underscores in front until no column of ``taken`` has it
    (column names compare without case)."""
    names = {t.lower() for t in taken}
    while name.lower() in names:
        name = f"_{name}"
    return name


def positional(df: DataFrame, *columns: Column) -> DataFrame:
    """The columns under names by position: Python workers cannot be handed names with dots."""
    return df.select(*[c.alias(f"c{i}") for i, c in enumerate(columns)])


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def require(df: DataFrame, *cols: str) -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; there are {df.columns}")


def in_bytes(batches: Iterable[pa.RecordBatch], column: int, limit: int = 4 << 20, rows: int = 4_096) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``rows`` rows and about ``limit`` bytes of the text in ``column``
    (a longer text is a slice of its own)."""
    for b in batches:
        sizes = pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False)
        at, held = 0, 0
        for i, n in enumerate(sizes.tolist()):
            if i > at and (held + n > limit or i - at >= rows):
                yield b.slice(at, i - at)
                at, held = i, 0
            held += n
        if at < b.num_rows:
            yield b.slice(at)
