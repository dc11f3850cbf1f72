"""JSON-lines sources and sinks.

Lines are read with the splittable text source and parsed with
``try_parse_json`` (VARIANT), so a bad line never fails the job.  Input order
(file name, then line) is rebuilt without sorting the data: lines of one
file split are contiguous in one task, so each split's first row id and line
count (one small row per split) give every line its global position.  The
counts are summed on two levels, splits inside a file and files in ranges of
their names.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..functions.text import is_blank
from ..operators.rank import prefix_sum
from ..session import broadcast_if_small, materialize
from . import manifest
from .commit import committed

GLOB = "*.jsonl"


def read_lines(spark: SparkSession, path: str, glob: str = GLOB) -> DataFrame:
    """(ord, value): every line of the matching files, ``ord`` = file-name then line order.

    Raises ``FileNotFoundError`` when no file matches (S1).
    """
    reader = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", "false")
    try:
        found = not reader.format("binaryFile").load(path).select("path").isEmpty()  # names only, no content
        raw = reader.format("text").load(path)
        tagged = raw.select(
            "value",
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_mono"),
        )
    except AnalysisException as e:  # path missing or nothing matched
        raise FileNotFoundError(f"no {glob} files under {path}") from e
    if not found:
        raise FileNotFoundError(f"no {glob} files under {path}")
    splits = tagged.groupBy("_file", "_block").agg(
        F.min("_mono").alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    splits = materialize(splits)
    files = prefix_sum(splits.groupBy("_file").agg(F.sum("_n").alias("_all")), ["_file"], "_all", "_before")
    inside = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        splits.withColumn("_run", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
        .join(files.select("_file", "_before"), "_file")
        .select("_file", "_block", "_first", (F.col("_before") + F.col("_run")).alias("_off"))
    )
    offsets, _ = broadcast_if_small(offsets)
    return tagged.join(offsets, ["_file", "_block"]).select(
        (F.col("_off") + F.col("_mono") - F.col("_first")).alias("ord"), "value"
    )


def parse_records(lines: DataFrame) -> DataFrame:
    """(ord, text, blank, malformed) from raw lines.

    * blank line (only whitespace): ``blank``;
    * not JSON, JSON that is not an object, or an object whose ``text`` is not
      a string (null, number, list): ``malformed``;
    * object without ``text``: text '' (then ``empty`` downstream).
    """
    v = F.try_parse_json(F.col("value"))
    kind = F.schema_of_variant(v)
    sub = F.schema_of_variant(F.try_variant_get(v, "$.text", "variant"))
    blank = is_blank(F.col("value"))
    is_obj = kind.startswith("OBJECT")
    ok = is_obj & (sub.isNull() | (sub == "STRING"))
    return lines.select(
        "ord",
        F.when(ok, F.coalesce(F.try_variant_get(v, "$.text", "string"), F.lit(""))).alias("text"),
        blank.alias("blank"),
        (~blank & ~F.coalesce(ok, F.lit(False))).alias("malformed"),
    )


def read_records(spark: SparkSession, path: str, glob: str = GLOB) -> DataFrame:
    """Tolerant record scan: (ord, text, blank, malformed).

    Few large files (splits for less than half the cores) are spread by ``ord`` once
    the line order is fixed, so the text work is not done by a handful of tasks.  With
    more, to deal out and write all lines again would cost more than it saves.
    """
    from .tables import spread

    return parse_records(spread(read_lines(spark, path, glob), "ord", spark.sparkContext.defaultParallelism // 2))


def line_counters(records: DataFrame, limit: int | None = None) -> DataFrame:
    """Report scan counters (S4, A3): total, empty, json_errors, valid.

    Blank lines count as JSON errors here, as in the reference's report, and
    ``empty`` is a record whose stripped text is ''.  ``limit`` keeps the first
    N lines (L3).
    """
    r = records if limit is None else records.where(F.col("ord") < F.lit(limit))
    err = F.col("blank") | F.col("malformed")
    empty = ~err & is_blank(F.col("text"))
    return r.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(empty).alias("empty"),
        F.count_if(err).alias("json_errors"),
        F.count_if(~err & ~empty).alias("valid"),
    )


def token_list(value: Column) -> tuple[Column, Column]:
    """(JSON value, token list) of a shard line: ``{"tokens": [...]}`` or a bare ``[...]``."""
    v = F.try_parse_json(value)
    return v, F.coalesce(F.try_variant_get(v, "$.tokens", "array<int>"), F.try_variant_get(v, "$", "array<int>"))


def read_token_records(spark: SparkSession, path: str, glob: str = "*.json*") -> DataFrame:
    """Shard lines: ``{"tokens": [...]}`` or a bare ``[...]``.

    (ord, tokens, shape): shape is ``object``, ``list``, ``other`` (valid JSON of
    another shape: counted, no tokens) or ``bad`` (not JSON: skipped).
    """
    lines = read_lines(spark, path, glob)
    v = F.try_parse_json(F.col("value"))
    obj = F.try_variant_get(v, "$.tokens", "array<int>")
    bare = F.try_variant_get(v, "$", "array<int>")
    return lines.select(
        "ord",
        F.coalesce(obj, bare).alias("tokens"),
        F.when(v.isNull(), F.lit("bad")).when(obj.isNotNull(), F.lit("object"))
        .when(bare.isNotNull(), F.lit("list")).otherwise(F.lit("other")).alias("shape"),
    )


def _ordered_parts(df: DataFrame, keys: list[str]) -> DataFrame:
    """Range partitions in key order, each sorted: part files concatenate in order.

    The partition count is explicit, so the writers stay parallel (adaptive
    execution keeps a requested count instead of coalescing small outputs).
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)


def _numbered(stem: str):
    """Part names whose order as text is their order as numbers."""
    return lambda k, n, _: f"{stem}_{k:0{max(5, len(str(n - 1)))}d}.jsonl"


def write_text_jsonl(df: DataFrame, path: str, order_col: str = "ord") -> None:
    """Cleaned texts as ``{"text": ...}`` lines in ``order_col`` order (S8): ``part_NNNNN.jsonl``, which
    ``read_records`` reads in that order.  Replaces ``path`` when all is written."""
    with committed(df.sparkSession, path, _numbered("part"), manifest.write) as raw:
        _ordered_parts(df, [order_col]).select("text").write.json(raw)


def write_shards(df: DataFrame, path: str) -> dict:
    """``{"tokens": [...]}`` lines, one file ``shard_NNNN.jsonl`` per ``shard_id``, in position order.

    Each shard (at most ``shard_size`` rows) is written by one task; ``path`` is
    replaced when all is written.  Returns the ``records`` and ``tokens`` written,
    observed by the writing tasks (a null list counts as no tokens).
    """
    def name(_k: int, _n: int, file: str) -> str:
        return f"shard_{int(re.search(r'shard_id=([0-9]+)/', file)[1]):04d}.jsonl"

    seen = Observation()
    with committed(df.sparkSession, path, name, manifest.write) as raw:
        (
            df.repartition("shard_id").sortWithinPartitions("shard_id", "pos")
            .select("shard_id", "tokens")
            .observe(seen, F.count(F.lit(1)).alias("records"), F.coalesce(F.sum(F.greatest(F.size("tokens"), F.lit(0))), F.lit(0)).alias("tokens"))
            .write.option("maxRecordsPerFile", 0).partitionBy("shard_id").json(raw)
        )
    return seen.get


def shard_lines(spark: SparkSession, path: str) -> DataFrame:
    """(shard_id, value, _block, _m): lines of written shards; ordered by all but ``value`` they
    follow the shards' numbers (not their names: ``shard_10000`` comes after ``shard_9999``) (L6)."""
    return spark.read.option("pathGlobFilter", "shard_*.jsonl").text(path).select(
        F.regexp_extract(F.col("_metadata.file_name"), r"shard_(\d+)", 1).cast("int").alias("shard_id"), "value",
        F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_m"))


def read_shards(spark: SparkSession, path: str, verify: bool = False) -> DataFrame:
    """Written shards back: (shard_id, tokens) (S9, L6).  ``verify``: hold all lines against the manifest first."""
    if verify:
        manifest.check(spark, path)
    return shard_lines(spark, path).select(token_list(F.col("value"))[1].alias("tokens"), "shard_id")


def combine_shards(spark: SparkSession, shards_path: str, out_path: str) -> None:
    """All shard records into one dataset, shard by shard.

    Stale shards of earlier runs are never picked up; the output is a folder of
    ordered part files, replaced when all is written.
    """
    df = shard_lines(spark, shards_path)
    with committed(spark, out_path, _numbered("part"), manifest.write) as raw:
        ordered = _ordered_parts(df, ["shard_id", "_block", "_m"])
        ordered.select(token_list(F.col("value"))[1].alias("tokens")).write.json(raw)


def check_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Read-back check over all lines (S13): (lines, unparsable)."""
    t = spark.read.text(path)
    return t.agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(F.try_parse_json(F.col("value")).isNull()).alias("unparsable"),
    )


def head(spark: SparkSession, path: str, n: int = 3) -> DataFrame:
    """First lines of an output (L7 preview)."""
    return spark.read.text(path).limit(n)
