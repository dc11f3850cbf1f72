"""URL rules by a sort-merge range join (DataFrame functions only).

A host is written with its labels reversed, each followed by a dot:
``www.example.com`` is ``com.example.www.``.  A rule on a host fits that host
and its subdomains, so its key is a prefix of theirs, and the prefix is an
interval ``[key, end)`` of the sorted keys.  Intervals of two rules are nested
or apart.

1. The distinct hosts (combined in the tasks that read the pages, so a host
   with a third of all pages is one row per task) are range-partitioned on
   their key by sampled splitters.
2. Every rule interval is sent to the partitions it overlaps.
3. In each partition a sweep over the sorted interval starts, interval ends and
   hosts keeps the stack of active rules: the running sum of starts and ends is
   the depth, and the last start seen at each depth up to the current one is
   the stack.  A host's row gets that stack.
4. Pages meet their host's stack in a sort-merge join on the host, which
   adaptive execution splits where a host is hot; the longest rule of the stack
   whose path begins the page's path decides.

The stack is as deep as rules are nested: at most the labels of a host.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize, rows_frame
from . import shared

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased; null or none: empty."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; null or no ``://``: empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://[^/?#]*([^?#]*)", 1)


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, "\\.")), "."), F.lit("."))


def rules_frame(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """(host, path, verdict, rule) from (verdict, host, path); of repeated rules ``block`` holds."""
    rows = {}
    for verdict, host, path in rules:
        if verdict not in ("allow", "block"):
            raise ValueError(f"verdict {verdict!r}")
        host = host.translate(str.maketrans(UPPER, LOWER))
        if rows.get((host, path)) != "block":
            rows[host, path] = verdict
    return rows_frame(spark, [(h, p, v, f"{h}{p}") for (h, p), v in rows.items()],
                      "host string, path string, verdict string, rule string")


def stacks(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, stack): the rules whose host fits, for every host that has any.

    ``hosts`` is (host), distinct; ``rules`` is (host, path, verdict, rule).
    """
    spark = hosts.sparkSession
    of_host = rules.groupBy("host").agg(
        F.collect_list(F.struct(F.length("host").alias("h"), F.length("path").alias("p"), "path", "rule", "verdict")).alias("rules"))
    spans = of_host.select(host_key(F.col("host")).alias("key"), "rules")
    # '/' follows '.': the smallest key behind every key that begins with this one
    spans = spans.withColumn("end", F.concat(F.expr("left(key, length(key) - 1)"), F.lit("/")))
    deepest = spans.select(F.max(F.size(F.split("key", "\\.")))).first()[0] or 0
    spans = materialize(spans)

    placed = materialize(
        hosts.withColumn("key", host_key(F.col("host")))
        .repartitionByRange(shared.partitions(spark), "key").withColumn("part", F.spark_partition_id()))
    reach = placed.groupBy("part").agg(F.min("key").alias("low"), F.max("key").alias("high"))
    # one row per partition and rule it overlaps; a partition table this small needs no key
    here = spans.join(F.broadcast(reach), (F.col("key") <= F.col("high")) & (F.col("end") > F.col("low")))

    none = F.lit(None)
    rule_type = spans.schema["rules"].dataType
    events = (
        here.select("part", F.col("key").alias("at"), F.lit(1).alias("kind"), F.lit(1).alias("step"), none.cast("string").alias("host"), "rules")
        .unionByName(here.select("part", F.col("end").alias("at"), F.lit(0).alias("kind"), F.lit(-1).alias("step"),
                                 none.cast("string").alias("host"), none.cast(rule_type).alias("rules")))
        .unionByName(placed.select("part", F.col("key").alias("at"), F.lit(2).alias("kind"), F.lit(0).alias("step"),
                                   "host", none.cast(rule_type).alias("rules"))))
    # at one place intervals end, then begin, then hosts are met
    sweep = (Window.partitionBy("part").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    events = events.withColumn("depth", F.sum("step").over(sweep))
    tops = [F.last(F.when((F.col("kind") == 1) & (F.col("depth") == d), F.col("rules")), ignorenulls=True).over(sweep)
            for d in range(1, deepest + 1)]
    stack = [F.when(F.col("depth") >= d, t) for d, t in enumerate(tops, 1)]
    stack = F.flatten(F.filter(F.array(*stack), lambda x: x.isNotNull())) if stack else F.array().cast(rule_type)
    return events.withColumn("stack", stack).where((F.col("kind") == 2) & (F.size("stack") > 0)).select("host", "stack")


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, url_col: str = "url",
          default: str = "allow") -> DataFrame:
    """Every row of ``pages`` with ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules``: (verdict, host, path).  The longest rule that fits wins: the
    longest host, then the longest path.  Pages that no rule fits have a null
    rule and the ``default`` verdict.  Null URLs and those without ``://`` have
    an empty host and path.  Existing columns of those names are replaced;
    repeated rows are judged alike; an empty table or no rules are fine.
    """
    shared.require(pages, url_col)
    out = ("host", "path", "rule", "verdict")
    pages = pages.drop(*[c for c in pages.columns if c.lower() in out and c != url_col])
    names = [*pages.columns, *out]
    h, p, found, stack, key = (shared.fresh(x, names) for x in ("h", "p", "found", "stack", "key"))
    rows = pages.withColumn(h, host_of(F.col(url_col))).withColumn(p, path_of(F.col(url_col)))
    known = stacks(rows.select(F.col(h).alias("host")).distinct(), rules_frame(pages.sparkSession, rules))
    rows = rows.join(known.select(F.col("host").alias(key), F.col("stack").alias(stack)), F.col(h) == F.col(key), "left")
    fits = F.filter(F.col(stack), lambda r: F.col(p).startswith(r["path"]))
    rows = rows.withColumn(found, F.array_max(F.transform(
        fits, lambda r: F.struct(r["h"].alias("h"), r["p"].alias("p"), r["rule"].alias("rule"), r["verdict"].alias("verdict")))))
    return rows.select(
        *[F.col(c) for c in pages.columns if c.lower() not in out], F.col(h).alias("host"), F.col(p).alias("path"),
        F.col(found)["rule"].alias("rule"), F.coalesce(F.col(found)["verdict"], F.lit(default)).alias("verdict"))
