"""Outputs under names of their own, visible all at once.

Spark's writers choose their file names (``part-00000-<uuid>.json``), and a consumer
of ``*.jsonl`` does not find them.  ``committed`` lets a job write to a hidden
folder beside the target, gives its data files their final names there, and then
puts the folder in place with one rename.  A failed job or a killed task leaves
the target as it was; the hidden folder is removed.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def _part(path: str) -> tuple[str, int]:
    """Folder and part number: the order in which a sorted write lays out its files."""
    folder, _, name = path.rpartition("/")
    m = re.match(r"part-(\d+)", name)
    return folder, int(m[1]) if m else -1


@contextmanager
def committed(spark: SparkSession, path: str, name: Callable[[int, int, str], str],
              finish: Callable[[SparkSession, str], None] | None = None) -> Iterator[str]:
    """Yields a folder for a Spark writer; ``path`` then holds its files, and nothing else.

    ``name(k, n, file)`` names the k-th of n data files.  File names and renames
    are the driver's, as in Spark's own commit; no data passes through it.  ``finish`` is
    called with the named files' folder before it is put in place.
    """
    jvm = spark.sparkContext._jvm
    Path = jvm.org.apache.hadoop.fs.Path
    target = Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    target = fs.makeQualified(target)
    hidden = f"_{target.getName()}-{uuid.uuid4().hex}"
    raw, ready, old = (Path(target.getParent(), f"{hidden}-{x}") for x in ("raw", "ready", "old"))

    def move(a, b) -> None:
        if not fs.rename(a, b):
            raise OSError(f"cannot rename {a} to {b}")

    try:
        yield raw.toString()
        fs.mkdirs(ready)
        found, listing = [], fs.listFiles(raw, True)
        while listing.hasNext():
            f = listing.next().getPath()
            if not f.getName().startswith(("_", ".")):
                found.append(f.toString())
        found.sort(key=_part)
        for k, f in enumerate(found):
            move(Path(f), Path(ready, name(k, len(found), f)))
        if finish:
            finish(spark, ready.toString())
        if fs.exists(target):
            move(target, old)
        move(ready, target)
    finally:
        for p in (raw, ready, old):
            if fs.exists(p):
                fs.delete(p, True)
