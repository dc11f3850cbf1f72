"""Session helpers: local session for tests/bench, checkpoint folder, sized broadcast."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "textprep",
                  event_log_dir: str | None = None) -> SparkSession:
    """Local session with AQE on and the UI off (tests, bench)."""
    b = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if event_log_dir:
        b = b.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log_dir)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Checkpoint folder of the session.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is; without it the job stops.  Only in local mode, when nothing is set
    (tests, bench), a scratch folder is made.
    """
    sc = spark.sparkContext
    cur = sc.getCheckpointDir()
    if cur:
        return cur
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not conf:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        conf = tempfile.mkdtemp(prefix="textprep-ckpt-")  # local mode only (tests, bench)
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: cuts lineage, survives executor loss."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


# Default bound for broadcasting a derived table (rows).  A side is broadcast
# only after its row count was measured under this bound.
BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 128 << 20


def row_bytes(df: DataFrame, *cols: str) -> Column:
    """About how many bytes a row's columns take: strings and binaries by their length, others 16 each."""
    types = dict(df.dtypes)
    sized = [F.coalesce(F.octet_length(c), F.lit(0)) + 16 if types[c] in ("string", "binary")
             else F.coalesce(F.size(c), F.lit(0)) * 16 if types[c].startswith("array") else F.lit(16) for c in cols or df.columns]
    return sum(sized[1:], sized[0]).cast("long")


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, materialized: bool = False,
                       max_bytes: int = BROADCAST_MAX_BYTES) -> tuple[DataFrame, bool]:
    """Materialise ``df`` and broadcast it when its measured size allows.

    Returns the (checkpointed) frame, hinted for broadcast when it holds at
    most ``max_rows`` rows and ``max_bytes`` bytes, and whether it was hinted.  Above
    the bounds the caller's join stays a shuffle join (AQE splits skewed keys).
    ``materialized``: ``df`` is already a checkpoint; only measure it.
    """
    m = df if materialized else materialize(df)
    n, size = m.agg(F.count(F.lit(1)), F.coalesce(F.sum(row_bytes(m)), F.lit(0))).first()
    if n <= max_rows and size <= max_bytes:
        return F.broadcast(m), True
    return m, False


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the checkpoint folder for written intermediates."""
    base = ensure_checkpoint_dir(spark)
    if base.startswith("file:"):
        base = base[len("file:"):]
    path = os.path.join(base, "tables", name)
    return path


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``textprep`` importable in Python workers (once per application).

    The package is zipped and added with ``addPyFile`` (what ``--py-files``
    does), so tasks running numpy code from it work on any executor.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    path = os.path.join(tempfile.mkdtemp(prefix="textprep-pkg-"), "textprep.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    _SHIPPED.add(app)


def rows_frame(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """A small result table built from literals on the JVM side.

    ``createDataFrame`` on a Python list goes through a Python RDD, which
    costs a Python-side job each time the table is read; report rows do not
    need that.
    """
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL(ddl)
    if not rows:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
    structs = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schema.fields)])
        for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs)))
