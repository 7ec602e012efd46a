"""What a job needs from its session: tuned settings, a shared scratch folder, lineage cuts, checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: largest dimension, in elements (edges, cells, ...), that is shipped to every executor
BROADCAST_ELEMENTS = 2_000_000


def session(app: str = "fathomline", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with adaptive execution and skew handling on. Shuffle partitions default to Spark's own setting."""
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.parquet.compression.codec", "zstd")
    )
    if master:
        b = b.master(master).config("spark.ui.enabled", "false").config("spark.driver.memory", "12g")
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. Only a local session that names none gets one of its own."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if path:
        return path
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    path = tempfile.mkdtemp(prefix="fathomline-")
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, for tables a job writes and reads back."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    A lost executor then re-reads files instead of recomputing the history; readers get column pruning, filters in the
    scan, and a known size for choosing joins. The tables stay until the folder is cleared.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: files of different folders that a writing task keeps open; rows of any further folder are sorted first
OPEN_FILES = 128


@contextmanager
def lean_writes(spark: SparkSession) -> Iterator[None]:
    """Tables written within need little disk besides themselves: a task keeps a file open per folder instead of sorting, and
    spilling, its rows, and a write's shuffle files go with the write instead of when the driver collects its garbage."""
    wanted = {"spark.sql.maxConcurrentOutputFileWriters": str(OPEN_FILES), "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
    before = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let Python workers of executors import this package: its sources are sent once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="fathomline-core-")) / "fathomline_core.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)


def replace_folder(spark: SparkSession, new: str, path: str) -> None:
    """Put the folder ``new`` in the place of ``path``. The old folder is moved aside first and deleted last."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target, source = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(new)
    fs = target.getFileSystem(conf)
    aside = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}.old-{uuid.uuid4().hex[:8]}")
    had = fs.exists(target)
    if had and not fs.rename(target, aside):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(source, target):
        raise OSError(f"cannot put {new} in the place of {path}")
    if had:
        fs.delete(aside, True)


def elements(df: DataFrame, weight: Column | None = None) -> int:
    """Rows of a dimension table, or the sum of a per-row weight such as an array's length."""
    total = df.agg(F.sum(weight if weight is not None else F.lit(1))).first()[0]
    return int(total or 0)
