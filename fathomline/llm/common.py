"""What the corpus operators share: shipping the package, free column names, word rules, running sums, scratch tables."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import cut_lineage, shared_dir

# What separates words, as a Java character class and as the words' own pattern.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let executors import this package: it is sent once per application as a zip file of its sources."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="fathomline-py-")) / "fathomline_src.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` does not have, whatever it carries; names compare without case, as Spark does."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out


def words_in(text: Column) -> Column:
    """Number of words of a text; 0 for none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def remove(spark: SparkSession, *frames_or_paths: DataFrame | str) -> None:
    """Delete scratch tables below the shared folder that nothing reads any more."""
    base = shared_dir(spark).rstrip("/").split(":", 1)[-1].lstrip("/")
    jvm = spark._jvm
    for item in frames_or_paths:
        paths = [item] if isinstance(item, str) else [f.rsplit("/", 1)[0] for f in item.inputFiles()[:1]]
        for p in paths:
            if base not in p:
                continue
            path = jvm.org.apache.hadoop.fs.Path(p)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def arrow_schema(**fields: pa.DataType) -> pa.Schema:
    return pa.schema([pa.field(k, v) for k, v in fields.items()])


def running_sum(df: DataFrame, order: list[str], value: str, out: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` over all rows before this one in the order of the columns ``order``.

    Rows are dealt by range of the order columns and summed partition by partition; the partitions' totals, one row
    each, are summed in turn. A key with any share of the rows spreads over as many partitions as it fills. Order columns
    may be null (first). Rows that tie in all of them get their sums in no fixed order. The result is a written table.
    """
    part, = fresh(df, "_part")
    spark = df.sparkSession
    dealt = df.repartitionByRange(*[F.col(c).asc_nulls_first() for c in order])
    dealt = dealt.sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in order])
    dealt = dealt.withColumn(part, F.spark_partition_id()).withColumn(out, F.lit(0).cast("bigint"))

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for b in batches:
            v = b.column(b.schema.get_field_index(value)).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(v) + total
            i = b.schema.get_field_index(out)
            total = int(ends[-1]) if len(ends) else total
            yield b.set_column(i, b.schema.field(i), pa.array(ends - v, pa.int64()))

    summed = cut_lineage(dealt.mapInArrow(add, dealt.schema), "running")
    totals = summed.groupBy(part).agg(F.sum(value).alias("_t")).collect()  # one row per partition
    base, before = 0, []
    for r in sorted(totals, key=lambda r: r[part]):
        before.append((r[part], base))
        base += int(r["_t"] or 0)
    bases = spark.createDataFrame(before or [(0, 0)], f"{part} int, _base bigint")
    joined = summed.join(F.broadcast(bases), part)
    return joined.withColumn(out, F.col(out) + F.col("_base")).drop(part, "_base")
