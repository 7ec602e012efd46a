"""Readers and writers: detection and overpass files, period caches, polygons, published tables."""

from __future__ import annotations

import json
import uuid
from collections import Counter
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from ..config import Params
from ..functions import geo
from ..functions.predicates import in_box
from ..functions.scalars import month_of
from ..runtime import BROADCAST_ELEMENTS, cut_lineage, elements, lean_writes
from ..schema import DETECTIONS, OVERPASSES, conform
from .features import collection_features

Paths = str | Sequence[str]


# -------------------------------------------------------------------------------------------------------------- tables
#: files whose first line is read at a time
HEADERS_AT_ONCE = 16


def first_line(spark: SparkSession, file: str) -> str | None:
    """The first line of a text file that is not blank, through whatever its name says it is compressed with; None without any.

    A plain read of the storage, no job: the rest of the file is not touched.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(file)
    stream = where.getFileSystem(conf).open(where)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(where)
        plain = stream if codec is None else codec.createInputStream(stream)
        lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, "UTF-8"))
        line = lines.readLine()
        while line is not None and not line.strip():
            line = lines.readLine()
        return line
    finally:
        stream.close()


def scan_csv(spark: SparkSession, paths: Paths, schema: T.StructType) -> DataFrame:
    """CSV files with a header, columns taken by name whatever their order, typed as ``schema``.

    Files are read together with those of the same header, because a reader goes by position within what it reads: as many
    scans as there are headers, however many files. A file that lacks a column is an error; one without any line has no rows.
    """
    files = [unquote(f) for f in spark.read.text(paths if isinstance(paths, str) else list(paths)).inputFiles()]
    by_header: dict[str, list[str]] = {}
    with ThreadPoolExecutor(HEADERS_AT_ONCE) as pool:
        for file, header in zip(files, pool.map(lambda f: first_line(spark, f), files)):
            if header is not None:
                by_header.setdefault(header, []).append(file)
    if not by_header:
        return spark.createDataFrame([], schema)
    reader = spark.read.option("header", True)
    return reduce(DataFrame.unionByName, [conform(reader.csv(fs), schema) for fs in by_header.values()])


def scan_detections_csv(spark: SparkSession, paths: Paths) -> DataFrame:
    return scan_csv(spark, paths, DETECTIONS)


def detections_in_bbox(det: DataFrame, p: Params) -> DataFrame:
    """Rows of the study box with their month."""
    return det.where(in_box(F.col("lon"), F.col("lat"), p.bbox)).withColumn("month", month_of(F.col("detect_timestamp")))


def overpasses_of_cells(overpass: DataFrame, cells: DataFrame) -> DataFrame:
    """Rows of the given cells (column ``cell``), month as ``'YYYY-MM'``."""
    wanted = cells.select(F.col("cell").alias("h3_id")).distinct()
    kept = overpass.join(F.broadcast(wanted) if elements(wanted) <= BROADCAST_ELEMENTS else wanted, "h3_id", "left_semi")
    return kept.withColumn("month", month_of(F.col("month")))


def write_by_month(df: DataFrame, path: str, keys: Sequence[str] = ("month",)) -> None:
    """Parquet partitioned by ``keys``; only the partitions in ``df`` are replaced. Rows of a partition are brought together
    first, in as many files as their size asks for."""
    (df.hint("rebalance", *keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
     .partitionBy(*keys).parquet(path))


# A stored table is a folder of versions, ``period=P/version=V/...``, none of which is ever changed, and a manifest that names the
# version of each period that counts. The manifest is one small file that is replaced as a whole, last of all: until then, and after
# a job that died on the way, readers see what was there before.
_MANIFEST = "_manifest.json"


@dataclass(frozen=True)
class Version:
    name: str
    rows: int


def manifest(spark: SparkSession, path: str) -> dict[str, Version]:
    """The version of each period of a stored table; nothing where no period was ever stored. One entry per period."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{_MANIFEST}")
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(where):
        return {}
    stream = fs.open(where)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return {period: Version(**v) for period, v in json.loads(text).items()}


def publish_versions(spark: SparkSession, path: str, versions: Mapping[str, Version]) -> None:
    """Let the given versions count from now on, all at once; other periods stay. One job at a time may store into a table."""
    text = json.dumps({k: asdict(v) for k, v in sorted((manifest(spark, path) | dict(versions)).items())}, indent=1)
    jvm = spark._jvm
    hadoop = jvm.org.apache.hadoop.fs
    target = hadoop.Path(f"{path.rstrip('/')}/{_MANIFEST}")
    beside = hadoop.Path(f"{path.rstrip('/')}/{_MANIFEST}.{uuid.uuid4().hex[:8]}")
    conf = spark._jsc.hadoopConfiguration()
    stream = target.getFileSystem(conf).create(beside, True)
    try:
        stream.write(text.encode())
    finally:
        stream.close()
    rename = getattr(hadoop, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    hadoop.FileContext.getFileContext(target.toUri(), conf).rename(beside, target, options)


def write_version(rows: DataFrame, path: str, period: str, by: Sequence[str] = ("month",), gathered: bool = False) -> Version:
    """Write all rows of one uploaded period beside what is stored of it. Nothing reads them before ``publish_versions``.

    Rows of months outside the period stay with it, ``releases.merge_periods`` leaves them out. Rows of a month are brought together
    by a shuffle, unless they are ``gathered``: few tasks have them all, or each task has rows of few months.
    """
    name = uuid.uuid4().hex[:12]
    folder = f"{path.rstrip('/')}/period={period}/version={name}"
    kept = rows.drop("period")
    writer = (kept.hint("rebalance", *by) if by and not gathered else kept).write.option("compression", "zstd")
    (writer.partitionBy(*by) if by else writer).parquet(folder)
    return Version(name, spark_count(rows.sparkSession, kept.schema, folder))


def spark_count(spark: SparkSession, schema: T.StructType, folder: str) -> int:
    """Rows of a written table, from its files' footers."""
    return spark.read.schema(schema).parquet(folder).count()


def remove_unused(spark: SparkSession, path: str) -> int:
    """Delete the versions that the manifest does not name, and tell how many; for when no reader uses them any more."""
    used = {(p, v.name) for p, v in manifest(spark, path).items()}
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/period=*/version=*")
    fs = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    gone = 0
    for status in fs.globStatus(pattern) or []:
        folder = status.getPath()
        if (folder.getParent().getName().removeprefix("period="), folder.getName().removeprefix("version=")) not in used:
            gone += bool(fs.delete(folder, True))
    return gone


#: periods that are stored side by side
PERIODS_AT_ONCE = 4
#: tasks that read an upload, and so files of a month, and the splits of larger ones that a task reads one after the other
TASKS, SPLITS = 16, 16


def _few_tasks(scan: DataFrame) -> DataFrame:
    """Scanned rows in so few tasks that each may write a file per month, without a shuffle."""
    n = scan.rdd.getNumPartitions()
    return scan.coalesce(max(TASKS, n // SPLITS)) if n > TASKS else scan


def _each_period(spark: SparkSession, uploads: Mapping[str, Paths], out: str, rows_of: Callable[[Paths], DataFrame]) -> dict[str, int]:
    """Store the periods a few at a time, each as a version of its own, and let them count together. Returns their rows.

    Files that several periods were delivered in are read once and kept by month; any others are written as they are scanned.
    """
    key = lambda paths: paths if isinstance(paths, str) else tuple(paths)
    with lean_writes(spark), ThreadPoolExecutor(PERIODS_AT_ONCE) as pool:
        shared = {paths: cut_lineage(rows_of(paths).hint("rebalance", "month"), "shared")
                  for paths, n in Counter(map(key, uploads.values())).items() if n > 1}
        stored = dict(pool.map(lambda item: (item[0], write_version(
            shared[key(item[1])] if key(item[1]) in shared else rows_of(item[1]), out, item[0], gathered=True)), sorted(uploads.items())))
    publish_versions(spark, out, stored)
    return {period: v.rows for period, v in stored.items()}


def ingest_detections(spark: SparkSession, uploads: Mapping[str, Paths], out: str, p: Params) -> dict[str, int]:
    """Store the detection files of each uploaded period, all its files together; filtered while scanning, so the files' global
    rows are never kept. A period replaces all that was stored of it. Returns the rows of each period; see
    ``streaming.incremental.store_detections`` for uploads that are to be noted in the ledger."""
    return _each_period(spark, uploads, out, lambda paths: detections_in_bbox(_few_tasks(scan_detections_csv(spark, paths)), p))


def ingest_overpasses(spark: SparkSession, uploads: Mapping[str, Paths], cells: DataFrame, out: str) -> dict[str, int]:
    return _each_period(spark, uploads, out, lambda paths: overpasses_of_cells(_few_tasks(scan_csv(spark, paths, OVERPASSES)), cells))


def read_stored(spark: SparkSession, path: str, schema: T.StructType, by: Sequence[str] = ("month",),
                versions: Mapping[str, Version] | None = None) -> DataFrame:
    """The versions that count, or those given: the columns of ``schema`` with those of ``by`` and period. A store whose periods are
    all empty, or that does not exist yet, has no rows."""
    named = manifest(spark, path) if versions is None else versions
    keys = [T.StructField(k, T.StringType()) for k in (*by, "period")]
    fields = [f for f in schema.fields if f.name not in (*by, "period")]
    full = T.StructType([*fields, *keys])
    folders = [f"{path.rstrip('/')}/period={p}/version={v.name}" for p, v in sorted(named.items()) if v.rows]
    if not folders:
        return spark.createDataFrame([], full)
    return spark.read.schema(T.StructType([*full.fields, T.StructField("version", T.StringType())])).option("basePath", path).parquet(*folders).drop("version")


def read_partitions(spark: SparkSession, path: str, months: Sequence[str] | None = None) -> DataFrame:
    """A stored table; ``months`` prunes partitions. Partition values stay text: a period '2024' is no number."""
    cols = {f.name: f.dataType for f in spark.read.parquet(path).schema.fields}
    schema = T.StructType([T.StructField(n, T.StringType() if n in ("month", "period") else t) for n, t in cols.items()])
    df = spark.read.schema(schema).parquet(path)
    return df.where(F.col("month").isin(*months)) if months is not None else df


# ------------------------------------------------------------------------------------------------------------ polygons
_COORDS2 = "array<array<array<double>>>"
_COORDS3 = "array<array<array<array<double>>>>"


def read_geojson(spark: SparkSession, paths: Paths, properties: T.StructType, sequence: bool = False) -> DataFrame:
    """Features (properties, geometry) from FeatureCollection files, or from files with one feature per line.

    A collection is dealt out like text, see ``sources.features``; members of it whose type is not Feature are left out.
    """
    part = T.StructType([T.StructField("type", T.StringType()), T.StructField("coordinates", T.StringType())])
    geometry = T.StructType([*part.fields, T.StructField("geometries", T.ArrayType(part))])
    feature = T.StructType([T.StructField("properties", properties), T.StructField("geometry", geometry)])
    if sequence:
        return spark.read.schema(feature).json(paths)
    typed = T.StructType([T.StructField("type", T.StringType()), *feature.fields])
    parsed = collection_features(spark, paths).select(F.from_json("text", typed).alias("f"))
    return parsed.where("f.type = 'Feature'").select("f.properties", "f.geometry")


def _polygons(geometry: Column) -> Column:
    """The polygons of a polygonal geometry, each an array of rings; none for any other."""
    text = geometry["coordinates"]
    polygons = F.when(geometry["type"] == "Polygon", F.array(F.from_json(text, _COORDS2))).when(
        geometry["type"] == "MultiPolygon", F.from_json(text, _COORDS3))
    return F.coalesce(polygons, F.array().cast(_COORDS3))


def polygons_from_geojson(features: DataFrame, order_by: str, p: Params, attributes: Sequence[str] = (),
                          mercator: bool = False) -> DataFrame:
    """Polygon rows (pid, attributes, rings, parts) of the features that overlap the study box.

    Anything but polygons is dropped, also inside a geometry collection. ``parts`` has the number of the polygon that each ring
    belongs to: all polygons of a multi-polygon, or of a collection's members, are parts of one row, and a point in any of them
    is in the row, also where members overlap. ``pid`` numbers the kept features by their ``order_by`` property; features without
    it come last, and equal ones stand in the order of their coordinates. ``mercator`` tells that the coordinates are
    web-mercator metres.
    """
    inner = F.flatten(F.transform(F.coalesce("geometry.geometries", F.array().cast("array<struct<type:string,coordinates:string>>")), _polygons))
    polygons = F.filter(F.transform(F.concat(_polygons(F.col("geometry")), inner), lambda g: F.filter(g, lambda r: F.size(r) > 0)),
                        lambda g: F.size(g) > 0)

    def vertex(c: Column) -> Column:
        lon, lat = geo.from_web_mercator(c[0], c[1]) if mercator else (c[0], c[1])
        return F.struct(lon.alias("lon"), lat.alias("lat"))

    attributes = list(dict.fromkeys([order_by, *attributes]))
    rows = features.select(*[F.col(f"properties.{a}").alias(a) for a in attributes], polygons.alias("_polygons"))
    rows = rows.where(F.size("_polygons") > 0).withColumns({
        "rings": F.transform(F.flatten("_polygons"), lambda r: F.transform(r, vertex)),
        "parts": F.flatten(F.transform("_polygons", lambda g, i: F.transform(g, lambda r: i.cast("int"))))})
    lons = F.flatten(F.transform("rings", lambda r: F.transform(r, lambda v: v.lon)))
    lats = F.flatten(F.transform("rings", lambda r: F.transform(r, lambda v: v.lat)))
    overlaps = ((F.array_max(lons) >= p.bbox[0]) & (F.array_min(lons) <= p.bbox[2])
                & (F.array_max(lats) >= p.bbox[1]) & (F.array_min(lats) <= p.bbox[3]))
    return number_polygons(rows.where(overlaps), order_by).select("pid", *attributes, "rings", "parts")


def number_polygons(rows: DataFrame, order_by: str) -> DataFrame:
    """Add ``pid``, the 0-based position by a whole-number attribute, absent ones last, ties by a hash of the rings.

    Rows are dealt by range of the order and numbered within a partition; the partitions' sizes, one number each, are summed.
    """
    tie = F.xxhash64("rings")
    order = [F.col(order_by).asc_nulls_last(), F.col("_tie").asc()]
    dealt = rows.withColumn("_tie", tie).repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = cut_lineage(dealt.withColumn("_part", F.spark_partition_id()), "polygons")
    within = F.row_number().over(W.partitionBy("_part").orderBy(*order))
    sizes = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    numbered = dealt.withColumn("_at", within).join(sizes.select("_part", before.alias("_before")), "_part")
    return numbered.withColumn("pid", (F.col("_before") + F.col("_at") - 1).cast("int")).drop("_part", "_at", "_before", "_tie")


# ----------------------------------------------------------------------------------------------------- published tables
def columnar(df: DataFrame, index: str, chunk_rows: int = 100_000) -> DataFrame:
    """Rows as objects of equal-length arrays in ``index`` order, one object per ``chunk_rows`` positions, however many
    there are: readers always take a list of chunks."""
    values = [c for c in df.columns if c != index]
    groups = df.groupBy(F.floor(F.col(index) / chunk_rows).alias("chunk")).agg(
        F.array_sort(F.collect_list(F.struct(index, *values))).alias("_rows"))

    def array_of(name: str) -> Column:
        return F.transform("_rows", lambda r: r[name]).alias(name)

    return groups.select("chunk", F.size("_rows").alias("rows"), *map(array_of, values))


def write_columnar_json(df: DataFrame, index: str, path: str, chunk_rows: int = 100_000) -> None:
    """One JSON object per line and chunk. Absent values are written as null, not left out."""
    columnar(df, index, chunk_rows).drop("rows").write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_geojson(layer: DataFrame, path: str) -> None:
    """A display layer (id, type, rings, parts) as one GeoJSON feature per line."""
    layer.select(feature_text(layer)).write.mode("overwrite").text(path)


def read_layer(spark: SparkSession, path: str) -> DataFrame:
    """A layer (id, type, rings, parts) as ``write_geojson`` has written it."""
    features = read_geojson(spark, path, T.StructType([T.StructField("id", T.LongType())]), sequence=True)
    rows = features.select("properties.id", "geometry.type", _polygons(F.col("geometry")).alias("_polygons"))
    vertex = lambda v: F.struct(v[0].alias("lon"), v[1].alias("lat"))
    return rows.select("id", "type", F.transform(F.flatten("_polygons"), lambda r: F.transform(r, vertex)).alias("rings"),
                       F.flatten(F.transform("_polygons", lambda g, i: F.transform(g, lambda r: i.cast("int")))).alias("parts"))


def feature_text(layer: DataFrame) -> Column:
    """Rows of a layer as GeoJSON features; each part's rings stand together, the outer one first."""
    pairs = F.transform("rings", lambda r: F.transform(r, lambda v: F.array(v.lon, v.lat)))
    nested = F.array(pairs)
    if "parts" in layer.columns:
        ringed = F.arrays_zip(pairs.alias("ring"), F.col("parts").alias("part"))
        nested = F.transform(F.array_sort(F.array_distinct("parts")), lambda i: F.transform(F.filter(ringed, lambda r: r.part == i), lambda r: r.ring))

    def feature(coordinates: Column) -> Column:
        return F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct("id").alias("properties"),
                                  F.struct("type", coordinates.alias("coordinates")).alias("geometry")))

    return F.when(F.col("type") == "MultiPolygon", feature(nested)).otherwise(feature(nested[0])).alias("value")


def read_mids(spark: SparkSession, path: str) -> DataFrame:
    """The ITU's table of maritime identification digits as CSV with the columns mid and iso2."""
    return spark.read.option("header", True).schema("mid string, iso2 string").csv(path)
