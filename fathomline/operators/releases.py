"""Which release supplies which month: the catalogue, the ledger of ingested files, and precedence between periods.

A period is ``'YYYYMM'`` (monthly) or ``'YYYY'`` (annual). A month comes from its monthly release where there is one, else
from the annual one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..config import Params
from ..functions.scalars import is_annual, period_months

# Name patterns of the release titles and files.
TITLE_PERIOD = r"^\s*(\d{6}|\d{4})\b"
DETECTIONS_FILE = r"^sentinel2_vessel_detections_.*_(\d{4,6})\.csv$"
OVERPASS_FILE = r"^sentinel2_overpass_(\d{4,6})\.csv$"


def monthly_key(period: Column) -> Column:
    """``'202507'`` -> ``'2025-07'``."""
    return F.concat(F.substring(period, 1, 4), F.lit("-"), F.substring(period, 5, 2))


def parse_releases(records: DataFrame, files_url: str) -> DataFrame:
    """Catalogue rows from source records (id, title, published, files[key, link, size]).

    The period is in the title, else in a file's name; records with neither are dropped. Of several files of a kind the
    last one counts. A file without a link gets ``files_url`` with ``{id}`` and ``{key}`` filled in.
    """
    def last(pattern: str) -> Column:
        return F.try_element_at(F.filter("files", lambda f: f.key.rlike(pattern)), F.lit(-1))

    def url(f: Column) -> Column:
        default = F.replace(F.replace(F.lit(files_url), F.lit("{id}"), F.col("id").cast("string")), F.lit("{key}"), f["key"])
        return F.when(f["key"].isNotNull(), F.coalesce(F.when(F.length(f["link"]) > 0, f["link"]), default))

    rows = records.withColumns({"_det": last(DETECTIONS_FILE), "_ovp": last(OVERPASS_FILE)})
    det, ovp = F.col("_det"), F.col("_ovp")
    found = [F.regexp_extract("title", TITLE_PERIOD, 1), F.regexp_extract(det["key"], DETECTIONS_FILE, 1),
             F.regexp_extract(ovp["key"], OVERPASS_FILE, 1)]
    period = F.coalesce(*[F.when(F.length(p) > 0, p) for p in found])
    return rows.select(
        F.col("id").cast("bigint").alias("record_id"), period.alias("period"), "title", "published",
        url(det).alias("detections_url"), det["key"].alias("detections_name"), det["size"].alias("detections_size"),
        url(ovp).alias("overpass_url"), ovp["key"].alias("overpass_name"), ovp["size"].alias("overpass_size"),
    ).where("period is not null")


def flatten_records(records: DataFrame) -> DataFrame:
    """Source records as delivered -> (id, title, published, files).

    Title and date are below ``metadata``; a record without a publication date has that of its creation. A file's address is
    its ``links.self``.
    """
    file = lambda f: F.struct(f.key.alias("key"), f.links["self"].alias("link"), f.size.cast("bigint").alias("size"))
    published = F.when(F.length("metadata.publication_date") > 0, F.col("metadata.publication_date"))
    return records.select("id", F.coalesce("metadata.title", F.lit("")).alias("title"),
                          F.coalesce(published, F.col("created"), F.lit("")).alias("published"), F.transform("files", file).alias("files"))


def complete_releases(releases: DataFrame) -> DataFrame:
    """Both files are there. An overpass file counts whatever its size; only a negative one marks it as missing.

    A size of 0 is what a source gives that does not know it.
    """
    return releases.where(
        (F.length("detections_url") > 0) & (F.length("overpass_url") > 0) & (F.coalesce("overpass_size", F.lit(0)) >= 0))


def latest_release_per_period(releases: DataFrame) -> DataFrame:
    """The newest complete release of every period."""
    newest = W.partitionBy("period").orderBy(F.desc("published"), F.desc("record_id"))
    return complete_releases(releases).withColumn("_n", F.row_number().over(newest)).where("_n = 1").drop("_n")


def since_year(df: DataFrame, since: str | None) -> DataFrame:
    return df if since is None else df.where(F.substring("period", 1, 4) >= since)


def superseded(periods: DataFrame, monthly: DataFrame | None = None) -> DataFrame:
    """Annual periods all of whose twelve months have a monthly one (among ``monthly``, by default the same table)."""
    months = (periods if monthly is None else monthly).where(~is_annual(F.col("period"))).select(
        monthly_key(F.col("period")).alias("month")).distinct()
    covered = (
        periods.where(is_annual(F.col("period"))).select("period").distinct()
        .withColumn("month", F.explode(period_months(F.col("period")))).join(months, "month", "left_semi")
    )
    return covered.groupBy("period").agg(F.count(F.lit(1)).alias("_n")).where("_n = 12").select("period")


def is_cached(releases: DataFrame, ledger: DataFrame, p: Params) -> DataFrame:
    """Releases with a flag: the ledger has the same record, the current schema (none noted means 1) and both files."""
    entry = ledger.select(
        "period", F.col("record_id").alias("_record"), F.coalesce("detections_schema", F.lit(1)).alias("_schema"),
        F.col("has_files").alias("_files"))
    ok = (F.col("_record") == F.col("record_id")) & (F.col("_schema") == p.schema_version) & F.col("_files")
    return releases.join(entry, "period", "left").withColumn("cached", F.coalesce(ok, F.lit(False))).drop(
        "_record", "_schema", "_files")


def keeps_overpass(releases: DataFrame, ledger: DataFrame) -> DataFrame:
    """Releases whose overpass file need not be read again: a schema change concerns detections only."""
    entry = ledger.select("period", F.col("record_id").alias("_record"), F.col("overpass_rows").alias("_rows"),
                          F.col("has_files").alias("_files"))
    ok = (F.col("_record") == F.col("record_id")) & F.col("_rows").isNotNull() & F.col("_files")
    return releases.join(entry, "period", "left").withColumn("keep_overpass", F.coalesce(ok, F.lit(False))).drop(
        "_record", "_rows", "_files")


NOTES = "period string, record_id bigint, published string, part string, rows bigint, detections_schema int, noted_at timestamp"


def note(spark: SparkSession, path: str, entries: Sequence[tuple]) -> None:
    """Add to the notes that parts of periods were taken in: (period, record_id, published, part, rows, detections_schema) each,
    where the part is detections or overpass and only detections have a schema. Notes are only ever added."""
    rows = spark.createDataFrame(list(entries), NOTES.rsplit(",", 1)[0])
    rows.withColumn("noted_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(path)


def noted(spark: SparkSession, path: str, part: str | None = None, schema: int | None = None) -> DataFrame:
    """The newest note of each period and part; only those of one part, and of one schema version, if asked."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], NOTES)
    rows = spark.read.schema(NOTES).parquet(path)
    if part is not None:
        rows = rows.where(F.col("part") == part)
    if schema is not None:
        rows = rows.where(F.col("detections_schema") == schema)
    newest = W.partitionBy("period", "part").orderBy(F.desc("published"), F.desc("record_id"), F.desc("noted_at"))
    return rows.withColumn("_n", F.row_number().over(newest)).where("_n = 1").drop("_n")


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger that the other operators read, one row per period, from the notes of ingestion.

    A period has its files when both parts were taken in from one record; ``overpass_rows`` is null until then.
    """
    notes = noted(spark, path)
    det = notes.where("part = 'detections'").select("period", "record_id", "published", "detections_schema", F.col("rows").alias("detections_rows"))
    ovp = notes.where("part = 'overpass'").select("period", F.col("record_id").alias("_record"), F.col("rows").alias("overpass_rows"))
    both = det.join(ovp, "period", "full")
    same = F.col("record_id").eqNullSafe(F.col("_record"))
    return both.select("period", F.coalesce("record_id", "_record").alias("record_id"), "published", "detections_schema", "detections_rows",
                       F.when(same, F.col("overpass_rows")).alias("overpass_rows"), same.alias("has_files"))


def releases_to_fetch(latest: DataFrame, ledger: DataFrame, p: Params, since: str | None = None) -> DataFrame:
    """What an update has to ingest, newest period first."""
    wanted = since_year(latest, since)
    todo = is_cached(wanted, ledger, p).where("not cached").drop("cached")
    return todo.join(superseded(wanted), "period", "left_anti").orderBy(F.desc("period"))


def resolve_requests(requests: DataFrame, latest: DataFrame) -> DataFrame:
    """Periods that answer each request (``'YYYY-MM'`` or ``'YYYY'``): monthly ones first, else the annual one.

    A request nothing answers keeps one row with a NULL period.
    """
    monthly = latest.where(~is_annual(F.col("period"))).select(
        "period", F.explode(F.array(monthly_key(F.col("period")), F.substring("period", 1, 4))).alias("request"))
    annual = latest.where(is_annual(F.col("period"))).select(F.col("period").alias("_annual"))
    out = requests.select("request").distinct().join(monthly, "request", "left")
    out = out.withColumn("_year", F.substring("request", 1, 4)).join(annual, F.col("_year") == F.col("_annual"), "left")
    return out.select("request", F.coalesce("period", "_annual").alias("period"))


def releases_for_months(requests: DataFrame, latest: DataFrame) -> DataFrame:
    """The releases to read for the requests, each once."""
    chosen = resolve_requests(requests, latest).where("period is not null").select("period").distinct()
    return latest.join(chosen, "period", "left_semi")


def ledger_status(ledger: DataFrame, p: Params, since: str | None = None) -> DataFrame:
    """Status of every ingested period: ``use``, ``stale`` (blocks a build), ``excluded`` (stale and before ``since``) or
    ``unused`` (stale, but all its months have a monthly release)."""
    rows = ledger.where("has_files").select(
        "period", (F.coalesce("detections_schema", F.lit(1)) != p.schema_version).alias("stale"))
    early = F.col("stale") & (F.substring("period", 1, 4) < since) if since is not None else F.lit(False)
    rows = rows.withColumn("excluded", early)
    covered = superseded(rows, rows.where("not excluded")).withColumn("covered", F.lit(True))
    rows = rows.join(covered, "period", "left")
    status = (F.when(F.col("excluded"), "excluded").when(F.col("stale") & F.col("covered"), "unused")
              .when(F.col("stale"), "stale").otherwise("use"))
    return rows.select("period", status.alias("status"))


def stale_releases(ledger: DataFrame, p: Params, since: str | None = None) -> DataFrame:
    return ledger_status(ledger, p, since).where("status = 'stale'").select("period")


class StaleRelease(ValueError):
    """Some ingested release was read under an older schema and still supplies a month."""


def usable_periods(ledger: DataFrame, p: Params, since: str | None = None) -> DataFrame:
    """Periods a build reads; refuses to go on while a stale one is needed."""
    stale = sorted(r[0] for r in stale_releases(ledger, p, since).collect())  # at most some hundred months
    if stale:
        raise StaleRelease(f"ingest these {len(stale)} periods again first: {', '.join(stale)}")
    return ledger_status(ledger, p, since).where("status = 'use'").select("period")


def monthly_months(periods: DataFrame) -> DataFrame:
    return periods.where(~is_annual(F.col("period"))).select(monthly_key(F.col("period")).alias("month")).distinct()


def months_without_monthly(rows: DataFrame, periods: DataFrame) -> DataFrame:
    """Annual rows of months that no monthly release supplies."""
    return rows.where(is_annual(F.col("period"))).join(monthly_months(periods), "month", "left_anti")


def merge_periods(rows: DataFrame, periods: DataFrame) -> DataFrame:
    """One row set from all stored periods: of each month the rows of one period.

    Rows that a monthly upload has of other months are left out; an annual upload fills in where no monthly one exists.
    """
    own = rows.where(~is_annual(F.col("period")) & (F.col("month") == monthly_key(F.col("period"))))
    own = own.join(periods.select("period").distinct(), "period", "left_semi")
    annual = rows.join(periods.select("period").distinct(), "period", "left_semi")
    return own.unionByName(months_without_monthly(annual, periods).select(*own.columns))
