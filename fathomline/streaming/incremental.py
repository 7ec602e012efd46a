"""Ingesting new release files as they arrive.

A stream over file names tells which uploads have new files; its checkpoint is the list of names already seen, so a run takes up
only what is new and stops. Of every upload named, all files present are read together, by column name, through the same
writer as batch ingestion: the upload's period is replaced as a whole, also by an upload that has no row left. Which of several
uploads of a period counts is decided by (publication date, record number), in this run and against the ledger of earlier
ones: an old upload that arrives late changes nothing. Every period taken up is noted in the ledger.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import Params
from ..operators import releases
from ..runtime import cut_lineage
from ..sources import files

#: how a file's name may tell that it is compressed
COMPRESSED = ("gz", "bz2")
#: an upload is a file, or a folder of files, named ``[<published>_<record>_]..._<period>[.csv]``, compressed or not
UPLOAD = re.compile(rf"^(.*?/)?(?:[^/=]*=)?(?:(\d{{4}}-\d{{2}}-\d{{2}})_(\d+)_)?(?:[^/]*_)?(\d{{6}}|\d{{4}})(\.csv(?:\.(?:{'|'.join(COMPRESSED)}))?$|/[^/]*$)")


@dataclass(frozen=True, order=True)
class Upload:
    """One delivery of a period. Uploads compare by what decides between them."""

    published: str
    record_id: int
    written: float
    period: str
    path: str


def upload_of(file: str, written: float) -> Upload | None:
    """The upload a file belongs to; None for names without a period. Without a date and number the time of writing counts."""
    m = UPLOAD.match(file)
    if m is None:
        return None
    path = file.rsplit("/", 1)[0] if m[5].startswith("/") else file
    return Upload(m[2] or "", int(m[3] or 0), written, m[4], path)


def newest(uploads: Iterable[Upload]) -> dict[str, Upload]:
    """Of each period's uploads the one that counts."""
    found: dict[str, Upload] = {}
    for u in uploads:
        if u.period not in found or (u.published, u.record_id, u.written, u.path) > (
                found[u.period].published, found[u.period].record_id, found[u.period].written, found[u.period].path):
            found[u.period] = u
    return found


def _run(spark: SparkSession, folder: str, checkpoint: str, take: Callable[[list[Upload]], None], known: Callable[[], DataFrame]) -> None:
    """Hand the periods' counting uploads with new files to ``take``."""
    names = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary").option(
        "recursiveFileLookup", True).option("pathGlobFilter", f"{{*.csv,{','.join(f'*.csv.{c}' for c in COMPRESSED)}}}").load(folder).select(
        "path", F.col("modificationTime").cast("double").alias("written"))  # names only, no content is read

    def store(batch: DataFrame, _id: int) -> None:
        # one row per new file; an upload's newest file dates it
        found = [u for r in batch.collect() if (u := upload_of(r["path"], r["written"] or 0.0))]
        held = {r["period"]: (r["published"] or "", int(r["record_id"] or 0)) for r in known().collect()}
        todo = [u for u in sorted(newest(found).values()) if u.period not in held or (u.published, u.record_id) >= held[u.period]]
        if todo:
            take(todo)

    names.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def store_detections(spark: SparkSession, uploads: Iterable[Upload], out: str, p: Params) -> None:
    """Store detection uploads below ``out``/detections and note them, with their rows, in ``out``/ledger.

    The note comes last: uploads of a job that died before it are known as not yet taken in, and their periods keep their old rows.
    """
    found = newest(uploads)
    rows = files.ingest_detections(spark, {u.period: u.path for u in found.values()}, f"{out}/detections", p)
    releases.note(spark, f"{out}/ledger", [(u.period, u.record_id, u.published, "detections", rows[u.period], p.schema_version) for u in found.values()])


def store_overpasses(spark: SparkSession, uploads: Iterable[Upload], cells: DataFrame, out: str) -> None:
    """Store overpass uploads below ``out``/overpass and note them; the cells that were asked for go to ``out``/requested."""
    found = newest(uploads)
    rows = files.ingest_overpasses(spark, {u.period: u.path for u in found.values()}, cells, f"{out}/overpass")
    asked = cut_lineage(cells.select("cell").distinct(), "asked")
    files.publish_versions(spark, f"{out}/requested", {p: files.write_version(asked, f"{out}/requested", p, by=()) for p in found})
    releases.note(spark, f"{out}/ledger", [(u.period, u.record_id, u.published, "overpass", rows[u.period], None) for u in found.values()])


def ingest_new_detections(spark: SparkSession, folder: str, out: str, checkpoint: str, p: Params) -> None:
    """Store and note the new detection uploads of ``folder``.

    The list of seen names belongs to the schema version: a new version reads all detection files again and leaves the
    overpasses as they are.
    """
    _run(spark, folder, f"{checkpoint}/detections-v{p.schema_version}", lambda uploads: store_detections(spark, uploads, out, p),
         lambda: releases.noted(spark, f"{out}/ledger", "detections", p.schema_version))


def ingest_new_overpasses(spark: SparkSession, folder: str, cells: DataFrame, out: str, checkpoint: str) -> None:
    """Store and note the new overpass uploads of ``folder``, with the cells that were asked for."""
    _run(spark, folder, f"{checkpoint}/overpasses", lambda uploads: store_overpasses(spark, uploads, cells, out),
         lambda: releases.noted(spark, f"{out}/ledger", "overpass"))


def requested_cells(spark: SparkSession, out: str) -> DataFrame:
    """(period, cell): the cells overpasses were asked for, whether or not the files had rows of them."""
    return files.read_stored(spark, f"{out}/requested", T.StructType([T.StructField("cell", T.StringType())]), by=())
