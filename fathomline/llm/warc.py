"""WARC archives: writing, normalising monolithic gzip files to one member per record, a sidecar index, reading back.

A monolithic archive is a whole-file gzip stream; no record of it can be read without inflating all before it. The normaliser
inflates each file once, as a stream (Spark's text reader does it, cut at the records' blank lines), rebuilds the records by
their declared length, writes every record as a gzip member of its own, and notes file, offset and length in a sidecar index.
With the index any record is read alone.

Members go to files in a folder that all executors reach, one file per task attempt. The index is the only list of them: it is
written through Spark's committer, so a task that was lost or run twice leaves an unlisted file and no row.

Payload digests decide between response and revisit: of records with equal payloads of at least ``REVISIT_FROM`` bytes that of
the smallest id is the response; the others are revisit records, which name it and carry no payload. Smaller payloads are always
responses. Ids are grouped by digest with partial minima, so payloads that a third of all rows share cost one row per task.

Defined cases: a null payload or url is empty. Rows that repeat an id and payload are records of their own; of a payload that the
smallest id has twice, both are responses. A null id ranks last. An empty table makes an empty index.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import cut_lineage, scratch_path
from .common import ship

# The format's line end and record end, and the least payload that may be replaced by a reference.
CRLF, RECORD_END = "\r\n", "\r\n\r\n"
REVISIT_FROM = 100
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: zlib level of the members
LEVEL = 3


def classify(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html", url_col: str = "url") -> DataFrame:
    """(id, url, payload, bytes, digest, record_type, refers_to): which record is a response and which refers to one."""
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).alias("id"), F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("url"), payload.alias("payload"),
                        F.octet_length(payload).cast("bigint").alias("bytes"), F.sha2(payload.cast("binary"), 256).alias("digest"))
    first = rows.where(F.col("bytes") >= REVISIT_FROM).groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("_n"))
    first = first.where("_n > 1").drop("_n")
    both = rows.join(first, "digest", "left")
    again = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("id"))
    return both.select("id", "url", "payload", "bytes", "digest", F.when(again, "revisit").otherwise("response").alias("record_type"),
                       F.when(again, F.col("first")).alias("refers_to"))


def record(rows: DataFrame) -> Column:
    """The text of a record up to its closing blank line, from the columns that ``classify`` makes."""
    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))

    revisit = F.col("record_type") == "revisit"
    # a line end inside a url would end its header line
    url = F.regexp_replace("url", "[\\r\\n]", "%0A")
    ref = F.concat(F.lit("<urn:fathomline:"), F.col("refers_to").cast("string"), F.lit(">"))
    return F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", F.concat(F.lit("<urn:fathomline:"), F.coalesce(F.col("id").cast("string"), F.lit("null")), F.lit(">"))),
        line("WARC-Target-URI", url), line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", ref))).otherwise(""),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("bytes").cast("string"))), F.lit(CRLF),
        F.when(revisit, "").otherwise(F.col("payload")))


def write_monolithic(rows: DataFrame, path: str, records_per_file: int = 20_000) -> None:
    """Write classified rows as WARC files, each one gzip stream from its first record to its last."""
    (rows.select(record(rows).alias("value")).write.option("compression", "gzip").option("lineSep", RECORD_END)
     .option("maxRecordsPerFile", records_per_file).text(path))


# ---------------------------------------------------------------------------------------------------------- normalising
def records_of(chunks: Iterable[tuple[str, bytes]]) -> Iterator[tuple[str, dict[str, str], bytes, bytes]]:
    """(file, headers, head, payload) of every record, from the pieces between blank lines of one file after another.

    A payload may hold blank lines itself; its declared length says how many pieces are its own. One that ends in an odd number
    of line ends is cut two bytes early, so its record is ended by bytes within a piece, and the rest of that piece is the next
    record's. A record without its end behind the declared length is an error.
    """
    sep = RECORD_END.encode()
    name, head, need, got = None, None, 0, []
    have = 0
    for file, piece in chunks:
        if file != name:
            if head is not None:
                raise ValueError(f"{name} ends within a record")
            name = file
        if head is not None:
            got.append(piece)
            have += len(piece)
            if have < need:
                have += len(sep)
                continue
            data, rest = sep.join(got), b""
            if have > need:
                rest = data[need:] if piece else data[need:] + sep  # only the last piece of a file has no separator, and that is not empty
                if not rest.startswith(sep):
                    raise ValueError(f"{name}: a record is longer than its declared length")
                rest = rest[len(sep):]
            yield name, headers, head, data[:need]
            head, piece = None, rest
        while piece.startswith(CRLF.encode()):
            piece = piece[len(CRLF):]
        if not piece:
            continue  # more blank lines than needed between records
        if not piece.startswith(b"WARC/"):
            raise ValueError(f"{name}: no record where one should start")
        head, got, have = piece, [], 0
        headers = {}
        for raw in piece.split(b"\r\n")[1:]:
            key, _, value = raw.partition(b":")
            headers[key.decode("utf-8").strip().lower()] = value.decode("utf-8").strip()
        need = int(headers["content-length"])
    if head is not None:
        raise ValueError(f"{name} ends within a record")


_INDEX = ("source string, file string, offset bigint, length bigint, record_id string, record_type string, url string, "
          "payload_digest string, payload_bytes bigint, refers_to string")
_INDEX_ARROW = pa.schema([("source", pa.string()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()),
                          ("record_id", pa.string()), ("record_type", pa.string()), ("url", pa.string()),
                          ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("refers_to", pa.string())])


def _filesystem(uri: str):
    """A file system and path for a folder's address: local paths, and what pyarrow knows (hdfs, s3, gs, abfs)."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def normalise(spark: SparkSession, archives: str, out: str, level: int = LEVEL) -> DataFrame:
    """Rewrite the monolithic archives below ``archives`` as member files below ``out``; the sidecar index is the result.

    It is written to ``out``/index, one row per record.
    """
    ship(spark)
    members = f"{out.rstrip('/')}/members"
    raw = spark.read.option("lineSep", RECORD_END).text(archives).select(
        F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("piece"))

    def rewrite(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = _filesystem(members)
        name, sink, at, rows = f"{uuid.uuid4().hex}.warc.gz", None, 0, []

        def pieces() -> Iterator[tuple[str, bytes]]:
            for b in batches:
                yield from zip(b.column(0).to_pylist(), b.column(1).to_pylist())

        try:
            for source, headers, head, payload in records_of(pieces()):
                if sink is None:
                    system.create_dir(folder, recursive=True)
                    sink = system.open_output_stream(f"{folder}/{name}", compression=None)  # the bytes are gzip already
                z = zlib.compressobj(level, zlib.DEFLATED, 31)
                member = z.compress(head + RECORD_END.encode() + payload + RECORD_END.encode()) + z.flush()
                sink.write(member)
                kind = headers.get("warc-type", "")
                digest = headers.get("warc-payload-digest", "").removeprefix("sha256:")
                own = hashlib.sha256(payload).hexdigest() if kind != "revisit" else digest
                if digest and own != digest:
                    raise ValueError(f"{source}: a payload does not have its digest")
                rows.append((source, f"{members}/{name}", at, len(member), headers.get("warc-record-id"), kind,
                             headers.get("warc-target-uri"), own, len(payload), headers.get("warc-refers-to")))
                at += len(member)
                if len(rows) >= 4096:
                    yield _batch(rows, _INDEX_ARROW)
                    rows = []
        finally:
            if sink is not None:
                sink.close()
        if rows:
            yield _batch(rows, _INDEX_ARROW)

    raw.mapInArrow(rewrite, _INDEX).write.parquet(f"{out.rstrip('/')}/index")
    return spark.read.schema(_INDEX).parquet(f"{out.rstrip('/')}/index")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


# -------------------------------------------------------------------------------------------------------------- reading
_READ = "record_id string, record_type string, url string, refers_to string, payload binary, declared_digest string"
_READ_ARROW = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("url", pa.string()), ("refers_to", pa.string()),
                         ("payload", pa.binary()), ("declared_digest", pa.string())])


def read_records(index: DataFrame) -> DataFrame:
    """The records an index lists, each inflated alone from its offset. Rows are dealt by file, as the index has them."""
    ship(index.sparkSession)

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, source = None, None
        for b in batches:
            rows, held = [], 0
            for file, offset, length in zip(*(b.column(i).to_pylist() for i in range(3))):
                if file != name:
                    if source is not None:
                        source.close()
                    system, path = _filesystem(file)
                    name, source = file, system.open_input_file(path)
                data = zlib.decompress(source.read_at(length, offset), 31)
                _, headers, _, payload = next(records_of((file, x) for x in data.removesuffix(RECORD_END.encode()).split(RECORD_END.encode())))
                rows.append((headers.get("warc-record-id"), headers.get("warc-type"), headers.get("warc-target-uri"),
                             headers.get("warc-refers-to"), payload, headers.get("warc-payload-digest", "").removeprefix("sha256:")))
                held += len(payload)
                if held > 16_000_000:
                    yield _batch(rows, _READ_ARROW)
                    rows, held = [], 0
            if rows:
                yield _batch(rows, _READ_ARROW)
        if source is not None:
            source.close()

    return index.select("file", "offset", "length").mapInArrow(read, _READ)


def number_of(record_id: Column) -> Column:
    """The id inside a record's name; null for none."""
    return F.regexp_extract(record_id, r"<urn:fathomline:(-?\d+)>", 1).try_cast("bigint")


def archive(pages: DataFrame, **columns: str) -> tuple[DataFrame, str]:
    """Write ``pages`` to monolithic archives, normalise them, and return the sidecar index and its folder."""
    spark = pages.sparkSession
    out = scratch_path(spark, "warc")
    write_monolithic(classify(pages, **columns), f"{out}/monolithic")
    return normalise(spark, f"{out}/monolithic", out), out


def page_records(pages: DataFrame, **columns: str) -> DataFrame:
    """Archive ``pages`` and read the archives back: id, payload size and digest, record type and what a revisit refers to.

    Size and digest of a response are those of the payload that was read; a revisit has those of the response it names.
    """
    index, _ = archive(pages, **columns)
    payload = F.coalesce(F.col("payload"), F.lit(b""))
    read = cut_lineage(read_records(index).select(
        number_of(F.col("record_id")).alias("id"), "record_type", number_of(F.col("refers_to")).alias("refers_to"), "declared_digest",
        F.octet_length(payload).cast("bigint").alias("bytes"), F.sha2(payload, 256).alias("digest")), "records")
    responses = read.where("record_type = 'response'").groupBy(F.col("id").alias("_id"), F.col("digest").alias("_digest")).agg(
        F.max("bytes").alias("_bytes"))
    again = read.where("record_type = 'revisit'").join(
        responses, (F.col("refers_to") == F.col("_id")) & (F.col("declared_digest") == F.col("_digest")), "left")
    again = again.select("id", F.col("_bytes").alias("bytes"), F.col("_digest").alias("digest"), "record_type", "refers_to")
    return read.where("record_type = 'response'").select("id", "bytes", "digest", "record_type", F.lit(None).cast("bigint").alias("refers_to")).unionByName(again)
