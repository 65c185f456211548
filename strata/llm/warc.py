r"""WARC archives by a monolithic gzip normaliser.

``write_archives`` writes one record for every page as Spark text rows whose
line separator is the record separator ``\r\n\r\n``; Spark compresses each file
as one gzip stream and commits it, so an archive is whole or absent.
``normalise`` inflates each such stream once, front to back, rewrites every
record as a gzip member of its own and writes a sidecar index of offsets beside
the new archive.  ``read_archives`` reads the normalised archives back, member
by member through the index.

Records with equal payloads of at least ``MIN_REVISIT`` bytes: the smallest page
id keeps the payload, the others become revisits that refer to it.  The smallest
id of a payload comes from an aggregate with partial sums and a join of ids on
the digest, so a payload that fills a third of all pages costs one row per task
before the shuffle and can be split in the join.  Payloads move once, by page; archives hold at most ``RECORDS_PER_FILE`` records, and a task
holds one compressed archive and one record at a time.

Files are written under an attempt's own name and renamed, and the index rows
are written as a table, so a task that is lost or run twice leaves one whole
archive under each name.

Defined results: a null html is an empty payload and a response; a null url an
empty target; a null page id is kept and comes last in the choice of a response;
rows that repeat the response's id and payload are responses too; columns of
other names are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import io
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import new_folder, release, written

MIN_REVISIT = 100
RECORDS_PER_FILE = 2000
SEPARATOR = b"\r\n\r\n"
PIECE = 1 << 20
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))


def _urn(page_id: Column, digest: Column) -> Column:
    """A stable record id: page and payload in the shape of a UUID."""
    h = F.md5(F.concat_ws(":", F.coalesce(page_id.cast("string"), F.lit("")), digest))
    return F.concat(F.lit("<urn:uuid:"), F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-"),
                    F.substring(h, 13, 4), F.lit("-"), F.substring(h, 17, 4), F.lit("-"),
                    F.substring(h, 21, 12), F.lit(">"))


def records(pages: DataFrame) -> DataFrame:
    """One text row ``value`` for every page: WARC header, HTTP header and payload."""
    rows = pages.select(
        "page_id", F.coalesce("url", F.lit("")).alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumns({"digest": F.sha2("html", 256), "size": F.octet_length("html").cast("long")})
    # Who refers to whom is settled on ids and digests alone; only then do payloads move, by page.
    ids = rows.filter(F.col("size") >= MIN_REVISIT).select("page_id", "digest")
    first = (ids.groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("copies"))
             .filter("copies > 1").drop("copies"))
    decided = (ids.join(first, "digest").filter(~F.col("page_id").eqNullSafe(F.col("first_id"))).distinct()
               .select(F.col("page_id").alias("d_page"), F.col("digest").alias("d_digest"), "first_id",
                       F.lit(True).alias("shared")))
    rows = rows.join(decided, F.col("page_id").eqNullSafe(F.col("d_page")) & (F.col("digest") == F.col("d_digest")), "left")
    revisit = F.col("shared").isNotNull()
    block = F.concat(F.lit(HTTP), F.when(revisit, F.lit("")).otherwise(F.col("html")))
    header = F.concat(
        F.lit("WARC/1.1\r\n"),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", _urn(F.col("page_id"), F.col("digest"))),
        F.lit("WARC-Date: 1970-01-01T00:00:00Z\r\n"),
        _line("WARC-Target-URI", F.regexp_replace("url", r"[\r\n]+", " ")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        _line("X-Page-Id", F.coalesce(F.col("page_id").cast("string"), F.lit(""))),
        _line("X-Payload-Length", F.col("size").cast("string")),
        F.when(revisit, F.concat(
            F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n"),
            _line("WARC-Refers-To", _urn(F.col("first_id"), F.col("digest"))),
            _line("X-Refers-To-Page-Id", F.coalesce(F.col("first_id").cast("string"), F.lit("")))))
        .otherwise(F.lit("")),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        _line("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"))
    return rows.select(F.concat(header, block).alias("value"))


def write_archives(pages: DataFrame, folder: str, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Monolithic ``.gz`` archives of all pages in ``folder``."""
    (records(pages).write.option("compression", "gzip").option("lineSep", SEPARATOR.decode())
     .option("maxRecordsPerFile", records_per_file).text(folder))


def _inflated(data: bytes) -> Iterator[bytes]:
    """The content of a gzip file of any number of members, piece by piece."""
    at = 0
    while at < len(data):
        inflater = zlib.decompressobj(31)
        while not inflater.eof:
            piece = inflater.unconsumed_tail
            if not piece:
                piece = data[at:at + PIECE]
                at += len(piece)
                if not piece:
                    raise ValueError("the gzip stream ends inside a member")
            yield inflater.decompress(piece, PIECE)
        at -= len(inflater.unused_data)


def split_records(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes, bytes]]:
    """(header fields, raw header, block) of each record of an inflated stream."""
    held = bytearray()

    def fill(size: int) -> bool:
        while len(held) < size:
            piece = next(pieces, None)
            if piece is None:
                return False
            held.extend(piece)
        return True

    while True:
        searched = 0
        while (end := held.find(SEPARATOR, searched)) < 0:
            searched = max(0, len(held) - len(SEPARATOR))
            if not fill(len(held) + 1):
                if held.strip():
                    raise ValueError("the archive ends inside a record header")
                return
        head = bytes(held[:end + 4])
        fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:] if x)
        size = int(fields["Content-Length"])
        if not fill(end + 4 + size + 4):
            raise ValueError("the archive ends inside a record block")
        yield fields, head, bytes(held[end + 4:end + 4 + size])
        del held[:end + 4 + size + 4]


def member(raw: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def _put(path: str, data: bytes) -> None:
    """Write a file under a name of this attempt, then give it its own name."""
    files, place = _filesystem(path)
    attempt = f"{place}.{uuid.uuid4().hex}.part"
    with files.open_output_stream(attempt) as out:
        out.write(data)
    if files.get_file_info(place).type != pafs.FileType.NotFound:
        files.delete_file(attempt)  # another attempt made the same file
    else:
        files.move(attempt, place)


def _filesystem(path: str):
    if "://" not in path and path.startswith("file:"):
        path = path.replace("file:", "file://", 1)
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


INDEX = ("path string, record long, offset long, length long, page_id long, record_type string, "
         "payload_digest string, target string")


def normalise(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Rewrite every archive of ``source`` record by record into ``target``.

    Returns the offset index, one row for each record, which also lies beside
    each archive as ``<name>.index.jsonl``.
    """
    files, place = _filesystem(target)
    files.create_dir(place, recursive=True)

    def run(batches):
        for batch in batches:
            for path, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                name = path.rsplit("/", 1)[1].split(".")[0]
                archive, out, rows, at = f"{target}/{name}.warc.gz", io.BytesIO(), [], 0
                for fields, head, block in split_records(_inflated(data)):
                    packed = member(head + block + SEPARATOR)
                    out.write(packed)
                    rows.append({"path": archive, "record": len(rows), "offset": at, "length": len(packed),
                                 "page_id": int(fields["X-Page-Id"]) if fields["X-Page-Id"] else None,
                                 "record_type": fields["WARC-Type"],
                                 "payload_digest": fields["WARC-Payload-Digest"].split(":", 1)[1],
                                 "target": fields["WARC-Target-URI"]})
                    at += len(packed)
                if rows:
                    _put(archive, out.getvalue())
                    _put(f"{target}/{name}.index.jsonl", "".join(json.dumps(r) + "\n" for r in rows).encode())
                    yield pa.RecordBatch.from_pylist(rows, schema=_INDEX_SCHEMA)

    raw = _archives(spark, source, "*.gz").select("path", "content")
    return written(raw.mapInArrow(run, INDEX), "warc-index")


_INDEX_SCHEMA = pa.schema([
    ("path", pa.string()), ("record", pa.int64()), ("offset", pa.int64()), ("length", pa.int64()),
    ("page_id", pa.int64()), ("record_type", pa.string()), ("payload_digest", pa.string()), ("target", pa.string())])

READ = ("page_id long, target string, payload_bytes long, payload_digest string, record_type string, "
        "refers_to long, payload binary")


def _archives(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """One row per file, one file per task as long as there are few: archives are cut to fit a task."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)


def read_archives(spark: SparkSession, folder: str, by_index: bool = True, with_payload: bool = True) -> DataFrame:
    """Every record of the normalised archives of ``folder``.

    Length and digest of a response are taken from the payload read; a revisit
    carries those of the payload that it refers to.  The sidecar index gives each
    member's place; without it the members are walked.
    """
    def row(fields: dict[str, str], block: bytes) -> dict:
        payload = block[block.index(SEPARATOR) + 4:]
        revisit = fields["WARC-Type"] == "revisit"
        told = fields["WARC-Payload-Digest"].split(":", 1)[1]
        digest = told if revisit else hashlib.sha256(payload).hexdigest()
        if digest != told:
            raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
        refers = fields.get("X-Refers-To-Page-Id", "")
        return {"page_id": int(fields["X-Page-Id"]) if fields["X-Page-Id"] else None,
                "target": fields["WARC-Target-URI"],
                "payload_bytes": int(fields["X-Payload-Length"]) if revisit else len(payload),
                "payload_digest": digest, "record_type": fields["WARC-Type"],
                "refers_to": int(refers) if refers else None, "payload": payload if with_payload else None}

    def members(path: str, data: bytes) -> Iterator[bytes]:
        if not by_index:
            yield data
            return
        files, place = _filesystem(f"{folder}/{path.rsplit('/', 1)[1].replace('.warc.gz', '.index.jsonl')}")
        with files.open_input_stream(place) as side:
            for line in side.read().splitlines():
                x = json.loads(line)
                yield data[x["offset"]:x["offset"] + x["length"]]

    def run(batches):
        for batch in batches:
            for path, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows, held = [], 0
                for part in members(path, data):
                    for fields, _, block in split_records(_inflated(part)):
                        rows.append(row(fields, block))
                        held += len(block) if with_payload else 0
                        if held > PIECE:
                            yield pa.RecordBatch.from_pylist(rows, schema=_READ_SCHEMA)
                            rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=_READ_SCHEMA)

    return _archives(spark, folder, "*.warc.gz").select("path", "content").mapInArrow(run, READ)


_READ_SCHEMA = pa.schema([
    ("page_id", pa.int64()), ("target", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])


def round_trip(pages: DataFrame) -> DataFrame:
    """Write, normalise and read back; the rows of the contract."""
    spark = pages.sparkSession
    raw, neat = new_folder(spark, "warc-raw"), new_folder(spark, "warc")
    write_archives(pages, raw)
    release(spark)
    normalise(spark, raw, neat)
    return read_archives(spark, neat, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
