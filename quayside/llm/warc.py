"""WARC archives with revisit records, and a splittable reader of them.

Archives are written by tasks, a gzip member for each record, each under a name of its attempt that is moved
to its final name when it is whole; a task that is run again writes the same bytes under the same name. Of
records with equal payloads of at least ``LEAST_REVISIT`` bytes that with the largest page id is a response
and the others revisit it: which is decided on digests alone, and only what is a revisit is joined to the pages, by
page, so that a payload however frequent is no hot key among whole pages.

The reader needs no index. Its tasks get ranges of bytes; a task looks for the magic of gzip in its range, takes a
candidate for a member only if it decodes to a WARC header, reads the member to its end, even beyond
the range, and goes on from there. A record belongs to the range that its first byte is in, so each is
read once. At most one record is in memory.

Null pages have an empty payload. Null page ids are kept and are never referred to, unless no equal payload has
an id: then all are responses. Rows that repeat an id and payload are responses if that id is
the one referred to. An empty table gives no archive and no rows.
"""

from __future__ import annotations

import base64
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.common import small_batches, snapshot
from quayside.session import new_folder

LEAST_REVISIT = 1000
#: An archive is closed after so many bytes, and read in ranges of so many.
ARCHIVE_BYTES = 1 << 30
RANGE_BYTES = 8 << 20
_READ_BYTES = 1 << 20
_GZIP = b"\x1f\x8b\x08"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_RECORD = "record_type string, page_id long, refers_to long, url string, digest string, payload_bytes long, payload binary, archive string, offset long"


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}:{digest}>"


def _page_of(record_id: str) -> int | None:
    page = record_id.split(":")[2]
    return int(page) if page else None


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A response record, or a revisit that has the headers of the response only; digest: SHA-1 in hexadecimal."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", _record_id(page_id, digest)),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe=":/?#[]@!$&'()*+,;=%~")))
    if refers_to is not None:
        fields += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", _record_id(refers_to, digest))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def _opened(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def _revisits(pages: DataFrame, least: int) -> DataFrame:
    """(page_id, digest, refers_to) of the pages that revisit another."""
    light = snapshot(pages.select("page_id", "digest", F.octet_length("payload").alias("size")), "digests")
    large = light.where(F.col("size") >= least)
    winners = large.groupBy("digest", "size").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n"))
    winners = snapshot(winners.where("n > 1 and refers_to is not null").select("digest", "size", "refers_to"), "winners")
    met = large.join(winners, ["digest", "size"]).where(~F.col("page_id").eqNullSafe(F.col("refers_to")))
    return snapshot(met.select("page_id", "digest", "refers_to").distinct(), "revisits")


def write(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    least_revisit: int = LEAST_REVISIT,
) -> DataFrame:
    """Write a record for each page into archives in a folder; returns (archive, records) of what was written.

    An attempt of a task names its archives for itself, and only the names of attempts that Spark counts are returned, so
    attempts that were repeated or lost leave archives that nobody reads.
    """
    spark = pages.sparkSession
    small_batches(spark, 500)
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.encode(F.col(html_col).cast("string"), "UTF-8"), F.lit(b"")).alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    again = _revisits(rows, least_revisit).withColumnsRenamed({"page_id": "_page", "digest": "_digest"})
    same = F.col("page_id").eqNullSafe(F.col("_page")) & (F.col("digest") == F.col("_digest"))
    all_rows = rows.join(again, same, "left").select("page_id", "url", "payload", "digest", "refers_to")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex[:12]
        system, root = _opened(folder)
        system.create_dir(root)
        out, path, name, size, count, part = None, "", "", 0, 0, 0

        def closed() -> pa.RecordBatch:
            out.close()
            system.move(path, f"{root}/{name}")
            return pa.RecordBatch.from_pydict({"archive": [name], "records": pa.array([count], pa.int64())})

        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    name = f"part-{task:05d}-{part:03d}-{attempt}.warc.gz"
                    path = f"{root}/_{name}"  # readers pass over names that begin with _
                    out, size, count, part = system.open_output_stream(path, compression=None), 0, 0, part + 1
                packer = zlib.compressobj(4, wbits=31)
                member = packer.compress(record(**row)) + packer.flush()
                out.write(member)
                size, count = size + len(member), count + 1
                if size >= ARCHIVE_BYTES:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    return snapshot(all_rows.mapInArrow(run, "archive string, records long"), "archives")


def members(file, begin: int, end: int, size: int) -> Iterator[tuple[int, bytes]]:
    """(place, decoded bytes) of the gzip members of WARC records that begin in a range of a file."""
    at, held = begin, b""  # held: bytes of the file from ``at`` on

    def more() -> bytes:
        file.seek(at + len(held))
        return file.read(_READ_BYTES)

    while at < end:
        found = held.find(_GZIP)
        if found < 0:
            kept = held[-2:]
            at, held = at + len(held) - len(kept), kept
            new = more() if at + len(held) < size else b""
            if not new:
                return
            held += new
            continue
        at, held = at + found, held[found:]
        if at >= end:
            return
        unpacker, parts, used, taken = zlib.decompressobj(31), [], 0, 0
        try:
            while not unpacker.eof:
                if used == len(held):
                    if at + len(held) >= size or not (new := more()):
                        raise zlib.error("the file ends in a member")
                    held += new
                parts.append(unpacker.decompress(held[used : used + _READ_BYTES]))
                used = min(len(held), used + _READ_BYTES)
                taken += len(parts[-1])
                if taken >= 7 and not _starts_warc(parts):
                    raise zlib.error("a member of something else")
            if not _starts_warc(parts):
                raise zlib.error("a member of something else")
        except zlib.error:
            at, held = at + 1, held[1:]
            continue
        yield at, b"".join(parts)
        length = used - len(unpacker.unused_data)
        at, held = at + length, held[length:]


def _starts_warc(parts: list[bytes]) -> bool:
    return b"".join(parts[:8])[:7] == b"WARC/1." if len(parts) < 8 else True


def parse(raw: bytes) -> dict:
    """The fields of a record that the reader returns; a revisit has no payload but its size and digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    lengths = [line.split(b":")[1] for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:")]
    revisit = fields["WARC-Type"] == "revisit"
    digest = fields.get("WARC-Payload-Digest", "").removeprefix("sha1:")
    return {
        "record_type": fields["WARC-Type"],
        "page_id": _page_of(fields["WARC-Record-ID"]),
        "refers_to": _page_of(fields["WARC-Refers-To"]) if revisit else None,
        "url": fields.get("WARC-Target-URI"),
        "digest": base64.b32decode(digest).hex() if digest else None,
        "payload_bytes": int(lengths[0]) if revisit and lengths else len(payload),
        "payload": None if revisit else payload,
    }


def read(spark: SparkSession, folder: str, range_bytes: int = RANGE_BYTES, archives: DataFrame | None = None) -> DataFrame:
    """All records of the archives in a folder, or of those that ``write`` returned, in the columns of _RECORD."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder).select("path", "length")
    if archives is not None:
        name = F.element_at(F.split("path", "/"), -1)
        files = files.join(archives, name == F.col("archive"), "left_semi")
    begins = F.explode(F.sequence(F.lit(0), F.col("length") - 1, F.lit(range_bytes)))
    ranges = files.where("length > 0").select("path", "length", begins.alias("begin"))
    ranges = ranges.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [field.split()[0] for field in _RECORD.split(", ")]
        schema = pa.schema(
            [(n, pa.int64() if n in ("page_id", "refers_to", "payload_bytes", "offset") else pa.binary() if n == "payload" else pa.string()) for n in names]
        )
        for batch in batches:
            for row in batch.to_pylist():
                system, path = _opened(row["path"])
                found, held = [], 0
                with system.open_input_file(path) as file:
                    for at, raw in members(file, row["begin"], row["begin"] + range_bytes, row["length"]):
                        found.append(parse(raw) | {"archive": path, "offset": at})
                        held += len(raw)
                        if held > _READ_BYTES:
                            yield pa.RecordBatch.from_pylist(found, schema)
                            found, held = [], 0
                if found:
                    yield pa.RecordBatch.from_pylist(found, schema)

    return ranges.mapInArrow(run, _RECORD)


def round_trip(pages: DataFrame, **columns: str) -> DataFrame:
    """Write the archives of a table to the shared folder and read them back."""
    spark = pages.sparkSession
    folder = new_folder(spark, "warc")
    archives = write(pages, folder, **columns)
    if archives.isEmpty():
        return spark.createDataFrame([], _RECORD)
    return read(spark, folder, archives=archives)
