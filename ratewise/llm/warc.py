"""WARC archives: a writer of deduplicated records and a salvage reader.

The writer gives every record a gzip member of its own. The reader checks each
member and record; after a failed check it searches for the next place where a
valid member or a version line begins, goes on from there, and logs the bytes in
between as a quarantined gap. The same search goes through the bytes of a member
that holds several records, as far as they can be decompressed.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.session import scratch_path

#: Payload bytes that one archive file aims at.
FILE_BYTES = 32 << 20
# Profile of a revisit, magic number of a gzip member, names of our own fields.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_STEP = 1 << 16
MAGIC = b"\x1f\x8b\x08"
PAGE_FIELD, REFERS_FIELD = "X-Page-Id", "X-Refers-To-Page-Id"
_NEXT = re.compile(rb"\x1f\x8b\x08|WARC/1\.[0-9]\r\n")
_LINE = re.compile(rb"WARC/1\.[0-9]\r\n")
_HEADERS = re.compile(rb"WARC/1\.[0-9]\r\n((?:[^\r\n]+\r\n)*)\r\n")


def record_id(row: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page-row:{row}')}>"


def build_record(
    kind: str, row: int, uri: str, digest: str, payload: bytes, page: int | None,
    refers_row: int | None = None, refers_page: int | None = None,
    date: str = "2000-01-01T00:00:00Z",
) -> bytes:
    """One record; a revisit holds the response's headers, but not its payload again."""
    uri = "".join(f"%{ord(c):02X}" if c <= " " else c for c in uri)
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", record_id(row)),
        ("WARC-Date", date),
        ("WARC-Target-URI", uri),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if page is not None:
        fields.append((PAGE_FIELD, str(page)))
    if kind == "revisit":
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_row))]
        if refers_page is not None:
            fields.append((REFERS_FIELD, str(refers_page)))
    else:
        block += payload
    fields.append(("Content-Length", str(len(block))))
    head = "".join(f"{k}: {v}\r\n" for k, v in fields if v)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


class Damaged(Exception):
    """A member or record that fails a check."""


def _record(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """Fields, block and end of the record at a place."""
    head = _HEADERS.match(data, at)
    if not head:
        raise Damaged("no version line and fields")
    fields = {}
    for line in head[1].decode("utf-8", "replace").split("\r\n"):
        name, _, value = line.partition(":")
        name = name.strip().lower()
        if name in fields and name != "warc-concurrent-to":
            raise Damaged("a field comes twice")  # the head of one record runs into the next
        fields[name] = value.strip()
    length = fields.get("content-length", "")
    if not (length.isascii() and length.isdigit()):
        raise Damaged("no content length")
    end = head.end() + int(length)
    if data[end : end + 4] != b"\r\n\r\n":
        raise Damaged("the record doesn't end where its length says")
    block = data[head.end() : end]
    digest = fields.get("warc-payload-digest", "")
    if fields.get("warc-type") == "response" and digest.startswith("sha256:"):
        if hashlib.sha256(payload_of(block)).hexdigest() != digest[7:]:
            raise Damaged("the payload doesn't have its digest")
    return fields, block, end + 4


def payload_of(block: bytes) -> bytes:
    """What follows the HTTP headers."""
    return block.partition(b"\r\n\r\n")[2]


def _inflate(data: bytes, at: int) -> tuple[bytes, int, str]:
    """What a gzip member at a place holds, the end of its bytes and what is wrong with it.

    Of a damaged member all that comes before the damage, and where that is.
    """
    member, parts, place = zlib.decompressobj(31), [], at
    while not member.eof and place < len(data):  # in steps: what is unused is copied
        before = member.copy()
        try:
            parts.append(member.decompress(data[place : place + _STEP]))
        except zlib.error as error:
            for one in range(place, len(data)):  # the last good byte of this step
                try:
                    parts.append(before.decompress(data[one : one + 1]))
                except zlib.error:
                    return b"".join(parts), one, f"bad member: {error}"
        place += _STEP
    content, place = b"".join(parts), min(place, len(data))
    if not member.eof:
        return content, place, "the member is cut off"
    return content, place - len(member.unused_data), ""


def _search(data: bytes, pattern: re.Pattern, unit) -> Iterator[tuple]:
    """('record', offset, end, what unit found) and ('gap', offset, end, reason), in order.

    ``unit`` reads what begins at a place, or raises ``Damaged``; then the next
    place with the pattern is tried.
    """
    at, bad, reason = 0, None, ""
    while at < len(data):
        try:
            found, end = unit(data, at)
        except Damaged as error:
            if bad is None:
                bad, reason = at, str(error)
            following = pattern.search(data, at + 1)
            at = following.start() if following else len(data)
            continue
        if bad is not None:
            yield "gap", bad, at, reason
            bad = None
        yield "record", at, end, found
        at = end
    if bad is not None:
        yield "gap", bad, len(data), reason


def _plain(data: bytes, at: int) -> tuple[tuple[dict, bytes], int]:
    """The record at a place, and its end."""
    fields, block, end = _record(data, at)
    return (fields, block), end


def _unit(data: bytes, at: int) -> tuple[list[tuple], int]:
    """What the gzip member or the one plain record at a place holds, and its end.

    A member gives its ('record', inner start, inner end, record) and ('gap',
    inner start, inner end, reason), or fails if no record in it passes. The end of a
    damaged one is where the damage is; its last gap goes from its last good record to
    there, and is empty if only the check sum is lost.
    """
    if not data.startswith(MAGIC, at):
        found, end = _plain(data, at)
        return [("record", None, None, found)], end
    content, end, wrong = _inflate(data, at)
    parts = list(_search(content, _LINE, _plain))
    if (content or wrong) and not any(x[0] == "record" for x in parts):
        raise Damaged(wrong or parts[0][3])
    if wrong:
        last = max(i for i, x in enumerate(parts) if x[0] == "record")
        parts[last + 1 :] = [("gap", parts[last][2], len(content), wrong)]
    return parts, end


def salvage(data: bytes) -> Iterator[tuple]:
    """('record', offset, end, fields, block) and ('gap', offset, end, reason, inner, past).

    In order. ``inner`` and ``past`` are None for a gap of the file; a gap inside a
    member has the place of the member as offset and end, and its own bytes among
    the decompressed ones as ``inner`` and ``past``. A record of a damaged member
    counts if it passes its own checks: version line, fields, length, end and, where
    it has one, digest.
    """
    for kind, at, end, found in _search(data, _NEXT, _unit):
        if kind == "gap":
            yield "gap", at, end, found, None, None
            continue
        for part, inner, past, what in found:
            if part == "record":
                yield "record", at, end, *what
            else:
                yield "gap", at, end, what, inner, past


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 100) -> DataFrame:
    """Write a record for each row of ``pages`` (page_id, url, html) below ``folder``.

    Of equal payloads of at least ``min_bytes`` the row with the smallest page_id
    is the response (null ids last, then by row), the others revisit it. Returns
    (file, records). A file has a name by its task and appears when complete, so
    a task that runs again replaces its own. ``folder`` must be one that pyarrow
    and Spark both reach from every executor. Null html is an empty payload; a
    null url is left out of the record.
    """
    spark = pages.sparkSession
    path = scratch_path(spark, "numbered-pages")
    payload = F.coalesce("html", F.lit("")).cast("binary")
    pages.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("page_id").cast("bigint").alias("page_id"),
        "url",
        payload.alias("payload"),
        F.sha2(payload, 256).alias("digest"),
        F.octet_length(payload).cast("bigint").alias("size"),
    ).write.option("compression", "zstd").parquet(path)  # the numbers hold from here
    rows = spark.read.parquet(path)
    large = rows.filter(F.col("size") >= min_bytes)
    order = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "row")
    firsts = (
        large.groupBy("digest")
        .agg(F.min(order).alias("first"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("digest", "first.row", "first.page_id")
        .withColumnsRenamed({"row": "first_row", "page_id": "first_page"})
    )
    again = (
        large.select("row", "digest")
        .join(firsts, "digest")
        .filter("row <> first_row")
        .select("row", "first_row", "first_page")
    )
    placed = rows.join(again, "row", "left")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        system, base = arrow_fs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)
        trial = f"{base}/.trial-{task.taskAttemptId()}"
        records = (
            build_record(
                "response" if r["first_row"] is None else "revisit",
                r["row"], r["url"] or "", r["digest"], r["payload"], r["page_id"],
                r["first_row"], r["first_page"],
            )
            for batch in batches
            for r in batch.to_pylist()
        )
        record, part = next(records, None), 0
        while record is not None:
            name = f"{base}/pages-{task.partitionId():06d}-{part:04d}.warc.gz"
            count, size = 0, 0
            with system.open_output_stream(trial, compression=None) as out:
                while record is not None and size < FILE_BYTES:
                    out.write(gzip.compress(record, 6, mtime=0))
                    count, size = count + 1, size + len(record)
                    record = next(records, None)
            system.move(trial, name)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([count])], ["file", "records"]
            )
            part += 1

    path = scratch_path(spark, "archive-manifest")
    placed.mapInArrow(write, "file string, records bigint").write.parquet(path)
    return spark.read.parquet(path)


_RECORD = (
    "file string, start bigint, past bigint, gap string, inner_start bigint, inner_past bigint, "
    "record_type string, record_id string, target_uri string, digest string, "
    "refers_to_id string, page_id bigint, refers_to bigint, payload binary"
)


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Records and gaps of all archives of a folder, one row each.

    ``gap`` says why a byte range was passed over and is null for records; start
    and past are bytes of the file. A gap inside a member that holds records names
    the member by these, and its decompressed bytes by inner_start and inner_past,
    which are null elsewhere. A file is one row of Spark's binary source,
    so it has to fit into a task; the writer's files do.
    """
    names = [part.split()[0] for part in _RECORD.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column("path"), batch.column("content")):
                rows, size = [], 0
                for kind, start, past, *what in salvage(content.as_py()):
                    row = dict.fromkeys(names) | {"file": file.as_py(), "start": start, "past": past}
                    if kind == "gap":
                        row["gap"], row["inner_start"], row["inner_past"] = what
                    else:
                        fields, block = what
                        page, refers = fields.get(PAGE_FIELD.lower()), fields.get(REFERS_FIELD.lower())
                        row |= {
                            "record_type": fields.get("warc-type"),
                            "record_id": fields.get("warc-record-id"),
                            "target_uri": fields.get("warc-target-uri"),
                            "digest": fields.get("warc-payload-digest", "").rpartition(":")[2],
                            "refers_to_id": fields.get("warc-refers-to"),
                            "page_id": int(page) if page else None,
                            "refers_to": int(refers) if refers else None,
                            "payload": payload_of(block),
                        }
                        size += len(block)
                    rows.append(row)
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    kinds = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(n, kinds[t]) for n, t in (p.split() for p in _RECORD.split(", "))])
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc*").load(folder)
    return files.select("path", "content").mapInArrow(read, _RECORD)


def pages_of(records: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of the records read.

    Size and digest are those of the full payload: of a revisit, those of the
    response that it names.
    """
    spark = records.sparkSession
    path = scratch_path(spark, "read-records")
    records.filter("gap is null").select(
        "page_id",
        "record_id",
        "record_type",
        "refers_to",
        "refers_to_id",
        F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"),
    ).write.parquet(path)
    rows = spark.read.parquet(path)
    own = rows.filter(F.col("record_type") == "response")
    full = own.select(
        F.col("record_id").alias("refers_to_id"), "payload_bytes", "payload_digest"
    )
    revisits = (
        rows.filter(F.col("record_type") == "revisit")
        .drop("payload_bytes", "payload_digest")
        .join(full, "refers_to_id", "left")
    )
    out = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return own.select(*out).unionByName(revisits.select(*out))
