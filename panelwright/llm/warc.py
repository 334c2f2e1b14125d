"""WARC archives compressed by zstandard: one frame for each record, the dictionary in a leading skippable frame.

Archives are rows (``archive``, ``n_records``, ``content``) of bounded size, so that any store Spark writes to can hold
them; ``save_files`` and ``load_files`` move them to and from ``.warc.zst`` files. A record whose
payload another record already has is a revisit of it, with the payload's digest and length but without the payload.
"""

from __future__ import annotations

import base64
import hashlib
import os
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.scale import attach, written

# Bytes of records in an archive; a larger record is an archive of its own.
ARCHIVE_BYTES = 16 << 20
DICTIONARY_BYTES = 32 << 10
# Bytes of records, evenly spread over the archive, that its dictionary is made from.
SAMPLE_BYTES = 2 << 20
# Equal payloads of at least so many bytes are written once.
REVISIT_BYTES = 0

# Frame magics of the format, the revisit profile, and the fields that every record must have.
DICTIONARY_MAGIC = 0x184D2A5D
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
VERSIONS = ("WARC/1.0", "WARC/1.1")
MANDATORY = ("warc-type", "warc-record-id", "warc-date", "content-length")

_FED = 1 << 16


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_bytes(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    return f"WARC/1.1\r\n{head}\r\n".encode() + block + b"\r\n\r\n"


def target(url: str | None) -> list[tuple[str, str]]:
    """The target field: bytes that can't stand in a header are percent-encoded; none for a missing url."""
    if not url:
        return []
    return [("WARC-Target-URI", "".join(chr(b) if 32 < b < 127 else f"%{b:02X}" for b in url.encode("utf-8", "replace")))]


def record_id(page_id: int | None, uid: int) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}:{uid}>"


def page_of(name: str) -> Column:
    """The page's id in a column of record ids that ``record_id`` made, else NULL."""
    return F.nullif(F.regexp_extract(name, "^<urn:x-page:(-?[0-9]*):", 1), F.lit("")).cast("long")


def response(page_id: int | None, uid: int, url: str | None, payload: bytes, date: str) -> bytes:
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode() + payload
    return record_bytes([("WARC-Type", "response"), ("WARC-Record-ID", record_id(page_id, uid)), ("WARC-Date", date), *target(url),
                         ("Content-Type", "application/http; msgtype=response"), ("WARC-Block-Digest", f"sha1:{sha1_base32(block)}"),
                         ("WARC-Payload-Digest", f"sha1:{sha1_base32(payload)}")], block)


def revisit(page_id: int | None, uid: int, url: str | None, payload: bytes, date: str, first_id: int | None, first_uid: int) -> bytes:
    return record_bytes([("WARC-Type", "revisit"), ("WARC-Record-ID", record_id(page_id, uid)), ("WARC-Date", date), *target(url),
                         ("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(first_id, first_uid)), ("X-Payload-Length", str(len(payload))),
                         ("WARC-Payload-Digest", f"sha1:{sha1_base32(payload)}")], b"")


def archive_bytes(records: list[bytes]) -> bytes:
    """A dictionary made from some of the records, where there are enough of them, and a frame for each record."""
    some, size = [], 0
    for k in range(0, len(records), max(1, sum(map(len, records)) // SAMPLE_BYTES)):
        if size < SAMPLE_BYTES:
            some.append(records[k])
            size += len(records[k])
    out, made = [], None
    if size > 8 * DICTIONARY_BYTES:
        try:
            made = zstandard.train_dictionary(DICTIONARY_BYTES, some, k=256, d=8)
        except zstandard.ZstdError:     # too few or too uniform records
            made = None
    if made is not None:
        body = zstandard.ZstdCompressor(level=9).compress(made.as_bytes())
        out.append(struct.pack("<II", DICTIONARY_MAGIC, len(body)) + body)
    packer = zstandard.ZstdCompressor(level=3, write_checksum=True, write_content_size=True, **({"dict_data": made} if made else {}))
    return b"".join(out + [packer.compress(r) for r in records])


def write_archives(pages: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Archives of the columns ``page_id, url, html``, written: ``archive, n_records, content``.

    A NULL html is an empty payload. Of the rows with equal payloads of ``REVISIT_BYTES`` or more, the one with the smallest
    id (NULL last, then the first as stored) is a response and all others revisit it, so one of several equal rows is the
    response. A missing url has no target field. Every archive starts with a ``warcinfo`` record.
    """
    held = written(pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("html"),
                                F.monotonically_increasing_id().alias("uid")))
    key = F.unhex(F.sha2("html", 256))
    first = F.min(F.struct(F.col("page_id").isNull().alias("none"), F.col("page_id"), F.col("uid"))).alias("f")
    firsts = (held.where(F.octet_length("html") >= REVISIT_BYTES).groupBy(key.alias("_key")).agg(first, F.count(F.lit(1)).alias("n")).where("n > 1")
              .select("_key", F.col("f.page_id").alias("first_id"), F.col("f.uid").alias("first_uid")))
    found = attach(held.withColumn("_key", key), written(firsts), ["_key"]).select("page_id", "url", "html", "uid", "first_id", "first_uid")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        records: list[bytes] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal records, size, number
            name = f"part-{part:06d}-{number:06d}.warc.zst"
            info = b"software: panelwright\r\nformat: WARC File Format 1.1\r\n"
            about = record_bytes([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:x-archive:{name}>"), ("WARC-Date", date),
                                  ("WARC-Filename", name), ("Content-Type", "application/warc-fields")], info)
            content = archive_bytes([about, *records])
            out = pa.RecordBatch.from_arrays([pa.array([name]), pa.array([len(records) + 1], pa.int32()), pa.array([content], pa.binary())],
                                             names=["archive", "n_records", "content"])
            records, size, number = [], 0, number + 1
            return out
        for batch in batches:
            for at in range(batch.num_rows):
                page_id, url, html, uid, first_id, first_uid = (c[at].as_py() for c in batch.columns)
                again = first_uid is not None and first_uid != uid
                record = revisit(page_id, uid, url, html, date, first_id, first_uid) if again else response(page_id, uid, url, html, date)
                if records and size + len(record) > ARCHIVE_BYTES:
                    yield flush()
                records.append(record)
                size += len(record)
        if records:
            yield flush()
    return written(found.mapInArrow(run, "archive string, n_records int, content binary"))


def frames(content: bytes) -> Iterator[tuple[int, bytes]]:
    """Offset and content of every frame after the dictionary. Raises ``ValueError`` where the archive is damaged."""
    view, at, made = memoryview(content), 0, None
    while len(view) - at >= 8 and 0x184D2A50 <= struct.unpack_from("<I", view, at)[0] <= 0x184D2A5F:
        magic, size = struct.unpack_from("<II", view, at)
        if len(view) - at - 8 < size:
            raise ValueError(f"offset {at}: skippable frame is cut")
        if magic == DICTIONARY_MAGIC and at == 0:
            body = bytes(view[8:8 + size])
            made = zstandard.ZstdCompressionDict(_whole(body) if body[:4] == ZSTD_MAGIC else body)
        at += 8 + size
    reader = zstandard.ZstdDecompressor(**({"dict_data": made} if made else {}))
    while at < len(view):
        if 0x184D2A50 <= int.from_bytes(view[at:at + 4], "little") <= 0x184D2A5F:       # other skippable frames hold nothing for us
            at += 8 + int.from_bytes(view[at + 4:at + 8], "little")
            continue
        one, start, out = reader.decompressobj(), at, []
        while not one.eof:
            fed = view[at:at + _FED]
            if not len(fed):
                raise ValueError(f"offset {start}: frame is cut")
            try:
                out.append(one.decompress(fed))
            except zstandard.ZstdError as e:
                raise ValueError(f"offset {start}: {e}") from e
            at += len(fed)
        at -= len(one.unused_data)
        yield start, b"".join(out)


def _whole(body: bytes) -> bytes:
    try:
        return zstandard.ZstdDecompressor().decompressobj().decompress(body)
    except zstandard.ZstdError as e:
        raise ValueError(f"dictionary: {e}") from e


@dataclass
class Record:
    fields: dict[str, str] = field(default_factory=dict)
    kind: str | None = None
    payload: bytes = b""
    payload_bytes: int = 0
    digest: str | None = None
    problem: str | None = None


def parse(data: bytes) -> Record:
    """One record, with what is wrong with it in ``problem``: version, fields, lengths of block and payload, digests, the end."""
    out = Record()
    head, mark, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    last = None
    for line in lines[1:]:
        if line[:1] in (" ", "\t") and last:        # a folded line
            out.fields[last] += " " + line.strip()
            continue
        name, colon, value = line.partition(":")
        last = name.strip().lower()
        if not colon or not last or len(last.split()) > 1 or last in out.fields and last in MANDATORY:
            out.problem = f"bad field {line[:80]!r}"
            return out
        out.fields[last] = value.strip()
    out.kind = out.fields.get("warc-type")
    if lines[0] not in VERSIONS or not mark:
        out.problem = f"bad version {lines[0][:20]!r}" if mark else "header has no end"
        return out
    absent = [m for m in MANDATORY if m not in out.fields]
    if absent:
        out.problem = f"no {', '.join(absent)}"
        return out
    length = out.fields["content-length"]
    if not length.isascii() or not length.isdigit() or int(length) + 4 != len(rest) or rest[-4:] != b"\r\n\r\n":
        out.problem = f"block of {len(rest) - 4} bytes, Content-Length {length[:20]}"
        return out
    block = rest[:-4]
    out.payload = block
    if out.kind in ("response", "revisit") and "application/http" in out.fields.get("content-type", ""):
        http, mark, out.payload = block.partition(b"\r\n\r\n")
        told = [x.split(b":", 1)[1].strip() for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
        if not mark or told and out.kind == "response" and told[0] != str(len(out.payload)).encode():
            out.problem = "HTTP header and body don't fit"
            return out
    stated = out.fields.get("warc-block-digest", "")
    if stated.lower().startswith("sha1:") and stated[5:] != sha1_base32(block):
        out.problem = "block digest differs"
        return out
    stated = out.fields.get("warc-payload-digest", "")
    if out.kind == "revisit":
        size = out.fields.get("x-payload-length", "")
        out.payload_bytes, out.digest = int(size) if size.isascii() and size.isdigit() else 0, stated[5:] or None
        if "warc-refers-to" not in out.fields or not out.digest:
            out.problem = "revisit without WARC-Refers-To or digest"
        return out
    out.payload_bytes, out.digest = len(out.payload), sha1_base32(out.payload)
    if stated.lower().startswith("sha1:") and stated[5:] != out.digest:
        out.problem = "payload digest differs"
    return out


def read_archives(archives: DataFrame, payloads: bool = True, strict: bool = False) -> DataFrame:
    """All records: ``archive, offset, record_type, record_id, target_uri, date, payload_bytes, payload_digest, refers_to, problem``
    and, with ``payloads``, ``payload``.

    Digest and length are those of the full payload; a revisit states them. What is wrong with a record stands in
    ``problem``; where an archive is damaged, one row of it tells the place and its later records are not read.
    ``strict`` raises instead. A NULL or empty content has no records.
    """
    names = ["archive", "offset", "record_type", "record_id", "target_uri", "date", "payload_bytes", "payload_digest", "refers_to", "problem"]
    kinds = [pa.string(), pa.int64(), *[pa.string()] * 4, pa.int64(), *[pa.string()] * 3]
    schema = ", ".join(f"{n} {'long' if k == pa.int64() else 'string'}" for n, k in zip(names, kinds)) + (", payload binary" if payloads else "")

    def rows(archive: str, content: bytes) -> Iterator[tuple]:
        try:
            for offset, data in frames(content):
                r = parse(data)
                get = r.fields.get
                yield (archive, offset, r.kind, get("warc-record-id"), get("warc-target-uri"), get("warc-date"), r.payload_bytes, r.digest,
                       get("warc-refers-to"), r.problem, r.payload)
        except ValueError as e:
            yield (archive, None, None, None, None, None, None, None, None, str(e), None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for at in range(batch.num_rows):
                for row in rows(batch.column(0)[at].as_py(), batch.column(1)[at].as_py() or b""):
                    if strict and row[9]:
                        raise ValueError(f"{row[0]}, {row[3]}: {row[9]}")
                    held.append(row)
                    size += len(row[10] or b"") if payloads else 100
                    if size > ARCHIVE_BYTES:
                        yield put(held)
                        held, size = [], 0
        if held:
            yield put(held)

    def put(held: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*held, strict=True))
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
        return pa.RecordBatch.from_arrays(arrays + ([pa.array(columns[10], pa.binary())] if payloads else []), names=names + (["payload"] if payloads else []))
    return archives.select("archive", "content").mapInArrow(run, schema)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write the pages as archives and read them back: ``page_id, payload_bytes, payload_digest, record_type, refers_to``.

    One row per page, also for NULL ids, NULL or empty html and repeated rows; see ``write_archives``. A record that
    does not stand the checks of ``read_archives`` fails the job.
    """
    records = read_archives(write_archives(pages), payloads=False, strict=True).where("record_type <> 'warcinfo'")
    return records.select(page_of("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page_of("refers_to").alias("refers_to"))


def save_files(archives: DataFrame, folder: str) -> None:
    """Write each archive as a file into a folder that all executors mount; a file appears whole or not at all."""
    def put(rows) -> None:
        os.makedirs(folder, exist_ok=True)
        for row in rows:
            part = f"{folder}/.{row['archive']}.{uuid.uuid4().hex}"
            with open(part, "wb") as f:
                f.write(row["content"])
            os.replace(part, f"{folder}/{row['archive']}")
    archives.select("archive", "content").foreachPartition(put)


def load_files(spark: SparkSession, path: str) -> DataFrame:
    """``archive, content`` of ``.warc.zst`` files (of less than 2 GB each, which is what Spark's binary reader can hold)."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(path)
    return found.select(F.element_at(F.split("path", "/"), -1).alias("archive"), "content")
