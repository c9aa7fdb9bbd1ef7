"""WARC archives from pages and a splittable reader (operator 9).

Writing: every task writes gzip members, one record each, to files of its own
names and reports them; only reported files belong to the archive, so a lost or
repeated task leaves nothing that is read. A payload of ``MIN_REVISIT`` bytes
or more that another page with a smaller page_id has is stored once and
revisited.

Reading: tasks scan byte ranges for the gzip magic, validate a candidate member
by decoding its WARC header, and own the records that start inside their range;
from one record on, the next one starts where the member ends.

Edge cases: a null html is an empty payload (always a response); a null url is
left out of the record; a null page_id is written as an empty id and read back
as null, and revisits a numbered page with the same payload; rows that repeat a
page_id and its payload are all responses; an empty table gives an archive
without files. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, column

#: Smaller payloads are never revisits.
MIN_REVISIT = 100
#: Compressed bytes of one archive file and of one reading range.
FILE_BYTES = 64 << 20
RANGE_BYTES = 4 << 20
#: Fixed, so that rewriting the same pages gives the same records.
WARC_DATE = "2000-01-01T00:00:00Z"

MAGIC = b"\x1f\x8b\x08"
_READ = 1 << 16


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system that a path names (local, HDFS or object store)."""
    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    return pafs.FileSystem.from_uri(path)


# --------------------------------------------------------------------------
# Records
# --------------------------------------------------------------------------

def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record as a gzip member."""
    http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    revisit = refers_to is not None
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {WARC_DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="!#$%&'()*+,/:;=?@[]~"))
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    if revisit:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    block = http if revisit else http + payload
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def _headers(block: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in block.decode("utf-8", "replace").split("\r\n")[1:])
    return {k.strip().lower(): v.strip() for k, _, v in pairs}


def _page(urn: str | None) -> int | None:
    digits = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def parse(data: bytes) -> dict:
    """The fields of one decoded record; a payload that does not have the
    digest its header states is an error."""
    head, _, rest = data.partition(b"\r\n\r\n")
    warc = _headers(head)
    block = rest[:int(warc["content-length"])]
    http_head, _, payload = block.partition(b"\r\n\r\n")
    size = int(_headers(http_head).get("content-length", len(payload)))
    digest = warc["warc-payload-digest"].removeprefix("sha256:")
    if warc["warc-type"] == "response":
        real = hashlib.sha256(payload).hexdigest()
        if real != digest or len(payload) != size:
            raise ValueError(f"damaged record {warc.get('warc-record-id')}")
    return {"page_id": _page(warc["warc-record-id"]), "url": warc.get("warc-target-uri"),
            "payload_bytes": size, "payload_digest": digest, "record_type": warc["warc-type"],
            "refers_to": _page(warc.get("warc-refers-to")),
            "payload": payload if warc["warc-type"] == "response" else None}


# --------------------------------------------------------------------------
# Writing
# --------------------------------------------------------------------------

def decisions(scratch: Scratch, pages: DataFrame) -> DataFrame:
    """(page_id, digest, refers_to) of the pages that revisit another one. The
    smallest id per payload is found with partial aggregation, the join back
    reads plain files on both sides (AQE splits a very common payload)."""
    heads = scratch.table(pages.select("page_id", F.unhex("digest").alias("digest"))
                          .where(F.octet_length("html") >= MIN_REVISIT), "heads")
    firsts = scratch.table(heads.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
                           .where("n > 1 AND first IS NOT NULL").select("digest", "first"), "firsts")
    return (heads.join(firsts, "digest").where(~F.col("page_id").eqNullSafe(F.col("first")))
            .select(F.col("page_id").alias("_page"), F.lower(F.hex("digest")).alias("_digest"),
                    F.col("first").alias("refers_to")).distinct())


def _write(base: str):
    def run(batches):
        fs, root = filesystem(base)
        out, name, size, records = None, None, 0, 0

        def done():
            out.close()
            return pa.RecordBatch.from_pydict({"path": [name], "bytes": [size], "records": [records]},
                                              schema=pa.schema([("path", pa.string()), ("bytes", pa.int64()),
                                                                ("records", pa.int64())]))

        for batch in batches:
            for row in zip(*(column(batch, c).to_pylist() for c in ("page_id", "url", "html", "digest", "refers_to"))):
                page_id, url, html, digest, refers_to = row
                if out is None:
                    name = f"part-{uuid.uuid4().hex}.warc.gz"
                    out, size, records = fs.open_output_stream(f"{root}/{name}", compression=None), 0, 0
                member = record(page_id, url, html.encode(), digest, refers_to)
                out.write(member)
                size, records = size + len(member), records + 1
                if size >= FILE_BYTES:
                    yield done()
                    out = None
        if out is not None:
            yield done()
    return run


def write_archive(spark: SparkSession, pages: DataFrame, base: str, scratch: Scratch | None = None) -> DataFrame:
    """Write a record per page under ``base`` and return the manifest: path
    (relative to ``base``), bytes, records of each file."""
    scratch = scratch or Scratch(spark, "warc")
    pages = (pages.select(F.col("page_id").cast("long").alias("page_id"), "url",
                          F.coalesce("html", F.lit("")).alias("html"))
             .withColumn("digest", F.sha2(F.col("html"), 256)))
    fs, root = filesystem(base)
    fs.create_dir(root, recursive=True)
    again = decisions(scratch, pages)
    rows = (pages.join(again, F.col("page_id").eqNullSafe(F.col("_page")) & (F.col("digest") == F.col("_digest")), "left")
            .select("page_id", "url", "html", "digest", "refers_to"))
    return scratch.table(rows.mapInArrow(_write(base), "path string, bytes long, records long"), "manifest")


# --------------------------------------------------------------------------
# Reading
# --------------------------------------------------------------------------

def _is_record(f, at: int) -> bool:
    """Whether a gzip member with a WARC header starts at byte ``at``."""
    f.seek(at)
    try:
        head = zlib.decompressobj(31).decompress(f.read(_READ), 1 << 14)
    except zlib.error:
        return False
    return head.startswith(b"WARC/1.") and b"\r\nWARC-Type:" in head


def _find(f, at: int, end: int) -> int | None:
    """The first record start in [at, end)."""
    while at < end:
        f.seek(at)
        block = f.read(min(_READ, end - at) + len(MAGIC) - 1)
        if not block:
            return None
        hit = block.find(MAGIC)
        while hit >= 0 and at + hit < end:
            if _is_record(f, at + hit):
                return at + hit
            hit = block.find(MAGIC, hit + 1)
        at += max(1, len(block) - len(MAGIC) + 1)
    return None


def _member(f, at: int) -> tuple[bytes, int]:
    """The decoded member at ``at`` and where it ends."""
    f.seek(at)
    decoder, parts, used = zlib.decompressobj(31), [], 0
    while not decoder.eof:
        block = f.read(_READ)
        if not block:
            raise ValueError(f"the record at byte {at} is cut off")
        parts.append(decoder.decompress(block))
        used += len(block)
    return b"".join(parts), at + used - len(decoder.unused_data)


def records_in(f, start: int, end: int) -> Iterator[dict]:
    """Records of the file that start in [start, end)."""
    at = _find(f, start, end)
    while at is not None and at < end:
        data, after = _member(f, at)
        yield parse(data)
        at = after if after < end and _is_record(f, after) else _find(f, after, end)


_FIELDS = [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
           ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
           ("payload", pa.binary())]
_SCHEMA = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
           "refers_to long, payload binary")
_BATCH_BYTES = 8 << 20


def _read(base: str, with_payload: bool):
    schema = pa.schema(_FIELDS)

    def run(batches):
        fs, root = filesystem(base)
        for batch in batches:
            for path, start, end in zip(*(column(batch, c).to_pylist() for c in ("path", "start", "end"))):
                with fs.open_input_file(f"{root}/{path}") as f:
                    rows, held = [], 0
                    for r in records_in(f, start, end):
                        held += len(r["payload"] or b"") if with_payload else 100
                        rows.append(r if with_payload else r | {"payload": None})
                        if held >= _BATCH_BYTES:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
    return run


def read_archive(spark: SparkSession, manifest: DataFrame, base: str, range_bytes: int = RANGE_BYTES,
                 with_payload: bool = True) -> DataFrame:
    """The records of an archive: page_id, url, payload_bytes, payload_digest,
    record_type, refers_to, payload (null for revisits)."""
    ranges = (manifest.where("bytes > 0")
              .withColumn("start", F.explode(F.expr(f"sequence(0L, bytes - 1, {range_bytes}L)")))
              .select("path", "start", F.least(F.col("start") + range_bytes, F.col("bytes")).alias("end")))
    n = manifest.agg(F.sum(F.ceil(F.col("bytes") / range_bytes))).first()[0] or 1
    return (ranges.repartition(int(n), "path", "start")
            .mapInArrow(_read(base, with_payload), _SCHEMA))
