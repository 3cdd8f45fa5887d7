"""WARC archives with an index written first and range reads through it.

Writing: each task streams its records, gzip member by member, into archive
files of its own attempt and returns one index row per record (file, offset,
length, url, digest, ...). Spark commits the index as Parquet, so only files
of successful attempts are ever referred to. Reading: index rows are sorted by
file and offset, neighbouring byte ranges are coalesced into one read each and
the records are parsed from them.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.common import stage, text_or_empty

MIN_REVISIT_BYTES = 1000
FILE_BYTES = 256 << 20
# Range reads: a gap up to READ_GAP is read over, one read covers READ_BYTES at most
# (or one record).
READ_GAP, READ_BYTES = 64 << 10, 8 << 20
WARC_DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_PAGE = uuid.UUID("6f1d7c52-8a33-4b0e-0000-000000000000").int

INDEX_SCHEMA = ("page_id long, file string, offset long, length long, url string, digest string, "
                "record_type string")
RECORD_SCHEMA = ("page_id long, url string, payload_bytes long, payload_digest string, "
                 "record_type string, refers_to long")


def record_id(page_id: int) -> str:
    """A record id that holds the page id in its last 64 bits."""
    return f"<urn:uuid:{uuid.UUID(int=_PAGE | (page_id & (1 << 64) - 1))}>"


def page_of(record: str) -> int:
    low = uuid.UUID(record.strip("<>").removeprefix("urn:uuid:")).int & (1 << 64) - 1
    return low - (1 << 64) if low >> 63 else low


def _record(page_id, url, payload: bytes, digest: str, n: int, kind: str, refers_to) -> bytes:
    """One record; a revisit has the HTTP header but no payload."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n\r\n").encode()
    block = http + (payload if kind == "response" else b"")
    head = ["WARC/1.1", f"WARC-Type: {kind}",
            f"WARC-Record-ID: {f'<urn:uuid:{uuid.uuid4()}>' if page_id is None else record_id(page_id)}",
            f"WARC-Date: {WARC_DATE}", f"WARC-Payload-Digest: sha1:{digest}",
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if url is not None:  # control characters cannot stand in a header line
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f%]", lambda m: f"%{ord(m[0]):02X}", url))
    if kind == "revisit":
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (lower-case names) and payload of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in head.decode().split("\r\n")[1:])}
    block = rest[:int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    fields["http-length"] = re.search(rb"(?i)content-length: (\d+)", http)[1].decode()
    return fields, payload


def _writer(folder: str, file_bytes: int):
    def run(batches):
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        out, name, at = None, "", 0
        for batch in batches:
            index = []
            for page_id, url, html, digest, n, kind, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None or at >= file_bytes:
                    if out is not None:
                        out.close()
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0  # an attempt's own file
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                gz = zlib.compressobj(3, zlib.DEFLATED, 31)
                data = gz.compress(_record(page_id, url, (html or "").encode(), digest, n, kind, refers_to)) + gz.flush()
                out.write(data)
                index.append((page_id, name, at, len(data), url, digest, kind))
                at += len(data)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*index) if index else [[]] * 7, _INDEX_TYPES)], names=_INDEX_NAMES)
        if out is not None:
            out.close()
    return run


_INDEX_NAMES = ["page_id", "file", "offset", "length", "url", "digest", "record_type"]
_INDEX_TYPES = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
_RECORD_NAMES = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
_RECORD_TYPES = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]


def record_plan(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Each page with its payload, digest, size and record type: of equal
    payloads of ``min_bytes`` at least, the rows with the largest page_id are
    responses and the others revisit it; all smaller ones are responses."""
    body = text_or_empty("html")
    keyed = pages.select("page_id", "url", body.alias("html"), F.sha1(body.cast("binary")).alias("digest"),
                         F.octet_length(body).cast("long").alias("n_bytes"))
    kept = stage(keyed.filter(F.col("n_bytes") >= min_bytes).groupBy("digest")
                 .agg(F.max("page_id").alias("keep"), F.count("*").alias("n"))
                 .filter("n > 1 and keep is not null").drop("n"), "warc-copies")
    again = F.col("keep").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keep"))
    return (keyed.join(kept, "digest", "left")
            .select("page_id", "url", "html", "digest", "n_bytes",
                    F.when(again, "revisit").otherwise("response").alias("record_type"),
                    F.when(again, F.col("keep")).alias("refers_to")))


def write_archives(pages: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html) into archive
    files under ``folder`` (a URI every executor reaches) and return the index,
    itself written to ``folder``/index.

    A null html is an empty payload, a null url leaves the target out, a null
    page_id is allowed (never revisited); repeated rows give a record each; an
    empty table gives an empty index.
    """
    plan = record_plan(pages)
    plan.mapInArrow(_writer(f"{folder}/archives", file_bytes), INDEX_SCHEMA).write.parquet(f"{folder}/index")
    return pages.sparkSession.read.schema(INDEX_SCHEMA).parquet(f"{folder}/index")


def _reader(folder: str):
    def spans(batches):
        """Runs of index rows (sorted by file and offset) that one read covers."""
        run: list[tuple] = []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length"))):
                if run and (row[0] != run[-1][0] or row[1] - run[-1][1] - run[-1][2] > READ_GAP
                            or row[1] + row[2] - run[0][1] > READ_BYTES):
                    yield run
                    run = []
                run.append(row)
        if run:
            yield run

    def run(batches):
        store, root = fs.FileSystem.from_uri(folder)
        name, source = None, None
        for span in spans(batches):
            if span[0][0] != name:
                if source is not None:
                    source.close()
                name = span[0][0]
                source = store.open_input_file(f"{root}/{name}")
            start = span[0][1]
            data = source.read_at(span[-1][1] + span[-1][2] - start, start)
            rows = []
            for _, offset, length in span:
                fields, payload = parse_record(zlib.decompress(data[offset - start:offset - start + length], 31))
                kind, said = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:")
                if kind == "response" and hashlib.sha1(payload).hexdigest() != said:
                    raise ValueError(f"damaged record at {offset} of {name}")
                page, refers, url = fields.get("x-page-id"), fields.get("warc-refers-to"), fields.get("warc-target-uri")
                rows.append((None if page is None else int(page),
                             None if url is None else re.sub(r"%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), url),
                             len(payload) if kind == "response" else int(fields["http-length"]), said, kind,
                             None if refers is None else page_of(refers)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _RECORD_TYPES)],
                                             names=_RECORD_NAMES)
        if source is not None:
            source.close()
    return run


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """The records that the rows of ``index`` (any selection of it) point to."""
    chunk = F.floor(F.col("offset") / F.lit(READ_BYTES))
    return (index.select("file", "offset", "length").repartition("file", chunk)
            .sortWithinPartitions("file", "offset")
            .mapInArrow(_reader(f"{folder}/archives"), RECORD_SCHEMA))
