"""WARC archives of pages: written, parsed, and assembled into captures.

Each page is one transaction of three records in a gzipped WARC 1.1 file (one
gzip member a record): a ``response`` with the payload, or a ``revisit`` of an
equal payload that is stored elsewhere; the ``request``; and ``metadata``. The
last two name the first by ``WARC-Concurrent-To``. Reading parses the files
into a table of records, joins request and metadata to their response or
revisit through that identifier and gives one nested row per capture; a
revisit finds its original through ``WARC-Refers-To``.

Of rows with equal payloads of at least ``min_revisit_bytes`` bytes, that with
the largest key is the response, the others revisit it. A payload or original
that holds a large share of all rows is looked up by broadcast (at most
``HOT_SHARE`` of them can exist), the others by a shuffled join.

Defined cases: a null payload is empty; a null key sorts below all others and
is read back as null; a null url gives records without ``WARC-Target-URI``;
white space and control characters of a url are percent-encoded in headers;
rows that tie on the largest key are all responses, and rows that repeat give
records that repeat, with equal identifiers, each of which is read back;
payloads may hold any text, record headers and line ends included; an empty
table gives an empty manifest and no captures; other columns are ignored
whatever their names. A payload whose digest differs from its header raises.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .store import file_system, materialise, prepare, unique_file

FILE_BYTES = 128 << 20  # of records before compression; a file is closed after the capture that passes it
READ_BYTES = 1 << 20
BATCH_RECORDS = 2_000
HOT_SHARE = 1_000  # a key is hot if it holds more than one in this many rows
DATE = "2000-01-01T00:00:00Z"
MANIFEST = "file string, n_captures long, n_bytes long"

RECORDS = pa.schema([
    ("file", pa.string()), ("offset", pa.int64()), ("type", pa.string()), ("record_id", pa.string()), ("transaction", pa.string()),
    ("nth", pa.int64()), ("refers_to", pa.string()), ("target_uri", pa.string()), ("date", pa.string()), ("http_head", pa.string()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("fields", pa.map_(pa.string(), pa.string()))])
RECORDS_DDL = ("file string, offset long, type string, record_id string, transaction string, nth long, refers_to string, target_uri string, "
               "date string, http_head string, payload_bytes long, payload_digest string, fields map<string,string>")

_UNSAFE = re.compile(r"[\x00-\x20\x7f-\x9f]")
_HOST = re.compile(r"^[^:]*://([^/?#]*)([^#]*)")


def digest_of(payload: bytes) -> str:
    """Upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(*parts: object) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(repr(parts).encode()).digest()[:16])}>"


def _safe(url: str) -> str:
    return _UNSAFE.sub(lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url)


def _member(kind: str, headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    """One record as a gzip member."""
    lines = [f"{k}: {v}" for k, v in [("WARC-Type", kind), *headers, ("Content-Length", str(len(block)))] if v is not None]
    z = zlib.compressobj(3, zlib.DEFLATED, 31)
    return z.compress("\r\n".join(["WARC/1.1", *lines, "", ""]).encode()) + z.compress(block) + z.compress(b"\r\n\r\n") + z.flush()


def _capture(key: int | None, url: str | None, payload: bytes, digest: str, revisit: bool, original: int | None, date: str) -> list[bytes]:
    """The records of one transaction."""
    uri = None if url is None else _safe(url)
    common = [("WARC-Date", date), ("WARC-Target-URI", uri)]
    stored = [*common, ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http;msgtype=response")]
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if revisit:
        own = _urn("revisit", key, url, digest)
        first = _member("revisit", [("WARC-Record-ID", own), *stored, ("WARC-Refers-To", _urn("response", original, digest)),
                                    ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")], head)
    else:
        own = _urn("response", key, digest)
        first = _member("response", [("WARC-Record-ID", own), *stored], head + payload)
    at = _HOST.match(uri or "")
    ask = f"GET {(at and at[2]) or '/'} HTTP/1.1\r\nHost: {at[1] if at else ''}\r\n\r\n".encode()
    fields = b"" if key is None else f"page-id: {key}\r\n".encode()
    return [first,
            _member("request", [("WARC-Record-ID", _urn("request", own, url)), *common, ("WARC-Concurrent-To", own),
                                ("Content-Type", "application/http;msgtype=request")], ask),
            _member("metadata", [("WARC-Record-ID", _urn("metadata", own, url)), *common, ("WARC-Concurrent-To", own),
                                 ("Content-Type", "application/warc-fields")], fields)]


def _lookup(rows: DataFrame, key: str, table: DataFrame, total: Column) -> DataFrame:
    """``rows`` left-joined with ``table``, which has each ``key`` once and in
    ``_n`` the number of rows that have it. Keys with more than one in
    ``HOT_SHARE`` of ``total`` rows, so fewer than ``HOT_SHARE`` keys, are
    broadcast and their rows spread over the join of the others."""
    values = [c for c in table.columns if c not in (key, "_n")]
    is_hot = F.col("_n") * HOT_SHARE > total
    hot = table.where(is_hot).select(F.col(key).alias("_hot"), F.struct(*values).alias("_near"))
    rest = table.where(~is_hot).select(F.col(key).alias("_cold"), F.struct(*values).alias("_far"))
    rows = rows.join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left")
    plain = [c for c, t in rows.dtypes if "map<" not in t and t != "binary"]
    # no key of ``table`` starts with the mark, so these rows meet none
    rows = rows.withColumn("_at", F.when(F.col("_hot").isNull() & F.col(key).isNotNull(), F.col(key))
                           .otherwise(F.concat(F.lit("-"), F.xxhash64(*plain).cast("string"))))
    rows = rows.join(rest, F.col("_at") == F.col("_cold"), "left")
    out = rows.withColumn("_value", F.coalesce("_near", "_far"))
    return out.select(*[c for c in out.columns if c not in ("_hot", "_near", "_at", "_cold", "_far", "_value")],
                      *[F.col(f"_value.{v}").alias(v) for v in values])


def write_archives(pages: DataFrame, folder: str | None = None, key: str = "page_id", url: str = "url", payload: str = "html",
                   min_revisit_bytes: int = 0, date: str = DATE) -> DataFrame:
    """Write a transaction per row; returns the manifest (one row per file).
    What a failed or repeated task attempt wrote is not in it."""
    spark = pages.sparkSession
    prepare(spark)
    folder = folder or scratch_path(spark, "warc")
    fs, path = file_system(folder)
    fs.create_dir(path, recursive=True)
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(key).cast("long").alias("key"), F.col(url).cast("string").alias("url"), body.alias("payload"))
    rows = rows.withColumn("sha1", F.sha1("payload"))
    # payloads that occur more than once: their largest key and how often they occur
    shared = rows.where(F.octet_length("payload") >= min_revisit_bytes).groupBy("sha1").agg(
        F.max("key").alias("original"), F.count("*").alias("_n")).where("_n > 1").withColumn("known", F.lit(True))
    shared = materialise(shared, "warc-shared")
    rows = _lookup(rows, "sha1", shared, rows.select(F.count("*")).scalar())
    revisit = F.coalesce("known", F.lit(False)) & ~F.col("key").eqNullSafe(F.col("original"))
    rows = rows.select("key", "url", "payload", "sha1", revisit.alias("revisit"), "original")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size, done, file = None, 0, 0, None

        def closed() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pydict({"file": [file], "n_captures": pa.array([done], pa.int64()), "n_bytes": pa.array([size], pa.int64())})

        for batch in batches:
            for one in zip(*[batch.column(i) for i in range(6)]):
                k, u, data, sha1, again, original = (x.as_py() for x in one)
                if out is None:
                    file = unique_file(folder, ".warc.gz")
                    fs, path = file_system(file)
                    out, size, done = fs.open_output_stream(path, compression=None), 0, 0
                    out.write(_member("warcinfo", [("WARC-Record-ID", _urn("file", file)), ("WARC-Date", date),
                                                   ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
                digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                for member in _capture(k, u, data, digest, again, original, date):
                    out.write(member)
                size, done = size + len(data) + 1_500, done + 1  # heads and headers count too
                if size >= FILE_BYTES:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    return materialise(rows.mapInArrow(write, MANIFEST), "warc-manifest")


def _members(stream) -> Iterator[tuple[int, bytes]]:
    """(offset, content) of each gzip member, read in pieces."""
    at, data = 0, stream.read(READ_BYTES)
    while data:
        z, parts, begin = zlib.decompressobj(31), [], at
        while not z.eof:
            if not data:
                raise ValueError(f"archive ends inside the record at {begin}")
            parts.append(z.decompress(data))
            at += len(data) - len(z.unused_data)
            data = z.unused_data if z.eof else stream.read(READ_BYTES)
        yield begin, b"".join(parts)
        data = data or stream.read(READ_BYTES)


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and block of one record."""
    head, mark, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    headers = {k.lower(): v for k, v in (line.split(": ", 1) for line in lines[1:])}
    n = int(headers.get("content-length", -1))
    if not mark or not lines[0].startswith("WARC/") or len(rest) != n + 4 or rest[n:] != b"\r\n\r\n":
        raise ValueError("not a WARC record")
    return headers, rest[:n]


def _row(file: str, offset: int, raw: bytes, seen: Counter) -> dict | None:
    h, block = parse(raw)
    kind = h["warc-type"]
    if kind not in ("response", "revisit", "request", "metadata"):
        return None
    transaction = h.get("warc-concurrent-to") or h["warc-record-id"]
    part = "capture" if kind in ("response", "revisit") else kind
    nth = seen[part, transaction]
    seen[part, transaction] += 1
    row = {"file": file, "offset": offset, "type": kind, "record_id": h["warc-record-id"], "transaction": transaction, "nth": nth,
           "refers_to": h.get("warc-refers-to"), "target_uri": h.get("warc-target-uri"), "date": h.get("warc-date")}
    if kind == "metadata":
        row["fields"] = [tuple(line.split(": ", 1)) for line in block.decode().split("\r\n") if line]
        return row
    head, _, payload = block.partition(b"\r\n\r\n")
    row["http_head"] = head.decode()
    if kind != "request":
        declared = h["warc-payload-digest"].removeprefix("sha1:")
        if kind == "response":
            row["payload_bytes"] = len(payload)
            if digest_of(payload) != declared:
                raise ValueError(f"{file}: payload of the record at {offset} differs from its digest")
        row["payload_digest"] = declared
    return row


def read_records(manifest: DataFrame) -> DataFrame:
    """All records of the files (``RECORDS``), payloads by their place, size and
    checked digest. ``transaction`` is the identifier of the response or
    revisit that a record belongs to, ``nth`` counts records of one kind and
    transaction within a file, so that repeated ones stay apart."""
    spark = manifest.sparkSession
    prepare(spark)
    tasks = max(1, manifest.count())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column("file").to_pylist():
                fs, path = file_system(file)
                seen: Counter = Counter()  # of one file, whose size is bounded
                rows: list[dict] = []
                with fs.open_input_stream(path, compression=None) as stream:
                    for offset, raw in _members(stream):
                        row = _row(file, offset, raw, seen)
                        if row:
                            rows.append(row)
                        if len(rows) >= BATCH_RECORDS:
                            yield pa.RecordBatch.from_pylist(rows, RECORDS)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, RECORDS)

    return manifest.select("file").repartitionByRange(tasks, "file").mapInArrow(read, RECORDS_DDL)


def payload_at(file: str, offset: int) -> bytes:
    """The payload of the response at a place that ``read_records`` gives."""
    fs, path = file_system(file)
    with fs.open_input_file(path) as f:
        f.seek(offset)
        _, raw = next(_members(f))
    return parse(raw)[1].partition(b"\r\n\r\n")[2]


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: key, type ('response' or 'revisit'), target
    uri and date; ``request``, ``response`` and ``metadata`` as structs (null
    where the archive has none); ``original``: for a revisit, key, place, size
    and digest of the response that it refers to. Repeated records of a
    transaction meet in their order. Read several times: give it materialised."""
    same = ["file", "transaction", "nth"]
    captures = records.where(F.col("type").isin("response", "revisit")).select(
        *same, F.col("type").alias("record_type"), "target_uri", "date", "refers_to",
        F.struct("record_id", "file", "offset", "http_head", "payload_bytes", "payload_digest").alias("response"))
    asked = records.where("type = 'request'").select(*same, F.struct("record_id", "target_uri", "http_head").alias("request"))
    notes = records.where("type = 'metadata'").select(*same, F.struct("record_id", "fields").alias("metadata"))
    captures = captures.join(asked, same, "left").join(notes, same, "left")
    captures = captures.withColumn("key", F.col("metadata.fields")["page-id"].cast("long"))
    captures = materialise(captures, "warc-captures")
    asks = captures.where("record_type = 'revisit'").groupBy(F.col("refers_to").alias("_to")).agg(F.count("*").alias("_n"))
    stored = captures.where("record_type = 'response'").groupBy(F.col("response.record_id").alias("_id")).agg(
        F.min(F.struct("key", "response.file", "response.offset", "response.payload_bytes", "response.payload_digest")).alias("original"))
    table = asks.join(stored, F.col("_to") == F.col("_id")).select(F.col("_to").alias("refers_to"), "_n", "original")
    return _lookup(captures, "refers_to", table, captures.select(F.count("*")).scalar())
