"""WARC writing, reading and assembly against the rows themselves."""

import gzip

from pyspark.sql import functions as F

from tessera.llm import queries, warc
from tessera.llm.store import materialise

from ..conftest import SF_SMALL

SCHEMA = "page_id long, url string, html string, file string, sha1 string, transaction string"
TRICKY = "WARC/1.1\r\nWARC-Type: response\r\n\r\n\r\n\r\nWARC/1.1\r\n"


def _rows():
    rows = [(1, "http://a.org/x?q=1#f", "one"), (7, "http://b.org", "one"), (3, None, "one"), (None, "http://c.org/", "one"),
            (4, "no scheme", None), (5, "http://d.org/a b\r\nX: y", ""), (6, "http://ü.org/ä", TRICKY), (8, "", TRICKY + "é" * 50_000),
            (None, None, "only null ids"), (9, "http://e.org", "single"), (10, "http://e.org", "twice"), (10, "http://f.org", "twice")]
    rows += [(20, "http://g.org", "same row")] * 3 + [(19, "http://g.org", "same row")] * 2
    rows += [(100 + i, f"http://h.org/{i}", "hot payload") for i in range(300)]
    return [(*r, "clash", "clash", "clash") for r in rows]


def _expected(rows):
    payload = lambda r: (r[2] or "").encode()
    largest = {}
    for r in rows:
        p = payload(r)
        largest[p] = max(largest.get(p, -1), -1 if r[0] is None else r[0])
    out = []
    for r in rows:
        p = payload(r)
        again = (-1 if r[0] is None else r[0]) != largest[p]
        out.append((r[0], len(p), warc.digest_of(p), "revisit" if again else "response", largest[p] if again else None))
    return sorted(out, key=repr)


def _captures(spark, rows, **options):
    pages = spark.createDataFrame(rows, SCHEMA).repartition(5)
    manifest = warc.write_archives(pages, **options)
    records = materialise(warc.read_records(manifest), "t")
    return manifest, records, warc.assemble(records)


def _digest_rows(captures):
    got = captures.select("key", F.coalesce("response.payload_bytes", "original.payload_bytes"), "response.payload_digest",
                          "record_type", "original.key")
    return sorted((tuple(r) for r in got.collect()), key=repr)


def test_captures_equal_the_rows(spark, monkeypatch):
    rows = _rows()
    manifest, records, captures = _captures(spark, rows)
    assert _digest_rows(captures) == _expected(rows)
    assert manifest.agg(F.sum("n_captures")).first()[0] == len(rows)
    assert records.count() == 3 * len(rows)
    for c in captures.collect():
        assert c.request is not None and c.metadata is not None and c.request.target_uri == c.target_uri
        assert c.request.http_head.startswith("GET ")
    monkeypatch.setattr(warc, "HOT_SHARE", 2)  # nothing but the hot payload by broadcast; then nothing at all
    assert _digest_rows(_captures(spark, rows)[2]) == _expected(rows)
    monkeypatch.setattr(warc, "HOT_SHARE", 1)
    assert _digest_rows(_captures(spark, rows)[2]) == _expected(rows)


def test_files_are_warc_and_payloads_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "READ_BYTES", 700)  # members cross the pieces that are read
    rows = _rows()
    manifest, records, captures = _captures(spark, rows)
    stored = []
    for (file,) in manifest.select("file").collect():
        data = gzip.open(file.removeprefix("file:")).read()
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            n = int(head.decode().split("Content-Length: ")[1].split("\r\n")[0])
            headers, block = warc.parse(head + b"\r\n\r\n" + rest[:n + 4])
            if headers["warc-type"] == "response":
                stored.append(block.partition(b"\r\n\r\n")[2])
            data = rest[n + 4:]
    responses = [r for r in _expected(rows) if r[3] == "response"]
    assert sorted(len(x) for x in stored) == sorted(r[1] for r in responses)
    assert sorted(warc.digest_of(x) for x in stored) == sorted(r[2] for r in responses)
    for c in captures.where("record_type = 'response' and key = 8").collect():
        assert warc.payload_at(c.response.file, c.response.offset).decode() == TRICKY + "é" * 50_000


def test_small_payloads_are_not_revisited(spark):
    rows = _rows()
    got = _digest_rows(_captures(spark, rows, min_revisit_bytes=9)[2])
    want = [r if r[1] >= 9 else (*r[:3], "response", None) for r in _expected(rows)]
    assert got == sorted(want, key=repr)


def test_file_bounds_and_empty_table(spark, monkeypatch):
    assert warc.assemble(warc.read_records(warc.write_archives(spark.createDataFrame([], SCHEMA)))).count() == 0
    from tessera.llm.warc import parse
    import pytest

    for bad in (b"", b"WARC/1.1\r\nContent-Length: 3\r\n\r\nab\r\n\r\n", b"HTTP/1.1\r\nContent-Length: 0\r\n\r\n\r\n\r\n"):
        with pytest.raises(ValueError):
            parse(bad)


def test_op13_query(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet").select("page_id", "url", "html").collect()
    got = queries.op13_warc_captures(spark, SF_SMALL)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == _expected([tuple(r) for r in pages])
