"""Archives: exact round trips, revisits and what foreign readers see."""

import base64
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from flowlark.llm import warc
from flowlark.session import scratch_path

SCHEMA = "page_id long, url string, html string, hit string, `a.b` long, payload string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)


def written(spark, df, **options):
    path = scratch_path(spark, "archives")
    archive = warc.write_archives(df, path, **options)
    return path, warc.joined_revisits(warc.read_archives(spark, path, archive))


def expected(rows, least=0):
    top, out, seen = {}, [], set()
    for key, _, html in rows:
        body = (html or "").encode()
        if len(body) >= least:
            top[body] = max(top.get(body, -1), -1 if key is None else key)
    for key, _, html in sorted(rows, key=repr):
        body = (html or "").encode()
        best = top.get(body, key)
        best = None if best == -1 else best
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        first = len(body) < least or (best == key and body not in seen)
        if first and len(body) >= least:
            seen.add(body)
        out.append((key, len(body), digest, "response" if first else "revisit", None if first else best))
    return sorted(out, key=repr)


def digest_rows(read):
    found = read.select(F.col("page_id").cast("long"), "bytes", "digest", "type", F.col("refers_to").cast("long"))
    return sorted(map(tuple, found.collect()), key=repr)


BORDER = "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nWARC/1.1\r\nArchive-ID: 0\r\n"
ROWS = [
    (1, "http://a/1", "<p>one</p>"), (2, "http://a/2", "<p>one</p>"), (3, "http://a/3", "<p>three</p>"),
    (4, "http://a/ b\r\nWARC-Type: forged\r\n\r\né", "<p>four</p>"),
    (5, None, None), (6, "", ""), (7, "http://a/7", " "), (8, "http://a/8", "a" + BORDER + "b\r\n\r\n"),
    (9, "http://a/9", "tail\r\n\r\n"), (10, "http://a/10", "tail\r\n\r\n"), (11, "u", "é中\U0001f600" * 400),
    (None, "http://n", "null id"), (None, "http://n", "null id"), (None, "http://n", "<p>one</p>"),
    (12, "http://same", "same"), (12, "http://same", "same"), (12, "http://same", "same"),
    (13, "http://x", "tie"), (13, "http://y", "tie"), (14, "http://z", "x" * 300_000),
]


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip(spark, least):
    path, read = written(spark, pages(spark, ROWS), least=least)
    assert digest_rows(read) == expected(ROWS, least)
    got = sorted(r["payload"].decode() for r in read.filter("type = 'response'").select("payload").collect())
    bodies = [h or "" for _, _, h in ROWS]
    want = sorted([b for b in bodies if len(b.encode()) < least] + list({b for b in bodies if len(b.encode()) >= least}))
    assert got == want


def test_headers(spark):
    _, read = written(spark, pages(spark, ROWS))
    rows = read.collect()
    ids = [r.record_id for r in rows]
    assert len(set(ids)) == len(ids)
    at = {r.record_id: r for r in rows}
    for r in rows:
        if r.type == "revisit":
            assert at[r.refers_to_id].type == "response" and at[r.refers_to_id].digest == r.digest
    forged = next(r for r in rows if r.page_id == "4")
    assert forged.uri == "http://a/%20b%0D%0AWARC-Type:%20forged%0D%0A%0D%0Aé"
    assert next(r for r in rows if r.page_id == "5").uri is None


def test_split_reading(spark):
    """Records are found wherever Spark splits a file."""
    rows = [(i, f"http://a/{i}", f"{i % 50}WARC/1.1\r\n" + "y" * (i * 37 % 900) + "\r\n" * (i % 7)) for i in range(400)]
    path = scratch_path(spark, "archives")
    archive = warc.write_archives(pages(spark, rows).coalesce(1), path)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    want = expected(rows)
    try:
        for part in (5000, 4099, 777):
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(part))
            read = warc.read_archives(spark, path, archive)
            assert read.rdd.getNumPartitions() > 20
            assert digest_rows(warc.joined_revisits(read)) == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def plain_records(raw):
    """Records by their lengths alone, as any reader finds them."""
    at = 0
    while at < len(raw):
        head, _, _ = raw[at:].partition(b"\r\n\r\n")
        assert head.startswith(b"WARC/1.1\r\n")
        fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
        start = at + len(head) + 4
        at = start + int(fields[b"Content-Length"])
        assert raw[at : at + 4] == b"\r\n\r\n"
        yield fields, raw[start:at]
        at += 4


def test_any_reader_finds_the_records(spark):
    path, read = written(spark, pages(spark, ROWS))
    found = []
    for name in os.listdir(path):
        if name.startswith("part-"):
            with open(os.path.join(path, name), "rb") as file:
                found += plain_records(file.read())
    kinds = sorted(f[b"WARC-Type"].decode() for f, _ in found)
    assert kinds == sorted([r.type for r in read.select("type").collect()] + ["warcinfo"])
    for fields, block in found:
        if fields[b"WARC-Type"] == b"response":
            body = block.partition(b"\r\n\r\n")[2]
            digest = b"sha1:" + base64.b32encode(hashlib.sha1(body).digest())
            assert fields[b"WARC-Payload-Digest"] == digest


def test_foreign_border_raises(spark):
    path = scratch_path(spark, "archives")
    warc.write_archives(pages(spark, [(8, "u", "a" + BORDER + "b")]), path)
    with pytest.raises(Exception, match="does not have its length"):
        warc.read_archives(spark, path).collect()


def test_many_copies(spark):
    """A bitmap of many revisits, hit by pages that are none of them."""
    rows = [(i, "http://c", "copy" if i % 3 else f"own {i}") for i in range(3000)]
    _, read = written(spark, pages(spark, rows))
    assert digest_rows(read) == expected(rows)


def test_false_hits_are_written(spark, monkeypatch):
    monkeypatch.setattr(warc, "MOST_BITS", warc.BUCKET_BITS)
    rows = [(i, "http://c", f"copy {i % 9000}") for i in range(30_000)]
    _, read = written(spark, pages(spark, rows))
    assert digest_rows(read) == expected(rows)


def test_empty_table(spark):
    _, read = written(spark, pages(spark, ROWS).filter("false"))
    assert read.count() == 0
