import base64
import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from tickflow.llm.warc import read_warc, write_warc
from tickflow.session import scratch_path


def record(body, n=None):
    size = len(body) if n is None else n
    return (
        "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x-page:99>\r\n"
        f"Content-Length: {size}\r\n\r\n{body}\r\n\r\n"
    )


PAGES = [
    (1, "http://a b", "plain é"),
    (2, None, None),
    (3, "u", "x WARC/1.0\r\ny"),
    (4, "u", "WARC/1.0\r\n"),
    (5, "u", record("HTTP/1.1 200 OK\r\n\r\ninner") + record("zz")),
    (6, "u", "pre" + record("q", 5000) + "post"),
    (7, "u", "plain é"),
    (8, "u", ""),
    (9, "u", "a" * 5000),
    (9, "u", "a" * 5000),
    (None, "u", "null id"),
    (None, "u", "plain é"),
    (10, "u", "a" * 5000),
    (11, "u", "\r\n\r\n"),
    (12, "u", "tail\r\nWARC/1.0\r\nWARC-Type: x\r\nContent-Length: 0\r\n\r\n"),
    (13, "u", "WARC/1.0\r\n" * 300),
    (14, "u", "end"),
]
SCHEMA = "page_id long, url string, html string, _id long, value string"


def expected(least):
    groups = defaultdict(list)
    for i, _, html in PAGES:
        groups[html or ""].append(i)
    for i, _, html in PAGES:
        raw = (html or "").encode()
        top = max((x for x in groups[html or ""] if x is not None), default=None)
        revisit = i != top and len(raw) >= least
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        kind = "revisit" if revisit else "response"
        yield i, kind, top if revisit else None, len(raw), digest, True


def round_trip(spark, pages, **options):
    path = scratch_path(spark, "warc")
    write_warc(pages, path, **options)
    got = read_warc(spark, path).drop("url").collect()
    columns = ("record_type", "refers_to", "payload_bytes", "payload_digest", "intact")
    return path, sorted(((r.page_id, *(r[c] for c in columns)) for r in got), key=str)


def test_magic_in_payloads_and_split_archives(spark):
    pages = spark.createDataFrame([(*p, 5, "v") for p in PAGES], SCHEMA).repartition(3)
    for size, least in (("2k", 0), ("128m", 100)):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            _, got = round_trip(spark, pages, records_per_file=5, least_bytes=least)
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert got == sorted(expected(least), key=str)


def test_files_follow_the_format(spark):
    pages = spark.createDataFrame([(*PAGES[0], 5, "v"), (*PAGES[6], 5, "v")], SCHEMA).coalesce(1)
    path, _ = round_trip(spark, pages)
    raw = b"".join(bytes(r.content) for r in spark.read.format("binaryFile").load(path).collect())
    while raw:
        head, _, rest = raw.partition(b"\r\n\r\n")
        assert head.startswith(b"WARC/1.0\r\nWARC-Type: re")
        size = int(head.rpartition(b"Content-Length: ")[2])
        assert rest[size : size + 4] == b"\r\n\r\n"
        raw = rest[size + 4 :]


def test_damage_shows(spark):
    path = scratch_path(spark, "warc")
    bad = record("HTTP/1.1 200 OK\r\n\r\nbody").replace(
        "Content-Length", "WARC-Payload-Digest: sha1:AAAA\r\nContent-Length"
    )
    spark.createDataFrame([(bad[:-4],)], "value string").write.option("lineSep", "\r\n\r\n").text(path)
    row = read_warc(spark, path).first()
    assert (row.page_id, row.payload_bytes, row.intact) == (99, 4, False)


def test_empty(spark):
    assert round_trip(spark, spark.createDataFrame([], SCHEMA))[1] == []


def test_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    _, got = round_trip(spark, pages.union(pages.withColumn("page_id", F.col("page_id") + 1000)))
    assert sum(row[1] == "revisit" for row in got) == pages.count()
    assert all(row[5] for row in got)
