"""WARC archives: what is written comes back byte by byte, and equal payloads are stored once."""

import hashlib
import random
from collections import Counter, defaultdict

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from footfall.llm import warc
from footfall.llm.queries import op13_warc
from footfall.session import scratch_dir
from tests.conftest import SF

PAGES = "page_id bigint, url string, html string, digest string, frame string, keeper string, head string, sha1 string"


@pytest.fixture
def make_pages(spark):
    return lambda rows: spark.createDataFrame([(*r, *["x"] * 5) for r in rows], PAGES)


def archived(pages, **options):
    folder = scratch_dir(pages.sparkSession, "test-warc")
    warc.write_archive(pages, folder, **options)
    return folder


def facts(pages):
    folder = archived(pages)
    return Counter((r.page_id, r.n_payload, r.payload_digest, r.record_type, r.refers_to) for r in warc.read_record_facts(pages.sparkSession, folder).collect())


def brute(rows):
    groups = defaultdict(list)
    for page_id, _, html in rows:
        groups[(html or "").encode()].append(page_id)
    result = Counter()
    for payload, ids in groups.items():
        keeper = max((i for i in ids if i is not None), default=None)
        for i in ids:
            again = len(payload) >= 1000 and keeper is not None and i != keeper
            result[(i, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if again else "response", keeper if again else None)] += 1
    return result


def odd_rows():
    rng = random.Random(1)
    long = "<p>é中\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n</p>" * 40
    rows = [(i, f"http://a/{i}", "x" * (998 + i % 4)) for i in range(40)]
    rows += [(100 + i, None, long) for i in range(30)] + [(200, "http://b/\r\nWARC-Type: x", "\r\n\r\n" * 300), (201, "", None), (202, "u", ""), (203, "u", "\r\n")]
    rows += [(None, "u", long), (None, "u", "only null " * 200), (None, "v", "only null " * 200), (300, "u", "twice " * 300), (300, "u", "twice " * 300), (300, "u", "other " * 300), (5, "u", "other " * 300)]
    rows += [(400 + i, "u", "".join(rng.choice("ab\r\n<>é") for _ in range(rng.randrange(3000)))) for i in range(60)]
    return rows + [(-7, "u", "long page " * 500_000), (8, "u", "long page " * 500_000)]


def test_whole_table(spark):
    table = pq.read_table(f"{SF}/pages.parquet").to_pydict()
    got = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in op13_warc(spark, SF).collect())
    assert got == brute(list(zip(table["page_id"], table["url"], table["html"])))


def test_types_and_references(make_pages):
    assert facts(make_pages(odd_rows())) == brute(odd_rows())


def test_a_payload_is_stored_once(make_pages, spark):
    rows = odd_rows()
    folder = archived(make_pages(rows))
    assert spark.read.parquet(f"{folder}/payloads").count() == len({html or "" for _, _, html in rows})
    assert spark.read.parquet(f"{folder}/records").columns == ["head", "digest"]


def test_files_give_back_the_archive(make_pages, spark):
    records = warc.read_archive(spark, archived(make_pages(odd_rows()))).cache()
    folder = scratch_dir(spark, "test-files")
    warc.write_warc(records.repartition(5), folder)
    put = Counter((bytes(r.head) + (bytes(r.payload) if r.record_type == "response" else b"")) for r in records.collect())
    got = warc.read_warc(spark, folder).collect()
    assert Counter(bytes(r.head) + bytes(r.block) for r in got) == put
    for r in got:
        fields = warc.parsed_head(bytes(r.head))
        assert fields["version"] == "WARC/1.1" and int(fields["content-length"]) == len(r.block)


def test_bytes_that_are_no_text_go_through_files(spark):
    head = b"WARC/1.0\r\nWARC-Type: resource\r\nContent-Length: 300\r\n\r\n"
    block = bytes(range(256)) + b"\r\n" * 22
    rows = spark.createDataFrame([("response", bytearray(head), bytearray(block))], "record_type string, head binary, payload binary")
    folder = scratch_dir(spark, "test-binary")
    warc.write_warc(rows, folder)
    assert [(bytes(r.head), bytes(r.block)) for r in warc.read_warc(spark, folder).collect()] == [(head, block)]


@pytest.mark.parametrize("stream", [[b"WARC/1.1\r\nContent-Length: 9", b"abc"], [b"no record", b"x"], [b"WARC/1.1\r\nContent-Length: 1", b"abc", b"WARC/1.1\r\nContent-Length: 0", b""]])
def test_damaged_files_are_refused(stream):
    with pytest.raises(warc.ArchiveError):
        list(warc.warc_records(iter(stream)))


def test_damaged_payloads_are_refused(make_pages, spark):
    folder = archived(make_pages([(1, "u", "a" * 2000), (2, "u", "b" * 2000)]))
    changed = scratch_dir(spark, "test-changed")
    spark.read.parquet(f"{folder}/records").write.parquet(f"{changed}/records")
    stored = spark.read.parquet(f"{folder}/payloads")
    other = stored.agg(F.max("frame")).first()[0]
    stored.withColumn("frame", F.lit(bytearray(other))).write.parquet(f"{changed}/payloads")
    with pytest.raises(Exception, match="damaged payload"):
        warc.read_archive(spark, changed).collect()
    lost = scratch_dir(spark, "test-lost")
    spark.read.parquet(f"{folder}/records").write.parquet(f"{lost}/records")
    stored.limit(1).write.parquet(f"{lost}/payloads")
    with pytest.raises(Exception, match="no payload with digest"):
        warc.read_archive(spark, lost).collect()


def test_two_payloads_of_one_digest_are_refused(make_pages):
    with pytest.raises(warc.ArchiveError):
        archived(make_pages([(1, "u", "aa"), (2, "u", "bb")]), content_hash=lambda payload: F.substring(payload, 9, 1))


def test_empty_table(make_pages):
    assert facts(make_pages([])) == Counter()
