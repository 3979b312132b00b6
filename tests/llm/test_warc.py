import base64
import gzip
import hashlib
import io
import uuid
from collections import defaultdict

import pytest

from millrace.llm import queries, warc
from millrace.llm.warc import pages_to_warc, read_pages, records, register
from millrace.session import scratch_root


def brute(rows, least=0):
    groups = defaultdict(list)
    payloads = [(h or "").encode() for _, h in rows]
    for i, (page, _) in enumerate(rows):
        groups[payloads[i]].append((page is None, page or 0, i))
    out = []
    for i, (page, _) in enumerate(rows):
        first = min(groups[payloads[i]])
        revisit = len(payloads[i]) >= least and first[2] != i
        digest = base64.b32encode(hashlib.sha1(payloads[i]).digest()).decode()
        out.append((page, len(payloads[i]), digest, "revisit" if revisit else "response", (None if first[0] else first[1]) if revisit else None))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


def new_path(spark):
    return f"{scratch_root(spark).rstrip('/')}/warc-test-{uuid.uuid4().hex}"


def test_query_equals_brute_force(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "html").collect()]
    assert found(queries.QUERIES["op13_warc"](spark, folder)) == brute(rows)


ODD = [
    (1, "http://a/ b\r\nX: y", "same"), (2, None, "same"), (0, "http://c", "same"), (None, "http://d", "same"), (3, "u", None), (4, "u", ""), (4, "u", ""), (None, None, None),
    (5, "u", "\r\n\r\nWARC/1.1\r\n\r\né日本" * 3), (6, "u", "long " * 400_000), (7, "u", "long " * 400_000), (None, "v", "alone"), (None, "v", "twins"), (None, "w", "twins"), (-9, "u", "q"), (-9, "u", "q"),
]
SCHEMA = "page_id bigint, url string, html string"


@pytest.mark.parametrize("least", [0, 5])
def test_odd_pages(spark, least):
    df = spark.createDataFrame(ODD, SCHEMA).selectExpr("*", "1 as row", "'s' as sha", "2 as bytes", "3 as payload", "'t' as target_uri", "4 as of", "5 as first_row")
    path = new_path(spark)
    pages_to_warc(df, path, least)
    assert found(read_pages(spark, path)) == brute([(p, h) for p, _, h in ODD], least)


def test_empty_table(spark):
    path = new_path(spark)
    pages_to_warc(spark.createDataFrame([], SCHEMA), path)
    assert read_pages(spark, path).collect() == []


def test_many_files_and_appending(spark, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 300)
    path = new_path(spark)
    rows = [(i, f"http://h/{i}", f"page {i % 7} " * 20) for i in range(40)]
    half = spark.createDataFrame(rows, SCHEMA)
    pages_to_warc(half, path)
    register(spark)
    frame = spark.read.format("warc").load(path)
    assert frame.select("file").distinct().count() > 5
    assert found(read_pages(spark, path)) == brute([(p, h) for p, _, h in rows])
    pages_to_warc(half, path)
    assert spark.read.format("warc").load(path).count() == 80


def test_predicates_reach_the_reader_and_spark_agrees(spark, capsys):
    path = new_path(spark)
    pages_to_warc(spark.createDataFrame(ODD, SCHEMA), path)
    register(spark)
    all_rows = spark.read.format("warc").load(path).collect()
    for where, test in (
        ("record_type = 'revisit'", lambda r: r["record_type"] == "revisit"),
        ("record_type in ('response', 'x') and target_uri = 'u'", lambda r: r["record_type"] == "response" and r["target_uri"] == "u"),
        ("target_uri is null", lambda r: r["target_uri"] is None),
        ("refers_to is not null and record_id like 'urn:page:4%'", lambda r: r["refers_to"] and r["record_id"].startswith("urn:page:4")),
        ("headers['WARC-Type'] = 'revisit'", lambda r: r["record_type"] == "revisit"),
        ("content_length > 1000 and record_type = 'response'", lambda r: r["content_length"] > 1000 and r["record_type"] == "response"),
        ("payload_bytes = 4 and record_type <=> 'revisit'", lambda r: r["payload_bytes"] == 4 and r["record_type"] == "revisit"),
    ):
        got = sorted(r["record_id"] for r in spark.read.format("warc").load(path).where(where).collect())
        assert got == sorted(r["record_id"] for r in all_rows if test(r)), where
    capsys.readouterr()
    spark.read.format("warc").load(path).where("record_type = 'revisit'").explain("formatted")
    plan = capsys.readouterr().out
    assert "PushedFilters: [IsNotNull(record_type), EqualTo(record_type,revisit)]" in plan and "Condition :" not in plan


def archive(items):
    return b"".join(warc.member(warc.record("response", f"urn:page:{i}:0", "u", warc.base32_sha1(p), p, "1970-01-01T00:00:00Z")) for i, p in items)


def test_unwanted_payloads_stay_undecoded():
    from pyspark.sql.datasource import EqualTo

    items = [(i, hashlib.sha512(str(i).encode()).hexdigest().encode() * 4000) for i in range(10)]
    data = archive(items)
    wanted, count = warc.Wanted(), {}
    wanted.filters.append(EqualTo(("record_id",), "urn:page:3:0"))
    got = list(records(io.BytesIO(data), len(data), "f", ["record_id", "payload"], wanted, count))
    assert [r["payload"] for r in got] == [items[3][1]]
    assert count["members"] == 10 and count["decoded"] < 2 * len(items[3][1])
    count = {}
    assert len(list(records(io.BytesIO(data), len(data), "f", ["record_id", "payload_bytes"], warc.Wanted(), count))) == 10
    assert count["decoded"] < 40_000


def test_members_of_other_writers_are_read():
    items = [(1, b"one" * 5000), (2, b""), (3, b"three")]
    data = b"".join(gzip.compress(warc.record("response", f"urn:page:{i}:0", "u", "D", p, "1970-01-01T00:00:00Z")) for i, p in items)
    got = list(records(io.BytesIO(data), len(data), "f", ["record_id", "payload"], warc.Wanted()))
    assert [(r["record_id"], r["payload"]) for r in got] == [(f"urn:page:{i}:0", p) for i, p in items]
    plain = b"".join(gzip.decompress(x) for x in [archive(items)])
    assert plain.count(b"WARC/1.1\r\n") == 3 and gzip.decompress(archive(items)) == plain


def test_cut_off_files_are_refused():
    data = archive([(1, b"abc" * 50_000)])
    with pytest.raises(ValueError):
        list(records(io.BytesIO(data[:-200]), len(data) - 200, "f", ["payload"], warc.Wanted()))


def test_folded_headers_and_other_records():
    head = b"WARC/1.0\r\nWARC-Type: metadata\r\nWARC-Record-ID: <urn:uuid:1>\r\nX-Long: a\r\n b\r\nContent-Type: text/plain\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    data = gzip.compress(head)
    (got,) = records(io.BytesIO(data), len(data), "f", ["record_type", "record_id", "payload", "headers", "payload_bytes"], warc.Wanted())
    assert got["payload"] == b"hello" and got["payload_bytes"] == 5 and got["headers"]["X-Long"] == "a b" and got["record_id"] == "urn:uuid:1"
