import collections
import gzip
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from studylake.llm import warc
from studylake.llm.queries import QUERIES


def brute(rows):
    """{(key, payload): (bytes, digest, kind, refers to)}"""
    copies = collections.defaultdict(list)
    for key, html in rows:
        copies[(html or "").encode()].append(key)
    out = {}
    for key, html in rows:
        payload = (html or "").encode()
        known = [k for k in copies[payload] if k is not None]
        stored = max(known) if known and len(copies[payload]) > 1 and len(payload) >= 1000 else key
        out[key, html] = (len(payload), hashlib.sha1(payload).hexdigest(),
                          "response" if stored == key else "revisit",
                          None if stored == key else stored)
    return out


def test_query_equals_brute_force(spark, small, table):
    rows = [(r["page_id"], r["html"]) for r in table("pages")]
    wanted = {k: v for (k, _), v in brute(rows).items()}
    found = QUERIES["op4_warc"](spark, small).collect()
    assert len(found) == len(rows)
    for r in found:
        assert tuple(r)[1:] == wanted[r["page_id"]]


@pytest.fixture
def pages(spark):
    def make(rows):
        return spark.createDataFrame(
            [(k, f"http://h/{k}\r\nX: y" if k == 3 else None if k == 4 else f"http://h/{k}", h, "extra")
             for k, h in rows], "page_id long, url string, html string, payload string")
    return make


ROWS = [
    (1, "é" * 500), (2, "é" * 500), (3, "x" * 999), (4, "x" * 999), (5, None), (6, ""), (7, None),
    (8, "y\r\n\r\n" * 400), (9, "y\r\n\r\n" * 400), (None, "y\r\n\r\n" * 400), (None, "z"),
    (10, "é" * 500), (12, "WARC/1.1\r\n" * 200), (13, "q" * 300_000), (14, "q" * 300_000),
]


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_round_trip(spark, pages, tmp_path, compression):
    path = str(tmp_path / "archive")
    warc.write_warc(warc.plan_records(pages(ROWS)), path, compression, roll_bytes=2000)
    wanted = brute(ROWS)
    rows = warc.read_warc(spark, path, split_bytes=3000).collect()
    assert len(rows) == len(ROWS)
    texts = {k: h or "" for k, h in ROWS if k is not None}
    for r in rows:
        key = r["record_id"].removeprefix("urn:page:")
        if key == "null":
            continue
        size, digest, kind, refers = wanted[int(key), dict(ROWS)[int(key)]]
        assert (r["payload_bytes"], r["payload_digest"], r["record_type"]) == (size, digest, kind)
        assert r["refers_to"] == (refers and f"urn:page:{refers}")
        assert bytes(r["payload"]) == (texts[int(key)].encode() if kind == "response" else b"")
    kinds = {r["record_type"] for r in rows if r["record_id"] == "urn:page:null"}
    assert kinds == {"revisit", "response"}
    assert next(r for r in rows if r["record_id"] == "urn:page:3")["target_uri"] == "http://h/3  X: y"
    assert next(r for r in rows if r["record_id"] == "urn:page:4")["target_uri"] is None


def test_plain_gzip_members_of_others_are_read(spark, tmp_path):
    fields = {"record_type": "response", "target_uri": "http://a", "date": "d", "refers_to": None}
    records = [warc.encode_record(fields | {
        "record_id": f"urn:page:{i}", "payload": b"p" * i * 70_000, "payload_bytes": i * 70_000,
        "payload_digest": hashlib.sha1(b"p" * i * 70_000).hexdigest()}) for i in range(5)]
    (tmp_path / "other.warc.gz").write_bytes(b"".join(map(gzip.compress, records)))
    rows = warc.read_warc(spark, str(tmp_path)).collect()
    assert sorted(len(r["payload"]) for r in rows) == [i * 70_000 for i in range(5)]
    assert all(hashlib.sha1(r["payload"]).hexdigest() == r["payload_digest"] for r in rows)
    assert warc.read_warc(spark, str(tmp_path), payload="none").filter("payload is null").count() == 5


def test_header_predicates_are_pushed(spark, pages, tmp_path):
    path = str(tmp_path / "archive")
    warc.write_warc(warc.plan_records(pages(ROWS)), path)
    df = warc.read_warc(spark, path)
    found = df.filter((F.col("record_type") == "revisit") & F.col("record_id").startswith("urn:page:"))
    # a pushed filter is not evaluated again above the scan
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"\bFilter \(", plan)
    assert {r["record_id"] for r in found.collect()} == {
        "urn:page:1", "urn:page:2", "urn:page:8", "urn:page:null", "urn:page:13"}
    assert df.filter(F.col("record_id").isin("urn:page:5", "urn:page:7", "no")).count() == 2
    assert df.filter(F.col("refers_to").isNotNull()).count() == 5
    assert df.filter(F.col("payload_bytes") > 1000).count() == 3 + 2 + 1


def test_unwanted_payloads_are_not_inflated():
    big = random.Random(1).randbytes(3_000_000)
    fields = {"record_type": "response", "target_uri": "u", "date": "d", "refers_to": None,
              "record_id": "r", "payload": big, "payload_bytes": len(big), "payload_digest": None}
    data = warc.compress_record(warc.encode_record(fields)) * 3

    class Counting:
        def __init__(self):
            self.at, self.read_bytes = 0, 0

        def seek(self, at):
            self.at = at

        def tell(self):
            return self.at

        def read(self, n):
            out = data[self.at:self.at + n]
            self.at += len(out)
            self.read_bytes += len(out)
            return out

    file = Counting()
    assert len(list(warc.read_gzip(file, len(data), warc._Wanted([], frozenset())))) == 3
    assert file.read_bytes < 0.1 * len(data)


def test_files_of_lost_tasks_are_ignored(spark, pages, tmp_path):
    path = tmp_path / "archive"
    warc.write_warc(warc.plan_records(pages(ROWS)), str(path))
    (path / "left-over.warc.gz").write_bytes(b"\x1f\x8b broken")
    assert warc.read_warc(spark, str(path)).count() == len(ROWS)


def test_empty_table(spark, pages, tmp_path):
    path = str(tmp_path / "archive")
    warc.write_warc(warc.plan_records(pages([])), path)
    assert warc.read_warc(spark, path).count() == 0
