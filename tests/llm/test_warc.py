import hashlib
import time

import pytest
from pyspark.sql import functions as F

from spanloom.llm.common import new_path
from spanloom.llm.warc import dechunk, op1_warc, payload_of, read_archives, reassemble, with_revisits, write_archives

SCHEMA = "id long, url string, payload binary, refers_to string, digest string"


def round_trip(spark, rows, **sizes):
    path = new_path(spark, "warc")
    pages = spark.createDataFrame(rows, SCHEMA).select("id", "url", "payload")
    write_archives(with_revisits(pages), path, **sizes)
    return path, reassemble(read_archives(spark, path))


def test_payloads_come_back_whole(spark):
    odd = b"WARC/1.1\r\nContent-Length: 5\r\n\r\n\r\n\r\n0\r\n\r\n" * 40
    rows = [(1, "http://a/", b"x" * 99, None, None), (2, "http://b/", b"x" * 99, None, None), (3, "u\r\nInjected: 1", odd, None, None), (4, None, odd, None, None), (5, "ü", None, None, None), (6, "", b"", None, None), (7, "v", bytes(range(256)) * 2000, None, None), (8, "w", b"y" * 100, None, None), (9, "w", b"y" * 100, None, None), (9, "w", b"y" * 100, None, None), (10, "w", b"y" * 100, None, None), (None, "n", b"z", None, None)]
    for sizes in ({}, {"segment": 37, "chunk": 10, "per_archive": 50}):
        path, whole = round_trip(spark, rows, **sizes)
        records = whole.collect()
        assert len(records) == len(rows) == len({r["record_id"] for r in records})
        found = {}
        for r in sorted(records, key=lambda r: r["record_id"]):
            found.setdefault(r["record_id"].split(":")[2].split("-")[0], []).append(r)
        assert {k: len(v) for k, v in found.items()} == {**{str(k): 1 for k in range(1, 11)}, "9": 2, "null": 1}
        for i, _, payload, *_ in rows:
            for r in found[str(i) if i else "null"]:
                assert r["payload_digest"] == "sha256:" + hashlib.sha256(payload or b"").hexdigest()
                assert r["payload"] == (None if i in (4, 9, 10) else payload or b"")
        assert {r["refers_to"] for r in found["9"] + found["10"]} == {found["8"][0]["record_id"]}
        assert found["4"][0]["refers_to"] == found["3"][0]["record_id"] and found["2"][0]["refers_to"] is None
    segments = read_archives(spark, path)
    assert segments.where("warc_type = 'continuation'").count() > 100


def test_long_payloads_take_time_in_proportion(spark):
    def seconds(size):
        start = time.perf_counter()
        _, whole = round_trip(spark, [(1, "u", bytes(range(256)) * (size // 256), None, None)])
        assert whole.select(F.octet_length("payload")).collect()[0][0] == size
        return time.perf_counter() - start

    seconds(1 << 20)
    assert seconds(1 << 24) < 8 * seconds(1 << 22) + 2


def test_query_over_repeated_and_null_rows(spark, tmp_path):
    page = "<html>" + "x" * 200
    rows = [(1, "a", page), (1, "a", page), (2, "b", page), (2, "b", page), (None, "c", page), (3, "d", None), (None, None, None), (None, None, None)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    found = sorted((r["page_id"] or 0, r["record_type"], r["refers_to"] or 0, r["payload_bytes"]) for r in op1_warc(spark, f"file://{tmp_path}").collect())
    assert found == [(0, "response", 0, 0), (0, "response", 0, 0), (0, "response", 0, 206), (1, "response", 0, 206), (1, "response", 0, 206), (2, "revisit", 1, 206), (2, "revisit", 1, 206), (3, "response", 0, 0)]


def test_damage_is_told(spark):
    path, _ = round_trip(spark, [(1, "u", b"abc" * 400, None, None)], segment=100)
    records = read_archives(spark, path)
    for damaged in (records.where("segment != 2"), records.where("segment < 5"), records.withColumn("block", F.when(F.col("segment") == 1, F.col("block")).otherwise(F.overlay("block", F.lit(b"Z"), F.lit(50))))):
        with pytest.raises(Exception, match="lacks segments|digest|chunk|invalid literal|ValueError"):
            reassemble(damaged).collect()
    twice = reassemble(records.unionByName(records)).collect()
    assert twice[0]["payload"] == b"abc" * 400


def test_framing():
    assert dechunk(b"4;x=1\r\nWiki\r\nA\r\n0123456789\r\n0\r\nTrailer: x\r\n\r\n") == b"Wiki0123456789"
    assert payload_of(b"HTTP/1.1 200 OK\r\nX: y\r\n\r\nplain") == b"plain"
    with pytest.raises(ValueError, match="short"):
        dechunk(b"5\r\nabc\r\n0\r\n\r\n")


def test_empty_and_query(spark):
    assert round_trip(spark, [])[1].count() == 0
    sf = "/root/testdata/sf0.001"
    pages = {r["page_id"]: (r["html"] or "").encode() for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    first = {}
    for i in sorted(pages):
        first.setdefault(pages[i], i)
    for r in op1_warc(spark, sf).collect():
        p = pages[r["page_id"]]
        again = len(p) >= 100 and first[p] != r["page_id"]
        assert (r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) == (len(p), hashlib.sha256(p).hexdigest(), "revisit" if again else "response", first[p] if again else None)
