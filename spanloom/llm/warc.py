"""WARC archives: segmented records, revisits, and reassembly."""

from __future__ import annotations

import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanloom.llm.common import new_path, table, written

VERSION, END = "WARC/1.1", "\r\n\r\n"
SEGMENT, CHUNK, PER_ARCHIVE, LEAST_REVISIT = 1 << 16, 1 << 13, 1 << 11, 100
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PARSED = "record_id string, warc_type string, target_uri string, refers_to string, payload_digest string, origin_id string, segment int, total_length long, block binary"


def _cut(data, at, size):
    """The parts of a binary column of at most ``size`` bytes, in order; one empty part if it is empty."""
    n = F.greatest(F.ceil(F.octet_length(data) / size), F.lit(1)).cast("int")
    return F.transform(F.sequence(F.lit(1), n), lambda i: at(F.substring(data, (i - 1) * size + 1, F.lit(size)), i))


def _numbered(records: DataFrame, digest: Column) -> DataFrame:
    """``records`` with ``copy``: 1, or the number among rows that repeat id and digest. Only those are shuffled."""
    keyed = records.withColumn("_digest", digest)
    pair = F.struct(F.col("id"), F.col("_digest"))
    times = written(keyed.groupBy(pair.alias("_pair")).agg(F.count(F.lit(1)).alias("_times")).where("_times > 1"), "repeated")
    marked = keyed.withColumn("_pair", pair).join(times, "_pair", "left")
    once = marked.where("_times is null").withColumn("copy", F.lit(1))
    more = marked.where("_times is not null").withColumn("copy", F.row_number().over(Window.partitionBy("_pair").orderBy("url")))
    return once.unionByName(more).select(*records.columns, "copy")


def write_archives(records: DataFrame, path: str, segment: int = SEGMENT, chunk: int = CHUNK, per_archive: int = PER_ARCHIVE) -> None:
    """Write ``records(id, url, payload, refers_to)`` as gzipped WARC files under ``path``.

    ``payload`` is binary (null: empty). A record whose ``refers_to`` is null is a
    response with an HTTP block in chunked framing, spread over segments of
    ``segment`` bytes; others are revisits of the equal payload of the record they
    name, with headers alone. An archive holds up to ``per_archive`` segments, so
    its size is bounded. Spark's text writer sets them down: the path can be in any
    store that Spark reaches. Every row is a record: its identifier is made of its
    id (a null one is written as ``null``), its digest and, where rows repeat both,
    its number among those.
    """
    body = F.coalesce(F.col("payload"), F.lit(b""))
    # bytes are joined as strings, which keep them as they are, in one pass
    chunks = F.filter(_cut(body, lambda part, _: part, chunk), lambda part: F.octet_length(part) > 0)
    framed = F.concat(F.array_join(F.transform(chunks, lambda part: F.concat(F.lower(F.hex(F.octet_length(part))), F.lit("\r\n"), part.cast("string"), F.lit("\r\n"))), "").cast("binary"), F.lit(b"0\r\n\r\n"))
    head = F.lit(b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n")
    digest = F.sha2(body, 256)
    urn = lambda c: F.concat(F.lit("urn:record:"), F.coalesce(F.col(c).cast("string"), F.lit("null")), F.lit("-"), F.substring(digest, 1, 16))
    blocks = _numbered(records, digest).select(
        F.concat(urn("id"), F.when(F.col("copy") > 1, F.concat(F.lit("-"), F.col("copy").cast("string"))).otherwise(F.lit(""))).alias("rid"),
        F.regexp_replace(F.coalesce("url", F.lit("about:blank")), r"[\r\n]", " ").alias("url"),
        F.when(F.col("refers_to").isNotNull(), urn("refers_to")).alias("to"),
        digest.alias("digest"),
        F.when(F.col("refers_to").isNull(), F.concat(head, framed)).otherwise(head).alias("block"),
    )
    parts = blocks.withColumn("total", F.octet_length("block")).withColumn("part", F.explode(_cut(F.col("block"), lambda part, i: F.struct(i.alias("n"), part.alias("data")), segment))).drop("block")
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n"))
    cut, n, last = F.col("total") > segment, F.col("part.n"), F.col("part.n") * segment >= F.col("total")
    none = F.lit("")
    header = F.concat(
        F.lit(f"{VERSION}\r\n"),
        line("WARC-Type", F.when(n > 1, "continuation").when(F.col("to").isNotNull(), "revisit").otherwise("response")),
        line("WARC-Record-ID", F.concat(F.lit("<"), F.col("rid"), F.when(n > 1, F.concat(F.lit(":"), n.cast("string"))).otherwise(none), F.lit(">"))),
        F.lit("WARC-Date: 1970-01-01T00:00:00Z\r\n"),
        line("WARC-Target-URI", F.col("url")),
        F.when(n == 1, line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest")))).otherwise(none),
        F.when(F.col("to").isNotNull(), F.concat(line("WARC-Refers-To", F.concat(F.lit("<"), F.col("to"), F.lit(">"))), line("WARC-Profile", F.lit(PROFILE)))).otherwise(none),
        F.when(cut, line("WARC-Segment-Number", n)).otherwise(none),
        F.when(n > 1, line("WARC-Segment-Origin-ID", F.concat(F.lit("<"), F.col("rid"), F.lit(">")))).otherwise(none),
        F.when(cut & last, line("WARC-Segment-Total-Length", F.col("total"))).otherwise(none),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        line("Content-Length", F.octet_length("part.data")),
        F.lit("\r\n"),
    )
    lines = parts.select(F.concat(header.cast("binary"), F.col("part.data")).cast("string").alias("value"))
    lines.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", per_archive).text(path)


def _records(data: bytes) -> Iterator[tuple]:
    """The records of one archive; what doesn't follow the format raises."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        first, *lines = data[at:end].decode("utf-8", "surrogateescape").split("\r\n")
        if end < 0 or not first.startswith("WARC/"):
            raise ValueError(f"no record header at byte {at}")
        head = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        start = end + 4
        at = start + int(head["content-length"])
        if data[at : at + 4] != b"\r\n\r\n":
            raise ValueError(f"record {head.get('warc-record-id')} is cut short")
        number = head.get("warc-segment-number")
        total = head.get("warc-segment-total-length")
        yield (head["warc-record-id"], head["warc-type"], head.get("warc-target-uri"), head.get("warc-refers-to"), head.get("warc-payload-digest"), head.get("warc-segment-origin-id", head["warc-record-id"]), int(number or 1), int(total) if total else None if number else at - start, data[start:at])
        at += 4


def _plain(data: bytes) -> bytes:
    return gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per WARC record (segments apart) of the archives under ``path``."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(n, t) for n, t in zip([c.split()[0] for c in PARSED.split(", ")], [pa.string()] * 6 + [pa.int32(), pa.int64(), pa.binary()], strict=True)])
        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                for record in _records(_plain(content.as_py())):
                    rows.append(record)
                    held += len(record[-1])
                    if held > 1 << 22:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(parse, PARSED)


def dechunk(body: bytes) -> bytes:
    """The content of a chunked HTTP body; extensions and trailers are passed over."""
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        if not size:
            return b"".join(out)
        out.append(body[end + 2 : end + 2 + size])
        at = end + 2 + size
        if len(out[-1]) != size or body[at : at + 2] != b"\r\n":
            raise ValueError("a chunk is cut short")
        at += 2


def payload_of(block: bytes) -> bytes:
    """The payload of an HTTP response block, out of its transfer framing."""
    head, found, body = block.partition(b"\r\n\r\n")
    if not found:
        raise ValueError("no end of the HTTP headers")
    return dechunk(body) if b"transfer-encoding: chunked" in head.lower() else body


def reassemble(records: DataFrame) -> DataFrame:
    """Whole records out of segments: ``(record_id, warc_type, target_uri, refers_to, payload, payload_digest)``.

    Segments meet by the identifier of their origin, are put in order of their
    number and joined. A record whose numbers have a hole, whose length isn't the
    total that its last segment states, or whose payload doesn't have its digest
    raises, so no damaged payload passes. Revisits carry no payload (null). A
    repeated segment (the same number again) counts once. A group is one record's
    segments, so it is as large as one payload.
    """
    grouped = records.groupBy("origin_id").agg(
        F.collect_list(F.struct("segment", "block")).alias("parts"),
        F.max("total_length").alias("total"),
        *[F.min_by(c, "segment").alias(c) for c in ("warc_type", "target_uri", "refers_to", "payload_digest")],
    )

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            payloads = []
            for name, kind, parts, total, digest in zip(*(batch.column(k).to_pylist() for k in ("origin_id", "warc_type", "parts", "total", "payload_digest")), strict=True):
                numbered = {p["segment"]: p["block"] for p in parts}
                order = sorted(numbered)
                block = b"".join(numbered[k] for k in order)
                if order != list(range(1, len(order) + 1)) or len(block) != total:
                    raise ValueError(f"record {name} lacks segments: {len(block)} of {total} bytes")
                payload = None if kind == "revisit" else payload_of(block)
                if payload is not None and digest and digest != "sha256:" + hashlib.sha256(payload).hexdigest():
                    raise ValueError(f"record {name} doesn't have its digest")
                payloads.append(payload)
            yield pa.RecordBatch.from_arrays([batch.column("origin_id"), *[batch.column(k) for k in ("warc_type", "target_uri", "refers_to", "payload_digest")], pa.array(payloads, pa.binary())], names=["record_id", "warc_type", "target_uri", "refers_to", "payload_digest", "payload"])

    return grouped.mapInArrow(join, "record_id string, warc_type string, target_uri string, refers_to string, payload_digest string, payload binary")


def with_revisits(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """``pages(id, url, payload)`` with ``refers_to``: the smallest id of an equal payload of ``least`` bytes or more.

    Only payloads that occur more than once meet the pages again, in a join of
    written tables, whose hot digests AQE splits. Rows with a null id refer to none
    and none refers to them.
    """
    digest = F.sha2(F.coalesce("payload", F.lit(b"")), 256)
    long_ones = pages.where((F.octet_length("payload") >= least) & F.col("id").isNotNull()).select("id", digest.alias("digest"))
    firsts = written(long_ones.groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "firsts")
    keyed = pages.withColumn("digest", F.when(F.octet_length("payload") >= least, digest))
    return keyed.join(firsts, "digest", "left").select("id", "url", "payload", F.when(F.col("first") != F.col("id"), F.col("first")).alias("refers_to"))


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A record per row of ``pages``, written as archives and read back; rows with a null page_id are responses."""
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), "url", F.col("html").cast("binary").alias("payload"))
    path = new_path(spark, "warc")
    write_archives(with_revisits(pages), path)
    number = lambda c: F.regexp_extract(c, r"^<urn:record:(-?\d+)-", 1).try_cast("long")
    whole = reassemble(read_archives(spark, path)).select(
        number("record_id").alias("page_id"), F.octet_length("payload").cast("long").alias("own_bytes"), F.regexp_extract("payload_digest", "^sha256:(.*)$", 1).alias("payload_digest"), F.col("warc_type").alias("record_type"), number("refers_to").alias("refers_to")
    )
    whole = written(whole, "whole")
    referred = whole.where("record_type = 'response'").select(F.col("page_id").alias("_to"), F.col("payload_digest").alias("_digest"), F.col("own_bytes").alias("_bytes")).distinct()
    found = whole.join(referred, (whole["refers_to"] == referred["_to"]) & (whole["payload_digest"] == referred["_digest"]), "left")
    return found.select("page_id", F.coalesce("own_bytes", "_bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")


ORACLE_OP1 = """
with p as (select page_id, encode(coalesce(html, '')) as b from pages),
d as (select page_id, octet_length(b) as n, sha256(b) as h from p),
f as (select page_id, n, h, min(page_id) over (partition by h) as first from d)
select page_id, cast(n as bigint) as payload_bytes, h as payload_digest,
  case when n >= 100 and first <> page_id then 'revisit' else 'response' end as record_type,
  case when n >= 100 and first <> page_id then first end as refers_to
from f
"""
