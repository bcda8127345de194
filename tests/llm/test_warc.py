"""Archives of repeated ids, of one very long payload, and against plain Python."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from orograph.llm import common, warc


def brute(rows: list[tuple[int | None, str | None]]) -> list[tuple]:
    bodies = [(i, (h or "").encode()) for i, h in rows]
    out = []
    for i, body in bodies:
        same = [j for j, other in bodies if other == body and j is not None]
        top = max(same, default=None)
        again = len(body) >= warc.REVISIT and top is not None and i != top
        out.append((i, len(body), hashlib.sha1(body).hexdigest(), "revisit" if again else "response", top if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("broadcast", [200_000, 0])
def test_repeated_ids_keep_their_payloads(spark, monkeypatch, broadcast):
    monkeypatch.setattr(warc, "BROADCAST_ROWS", broadcast)
    p, q, r = "p" * 3000, "q" * 2000, "r" * 1000
    rows = [(7, p), (9, p), (7, q), (9, r), (9, r), (3, r), (None, p), (None, "short"), (4, "short"), (5, None), (None, r), (9, q + p)]
    pages = spark.createDataFrame([(i, "http://a/", h) for i, h in rows], "page_id long, url string, html string")
    got = warc.records(*warc.archive(pages)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_pages_by_plain_python(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "html").collect()]
    assert sorted((tuple(r) for r in warc.op5_chunked_records(spark, sf).collect()), key=str) == brute(rows)


def test_a_chunk_row_holds_its_chunk_only(spark):
    long = spark.range(1).select(F.col("id").alias("page_id"), F.lit(None).cast("string").alias("url"), F.repeat(F.concat(F.col("id").cast("string"), F.lit("123456789abcdef")), 1_500_000).alias("html"))
    pages = common.stored(long, "pages")
    rows = warc.chunks(pages)
    sizes = rows.agg(F.max(F.octet_length("data")).alias("most"), F.sum(F.octet_length("data")).alias("total"), F.count("*").alias("n")).first()
    assert tuple(sizes) == (warc.CHUNK, 24_000_000, -(-24_000_000 // warc.CHUNK)) and "body" not in rows.columns
    got = warc.records(*warc.archive(pages)).first()
    assert got["payload_bytes"] == 24_000_000 and got["payload_digest"] == hashlib.sha1(b"0123456789abcdef" * 1_500_000).hexdigest()
