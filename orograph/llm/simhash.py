"""SimHash near-duplicates: 64-bit fingerprints, pigeonhole blocks, verified links, components.

Fingerprints that differ in 2 bits or fewer agree on two of four 16-bit blocks, so each distinct
fingerprint stands in six buckets of two blocks. A bucket's members are compared with each other and only
a spanning set of its links goes on. Buckets are counted first; one of more than BUCKET members is not brought together: its
members are looked up exactly through the values one bit away. Fingerprints that differ in at most 2
bits share such a value, at most 65 fingerprints stand at one, and all of those are linked. Documents with
equal fingerprints are one node throughout, so copies cost one row.

Defined results: a null text, or one without words, has fingerprint zero and is linked like any other.
Repeated rows share a component. A component's id is the smallest non-null doc_id in it, null if it has none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, components, files_for, lean, stored, table, unused

SHINGLE = 3
SEED = 42
DISTANCE = 2
BUCKET = 256
BROADCAST_ROWS = 200_000
"""Rows of two numbers that are broadcast at most."""
_PAIRS = [(0, 1), (0, 2), (0, 3), (1, 2), (1, 3), (2, 3)]


def shingle_hashes(text: str | None, width: int = SHINGLE) -> list[int]:
    """XXH64 of each run of width words (of all words, if there are fewer), repeats included."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    n = len(words)
    if not n:
        return []
    joined = memoryview(b" ".join(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(width, n)
    of = xxhash.xxh64_intdigest
    return [of(joined[a:b], SEED) for a, b in zip(starts[: n - k + 1].tolist(), ends[k - 1 :].tolist())]


def _votes(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Fingerprint of each range of hashes: the bits set in over half of it."""
    out = np.zeros(len(bounds) - 1, np.uint64)
    sizes = np.diff(bounds)
    some = np.flatnonzero(sizes)
    if len(some):
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8)).reshape(-1, 64)
        counts = np.add.reduceat(bits, bounds[some], axis=0, dtype=np.int32)
        out[some] = np.packbits(counts * 2 > sizes[some, None], axis=1).view(">u8")[:, 0]
    return out


def _fingerprints(batch: pa.RecordBatch) -> pa.RecordBatch:
    hashes: list[int] = []
    bounds = [0]
    for text in batch.column(2).to_pylist():
        hashes += shingle_hashes(text)
        bounds.append(len(hashes))
    got = _votes(np.array(hashes, np.uint64), np.array(bounds))
    return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(got.view(np.int64))], ["doc_id", "text_hash", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, a hash of the text and the signed 64-bit fingerprint fp of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return arrow_map(docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text"), _fingerprints, f"doc_id {kind}, text_hash long, fp long", 2, 1 << 19)


def _kept(docs: DataFrame) -> tuple[DataFrame, int]:
    """The fingerprints of docs, stored, and how many there are."""
    n = docs.count()
    return stored(fingerprints(docs).repartition(files_for(n)), "fingerprints"), n


def _buckets(fp: Column) -> Column:
    block = lambda k: F.shiftrightunsigned(fp, 16 * k).bitwiseAND(F.lit(0xFFFF))
    return F.array(*(F.struct(F.lit(k).alias("pair"), (block(a) * 65536 + block(b)).alias("key")) for k, (a, b) in enumerate(_PAIRS)))


def _star(members: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links that join the members as all links of that distance do: each to the least of its component."""
    u = members.view(np.uint64)
    near = np.bitwise_count(u[:, None] ^ u[None, :]) <= distance
    root = np.arange(len(u))
    while True:
        low = np.where(near, root[None, :], len(u)).min(1)
        low = low[low]
        if (low == root).all():
            break
        root = low
    at = np.flatnonzero(root != np.arange(len(u)))
    return list(zip(members[at].tolist(), members[root[at]].tolist()))


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) of rows (pair, key, fp) sorted by bucket; a bucket has BUCKET members at most."""
    held: list[int] = []
    at = None

    def out(rows: list[tuple[int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64())], ["a", "b"])

    for batch in batches:
        rows: list[tuple[int, int]] = []
        for pair, key, fp in zip(*(c.to_pylist() for c in batch.columns)):
            if (pair, key) != at:
                if len(held) > 1:
                    rows += _star(np.array(held, np.int64), DISTANCE)
                held, at = [], (pair, key)
            held.append(fp)
        yield out(rows)
    if len(held) > 1:
        yield out(_star(np.array(held, np.int64), DISTANCE))


def _one_bit_away(fp: Column) -> Column:
    return F.transform(F.sequence(F.lit(-1), F.lit(63)), lambda i: F.when(i < 0, fp).otherwise(fp.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i))))


def links(distinct: DataFrame) -> DataFrame:
    """Links (a, b) between distinct fingerprints (fp): they join what all links of DISTANCE join.

    Buckets are counted first; members of those over BUCKET never meet in a task."""
    rows = distinct.select(F.explode(_buckets(F.col("fp"))).alias("x"), "fp").select("x.pair", "x.key", "fp")
    large = rows.groupBy("pair", "key").agg(F.count("*").alias("n")).where(F.col("n") > BUCKET).select("pair", "key")
    many = large.limit(BROADCAST_ROWS + 1).count()
    small = rows
    if many:
        large = F.broadcast(large) if many <= BROADCAST_ROWS else large
        small = rows.join(large, ["pair", "key"], "left_anti")
    found = small.repartition("pair", "key").sortWithinPartitions("pair", "key").mapInArrow(lean(_verify), "a long, b long")
    if many:
        hot = rows.join(large, ["pair", "key"], "left_semi").select("fp").distinct()
        away = hot.select(F.explode(_one_bit_away(F.col("fp"))).alias("v"), "fp").groupBy("v").agg(F.collect_list("fp").alias("fps"))  # 65 at most
        found = found.union(away.where(F.size("fps") > 1).select(F.explode("fps").alias("a"), F.array_min("fps").alias("b")).where("a <> b"))
    return stored(found, "found", len(_PAIRS) * distinct.count())


def _grouped(fps: DataFrame, n: int) -> DataFrame:
    """(fp, first, root) of each distinct fingerprint; first is its least row: null ids last."""
    first = fps.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("first"))
    first = stored(first, "distinct", n)
    roots = components(links(first.select("fp"))).withColumnRenamed("node", "fp")
    return first.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text_hash, fp) of every row, and (fp, component_id) of each distinct fingerprint."""
    fps, n = _kept(docs)
    of = _grouped(fps, n)
    ids = of.groupBy("root").agg(F.min("first.doc_id").alias("component_id"))
    return fps, of.join(ids, "root").select("fp", "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """docs, all columns, with one row of each component: the one of the least doc_id, null ids last.

    Rows that repeat both the id and the text of the row that stays are one row. Texts are not exchanged but for
    those rows, or if more than BROADCAST_ROWS rows go.
    """
    fps, n = _kept(docs)
    of = _grouped(fps, n)
    stay = of.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.doc_id").alias("doc_id"), F.col("first.text_hash").alias("text_hash"))
    rows = fps.groupBy("doc_id", "text_hash").agg(F.count("*").alias("n"))
    same = F.col("r.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("r.text_hash") == F.col("s.text_hash"))
    marked = rows.alias("r").join(stay.alias("s"), same, "left").select("r.doc_id", "r.text_hash", "n", F.col("s.text_hash").isNotNull().alias("stays"))
    marked = stored(marked.where("not stays or n > 1"), "marked", n)
    own, text = unused("__id", docs), unused("__text", docs)
    key = lambda df: _few(df.select(F.col("doc_id").alias(f"{own}k"), F.col("text_hash").alias(f"{text}k")))
    on = F.col(own).eqNullSafe(F.col(f"{own}k")) & (F.col(text) == F.col(f"{text}k"))
    mine = docs.withColumns({own: F.col("doc_id"), text: F.xxhash64("text")})
    left = mine.join(key(marked.where("not stays")), on, "left_anti")
    again = marked.where("stays")
    if not again.isEmpty():
        left = left.join(key(again), on, "left_anti").union(left.join(key(again), on, "left_semi").dropDuplicates([own, text]))
    return left.drop(own, text)


def _few(rows: DataFrame) -> DataFrame:
    return F.broadcast(rows) if rows.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else rows


def op8_simhash_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    fps, of = near_duplicates(table(spark, sf_dir, "documents"))
    return fps.join(of, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
