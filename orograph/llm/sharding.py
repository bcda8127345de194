"""Sharding by a hypergeometric communication matrix, in DataFrame functions only.

A uniform shuffle with exact shard sizes: rows are dealt to parts by a keyed hash; how many rows of each part go
to each shard is drawn exactly (each part's row of the matrix is multivariate hypergeometric given
what the shards still lack); a part's rows are permuted and cut at those counts, exchanged, and
permuted again within their shard. The driver holds the matrix, parts times shards numbers (a million at most for 16
shards), and no rows. The number of parts follows the row count, so a part stays small and no task holds a whole shard.

Defined results: a null text has size 1 and the checksum of the empty text. A null doc_id is dealt like any
other. Repeated rows are dealt one by one. An empty table gives no rows. All columns of a row go along through
both exchanges; columns besides doc_id and text only part rows that are alike in these.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import quoted, table

SHARDS = 16
PART_ROWS = 20_000
MAX_PARTS = 1 << 16
"""Beyond MAX_PARTS * PART_ROWS rows (1.3 billion) parts grow with the rows; a part is sorted by one task, which spills."""
SEED = 20_26


def communication_matrix(rows: np.ndarray, shards: int, seed: int = SEED) -> np.ndarray:
    """Rows of each part (first axis) that go to each shard: column sums differ by one at most."""
    rng = np.random.default_rng(seed)
    total = int(rows.sum())
    room = np.full(shards, total // shards, np.int64)
    room[rng.permutation(shards)[: total % shards]] += 1
    out = np.zeros((len(rows), shards), np.int64)
    for i, n in enumerate(rows.tolist()):
        left = n
        for j in range(shards):  # one hypergeometric draw for each shard, given what the others can take
            others = int(room[j + 1 :].sum())
            out[i, j] = left if not others else _draw(rng, int(room[j]), others, left)
            left -= int(out[i, j])
        room -= out[i]
    return out


def _draw(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """Good ones among n drawn of good + bad. numpy takes fewer than 10**9 of either; from a larger urn the draw inverts the
    law itself, whose ratios from one count to the next are exact numbers."""
    if not n or not good or not bad:
        return n if not bad else 0
    if good < 10**9 and bad < 10**9:
        return int(rng.hypergeometric(good, bad, n))
    total = good + bad
    low, high = max(0, n - bad), min(n, good)
    mode = min(high, max(low, (n + 1) * (good + 1) // (total + 2)))
    # 40 standard deviations on either side: what lies beyond has less weight than the last bit of a draw's 53.
    reach = 64 + int(40 * (n * (good / total) * (bad / total) * ((total - n) / (total - 1))) ** 0.5)
    k = np.arange(max(low, mode - reach), min(high, mode + reach) + 1)
    up = np.log((good - k[:-1]).astype(float)) + np.log((n - k[:-1]).astype(float)) - np.log((k[:-1] + 1).astype(float)) - np.log((bad - n + k[:-1] + 1).astype(float))
    weight = np.concatenate([[0.0], np.cumsum(up)])
    weight = np.cumsum(np.exp(weight - weight.max()))
    return int(k[np.searchsorted(weight, rng.random() * weight[-1], "right")])


def sharded(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, part_rows: int = PART_ROWS) -> DataFrame:
    """row (a struct of all columns of docs, the text too), shard and slot (gapless from 0 within a shard) of every row
    of docs. docs is read several times and has to give the same rows each time, as tables and stored rows do."""
    spark = docs.sparkSession
    size, crc = _size(F.col("text")), _crc(F.col("text"))
    marks = [F.xxhash64("doc_id", size, crc, F.lit(seed * 8 + k)) for k in range(4)]
    parts = min(MAX_PARTS, max(16 * shards, -(-docs.count() // part_rows)))
    # Rows of one doc_id and text are told apart by their other columns; maps have no hash.
    hashed = [f for f in docs.schema if "map<" not in f.dataType.simpleString() and f.dataType.simpleString() != "variant"]
    rest = F.xxhash64(*(F.col(quoted(f.name)) for f in hashed))
    order = lambda mark: F.struct(mark, "doc_id", size, crc, rest)
    dealt = docs.select(
        F.struct("*").alias("row"),
        F.pmod(marks[0], F.lit(parts)).alias("__part"),
        order(marks[1]).alias("__order"),
        order(marks[3]).alias("__again"),
        F.pmod(marks[2], F.lit(max(1, parts // shards))).alias("__piece"),
    )
    counts = {r[0]: r[1] for r in dealt.groupBy("__part").count().collect()}  # parts rows
    matrix = communication_matrix(np.array([counts.get(p, 0) for p in range(parts)], np.int64), shards, seed)
    ends = np.cumsum(matrix, axis=1)
    rows = [(int(p), int(j), int(ends[p, j] - matrix[p, j]), int(ends[p, j])) for p, j in zip(*np.nonzero(matrix))]
    cuts = spark.createDataFrame(rows, "__p long, shard int, __from long, __to long")
    local = dealt.withColumn("__n", F.row_number().over(Window.partitionBy("__part").orderBy("__order")) - 1)
    there = (F.col("__part") == F.col("__p")) & (F.col("__n") >= F.col("__from")) & (F.col("__n") < F.col("__to"))
    again = local.join(F.broadcast(cuts), there).select("row", "shard", "__again", "__piece")  # cuts: parts * shards rows of four numbers

    # The second permutation: a shard's slots are dealt to pieces by another hash, so that no task sorts a whole shard.
    sizes = again.groupBy("shard", "__piece").count()
    so_far = F.sum("count").over(Window.partitionBy("shard").orderBy("__piece")) - F.col("count")
    before = sizes.select("shard", "__piece", so_far.alias("__before"))  # parts rows
    placed = again.withColumn("__n", F.row_number().over(Window.partitionBy("shard", "__piece").orderBy("__again")) - 1)
    return placed.join(F.broadcast(before), ["shard", "__piece"]).select("row", "shard", (F.col("__before") + F.col("__n")).cast("long").alias("slot"))


def _size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(F.encode(text, "UTF-8")), F.lit(0)) + 1).cast("long")


def _crc(text: Column) -> Column:
    return F.crc32(F.coalesce(F.encode(text, "UTF-8"), F.lit(b"")))


def shuffled(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, part_rows: int = PART_ROWS) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row of docs, from the sharded rows."""
    text = F.col("row.text")
    return sharded(docs, shards, seed, part_rows).select("row.doc_id", _size(text).alias("size"), _crc(text).alias("text_crc32"), "shard", "slot")


def op2_hypergeometric(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shuffled(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
