"""What the operators of this subpackage share: tables, shared storage, byte spans and components.

Texts reach Python as Arrow batches. The helpers here view a batch's text column as one
byte buffer with document offsets, so that words, lines and windows of thousands of
documents are found and hashed by a few numpy calls, with no Python loop over words.
"""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK_BYTES = 2 << 20
"""Bytes of text that are worked on at once; one longer text is a chunk by itself."""
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of at most BATCH_BYTES, one longer row aside, whatever the length of texts. All operators here ask for
    the same bound, so none depends on which was called last; a lower one that the session has stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(key, str(1 << 30)).rstrip("bB")) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


_made: dict[str, str] = {}
"""Folders of this process in shared storage, by application."""


def shared_dir(spark: SparkSession) -> str:
    """This application's folder in the one that all executors share, spark.checkpoint.dir. Only a local master, where
    driver and executors are one machine, may do without that setting. The folder goes when the driver's JVM ends."""
    app = spark.sparkContext.applicationId
    if app not in _made:
        there = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
        if not there:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
            there = tempfile.mkdtemp(prefix="checkpoints-")
            spark.sparkContext.setCheckpointDir(there)
        _made[app] = f"{there.rstrip('/')}/orograph-{app}-{uuid.uuid4().hex[:8]}"
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_made[app])
        files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
    return _made[app]


FILE_ROWS = 200_000


def stored(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """df written once as Parquet in the shared folder and reread: later readers neither compute it again nor lose it with
    an executor. rows: for tables of a few numbers a row that come out of an exchange, about how many rows there
    are at most; they are written as a file for each FILE_ROWS of these instead of one for each partition."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    (df if rows is None else df.coalesce(files_for(rows))).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def files_for(rows: int) -> int:
    return max(1, -(-rows // FILE_ROWS))


def unused(name: str, *frames: DataFrame) -> str:
    """name, with underscores added until no column of the frames has it."""
    there = {c.lower() for df in frames for c in df.columns}
    while name.lower() in there:
        name += "_"
    return name


def quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def bucket_crc(column: Column, mod: int) -> Column:
    """crc32 of the column's text form, modulo mod; null counts as the empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % mod


def text_chunks(lengths: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts sum to about limit bytes at most."""
    lo, total = 0, 0
    for i, n in enumerate(lengths.tolist()):
        if total and total + n > limit:
            yield lo, i
            lo, total = i, 0
        total += n
    if lo < len(lengths):
        yield lo, len(lengths)


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts end to end, and the n + 1 offsets; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = texts.buffers()[2] if len(texts) else None
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    return raw, at - at[0]


def sized(batch: pa.RecordBatch, column: int, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about limit bytes of one text column."""
    n = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    for lo, hi in text_chunks(n, limit):
        yield batch.slice(lo, hi - lo)


def spans(mask: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true bytes; no run goes on over a text's end."""
    if not len(mask):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.zeros(len(mask) + 1, bool)
    first[at] = True
    before = np.empty(len(mask), bool)
    before[0], before[1:] = False, mask[:-1]
    after = np.empty(len(mask), bool)
    after[-1], after[:-1] = False, mask[1:]
    return np.flatnonzero(mask & (~before | first[:-1])), np.flatnonzero(mask & (~after | first[1:])) + 1


_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_CODED = 1 << 17
"""Bytes that are coded at once: what that takes stays in a core's cache."""
_powers: list[np.ndarray] = []


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, or more; those for longer words than _CODED aren't kept."""
    if _powers and n <= _CODED:
        return _powers[0], _powers[1]
    out = []
    for base in (_BASE, _INVERSE):
        steps = np.full(max(n, _CODED), base, np.uint64)
        steps[0] = 1
        out.append(np.multiply.accumulate(steps))
    if n <= _CODED:
        _powers[:] = out
    return out[0], out[1]


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads each bit over all."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def span_codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit code of each span's bytes, spans in order: equal bytes have equal codes wherever they stand."""
    out = np.empty(len(starts), np.uint64)
    lo = 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + _CODED, "right")))
        a, b = int(starts[lo]), int(ends[hi - 1])
        up, down = _power(b - a)
        total = np.zeros(b - a + 1, np.uint64)
        np.cumsum((data[a:b].astype(np.uint64) + np.uint64(1)) * up[: b - a], out=total[1:])
        out[lo:hi] = (total[ends[lo:hi] - a] - total[starts[lo:hi] - a]) * down[starts[lo:hi] - a]
        lo = hi
    return mixed(out)


def run_codes(codes: np.ndarray, width: int) -> np.ndarray:
    """Code of each run of width consecutive codes, len(codes) - width + 1 of them."""
    n = len(codes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for k in range(width):
        h = h * _BASE + codes[k : k + n]
    return mixed(h)


def per_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of values[bounds[i]:bounds[i + 1]]."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def in_runs(flags: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of n items lie in a run of width items that begins at a true flag; runs end by n."""
    step = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(flags)
    step[at] += 1
    step[at + width] -= 1
    return np.cumsum(step[:-1]) > 0


SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, for mapInArrow; when a task ends its worker gives free memory back, since workers outlive tasks and stages."""

    def lean_run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
                trim(0)

    return lean_run


def arrow_map(df: DataFrame, each: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, text: int, limit: int = CHUNK_BYTES) -> DataFrame:
    """each over slices of about limit bytes of text, by mapInArrow; text is the text column's place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sized(batch, text, limit):
                yield each(part)

    bounded_batches(df.sparkSession)
    return df.mapInArrow(lean(run), schema)


def components(edges: DataFrame, rounds: int = 200) -> DataFrame:
    """(node, root): the smallest node reachable from each node of edges (a, b), which are counted first.

    Alternating large-star and small-star steps: every node links its larger neighbours,
    then its smaller ones, to its least neighbour, until the links form stars; rounds grow as the square of the
    logarithm of the longest path at most. Links are always spread over hash partitions by node; each round's links are written in
    the shared folder. A node with no edge is not in the result.
    """
    n = edges.count()
    now = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links", n)
    seen = None
    for _ in range(rounds):
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        star = F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))
        small = large.join(low, "a").select(F.explode(star).alias("x")).select("x.a", "x.b").where("a <> b").distinct()
        now = stored(small, "links", n)
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if state == seen:
            break
        seen, n = state, state["n"]
    else:
        raise RuntimeError("links did not settle")
    return now.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b").distinct())
