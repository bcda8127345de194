"""Benchmark decontamination by suffix arrays over the training texts.

Documents are cut into shards of bounded text; each shard's words become 64-bit codes and its suffix array
is built in numpy (as many words at once as fit 63 bits, then prefix doubling, sorting only what is still tied).
Every test suffix is binary-searched in every shard, which gives all places where its window occurs. Each of these
places is then extended in its own document, by the suffix array of the test items: that gives the longest verbatim
match, whatever else the shard holds. Matches of fewer words than a window count for it too.

The benchmark is read in blocks of bounded size: each block is one map over the documents, and what the
blocks find adds up in two columns. So neither side is ever shuffled or joined.

Equality of words and runs rests on 64-bit codes: two given words or runs that differ share one with a chance of
about 2^-64, so of 10^9 distinct words against 10^6 test words some pair does with a chance of about 1 in 18,000.

Defined results: a null or empty text has no words, is never hit and keeps its row. Item rows of one id
count as one item; the words of an item with a null id hit documents, but it isn't counted or listed. An
item without words is in no document. Of equally long matches the first in the document counts. Repeated documents get
equal results; further columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructType

from .common import LOWER, bounded_batches, flat, lean, mixed, sized, span_codes, spans, table, unused

WINDOW = 10
BLOCK_WORDS = 500_000
"""Words of a benchmark block at most, longer single items aside: about 60 MB in a worker."""
SHARD_BYTES = 2 << 20

_WORD = np.ones(256, bool)
_WORD[0x00:0x30] = False
_WORD[0x3A:0x61] = False
_WORD[0x7B:0x80] = False


def word_codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all words of the texts in order, and the n + 1 bounds of each text's words."""
    data, at = flat(texts)
    data = LOWER[data]
    starts, ends = spans(_WORD[data], at)
    return span_codes(data, starts, ends), np.searchsorted(starts, at)


class SuffixArray:
    """Suffixes of a shard's words in order, to a given depth; no suffix goes on over a text's end. fresh: which differ
    from the one before within depth words (a depth that is a power of two: within just that many)."""

    def __init__(self, codes: np.ndarray, bounds: np.ndarray, depth: int) -> None:
        n = len(bounds) - 1
        # A text's end is a word of its own, rank 0, that no test word equals.
        place = np.arange(len(codes)) + np.repeat(np.arange(n), np.diff(bounds))
        self.vocabulary, rank = np.unique(codes, return_inverse=True)
        self.text = np.zeros(len(codes) + n + 1, np.int64)
        self.text[place] = rank + 1
        self.word_at = np.full(len(self.text), -1, np.int64)
        self.word_at[place] = np.arange(len(codes))
        self.order = self._sorted(depth)

    def _sorted(self, depth: int) -> np.ndarray:
        t, n = self.text, len(self.text)
        width = int(len(self.vocabulary) + 1).bit_length()
        known = min(63 // width, depth)
        while depth < 16 and depth % known:  # so that doubling ends at a short depth itself
            known -= 1
        pad = np.concatenate([t, np.zeros(known, np.int64)])
        key = np.zeros(n, np.int64)
        for k in range(known):
            key = (key << width) | pad[k : n + k]
        order = np.argsort(key)
        ordered = key[order]
        fresh = np.concatenate([[True], ordered[1:] != ordered[:-1]])
        place = np.flatnonzero(fresh)
        rank = np.empty(n, np.int64)
        rank[order] = np.repeat(place, np.diff(np.append(place, n)))
        while known < depth:
            tied = ~fresh
            tied[:-1] |= ~fresh[1:]
            at = np.flatnonzero(tied)
            # Behind a text's end order does not matter: such suffixes stay tied, and test words never reach them.
            if not len(at):
                break
            s = order[at]
            group = rank[s]
            after = rank[np.minimum(s + known, n - 1)]
            again = np.lexsort((after, group))
            s, group, after = s[again], group[again], after[again]
            order[at] = s
            new = np.concatenate([[True], (group[1:] != group[:-1]) | (after[1:] != after[:-1])])
            fresh[at] = new
            first = at[new]
            rank[s] = np.repeat(first, np.diff(np.append(np.flatnonzero(new), len(at))))
            known *= 2
        self.fresh = fresh
        return order

    def search(self, suffixes: np.ndarray, starts: np.ndarray, lengths: np.ndarray, window: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For suffixes starts[i] + lengths[i] of a code array: the longest match, a place of it, and the
        range in order of the suffixes that begin with its first window[i] words (empty if there are none)."""
        known = np.searchsorted(self.vocabulary, suffixes)
        known[known == len(self.vocabulary)] = 0
        words = np.where(self.vocabulary[known] == suffixes, known + 1, -1) if len(self.vocabulary) else np.full(len(suffixes), -1)
        m, n = len(starts), len(self.text)
        lo, hi = np.zeros(m, np.int64), np.full(m, n, np.int64)
        best, where = np.zeros(m, np.int64), np.full(m, -1, np.int64)
        from_, to = np.zeros(m, np.int64), np.zeros(m, np.int64)
        live = np.arange(m)
        depth = 0
        while len(live):
            want = words[starts[live] + depth]
            a, b = self._bound(lo[live], hi[live], depth, want), self._bound(lo[live], hi[live], depth, want + 1)
            lo[live], hi[live] = a, b
            depth += 1
            live = live[(a < b) & (want > 0)]
            best[live], where[live] = depth, self.order[lo[live]]
            full = live[window[live] == depth]
            from_[full], to[full] = lo[full], hi[full]
            live = live[lengths[live] > depth]
        return best, where, from_, to

    def _bound(self, lo: np.ndarray, hi: np.ndarray, depth: int, want: np.ndarray) -> np.ndarray:
        """First place in [lo, hi) whose suffix has at depth a word not below want."""
        lo, hi, last = lo.copy(), hi.copy(), len(self.text) - 1
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                return lo
            mid = (lo[open_] + hi[open_]) >> 1
            less = self.text[np.minimum(self.order[mid] + depth, last)] < want[open_]
            lo[open_[less]] = mid[less] + 1
            hi[open_[~less]] = mid[~less]


@dataclass
class Block:
    """Test items: their word codes, every suffix, which suffixes begin with a whole window, and their own suffix array."""

    ids: list[str | None]
    codes: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    window: np.ndarray
    item: np.ndarray
    order: SuffixArray
    width: int
    grams: list[np.ndarray]
    """Sorted codes of all runs of 1, 2, ... words, fewer than a window's; none if they are not asked for."""

    @classmethod
    def of(cls, ids: list[str | None], texts: list[str | None], width: int, below: bool) -> Block:
        codes, bounds = word_codes(pa.array(texts, pa.string()))
        size = np.diff(bounds)
        item = np.repeat(np.arange(len(ids)), size)
        starts = np.arange(len(codes))
        left = np.repeat(bounds[1:], size) - starts
        whole = np.where((size[item] < width) & (starts == bounds[item]), left, np.where(left >= width, width, 0))
        grams, at, run = [], starts, np.zeros(len(codes), np.uint64)
        for depth in range(1, width if below else 1):
            at, run = at[left[at] >= depth], run[left[at] >= depth]
            run = mixed(run + codes[at + depth - 1])
            grams.append(np.unique(run))
        return cls(ids, codes, starts, left, whole, item, SuffixArray(codes, bounds, int(size.max(initial=1))), width, grams)


def blocks(benchmark: DataFrame, width: int = WINDOW, below: bool = False) -> Iterator[Block]:
    """The benchmark in blocks; the driver holds one at a time."""
    ids: list[str | None] = []
    texts: list[str] = []
    size = 0
    for row in benchmark.select(F.col("item_id").cast("string").alias("i"), "text").where(F.col("text").isNotNull()).toLocalIterator():
        n = len(row["text"]) // 2 + 1
        if ids and size + n > 3 * BLOCK_WORDS:
            yield Block.of(ids, texts, width, below)
            ids, texts, size = [], [], 0
        ids.append(row["i"]), texts.append(row["text"])
        size += n
    yield Block.of(ids, texts, width, below)


def _below(codes: np.ndarray, bounds: np.ndarray, block: Block, longest: np.ndarray, place: np.ndarray) -> None:
    """Raises longest and place to matches of fewer words than a window, in each document's own words."""
    doc = np.repeat(np.arange(len(longest)), np.diff(bounds))
    at = np.flatnonzero(longest[doc] <= len(block.grams))
    run = np.zeros(len(at), np.uint64)
    for depth, grams in enumerate(block.grams, 1):
        inside = at + depth <= bounds[doc[at] + 1]
        at, run = at[inside], run[inside]
        run = mixed(run + codes[at + depth - 1])
        known = np.searchsorted(grams, run)
        known[known == len(grams)] = 0
        hit = grams[known] == run if len(grams) else np.zeros(len(run), bool)
        at, run = at[hit], run[hit]
        if not len(at):
            return
        found, first = np.unique(doc[at], return_index=True)
        where = at[first] - bounds[found]
        more = (longest[found] < depth) | (longest[found] == depth) & (place[found] > where)
        longest[found[more]], place[found[more]] = depth, where[more]


def _hits(texts: pa.Array, block: Block, below: bool) -> tuple[np.ndarray, np.ndarray, list[list[str]], np.ndarray, np.ndarray]:
    """Hit words of a shard, the bounds of its texts' words, each text's items, and its longest match and where that begins.
    below: matches shorter than a window count for these too."""
    codes, bounds = word_codes(texts)
    n = len(texts)
    hit = np.zeros(len(codes), bool)
    items: list[set[str]] = [set() for _ in range(n)]
    longest, place = np.zeros(n, np.int64), np.full(n, -1, np.int64)
    if len(codes) and len(block.codes):
        sa = SuffixArray(codes, bounds, block.width)
        whole = np.flatnonzero(block.window)
        _, _, lo, hi = sa.search(block.codes, block.starts[whole], block.window[whole], block.window[whole])
        some = hi > lo
        if some.any():
            # Equal windows have one range of places, whatever number of items holds them.
            key, which = np.unique(lo[some] * (len(sa.order) + 1) + hi[some], return_inverse=True)
            lo, hi = key // (len(sa.order) + 1), key % (len(sa.order) + 1)
            width = np.zeros(len(key), np.int64)
            np.maximum.at(width, which, block.window[whole[some]])
            holders: list[set[str]] = [set() for _ in key]
            for k, i in zip(which.tolist(), block.item[whole[some]].tolist()):
                if block.ids[i] is not None:
                    holders[k].add(block.ids[i])
            count = hi - lo
            row = np.repeat(np.arange(len(key)), count)
            word = sa.word_at[sa.order[np.arange(count.sum()) - np.repeat(np.cumsum(count) - count - lo, count)]]
            step = np.zeros(len(codes) + 1, np.int64)
            np.add.at(step, word, 1)
            np.add.at(step, word + width[row], -1)
            hit = np.cumsum(step[:-1]) > 0
            doc = np.searchsorted(bounds, word, "right") - 1
            for pair in np.unique(doc * len(key) + row).tolist():
                items[pair // len(key)] |= holders[pair % len(key)]
            word = np.unique(word)
            doc = np.searchsorted(bounds, word, "right") - 1
            length = block.order.search(codes, word, bounds[doc + 1] - word, np.zeros(len(word), np.int64))[0]
            order = np.lexsort((-word, length, doc))
            last = order[np.append(np.flatnonzero(np.diff(doc[order])), len(order) - 1)]
            longest[doc[last]], place[doc[last]] = length[last], word[last] - bounds[doc[last]]
        if below:
            _below(codes, bounds, block, longest, place)
    return hit, bounds, [sorted(s) for s in items], longest, place


_FOUND = [
    ("bits", pa.binary(), BinaryType()),
    ("n", pa.int64(), LongType()),
    ("items", pa.list_(pa.string()), ArrayType(StringType())),
    ("longest", pa.int64(), LongType()),
    ("place", pa.int64(), LongType()),
]
"""What is found in a document: a bit for each word, their number, its items, its longest match and that one's place."""

Finish = Callable[[pa.RecordBatch, list], pa.RecordBatch]


def _matched(docs: DataFrame, benchmark: DataFrame, width: int, finish: Finish, schema: str | StructType, below: bool) -> DataFrame:
    """What finish makes of slices of docs and of the columns of what was found in them, in one map for each block."""
    text, columns = docs.columns.index("text"), len(docs.columns)
    bounded_batches(docs.sparkSession)
    spark = docs.sparkSession
    between = StructType(list(docs.schema.fields))
    for name, _, kind in _FOUND:
        between = between.add(unused(f"__{name}", docs), kind)

    def step(block: Block, first: bool, last: bool):
        shared = spark.sparkContext.broadcast(block)  # bounded by BLOCK_WORDS

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block = shared.value
            for batch in batches:
                for part in sized(batch, text, SHARD_BYTES):
                    hit, bounds, items, longest, place = _hits(part.column(text), block, below)
                    bits = [np.packbits(hit[a:b]).tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
                    if not first:
                        old = [c.to_pylist() for c in part.columns[columns:]]
                        bits = [(np.frombuffer(x, np.uint8) | np.frombuffer(y, np.uint8)).tobytes() for x, y in zip(bits, old[0])]
                        items = [sorted({*x, *y}) for x, y in zip(items, old[2])]
                        most, at = np.array(old[3], np.int64), np.array(old[4], np.int64)
                        better = (longest > most) | (longest == most) & (place < at)
                        longest, place = np.where(better, longest, most), np.where(better, place, at)
                    found = [bits, np.diff(bounds), items, longest, place]
                    if last:
                        yield finish(pa.RecordBatch.from_arrays(part.columns[:columns], docs_names), found)
                    else:
                        yield pa.RecordBatch.from_arrays([*part.columns[:columns], *(pa.array(v, t) for v, (_, t, _) in zip(found, _FOUND))], between.names)

        return run

    docs_names, out, held = docs.columns, docs, None
    for number, block in enumerate(blocks(benchmark, width, below)):
        if held is not None:
            out = out.mapInArrow(lean(step(held, number == 1, False)), between)
        held, many = block, number
    return out.mapInArrow(lean(step(held, many == 0, True)), schema)


def matches(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """For every row of docs: doc_id, n_words, n_hit, the items found in it, its longest verbatim match in
    words and the word at which that begins (-1: none)."""

    def finish(part: pa.RecordBatch, found: list) -> pa.RecordBatch:
        bits, n, items, longest, place = found
        hits = [int(np.bitwise_count(np.frombuffer(x, np.uint8)).sum()) for x in bits]
        own = [pa.array(n, pa.int64()), pa.array(hits, pa.int64()), pa.array(items, pa.list_(pa.string())), pa.array(longest, pa.int64()), pa.array(place, pa.int64())]
        return pa.RecordBatch.from_arrays([part.column(0), *own], ["doc_id", "n_words", "n_hit", "items", "longest", "place"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return _matched(docs.select("doc_id", "text"), benchmark, width, finish, f"doc_id {kind}, n_words long, n_hit long, items array<string>, longest long, place long", True)


def clean(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """The rows of docs, all columns, in which no window of any item occurs."""
    finish = lambda part, found: part.filter(pa.array([not any(x) for x in found[0]], pa.bool_()))
    return _matched(docs, benchmark, width, finish, docs.schema, False)


def op3_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), digest.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"), "longest", "place")


ORACLE = r"""
WITH low AS MATERIALIZED (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS MATERIALIZED (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS MATERIALIZED (
  SELECT DISTINCT item_id, least(10, len(w)) AS k, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS s
  FROM items, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT k FROM windows),
runs AS (
  SELECT r, i, k, array_to_string(w[i : i + k - 1], ' ') AS s
  FROM low, sizes, unnest(range(1, len(w) - k + 2)) AS t(i) WHERE len(w) >= k),
found AS MATERIALIZED (SELECT runs.r, runs.i, runs.k, windows.item_id FROM runs JOIN windows USING (k, s)),
hit AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT r, i, k FROM found)) GROUP BY r),
named AS (SELECT r, count(x) AS n, string_agg(x, ',' ORDER BY x) AS ids FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS x FROM found) GROUP BY r),
here AS (SELECT r, unnest(w) AS x, generate_subscripts(w, 1) - 1 AS i FROM low),
there AS (SELECT b, unnest(w) AS x, generate_subscripts(w, 1) AS j FROM (SELECT row_number() OVER () AS b, w FROM items)),
same AS (SELECT r, b, i - j AS d, i, i - row_number() OVER (PARTITION BY r, b, i - j ORDER BY i) AS run FROM here JOIN there USING (x)),
longest AS (SELECT r, n AS longest, place FROM (SELECT r, count(*) AS n, min(i) AS place FROM same GROUP BY r, b, d, run)
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY n DESC, place) = 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(hit.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(named.n, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated,
  CAST(coalesce(longest, 0) AS BIGINT) AS longest, CAST(coalesce(place, -1) AS BIGINT) AS place
FROM low LEFT JOIN hit USING (r) LEFT JOIN named USING (r) LEFT JOIN longest USING (r)
"""
