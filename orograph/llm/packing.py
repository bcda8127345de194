"""Packing documents into sequences by non-negative least squares over length combinations.

Documents are tokenised and cut at whole windows; what remains of each is one piece. Piece lengths are
counted in bins of UNIT tokens. Combinations of bins that fill a window exactly (two different lengths,
each any number of times, or three pieces) are the columns of a least-squares problem whose
solution says how often to use each; it is rounded down to what the histogram holds, and the residual counts
are packed greedily, longest first. Only the histogram and a number for each RANK_ROWS pieces reach the driver. A piece's place follows
from its rank within its bin, so assigning places takes two shuffles of rows without ids and one that joins the ids to them.

Defined results: a null or empty text is the end token alone, one piece of length 1. Repeated rows are packed
as often as they occur. An empty table gives no sequences. Columns besides doc_id and text are not read.
"""

from __future__ import annotations

import os
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bounded_batches, lean, sized, stored, table

WINDOW = 4096
UNIT = 16
END_TOKEN = 2
RANK_ROWS = 100_000
"""Pieces of a bin that are ranked together, about; a bin's parts follow its size."""
CACHE_PARTS = 160_000
"""Parts in a worker's table, about; it has this one and the last."""
SLICE = 2 << 20


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


_FEED, _LETTER, _DIGIT, _SIGN, _WHOLE = range(5)
_SORT = np.full(256, _SIGN, np.uint8)
_SORT[0x61:0x7B], _SORT[0x80:], _SORT[0x30:0x3A], _SORT[0x0A] = _LETTER, _LETTER, _DIGIT, _FEED
"""Sorts of bytes in lower case: letters in a row are a part of a stretch, as are signs; each digit is one."""


_SINGLE = re.compile(r"[0-9]|[^a-zA-Z0-9\s']+", re.A)
"""ASCII parts that are one word, beside letters."""


class _Known(dict):
    """Part to number; one that isn't there is noted and gets the next number. before: parts known before these."""

    def __init__(self, before: dict[bytes, int]) -> None:
        super().__init__()
        self.before = before
        self.fresh: list[bytes] = []

    def __missing__(self, part: bytes) -> int:
        self[part] = at = len(self)
        self.fresh.append(part)
        return at


class _Encoder:
    """Token ids of texts by way of the distinct stretches between white space, and of their distinct parts.

    The tokenizer lower-cases, drops white space and splits between letters, digits and signs, so a text's
    ids are its stretches' ids and those their parts' ids. A stretch with special tokens or characters beyond ASCII that
    are not plain letters is a part as it is. Arrow finds the stretches and numbers the distinct ones of a slice of texts;
    each of these is split once, and each part new to the worker is encoded once.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a core runs one task
        self.tokenizer = Tokenizer.from_file(path)
        self.letters: dict[int, bool] = {}
        self.known: dict[bytes, int] = {}
        self.ids, self.starts, self.sizes = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.turn()

    def turn(self) -> None:
        """Begins a new table of parts; of the last one those that come again are taken over, the rest is forgotten at the next turn."""
        self.before = self.ids, self.starts, self.sizes
        self.known = _Known(dict(self.known))
        self.ids, self.starts, self.sizes = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _odd(self, raw: bytes) -> set[str]:
        """The characters beyond ASCII in raw that are not plain letters."""
        if raw.isascii():
            return set()
        codes = np.unique(np.frombuffer(raw.decode("utf-8", "replace").encode("utf-32-le"), np.uint32))
        for c in codes[codes > 127].tolist():
            if c not in self.letters:
                self.letters[c] = all(unicodedata.category(x)[0] == "L" for x in chr(c).lower() + unicodedata.normalize("NFC", chr(c)))
        return {chr(c) for c in codes[codes > 127].tolist() if not self.letters[c]}

    def _learn(self) -> None:
        """Ids of the new parts. Those that are one word each are encoded as one text: the tokenizer tells whose words they are."""
        asked, self.known.fresh = self.known.fresh, []
        last = np.fromiter((self.known.before.get(p, -1) for p in asked), np.int64, len(asked))
        fresh = [asked[i] for i in np.flatnonzero(last < 0).tolist()]
        plain = lambda p: p.isalpha() or (bool(_SINGLE.fullmatch(p.decode())) if p.isascii() else p.decode().lower().isalpha())
        single = np.fromiter(map(plain, fresh), bool, len(fresh))
        sizes, runs, order = np.zeros(len(fresh), np.int64), [], []
        for lo in range(0, len(fresh), 2048):
            at = lo + np.flatnonzero(single[lo : lo + 2048])
            if len(at):
                together = self.tokenizer.encode(b" ".join([fresh[i] for i in at.tolist()]).decode(), add_special_tokens=False)
                size = np.bincount(np.array(together.word_ids, np.int64), minlength=len(at))
                if len(size) == len(at):
                    sizes[at] = size
                    runs.append(np.array(together.ids, np.uint32))
                    order.append(at)
                else:
                    single[at] = False
            rest = lo + np.flatnonzero(~single[lo : lo + 2048])
            each = [e.ids for e in self.tokenizer.encode_batch([fresh[i].decode() for i in rest.tolist()], add_special_tokens=False)]
            sizes[rest] = [len(x) for x in each]
            runs.append(np.array([i for x in each for i in x], np.uint32))
            order.append(rest)
        order = np.concatenate([np.zeros(0, np.int64), *order])
        starts = np.empty(len(fresh), np.int64)
        starts[order] = np.cumsum(sizes[order]) - sizes[order]
        ids = np.concatenate([np.zeros(0, np.uint32), *runs])
        again, done = _gathered(*self.before, last[last >= 0])
        all_starts, all_sizes = np.empty(len(asked), np.int64), np.empty(len(asked), np.int64)
        all_starts[last < 0], all_sizes[last < 0] = starts, sizes
        all_starts[last >= 0], all_sizes[last >= 0] = len(ids) + done[:-1], np.diff(done)
        self.starts, self.sizes = np.concatenate([self.starts, all_starts + len(self.ids)]), np.concatenate([self.sizes, all_sizes])
        self.ids = np.concatenate([self.ids, ids, again])

    def _stretches(self, found: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of these stretches end to end, and the n + 1 bounds. Parts are found by the sorts of neighbouring bytes, and Arrow
        numbers the distinct ones; a stretch with an apostrophe is one part."""
        n = len(found)
        if not n:
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        if len(self.known) > CACHE_PARTS:
            self.turn()
        listed = pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), found.cast(pa.string()))
        joined = pc.binary_join(listed, "\n")[0].as_buffer().to_pybytes() + b"\n"
        raw, data = np.frombuffer(joined, np.uint8), np.frombuffer(joined.lower(), np.uint8)
        feed = data == 0x0A
        of = np.cumsum(feed) - feed
        as_is = np.zeros(n, bool)  # stretches whose letters' case may tell a special token, or that are not plain
        as_is[of[:-1][(data[:-1] == 0x3C) & (data[1:] == 0x7C)]] = True
        if odd := self._odd(joined):
            as_is |= np.fromiter((not x.isascii() and not odd.isdisjoint(x) for x in found.to_pylist()), bool, n)
        whole = as_is.copy()
        whole[of[data == 0x27]] = True
        sort = np.where(whole[of] & ~feed, np.uint8(_WHOLE), _SORT[data])
        begins = ~feed
        begins[1:] &= (sort[1:] != sort[:-1]) | (sort[1:] == _DIGIT)
        starts = np.flatnonzero(begins)
        letters = np.where(as_is[of], raw, data)[~feed]
        ends = np.append(starts - of[starts], len(letters)).astype(np.int64)
        parts = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(letters)]).dictionary_encode()
        distinct = parts.dictionary.to_pylist()
        at = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))
        if self.known.fresh:
            self._learn()
        ids, done = _gathered(self.ids, self.starts, self.sizes, at[parts.indices.to_numpy(zero_copy_only=False)])
        return ids, done[np.concatenate([[0], np.cumsum(np.bincount(of[starts], minlength=n))])]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, each text's followed by END_TOKEN, and the n + 1 bounds."""
        split = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
        size = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
        distinct = split.flatten().dictionary_encode()
        ids, bounds = self._stretches(distinct.dictionary)
        ids, done = _gathered(ids, bounds[:-1], np.diff(bounds), distinct.indices.to_numpy(zero_copy_only=False))
        bounds = done[np.concatenate([[0], np.cumsum(size)])]
        return np.insert(ids, bounds[1:], np.uint32(END_TOKEN)), bounds + np.arange(len(bounds))


def _gathered(ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ids with these numbers end to end, and where each begins and the last ends."""
    size = sizes[at]
    done = np.concatenate([[0], np.cumsum(size)])
    return ids[np.repeat(starts[at] - done[:-1], size) + np.arange(done[-1])], done


_encoders: dict[str, _Encoder] = {}


def _encoder(path: str) -> _Encoder:
    """A worker's encoder: made once, its bounded memory of parts serves all the worker's tasks."""
    if path not in _encoders:
        _encoders[path] = _Encoder(path)
    return _encoders[path]


def pieces(docs: DataFrame, window: int = WINDOW, path: str | None = None) -> DataFrame:
    """doc_id, start, length, ids and doc_tokens of every piece of every row; ids are the piece's token ids, 32-bit
    little-endian numbers end to end."""
    path = path or tokenizer_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        for batch in batches:
            for part in sized(batch, 1, SLICE):
                ids, bounds = encoder.encode(part.column(1))
                total = np.diff(bounds)
                number = -(-total // window)
                row = np.repeat(np.arange(len(total)), number)
                start = (np.arange(len(row)) - np.repeat(np.cumsum(number) - number, number)) * window
                length = np.minimum(window, total[row] - start)
                ends = np.concatenate([[0], np.cumsum(length)])  # pieces follow each other as the ids do
                own = pa.Array.from_buffers(pa.large_binary(), len(row), [None, pa.py_buffer(ends.astype(np.int64) * 4), pa.py_buffer(ids.astype("<u4"))]).cast(pa.binary())
                start, length, total = (pa.array(np.asarray(c, np.int64)) for c in (start, length, total[row]))
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(row)), start, length, own, total], ["doc_id", "start", "length", "ids", "doc_tokens"])

    bounded_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(lean(run), f"doc_id {kind}, start long, length long, ids binary, doc_tokens long")


Combination = tuple[tuple[int, int], ...]
"""(bin, times) pairs."""


def combinations(bins: int) -> list[Combination]:
    """Shallow ways to fill bins exactly: one or two sizes at any number of times, or three pieces."""
    out: list[Combination] = [((a, bins // a),) for a in range(1, bins + 1) if bins % a == 0]
    for a in range(1, bins):
        for times in range(1, (bins - 1) // a + 1):
            left = bins - a * times
            out += [((a, times), (left // k, k)) for k in range(1, left // (a + 1) + 1) if left % k == 0 and left // k > a]
    out += [((a, 1), (b, 1), (bins - a - b, 1)) for a in range(1, bins // 3) for b in range(a + 1, (bins - a + 1) // 2) if bins - a - b > b]
    return out


def least_squares(a: np.ndarray, h: np.ndarray, rounds: int = 1200) -> np.ndarray:
    """x >= 0 that makes |a x - h| least: the active-set method."""
    x, free = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    for _ in range(rounds):
        pull = a.T @ (h - a @ x)
        pull[free] = -np.inf
        j = int(np.argmax(pull))
        if pull[j] <= 1e-7 * max(1.0, float(h.max())):
            break
        free[j] = True
        while True:
            at = np.flatnonzero(free)
            sub = a[:, at]
            s = np.linalg.solve(sub.T @ sub + 1e-9 * np.eye(len(at)), sub.T @ h)
            if (s > 1e-12).all():
                x[:] = 0
                x[at] = s
                break
            low = s <= 1e-12
            step = np.min(x[at][low] / np.maximum(x[at][low] - s[low], 1e-300))
            x[at] += step * (s - x[at])
            gone = at[(x[at] <= 1e-12)]
            x[gone], free[gone] = 0, False
            if not free.any() or j in gone and not len(at) > 1:
                break
    return x


def plan(histogram: np.ndarray) -> list[tuple[Combination, int]]:
    """Combinations and repeat counts that use histogram[b] pieces of each bin b (from 1) exactly."""
    left = histogram.astype(np.int64).copy()
    bins = len(left) - 1
    there = set(np.flatnonzero(left).tolist())
    ways = [c for c in combinations(bins) if all(b in there for b, _ in c)]
    out: list[tuple[Combination, int]] = []

    def use(way: Combination, times: int) -> None:
        times = min(times, *(int(left[b]) // k for b, k in way))
        if times > 0:
            for b, k in way:
                left[b] -= k * times
            out.append((way, times))

    if ways:
        a = np.zeros((bins + 1, len(ways)))
        for j, way in enumerate(ways):
            for b, k in way:
                a[b, j] = k
        x = least_squares(a, histogram.astype(float))
        for j in np.argsort(-x, kind="stable").tolist():
            if x[j] < 0.5:
                break
            use(ways[j], int(x[j] + 0.5))
    while (here := np.flatnonzero(left)).size:
        way, space = {}, bins
        for b in here[::-1].tolist():
            if b <= space and (k := min(space // b, int(left[b]))):
                way[b] = k
                space -= b * k
        use(tuple(way.items()), int(left.sum()))
    return out


def assigned(found: DataFrame, window: int = WINDOW, unit: int = UNIT) -> DataFrame:
    """found (what numbered returns, stored) with sequence_id and offset. A piece that fills a window is a sequence by itself,
    whose id follows from its own number, so these ids have gaps. Places of the others are found without the ids of
    their tokens, which are exchanged once."""
    spark = found.sparkSession
    whole = F.col("length") == window
    rows = found.where(~whole).drop("ids").withColumn("__bin", F.ceil(F.col("length") / unit).cast("int"))
    bins = window // unit
    sizes = {r[0]: r[1] for r in rows.groupBy("__bin").count().collect()}  # bins rows at most
    subs = F.array(*(F.lit(max(1, -(-sizes.get(b, 0) // RANK_ROWS))) for b in range(1, bins + 1)))
    rows = rows.withColumn("__sub", F.pmod("__mark", F.element_at(subs, F.col("__bin"))).cast("int"))
    counts = rows.groupBy("__bin", "__sub").agg(F.count("*").alias("n")).collect()  # one for each RANK_ROWS rows, and bins
    histogram = np.zeros(bins + 1, np.int64)
    before = []
    for r in sorted(counts):
        before.append((r["__bin"], r["__sub"], int(histogram[r["__bin"]])))
        histogram[r["__bin"]] += r["n"]
    ranges, used, sequence = [], np.zeros(len(histogram), np.int64), 0
    for way, times in plan(histogram):
        slot = 0
        for b, k in way:
            ranges.append((b, int(used[b]), int(used[b]) + k * times, sequence, k, slot))
            used[b] += k * times
            slot += k
        sequence += times
    offsets = spark.createDataFrame(before, "__bin int, __sub int, __before long")
    places = spark.createDataFrame(ranges, "__bin int, __from long, __to long, __first long, __times int, __slot int")
    by_bin = Window.partitionBy("__bin", "__sub").orderBy("__mark", "doc_id", "start", "length", "doc_tokens", "__piece")
    ranked = rows.withColumn("__n", F.row_number().over(by_bin) - 1).join(F.broadcast(offsets), ["__bin", "__sub"]).withColumn("__rank", F.col("__before") + F.col("__n"))
    p, r = ranked.alias("p"), F.broadcast(places).alias("r")
    placed = p.join(r, (F.col("p.__bin") == F.col("r.__bin")) & (F.col("__rank") >= F.col("__from")) & (F.col("__rank") < F.col("__to")))
    turn = F.col("__rank") - F.col("__from")
    sequence_id = F.col("__first") + F.floor(turn / F.col("__times"))
    placed = placed.select("p.__piece", "p.length", sequence_id.alias("sequence_id"), (F.col("__slot") + turn % F.col("__times")).alias("__slot"))
    in_sequence = Window.partitionBy("sequence_id").orderBy("__slot").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    places = placed.select("__piece", "sequence_id", (F.sum("length").over(in_sequence) - F.col("length")).alias("offset"))
    shared = found.where(~whole).drop("__mark").join(places, "__piece").drop("__piece")
    alone = found.where(whole).withColumns({"sequence_id": F.col("__piece") + sequence, "offset": F.lit(0).cast("long")})
    return shared.unionByName(alone.select(*shared.columns))


def numbered(found: DataFrame) -> DataFrame:
    """found (what pieces returns) with what ranks a piece and a number of its own, which is fixed once stored."""
    return found.withColumns({"__mark": F.xxhash64("doc_id", "start", F.crc32("ids")), "__piece": F.monotonically_increasing_id()})


def packed(docs: DataFrame, window: int = WINDOW, path: str | None = None) -> DataFrame:
    """Every piece of docs with its ids, its sequence and its offset there."""
    return assigned(stored(numbered(pieces(docs, window, path)), "pieces"), window)


def sequences(placed: DataFrame) -> DataFrame:
    """sequence_id, length and ids of every packed sequence of placed (what packed returns)."""
    own = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # a window's tokens at most
    return placed.groupBy("sequence_id").agg(F.sum("length").alias("length"), F.array_join(F.transform(own, lambda x: F.hex(x["ids"])), "").alias("__hex")).select("sequence_id", "length", F.unhex("__hex").alias("ids"))


def digested(placed: DataFrame) -> DataFrame:
    """placed with the checksum of each piece's ids in their stead."""
    return placed.select(*(F.crc32("ids").alias("ids_crc32") if c == "ids" else c for c in placed.columns))


def op7_nnls_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digested(packed(table(spark, sf_dir, "documents")))
