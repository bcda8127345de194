"""Toxicity by multiple-instance learning: a document is a bag of sentences, and only bags are labelled.

A sentence's logit is a bias plus the weights of its words; a word's weight is the sum over its hashed
features (the word, its beginnings and its ending). Sentence probabilities are joined by noisy-or,
1 - prod(1 - p), and the weights are trained in numpy from document labels through that formula, so the
trained model also says which sentences offend.

Defined results: a null or empty text has no sentence and score 0. Without labels of both kinds, or if no labelled
text has a word, every score is that of texts without a known word, 0 or close to it. Of rows that repeat a labelled id
the model learns from 4 * MAX_SAMPLE in all, those of the least id hash, id and text. Repeated rows are scored one by one; a document labelled both ways counts as toxic. Columns of docs
beyond doc_id and text are never read by the scorer.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, bucket_crc, lean, sized, table

BITS = 18
MAX_SAMPLE = 1200
"""Labelled documents of each label, at most, that the model is fitted on: those of the least id hash."""
CACHE_WORDS = 120_000
THRESHOLD = 0.7

_END = 10
_KEEP = bytes(c if c >= 0x80 or 0x61 <= c <= 0x7A else _END if chr(c) in ".!?\n" else 32 for c in range(256))
_SENTENCE = re.compile(r"[^.!?\n]+")
_MARK = b"\n"


def _tokens(text: str) -> list[bytes]:
    """Lower-case words in order; each sentence end is a token of one newline."""
    return text.lower().encode("utf-8", "replace").translate(_KEEP).replace(b"\n", b" \x01 ").split()


def word_features(word: bytes) -> list[int]:
    """Places of a word's features in the weight vector."""
    text = word.decode("utf-8", "replace")
    parts = [f"={text}", *(f"^{text[:k]}" for k in (3, 4, 5, 6) if len(text) > k), f"{text[-4:]}$"]
    return [zlib.crc32(p.encode()) >> (32 - BITS) for p in parts]


class NoisyOr:
    """Feature weights and the bias of a sentence."""

    def __init__(self) -> None:
        self.weights, self.bias = np.zeros(1 << BITS, np.float32), -6.0

    def fit(self, texts: list[str], toxic: np.ndarray, rounds: int = 300, rate: float = 0.1, decay: float = 3e-5, seen_in: int = 5) -> None:
        """Full-batch Adam on the documents' log-likelihood with an L1 pull towards zero.

        Features of fewer than seen_in toxic documents get no weight: what one document alone has says
        nothing of others. Weights are never negative: no harmless word excuses an offending one.
        """
        vocabulary: dict[bytes, int] = {}
        word_ids, sentence_ends, bag_ends = array("i"), [], []
        n = 0
        while texts:  # the texts go as their words come
            for word in _tokens(texts.pop(0)) + [b"\x01"]:
                if word == b"\x01":
                    if n > (sentence_ends[-1] if sentence_ends else 0):
                        sentence_ends.append(n)
                else:
                    word_ids.append(vocabulary.setdefault(word, len(vocabulary)))
                    n += 1
            bag_ends.append(len(sentence_ends))
        ids, ends, bags = np.frombuffer(word_ids, np.int32), np.array(sentence_ends, np.int64), np.array(bag_ends, np.int64)
        if not len(ids):
            return  # no text has a word: no feature tells anything
        lists = [word_features(w) for w in vocabulary]
        places = np.fromiter((x for f in lists for x in f), np.int64)
        owner = np.repeat(np.arange(len(lists)), [len(f) for f in lists])
        starts = np.concatenate([[0], ends[:-1]])
        sentence_of = np.repeat(np.arange(len(ends)), ends - starts)
        bag_of = np.repeat(np.arange(len(bags)), np.diff(np.concatenate([[0], bags])))
        bag_of_word = bag_of[sentence_of]
        in_toxic = np.unique((ids.astype(np.int64) * len(bags) + bag_of_word)[toxic[bag_of_word]])
        word_of, bag_of_it = in_toxic // len(bags), in_toxic % len(bags)
        count = np.array([len(f) for f in lists])
        first = np.concatenate([[0], np.cumsum(count)[:-1]])
        picked = np.repeat(first[word_of], count[word_of]) + np.arange(count[word_of].sum()) - np.repeat(np.cumsum(count[word_of]) - count[word_of], count[word_of])
        pairs = np.unique(places[picked] * len(bags) + np.repeat(bag_of_it, count[word_of]))
        live = np.bincount(pairs // len(bags), minlength=1 << BITS) >= seen_in
        places, owner = places[live[places]], owner[live[places]]
        weight_of_bag = np.where(toxic, 0.5 / max(1, toxic.sum()), 0.5 / max(1, (~toxic).sum())) * len(toxic)
        w = self.weights.astype(np.float64)
        m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
        for step in range(1, rounds + 1):
            by_word = np.bincount(owner, w[places], len(lists))
            logit = np.bincount(sentence_of, by_word[ids], len(ends)) + self.bias
            clear = -np.logaddexp(0, logit)  # log(1 - p)
            none = np.bincount(bag_of, clear, len(bags))
            some = -np.expm1(none)
            p = np.exp(logit + clear)
            pull = np.where(toxic, -np.exp(none) / np.maximum(some, 1e-9), 1.0) * weight_of_bag / len(toxic)
            g_sentence = p * pull[bag_of]
            g_word = np.bincount(ids, g_sentence[sentence_of], len(lists))
            g = np.bincount(places, g_word[owner], len(w)) + decay
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            w = np.maximum(0, w - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-6))
            gb = float(g_sentence.sum())
            mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
            self.bias -= rate * (mb / (1 - 0.9**step)) / (np.sqrt(vb / (1 - 0.999**step)) + 1e-8)
        w[np.abs(w) < 1e-3] = 0
        self.weights = w.astype(np.float32)

    def word_weight(self, word: bytes) -> float:
        return float(self.weights[word_features(word)].sum())


class _Weights(dict):
    def __init__(self, model: NoisyOr) -> None:
        super().__init__()
        self.model = model

    def __missing__(self, word: bytes) -> float:
        if len(self) > CACHE_WORDS:
            self.clear()
        self[word] = out = self.model.word_weight(word)
        return out


def sample(docs: DataFrame, labels: DataFrame, most: int = MAX_SAMPLE) -> tuple[list[str], np.ndarray]:
    """Texts and labels of at most most documents of each label."""
    marked = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = [F.xxhash64("doc_id", F.lit(1)), "doc_id"]
    chosen = marked.where("toxic = 1").orderBy(*order).limit(most).union(marked.where("toxic = 0").orderBy(*order).limit(most))
    texts = docs.select("doc_id", "text").where(F.col("text").isNotNull())
    rows = texts.join(F.broadcast(chosen), "doc_id")  # chosen: 2 * most rows of two numbers
    got = rows.orderBy(*order, "text").limit(4 * most).select("toxic", "text").toArrow()
    return got.column("text").to_pylist(), got.column("toxic").to_numpy() == 1


def fitted(docs: DataFrame, labels: DataFrame, most: int = MAX_SAMPLE) -> NoisyOr | None:
    texts, toxic = sample(docs, labels, most)
    if toxic.all() or not toxic.any():
        return None
    model = NoisyOr()
    model.fit(texts, toxic)
    return model


def _scorer(model: NoisyOr | None):
    """From a list of texts to their scores and the ordinals and probabilities of their offending sentences."""
    weights = _Weights(model) if model else None

    def scores(texts: list[str | None]) -> tuple[list[float], list[list[dict]]]:
        if not model:
            return [0.0] * len(texts), [[] for _ in texts]
        tokens: list[bytes] = []
        begins = []
        for text in texts:
            begins.append(len(tokens))
            tokens += _tokens(text or "")
            tokens.append(b"\x01")
        weights[b"\x01"] = 0.0
        w = np.fromiter(map(weights.__getitem__, tokens), np.float64, len(tokens))
        end = np.fromiter((t == b"\x01" for t in tokens), bool, len(tokens))
        sentence = np.concatenate([[0], np.cumsum(end)[:-1]])
        n = int(end.sum())
        size = np.bincount(sentence, ~end, n)
        logit = np.bincount(sentence, w, n) + model.bias
        clear = np.where(size > 0, -np.logaddexp(0, logit), 0.0)
        first = np.searchsorted(np.flatnonzero(end), begins)
        out = -np.expm1(np.add.reduceat(clear, first))
        hot = np.flatnonzero(clear < np.log(0.5))
        bag = np.searchsorted(first, hot, "right") - 1
        where: list[list[dict]] = [[] for _ in texts]
        for s, b in zip(hot.tolist(), bag.tolist()):
            where[b].append({"ordinal": s - int(first[b]), "probability": float(-np.expm1(clear[s]))})
        return np.clip(out, 0.0, 1.0).tolist(), where

    return scores


def _spans(text: str, found: list[dict]) -> list[dict]:
    """Found sentences with their places: the ordinal counts every sentence end of the text."""
    if not found:
        return []
    out, at, by = [], 0, {f["ordinal"]: f["probability"] for f in found}
    for k, part in enumerate(re.split(r"[.!?\n]", text.lower() if len(text.lower()) == len(text) else text)):
        if k in by:
            out.append({"start": at, "end": at + len(part), "probability": by[k]})
        at += len(part) + 1
    return out


def score(docs: DataFrame, model: NoisyOr | None) -> DataFrame:
    """doc_id, score and the offending sentences (code point ranges and probabilities) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = _scorer(model)
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("probability", pa.float64())]))
        for batch in batches:
            for part in sized(batch, 1, 1 << 20):
                texts = part.column(1).to_pylist()
                got, found = scores(texts)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(got, pa.float64()), pa.array([_spans(t, f) for t, f in zip(texts, found)], kind)], ["doc_id", "score", "sentences"])

    bounded_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(lean(run), f"doc_id {kind}, score double, sentences array<struct<start:int,end:int,probability:double>>")


def without_toxic(docs: DataFrame, model: NoisyOr | None, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, all columns, that score below threshold."""
    text = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = _scorer(model)
        for batch in batches:
            for part in sized(batch, text, 1 << 20):
                yield part.filter(pc.less(pa.array(scores(part.column(text).to_pylist())[0], pa.float64()), threshold))

    bounded_batches(docs.sparkSession)
    return docs.mapInArrow(lean(run), docs.schema)


def learnable(labels: DataFrame) -> DataFrame:
    """The label rows that are not held out."""
    return labels.where(bucket_crc(F.col("doc_id"), 3) != 1)


def op4_noisy_or(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fitted(docs, learnable(table(spark, sf_dir, "labels")))
    return score(docs, model).select("doc_id", (bucket_crc(F.col("doc_id"), 3) == 1).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "sentences")
