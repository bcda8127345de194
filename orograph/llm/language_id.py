"""Language identification: a bidirectional gated recurrent network over bytes.

The network reads running text in windows: CORE bytes that it labels and MARGIN bytes of context on either side, so that
every position of a text is labelled once and sees at least MARGIN bytes around it, words before and after its own
included. It gives a language distribution for every byte position; a document's distribution is the mean over all its
positions. It is trained in numpy by backpropagation through time on windows of a bounded sample.

Text is read in lower case as UTF-8; what isn't a letter or beyond ASCII is a boundary byte, and boundaries in a row are one.

Defined results: null text, empty text or text without a letter (Unicode category L) is ``und`` with score 0. If no
row may be learned from, every text is ``und`` with score 0. Repeated rows get equal results; other columns of
docs are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, bucket_crc, flat, lean, sized, table

CORE = 112
MARGIN = 16
BOUNDARY = 32
TRAIN_DOCS = 500
"""Documents of each language, at most, that the network learns from: those of the least id hash."""
PIECES = 12
"""Pieces of each of these documents, at hashed places, that a window is taken of."""
PIECE = 96
TRAIN_BYTES = 48
"""Bytes of a window that the network is trained on."""
WINDOWS_AT_ONCE = 2048

_KEEP = np.full(256, BOUNDARY, np.uint8)
_KEEP[0x61:0x7B] = np.arange(0x61, 0x7B)
_KEEP[0x80:] = np.arange(0x80, 0x100)


def byte_streams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """What the network reads of all texts end to end, and the n + 1 bounds."""
    data, at = flat(pc.utf8_lower(texts.cast(pa.large_string())))
    data = _KEEP[data]
    keep = data != BOUNDARY
    keep[1:] |= data[:-1] != BOUNDARY
    keep[at[:-1][at[:-1] < len(data)]] = True
    done = np.concatenate([[0], np.cumsum(keep)])
    return data[keep], done[at]


def windows(data: np.ndarray, bounds: np.ndarray, core: int = CORE, margin: int = MARGIN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows over all texts (one a row; boundaries where a text has no byte), each one's text, and how many of its
    core's positions are the text's."""
    size = np.diff(bounds)
    number = -(-size // core)
    text = np.repeat(np.arange(len(size)), number)
    first = (np.arange(len(text)) - np.repeat(np.cumsum(number) - number, number)) * core
    at = first[:, None] + np.arange(-margin, core + margin)[None, :]
    inside = (at >= 0) & (at < size[text, None])
    seq = np.full(at.shape, BOUNDARY, np.uint8)
    seq[inside] = data[(at + bounds[text, None])[inside]]
    return seq, text, np.minimum(core, size[text] - first)


class ByteNetwork:
    """Two gated recurrent layers, one for each direction, and a softmax at every position."""

    def __init__(self, languages: list[str], hidden: int = 16, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        self.languages, self.hidden = languages, hidden
        shape = {"x": (256, 3 * hidden), "u": (hidden, 3 * hidden)}
        self.p = {f"{k}{d}": (rng.normal(size=s) * (0.3 if k == "x" else hidden**-0.5)).astype(np.float32) for d in "fb" for k, s in shape.items()}
        self.p |= {f"c{d}": np.zeros(3 * hidden, np.float32) for d in "fb"}
        self.p |= {"o": (rng.normal(size=(2 * hidden, len(languages))) * 0.2).astype(np.float32), "ob": np.zeros(len(languages), np.float32)}

    def _gates(self, d: str) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Weights by byte and of the state, an array for each gate; sigmoid(x) is (1 + tanh(x / 2)) / 2, and the halves are in the weights."""
        k = self.hidden
        split = lambda w: [np.ascontiguousarray(w[:, i * k : (i + 1) * k] * w.dtype.type(0.5 if i < 2 else 1)) for i in range(3)]
        return split(self.p[f"x{d}"] + self.p[f"c{d}"]), split(self.p[f"u{d}"])

    def _states(self, d: str, seq: np.ndarray) -> Iterator[tuple]:
        """Position, the state before it, what the gates make of it and the state after it, in direction d."""
        k, t = self.hidden, seq.shape[1]
        by_byte, inner = self._gates(d)
        h = np.zeros((len(seq), k), by_byte[0].dtype)
        for i in range(t) if d == "f" else range(t - 1, -1, -1):
            byte = seq[:, i]
            z, r = ((np.tanh(by_byte[g][byte] + h @ inner[g]) + 1) * h.dtype.type(0.5) for g in (0, 1))
            uc = h @ inner[2]
            new = np.tanh(by_byte[2][byte] + r * uc)
            after = h + z * (new - h)
            yield i, h, z, r, new, uc, after
            h = after

    def positions(self, seq: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Language probabilities of every position, (time, window, language). keep gets what backpropagation needs."""
        s = np.zeros((seq.shape[1], len(seq), len(self.languages)), self.p["o"].dtype)
        for d, o in (("f", self.p["o"][: self.hidden]), ("b", self.p["o"][self.hidden :])):
            for step in self._states(d, seq):
                s[step[0]] += step[-1] @ o
                if keep is not None:
                    keep.setdefault(d, []).append(step)
        s += self.p["ob"]
        s -= s.max(axis=2, keepdims=True)
        np.exp(s, out=s)
        s /= s.sum(axis=2, keepdims=True)
        return s

    def core(self, seq: np.ndarray, margin: int = MARGIN) -> np.ndarray:
        """positions(seq) between the margins as (language, time, window), without what is not needed for it: each direction ends
        at its far margin, no margin is labelled, and steps write into the same arrays."""
        n, t = seq.shape
        kind = self.p["o"].dtype
        s = np.zeros((len(self.languages), t - 2 * margin, n), kind)
        bytes_at = np.ascontiguousarray(seq.T).astype(np.intp)
        z, r, new, part, h = (np.zeros((n, self.hidden), kind) for _ in range(5))
        half, one = kind.type(0.5), kind.type(1)
        for d, o in (("f", self.p["o"][: self.hidden]), ("b", self.p["o"][self.hidden :])):
            by_byte, inner = self._gates(d)
            h[:] = 0
            for i in range(t - margin) if d == "f" else range(t - 1, margin - 1, -1):
                for gate, out in enumerate((z, r, new)):
                    np.take(by_byte[gate], bytes_at[i], axis=0, out=out, mode="clip")
                    np.matmul(h, inner[gate], out=part)
                    if gate == 2:
                        part *= r
                    out += part
                    np.tanh(out, out=out)
                    if gate < 2:
                        out += one
                        out *= half
                new -= h
                new *= z
                h += new
                if margin <= i < t - margin:
                    s[:, i - margin] += o.T @ h.T
        s += self.p["ob"][:, None, None]
        s -= s.max(axis=0)
        np.exp(s, out=s)
        s /= s.sum(axis=0)
        return s

    def gradients(self, seq: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean negative log-probability of the label over all positions."""
        keep: dict = {}
        d_s = self.positions(seq, keep)
        n, t = seq.shape
        d_s[:, np.arange(n), label] -= 1
        d_s /= n * t
        g = {name: np.zeros_like(v) for name, v in self.p.items()}
        g["ob"] = d_s.sum((0, 1))
        for d, half in (("f", slice(0, self.hidden)), ("b", slice(self.hidden, None))):
            back = np.zeros((n, self.hidden), self.p["o"].dtype)
            u_t, o_t = self.p[f"u{d}"].T, self.p["o"][half].T
            for i, h, z, r, new, uc, after in reversed(keep[d]):
                g["o"][half] += after.T @ d_s[i]
                d_h = d_s[i] @ o_t + back
                d_new = d_h * z * (1 - new * new)
                d_z = d_h * (new - h) * z * (1 - z)
                d_r = d_new * uc * r * (1 - r)
                d_a = np.concatenate([d_z, d_r, d_new], axis=1)
                d_u = np.concatenate([d_z, d_r, d_new * r], axis=1)
                np.add.at(g[f"x{d}"], seq[:, i], d_a)
                g[f"c{d}"] += d_a.sum(0)
                g[f"u{d}"] += h.T @ d_u
                back = d_h * (1 - z) + d_u @ u_t
        return g

    def train(self, seq: np.ndarray, labels: np.ndarray, steps: int = 500, batch: int = 160, rate: float = 0.02, seed: int = 11) -> None:
        """Adam over batches of windows; every language has the same share of a batch's windows."""
        rng = np.random.default_rng(seed)
        by_language = [np.flatnonzero(labels == k) for k in range(len(self.languages))]
        by_language = [at for at in by_language if len(at)]
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v2 = {k: np.zeros_like(v) for k, v in self.p.items()}
        for step in range(1, steps + 1):
            of = rng.integers(0, len(by_language), batch)
            at = np.array([by_language[k][rng.integers(0, len(by_language[k]))] for k in of.tolist()])
            g = self.gradients(seq[at], labels[at])
            now = rate * (1 - 0.95 * step / steps)
            for k in self.p:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v2[k] = 0.99 * v2[k] + 0.01 * g[k] ** 2
                self.p[k] -= (now * (m[k] / (1 - 0.9**step)) / (np.sqrt(v2[k] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)

    def pooled(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """For each text the mean over its positions of the language probabilities; 0 for a text without positions."""
        total = np.zeros((len(bounds) - 1, len(self.languages)))
        seq, text, own = windows(data, bounds)
        for lo in range(0, len(seq), WINDOWS_AT_ONCE):
            at = slice(lo, lo + WINDOWS_AT_ONCE)
            prob = self.core(seq[at])
            prob *= np.arange(CORE)[:, None] < own[None, at]
            np.add.at(total, text[at], prob.sum(1, dtype=np.float64).T)
        return total / np.maximum(1, np.diff(bounds))[:, None]


def sample_windows(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Windows of a bounded number of documents of each language, with the language's number.

    Languages that have fewer documents are used whole. A document gives PIECES pieces of PIECE characters, at places
    that a hash of its id tells, so what reaches the driver is bounded for texts of any length. The driver holds a number for each language.
    """
    usable = docs.select("doc_id", "lang", "text").where(F.col("lang").isNotNull() & (F.length("text") > 0) & (bucket_crc(F.col("doc_id"), 4) != 2))
    share = {r["lang"]: min(1.0, 1.5 * train_docs / r["n"]) for r in usable.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not share:
        return np.zeros((0, TRAIN_BYTES), np.uint8), np.zeros(0, int), []
    top = float(1 << 63)
    chosen = F.lit(False)
    mark = F.xxhash64("doc_id", F.lit(3))
    for lang, s in share.items():
        chosen = chosen | ((F.col("lang") == lang) & (mark.cast("double") < F.lit((2 * s - 1) * top if s < 1 else 2 * top)))
    place = lambda k: F.pmod(F.xxhash64("doc_id", k), F.length("text")).cast("int") + 1
    pieces = F.transform(F.sequence(F.lit(1), F.lit(PIECES)), lambda k: F.substring(F.col("text"), place(k), F.lit(PIECE)))
    languages, taken = sorted(share), dict.fromkeys(share, 0)
    rows = usable.where(chosen).select("lang", pieces.alias("pieces"), mark.alias("mark"), "doc_id", F.xxhash64("text").alias("hash"))
    found: list[str] = []
    labels: list[int] = []
    for r in rows.orderBy("mark", "doc_id", "hash", "lang").limit(2 * train_docs * len(languages)).toLocalIterator():
        if taken[r["lang"]] < train_docs:
            taken[r["lang"]] += 1
            found += r["pieces"]
            labels += [languages.index(r["lang"])] * len(r["pieces"])
    data, bounds = byte_streams(pa.array(found, pa.string()))
    seq, text, _ = windows(data, bounds, TRAIN_BYTES, 0)
    first = np.unique(text, return_index=True)[1]  # one window a piece: the first
    first = first[np.diff(bounds)[text[first]] >= 4]
    return seq[first], np.array(labels, int)[text[first]], languages


def fitted(docs: DataFrame, train_docs: int = TRAIN_DOCS, steps: int = 500) -> ByteNetwork | None:
    seq, labels, languages = sample_windows(docs, train_docs)
    if not len(seq):
        return None
    net = ByteNetwork(languages)
    net.train(seq, labels, steps)
    return net


def identify(docs: DataFrame, net: ByteNetwork | None) -> DataFrame:
    """doc_id, lang_pred and score of every row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sized(batch, 1):
                texts = part.column(1)
                lettered = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False) & (net is not None)
                langs, scores = ["und"] * len(part), np.zeros(len(part))
                if lettered.any():
                    mean = net.pooled(*byte_streams(texts))
                    best = mean.argmax(1)
                    langs = [net.languages[b] if has else "und" for b, has in zip(best.tolist(), lettered.tolist())]
                    scores = np.where(lettered, np.minimum(1.0, mean[np.arange(len(best)), best]), 0.0)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    bounded_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(lean(run), f"doc_id {kind}, lang_pred string, score double")


def op10_byte_gru(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = (bucket_crc(F.col("doc_id"), 4) == 2).alias("held_out")
    return identify(docs, fitted(docs)).select("doc_id", held, "lang_pred", "score")
