"""Main text of web pages: markup roles and a suffix array over each host's pages.

A page is read into blocks, each within the article, within a part that is named as boilerplate, or
open (neither). All words of a host's pages are streams (a page's words within articles, and its others) whose suffix
array is built; it groups equal runs of MIN_TOKENS words, and a run's pages are counted. Coverage decides first:

* a run on HOST_SHARE of the host's pages and on HOST_PAGES at least is host-wide: its words go wherever they stand, in articles too;
* a run that two pages share outside articles goes from named blocks, and from open blocks of which it and its like
  cover half or more; a passage that a few articles quote, or that is a lesser part of an open block, stays.

What the array leaves of named blocks goes by their markup, which is the hint that takes boilerplate of one page alone. The text
of a page is what is left of its article and its open blocks, in page order; by_array and by_markup say how many words went either way.

A host with more pages or bytes than a shard takes is cut by page into shards of bounded size; counts of pages are
those of the whole host all the same, so where the cuts fall doesn't change a text. Equality of runs rests on 64-bit codes: two given
runs that differ share one with a chance of about 2^-64.

An article or main part inside a named one is an article again, except in comments, asides, lists of related pages and
what is hidden.

Defined results: null, empty or wordless html gives an empty text. Rows of one page_id (of one url, if that is
null) are one page and don't count as repeats of each other. A null url is a host of its own name. An unclosed
tag, comment or quotation ends with the page. Columns besides page_id, url and html are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, in_runs, lean, run_codes, span_codes, spans, stored, table, text_chunks
from .decontamination import SuffixArray

MIN_TOKENS = 8
HOST_PAGES = 4
HOST_SHARE = 0.5
"""A run on this share of a host's pages, and on HOST_PAGES at least, is host-wide."""
SHARD_PAGES = 2000
SHARD_BYTES = 32 << 20
BROADCAST_HOSTS = 200_000

ARTICLE, NAMED, OPEN, CLOSED = 0, 1, 2, 3
"""CLOSED: named, and an article in it is no article."""

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>\"']++|\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_NO_TEXT = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "object", "canvas", "audio", "video", "select", "xmp", "noembed", "noframes", "head"}
_NAMED_TAGS = {"nav", "footer", "aside", "form", "button", "dialog", "menu", "label", "fieldset"}
_BLOCKS = set("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split())
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
_NAMED_WORDS = set("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar widget widgets menu nav navbar navigation breadcrumb breadcrumbs footer masthead cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup share sharing social comment comments reply replies disqus respond related recommended recommendations toolbar pagination pager copyright login search".split())
_OUTSIDE_WORDS = {"header", "topbar", "top"}
_NAMED_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "form", "menu"}
_CLOSED_WORDS = set("comment comments reply replies disqus respond related recommended recommendations".split())
_WRAPPERS = {"html", "body", "main"}
_WORDS = re.compile(r"[a-z]+")


def _named(name: str, attributes: str, within: bool) -> int:
    """NAMED or CLOSED if this element is boilerplate by its name or attributes, else OPEN. within: inside an article.

    A class or id counts whole: all its words have to be telling (cookie-banner, but not has-sidebar). What wraps a
    whole page isn't named by class, id or role."""
    found = CLOSED if name == "aside" else NAMED if name in _NAMED_TAGS or name == "header" and not within else OPEN
    for m in _ATTRIBUTE.finditer(attributes) if attributes and name not in ("html", "body") else ():
        key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none", value):
            return CLOSED
        if key not in ("class", "id", "role") or name in _WRAPPERS:
            continue
        for one in value.split():
            words = set(_WORDS.findall(one))
            if words and words <= (_NAMED_ROLES if key == "role" else _NAMED_WORDS if within else _NAMED_WORDS | _OUTSIDE_WORDS):
                found = CLOSED if words & _CLOSED_WORDS or one == "complementary" else NAMED if found == OPEN else found
    return found


def blocks(html: str | None) -> list[tuple[int, str]]:
    """The page's blocks in order: where each stands, and its text with references decoded and white space single."""
    out: list[tuple[int, str]] = []
    open_: list[tuple[str, int]] = []
    text: list[str] = []
    side: list[str] = []  # of named elements within a line: their text leaves the block around them whole
    inline = 0
    place, at, html = OPEN, 0, html or ""

    def flush() -> None:
        for kind, held in ((place, text), (NAMED, side)):
            if held:
                words = unescape("".join(held)).split()
                if words:
                    out.append((kind, " ".join(words)))
                held.clear()

    def settle() -> None:
        """The place of what follows, by the elements that are open."""
        nonlocal place, inline
        closed, new, inline = False, OPEN, 0
        for name, kind in open_:
            if kind == ARTICLE and not closed:
                new, inline = ARTICLE, 0
            elif kind in (NAMED, CLOSED):
                closed = closed or kind == CLOSED
                if name in _BLOCKS:
                    new = NAMED
                else:
                    inline += 1
        if new != place:
            flush()
            place = new

    n = len(html)
    while at < n:
        m = _TAG.search(html, at)
        if m is None:
            (side if inline else text).append(html[at:])
            break
        if m.start() > at:
            (side if inline else text).append(html[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        name = m[2].lower()
        if not m[1] and name in _NO_TEXT:
            end = re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*>?", re.I).search(html, at)
            if name != "head" or end:
                at = end.end() if end else n
            flush() if name in ("head", "title") else (side if inline else text).append(" ")
        elif name == "br":
            (side if inline else text).append(" ")
        elif m[1]:
            if name in _BLOCKS:
                flush()
            for k in range(len(open_) - 1, -1, -1):
                if open_[k][0] == name:
                    del open_[k:]
                    settle()
                    break
        else:
            block = name in _BLOCKS
            if block:
                flush()
                if open_ and open_[-1][0] in ("p", *_HEADINGS) and name not in ("b", "i"):
                    open_.pop()
                    settle()
                if open_ and open_[-1][0] == name and name in ("li", "dt", "dd", "td", "th", "tr", "option"):
                    open_.pop()
                    settle()
            if name in _VOID or m[3].endswith("/") and not block:
                continue
            within = any(kind == ARTICLE for _, kind in open_)
            kind = _named(name, m[3], within)
            if kind == OPEN and name in ("article", "main"):
                kind = ARTICLE
            if block or kind != OPEN:
                open_.append((name, kind))
                settle()
    flush()
    return out


class Runs:
    """The runs of least tokens in streams of word codes: equal runs are one group, numbered in the order of the
    suffix array; no stream's run goes on over its end."""

    def __init__(self, tokens: np.ndarray, bounds: np.ndarray, owner_of: np.ndarray, least: int = MIN_TOKENS) -> None:
        """owner_of: the owner's number for each stream."""
        self.tokens, self.least = tokens, least
        self.starts = self.group = self.owner = np.zeros(0, np.int64)
        self.n_owners = int(owner_of.max()) + 1 if len(owner_of) else 0
        size = np.diff(bounds)
        if len(tokens) >= least:
            sa = SuffixArray(tokens, bounds, least)
            left = np.repeat(bounds[1:], size) - np.arange(len(tokens))
            whole = sa.word_at[sa.order]
            whole = (whole >= 0) & (left[whole] >= least)
            self.starts = sa.word_at[sa.order[whole]]
            group = np.cumsum(sa.fresh)[whole]
            self.group = np.cumsum(np.diff(group, prepend=group[:1]) > 0)
            self.owner = np.repeat(owner_of, size)[self.starts]
        self.n_groups = int(self.group[-1]) + 1 if len(self.group) else 0

    def owners(self, where: np.ndarray | None = None) -> np.ndarray:
        """How many owners have each group; where: only at these of the starts."""
        group, owner = (self.group, self.owner) if where is None else (self.group[where], self.owner[where])
        return np.bincount(np.unique(group * self.n_owners + owner) // max(1, self.n_owners), minlength=self.n_groups)

    def covered(self, groups: np.ndarray, where: np.ndarray | None = None) -> np.ndarray:
        """Which tokens lie in a run of the flagged groups."""
        return _covered(self.starts[groups[self.group] if where is None else groups[self.group] & where], self.least, len(self.tokens))


def _covered(starts: np.ndarray, least: int, n: int) -> np.ndarray:
    begins = np.zeros(n, bool)
    begins[starts] = True
    return in_runs(begins, least, n)


def _numbered(owners: list[str]) -> np.ndarray:
    names: dict[str, int] = {}
    return np.array([names.setdefault(o, len(names)) for o in owners], np.int64)


def repeated(streams: list[list[str]], owners: list[str], least: int = MIN_TOKENS) -> list[np.ndarray]:
    """For each stream, which of its tokens lie in a run of least tokens or more that two owners' streams share."""
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in streams])]).astype(np.int64)
    codes: dict[str, int] = {}
    tokens = np.fromiter((codes.setdefault(t, len(codes)) for s in streams for t in s), np.uint64, int(bounds[-1]))
    runs = Runs(tokens, bounds, _numbered(owners), least)
    covered = runs.covered(runs.owners() > 1)
    return [covered[a:b] for a, b in zip(bounds[:-1], bounds[1:])]


def _codes(streams: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all words of streams whose words are parted by single spaces, and the n + 1 bounds."""
    codes, sizes = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
    raw = [s.encode("utf-8", "replace") for s in streams]
    for lo, hi in text_chunks(np.array([len(r) for r in raw])):
        at = np.concatenate([[0], np.cumsum([len(r) for r in raw[lo:hi]])])
        data = np.frombuffer(b"".join(raw[lo:hi]), np.uint8)
        starts, ends = spans(data != 0x20, at)
        codes.append(span_codes(data, starts, ends))
        sizes.append(np.diff(np.searchsorted(starts, at)))
    return np.concatenate(codes), np.cumsum(np.concatenate(sizes))


class Shard:
    """Pages of one host. Each page is two streams of one owner, the words outside articles and those within."""

    def __init__(self, pages: list[list[tuple[int, str]]], owners: list[str]) -> None:
        self.pages, self.owner = pages, np.repeat(_numbered(owners), 2)
        self.tokens, self.bounds = _codes([" ".join(text for kind, text in page if (kind == ARTICLE) == article) for page in pages for article in (False, True)])

    def counted(self) -> None:
        """Builds the suffix array and counts the pages of each run."""
        self.runs = Runs(self.tokens, self.bounds, self.owner)
        stream = np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))
        self.outside = stream[self.runs.starts] % 2 == 0
        self.n_all, self.n_outside = self.runs.owners(), self.runs.owners(self.outside)

    def own_texts(self) -> list[tuple[str, int, int]]:
        """Main texts of a host that is this shard alone."""
        self.counted()
        wide = self.runs.covered(self.n_all >= least_pages(self.runs.n_owners))
        return self.texts(wide, self.runs.covered(self.n_outside > 1, self.outside))

    def coded(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where each run begins, its code (equal in all shards) and its stream, without a suffix array."""
        size = np.diff(self.bounds)
        codes = run_codes(self.tokens, MIN_TOKENS)
        at = np.flatnonzero((np.repeat(self.bounds[1:], size) - np.arange(len(self.tokens)) >= MIN_TOKENS)[: len(codes)])
        return at, codes[at].view(np.int64), np.repeat(np.arange(len(size)), size)[at]

    def texts(self, wide: np.ndarray, shared: np.ndarray) -> list[tuple[str, int, int]]:
        """Main texts and how many words went by the array and by markup alone, given which tokens are covered by runs that are
        host-wide and by those that two pages share outside articles."""
        out = []
        for k, page in enumerate(self.pages):
            at, left, by_array, by_markup = [int(self.bounds[2 * k]), int(self.bounds[2 * k + 1])], [], 0, 0
            for kind, text in page:
                words = text.split(" ")
                side = int(kind == ARTICLE)
                a, b = at[side], at[side] + len(words)
                at[side] = b
                gone = wide[a:b]
                both = gone if kind == ARTICLE else gone | shared[a:b]
                if kind == NAMED or 2 * int(both.sum()) >= len(words):
                    gone = both
                n = int(gone.sum())
                by_array += n
                if kind == NAMED:
                    by_markup += len(words) - n
                    continue
                if n:
                    text = " ".join(w for w, g in zip(words, gone) if not g)
                if text:
                    left.append(text)
            out.append(("\n".join(left), by_array, by_markup))
        return out


def least_pages(pages: int) -> float:
    """On so many of a host's pages a run is host-wide."""
    return max(HOST_PAGES, HOST_SHARE * pages)


def _hosts(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The pages with their host and part, and the hosts of more than one part (__host, __parts). All rows of a page
    are in one part."""
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    own = pages.select("page_id", "url", "html").withColumn("__host", host)
    parts = F.ceil(F.greatest(F.count("*") / SHARD_PAGES, F.sum(F.coalesce(F.octet_length("html"), F.lit(0))) / SHARD_BYTES)).cast("int")
    hot = stored(own.groupBy("__host").agg(parts.alias("__parts")).where("__parts > 1"), "hosts")
    hot = F.broadcast(hot) if hot.limit(BROADCAST_HOSTS + 1).count() <= BROADCAST_HOSTS else hot
    owner = F.when(F.col("page_id").isNotNull(), F.xxhash64("page_id")).otherwise(F.xxhash64("url"))
    part = F.when(F.col("__parts").isNotNull(), F.pmod(owner, F.col("__parts"))).otherwise(-1).cast("int")
    return own.join(hot, "__host", "left").select("__host", part.alias("__part"), "page_id", "url", "html"), hot


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        packed = [pack("\n".join(f"{kind}{text}" for kind, text in blocks(h)).encode("utf-8", "replace")) for h in batch.column(4).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(packed, pa.binary())], ["__host", "__part", "page_id", "url", "blocks"])


def _shard(rows: pa.Table) -> Shard:
    unpack = zstandard.ZstdDecompressor().decompress
    pages = [[(int(line[0]), line[1:]) for line in unpack(b).decode().split("\n") if line] for b in rows.column("blocks").to_pylist()]
    ids, urls = rows.column("page_id").to_pylist(), rows.column("url").to_pylist()
    return Shard(pages, [f"#{i}" if i is not None else f"@{u}" for i, u in zip(ids, urls)])


def _out(rows: pa.Table, texts: list[tuple[str, int, int]]) -> pa.Table:
    own = [pa.array([t[k] for t in texts], kind) for k, kind in enumerate((pa.string(), pa.int64(), pa.int64()))]
    return pa.table([rows.column("page_id"), rows.column("url"), *own], ["page_id", "url", "text", "by_array", "by_markup"])


def _by_host(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows sorted by host; one host is held at a time."""
    held: list[pa.RecordBatch] = []

    def out() -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held)
        yield from _out(rows, _shard(rows).own_texts()).combine_chunks().to_batches()

    last = None
    for batch in batches:
        names = batch.column(0).to_pylist()
        cuts = [0, *(i for i in range(1, len(names)) if names[i] != names[i - 1]), len(names)]
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            if hi > lo:
                if held and names[lo] != last:
                    yield from out()
                    held.clear()
                held.append(batch.slice(lo, hi - lo))
                last = names[lo]
    if held:
        yield from out()


# Hosts of several shards. Each shard's suffix array gives its runs by their codes. A run on a share of all pages of a host is
# on that share of the pages of a shard at least: those runs of the shards are the only candidates for host-wide ones. Each
# shard then counts the candidates of its host, and the sums tell which are host-wide. Runs outside articles are brought
# together by their codes, once a shard. The codes that are host-wide or shared mark the words of each shard.


def _found(rows: pa.Table) -> pa.Table:
    """A shard's candidates and runs outside articles by code; the row of a null code has the shard's pages."""
    shard = _shard(rows)
    shard.counted()
    runs = shard.runs
    likely = shard.n_all >= HOST_SHARE * runs.n_owners
    at = np.flatnonzero(likely | (shard.n_outside > 0))
    n = len(at) + 1
    first = np.unique(runs.group, return_index=True)[1][at] if len(at) else at
    codes = run_codes(runs.tokens, MIN_TOKENS)[runs.starts[first]].view(np.int64) if len(at) else np.zeros(0, np.int64)
    key = [pa.array([rows.column(k)[0].as_py()] * n, t) for k, t in (("__host", pa.string()), ("__part", pa.int32()))]
    counts = pa.array([*np.minimum(shard.n_outside[at], 2).tolist(), runs.n_owners], pa.int64())
    return pa.table([*key, pa.array([*codes.tolist(), None], pa.int64()), pa.array([*likely[at].tolist(), False], pa.bool_()), counts], ["__host", "__part", "code", "likely", "n"])


def _counted(rows: pa.Table, candidates: pa.Table) -> pa.Table:
    """How many pages of a shard have each of the candidates."""
    if not len(rows) or not len(candidates):
        return pa.table([pa.array([], pa.string()), pa.array([], pa.int64()), pa.array([], pa.int64())], ["__host", "code", "n"])
    shard = _shard(rows)
    _, codes, stream = shard.coded()
    asked = np.unique(candidates.column("code").to_numpy())
    hit = np.isin(codes, asked)
    which = np.searchsorted(asked, codes[hit])
    pages = np.unique(which * len(shard.owner) + shard.owner[stream[hit]]) // max(1, len(shard.owner))
    n = np.bincount(pages, minlength=len(asked))
    at = np.flatnonzero(n)
    return pa.table([pa.array([rows.column("__host")[0].as_py()] * len(at), pa.string()), pa.array(asked[at]), pa.array(n[at].astype(np.int64))], ["__host", "code", "n"])


def _marked(rows: pa.Table, marks: pa.Table) -> pa.Table:
    """Main texts of a shard, given the codes of runs that are host-wide and of those that two pages share outside articles."""
    if not len(rows):
        return _out(rows, [])
    shard = _shard(rows)
    at, codes, stream = shard.coded()
    code, wide = marks.column("code").to_numpy(), marks.column("wide").to_numpy(zero_copy_only=False).astype(bool)
    n = len(shard.tokens)
    everywhere = _covered(at[np.isin(codes, code[wide])], MIN_TOKENS, n)
    return _out(rows, shard.texts(everywhere, _covered(at[np.isin(codes, code[~wide]) & (stream % 2 == 0)], MIN_TOKENS, n)))


def _over_shards(parsed: DataFrame, hot: DataFrame, kind: str) -> DataFrame:
    """The results for pages of hosts of several shards."""
    shards = parsed.groupBy("__host", "__part")
    found = stored(shards.applyInArrow(_found, "__host string, __part int, code long, likely boolean, n long"), "runs")
    every = F.explode(F.sequence(F.lit(0), F.col("__parts") - 1)).alias("__part")
    to_all = lambda df: df.join(hot, "__host").select("__host", every, "code")
    candidates = stored(found.where("likely").select("__host", "code").distinct(), "candidates")
    pages = found.where("code is null").groupBy("__host").agg(F.sum("n").alias("__pages"))
    wide = candidates
    if not candidates.isEmpty():
        counted = shards.cogroup(to_all(candidates).groupBy("__host", "__part")).applyInArrow(_counted, "__host string, code long, n long")
        wide = counted.groupBy("__host", "code").agg(F.sum("n").alias("n")).join(pages, "__host").where(F.col("n") >= F.greatest(F.lit(float(HOST_PAGES)), HOST_SHARE * F.col("__pages")))
    outside = found.where("code is not null and n > 0").groupBy("__host", "code").agg(F.sum("n").alias("n"), F.collect_list("__part").alias("parts"))  # a number for each shard at most
    shared = outside.where("n > 1").select("__host", F.explode("parts").alias("__part"), "code")
    marks = to_all(wide.select("__host", "code")).withColumn("wide", F.lit(True)).unionByName(shared.withColumn("wide", F.lit(False)))
    return shards.cogroup(stored(marks, "marks").groupBy("__host", "__part")).applyInArrow(_marked, _RESULT.format(kind))


_RESULT = "page_id {}, url string, text string, by_array long, by_markup long"


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url and text of every row of pages, and how many words went by the suffix array and by markup alone."""
    bounded_batches(pages.sparkSession)
    kind = pages.schema["page_id"].dataType.simpleString()
    own, hot = _hosts(pages)
    schema = f"__host string, __part int, page_id {kind}, url string, blocks binary"
    whole = own.where("__part < 0").mapInArrow(lean(_parse), schema).repartition("__host").sortWithinPartitions("__host").mapInArrow(lean(_by_host), _RESULT.format(kind))
    if hot.isEmpty():
        return whole
    parsed = stored(own.where("__part >= 0").mapInArrow(lean(_parse), schema), "blocks")
    return whole.unionByName(_over_shards(parsed, hot, kind))


def op1_host_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = main_text(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "by_array", "by_markup")
