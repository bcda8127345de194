"""Main texts against a plain Python count of all runs of a host's pages, whole tables and small shards."""

from __future__ import annotations

from collections import defaultdict
from urllib.parse import urlsplit

import pytest

from orograph.llm import html_text as H


def plain(pages: list[tuple[int, str, str]]) -> dict[int, tuple[str, int, int]]:
    hosts = defaultdict(list)
    for page_id, url, html in pages:
        hosts[urlsplit(url).hostname].append((page_id, H.blocks(html)))
    out = {}
    for members in hosts.values():
        everywhere, outside = defaultdict(set), defaultdict(set)
        words = lambda page, article: [w for kind, text in page if (kind == H.ARTICLE) == article for w in text.split(" ")]
        runs = lambda stream: [tuple(stream[i : i + H.MIN_TOKENS]) for i in range(len(stream) - H.MIN_TOKENS + 1)]
        for page_id, page in members:
            for article in (False, True):
                for run in runs(words(page, article)):
                    everywhere[run].add(page_id)
                    if not article:
                        outside[run].add(page_id)
        wide = {run for run, on in everywhere.items() if len(on) >= max(H.HOST_PAGES, H.HOST_SHARE * len(members))}
        shared = {run for run, on in outside.items() if len(on) > 1}
        for page_id, page in members:
            covered = {}
            for article in (False, True):
                stream = words(page, article)
                for k, flagged in enumerate((wide, shared if not article else set())):
                    hit = {i + d for i, run in enumerate(runs(stream)) if run in flagged for d in range(H.MIN_TOKENS)}
                    covered[article, k] = [i in hit for i in range(len(stream))]
            at, left, by_array, by_markup = {False: 0, True: 0}, [], 0, 0
            for kind, text in page:
                own, article = text.split(" "), kind == H.ARTICLE
                span = range(at[article], at[article] + len(own))
                at[article] += len(own)
                both = [covered[article, 0][i] or covered[article, 1][i] for i in span]
                gone = both if kind == H.NAMED or 2 * sum(both) >= len(own) else [covered[article, 0][i] for i in span]
                by_array += sum(gone)
                if kind == H.NAMED:
                    by_markup += len(own) - sum(gone)
                elif not all(gone):
                    left.append(" ".join(w for w, g in zip(own, gone) if not g))
            out[page_id] = "\n".join(left), by_array, by_markup
    return out


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet("/root/testdata/sf0.01/pages.parquet")


@pytest.mark.parametrize("shard", [2000, 7])
def test_texts_by_plain_python(pages, monkeypatch, shard):
    monkeypatch.setattr(H, "SHARD_PAGES", shard)
    want = plain([tuple(r) for r in pages.select("page_id", "url", "html").collect()])
    got = {r["page_id"]: (r["text"], r["by_array"], r["by_markup"]) for r in H.main_text(pages).collect()}
    assert got == want
    assert sum(x[1] for x in got.values()) > 500 and sum(x[2] for x in got.values()) > 500


def test_open_boilerplate_goes_by_the_array_alone(spark):
    menu = "Home News Sport Weather Culture Travel Science Archive Contact"
    own = lambda i: " ".join(f"word{i}x{k}" for k in range(12))
    rows = [(i, "http://h/", f"<div>{menu}</div><div>{own(i)}</div><footer>rare {i}</footer>") for i in range(3)]
    got = H.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["page_id"]: (r["text"], r["by_array"], r["by_markup"]) for r in got} == {i: (own(i), 9, 2) for i in range(3)}
