"""Each operator on nulls, empty and very long texts, repeated rows, clashing columns and empty tables."""

from __future__ import annotations

import pytest

from orograph.llm import decontamination, html_text, language_id, packing, quality_rules, sharding, simhash, surrogates, toxicity, warc


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(4, 1, 0), (5, 0, 1), (None, None, None), (6, None, None)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, "One line. Two"), (1, "One line. Two"), (2, None), (None, "no id"), (3, "")], "item_id long, text string")


def test_sharding(edges, nothing):
    rows = sharding.shuffled(edges, shards=4).collect()
    assert len(rows) == 11 and sorted(sum(r["shard"] == s for r in rows) for s in range(4)) == [2, 3, 3, 3]
    for s in range(4):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sum(r["shard"] == s for r in rows)))
    assert {r["size"] for r in rows if r["doc_id"] in (1, 2)} == {1}
    assert sharding.shuffled(nothing).count() == 0


def test_decontamination(edges, nothing, bench):
    rows = decontamination.matches(edges, bench).collect()
    by = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert len(rows) == 11 and by[4]["n_hit"] == 3 and by[4]["items"] == ["1"] and by[4]["longest"] == 3 and by[1]["n_words"] == 0
    unnamed = [r for r in rows if r["doc_id"] is None and r["n_words"]]
    assert unnamed[0]["n_hit"] == 2 and unnamed[0]["items"] == []
    assert decontamination.matches(nothing, bench).count() == 0
    assert decontamination.matches(edges, bench.where("false")).where("n_hit > 0").count() == 0
    assert decontamination.clean(edges, bench.where("item_id = 1")).columns == edges.columns


def test_toxicity(edges, nothing, labels):
    assert toxicity.fitted(edges, labels.where("false")) is None
    assert toxicity.score(nothing, None).count() == 0
    model = toxicity.NoisyOr()
    rows = toxicity.score(edges, model).collect()
    assert len(rows) == 11 and all(0 <= r["score"] <= 1 for r in rows) and [r["score"] for r in rows if r["doc_id"] in (1, 2, 3)] == [0.0, 0.0, 0.0]
    assert toxicity.without_toxic(edges, model).columns == edges.columns


def test_surrogates(edges, nothing):
    rows = surrogates.replaced(edges, "k").collect()
    assert len(rows) == 11 and {r["doc_id"]: r["text"] for r in rows}[2] == "" and surrogates.replaced(edges, "k").columns == edges.columns
    assert surrogates.replaced(nothing, "k").count() == 0


def test_packing(edges, nothing):
    rows = packing.packed(edges).collect()
    assert sum(r["start"] == 0 for r in rows) == 11 and sum(r["length"] for r in rows) == sum(r["doc_tokens"] for r in rows if r["start"] == 0)
    assert {r["doc_tokens"] for r in rows if r["doc_id"] in (1, 2, 3)} == {1}
    assert packing.packed(nothing).count() == 0


def test_simhash(edges, nothing):
    fps, of = simhash.near_duplicates(edges)
    by = {r["doc_id"]: r for r in fps.join(of, "fp").collect() if r["doc_id"] is not None}
    assert by[1]["fp"] == by[2]["fp"] == by[3]["fp"] == 0 and by[3]["component_id"] == 1 and by[8]["component_id"] == 5
    kept = simhash.one_of_each(edges)
    assert kept.columns == edges.columns and sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 4, 5, 6, 7]
    assert simhash.one_of_each(nothing).count() == 0


def test_quality(edges, nothing, labels):
    rows = quality_rules.quality(edges, labels).collect()
    by = {r["doc_id"]: r for r in rows}
    assert len(rows) == 11 and by[4]["n_dup_lines"] == 1 and by[5]["base_failed"] and by[5]["n_repeat_words"] == 60_000 and not by[1]["kept"]
    assert quality_rules.quality(nothing, labels.where("false")).count() == 0


def test_language(edges, nothing):
    assert {r["lang_pred"] for r in language_id.identify(edges, None).collect()} == {"und"}
    net = language_id.ByteNetwork(["a", "b"])
    by = {r["doc_id"]: r for r in language_id.identify(edges, net).collect()}
    assert by[1]["lang_pred"] == by[3]["lang_pred"] == "und" and by[6]["lang_pred"] in "ab" and 0 <= by[6]["score"] <= 1
    assert language_id.fitted(nothing) is None and language_id.identify(nothing, net).count() == 0


@pytest.fixture(scope="module")
def pages(spark):
    big = "<article><p>" + "long text " * 60_000 + "</p>"
    return spark.createDataFrame([(None, None, None, 1), (1, "http://a/b", "", 1), (2, "http://a/c", big, 1), (3, "http://a/d", big, 1), (4, None, "<p>unclosed <b>x", 1), (4, None, "<p>unclosed <b>x", 1)], "page_id long, url string, html string, text int")


def test_html(pages):
    by = {r["page_id"]: r["text"] for r in html_text.main_text(pages).collect()}
    assert by[None] == by[1] == "" and by[4] == "unclosed x" and by[2] == by[3] and len(by[2]) == 60_000 * 10 - 1
    assert html_text.main_text(pages.where("false")).count() == 0


def test_warc(pages):
    rows = {r["page_id"]: r for r in warc.records(*warc.archive(pages)).collect()}
    assert rows[2]["record_type"] == "revisit" and rows[2]["refers_to"] == 3 and rows[2]["payload_bytes"] == rows[3]["payload_bytes"] and rows[2]["payload_digest"] == rows[3]["payload_digest"]
    assert rows[None]["payload_bytes"] == rows[1]["payload_bytes"] == 0
    assert warc.records(*warc.archive(pages.where("false"))).count() == 0
