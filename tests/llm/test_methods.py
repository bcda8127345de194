"""Operators against brute force, exact round trips and held-out accuracy."""

from __future__ import annotations

import io
import re
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
import xxhash

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
import oracle

import corpus_pipeline
from orograph.llm import common, decontamination, html_text, language_id, packing, quality_rules, queries, sharding, simhash, surrogates, toxicity, warc
from pyspark.sql import functions as F

WORDS = re.compile("[^\x20\x09-\x0d]+")


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_rows_are_those_of_sql(spark, sf, name):
    sql = queries.oracle_sql()[name]
    con = oracle.connect(sf)
    assert oracle.compare(queries.queries()[name](spark, sf), con, sql) == ""


def test_communication_matrix_has_exact_sums_and_the_law_of_the_urn():
    rows = np.array([5, 0, 17, 40])
    m = sharding.communication_matrix(rows, 4)
    assert m.sum(1).tolist() == rows.tolist() and np.ptp(m.sum(0)) <= 1
    draws = np.array([sharding.communication_matrix(np.array([10, 30]), 2, seed)[0, 0] for seed in range(4000)])
    assert abs(draws.mean() - 5) < 0.1 and abs(draws.var() - 10 * 0.25 * 30 / 39) < 0.15


def test_shards_hold_all_columns_of_all_rows(spark, sf, docs):
    rows = sharding.sharded(docs, shards=5).collect()
    assert Counter(tuple(r["row"]) for r in rows) == Counter(map(tuple, docs.collect()))
    assert sorted((r["shard"], r["slot"]) for r in rows) == [(s, k) for s, n in sorted(Counter(r["shard"] for r in rows).items()) for k in range(n)]
    out = {r["doc_id"]: (r["text_crc32"], r["size"]) for r in queries.queries()["op2_hypergeometric"](spark, sf).collect()}
    assert out == {r["row"]["doc_id"]: (zlib.crc32(b := r["row"]["text"].encode()), len(b) + 1) for r in rows}


def test_fingerprints_by_brute_force(docs):
    def brute(text):
        w = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        h = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in ([w[i : i + 3] for i in range(len(w) - 2)] or ([w] if w else []))]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    got = {r["doc_id"]: r["fp"] & (2**64 - 1) for r in simhash.fingerprints(docs).collect()}
    for r in docs.limit(60).collect():
        assert got[r["doc_id"]] == brute(r["text"])


@pytest.mark.parametrize("hot", [False, True])
def test_links_by_brute_force(spark, hot):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 150, dtype=np.uint64)
    flips = [b ^ np.uint64(1 << int(i)) ^ np.uint64(1 << int(j)) for b in base for i, j in rng.integers(0, 63, (3, 2))]
    if hot:  # one crowded bucket: the same 32 bits in all
        flips += [np.uint64(0xABCD_EF01_0000_0000 | int(x)) for x in rng.integers(0, 1 << 11, 900)]
    u = np.unique(np.concatenate([base, np.array(flips, np.uint64)]))
    parent = list(range(len(u)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(u)):
        for j in np.flatnonzero(np.bitwise_count(u[i + 1 :] ^ u[i]) <= 2):
            a, b = find(i), find(i + 1 + int(j))
            parent[max(a, b)] = min(a, b)
    signed = u.view(np.int64).tolist()
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    root = {r["node"]: r["root"] for r in common.components(simhash.links(df)).collect()}
    for i, x in enumerate(signed):
        for j in (find(i),):
            assert root.get(x, x) == root.get(signed[j], signed[j])
    assert len({root.get(x, x) for x in signed}) == len({find(i) for i in range(len(u))})


def test_statistics_by_brute_force(docs):
    def brute(t):
        w = WORDS.findall(t or "")
        lines = [x for x in (t or "").split("\n") if WORDS.search(x)]
        c = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        inside = {i + k for i in range(len(w) - 4) if c[tuple(w[i : i + 5])] > 1 for k in range(5)}
        return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(inside)

    got = {r["doc_id"]: tuple(r)[1:6] for r in quality_rules.text_statistics(docs).collect()}
    for r in docs.collect():
        assert got[r["doc_id"]] == brute(r["text"])


def test_rules_reject_what_is_labelled_low():
    rng = np.random.default_rng(3)
    x = rng.random((3000, 2))
    bad = (x[:, 0] > 0.8) & (x[:, 1] < 0.4) | (x[:, 1] > 0.95)
    rules = quality_rules.learn_rules(x, bad, ["a", "b"])
    hit = np.zeros(3000, bool)
    for r in rules:
        hit |= quality_rules._covers(r, x, ["a", "b"])
    assert (hit == bad).mean() > 0.98


def test_suffix_array_is_in_order():
    rng = np.random.default_rng(2)
    codes = rng.integers(0, 4, 300).astype(np.uint64)
    bounds = np.array([0, 100, 100, 300])
    sa = decontamination.SuffixArray(codes, bounds, 40)
    text = sa.text.tolist()
    keys = [text[i : i + 40] for i in sa.order.tolist()]
    cut = [k[: k.index(0) + 1] if 0 in k else k for k in keys]
    assert sorted(sa.order.tolist()) == list(range(len(text))) and cut == sorted(cut)


def test_decontamination_in_blocks_is_the_same(spark, sf, docs, monkeypatch):
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    whole = sorted(map(str, decontamination.matches(docs, bench).collect()))
    monkeypatch.setattr(decontamination, "BLOCK_WORDS", 200)
    assert sorted(map(str, decontamination.matches(docs, bench).collect())) == whole


def test_longest_match_is_the_documents_own(spark):
    words = [f"w{k}" for k in range(40)]
    texts = [" ".join(words), "x y " + " ".join(words[5:15]) + " z", "x " + " ".join(words[7:11]) + " y w39", "nothing", " ".join(words[20:32]) + " q " + " ".join(words[2:13])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(words)), (2, "x")], "item_id long, text string")
    got = {r["doc_id"]: (r["longest"], r["place"]) for r in decontamination.matches(docs, bench).collect()}
    assert got == {0: (40, 0), 1: (10, 2), 2: (4, 1), 3: (0, -1), 4: (12, 0)}


def test_tokens_are_the_tokenizers_own(docs):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(packing.tokenizer_path())
    texts = [r["text"] for r in docs.collect()] + ["don't I'll 'x'", "<|endoftext|> <|ENDOFTEXT|>", "… é́ İ, x² ½", "日本語、12", "", "a\x1cb \x85 c"]
    ids, bounds = packing._Encoder(packing.tokenizer_path()).encode(pa.array(texts))
    for k, t in enumerate(texts):
        assert ids[bounds[k] : bounds[k + 1]].tolist() == [*plain.encode(t, add_special_tokens=False).ids, 2]


def test_packing_places_every_token_once(spark, sf):
    rows = queries.queries()["op7_nnls_packing"](spark, sf).toPandas()
    ordered = rows.sort_values(["sequence_id", "offset"])
    assert (ordered.groupby("sequence_id").length.cumsum() - ordered.length == ordered.offset).all()
    filled = rows.groupby("sequence_id").length.sum()
    assert filled.max() <= packing.WINDOW and filled.sum() / (len(filled) * packing.WINDOW) > 0.9


def test_sequences_hold_the_tokens_of_their_pieces(spark, sf, docs):
    rows = packing.packed(docs)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    ids, bounds = packing._Encoder(packing.tokenizer_path()).encode(pa.array(list(texts.values())))
    whole = {i: ids[a:b] for i, a, b in zip(texts, bounds[:-1], bounds[1:])}
    packed = {r["sequence_id"]: np.frombuffer(r["ids"], "<u4") for r in packing.sequences(rows).collect()}
    got = rows.collect()
    for r in got:
        own = whole[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert (np.frombuffer(r["ids"], "<u4") == own).all() and (packed[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]] == own).all()
    assert sum(map(len, packed.values())) == sum(r["length"] for r in got) == len(ids)
    out = {(r["doc_id"], r["start"]): r["ids_crc32"] for r in queries.queries()["op7_nnls_packing"](spark, sf).collect()}
    assert out == {(r["doc_id"], r["start"]): zlib.crc32(r["ids"]) for r in got}


def test_plan_uses_each_piece_once():
    rng = np.random.default_rng(4)
    h = np.concatenate([[0], rng.integers(0, 50, 256)])
    used = np.zeros(257, int)
    for way, times in packing.plan(h):
        assert sum(b * k for b, k in way) <= 256
        for b, k in way:
            used[b] += k * times
    assert (used == h).all()


def test_least_squares_is_non_negative_and_least():
    rng = np.random.default_rng(5)
    a, b = rng.random((20, 40)), rng.random(20)
    x = packing.least_squares(a, b)
    pull = a.T @ (b - a @ x)
    assert (x >= 0).all() and (pull < 1e-6).all() and np.abs(pull[x > 0]).max() < 1e-5


def test_records_survive_any_block_size():
    out = io.BytesIO()
    w = warc.RecordWriter(out)
    bodies = [b"", b"x" * 10, b"\r\n\r\n" * 50, bytes(range(256)) * 400]
    for k, body in enumerate(bodies):
        for n, lo in enumerate(range(0, max(1, len(body)), 1000)):
            w.chunk(k, "u", "response", None, "d", len(body), n, body[lo : lo + 1000])
    w.close_record()
    for block in (1, 7, 4096):
        got = [b"".join(p) for _, p in warc.RecordReader(io.BytesIO(out.getvalue()), block).records()]
        assert got == bodies


def test_repeated_runs_by_brute_force():
    rng = np.random.default_rng(6)
    streams = [[str(x) for x in rng.integers(0, 3, 60)] for _ in range(5)]
    seen: dict[tuple, set] = {}
    for k, s in enumerate(streams):
        for i in range(len(s) - 7):
            seen.setdefault(tuple(s[i : i + 8]), set()).add(k)
    got = html_text.repeated(streams, list("abcde"), 8)
    for k, s in enumerate(streams):
        want = np.zeros(60, bool)
        for i in range(53):
            if len(seen[tuple(s[i : i + 8])]) > 1:
                want[i : i + 8] = True
        assert (got[k] == want).all()


def test_boilerplate_goes_and_articles_stay(spark):
    menu = "Home News Sport Weather Culture Travel Science Archive Contact"
    rows = [(i, f"http://h/{i}", f"<body><div>{menu}</div><div>Story {i} of its own</div></body>") for i in range(3)]
    rows.append((9, "http://h/9", f"<nav>{menu}</nav><article><h1>T &amp; x</h1><p>good <span class='ad'>buy</span>text</p><div id=comments>no</div></article><footer>c</footer>"))
    got = {r["page_id"]: r["text"] for r in html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {0: "Story 0 of its own", 1: "Story 1 of its own", 2: "Story 2 of its own", 9: "T & x\ngood text"}


def test_host_wide_runs_leave_articles_and_quotations_stay(spark):
    notice = "All rights in these pages belong to their several authors and nobody else"
    quote = "It was the best of times and it was the worst of times by far"
    own = lambda i: " ".join(f"word{i}x{k}" for k in range(12))
    rows = [(i, f"http://h/{i}", f"<main><p>{own(i)} {notice}</p><p>{quote if i < 3 else own(i + 50)}</p></main>") for i in range(10)]
    rows.append((10, "http://h/10", f"<article>teaser</article><div>{own(10)}</div>"))
    got = {r["page_id"]: r["text"] for r in html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"{own(i)}\n{quote if i < 3 else own(i + 50)}" for i in range(10)} | {10: f"teaser\n{own(10)}"}


def test_shards_of_a_host_change_no_text(spark, monkeypatch):
    long = lambda name, n=12: " ".join(f"{name}x{k}" for k in range(n))
    rows = [(i, f"http://h/{i}", f"<div>{long(f'open{i // 2}')}</div><main><p>{long(f'own{i}')}</p><p>{long('wide' if i % 8 < 5 else f'many{i % 8}')}</p></main>") for i in range(40)]
    rows += [(50 + i, "http://g/", f"<p>{long('other')}</p><p>{long(f'own{i}')}</p>") for i in range(2)] + [(60, "http://f/", "<p>alone</p>")]
    rows += [(None, "http://h/a", f"<p>{long('same')}</p>")] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    texts = lambda: sorted(map(tuple, html_text.main_text(pages).collect()), key=str)
    whole = texts()
    assert {r[0]: r[2] for r in whole}[7] == f"{long('own7')}\n{long('many7')}" and {r[0]: r[2] for r in whole}[8] == long("own8")
    monkeypatch.setattr(html_text, "SHARD_PAGES", 6)
    assert texts() == whole


@pytest.mark.parametrize(
    "html",
    [
        "<body class='has-sidebar'><article>kept text</article></body>",
        "<body class='search-results'><p>kept text</p></body>",
        "<body class=search><div class='widget'>gone</div><main class='menu'>kept text</main></body>",
        "<div id='top'><article>kept text</article></div>",
        "<div class='content no-comments'>kept text</div>",
        "<form><main>kept text</main><div class='comments'><article>gone</article></div></form><aside><article>gone</article></aside>",
        "<article>kept <math><mi>text</mi></math><div class='cookie-banner'>gone</div><div hidden><article>gone</article></div></article>",
    ],
)
def test_class_names_of_wrappers_take_no_text(html):
    assert " ".join(text for kind, text in html_text.blocks(html) if kind != html_text.NAMED) == "kept text"


def test_surrogates_keep_format_and_people(spark):
    texts = ["Mail und.34@mail7.example.com or +1 (017) 555-7713, IP 97.51.17.173.", "Mrs. Anna Smith and Mr Jones; Smith left. 4111 1111 1111 1111", "und.34@mail7.example.com г-жа Анна Иванова", "no data 12"]
    out = [r["text"] for r in surrogates.replaced(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string"), "k").orderBy("doc_id").collect()]
    mail = r"\w{3}\.\d\d@\w{8}\.example"
    first = re.fullmatch(rf"Mail ({mail}) or \+1 \(\d{{3}}\) \d{{3}}-\d{{4}}, IP \d+\.\d+\.\d+\.\d+\.", out[0])
    assert first and out[2].startswith(first[1]) and re.search("г-жа [А-Я][а-я]+ла [А-Я][а-я]+$", out[2]) and out[3] == texts[3]
    person = re.fullmatch(r"Mrs\. \w+la (\w+) and Mr (\w+); (\w+) left\. \d{4} \d{4} \d{4} \d{4}", out[1])
    assert person and person[1] == person[3] != person[2] and "Smith" not in out[1]


@pytest.mark.parametrize("secret", ["AKIA" + "ABCDEFGHIJKLMNOP", "sk-" + "abcdefghij" * 2, "ghp_" + "abcdef" * 6, "abcdef" * 6, "ABCDEF" * 6])
def test_secrets_without_digits_are_replaced(spark, secret):
    out = surrogates.replaced(spark.createDataFrame([(1, f"key {secret} here")], "doc_id int, text string"), "k").first()["text"]
    assert secret not in out and re.fullmatch(r"key \S+ here", out) and len(out) == len(secret) + 9


def test_colliding_surrogates_are_drawn_again(spark, monkeypatch):
    plain = surrogates.part_surrogate
    monkeypatch.setattr(surrogates, "part_surrogate", lambda kind, value, attempt, key: F.when(attempt == 0, F.lit("same")).otherwise(plain(kind, value, attempt, key)))
    found = spark.createDataFrame([("ip", f"1.2.3.{i}") for i in range(5)], "kind string, value string")
    late = surrogates.checked(found, "k").collect()
    assert sorted(r["value"] for r in late) == [f"1.2.3.{i}" for i in range(1, 5)] and all(r["attempt"] == 1 for r in late)


def test_toxicity_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    rows = queries.queries()["op4_noisy_or"](spark, sf).where("held_out").join(labels, "doc_id").toPandas()
    assert ((rows.predicted == rows.toxic).mean() > 0.97) and rows[rows.toxic == 1].predicted.mean() > 0.8


def test_language_on_held_out_documents(spark, sf):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    rows = queries.queries()["op10_byte_gru"](spark, sf).where("held_out").join(docs, "doc_id").toPandas()
    assert (rows.lang == rows.lang_pred).mean() > 0.97


def test_language_by_a_plain_network(spark, docs):
    """Every window through a network written out gate by gate, one byte at a time."""
    net = language_id.ByteNetwork(["a", "b", "c"], hidden=3)
    sigmoid = lambda x: 1 / (1 + np.exp(-x))

    def labelled(window):
        side = {}
        for d in "fb":
            h, states, p = np.zeros(3), [], {n: net.p[n + d].astype(float) for n in "xuc"}
            for byte in window if d == "f" else window[::-1]:
                x, u = p["x"][byte] + p["c"], h @ p["u"]
                z, r = sigmoid(x[:3] + u[:3]), sigmoid(x[3:6] + u[3:6])
                h = (1 - z) * h + z * np.tanh(x[6:] + r * u[6:])
                states.append(h)
            side[d] = states if d == "f" else states[::-1]
        s = np.exp(np.concatenate([side["f"], side["b"]], axis=1) @ net.p["o"] + net.p["ob"])
        return s / s.sum(1, keepdims=True)

    def plain(text):
        read = re.sub(rb"[^a-z\x80-\xff]+", b" ", text.lower().encode())
        total = np.zeros(3)
        for lo in range(0, len(read), language_id.CORE):
            window = [read[i] if 0 <= i < len(read) else 32 for i in range(lo - language_id.MARGIN, lo + language_id.CORE + language_id.MARGIN)]
            total += labelled(window)[language_id.MARGIN :][: min(language_id.CORE, len(read) - lo)].sum(0)
        return total / len(read)

    some = docs.where("length(text) < 3000").limit(12).union(spark.createDataFrame([(-1, "½ ² 12 —", None, None, 0), (-2, "½ é", None, None, 0), (-3, None, None, None, 0)], docs.schema))
    got = {r["doc_id"]: r for r in language_id.identify(some, net).collect()}
    for r in some.collect():
        mean = plain(r["text"]) if r["text"] and any(map(str.isalpha, r["text"])) else None
        mine = got[r["doc_id"]]
        assert (mine["lang_pred"], mine["score"]) == ("und", 0.0) if mean is None else mine["lang_pred"] == "abc"[mean.argmax()] and abs(mine["score"] - mean.max()) < 1e-4


def test_network_gradients_by_differences():
    net = language_id.ByteNetwork(["a", "b", "c"], hidden=3)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    seq, label = np.array([[32, 97, 98, 32], [32, 99, 97, 32]], np.uint8), np.array([0, 2])
    loss = lambda: -np.log(net.positions(seq)[:, np.arange(2), label]).mean()
    g = net.gradients(seq, label)
    for name in ("uf", "ub", "xf", "o", "cb"):
        at = (97, 1) if name[0] == "x" else tuple(0 for _ in net.p[name].shape)
        was = net.p[name][at]
        net.p[name][at] = was + 1e-3
        up = loss()
        net.p[name][at] = was - 1e-3
        down = loss()
        net.p[name][at] = was
        assert abs((up - down) / 2e-3 - g[name][at]) < 1e-3


def test_pipeline_by_plain_python(spark, sf):
    docs = common.table(spark, sf, "documents")
    left = {r["doc_id"]: r for r in docs.collect()}
    model = toxicity.fitted(docs, toxicity.learnable(common.table(spark, sf, "labels")))
    scores, _ = toxicity._scorer(model)(list(r["text"] for r in left.values()))
    left = {i: r for (i, r), s in zip(left.items(), scores) if s < toxicity.THRESHOLD}
    fp = {i: simhash._votes(np.array(simhash.shingle_hashes(r["text"]), np.uint64), np.array([0, len(simhash.shingle_hashes(r["text"]))]))[0] for i, r in left.items()}
    kept: list[int] = []
    for i in sorted(left):
        if not any(np.bitwise_count(fp[i] ^ fp[j]) <= 2 for j in kept):
            kept.append(i)
    items = [decontamination.word_codes(pa.array([r["text"]]))[0] for r in common.table(spark, sf, "benchmark").collect()]
    windows = {tuple(w[k : k + min(10, len(w))]) for w in items if len(w) for k in range(max(1, len(w) - 9))}

    def dirty(text):
        w = decontamination.word_codes(pa.array([text]))[0]
        return any(tuple(w[k : k + n]) in windows for n in {len(x) for x in windows} for k in range(len(w) - n + 1))

    want = {i for i in kept if not dirty(left[i]["text"])}
    got = corpus_pipeline.run(spark, sf).select("doc_id").distinct().collect()
    assert {r["doc_id"] for r in got} == want


def test_toxicity_learns_from_texts_without_words():
    for texts in (["", "  ", "12", "34"], ["", "vile rot here. fine", "12", "quite fine"]):
        model = toxicity.NoisyOr()
        model.fit(list(texts), np.array([False, True, True, False]))
        assert all(0 <= s < 0.7 for s in toxicity._scorer(model)(["", "some words. more", None])[0])


def test_toxicity_scores_by_plain_python(spark, docs):
    model = toxicity.NoisyOr()
    bad = ["you are a vile rotten thing", "a rotten day. go away vile one", "vile! rotten!"]
    model.fit((bad + ["a good day", "you are a fine thing. go on", "one day"]) * 6, np.array(([True] * 3 + [False] * 3) * 6))

    def plain(text):
        logits = []
        for sentence in re.split(r"[.!?\n]", (text or "").lower()):
            words = re.findall("[a-z\x80-\U0010ffff]+", sentence)
            if words:
                logits.append(model.bias + sum(model.word_weight(w.encode()) for w in words))
        return 1 - np.prod([1 - 1 / (1 + np.exp(-x)) for x in logits])

    rows = docs.union(spark.createDataFrame([(-1, "Fine. You vile rotten thing! go", None, None, 0), (-2, None, None, None, 0)], docs.schema))
    texts = {r["doc_id"]: r["text"] for r in rows.collect()}
    got = {r["doc_id"]: r for r in toxicity.score(rows, model).collect()}
    assert all(abs(got[i]["score"] - plain(t)) < 1e-6 for i, t in texts.items()) and got[-1]["score"] > 0.7 > got[-2]["score"] == 0
    assert [texts[-1][s["start"] : s["end"]] for s in got[-1]["sentences"]] == [" You vile rotten thing"]


def test_kept_by_plain_python(spark):
    """Every document through the learned list written out, over statistics counted by hand."""
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rules = quality_rules.learned(docs, labels)
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    got = {r["doc_id"]: r for r in quality_rules.op9_decision_list(spark, sf).collect()}

    def measured(t):
        words, lines = WORDS.findall(t), [x for x in t.split("\n") if WORDS.search(x)]
        n, chars = max(1, len(words)), max(1, sum(map(len, words)))
        windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
        inside = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
        count = lambda kind: len(re.findall(kind, t))
        shares = {"mean_word": sum(map(len, words)) / n, "symbols": count(r"[#*$%&|<>]") / n, "dup_lines": (len(lines) - len(set(lines))) / max(1, len(lines)), "repeats": len(inside) / n, "line_words": len(words) / max(1, len(lines))}
        shares |= {"upper": count("[A-Z]") / chars, "digits": count("[0-9]") / chars, "stops": count("[.!?]") / n, "pipes": count(r"\|") / n, "words": float(len(words))}
        return shares, len(words) < 10 or 100 * len(inside) > 20 * len(words)

    assert rules and len(got) == len(texts)
    for i, t in texts.items():
        x, failed = measured(t)
        rejected = any(all(x[c.feature] >= c.threshold if c.above else x[c.feature] < c.threshold for c in rule) for rule in rules)
        assert (got[i]["base_failed"], got[i]["kept"]) == (failed, not failed and not rejected)


def test_core_is_what_all_positions_say_between_the_margins():
    """op10: each direction ran on through the far margin, whose states no labelled position needs, and margins were labelled."""
    net = language_id.ByteNetwork(["a", "b", "c"], hidden=5)
    seq = np.random.default_rng(1).integers(0, 256, (9, 40)).astype(np.uint8)
    got = net.core(seq, 6)
    assert got.shape == (3, 28, 9) and np.allclose(got, net.positions(seq)[6:-6].transpose(2, 0, 1), atol=1e-6)
