"""Surrogates against a plain Python reading of the patterns, check digits, full classes and both ways attempts travel."""

from __future__ import annotations

import re

import pytest
import regex

from orograph.llm import surrogates

CARD, IBAN = "4111 1111 1111 1111", "DE89 3704 0044 0532 0130 00"


def luhn(text: str) -> bool:
    digits = [int(c) for c in text if c.isdigit()][::-1]
    return sum(d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(digits)) % 10 == 0


def iban(text: str) -> bool:
    bare = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in bare[4:] + bare[:4])) % 97 == 1


def python_entities(text: str) -> list[str]:
    found = [m[0] for m in regex.compile(surrogates.ENTITY).finditer(text)]
    number = lambda e: re.fullmatch(r"\d{13,19}|\d{4}(?:[ -]\d{4}){3}", e)
    account = lambda e: re.fullmatch(r"[A-Z]{2}\d{2}[ A-Z0-9]+", e) and not re.fullmatch("[0-9A-F]{32,}", e)
    return [e for e in found if luhn(e) or not number(e) if not account(e) or iban(e)]


def rewrite(spark, texts: list[str | None], **more) -> list[str | None]:
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    return [r["text"] for r in surrogates.replaced(rows, "k", **more).orderBy("doc_id").collect()]


def test_documents_by_plain_python(spark, docs):
    rows = docs.select("doc_id", "text").collect()
    was, now = {r["doc_id"]: r["text"] or "" for r in rows}, {r["doc_id"]: r["text"] or "" for r in surrogates.replaced(docs, "k").collect()}
    given: dict[str, set[str]] = {}
    for i, text in was.items():
        found = python_entities(text)
        between = regex.split("|".join(map(regex.escape, found)), text) if found else [text]
        pattern = "(.+?)".join(map(re.escape, between))
        got = re.fullmatch(pattern, now[i], re.S)
        assert got, (text, now[i])
        for entity, made in zip(found, got.groups()):
            given.setdefault(entity.lower() if "@" in entity else entity, set()).add(made)
    assert len(given) > 10 and all(len(x) == 1 for x in given.values())
    made = [next(iter(x)) for x in given.values()]
    assert len(set(made)) == len(made) and not set(made) & set(given)


@pytest.mark.parametrize("text", ["order 1234567890123456 went out", "AB12 WORD TEXT MORE", "version 1.2.3.4", "4111 1111 1111 1112", ""])
def test_what_is_no_entity_stays(spark, text):
    assert rewrite(spark, [text]) == [text]


def test_check_digits_are_right(spark):
    out = rewrite(spark, [f"{CARD} and 4111111111111111", f"to {IBAN}."])
    one, two = out[0].split(" and ")
    assert luhn(one) and luhn(two) and re.fullmatch(r"4\d{3} \d{4} \d{4} \d{4}", one) and re.fullmatch(r"4\d{15}", two) and one != CARD
    assert iban(out[1][3:-1]) and re.fullmatch(r"to DE\d\d \d{4} \d{4} \d{4} \d{4} \d\d\.", out[1]) and IBAN not in out[1]


def test_a_full_class_still_gets_distinct_surrogates(spark):
    boxes = [f"{c}@x.com" for c in "abcdefghijklmnopqrstuvwxyz"]
    out = rewrite(spark, boxes)
    assert len(set(out)) == len(out) and not set(out) & set(boxes)
    assert len({x.split("@")[1] for x in out}) == 1 and max(len(x.split("@")[0]) for x in out) > 1


def test_names_alone_follow_but_not_behind_an_article(spark):
    out = rewrite(spark, ["Mr. Rose grows a Rose. The Rose is red. Rose waters it."])[0]
    got = re.fullmatch(r"Mr\. (\w+) grows a Rose\. The Rose is red\. (\w+) waters it\.", out)
    assert got and got[1] == got[2] != "Rose"


def test_joined_attempts_give_the_texts_of_mapped_ones(spark):
    texts = [f"{c}@x.com and Mrs. Anna {c.upper()}smith" for c in "abcdefghijklmnopqrstuvwxyz"] + ["none", None, ""]
    assert rewrite(spark, texts, map_rows=0) == rewrite(spark, texts)


def test_clashing_columns_stay(spark):
    rows = spark.createDataFrame([("a@x.com", 1, 2)], "text string, __text int, __attempts int")
    for rows_at_once in (0, 5000):
        got = surrogates.replaced(rows, "k", rows_at_once).first()
        assert got["__text"] == 1 and got["__attempts"] == 2 and got["text"].endswith(".example")


def test_another_key_gives_other_surrogates(spark):
    rows = spark.createDataFrame([(1, "mail ann.lee@example.org")], "doc_id int, text string")
    assert surrogates.replaced(rows, "k").first()["text"] != surrogates.replaced(rows, "other").first()["text"]
