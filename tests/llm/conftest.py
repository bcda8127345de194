from __future__ import annotations

import pytest


@pytest.fixture(scope="session")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


def edge_rows(spark, extra: str = "n_words long, slot int"):
    """Nulls in every column, empty and very long texts, repeated rows, and columns that clash with results."""
    long = "word another third " * 20_000
    rows = [(None, None), (1, None), (2, ""), (3, " \n\t "), (4, "One line.\nTwo lines.\nOne line."), (4, "One line.\nTwo lines.\nOne line."), (5, long), (6, "é" * 5000), (None, "no id here"), (7, "<|endoftext|> don't STOP… 12"), (8, long)]
    return spark.createDataFrame([(*r, None, None, None, 9, 9) for r in rows], f"doc_id long, text string, lang string, source string, n_chars long, {extra}")


@pytest.fixture(scope="session")
def edges(spark):
    return edge_rows(spark).cache()


@pytest.fixture(scope="session")
def nothing(edges):
    return edges.where("false")
