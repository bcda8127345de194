"""The corpus pipeline: what is toxic goes, near-duplicates become one, benchmark passages go, personal data
is replaced, and what is left is packed.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; run writes each stage's
rows in the shared folder before the next reads them, as the check tool and a scheduler of stages do.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from orograph.llm import decontamination, packing, simhash, surrogates, toxicity
from orograph.llm.common import stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents of a toxicity score of 0.7 or more; the model learns from the labels that op4 learns from."""
    model = toxicity.fitted(table(spark, sf_dir, "documents"), toxicity.learnable(table(spark, sf_dir, "labels")))
    return toxicity.without_toxic(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of fingerprints that differ in 2 bits or fewer."""
    return simhash.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents in which a window of a benchmark item occurs."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for personal data; n_chars follows the new text."""
    from pyspark.sql import functions as F

    out = surrogates.replaced(docs, surrogates.query_key(spark))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their ids, these ids' checksums, and their sequences."""
    from pyspark.sql import functions as F

    return packing.packed(docs).withColumn("ids_crc32", F.crc32("ids"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", replace_personal_data),
    ("packing", pack),
]

ORACLE_SQL = None
"""Learned scores, XXH64 fingerprints and a tokenizer are beyond SQL; tests/llm compare run with plain Python."""


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"stage-{name}")
    return docs
