"""The corpus pipeline: quality, exact copies, near copies, secrets, packing.

Each stage but the last gives back the columns of documents, whatever they are named; the operators keep rows as structs
beside their own columns. Defined results: null and empty texts are scored, deduplicated and packed like others (as
empty texts, and as one group of copies); a row of a null id is kept or dropped by its text; of repeated rows one
stays; an empty table goes through all stages and gives no rows; without labels nothing is rejected.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from folioworks.llm.common import read_table, through_scratch
from folioworks.llm.exact_dedup import exact_dedup, keep_one
from folioworks.llm.near_copies import one_of_near
from folioworks.llm.packing import pack
from folioworks.llm.quality import keep_good
from folioworks.llm.secret_scan import redact_secrets

#: No SQL has a trained network or a tokenizer: tests hold the stages against brute-force versions.
ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return keep_good(docs, read_table(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest id stays."""
    return keep_one(docs, exact_dedup(docs))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that SimHash or 0.8 of the 5-word shingles link one stays: the one with the smallest id."""
    return one_of_near(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts; n_chars follows."""
    return redact_secrets(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in sequences of at most 4096 ids."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_copies),
    ("simhash_near_dedup", near_copies),
    ("secret_scan", secrets),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's result is written, and read by the next."""
    out = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        out = stage(spark, out, sf_dir)
        if i < len(STAGES) - 1:
            out = through_scratch(out, name)
    return out
