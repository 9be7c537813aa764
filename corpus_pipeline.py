"""The corpus pipeline: stages over documents, each written and read again before the next."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metricwin.llm import language, secret_scan, simhash
from metricwin.llm.common import read, table
from metricwin.llm.packing import pack

DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents whose language it rejects (narrow margin, no letter, null) go."""
    found = language.predict(docs, language.fit(docs))
    return found.where("not rejected").select(*DOCUMENT)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: of each group of near-duplicates the document with the smallest id stays."""
    return simhash.keep_one(docs, distance=2, shingle=3).select(*DOCUMENT)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: live values are masked in the text; no document is dropped."""
    repository = F.concat_ws("/", "source", "lang")
    return secret_scan.redact(docs, F.col("source"), repository).select(*DOCUMENT)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: the kept documents' pieces in sequences of 2048 tokens."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=1, length=2048)


STAGES: list[tuple[str, Stage]] = [
    ("language id", language_id),
    ("near duplicates", near_duplicates),
    ("secrets", secrets),
    ("packing", packing),
]

#: No SQL states what the stages do; tests hold them against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; between stages the rows go to the shared folder."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = table(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
