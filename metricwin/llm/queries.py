"""Registered queries of this folder: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metricwin.llm import cover_tree, multi_index, quality
from metricwin.llm.common import read
from metricwin.llm.fixity import compare
from metricwin.llm.language import fit, held_out, predict
from metricwin.llm.oracle import FIXITY, SECRETS
from metricwin.llm.packing import pack
from metricwin.llm.pieces import digests
from metricwin.llm.rans import write_tokens
from metricwin.llm.secret_scan import secret_spans
from metricwin.llm.sharding import shard
from metricwin.llm.simhash import near_duplicates
from metricwin.llm.spelling import spelling_variants
from metricwin.llm.whitening import whiten
from metricwin.storage import fresh_dir

Query = Callable[[SparkSession, str], DataFrame]


def op1_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    maps = fresh_dir(spark, "slot-maps")
    rows, _ = shard(read(spark, sf_dir, "documents"), shards=8, slots=4096, map_path=maps)
    return rows.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("place").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        F.col("slot").alias("virtual_slot"),
    )


def damaged(pages: DataFrame) -> DataFrame:
    """A second copy of ``pages`` as bad disks and bad copying may leave it: of every 97 ids one page
    with its first character lost and written again as another, one cut short by ten characters,
    one lost, one kept twice, and one that is there under another id as well."""
    rule = F.pmod(F.col("page_id"), F.lit(97))
    spoilt = F.when(rule == 5, F.concat(F.lit("?"), F.expr("substring(html, 2)")))
    spoilt = spoilt.when(rule == 50, F.expr("left(html, length(html) - 10)"))
    pages = pages.select("page_id", "url", spoilt.otherwise(F.col("html")).alias("html"))
    once = F.array("page_id")
    ids = F.when(rule == 20, F.array().cast("array<bigint>")).when(rule == 30, F.array("page_id", "page_id"))
    ids = ids.when(rule == 60, F.array("page_id", -1 - F.col("page_id"))).otherwise(once)
    return pages.select(F.explode(ids).alias("page_id"), "url", "html")


def op2_merkle_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    return compare(pages, damaged(pages), per_file=1024, fanout=16)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"), distance=2, shingle=3)


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source is taken as an owner, a source's documents in one language as a repository."""
    repository = F.concat_ws("/", "source", "lang")
    return secret_spans(read(spark, sf_dir, "documents"), F.col("source"), repository)


def op5_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.near_duplicates(read(spark, sf_dir, "embeddings"), cosine=0.95)


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    rows = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    return predict(rows, fit(docs)).drop("text")


def op7_range_ans(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return write_tokens(read(spark, sf_dir, "documents"), tokenizer, end_id=1).documents()


def op8_aho_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    return digests(read(spark, sf_dir, "documents"), model)


def op9_concatenate_and_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return pack(read(spark, sf_dir, "documents"), tokenizer, end_id=1, length=2048)


def op10_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op11_chebyshev_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(read(spark, sf_dir, "embeddings"), components=8, scale=1024, shift=100_000)


def op12_reduced_alphabet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(read(spark, sf_dir, "documents"), typo_every=97, symbols=6)


def op13_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    rows = docs.select("doc_id", "text", quality.held_out(F.col("doc_id")).alias("held_out"))
    return quality.predict(rows, quality.fit(docs, labels), threshold=0.3).drop("text")


QUERIES: dict[str, Query] = {
    "op1_virtual_slots": op1_virtual_slots,
    "op2_merkle_fixity": op2_merkle_fixity,
    "op3_simhash": op3_simhash,
    "op4_secrets": op4_secrets,
    "op5_cover_tree": op5_cover_tree,
    "op6_language": op6_language,
    "op7_range_ans": op7_range_ans,
    "op8_aho_viterbi": op8_aho_viterbi,
    "op9_concatenate_and_cut": op9_concatenate_and_cut,
    "op10_multi_index": op10_multi_index,
    "op11_chebyshev_whitening": op11_chebyshev_whitening,
    "op12_reduced_alphabet": op12_reduced_alphabet,
    "op13_compression_quality": op13_compression_quality,
}

ORACLE: dict[str, str] = {"op2_merkle_fixity": FIXITY, "op4_secrets": SECRETS}
