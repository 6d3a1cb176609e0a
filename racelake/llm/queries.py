"""Contract queries of the operators: thin calls over the given tables."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    bpe_codec,
    lang_id,
    line_dedup,
    near_dup,
    oracles,
    packing,
    pii,
    quality,
    resample,
    spelling,
    token_counts,
    token_output,
    topk,
    url_rules,
)
from .common import fresh_path, read_table, ship
from .tokenizing import vocabulary

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return fn(spark, sf_dir)
        QUERIES[name] = run
        if oracle:
            ORACLE[name] = oracle
        return fn
    return add


@query("op1_token_output")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents in a Simple-8b block file, read back per document."""
    return token_output.token_output(read_table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), end_id=0)


@query("op2_quality_rules", quality.oracle())
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics and verdicts of the quality rules for every document."""
    return quality.quality_verdicts(read_table(spark, sf_dir, "documents"))


@query("op3_bpe_codec")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded through the transducer lexicon, and decoded again."""
    return bpe_codec.codec_digest(read_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


@query("op4_token_counts")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token totals by source, language and tokenizer after four delta batches."""
    vocabularies = {name: vocabulary(name + ".json") for name in ("byte_bpe_50k", "word_bpe_49k")}
    return token_counts.corpus_rollup(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"),
                                      vocabularies, fresh_path(spark, "rollup"))


@query("op5_near_dup", oracles.NEAR_DUP)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents: 4-word shingles, similarity 0.8."""
    return near_dup.near_duplicates(read_table(spark, sf_dir, "documents"), words=4)


@query("op6_language_id")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by PPM code lengths."""
    return lang_id.identify(read_table(spark, sf_dir, "documents"))


@query("op7_pii")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document, and the terms that disclose it."""
    return pii.pii_spans(read_table(spark, sf_dir, "documents"))


@query("op8_topk", oracles.TOP_K)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 highest inner products of every 50th vector, exactly."""
    return topk.top_k(read_table(spark, sf_dir, "embeddings"))


@query("op9_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4096 tokens by cost."""
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), end_id=2)


@query("op10_line_dedup", oracles.LINE_DEDUP)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of 20 or more code points in three or more documents, kept in one."""
    return line_dedup.line_dedup_digest(read_table(spark, sf_dir, "documents"))


@query("op11_url_rules", url_rules.oracle())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the url of every page, by the longest fitting rule."""
    return url_rules.judge_urls(read_table(spark, sf_dir, "pages"))


@query("op12_spelling", oracles.SPELLING)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frequent words of all documents with their near words, form and root."""
    return spelling.spelling_groups(read_table(spark, sf_dir, "documents"))


@query("op13_resample", oracles.RESAMPLE)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tenth of the documents drawn in proportion to their likeness to the benchmark."""
    return resample.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
