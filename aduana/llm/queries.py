"""One registered query per operator, with production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from aduana.llm import (
    decontamination, html_text, line_dedup, lm_scoring, mixing, quality_classifier, quality_rules, sharding)
from aduana.llm.common import importable, written
from aduana.llm.debruijn import PassageDedup
from aduana.llm.divergence import SourceDivergence
from aduana.llm.jaccard_join import JaccardJoin
from aduana.llm.merkle import Manifest
from aduana.llm.suffix_dedup import SuffixDedup

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return importable(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lines = written(line_dedup.keyed_lines(docs, min_chars=20), "lines")
    index = line_dedup.empty_index(spark, min_docs=3, min_chars=20, n_shards=line_dedup.shards_for(lines))
    index = line_dedup.insert_documents(index, docs, lines)
    return line_dedup.dedup_lines(index, docs, lines).select("doc_id", "n_lines", "n_dropped", "kept_sha256")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mixed_sizes(docs).select("doc_id", "size", "source_size", "target", "taken")


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return JaccardJoin(docs, n=4, percent=85).documents().select("doc_id", "n_shingles", "component_id")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(spark, table(spark, sf_dir, "documents").select("doc_id"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(table(spark, sf_dir, "pages"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.lm_scores(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.quality_verdicts(docs, quality_rules.train(docs, table(spark, sf_dir, "labels")))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return SuffixDedup(docs).digests()


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return PassageDedup(table(spark, sf_dir, "documents")).documents()


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SourceDivergence(table(spark, sf_dir, "documents")).report()


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Manifest(table(spark, sf_dir, "documents")).documents()


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (
        op1_line_dedup, op2_mixing, op3_jaccard_join, op4_sharding, op5_html_text, op6_quality_classifier,
        op7_lm_scoring, op8_decontamination, op9_quality_rules, op10_suffix_dedup, op11_substring_dedup, op12_divergence, op13_merkle)}
