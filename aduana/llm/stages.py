"""The stages of the corpus pipeline: each takes (spark, docs, sf_dir) and returns the documents that go on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from aduana.functions.frames import quoted, unused_name
from aduana.llm import decontamination, mixing, quality_rules, sharding
from aduana.llm.common import WORD_REGEX, written
from aduana.llm.jaccard_join import JaccardJoin


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_rules.keep_good(docs, quality_rules.train(docs, labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links at a similarity of 0.8 of five-word shingles: the one with the least id, and
    of rows that repeat it, one. Documents without words are in no group and stay."""
    rows = written(JaccardJoin(docs, n=5, percent=80).documents(), "grouped-rows")
    grouped = rows.where("component IS NOT NULL")
    first = grouped.groupBy("component").agg(F.min(F.struct("doc_id", "row_hash")).alias("first")).select("first.*")
    keep = written(first.unionByName(rows.where("component IS NULL").select("doc_id", "row_hash")).distinct(), "kept-rows")
    keep = keep.select(F.struct(F.col("doc_id").alias("id"), F.col("row_hash").alias("hash")).alias("__keep__"))
    whole = docs.select(F.struct(*(F.col(quoted(c)) for c in docs.columns)).alias("__row__"))
    row, kept = F.col("__row__"), F.col("__keep__")
    row_hash = F.xxhash64(row["doc_id"].cast("long"), F.coalesce(row["text"], F.lit("")))
    whole = whole.join(keep, (row_hash == kept["hash"]) & row["doc_id"].cast("long").eqNullSafe(kept["id"]), "left_semi")
    if not grouped.groupBy("doc_id", "row_hash").count().where("count > 1").isEmpty():
        # Rows that repeat an id with its text came along; of those with words, one goes on.
        wordless = F.regexp_count(F.coalesce(row["text"], F.lit("")), F.lit(WORD_REGEX)) == 0
        number = F.when(wordless, F.monotonically_increasing_id())
        whole = whole.select("__row__", row["doc_id"].alias("__id__"), row_hash.alias("__hash__"), number.alias("__number__"))
        whole = whole.dropDuplicates(["__id__", "__hash__", "__number__"])
    return whole.select("__row__.*")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontamination.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them."""
    return mixing.mixture(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the slot and shard_id of each; where the input has columns of these names, the new ones get underscores
    in front."""
    return sharding.place(spark, docs, slot=unused_name("slot", docs), shard=unused_name("shard_id", docs))


STAGES = [
    ("quality", quality), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate), ("mix", mix), ("shard", shard)]
