"""The corpus pipeline: stages over documents, each reading all that the one before it kept.

Each stage is written as Parquet to the shared folder and read again as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm import decontamination, mixing, quality, sharding, simhash
from marketlens.llm.common import free_name, written


def _row_key() -> Column:
    """Names a row by its id and text, ordered by id (null last): null and repeated ids stay apart, equal rows fall together."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0)).cast("long").alias("doc_id"),
                    F.coalesce(F.sha1(F.col("text").cast("binary")), F.lit("")).alias("text"))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on labelled rows of ``docs``, predicts as good; the others go.

    A null text is scored as an empty one. Rows are judged each by its text, so equal ids or rows share a fate only as their texts do;
    without labels that match a row every document has the same score. An empty table stays empty; extra columns are kept.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = quality.scored(docs, quality.fit(docs, labels))
    return scored.filter(F.col(scored.columns[len(docs.columns) + 1]) == 1).select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group that the SimHash operator links, the document with the smallest id (a null id is the largest).

    Of rows with equal id and text one stays, the first in the order of its columns' JSON, so that reruns agree. Null and empty texts have
    the fingerprint zero and are one group. An empty table stays empty; extra columns are kept.
    """
    key = free_name(docs, "row_key")
    keyed = docs.withColumn(key, _row_key())
    near = written(simhash.near_duplicates(keyed, key), "pipeline-near")
    gone = near.filter("doc_id != component_id").select(F.col("doc_id").alias(key)).distinct()
    left = keyed.join(gone, key, "left_anti")
    repeated = written(near.groupBy(F.col("doc_id").alias(key)).count().filter("count > 1").select(key), "pipeline-repeated")
    if not repeated.isEmpty():
        row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
        first = left.join(repeated, key, "left_semi").select(F.col(key).alias("key"), row.alias("row")).groupBy("key").agg(
            F.min_by("row", F.to_json("row")).alias("row"))
        return left.join(repeated, key, "left_anti").drop(key).unionByName(first.select("row.*"))
    return left.drop(key)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a word inside any window of a benchmark item; the others go.

    Null and empty texts have no words and stay; rows with equal id and text share a fate. An empty table stays empty;
    extra columns are kept.
    """
    key = free_name(docs, "row_key")
    keyed = docs.withColumn(key, _row_key())
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    gone = decontamination.contamination(keyed, items, key).filter("contaminated").select(F.col("doc_id").alias(key)).distinct()
    return keyed.join(gone, key, "left_anti").drop(key)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents as often as it takes them.

    A null source is a source of its own; null and empty texts have no words, and are taken as often as their block is. Rows with
    equal id and text are one document with as many copies. An empty table stays empty; extra columns are kept.
    """
    return mixing.mixed(docs).select(*docs.columns)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places every row that the mix holds, repeats included, into the 40 shards.

    Repeats and rows with equal or null ids share a shard and get slots of their own; a null text has size 16. An empty table
    gives an empty result; extra columns aren't read.
    """
    return sharding.shard_documents(docs, sharding.shard_tree(sharding.SHARDS),
                                    sharding.shard_tree(sharding.SHARDS + 1))


STAGES = [
    ("quality classifier", quality_stage),
    ("SimHash near-dedup", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing sources to target weights", mixing_stage),
    ("sharding", sharding_stage),
]

# The classifier is fitted and XXH64 isn't in DuckDB, so SQL can't express the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
