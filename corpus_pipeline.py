"""From raw documents to packed training sequences, stage by stage.

Every stage takes the documents that the stage before it kept and, but for the last, returns
their columns, whatever they are. Each is written as Parquet and read again by the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm import line_dedup, mixing, packing, quality, simhash
from tradewind.llm.common import Steps, fresh, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from ``labels`` next to the documents.

    Without a good label in the training folds there is no model, and no document is rejected.
    """
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    if model is None:
        return docs
    score = fresh("quality_score_", docs.columns)
    scored = quality.with_quality(docs, model, score)
    return scored.filter(F.col(score) >= 0.7).select(*docs.columns)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeats of runs of lines are deleted; a text may become empty, no document goes."""
    rows = line_dedup.dedup_lines(docs)[0].select(*docs.columns)
    return rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else rows


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates; one row of repeated ones."""
    row, key = fresh("row_", docs.columns), fresh("key_", docs.columns)
    stored = Steps(spark).keep(docs.withColumn(row, F.monotonically_increasing_id()), "documents")
    ordered = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col(row).alias("row"))
    groups = simhash.near_duplicates(stored.select("text", ordered.alias(key)), id_col=key)
    first = groups.filter("doc_id = component_id").select(F.col("doc_id.row").alias(row))
    return stored.join(first.hint("shuffle_hash"), row, "left_semi").select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, those of small sources up to twice, so that sources come at their weights."""
    return mixing.mix(docs)[0].select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sequences to train on: every piece of every document with its place."""
    return packing.pack_documents(docs, packing.tokenizer_path())


STAGES = [
    ("quality classifier", good_quality),
    ("line dedup", without_repeated_lines),
    ("SimHash near-dedup", one_of_each_group),
    ("mixing sources", mixed),
    ("packing", packed),
]
# The stages are beyond SQL; tests hold the rows of each, and of all in a row, against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = Steps(spark)
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = steps.keep(stage(spark, docs, sf_dir), f"stage{number}")
        if number:
            steps.drop(f"stage{number - 1}")
    return docs
