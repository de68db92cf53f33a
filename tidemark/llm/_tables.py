"""Reading the given tables and choosing training rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(id_column: str, folds: int) -> Column:
    """The fold of a row: crc32 of its id as text, modulo folds."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % folds


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows written to the shared folder, so that no lost executor makes them be computed anew.

    With spark.cleaner.referenceTracking.cleanCheckpoints Spark deletes them once nothing refers to them.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint()


def labelled_sample(
    documents: DataFrame, labels: DataFrame, label: str, training: Column, limit: int
) -> DataFrame:
    """Texts and labels of at most ``limit`` labelled training rows, the first by a hash of their ids.

    Only the chosen ids are sent to the tasks that read the texts; their number is bounded by ``limit``, and so is
    that of the rows, for an id that stands more than once teaches by its smallest text alone.
    A document whose id is labelled more than once with different values takes the larger one.
    """
    chosen = (
        labels.filter(training & F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(limit)
    )
    return (
        documents.select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id")
        .agg(F.min("text").alias("text"), F.max("label").alias("label"))
        .select("text", "label")
    )
