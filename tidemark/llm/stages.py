"""Operators as stages of a pipeline: documents in, documents out, but for the last."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import jaccard_join, mixing, packing, quality, toxicity
from tidemark.llm._tables import checkpointed, table
from tidemark.llm.queries import quality_model, toxicity_model


def _aside(documents: DataFrame, names: tuple[str, ...], step: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The step's rows with the columns of documents; columns named like the step's own are put aside meanwhile."""
    away = {name: f"aside_{i}_{name}" for i, name in enumerate(documents.columns) if name.lower() in names}
    stepped = step(documents.withColumnsRenamed(away))
    return stepped.select(*(F.col(away.get(name, name)).alias(name) for name in documents.columns))


def drop_toxic(spark, docs, sf_dir):
    """Documents whose toxicity stays below the threshold, null and empty texts among them."""
    model = toxicity_model(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))

    def step(rows):
        return toxicity.score(rows, model).filter(F.col("score") < toxicity.THRESHOLD)

    return _aside(docs, ("score", "toxic_words"), step)


def keep_quality(spark, docs, sf_dir):
    """Documents whose quality reaches the threshold."""
    model = quality_model(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return _aside(docs, ("score",), lambda rows: quality.score(rows, model).filter(F.col("score") >= quality.THRESHOLD))


def drop_near_copies(spark, docs, sf_dir):
    """One row of each similarity class, that of the smallest doc_id, null last; rows without a word all stay.

    Where an id is null or stands more than once, rows are compared by numbers of their own. The numbered rows are
    written first, so that a lost executor does not number them anew.
    """
    if _ids_are_keys(docs):
        gone = jaccard_join.similarity_classes(docs).filter(~F.col("kept")).select("doc_id")
        return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    given = F.struct(*[F.col(f"`{name}`") for name in docs.columns])
    rows = checkpointed(docs.select(given.alias("row")).withColumn("number", F.monotonically_increasing_id()))
    classes = checkpointed(
        jaccard_join.similarity_classes(rows.select(F.col("number").alias("doc_id"), "row.text")).select(
            F.col("doc_id").alias("number"), "class_id"
        )
    )
    place = F.struct(F.col("row.doc_id").isNull(), "row.doc_id", "number")
    first = (
        classes.join(rows.select("number", place.alias("place")), "number")
        .groupBy("class_id")
        .agg(F.min("place").getField("number").alias("number"))
    )
    return rows.join(first, "number", "left_semi").select("row.*")


def _ids_are_keys(docs: DataFrame) -> bool:
    """Whether no doc_id is null or stands more than once."""
    odd = F.col("doc_id").isNull() | (F.col("rows") > 1)
    return docs.groupBy("doc_id").agg(F.count("*").alias("rows")).filter(odd).isEmpty()


def mix_sources(spark, docs, sf_dir):
    """Documents as often as the mix takes them; of a boundary document less than half taken is none."""
    names = ("size", "source_size", "target", "taken", "hash", "copy")
    return _aside(docs, names, lambda rows: mixing.emitted(mixing.mix(rows)))


def pack_batches(spark, docs, sf_dir):
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", keep_quality),
    ("jaccard_join", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_batches),
]
