"""Mixing sources to target weights by hash thresholds, with DataFrame operations alone.

Every document has a hash. Whole repeats of a source are taken of all its documents; of what
remains of its budget, the documents below a hash threshold are taken once more. The threshold is found in
histograms: sizes are summed by source and leading hash digits, then again within the one bucket on
the boundary, and at last by the few hashes left there. Nothing is sorted but these.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm._tables import checkpointed

#: Hexadecimal digits of a hash, and those that each histogram reads. 4096 buckets a source and pass.
HASH_DIGITS, PASS_DIGITS = 15, (3, 3)
WEIGHTS = (1, 2, 3)
LARGEST_SHARE = 3
#: With more sources than this their thresholds are joined by a shuffle instead of being broadcast.
BROADCAST_SOURCES = 10_000
#: Words are runs of anything but blanks.
WORD = "[^\\x20\\x09-\\x0D]+"


def word_count(text: Column | str) -> Column:
    """Number of words; null counts none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def id_hash(id_column: Column | str) -> Column:
    """The leading digits of the md5 of an id as text, as a number; a null id hashes as 'null'."""
    text = F.coalesce(F.col(id_column).cast("string") if isinstance(id_column, str) else id_column, F.lit("null"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, HASH_DIGITS), 16, 10).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """Words wanted of each source: ``target`` beside source and source_size.

    sizes: one row per source with source_size. Sources by code point, null last, weigh 1, 2, 3, 1, ... and
    share the total; a target stops at three times its source's size and the excess goes to the others by
    weight. Sources in the order of size over weight reach their stop first, so one running sum over
    them finds who stops.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    number = F.row_number().over(by_name)
    weights = F.element_at(F.array(*map(F.lit, WEIGHTS)), ((number - 1) % len(WEIGHTS) + 1).cast("int"))
    ranked = sizes.withColumn("weight", weights.cast("long"))
    cap = F.col("source_size") * LARGEST_SHARE
    by_ratio = Window.orderBy((cap / F.col("weight")), F.col("source").asc_nulls_last())
    before, everything = by_ratio.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    left = F.col("total") - F.coalesce(F.sum(cap).over(before), F.lit(0))
    shares = F.col("all_weights") - F.coalesce(F.sum("weight").over(before), F.lit(0))
    reached = (
        ranked.withColumn("total", F.sum("source_size").over(everything))
        .withColumn("all_weights", F.sum("weight").over(everything))
        # If this source and all of larger ratio shared what is left, would it pass its stop?
        .withColumn("stops", cap * shares <= left * F.col("weight"))
    )
    stopped = F.sum(F.when(F.col("stops"), cap).otherwise(0)).over(everything)
    open_weight = F.sum(F.when(F.col("stops"), 0).otherwise(F.col("weight"))).over(everything)
    free = (F.col("total") - stopped).cast("double") * F.col("weight").cast("double") / open_weight.cast("double")
    return reached.select(
        "source", "source_size", F.when(F.col("stops"), cap.cast("double")).otherwise(free).alias("target")
    )


def _boundary(histogram: DataFrame) -> DataFrame:
    """The bucket of each source in which the running sum passes what is still wanted, and the sum before it."""
    running = Window.partitionBy("source").orderBy("bucket")
    before = F.col("before") + F.sum("size").over(running) - F.col("size")
    return (
        histogram.withColumn("reached", before)
        .filter((F.col("reached") <= F.col("wanted")) & (F.col("reached") + F.col("size") > F.col("wanted")))
        .select("source", "wanted", "repeats", F.col("bucket").alias("prefix"), F.col("reached").alias("before"))
    )


def thresholds(sizes: DataFrame) -> DataFrame:
    """How to take each source: ``repeats`` of all documents, one more below ``cut``, and of those with
    hash ``cut`` the part ``part`` of ``part_of``.

    sizes: source, size and hash of all documents, computed once and kept.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = checkpointed(source_targets(per_source))
    # A whole number of repeats goes to all, the rest of the budget in whole words by hash.
    repeats = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    wanted = targets.withColumn("repeats", repeats).select(
        "source",
        "repeats",
        (F.floor("target") - F.col("repeats") * F.col("source_size")).alias("wanted"),
        F.lit(0).cast("long").alias("prefix"),
        F.lit(0).cast("long").alias("before"),
    )
    digits = 0
    for step in (*PASS_DIGITS, HASH_DIGITS - sum(PASS_DIGITS)):
        cells = _with_source(sizes, wanted)
        if digits:
            cells = cells.filter(_leading(F.col("hash"), digits) == F.col("prefix"))
        digits += step
        cells = (
            cells.groupBy("source", "wanted", "repeats", "before", _leading(F.col("hash"), digits).alias("bucket"))
            .agg(F.sum("size").alias("size"))
            .filter("size > 0")
        )
        wanted = checkpointed(
            _boundary(cells).withColumn("part_of", F.lit(0)) if digits < HASH_DIGITS else _last_boundary(cells)
        )
    return targets.alias("t").join(wanted.alias("w"), F.expr("t.source <=> w.source"), "left").select(
        "t.source",
        "t.source_size",
        "t.target",
        F.coalesce("w.repeats", repeats).alias("repeats"),
        F.coalesce("w.prefix", F.lit(-1)).alias("cut"),
        (F.coalesce("w.wanted", F.lit(0)) - F.coalesce("w.before", F.lit(0))).alias("part"),
        F.coalesce("w.part_of", F.lit(0)).alias("part_of"),
    )


def _last_boundary(cells: DataFrame) -> DataFrame:
    running = Window.partitionBy("source").orderBy("bucket")
    before = F.col("before") + F.sum("size").over(running) - F.col("size")
    return (
        cells.withColumn("reached", before)
        .filter((F.col("reached") <= F.col("wanted")) & (F.col("reached") + F.col("size") > F.col("wanted")))
        .select(
            "source",
            "wanted",
            "repeats",
            F.col("bucket").alias("prefix"),
            F.col("reached").alias("before"),
            F.col("size").alias("part_of"),
        )
    )


def _leading(h: Column, digits: int) -> Column:
    return F.shiftright(h, 4 * (HASH_DIGITS - digits))


def _with_source(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Rows joined with one row per source; null is a source too.

    The sources are broadcast while their number is small, and joined by a shuffle beyond that, in which a
    source with many rows is split by adaptive execution.
    """
    few = sources.count() <= BROADCAST_SOURCES
    named = sources.withColumnRenamed("source", "of_source")
    return rows.join(F.broadcast(named) if few else named, F.expr("source <=> of_source")).drop("of_source")


def mix(documents: DataFrame) -> DataFrame:
    """Every row with ``size``, ``source_size``, ``target`` and ``taken``.

    Size is the number of words (null: 0) and taken the words the mix takes, repeats counted: at most three times
    the size. The taken words of a source come to its target, rounded down; rows that share the
    boundary hash share what is left, rounded down for each. Null is a source of its own; rows with a
    null id hash alike. The same rows give the same mix. Columns of these names are replaced, others stay.
    """
    added = ("size", "source_size", "target", "taken")
    # The given columns travel in one, so that none of their names meets one used here.
    given = F.struct(*[F.col(f"`{name}`") for name in documents.columns if name.lower() not in added])
    hashed = documents.select(
        given.alias("row"), "source", word_count("text").alias("size"), id_hash("doc_id").alias("hash")
    )
    kept = checkpointed(hashed.select("source", "size", "hash"))
    return _taken(hashed, thresholds(kept)).select("row.*", *added)


def _taken(hashed: DataFrame, cuts: DataFrame) -> DataFrame:
    cuts = cuts.toDF("source", *(f"mix_{c}" for c in cuts.columns[1:]))
    share = F.floor(F.col("size") * F.col("mix_part") / F.greatest(F.col("mix_part_of"), F.lit(1)))
    more = (
        F.when(F.col("hash") < F.col("mix_cut"), F.col("size"))
        .when(F.col("hash") == F.col("mix_cut"), share)
        .otherwise(0)
    )
    taken = (F.col("size") * F.col("mix_repeats") + more).cast("long")
    joined = _with_source(hashed, checkpointed(cuts))
    joined = joined.withColumns({"source_size": F.col("mix_source_size"), "target": F.col("mix_target"), "taken": taken})
    return joined.drop("hash", *(f"mix_{c}" for c in ("source_size", "target", "repeats", "cut", "part", "part_of")))


def mix_ids(documents: DataFrame) -> DataFrame:
    """The mix without texts: doc_id, source and the columns of mix(), from one reading of the texts."""
    kept = checkpointed(
        documents.select("doc_id", "source", word_count("text").alias("size"), id_hash("doc_id").alias("hash"))
    )
    return _taken(kept, thresholds(kept.select("source", "size", "hash")))


def emitted(mixed: DataFrame) -> DataFrame:
    """The rows of a mix as often as they are taken: taken over size, rounded; rows not taken go."""
    times = F.when(F.col("size") > 0, F.round(F.col("taken") / F.col("size"))).otherwise(0).cast("int")
    copies = F.explode(F.when(times > 0, F.sequence(F.lit(1), times)).otherwise(F.array().cast("array<int>")))
    return mixed.withColumn("copy", copies)
