"""Mixing sources to target weights by capped water-filling and seeded repetition.

Targets: every source gets its weight's share of all words, but at most
``max_epochs`` times its own size. What a capped source can't take is shared
among the others by weight, until nobody is above the cap. Sorted by cap over
weight, the capped sources come first, so two running sums over one row per
source give the level at which the rest is filled.

Sampling: each document is taken as often as fits whole, and the words still
missing come from one more pass in a seeded random order. Its running sum is
taken in two steps, over 4096 buckets of the random number and then within a
bucket, so a source with a third of all documents is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import fresh_folder, stored, word_count

BUCKET_BITS = 12


def source_targets(sizes: DataFrame, weights: Sequence[int], max_epochs: int) -> DataFrame:
    """``source_size`` and ``target`` for each ``source`` of ``sizes`` (source, source_size).

    The weights repeat over the sources by code point, null last. The windows
    run over one row per source, a list that a person gives weights to.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.row_number().over(by_name) - 1
    rows = sizes.withColumn("weight", F.array(*map(F.lit, weights))[F.pmod(turn, F.lit(len(weights)))].cast("long"))
    rows = rows.withColumn("cap", F.col("source_size") * max_epochs)
    filled = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("cap").over(filled.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("weight").over(filled.rowsBetween(0, Window.unboundedFollowing))
    everything = filled.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumn("level", (F.sum("source_size").over(everything) - before) / left)
    rows = rows.withColumn("capped", F.col("level") * F.col("weight") > F.col("cap"))
    # Behind the first source that is not capped the levels only fall.
    level = F.max(F.when(~F.col("capped"), F.col("level"))).over(everything)
    return rows.select(
        "source",
        "source_size",
        F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(level * F.col("weight")).alias("target"),
    )


def mix(
    docs: DataFrame, weights: Sequence[int] = (5, 2, 1), max_epochs: int = 3, seed: str = "mix", folder: str | None = None
) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken`` for every row of ``docs``.

    ``docs`` has ``doc_id``, ``text`` and ``source``; other columns are ignored.
    ``size`` counts the words of the whole text (null: 0). ``taken`` is the
    number of words that the mix takes of the document, repeats counted: its
    size times the whole repetitions, plus all of it, the leading part of it (one
    document a source) or nothing in the last, fractional one. The taken words
    of a source are its target rounded down. A null source is a source of its
    own, a source without words takes nothing. Rows that agree in id, source
    and size are interchangeable, and reruns agree for any partitioning.
    """
    spark = docs.sparkSession
    draw = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), 1, 8), 16, 10)
    sized = docs.select(
        "doc_id",
        F.col("source").cast("string").alias("source"),
        word_count(F.col("text")).alias("size"),
        draw.cast("long").alias("draw"),
    )
    sized = stored(sized, folder or fresh_folder(spark), "sizes")
    sized = sized.withColumn("bucket", F.shiftright("draw", 32 - BUCKET_BITS))
    # One row per source and bucket: what hot sources need is summed before any shuffle.
    buckets = sized.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    targets = source_targets(buckets.groupBy("source").agg(F.sum("bucket_size").alias("source_size")), weights, max_epochs)
    buckets = buckets.join(targets.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    running = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.withColumn("ahead", F.coalesce(F.sum("bucket_size").over(running), F.lit(0))).select(
        F.col("source").alias("_s"), F.col("bucket").alias("_b"), "source_size", "target", "ahead"
    )
    inside = Window.partitionBy("source", "bucket").orderBy("draw", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = sized.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    rows = rows.join(buckets, F.col("source").eqNullSafe(F.col("_s")) & (F.col("bucket") == F.col("_b")))
    words = F.floor("target").cast("long")
    whole = F.when(F.col("source_size") > 0, F.floor(words / F.col("source_size"))).otherwise(0).cast("long")
    missing = words - whole * F.col("source_size") - F.col("ahead") - F.col("within")
    extra = F.least(F.col("size"), F.greatest(missing, F.lit(0)))
    return rows.select("doc_id", "source", "size", "source_size", "target", (whole * F.col("size") + extra).alias("taken"))


def mixed(
    docs: DataFrame, weights: Sequence[int] = (5, 2, 1), max_epochs: int = 3, seed: str = "mix", folder: str | None = None
) -> DataFrame:
    """``docs`` with their columns and ``size, source_size, target, taken`` of ``mix``.

    Documents are matched by id, source and size, in which rows may only repeat
    if they are the same; an input column with one of the new names gives way.
    """
    taken = mix(docs, weights, max_epochs, seed, folder).select(
        F.struct(F.col("doc_id"), F.col("source"), F.col("size")).alias("_key"), "size", "source_size", "target", "taken"
    )
    turn = Window.partitionBy("_key").orderBy("taken")
    taken = taken.withColumn("_turn", F.row_number().over(turn))
    new = ("size", "source_size", "target", "taken")
    rows = docs.select([F.col(f"`{c}`") for c in docs.columns if c not in new])
    rows = rows.withColumn("_key", F.struct(F.col("doc_id"), F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size")))
    rows = rows.withColumn("_turn", F.row_number().over(Window.partitionBy("_key").orderBy("text")))
    return rows.join(taken, (rows["_key"].eqNullSafe(taken["_key"])) & (rows["_turn"] == taken["_turn"])).drop("_key", "_turn")
