"""Top-1 per key and lookups of one fact row per key, safe for hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per(rows: DataFrame, key: str, order: Column) -> DataFrame:
    """The first row of each key.

    ``row_number() = 1`` lets Spark keep one row per key in every map task
    before the shuffle, so a hot key never reaches a single task whole.
    """
    window = Window.partitionBy(key).orderBy(order)
    return rows.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def lookup(rows: DataFrame, facts: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Join any number of rows per key to at most one fact row per key.

    ``facts`` mostly comes out of an aggregate on the key. Joined on the key
    alone, the aggregate would feed the join without a shuffle in between, and
    adaptive execution splits a hot key only where both inputs are shuffles.
    A hash of the key as another join column makes Spark shuffle both sides, so
    a key holding a third of all rows is spread over many tasks. As first sort
    column it also spares comparing paths that all start alike. Facts small
    enough by Spark's own statistics are broadcast, and nothing is shuffled.
    """
    keyed = facts.withColumn("_hash", F.xxhash64(key))
    return rows.withColumn("_hash", F.xxhash64(key)).join(keyed, ["_hash", key], how).drop("_hash")
