"""What the operators of this folder share: words, tables, folders, connected components."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.pick import lookup

# The six ASCII white space characters; every run of other characters is a word.
SPACE = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"
# Of the rows that an operator in Python turns into objects at once.
PIECE_BYTES = 1 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Words of a text; a null one has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z alone."""
    return F.translate(text, UPPER, LOWER)


def pieces(batches: Iterator[pa.RecordBatch], most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of the batches, in order, in slices of at most ``most`` bytes; a larger row goes alone.

    What a task makes of a slice is gone before the next one, so its memory
    doesn't follow the size of Spark's batches.
    """
    for batch in batches:
        left = [batch]
        while left:
            piece = left.pop()
            if piece.num_rows > 1 and piece.nbytes > most:
                half = piece.num_rows // 2
                left += [piece.slice(half), piece.slice(0, half)]
            else:
                yield piece


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="tidemark-llm-")


def fresh_folder(spark: SparkSession, shared: str | None = None) -> str:
    """A new folder below ``shared`` or the cluster's ``spark.checkpoint.dir``.

    Only a session on one machine may go without either; it gets a folder of its own.
    """
    shared = shared or spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = _local_folder()
    return f"{shared.rstrip('/')}/llm-{uuid.uuid4().hex}"


def stored(rows: DataFrame, folder: str, name: str, compression: str | None = None) -> DataFrame:
    """Rows written once below ``folder`` and read from there: computed once, safe from lost executors."""
    path = f"{folder}/{name}"
    rows.write.parquet(path, compression=compression)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def components(edges: DataFrame, folder: str) -> DataFrame:
    """``node``, ``root``: the smallest node that each node of the edges ``a``, ``b`` reaches.

    Large-star and small-star rounds: every round ties nodes to the smallest
    neighbour, first upwards, then downwards, until all trees are stars. Each
    round is two joins on a node and is written, so lineage stays short. A node
    with a third of all edges is combined before the shuffle, and ``lookup``
    lets adaptive execution split its rows.
    """
    now = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        folder,
        "edges-0",
    )
    before, turn = None, 0
    while True:
        mark = now.agg(
            F.count("*").alias("n"),
            F.bit_xor(F.xxhash64("u", "v")).alias("x"),
            F.bit_xor(F.xxhash64("v", "u")).alias("y"),
        ).first()
        if mark == before or not mark["n"]:
            break
        before, turn = mark, turn + 1
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = lookup(both, least, "u", "inner").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = lookup(large, low, "u", "inner")
        small = small.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).where("u <> v")
        now = stored(small.distinct(), folder, f"edges-{turn}")
    pairs = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return pairs.unionByName(pairs.select(F.col("root").alias("node"), "root").distinct())
