"""Chat formatting: collapse cumulative snapshots of conversations, then render what is left.

A log that stores a conversation after every reply holds the same opening many
times. Each turn gets a hash of the conversation up to it; a conversation whose
last such hash is found inside a longer one is a snapshot of that one and goes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import fresh_folder, stored

# Turns are handled in blocks of so many, so one endless conversation is spread over tasks.
BLOCK_TURNS = 256


def placed_turns(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``part``, ``place`` (from 1), ``role``, ``text`` and the prefix hash ``h1``, ``h2``.

    Turns are ordered by number, then role, then text (nulls first); a row that is there twice
    counts once. ``part`` is a block of turn numbers. A conversation's places
    and hashes are running sums inside a block plus those of the blocks before
    it, so no task needs a whole conversation.
    """
    rows = turns.select("conv_id", "turn", "role", "text").distinct()
    rows = rows.withColumn("part", F.floor(F.coalesce("turn", F.lit(0)) / BLOCK_TURNS).cast("long"))
    # The null turn comes first, as part -infinity would.
    rows = rows.withColumn("part", F.when(F.col("turn").isNull(), F.lit(-(2**62))).otherwise(F.col("part")))
    inside = Window.partitionBy("conv_id", "part").orderBy("turn", "role", "text")
    rows = rows.withColumn("row", F.row_number().over(inside).cast("long"))
    counts = rows.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    blocks = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("conv_id", "part", F.coalesce(F.sum("n").over(blocks), F.lit(0)).alias("ahead"))
    rows = beside(rows, starts).withColumn("place", F.col("ahead") + F.col("row")).drop("ahead", "row")
    marks = {h: F.xxhash64("place", "role", F.col("role").isNull(), "text", F.col("text").isNull(), F.lit(h)) for h in ("h1", "h2")}
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.select("*", *[m.alias(f"_{h}") for h, m in marks.items()])
    rows = rows.select("*", *[F.bit_xor(f"_{h}").over(upto).alias(h) for h in marks])
    sums = rows.groupBy("conv_id", "part").agg(*[F.bit_xor(f"_{h}").alias(h) for h in marks])
    sums = sums.select("conv_id", "part", *[F.coalesce(F.bit_xor(h).over(blocks), F.lit(0)).alias(f"{h}_ahead") for h in marks])
    rows = beside(rows, sums)
    return rows.select(
        "conv_id", "part", "turn", "place", "role", "text", *[F.col(h).bitwiseXOR(F.col(f"{h}_ahead")).alias(h) for h in marks]
    )


def beside(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    """Rows with what ``blocks`` has for their conversation, which may be null, and part."""
    other = blocks.withColumnsRenamed({"conv_id": "_conv", "part": "_part"})
    return rows.join(other, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("part") == F.col("_part"))).drop("_conv", "_part")


def maximal(placed: DataFrame) -> DataFrame:
    """``conv_id``, ``n_turns``, ``n_equal``: conversations that are no opening of a longer one.

    Of equal conversations that with the smallest id stays; ``n_equal`` counts them.
    """
    lengths = placed.groupBy("conv_id").agg(F.max("place").alias("n_turns"), F.max_by(F.struct("h1", "h2"), "place").alias("h"))
    ends = lengths.groupBy("n_turns", "h").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_equal"))
    # Openings: prefixes that go on. The same opening is kept once per task before the shuffle.
    last = lengths.select(F.col("conv_id").alias("_conv"), "n_turns")
    openings = placed.select("conv_id", "place", F.struct("h1", "h2").alias("h"))
    openings = openings.join(last, F.col("conv_id").eqNullSafe(F.col("_conv"))).where("place < n_turns")
    openings = openings.select(F.col("place").alias("n_turns"), "h").distinct()
    return ends.join(openings, ["n_turns", "h"], "left_anti").select("conv_id", "n_turns", "n_equal")


def format_chats(turns: DataFrame, folder: str | None = None) -> DataFrame:
    """``conv_id, part, n_turns, n_equal, text``: maximal conversations, rendered turn by turn.

    ``turns`` has ``conv_id``, ``turn``, ``role``, ``text``; other columns are
    ignored. A turn becomes ``<|role|>``, a line end, its text and a line end;
    ``<|`` within a text is written ``< |``, so no text can open a turn. A null role
    is ``unknown``, a null text empty, though neither equals one that says so. A
    null conversation id is an id like others, and ids may have any type that can be compared. ``part`` counts
    blocks of 256 turn numbers from 0: texts longer than that come in several rows, in order.
    """
    placed = stored(placed_turns(turns), folder or fresh_folder(turns.sparkSession), "turns")
    kept = maximal(placed).withColumnRenamed("conv_id", "_conv")
    said = F.concat(
        F.lit("<|"), F.coalesce("role", F.lit("unknown")), F.lit("|>\n"),
        F.replace(F.coalesce("text", F.lit("")), F.lit("<|"), F.lit("< |")), F.lit("\n"),
    )
    turn = F.struct("place", said.alias("said"))
    parts = placed.groupBy("conv_id", "part").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    rows = parts.join(kept, F.col("conv_id").eqNullSafe(F.col("_conv")))
    order = F.row_number().over(Window.partitionBy("conv_id").orderBy("part")) - 1
    text = F.array_join(F.transform("turns", lambda t: t["said"]), "")
    return rows.select("conv_id", order.cast("long").alias("part"), "n_turns", "n_equal", text.alias("text"))
