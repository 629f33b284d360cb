"""Merkle manifest of a dataset: a digest per row, per source and for all, with a proof per row.

A row's place among the rows of its source comes from a bitmap of ids instead of
a sort. Bitmaps are kept by words of 64 ids, empty words left out, and built with
map-side combine. A directory of bit counts says how many ids lie ahead of each
word; the rest of a row's rank is the bit count below its own bit. With places
known, 16 neighbours share a key: each level is one aggregate into arrays of 16
slots, and proofs come down the same arrays level by level.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, fresh_folder, stored
from tidemark.operators.pick import lookup

FANOUT = 16
# Powers of two: ids of one bitmap word, and words of one block of the directory.
WORD_BITS, BLOCK_BITS = 6, 10
# Below all words: that of rows without an id.
NO_WORD = -(2**62)
# Rows that share an id are told apart by leading hex digits of their digest first.
PREFIX = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
NO_PATH = "CAST(array() AS ARRAY<STRUCT<l: STRING, r: STRING>>)"


def leaf_digest(text: Column) -> Column:
    """SHA-256 over all fields of a row, each with its length in bytes; null is ``-``."""
    parts = []
    for name in FIELDS:
        value = text if name == "text" else F.col(name).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def leaves(docs: DataFrame, folder: str) -> DataFrame:
    """``tree, id, doc_id, digest, forged``: the leaf of each row, and of the row after tampering if it is chosen."""
    source = F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))  # null comes first
    chosen = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    rows = docs.select(
        source.alias("tree"),
        F.monotonically_increasing_id().alias("id"),
        "doc_id",
        leaf_digest(F.col("text")).alias("digest"),
        F.when(chosen, leaf_digest(ascii_lower(F.col("text")))).alias("forged"),
    )
    return stored(rows, folder, "leaves")


def ranked(rows: DataFrame, folder: str) -> DataFrame:
    """Rows with ``slot``, their place from 0 among the rows of their tree by doc_id, and ``n``, the tree's rows.

    Rows without an id come first. Rows that share an id go by digest; equal
    digests in any order.
    """
    number = F.col("doc_id").cast("long")
    bit = F.coalesce(F.pmod(number, F.lit(1 << WORD_BITS)), F.lit(0)).cast("int")
    key = rows.withColumn("word", F.coalesce(F.shiftright(number, WORD_BITS), F.lit(NO_WORD))).withColumn("bit", bit)
    mask = F.expr("bit_or(shiftleft(1L, bit))")
    words = key.groupBy("tree", "word").agg(mask.alias("mask"), F.count("*").alias("held"))
    words = stored(words.withColumn("block", F.shiftright("word", BLOCK_BITS)), folder, "words")
    # The directory: rows ahead of a block in its tree, and ahead of a word in its block.
    blocks = words.groupBy("tree", "block").agg(F.sum("held").alias("held"))
    own = Window.partitionBy("tree")
    blocks = blocks.select(
        "tree",
        "block",
        (F.sum("held").over(own.orderBy("block")) - F.col("held")).alias("ahead"),
        F.sum("held").over(own).alias("n"),
    )
    inside = Window.partitionBy("tree", "block").orderBy("word")
    words = words.withColumn("before", F.sum("held").over(inside) - F.col("held"))
    words = words.join(blocks, ["tree", "block"])
    crowded = (F.col("held") > F.bit_count("mask")) | (F.col("word") == NO_WORD)
    words = words.select(
        F.struct("tree", "word").alias("key"), "mask", (F.col("ahead") + F.col("before")).alias("start"), "n", crowded.alias("crowded")
    )
    placed = lookup(key.withColumn("key", F.struct("tree", "word")), stored(words, folder, "directory"), "key", "inner")
    below = F.expr("bit_count(mask & ~shiftleft(-1L, bit))")
    alone = placed.where("NOT crowded").withColumn("slot", F.col("start") + below)
    keep = ["tree", "id", "doc_id", "digest", "forged", "slot", "n"]
    return alone.select(keep).unionByName(_tied(placed.where("crowded")).select(keep))


def _tied(rows: DataFrame) -> DataFrame:
    """Slots for words in which rows share an id: counts by id and digest prefix, then by digest, then by file part.

    A third of all rows with one id, or with one digest, is split by each of these.
    """
    rows = rows.withColumn("head", F.substring("digest", 1, PREFIX)).withColumn("part", F.shiftright("id", 33))
    outer, inner, last = ["tree", "word"], ["bit", "head"], ["digest", "part"]

    def ahead(counts: DataFrame, by: list[str], order: list[str], name: str) -> DataFrame:
        window = Window.partitionBy(*by).orderBy(*order)
        return counts.withColumn(name, F.sum("c").over(window) - F.col("c")).drop("c")

    heads = ahead(rows.groupBy(*outer, *inner).agg(F.count("*").alias("c")), outer, inner, "a")
    parts = ahead(rows.groupBy(*outer, *inner, *last).agg(F.count("*").alias("c")), [*outer, *inner], last, "b")
    for counts, by in ((heads, outer + inner), (parts, outer + inner + last)):
        key = F.struct(*by)
        rows = lookup(rows.withColumn("_key", key), counts.select(key.alias("_key"), counts.columns[-1]), "_key").drop("_key")
    own = F.row_number().over(Window.partitionBy(*outer, *inner, *last).orderBy("id")) - 1
    return rows.withColumn("slot", F.col("start") + F.col("a") + F.col("b") + own)


def reduced(nodes: DataFrame, folder: str) -> tuple[list[DataFrame], DataFrame]:
    """Runs of each level, from the leaves up, and ``tree, digest, height`` of each tree's last node.

    ``nodes`` has ``tree, slot, n, digest, doc_id, forged``. Nodes whose slots fall
    on the same 16 are one array.
    """
    most = nodes.agg(F.max("n")).first()[0] or 0
    runs, tops, level = [], [], 0
    while True:
        tops.append(nodes.where("n = 1").select("tree", "digest", F.lit(level).alias("height"), "doc_id", "forged"))
        if most <= 1:
            break
        slot = F.struct((F.col("slot") % FANOUT).cast("int").alias("at"), "digest", "doc_id", "forged")
        run = nodes.where("n > 1").groupBy("tree", F.floor(F.col("slot") / FANOUT).cast("long").alias("slot"))
        run = run.agg(F.sort_array(F.collect_list(slot)).alias("kids"), F.max("n").alias("n"))
        run = run.withColumn("digest", F.sha2(F.array_join("kids.digest", ""), 256))
        run = stored(run.withColumn("n", F.ceil(F.col("n") / FANOUT).cast("long")), folder, f"level-{level + 1}")
        runs.append(run)
        none = [F.lit(None).cast(kind).alias(name) for name, kind in (("doc_id", nodes.schema["doc_id"].dataType), ("forged", "string"))]
        nodes = run.select("tree", "slot", "n", "digest", *none)
        most, level = -(-most // FANOUT), level + 1
    return runs, stored(reduce(DataFrame.unionByName, tops), folder, "tops")


def proven(runs: list[DataFrame], tops: DataFrame, folder: str) -> DataFrame:
    """Each leaf with its ``path``: siblings to its left and right, level by level up to the root.

    ``tops`` has the ``path`` from each tree's last node on. The path of a run
    is fetched once for its 16 nodes.
    """
    rows = None
    for level in range(len(runs), -1, -1):
        here = tops.where(F.col("height") == level).withColumn("slot", F.lit(0).cast("long"))
        here = here.select("tree", "slot", "digest", "doc_id", "forged", "path", "top")
        rows = here if rows is None else rows.unionByName(here)
        if level == 0:
            break
        if level < len(runs):
            rows = stored(rows, folder, f"paths-{level}")
        key = F.struct("tree", "slot")
        above = rows.select(key.alias("key"), "path", "top")
        below = runs[level - 1].select(key.alias("key"), "tree", "slot", "kids")
        rows = lookup(below, above, "key", "inner")
        rows = rows.select("tree", "slot", "path", "top", "kids", F.posexplode("kids").alias("at", "kid"))
        beside = F.expr(
            """named_struct('l', array_join(transform(slice(kids, 1, at), k -> k.digest), ''),
                            'r', array_join(transform(slice(kids, at + 2, size(kids)), k -> k.digest), ''))"""
        )
        rows = rows.select(
            "tree",
            (F.col("slot") * FANOUT + F.col("at")).alias("slot"),
            F.col("kid.digest").alias("digest"),
            F.col("kid.doc_id").alias("doc_id"),
            F.col("kid.forged").alias("forged"),
            F.concat(F.array(beside), "path").alias("path"),
            "top",
        )
    return rows


def manifest(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, source, slot`` for every row of ``docs``.

    ``docs`` has ``doc_id`` (an integer), ``source``, ``lang``, ``n_chars``,
    ``text``; other columns are ignored. Every row is a leaf, a repeated one as
    often as it is there: see :func:`ranked` for rows without an id or that share
    one. A null source is a source of its own, before all others. Nulls in
    other columns are ``-``. An empty table has no rows and no root. Rows without
    an id are never tampered with.
    """
    folder = folder or fresh_folder(docs.sparkSession)
    nodes = stored(ranked(leaves(docs, folder), folder), folder, "nodes")
    runs, tops = reduced(nodes, folder)
    # Sources in order: a sort by range; the place inside its partition and the partitions ahead number each.
    order = tops.repartitionByRange("tree").sortWithinPartitions("tree")
    order = order.select("tree", F.col("digest"), F.monotonically_increasing_id().alias("id"))
    order = stored(order.withColumn("part", F.shiftright("id", 33)), folder, "order")
    parts = order.groupBy("part").agg(F.count("*").alias("c"), F.min("id").alias("low"))
    every = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition of the sort
    parts = parts.select("part", "low", F.coalesce(F.sum("c").over(every), F.lit(0)).alias("ahead"))
    total = order.groupBy().agg(F.count("*").alias("n"))
    kind = nodes.schema["doc_id"].dataType
    sources = order.join(parts, "part").select(
        F.lit("").alias("tree"), (F.col("id") - F.col("low") + F.col("ahead")).alias("slot"), "digest",
        F.lit(None).cast(kind).alias("doc_id"), F.col("tree").alias("forged"),
    )
    sources = stored(sources.withColumn("n", F.lit(total.first()["n"])), folder, "sources")
    upper_runs, upper_top = reduced(sources, f"{folder}/upper")
    upper_top = upper_top.withColumn("path", F.expr(NO_PATH)).withColumn("top", F.struct(F.col("digest").alias("root"), F.lit("").alias("subroot")))
    paths = proven(upper_runs, upper_top, f"{folder}/upper")
    # The upper leaves carry the name of their source where rows carry the forged digest.
    paths = paths.select(F.col("forged").alias("tree"), "path", F.struct(F.col("top.root").alias("root"), F.col("digest").alias("subroot")).alias("top"))
    tops = stored(lookup(tops, paths, "tree", "inner"), folder, "placed")
    rows = proven(runs, tops, folder)
    proof = F.sha2(F.expr("array_join(transform(path, x -> concat(x.l, x.r)), '')"), 256)
    folded = F.expr("aggregate(path, coalesce(forged, digest), (node, x) -> sha2(concat(x.l, node, x.r), 256))")
    return rows.select(
        "doc_id",
        F.col("digest").alias("leaf"),
        "top.subroot",
        "top.root",
        proof.alias("proof_sha256"),
        folded.alias("folded_root"),
        F.when(F.col("tree") != "n", F.substring("tree", 2, 1 << 30)).alias("source"),
        "slot",
    ).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"), "source", "slot")
