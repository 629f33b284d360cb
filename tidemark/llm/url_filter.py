"""URL filters: host rules first, then a list of blocked URLs behind a blocked Bloom filter.

The filter is a table of blocks. A listed URL sets bits in one block only, so
testing a page's URL is one lookup of one small row. Pages that the filter
passes go to an exact join with the list, which removes false positives; all
others need no further shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower
from tidemark.operators.pick import lookup

# A block has four 64-bit words, and a URL sets two bits in each.
WORDS = 4
BLOCK_BITS = 64 * WORDS
# A block row takes 40 bytes; a filter of up to so many blocks (20 MB) is sent to all executors.
BROADCAST_BLOCKS = 1 << 19


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """One spelling of a page's address: no scheme, ``www.``, ``m.``, query, ``.html`` or final slash."""
    return F.concat(F.regexp_replace(host, r"^(www|m)\.", ""), F.regexp_replace(path, r"(\.html|/)+$", ""))


def first_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule and its action; null if none fits.

    A rule such as ``net/es/`` fits the host and all its subdomains where the
    path starts with ``/es/``. Rules are a short list that people write.
    """
    rule = verdict = F.lit(None).cast("string")
    for action, text in sorted(rules, key=lambda r: len(r[1])):
        at, slash, start = text.partition("/")
        fits = (host.eqNullSafe(at) | host.endswith(f".{at}")) & path.startswith(slash + start)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, action).otherwise(verdict)
    return rule, verdict


def block_of(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def masks(key: Column) -> list[Column]:
    """The bits that a URL sets in each word of its block."""
    bits = F.xxhash64(key, F.lit("bits"))

    def bit(n: int) -> Column:
        place = F.shiftrightunsigned(bits, 6 * n).bitwiseAND(F.lit(63)).cast("int")
        return F.call_function("shiftleft", F.lit(1).cast("long"), place)

    return [bit(2 * w).bitwiseOR(bit(2 * w + 1)) for w in range(WORDS)]


def bloom_blocks(listed: DataFrame, blocks: int) -> DataFrame:
    """``block`` and its words ``w0`` to ``w3``, for the keys in ``listed.key``."""
    rows = listed.select(block_of(F.col("key"), blocks).alias("block"), *[m.alias(f"w{i}") for i, m in enumerate(masks(F.col("key")))])
    return rows.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def judge_urls(
    pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str]], bits_per_url: int = 16
) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``listed`` for every row of ``pages``.

    ``pages`` has ``page_id`` and ``url``, ``listed`` a column ``url``; other
    columns are ignored. A rule decides first; without one, a page is blocked
    if its canonical address is that of a listed URL, else allowed. A null URL,
    or one without ``://``, has an empty host and path, no rule, and is
    allowed; such URLs list nothing. Repeated pages give repeated rows, a
    repeated list changes nothing, and an empty list allows all.
    """
    keys = listed.select(F.col("url").alias("_u")).select(
        canonical(url_host(F.col("_u")), url_path(F.col("_u"))).alias("key")
    )
    keys = keys.where("key <> ''").distinct()
    blocks = max(1, -(-keys.count() * bits_per_url // BLOCK_BITS))
    rows = pages.select("page_id", F.col("url").alias("_u")).select(
        "page_id", url_host(F.col("_u")).alias("host"), url_path(F.col("_u")).alias("path")
    )
    rule, by_rule = first_rule(F.col("host"), F.col("path"), rules)
    key = F.col("key")
    rows = rows.select("*", rule.alias("rule"), by_rule.alias("by_rule"), canonical(F.col("host"), F.col("path")).alias("key"))
    rows = rows.withColumn("block", block_of(key, blocks))
    filtered = bloom_blocks(keys, blocks)
    tested = (
        rows.join(F.broadcast(filtered), "block", "left")
        if blocks <= BROADCAST_BLOCKS
        else lookup(rows, filtered, "block")
    )
    passes = F.lit(True)
    for i, mask in enumerate(masks(key)):
        passes = passes & (F.col(f"w{i}").bitwiseAND(mask) == mask)
    tested = tested.select(*rows.columns, F.coalesce(passes, F.lit(False)).alias("possible")).drop("block")
    hits = lookup(tested.where("possible"), keys.withColumn("listed", F.lit(True)), "key")
    rest = tested.where("NOT possible").withColumn("listed", F.lit(False))
    found = hits.unionByName(rest).withColumn("listed", F.coalesce("listed", F.lit(False)))
    by_list = F.when(F.col("listed"), "block").otherwise("allow")
    return found.select("page_id", "host", "path", "rule", F.coalesce("by_rule", by_list).alias("verdict"), "listed")
