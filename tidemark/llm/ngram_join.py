"""Jaccard join on word shingles by prefix filters under several global token orders.

Sets that are at least 75 % alike share a token among their first ones in *any*
order of all tokens: of n tokens the first n - ceil(0.75 n) + 1 will do. The
first order puts frequent tokens last and hashes the rest; its prefixes are the
rows that are shuffled by token. Pairs that meet there must meet under two more
orders as well, and the parities of their sets must leave room for enough common
tokens. These filters work on rows kept per set; only for pairs that pass all of
them are whole sets fetched and compared.

Groups of copies stay linear. Equal sets are one node. Each node is first
compared with one leader, the smallest node of the buckets it shares most often;
what that links is one class. Where a token still has many classes, each of them
is compared with a few members of the largest one, other ones in each round, as
long as that links. Afterwards all pairs from different classes are looked at. Where
a token would make many pairs for each of its rows, its sets meet in blocks: a task
counts what they share and returns only links that tie two classes which it had
not tied before, so such a group makes no more rows than it has. No
link between classes is lost, and none within one is needed.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, components, fresh_folder, stored
from tidemark.operators.pick import first_per, lookup

SHINGLE = 5
PERCENT = 75
# Of the 64-bit hashes the lower two thirds are counted, over all documents. Prefixes begin there, and a
# pair's first common token lies in the first seventh of the smaller set.
COUNTED_BELOW = (1 << 64) // 3 * 2
# A task sums up so many shingles and passes on those that it met more than once: a frequent-items sketch.
# The counts only choose an order, and any order is exact.
RUN_SHINGLES = 1 << 20
FREQUENT_LEAST = 4
# At most so many of the most frequent shingles come last in the orders: 9 MB for the driver and each worker.
# A table that is too short only makes some buckets larger.
FREQUENT = 1 << 20
# Texts are taken from a batch in slices of so many rows.
OUT_ROWS = 256
# A token with so many classes gets rounds of leaders, of which each class meets at most so many a round.
MANY_CLASSES, LEADERS, ROUNDS = 8, 2, 1
# Prefixes of so many tokens go along with each of their rows, so that a pair is made at its first common one only.
SHORT_PREFIX = 256
# A round that links less than this share of its pairs is the last one.
WORTHWHILE = 0.05
# A token with so many pairs of different classes for each of its rows is dense. Sets of dense tokens meet in blocks of so many
# rows, or of a part of them all, but of no more shingles than that.
DENSE, BLOCK_ROWS, BLOCKS, BLOCK_SHINGLES = 64, 256, 32, 1 << 22
# So many sides of pairs (at most 40 MB) are sent to all executors, more are shuffled.
BROADCAST_ROWS = 1 << 19

# Texts are hashed together up to so many bytes.
CHUNK_BYTES = 1 << 18
PIECE_BYTES = 1 << 20

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_IS_WORD = np.ones(256, bool)
_IS_WORD[list(SPACE.encode())] = False


def scrambled(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit numbers; each seed gives another order."""
    out = values ^ np.uint64(seed)
    out = (out ^ (out >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    out = (out ^ (out >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return out ^ (out >> np.uint64(31))


@functools.cache
def powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse."""
    out = []
    for base in (_MULTIPLIER, _INVERSE):
        row = np.full(count, base, np.uint64)
        row[0] = 1
        out.append(np.multiply.accumulate(row))
    return out[0], out[1]


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and 64-bit hash of each word: a polynomial of its bytes, scrambled with its length.

    Long texts are halved between words.
    """
    codes = np.frombuffer(data, np.uint8)
    if len(data) > PIECE_BYTES:
        gaps = np.flatnonzero(~_IS_WORD[codes])
        cut = gaps[min(np.searchsorted(gaps, len(data) // 2), len(gaps) - 1)] if len(gaps) else 0
        if 0 < cut:
            front, rest = word_hashes(data[:cut]), word_hashes(data[cut + 1 :])
            return np.concatenate((front[0], rest[0] + cut + 1)), np.concatenate((front[1], rest[1]))
    edges = np.flatnonzero(np.diff(_IS_WORD[codes], prepend=False, append=False))
    start, end = edges[::2], edges[1::2]
    power, inverse = powers(1 << max(20, len(data).bit_length()))
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * power[: len(codes)], out=sums[1:])
    own = (sums[end] - sums[start]) * inverse[start]
    return start, scrambled(own + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def shingles_of(texts: Sequence[str | None], size: int = SHINGLE) -> Iterator[np.ndarray]:
    """For each text the sorted distinct 64-bit hashes of its word shingles; of fewer words, one of them all."""
    held: list[bytes] = []
    count = 0
    for at, text in enumerate(texts):
        held.append((text or "").encode().lower())
        count += len(held[-1]) + 1
        if count >= CHUNK_BYTES or at == len(texts) - 1:
            yield from _chunk_shingles(held, size)
            held, count = [], 0


def _chunk_shingles(texts: list[bytes], size: int) -> Iterator[np.ndarray]:
    start, words = word_hashes(b" ".join(texts))
    offsets = np.cumsum([0, *[len(t) + 1 for t in texts]])
    first = np.searchsorted(start, offsets)
    rolled = np.full(max(len(words) - size + 1, 0), size, np.uint64)
    for shift in range(size):
        rolled = rolled * _MULTIPLIER + words[shift : shift + len(rolled)]
    rolled = scrambled(rolled)
    for begin, end in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if end - begin >= size:
            yield distinct(rolled[begin : end - size + 1])
        elif end == begin:
            yield np.empty(0, np.uint64)
        else:
            whole = np.full(1, end - begin, np.uint64)
            for word in words[begin:end]:
                whole = whole * _MULTIPLIER + word
            yield scrambled(whole)


def distinct(values: np.ndarray) -> np.ndarray:
    ordered = np.sort(values)
    fresh = np.empty(len(ordered), bool)
    fresh[0] = True
    np.not_equal(ordered[1:], ordered[:-1], out=fresh[1:])
    return ordered[fresh]


def parities(own: np.ndarray) -> np.ndarray:
    """A bit string of four to eight bits per token: which places an odd number of tokens falls on.

    It differs between two sets in no more bits than there are tokens in only
    one of them, which bounds what they share from above.
    """
    size = max(64, 4 << int(max(len(own) - 1, 1)).bit_length())
    odd = np.bincount((scrambled(own, 9) & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def prefix_size(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1


def signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for start in range(0, whole.num_rows, OUT_ROWS):
            yield whole.slice(start, OUT_ROWS)


def node_of(own: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(own.tobytes())


def set_rows(docs: DataFrame, orders, size: int, percent: int) -> DataFrame:
    """``doc_id, key, node, n, bits, second, third`` per document.

    ``key`` is a hash of the text and ``node`` of its set; ``bits`` are the
    set's parities, ``second`` and ``third`` its prefixes under two more orders, as
    32 bits of each token.
    """
    rows = docs.select("doc_id", F.xxhash64("text").alias("key"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = orders.value
        for batch in sliced(batches):
            nodes, sizes, bits, firsts = [], [], [], ([], [])
            for own in shingles_of(batch.column(2).to_pylist(), size):
                nodes.append(node_of(own))
                sizes.append(len(own))
                bits.append(parities(own))
                for prefix, into in zip(order.others(own, prefix_size(len(own), percent)), firsts, strict=True):
                    into.append(prefix)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:2],
                    signed(np.array(nodes, np.uint64)),
                    pa.array(sizes, pa.int64()),
                    pa.array(bits, pa.list_(pa.int64())),
                    *[pa.array(f, pa.list_(pa.int32())) for f in firsts],
                ],
                ["doc_id", "key", "node", "n", "bits", "second", "third"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"doc_id {kind}, key BIGINT, node BIGINT, n BIGINT, bits ARRAY<BIGINT>, second ARRAY<INT>, third ARRAY<INT>"
    )


def shingle_counts(docs: DataFrame, size: int) -> DataFrame:
    """``token, seen``: in about how many documents each shingle of the counted part is that a task met repeatedly."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def summed() -> pa.RecordBatch:
            token, seen = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            often = seen > 1
            return pa.RecordBatch.from_arrays([signed(token[often]), pa.array(seen[often].astype(np.int64))], ["token", "seen"])

        count = 0
        for batch in sliced(batches):
            for own in shingles_of(batch.column(0).to_pylist(), size):
                held.append(own[: np.searchsorted(own, np.uint64(COUNTED_BELOW))].copy())
                count += len(held[-1])
                if count >= RUN_SHINGLES:
                    count = 0
                    yield summed()
        if held:
            yield summed()

    return docs.select("text").mapInArrow(run, "token BIGINT, seen BIGINT").groupBy("token").agg(F.sum("seen").alias("seen"))


def frequent(counts: DataFrame, most: int) -> pa.Table:
    """Shingles with at least the least count that at most ``most`` of them reach; found from counts by powers of two."""
    step = F.floor(F.log2("seen")).cast("int")
    steps = counts.where(F.col("seen") >= FREQUENT_LEAST).groupBy(step.alias("step")).agg(F.count("*").alias("n")).collect()
    least, total = 64, 0
    for row in sorted(steps, reverse=True):
        total += row["n"]
        if total > most:
            break
        least = row["step"]
    return counts.where((F.col("seen") >= FREQUENT_LEAST) & (step >= least)).toArrow()


class Orders:
    """Global token orders: frequent tokens last, by classes of their counts, then by a seeded hash."""

    SEEDS = (2, 3)

    def __init__(self, token: np.ndarray, seen: np.ndarray) -> None:
        by = np.argsort(token)
        self.token = token[by]
        self.place = np.log2(np.maximum(seen[by], 1)).astype(np.uint8) + 1

    def places(self, own: np.ndarray) -> np.ndarray:
        if not len(self.token):
            return np.zeros(len(own), np.uint8)
        at = np.minimum(np.searchsorted(self.token, own), len(self.token) - 1)
        return np.where(self.token[at] == own, self.place[at], 0).astype(np.uint8)

    def first(self, own: np.ndarray, count: int, seed: int = 0) -> np.ndarray:
        """The first ``count`` of the sorted tokens ``own``; in order if there is no seed."""
        places = self.places(own)
        if seed:
            ranks = (scrambled(own, seed) >> np.uint64(8)) | (places.astype(np.uint64) << np.uint64(56))
            return own[np.argpartition(ranks, count - 1)[:count]] if len(own) else own
        return own[np.argsort(places, kind="stable")[:count]] if places.any() else own[:count]

    def others(self, own: np.ndarray, count: int) -> list[np.ndarray]:
        """The prefixes under the other orders, as 32 bits of each token."""
        return [self.first(own, count, seed).astype(np.uint32).view(np.int32) for seed in self.SEEDS]


def prefix_rows(docs: DataFrame, orders, size: int, percent: int) -> DataFrame:
    """``token, node, n, rank``: the prefix of each set under the first order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, done = orders.value, set()
        for batch in sliced(batches):
            done = done if len(done) < RUN_SHINGLES else set()
            parts, nodes, sizes = [], [], []
            for own in shingles_of(batch.column(0).to_pylist(), size):
                node = node_of(own)
                if len(own) and node not in done:
                    done.add(node)
                    parts.append(order.first(own, prefix_size(len(own), percent)))
                    nodes.append(node)
                    sizes.append(len(own))
            if parts:
                counts = [len(p) for p in parts]
                yield pa.RecordBatch.from_arrays(
                    [
                        signed(np.concatenate(parts)),
                        signed(np.repeat(np.array(nodes, np.uint64), counts)),
                        pa.array(np.repeat(np.array(sizes, np.int64), counts)),
                        pa.array(np.concatenate([np.arange(c) for c in counts])),
                    ],
                    ["token", "node", "n", "rank"],
                )

    return docs.select("text").mapInArrow(run, "token BIGINT, node BIGINT, n BIGINT, rank BIGINT")


def whole_sets(texts: DataFrame, size: int) -> DataFrame:
    """``a, b, side, n, tokens``: the whole set of each side of a pair."""
    names = ["a", "b", "side", "n", "tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            own = list(shingles_of(batch.column(3).to_pylist(), size))
            # Rows that share an id may hold other texts.
            node = np.array([node_of(o) for o in own], np.uint64).view(np.int64)
            wanted = pc.if_else(pc.equal(batch.column(2), "a"), batch.column(0), batch.column(1)).to_numpy()
            batch = batch.filter(pa.array(node == wanted))
            own = [o for o, right in zip(own, node == wanted, strict=True) if right]
            tokens = pa.array([o.view(np.int64) for o in own], pa.list_(pa.int64()))
            counts = pa.array([len(o) for o in own], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], counts, tokens], names)

    return texts.select("a", "b", "side", "text").mapInArrow(run, "a BIGINT, b BIGINT, side STRING, n BIGINT, tokens ARRAY<BIGINT>")


def ties(sets: pa.Table, percent: int) -> pa.Table:
    """``a, b``: links between sets of two blocks that tie all classes which such links tie.

    ``sets`` has ``i, j, block, node, label, tokens``. In the block ``i`` = ``j`` all
    rows meet, else those of one block meet those of the other one.
    """
    sets = sets.sort_by("block").combine_chunks()
    i, j, block, node = (sets[c].to_numpy() for c in ("i", "j", "block", "node"))
    lists = sets["tokens"].combine_chunks()
    sizes = pc.list_value_length(lists).to_numpy().astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    distinct_tokens, numbers = np.unique(lists.flatten().to_numpy(), return_inverse=True)
    row_of = np.repeat(np.arange(len(node)), sizes)
    kinds, class_of = np.unique(sets["label"].to_numpy(), return_inverse=True)
    # Of two sets of different classes one at least is not of the largest class.
    rest = np.flatnonzero(class_of != np.argmax(np.bincount(class_of, minlength=len(kinds))))
    cut = int(np.searchsorted(block, j[0])) if i[0] < j[0] else 0
    own, found = np.zeros(len(distinct_tokens), bool), []
    for at in rest.tolist():
        low, high = (0, len(node)) if not cut else (cut, len(node)) if at < cut else (0, cut)
        mine = numbers[ends[at] : ends[at + 1]]
        own[mine] = True
        met = own[numbers[ends[low] : ends[high]]]
        own[mine] = False
        common = np.bincount(row_of[ends[low] : ends[high]][met] - low, minlength=high - low)
        alike = (100 + percent) * common >= percent * (sizes[at] + sizes[low:high])
        for other in (np.flatnonzero(alike) + low).tolist():
            if class_of[other] != class_of[at]:
                found.append((at, other))
                class_of[class_of == class_of[other]] = class_of[at]
    pairs = np.sort(node[np.array(found, np.int64).reshape(-1, 2)], axis=1)
    return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})


class Join:
    """One run over one table of documents."""

    def __init__(self, docs: DataFrame, size: int, percent: int, folder: str) -> None:
        self.docs, self.size, self.percent, self.folder = docs, size, percent, folder
        spark = docs.sparkSession
        # Bounded by FREQUENT, as packed columns.
        often = frequent(stored(shingle_counts(docs, size), folder, "counts"), FREQUENT)
        self.orders = spark.sparkContext.broadcast(
            Orders(often["token"].to_numpy().astype(np.int64).view(np.uint64), often["seen"].to_numpy().astype(np.int64))
        )
        self.facts = stored(set_rows(docs, self.orders, size, percent), folder, "sets")

    def alike(self, a: str, b: str) -> str:
        """SQL: sizes and ranks let the pair reach the threshold with this token as the first common one."""
        enough = " AND ".join(f"{100 + self.percent} * ({s}.n - {s}.rank) >= {self.percent} * ({a}.n + {b}.n)" for s in (a, b))
        return f"100 * least({a}.n, {b}.n) >= {self.percent} * greatest({a}.n, {b}.n) AND {enough}"

    def buckets(self) -> DataFrame:
        """Prefix rows of tokens that several nodes share, with the smallest node of the token."""
        rows = prefix_rows(self.docs, self.orders, self.size, self.percent).repartition("token")
        own = Window.partitionBy("token")
        rows = rows.withColumn("_n", F.count("*").over(own)).where("_n > 1").drop("_n").dropDuplicates(["token", "node"])
        lead = F.min(F.struct("node", "n", "rank")).over(own)
        rows = rows.withColumn("lead", lead).withColumn("_n", F.count("*").over(own)).where("_n > 1").drop("_n")
        return stored(rows, self.folder, "buckets")

    def sets_of(self, nodes: DataFrame, *columns: Column) -> DataFrame:
        """One row of ``facts``, or of the given columns, for each of the nodes; other sets are not shuffled while these are few."""
        facts = self.facts.select("node", *(columns or ("n", "bits", "second", "third")))
        nodes = nodes.distinct()
        wanted = F.broadcast(nodes) if nodes.count() <= BROADCAST_ROWS else nodes
        return facts.join(wanted, "node", "left_semi").dropDuplicates(["node"])

    def possible(self, pairs: DataFrame) -> DataFrame:
        """The stored pairs ``a``, ``b`` that meet under all orders and whose parities leave room for enough common tokens."""
        sets = self.sets_of(pairs.select(F.explode(F.array("a", "b")).alias("node")))
        few = pairs.count() <= BROADCAST_ROWS
        for s in "ab":
            side = sets.select(F.col("node").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in ("n", "bits", "second", "third")])
            # The sets are wide: while pairs are few, they are sent to the sets of one side instead of both being shuffled.
            pairs = side.join(F.broadcast(pairs), s) if s == "a" and few else lookup(pairs, side, s, "inner")
        meet = F.arrays_overlap("second_a", "second_b") & F.arrays_overlap("third_a", "third_b")
        return pairs.where(meet).where(self.room("n_a", "n_b", "bits_a", "bits_b")).select("a", "b")

    def linked(self, pairs: DataFrame, name: str) -> DataFrame:
        """Those of the pairs ``a``, ``b`` that pass all filters and reach the threshold."""
        pairs = stored(self.possible(stored(pairs, self.folder, f"{name}-met")), self.folder, f"{name}-pairs")
        sides = pairs.select(
            "a", "b", F.explode(F.array(*[F.struct(F.lit(s).alias("side"), F.col(s).alias("node")) for s in "ab"])).alias("s")
        )
        sets = self.whole(sides.select("a", "b", "s.*"), name)
        one = F.struct("n", "tokens")
        both = sets.groupBy("a", "b").agg(*[F.first(F.when(F.col("side") == s, one), True).alias(s * 2) for s in "ab"])
        common = F.size(F.array_intersect("aa.tokens", "bb.tokens"))
        good = (100 + self.percent) * common >= self.percent * (F.col("aa.n") + F.col("bb.n"))
        return stored(both.where(good).select("a", "b"), self.folder, f"{name}-links")

    def whole(self, sides: DataFrame, name: str) -> DataFrame:
        """``whole_sets`` of the rows ``a, b, side, node``."""
        # A document to take the set's text from; where none has an id, one that has the text.
        first = self.facts.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.min("key").alias("key"))
        sides = stored(lookup(sides, first, "node", "inner").drop("node"), self.folder, f"{name}-sides")
        # Each side of a pair takes its text along, so a leader of many pairs is spread like its pairs.
        few = sides.count() <= BROADCAST_ROWS
        texts = beside(self.docs.select("doc_id", "text"), sides.drop("key"), "doc_id", few)
        if self.nameless:
            unnamed = sides.where("doc_id IS NULL").drop("doc_id")
            others = self.docs.where("doc_id IS NULL").select(F.xxhash64("text").alias("key"), "text")
            wanted = unnamed.select("key").distinct()
            others = lookup(others, wanted, "key", "left_semi").dropDuplicates(["key"])
            texts = texts.unionByName(beside(others, unnamed, "key", few))
        return whole_sets(texts, self.size)

    @functools.cached_property
    def nameless(self) -> bool:
        """Whether there are documents without an id."""
        return not self.facts.where("doc_id IS NULL").select("node").isEmpty()

    def classes(self) -> DataFrame:
        """``node``, ``root`` for all linked nodes."""
        rows = self.buckets()
        a = rows.selectExpr("node AS b", "lead.node AS a", "named_struct('n', n, 'rank', rank) AS x", "lead AS y").where("a <> b")
        led = a.where(self.alike("x", "y")).groupBy("a", "b").agg(F.count("*").alias("shared"), F.max("x.n").alias("n"))
        # Of copies most of the prefix is shared; other pairs can wait for the second step.
        best = led.where("16 * shared >= n").groupBy("b").agg(F.max_by("a", F.struct("shared", -F.col("a"))).alias("a"))
        links = self.linked(best.select("a", "b"), "led")
        known = components(links, f"{self.folder}/led")
        rows = stored(self.spread(self.labelled(rows.drop("lead"), known)), self.folder, "labels")
        for turn in range(ROUNDS):
            crowd = rows.where(F.col("classes") >= MANY_CLASSES)
            pairs = stored(self.led(crowd, turn), self.folder, f"turn-{turn}")
            tested = pairs.count()
            if not tested:
                break
            found = self.linked(pairs, f"turn-{turn}")
            links = links.unionByName(found)
            known = components(links, f"{self.folder}/turn-{turn}")
            # Classes only grow, so tokens of one class are done.
            rows = self.labelled(rows.select("token", "node", "n", "rank"), known)
            rows = stored(self.spread(rows), self.folder, f"labels-{turn}")
            if found.count() < WORTHWHILE * tested:
                break
        if not rows.where("dense").isEmpty():
            links = links.unionByName(self.dense_links(rows.where("dense")))
        pairs = self.across(rows)
        more = self.linked(pairs.join(best.select("a", "b"), ["a", "b"], "left_anti"), "rest")
        return components(links.unionByName(more), f"{self.folder}/all")

    def dense_links(self, rows: DataFrame) -> DataFrame:
        """``a, b``: links that tie all classes which links between nodes of one dense token tie.

        Tokens of a group of near copies mostly have the same main class, so a node
        goes there once, not with each token. In a block pair at most one link is returned
        for each of its classes.
        """
        nodes = stored(rows.select("main", "node", "label", "n").distinct(), self.folder, "dense")
        sides = nodes.select(F.col("node").alias("a"), F.col("node").alias("b"), F.lit("a").alias("side"), "node").distinct()
        sets = stored(self.whole(sides, "dense").select(F.col("a").alias("node"), "tokens"), self.folder, "dense-sets")
        blocks = F.greatest(F.least(F.ceil(F.count("*") / BLOCK_ROWS), F.lit(BLOCKS)), F.ceil(F.sum("n") / BLOCK_SHINGLES))
        dealt = lookup(nodes, nodes.groupBy("main").agg(blocks.alias("blocks")), "main", "inner")
        dealt = dealt.withColumn("block", F.pmod(F.xxhash64("node"), "blocks"))
        dealt = dealt.withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)")))
        dealt = dealt.select("main", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "label")
        percent = self.percent

        def tied(table: pa.Table) -> pa.Table:
            return ties(table, percent)

        met = lookup(dealt, sets, "node", "inner").groupBy("main", "i", "j").applyInArrow(tied, "a BIGINT, b BIGINT")
        return stored(met, self.folder, "dense-links")

    def across(self, mixed: DataFrame) -> DataFrame:
        """``a, b``: pairs of nodes of different classes that have a prefix token in common and may be alike.

        For tokens that many classes share the bound by parities is part of the
        join, so of a group of many sets that are not quite alike the pairs are
        compared, but are no rows; and each pair is made at the first such token only. Here
        half the parities will do, as these rows go along with each token of a node. Nodes
        that share a dense token have met there.
        """
        met = mixed.where("NOT dense")
        crowd, plain = met.where(F.col("classes") >= MANY_CLASSES), met.where(F.col("classes") < MANY_CLASSES)
        ordered = F.array_sort(F.collect_list(F.struct("rank", "token", "dense")))
        short = mixed.where((F.col("classes") >= MANY_CLASSES) | F.col("dense")).where(F.expr(f"n - ceil({self.percent} * n / 100) < {SHORT_PREFIX}"))
        listed = short.groupBy("node").agg(ordered.alias("all"))
        sets = self.sets_of(crowd.select("node"), half("bits").alias("bits"))
        ahead = F.expr("coalesce(transform(filter(all, e -> e.dense OR e.rank < rank), e -> e.token), array())")
        heavy = lookup(crowd, sets.join(listed, "node", "left"), "node", "inner").withColumn("ahead", ahead)
        heavy = stored(heavy.select("token", "node", "n", "rank", "label", "bits", "ahead"), self.folder, "heavy")
        bound = self.room("x.n", "y.n", "x.bits", "y.bits")
        pairs = self.met(plain, "true").union(self.met(heavy, f"NOT arrays_overlap(x.ahead, y.ahead) AND {bound}"))
        return pairs.distinct()

    def met(self, rows: DataFrame, also: str) -> DataFrame:
        """``a, b``: nodes of different classes that share a token, may be alike by it, and meet another condition."""
        rows = rows.withColumn("_t", F.xxhash64("token"))
        met = "x._t = y._t AND x.token = y.token AND x.label <> y.label AND x.node < y.node"
        pairs = rows.alias("x").join(rows.alias("y"), F.expr(f"{met} AND {self.alike('x', 'y')} AND {also}"))
        return pairs.select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))

    def room(self, n_a: str, n_b: str, bits_a: str, bits_b: str) -> str:
        """SQL: the parities of two sets leave room for enough common tokens."""
        # Sizes are powers of two; a longer one is folded to the shorter one.
        least = f"least(size({bits_a}), size({bits_b}))"
        part = "aggregate(sequence(i, size({0}), {1}), 0L, (v, k) -> v ^ {0}[k - 1])"
        folded = f"transform(sequence(1, {least}), i -> bit_count({part.format(bits_a, least)} ^ {part.format(bits_b, least)}))"
        apart = f"aggregate({folded}, 0L, (v, c) -> v + c)"
        return f"{100 + self.percent} * ({n_a} + {n_b} - {apart}) >= {2 * self.percent} * ({n_a} + {n_b})"

    def labelled(self, rows: DataFrame, known: DataFrame) -> DataFrame:
        """Rows with the ``label`` of their node's class; the stored roots are sent around while they are few."""
        few = known.count() <= BROADCAST_ROWS
        rows = rows.join(F.broadcast(known), "node", "left") if few else lookup(rows, known, "node")
        return rows.withColumn("label", F.coalesce("root", "node")).drop("root")

    def spread(self, label: DataFrame) -> DataFrame:
        """Rows of tokens that several classes share, with ``classes``, their number, and ``main``, the one that has most nodes there.

        ``dense`` tells that the token has many pairs of different classes for each of its rows.

        The rows are dealt by token once, like the buckets, and everything is a window over that.
        """
        own, same = Window.partitionBy("token"), Window.partitionBy("token", "label")
        rows = label.repartition("token").withColumn("_c", F.count("*").over(same))
        first = F.row_number().over(same.orderBy("node")) == 1
        rows = rows.withColumn("_first", first.cast("int")).withColumn("classes", F.sum("_first").over(own)).where("classes > 1")
        # Each node of a class counts all of them, so the sum is that of the squares.
        all_rows, within = F.count("*").over(own), F.sum("_c").over(own)
        rows = rows.withColumn("dense", all_rows * all_rows - within >= 2 * DENSE * all_rows)
        return rows.withColumn("main", F.max(F.struct("_c", "label")).over(own)["label"]).drop("_c", "_first")

    def led(self, crowd: DataFrame, turn: int) -> DataFrame:
        """``a, b``: nodes with a few nodes of the main class, chosen by a hash that is another one in each round."""
        seeds = [F.xxhash64("node", F.lit(turn * LEADERS + k)).alias("h") for k in range(LEADERS)]
        leaders = [F.min(F.struct(seed, "node", "n", "rank")).alias(f"l{k}") for k, seed in enumerate(seeds)]
        leaders = crowd.where("label = main").groupBy("token").agg(*leaders)
        others = lookup(crowd.where("label <> main"), leaders, "token", "inner")
        lead = F.explode(F.array(*[F.struct(f"l{k}.node", f"l{k}.n", f"l{k}.rank") for k in range(LEADERS)]))
        met = others.select(F.col("node").alias("b"), F.struct("n", "rank").alias("x"), lead.alias("y"))
        met = met.where(self.alike("x", "y")).groupBy(F.col("y.node").alias("a"), "b").agg(F.count("*").alias("shared"))
        rank = F.row_number().over(Window.partitionBy("b").orderBy(F.desc("shared"), "a"))
        return met.withColumn("_rank", rank).where(F.col("_rank") <= LEADERS).select("a", "b")

    def roots(self) -> DataFrame:
        """The facts of all documents with words, with the ``root`` of their class."""
        facts = self.facts.where("n > 0").select("doc_id", "key", "node", "n")
        return lookup(facts, self.classes(), "node").withColumn("root", F.coalesce("root", "node"))


def half(bits: str) -> Column:
    """Parities folded to half their size; sets still differ in no more bits than in tokens."""
    folded = f"transform(sequence(1, size({bits}) div 2), i -> {bits}[i - 1] ^ {bits}[i - 1 + size({bits}) div 2])"
    return F.expr(f"if(size({bits}) > 1, {folded}, {bits})")


def beside(texts: DataFrame, sides: DataFrame, key: str, few: bool) -> DataFrame:
    """``a, b, side, text``: a few sides are sent to all executors, many are shuffled."""
    if few:
        rows = texts.join(F.broadcast(sides), key)
    else:
        rows = texts.withColumn("_hash", F.xxhash64(key)).join(sides.withColumn("_hash", F.xxhash64(key)), ["_hash", key])
    return rows.select("a", "b", "side", "text")


def jaccard_classes(
    docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, folder: str | None = None
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs`` (``doc_id``, ``text``).

    Two documents link when their sets of distinct word shingles share at least
    ``percent`` of their union; A-Z are lower-cased. A text of fewer words than
    ``size`` has one shingle, its whole sequence; a null text or one without
    words has none and links with nothing. ``component_id`` is the smallest
    ``doc_id`` reachable by links. Rows that share a ``doc_id`` and a text are
    copies like others; a document without an id links like others, but gives
    its class no name. Other columns are ignored. Sets and shingles are known by
    64-bit hashes.
    """
    join = Join(docs, size, percent, folder or fresh_folder(docs.sparkSession))
    roots = join.roots()
    names = roots.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    linked = lookup(roots, names, "root").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    alone = join.facts.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone)


def one_of_each(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, folder: str | None = None) -> DataFrame:
    """``docs`` with all its columns, of each class only one row.

    It is the row with the smallest ``doc_id``, of several with that id the one
    with the least hash of its text; rows without an id come last. Of rows with
    the same id and text any one stays. What goes is told by id and text, so a
    row that shares only its id with one that goes stays. Documents without a
    word are in no class, and all stay.
    """
    join = Join(docs, size, percent, folder or fresh_folder(docs.sparkSession))
    place = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "key")
    rows = join.roots().groupBy("root", place.alias("place")).agg(F.count("*").alias("times"))
    best = rows.groupBy("root").agg(F.min("place").alias("best"))
    rows = lookup(rows, best, "root").select("place", "times", (F.col("place") == F.col("best")).alias("stays"))
    rows = stored(rows, join.folder, "verdicts")

    def marked(verdicts: DataFrame) -> DataFrame:
        return verdicts.select(F.col("place.doc_id").alias("_id"), F.col("place.key").alias("_key"))

    def same(right: DataFrame) -> Column:
        return (F.xxhash64(docs["text"]) == right["_key"]) & docs["doc_id"].eqNullSafe(right["_id"])

    gone, again = marked(rows.where("NOT stays")), marked(rows.where("stays AND times > 1"))
    kept = docs.join(gone, same(gone), "left_anti")
    if again.isEmpty():
        return kept
    alone = kept.join(again, same(again), "left_anti")
    twice = docs.join(again, same(again), "left_semi")
    key = F.struct(twice["doc_id"].isNull(), twice["doc_id"], F.xxhash64(twice["text"]))
    return alone.unionByName(first_per(twice.withColumn("_place", key), "_place", F.lit(1)).drop("_place"))
