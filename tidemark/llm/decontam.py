"""Benchmark decontamination with a generalised suffix automaton of the test items.

The automaton accepts every run of words of every item. Streaming a document
through it gives, at each word, the longest run ending there that some item
has; a run of ``window`` words or a whole shorter item is a hit. Documents stay
where they are: the automaton goes to them, in blocks of bounded size that are
built in tasks. A task holds a few blocks, and further ones are one more map over rows.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import fresh_folder, pieces, stored

WINDOW = 10
# Words of benchmark text in one automaton; a state takes about 400 bytes, and there are two a word at most.
BLOCK_WORDS = 150_000
# Automata that a task holds at once.
HELD_BLOCKS = 4
# Of a document of which over half is hit, nothing is kept.
MAX_HIT_PERCENT = 50

WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words_of(text: str) -> list[bytes]:
    """Runs of 0-9, A-Z lower-cased, a-z and everything beyond ASCII."""
    return text.encode().translate(WORD_BYTES).split()


@dataclass
class Automaton:
    """Generalised suffix automaton over the words of items, with the items of each window."""

    window: int = WINDOW
    vocabulary: dict[bytes, int] = field(default_factory=dict)
    length: list[int] = field(default_factory=lambda: [0])
    link: list[int] = field(default_factory=lambda: [-1])
    next: list[dict[int, int]] = field(default_factory=lambda: [{}])
    whole: dict[int, set[str]] = field(default_factory=dict)  # items of the window that ends in a state
    short: dict[int, list[tuple[int, str]]] = field(default_factory=dict)  # whole items below a window
    shortest: int = WINDOW

    @classmethod
    def of(cls, items: list[tuple[str, str]], window: int = WINDOW) -> Automaton:
        made = cls(window=window, shortest=window)
        coded = []
        for name, text in items:
            ids = [made.vocabulary.setdefault(w, len(made.vocabulary)) for w in words_of(text)]
            if ids:
                made.add(ids)
                coded.append((name, ids))
        for name, ids in coded:
            made.mark(name, ids)
        return made

    def state(self, length: int, link: int, following: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(following)
        return len(self.length) - 1

    def split(self, at: int, word: int) -> int:
        """The state that ``word`` leads to from ``at``, made to end runs of one word more than ``at``."""
        to = self.next[at][word]
        if self.length[to] == self.length[at] + 1:
            return to
        copy = self.state(self.length[at] + 1, self.link[to], dict(self.next[to]))
        self.link[to] = copy
        while at >= 0 and self.next[at].get(word) == to:
            self.next[at][word] = copy
            at = self.link[at]
        return copy

    def add(self, ids: list[int]) -> None:
        last = 0
        for word in ids:
            if word in self.next[last]:
                last = self.split(last, word)
                continue
            new, at = self.state(self.length[last] + 1, 0, {}), last
            while at >= 0 and word not in self.next[at]:
                self.next[at][word] = new
                at = self.link[at]
            if at >= 0:
                self.link[new] = self.split(at, word)
            last = new

    def holding(self, at: int, size: int) -> int:
        """Of the suffixes of ``at``, the state that has the one of ``size`` words."""
        while self.length[self.link[at]] >= size:
            at = self.link[at]
        return at

    def mark(self, name: str, ids: list[int]) -> None:
        at = 0
        for place, word in enumerate(ids, 1):
            at = self.next[at][word]
            if place >= self.window:
                at = self.holding(at, self.window)
                self.whole.setdefault(at, set()).add(name)
        if len(ids) < self.window:
            self.short.setdefault(self.holding(at, len(ids)), []).append((len(ids), name))
            self.shortest = min(self.shortest, len(ids))

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Hits as (first word, word behind), and the items they come from."""
        get = self.vocabulary.get
        ids = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        # Only runs of known words can match; each begins at the root.
        edges = np.flatnonzero(np.diff(np.concatenate(([0], ids >= 0, [0]))))
        hits: list[tuple[int, int]] = []
        found: set[str] = set()
        for begin, end in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if end - begin >= self.shortest:
                self.walk(ids[begin:end].tolist(), begin, hits, found)
        return hits, found

    def walk(self, ids: list[int], begin: int, hits: list[tuple[int, int]], found: set[str]) -> None:
        at = matched = 0  # the state and the length of the longest match that ends here
        for place, word in enumerate(ids, begin + 1):
            while at and word not in self.next[at]:
                at = self.link[at]
                matched = self.length[at]
            if word not in self.next[at]:
                continue
            at, matched = self.next[at][word], matched + 1
            if matched >= self.window:
                hits.append((place - self.window, place))
                found |= self.whole.get(self.holding(at, self.window), set())
            if self.short:
                state = at
                while state > 0:
                    for size, name in self.short.get(state, ()):
                        if size <= matched:
                            hits.append((place - size, place))
                            found.add(name)
                    state = self.link[state]


def merged(hits: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Hits as spans that neither touch nor overlap."""
    spans: list[tuple[int, int]] = []
    for begin, end in sorted(hits):
        if spans and begin <= spans[-1][1]:
            spans[-1] = spans[-1][0], max(end, spans[-1][1])
        else:
            spans.append((begin, end))
    return spans


def pieces_of(items: DataFrame, window: int, step: int) -> DataFrame:
    """``name, text, n``: items as runs of words that begin ``step`` words apart and overlap by ``window - 1``.

    Each window of a long item lies in one of its runs; a shorter item is one run.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            for name, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                words = words_of(text)
                for start in range(0, max(1, len(words) - window + 1) if words else 0, step):
                    part = words[start : start + step + window - 1]
                    yield pa.RecordBatch.from_pydict({"name": [name], "text": [b" ".join(part).decode()], "n": [len(part)]})

    return items.mapInArrow(run, "name STRING, text STRING, n BIGINT")


def automata(benchmark: DataFrame, folder: str, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> list[Broadcast]:
    """One automaton, pickled and broadcast, for each block of items; built in tasks and kept below ``folder``.

    A block is bounded, however large the benchmark or an item of it, and the driver passes them on one by one.
    An item without an id is called ``null``; items without words do nothing.
    """
    spark = benchmark.sparkSession
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("name"), F.coalesce("text", F.lit("")).alias("text")
    ).distinct()
    # Runs of a quarter of a block deal out evenly.
    runs = stored(pieces_of(items, window, max(1, block_words // 4)), folder, "runs")
    total = runs.agg(F.sum("n")).first()[0] or 0
    block = F.pmod(F.xxhash64("name", "text"), F.lit(max(1, -(-total // block_words))))

    def build(rows: pa.Table) -> pa.Table:
        made = Automaton.of(list(zip(rows["name"].to_pylist(), rows["text"].to_pylist(), strict=True)), window)
        return pa.table({"block": rows["block"][:1], "automaton": pa.array([pickle.dumps(made)], pa.binary())})

    built = runs.withColumn("block", block).groupBy("block").applyInArrow(build, "block BIGINT, automaton BINARY")
    built = stored(built, folder, "automata")
    numbers = [row["block"] for row in built.select("block").orderBy("block").collect()]
    made = (bytes(built.where(F.col("block") == n).first()["automaton"]) for n in numbers)
    return [spark.sparkContext.broadcast(one) for one in made]


def groups_of(blocks: list[Broadcast]) -> list[list[Broadcast]]:
    """Blocks that a task holds together; one empty group if there are none."""
    return [blocks[at : at + HELD_BLOCKS] for at in range(0, len(blocks), HELD_BLOCKS)] or [[]]


SPANS = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
HIT = (
    T.StructType()
    .add("n_words", "long")
    .add("spans", T.ArrayType(T.StructType().add("begin", "long").add("end", "long")))
    .add("items", T.ArrayType(T.StringType()))
)
HIT_ARROW = pa.struct([("n_words", pa.int64()), ("spans", SPANS), ("items", pa.list_(pa.string()))])


def unused(columns: list[str], name: str) -> str:
    """The name, with as many underscores ahead as make it a new one."""
    taken = {c.lower() for c in columns}
    while name in taken:
        name = f"_{name}"
    return name


def with_hits(rows: DataFrame, blocks: list[Broadcast], folder: str, name: str) -> DataFrame:
    """``rows`` with a struct of the words of ``text``, the spans of them that are hit and the items found, sorted.

    A task holds a few blocks at once; between two such groups the rows are written below ``folder``.
    """
    at, width = rows.columns.index("text"), len(rows.columns)
    schema = T.StructType([*rows.schema.fields, T.StructField(name, HIT)])
    for number, group in enumerate(groups_of(blocks)):

        def run(batches: Iterator[pa.RecordBatch], group=group, first=number == 0) -> Iterator[pa.RecordBatch]:
            own = [pickle.loads(block.value) for block in group]
            for batch in pieces(batches):
                rows = []
                for row in range(batch.num_rows):
                    words = words_of(batch.column(at)[row].as_py() or "")
                    before = {"spans": [], "items": []} if first else batch.column(width)[row].as_py()
                    hits, found = [(h["begin"], h["end"]) for h in before["spans"]], set(before["items"])
                    for automaton in own:
                        more, names = automaton.scan(words)
                        hits += more
                        found |= names
                    spans = [{"begin": begin, "end": end} for begin, end in merged(hits)]
                    rows.append({"n_words": len(words), "spans": spans, "items": sorted(found)})
                yield pa.RecordBatch.from_arrays([*batch.columns[:width], pa.array(rows, HIT_ARROW)], schema.names)

        rows = (stored(rows, folder, f"pass-{number}") if number else rows).mapInArrow(run, schema)
    return rows


def scanned(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS, folder: str | None = None
) -> DataFrame:
    """``doc_id``, ``n_words``, ``spans`` of hit words and the ``items`` found, for every row of ``docs``.

    ``docs`` has ``doc_id`` and ``text``, ``benchmark`` ``item_id`` and ``text``;
    other columns are ignored. A null or empty text has no words and no spans;
    repeated rows get repeated results; without items nothing is hit.
    """
    folder = folder or fresh_folder(docs.sparkSession)
    blocks = automata(benchmark, folder, window, block_words)
    return with_hits(docs.select("doc_id", "text"), blocks, folder, "hit").select("doc_id", "hit.*")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document: words, hit words, items found, a digest of their ids, and whether there is a hit."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    return scanned(docs, benchmark, window, block_words).select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.sort_array("items"), ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def without(text: str, spans: list[tuple[int, int]], n_words: int) -> str | None:
    """The text without the spans of its words; None if these are over half of them."""
    if 100 * sum(end - begin for begin, end in spans) > MAX_HIT_PERCENT * n_words:
        return None
    places = [m.span() for m in WORD.finditer(text)]
    parts, at = [], 0
    for begin, end in spans:
        parts.append(text[at : places[begin][0]])
        at = places[end - 1][1]
    return "".join([*parts, text[at:]])


def cut(text: str, blocks: list[Automaton]) -> str | None:
    """The text without its hit spans; None if over half of its words are hit.

    What a cut brings together is looked at again, until nothing is hit.
    """
    now: str | None = text
    while now:
        words = words_of(now)
        spans = merged([hit for block in blocks for hit in block.scan(words)[0]])
        if not spans:
            break
        now = without(now, spans, len(words))
    return now


def edited(batch: pa.RecordBatch, names: list[str], after: list[str | None]) -> pa.RecordBatch:
    """The batch's columns ``names`` with new texts and their ``n_chars``, and whether a text changed; rows without a new text go."""
    at, size = names.index("text"), names.index("n_chars") if "n_chars" in names else None
    columns, texts = batch.columns[: len(names)], batch.column(at).to_pylist()
    changed = [a != t for a, t in zip(after, texts, strict=True)]
    columns[at] = pa.array(after, batch.schema.field(at).type)
    if size is not None:
        counts = [len(a or "") if c else n for n, a, c in zip(columns[size].to_pylist(), after, changed, strict=True)]
        columns[size] = pa.array(counts, batch.schema.field(size).type)
    kept = pa.array([a is not None or not c for a, c in zip(after, changed, strict=True)], pa.bool_())
    return pa.RecordBatch.from_arrays([*columns, pa.array(changed, pa.bool_())], [*names, "changed"]).filter(kept)


def decontaminated(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS, folder: str | None = None
) -> DataFrame:
    """``docs`` with all its columns, hit spans cut out of ``text``; rows that are mostly hit go.

    ``n_chars``, if it is there, is counted anew for texts that change. Texts
    without a hit, null and empty ones stay as they are. If a task can hold all
    blocks it cuts a text until nothing is hit; with more of them each cut is one
    pass over the texts that the last one changed, with the same result.
    """
    folder = folder or fresh_folder(docs.sparkSession)
    blocks = automata(benchmark, folder, window, block_words)
    names, at = docs.columns, docs.columns.index("text")

    def cut_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [pickle.loads(block.value) for block in blocks]
        for batch in pieces(batches):
            after = [text and cut(text, own) for text in batch.column(at).to_pylist()]
            done = edited(batch, names, after)
            yield pa.RecordBatch.from_arrays(done.columns[:-1], names)

    if len(blocks) <= HELD_BLOCKS:
        return docs.mapInArrow(cut_all, docs.schema)

    def cut_once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            after = []
            for text, hit in zip(batch.column(at).to_pylist(), batch.column(len(names)).to_pylist(), strict=True):
                spans = [(span["begin"], span["end"]) for span in hit["spans"]]
                after.append(without(text, spans, hit["n_words"]) if spans else text)
            yield edited(batch, names, after)

    mark, turn = unused(names, "_changed"), 0
    schema = T.StructType([*docs.schema.fields, T.StructField(mark, T.BooleanType())])
    rows, kept = docs, None
    while True:
        place = f"{folder}/cut-{turn}"
        hits = with_hits(rows, blocks, place, unused(names, "_hit"))
        done = stored(hits.mapInArrow(cut_once, schema), place, "rows")
        same = done.where(~F.col(mark)).drop(mark)
        kept = kept.union(same) if kept is not None else same
        rows, turn = done.where(F.col(mark)).drop(mark), turn + 1
        if rows.isEmpty():
            return kept
