"""Repair of conversation structure: the cheapest edits that give a legal order of roles.

A conversation is legal if the initials of its roles read ``(s?(ua)+)?``. Four
states say what the repaired part ends with; each row keeps one survivor per
state, the cheapest way there, of equal ones the least in ASCII order. Survivors
are leaves of a tree of back pointers. Its nodes count who refers to them, so
that dead branches go at once, and as soon as all survivors share an ancestor the
edits above it are emitted. What is held is the suffix that is still undecided.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, fresh_folder, stored
from tidemark.operators.pick import lookup

# States: nothing yet, after a system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
# Fixed by the task: costs of the edits, and the surcharge for a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
# What it costs at most to go on from a state (column) as another one (row) would: a state
# that is dearer than another one by more than that can't win any more.
STAND_IN = (
    (0, 0, 5, 0),
    (10, 0, 5, 10),
    (7, 5, 0, 5),
    (2, 0, 5, 0),
)
ENDS = ".!?"
# The undecided suffix is looked through when it has grown to this, or to twice what stayed last time.
LEAST_SUFFIX = 32
OUT_ROWS = 1024


class Node:
    """An edit: its letter, its row, the edit before it."""

    __slots__ = ("depth", "jump", "letter", "parent", "refs", "row")

    def __init__(self, parent: Node | None, letter: str, row: tuple | None) -> None:
        self.parent, self.letter, self.row, self.refs = parent, letter, row, 0
        if parent is None:
            self.depth, self.jump = 0, self
        else:
            far = parent.jump
            self.depth = parent.depth + 1
            # Pointers whose lengths follow the skew binary numbers: any ancestor is a few jumps away.
            self.jump = far.jump if parent.depth - far.depth == far.depth - far.jump.depth else parent


def before(a: Node, b: Node) -> bool:
    """Whether the whole path to ``a`` is less than that to ``b``.

    Paths of one cost to one state differ at the first edits below their last
    common one, and two edits after the same one have different letters.
    """
    while a.depth > b.depth:
        a = a.jump if a.jump.depth >= b.depth else a.parent
    while b.depth > a.depth:
        b = b.jump if b.jump.depth >= a.depth else b.parent
    while a.parent is not b.parent:
        a, b = (a.jump, b.jump) if a.jump is not b.jump else (a.parent, b.parent)
    return a.letter < b.letter


class Repair:
    """One conversation, row by row: ``feed`` and ``finish`` give edits as soon as they are sure."""

    def __init__(self) -> None:
        self.base = Node(None, "", None)
        self.base.refs = 1
        self.alive: list[tuple[int, Node] | None] = [(0, self.base), None, None, None]
        self.state = START
        self.limit = LEAST_SUFFIX
        self.cost = 0
        self._move(self.alive, inserts_only=True)

    def feed(self, role: str, text: str, must_go: bool, truncated: bool) -> Iterator[tuple[str, str | None, str]]:
        row = (role, text)
        initial, extra = role[:1], TRUNCATED if truncated else 0
        found: list[tuple[int, Node] | None] = [None] * 4
        for state, survivor in enumerate(self.alive):
            if survivor is None:
                continue
            cost, node = survivor
            self._offer(found, state, cost + DELETE, Node(node, "D", row))
            if must_go:
                continue
            after = ASSISTANT if state == USER else USER
            self._offer(found, after, cost + REROLE + extra, Node(node, "R", row))
            if initial == "s" and state == START:
                self._offer(found, SYSTEM, cost + extra, Node(node, "K", row))
            elif initial == "ua"[state == USER]:
                self._offer(found, after, cost + extra, Node(node, "K", row))
        self._move(found)
        yield from self._settled()

    def finish(self) -> Iterator[tuple[str, str | None, str]]:
        ends = [x for x in (self.alive[START], self.alive[ASSISTANT]) if x]
        best = ends[0]
        if len(ends) > 1 and (ends[1][0], before(best[1], ends[1][1])) <= (best[0], False):
            best = ends[1]
        self.cost = best[0]
        yield from self._emitted(self._path(best[1]))

    @staticmethod
    def _offer(found: list, state: int, cost: int, node: Node) -> None:
        now = found[state]
        if now is None or cost < now[0] or (cost == now[0] and before(node, now[1])):
            found[state] = (cost, node)

    def _move(self, found: list, inserts_only: bool = False) -> None:
        """Inserts behind the row, then dead states go, then the survivors' branches are counted."""
        for state in (START, SYSTEM, ASSISTANT):
            if found[state]:
                self._offer(found, USER, found[state][0] + INSERT, Node(found[state][1], "I", None))
        if found[USER]:
            self._offer(found, ASSISTANT, found[USER][0] + INSERT, Node(found[USER][1], "I", None))
        costs = [x[0] if x else None for x in found]
        for state in range(4):
            if costs[state] is not None and any(
                c is not None and costs[state] > c + STAND_IN[other][state] for other, c in enumerate(costs)
            ):
                found[state] = None
        old = [] if inserts_only else [x[1] for x in self.alive if x]
        for survivor in found:
            if survivor and survivor[1] is not self.base:
                self._hold(survivor[1])
        self.alive = found
        for node in old:
            self._release(node)

    @staticmethod
    def _hold(node: Node) -> None:
        """A survivor's branch down from the tree gets its references; each node counts its children and holders."""
        node.refs += 1
        while node.parent is not None and node.refs == 1:
            node = node.parent
            node.refs += 1

    def _release(self, node: Node) -> None:
        node.refs -= 1
        while not node.refs and node is not self.base:
            node.row, node = None, node.parent
            node.refs -= 1

    def _path(self, node: Node) -> list[Node]:
        """Edits from the last emitted one to ``node``, in order."""
        path = []
        while node is not self.base:
            path.append(node)
            node = node.parent
        return path[::-1]

    def _settled(self) -> Iterator[tuple[str, str | None, str]]:
        leaf = min((x for x in self.alive if x), key=lambda x: x[1].depth)[1]
        if leaf.depth - self.base.depth < self.limit:
            return
        path, sure = self._path(leaf), 0
        above = self.base
        while sure < len(path) and above.refs == 1:
            above = path[sure]
            sure += 1
        yield from self._emitted(path[:sure])
        self.limit = max(LEAST_SUFFIX, 2 * (len(path) - sure))

    def _emitted(self, path: list[Node]) -> Iterator[tuple[str, str | None, str]]:
        """``letter, role, text`` of each edit; a deleted row has no role."""
        for node in path:
            letter, (role, text) = node.letter, node.row or ("", "")
            if letter == "D":
                role = None
            else:
                after = SYSTEM if letter == "K" and role[:1] == "s" else ASSISTANT if self.state == USER else USER
                if letter != "K":
                    role = "assistant" if after == ASSISTANT else "user"
                self.state = after
            # Pointers from below may still lead here, but no further text is kept alive.
            node.parent = node.row = None
            self.base = node
            yield letter, role, text


def damaged(turns: DataFrame) -> DataFrame:
    """Rows of ``turns`` after seeded damage; a dropped one stays with ``gone``, so its conversation is known."""

    def filled(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn"))) % 20
    rows = turns.select("conv_id", "turn", filled("role").alias("role"), filled("text").alias("text"), kind.alias("_d"))
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("_d") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("_d") == 1, "").when(F.col("_d") == 2, F.translate("text", ENDS, "")).otherwise(F.col("text")).alias("text"),
        (F.col("_d") == 0).alias("gone"),
        F.explode(F.when(F.col("_d") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )


def judged(rows: DataFrame, folder: str) -> DataFrame:
    """Rows with ``fault``: the first of blank, duplicate, truncated that holds, else empty.

    Whether role and text were seen before in the conversation is asked of an
    aggregate by their digest, so no task needs a whole conversation.
    """
    if "gone" not in rows.columns:
        rows = rows.select("*", F.lit(False).alias("gone"), F.lit(0).alias("copy"))
    end = F.substring(F.rtrim(F.col("text"), F.lit(SPACE)), -1, 1)
    key = F.md5(
        F.concat_ws(":", F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("n")), F.length("role"), "role", "text")
    )
    rows = rows.select(
        "conv_id", "turn", "role", "text", "gone", "copy", F.monotonically_increasing_id().alias("id"),
        F.when(F.col("gone"), "gone").when(end == "", "blank").when(~end.isin(*ENDS), "truncated").otherwise("").alias("ending"),
        key.alias("key"),
    )
    rows = stored(rows, folder, "rows")
    place = F.struct(F.col("turn").isNotNull(), "turn", "copy", "id").alias("place")
    seen = rows.where(~F.col("gone")).groupBy("key").agg(F.count("*").alias("n"), F.min(place).alias("first"))
    rows = lookup(rows, seen.where("n > 1").select("key", F.col("first.id").alias("first_id")), "key")
    again = (F.col("id") != F.col("first_id")) & ~F.col("ending").isin("gone", "blank")
    return rows.withColumn("fault", F.when(again, "duplicate").otherwise(F.col("ending")))


def in_order(rows: DataFrame) -> DataFrame:
    """Judged rows, each conversation a stream of its own; the sort spills, so its length is free."""
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text", "copy", "id")
    return rows.select("conv_id", "turn", "role", "text", "fault")


def streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for whole in batches:
        for start in range(0, whole.num_rows, OUT_ROWS):
            yield from zip(*[c.to_pylist() for c in whole.slice(start, OUT_ROWS).columns], strict=True)


class Summary:
    """What is reported of one conversation; all of it but the audit has a fixed size."""

    def __init__(self, conv_id: object) -> None:
        self.conv_id, self.repair = conv_id, Repair()
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        self.low = self.high = self.last_role = None
        self.turns = self.illegal = 0
        self.audit, self.lines, self.digest = bytearray(), 0, hashlib.sha256()

    def row(self, turn: int | None, role: str, text: str, fault: str) -> None:
        if fault == "gone":
            return
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high, self.turns = turn, self.turns + 1
        if self.last_role is not None and self.last_role[:1] + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.last_role = role
        if fault:
            self.counts[fault] += 1
        self._take(self.repair.feed(role, text, fault in ("blank", "duplicate"), fault == "truncated"))

    def _take(self, edits: Iterator[tuple[str, str | None, str]]) -> None:
        for letter, role, text in edits:
            self.audit += letter.encode()
            if role is not None:
                self.digest.update(("\n" * (self.lines > 0) + f"{role}:{text}").encode("utf-8", "surrogatepass"))
                self.lines += 1

    def result(self) -> tuple:
        self._take(self.repair.finish())
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        counts = self.counts.values()
        return (self.conv_id, gaps, *counts, self.illegal, self.repair.cost, self.audit.decode(), self.digest.hexdigest())


SUMMARY = "gaps BIGINT, blank BIGINT, duplicate BIGINT, truncated BIGINT, illegal BIGINT, cost BIGINT, audit STRING, repaired_sha256 STRING"


def audits(rows: DataFrame, folder: str | None = None) -> DataFrame:
    """One row per conversation: faults, gaps in turn numbers, cost and letters of the edits, digest of the result.

    ``rows`` has ``conv_id``, ``turn``, ``role`` and ``text`` (nulls filled),
    and may have ``gone`` and ``copy`` of :func:`damaged`; other columns are
    ignored. Rows go by turn, nulls first; rows of one turn by role, then text. A
    null conversation id is an id like others. A conversation of which no row
    is left has zeros, no audit and the digest of an empty text. The digest runs
    over a conversation's text in order, so one task reads a conversation, as a
    stream: it holds a batch, the undecided suffix and a letter per edit.
    """
    rows = judged(rows, folder or fresh_folder(rows.sparkSession))
    kind = rows.schema["conv_id"].dataType
    schema = f"conv_id {kind.simpleString()}, {SUMMARY}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, done, conv_type = None, [], None

        def packed() -> pa.RecordBatch:
            columns = list(zip(*done, strict=True))
            types = [conv_type, *[pa.int64()] * 6, pa.string(), pa.string()]
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        def typed(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            nonlocal conv_type
            for batch in source:
                conv_type = batch.schema.field(0).type
                yield batch

        for conv_id, turn, role, text, fault in streamed(typed(batches)):
            if own is None or conv_id != own.conv_id:
                if own is not None:
                    done.append(own.result())
                    if len(done) >= OUT_ROWS:
                        yield packed()
                own = Summary(conv_id)
            own.row(turn, role, text, fault)
        if own is not None:
            done.append(own.result())
            yield packed()

    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return in_order(rows).mapInArrow(run, schema)


def repaired_turns(rows: DataFrame, folder: str | None = None) -> DataFrame:
    """``conv_id, place, role, text``: the repaired conversations, turn by turn from 0.

    Takes and treats rows as :func:`audits` does; a conversation of which nothing is left has no rows.
    """
    rows = judged(rows, folder or fresh_folder(rows.sparkSession))
    schema = f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, place BIGINT, role STRING, text STRING"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv_type = pa.null()

        def typed(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            nonlocal conv_type
            for batch in source:
                conv_type = batch.schema.field(0).type
                yield batch

        def turns() -> Iterator[tuple]:
            before_first, conv, own, place = object(), None, None, 0
            conv = before_first
            for conv_id, _, role, text, fault in streamed(typed(batches)):
                if conv is before_first or conv_id != conv:
                    if own is not None:
                        for _, new_role, new_text in own.finish():
                            if new_role is not None:
                                yield conv, place, new_role, new_text
                                place += 1
                    conv, own, place = conv_id, Repair(), 0
                if fault == "gone":
                    continue
                for _, new_role, new_text in own.feed(role, text, fault in ("blank", "duplicate"), fault == "truncated"):
                    if new_role is not None:
                        yield conv, place, new_role, new_text
                        place += 1
            if own is not None:
                for _, new_role, new_text in own.finish():
                    if new_role is not None:
                        yield conv, place, new_role, new_text
                        place += 1

        held: list[tuple] = []

        def packed() -> pa.RecordBatch:
            columns = list(zip(*held, strict=True))
            held.clear()
            types = [conv_type, pa.int64(), pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["conv_id", "place", "role", "text"]
            )

        for turn in turns():
            held.append(turn)
            if len(held) >= OUT_ROWS:
                yield packed()
        if held:
            yield packed()

    return in_order(rows).mapInArrow(run, schema)
