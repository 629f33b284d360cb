"""Near-duplicate lines by a segment-partition edit join, and documents without their repeats.

Two lines within ``edits`` edits share one of ``edits + 1`` segments of the
shorter one, at a place that lengths and the segment's number narrow down to a
few. Each line is therefore indexed under its own segments and probes with those
substrings of itself that could be a segment of a line as long or a little
shorter. Pairs that meet are verified by a banded bit-parallel edit distance.

Equal lines are one node. Groups of similar lines stay linear: each line is
first compared with one leader, and then only with lines of other classes.
Everything is built from column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, components, fresh_folder, stored
from tidemark.operators.pick import lookup

EDITS = 2
# Shorter lines are compared for equality alone.
MIN_CHARS = 30
# Tables of this many 8-byte keys (at most 16 MB) are sent to all executors, larger ones are shuffled.
BROADCAST_KEYS = 1 << 21


def line_rows(docs: DataFrame) -> DataFrame:
    """``doc_id, version, place, line`` for each line with a word, white space around it removed.

    ``version`` is a hash of the text: rows with one id and text are one document.
    """
    texts = docs.select("doc_id", F.xxhash64("text").alias("version"), F.split("text", "\n").alias("lines"))
    # The outer form spares a filter that would split the text once more; null texts go with empty lines.
    lines = texts.select("doc_id", "version", F.posexplode_outer("lines").alias("place", "line"))
    return lines.withColumn("line", F.btrim("line", F.lit(SPACE))).where("line <> ''")


def line_key(line: Column) -> Column:
    return F.unhex(F.md5(line))


def probes(edits: int) -> list[tuple[int, int, int]]:
    """``shorter, number, shift``: where a line has to look for segments of lines that much shorter.

    Of segments that match, one has at most as many edits before it as segments,
    and the same from the right; that bounds its shift from both sides.
    """
    return [
        (shorter, number, shift)
        for shorter in range(edits + 1)
        for number in range(1, edits + 2)
        for shift in range(
            max(1 - number, shorter - (edits + 1 - number)), min(number - 1, shorter + (edits + 1 - number)) + 1
        )
    ]


def segment_rows(lines: DataFrame, edits: int, min_chars: int) -> DataFrame:
    """``key, id, indexed``: the keys under which a line is indexed and probes.

    A key is the hash of a substring, of the length of the line it could be a
    segment of, and of the segment's number. The last segments of a line take
    the remainder of its length.
    """
    lines = lines.selectExpr("xxhash64(line) AS id", "line", "char_length(line) AS size").where(f"size >= {min_chars}")
    # Characters of one byte each are found without walking through the line; the bytes hash alike.
    lines = lines.selectExpr("id", "line", "size", "if(octet_length(line) = size, CAST(line AS BINARY), NULL) AS ascii")
    places = ", ".join(f"named_struct('shorter', {x}, 'number', {n}, 'shift', {y})" for x, n, y in probes(edits))
    rows = lines.selectExpr("id", "line", "ascii", "size", f"inline(array({places}))").where(f"size - shorter >= {min_chars}")
    rows = rows.selectExpr(
        "*", f"CAST((size - shorter) div {edits + 1} AS INT) AS base", f"{edits + 1} - (size - shorter) % {edits + 1} AS short"
    )
    start = "1 + (number - 1) * base + greatest(0, number - 1 - short) + shift"
    cut = f"{start}, base + if(number > short, 1, 0)"
    own = f"if(ascii IS NULL, CAST(substring(line, {cut}) AS BINARY), substring(ascii, {cut}))"
    key = f"xxhash64({own}, size - shorter, number)"
    return rows.selectExpr(f"{key} AS key", "id", "shorter = 0 AND shift = 0 AS indexed")


# Texts up to this length are trimmed to the end.
TRIMMED = (1 << 18) - 1


def common_prefix(a: Column, b: Column, length: Column) -> Column:
    """How many first characters agree, found by halving; beyond ``TRIMMED`` a lower bound."""
    steps = F.array(*[F.lit(1 << n) for n in range(17, -1, -1)])

    def longer(at: Column, step: Column) -> Column:
        same = F.substring(a, at + 1, step) == F.substring(b, at + 1, step)
        return F.when((at + step <= length) & same, at + step).otherwise(at)

    return F.aggregate(steps, F.lit(0), longer)


def two_edits_possible(a: Column, b: Column, front: Column, m_a: Column, m_b: Column) -> Column:
    """Whether what is left of two texts between ``front`` and their common end can be two edits apart.

    Both parts begin and end with other characters, so an edit stands at either
    end, each taking a character of one or both, and nothing lies in between.
    """
    takes = ((1, 1), (1, 0), (0, 1))
    found = F.greatest(m_a, m_b) <= 2
    for x, y in takes:
        for v, w in takes:
            size = m_a - (x + v)
            inner = F.substring(a, front + 1 + x, size) == F.substring(b, front + 1 + y, size)
            found = found | ((size >= 0) & (size == m_b - (y + w)) & inner)
    return found


def with_value(value: Column, use) -> Column:
    """``use(value)``, with the value computed once."""
    return F.transform(F.array(value), use)[0]


def banded_distance(a: Column, b: Column, edits: int) -> Column:
    """Edit distance of two arrays of characters whose sizes differ by ``edits`` at most.

    Exact up to ``edits``, larger beyond. A bit vector holds the vertical
    differences of the cells within ``edits`` of the diagonal, one column of the
    table per character of ``b``; bit 0 is the topmost of them, and two more rows
    above keep carries right. The distance is followed along the lowest diagonal
    and then along the last row.
    """
    above = edits + 2
    width = above + edits + 1
    every = (1 << width) - 1
    top = 1 << (width - 1)
    n_a, n_b = F.size(a), F.size(b)

    def equal_rows(j: Column) -> Column:
        letter = b[j - 1]
        mask = F.lit(0)
        for bit in range(width):
            row = j - above + bit
            hit = (row >= 1) & (row <= n_a) & F.get(a, row - 1).eqNullSafe(letter)
            mask = mask.bitwiseOR(F.when(hit, 1 << bit).otherwise(0))
        return mask

    def step(state: Column, j: Column) -> Column:
        vp, vn, found = state["vp"], state["vn"], state["found"]

        def from_match(x: Column) -> Column:
            carried = (x.bitwiseAND(vp) + vp).bitwiseXOR(vp).bitwiseOR(x).bitwiseOR(vn).bitwiseAND(F.lit(every))
            return with_value(carried, from_diagonal)

        def from_diagonal(d0: Column) -> Column:
            hp = vn.bitwiseOR(F.lit(every).bitwiseXOR(d0.bitwiseOR(vp)))
            hn = d0.bitwiseAND(vp)
            return with_value(F.struct(hp.alias("p"), hn.alias("n"), F.shiftright(d0, 1).alias("d")), lambda h: finished(h, d0))

        def finished(h: Column, d0: Column) -> Column:
            last = F.call_function("shiftleft", F.lit(1), F.greatest(n_a - j + above, F.lit(0)))
            on_diagonal = F.when(d0.bitwiseAND(F.lit(top)) == 0, 1).otherwise(0)
            on_row = F.when(h["p"].bitwiseAND(last) != 0, 1).when(h["n"].bitwiseAND(last) != 0, -1).otherwise(0)
            new_vp = h["n"].bitwiseOR(F.lit(every).bitwiseXOR(h["d"].bitwiseOR(h["p"])))
            return F.struct(
                new_vp.alias("vp"),
                h["d"].bitwiseAND(h["p"]).alias("vn"),
                (found + F.when(j <= n_a - edits, on_diagonal).otherwise(on_row)).alias("found"),
            )

        return with_value(equal_rows(j), from_match)

    first = F.struct(
        F.lit(((1 << (edits + 1)) - 1) << above).alias("vp"),
        F.lit(0).alias("vn"),
        F.least(F.lit(edits), n_a).alias("found"),
    )
    whole = F.aggregate(F.sequence(F.lit(1), n_b), first, step, lambda s: s["found"])
    return F.when(n_b == 0, n_a).when(n_a == 0, n_b).otherwise(whole)


def letter_parities(line: Column) -> Column:
    """64 bits: of which characters (by their codes modulo 64) a text has an odd number. An edit turns at most two of them."""
    letters = F.split(line, "")
    one = F.lit(1).cast("long")
    return F.aggregate(letters, F.lit(0).cast("long"), lambda odd, c: odd.bitwiseXOR(F.call_function("shiftleft", one, F.ascii(c))))


def parities_near(a: Column, b: Column, edits: int) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= 2 * edits


def pieces_recur(a: Column, b: Column, edits: int) -> Column:
    """Whether all but ``edits`` of some equal pieces of a text stand in the other one, near their place."""
    pieces = 4 * edits
    size = F.call_function("div", F.char_length(a), F.lit(pieces)).cast("int")
    found = F.lit(0)
    for number in range(pieces):
        start = size * number + 1
        low = F.greatest(start - edits, F.lit(1))
        there = F.contains(F.substring(b, low, start + size + edits - low), F.substring(a, start, size))
        found = found + F.when(there, 1).otherwise(0)
    return found >= pieces - edits


def within(a: Column, b: Column, edits: int) -> Column:
    """Whether two texts are at most ``edits`` edits apart; what they begin and end with alike is skipped.

    Texts of which too many pieces are missing are left out first. For up to two edits, parts that no two edits can explain are told apart by
    a few comparisons of strings before the distance is computed.
    """
    n_a, n_b = F.char_length(a), F.char_length(b)

    def middle(cut: Column) -> Column:
        front, m_a, m_b = cut["front"], n_a - cut["front"] - cut["back"], n_b - cut["front"] - cut["back"]

        def letters(text: Column, length: Column) -> Column:
            part = F.substring(text, front + 1, length)
            return F.when(part == "", F.array().cast("array<string>")).otherwise(F.split(part, ""))

        whole = with_value(
            F.struct(letters(a, m_a).alias("a"), letters(b, m_b).alias("b")),
            lambda m: banded_distance(m["a"], m["b"], edits) <= edits,
        )
        if edits > 2:
            return whole
        return F.when((F.greatest(n_a, n_b) > TRIMMED) | two_edits_possible(a, b, front, m_a, m_b), whole).otherwise(False)

    def back(front: Column) -> Column:
        ends = common_prefix(F.reverse(a), F.reverse(b), F.least(n_a, n_b) - front)
        return with_value(F.struct(front.alias("front"), ends.alias("back")), middle)

    near = (F.abs(n_a - n_b) <= edits) & pieces_recur(a, b, edits)
    return F.when(near, with_value(common_prefix(a, b, F.least(n_a, n_b)), back)).otherwise(False)


def among(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in the stored table ``keys``, which is sent around if it is small and shuffled if not."""
    if keys.count() <= BROADCAST_KEYS:
        return rows.join(F.broadcast(keys), key, "left_semi")
    return lookup(rows, keys, key, "inner")


class Join:
    """One run over one table of lines."""

    def __init__(self, lines: DataFrame, edits: int, min_chars: int, folder: str) -> None:
        self.lines, self.edits, self.min_chars, self.folder = lines, edits, min_chars, folder

    def buckets(self) -> DataFrame:
        """``key, id, indexed, lead`` where different lines share a key; copies are combined before each shuffle."""
        rows = segment_rows(self.lines, self.edits, self.min_chars)
        keys = rows.groupBy("key").agg(
            F.min("id").alias("low"), F.max("id").alias("high"), F.min(F.when(F.col("indexed"), F.col("id"))).alias("lead")
        )
        shared = stored(keys.where("low <> high AND lead IS NOT NULL").select("key", "lead"), self.folder, "keys")
        rows = among(rows, shared.select("key"), "key").groupBy("key", "id").agg(F.max("indexed").alias("indexed"))
        return stored(lookup(rows, shared, "key", "inner"), self.folder, "buckets")

    def texts(self, ids: DataFrame, name: str) -> DataFrame:
        """``id``, ``line``, ``odd`` (parities of its letters) of the given ids; two lines that share an id both come."""
        ids = stored(ids.select("id").distinct(), self.folder, f"{name}-ids")
        lines = among(self.lines.select(F.xxhash64("line").alias("id"), "line"), ids, "id")
        lines = lines.dropDuplicates(["id", "line"]).withColumn("odd", letter_parities(F.col("line")))
        return stored(lines, self.folder, f"{name}-lines")

    def near(self) -> Column:
        """Whether lines a and b are similar; the parities of their letters rule out most pairs by one comparison."""
        return parities_near(F.col("odd_a"), F.col("odd_b"), self.edits) & within(F.col("line_a"), F.col("line_b"), self.edits)

    def links(self, pairs: DataFrame, name: str) -> DataFrame:
        """``a``, ``b`` and the lines' keys, for rows of ``id_a, line_a, id_b, line_b``."""
        keys = [line_key(F.col(f"line_{s}")).alias(f"key_{s}") for s in "ab"]
        return stored(pairs.select(F.col("id_a").alias("a"), F.col("id_b").alias("b"), *keys).distinct(), self.folder, f"{name}-links")

    def classes(self) -> DataFrame:
        """``node``, ``root``: keys of similar lines and the smallest key of their class.

        First each line is verified against the leader it shares most keys
        with. Then lines of different classes that share a key are joined; the
        distance is a condition of that join, so pairs that are not similar are
        never rows.
        """
        rows = self.buckets()
        led = rows.where("id <> lead").groupBy("id", "lead").agg(F.count("*").alias("shared"))
        best = led.groupBy("id").agg(F.max_by("lead", F.struct("shared", -F.col("lead"))).alias("lead"))
        lines = self.texts(rows, "shared")
        mine = lines.withColumnsRenamed({"line": "line_b", "odd": "odd_b"})
        leads = lines.withColumnsRenamed({"id": "lead", "line": "line_a", "odd": "odd_a"})
        first = lookup(lookup(best, mine, "id", "inner"), leads, "lead", "inner")
        first = first.where(self.near())
        links = self.links(first.withColumnsRenamed({"id": "id_b", "lead": "id_a"}), "led")
        known = components(links.select("a", "b"), f"{self.folder}/led")
        label = lookup(rows, known.withColumnRenamed("node", "id"), "id").withColumn("label", F.coalesce("root", "id"))
        spread = label.groupBy("key").agg(F.min("label").alias("_l"), F.max("label").alias("_m")).where("_l <> _m").select("key")
        mixed = lookup(label, spread, "key", "inner").select("key", "id", "indexed", "label")
        mixed = stored(lookup(mixed, lines, "id", "inner"), self.folder, "mixed").withColumn("_t", F.xxhash64("key"))

        def side(s: str) -> DataFrame:
            return mixed.select("_t", "key", *[F.col(c).alias(f"{c}_{s}") for c in ("id", "indexed", "label", "line", "odd")])

        apart = "indexed_a AND label_a <> label_b AND (id_a < id_b OR NOT indexed_b)"
        rest = side("a").join(side("b"), ["_t", "key"]).where(F.expr(apart) & self.near())
        edges = links.unionByName(self.links(rest, "rest"))
        return components(edges.select(F.col("key_a").alias("a"), F.col("key_b").alias("b")), f"{self.folder}/all")


def removed_lines(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS, folder: str | None = None) -> DataFrame:
    """``doc_id, version, places``: the line numbers (from 0) of repeats in each document that has any.

    A class of equal or similar lines keeps its first line, by ``doc_id`` (null
    first), then text, then place. Lines of ``min_chars`` characters or more are
    similar within ``edits`` edits, and classes are closed under that.
    """
    folder = folder or fresh_folder(docs.sparkSession)
    lines = line_rows(docs)
    classes = Join(lines, edits, min_chars, folder).classes()
    seen = stored(lines.select("doc_id", "version", "place", line_key(F.col("line")).alias("node")), folder, "seen")
    at = F.struct("doc_id", "version", "place")
    firsts = seen.groupBy("node").agg(F.min(at).alias("first"))
    firsts = stored(lookup(firsts, classes, "node"), folder, "firsts")
    shared = firsts.where("root IS NOT NULL").groupBy("root").agg(F.min("first").alias("least"))
    firsts = firsts.where("root IS NULL").select("node", "first").unionByName(
        lookup(firsts.where("root IS NOT NULL"), shared, "root").select("node", F.col("least").alias("first"))
    )
    repeats = lookup(seen, firsts, "node").where(~at.eqNullSafe(F.col("first")))
    return repeats.groupBy("doc_id", "version").agg(F.collect_set("place").alias("places"))


def dedup_lines(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS, folder: str | None = None) -> DataFrame:
    """``docs`` with its columns, ``text`` without repeated lines, and ``_n_lines``, ``_n_removed``.

    Only lines with a word count; white space around a line is not compared. A
    text without repeats, an empty and a null one stay as they are. Rows that
    agree in ``doc_id`` and text are one document and stay alike.
    """
    gone = removed_lines(docs, edits, min_chars, folder)
    gone = gone.select(F.col("doc_id").alias("_doc"), F.col("version").alias("_version"), F.col("places").alias("_places"))
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.xxhash64("text") == F.col("_version"))
    rows = docs.join(gone, same, "left")
    kept = F.filter(F.split("text", "\n"), lambda line, place: ~F.array_contains("_places", place))
    text = F.when(F.col("_places").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    n_lines = F.size(F.filter(F.split("text", "\n"), lambda line: F.btrim(line, F.lit(SPACE)) != ""))
    others = [text.alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns]
    return rows.select(
        *others,
        F.coalesce(n_lines, F.lit(0)).cast("long").alias("_n_lines"),
        F.coalesce(F.size("_places"), F.lit(0)).cast("long").alias("_n_removed"),
    )


def recounted(rows: DataFrame, changed: Column) -> DataFrame:
    """``n_chars``, if it is there, counted anew where the text has changed."""
    if "n_chars" not in rows.columns:
        return rows
    kind = rows.schema["n_chars"].dataType
    return rows.withColumn("n_chars", F.when(changed, F.char_length("text").cast(kind)).otherwise(F.col("n_chars")))
