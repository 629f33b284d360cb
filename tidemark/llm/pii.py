"""Personal data by bootstrapping: known forms teach contexts, good contexts teach new values.

Values of four strict forms (e-mail, IP, card, phone) are seeds. The one and the
two words ahead of a value are its lexical patterns. Looser forms of the same four
kinds are candidates: obfuscated addresses, numbers without a plus sign or with a
wrong check digit, IPv6. Patterns and values form a graph whose edges are
occurrences. In rounds, a pattern is worth the share of all its occurrences in
the corpus that a trusted value follows, and a value gets the trust of its best
patterns. Values that reach the threshold are personal data wherever they stand.

Everything is expressions, joins and aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, ascii_lower, fresh_folder, stored
from tidemark.operators.pick import lookup

KINDS = ("email", "ip", "card", "phone")
# Fixed by the task, written with possessive groups, which match the same and need no stack: an e-mail starts
# where no character of its own precedes, or where the last match ended; an IP starts with a whole number.
STRICT = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
CARD_DIGITS, PHONE_DIGITS, IP_PART = (14, 19), (10, 15), 255
# Looser forms that a good context makes personal data.
AT = r"(?:@|\x20?[\[({]\x20?(?:at|AT|@)\x20?[\])}]\x20?)"
DOT = r"(?:\.|\x20?[\[({]\x20?(?:dot|DOT|\.)\x20?[\])}]\x20?)"
LOOSE = {
    "email": rf"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++{AT}[A-Za-z0-9-]++(?:{DOT}[A-Za-z0-9-]++)*+",
    "ip": rf"(?:(?<![0-9A-Fa-f:.])|\G)(?:[0-9A-Fa-f]{{1,4}}+(?::[0-9A-Fa-f]{{0,4}}+){{3,7}}+|[0-9]++(?:{DOT}[0-9]++){{3}}+)",
    "number": r"[0-9](?:[\x20()./-]{0,2}+[0-9])++",
}
# Digits of a number that a context may call a card or a phone.
LOOSE_DIGITS = {"card": (12, 19), "phone": (7, 15)}
# A pattern needs so many different trusted values, this share of its occurrences, and so many rounds are made.
SUPPORT, CONFIDENCE, ROUNDS = 3, 0.5, 3
# Of the text ahead of a value so many characters are looked at for words.
LEFT_CHARS = 80
BLOCK = 256
# So many contexts (8 bytes each) are sent to all executors, more are joined by a shuffle.
BROADCAST_ROWS = 1 << 20


def literal(pattern: str) -> str:
    return "r'" + pattern + "'"


def ahead_of(items: str, step: str) -> str:
    """SQL: for each element what ``step`` (of ``s`` and ``x``) makes of those ahead, from 0.

    Done in blocks, so that no long array is copied for each of its elements.
    """

    def plain(a: str) -> str:
        return f"aggregate({a}, array(0L), (s, x) -> array_append(s, {let('s', 'element_at(s, -1)', step)}))"

    blocks = f"transform(sequence(0, cast((size(v) - 1) div {BLOCK} as int)), c -> slice(v, c * {BLOCK} + 1, {BLOCK}))"
    starts = plain(f"transform(b, p -> aggregate(p, 0L, (s, x) -> {step}))")
    inside = f"transform(slice({plain('p')}, 1, size(p)), x -> {step})"
    joined = f"flatten(zip_with(b, slice(t, 1, size(b)), (p, s) -> {inside}))"
    return let("v", items, let("b", blocks, let("t", starts, joined)))


def let(name: str, value: str, body: str) -> str:
    """SQL: ``body`` with ``name`` bound to ``value``, which is computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def matches(text: str, pattern: str) -> str:
    """SQL: array of ``at, value, ahead`` for the leftmost, non-overlapping matches of a pattern.

    ``at`` counts code points; ``ahead`` is the end of the text since the match before.
    """
    lengths = "transform(h, (x, i) -> cast(char_length(p[i]) + char_length(x) as bigint))"
    place = "cast(s[i] + char_length(p[i]) as bigint)"
    one = f"named_struct('at', {place}, 'value', x, 'ahead', right(p[i], {LEFT_CHARS}))"
    found = let("p", f"split({text}, {literal(pattern)}, -1)", let("s", ahead_of(lengths, "s + x"), f"transform(h, (x, i) -> {one})"))
    empty = "cast(array() as array<struct<at: bigint, value: string, ahead: string>>)"
    return let("h", f"regexp_extract_all({text}, {literal(pattern)}, 0)", f"CASE WHEN size(h) = 0 THEN {empty} ELSE {found} END")


def digits(value: str) -> str:
    return f"translate({value}, translate({value}, '0123456789', ''), '')"


def between(value: str, limits: tuple[int, int]) -> str:
    return f"(length({digits(value)}) BETWEEN {limits[0]} AND {limits[1]})"


def luhn(number: str) -> str:
    """SQL: every second digit from the right counts twice, the sum of all is a multiple of ten."""
    doubled = "if(d > 4, 2 * d - 9, 2 * d)"
    step = f"(s, c) -> named_struct('sum', s.sum + {let('d', 'cast(c as int)', f'if(s.twice, {doubled}, d)')}, 'twice', NOT s.twice)"
    return f"aggregate(split(reverse({number}), ''), named_struct('sum', 0, 'twice', false), {step}).sum % 10 = 0"


def holds(kind: str, value: str) -> str:
    """SQL: what has to be true of a match of the strict form."""
    if kind == "ip":
        part = "ltrim('0', p)"
        return f"forall(split({value}, '[.]'), p -> length({part}) <= 3 AND cast('0' || {part} as int) <= {IP_PART})"
    if kind == "card":
        return f"if({between(value, CARD_DIGITS)}, {luhn(digits(value))}, false)"
    if kind == "phone":
        return between(value, PHONE_DIGITS)
    return "true"


def normal(kind: str, value: str) -> str:
    """SQL: the value that different spellings share."""
    if kind == "email":
        return f"regexp_replace(regexp_replace(lower({value}), {literal(AT)}, '@'), {literal(DOT)}, '.')"
    if kind == "ip":
        return f"regexp_replace(lower({value}), {literal(DOT)}, '.')"
    return digits(value)


def left_words(ahead: str) -> str:
    """SQL: the last two words, lower-cased; null where there are fewer."""
    words = f"regexp_extract_all({ahead}, {literal(WORD)}, 0)"
    return let("w", words, "array(try_element_at(w, -2), try_element_at(w, -1))")


def strict_spans(text: str) -> str:
    """SQL: array of ``kind, at, end, value, ahead`` for the strict forms."""
    every = []
    for kind in KINDS:
        trigger = {"email": "'%@%'", "phone": "'%+%'"}.get(kind)
        found = f"filter({matches(text, STRICT[kind])}, m -> {holds(kind, 'm.value')})"
        found = f"transform({found}, m -> {span(kind, 'm')})"
        every.append(f"CASE WHEN {text} LIKE {trigger} THEN {found} ELSE {NO_SPANS} END" if trigger else found)
    return f"concat({', '.join(every)})"


NO_SPANS = "cast(array() as array<struct<at: bigint, kind: int, end: bigint, value: string, ahead: string>>)"


def span(kind: str, m: str) -> str:
    return (
        f"named_struct('at', {m}.at, 'kind', {KINDS.index(kind)}, 'end', {m}.at + char_length({m}.value),"
        f" 'value', {normal(kind, f'{m}.value')}, 'ahead', {m}.ahead)"
    )


def loose_spans(text: str) -> str:
    """SQL: the same for the looser forms; a number may be offered as a card and as a phone."""
    every = []
    for form, pattern in LOOSE.items():
        found = matches(text, pattern)
        for kind in LOOSE_DIGITS if form == "number" else [form]:
            kept = f"filter({found}, m -> {between('m.value', LOOSE_DIGITS[kind])})" if form == "number" else found
            kept = f"transform({kept}, m -> {span(kind, 'm')})"
            if form == "email":
                kept = f"CASE WHEN {text} RLIKE {literal('@|[({\\[] ?(?:at|AT)')} THEN {kept} ELSE {NO_SPANS} END"
            every.append(kept)
    return f"concat({', '.join(every)})"


def apart(loose: str, base: str) -> str:
    """SQL: the loose spans that touch no strict one.

    All are sorted, strict ones by start, loose ones by end; one touches if a
    strict one ahead of it ends behind its start.
    """
    none = "cast(null as struct<at: bigint, kind: int, end: bigint, value: string, ahead: string>)"
    strict = f"transform({base}, x -> named_struct('place', x.at, 'strict', 1, 'far', x.end, 'span', {none}))"
    other = f"transform({loose}, x -> named_struct('place', x.end, 'strict', 0, 'far', 0L, 'span', x))"
    reach = ahead_of("transform(g, x -> x.far)", "greatest(s, x)")
    free = "filter(g, (x, i) -> x.strict = 0 AND r[i] <= x.span.at)"
    return let("g", f"array_sort(concat({strict}, {other}))", let("r", reach, f"transform({free}, x -> x.span)"))


def found_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, id, base, more``: strict spans, sorted, and candidates that touch none, per row."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.monotonically_increasing_id().alias("id"))
    rows = rows.withColumn("base", F.expr(strict_spans("text"))).withColumn("loose", F.expr(loose_spans("text")))
    more = F.expr(f"CASE WHEN size(base) = 0 OR size(loose) = 0 THEN loose ELSE {apart('loose', 'base')} END")
    return rows.select("doc_id", "id", F.array_sort("base").alias("base"), more.alias("more"))


def occurrences(found: DataFrame) -> DataFrame:
    """``kind, value, seed, context, n``: edges of the graph, pre-aggregated over all documents."""
    seeds = found.select(F.explode("base").alias("s"), F.lit(True).alias("seed"))
    rows = seeds.unionByName(found.select(F.explode("more").alias("s"), F.lit(False).alias("seed")))
    rows = rows.select("s.kind", "s.value", "seed", F.expr(left_words("s.ahead")).alias("w"))
    rows = rows.select("kind", "value", "seed", F.explode(hashes("w")).alias("context")).where("context IS NOT NULL")
    return rows.groupBy("kind", "context", "value", "seed").agg(F.count("*").alias("n"))


def hashes(words: str) -> Column:
    low = [ascii_lower(F.element_at(words, k)) for k in (1, 2)]
    one = F.when(low[1].isNotNull(), F.xxhash64(low[1]))
    return F.array(one, F.when(low[0].isNotNull() & low[1].isNotNull(), F.xxhash64(*low)))


def context_counts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """How often each of the wanted contexts, one or two words, occurs in all texts, whatever follows."""
    rows = docs.select(F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(WORD), F.lit(0)).alias("w")).where("size(w) > 0")
    pairs = "zip_with(slice(w, 1, size(w) - 1), slice(w, 2, size(w)), (a, b) -> xxhash64(a, b))"
    rows = rows.select(F.explode(F.expr(f"concat(transform(w, x -> xxhash64(x)), {pairs})")).alias("context"))
    if wanted.count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(wanted), "context").groupBy("context").agg(F.count("*").alias("seen"))
    return rows.groupBy("context").agg(F.count("*").alias("seen")).join(wanted, "context")


def discovered(docs: DataFrame, found: DataFrame, folder: str) -> DataFrame:
    """``instance`` (kind, value) and ``trust``: the seeds, and values that trusted patterns lead to."""
    edges = stored(occurrences(found), folder, "edges")
    # A context of too few different values can never count.
    spread = edges.groupBy("kind", "context").agg(F.count_distinct("value").alias("values"), F.sum("n").alias("n"))
    spread = stored(spread.where(F.col("values") >= SUPPORT), folder, "contexts")
    wanted = stored(spread.select("context").distinct(), folder, "wanted")
    seen = stored(context_counts(docs, wanted), folder, "seen")
    patterns = lookup(spread, seen, "context").select(
        F.struct("kind", "context").alias("pattern"), F.greatest("n", F.coalesce("seen", F.lit(0))).alias("seen")
    )
    patterns = stored(patterns, folder, "patterns")
    edges = edges.select(F.struct("kind", "context").alias("pattern"), F.struct("kind", "value").alias("instance"), "seed", "n")
    edges = stored(lookup(edges, patterns, "pattern", "inner"), folder, "graph")
    trust = edges.where("seed").select("instance", F.lit(1.0).alias("trust")).distinct()
    for turn in range(ROUNDS):
        judged = lookup(edges, trust, "instance").withColumn("trust", F.coalesce("trust", F.lit(0.0)))
        scores = judged.groupBy("pattern").agg(
            (F.sum(F.col("n") * F.col("trust")) / F.max("seen")).alias("score"),
            F.count_distinct(F.when(F.col("trust") >= CONFIDENCE, F.col("instance"))).alias("support"),
        )
        good = scores.where((F.col("support") >= SUPPORT) & (F.col("score") >= CONFIDENCE)).select("pattern", "score")
        good = stored(good, folder, f"good-{turn}")
        values = lookup(edges.select("pattern", "instance", "seed"), good, "pattern", "inner").groupBy("instance")
        values = values.agg(F.max(F.col("seed").cast("int")).alias("seed"), F.max("score").alias("score"))
        learnt = values.select("instance", F.when(F.col("seed") == 1, 1.0).otherwise(F.col("score")).alias("trust"))
        seeds = edges.where("seed").select("instance", F.lit(1.0).alias("trust"))
        trust = learnt.unionByName(seeds).groupBy("instance").agg(F.max("trust").alias("trust"))
        trust = stored(trust, folder, f"trust-{turn}")
    # A value that has the strict form somewhere is known wherever it has another one.
    seeds = found.select(F.explode("base").alias("s")).select(F.struct("s.kind", "s.value").alias("instance"), F.lit(1.0).alias("trust"))
    return trust.unionByName(seeds).groupBy("instance").agg(F.max("trust").alias("trust")).where(F.col("trust") >= CONFIDENCE)


def listed(spans: str) -> str:
    """SQL: ``kind:start:end`` of sorted spans, comma-joined."""
    names = ", ".join(f"'{k}'" for k in KINDS)
    return f"array_join(transform({spans}, x -> concat_ws(':', array({names})[x.kind], x.at, x.end)), ',')"


def personal_data(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans`` for every row of ``docs`` (``doc_id``, ``text``).

    The counts and the digest are of the strict forms; ``spans`` has these and
    the discovered ones. Of a value that is trusted as several kinds a place
    counts as the most trusted one, and no discovered place touches a strict
    one. A null or empty text has no spans. Repeated rows count as often as they are
    there, but support a pattern by different values only. Other columns are
    ignored. Contexts are known by 64-bit hashes.
    """
    folder = folder or fresh_folder(docs.sparkSession)
    found = stored(found_spans(docs), folder, "found")
    trust = discovered(docs, found, folder)
    open_spans = found.where("size(more) > 0").select("id", F.explode("more").alias("s"))
    open_spans = open_spans.select("id", "s.at", "s.kind", "s.end", F.struct("s.kind", "s.value").alias("instance"))
    hits = lookup(open_spans, trust, "instance", "inner")
    best = hits.groupBy("id", "at", "end").agg(F.max_by("kind", F.struct("trust", -F.col("kind"))).alias("kind"))
    added = best.groupBy("id").agg(F.collect_list(F.struct("at", "kind", "end")).alias("added"))
    plain = F.expr("transform(base, x -> named_struct('at', x.at, 'kind', x.kind, 'end', x.end))")
    rows = found.select("doc_id", "id", plain.alias("base"))
    rows = rows.join(added, "id", "left")
    spans = F.when(F.col("added").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "added")))
    counts = [F.expr(f"cast(size(filter(base, x -> x.kind = {k})) as bigint)").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    rows = rows.select("doc_id", "base", spans.alias("every"), *counts)
    return rows.select(
        "doc_id",
        *[f"n_{name}" for name in KINDS],
        F.sha2(F.expr(listed("base")), 256).alias("base_sha256"),
        F.expr(listed("every")).alias("spans"),
    )
