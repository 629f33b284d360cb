"""Expressions that build the text of definition files."""

from __future__ import annotations

from collections.abc import Sequence

# Binary unit names in ascending order, one per power of 1024.
BYTE_UNITS = ("B", "KiB", "MiB", "GiB", "TiB", "PiB")

# The JSON two-character escapes (RFC 8259), backslash first so
# that the backslashes added by the later ones are not escaped again.
JSON_SHORT_ESCAPES = (
    ("\\", "\\\\"),
    ('"', '\\"'),
    ("\b", "\\b"),
    ("\f", "\\f"),
    ("\n", "\\n"),
    ("\r", "\\r"),
    ("\t", "\\t"),
)


def literal(value: str) -> str:
    """A string as SQL literal; ``$`` is escaped, as Spark substitutes ``${name}``."""
    plain = value.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n")
    plain = plain.replace("\r", "\\r").replace("\t", "\\t").replace("\b", "\\b")
    return "'" + plain.replace("\f", "\\u000c").replace("$", "\\u0024") + "'"


def concat(*parts: str) -> str:
    return f"concat({', '.join(parts)})"


def humanize_bytes(n: str) -> str:
    """Byte count as text with a binary unit and one decimal.

    Null gives ``''``; counts below 1024, negative ones included, stay whole
    bytes. The unit is picked before rounding (1048575 is ``1024.0 KiB``) and
    ties round to even, which is what ``format_number`` with a pattern does.
    """
    size = f"CAST({n} AS DOUBLE)"
    powers = range(1, len(BYTE_UNITS) - 1)
    below = [f"WHEN {size} < {float(1024 ** (p + 1))}D THEN " for p in powers]
    divisors = "".join(f"{b}{float(1024**p)}D " for b, p in zip(below, powers))
    units = "".join(f"{b}' {BYTE_UNITS[p]}' " for b, p in zip(below, powers))
    divisor = f"CASE {divisors}ELSE {float(1024 ** (len(BYTE_UNITS) - 1))}D END"
    unit = f"CASE {units}ELSE ' {BYTE_UNITS[-1]}' END"
    return f"""CASE WHEN {n} IS NULL THEN ''
        WHEN {size} < 1024.0D THEN concat(CAST({n} AS STRING), ' {BYTE_UNITS[0]}')
        ELSE concat(format_number({size} / {divisor}, '0.0'), {unit}) END"""


# Java character classes: printable ASCII that JSON takes as it is, the
# characters with a short escape, and the rest.
PLAIN = r" !#-\[\]-~"
SHORT = r"\"\\\x08\x09\x0a\x0c\x0d"


def json_quote(s: str) -> str:
    """JSON string literal in pure ASCII; everything else becomes ``\\uXXXX``.

    Plain text is only wrapped in quotes. Otherwise the text is cut into runs
    of the three character classes, so the work grows with the number of runs
    and not with the number of characters.
    """
    short = "run"
    for char, replacement in JSON_SHORT_ESCAPES:
        short = f"replace({short}, {literal(char)}, {literal(replacement)})"
    units = "lower(hex(encode(run, 'UTF-16BE')))"
    escaped = f"""CASE
        WHEN ascii(run) IN ({', '.join(str(ord(char)) for char, _ in JSON_SHORT_ESCAPES)})
        THEN {short}
        WHEN ascii(run) BETWEEN 32 AND 126 THEN run
        ELSE regexp_replace({units}, '(.{{4}})', r'\\\\u$1') END"""
    runs = f"regexp_extract_all({s}, r'[{PLAIN}]+|[{SHORT}]+|[^ -~{SHORT}]+', 0)"
    return f"""concat('"', CASE WHEN {s} RLIKE r'^[{PLAIN}]*\\z' THEN {s}
        ELSE array_join(transform({runs}, run -> {escaped}), '') END, '"')"""


def iso_utc(ts: str) -> str:
    """ISO-8601 text of an instant in UTC, with six fraction digits only if needed.

    Goes through a zone-free timestamp, so the session time zone has no say.
    The cast to text drops trailing zeros of the fraction: they are filled up.
    """
    wall = f"timestampadd(MICROSECOND, unix_micros({ts}), TIMESTAMP_NTZ'1970-01-01 00:00:00')"
    length = f"if(unix_micros({ts}) % 1000000 = 0, 19, 26)"
    return f"concat(replace(rpad(CAST({wall} AS STRING), {length}, '0'), ' ', 'T'), '+00:00')"


def inline_list(items: str) -> str:
    """``[a, b]``."""
    return f"concat('[', array_join({items}, ', '), ']')"


# --- lines: every piece below ends its lines with a newline, and a text is the plain
# --- concatenation of its pieces, which Spark compiles without building arrays


def or_none(value: str) -> str:
    """Text of a value inside a line; an absent one prints as ``None``.

    A null would make the whole text null.
    """
    return f"coalesce(CAST({value} AS STRING), 'None')"


def line(*parts: str) -> str:
    return concat(*parts, literal("\n"))


def labelled(label: str, value: str) -> str:
    """Line ``label: value``."""
    return line(literal(f"{label}: "), or_none(value))


def optional(piece: str, condition: str) -> str:
    """The piece if the condition holds, else nothing."""
    return f"CASE WHEN {condition} THEN {piece} ELSE '' END"


def each(items: str, item: str, piece: str) -> str:
    """The piece for every element of an array, ``item`` standing for the element."""
    return f"coalesce(array_join(transform({items}, {item} -> {piece}), ''), '')"


def schema_lines(schema: str) -> str:
    """``schema:`` and one line per top-level column."""
    field = line(
        "'  - name: '",
        or_none("field.name"),
        "'  type: '",
        or_none("field.type"),
        "'  mode: '",
        or_none("field.mode"),
        "'  description: '",
        json_quote("coalesce(field.description, '')"),
    )
    return concat(line("'schema:'"), each(schema, "field", field))


def argument_lines(arguments: str) -> str:
    """``arguments:`` and one line per routine argument; nothing if there are none."""
    argument = line(
        "'  - name: '",
        or_none("arg.name"),
        "'  type: '",
        or_none("arg.type"),
        "'  mode: '",
        or_none("arg.mode"),
    )
    lines = concat(line("'arguments:'"), each(arguments, "arg", argument))
    return optional(lines, f"size({arguments}) > 0")


def uri_lines(uris: str) -> str:
    """``source_uris:`` and one indented line per URI."""
    return concat(line("'source_uris:'"), each(uris, "uri", line("'  - '", or_none("uri"))))


def sql_header(labels: Sequence[tuple[str, str]]) -> str:
    """Comment lines ``-- Label: value`` and a blank line."""
    lines = [line(literal(f"-- {label}: "), or_none(value)) for label, value in labels]
    return concat(*lines, literal("\n"))
