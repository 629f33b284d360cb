"""Quality rules, line first: bad lines go, then documents that lose too much text.

Every line with a word is judged by itself:

* punctuation: it has to end a sentence, and must not shout (``!!``, ``??``) after
  every fifth word;
* navigation: less than a fifth of its words are separators such as ``|``;
* boilerplate: a short line has no stock phrase, and no line has a symbol of
  ``#*$%&|<>`` for every tenth character.

Each document is one row and is judged alone, so the work is a map over rows
without any shuffle, in slices of Arrow columns.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import SPACE, pieces

# Fixed values of the rules.
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
MAX_LOST_PERCENT = 50
SYMBOLS = b"#*$%&|<>"
SENTENCE_ENDS = (".", "!", "?", "…", ":", ";", "。", "！", "？")
CLOSERS = "\"')]»”’"
SEPARATORS = "|»>•·/→<–—-"
STOCK_WORDS = 30
STOCK_PHRASES = (
    b"all rights reserved",
    b"terms of service",
    b"terms of use",
    b"privacy policy",
    b"cookie policy",
    b"accept cookies",
    b"enable javascript",
    b"released under the",
    b"licensed under the",
    b"lorem ipsum",
    b"subscribe to our newsletter",
    b"click here",
    b"copyright (c)",
)

_SEPARATOR = re.compile(f"[{re.escape(SEPARATORS)}]+")
_ANY_SEPARATOR = re.compile(f"[{re.escape(SEPARATORS)}]")

FACTS = {
    "n_words": "BIGINT",
    "word_chars": "BIGINT",
    "n_symbols": "BIGINT",
    "n_dup_lines": "BIGINT",
    "n_repeat_words": "BIGINT",
    "n_bad_lines": "BIGINT",
    "lost_chars": "BIGINT",
    "base_failed": "BOOLEAN",
    "kept": "BOOLEAN",
}


def repeated_words(words: list[bytes]) -> int:
    """Words inside a 3-word window that the text has at least twice."""
    if len(words) < 4:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    pairs = ids[:-1] * len(seen) + ids[1:]
    if len(seen) > 1 << 20:  # three ids don't fit into 63 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * len(seen) + ids[2:]
    ordered = np.sort(windows)
    again = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(again):
        return 0
    at = again[np.minimum(np.searchsorted(again, windows), len(again) - 1)] == windows
    inside = np.zeros(len(words), bool)
    for shift in range(3):
        inside[shift : len(words) - 2 + shift] |= at
    return int(inside.sum())


def code_points(data: bytes) -> int:
    return len(data) if data.isascii() else len(data.decode())


def bad_line(line: str, data: bytes, words: list[bytes], symbols: bool, separators: bool, stock: bool) -> bool:
    """The three rules. The flags say whether the document has any such thing."""
    if not line.rstrip(SPACE).rstrip(CLOSERS).endswith(SENTENCE_ENDS):
        return True
    if 5 * (data.count(b"!!") + data.count(b"??")) >= len(words):
        return True
    if separators and 5 * sum(map(bool, (_SEPARATOR.fullmatch(w.decode()) for w in words))) >= len(words):
        return True
    if symbols and 10 * (len(data) - len(data.translate(None, SYMBOLS))) >= len(line):
        return True
    low = data.lower() if stock and len(words) <= STOCK_WORDS else b""
    return any(phrase in low for phrase in STOCK_PHRASES) if low else False


def judge(text: str | None) -> tuple[dict, list[str]]:
    """The facts of a text and the lines that it keeps. A null text is an empty one."""
    text = text or ""
    data = text.encode()
    words = data.split()
    word_chars = len(text) - (len(data) - len(data.translate(None, SPACE.encode())))
    n_symbols = len(data) - len(data.translate(None, SYMBOLS))
    low = data.lower()
    flags = n_symbols > 0, bool(_ANY_SEPARATOR.search(text)), any(phrase in low for phrase in STOCK_PHRASES)
    seen: set[str] = set()
    good: list[str] = []
    with_word = bad = lost = 0
    for line in text.split("\n"):
        raw = line.encode()
        own = raw.split()
        if not own:
            good.append(line)
            continue
        with_word += 1
        seen.add(line)
        if bad_line(line, raw, own, *flags):
            bad += 1
            lost += sum(map(code_points, own))
        else:
            good.append(line)
    repeated = repeated_words(words)
    base_failed = len(words) < MIN_WORDS or 100 * repeated > MAX_REPEATED_PERCENT * len(words)
    facts = {
        "n_words": len(words),
        "word_chars": word_chars,
        "n_symbols": n_symbols,
        "n_dup_lines": with_word - len(seen),
        "n_repeat_words": repeated,
        "n_bad_lines": bad,
        "lost_chars": lost,
        "base_failed": base_failed,
        "kept": not base_failed and 100 * lost <= MAX_LOST_PERCENT * word_chars,
    }
    return facts, good


def quality(docs: DataFrame) -> DataFrame:
    """``doc_id``, the facts and the verdict for every row of ``docs`` (``doc_id``, ``text``).

    ``base_failed``: fewer than 50 words, or over half of the words inside
    repeated 3-word windows. ``kept`` is false for those, and where the bad
    lines hold over half of the characters of all words. A null or empty text
    has no words. Repeated rows are judged alike; other columns are ignored.
    """
    rows = docs.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            facts = [judge(text.as_py())[0] for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array([f[name] for f in facts], _arrow(kind)) for name, kind in FACTS.items()]],
                ["doc_id", *FACTS],
            )

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, " + ", ".join(map(" ".join, FACTS.items())))


def _arrow(kind: str) -> pa.DataType:
    return pa.bool_() if kind == "BOOLEAN" else pa.int64()


def cleaned(docs: DataFrame) -> DataFrame:
    """The kept rows of ``docs`` with all their columns, ``text`` without its bad lines.

    ``n_chars``, if it is there, is counted anew; the others stay as they are.
    """
    at, size = docs.columns.index("text"), docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            judged = [judge(text.as_py()) for text in batch.column(at)]
            kept = [facts["kept"] for facts, _ in judged]
            texts = ["\n".join(good) for facts, good in judged if facts["kept"]]
            columns = batch.filter(pa.array(kept, pa.bool_())).columns
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            if size is not None:
                columns[size] = pa.array(map(len, texts), batch.schema.field(size).type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return docs.mapInArrow(run, docs.schema)
