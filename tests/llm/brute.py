"""Plain single-machine versions of operators, for small inputs."""

from __future__ import annotations

SPACE = " \t\n\x0b\f\r"


def close(a: str, b: str, edits: int) -> bool:
    """Whether the edit distance is at most ``edits``, by the textbook table near its diagonal."""
    if abs(len(a) - len(b)) > edits:
        return False
    far = edits + 1
    row = {j: j for j in range(min(len(b), edits) + 1)}
    for i, x in enumerate(a, 1):
        now = {}
        for j in range(max(0, i - edits), min(len(b), i + edits) + 1):
            steps = [row.get(j, far) + 1, now.get(j - 1, far) + 1]
            if j:
                steps.append(row.get(j - 1, far) + (x != b[j - 1]))
            now[j] = min(steps) if j else i
        if min(now.values()) > edits:
            return False
        row = now
    return row[len(b)] <= edits


def classes(nodes: list, linked) -> dict:
    """Smallest reachable node of each, comparing all pairs."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    ordered = sorted(set(nodes))
    for i, a in enumerate(ordered):
        for b in ordered[i + 1 :]:
            x, y = find(a), find(b)
            if x != y and linked(a, b):
                root[max(x, y)] = min(x, y)
    return {n: find(n) for n in ordered}


def dedup_lines(docs: list[tuple[int, str | None]], edits: int = 2, min_chars: int = 30) -> list[tuple]:
    """(doc_id, text, lines, removed) for each document; ids have to differ."""
    lines = {}
    for doc_id, text in docs:
        for place, line in enumerate((text or "").split("\n")):
            if line.strip(SPACE):
                lines[doc_id, place] = line.strip(SPACE)
    by_size: dict[int, list[str]] = {}
    for line in sorted(set(lines.values())):
        if len(line) >= min_chars:
            by_size.setdefault(len(line), []).append(line)
    root = {line: line for line in lines.values()}

    def find(line):
        while root[line] != line:
            line = root[line]
        return line

    for size, group in by_size.items():
        others = [x for s in range(size, size + edits + 1) for x in by_size.get(s, [])]
        for a in group:
            for b in others:
                if a < b or len(a) < len(b):
                    x, y = find(a), find(b)
                    if x != y and close(a, b, edits):
                        root[max(x, y)] = min(x, y)
    first: dict[str, tuple] = {}
    for at in sorted(lines):
        first.setdefault(find(lines[at]), at)
    out = []
    for doc_id, text in docs:
        own = [p for d, p in lines if d == doc_id]
        gone = {p for p in own if first[find(lines[doc_id, p])] != (doc_id, p)}
        if gone:
            text = "\n".join(x for p, x in enumerate(text.split("\n")) if p not in gone)
        out.append((doc_id, text, len(own), len(gone)))
    return out
