"""Merkle manifest, conversation repair and personal data against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
import string
import zlib
from collections import Counter, defaultdict
from functools import cache

import pytest

from tidemark.llm import merkle, pii, repair


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# --- Merkle manifest ------------------------------------------------------------------------

DOCS = "doc_id BIGINT, source STRING, lang STRING, n_chars BIGINT, text STRING, digest STRING, n INT, id STRING"


def plain_manifest(rows):
    def leaf(row, text):
        fields = [None if x is None else str(x) for x in (*row[:4], text)]
        return sha("".join("-" if x is None else f"{len(x.encode())}:{x}" for x in fields))

    def up(digests):
        levels = [digests]
        while len(levels[-1]) > 1:
            last = levels[-1]
            levels.append([sha("".join(last[i : i + 16])) for i in range(0, len(last), 16)])
        return levels

    def path(levels, at):
        for level in levels[:-1]:
            start = at // 16 * 16
            yield "".join(level[start:at]), "".join(level[at + 1 : start + 16])
            at //= 16

    sources = defaultdict(list)
    for row in rows:
        own = leaf(row, row[4])
        low = row[4] and "".join(c.lower() if c in string.ascii_uppercase else c for c in row[4])
        chosen = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
        sources[row[1]].append(((row[0] is not None, row[0] or 0, own), row, own, leaf(row, low) if chosen else own))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: up([x[2] for x in sorted(sources[s], key=lambda x: x[0])]) for s in names}
    top = up([trees[s][-1][0] for s in names])
    out = []
    for place, s in enumerate(names):
        for at, (_, row, own, forged) in enumerate(sorted(sources[s], key=lambda x: x[0])):
            siblings = [*path(trees[s], at), *path(top, place)]
            node = forged
            for left, right in siblings:
                node = sha(left + node + right)
            root = top[-1][0]
            proof = sha("".join(left + right for left, right in siblings))
            out.append((row[0], own, trees[s][-1][0], root, proof, node, node == root, s, at))
    return Counter(out)


def manifest_of(spark, rows):
    docs = spark.createDataFrame([(*row, "x", 1, "y") for row in rows], DOCS).repartition(3)
    return Counter(map(tuple, merkle.manifest(docs).collect()))


def test_manifest_of_nothing(spark):
    assert not manifest_of(spark, [])


@pytest.mark.parametrize("seed", [1, 2])
def test_manifest(spark, seed):
    rnd = random.Random(seed)
    rows = [(i, f"s{rnd.choice('abcé')}", "en", 5, rnd.choice(["Same", "AbÉ", None, "", "x" * 5000]) or f"Text {i}") for i in range(300)]
    rows += [(rnd.choice([-5, -(2**63), 2**63 - 1, 10**15, 64, 63, 0]), "big", None, None, f"T{i % 4}") for i in range(40)]
    rows += [(None, rnd.choice([None, "sa"]), None, 1, f"N{i % 3}") for i in range(40)]
    rows += [(7, "one", "de", 2, None), (9, "", "", 0, "Lone")]
    assert manifest_of(spark, rows) == plain_manifest(rows)


def test_manifest_of_one_row(spark):
    assert manifest_of(spark, [(5, None, None, None, None)]) == plain_manifest([(5, None, None, None, None)])


def test_manifest_of_many_rows_with_one_id(spark):
    rows = [(3, "a", "en", 1, f"T{i % 90}") for i in range(600)] + [(i, "a", "en", 1, "Z") for i in range(300)]
    assert manifest_of(spark, rows) == plain_manifest(rows)


def test_manifest_of_many_sources(spark):
    rows = [(i, f"{i % 40}", "en", 1, "A") for i in range(100)]
    assert manifest_of(spark, rows) == plain_manifest(rows)


# --- conversation repair ----------------------------------------------------------------------

TURNS = "conv_id BIGINT, turn BIGINT, role STRING, text STRING, key STRING, id INT"


def plain_damage(rows):
    for conv, turn, role, text in rows:
        conv_name, turn_name = (" " if x is None else str(x) for x in (conv, turn))
        kind = zlib.crc32(f"{conv_name}:{turn_name}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            yield from [(conv, turn, "user" if kind == 4 else role, text)] * (1 + (kind == 3))


def plain_audit(rows):
    """Every way to edit, rest by rest: the cheapest, then least one by whole strings."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
    counts, seen, faults = Counter(), set(), []
    for _, _, role, text in rows:
        words = text.strip(" \t\n\x0b\f\r")
        fault = "blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else ""
        seen.add((role, text))
        counts[fault] += 1
        faults.append(fault)

    @cache
    def best(at, state, inserted):
        options = [(0, "", ())] if at == len(rows) and state in "0A" else []
        after = {"0": "U", "S": "U", "A": "U", "U": "A"}[state]
        name = "user" if after == "U" else "assistant"

        def add(cost, letter, line, rest):
            if rest:
                options.append((cost + rest[0], letter + rest[1], (line, *rest[2]) if line is not None else rest[2]))

        if inserted < 2:
            add(5, "I", f"{name}:", best(at, after, inserted + 1))
        if at < len(rows):
            _, _, role, text = rows[at]
            add(2, "D", None, best(at + 1, state, 0))
            if faults[at] not in ("blank", "duplicate"):
                extra = 5 if faults[at] else 0
                add(1 + extra, "R", f"{name}:{text}", best(at + 1, after, 0))
                if role[:1] == after.lower():
                    add(extra, "K", f"{role}:{text}", best(at + 1, after, 0))
                if role[:1] == "s" and state == "0":
                    add(extra, "K", f"{role}:{text}", best(at + 1, "S", 0))
        return min(options) if options else None

    for at in range(len(rows), 0, -1):
        for state in "0SUA":
            best(at, state, 0)
    cost, audit, lines = best(0, "0", 0)
    turns = {r[1] for r in rows if r[1] is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, sha("\n".join(lines))), lines


def random_turns(rnd, convs):
    texts = ["Yes.", "No!", "what", "", " \n", None, "Fine?\n", "é.", "a.b", "one", "two.", "three."]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "User"]
    rows = []
    for conv in convs:
        size = rnd.choice([1, 2, 3, 8, 20])
        regular = rnd.random() < 0.5
        for turn in range(size):
            role = ("user", "assistant")[turn % 2] if regular and rnd.random() < 0.9 else rnd.choice(roles)
            text = rnd.choice(texts) if rnd.random() < 0.4 else f"Say {turn}."
            rows.append((conv, rnd.choice([turn, turn, turn, turn // 2, None, turn * 3]), role, text))
    return rows


def by_conversation(rows):
    out = defaultdict(list)
    for row in rows:
        out[row[0]].append(row)
    return out


def check_audits(spark, rows, damage=True):
    turns = spark.createDataFrame([(*r, "k", 1) for r in rows], TURNS).repartition(3)
    got = repair.audits(repair.damaged(turns) if damage else turns)
    left = by_conversation(plain_damage(rows) if damage else rows)
    want = Counter((conv, *plain_audit(left[conv])[0]) for conv in by_conversation(rows))
    assert Counter(map(tuple, got.collect())) == want


def test_repair(spark):
    rnd = random.Random(5)
    check_audits(spark, random_turns(rnd, [*range(150), None, -3]))


def test_repair_of_nothing(spark):
    check_audits(spark, [])


def test_repair_of_rows_that_all_go(spark):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    check_audits(spark, [(gone, 0, "user", "Yes."), (gone, 0, "assistant", "No.")])


def test_repair_of_a_long_conversation(spark):
    rnd = random.Random(6)
    rows = [(1, i, rnd.choice(["user", "assistant"]), f"{i}." * rnd.randrange(1, 300)) for i in range(700)]
    rows += [(2, i, "user", f"{i}.") for i in range(301)] + [(3, None, "user", f"{i}") for i in range(100)]
    check_audits(spark, rows + [(4, 0, "user", "x" * 200_000), (4, 1, "assistant", "y" * 200_000 + ".")], damage=False)


def test_repaired_turns(spark):
    rows = [r for r in random_turns(random.Random(7), range(60)) if r[2] is not None and r[3] is not None]
    turns = spark.createDataFrame([(*r, "k", 1) for r in rows], TURNS)
    got = defaultdict(list)
    for conv, place, role, text in sorted(repair.repaired_turns(turns).collect()):
        assert place == len(got[conv])
        got[conv].append(f"{role}:{text}")
    for conv, own in by_conversation(rows).items():
        assert got[conv] == list(plain_audit(own)[1])
        assert re.fullmatch("(s?(ua)+)?", "".join(line[0] for line in got[conv]))


def test_sure_edits_are_emitted_and_memory_stays_small():
    one, given, most = repair.Repair(), 0, 0
    for i in range(5000):
        given += sum(1 for _ in one.feed(("user", "assistant", "user")[i % 3], f"{i}.", False, i % 7 == 0))
        most = max(most, i + 1 - given)
    assert most < 200
    assert given + sum(1 for _ in one.finish()) >= 5000


# --- personal data ----------------------------------------------------------------------------

STRICT = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_strict(text):
    spans = []
    for order, (kind, pattern) in enumerate(STRICT.items()):
        for m in re.finditer(pattern, text or ""):
            numbers = [int(c) for c in m[0] if c in string.digits]
            luhn = sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(reversed(numbers))) % 10 == 0
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 14 <= len(numbers) <= 19 and luhn,
                "phone": 10 <= len(numbers) <= 15,
            }[kind]
            if good:
                spans.append((m.start(), order, m.end()))
    return sorted(spans)


def listing(spans):
    return ",".join(f"{pii.KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


def plain_row(doc_id, text):
    spans = plain_strict(text)
    return (doc_id, *[sum(s[1] == k for s in spans) for k in range(4)], sha(listing(spans)))


def data_of(spark, rows):
    docs = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], "doc_id BIGINT, text STRING, id STRING, kind INT, base STRING")
    return pii.personal_data(docs.repartition(3)).collect()


def test_strict_forms(spark):
    rnd = random.Random(9)
    bits = [
        "a.b@c.de", "x@y", "@", "a@b.c_d@e.f", "a@b.c@d.e", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "001.002.3.0000255", "4539 1488 0343 6467",
        "4539148803436467", "45391488034364678", "0000 0000 0000 00", "+1 (017) 555-7713", "+1-", "+49 30 1234567.", "++1 2345678901", " ", " ", "é", "😀",
        "\n", "mail:", "-", "7", ".", "+", "12-34 56", "(", "%", "a" * 50,
    ]
    rows = [(i, "".join(rnd.choice(bits) for _ in range(rnd.randrange(25)))) for i in range(400)]
    rows += [(None, None), (1, ""), (1, "a@b.cd"), (1, "a@b.cd"), (2, "+1 (017) 555-7713 " * 700), (3, "9" * 60_000), (4, "a" * 60_000 + "@b.c")]
    got = data_of(spark, rows)
    assert Counter(tuple(r)[:6] for r in got) == Counter(plain_row(*r) for r in rows)
    for row in got:
        spans = row["spans"].split(",") if row["spans"] else []
        assert len(spans) >= sum(row[f"n_{k}"] for k in pii.KINDS)


def test_nothing(spark):
    assert data_of(spark, []) == []


LOOSE = {0: r"[A-Za-z0-9._%+-]+(?:@|\[at\])[A-Za-z0-9-]+(?:(?:\.|\[dot\])[A-Za-z0-9-]+)*", 2: None, 3: None}


def plain_discovery(texts):
    """Bootstrapping by loops, over numbers and ``[at]`` addresses only."""
    base = [plain_strict(t) for t in texts]

    def value(kind, text):
        return text.replace("[at]", "@").replace("[dot]", ".") if kind == 0 else re.sub("[^0-9]", "", text)

    loose = []
    for text, own in zip(texts, base, strict=True):
        found = [(m.start(), 0, m.end()) for m in re.finditer(LOOSE[0], text)]
        for m in re.finditer(r"[0-9](?:[\x20()./-]{0,2}[0-9])+", text):
            size = sum(c in string.digits for c in m[0])
            found += [(m.start(), kind, m.end()) for kind, low, high in ((2, 12, 19), (3, 7, 15)) if low <= size <= high]
        loose.append([s for s in found if not any(b[0] < s[2] and s[0] < b[2] for b in own)])
    edges, ends = Counter(), {0: STRICT["email"], 1: STRICT["ip"], 2: STRICT["card"], 3: STRICT["phone"]}
    for text, own, other in zip(texts, base, loose, strict=True):
        for seed, spans in ((True, own), (False, other)):
            for start, kind, end in spans:
                pattern = ends[kind] if seed else LOOSE[kind] or r"[0-9](?:[\x20()./-]{0,2}[0-9])+"
                last = max((m.end() for m in re.finditer(pattern, text) if m.end() <= start), default=0)
                words = text[last:start].lower().split()
                for n in (1, 2):
                    if len(words) >= n:
                        edges[kind, tuple(words[-n:]), value(kind, text[start:end].lower()), seed] += 1
    corpus = Counter()
    for text in texts:
        words = text.lower().split()
        for n in (1, 2):
            corpus.update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    totals, values = Counter(), defaultdict(set)
    for (kind, context, val, _), n in edges.items():
        totals[kind, context] += n
        values[kind, context].add(val)
    seeds = {(k, value(k, t[s:e].lower())) for t, own in zip(texts, base, strict=True) for s, k, e in own}
    trust = dict.fromkeys(seeds, 1.0)
    for _ in range(pii.ROUNDS):
        score, support = Counter(), defaultdict(set)
        for (kind, context, val, _), n in edges.items():
            score[kind, context] += n * trust.get((kind, val), 0) / max(totals[kind, context], corpus[context])
            if trust.get((kind, val), 0) >= pii.CONFIDENCE:
                support[kind, context].add(val)
        good = {p: s for p, s in score.items() if s >= pii.CONFIDENCE and len(support[p]) >= pii.SUPPORT}
        trust = dict.fromkeys(seeds, 1.0)
        for kind, context, val, _ in edges:
            if (kind, context) in good:
                trust[kind, val] = max(trust.get((kind, val), 0), good[kind, context])
    out = []
    for text, own, other in zip(texts, base, loose, strict=True):
        chosen = {}
        for start, kind, end in other:
            sure = trust.get((kind, value(kind, text[start:end].lower())), 0)
            if sure >= pii.CONFIDENCE:
                chosen[start, end] = max(chosen.get((start, end), (0, -9)), (sure, -kind))
        out.append(listing(own + [(s, -k, e) for (s, e), (_, k) in chosen.items()]))
    return out


def contact_texts():
    texts = [f"Please call us: +1 (20{i}) 555-01{i}7 today, or mail to: sam{i}@shop{i}.example.com now." for i in range(8)]
    texts += ["Please call us: 555-0199 34 today", "mail to: bob[at]corner[dot]example now", "again 5550 19934 was seen", "order 88123456 is here."]
    texts += ["code 4539 1488 0343 6468 and more", "call +1 (201) 555-0117", "ring 1 201 555 0117 at noon", "the the the", "12345678"]
    texts += [f"ring {i}201 777 011{i} at noon, ring +1 301 777 011{i} soon, ring +1 401 777 011{i}" for i in range(4)]
    return texts


def test_contexts_find_new_values(spark):
    texts = contact_texts()
    got = {r["doc_id"]: r["spans"] for r in data_of(spark, list(enumerate(texts)))}
    assert [got[i] for i in range(len(texts))] == plain_discovery(texts)
    assert got[8] == "phone:16:27" and got[9].startswith("email:9:") and got[10].startswith("phone:")
    assert got[11] == got[12] == got[16] == "" and got[14].startswith("phone:")


def test_copies_are_no_support(spark):
    texts = ["write here: ann@one.example please"] * 20 + ["write here: joe[at]two[dot]example please"]
    got = data_of(spark, list(enumerate(texts)))
    assert {r["spans"] for r in got if r["doc_id"] == 20} == {""}
