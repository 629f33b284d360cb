"""Line dedup, Jaccard join, mixing, archive, URL filter and chats on small inputs."""

from __future__ import annotations

import base64
import hashlib
import random
from collections import Counter

import brute
import pytest
from pyspark.sql import functions as F

from tidemark.llm import chat, line_dedup, mixing, ngram_join, url_filter, warc
from tidemark.llm.common import components

DOCS = "doc_id BIGINT, text STRING, source STRING, size STRING, node INT"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, s, "x", 7) for i, t, s in rows], DOCS).repartition(3)


def edited(rnd, text, edits):
    letters = list(text)
    for _ in range(edits):
        at = rnd.randrange(len(letters))
        rnd.choice([lambda: letters.insert(at, "q"), lambda: letters.pop(at), lambda: letters.__setitem__(at, "ü")])()
    return "".join(letters)


# --- components ---------------------------------------------------------------------------


def test_components(spark, tmp_path):
    rnd = random.Random(2)
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, 100 + i) for i in range(1, 300)]
    edges = chain + star + [(rnd.randrange(1000, 1200), rnd.randrange(1000, 1200)) for _ in range(90)] + [(5, 5), (1, 0)]
    got = components(spark.createDataFrame(edges, "a BIGINT, b BIGINT"), str(tmp_path / "c")).collect()
    linked = {frozenset(e) for e in edges}
    nodes = {n for e in edges for n in e if len(set(e)) > 1}
    want = brute.classes(sorted(nodes), lambda a, b: frozenset((a, b)) in linked)
    assert {r["node"]: r["root"] for r in got} == want and len(got) == len(want)
    empty = spark.createDataFrame([], "a BIGINT, b BIGINT")
    assert components(empty, str(tmp_path / "e")).count() == 0


# --- lines --------------------------------------------------------------------------------


def test_distance_against_the_textbook(spark):
    rnd = random.Random(1)
    rows = []
    for _ in range(600):
        a = "".join(rnd.choice("abé日") for _ in range(rnd.choice([0, 1, 2, 5, 9, 40])))
        rows.append((a, edited(rnd, a, rnd.randrange(5)) if len(a) > 5 else "".join(rnd.choice("ab") for _ in range(rnd.randrange(4)))))
    df = spark.createDataFrame(rows, "a STRING, b STRING")
    for edits in (1, 2, 3):
        for r in df.select("a", "b", line_dedup.within(F.col("a"), F.col("b"), edits).alias("near")).collect():
            assert r["near"] == brute.close(r["a"], r["b"], edits), (r, edits)


def test_parities_never_rule_out_a_similar_pair(spark):
    rnd, letters = random.Random(12), "ab Zé中😀𝄞\t"
    rows = []
    for edits in (1, 2, 3):
        for _ in range(150):
            a = b = "".join(rnd.choices(letters, k=rnd.randint(0, 40)))
            for _ in range(edits):
                at = rnd.randint(0, len(b))
                b = b[:at] + rnd.choice(["", *letters]) + b[at + rnd.randint(0, 1) :]
            rows.append((a, b, edits))
    df = spark.createDataFrame(rows, "a STRING, b STRING, edits INT").withColumns(
        {f"odd_{s}": line_dedup.letter_parities(F.col(s)) for s in "ab"}
    )
    near = F.bit_count(F.col("odd_a").bitwiseXOR(F.col("odd_b"))) <= 2 * F.col("edits")
    assert df.where(near).count() == len(rows)
    by_two = line_dedup.parities_near(F.col("odd_a"), F.col("odd_b"), 2)
    assert df.where(F.col("edits") <= 2).where(by_two).count() == 300
    far = spark.createDataFrame([("abcdef", "")], "a STRING, b STRING")
    assert far.where(line_dedup.parities_near(*[line_dedup.letter_parities(F.col(s)) for s in "ab"], 2)).isEmpty()


def test_dedup_lines_against_all_pairs(spark):
    rnd = random.Random(4)
    base = ["".join(rnd.choice("abcdefgh ") for _ in range(rnd.choice([31, 33, 60, 200]))).strip() + "." for _ in range(12)]
    rows = []
    for i in range(60):
        lines = [edited(rnd, rnd.choice(base), rnd.choice([0, 0, 1, 2, 3])) for _ in range(rnd.randrange(1, 6))]
        rows.append((i, "\n".join([*lines, rnd.choice(["short", "shirt", "", " \t"])])))
    rows += [(100, None), (101, ""), (102, "\n\n"), (103, "  " + base[0] + "\t"), (104, "x" * 20_000), (105, "x" * 20_001)]
    got = line_dedup.dedup_lines(docs_of(spark, [(*r, "s") for r in rows]))
    assert got.columns[:5] == ["doc_id", "text", "source", "size", "node"]
    assert sorted(tuple(r) for r in got.select("doc_id", F.coalesce("text", F.lit("NULL")), "_n_lines", "_n_removed").collect()) == sorted(
        (i, "NULL" if t is None else t, n, m) for i, t, n, m in brute.dedup_lines(rows)
    )


def test_dedup_lines_ties_and_nulls(spark):
    docs = docs_of(spark, [(1, "same line", "s"), (1, "same line", "s"), (None, "same line\nother", "s"), (2, "same line", None)])
    rows = Counter((r["doc_id"], r["text"]) for r in line_dedup.dedup_lines(docs).collect())
    # A document without an id comes first; repeated rows are one document.
    assert rows == Counter({(1, ""): 2, (None, "same line\nother"): 1, (2, ""): 1})
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0


# --- n-grams ------------------------------------------------------------------------------


def shingle_set(text):
    words = (text or "").lower().split()
    size = min(5, len(words))
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1)) if words else frozenset()


def jaccard_classes(rows):
    sets = {i: shingle_set(t) for i, t in rows}

    def linked(a, b):
        x, y = sets[a], sets[b]
        return bool(x and y) and 100 * len(x & y) >= 75 * len(x | y)

    return {i: (len(sets[i]), root) for i, root in brute.classes(sorted(sets), linked).items()}


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_classes_against_all_pairs(spark, seed):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    passage = [rnd.choice(words) for _ in range(60)]
    base = [[rnd.choice(words) for _ in range(rnd.choice([6, 20, 60, 120]))] for _ in range(10)]
    rows = []
    for i in range(140):
        text = list(rnd.choice(base))
        for _ in range(rnd.choice([0, 0, 1, 1, 2, 4])):
            text[rnd.randrange(len(text))] = rnd.choice(words)
        if rnd.random() < 0.3:
            text = passage + text
        if rnd.random() < 0.2:
            text = text[: rnd.randrange(len(text))]
        rows.append((i, " ".join(text).title() if rnd.random() < 0.5 else "\n".join(text)))
    rows += [(200, None), (201, ""), (202, "one two"), (203, "ONE  two"), (204, "one two three"), (205, " \n")]
    got = ngram_join.jaccard_classes(docs_of(spark, [(*r, "s") for r in rows]))
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got.collect()} == jaccard_classes(rows)


def test_prefix_orders_agree_on_frequent_tokens():
    import numpy as np

    order = ngram_join.Orders(np.array([30, 10], np.uint64), np.array([1000, 4]))
    own = np.array([5, 10, 20, 30], np.uint64)
    assert order.first(own, 4).tolist() == [5, 20, 10, 30]
    assert sorted(order.first(own, 2, seed=2).tolist()) == [5, 20]


def test_one_of_each_nulls_and_repeats(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(7, text, "s"), (3, text, "s"), (3, text, "t"), (None, text, "s"), (9, None, "s"), (8, "a b", None), (None, None, "s")]
    docs = docs_of(spark, rows)
    kept = ngram_join.one_of_each(docs)
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in kept.collect()))) == sorted(
        map(str, [(3, text), (9, None), (8, "a b"), (None, None)])
    )
    assert ngram_join.jaccard_classes(docs.limit(0)).count() == 0


def test_rows_of_crowded_tokens_are_narrow(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ngram_join, "MANY_CLASSES", 2)
    rnd = random.Random(8)
    shared = [rnd.choice("abcdefgh") * rnd.randrange(1, 9) for _ in range(60)]
    texts = [" ".join(shared[:50] + [f"w{k}x{j}" for j in range(25)]) for k in range(6)] + ["a b", None]
    docs = docs_of(spark, [(i, t, "s") for i, t in enumerate(texts)])
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.jaccard_classes(docs, folder=str(tmp_path / "j")).collect()}
    assert got == {i: i for i in range(len(texts))}
    heavy = spark.read.parquet(str(tmp_path / "j" / "heavy")).collect()
    sets = {r["node"]: len(r["bits"]) for r in spark.read.parquet(str(tmp_path / "j" / "sets")).collect()}
    crowded = {r["token"] for r in heavy}
    assert heavy and all(2 * len(r["bits"]) == sets[r["node"]] and set(r["ahead"]) <= crowded for r in heavy)


@pytest.mark.parametrize("block_rows", [8, 1000])
def test_a_group_of_near_copies_makes_no_rows_of_pairs(spark, tmp_path, monkeypatch, block_rows):
    """Copies with one or two other words link or miss the threshold by little: many classes, many possible pairs."""
    for name, value in (("DENSE", 2), ("BLOCK_ROWS", block_rows)):
        monkeypatch.setattr(ngram_join, name, value, raising=False)
    rnd = random.Random(5)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(150):
        text = list(base)
        for at in rnd.sample(range(60), rnd.choice([1, 2, 2])):
            text[at] = f"x{rnd.randrange(3)}"
        rows.append((i, " ".join(text)))
    rows += [(200, " ".join(base[:30])), (201, None), (202, " ".join(base[30:]))]
    docs = docs_of(spark, [(*r, "s") for r in rows] + [(None, rows[0][1], "s")])
    got = ngram_join.jaccard_classes(docs, folder=str(tmp_path / "j")).where("doc_id IS NOT NULL").collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == jaccard_classes(rows)
    assert spark.read.parquet(str(tmp_path / "j" / "rest-met")).count() <= len(rows)


def test_ties_of_two_blocks():
    import pyarrow as pa

    def met(blocks, labels, sets):
        size = len(sets)
        table = {"i": [0] * size, "j": [max(blocks)] * size, "block": blocks, "node": list(range(size)), "label": labels, "tokens": sets}
        kinds = {c: pa.list_(pa.int64()) if c == "tokens" else pa.int64() for c in table}
        return ngram_join.ties(pa.table({c: pa.array(v, kinds[c]) for c, v in table.items()}), 75).to_pylist()

    same, other = [1, 2, 3, 4], [5, 6]
    assert met([0, 0, 0], [0, 1, 2], [same, other, same]) == [{"a": 0, "b": 2}]
    assert met([0, 0, 0], [0, 0, 0], [same, same, same]) == met([0, 0], [0, 1], [same, other]) == []
    assert len(met([0, 0, 0, 0], [0, 1, 2, 3], [same] * 4)) == 3
    # Rows of one block meet in their own group.
    assert met([0, 0, 1], [0, 1, 2], [same, same, other]) == []
    assert met([1, 0, 0], [0, 1, 2], [same, same, other]) == [{"a": 0, "b": 1}]


def test_classes_of_a_token(spark, tmp_path):
    join = object.__new__(ngram_join.Join)
    rows = [(1, 1, 1), (1, 2, 1), (1, 3, 3), (2, 1, 1), (2, 2, 1), (3, 3, 3), (3, 4, 4), (3, 5, 5), (4, 6, 6)]
    got = join.spread(spark.createDataFrame(rows, "token BIGINT, node BIGINT, label BIGINT")).collect()
    assert sorted((r["token"], r["node"], r["classes"], r["main"]) for r in got) == [
        (1, 1, 2, 1), (1, 2, 2, 1), (1, 3, 2, 1), (3, 3, 3, 5), (3, 4, 3, 5), (3, 5, 3, 5),
    ]


# --- mixing -------------------------------------------------------------------------------


def plain_targets(sizes, weights, cap):
    """Clamp and share the excess, round by round."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        rest = total - sum(fixed.values())
        share = sum(w for s, w in weight.items() if s not in fixed)
        target = {s: fixed.get(s, rest * w / share if share else 0) for s, w in weight.items()}
        over = {s: cap * sizes[s] for s in names if s not in fixed and target[s] > cap * sizes[s]}
        if not over:
            return target
        fixed |= over


@pytest.mark.parametrize("seed", range(3))
def test_mix(spark, seed):
    rnd = random.Random(seed)
    rows = [
        (i, "w " * rnd.choice([0, 1, 5, 40, 300]), rnd.choice(["b", "a", "c", "hot", "hot", "hot", "é", "Z", None]))
        for i in range(300)
    ] + [(900, None, "a"), (901, "x", "tiny"), (None, "y z", "a"), (1, "w " * 7, "a"), (1, "w " * 7, "a"), (5, "", "none")]
    got = mixing.mix(docs_of(spark, rows)).collect()
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len((text or "").split())
    target, taken = plain_targets(sizes, (5, 2, 1), 3), Counter()
    assert Counter((r["doc_id"], r["source"], r["size"]) for r in got) == Counter((i, s, len((t or "").split())) for i, t, s in rows)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - target[r["source"]]) < 1e-6
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    for source in sizes:
        assert target[source] - 1.001 <= taken[source] <= target[source] + 0.001
    again = mixing.mix(docs_of(spark, rows[::-1]).repartition(5)).collect()
    assert Counter(got) == Counter(again)


def test_mixed_keeps_columns_and_empty_tables(spark):
    docs = docs_of(spark, [(1, "a b", "s"), (1, "a b", "s"), (2, None, None)])
    rows = mixing.mixed(docs)
    assert rows.columns == ["doc_id", "text", "source", "node", "size", "source_size", "target", "taken"] and rows.count() == 3
    assert mixing.mix(docs.limit(0)).count() == 0


# --- archive ------------------------------------------------------------------------------


def test_archive_round_trip(spark, tmp_path):
    rows = [(1, "http://a/", "same é"), (5, "http://b/\r\nX: y", "same é"), (3, None, "same é"), (2, "u", None), (4, "v", "")]
    rows += [(None, "w", "same é"), (None, "w", "no id"), (6, "z", "long " * 100_000), (6, "z", "long " * 100_000)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id BIGINT, url STRING, html STRING, key STRING")
    folder = warc.write_archive(pages, str(tmp_path / "a"))
    index = warc.read_index(spark, folder).collect()
    assert warc.read_payloads(spark, folder).count() == 4  # each payload once
    want = Counter()
    for page_id, _, html in rows:
        data = (html or "").encode()
        ids = [i for i, _, h in rows if (h or "") == (html or "") and i is not None]
        largest = max(ids, default=None)
        again = page_id != largest
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        want[page_id, len(data), digest, "revisit" if again else "response", largest if again else None] += 1
    assert Counter(map(tuple, index)) == want
    records = {r["page_id"]: r for r in warc.read_records(spark, folder).where("page_id IS NOT NULL").collect()}
    head, body = bytes(records[5]["record"]).split(b"\r\n\r\n")[:2]
    assert body.decode() == "same é" and b"\r\nWARC-Target-URI: http://b/%0D%0AX: y\r\n" in head
    assert f"Content-Length: {len(body)}".encode() in head
    assert b"WARC-Refers-To: <urn:page:5>" in bytes(records[1]["record"]) and bytes(records[1]["payload"]) == body


def test_archive_small_payloads_and_damage(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab")], "page_id BIGINT, url STRING, html STRING")
    folder = warc.write_archive(pages, str(tmp_path / "s"), min_revisit=3)
    assert {r["record_type"] for r in warc.read_index(spark, folder).collect()} == {"response"}
    bad = spark.createDataFrame([("00", b"ab")], "key STRING, payload BINARY")
    bad.write.mode("append").parquet(f"{folder}/payloads")
    with pytest.raises(Exception, match="damaged payload"):
        warc.read_payloads(spark, folder).collect()
    folder = warc.write_archive(pages.limit(0), str(tmp_path / "e"))
    assert warc.read_index(spark, folder).count() == 0


def test_index_is_of_rebuilt_records(spark, tmp_path):
    """A header that states another length of its block than the rebuilt record has is an error in the index too."""
    pages = spark.createDataFrame([(1, "u", "abc"), (2, "v", "abc")], "page_id BIGINT, url STRING, html STRING")
    folder = warc.write_archive(pages, str(tmp_path / "l"))
    assert warc.read_index(spark, folder).count() == 2
    heads = spark.read.parquet(f"{folder}/headers").where("page_id = 2")
    bad = heads.withColumn("page_id", F.lit(9).cast("long")).withColumn("header", F.replace("header", F.lit("Length: 3"), F.lit("Length: 4")))
    bad.write.mode("append").parquet(f"{folder}/headers")
    for read in (warc.read_index, warc.read_records):
        with pytest.raises(Exception, match="damaged record of page 9"):
            read(spark, folder).collect()


# --- URLs ---------------------------------------------------------------------------------

RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/")]


def test_rules_and_list(spark):
    cases = {
        "http://www.Example.com/en/x?q": ("allow", "www.example.com/en/"),
        "http://m.example.com/en/x": ("block", "example.com/en/"),
        "http://example.com/en": ("allow", "com/"),
        "http://example.com": ("allow", None),
        "http://notexample.com/en/": ("allow", "com/"),
        "https://a.net/es/?": ("block", "net/es/"),
        "https://a.net/ES/": ("allow", None),
        "https://www.bad.org/p/1.html?x#y": ("block", None),
        "http://bad.org/p/1": ("block", None),
        "http://bad.org/p/2": ("allow", None),
        "no scheme bad.org/p/1": ("allow", None),
        "": ("allow", None),
        None: ("allow", None),
    }
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(cases)] * 2, "page_id INT, url STRING, rule STRING, key STRING")
    listed = spark.createDataFrame([("http://m.bad.org/p/1/",), ("HTTP://BAD.org/p/1",), (None,), ("x",)], "url STRING")
    rows = url_filter.judge_urls(pages, listed, RULES).collect()
    assert len(rows) == 2 * len(cases)
    for r in rows:
        assert (r["verdict"], r["rule"]) == list(cases.values())[r["page_id"]], r
    none = url_filter.judge_urls(pages, listed.limit(0), RULES)
    assert {r["listed"] for r in none.collect()} == {False}
    assert url_filter.judge_urls(pages.limit(0), listed, RULES).count() == 0


def test_filter_has_no_false_negatives_and_few_hits(spark):
    listed = spark.range(2000).selectExpr("concat('k', id) AS key")
    blocks = -(-2000 * 16 // url_filter.BLOCK_BITS)
    table = url_filter.bloom_blocks(listed, blocks)
    keys = spark.range(4000).selectExpr("concat('k', id) AS key", "id < 2000 AS there")
    rows = keys.withColumn("block", url_filter.block_of(F.col("key"), blocks)).join(table, "block", "left")
    passes = F.lit(True)
    for i, mask in enumerate(url_filter.masks(F.col("key"))):
        passes = passes & (F.col(f"w{i}").bitwiseAND(mask) == mask)
    found = rows.select("there", F.coalesce(passes, F.lit(False)).alias("hit")).groupBy("there").agg(F.sum(F.col("hit").cast("int"))).collect()
    hits = {r[0]: r[1] for r in found}
    assert hits[True] == 2000 and hits[False] < 60


def test_large_filter_is_joined(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "BROADCAST_BLOCKS", 0)
    pages = spark.createDataFrame([(1, "http://b/x"), (2, "http://b/y")], "page_id INT, url STRING")
    rows = url_filter.judge_urls(pages, pages.where("page_id = 1"), []).collect()
    assert {r["page_id"]: r["verdict"] for r in rows} == {1: "block", 2: "allow"}


# --- chats --------------------------------------------------------------------------------


def chats_of(spark, chats):
    rows = [(c, n, r, t, "x") for c, turns in chats for n, (r, t) in enumerate(turns)]
    return spark.createDataFrame(rows, "conv_id BIGINT, turn BIGINT, role STRING, text STRING, place STRING").repartition(3)


def test_snapshots_collapse(spark):
    whole = [("user", "hi"), ("assistant", None), ("user", "a <|user|> b"), (None, "")]
    chats = [(1, whole[:2]), (2, whole), (3, whole[:3]), (4, whole), (5, whole[1:]), (6, [("user", "hi"), ("assistant", "")]), (None, [("user", "x")])]
    rows = {r["conv_id"]: r for r in chat.format_chats(chats_of(spark, [*chats, (2, whole)])).collect()}
    assert set(rows) == {2, 5, 6, None}
    assert rows[2]["text"] == "<|user|>\nhi\n<|assistant|>\n\n<|user|>\na < |user|> b\n<|unknown|>\n\n"
    assert (rows[2]["n_turns"], rows[2]["n_equal"], rows[6]["n_equal"]) == (4, 2, 1)
    assert chat.format_chats(chats_of(spark, chats).limit(0)).count() == 0


def test_long_conversations_come_in_parts(spark):
    turns = [("user", str(i)) for i in range(700)]
    other = [*turns[:600], ("user", "else")]
    rows = chat.format_chats(chats_of(spark, [(1, turns), (2, turns[:600]), (3, turns[:256]), (4, other)])).orderBy("conv_id", "part").collect()
    assert [(r["conv_id"], r["part"], r["n_turns"]) for r in rows] == [(c, p, n) for c, n in ((1, 700), (4, 601)) for p in range(3)]
    for c, said in ((1, turns), (4, other)):
        assert "".join(r["text"] for r in rows if r["conv_id"] == c) == "".join(f"<|{r}|>\n{t}\n" for r, t in said)


def test_odd_turn_numbers(spark):
    rows = [(1, None, "user", "first"), (1, -3, "user", "second"), (1, 7, "b", "x"), (1, 7, "a", "y"), (1, 7, "a", "y")]
    df = spark.createDataFrame(rows, "conv_id BIGINT, turn BIGINT, role STRING, text STRING")
    got = chat.format_chats(df).orderBy("part").collect()
    assert "".join(r["text"] for r in got) == "<|user|>\nfirst\n<|user|>\nsecond\n<|a|>\ny\n<|b|>\nx\n" and got[0]["n_turns"] == 4


def test_conversation_ids_may_be_text(spark):
    """Hundreds of rows with one turn number or none, and ids that are text, empty or missing."""
    rows = [("a", n, "user", f"t{i:04}") for n in (None, 3) for i in range(400)] + [(None, 0, "user", "x"), ("", 0, "user", "y")]
    df = spark.createDataFrame(rows, "conv_id STRING, turn BIGINT, role STRING, text STRING").repartition(5)
    got = chat.format_chats(df).orderBy("conv_id", "part").collect()
    assert [(r["conv_id"], r["part"], r["n_turns"]) for r in got] == [(None, 0, 1), ("", 0, 1), ("a", 0, 800), ("a", 1, 800)]
    assert "".join(r["text"] for r in got[2:]) == "".join(f"<|user|>\n{t}\n" for c, _, _, t in rows if c == "a")


# --- n-gram join: documents without an id, ids that are there twice ---------------------------------


def text_of(start, stop):
    return " ".join(f"w{i}" for i in range(start, stop))


CHAIN = [text_of(0, 100), text_of(8, 108), text_of(16, 116)]  # 1 and 2, 2 and 3 are alike, 1 and 3 are not


@pytest.mark.parametrize("middle", [9, None])
def test_links_go_through_documents_without_an_id(spark, middle):
    rows = [(1, CHAIN[0]), (middle, CHAIN[1]), (middle, CHAIN[1]), (5, CHAIN[2]), (None, "alone here"), (7, text_of(500, 600))]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngram_join.jaccard_classes(docs).collect())
    assert got == Counter({(1, 96, 1): 1, (middle, 96, 1): 2, (5, 96, 1): 1, (None, 1, None): 1, (7, 96, 7): 1})


def test_one_row_of_each_class_and_nothing_else_goes(spark):
    def kept(rows):
        docs = spark.createDataFrame([(i, t, "k", "p") for i, t in rows], "doc_id BIGINT, text STRING, key STRING, _id STRING")
        return Counter((r["doc_id"], r["text"]) for r in ngram_join.one_of_each(docs).collect())

    a, b, c = text_of(0, 60), text_of(100, 160), text_of(200, 260)
    assert kept([(5, a), (5, b), (3, a)]) == Counter([(5, b), (3, a)])
    assert kept([(5, a), (5, b)]) == Counter([(5, a), (5, b)])
    assert kept([(None, a), (None, a), (None, b), (2, b), (2, b)]) == Counter([(None, a), (2, b)])
    assert kept([(1, ""), (1, ""), (None, None), (4, c)]) == Counter([(1, ""), (1, ""), (None, None), (4, c)])
    assert kept([(1, CHAIN[0]), (None, CHAIN[1]), (5, CHAIN[2])]) == Counter([(1, CHAIN[0])])
    assert kept([]) == Counter()


def test_the_frequent_shingles_are_bounded(spark):
    counts = spark.createDataFrame([(i, 2 ** (i % 10)) for i in range(1000)], "token BIGINT, seen BIGINT")
    for most, want in ((250, 200), (1000, 800), (99, 0), (10**6, 800)):
        assert ngram_join.frequent(counts, most).num_rows == want
