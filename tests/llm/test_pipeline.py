"""The pipeline against plain versions of its stages, on a small corpus."""

from __future__ import annotations

import random
from collections import Counter

import brute
import pyarrow as pa
import pytest
from test_join_operators import edited, jaccard_classes, plain_targets
from test_text_operators import plain_hits

import corpus_pipeline
from tidemark.llm import decontam, quality
from tidemark.llm.common import pieces

COLUMNS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


def sentence(rnd):
    return " ".join(f"{rnd.choice('abcdefg')}{rnd.randrange(3000)}" for _ in range(rnd.randrange(8, 15))) + "."


def corpus():
    rnd = random.Random(11)
    items = [" ".join(f"item{i}word{k}" for k in range(16)) for i in range(3)]
    stock = [sentence(rnd) for _ in range(3)]
    docs = []
    for i in range(60):
        lines = [sentence(rnd) for _ in range(rnd.randrange(6, 12))]
        kind = i % 6
        if kind == 1 and docs:  # a near copy
            lines = docs[-1][1].split("\n")
            lines[1] = sentence(rnd)
            lines[2] = edited(rnd, lines[2], 2)
        if kind == 2:
            lines.insert(3, rnd.choice(stock))
        if kind == 3:
            lines[0] += f" so {rnd.choice(items)} end."
        if kind == 4:
            lines = ["home | shop | about | more"] * (2 if i % 4 else 40) + lines
        if kind == 5 and i % 4 == 1:
            lines = [rnd.choice(items) + " " + rnd.choice(items) + "."] + [stock[0]] * 5
        docs.append((i, "\n".join(lines), "en", rnd.choice(["s1", "s2", "s2", "s3", None])))
    docs += [(100, docs[0][1], "en", "s1"), (101, None, None, "s1"), (102, "", "en", None), (103, "too short.", "en", "s1")]
    rows = [(i, t, lang, s, len(t or "")) for i, t, lang, s in docs]
    return rows, items


def plain_cut(text, items):
    while True:
        words = decontam.words_of(text)
        hit, _ = plain_hits(words, items)
        if not hit:
            return text
        if 2 * len(hit) > len(words):
            return None
        places = [m.span() for m in decontam.WORD.finditer(text)]
        out, at = "", 0
        for p in sorted(hit):
            if p - 1 not in hit:
                out += text[at : places[p][0]]
            at = places[p][1]
        text = out + text[at:]


def test_stages_against_plain_versions(spark, tmp_path):
    rows, items = corpus()
    spark.createDataFrame(rows, COLUMNS).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    bench = spark.createDataFrame(list(enumerate(items)), "item_id BIGINT, text STRING")
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    by_id = {r[0]: r for r in rows}

    def after(name, docs, want):
        out = dict(corpus_pipeline.STAGES)[name](spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        got = {r["doc_id"]: r["text"] for r in out.collect()}
        assert got == want and out.count() == len(want)
        for r in out.collect():
            assert (r["lang"], r["source"]) == by_id[r["doc_id"]][2:4] and r["n_chars"] == len(r["text"])
        return out, got

    judged = {i: quality.judge(t) for i, t, *_ in rows}
    texts = {i: "\n".join(good) for i, (facts, good) in judged.items() if facts["kept"]}
    assert 0 < len(texts) < len(rows) and any(t != by_id[i][1] for i, t in texts.items())
    docs, texts = after("quality_rules", docs, texts)

    plain = brute.dedup_lines(sorted(texts.items()))
    want = {i: t for i, t, _, gone in plain if not gone or t.split()}
    assert len(want) < len(texts) and sum(gone for *_, gone in plain) > 10
    docs, texts = after("line_dedup", docs, want)

    classes = jaccard_classes(sorted(texts.items()))
    docs, texts = after("ngram_join", docs, {i: t for i, t in texts.items() if classes[i][1] == i})

    coded = [(str(i), decontam.words_of(t)) for i, t in enumerate(items)]
    want = {i: plain_cut(t, coded) for i, t in texts.items()}
    assert any(t is not None and t != texts[i] for i, t in want.items())
    docs, texts = after("decontamination", docs, {i: t for i, t in want.items() if t is not None})

    mixed = corpus_pipeline.mix_sources(spark, docs, str(tmp_path)).collect()
    sizes, taken = Counter(), Counter()
    for i, t in texts.items():
        sizes[by_id[i][3]] += len(t.split())
    target = plain_targets(sizes, (5, 2, 1), 3)
    for r in mixed:
        assert r["text"] == texts[r["doc_id"]] and 0 < r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    assert all(target[s] - 1.001 <= taken[s] <= target[s] + 0.001 for s in sizes)

    whole = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter(map(str, whole)) == Counter(map(str, mixed))


def test_near_copies_that_lines_do_not_show(spark):
    """Copies without common lines: the join keeps the one with the smallest id."""
    rnd = random.Random(3)
    words = [f"w{rnd.randrange(500)}" for _ in range(90)]
    copy = [*words[:40], "other", *words[41:]]
    docs = spark.createDataFrame([(7, " ".join(words), "en", "s", 1), (4, "\n".join(copy), "en", "s", 1)], COLUMNS)
    assert [r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()] == [4]


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_odd_rows(spark, tmp_path, name):
    """Nulls anywhere, empty texts, repeated rows, extra columns with clashing names, an empty table."""
    rnd = random.Random(1)
    text = "\n".join(sentence(rnd) for _ in range(8))
    rows = [(1, text, None, None, None), (1, text, None, None, None), (None, text + " x.", "en", "s", 3), (2, None, "en", "s", 0), (3, "", "en", None, 0)]
    rows += [(None, None, None, None, None), (4, " \n", "en", "s", 2), (5, "long " * 30_000, "en", "s", 5)]
    docs = spark.createDataFrame(rows, COLUMNS).selectExpr("*", "'a' AS size", "'b' AS taken", "1 AS node", "'c' AS version", "2 AS place")
    spark.createDataFrame([(1, text[:200])], "item_id BIGINT, text STRING").write.parquet(str(tmp_path / "benchmark.parquet"))
    stage = dict(corpus_pipeline.STAGES)[name]
    out = stage(spark, docs, str(tmp_path))
    if name != "mixing":
        assert out.columns == docs.columns
    out.collect()
    assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0


class Caught:
    """In place of ``docs``: gives the function that tasks would run."""

    def __init__(self, docs):
        self.columns, self.schema, self.sparkSession = docs.columns, docs.schema, docs.sparkSession

    def select(self, *names):
        return self

    def mapInArrow(self, run, schema):
        return run


@pytest.mark.parametrize("name", ["quality", "cleaned", "decontaminated"])
def test_tasks_work_on_slices(spark, tmp_path, name):
    """Of a large batch a task turns a slice into objects at once, however Spark cuts its batches."""
    rnd = random.Random(5)
    texts = ["\n".join(sentence(rnd) for _ in range(40 + i % 7)) for i in range(1500)] + [None, ""]
    docs = Caught(spark.createDataFrame([], "doc_id BIGINT, text STRING"))
    bench = spark.createDataFrame([(1, texts[3][:200])], "item_id BIGINT, text STRING")
    run = {
        "quality": lambda: quality.quality(docs),
        "cleaned": lambda: quality.cleaned(docs),
        "decontaminated": lambda: decontam.decontaminated(docs, bench, folder=str(tmp_path / "blocks")),
    }[name]()
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    out = list(run(iter([batch])))
    assert batch.nbytes > 3 << 20 and len(out) >= 4
    alone = [got for start in range(0, batch.num_rows, 100) for got in run(iter([batch.slice(start, 100)]))]
    assert pa.Table.from_batches(out).equals(pa.Table.from_batches(alone))


def test_pieces():
    texts = ["a" * n for n in (10, 0, 5000, 10, 20, 30, 40, 3000, 1)]
    batch = pa.RecordBatch.from_pydict({"n": list(range(9)), "text": texts})
    got = list(pieces(iter([batch, batch.slice(0, 0), batch.slice(2, 1)]), 200))
    assert all(p.nbytes <= 200 or p.num_rows == 1 for p in got)
    assert pa.Table.from_batches(got).to_pylist() == [*batch.to_pylist(), *batch.slice(2, 1).to_pylist()]
    assert [p.num_rows for p in pieces(iter([batch]))] == [9]
