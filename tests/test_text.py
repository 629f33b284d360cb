"""Scalar expressions against the standard library and fixed examples."""

from __future__ import annotations

import json
import random
from datetime import datetime, timedelta, timezone
from pathlib import PurePosixPath

import pytest

from tidemark.functions import paths, text

UTC = timezone.utc


def evaluate(spark, values, ddl, expression):
    """Values of ``expression`` over a column ``x``, in the order of ``values``."""
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i INT, x {ddl}").selectExpr("i", f"{expression} AS y")
    return [r["y"] for r in sorted(df.collect(), key=lambda r: r["i"])]


@pytest.mark.parametrize(
    ("n", "expected"),
    [
        (None, ""),
        (0, "0 B"),
        (512, "512 B"),
        (1023, "1023 B"),
        (1024, "1.0 KiB"),
        (1280, "1.2 KiB"),
        (1792, "1.8 KiB"),
        (1048575, "1024.0 KiB"),
        (1024**2, "1.0 MiB"),
        (2 * 1024**3, "2.0 GiB"),
        (5 * 1024**4, "5.0 TiB"),
        (1024**5, "1.0 PiB"),
        (1024**6, "1024.0 PiB"),
        (2**63 - 1, "8192.0 PiB"),
        (-1, "-1 B"),
        (-(2**63), "-9223372036854775808 B"),
    ],
)
def test_humanize_bytes(spark, n, expected):
    assert evaluate(spark, [n], "BIGINT", text.humanize_bytes("x")) == [expected]


def test_humanize_bytes_rounds_like_python(spark):
    rnd = random.Random(3)
    values = [rnd.randrange(2 ** rnd.randrange(10, 62)) + 1024 for _ in range(2000)]
    values += [1024**p * q // 20 for p in (1, 2, 3, 4, 5) for q in range(20, 2000, 7)]

    def expected(n):
        power = min(max(p for p in range(6) if float(n) >= 1024.0**p), 5)
        return f"{float(n) / 1024.0**power:.1f} {text.BYTE_UNITS[power]}"

    assert evaluate(spark, values, "BIGINT", text.humanize_bytes("x")) == [
        expected(v) for v in values
    ]


def test_json_quote_equals_json_dumps(spark):
    rnd = random.Random(7)
    pool = list('aZ09 "\\\n\t\r\b\f\x00\x1f\x7f\x80$~/uéß漢😀\u2028\uffff') + ["\\u00e9", "\\\\", "''"]
    values = ["".join(rnd.choices(pool, k=rnd.randrange(40))) for _ in range(600)]
    values += ["", "plain", "plain\n", "x\n\n", '"', "é" * 50_000 + '"' * 50_000 + "漢字a" * 20_000]
    assert evaluate(spark, values, "STRING", text.json_quote("x")) == [json.dumps(v) for v in values]


def test_iso_utc_equals_isoformat_in_any_session_zone(spark):
    rnd = random.Random(5)
    start = datetime(2024, 3, 10, 6, 0, tzinfo=UTC)
    values = [
        start + timedelta(minutes=rnd.randrange(600_000), microseconds=rnd.choice([0, 1, 120, 500_000]))
        for _ in range(300)
    ]
    values += [datetime(1970, 1, 1, tzinfo=UTC), datetime(1969, 12, 31, 23, 59, 59, 999_999, UTC)]
    try:
        for zone in ("America/New_York", "UTC"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            got = evaluate(spark, values, "TIMESTAMP", text.iso_utc("x"))
            assert got == [v.isoformat() for v in values]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_literals_survive(spark):
    values = ["it's", "a\\b", "new\nline", "tab\tq\"", "\\n", "$1 ${x}", "\f\b\r", "é😀"]
    for value in values:
        assert spark.range(1).selectExpr(f"{text.literal(value)} AS y").first()["y"] == value


def test_schema_lines(spark):
    ddl = "ARRAY<STRUCT<name STRING, type STRING, mode STRING, description STRING>>"
    schema = [("id", "INTEGER", "REQUIRED", "Event ID"), ("ts", "TIMESTAMP", None, 'a "b"\n'), None]
    got = evaluate(spark, [schema[:2], [], None], ddl, text.schema_lines("x"))
    assert got == [
        "schema:\n"
        '  - name: id  type: INTEGER  mode: REQUIRED  description: "Event ID"\n'
        '  - name: ts  type: TIMESTAMP  mode: None  description: "a \\"b\\"\\n"\n',
        "schema:\n",
        "schema:\n",
    ]


def test_argument_and_uri_lines(spark):
    ddl = "ARRAY<STRUCT<name STRING, type STRING, mode STRING>>"
    got = evaluate(spark, [[("x", "INT64", "IN")], [], None], ddl, text.argument_lines("x"))
    assert got == ["arguments:\n  - name: x  type: INT64  mode: IN\n", "", ""]
    got = evaluate(spark, [["gs://b/f.csv", "gs://b/g.csv"], []], "ARRAY<STRING>", text.uri_lines("x"))
    assert got == ["source_uris:\n  - gs://b/f.csv\n  - gs://b/g.csv\n", "source_uris:\n"]


def test_stem_equals_pathlib(spark):
    names = ["a", "a.b", "a.b.c", ".hid", "a.", "..", "..a", ".", "", "...", "a..b", ".a.b"]
    names += ["x.y\n", "n\n.y", "é.yaml", "a .b", "a.b ", "$1.x"]
    assert evaluate(spark, names, "STRING", paths.stem("x")) == [
        PurePosixPath(n).stem for n in names
    ]


@pytest.mark.parametrize(
    ("model", "expected"),
    [
        ("proj/ds/tbl", ("proj", "ds", "tbl", None)),
        ("proj/ds/models/tbl", ("proj", "ds", "tbl", None)),
        ("proj/ds/models/tbl.yaml", ("proj", "ds", "tbl", None)),
        ("proj/ds/a.b.c", ("proj", "ds", "a.b", None)),
        ("a//c", ("a", "", "c", None)),
        ("a/b/", ("a", "b", "", None)),
    ],
)
def test_parse_model(spark, model, expected):
    assert tuple(evaluate(spark, [model], "STRING", paths.parse_model("x"))[0]) == expected


@pytest.mark.parametrize(("model", "n"), [("proj/tbl", 2), ("a/b/c/d/e", 5), ("x", 1), ("a/b/c/d/", 5)])
def test_parse_model_rejects(spark, model, n):
    got = evaluate(spark, [model], "STRING", paths.parse_model("x"))[0]
    assert got["project"] is None and got["model"] is None
    assert got["error"].endswith(f"found {n}") and f"'{model}'" in got["error"]


def test_definition_paths(spark):
    kinds = list(paths.KINDS)
    got = evaluate(spark, kinds, "STRING", paths.definition_path("x", "/o/p", "'ds'", "'n'"))
    assert got == [
        "/o/p/ds/views/n.sql",
        "/o/p/ds/routines/n.sql",
        "/o/p/ds/models/n.yaml",
        "/o/p/ds/models/n.yaml",
        "/o/p/scheduled_queries/n.sql",
        "/o/p/saved_queries/n.sql",
    ]
    got = evaluate(spark, kinds, "STRING", paths.model_path("x", "/o/p", "'ds'", "'n'"))
    assert got == ["/o/p/ds/models/n.yaml"] * 2 + [None] * 4


@pytest.mark.parametrize(
    ("base", "output_dir", "project", "expected"),
    [
        ("/base", "output", "my-project", "/base/output/my-project"),
        ("/base", ".", "proj", "/base/proj"),
        ("/base/x", "../y", "proj", "/base/y/proj"),
        ("/base", "/abs", "proj", "/abs/proj"),
        ("s3a://bucket/base", "output", "proj", "s3a://bucket/base/output/proj"),
        ("s3a://bucket", ".", "proj", "s3a://bucket/proj"),
        ("/base", ".", "proj", "/base/proj"),
    ],
)
def test_output_root(base, output_dir, project, expected):
    assert paths.output_root(base, output_dir, project) == expected


def test_refs_and_export_paths(spark):
    assert evaluate(spark, ["t"], "STRING", paths.table_ref("'p'", "'d'", "x")) == ["p.d.t"]
    assert evaluate(spark, ["t"], "STRING", paths.export_path("/o/data/", "x", "csv")) == [
        "/o/data/t.csv"
    ]
    assert paths.data_dir("/o/proj/") == paths.data_dir("/o/proj") == "/o/proj/data"
    assert evaluate(spark, ["/a/b.c", "b"], "STRING", paths.basename("x")) == ["b.c", "b"]
