"""Exports, definition versions, files, and a whole run."""

from __future__ import annotations

import csv
from dataclasses import replace
from datetime import date, datetime, timezone
from decimal import Decimal
from pathlib import Path

import pytest
from pyarrow import fs
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators.history import UncommittedChangesError
from tidemark.plans.pull import pull
from tidemark.session import scratch, session_conf, work_folder
from tidemark.sinks.definitions import (
    accepted,
    append_run,
    current_files,
    latest_definitions,
    read_runs,
    read_version,
    write_files,
    write_version,
)
from tidemark.sinks.export import export_requests, export_table, fetch_model, read_export
from tidemark.sinks.publish import POINTERS, current, publish, published
from tidemark.sources.snapshot import (
    SNAPSHOT_SCHEMAS,
    WORKTREE_SCHEMAS,
    load_snapshot,
    load_worktree,
)
from tidemark.sources.state import create_state, merge_state, read_state
from tidemark.sources.tables import scan_table, table_stats

UTC = timezone.utc
TS = datetime(2025, 1, 1, tzinfo=UTC)


def read_csv(folder):
    """All part files of a CSV dataset by an independent reader: header and rows."""
    header, rows = None, []
    for part in sorted(Path(folder).rglob("part-*")):
        with open(part, newline="", encoding="utf-8") as f:
            lines = list(csv.reader(f))
        header = lines[0]
        rows += lines[1:]
    return header, rows


def test_csv(spark, tmp_path):
    df = spark.createDataFrame([(1, "alice"), (2, "bob")], "id BIGINT, name STRING")
    dest = export_table(df, str(tmp_path / "data" / "tbl.csv"))
    header, rows = read_csv(dest)
    assert header == ["id", "name"] and sorted(rows) == [["1", "alice"], ["2", "bob"]]
    again = export_table(df.limit(1), dest, "csv")
    assert len(read_csv(again)[1]) == 1


def test_parquet(spark, tmp_path):
    df = spark.createDataFrame([(10, 20), (30, 40)], "x BIGINT, y BIGINT")
    dest = export_table(df, str(tmp_path / "t.parquet"), "parquet")
    back = spark.read.parquet(current(spark, dest))
    assert back.schema == df.schema and sorted(map(tuple, back.collect())) == [(10, 20), (30, 40)]


def test_unsupported_format(spark, tmp_path):
    with pytest.raises(ValueError, match="Unsupported format"):
        export_table(spark.range(1), str(tmp_path / "f.json"), "json")
    with pytest.raises(ValueError, match="Unsupported format"):
        fetch_model(spark, "p/d/missing", str(tmp_path), "json")
    assert not list(tmp_path.iterdir())


HARD = ["", None, "a,b", 'say "hi"', "line\nbreak", " blanks ", "\ttab", "é😀", "\\", '"', "a\r\nb", "#x", "''"]


def test_csv_text_survives(spark, tmp_path):
    df = spark.createDataFrame(list(enumerate(HARD)), "i INT, s STRING")
    dest = export_table(df, str(tmp_path / "t.csv"))
    _, rows = read_csv(dest)
    assert {int(i): s for i, s in rows} == {i: s or "" for i, s in enumerate(HARD)}
    back = read_export(spark, dest, df.schema).collect()
    assert {r["i"]: r["s"] for r in back} == dict(enumerate(HARD))
    text = "".join(p.read_text(encoding="utf-8") for p in Path(dest).rglob("part-*"))
    assert '0,""\n' in text and "1,\n" in text  # '' is quoted, null is an empty field


def test_csv_types(spark, tmp_path):
    row = (True, date(2024, 2, 29), datetime(2024, 1, 1, 0, 0, 7, 179575, UTC), Decimal("1.50"), 0.1, None)
    ddl = "b BOOLEAN, d DATE, t TIMESTAMP, m DECIMAL(10,2), f DOUBLE, n INT"
    df = spark.createDataFrame([row], ddl).selectExpr("*", "TIMESTAMP_NTZ'2024-01-01 00:00:00' AS z")
    dest = export_table(df, str(tmp_path / "t.csv"))
    assert read_csv(dest)[1] == [
        ["true", "2024-02-29", "2024-01-01T00:00:07.179575+0000", "1.50", "0.1", "", "2024-01-01T00:00:00.000000"]
    ]
    assert read_export(spark, dest, df.schema).collect() == df.collect()


def test_zero_rows_keep_the_header(spark, tmp_path):
    df = spark.createDataFrame([], "a BIGINT, b STRING")
    assert read_csv(export_table(df, str(tmp_path / "t.csv"))) == (["a", "b"], [])


def test_arrays_only_as_parquet(spark, tmp_path):
    df = spark.createDataFrame([([1, 2],)], "a ARRAY<INT>")
    with pytest.raises(AnalysisException):
        export_table(df, str(tmp_path / "t.csv"))
    dest = export_table(df, str(tmp_path / "t.parquet"), "parquet")
    assert read_export(spark, dest, df.schema, "parquet").first()["a"] == [1, 2]


def test_fetch_model(spark, tmp_path):
    spark.createDataFrame([(1, "x")], "a BIGINT, b STRING").write.parquet(str(tmp_path / "src/p/d/my_table"))
    for model in ("p/d/my_table", "p/d/models/my_table.yaml"):
        dest = fetch_model(spark, model, str(tmp_path / "data"), location=str(tmp_path / "src"))
        assert dest == str(tmp_path / "data/my_table.csv") and read_csv(dest) == (["a", "b"], [["1", "x"]])
    with pytest.raises(ValueError, match="found 2"):
        fetch_model(spark, "d/my_table", str(tmp_path / "data"))


def test_tables_and_views_of_the_session_catalog(spark, tmp_path):
    spark.sql(f"CREATE DATABASE sales LOCATION '{tmp_path}/sales'")
    try:
        spark.sql("CREATE TABLE sales.a_b USING parquet AS SELECT 1 AS y, 'q' AS x")
        spark.sql("CREATE VIEW sales.v AS SELECT x, y + 1 AS z FROM sales.a_b")
        table = scan_table(spark, "spark_catalog", "sales", "a_b")
        assert table.columns == ["y", "x"] and tuple(table.first()) == (1, "q")
        dest = fetch_model(spark, "spark_catalog/sales/views/v.sql", str(tmp_path / "data"))
        assert read_csv(dest) == (["x", "z"], [["q", "2"]])
        with pytest.raises(AnalysisException):
            scan_table(spark, "spark_catalog", "sales", "no`such")
    finally:
        spark.sql("DROP DATABASE sales CASCADE")


def test_export_requests_flag_shared_destinations(spark):
    requests = spark.createDataFrame([("p/a/t",), ("p/b/t.yaml",), ("p/a/u",), ("p/x",)], "model STRING")
    got = {r["model"]: r for r in export_requests(requests, "/o/data", "parquet").collect()}
    assert len(got) == 4
    assert (got["p/a/t"]["dest"], got["p/a/t"]["same_dest"]) == ("/o/data/t.parquet", 2)
    assert got["p/b/t.yaml"]["same_dest"] == 2 and got["p/a/u"]["same_dest"] == 1
    assert got["p/x"]["dest"] is None and got["p/x"]["error"] is not None


def test_table_stats(spark):
    ddl = "i INT, l BIGINT, s STRING, a ARRAY<FLOAT>, st STRUCT<x: INT, y: STRING>, m MAP<STRING, BIGINT>, n ARRAY<STRING>"
    df = spark.createDataFrame(
        [(1, 2, "é", [1.0, None, 2.0], (1, "ab"), {"k": 1}, ["a", None, "bcd"]), (None,) * 7], ddl
    )
    assert tuple(table_stats(df, "t").first()) == ("t", 2, 4 + 8 + 2 + 8 + 6 + 9 + 4)
    assert tuple(table_stats(df.limit(0), "e").first()) == ("e", 0, 0)


def definitions(spark, rows):
    return spark.createDataFrame(rows, schemas.DEFINITIONS)


def test_versions(spark, tmp_path):
    old = definitions(spark, [("/r/a", "old a", TS, "view"), ("/r/b", "old b", TS, "table")])
    new = definitions(spark, [("/r/b", "new b", TS, "external"), ("/r/c", "new c", TS, "view")])
    expected = {("/r/a", "old a", "view"), ("/r/b", "new b", "external"), ("/r/c", "new c", "view")}

    def content(df):
        rows = [(r["path"], r["content"], r["kind"]) for r in df.collect()]
        assert len(rows) == len(set(rows))
        return set(rows)

    first = write_version(old, new, new, str(tmp_path / "v1"))
    assert content(first) == expected
    second = write_version(first, new.limit(0), new.limit(0), str(tmp_path / "v2"))
    assert content(second) == expected
    assert (Path(current(spark, str(tmp_path / "v2"))) / "_SUCCESS").exists()
    with pytest.raises(FileExistsError):
        write_version(first, new, new, str(tmp_path / "v2"))
    assert content(read_version(spark, str(tmp_path / "v2"))) == expected
    with pytest.raises(ValueError, match="/r/b is there twice"):
        current_files(old.union(new))
    runs = old.selectExpr("*", "1L AS run").unionByName(new.selectExpr("*", "2L AS run"))
    assert content(current_files(runs)) == expected


def test_accepted_runs_are_commits(spark, tmp_path):
    table = str(tmp_path / "runs")
    append_run(definitions(spark, [("/r/a", "a", TS, "view")]), table, 1)
    append_run(definitions(spark, [("/r/b", "b", TS, "view")]), table, 2)
    rows = accepted(spark, table, 1, "2025-02-01 00:00:00").collect()
    assert [(r["path"], r["commit_ts"].replace(tzinfo=UTC).month) for r in rows] == [("/r/a", 2)]
    assert read_runs(spark, str(tmp_path / "none")).count() == 0


def test_runs(spark, tmp_path):
    table = str(tmp_path / "runs")
    append_run(definitions(spark, [("/r/a", "a1", TS, "view"), ("/r/b", "b1", TS, "table")]), table, 1)
    append_run(definitions(spark, [("/r/b", "b2", TS, "external"), ("/r/c", "c2", TS, "view")]), table, 2)
    append_run(definitions(spark, [("/r/b", "wrong", TS, "view")]), table, 10)
    append_run(definitions(spark, [("/r/c", "c10", TS, "view")]), table, 10)  # repeated

    def content(before=None):
        rows = latest_definitions(read_runs(spark, table, before)).collect()
        return sorted((r["path"], r["content"], r["kind"]) for r in rows)

    assert content(before=2) == [("/r/a", "a1", "view"), ("/r/b", "b1", "table")]
    assert content() == [("/r/a", "a1", "view"), ("/r/b", "b2", "external"), ("/r/c", "c10", "view")]


def test_files_in_a_shared_folder(spark, tmp_path):
    root = tmp_path / "out/proj"
    rows = [(f"{root}/ds/views/é v.sql", "SELECT 'é'\r\n", TS, "view"), (f"{root}/ds/models/t.yaml", "", TS, "table")]
    write_files(definitions(spark, rows), str(root))
    write_files(definitions(spark, rows), str(root))
    assert (root / "ds/views/é v.sql").read_bytes() == "SELECT 'é'\r\n".encode()
    assert len([p for p in root.rglob("*") if p.is_file()]) == 2
    assert (root / "ds/models/t.yaml").read_bytes() == b""
    with pytest.raises(ValueError, match="no file system is known"):
        write_files(definitions(spark, rows), "ftp://lake/out")
    with pytest.raises(Exception, match="is not below"):
        write_files(definitions(spark, [(f"{root}/../evil.sql", "x", TS, "view")]), str(root))


def store(spark, base, ddl_by_name, rows_by_name):
    for name, ddl in ddl_by_name.items():
        struct = schemas.struct_type(ddl)
        rows = [tuple(r.get(f.name) for f in struct) for r in rows_by_name.get(name, [])]
        spark.createDataFrame(rows, struct).write.parquet(f"{base}/{name}")


def test_whole_run(spark, tmp_path):
    def key(name, dataset="d1"):
        return {"project": "p", "dataset": dataset, "name": name}

    store(
        spark,
        tmp_path / "snap",
        SNAPSHOT_SCHEMAS,
        {
            "listing": [
                {**key("v"), "table_type": "VIEW", "seq": 0},
                {**key("t"), "table_type": "TABLE", "seq": 1},
                {**key("x", "d2"), "table_type": "TABLE", "seq": 0},
            ],
            "table_details": [
                {**key("v"), "view_query": "SELECT 1", "schema": [], "modified": TS},
                {**key("t"), "schema": [], "num_rows": 5, "modified": TS},
                {**key("x", "d2"), "schema": [], "modified": TS},
            ],
            "routines": [{**key("f"), "seq": 0}],
            "routine_details": [{**key("f"), "body": "b", "modified": TS}],
            "transfer_configs": [
                {"project": "p", "region": "r", "display_name": "s", "params": {"query": "q"},
                 "data_source_id": "scheduled_query", "update_time": TS, "seq": 0},
                {"project": "p", "region": "other", "display_name": "z",
                 "data_source_id": "scheduled_query", "seq": 1},
            ],
        },
    )
    late = datetime(2025, 3, 1, tzinfo=UTC)
    store(
        spark,
        tmp_path / "tree",
        WORKTREE_SCHEMAS,
        {
            "local_files": [
                {"path": "/o/p/d1/models/t.yaml", "content": "kept", "kind": "table"},
                {"path": "/o/p/notes.txt", "content": "mine"},
            ],
            "commits": [{"path": "/o/p/d1/models/t.yaml", "commit_ts": late}],
        },
    )
    snapshot = load_snapshot(spark, str(tmp_path / "snap"))
    tree = load_worktree(spark, str(tmp_path / "tree"))
    options = {"project": "p", "region": "r", "root": "/o/p", "datasets": ["d1"]}
    plan = pull(snapshot, tree, str(tmp_path / "v1"), dry_run=True, **options)
    assert {(r["kind"], r["name"], r["action"]) for r in plan.collect()} == {
        ("view", "v", "fetch"), ("table", "t", "skip"), ("routine", "f", "fetch"), ("scheduled", "s", "fetch"),
    }
    assert not (tmp_path / "v1").exists()
    version = pull(snapshot, tree, str(tmp_path / "v1"), **options)
    got = {r["path"]: r["content"] for r in version.collect()}
    assert sorted(got) == [
        "/o/p/d1/models/f.yaml", "/o/p/d1/models/t.yaml", "/o/p/d1/models/v.yaml",
        "/o/p/d1/routines/f.sql", "/o/p/d1/views/v.sql", "/o/p/notes.txt", "/o/p/scheduled_queries/s.sql",
    ]
    assert got["/o/p/d1/models/t.yaml"] == "kept" and got["/o/p/d1/views/v.sql"] == "SELECT 1"
    assert got["/o/p/scheduled_queries/s.sql"] == "-- Scheduled Query: s\n-- Schedule: \n\nq"
    runs = str(tmp_path / "runs")
    append_run(tree.local_files, runs, 1)
    for _ in range(2):  # a run may be repeated
        latest = pull(snapshot, tree, runs, run=2, **options)
        assert {r["path"]: r["content"] for r in latest.collect()} == got
    assert read_runs(spark, runs).count() == 2 + 5
    version = pull(snapshot, tree, str(tmp_path / "v2"), force=True, **options)
    got = {r["path"]: r["content"] for r in version.collect()}
    assert got["/o/p/d1/models/t.yaml"].startswith("name: t\n")

    compact = pull(snapshot, replace(tree, local_files=read_runs(spark, runs)), str(tmp_path / "v4"), **options)
    assert compact.count() == compact.select("path").distinct().count() == 2 + 5
    assert not list(Path(spark.conf.get("spark.checkpoint.dir")).glob("tidemark-*"))  # no staging is left

    dirty = spark.createDataFrame([("/o/p/notes.txt", " M")], schemas.WORKTREE_STATUS)
    tree = replace(tree, worktree_status=dirty)
    for flags in ({"dry_run": True}, {"force": True}):
        with pytest.raises(UncommittedChangesError):
            pull(snapshot, tree, str(tmp_path / "v3"), **options, **flags)
    assert not (tmp_path / "v3").exists()


def test_work_folder_is_the_shared_one(spark, tmp_path):
    class Clustered:
        conf = {"spark.checkpoint.dir": "hdfs:///shared/"}

    first, second = work_folder(Clustered), work_folder(Clustered)
    assert first != second and first.startswith("hdfs:///shared/tidemark-")
    assert work_folder(Clustered, "s3a://own").startswith("s3a://own/tidemark-")
    Clustered.conf = {}
    with pytest.raises(ValueError, match="shared work folder"):
        work_folder(Clustered)


def test_scratch_is_removed_after_a_failure(spark):
    with pytest.raises(RuntimeError), scratch(spark) as folder:
        spark.range(3).write.parquet(f"{folder}/x")
        raise RuntimeError
    assert not Path(folder).exists()


@pytest.mark.parametrize("datasets", [None, ["b", "a"]])
def test_tied_run_orders_write_each_path_once(spark, tmp_path, datasets):
    """Two scheduled queries of one name without an order; listings of datasets that each start anew."""
    config = {"project": "p", "region": "r", "display_name": "a", "data_source_id": "scheduled_query", "update_time": TS}
    keys = [{"project": "p", "dataset": d, "name": "t"} for d in "ab"]
    store(
        spark,
        tmp_path / "snap",
        SNAPSHOT_SCHEMAS,
        {
            "listing": [{**k, "table_type": "VIEW", "seq": 0} for k in keys],
            "table_details": [{**k, "view_query": k["dataset"], "schema": [], "modified": TS} for k in keys],
            "transfer_configs": [{**config, "params": {"query": q}} for q in ("one", "two", "two")],
        },
    )
    store(spark, tmp_path / "tree", WORKTREE_SCHEMAS, {})
    snapshot, tree = load_snapshot(spark, str(tmp_path / "snap")), load_worktree(spark, str(tmp_path / "tree"))
    version = pull(snapshot, tree, str(tmp_path / "v"), project="p", region="r", root="/o", datasets=datasets)
    rows = {r["path"]: r["content"] for r in version.collect()}
    assert version.count() == len(rows) == 5 and rows["/o/a/views/t.sql"] == "a"
    assert rows["/o/scheduled_queries/a.sql"].split("\n")[-1] in ("one", "two")


def test_unreadable_saved_queries_are_left_out(spark, tmp_path):
    repos = [{"project": p, "region": "r", "repo": p, "display_name": f"q{p}", "seq": 0} for p in ("p", "other")]
    repos.append({"project": "p", "region": "r", "repo": "good", "display_name": "good", "seq": 1})
    store(
        spark,
        tmp_path / "snap",
        SNAPSHOT_SCHEMAS,
        {
            "repositories": repos,
            "workspaces": [{"repo": r["repo"], "workspace": r["repo"], "seq": 0} for r in repos],
            "workspace_files": [
                {"workspace": w, "path": "content.sql", "contents": c}
                for w, c in (("p", b"a\xff"), ("other", b"\xc3"), ("nowhere", b"\xfe"), ("good", "é".encode()))
            ],
        },
    )
    store(spark, tmp_path / "tree", WORKTREE_SCHEMAS, {})
    snapshot, tree = load_snapshot(spark, str(tmp_path / "snap")), load_worktree(spark, str(tmp_path / "tree"))
    version = pull(snapshot, tree, str(tmp_path / "v"), project="p", region="r", root="/o", files=False)
    assert [(r["path"], r["content"].split("\n")[-1]) for r in version.collect()] == [("/o/saved_queries/good.sql", "é")]


def test_session_conf():
    conf = session_conf(100 * 2**40, 4000)
    assert conf["spark.sql.shuffle.partitions"] == str(100 * 2**40 // (128 << 20))
    assert session_conf(1, 8)["spark.sql.shuffle.partitions"] == "8"


def damaged(rows):
    """Rows that end the job that writes one of them."""
    return rows.withColumn("content", F.expr("if(content = 'bad', raise_error('lost'), content)"))


def test_a_failed_version_can_be_repeated(spark, tmp_path):
    dest = str(tmp_path / "v")
    old = definitions(spark, [(f"/r/{i}", "old" if i else "bad", TS, "view") for i in range(40)]).repartition(8)
    none = old.limit(0)
    for _ in range(2):
        with pytest.raises(PySparkException):
            write_version(damaged(old), none, none, dest)
        with pytest.raises(FileNotFoundError):
            read_version(spark, dest)
        assert not list(Path(dest).rglob("part-*"))
    assert write_version(old, none, none, dest).count() == read_version(spark, dest).count() == 40


def test_a_failed_export_or_run_leaves_the_last_one(spark, tmp_path):
    rows = definitions(spark, [(f"/r/{i}", "new" if i else "bad", TS, "view") for i in range(40)]).repartition(8)
    broken = damaged(rows)
    dest, table = str(tmp_path / "t.csv"), str(tmp_path / "runs")
    export_table(rows, dest)
    append_run(rows, table, 7)
    for _ in range(2):
        with pytest.raises(PySparkException):
            export_table(broken, dest)
        with pytest.raises(PySparkException):
            append_run(broken, table, 7)
        assert read_export(spark, dest, rows.schema).count() == read_runs(spark, table).count() == 40
    export_table(rows.limit(3), dest)
    append_run(rows.limit(3), table, 7)
    assert read_export(spark, dest, rows.schema).count() == read_runs(spark, table).count() == 3
    for folder in (dest, table):
        assert len([p for p in Path(folder).iterdir() if p.name != POINTERS]) == 1  # nothing is left behind


def test_a_writer_that_was_lost_is_not_seen(spark, tmp_path):
    """Files of an unfinished write, and a pointer that was opened but never written."""
    dest = str(tmp_path / "t")
    first = publish(spark, dest, lambda folder: spark.range(5).write.parquet(folder))
    spark.range(9).write.parquet(f"{dest}/gen-lost")
    (tmp_path / "t" / POINTERS / f"{7:020d}.json").write_text("")
    assert current(spark, dest) == first and spark.read.parquet(first).count() == 5
    second = publish(spark, dest, lambda folder: spark.range(6).write.parquet(folder), alone=True)
    assert published(spark, dest) == {"": second} and not Path(first).exists()
    assert not (tmp_path / "t" / "gen-lost").exists()
    third = publish(spark, dest, lambda folder: spark.range(7).write.parquet(folder), name="x")
    assert published(spark, dest) == {"": second, "x": third}


def test_a_writer_that_comes_second_keeps_the_first_ones_work(spark, tmp_path):
    dest = str(tmp_path / "t")

    def slow(folder):
        publish(spark, dest, lambda inner: spark.range(2).write.parquet(inner), name="quick")
        spark.range(3).write.parquet(folder)

    publish(spark, dest, slow, name="slow")
    assert {n: spark.read.parquet(f).count() for n, f in published(spark, dest).items()} == {"quick": 2, "slow": 3}

    def late(folder):
        publish(spark, dest, lambda inner: spark.range(4).write.parquet(inner), name="v", once=True)
        spark.range(5).write.parquet(folder)

    with pytest.raises(FileExistsError):
        publish(spark, dest, late, name="v", once=True)
    assert spark.read.parquet(published(spark, dest)["v"]).count() == 4


def test_text_files_come_last(spark, tmp_path):
    """A run whose version can't be written leaves the text files alone."""
    root = tmp_path / "out"
    config = {"project": "p", "region": "r", "display_name": "a", "data_source_id": "scheduled_query", "update_time": TS}
    store(spark, tmp_path / "snap", SNAPSHOT_SCHEMAS, {"transfer_configs": [{**config, "params": {"query": "one"}}]})
    store(spark, tmp_path / "tree", WORKTREE_SCHEMAS, {"local_files": [{"path": f"{root}/x", "content": "bad", "kind": "view"}]})
    snapshot, tree = load_snapshot(spark, str(tmp_path / "snap")), load_worktree(spark, str(tmp_path / "tree"))
    broken = replace(tree, local_files=damaged(tree.local_files))
    options = {"project": "p", "region": "r", "root": str(root), "files": True}
    with pytest.raises(PySparkException):
        pull(snapshot, broken, str(tmp_path / "v"), **options)
    assert not root.exists()
    assert pull(snapshot, tree, str(tmp_path / "v"), **options).count() == 2
    assert (root / "scheduled_queries/a.sql").read_text().endswith("one")


def test_files_below_an_address(spark, tmp_path):
    root = f"file://{tmp_path}/out"
    write_files(definitions(spark, [(f"{root}/ds/views/é v.sql", "é\r\n", TS, "view")]), root)
    assert (tmp_path / "out/ds/views/é v.sql").read_bytes() == "é\r\n".encode()
    with pytest.raises(Exception, match="is not below"):
        write_files(definitions(spark, [(f"{tmp_path}/out/x.sql", "x", TS, "view")]), root)
    base = str(tmp_path)

    def bucket():  # stands for an object store: no renames, no folders
        return fs.SubTreeFileSystem(base, fs.LocalFileSystem())

    bucket().create_dir("lake/out/ds")
    write_files(definitions(spark, [("s3a://lake/out/ds/q.sql", "q", TS, "view")]), "s3a://lake/out", bucket)
    assert (tmp_path / "lake/out/ds/q.sql").read_text() == "q"


def commits_of(spark, rows):
    return spark.createDataFrame(rows, schemas.COMMITS)


def test_kept_state(spark, tmp_path):
    dest, day = str(tmp_path / "state"), lambda d: datetime(2025, 1, d, tzinfo=UTC)
    files = spark.createDataFrame([("/a",), ("/b",), ("/a",), (None,)], "path STRING")
    commits = commits_of(spark, [("/a", day(5), 1), ("/a", day(3), 2), ("/b", day(4), None), ("/c", day(1), None)])

    def content():
        rows = read_state(spark, dest).collect()
        return {r["path"]: (r["file_present"], r["committed"] and r["committed"].astimezone(UTC).day) for r in rows}

    create_state(files, commits, dest, buckets=3)
    assert content() == {"/a": (True, 3), "/b": (True, 4), "/c": (False, 1)}
    with pytest.raises(FileExistsError):
        create_state(files, commits, dest, buckets=3)
    for _ in range(2):  # a merge may be repeated
        merge_state(
            spark, dest, files=spark.createDataFrame([("/c",), ("/d",)], "path STRING"),
            removed=spark.createDataFrame([("/b",), ("/d",)], "path STRING"),
            commits=commits_of(spark, [("/a", day(9), 1), ("/b", day(2), None), ("/e", day(7), 3)]),
        )
        assert content() == {"/a": (True, 3), "/b": (False, 4), "/c": (True, 1), "/d": (True, None), "/e": (False, 7)}
    lost = spark.createDataFrame([("/z",)], "path STRING").withColumn("path", F.expr("CAST(raise_error('lost') AS STRING)"))
    with pytest.raises(PySparkException):
        merge_state(spark, dest, files=lost)
    assert len(content()) == 5
    with pytest.raises(FileNotFoundError):
        read_state(spark, str(tmp_path / "none"))


def test_a_run_with_a_kept_state(spark, tmp_path):
    config = {"project": "p", "region": "r", "data_source_id": "scheduled_query", "update_time": TS}
    configs = [{**config, "display_name": n, "params": {"query": n}} for n in "ab"]
    store(spark, tmp_path / "snap", SNAPSHOT_SCHEMAS, {"transfer_configs": configs})
    store(spark, tmp_path / "tree", WORKTREE_SCHEMAS, {})
    snapshot, tree = load_snapshot(spark, str(tmp_path / "snap")), load_worktree(spark, str(tmp_path / "tree"))
    state = str(tmp_path / "state")
    files = spark.createDataFrame([("/o/scheduled_queries/a.sql",)], "path STRING")
    create_state(files, commits_of(spark, [("/o/scheduled_queries/a.sql", datetime(2026, 1, 1, tzinfo=UTC), None)]), state, buckets=2)
    options = {"project": "p", "region": "r", "root": "/o", "state": state}
    version = pull(snapshot, tree, str(tmp_path / "v1"), **options)
    assert [r["path"] for r in version.collect()] == ["/o/scheduled_queries/b.sql"]
    plan = pull(snapshot, tree, str(tmp_path / "v2"), dry_run=True, **options).collect()
    assert {r["name"]: r["reason"] for r in plan} == {"a": "up_to_date", "b": "uncommitted"}


def test_files_are_listed_and_read_in_tasks(spark, tmp_path):
    from tidemark.sinks.definitions import read_files, write_files

    for scheme in ("", "file://"):
        root = f"{scheme}{tmp_path}/{len(scheme)}"
        names = [f"{root}/d{i % 7}/{'deep/' * (i % 3)}f{i}.sql" for i in range(400)] + [f"{root}/_top", f"{root}/empty"]
        want = {n: "" if n.endswith("empty") else f"é {n}\r\n" for n in names}
        write_files(spark.createDataFrame(list(want.items()), "path STRING, content STRING").coalesce(1), root)
        files = read_files(spark, root)
        assert {r["path"]: bytes(r["content"]).decode() for r in files.collect()} == want
        # No source of Spark's that lists files on the driver, and no more tasks for more files.
        assert not files.inputFiles() and files.rdd.getNumPartitions() == 4 * spark.sparkContext.defaultParallelism
