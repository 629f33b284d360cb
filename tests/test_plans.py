"""Physical plans over stored snapshot tables."""

from __future__ import annotations

import re

import pytest

from test_sinks import store
from tidemark import schemas
from tidemark.plans.inventory import in_scope, inventory, located, run_order
from tidemark.plans.sync import sync_plan
from tidemark.session import staged
from tidemark.sources.snapshot import (
    SNAPSHOT_SCHEMAS,
    WORKTREE_SCHEMAS,
    load_snapshot,
    load_worktree,
)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("stored")
    key = {"project": "p", "dataset": "d1", "name": "t"}
    rows = {"listing": [{**key, "table_type": "TABLE", "seq": 0}], "table_details": [key]}
    store(spark, base / "snap", SNAPSHOT_SCHEMAS, rows)
    store(spark, base / "tree", WORKTREE_SCHEMAS, {})
    return load_snapshot(spark, str(base / "snap")), load_worktree(spark, str(base / "tree"))


def scans(spark, df):
    """Pushed filters and read columns of each scanned table."""
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(mode)
    found = re.findall(r"Location: \S+ \[\S*/(\w+)\]\n(?:PushedFilters: \[(.*)\]\n)?ReadSchema: struct<(.*)>", text)
    return {
        table: (filters, {c.split(":")[0] for c in columns.split(",")})
        for table, filters, columns in found
    }


def test_filters_and_columns_reach_the_scans(spark, stored):
    snapshot, tree = stored
    records = inventory(snapshot, "p", "r", "/o", ["d1", "d2"])
    plan = sync_plan(records, tree.local_files, tree.commits, dry_run=True)
    got = scans(spark, plan.select("path", "action"))
    assert "In(table_type, [EXTERNAL,TABLE,VIEW])" in got["listing"][0]
    assert "In(dataset, [d1,d2])" in got["table_details"][0]
    assert "EqualTo(data_source_id,scheduled_query)" in got["transfer_configs"][0]
    assert "EqualTo(path,content.sql)" in got["workspace_files"][0]
    assert got["table_details"][1] == {"project", "dataset", "name", "modified"}
    assert got["local_files"][1] == {"path"}
    assert got["workspace_files"][1] == {"workspace", "path", "contents"}  # to leave out what isn't text


def test_staged_rows_are_pruned_by_kind(spark, stored, tmp_path):
    rows = staged(inventory(stored[0], "p", "r", "/o"), schemas.INVENTORY, str(tmp_path / "staged"), "kind")
    plan = rows.filter("kind IN ('table', 'external')").select("path")._jdf.queryExecution().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*kind", plan)
    assert rows.columns == schemas.struct_type(schemas.INVENTORY).names


@pytest.mark.parametrize("scope", [None, ["b", "a"], ["it's"]])
def test_run_order(spark, scope):
    rows = [("view", "b", 5), ("view", "b", 6), ("routine", "b", 1), ("table", "b", 0), ("external", "b", 0)]
    if scope:
        rows = [(k, scope[0], s) for k, _, s in rows]
        rows += [("view", d, 2**63 - 1) for d in scope[1:]] + [("table", d, 0) for d in scope[1:]]
    rows += [("scheduled", None, 0), ("scheduled", None, 2**63 - 1), ("saved", None, 0)]
    df = spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows)], "i INT, kind STRING, dataset STRING, seq BIGINT"
    )
    order = df.selectExpr("i", f"{run_order('kind', 'dataset', 'seq', scope)} AS o").collect()
    assert [r["i"] for r in sorted(order, key=lambda r: r["o"])] == list(range(len(rows)))
    assert len({r["o"] for r in order}) == len(rows)


@pytest.mark.parametrize("as_table", [False, True])
def test_a_hundred_thousand_datasets(spark, stored, as_table):
    """No list of names in the plan, and no limit to the order."""
    snapshot, tree = stored
    names = [f"x{i}" for i in range(99_999)] + ["d1"]
    scope = names
    if as_table:
        scope = spark.range(100_000).selectExpr("if(id = 99999, 'd1', concat('x', id)) AS dataset", "id + 1 AS position")
    records = inventory(snapshot, "p", "r", "/o", scope)
    plan = sync_plan(records, tree.local_files, tree.commits)
    rows = plan.select("path", "action", "run_order").collect()
    assert [(r["path"], r["action"], r["run_order"]["stage"]) for r in rows] == [("/o/d1/models/t.yaml", "fetch", 399_998)]
    text = records._jdf.queryExecution().optimizedPlan().toString()
    assert "x99" not in re.sub(r"LocalRelation .*", "", text) and "INSET" not in text.upper()


def test_repeated_names_in_a_scope_table(spark):
    scope = spark.createDataFrame([("b", 1), ("a", 2), ("b", 3)], "dataset STRING, position INT")
    objects = spark.createDataFrame([("table", d, "t") for d in "abc"], "kind STRING, dataset STRING, name STRING")
    rows = located(in_scope(objects, scope).selectExpr("*", "0L AS seq"), "/o", scope).collect()
    assert {r["dataset"]: r["run_order"]["stage"] for r in rows} == {"b": 2, "a": 6}


def test_a_real_plan_reads_no_texts_to_order_objects(spark, stored):
    snapshot, tree = stored
    got = scans(spark, sync_plan(inventory(snapshot, "p", "r", "/o"), tree.local_files, tree.commits).select("path", "action"))
    for table in ("table_details", "routine_details"):
        assert got[table][1] <= {"project", "dataset", "name", "modified"}


def test_a_plan_from_a_kept_state_leaves_it_where_it_is(spark, stored, tmp_path):
    from tidemark.sources.state import create_state

    snapshot, _ = stored
    files = spark.range(5000).selectExpr("concat('/o/d1/models/t', id, '.yaml') AS path")
    commits = files.selectExpr("path", "timestamp_seconds(1) AS commit_ts")
    kept = create_state(files, commits, str(tmp_path / "state"), buckets=6)
    records = inventory(snapshot, "p", "r", "/o")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = sync_plan(records, None, None, kept=kept).select("path", "reason")
        text = plan._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    lines = text.split("\n")
    depths = [re.search(r"[+:]- |$", line).start() for line in lines]
    at = [i for i, line in enumerate(lines) if "tidemark_state_" in line]
    assert at
    for i in at:
        assert "Bucketed: true" in lines[i]
        while "Join" not in lines[i]:  # from the scan up to the first join
            i = next(j for j in range(i - 1, -1, -1) if depths[j] < depths[i])
            assert "Exchange" not in lines[i]
