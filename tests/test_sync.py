"""Sync plans against a one-by-one run in plain Python, and their behaviour on hot paths."""

from __future__ import annotations

import random
import re
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.paths import KINDS
from tidemark.operators.decision import with_forced
from tidemark.operators.history import last_commit
from tidemark.plans.apply import applied, object_writes, staged_records
from tidemark.plans.inventory import located
from tidemark.plans.sync import path_state, sync_plan
from tidemark.session import scratch
from tidemark.sinks.definitions import write_version
from tidemark.sinks.export import export_requests

UTC = timezone.utc
START = datetime(2025, 1, 1, tzinfo=UTC)
ROOT = "/r"
SCOPE = ["b", "a"]


def make_objects(rnd, n):
    """Objects with few names, so that many share a path."""
    seqs = list(range(n))
    rnd.shuffle(seqs)
    objects = []
    for seq in seqs:
        kind = rnd.choice(KINDS)
        objects.append(
            {
                "kind": kind,
                "dataset": rnd.choice(SCOPE) if kind in KINDS[:4] else None,
                "name": f"n{rnd.randrange(max(2, n // 4))}",
                "seq": seq,
                "modified": START + timedelta(hours=rnd.randrange(40)),
                "sql": f"sql {seq}",
            }
        )
    return objects


def paths_of(obj):
    home = f"{ROOT}/{obj['dataset']}"
    name = obj["name"]
    gated = {
        "view": f"{home}/views/{name}.sql",
        "routine": f"{home}/routines/{name}.sql",
        "table": f"{home}/models/{name}.yaml",
        "external": f"{home}/models/{name}.yaml",
        "scheduled": f"{ROOT}/scheduled_queries/{name}.sql",
        "saved": f"{ROOT}/saved_queries/{name}.sql",
    }[obj["kind"]]
    paired = obj["kind"] in ("view", "routine")
    return gated, (f"{home}/models/{name}.yaml" if paired else None)


def in_run_order(objects):
    def position(obj):
        dataset = SCOPE.index(obj["dataset"]) if obj["dataset"] else len(SCOPE)
        return dataset, KINDS.index(obj["kind"]), obj["seq"]

    return sorted(objects, key=position)


def one_by_one(objects, files, commits, force, force_files, dry_run):
    """Actions by seq, and the object whose text each path ends up with."""
    present, actions, owner = set(files), {}, {}
    for obj in in_run_order(objects):
        gated, model = paths_of(obj)
        listed = force_files is None or gated in force_files or gated.split("/")[-1] in force_files
        last = max((ts for p, ts in commits if p == gated), default=None)
        if (force and listed) or gated not in present:
            outcome = "fetch"
        elif last is None:
            outcome = "warn"
        else:
            outcome = "fetch" if obj["modified"] > last else "skip"
        actions[obj["seq"]] = outcome
        if outcome == "fetch" and not dry_run:
            for path in filter(None, (gated, model)):
                present.add(path)
                owner[path] = obj["seq"]
    return actions, owner


@pytest.mark.parametrize(
    ("seed", "force", "listed"),
    [(0, False, False), (1, False, False), (2, True, True), (3, True, False), (4, False, True)],
)
def test_plan_equals_one_by_one(spark, tmp_path, seed, force, listed):
    rnd = random.Random(seed)
    objects = make_objects(rnd, 60)
    possible = sorted({p for o in objects for p in paths_of(o) if p})
    files = rnd.sample(possible, len(possible) // 2) + [f"{ROOT}/a/views/gone.sql", f"{ROOT}/notes.txt", "/else/views/x.sql", f"{ROOT}/a/models/old.yaml"]
    commits = [
        (p, START + timedelta(hours=rnd.randrange(40)))
        for p in possible + files[-1:]
        for _ in range(rnd.choice([0, 1, 3]))
    ]
    struct = schemas.StructType(
        [f for f in schemas.struct_type(schemas.INVENTORY) if f.name in objects[0]]
    )
    records = located(
        spark.createDataFrame([tuple(o[f.name] for f in struct) for o in objects], struct),
        ROOT,
        SCOPE,
    )
    records = staged_records(records, str(tmp_path / "inventory"))
    local = spark.createDataFrame([(p, f"old {p}") for p in files], "path STRING, content STRING")
    history = spark.createDataFrame(commits, "path STRING, commit_ts TIMESTAMP")
    force_files = None
    if listed:
        force_files = rnd.sample(possible, 3) + [rnd.choice(possible).split("/")[-1]]
    for dry_run in (False, True):
        expected, owner = one_by_one(objects, files, commits, force, force_files, dry_run)
        options = {"force": force, "force_files": force_files, "dry_run": dry_run}
        plan = sync_plan(records, local, history, **options)
        assert {r["seq"]: r["action"] for r in plan.select("seq", "action").collect()} == expected
        whole = sync_plan(records, local, history, include_deleted=True, root=ROOT, **options)
        gone = whole.filter("kind IS NULL").select("path", "action", "reason").collect()
        assert sorted(r["path"] for r in gone) == [f"{ROOT}/a/models/old.yaml", f"{ROOT}/a/views/gone.sql"]
        assert {(r["action"], r["reason"]) for r in gone} == {("warn", "deleted_at_source")}
        if dry_run:
            continue
        writes, fetched = applied(plan, records, str(tmp_path / "work"))
        merged = write_version(local, writes, fetched, str(tmp_path / "version")).collect()
        assert len(merged) == len({r["path"] for r in merged}) == len(set(files) | set(owner))
        modified = {o["seq"]: o["modified"] for o in objects}
        for row in merged:
            if row["path"] not in owner:
                assert row["content"] == f"old {row['path']}"
                continue
            seq = owner[row["path"]]
            assert row["modified"].astimezone(UTC) == modified[seq]
            if row["path"].endswith(".sql"):
                assert row["content"].endswith(f"sql {seq}")


def test_later_object_sees_the_history_of_a_missing_file(spark):
    """The file was deleted but has commits: the second object compares with them."""
    records = located(
        spark.createDataFrame(
            [("saved", "q", i, START + timedelta(hours=h)) for i, h in enumerate((0, 2, 9))],
            "kind STRING, name STRING, seq BIGINT, modified TIMESTAMP",
        ),
        ROOT,
    )
    none = spark.createDataFrame([], "path STRING, content STRING")
    commits = spark.createDataFrame([(f"{ROOT}/saved_queries/q.sql", START + timedelta(hours=5), None)], schemas.COMMITS)
    plan = sync_plan(records, none, commits)
    assert {r["seq"]: r["reason"] for r in plan.collect()} == {0: "new", 1: "up_to_date", 2: "source_newer"}


def test_listing_order_may_be_missing(spark):
    records = located(
        spark.createDataFrame([("saved", "a", START), ("saved", "b", START)], "kind STRING, name STRING, modified TIMESTAMP")
        .selectExpr("*", "CAST(NULL AS BIGINT) AS seq"),
        ROOT,
    )
    files = spark.createDataFrame([(f"{ROOT}/saved_queries/b.sql", "x")], "path STRING, content STRING")
    plan = sync_plan(records, files, spark.createDataFrame([], schemas.COMMITS))
    assert {r["name"]: r["reason"] for r in plan.collect()} == {"a": "new", "b": "uncommitted"}


def hot_records(spark, n):
    """A third of all objects have one name."""
    name = F.when(F.col("id") % 3 == 0, F.lit("untitled")).otherwise(F.concat(F.lit("q"), F.col("id")))
    return located(
        spark.range(0, n, 1, 8).select(
            F.lit("scheduled").alias("kind"),
            name.alias("name"),
            F.col("id").alias("seq"),
            F.timestamp_seconds(F.col("id")).alias("modified"),
            F.repeat(F.col("id").cast("string"), 5).alias("sql"),
        ),
        ROOT,
    )


@pytest.fixture
def small_partitions(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def final_plan(df):
    text = df._jdf.queryExecution().toString()
    return text[text.index("== Physical Plan ==") :].split("== Initial Plan ==")[0]


def test_hot_path_is_split_in_the_lookup(spark, small_partitions):
    n = 60_000
    records = hot_records(spark, n)
    none = spark.createDataFrame([], "path STRING, content STRING")
    commits = spark.createDataFrame([], schemas.COMMITS)
    plan = sync_plan(records, none, commits)
    rows = plan.select("path", "reason", "sql").collect()
    assert len(rows) == n
    assert sum(r["reason"] == "uncommitted" for r in rows) == n // 3 - 1
    plan = plan.select("path", "reason", "sql")
    plan.collect()
    assert "skew=true" in final_plan(plan)


def test_hot_path_is_cut_down_before_the_shuffle(spark, small_partitions):
    n = 30_000
    records = hot_records(spark, n)
    none = spark.createDataFrame([], "path STRING, content STRING")
    plan = sync_plan(records, none, spark.createDataFrame([], schemas.COMMITS), force=True)
    with scratch(spark) as folder:
        staged = staged_records(records, f"{folder}/inventory")
        writes = object_writes(plan.drop("id"), staged)
        fetched = applied(plan, staged, folder)[1]
        assert fetched.count() == n - n // 3 + 1
        hot = fetched.filter("path LIKE '%/untitled.sql'").collect()
        assert len(hot) == 1 and hot[0]["modified"].timestamp() == n - 3
        text = writes._jdf.queryExecution().toString()
        assert "partial_max(run_order" in text and "collect_set" not in text and "Window" not in text


def test_hot_destination_is_split(spark, small_partitions):
    n = 60_000
    requests = spark.range(0, n, 1, 8).selectExpr(
        "concat('p/d', id, '/', if(id % 3 = 0, 'hot', concat('t', id))) AS model"
    )
    got = export_requests(requests, "/o/data")
    assert got.filter(f"same_dest = {n // 3} AND dest = '/o/data/hot.csv'").count() == n // 3
    got.collect()
    assert "skew=true" in final_plan(got)


def test_hot_file_name_is_split_when_forced(spark, small_partitions):
    """A table of forced names, one of which a third of all objects have."""
    n = 60_000
    names = spark.createDataFrame([("untitled.sql",), ("q1.sql",)], "name STRING")
    marked = with_forced(hot_records(spark, n).select("path", "sql"), True, names)
    assert marked.filter("forced").count() == n // 3 + 1
    marked.collect()
    assert "skew=true" in final_plan(marked)


def test_decision_moves_no_texts(spark, small_partitions):
    records = hot_records(spark, 1000)
    none = spark.createDataFrame([], "path STRING, content STRING")
    with scratch(spark) as folder:
        records = staged_records(records, f"{folder}/inventory")
        plan = sync_plan(records, none, spark.createDataFrame([], schemas.COMMITS))
        writes = object_writes(plan, records)
        assert writes.count() == 667
        read = re.findall(r"ReadSchema: struct<(.*?)>", writes._jdf.queryExecution().toString())
        assert read and not any("sql:" in columns or "schema:" in columns for columns in read)


def test_state_is_shuffled_once(spark, small_partitions):
    records = hot_records(spark, 1000)
    files = spark.range(500).selectExpr("concat('/r/scheduled_queries/q', id, '.sql') AS path", "'' AS content")
    commits = files.selectExpr("path", "timestamp_seconds(100) AS commit_ts")
    plan = sync_plan(records, files, commits, include_deleted=True)
    plan.collect()
    assert "ReusedExchange" in final_plan(plan)


def test_forced_run_needs_no_join(spark):
    records = hot_records(spark, 100)
    none = spark.createDataFrame([], "path STRING, content STRING")
    plan = sync_plan(records, none, spark.createDataFrame([], schemas.COMMITS), force=True)
    assert {r["reason"] for r in plan.collect()} == {"forced"}
    assert "Join" not in final_plan(plan) and "Exchange" not in final_plan(plan)


def test_last_commit_is_that_of_the_log(spark):
    """A commit with an earlier time may be the last one; without a log order the latest time is."""
    rows = [("a", 9, 1), ("a", 5, 2), ("a", 7, None), ("b", 3, None), ("b", 4, None), ("c", None, 1)]
    commits = spark.createDataFrame([(p, h and START + timedelta(hours=h), o) for p, h, o in rows], schemas.COMMITS)

    def hours(df):
        return {r["path"]: r["committed"] and (r["committed"].astimezone(UTC) - START).seconds // 3600 for r in df.collect()}

    assert hours(last_commit(commits)) == {"a": 5, "b": 4, "c": None}
    assert hours(last_commit(commits.drop("log_order"))) == {"a": 9, "b": 4, "c": None}
    files = commits.select("path").distinct()
    assert hours(path_state(files, commits)) == {"a": 5, "b": 4, "c": None}
    assert hours(path_state(files, commits.drop("log_order"))) == {"a": 9, "b": 4, "c": None}


def test_files_and_commits_are_not_sorted_by_path(spark):
    files = spark.createDataFrame([("/a",), ("/b",), (None,)], "path STRING")
    commits = spark.createDataFrame([("/a", None, 1), ("/c", None, None)], "path STRING, commit_ts TIMESTAMP, log_order BIGINT")
    touched = spark.createDataFrame([("/a", (1, 2, 3)), ("/d", (1, 2, 2)), ("/d", (1, 1, 9)), (None, (0, 0, 0))], f"path STRING, run_order {schemas.RUN_ORDER}")
    state = path_state(files, commits, touched)
    got = {r["path"]: (r["file_present"], r["first_object"] and tuple(r["first_object"])) for r in state.collect()}
    assert got == {"/a": (True, (1, 2, 3)), "/b": (True, None), "/c": (False, None), "/d": (False, (1, 1, 9))}
    sorting = [line for line in final_plan(state).splitlines() if "SortAggregate" in line]
    assert sorting and not any("is_file" in line for line in sorting)
