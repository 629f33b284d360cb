"""Decision matrix, force switches, history and worktree."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pytest

from tidemark.operators import decision
from tidemark.operators.history import (
    UncommittedChangesError,
    last_commit,
    require_clean,
    uncommitted_changes,
)

UTC = timezone.utc
OLD = datetime(2024, 1, 1, tzinfo=UTC)
MID = datetime(2025, 1, 1, tzinfo=UTC)
NEW = datetime(2025, 6, 1, tzinfo=UTC)

MATRIX = [
    (NEW, False, None, False, "new", "fetch"),
    (NEW, True, None, False, "uncommitted", "warn"),
    (OLD, True, MID, False, "up_to_date", "skip"),
    (NEW, True, MID, False, "source_newer", "fetch"),
    (None, False, None, False, "absent", "skip"),
    (None, True, None, False, "deleted_at_source", "warn"),
    (OLD, True, MID, True, "forced", "fetch"),
    (NEW, False, None, True, "forced", "fetch"),
    (None, False, None, True, "forced", "fetch"),
    (MID, True, MID, False, "up_to_date", "skip"),
    (MID + timedelta(milliseconds=500), True, MID, False, "source_newer", "fetch"),
    (None, True, MID, False, "deleted_at_source", "warn"),
    (NEW, False, MID, False, "new", "fetch"),
]


def test_matrix(spark):
    rows = [(i, *row) for i, row in enumerate(MATRIX)]
    df = spark.createDataFrame(
        rows,
        "i INT, modified TIMESTAMP, present BOOLEAN, committed TIMESTAMP, forced BOOLEAN, "
        "reason STRING, action STRING",
    )
    why = decision.reason(
        "modified", "committed", "present", forced="forced", source_present="modified IS NOT NULL"
    )
    got = df.selectExpr("i", "reason", "action", f"{why} AS got").selectExpr(
        "*", f"{decision.action('got')} AS got_action"
    )
    for row in got.collect():
        assert (row["got"], row["got_action"]) == (row["reason"], row["action"]), MATRIX[row["i"]]


PATHS = ["/r/a/views/v.sql", "/r/b/views/v.sql", "/r/a/models/t.yaml"]


def forced(spark, force, force_files):
    records = spark.createDataFrame([(p,) for p in PATHS], "path STRING")
    marked = decision.with_forced(records, force, force_files)
    assert marked.columns == ["path", "forced"]
    return {r["path"] for r in marked.collect() if r["forced"]}


@pytest.mark.parametrize(
    ("force", "files", "expected"),
    [
        (False, None, []),
        (False, ["v.sql"], []),
        (True, None, PATHS),
        (True, [], []),
        (True, ["v.sql"], PATHS[:2]),
        (True, ["/r/a/views/v.sql"], PATHS[:1]),
        (True, ["t.yaml", "/r/b/views/v.sql", "/x/t.yaml"], PATHS[1:]),
        (True, ["views/v.sql", "t"], []),
    ],
)
def test_force(spark, force, files, expected):
    assert forced(spark, force, files) == set(expected)
    if files is not None:
        table = spark.createDataFrame([(f,) for f in files * 2], "name STRING")
        assert forced(spark, force, table) == set(expected)


def test_last_commit(spark):
    commits = spark.createDataFrame([("a", OLD), ("a", NEW), ("a", MID), ("b", MID)], "path STRING, commit_ts TIMESTAMP")
    got = {r["path"]: r["committed"].astimezone(UTC) for r in last_commit(commits).collect()}
    assert got == {"a": NEW, "b": MID}


@pytest.mark.parametrize(
    ("status", "dirty"),
    [
        ([], False),
        ([("/r/p/a.sql", " M")], True),
        ([("/r/p/new.sql", "??")], True),
        ([("/r/p", "??")], True),
        ([("/r/px/a.sql", " M"), ("/other", " M"), ("/r", " M")], False),
    ],
)
def test_worktree(spark, status, dirty):
    df = spark.createDataFrame(status, "path STRING, status STRING")
    assert uncommitted_changes(df, "/r/p").first()["dirty"] is dirty
    files = spark.createDataFrame([("/r/p/a.sql",)], "path STRING")
    none = spark.createDataFrame([("/r/px/a.sql",)], "path STRING")
    require_clean(df, none, "/r/p")
    if dirty:
        with pytest.raises(UncommittedChangesError):
            require_clean(df, files, "/r/p")
    else:
        require_clean(df, files, "/r/p")
