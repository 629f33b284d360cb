"""What the version history and the worktree say about the synced copy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class UncommittedChangesError(RuntimeError):
    """The synced copy has uncommitted changes."""


def last_commit(commits: DataFrame) -> DataFrame:
    """Time of each path's last commit: ``path, committed``."""
    return commits.groupBy("path").agg(committed(commits).alias("committed"))


def committed(commits: DataFrame) -> Column:
    """Aggregate: time of the last commit in log order, which need not be the latest time.

    Merged and rewritten histories put commits behind others with later times. A
    log that states no order is ordered by time; commits without a place in it
    come before all others.
    """
    if "log_order" not in commits.columns:
        return F.max("commit_ts")
    return F.coalesce(F.max_by("commit_ts", "log_order"), F.max("commit_ts"))


def under_root(path: Column, root: str) -> Column:
    return (path == root) | path.startswith(root.rstrip("/") + "/")


def uncommitted_changes(worktree_status: DataFrame, root: str) -> DataFrame:
    """One row: does anything at or below ``root`` differ from the last commit?

    Untracked files count as well.
    """
    return worktree_status.agg(
        F.coalesce(F.bool_or(under_root(F.col("path"), root)), F.lit(False)).alias("dirty")
    )


def uncommitted_by_root(worktree_status: DataFrame, roots: Sequence[str]) -> DataFrame:
    """``root, dirty`` for several roots, from one pass over the status."""
    flags = [F.coalesce(F.bool_or(under_root(F.col("path"), r)), F.lit(False)) for r in roots]
    rows = F.array(*[F.struct(F.lit(r).alias("root"), flag.alias("dirty")) for r, flag in zip(roots, flags, strict=True)])
    return worktree_status.agg(rows.alias("rows")).select(F.inline("rows"))


def require_clean(worktree_status: DataFrame, local_files: DataFrame, root: str) -> None:
    """Raise if the copy below ``root`` exists and has uncommitted changes."""
    below = under_root(F.col("path"), root)
    changed = worktree_status.filter(below).select("path")
    if not local_files.filter(below).select("path").isEmpty() and not changed.isEmpty():
        raise UncommittedChangesError(
            f"{root} is not clean; a sync would mix its files with changes that no commit has"
        )
