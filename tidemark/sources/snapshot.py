"""Input tables of a sync run."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession

from tidemark import schemas


@dataclass(frozen=True)
class Snapshot:
    """Raw tables that describe the source catalog at one moment."""

    listing: DataFrame
    table_details: DataFrame
    routines: DataFrame
    routine_details: DataFrame
    transfer_configs: DataFrame
    repositories: DataFrame
    workspaces: DataFrame
    workspace_files: DataFrame


SNAPSHOT_SCHEMAS = {
    "listing": schemas.LISTING,
    "table_details": schemas.TABLE_DETAILS,
    "routines": schemas.ROUTINE_LISTING,
    "routine_details": schemas.ROUTINE_DETAILS,
    "transfer_configs": schemas.TRANSFER_CONFIGS,
    "repositories": schemas.REPOSITORIES,
    "workspaces": schemas.WORKSPACES,
    "workspace_files": schemas.WORKSPACE_FILES,
}


@dataclass(frozen=True)
class Worktree:
    """State of the synced copy: its files, their commits, uncommitted changes."""

    local_files: DataFrame
    commits: DataFrame
    worktree_status: DataFrame


WORKTREE_SCHEMAS = {
    "local_files": schemas.LOCAL_FILES,
    "commits": schemas.COMMITS,
    "worktree_status": schemas.WORKTREE_STATUS,
}


def load_snapshot(spark: SparkSession, base: str) -> Snapshot:
    """Parquet tables at ``<base>/<table name>``, read with the declared schemas."""
    return Snapshot(**_load(spark, base, SNAPSHOT_SCHEMAS, [f.name for f in fields(Snapshot)]))


def load_worktree(spark: SparkSession, base: str) -> Worktree:
    return Worktree(**_load(spark, base, WORKTREE_SCHEMAS, [f.name for f in fields(Worktree)]))


def _load(
    spark: SparkSession, base: str, ddl: dict[str, str], names: list[str]
) -> dict[str, DataFrame]:
    return {n: spark.read.schema(ddl[n]).parquet(f"{base.rstrip('/')}/{n}") for n in names}
