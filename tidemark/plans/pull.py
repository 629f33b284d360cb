"""A whole run: check, list, plan, and write the next version."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tidemark import schemas
from tidemark.operators.history import require_clean
from tidemark.plans.apply import applied, staged_records
from tidemark.plans.inventory import Scope, inventory
from tidemark.plans.sync import sync_plan
from tidemark.session import scratch
from tidemark.sinks.definitions import (
    append_run,
    current_files,
    latest_definitions,
    read_runs,
    write_files,
    write_version,
)
from tidemark.sources.snapshot import Snapshot, Worktree
from tidemark.sources.state import merge_state, read_state


def pull(
    snapshot: Snapshot,
    worktree: Worktree,
    dest: str,
    *,
    project: str,
    region: str,
    root: str,
    datasets: Scope = None,
    dry_run: bool = False,
    force: bool = False,
    force_files: Sequence[str] | DataFrame | None = None,
    run: int | None = None,
    work: str | None = None,
    files: bool = False,
    state: str | None = None,
) -> DataFrame:
    """Write the next version of the synced set to ``dest`` and return it.

    Without ``run`` that is a new version with all files; if the worktree's files
    are a table of runs, the last one of each path counts. With ``run``, ``dest``
    is a table of runs that only gains the fetched files. Its runs before
    ``run`` then are the synced copy, whatever files ``worktree`` has, so a run
    that is repeated gives the same again.

    A dry run returns the plan and writes nothing. Either kind refuses to run
    on a copy with uncommitted changes, forced or not. A real run stores the
    inventory, which it reads several times, and then what to write, below
    ``work`` or ``spark.checkpoint.dir``, and removes both at the end. The
    decision moves no texts. A run that fails publishes nothing and can be
    repeated. ``files=True`` also writes the fetched files as text files below
    ``root``, when the version is there. With ``state``, the place of a kept
    state, the plan goes by that instead of all files and commits, and the
    written files are merged into it at the end.
    """
    spark = worktree.local_files.sparkSession
    kept = read_state(spark, state) if state else None
    local = worktree.local_files if run is None else read_runs(spark, dest, before=run)
    require_clean(worktree.worktree_status, local, root)
    records = inventory(snapshot, project, region, root, datasets)
    options = {"force": force, "force_files": force_files, "dry_run": dry_run, "kept": kept}
    if dry_run:
        return sync_plan(records, local, worktree.commits, **options)
    with scratch(spark, work) as folder:
        records = staged_records(records, f"{folder}/inventory")
        plan = sync_plan(records, local, worktree.commits, **options)
        writes, fetched = applied(plan, records, folder)
        if run is None:
            version = write_version(current_files(local), writes, fetched, dest)
        else:
            append_run(fetched, dest, run)
            version = latest_definitions(read_runs(spark, dest))
        if files:
            write_files(fetched, root)
        if state:
            merge_state(spark, state, files=writes)
    return version
