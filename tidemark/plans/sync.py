"""The sync plan: which objects to fetch, which to skip, which to warn about."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.paths import is_definition
from tidemark.operators.decision import action, reason, with_forced
from tidemark.operators.history import committed
from tidemark.operators.pick import lookup

# Fixed value: a run order no object reaches.
BEHIND_ALL = f"named_struct({', '.join(f"'{name}', {(1 << 63) - 1}L" for name in ('stage', 'seq', 'tie'))})"

FILE_PRESENT = "coalesce(file_present, false)"


def sync_plan(
    records: DataFrame,
    local_files: DataFrame | None,
    commits: DataFrame | None,
    *,
    force: bool = False,
    force_files: Sequence[str] | DataFrame | None = None,
    dry_run: bool = False,
    include_deleted: bool = False,
    root: str | None = None,
    kept: DataFrame | None = None,
) -> DataFrame:
    """Inventory rows with ``action``, ``reason`` and the ``committed`` time compared with.

    Several objects may share a path (two queries of one name, a table and a
    routine of one name). In a real run the first of them to be written makes
    the file exist for those behind it; ``dry_run=True`` writes nothing, so
    each is judged by the state at the start. ``include_deleted=True`` adds a
    row for each local definition file, below ``root`` if given, that no record
    accounts for, so ``records`` should then be an inventory of all datasets.
    A ``kept`` state (:mod:`tidemark.sources.state`) takes the place of files and
    commits; it isn't shuffled.
    """
    marked = with_forced(schemas.conform(records, schemas.INVENTORY), force, force_files)
    if force and force_files is None and not include_deleted:
        return _decided(marked, "true", committed="NULL")

    if include_deleted:
        touched = _gated_paths(marked).union(_model_paths(marked))
    else:
        touched = _gated_paths(marked) if kept is not None or not dry_run else None
    if kept is not None:
        state = touched_state(kept, touched)
    else:
        state = path_state(local_files, commits, touched)
    if dry_run:
        plan = _decided(lookup(marked, state, "path"), FILE_PRESENT)
    else:
        plan = _plan_real_run(marked, state)
    if not include_deleted:
        return plan
    if kept is not None:
        state = kept.join(touched.select("path").distinct(), "path", "left_anti").withColumn("first_object", F.lit(None))
    return plan.unionByName(_deleted(state, root), allowMissingColumns=True)


def _gated_paths(records: DataFrame) -> DataFrame:
    return records.select("path", "run_order")


def _model_paths(records: DataFrame) -> DataFrame:
    """Model files known at the source, ordered behind every object that gates on one."""
    return records.filter("model_path IS NOT NULL").selectExpr(
        "model_path AS path", f"{BEHIND_ALL} AS run_order"
    )


def path_state(
    local_files: DataFrame, commits: DataFrame, touched: DataFrame | None = None
) -> DataFrame:
    """One row per path: file present, last commit, first object of the source on it.

    Files and commits go through one aggregate of plain numbers, which Spark keeps
    in a hash table; each map task combines its rows of a path before the shuffle. A run order
    is a struct, which takes a sort by path, so the fewer objects (``path, run_order``) have
    an aggregate of their own, dealt in the same way and joined without another shuffle. A hash
    ahead of the path spares that sort comparing paths that all start alike.
    """
    ordered = "log_order" in commits.columns
    none = {"commit_ts": "TIMESTAMP", "log_order": "BIGINT"}
    facts = local_files.selectExpr("path", "true AS is_file", *[f"CAST(NULL AS {kind}) AS {name}" for name, kind in none.items()])
    history = commits.selectExpr("path", "false", "commit_ts", "log_order" if ordered else "NULL")
    facts = facts.union(history)
    state = facts.filter("path IS NOT NULL").groupBy(F.xxhash64("path").alias("_hash"), "path").agg(
        F.max("is_file").alias("file_present"),
        committed(facts if ordered else facts.drop("log_order")).alias("committed"),
    )
    if touched is None:
        return state.drop("_hash").withColumn("first_object", F.lit(None).cast(schemas.RUN_ORDER))
    first = _first_objects(touched, F.xxhash64("path").alias("_hash"))
    return state.join(first, ["_hash", "path"], "full").select(
        "path", F.expr(FILE_PRESENT).alias("file_present"), "committed", "first_object"
    )


def _first_objects(touched: DataFrame, *ahead: Column) -> DataFrame:
    return touched.filter("path IS NOT NULL").groupBy(*ahead, "path").agg(F.min("run_order").alias("first_object"))


def touched_state(kept: DataFrame, touched: DataFrame) -> DataFrame:
    """The rows of :func:`path_state` for the paths of the source's objects.

    The kept state is read where it lies; only the objects' paths go to it. What
    comes out is no larger than the inventory, however long the history is.
    """
    return _first_objects(touched).join(kept, "path", "left").select("path", "file_present", "committed", "first_object")


def _plan_real_run(marked: DataFrame, state: DataFrame) -> DataFrame:
    """Where the file is missing, the first object on the path is written.

    So a later one finds a file. Model files are also written ungated along
    with fetched views and routines; these gate on ``.sql`` paths, which no
    model file can have. Which of them are fetched is settled first, on narrow
    rows that are dealt like the state; what follows for the model files joins
    the state where it lies. Whole objects then look up their path once.
    """
    found = f"({FILE_PRESENT} OR coalesce(run_order > first_object, false))"
    paired = marked.filter("model_path IS NOT NULL").select("path", "model_path", "run_order", "modified", "forced")
    fetched = paired.join(state, "path", "left").filter(f"{action(reason('modified', 'committed', found, forced='forced'))} = 'fetch'")
    ungated = fetched.groupBy(F.col("model_path").alias("path")).agg(F.min("run_order").alias("first_ungated"))
    facts = state.join(ungated, "path", "left")
    found_later = f"({found} OR coalesce(run_order > first_ungated, false))"
    return _decided(lookup(marked, facts, "path"), found_later)


def _decided(rows: DataFrame, file_present: str, committed: str = "committed") -> DataFrame:
    why = reason("modified", committed, file_present, forced="forced")
    return rows.withColumn("reason", F.expr(why)).selectExpr(
        *schemas.struct_type(schemas.INVENTORY).names,
        f"{action('reason')} AS action",
        "reason",
        f"CAST({committed} AS TIMESTAMP) AS committed",
    )


def _deleted(state: DataFrame, root: str | None) -> DataFrame:
    why = reason("NULL", "committed", "true", source_present="false")
    # A condition on the path alone would go below the aggregate, and its shuffle be done twice.
    return (
        state.filter("file_present AND first_object IS NULL")
        .filter(f"if(file_present, {is_definition('path', root)}, false)")
        .withColumn("reason", F.expr(why))
        .selectExpr("path", f"{action('reason')} AS action", "reason", "committed")
    )
