"""All source objects of one run, with their paths and processing order."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.paths import DATASET_KINDS, KINDS, definition_path, model_path
from tidemark.functions.text import literal
from tidemark.operators.pick import lookup
from tidemark.sources import listings
from tidemark.sources.snapshot import Snapshot

# Longer dataset lists are joined instead of being part of an expression.
LITERAL_SCOPE = 64

# Behind the stages of all datasets.
PROJECT_STAGE = 1 << 62

# Datasets in processing order, or a table of any size with ``dataset`` and ``position`` (from 1).
Scope = Sequence[str] | DataFrame | None


def scope_table(spark: SparkSession, datasets: Sequence[str] | DataFrame) -> DataFrame:
    """``dataset, position``: one row per dataset, the first place of a repeated one.

    Spark knows the size of a list and sends it around or shuffles it accordingly.
    """
    if isinstance(datasets, DataFrame):
        return datasets.groupBy("dataset").agg(F.min("position").cast("bigint").alias("position"))
    first = {name: place for place, name in reversed(list(enumerate(datasets, 1)))}
    columns = {"dataset": pa.array(first.keys(), pa.string()), "position": pa.array(first.values(), pa.int64())}
    return spark.createDataFrame(pa.table(columns))


def is_short(datasets: Scope) -> bool:
    return datasets is None or (not isinstance(datasets, DataFrame) and len(datasets) <= LITERAL_SCOPE)


def in_scope(objects: DataFrame, datasets: Scope) -> DataFrame:
    """Keep the objects of the given datasets; ``None`` keeps all."""
    if datasets is None:
        return objects
    if is_short(datasets):
        return objects.filter(F.col("dataset").isin(list(datasets)))
    return lookup(objects, scope_table(objects.sparkSession, datasets).select("dataset"), "dataset", "left_semi")


def scope_position(dataset: str, datasets: Sequence[str] | None) -> str:
    """Place of a dataset in a short scope, from 1, as SQL text."""
    scope = ", ".join(map(literal, datasets or []))
    return f"coalesce(array_position(array({scope}), {dataset}), 1)" if scope else "1"


def run_order(
    kind: str, dataset: str, seq: str, datasets: Scope, position: str | None = None, tie: str = "0L"
) -> str:
    """Position of an object in the run, as SQL text: a struct that is compared field by field.

    Datasets go in the given order, kinds in fixed order within each, the
    project-level kinds last; within a kind the listing order holds, and objects
    that share a place in it go by ``tie``.
    """
    per_dataset = len(DATASET_KINDS)
    place = position or scope_position(dataset, datasets)
    last = PROJECT_STAGE if isinstance(datasets, DataFrame) else max(len(datasets or []), 1) * per_dataset
    stages = [f"WHEN '{k}' THEN ({place} - 1) * {per_dataset}L + {pos}" for pos, k in enumerate(DATASET_KINDS)]
    stages += [f"WHEN '{k}' THEN {last + pos}L" for pos, k in enumerate(KINDS[per_dataset:])]
    stage = f"CASE {kind} {' '.join(stages)} END"
    fields = {"stage": stage, "seq": f"coalesce({seq}, 0)", "tie": tie}
    return f"named_struct({', '.join(f"'{name}', CAST({value} AS BIGINT)" for name, value in fields.items())})"


def located(objects: DataFrame, root: str, datasets: Scope = None) -> DataFrame:
    """Objects with a ``kind`` as inventory rows: paths and run order added.

    Listings of several datasets may each start anew, and a listing position may
    be missing. Objects that share one are told apart by a hash of their key, so
    that one of two on a path is always the first. Queries of a project may share
    a name and have no other key; they are told apart by all they have. A name or
    dataset that begins with ``/`` has no place below the root; such objects are
    left out.
    """
    keyed = "dataset" in objects.columns
    if not keyed:
        objects = objects.withColumn("dataset", F.lit(None).cast("string"))
    objects = objects.filter("NOT (startswith(name, '/') OR coalesce(startswith(dataset, '/'), false))")
    given = schemas.conform(objects, schemas.INVENTORY).columns
    own = [c for c in objects.columns if c in given and c not in ("path", "model_path", "run_order")]
    tie = "xxhash64(kind, dataset, name)" if keyed else f"xxhash64({', '.join(own)})"
    objects = _positioned(objects, datasets if keyed else None)
    return schemas.conform(
        objects.selectExpr(
            "*",
            f"{definition_path('kind', root, 'dataset', 'name')} AS path",
            f"{model_path('kind', root, 'dataset', 'name')} AS model_path",
            f"{run_order('kind', 'dataset', 'seq', datasets, '_position', tie)} AS run_order",
        ),
        schemas.INVENTORY,
    )


def _positioned(objects: DataFrame, datasets: Scope) -> DataFrame:
    """Adds ``_position``, the place of an object's dataset in the scope."""
    if is_short(datasets):
        return objects.withColumn("_position", F.expr(scope_position("dataset", datasets)))
    places = scope_table(objects.sparkSession, datasets).withColumnRenamed("position", "_position")
    return lookup(objects, places, "dataset").withColumn("_position", F.coalesce("_position", F.lit(1)))


def inventory(
    snapshot: Snapshot,
    project: str,
    region: str,
    root: str,
    datasets: Scope = None,
) -> DataFrame:
    """Union of the six kinds. The dataset scope does not narrow project-level kinds."""
    of_project = F.col("project") == project
    of_region = of_project & (F.col("region") == region)

    def scoped(table: DataFrame) -> DataFrame:
        return in_scope(table.filter(of_project), datasets)

    table_like = listings.list_table_like(scoped(snapshot.listing), snapshot.table_details)
    routines = listings.list_routines(scoped(snapshot.routines), snapshot.routine_details)
    scheduled = listings.list_scheduled_queries(snapshot.transfer_configs.filter(of_region))
    saved = listings.list_saved_queries(
        snapshot.repositories.filter(of_region), snapshot.workspaces, snapshot.workspace_files
    )
    kinds = [
        table_like,
        routines.withColumn("kind", F.lit("routine")),
        scheduled.withColumn("kind", F.lit("scheduled")),
        saved.withColumn("kind", F.lit("saved")),
    ]
    return reduce(DataFrame.unionByName, (located(k, root, datasets) for k in kinds))
