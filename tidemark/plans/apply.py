"""Fetched objects merged into a new version of the synced set.

One route: the inventory is stored with an id per object, the decision names the
one object that owns each written path, and only those objects are rendered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.plans.render import GATED_CONTENT, MODEL_CONTENT
from tidemark.session import staged


def staged_records(records: DataFrame, folder: str) -> DataFrame:
    """Inventory rows stored once, a directory per kind, each with an ``id`` of its own."""
    numbered = records.withColumn("id", F.monotonically_increasing_id())
    return staged(numbered, schemas.STAGED, folder, "kind")


def object_writes(plan: DataFrame, records: DataFrame) -> DataFrame:
    """``path, id``: the object whose text each written path ends up with.

    Needs no texts. The last write of a path is the one with the largest run
    order; of objects that agree in everything, any will do.
    """
    files = "inline(array(named_struct('path', path), named_struct('path', model_path)))"
    orders = plan.filter("action = 'fetch'").select("path", "model_path", "run_order")
    last = orders.selectExpr(files, "run_order").filter("path IS NOT NULL")
    last = last.groupBy("path").agg(F.max("run_order").alias("run_order"))
    owned = records.select("path", "model_path", "run_order", "id").selectExpr(files, "run_order", "id")
    return owned.join(last, ["path", "run_order"]).groupBy("path").agg(F.min("id").alias("id"))


def written_definitions(records: DataFrame, writes: DataFrame) -> DataFrame:
    """Rendered files of the stored writes, one row per path.

    If ``writes`` is a stored table, Spark knows its size and broadcasts it
    while small, so texts are then not shuffled at all, else once.
    """
    wanted = writes.withColumnRenamed("path", "wanted")
    content = f"CASE WHEN wanted = path THEN {GATED_CONTENT} ELSE {MODEL_CONTENT} END"
    files = records.join(wanted, "id").selectExpr("wanted AS path", f"{content} AS content", "modified", "kind")
    return schemas.conform(files, schemas.DEFINITIONS)


def applied(plan: DataFrame, records: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """The writes of a plan over staged ``records``, stored below ``folder``, and their files."""
    writes = staged(object_writes(plan, records), schemas.WRITES, f"{folder}/writes")
    return writes, written_definitions(records, writes)
