"""The fetch / skip / warn decision as an expression."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.paths import basename
from tidemark.operators.pick import lookup

# The outcome that each reason leads to.
ACTIONS = {
    "forced": "fetch",
    "absent": "skip",
    "deleted_at_source": "warn",
    "new": "fetch",
    "uncommitted": "warn",
    "up_to_date": "skip",
    "source_newer": "fetch",
}


def reason(
    modified: str,
    committed: str,
    file_present: str,
    forced: str = "false",
    source_present: str = "true",
) -> str:
    """Why an object is fetched, skipped or warned about, as SQL text.

    Presence comes as explicit conditions, since ``committed`` may be null for
    a file that exists and set for one that does not.
    """
    return f"""CASE
        WHEN {forced} THEN 'forced'
        WHEN NOT ({source_present}) THEN if({file_present}, 'deleted_at_source', 'absent')
        WHEN NOT ({file_present}) THEN 'new'
        WHEN {committed} IS NULL THEN 'uncommitted'
        WHEN {modified} > {committed} THEN 'source_newer'
        ELSE 'up_to_date' END"""


def action(why: str) -> str:
    """Outcome of a reason."""
    cases = " ".join(f"WHEN '{name}' THEN '{outcome}'" for name, outcome in ACTIONS.items())
    return f"CASE {why} {cases} END"


def with_forced(
    records: DataFrame, force: bool, force_files: Sequence[str] | DataFrame | None
) -> DataFrame:
    """Add ``forced``: every record, or those whose path or file name is listed.

    Nothing is forced without ``force``. A list comes from the caller's
    arguments and becomes a literal set; a DataFrame (first column) of any
    size is joined.
    """
    if not force or force_files is None:
        return records.withColumn("forced", F.lit(force))
    if not isinstance(force_files, DataFrame):
        wanted = list(force_files)
        name = F.expr(basename("path"))
        return records.withColumn("forced", F.col("path").isin(wanted) | name.isin(wanted))
    names = force_files.select(F.col(force_files.columns[0]).alias("_wanted")).distinct()
    marked = records
    for flag, value in (("_by_path", "path"), ("_by_name", basename("path"))):
        hits = names.withColumn(flag, F.lit(True))
        marked = lookup(marked.withColumn("_wanted", F.expr(value)), hits, "_wanted")
        marked = marked.drop("_wanted")
    forced = F.coalesce("_by_path", "_by_name", F.lit(False))
    return marked.withColumn("forced", forced).drop("_by_path", "_by_name")
