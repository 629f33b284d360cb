"""Text of the definition files, as expressions over inventory rows."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.functions.text import (
    argument_lines,
    concat,
    humanize_bytes,
    inline_list,
    iso_utc,
    json_quote,
    labelled,
    line,
    optional,
    schema_lines,
    sql_header,
    uri_lines,
)


def _if_filled(name: str) -> str:
    return optional(labelled(name, name), f"{name} <> ''")


def _list_if_filled(name: str) -> str:
    return optional(labelled(name, inline_list(name)), f"size({name}) > 0")


TITLE = concat(
    labelled("name", "name"), labelled("description", json_quote("coalesce(description, '')"))
)
CREATED = optional(labelled("created", iso_utc("created")), "created IS NOT NULL")
MODIFIED = labelled("modified", iso_utc("modified"))
REGION = _if_filled("region")
ROW_COUNT = labelled("row_count", "row_count")
STORAGE = concat(
    _if_filled("partitioning"),
    _list_if_filled("clustering"),
    _list_if_filled("primary_keys"),
    optional(
        labelled("total_logical_bytes", humanize_bytes("total_logical_bytes")),
        "total_logical_bytes IS NOT NULL",
    ),
)
SCHEMA = schema_lines("schema")

TABLE_YAML = concat(TITLE, ROW_COUNT, CREATED, MODIFIED, REGION, STORAGE, SCHEMA)
VIEW_YAML = concat(TITLE, line("'type: VIEW'"), CREATED, MODIFIED, REGION, SCHEMA)
ROUTINE_YAML = concat(
    TITLE,
    labelled("language", "language"),
    CREATED,
    MODIFIED,
    _if_filled("return_type"),
    argument_lines("arguments"),
)
EXTERNAL_YAML = concat(
    TITLE,
    labelled("source_format", "source_format"),
    uri_lines("source_uris"),
    CREATED,
    MODIFIED,
    REGION,
    ROW_COUNT,
    STORAGE,
    SCHEMA,
)

ROUTINE_SQL = concat(sql_header([("Routine", "name"), ("Language", "language")]), "sql")
SCHEDULED_SQL = concat(sql_header([("Scheduled Query", "name"), ("Schedule", "schedule")]), "sql")
SAVED_SQL = concat(sql_header([("Saved Query", "name")]), "sql")

# Content of the file that decides about an object, and of the model file that
# goes along with a view or routine.
GATED_CONTENT = f"""CASE kind
    WHEN 'view' THEN sql
    WHEN 'routine' THEN {ROUTINE_SQL}
    WHEN 'table' THEN {TABLE_YAML}
    WHEN 'external' THEN {EXTERNAL_YAML}
    WHEN 'scheduled' THEN {SCHEDULED_SQL}
    WHEN 'saved' THEN {SAVED_SQL} END"""
MODEL_CONTENT = f"CASE kind WHEN 'view' THEN {VIEW_YAML} WHEN 'routine' THEN {ROUTINE_YAML} END"

FILES = """inline(array(named_struct('path', path, 'content', gated_content),
    named_struct('path', model_path, 'content', model_content)))"""


def gated_files(records: DataFrame) -> DataFrame:
    """The file that decides about each object, alone: ``path, content, modified, kind, run_order``."""
    return records.selectExpr("path", f"{GATED_CONTENT} AS content", "modified", "kind", "run_order")


def model_files(records: DataFrame) -> DataFrame:
    """The model files of views and routines, alone."""
    paired = records.filter("model_path IS NOT NULL")
    return paired.selectExpr("model_path AS path", f"{MODEL_CONTENT} AS content", "modified", "kind", "run_order")


def rendered(records: DataFrame, *keep: str) -> DataFrame:
    """One row per file to write: ``path, content, modified, kind, run_order``.

    A view or routine gives two files, its ``.sql`` and its model; every other
    object gives one. Columns to ``keep`` are added at the end.
    """
    texts = records.selectExpr(
        "path",
        "model_path",
        f"{GATED_CONTENT} AS gated_content",
        f"{MODEL_CONTENT} AS model_content",
        "modified",
        "kind",
        "run_order",
        *keep,
    )
    files = texts.selectExpr(FILES, "modified", "kind", "run_order", *keep)
    return files.filter("path IS NOT NULL")
