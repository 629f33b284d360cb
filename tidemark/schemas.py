"""Fixed record shapes, as Spark DDL.

Instants are ``TIMESTAMP`` (UTC). Snapshot tables may leave out optional
columns: :func:`conform` adds them as typed nulls.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

FIELDS = "ARRAY<STRUCT<name STRING, type STRING, mode STRING, description STRING>>"
ARGUMENTS = "ARRAY<STRUCT<name STRING, type STRING, mode STRING>>"

# --- inputs: raw snapshot of the source catalog -------------------------------

LISTING = "project STRING, dataset STRING, name STRING, table_type STRING, seq BIGINT"
TABLE_DETAILS = f"""
    project STRING, dataset STRING, name STRING, view_query STRING, description STRING,
    num_rows BIGINT, num_bytes BIGINT, modified TIMESTAMP, created TIMESTAMP, location STRING,
    schema {FIELDS},
    time_partitioning STRUCT<field STRING>,
    clustering_fields ARRAY<STRING>,
    table_constraints STRUCT<primary_key STRUCT<columns ARRAY<STRING>>>,
    external_config STRUCT<source_uris ARRAY<STRING>, source_format STRING>
"""
ROUTINE_LISTING = "project STRING, dataset STRING, name STRING, seq BIGINT"
ROUTINE_DETAILS = """
    project STRING, dataset STRING, name STRING, body STRING, language STRING,
    description STRING, modified TIMESTAMP, created TIMESTAMP,
    arguments ARRAY<STRUCT<name STRING, data_type STRUCT<type_kind STRING>, mode STRING>>,
    return_type STRUCT<type_kind STRING>
"""
TRANSFER_CONFIGS = """
    project STRING, region STRING, display_name STRING, data_source_id STRING,
    params MAP<STRING, STRING>, schedule STRING, update_time TIMESTAMP, seq BIGINT
"""
REPOSITORIES = "project STRING, region STRING, repo STRING, display_name STRING, seq BIGINT"
WORKSPACES = "repo STRING, workspace STRING, seq BIGINT"
WORKSPACE_FILES = "workspace STRING, path STRING, contents BINARY"

# --- inputs: state of the synced copy -----------------------------------------

LOCAL_FILES = "path STRING, content STRING, modified TIMESTAMP, kind STRING"
# ``log_order`` grows along the log; without it the latest time counts as the last commit.
COMMITS = "path STRING, commit_ts TIMESTAMP, log_order BIGINT"
WORKTREE_STATUS = "path STRING, status STRING"

# One row per path that is or was known, kept between runs.
PATH_STATE = "path STRING, file_present BOOLEAN, committed TIMESTAMP, log_order BIGINT"

# --- outputs: one row per source object ---------------------------------------

VIEW = f"""
    project STRING, dataset STRING, name STRING, seq BIGINT, modified TIMESTAMP, sql STRING,
    schema {FIELDS}, description STRING, created TIMESTAMP, region STRING
"""
ROUTINE = f"""
    project STRING, dataset STRING, name STRING, seq BIGINT, modified TIMESTAMP, sql STRING,
    language STRING, description STRING, created TIMESTAMP, arguments {ARGUMENTS},
    return_type STRING
"""
TABLE = f"""
    project STRING, dataset STRING, name STRING, seq BIGINT, modified TIMESTAMP,
    schema {FIELDS}, description STRING, row_count BIGINT, partitioning STRING,
    clustering ARRAY<STRING>, created TIMESTAMP, region STRING, primary_keys ARRAY<STRING>,
    total_logical_bytes BIGINT
"""
EXTERNAL = f"{TABLE}, source_uris ARRAY<STRING>, source_format STRING"
SCHEDULED = """
    project STRING, region STRING, name STRING, seq BIGINT, modified TIMESTAMP, sql STRING,
    schedule STRING
"""
SAVED = "project STRING, region STRING, name STRING, seq BIGINT, modified TIMESTAMP, sql STRING"

# Place of an object in a run, compared field by field.
RUN_ORDER = "STRUCT<stage: BIGINT, seq: BIGINT, tie: BIGINT>"
INVENTORY = f"""
    kind STRING, project STRING, dataset STRING, name STRING, seq BIGINT, modified TIMESTAMP,
    sql STRING, schema {FIELDS}, description STRING, created TIMESTAMP, region STRING,
    language STRING, arguments {ARGUMENTS}, return_type STRING,
    row_count BIGINT, partitioning STRING, clustering ARRAY<STRING>, primary_keys ARRAY<STRING>,
    total_logical_bytes BIGINT, source_uris ARRAY<STRING>, source_format STRING,
    schedule STRING, path STRING, model_path STRING, run_order {RUN_ORDER}
"""
STAGED = f"{INVENTORY}, id BIGINT"
WRITES = "path STRING, id BIGINT"
DEFINITIONS = "path STRING, content STRING, modified TIMESTAMP, kind STRING"


@cache
def struct_type(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)


def conform(df: DataFrame, ddl: str) -> DataFrame:
    """Project ``df`` to ``ddl``: columns in that order, missing ones as typed nulls."""
    return df.to(struct_type(ddl))
