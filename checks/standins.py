"""The given tables, projected to the shapes of a catalog snapshot and a synced copy.

The tables hold no catalog, so each input of the library is derived from the
whole of a table of about the same shape. Nulls and empty values come from
conditions on its columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.plans.inventory import located
from tidemark.sources.snapshot import Snapshot, Worktree

PROJECT = "proj"
REGION = "us-east1"
ROOT = "/out/proj"
SCOPE = ["ds2", "ds0", "economy", "promo"]
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


# Schemas read from the files so far: looking into a file takes a Spark job of its own.
KNOWN_SCHEMAS: dict[str, StructType] = {}


class Tables:
    """The Parquet tables of one scale folder; their zone-free times are UTC."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        path = f"{self.sf_dir}/{name}.parquet"
        if path not in KNOWN_SCHEMAS:
            KNOWN_SCHEMAS[path] = self.spark.read.parquet(path).schema
        table = self.spark.read.schema(KNOWN_SCHEMAS[path]).parquet(path)
        setattr(self, name, table)
        return table


# --- catalog from events -----------------------------------------------------------


def event_listing(t: Tables) -> DataFrame:
    return t.events.selectExpr(
        "'proj' AS project",
        "concat('ds', user_id % 4) AS dataset",
        "concat('res_', event_id) AS name",
        """CASE event_type WHEN 'view' THEN 'VIEW' WHEN 'click' THEN 'TABLE'
           WHEN 'purchase' THEN 'EXTERNAL' ELSE 'MATERIALIZED_VIEW' END AS table_type""",
        "event_id AS seq",
    )


def event_details(t: Tables) -> DataFrame:
    return t.events.selectExpr(
        "'proj' AS project",
        "concat('ds', user_id % 4) AS dataset",
        "concat('res_', event_id) AS name",
        "CASE WHEN value >= 5 THEN concat('SELECT ', value, ' AS v') END AS view_query",
        "CASE WHEN value < 20 THEN props END AS description",
        "CASE WHEN value >= 2 THEN CAST(floor(value) AS BIGINT) END AS num_rows",
        "CASE WHEN value >= 1 THEN event_id * 1000 END AS num_bytes",
        "CASE WHEN user_id % 5 <> 0 THEN CAST(ts AS TIMESTAMP) END AS modified",
        "CASE WHEN user_id % 3 <> 0 THEN CAST(date_trunc('SECOND', ts) AS TIMESTAMP) END AS created",
        "CASE WHEN user_id % 7 <> 0 THEN 'us-east1' END AS location",
        """array(named_struct('name', 'id', 'type', 'INTEGER', 'mode', 'REQUIRED',
                              'description', CAST(NULL AS STRING)),
                 named_struct('name', event_type, 'type', 'STRING', 'mode', 'NULLABLE',
                              'description', props)) AS schema""",
        """CASE WHEN user_id % 2 = 0 THEN named_struct('field', CASE WHEN value >= 10 THEN 'ts' END)
           END AS time_partitioning""",
        "CASE WHEN value >= 8 THEN array('id', event_type) ELSE array() END AS clustering_fields",
        """named_struct('primary_key', CASE WHEN user_id % 3 = 1
                        THEN named_struct('columns', array('id')) END) AS table_constraints""",
        """CASE WHEN value >= 3 THEN named_struct(
             'source_uris', array(concat('gs://bucket/', event_id, '.csv'), 'gs://bucket/b.csv'),
             'source_format', 'CSV') END AS external_config""",
    )


def event_transfer_configs(t: Tables) -> DataFrame:
    return t.events.selectExpr(
        "'proj' AS project",
        "'us-east1' AS region",
        "concat('job ', user_id) AS display_name",
        "CASE event_type WHEN 'error' THEN 'scheduled_query' ELSE 'other' END AS data_source_id",
        """map_concat(from_json(props, 'map<string,string>'),
                      CASE WHEN value >= 4 THEN map('query', concat('SELECT ', value))
                           ELSE CAST(map() AS MAP<STRING, STRING>) END) AS params""",
        "CASE WHEN value >= 10 THEN concat('every ', user_id, ' hours') END AS schedule",
        "CASE WHEN user_id % 6 <> 0 THEN CAST(ts AS TIMESTAMP) END AS update_time",
        "event_id AS seq",
    )


# --- routines from part ------------------------------------------------------------


def part_routines(t: Tables) -> DataFrame:
    return t.part.selectExpr(
        "'proj' AS project",
        "lower(p_type) AS dataset",
        "concat('fn_', p_partkey) AS name",
        "p_partkey AS seq",
    )


def part_routine_details(t: Tables) -> DataFrame:
    return t.part.selectExpr(
        "'proj' AS project",
        "lower(p_type) AS dataset",
        "concat('fn_', p_partkey) AS name",
        "CASE WHEN p_size <> 1 THEN concat('RETURN ', p_retailprice, ';') END AS body",
        "CASE p_brand WHEN 'Brand#13' THEN NULL WHEN 'Brand#14' THEN '' ELSE p_brand END AS language",
        "CASE WHEN p_size <> 2 THEN concat(p_name, ' \"', p_brand, '\"') END AS description",
        "CASE WHEN p_size <> 3 THEN timestamp_seconds(1700000000 + p_size * 86400) END AS modified",
        "CASE WHEN p_size % 2 = 0 THEN timestamp_micros(1690000000000000 + p_partkey) END AS created",
        """CASE WHEN p_size % 7 <> 0 THEN array(
             named_struct('name', CASE WHEN p_size > 5 THEN p_name END,
                          'data_type', CASE WHEN p_type <> 'PROMO'
                                            THEN named_struct('type_kind', p_type) END,
                          'mode', CASE WHEN p_size > 25 THEN 'INOUT' WHEN p_size > 15 THEN '' END),
             named_struct('name', 'y', 'data_type', named_struct('type_kind', 'INT64'),
                          'mode', CAST(NULL AS STRING))) END AS arguments""",
        "CASE WHEN p_type <> 'SMALL' THEN named_struct('type_kind', p_brand) END AS return_type",
    )


# --- saved queries from conversations ------------------------------------------------


def conversation_repositories(t: Tables) -> DataFrame:
    """A conversation is a repository; one with a single kind of speaker has no name."""
    return (
        t.conversations.groupBy("conv_id")
        .agg(F.count(F.lit(1)).alias("turns"))
        .selectExpr(
            "'proj' AS project",
            "'us-east1' AS region",
            "concat('repo_', conv_id) AS repo",
            """CASE WHEN turns > 3 THEN concat('query ', conv_id) WHEN turns = 3 THEN ''
               END AS display_name""",
            "conv_id AS seq",
        )
    )


def conversation_workspaces(t: Tables) -> DataFrame:
    return t.conversations.selectExpr(
        "concat('repo_', conv_id) AS repo",
        "concat('ws_', conv_id, '_', turn) AS workspace",
        "turn AS seq",
    )


def damaged_files(t: Tables) -> DataFrame:
    """The same files, those of every third conversation with a byte that no UTF-8 text has."""
    damage = "if(workspace LIKE 'ws_%' AND CAST(split(workspace, '_')[1] AS BIGINT) % 3 = 0, X'FF', X'')"
    return conversation_files(t).withColumn("contents", F.expr(f"concat(contents, {damage})"))


def conversation_files(t: Tables) -> DataFrame:
    return t.conversations.selectExpr(
        "concat('ws_', conv_id, '_', turn) AS workspace",
        "CASE role WHEN 'user' THEN 'content.sql' ELSE 'notes.md' END AS path",
        "encode(text, 'UTF-8') AS contents",
    )


def snapshot(t: Tables) -> Snapshot:
    """The whole catalog; it is the source of :func:`event_worktree`."""
    return Snapshot(
        listing=event_listing(t),
        table_details=event_details(t),
        routines=part_routines(t),
        routine_details=part_routine_details(t),
        transfer_configs=event_transfer_configs(t),
        repositories=conversation_repositories(t),
        workspaces=conversation_workspaces(t),
        workspace_files=conversation_files(t),
    )


# --- synced copy of the events catalog ---------------------------------------------------

EVENT_PATH = f"""concat('{ROOT}/ds', user_id % 4,
    CASE event_type WHEN 'view' THEN '/views/res_' ELSE '/models/res_' END, event_id,
    CASE event_type WHEN 'view' THEN '.sql' ELSE '.yaml' END) AS path"""


def event_worktree(t: Tables) -> Worktree:
    """Views and tables below a value are on disk, those far below are committed as well."""
    synced = t.events.filter("event_type IN ('view', 'click')")
    return Worktree(
        local_files=synced.filter("value < 20").selectExpr(
            EVENT_PATH,
            "'old' AS content",
            "CAST(ts AS TIMESTAMP) AS modified",
            "CASE event_type WHEN 'view' THEN 'view' ELSE 'table' END AS kind",
        ),
        commits=synced.filter("value < 10").selectExpr(
            EVENT_PATH, "CAST(date_trunc('HOUR', ts) AS TIMESTAMP) AS commit_ts"
        ),
        worktree_status=t.lineitem.selectExpr(
            "concat('/elsewhere/', l_orderkey) AS path", "' M' AS status"
        ),
    )


# --- sync state from orders and lineitem ---------------------------------------------


def order_records(t: Tables, pending: bool = True) -> DataFrame:
    """Orders are tables; without ``pending`` ones ('P') these no longer exist at the source."""
    orders = t.orders if pending else t.orders.filter("o_orderstatus <> 'P'")
    objects = orders.selectExpr(
        "'table' AS kind",
        "'proj' AS project",
        "'sales' AS dataset",
        "CAST(o_orderkey AS STRING) AS name",
        "o_orderkey AS seq",
        "CAST(o_orderdate AS TIMESTAMP) AS modified",
        "o_orderpriority AS description",
        "o_custkey AS row_count",
    )
    return located(objects, ROOT)


def order_paths(t: Tables) -> DataFrame:
    """Path of an order's file, once for each of its line items."""
    return t.lineitem.selectExpr(f"concat('{ROOT}/sales/models/', l_orderkey, '.yaml') AS path")


def order_files(t: Tables) -> DataFrame:
    """One local file per order that has line items."""
    return (
        t.lineitem.groupBy("l_orderkey")
        .agg(F.count(F.lit(1)).alias("lines"))
        .selectExpr(
            f"concat('{ROOT}/sales/models/', l_orderkey, '.yaml') AS path",
            "concat('old ', lines) AS content",
            "'table' AS kind",
        )
    )


def order_commits(t: Tables, only: str = "true") -> DataFrame:
    """Each finished line item is a commit of its order's file."""
    return t.lineitem.filter("l_linestatus = 'F'").filter(only).selectExpr(
        f"concat('{ROOT}/sales/models/', l_orderkey, '.yaml') AS path",
        "CAST(l_shipdate AS TIMESTAMP) AS commit_ts",
    )


# --- colliding paths: all orders of a customer share their names ------------------------


def customer_records(t: Tables) -> DataFrame:
    objects = t.orders.selectExpr(
        """CASE o_orderpriority WHEN '1-URGENT' THEN 'view' WHEN '2-HIGH' THEN 'routine'
           WHEN '3-MEDIUM' THEN 'table' WHEN '4-NOT SPECIFIED' THEN 'external'
           ELSE 'scheduled' END AS kind""",
        "'proj' AS project",
        "'ds' AS dataset",
        "concat('c', o_custkey) AS name",
        "o_orderkey AS seq",
        "CAST(o_orderdate AS TIMESTAMP) AS modified",
        "concat('q', o_orderkey) AS sql",
        "o_orderstatus AS description",
        "'SQL' AS language",
        "'daily' AS schedule",
        "o_orderkey AS row_count",
        "'CSV' AS source_format",
    )
    return located(objects, ROOT)


def customer_files(t: Tables) -> DataFrame:
    return t.customer.filter("c_mktsegment <> 'BUILDING'").selectExpr(
        f"""concat('{ROOT}/', CASE c_mktsegment WHEN 'MACHINERY' THEN 'ds/views/'
              WHEN 'AUTOMOBILE' THEN 'ds/routines/' WHEN 'HOUSEHOLD' THEN 'ds/models/'
              ELSE 'scheduled_queries/' END,
            'c', c_custkey,
            CASE c_mktsegment WHEN 'HOUSEHOLD' THEN '.yaml' ELSE '.sql' END) AS path""",
        "c_name AS content",
    )


def customer_commits(t: Tables) -> DataFrame:
    """Pending orders commit a customer's model file, finished ones the view."""
    return t.orders.filter("o_orderstatus <> 'O'").selectExpr(
        f"""CASE o_orderstatus WHEN 'P' THEN concat('{ROOT}/ds/models/c', o_custkey, '.yaml')
            ELSE concat('{ROOT}/ds/views/c', o_custkey, '.sql') END AS path""",
        "CAST(o_orderdate AS TIMESTAMP) AS commit_ts",
    )
