"""One query per operator of the inventory, over the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import suppress
from dataclasses import replace
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import standins as S
from checks.standins import ROOT, Tables
from checks.workspace import shared_folder
from tidemark.functions import text
from tidemark.functions.paths import data_dir, definition_path, output_root, parse_model, stem, table_ref
from tidemark.operators.history import last_commit, uncommitted_by_root
from tidemark.plans.apply import applied, staged_records
from tidemark.plans.inventory import in_scope, inventory, located
from tidemark.plans.pull import pull
from tidemark.plans.render import gated_files, model_files
from tidemark.plans.sync import sync_plan
from tidemark.session import work_folder
from tidemark.sinks.definitions import accepted, append_run, latest_definitions, read_files, read_runs, write_files, write_version
from tidemark.sinks.export import export_requests, export_table, fetch_model, read_export
from tidemark.sources import listings
from tidemark.sources.snapshot import Worktree
from tidemark.sources.state import create_state, merge_state
from tidemark.sources.tables import table_stats

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    """Register under the function's name; ``_`` at its end only avoids a clash."""
    QUERIES[fn.__name__.rstrip("_")] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
    return fn


def iso(name: str) -> str:
    return f"{text.iso_utc(name)} AS {name}"


def joined(name: str) -> str:
    return f"array_join({name}, '|') AS {name}"


# --- listings ------------------------------------------------------------------------


@query
def list_views(t: Tables) -> DataFrame:
    views = listings.list_views(S.event_listing(t), S.event_details(t))
    return views.selectExpr(
        "project", "dataset", "name", "seq", "sql", "description", "region",
        iso("modified"), iso("created"), f"{text.schema_lines('schema')} AS schema",
    )


@query
def list_tables(t: Tables) -> DataFrame:
    tables = listings.list_tables(S.event_listing(t), S.event_details(t))
    return tables.selectExpr(
        "project", "dataset", "name", "seq", "description", "region", "row_count",
        "total_logical_bytes", iso("modified"), iso("created"),
        f"{text.schema_lines('schema')} AS schema",
    )


@query
def list_externals(t: Tables) -> DataFrame:
    externals = listings.list_external_tables(S.event_listing(t), S.event_details(t))
    return externals.selectExpr(
        "project", "dataset", "name", "seq", "description", "row_count", "source_format",
        joined("source_uris"), iso("modified"), "partitioning", joined("clustering"),
        joined("primary_keys"),
    )


@query
def list_routines(t: Tables) -> DataFrame:
    """One row per argument; a routine without arguments keeps one row."""
    routines = listings.list_routines(S.part_routines(t), S.part_routine_details(t))
    return routines.selectExpr(
        "dataset", "name", "seq", "sql", "language", "description", "return_type",
        iso("modified"), iso("created"), "posexplode_outer(arguments) AS (pos, arg)",
    ).selectExpr(
        "* EXCEPT (arg)", "arg.name AS arg_name", "arg.type AS arg_type", "arg.mode AS arg_mode"
    )


@query
def table_model_meta(t: Tables) -> DataFrame:
    """Partition label, clustering and primary key from null, empty and filled input."""
    listing = t.part.selectExpr(
        "'proj' AS project", "p_brand AS dataset", "concat('t', p_partkey) AS name",
        "'TABLE' AS table_type", "p_partkey AS seq",
    )
    details = t.part.selectExpr(
        "'proj' AS project",
        "p_brand AS dataset",
        "concat('t', p_partkey) AS name",
        """CASE WHEN p_size % 4 <> 0 THEN named_struct('field',
             CASE WHEN p_size % 4 = 1 THEN '' WHEN p_size % 4 = 2 THEN p_type END)
           END AS time_partitioning""",
        """CASE p_type WHEN 'PROMO' THEN NULL WHEN 'SMALL' THEN array()
           ELSE array(p_name, p_type) END AS clustering_fields""",
        """CASE WHEN p_size > 10 THEN named_struct('primary_key',
             CASE WHEN p_size > 20 THEN named_struct('columns', array('a', p_name)) END)
           END AS table_constraints""",
        "CASE WHEN p_size > 30 THEN p_partkey END AS num_rows",
    )
    return listings.list_tables(listing, details).selectExpr(
        "dataset", "name", "partitioning", joined("clustering"), joined("primary_keys"),
        "row_count", iso("modified"),
    )


@query
def list_scheduled(t: Tables) -> DataFrame:
    scheduled = listings.list_scheduled_queries(S.event_transfer_configs(t))
    return scheduled.selectExpr(
        "project", "region", "name", "seq", "sql", "schedule", iso("modified")
    )


@query
def list_saved_first(t: Tables) -> DataFrame:
    saved = listings.list_saved_queries(
        S.conversation_repositories(t), S.conversation_workspaces(t), S.conversation_files(t)
    )
    return saved.selectExpr("project", "region", "name", "seq", "sql", iso("modified"))


@query
def listing_detail_join(t: Tables) -> DataFrame:
    """Documents are listed; only the labelled ones can be looked up."""
    listing = t.documents.selectExpr(
        "'proj' AS project", "'docs' AS dataset", "CAST(doc_id AS STRING) AS name",
        "'TABLE' AS table_type", "doc_id AS seq",
    )
    details = t.labels.selectExpr(
        "'proj' AS project", "'docs' AS dataset", "CAST(doc_id AS STRING) AS name",
        "CAST(quality AS BIGINT) AS num_rows", "CAST(toxic AS BIGINT) AS num_bytes",
    )
    return listings.list_tables(listing, details).select(
        "name", "seq", "row_count", "total_logical_bytes"
    )


@query
def defaults_fill(t: Tables) -> DataFrame:
    """Details of documents; what their labels leave out gets a default."""
    listing = t.documents.selectExpr(
        "'proj' AS project", "source AS dataset", "CAST(doc_id AS STRING) AS name",
        "CASE WHEN lang = 'en' THEN 'TABLE' ELSE 'VIEW' END AS table_type", "doc_id AS seq",
    )
    details = t.documents.join(t.labels, "doc_id", "left").selectExpr(
        "'proj' AS project",
        "source AS dataset",
        "CAST(doc_id AS STRING) AS name",
        "CASE WHEN toxic IS NOT NULL THEN text END AS view_query",
        "CASE quality WHEN 1 THEN 'good' WHEN 0 THEN '' END AS description",
        "CAST(quality AS BIGINT) AS num_rows",
        "CASE toxic WHEN 0 THEN timestamp_seconds(n_chars) END AS modified",
        "array() AS schema",
    )
    return listings.list_table_like(listing, details).selectExpr(
        "kind", "dataset", "name", "sql", "description", "row_count", iso("modified")
    )


@query
def inventory_union(t: Tables) -> DataFrame:
    objects = inventory(S.snapshot(t), S.PROJECT, S.REGION, ROOT, S.SCOPE)
    return objects.selectExpr(
        "kind", "dataset", "name", "seq", iso("modified"), "path", "model_path",
        "CAST(CAST(run_order.stage AS DECIMAL(10,0)) * CAST(1e19 AS DECIMAL(20,0)) + run_order.seq AS STRING) AS run_order",
    )


# --- scalar functions ------------------------------------------------------------------


@query
def schema_lines(t: Tables) -> DataFrame:
    """Each part as a schema of three columns, each field one text line."""
    parts = t.part.selectExpr(
        "p_partkey",
        """array(
             named_struct('name', concat('p', p_partkey), 'type', 'INTEGER', 'mode', 'REQUIRED',
                          'description', concat('key "', p_name, '"')),
             named_struct('name', p_brand, 'type', p_type, 'mode', 'NULLABLE',
                          'description', CASE WHEN p_size > 10 THEN concat(p_name, '\\n\\u00e9') END),
             named_struct('name', 'size', 'type', 'RECORD', 'mode', 'REPEATED',
                          'description', CAST(p_size AS STRING))) AS fields""",
    )
    described = parts.selectExpr("p_partkey", f"{listings.described_fields('fields')} AS fields")
    return described.selectExpr("p_partkey", f"{text.schema_lines('fields')} AS lines")


@query
def humanize(t: Tables) -> DataFrame:
    """Bytes of text per source, and a wide range of counts from order keys."""
    by_source = t.documents.groupBy("source").agg(
        F.sum(F.octet_length("text")).cast("bigint").alias("n")
    )
    keys = t.orders.selectExpr(
        "CAST(o_orderkey AS STRING) AS id",
        """CASE o_orderpriority WHEN '1-URGENT' THEN o_orderkey * 256
             WHEN '2-HIGH' THEN -o_orderkey WHEN '3-MEDIUM' THEN o_orderkey
             WHEN '4-NOT SPECIFIED' THEN (o_orderkey % 4096) * 1099511627776 + o_orderkey END AS n""",
    )
    rows = by_source.withColumnRenamed("source", "id").unionByName(keys)
    return rows.selectExpr("id", "n", f"{text.humanize_bytes('n')} AS size")


@query
def json_quote(t: Tables) -> DataFrame:
    return t.documents.selectExpr("doc_id", f"{text.json_quote('text')} AS quoted")


@query
def iso_ts(t: Tables) -> DataFrame:
    return t.events.selectExpr(
        "event_id",
        f"{text.iso_utc('CAST(ts AS TIMESTAMP)')} AS exact",
        f"{text.iso_utc("date_trunc('SECOND', CAST(ts AS TIMESTAMP))")} AS whole",
    )


@query
def parse_model_path(t: Tables) -> DataFrame:
    """Paths of two to five segments, with and without extensions."""
    paths = t.part.selectExpr(
        "p_partkey",
        """CASE p_size % 6
             WHEN 0 THEN concat('proj/', p_type, '/', p_name)
             WHEN 1 THEN concat('proj/', p_type, '/models/', p_name, '.yaml')
             WHEN 2 THEN concat('proj/', p_type, '/', p_name, '.v', p_partkey, '.sql')
             WHEN 3 THEN concat('proj/', p_name)
             WHEN 4 THEN concat('proj//.', p_name)
             ELSE concat('a/b/', p_type, '/', p_name, '/') END AS model""",
    )
    return paths.withColumn("m", F.expr(parse_model("model"))).selectExpr(
        "p_partkey", "model", "m.project", "m.dataset", "m.model AS name", "m.error",
        f"CASE WHEN m.error IS NULL THEN {table_ref('m.project', 'm.dataset', 'm.model')} END AS ref",
        f"{stem('CAST(p_partkey AS STRING)')} AS key_stem",
    )


@query
def export_dest(t: Tables) -> DataFrame:
    requests = t.documents.selectExpr(
        "doc_id", "concat_ws('/', 'proj', source, concat('t', doc_id % 50, '.sql')) AS model"
    )
    return export_requests(requests, f"{ROOT}/data", "csv").select(
        "doc_id", "model", "dest", "same_dest"
    )


# --- state -------------------------------------------------------------------------------


@query
def table_stats_(t: Tables) -> DataFrame:
    return reduce(
        DataFrame.unionByName, (table_stats(getattr(t, name), name) for name in S.TABLES)
    )


@query
def last_commit_(t: Tables) -> DataFrame:
    return last_commit(S.order_commits(t)).selectExpr("path", iso("committed"))


@query
def dirty_tree(t: Tables) -> DataFrame:
    """Open line items are uncommitted files; a folder with the same prefix stays clean."""
    status = t.lineitem.filter("l_linestatus = 'O'").selectExpr(
        f"concat('{ROOT}/sales/models/', l_orderkey, '.yaml') AS path", "' M' AS status"
    )
    roots = [ROOT, f"{ROOT}/sales", f"{ROOT}/sale", "/out/pro"]
    return uncommitted_by_root(status, roots)


# --- sync plans ----------------------------------------------------------------------------


def order_plan(t: Tables, pending: bool = True, **options: object) -> DataFrame:
    plan = sync_plan(S.order_records(t, pending), S.order_paths(t), S.order_commits(t), **options)
    return plan.selectExpr("path", "kind", "action", "reason", iso("modified"), iso("committed"))


@query
def sync_plan_(t: Tables) -> DataFrame:
    """The whole decision matrix, rows for files deleted at the source included."""
    return order_plan(t, pending=False, include_deleted=True, root=ROOT)


@query
def sync_plan_pull(t: Tables) -> DataFrame:
    return order_plan(t)


@query
def sync_plan_dry_run(t: Tables) -> DataFrame:
    """Objects that share paths, each judged by the state at the start."""
    plan = sync_plan(S.customer_records(t), S.customer_files(t), S.customer_commits(t), dry_run=True)
    return plan.select("kind", "path", "seq", "action", "reason")


@query
def sync_plan_force(t: Tables) -> DataFrame:
    return order_plan(t, pending=False, force=True, include_deleted=True)


FORCED = [f"{ROOT}/sales/models/{k}.yaml" for k in (1, 2, 5, 7)] + ["10.yaml", "11.yaml", "x.sql"]


@query
def sync_plan_force_files(t: Tables) -> DataFrame:
    return order_plan(t, force=True, force_files=FORCED)


@query
def sync_plan_force_table(t: Tables) -> DataFrame:
    """Forced paths and names from a table: customers by name, parts by whole path."""
    names = t.customer.selectExpr("concat(c_custkey, '.yaml') AS name")
    paths = t.part.selectExpr(f"concat('{ROOT}/sales/models/', p_partkey * 3, '.yaml') AS name")
    return order_plan(t, force=True, force_files=names.union(paths), pending=False, include_deleted=True)


@query
def sync_plan_files_without_force(t: Tables) -> DataFrame:
    return order_plan(t, force=False, force_files=FORCED)


@query
def path_collisions(t: Tables) -> DataFrame:
    """Objects that share paths: judged one after the other, or all at once in a dry run."""

    def plan(mode: str, dry_run: bool) -> DataFrame:
        return sync_plan(
            S.customer_records(t), S.customer_files(t), S.customer_commits(t), dry_run=dry_run
        ).select(F.lit(mode).alias("mode"), "kind", "path", "seq", "action", "reason")

    return plan("real", False).unionByName(plan("dry", True))


@query
def collision_winners(t: Tables) -> DataFrame:
    """Of all files written to one path, the last one stays."""
    folder = work_folder(t.spark, shared_folder(t.spark))
    records = staged_records(S.customer_records(t), f"{folder}/inventory")
    plan = sync_plan(records, S.customer_files(t), S.customer_commits(t))
    return applied(plan, records, folder)[1].selectExpr("path", "kind", "content", iso("modified"))


@query
def apply_plan(t: Tables) -> DataFrame:
    folder = work_folder(t.spark, shared_folder(t.spark))
    records = staged_records(S.order_records(t), f"{folder}/inventory")
    plan = sync_plan(records, S.order_paths(t), S.order_commits(t))
    writes, fetched = applied(plan, records, folder)
    return write_version(S.order_files(t), writes, fetched, f"{folder}/version").select("path", "content", "kind")


@query
def view_pair_paths(t: Tables) -> DataFrame:
    """Fetched views and routines give a query file and a model file each."""
    views = listings.list_views(S.event_listing(t), S.event_details(t))
    routines = listings.list_routines(S.part_routines(t), S.part_routine_details(t))
    records = located(views.withColumn("kind", F.lit("view")), ROOT).unionByName(
        located(routines.withColumn("kind", F.lit("routine")), ROOT)
    )
    tree = S.event_worktree(t)
    folder = work_folder(t.spark, shared_folder(t.spark))
    records = staged_records(records, f"{folder}/inventory")
    plan = sync_plan(records, tree.local_files, tree.commits)
    return applied(plan, records, folder)[1].select("path", "kind")


def whole_run(t: Tables, tree: Worktree, dest: str, run: int | None = None) -> DataFrame:
    version = pull(
        S.snapshot(t),
        tree,
        dest,
        project=S.PROJECT,
        region=S.REGION,
        root=ROOT,
        datasets=S.SCOPE,
        run=run,
        work=shared_folder(t.spark),
    )
    return version.selectExpr("path", "kind", "content <> 'old' AS fetched", "content")


def flags(version: DataFrame) -> DataFrame:
    return version.select("path", "kind", "fetched")


@query
def pull_version(t: Tables) -> DataFrame:
    """A whole run over the catalog: which files the next version holds, and which are new."""
    return flags(whole_run(t, S.event_worktree(t), f"{work_folder(t.spark, shared_folder(t.spark))}/version"))


@query
def pull_contents(t: Tables) -> DataFrame:
    """The whole texts of that version."""
    folder = work_folder(t.spark, shared_folder(t.spark))
    return whole_run(t, S.event_worktree(t), f"{folder}/version").select("path", "content")


@query
def pull_runs(t: Tables) -> DataFrame:
    """The same run, added to a table of runs."""
    table = f"{work_folder(t.spark, shared_folder(t.spark))}/runs"
    tree = S.event_worktree(t)
    append_run(tree.local_files, table, 1)
    return flags(whole_run(t, tree, table, run=2))


@query
def pull_repeat(t: Tables) -> DataFrame:
    """A run under the number of an earlier one gives the same files with the same texts."""
    folder = work_folder(t.spark, shared_folder(t.spark))
    tree = S.event_worktree(t)
    append_run(tree.local_files, f"{folder}/runs", 1)
    whole_run(t, tree, f"{folder}/runs", run=2).write.parquet(f"{folder}/first")
    first = t.spark.read.parquet(f"{folder}/first").selectExpr("path", "content AS before")
    again = whole_run(t, tree, f"{folder}/runs", run=2).join(first, "path", "full_outer")
    return again.selectExpr("path", "kind", "fetched", "content <=> before AS same")


@query
def pull_compact(t: Tables) -> DataFrame:
    """Two runs, then a whole version of what they hold: one row per path."""
    folder = work_folder(t.spark, shared_folder(t.spark))
    tree = S.event_worktree(t)
    append_run(tree.local_files, f"{folder}/runs", 1)
    whole_run(t, tree, f"{folder}/runs", run=2)
    tree = replace(tree, local_files=read_runs(t.spark, f"{folder}/runs"))
    return flags(whole_run(t, tree, f"{folder}/version"))


@query
def accepted_run(t: Tables) -> DataFrame:
    """Files of an accepted run are fetched again if their source changed after that."""
    table = f"{work_folder(t.spark, shared_folder(t.spark))}/runs"
    append_run(S.order_files(t), table, 1)
    commits = accepted(t.spark, table, 1, "1996-01-01 00:00:00")
    plan = sync_plan(S.order_records(t), read_runs(t.spark, table), commits)
    return plan.select("path", "action", "reason")


@query
def kept_state(t: Tables) -> DataFrame:
    """A plan from a state that two runs have left: the commits of returned lines came with the second."""
    dest = f"{work_folder(t.spark, shared_folder(t.spark))}/state"
    returned = S.order_commits(t, "l_returnflag = 'R'")
    create_state(S.order_paths(t), S.order_commits(t, "l_returnflag <> 'R'"), dest, buckets=8)
    kept = merge_state(t.spark, dest, commits=returned)
    plan = sync_plan(S.order_records(t), None, None, kept=kept)
    return plan.selectExpr("path", "kind", "action", "reason", iso("modified"), iso("committed"))


@query
def kept_state_deleted(t: Tables) -> DataFrame:
    """The whole matrix from a kept state."""
    dest = f"{work_folder(t.spark, shared_folder(t.spark))}/state"
    kept = create_state(S.order_paths(t), S.order_commits(t), dest, buckets=8)
    plan = sync_plan(S.order_records(t, pending=False), None, None, include_deleted=True, root=ROOT, kept=kept)
    return plan.selectExpr("path", "kind", "action", "reason", iso("modified"), iso("committed"))


@query
def log_order_commit(t: Tables) -> DataFrame:
    """The last commit in log order, here by line number, which is often not the latest."""
    commits = t.lineitem.filter("l_linestatus = 'F'").selectExpr(
        f"concat('{ROOT}/sales/models/', l_orderkey, '.yaml') AS path",
        "CAST(l_shipdate AS TIMESTAMP) AS commit_ts",
        "l_linenumber * 1000000000000 + l_partkey * 10000 + l_suppkey AS log_order",
    )
    return last_commit(commits).selectExpr("path", iso("committed"))


@query
def pull_after_failure(t: Tables) -> DataFrame:
    """A whole run fails while its version is written; repeated, it is there whole."""
    dest = f"{work_folder(t.spark, shared_folder(t.spark))}/version"
    tree = S.event_worktree(t)
    broken = tree.local_files.withColumn("content", F.expr("if(content = 'old', raise_error('lost'), content)"))
    with suppress(PySparkException):
        whole_run(t, replace(tree, local_files=broken), dest)
    return flags(whole_run(t, tree, dest))


@query
def run_after_failure(t: Tables) -> DataFrame:
    """A run of a table of runs is repeated and fails: what it wrote before stays."""
    table = f"{work_folder(t.spark, shared_folder(t.spark))}/runs"
    tree = S.event_worktree(t)
    append_run(tree.local_files, table, 1)
    whole_run(t, tree, table, run=2)
    broken = tree.local_files.withColumn("content", F.expr("CAST(raise_error('lost') AS STRING)"))
    with suppress(PySparkException):
        append_run(broken, table, 2)
    version = latest_definitions(read_runs(t.spark, table))
    return version.selectExpr("path", "kind", "content <> 'old' AS fetched")


@query
def export_after_failure(t: Tables) -> DataFrame:
    """An export that fails halfway leaves the one before it."""
    dest = f"{work_folder(t.spark, shared_folder(t.spark))}/customer.csv"
    export_table(t.customer, dest)
    broken = F.expr("if(c_custkey % 100 = 7, raise_error('lost'), c_name)")
    with suppress(PySparkException):
        export_table(t.customer.withColumn("c_name", broken), dest)
    return read_export(t.spark, dest, t.customer.schema)


@query
def untied_run_order(t: Tables) -> DataFrame:
    """Objects without a listing order that share paths: one of them is the first, the others find its file."""
    records = located(
        t.orders.selectExpr(
            "'scheduled' AS kind", "'proj' AS project", "concat('c', o_custkey) AS name",
            "CAST(NULL AS BIGINT) AS seq", "CAST(o_orderdate AS TIMESTAMP) AS modified", "concat('q', o_orderkey) AS sql",
        ),
        ROOT,
    )
    folder = work_folder(t.spark, shared_folder(t.spark))
    records = staged_records(records, f"{folder}/inventory")
    none = t.customer.selectExpr("CAST(c_custkey AS STRING) AS path", "c_name AS content")
    plan = sync_plan(records, none, none.limit(0).selectExpr("path", "CAST(NULL AS TIMESTAMP) AS commit_ts"))
    files = applied(plan, records, folder)[1].groupBy("path").agg(F.count("*").alias("files"))
    judged = plan.groupBy("path").agg(F.count_if(F.col("reason") == "new").alias("n_new"), F.count("*").alias("objects"))
    return judged.join(files, "path")


@query
def definition_paths(t: Tables) -> DataFrame:
    """Addresses as names: repeated slashes are one."""
    path = definition_path("'scheduled'", ROOT, "CAST(NULL AS STRING)", "url")
    return t.pages.selectExpr("page_id", f"{path} AS path")


@query
def definition_files(t: Tables) -> DataFrame:
    """Definitions as text files in a folder, read back."""
    root = f"{work_folder(t.spark, shared_folder(t.spark))}/out".removeprefix("file://")
    write_files(
        t.documents.selectExpr(
            f"concat('{root}/', source, '/views/doc_', doc_id, '.sql') AS path", "concat(text, '\r\n') AS content"
        ),
        root,
    )
    files = read_files(t.spark, root)
    return files.selectExpr(f"split_part(path, '{root}/', 2) AS path", "CAST(content AS STRING) AS content")


@query
def definition_files_uri(t: Tables) -> DataFrame:
    """The same below an address with a scheme."""
    folder = f"{work_folder(t.spark, shared_folder(t.spark))}/out"
    root = folder if folder.startswith("file://") else f"file://{folder}"
    write_files(
        t.part.selectExpr(f"concat('{root}/', p_brand, '/models/part_', p_partkey, '.yaml') AS path", "concat(p_name, chr(10)) AS content"),
        root,
    )
    files = read_files(t.spark, root)
    place = root.removeprefix("file://")
    return files.selectExpr(f"split_part(path, '{place}/', 2) AS path", "CAST(content AS STRING) AS content")


@query
def long_scope(t: Tables) -> DataFrame:
    """A scope of every customer, in order of the number; each is a dataset, its orders are tables."""
    objects = t.orders.selectExpr(
        "'table' AS kind", "concat('d', o_custkey) AS dataset", "CAST(o_orderkey AS STRING) AS name", "o_orderkey AS seq",
        "CAST(o_orderdate AS TIMESTAMP) AS modified",
    )
    scope = t.customer.selectExpr("concat('d', c_custkey) AS dataset", "c_custkey + 1 AS position")
    rows = located(in_scope(objects, scope), ROOT, scope)
    return rows.selectExpr("path", "run_order.stage AS stage", "run_order.seq AS seq")


@query
def fetch_model_(t: Tables) -> DataFrame:
    """A table fetched by its reference, whole, into the data folder of a project."""
    folder = work_folder(t.spark, shared_folder(t.spark))
    t.customer.write.parquet(f"{folder}/src/proj/sales/customer")
    data = data_dir(output_root(folder, "out", "proj"))
    dest = fetch_model(t.spark, "proj/sales/models/customer.yaml", data, "csv", f"{folder}/src")
    rows = read_export(t.spark, dest, t.customer.schema, "csv")
    return rows.withColumn("dest", F.lit(dest.removeprefix(f"{folder}/")))


@query
def list_saved_damaged(t: Tables) -> DataFrame:
    """Files that aren't UTF-8 are left out, and only they."""
    saved = listings.list_saved_queries(S.conversation_repositories(t), S.conversation_workspaces(t), S.damaged_files(t))
    return saved.select("name", "sql")


# --- rendering ----------------------------------------------------------------------------


def content_of(files: DataFrame) -> DataFrame:
    return files.select("path", "kind", "content")


@query
def render_sql(t: Tables) -> DataFrame:
    """Documents as views, routines, scheduled and saved queries."""
    records = t.documents.selectExpr(
        """CASE doc_id % 4 WHEN 0 THEN 'view' WHEN 1 THEN 'routine' WHEN 2 THEN 'scheduled'
           ELSE 'saved' END AS kind""",
        "source AS dataset",
        "concat('doc_', doc_id) AS name",
        "doc_id AS seq",
        "text AS sql",
        "lang AS language",
        "concat('every ', n_chars, ' hours') AS schedule",
    )
    return content_of(gated_files(located(records, ROOT)))


@query
def render_yaml_table(t: Tables) -> DataFrame:
    records = t.part.selectExpr(
        "'table' AS kind",
        "lower(p_type) AS dataset",
        "concat('part_', p_partkey) AS name",
        "p_partkey AS seq",
        "concat(p_name, ' \"', p_brand, '\"') AS description",
        "CAST(p_size AS BIGINT) AS row_count",
        "CASE WHEN p_size % 2 = 0 THEN timestamp_seconds(1690000000 + p_partkey) END AS created",
        "timestamp_micros(1700000000000000 + p_partkey * 250000) AS modified",
        "CASE WHEN p_size % 3 = 0 THEN 'US' WHEN p_size % 3 = 1 THEN '' END AS region",
        "CASE WHEN p_size % 5 <> 0 THEN p_type END AS partitioning",
        "CASE WHEN p_size > 40 THEN array(p_brand, 'id') WHEN p_size > 30 THEN array() END AS clustering",
        "CASE WHEN p_size < 20 THEN array('id') END AS primary_keys",
        "CASE WHEN p_size % 7 <> 0 THEN p_partkey * p_size * 1000 END AS total_logical_bytes",
        """CASE WHEN p_size <> 9 THEN array(
             named_struct('name', 'id', 'type', 'INTEGER', 'mode', 'REQUIRED', 'description', p_name),
             named_struct('name', 'v', 'type', p_type, 'mode', 'NULLABLE', 'description', ''))
           ELSE array() END AS schema""",
    )
    return content_of(gated_files(located(records, ROOT)))


@query
def render_yaml_view(t: Tables) -> DataFrame:
    """The whole text of each document as a view's description."""
    records = t.documents.selectExpr(
        "'view' AS kind",
        "source AS dataset",
        "concat('doc_', doc_id) AS name",
        "doc_id AS seq",
        "'SELECT 1' AS sql",
        "text AS description",
        "CASE lang WHEN 'en' THEN timestamp_seconds(n_chars) END AS created",
        "timestamp_seconds(1700000000 + doc_id) AS modified",
        "CASE lang WHEN 'en' THEN 'EU' WHEN 'fr' THEN '' END AS region",
        """array(named_struct('name', lang, 'type', 'STRING', 'mode', 'NULLABLE',
                              'description', source)) AS schema""",
    )
    return content_of(model_files(located(records, ROOT)))


@query
def render_yaml_routine(t: Tables) -> DataFrame:
    routines = listings.list_routines(S.part_routines(t), S.part_routine_details(t))
    return content_of(model_files(located(routines.withColumn("kind", F.lit("routine")), ROOT)))


@query
def render_yaml_external(t: Tables) -> DataFrame:
    """Pages as external tables, described by the supplier of the same number if any."""
    records = t.pages.join(t.supplier, F.col("page_id") == F.col("s_suppkey"), "left").selectExpr(
        "'external' AS kind",
        "'web' AS dataset",
        "concat('page_', page_id) AS name",
        "page_id AS seq",
        "coalesce(s_name, '') AS description",
        "CASE WHEN s_nationkey > 5 THEN 'CSV' ELSE '' END AS source_format",
        "CASE WHEN s_nationkey <> 3 THEN array(url, s_name) ELSE array(url) END AS source_uris",
        "timestamp_seconds(1700000000 + page_id) AS modified",
        "CASE WHEN s_nationkey < 12 THEN 'EU' END AS region",
        "CAST(octet_length(html) AS BIGINT) AS row_count",
        "CAST(octet_length(html) AS BIGINT) * page_id AS total_logical_bytes",
        "CASE WHEN s_nationkey > 20 THEN array(s_name) END AS clustering",
        """array(named_struct('name', 'html', 'type', 'STRING', 'mode', 'NULLABLE',
                              'description', url)) AS schema""",
    )
    return content_of(gated_files(located(records, ROOT)))


# --- exports --------------------------------------------------------------------------------


def round_trip(t: Tables, name: str, fmt: str) -> DataFrame:
    """Export a whole table and read the export back."""
    table = getattr(t, name)
    dest = export_table(table, f"{work_folder(t.spark, shared_folder(t.spark))}/{name}.{fmt}", fmt)
    return read_export(t.spark, dest, table.schema, fmt)


@query
def export_csv(t: Tables) -> DataFrame:
    return round_trip(t, "customer", "csv")


@query
def export_parquet(t: Tables) -> DataFrame:
    return round_trip(t, "customer", "parquet")


@query
def export_csv_text(t: Tables) -> DataFrame:
    """Long texts with quotes, commas and line breaks."""
    return round_trip(t, "documents", "csv")


@query
def export_csv_times(t: Tables) -> DataFrame:
    events = round_trip(t, "events", "csv")
    return events.withColumn("ts", F.expr(text.iso_utc("CAST(ts AS TIMESTAMP)")))
