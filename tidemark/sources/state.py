"""The state of all paths, kept between runs as a table bucketed by path.

A plan that starts from files and commits shuffles all of them. The kept state is
dealt by path already: a plan joins the objects of the source to it, and a merge
joins what has changed, without moving the rest. Every merge writes a new
generation, and readers see the last whole one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators.history import committed
from tidemark.sinks.publish import publish, published

# Rows of one bucket should sort in a task's memory.
ROWS_PER_BUCKET = 1 << 20


def path_changes(
    files: DataFrame | None = None, commits: DataFrame | None = None, removed: DataFrame | None = None
) -> DataFrame:
    """One row per path that files, commits or removed files name, from one aggregate."""
    rows = []
    for table, present in ((files, "true"), (removed, "false")):
        if table is not None:
            rows.append(table.selectExpr("path", f"{present} AS is_file", "CAST(NULL AS TIMESTAMP) AS commit_ts", "CAST(NULL AS BIGINT) AS log_order"))
    if commits is not None:
        order = "log_order" if "log_order" in commits.columns else "CAST(NULL AS BIGINT)"
        rows.append(commits.selectExpr("path", "CAST(NULL AS BOOLEAN) AS is_file", "commit_ts", f"{order} AS log_order"))
    if not rows:
        raise ValueError("a change names files, commits or removed files")
    facts = rows[0]
    for more in rows[1:]:
        facts = facts.union(more)
    return facts.filter("path IS NOT NULL").groupBy("path").agg(
        F.max("is_file").alias("file_present"), committed(facts).alias("committed"), F.max("log_order").alias("log_order")
    )


def create_state(local_files: DataFrame, commits: DataFrame, dest: str, buckets: int | None = None) -> DataFrame:
    """Write the first state of a synced copy to ``dest``; an error if there is one."""
    spark = local_files.sparkSession
    rows = path_changes(local_files, commits)
    if buckets is None:
        buckets = max(1, -(-(local_files.count() + commits.count()) // ROWS_PER_BUCKET))
    _write(_with_presence(rows).repartition(buckets, "path"), dest, buckets, once=True)
    return read_state(spark, dest)


def merge_state(
    spark: SparkSession,
    dest: str,
    files: DataFrame | None = None,
    commits: DataFrame | None = None,
    removed: DataFrame | None = None,
) -> DataFrame:
    """Write the state after a change and return it.

    ``files`` are there now, ``removed`` are not; a path in both is there. Of old
    and new commits the later in log order counts. Only the change is shuffled.
    A merge that fails leaves the state as it was; one that is repeated gives the
    same again.
    """
    buckets, _ = _generation(spark, dest)
    new = path_changes(files, commits, removed).select("path", F.struct("file_present", "committed", "log_order").alias("new"))
    old = read_state(spark, dest).select("path", F.struct("file_present", "committed", "log_order").alias("old"))
    rows = old.join(new, "path", "full_outer")
    last = F.greatest(*[F.struct(F.col(f"{s}.log_order").alias("log_order"), F.col(f"{s}.committed").alias("committed")) for s in ("old", "new")])
    rows = rows.select("path", F.coalesce("new.file_present", "old.file_present").alias("file_present"), last.alias("last"))
    _write(_with_presence(rows.select("path", "file_present", "last.committed", "last.log_order")), dest, buckets)
    return read_state(spark, dest)


def read_state(spark: SparkSession, dest: str) -> DataFrame:
    """The last whole state, with what Spark needs to know of its buckets."""
    buckets, folder = _generation(spark, dest)
    name = _table(folder)
    if not spark.catalog.tableExists(name):
        place = folder.replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {name} ({schemas.PATH_STATE}) USING parquet"
            f" CLUSTERED BY (path) SORTED BY (path) INTO {buckets} BUCKETS LOCATION '{place}'"
        )
    return spark.table(name)


def _with_presence(rows: DataFrame) -> DataFrame:
    return schemas.conform(rows.withColumn("file_present", F.coalesce("file_present", F.lit(False))), schemas.PATH_STATE)


def _generation(spark: SparkSession, dest: str) -> tuple[int, str]:
    found = published(spark, dest)
    if not found:
        raise FileNotFoundError(f"there is no state in {dest}")
    ((buckets, folder),) = found.items()
    return int(buckets), folder


def _table(folder: str) -> str:
    """Name in the session catalog of the table in a folder; dropping it leaves the files."""
    return f"tidemark_state_{folder.rpartition('-')[2]}"


def _write(rows: DataFrame, dest: str, buckets: int, once: bool = False) -> None:
    """Rows that lie by path in as many partitions as there are buckets: a file for each."""

    def write(folder: str) -> None:
        writer = rows.write.format("parquet").option("path", folder).bucketBy(buckets, "path").sortBy("path")
        writer.saveAsTable(_table(folder))

    publish(rows.sparkSession, dest, write, name=str(buckets), once=once, alone=True)
