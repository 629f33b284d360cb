"""Whole-table export to CSV or Parquet datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.paths import export_path, parse_model
from tidemark.functions.text import literal
from tidemark.operators.pick import lookup
from tidemark.sinks.publish import current, publish
from tidemark.sources.tables import scan_table

FORMATS = ("csv", "parquet")

# Quotes are doubled, blanks are kept, null is an empty field and '' is "".
# Instants keep their microseconds.
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "emptyValue": '""',
    "nullValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "dateFormat": "yyyy-MM-dd",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxx",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
# The reader turns an empty field into the null mark; the mark differs from ''
# so that a quoted empty text stays one.
CSV_READ_OPTIONS = {**CSV_OPTIONS, "emptyValue": "", "nullValue": "\0", "multiLine": "true"}


def check_format(fmt: str) -> None:
    if fmt not in FORMATS:
        raise ValueError(f"Unsupported format: {fmt!r}; use one of {', '.join(FORMATS)}")


def export_table(table: DataFrame, dest: str, fmt: str = "csv") -> str:
    """Write all rows and columns to a dataset at ``dest``, replacing what is there.

    Executors write their own part files, to a folder below ``dest`` that
    :func:`tidemark.sinks.publish.current` names. Until they are complete, an earlier
    export is what readers get, also after a failure; then it is removed. CSV has
    no form for arrays, maps and structs, so Spark refuses those; Parquet takes them.
    """
    check_format(fmt)

    def write(folder: str) -> None:
        if fmt == "csv":
            table.write.options(**CSV_OPTIONS).csv(folder)
        else:
            table.write.parquet(folder)

    publish(table.sparkSession, dest, write, alone=True)
    return dest


def read_export(spark: SparkSession, dest: str, schema: str | StructType, fmt: str = "csv") -> DataFrame:
    """An export read back as one dataset."""
    check_format(fmt)
    reader, folder = spark.read.schema(schema), current(spark, dest)
    if fmt == "csv":
        return reader.options(**CSV_READ_OPTIONS).csv(folder)
    return reader.parquet(folder)


def resolve_request(spark: SparkSession, model: str) -> tuple[str, str, str]:
    """Project, dataset and table named by a resource path, or ``ValueError``."""
    parsed = spark.range(1).select(F.expr(parse_model(literal(model))).alias("m")).select("m.*").first()
    if parsed["error"]:
        raise ValueError(parsed["error"])
    return parsed["project"], parsed["dataset"], parsed["model"]


def fetch_model(
    spark: SparkSession,
    model: str,
    data_dir: str,
    fmt: str = "csv",
    location: str | None = None,
) -> str:
    """Export the table or view named by ``model`` to ``<data_dir>/<table>.<fmt>``."""
    check_format(fmt)
    project, dataset, name = resolve_request(spark, model)
    table = scan_table(spark, project, dataset, name, location)
    return export_table(table, f"{data_dir.rstrip('/')}/{name}.{fmt}", fmt)


def export_requests(requests: DataFrame, data_dir: str, fmt: str = "csv") -> DataFrame:
    """Destinations of many requests (column ``model``), and how many share each.

    Two datasets with a table of one name share a destination, where the later
    export replaces the earlier one.
    """
    check_format(fmt)
    parsed = requests.withColumn("m", F.expr(parse_model("model"))).selectExpr(
        "* EXCEPT (m)", "m.error", f"{export_path(data_dir, 'm.model', fmt)} AS dest"
    )
    counts = parsed.filter("dest IS NOT NULL").groupBy("dest").agg(
        F.count(F.lit(1)).alias("same_dest")
    )
    return lookup(parsed, counts, "dest")
