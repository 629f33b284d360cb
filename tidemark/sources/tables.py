"""Whole-table scans and their size."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.functions.text import literal

# Logical width in bytes of fixed-size types.
WIDTHS = {
    "boolean": 1,
    "byte": 1,
    "short": 2,
    "integer": 4,
    "long": 8,
    "float": 4,
    "double": 8,
    "date": 4,
    "timestamp": 8,
    "timestamp_ntz": 8,
}
DECIMAL_WIDTH = 16


def scan_table(
    spark: SparkSession, project: str, dataset: str, name: str, location: str | None = None
) -> DataFrame:
    """All rows and columns of a table or view, in source column order.

    With a ``location`` the table is the Parquet dataset
    ``<location>/<project>/<dataset>/<name>``, otherwise it is looked up in
    the session catalog as ``project.dataset.name``.
    """
    if location is not None:
        return spark.read.parquet("/".join([location.rstrip("/"), project, dataset, name]))
    quoted = ".".join("`" + part.replace("`", "``") + "`" for part in (project, dataset, name))
    return spark.table(quoted)


def table_stats(table: DataFrame, name: str) -> DataFrame:
    """One row ``name, row_count, total_logical_bytes`` by a single aggregate."""
    sizes = [logical_bytes("`" + f.name.replace("`", "``") + "`", f.dataType) for f in table.schema]
    return table.selectExpr(f"{' + '.join(sizes) or '0'} AS bytes").selectExpr(
        f"{literal(name)} AS name",
        "count(*) AS row_count",
        "CAST(coalesce(sum(bytes), 0) AS BIGINT) AS total_logical_bytes",
    )


def logical_bytes(value: str, data_type: T.DataType) -> str:
    """Logical size of a value as SQL text; null is 0, nested values are summed up."""
    return f"CAST(coalesce({_size(value, data_type)}, 0) AS BIGINT)"


def _size(value: str, data_type: T.DataType) -> str:
    if isinstance(data_type, (T.StringType, T.BinaryType)):
        return f"octet_length({value})"
    if isinstance(data_type, T.ArrayType):
        return _array_size(value, data_type.elementType)
    if isinstance(data_type, T.MapType):
        keys = _array_size(f"map_keys({value})", data_type.keyType)
        return f"{keys} + {_array_size(f'map_values({value})', data_type.valueType)}"
    if isinstance(data_type, T.StructType):
        inner = [logical_bytes(f"{value}.`{f.name}`", f.dataType) for f in data_type]
        return f"CASE WHEN {value} IS NOT NULL THEN {' + '.join(inner) or '0'} END"
    return f"CASE WHEN {value} IS NOT NULL THEN {_width(data_type)} END"


def _width(data_type: T.DataType) -> int:
    return DECIMAL_WIDTH if isinstance(data_type, T.DecimalType) else WIDTHS[data_type.typeName()]


def _array_size(items: str, element: T.DataType) -> str:
    if element.typeName() in WIDTHS or isinstance(element, T.DecimalType):
        # Same width for every element that is not null: count instead of adding up.
        return f"CASE WHEN {items} IS NOT NULL THEN size(array_compact({items})) * {_width(element)} END"
    total = f"total + {logical_bytes('item', element)}"
    return f"aggregate({items}, 0L, (total, item) -> {total})"
