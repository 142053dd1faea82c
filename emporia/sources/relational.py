"""Relational tables over JDBC (operator 4).

A read is split into ranges of a numeric, date or timestamp column, one
connection and one task each, so it has to say which column and between which
bounds; or it gives the predicates of its parts itself.  Filters and columns
are pushed to the database.  Rows outside the bounds are still read, by the
first and the last task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

FETCH_ROWS = 10_000


def jdbc_options(url: str, table: str, column: str, lower, upper, parts: int, **options) -> dict[str, str]:
    """Options of a read of ``table`` in ``parts`` ranges of ``column``."""
    if lower is None or upper is None:
        raise ValueError(f"reading {table} needs the bounds of {column}")
    if parts < 1 or not lower <= upper:
        raise ValueError(f"{parts} parts between {lower} and {upper}")
    base = {
        "url": url, "dbtable": table, "partitionColumn": column, "lowerBound": str(lower), "upperBound": str(upper),
        "numPartitions": str(parts), "fetchsize": str(FETCH_ROWS), "pushDownPredicate": "true",
    }
    return base | {k: str(v) for k, v in options.items()}


def read_ranges(spark: SparkSession, url: str, table: str, column: str, lower, upper, parts: int, **options) -> DataFrame:
    """``table`` in ``parts`` tasks by ranges of ``column``; columns and filters of the result are pushed down."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, column, lower, upper, parts, **options)).load()


def read_parts(spark: SparkSession, url: str, table: str, predicates: list[str], **properties) -> DataFrame:
    """``table`` in one task a predicate; the predicates must not overlap."""
    if not predicates:
        raise ValueError(f"reading {table} needs a predicate a task")
    return spark.read.jdbc(url, table, predicates=predicates, properties={"fetchsize": str(FETCH_ROWS)} | {k: str(v) for k, v in properties.items()})
