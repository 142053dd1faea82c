"""Broad type classes, to compare a Spark schema with DuckDB result types."""

from __future__ import annotations

from pyspark.sql import types as T


def spark_class(dt) -> str:
    if isinstance(dt, (T.StringType, T.VarcharType, T.CharType)):
        return "text"
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "int"
    if isinstance(dt, (T.FloatType, T.DoubleType, T.DecimalType)):
        return "frac"
    if isinstance(dt, T.DateType):
        return "date"
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return "ts"
    if isinstance(dt, T.BooleanType):
        return "bool"
    return dt.simpleString()


def duck_class(t: str) -> str:
    t = t.upper()
    if t.startswith(("VARCHAR", "CHAR", "TEXT", "STRING")):
        return "text"
    if t in ("TINYINT", "SMALLINT", "INTEGER", "BIGINT", "HUGEINT", "UTINYINT", "USMALLINT", "UINTEGER", "UBIGINT"):
        return "int"
    if t in ("FLOAT", "DOUBLE", "REAL") or t.startswith("DECIMAL"):
        return "frac"
    if t == "DATE":
        return "date"
    if t.startswith("TIMESTAMP"):
        return "ts"
    if t == "BOOLEAN":
        return "bool"
    return t.lower()


def compare(spark_schema, duck_rel) -> list[str]:
    """Differences as 'column: spark=.. duckdb=..' strings."""
    s = {f.name: spark_class(f.dataType) for f in spark_schema.fields}
    d = {c: duck_class(str(t)) for c, t in zip(duck_rel.columns, duck_rel.types)}
    return [f"{c}: spark={s.get(c)} duckdb={d.get(c)}" for c in sorted(set(s) | set(d)) if s.get(c) != d.get(c)]
