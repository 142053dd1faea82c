"""JSON decoding that tolerates quoted numbers.

The reference's JSON library turns ``"7"`` into the number 7 for a numeric
field; Spark's ``from_json`` gives null for a quoted number in a numeric
field.  So records are decoded with every leaf as ``string`` and then
``try_cast`` to the target type (an unparsable value becomes null instead of
failing the batch under ANSI mode).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def all_string(schema: T.StructType) -> T.StructType:
    """Same field names, every leaf a string (nested structs kept)."""
    fields = []
    for f in schema.fields:
        if isinstance(f.dataType, T.StructType):
            fields.append(T.StructField(f.name, all_string(f.dataType), True))
        elif isinstance(f.dataType, T.ArrayType):
            fields.append(T.StructField(f.name, T.ArrayType(T.StringType()), True))
        else:
            fields.append(T.StructField(f.name, T.StringType(), True))
    return T.StructType(fields)


def decode(value: Column, schema: T.StructType) -> Column:
    """JSON text -> struct typed as ``schema`` (quoted numbers accepted).

    The text is parsed once: the fields are taken from a lambda's argument.
    Taken from ``from_json`` itself, each field would become a parse of its own,
    as the optimizer narrows the schema of every one of them."""
    raw = F.from_json(value, all_string(schema))
    return F.transform(F.array(raw), lambda r: _typed(r, schema)).getItem(0)


def records(texts: DataFrame, value: str, schema: T.StructType, columns: tuple[str, ...] | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """The JSON texts of column ``value`` as rows: ``keep`` columns of ``texts``
    and the fields ``columns`` (all by default), as ``decode`` types them.

    A row generator makes the rows: a filter on a field stays above it, where
    it would parse the text a second time, and the casts are compiled code of
    their own, left out for fields nobody reads."""
    some = T.StructType([f for f in schema.fields if columns is None or f.name in columns])
    rows = texts.select(*keep, F.inline_outer(F.array(F.from_json(F.col(value), all_string(some)))))
    return rows.select(*keep, *[_cast(F.col(f.name), f.dataType).alias(f.name) for f in some.fields])


def _cast(text: Column, to: T.DataType) -> Column:
    if isinstance(to, T.StructType):
        return _typed(text, to)
    return text if isinstance(to, (T.StringType, T.ArrayType)) else text.try_cast(to)


def _typed(raw: Column, schema: T.StructType) -> Column:
    parts = [_cast(raw.getField(f.name), f.dataType).alias(f.name) for f in schema.fields]
    return F.when(raw.isNotNull(), F.struct(*parts))


def encode(*cols) -> Column:
    """Row -> JSON text (null fields left out, like the reference's writer)."""
    return F.to_json(F.struct(*cols))
