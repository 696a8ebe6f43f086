"""Schemas from ``name type [not null]`` lists, without a running session."""

from __future__ import annotations

import re

from pyspark.sql import types as T

POINT = T.StructType(
    [
        T.StructField("srid", T.IntegerType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("lat", T.DoubleType()),
    ]
)

_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "decimal(10,2)": T.DecimalType(10, 2),
    "decimal(8,4)": T.DecimalType(8, 4),
    "point": POINT,
}


def columns(text: str) -> T.StructType:
    """``"a string not null, b decimal(10,2)"`` as a struct type."""
    fields = []
    for entry in re.split(r",\s*(?![0-9])", text.strip()):
        name, kind, *rest = entry.split()
        if rest not in ([], ["not", "null"]):
            raise ValueError(f"cannot read column {entry!r}")
        fields.append(T.StructField(name, _TYPES[kind], nullable=not rest))
    return T.StructType(fields)
