"""Explicit schemas, built without a session."""

from __future__ import annotations

from pyspark.sql import types as T

_SIMPLE = {"string": T.StringType, "long": T.LongType, "int": T.IntegerType, "double": T.DoubleType, "boolean": T.BooleanType, "timestamp": T.TimestampType, "binary": T.BinaryType}


def of(**fields: object) -> T.StructType:
    """``of(a="long", b=T.ArrayType(...))``."""
    return T.StructType([T.StructField(n, _SIMPLE[t]() if isinstance(t, str) else t) for n, t in fields.items()])


def strings(names: str) -> dict[str, str]:
    return dict.fromkeys(names.split(), "string")


def doubles(names: str) -> dict[str, str]:
    return dict.fromkeys(names.split(), "double")
