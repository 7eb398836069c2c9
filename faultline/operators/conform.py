"""Bring a table to a declared schema: columns by name, types from a short list, checked before it runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCALARS = (T.StringType, T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)
ELEMENTS = (T.FloatType, T.DoubleType, T.IntegerType, T.LongType, T.StringType)


def check_types(schema: T.StructType) -> None:
    for field in schema.fields:
        kind = field.dataType
        if isinstance(kind, T.ArrayType):
            allowed = isinstance(kind.elementType, ELEMENTS)
        else:
            allowed = isinstance(kind, SCALARS)
        if not allowed:
            raise ValueError(f"column {field.name!r} has unsupported type {kind.simpleString()}")
    if not any(isinstance(f.dataType, T.ArrayType) for f in schema.fields):
        raise ValueError("a corpus needs at least one ARRAY column for its vectors")


def conform(df: DataFrame, schema: T.StructType, key: str) -> DataFrame:
    """``df`` with exactly the declared columns and types.

    A value that does not fit its type becomes NULL. The key column may go by the stored name
    ``key``: a single declared column absent from ``df`` takes it. Any further absence is an error,
    as is a type outside the list.
    """
    check_types(schema)
    absent = [f.name for f in schema.fields if f.name not in df.columns]
    if len(absent) > 1:
        raise ValueError(f"columns not in the table: {', '.join(absent)}")
    if absent and key not in df.columns:
        raise ValueError(f"column {absent[0]!r} is not in the table, nor is the key {key!r}")
    source = {f.name: (key if f.name in absent else f.name) for f in schema.fields}
    return df.select(*[F.col(source[f.name]).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def dimensions(df: DataFrame, vec: str) -> DataFrame:
    return df.agg(F.min(F.size(vec)).alias("min_dim"), F.max(F.size(vec)).alias("max_dim"),
                  F.count(vec).alias("vectors"))


def check_dim(df: DataFrame, vec: str, dim: int) -> DataFrame:
    """``df`` itself, after checking that every vector is ``dim`` wide."""
    seen = dimensions(df.where(F.col(vec).isNotNull()), vec).first()
    if seen.vectors and (seen.min_dim != dim or seen.max_dim != dim):
        raise ValueError(f"declared dimension {dim}, but {vec!r} holds {seen.min_dim} to {seen.max_dim}")
    return df
