"""A digest of a whole row that two rows share exactly when Spark would group them together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def canonical(value: Column, kind: T.DataType) -> Column:
    """A text for a value: its length stands before it, so texts in a row cannot run into each other, and null has one of
    its own. Zero has no sign and NaN is one value, as in grouping; instants are counted, since local times repeat."""
    if isinstance(kind, T.ArrayType):
        inner = F.transform(value, lambda x: canonical(x, kind.elementType))
        text = F.concat(F.size(value).cast("string"), F.lit("["), F.array_join(inner, ""))
    elif isinstance(kind, T.StructType):
        text = F.concat(F.lit("{"), *[canonical(value[field.name], field.dataType) for field in kind.fields])
    elif isinstance(kind, (T.DoubleType, T.FloatType)):
        text = (value + F.lit(0.0).cast(kind)).cast("string")
    elif isinstance(kind, T.TimestampType):
        text = F.unix_micros(value).cast("string")
    elif isinstance(kind, T.BinaryType):
        text = F.hex(value)
    elif isinstance(kind, T.MapType):
        raise ValueError("maps cannot be grouped")
    else:
        text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.length(text).cast("string"), F.lit(":"), text))


def row_digest(df: DataFrame) -> Column:
    """SHA-256 of all columns of ``df`` in their order, 32 bytes."""
    parts = [canonical(F.col(f"`{field.name}`"), field.dataType) for field in df.schema.fields]
    return F.unhex(F.sha2(F.concat(F.lit(""), *parts), 256))
