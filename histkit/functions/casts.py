"""Casting text into typed columns with an unknown member, and conforming to a target schema."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from histkit.functions.times import col_of

# Unknown members and text for missing values (fixed values).
UNKNOWN_KEY = -2
UNKNOWN_TEXT = "N/A"
UNKNOWN_DATE = "1970-01-01"
NOT_DEFINED = "Not Defined"


@dataclass(frozen=True)
class Field:
    """One output column: source column, target type and the member used for missing values."""

    source: str
    dtype: str
    default: Any = None
    fmt: str = "yyyy-MM-dd"

    def expr(self) -> Column:
        text = F.trim(col_of(self.source).cast("string"))
        if self.dtype == "string":
            # Blank text stays blank; only null becomes the unknown member.
            value, unknown = text, UNKNOWN_TEXT
        elif self.dtype == "date":
            if self.fmt == "yyyy-MM-dd":  # a plain cast, much cheaper than a formatter, for texts of that shape
                value = F.when(F.regexp_like(text, F.lit(r"^\d{4}-\d{2}-\d{2}$")), text).try_cast("date")
            else:
                value = F.try_to_timestamp(F.nullif(text, F.lit("")), F.lit(self.fmt)).cast("date")
            unknown = UNKNOWN_DATE
        else:
            value, unknown = F.nullif(text, F.lit("")).try_cast(self.dtype), UNKNOWN_KEY
        default = F.lit(unknown if self.default is None else self.default).cast(self.dtype)
        return F.coalesce(value, default)


def safe_cast(df: DataFrame, fields: Mapping[str, Field], keep: Iterable[str] = ()) -> DataFrame:
    """Project text columns into typed columns; what does not parse becomes the unknown member."""
    return df.select(*keep, *[f.expr().alias(out) for out, f in fields.items()])


def null_defaults(df: DataFrame, defaults: Mapping[str, Any]) -> DataFrame:
    """Replace nulls column by column, keeping each column's type."""
    out = {}
    for name, value in defaults.items():
        out[name] = F.coalesce(F.col(name), F.lit(value).cast(df.schema[name].dataType))
    return df.withColumns(out)


def nullable(t: T.DataType) -> T.DataType:
    """The type with every nested part nullable; casts cannot promise non-null fields."""
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, nullable(f.dataType), True) for f in t.fields])
    if isinstance(t, T.ArrayType):
        return T.ArrayType(nullable(t.elementType), True)
    if isinstance(t, T.MapType):
        return T.MapType(nullable(t.keyType), nullable(t.valueType), True)
    return t


def conform(
    df: DataFrame, schema: T.StructType, untouched: Iterable[str] = ("etl_metadata_struct",)
) -> DataFrame:
    """Cast to the target's types and select its columns in its order, by name."""
    skip = set(untouched)
    return df.select(
        *[
            F.col(f.name) if f.name in skip else F.col(f.name).cast(nullable(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )


def device_for_feature(
    feature: str, service: str, actual_service: str, device: str, special: str = "7"
) -> Column:
    """Device id of a fact row: for the special feature only a foreign-service id of a valid length."""
    id_lengths = (8, 10, 12)  # fixed values
    trimmed = F.trim(col_of(device))
    foreign = F.when(F.length(trimmed).isin(*id_lengths), trimmed).otherwise(F.lit(UNKNOWN_TEXT))
    same_service = F.trim(col_of(service)) == F.trim(col_of(actual_service))
    return F.when(
        col_of(feature).cast("string") == special,
        F.when(same_service, F.lit(UNKNOWN_TEXT)).otherwise(foreign),
    ).otherwise(trimmed)


def login_for_feature(feature: str, actual_device: str, special: str = "7") -> Column:
    known = F.coalesce(F.nullif(F.trim(col_of(actual_device)), F.lit("")), F.lit(UNKNOWN_TEXT))
    return F.when(col_of(feature).cast("string") == special, known).otherwise(F.lit(UNKNOWN_TEXT))
