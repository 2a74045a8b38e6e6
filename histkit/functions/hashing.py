"""Row hash for change detection, with built-in expressions only.

Two rows get the same hash exactly when their tracked columns are equal, where maps are
compared as sets of entries and arrays keep their order. Columns enter sorted by name, so
the order of a select does not matter.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Keep every microsecond: the JSON default stops at milliseconds.
_JSON = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def _has_map(t: T.DataType) -> bool:
    if isinstance(t, T.MapType):
        return True
    if isinstance(t, T.ArrayType):
        return _has_map(t.elementType)
    if isinstance(t, T.StructType):
        return any(_has_map(f.dataType) for f in t.fields)
    return False


def canonical(c: Column, t: T.DataType, sort_fields: bool = False) -> Column:
    """Replace every map in a value by its entries sorted by key; optionally sort struct fields."""
    if isinstance(t, T.MapType):
        if not _has_map(t.valueType) and not (sort_fields and isinstance(t.valueType, T.StructType)):
            return F.array_sort(F.map_entries(c))
        return F.transform(
            F.array_sort(F.map_keys(c)),
            lambda k: F.struct(
                k.alias("key"), canonical(F.element_at(c, k), t.valueType, sort_fields).alias("value")
            ),
        )
    if isinstance(t, T.ArrayType):
        if not _has_map(t) and not sort_fields:
            return c
        return F.transform(c, lambda x: canonical(x, t.elementType, sort_fields))
    if isinstance(t, T.StructType):
        if not _has_map(t) and not sort_fields:
            return c
        names = sorted(t.names) if sort_fields else t.names
        fields = [canonical(c[n], t[n].dataType, sort_fields).alias(n) for n in names]
        return F.when(c.isNotNull(), F.struct(*fields))
    return c


def comparable(df: DataFrame, names: Iterable[str]) -> list[Column]:
    """The columns in a form that ``=``, ``<=>``, grouping and sorting accept (maps are not)."""
    return [canonical(F.col(f"`{n}`"), df.schema[n].dataType).alias(n) for n in names]


def hash_expr(df: DataFrame, exclude: Iterable[str] = (), compat: bool = False) -> Column:
    skip = set(exclude)
    names = sorted(n for n in df.columns if n not in skip)
    if not compat:
        payload = F.struct(*comparable(df, names))
        return F.md5(F.to_json(payload, {**_JSON, "ignoreNullFields": "false"}))
    parts = []
    for n in names:
        t = df.schema[n].dataType
        c = F.col(f"`{n}`")
        if isinstance(t, (T.StructType, T.ArrayType, T.MapType)):
            parts.append(F.coalesce(F.to_json(canonical(c, t, sort_fields=True), _JSON), F.lit("")))
        else:
            parts.append(c.cast("string"))
    return F.md5(F.concat_ws("", *parts))


def row_hash(
    df: DataFrame, exclude: Iterable[str] = (), out: str = "hash_md5", compat: bool = False
) -> DataFrame:
    """Add an md5 over all columns but ``exclude`` (top-level names).

    By default nulls are marked and values are separated, so ``("a", null, "b")`` and
    ``("ab", null, null)`` differ. ``compat=True`` concatenates without either, as older
    hash columns did, for comparing with stored hashes of scalar columns.
    """
    return df.withColumn(out, hash_expr(df, exclude, compat))
