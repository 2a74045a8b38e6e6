"""Expressions over arrays of structs, one-of structs, and ordered rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from histkit.functions.times import col_of


def first_match(arr: str | Column, field: str, value: str, out: str) -> Column:
    """``out`` of the first element whose ``field`` equals ``value``; null when there is none."""
    hits = F.filter(col_of(arr), lambda x: x[field] == F.lit(value))
    return F.get(hits, F.lit(0))[out]


def first_element(arr: str | Column) -> Column:
    """First element, null for an empty or null array."""
    return F.get(col_of(arr), F.lit(0))


def struct_of_arrays(arr: str | Column, fields: Mapping[str, tuple[str, str | None]]) -> Column:
    """Array of structs -> struct of arrays, each sorted by itself, nulls last.

    ``fields``: output name -> (input field, type to cast to or None). Sorting every field
    by itself loses which values belonged together; see :func:`sorted_structs`.
    """
    source = col_of(arr)

    def one(name: str, dtype: str | None) -> Column:
        return F.array_sort(
            F.transform(source, lambda x: x[name].cast(dtype) if dtype else x[name])
        )

    return F.struct(*[one(n, t).alias(out) for out, (n, t) in fields.items()])


def sorted_structs(arr: str | Column, fields: Mapping[str, tuple[str, str | None]]) -> Column:
    """The same renamed and cast fields, but kept together as an array of structs sorted as a whole."""

    def one(x: Column) -> Column:
        return F.struct(
            *[(x[n].cast(t) if t else x[n]).alias(out) for out, (n, t) in fields.items()]
        )

    return F.array_sort(F.transform(col_of(arr), one))


def oneof_key(struct: str | Column, alternatives: Sequence[str]) -> Column:
    """Name of the alternative that is set in a one-of struct; null when none is."""
    s = col_of(struct)
    return F.coalesce(*[F.when(s[a].isNotNull(), F.lit(a)) for a in alternatives])


def oneof_value(
    struct: str | Column, alternatives: Sequence[str], field: str, default: str | None = None
) -> Column:
    """``field`` of the first alternative that is set (even when the field itself is null)."""
    s = col_of(struct)
    chain = None
    for a in alternatives:
        cond, value = s[a].isNotNull(), s[a][field]
        chain = F.when(cond, value) if chain is None else chain.when(cond, value)
    return chain.otherwise(F.lit(default))


def json_keys(c: str | Column) -> Column:
    """Keys of a JSON object column, in order."""
    return F.map_keys(F.from_json(col_of(c), "MAP<STRING,STRING>"))


def json_values(c: str | Column) -> Column:
    return F.map_values(F.from_json(col_of(c), "MAP<STRING,STRING>"))


def discriminator(variants: Mapping[str, Column]) -> Column:
    """Type name of the variant struct that is set."""
    return F.coalesce(*[F.when(v.isNotNull(), F.lit(name)) for name, v in variants.items()])


def classify(rules: Sequence[tuple[Column, str]], default: str | None = None) -> Column:
    """The label of the first rule that holds."""
    chain = None
    for cond, label in rules:
        chain = F.when(cond, F.lit(label)) if chain is None else chain.when(cond, F.lit(label))
    return chain.otherwise(F.lit(default))


def null_unless(cond: Column, values: Mapping[str, Column]) -> dict[str, Column]:
    """Blank every value where the condition does not hold (for ``withColumns``)."""
    return {name: F.when(cond, value) for name, value in values.items()}


def match_flag(a: Column, b: Column) -> Column:
    """Null when both are null, true when equal, otherwise false."""
    return F.when(a.isNull() & b.isNull(), F.lit(None).cast("boolean")).otherwise(
        F.coalesce(a == b, F.lit(False))
    )


def strip_tokens(c: str | Column, tokens: Sequence[str]) -> Column:
    """Remove each token in turn wherever it occurs."""
    out = col_of(c)
    for t in tokens:
        out = F.replace(out, F.lit(t), F.lit(""))
    return out
