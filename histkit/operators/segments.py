"""Segmented scans: previous row, next row and forward fill over a range partitioning by key and order.

Rows are dealt into ranges of (key, order) of even size, so one key - even one key at one
timestamp - may fill as many ranges as it likes. Inside a range an ordinary window does the
work; what crosses a border is one row per range: the value that a key's last rows hand to its
first row in the next range. There is no list of hot keys and no expression that cuts the
order. The price is a stored copy of the rows, as the ranges must be the same for both steps.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from histkit.functions.times import col_of

Store = Callable[[DataFrame, str], DataFrame]
_SEGMENT, _TIE, _ROW = "_segment", "_tie", "_row"


def segmented(df: DataFrame, keys: Sequence[str], order: Sequence[str], store: Store, parts: int | None = None) -> DataFrame:
    """The rows stored with the number of their range; ranges follow each other in (keys, order).

    Ties are put in the order of a hash of the row. Equal rows share a hash, so a running number
    lets ranges divide these too.
    """
    plain = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    rows = df.withColumns({_TIE: F.xxhash64(*[F.col(f"`{n}`") for n in plain]), _ROW: F.monotonically_increasing_id()})
    by = [*keys, *order, _TIE, _ROW]
    rows = rows.repartitionByRange(parts, *by) if parts else rows.repartitionByRange(*by)
    return store(rows.withColumn(_SEGMENT, F.spark_partition_id()), "segments")


def _scan(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Mapping[str, str | Column], mode: str, store: Store, parts: int | None) -> DataFrame:
    hidden = {f"_v_{n}": F.struct(col_of(v).alias("v")) for n, v in values.items()}
    if mode == "fill":
        hidden = {f"_v_{n}": F.when(col_of(v).isNotNull(), F.struct(col_of(v).alias("v"))) for n, v in values.items()}
    rows = segmented(df.withColumns(hidden), keys, order, store, parts)
    position = F.struct(*order, _TIE, _ROW)
    by = [F.col(c).asc() for c in [*order, _TIE, _ROW]]

    # The value that each (range, key) hands on. Of a range only its first and last key can reach
    # another range, so all others are dropped before anything is gathered.
    pick = {"lag": F.max_by, "lead": F.min_by, "fill": F.max_by}[mode]
    name = F.struct(*keys)
    ends = rows.groupBy(_SEGMENT).agg(F.min(name).alias("_first"), F.max(name).alias("_last"))
    outer = rows.join(ends, _SEGMENT).where(name.eqNullSafe(F.col("_first")) | name.eqNullSafe(F.col("_last")))
    edges = outer.groupBy(_SEGMENT, *keys).agg(
        *[pick(F.col(c), position if mode != "fill" else F.when(F.col(c).isNotNull(), position)).alias(c) for c in hidden]
    )
    over = Window.partitionBy(*keys).orderBy(_SEGMENT)  # at most one row per range
    move: dict[str, Callable[[str], Column]] = {
        "lag": lambda c: F.lag(c).over(over),
        "lead": lambda c: F.lead(c).over(over),
        "fill": lambda c: F.last(c, ignorenulls=True).over(over.rowsBetween(Window.unboundedPreceding, -1)),
    }
    carried = edges.select(_SEGMENT, *keys, *[move[mode](c).alias(f"_c{c}") for c in hidden])
    carried = carried.select(F.col(_SEGMENT).alias("_s"), *[F.col(k).alias(f"_k_{k}") for k in keys], *[f"_c{c}" for c in hidden])
    on = F.col(_SEGMENT) == F.col("_s")
    for k in keys:
        on &= F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    rows = rows.join(carried, on, "left").drop("_s", *[f"_k_{k}" for k in keys])

    inside = Window.partitionBy(_SEGMENT, *keys).orderBy(*by)
    out = {}
    for n, c in zip(values, hidden):
        if mode == "lag":
            own = F.lag(c).over(inside)
        elif mode == "lead":
            own = F.lead(c).over(inside)
        else:
            own = F.last(c, ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        out[n] = F.coalesce(own, F.col(f"_c{c}"))["v"]
    return rows.withColumns(out).drop(_SEGMENT, _TIE, _ROW, *hidden, *[f"_c{c}" for c in hidden])


def previous_value(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str | Column, out: str, store: Store, parts: int | None = None) -> DataFrame:
    """``lag(value)`` per key in ascending order; null on the first row of a key."""
    return _scan(df, keys, order, {out: value}, "lag", store, parts)


def next_value(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str | Column, out: str, store: Store, parts: int | None = None) -> DataFrame:
    """``lead(value)`` per key in ascending order; null on the last row of a key."""
    return _scan(df, keys, order, {out: value}, "lead", store, parts)


def forward_fill(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Mapping[str, str | Column], store: Store, parts: int | None = None) -> DataFrame:
    """Last non-null value at or before each row, per key."""
    return _scan(df, keys, order, values, "fill", store, parts)


def changed_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], tracked: Sequence[str], store: Store, deleted: str | None = None, parts: int | None = None
) -> DataFrame:
    """Rows that differ in a tracked column from the row before them in their key; with ``deleted``
    the flag counts too and every delete stays."""
    gone = F.coalesce(F.col(deleted), F.lit(False)) if deleted else F.lit(False)
    state = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(tracked)], gone.alias("d"))
    rows = previous_value(df.withColumn("_state", state), keys, order, "_state", "_before", store, parts)
    changed = F.col("_before").isNull() | ~F.col("_before").eqNullSafe(F.col("_state"))
    return rows.where(changed | gone).drop("_state", "_before")


def pit_join(
    spine: DataFrame,
    history: DataFrame,
    keys: Sequence[str],
    at: str,
    take: Mapping[str, str],
    valid_from: str,
    valid_to: str,
    store: Store,
    parts: int | None = None,
) -> DataFrame:
    """Left join each spine row to the history row with ``from <= at < to``, for histories that do not overlap."""
    held = F.struct(F.col(valid_to).alias("_to"), *[F.col(src).alias(out) for out, src in take.items()])
    past = history.select(*keys, F.col(valid_from).alias(at), F.lit(0).alias("_kind"), F.col(valid_to).alias("_until"), held.alias("_h"))
    rows = spine.withColumn("_kind", F.lit(1)).unionByName(past, allowMissingColumns=True)
    rows = forward_fill(rows, keys, [at, "_kind", "_until"], {"_last_h": "_h"}, store, parts).where("_kind = 1")
    valid = F.col(at) < F.col("_last_h._to")
    for k in keys:
        valid &= F.col(k).isNotNull()
    return rows.select(*spine.columns, *[F.when(valid, F.col("_last_h")[out]).alias(out) for out in take])
