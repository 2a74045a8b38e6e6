"""Previous row, next row and forward fill per key, also for keys too big for one task.

Without ``slice_by`` these are ordinary windows over the key. That is the right plan once
events are reduced to one row per key and local hour or day: a key then has at most one
row per hour of history, however many events it had.

With ``slice_by`` - an expression that never decreases along the order, such as the hour of
the event - hot keys are cut into slices. A key is hot when it holds more than ``HOT_SHARE``
of all rows (and more than ``hot_rows``); there are at most ``1 / HOT_SHARE`` such keys, so
the list of them is always small enough to broadcast. Rows are windowed inside (key, slice),
and what crosses a slice border arrives as one extra row per (hot key, slice). Those border
rows come from an aggregation with map-side combine, and the window over them holds one row
per slice of a key, a number bounded by the length of the history and not by the data. All
other keys keep one slice. The price is a count per key and a second, narrow read of the hot
keys' rows.

Rows that tie in the order are put in the order of a hash of the whole row, here and there, so
the answer depends neither on a key's size nor on the partitioning.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from histkit.functions.times import col_of

HOT_SHARE = 1e-4
HOT_ROWS = 100_000

_SLICE, _SEED, _HOT, _TIE = "_slice", "_seed", "_hot", "_tie"


def _with_tie(df: DataFrame) -> DataFrame:
    """Add a hash of the row as the last part of the order. Maps have no hash and are left out."""
    plain = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    return df.withColumn(_TIE, F.xxhash64(*[F.col(f"`{n}`") for n in plain]))


def _held(values: Mapping[str, str | Column]) -> dict[str, str]:
    """Output name -> column that carries its value; expressions get a hidden column."""
    return {n: v if isinstance(v, str) else f"_v_{n}" for n, v in values.items()}


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys with more than ``HOT_SHARE`` of all rows, at most ``1 / HOT_SHARE`` of them."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    return counts.where((F.col("_n") > hot_rows) & (F.col("_n") > total * HOT_SHARE)).select(*keys)


def _mark_hot(df: DataFrame, keys: Sequence[str], hot_rows: int) -> DataFrame:
    hot = hot_keys(df, keys, hot_rows)
    hot = hot.select(*[F.col(k).alias(f"_hot_{k}") for k in keys], F.lit(True).alias(_HOT))
    on = [F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in keys]
    return df.join(F.broadcast(hot), on, "left").drop(*[f"_hot_{k}" for k in keys])


def _with_borders(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: Mapping[str, str | Column],
    slice_by: str | Column,
    mode: str,
    hot_rows: int,
) -> DataFrame:
    """The rows plus one border row per (key, slice) that carries a value in from its neighbour."""
    held = _held(values)
    hidden = {held[n]: v for n, v in values.items() if not isinstance(v, str)}
    order = [*order, _TIE]
    slices = F.when(F.col(_HOT), col_of(slice_by))
    base = _mark_hot(df, keys, hot_rows).withColumns({_SLICE: slices, _SEED: F.lit(0), **hidden})
    position = F.struct(*[F.col(c) for c in order])

    def edge(column: str) -> Column:
        boxed = F.struct(F.col(column).alias("v"))
        if mode == "lead":
            return F.min_by(boxed, position)
        if mode == "lag":
            return F.max_by(boxed, position)
        known = F.col(column).isNotNull()
        return F.max_by(F.when(known, boxed), F.when(known, position))

    edges = base.where(F.col(_HOT)).groupBy(*keys, _SLICE).agg(*[edge(c).alias(f"_e_{n}") for n, c in held.items()])
    over = Window.partitionBy(*keys).orderBy(_SLICE)
    before = over.rowsBetween(Window.unboundedPreceding, -1)
    move = {
        "lead": lambda c: F.lead(c).over(over),
        "lag": lambda c: F.lag(c).over(over),
        "fill": lambda c: F.last(c, ignorenulls=True).over(before),
    }[mode]
    moved = edges.select(*keys, _SLICE, *[move(f"_e_{n}").alias(f"_e_{n}") for n in held])
    some = reduce(lambda a, b: a | b, [F.col(f"_e_{n}").isNotNull() for n in held])
    seeds = moved.where(some).select(
        *keys,
        _SLICE,
        F.lit(1 if mode == "lead" else -1).alias(_SEED),
        *[F.col(f"_e_{n}")["v"].alias(c) for n, c in held.items()],
    )
    return base.unionByName(seeds, allowMissingColumns=True)


def _drop_borders(df: DataFrame, values: Mapping[str, str | Column]) -> DataFrame:
    hidden = [f"_v_{n}" for n, v in values.items() if not isinstance(v, str)]
    return df.where(F.col(_SEED) == 0).drop(_SLICE, _SEED, _HOT, _TIE, *hidden)


def _neighbour(df, keys, order, value, out, slice_by, hot_rows, fn, mode):
    df = _with_tie(df)
    if slice_by is None:
        over = Window.partitionBy(*keys).orderBy(*[F.col(c).asc() for c in [*order, _TIE]])
        return df.withColumn(out, fn(col_of(value)).over(over)).drop(_TIE)
    values = {out: value}
    rows = _with_borders(df, keys, order, values, slice_by, mode, hot_rows)
    over = Window.partitionBy(*keys, _SLICE).orderBy(_SEED, *[F.col(c).asc() for c in [*order, _TIE]])
    return _drop_borders(rows.withColumn(out, fn(F.col(_held(values)[out])).over(over)), values)


def previous_value(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str | Column,
    out: str,
    slice_by: str | Column | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``lag(value)`` per key in ascending order; null on the first row of a key."""
    return _neighbour(df, keys, order, value, out, slice_by, hot_rows, F.lag, "lag")


def next_value(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str | Column,
    out: str,
    slice_by: str | Column | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``lead(value)`` per key in ascending order; null on the last row of a key."""
    return _neighbour(df, keys, order, value, out, slice_by, hot_rows, F.lead, "lead")


def forward_fill(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: Mapping[str, str | Column],
    slice_by: str | Column | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Last non-null value at or before each row, per key."""
    df = _with_tie(df)
    asc = [F.col(c).asc() for c in [*order, _TIE]]
    if slice_by is None:
        over = Window.partitionBy(*keys).orderBy(*asc)
        over = over.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.withColumns({n: F.last(col_of(v), ignorenulls=True).over(over) for n, v in values.items()}).drop(_TIE)
    rows = _with_borders(df, keys, order, values, slice_by, "fill", hot_rows)
    over = Window.partitionBy(*keys, _SLICE).orderBy(_SEED, *asc)
    over = over.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = {n: F.last(c, ignorenulls=True).over(over) for n, c in _held(values).items()}
    return _drop_borders(rows.withColumns(filled), values)
