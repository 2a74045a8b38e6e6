"""MERGE as joins that yield the new target, for tables without a MERGE command.

The target is left-joined to the source, so Spark can broadcast a small source and split a
skewed key; source rows without a target row come from an anti join against the keys they
share with the target. Only a clause for absent rows needs a full outer join.

Every function returns the target's columns plus ``_action`` (``keep``, ``insert``,
``update``, ``delete``), deleted rows included, so one DataFrame gives both the new
contents (:func:`merged_rows`) and the load counts (:func:`merge_metrics`).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from histkit.functions.casts import nullable
from histkit.functions.hashing import comparable
from histkit.operators.scd2 import DEFAULT_COLUMNS, Scd2Columns

ACTION = "_action"
_COPIES, _IN_T, _IN_S = "_copies", "_in_target", "_in_source"


@dataclass(frozen=True)
class Clause:
    """One WHEN clause; conditions and values refer to ``t.<column>`` and ``s.<column>``.

    ``kind``: ``matched``, ``not_matched`` (source only) or ``not_matched_by_source``.
    ``values`` maps target columns, or fields of struct columns (``a.b``), to new values;
    an insert without values takes the source columns of the same name.
    """

    kind: str
    action: str
    when: Column | None = None
    values: Mapping[str, Column] = field(default_factory=dict)


def matched_update(values: Mapping[str, Column], when: Column | None = None) -> Clause:
    return Clause("matched", "update", when, values)


def matched_delete(when: Column | None = None) -> Clause:
    return Clause("matched", "delete", when)


def insert_missing(values: Mapping[str, Column] | None = None, when: Column | None = None) -> Clause:
    return Clause("not_matched", "insert", when, values or {})


def delete_absent(when: Column | None = None) -> Clause:
    return Clause("not_matched_by_source", "delete", when)


def any_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def _new_value(name: str, c: Clause, base: Column) -> Column:
    if name in c.values:
        return c.values[name]
    nested = {k.split(".", 1)[1]: v for k, v in c.values.items() if k.startswith(name + ".")}
    for path, value in nested.items():
        base = base.withField(path, value)
    return base


def merge(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    clauses: Sequence[Clause],
    source_unique: bool = False,
) -> DataFrame:
    """Apply the clauses in order; per row the first one of its kind whose condition holds wins.

    Null keys never match. Several source rows for one target row are an error, raised when
    the row is computed, as soon as one of them would change it; if none would, the target
    row is kept once. ``source_unique`` promises one source row per key and skips the check.
    """
    keys = list(keys)
    absent = any(c.kind == "not_matched_by_source" for c in clauses)
    s = source.withColumn(_IN_S, F.lit(True))
    s_known, s_null = s.where(~any_null(keys)), s.where(any_null(keys))
    t = target.withColumn(_IN_T, F.lit(True))
    copied = None
    if not source_unique:
        copied = s_known.groupBy(*keys).agg(F.count(F.lit(1)).alias(_COPIES)).where(F.col(_COPIES) > 1)
        s_known = s_known.join(copied, keys, "left").select(*s.columns, _COPIES)
        s_null = s_null.withColumn(_COPIES, F.lit(None).cast("bigint"))
    on = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
    if absent:
        t_known, t_null = t.where(~any_null(keys)), t.where(any_null(keys))
        branches = [t_known.alias("t").join(s_known.alias("s"), on, "full"), t_null.alias("t").join(s_null.where(F.lit(False)).alias("s"), on, "left")]
        new = s_null
    else:
        branches = [t.alias("t").join(s_known.alias("s"), on, "left")]
        shared = target.select(*keys).join(s_known.select(*keys).distinct(), keys, "left_semi").distinct()
        new = s_known.join(shared, keys, "left_anti").select(*s_null.columns).unionByName(s_null)
    if any(c.kind == "not_matched" for c in clauses):
        branches.append(t.where(F.lit(False)).alias("t").join(new.alias("s"), on, "right"))

    def resolved(rows: DataFrame) -> DataFrame:
        return _resolved(rows, target, source, clauses, source_unique)

    merged = reduce(DataFrame.unionByName, map(resolved, branches))
    if copied is None:
        return merged
    # A target row met by several source rows that leave it alone stays one row.
    left_alone = target.join(copied.select(*keys), keys, "left_semi").select(*target.columns)
    return merged.unionByName(left_alone.withColumn(ACTION, F.lit("keep")))


def _resolved(rows: DataFrame, target: DataFrame, source: DataFrame, clauses: Sequence[Clause], source_unique: bool) -> DataFrame:
    """Joined rows -> target columns and action, by the first clause that holds."""
    in_t, in_s = F.col(f"t.{_IN_T}").isNotNull(), F.col(f"s.{_IN_S}").isNotNull()
    kinds = {"matched": in_t & in_s, "not_matched": ~in_t & in_s, "not_matched_by_source": in_t & ~in_s}

    def holds(c: Clause) -> Column:
        cond = kinds[c.kind]
        return cond if c.when is None else cond & F.coalesce(c.when, F.lit(False))

    chosen = F.lit(-1)
    for i, c in reversed(list(enumerate(clauses))):
        chosen = F.when(holds(c), F.lit(i)).otherwise(chosen)
    if not source_unique:
        clash = in_t & F.col(f"s.{_COPIES}").isNotNull() & (chosen >= 0)
        chosen = F.when(
            clash, F.raise_error(F.lit("more than one source row matches a target row")).cast("int")
        ).otherwise(chosen)
    rows = rows.withColumn("_clause", chosen)

    pick = F.col("_clause")
    out, source_names = [], set(source.columns)
    for f in target.schema.fields:
        value = F.col(f"t.{f.name}")
        for i, c in enumerate(clauses):
            if c.action == "delete":
                continue
            if c.action == "insert":
                if c.values:
                    new = c.values.get(f.name, F.lit(None))
                else:
                    new = F.col(f"s.{f.name}") if f.name in source_names else F.lit(None)
            else:
                new = _new_value(f.name, c, F.col(f"t.{f.name}"))
            value = F.when(pick == i, new.cast(nullable(f.dataType))).otherwise(value)
        out.append(value.alias(f.name))
    action = F.when(in_t, F.lit("keep"))
    for i, c in enumerate(clauses):
        action = F.when(pick == i, F.lit(c.action)).otherwise(action)
    # Source rows that no insert clause takes do not reach the target.
    once = in_t if source_unique else in_t & F.col(f"s.{_COPIES}").isNull()
    return rows.where(once | (pick >= 0)).select(*out, action.alias(ACTION))


def merged_rows(merged: DataFrame) -> DataFrame:
    return merged.where(F.col(ACTION) != "delete").drop(ACTION)


def merge_metrics(merged: DataFrame) -> DataFrame:
    """Rows per action."""
    return merged.groupBy(F.col(ACTION).alias("action")).agg(F.count(F.lit(1)).alias("row_count"))


def merge_scd1(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    type_col: str = "envelopeType",
    delete_pattern: str = "Deleted",
    deletes: bool = True,
    audit: str = "etl_metadata_struct",
    update_field: str = "etl_update_est_timestamp",
    source_unique: bool = False,
) -> DataFrame:
    """Type-1 upsert. With deletes on, delete events remove their row and are never inserted.

    An update replaces every column but the audit struct, of which only the update time changes.
    """
    values = {c: F.col(f"s.{c}") for c in target.columns if c != audit}
    if audit in target.columns:
        values[f"{audit}.{update_field}"] = F.col(f"s.{audit}.{update_field}")
    is_delete = F.col(f"s.{type_col}").contains(delete_pattern)
    clauses = [matched_update(values)]
    if deletes:
        clauses = [matched_delete(is_delete), *clauses]
        clauses.append(insert_missing(when=~is_delete | F.col(f"s.{type_col}").isNull()))
    else:
        clauses.append(insert_missing())
    return merge(target, source, keys, clauses, source_unique)


def merge_scd2(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    as_of_local: Column | None = None,
    cols: Scd2Columns = DEFAULT_COLUMNS,
    update_field: str = "etl_update_est_timestamp",
    source_unique: bool = False,
) -> DataFrame:
    """Close current rows the batch superseded and insert new versions, matched on key and start."""
    values = {cols.is_current: F.lit(False), cols.valid_to: F.col(f"s.{cols.valid_to}")}
    if as_of_local is not None and cols.audit in target.columns:
        values[f"{cols.audit}.{update_field}"] = as_of_local
    close = F.col(f"t.{cols.is_current}") & ~F.col(f"s.{cols.is_current}")
    clauses = [matched_update(values, close), insert_missing()]
    return merge(target, source, [*keys, cols.valid_from], clauses, source_unique)


def merge_scd2_current(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    as_of_local: Column | None = None,
    cols: Scd2Columns = DEFAULT_COLUMNS,
) -> DataFrame:
    """:func:`merge_scd2` that joins only the open rows and passes closed history through.

    Right when the source went through ``consolidate``: such rows start after everything
    stored for their key, so none can match a closed row. Closed history, nearly all of a
    big target, is then neither shuffled nor compared.
    """
    is_open = F.coalesce(F.col(cols.is_current), F.lit(False))
    live = merge_scd2(target.where(is_open), source, keys, as_of_local, cols, source_unique=True)
    return live.unionByName(target.where(~is_open).withColumn(ACTION, F.lit("keep")))


def upsert_replace(target: DataFrame, stage: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Delete target rows whose key is staged, then insert every stage row."""
    staged = stage.select(*keys).distinct().withColumn("_staged", F.lit(True))
    action = F.when(F.col("_staged"), F.lit("delete")).otherwise(F.lit("keep"))
    old = target.join(staged, list(keys), "left").select(*target.columns, action.alias(ACTION))
    return old.unionByName(stage.select(*target.columns).withColumn(ACTION, F.lit("insert")))


def sync(
    target: DataFrame,
    stage: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
    source_unique: bool = False,
) -> DataFrame:
    """Make the target hold exactly the staged keys: update, insert, and delete what is absent."""
    shared = columns or [c for c in stage.columns if c in target.columns and c not in keys]
    update = matched_update({c: F.col(f"s.{c}") for c in shared})
    insert = insert_missing({c: F.col(f"s.{c}") for c in [*keys, *shared]})
    return merge(target, stage, keys, [update, insert, delete_absent()], source_unique)


def merge_if_different(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    compare: Mapping[str, str],
    update: Mapping[str, Column],
    insert: Mapping[str, Column],
    source_unique: bool = False,
) -> DataFrame:
    """Update a matched row only when a compared attribute differs; null to value is a difference.

    ``compare``: target column -> source column.
    """
    differs = reduce(
        lambda a, b: a | b,
        [~F.col(f"t.{t}").eqNullSafe(F.col(f"s.{s}")) for t, s in compare.items()],
    )
    return merge(target, source, keys, [matched_update(update, differs), insert_missing(insert)], source_unique)


def new_and_updated(
    source: DataFrame, target: DataFrame, keys: Sequence[str], exclude: Sequence[str] = ("etl_metadata_struct",)
) -> DataFrame:
    """Source rows that are absent from the target or differ from its row in a shared column."""
    shared = [c for c in source.columns if c in target.columns and c not in keys and c not in set(exclude)]
    mine = source.withColumn("_new", F.struct(*comparable(source, shared)))
    theirs = target.select(*keys, F.struct(*comparable(target, shared)).alias("_old"))
    return mine.join(theirs, list(keys), "left").where(~F.col("_new").eqNullSafe(F.col("_old"))).select(*source.columns)
