"""One point-in-time timeline per key out of several staging histories."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from histkit.functions.nested import classify, null_unless
from histkit.functions.times import OPEN_END, open_end
from histkit.operators.events import union_all
from histkit.operators.joins import pit_join

HOUR = "valid_from_date_hour"


def timeline(
    sources: Mapping[str, tuple[DataFrame, Sequence[str]]],
    key: str,
    hour: str = HOUR,
    valid_to: str = "valid_to_date_hour",
    high: str = OPEN_END,
) -> DataFrame:
    """State of every source at every hour any source changes; one struct column per source.

    Same result as joining each history to the distinct (key, hour) spine by validity, with
    one shuffle instead of one per source: rows of all sources are put in one sequence per
    key and the last known struct of each source is carried forward. A range frame lets rows
    of one hour see each other, so no grouping is needed first. Inputs are staging histories
    with at most one row per key and hour, which bounds a key by the hours of history.
    """
    parts = [
        df.select(key, hour, F.struct(*[F.col(c) for c in cols]).alias(name))
        for name, (df, cols) in sources.items()
    ]
    over = Window.partitionBy(key).orderBy(hour)
    so_far = over.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    state = {n: F.last(n, ignorenulls=True).over(so_far) for n in sources}
    repeat = F.lag(hour).over(over).eqNullSafe(F.col(hour))
    rows = union_all(parts).withColumns({**state, "_repeat": repeat}).where(~F.col("_repeat")).drop("_repeat")
    end = open_end(rows.schema[hour].dataType, high)
    return rows.withColumn(valid_to, F.coalesce(F.lead(hour).over(over), end))


def splice(stored: DataFrame, delta: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """Lay the intervals of ``delta`` over the stored ones of the same keys.

    Wherever a delta interval covers a point in time its row holds, elsewhere the stored row:
    a stored row that is covered in part is closed early, starts late, or is split in two; one
    that is covered whole is gone. Rows of no length (tombstones) stay unless delta covers
    their time or has a row that starts there. Intervals of one side and key do not overlap. Both sides have
    the same columns; one shuffle by key serves all steps.
    """
    names = [c for c in stored.columns if c not in keys]
    row = F.struct(*names)

    def marks(df: DataFrame, side: str) -> DataFrame:
        long = F.col(start) < F.col(end)
        points = F.array(
            F.struct(F.col(start).alias("_at"), row.alias(side), long.alias("_long")),
            F.struct(F.col(end).alias("_at"), F.lit(None).cast(df.select(row.alias("r")).schema["r"].dataType).alias(side), F.lit(True).alias("_long")),
        )
        return df.select(*keys, F.explode(F.when(long, points).otherwise(F.slice(points, 1, 1))).alias("_p")).select(*keys, "_p.*")

    points = union_all([marks(stored.select(*keys, *names), "_old"), marks(delta.select(*keys, *names), "_new")])
    over = Window.partitionBy(*keys).orderBy("_at")
    so_far = over.rangeBetween(Window.unboundedPreceding, Window.currentRow)

    def in_force(side: str) -> Column:
        return F.last(F.when(F.col("_long"), F.col(side)), ignorenulls=True).over(so_far)

    started = F.max(F.col("_new").isNotNull()).over(over.rangeBetween(Window.currentRow, Window.currentRow))
    points = points.withColumns({"_o": in_force("_old"), "_n": in_force("_new"), "_started": started})
    covers = F.coalesce(F.col("_n")[end] > F.col("_at"), F.lit(False))
    held = F.coalesce(F.col("_o")[end] > F.col("_at"), F.lit(False))
    points = points.withColumns({"_covered": covers, "_row": F.when(covers, F.col("_n")).when(held, F.col("_o"))})
    short = points.where(~F.col("_long") & (F.col("_new").isNotNull() | ~(F.col("_covered") | F.col("_started"))))
    tombstones = short.select(*keys, F.coalesce("_new", "_old").alias("_row")).select(*keys, *[F.col("_row")[c].alias(c) for c in names])

    which = F.struct("_covered", F.col("_row")[start].alias("s"))
    cut = points.where("_long").withColumns({"_which": which, "_before": F.lag(which).over(over)})
    cut = cut.where(F.col("_before").isNull() | ~F.col("_before").eqNullSafe(F.col("_which")))
    cut = cut.withColumn("_to", F.lead("_at").over(over)).where(F.col("_row").isNotNull())
    moved = {start: F.col("_at"), end: F.coalesce("_to", F.col("_row")[end])}
    return cut.select(*keys, *[moved.get(c, F.col("_row")[c]).alias(c) for c in names]).unionByName(tombstones)


@dataclass(frozen=True)
class Labels:
    """Names of the classes an identity can be resolved by, in order of precedence."""

    billing: str = "billing"
    legacy: str = "legacy"
    account: str = "legacy-account"
    identity: str = "identity"
    person: str = "primary"


DEFAULT_LABELS = Labels()

# What each source contributes to the unified timeline (stage columns).
SOURCE_COLUMNS = {
    "idt": ("email_address", "phone_number", "create_est_timestamp", "update_est_timestamp"),
    "bp": ("billing_profile_id", "first_name", "last_name", "address_struct"),
    "hh": ("individual_id", "household_id"),
    "event_sub": ("subscription_id", "source_reference", "individual_id", "account_id"),
    "legacy_sub": ("subscription_id", "source_reference", "individual_id", "account_id"),
}


def source_class(
    first_name: Column,
    hh_individual: Column,
    billing_deleted: Column,
    legacy_individual: Column,
    subscription_deleted: Column,
    legacy_account: Column,
    labels: Labels = DEFAULT_LABELS,
) -> Column:
    """Which source identifies the person behind an identity at this hour."""
    billed = first_name.isNotNull() & hh_individual.isNotNull() & (billing_deleted != F.lit(True))
    subscribed = legacy_individual.isNotNull() & (subscription_deleted != F.lit(True))
    return classify(
        [(billed, labels.billing), (subscribed, labels.legacy), (legacy_account.isNotNull(), labels.account)],
        labels.identity,
    )


def _states(stages: Mapping[str, DataFrame], key: str) -> DataFrame:
    sources = {
        name: (df, [*SOURCE_COLUMNS[name], "is_deleted", HOUR]) for name, df in stages.items()
    }
    return timeline(sources, key, HOUR)


def _classified(rows: DataFrame, labels: Labels) -> DataFrame:
    return rows.withColumn(
        "id_source",
        source_class(
            F.col("first_name"),
            F.col("hh_individual_id"),
            F.col("is_billing_deleted"),
            F.col("legacy_individual_id"),
            F.col("is_subscription_deleted"),
            F.col("legacy_account_id"),
            labels,
        ),
    )


def unified_timeline(
    stages: Mapping[str, DataFrame],
    key: str = "identity_id",
    labels: Labels = DEFAULT_LABELS,
    high: str = OPEN_END,
) -> DataFrame:
    """Full-load timeline. Attributes of a source show only while that source is not deleted.

    ``stages``: ``idt``, ``bp``, ``hh``, ``event_sub``, ``legacy_sub`` -> staging history.
    """
    rows = _states(stages, key)

    def alive(source: str) -> Column:
        return F.col(source)["is_deleted"] == F.lit(False)

    def shown(source: str, **names: str) -> dict[str, Column]:
        return null_unless(alive(source), {out: F.col(source)[c] for out, c in names.items()})

    def either(field: str) -> Column:
        return F.coalesce(F.col("event_sub")[field], F.col("legacy_sub")[field])

    def either_alive(field: str) -> Column:
        return F.coalesce(
            F.when(alive("event_sub"), F.col("event_sub")[field]),
            F.when(alive("legacy_sub"), F.col("legacy_sub")[field]),
        )

    end = open_end(rows.schema[HOUR].dataType, high)
    out = {
        "is_current": F.coalesce(alive("idt"), F.lit(False)) & (F.col("valid_to_date_hour") == end),
        **shown("idt", email_address="email_address", phone_number="phone_number"),
        "is_identity_deleted": F.col("idt.is_deleted"),
        "create_est_timestamp": F.col("idt.create_est_timestamp"),
        "update_est_timestamp": F.col("idt.update_est_timestamp"),
        "identity_valid_from": F.col(f"idt.{HOUR}"),
        "billing_profile_id": F.col("bp.billing_profile_id"),
        **shown("bp", first_name="first_name", last_name="last_name", address_struct="address_struct"),
        "is_billing_deleted": F.col("bp.is_deleted"),
        "billing_valid_from": F.col(f"bp.{HOUR}"),
        **shown("hh", hh_individual_id="individual_id", household_id="household_id"),
        "is_household_deleted": F.col("hh.is_deleted"),
        "household_valid_from": F.col(f"hh.{HOUR}"),
        "subscription_id": either("subscription_id"),
        "legacy_subscription_id": either("source_reference"),
        "legacy_individual_id": either_alive("individual_id"),
        "legacy_account_id": either_alive("account_id"),
        "is_subscription_deleted": either("is_deleted"),
        "subscription_valid_from": either(HOUR),
    }
    rows = rows.select(key, HOUR, "valid_to_date_hour", *[c.alias(n) for n, c in out.items()])
    return _classified(rows, labels)


def unified_timeline_delta(
    stages: Mapping[str, DataFrame],
    target: DataFrame,
    key: str = "identity_id",
    labels: Labels = DEFAULT_LABELS,
    high: str = OPEN_END,
) -> DataFrame:
    """Timeline of a delta load: what a source does not say comes from the target row valid then.

    ``target`` holds the columns of :func:`histkit.operators.resolve.identity_history`. A
    deleted identity is closed at its own hour.
    """
    rows = _states(stages, key)
    info = "additional_info_struct"
    target = target.select(
        key,
        "valid_from_est_timestamp",
        "valid_to_est_timestamp",
        "email_address",
        "phone_number",
        "created_est_timestamp",
        "is_deleted",
        "first_name",
        "last_name",
        "address_struct",
        "individual_id",
        "individual_id_source",
        *[F.col(f"{info}.{f}").alias(f"i_{c}") for f, c in INFO_FIELDS.items()],
    )
    # Only identities of the batch are looked at: the stored history of all others stays where it is.
    batch = reduce(DataFrame.union, [df.select(key) for df in stages.values()]).distinct()
    target = target.join(batch, key, "left_semi")
    take = {f"_u_{c}": c for c in target.columns if c != key}
    rows = pit_join(
        rows, target, [key], HOUR, take, "valid_from_est_timestamp", "valid_to_est_timestamp"
    )

    def both(source: str, field: str, kept: str) -> Column:
        return F.coalesce(F.col(source)[field], F.col(f"_u_{kept}"))

    def kept_individual(label: str) -> Column:
        return F.when(F.col("_u_individual_id_source") == label, F.col("_u_individual_id"))

    def sub(field: str, *more: Column) -> Column:
        return F.coalesce(F.col("event_sub")[field], F.col("legacy_sub")[field], *more)

    gone = F.coalesce(F.col("idt.is_deleted"), F.lit(False))
    end = open_end(rows.schema[HOUR].dataType, high)
    to = F.when(gone, F.col(HOUR)).otherwise(F.col("valid_to_date_hour"))
    alive = F.coalesce(F.col("idt.is_deleted") == F.lit(False), F.lit(False))
    out = {
        "valid_to_date_hour": to,
        "is_current": alive & (to == end),
        "email_address": both("idt", "email_address", "email_address"),
        "phone_number": both("idt", "phone_number", "phone_number"),
        "is_identity_deleted": both("idt", "is_deleted", "is_deleted"),
        "create_est_timestamp": both("idt", "create_est_timestamp", "created_est_timestamp"),
        "update_est_timestamp": F.col("idt.update_est_timestamp"),
        "identity_valid_from": both("idt", HOUR, "i_identity_valid_from"),
        "billing_profile_id": F.col("bp.billing_profile_id"),
        "first_name": both("bp", "first_name", "first_name"),
        "last_name": both("bp", "last_name", "last_name"),
        "address_struct": both("bp", "address_struct", "address_struct"),
        "is_billing_deleted": both("bp", "is_deleted", "i_is_billing_deleted"),
        "billing_valid_from": both("bp", HOUR, "i_billing_valid_from"),
        "hh_individual_id": F.coalesce(F.col("hh.individual_id"), kept_individual(labels.billing)),
        "household_id": F.col("hh.household_id"),
        "is_household_deleted": both("hh", "is_deleted", "i_is_household_deleted"),
        "household_valid_from": both("hh", HOUR, "i_household_valid_from"),
        "subscription_id": sub("subscription_id"),
        "legacy_subscription_id": sub("source_reference"),
        "legacy_individual_id": sub("individual_id", kept_individual(labels.legacy)),
        "legacy_account_id": sub("account_id", F.col("_u_i_legacy_account_id")),
        "is_subscription_deleted": sub("is_deleted", F.col("_u_i_is_subscription_deleted")),
        "subscription_valid_from": F.coalesce(
            F.col("event_sub")[HOUR], F.col("_u_i_subscription_valid_from")
        ),
    }
    return _classified(rows.select(key, HOUR, *[c.alias(n) for n, c in out.items()]), labels)


# Fields of a history row's additional_info_struct, in order -> timeline column.
INFO_FIELDS = {
    "billing_profile_id": "billing_profile_id",
    "subscription_id": "subscription_id",
    "legacy_subscription_id": "legacy_subscription_id",
    "identity_valid_from_est_timestamp": "identity_valid_from",
    "billing_profile_valid_from_est_timestamp": "billing_valid_from",
    "household_link_valid_from_est_timestamp": "household_valid_from",
    "subscription_valid_from_est_timestamp": "subscription_valid_from",
    "is_billing_profile_deleted": "is_billing_deleted",
    "is_household_link_deleted": "is_household_deleted",
    "is_subscription_deleted": "is_subscription_deleted",
    "linked_legacy_account_id": "legacy_account_id",
}
