"""Persons behind identities: stable ids, the person dimension, and the identity history."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from histkit.functions.casts import nullable
from histkit.functions.nested import match_flag
from histkit.functions.times import DEFAULT_ZONE, OPEN_END, col_of, local_time, open_end, timestamp_literal, trunc_hour
from histkit.operators.events import top_rank
from histkit.operators.components import Store, components, survivors
from histkit.operators.joins import missing_keys
from histkit.operators.merge import merge_if_different, merged_rows
from histkit.operators.timeline import DEFAULT_LABELS, HOUR, INFO_FIELDS, Labels

ADDRESS_FIELDS = ("city", "state", "zip_code", "address_line_1", "address_line_2", "country")
ACTIVE = "active"
ACCOUNT_PREFIX = "A:"


def person_id(kind: str | Column, key: str | Column) -> Column:
    """Same class and natural key, same id: loads can be repeated and run in any order."""
    kind_col = F.lit(kind) if isinstance(kind, str) else kind
    return F.sha2(F.concat(kind_col, F.lit("|"), col_of(key).cast("string")), 256)


def _insert(person: DataFrame, rows: DataFrame) -> DataFrame:
    """Append rows to the person table; columns they do not have stay null."""
    known = [f for f in person.schema.fields if f.name in rows.columns]
    typed = rows.select(*[F.col(f.name).cast(nullable(f.dataType)).alias(f.name) for f in known])
    return person.unionByName(typed, allowMissingColumns=True)


def upsert_primary_persons(
    person: DataFrame, timeline: DataFrame, labels: Labels = DEFAULT_LABELS
) -> DataFrame:
    """Persons known from billing: the most recently updated identity of an individual is primary.

    Returns the new table with ``_action``. An existing person keeps its id, takes over the
    attributes when any differs, and loses its legacy primary account.
    """
    best = top_rank(
        timeline.where((F.col("id_source") == labels.billing) & F.col("hh_individual_id").isNotNull()),
        ["hh_individual_id"],
        ["update_est_timestamp", HOUR, "identity_id"],
    )
    src = best.select(
        person_id("individual", "hh_individual_id").alias("person_id"),
        F.lit(labels.person).alias("source"),
        F.col("hh_individual_id").alias("individual_id"),
        "household_id",
        F.col("email_address").alias("best_email_address"),
        F.col("address_struct").alias("best_address_struct"),
        F.col("first_name").alias("best_first_name"),
        F.col("last_name").alias("best_last_name"),
        F.col("phone_number").alias("best_phone_number"),
        F.lit(ACTIVE).alias("state"),
        F.col("identity_id").alias("primary_identity_id"),
    )
    changing = [c for c in src.columns if c not in ("person_id", "individual_id", "state")]
    update = {c: F.col(f"s.{c}") for c in changing}
    update["primary_legacy_account_id"] = F.lit(None)
    insert = {c: F.col(f"s.{c}") for c in src.columns}
    return merge_if_different(
        person, src, ["individual_id"], {c: c for c in changing}, update, insert, source_unique=True
    )


def legacy_address(prefix: str = "best_address_") -> Column:
    parts = {
        "city": "city",
        "state": "state",
        "zip_code": "zip_code",
        "address_line_1": "line1",
        "address_line_2": "line2",
    }
    country = F.substring(F.col(f"{prefix}country_code"), 1, 2).alias("country")
    return F.struct(*[F.col(prefix + c).alias(n) for n, c in parts.items()], country)


def _legacy_rows(devices: DataFrame, individuals: DataFrame, labels: Labels, updated: str) -> DataFrame:
    latest = top_rank(
        devices.where("account_id is not null and individual_id is not null"),
        ["individual_id"],
        [updated, "account_id"],
    ).select("individual_id", "account_id")
    return latest.join(individuals, "individual_id").select(
        person_id("individual", "individual_id").alias("person_id"),
        F.lit(labels.legacy).alias("source"),
        "individual_id",
        "household_id",
        "best_email_address",
        legacy_address().alias("best_address_struct"),
        F.col("first_name").alias("best_first_name"),
        F.col("last_name").alias("best_last_name"),
        "best_phone_number",
        F.lit(ACTIVE).alias("state"),
        F.col("account_id").alias("primary_legacy_account_id"),
    )


def _account_rows(person: DataFrame, devices: DataFrame, labels: Labels) -> DataFrame:
    rows = (
        devices.where("account_id is not null and individual_id is null")
        .select("account_id")
        .distinct()
        .select(
            person_id("account", "account_id").alias("person_id"),
            F.lit(labels.account).alias("source"),
            F.lit(ACTIVE).alias("state"),
            F.col("account_id").alias("primary_legacy_account_id"),
        )
    )
    known = person.where(F.col("source") == labels.account)
    return missing_keys(rows, known, ["primary_legacy_account_id"])


def _identity_rows(person: DataFrame, timeline: DataFrame, labels: Labels) -> DataFrame:
    rows = top_rank(timeline.where(F.col("id_source") == labels.identity), ["identity_id"], [HOUR]).select(
        person_id("identity", "identity_id").alias("person_id"),
        F.lit(labels.identity).alias("source"),
        F.col("email_address").alias("best_email_address"),
        F.col("phone_number").alias("best_phone_number"),
        F.lit(ACTIVE).alias("state"),
        F.col("identity_id").alias("primary_identity_id"),
    )
    known = person.where(F.col("source") == labels.identity)
    return missing_keys(rows, known, ["primary_identity_id"])


def insert_legacy_persons(
    person: DataFrame,
    devices: DataFrame,
    individuals: DataFrame,
    labels: Labels = DEFAULT_LABELS,
    updated: str = "update_est_timestamp",
) -> DataFrame:
    """Add persons of the legacy tables that are not known by individual id yet."""
    rows = _legacy_rows(devices, individuals, labels, updated)
    return _insert(person, missing_keys(rows, person, ["individual_id"]))


def insert_account_persons(
    person: DataFrame, devices: DataFrame, labels: Labels = DEFAULT_LABELS
) -> DataFrame:
    """One person per legacy account that has a row without an individual."""
    return _insert(person, _account_rows(person, devices, labels))


def insert_identity_persons(
    person: DataFrame, timeline: DataFrame, labels: Labels = DEFAULT_LABELS
) -> DataFrame:
    """One person per identity that nothing else resolves."""
    return _insert(person, _identity_rows(person, timeline, labels))


def refresh_identity_persons(person: DataFrame, timeline: DataFrame, labels: Labels = DEFAULT_LABELS) -> DataFrame:
    """Persons that only an identity stands for, from its newest row: (new table, with ``_action``).

    A full load takes them from all rows at once; a delta load has to follow newer rows to give the same table.
    """
    newest = top_rank(timeline.where(F.col("id_source") == labels.identity), ["identity_id"], [HOUR])
    src = newest.select(
        person_id("identity", "identity_id").alias("person_id"),
        F.lit(labels.identity).alias("source"),
        F.col("email_address").alias("best_email_address"),
        F.col("phone_number").alias("best_phone_number"),
        F.lit(ACTIVE).alias("state"),
        F.col("identity_id").alias("primary_identity_id"),
    )
    changing = ["best_email_address", "best_phone_number"]
    return merge_if_different(
        person,
        src,
        ["source", "primary_identity_id"],
        {c: c for c in changing},
        {c: F.col(f"s.{c}") for c in changing},
        {c: F.col(f"s.{c}") for c in src.columns},
        source_unique=True,
    )


def resolve_persons(
    person: DataFrame,
    timeline: DataFrame,
    devices: DataFrame,
    individuals: DataFrame,
    labels: Labels = DEFAULT_LABELS,
    updated: str = "update_est_timestamp",
) -> DataFrame:
    """The four person loads as one union.

    Same result as running them one after the other, but every step compares with the
    stored table instead of with the plan of the steps before it: the billing load only adds
    individuals (so the legacy load also skips those), and the other two look at classes
    only they write.
    """
    merged = merged_rows(upsert_primary_persons(person, timeline, labels))
    billed = timeline.where((F.col("id_source") == labels.billing) & F.col("hh_individual_id").isNotNull())
    known = person.select("individual_id").unionByName(
        billed.select(F.col("hh_individual_id").alias("individual_id")).distinct()
    )
    legacy = missing_keys(_legacy_rows(devices, individuals, labels, updated), known, ["individual_id"])
    out = merged
    for rows in (legacy, _account_rows(person, devices, labels), _identity_rows(person, timeline, labels)):
        out = _insert(out, rows)
    return out


_BEST = {
    "is_best_first_name": ("first_name", "best_first_name"),
    "is_best_last_name": ("last_name", "best_last_name"),
    "is_best_email_address": ("email_address", "best_email_address"),
    "is_best_phone_number": ("phone_number", "best_phone_number"),
    "is_best_address": ("address_struct", "best_address_struct"),
}


def best_flags(ours: Mapping[str, str] | None = None) -> dict[str, Column]:
    """Does each attribute equal the person's best one? Columns of the person are ``p_*``."""
    rename = ours or {}
    return {
        flag: match_flag(F.col(rename.get(mine, mine)), F.col(f"p_{best}"))
        for flag, (mine, best) in _BEST.items()
    }


_PERSON_NAMES = ("person_id", "primary_identity_id", "primary_legacy_account_id", *[b for _, b in _BEST.values()])


def _person_columns(person: DataFrame) -> list[Column]:
    return [F.col(n).alias(f"p_{n}") for n in _PERSON_NAMES]


def _key(name: str) -> Column:
    """Keys of different sources share one column, as text."""
    return F.col(name).cast("string")


def load_times(as_of: str | datetime | None, zone: str = DEFAULT_ZONE) -> Column:
    """The audit struct of the identity tables: local time of the load, twice; null without one."""
    now = F.lit(None).cast("timestamp") if as_of is None else local_time(timestamp_literal(as_of), zone)
    return F.struct(now.alias("etl_create_est_timestamp"), now.alias("etl_update_est_timestamp")).alias("etl_metadata_struct")


def natural_key(labels: Labels = DEFAULT_LABELS) -> tuple[Column, Column]:
    """How a timeline row finds its person: the kind of key, and the key as text."""
    is_class = {c: F.col("id_source") == getattr(labels, c) for c in ("billing", "legacy", "account")}
    kind = (
        F.when(is_class["billing"] | is_class["legacy"], F.lit("individual"))
        .when(is_class["account"], F.lit("account"))
        .otherwise(F.lit("identity"))
    )
    natural = (
        F.when(is_class["billing"], _key("hh_individual_id"))
        .when(is_class["legacy"], _key("legacy_individual_id"))
        .when(is_class["account"], _key("legacy_account_id"))
        .otherwise(_key("identity_id"))
    )
    return kind, natural


def ways_to_persons(person: DataFrame, labels: Labels = DEFAULT_LABELS) -> DataFrame:
    """Persons (columns ``p_*``), one row per way they can be found: by individual, by account or by identity."""
    ways = F.array(
        F.struct(F.lit("individual").alias("_kind"), _key("individual_id").alias("_natural")),
        F.struct(
            F.lit("account").alias("_kind"),
            F.when(F.col("source") == labels.account, _key("primary_legacy_account_id")).alias("_natural"),
        ),
        F.struct(
            F.lit("identity").alias("_kind"),
            F.when(F.col("source") == labels.identity, _key("primary_identity_id")).alias("_natural"),
        ),
    )
    return (
        person.select(F.explode(ways).alias("_way"), *_person_columns(person))
        .select("_way.*", *[f"p_{n}" for n in _PERSON_NAMES])
        .where(F.col("_natural").isNotNull())
    )


def identity_history(
    timeline: DataFrame, person: DataFrame, labels: Labels = DEFAULT_LABELS, as_of: str | datetime | None = None
) -> DataFrame:
    """Timeline rows of all four classes with their person, best-attribute flags and prior person.

    Each class looks the person up by its own key; one join on (kind of key, key) serves all
    four. The prior person is the one before on the same identity, whatever class it came
    from, and is set only when it changed.
    """
    is_class = {c: F.col("id_source") == getattr(labels, c) for c in ("billing", "legacy", "account")}
    kind, natural = natural_key(labels)
    people = ways_to_persons(person, labels)
    rows = timeline.withColumns({"_kind": kind, "_natural": natural}).join(
        people, ["_kind", "_natural"], "left"
    )
    own_key = F.when(is_class["account"], match_flag(F.col("legacy_account_id"), F.col("p_primary_legacy_account_id")))
    over = Window.partitionBy("identity_id").orderBy(HOUR)
    before = F.lag("p_person_id").over(over)
    rows = rows.withColumn("_prior", before)
    moved = F.col("_prior").isNotNull() & ~F.col("_prior").eqNullSafe(F.col("p_person_id"))
    individual = F.when(is_class["billing"], F.col("hh_individual_id")).when(
        is_class["legacy"], F.col("legacy_individual_id")
    )
    return rows.select(
        _key("identity_id").alias("unified_identity_id"),
        F.lit(labels.person).alias("source"),
        "identity_id",
        F.lit(None).cast(person.schema["primary_legacy_account_id"].dataType).alias("legacy_account_id"),
        F.col("p_person_id").alias("person_id"),
        individual.alias("individual_id"),
        F.col("id_source").alias("individual_id_source"),
        "email_address",
        "address_struct",
        "first_name",
        "last_name",
        "phone_number",
        *[c.alias(n) for n, c in best_flags().items()],
        own_key.otherwise(match_flag(F.col("identity_id"), F.col("p_primary_identity_id"))).alias("is_primary"),
        F.col("create_est_timestamp").alias("created_est_timestamp"),
        F.col(HOUR).alias("valid_from_est_timestamp"),
        F.col("valid_to_date_hour").alias("valid_to_est_timestamp"),
        "is_current",
        F.col("is_identity_deleted").alias("is_deleted"),
        F.struct(*[F.col(c).alias(f) for f, c in INFO_FIELDS.items()]).alias("additional_info_struct"),
        F.struct(
            F.when(moved, F.col("_prior")).alias("prior_person_id"),
            F.when(moved, F.col(HOUR)).alias("change_est_timestamp"),
        ).alias("prior_person_struct"),
        load_times(as_of),
    )


def legacy_account_history(
    devices: DataFrame,
    individuals: DataFrame,
    person: DataFrame,
    labels: Labels = DEFAULT_LABELS,
    updated: str = "update_est_timestamp",
    high: str = OPEN_END,
    as_of: str | datetime | None = None,
) -> DataFrame:
    """Open history rows of legacy accounts, with and without an individual."""
    end = open_end(devices.schema[updated].dataType, high)
    known = devices.where(F.col("account_id").isNotNull())
    with_person = person.select("individual_id", *_person_columns(person))

    newest = top_rank(known.where("individual_id is not null"), ["account_id"], [updated, "individual_id"])
    named = (
        newest.select("account_id", "individual_id")
        .join(individuals, "individual_id")
        .withColumn("address_struct", legacy_address())
        .join(with_person, "individual_id", "left")
        .select(
            "account_id",
            F.col("p_person_id").alias("person_id"),
            "individual_id",
            F.lit(labels.legacy).alias("individual_id_source"),
            F.col("best_email_address").alias("email_address"),
            "address_struct",
            "first_name",
            "last_name",
            F.col("best_phone_number").alias("phone_number"),
            *[
                c.alias(n)
                for n, c in best_flags(
                    {"email_address": "best_email_address", "phone_number": "best_phone_number"}
                ).items()
            ],
            match_flag(F.col("account_id"), F.col("p_primary_legacy_account_id")).alias("is_primary"),
            trunc_hour(individuals, updated).alias("valid_from_est_timestamp"),
        )
    )
    bare = top_rank(known.where("individual_id is null"), ["account_id"], [updated])
    by_account = person.where(F.col("source") == labels.account).select(
        F.col("primary_legacy_account_id").alias("account_id"), F.col("person_id")
    )
    unnamed = bare.join(by_account, "account_id", "left").select(
        "account_id",
        "person_id",
        match_flag(F.col("account_id"), F.when(F.col("person_id").isNotNull(), F.col("account_id"))).alias("is_primary"),
        trunc_hour(devices, updated).alias("valid_from_est_timestamp"),
    )
    rows = named.unionByName(unnamed, allowMissingColumns=True)
    return rows.select(
        F.concat(F.lit(ACCOUNT_PREFIX), F.col("account_id").cast("string")).alias("unified_identity_id"),
        F.lit("legacy").alias("source"),
        F.col("account_id").alias("legacy_account_id"),
        *[c for c in rows.columns if c != "account_id"],
        end.alias("valid_to_est_timestamp"),
        F.lit(True).alias("is_current"),
        load_times(as_of),
    )


MERGED = "merged"


def merge_persons(person: DataFrame, links: DataFrame, store: Store, labels: Labels = DEFAULT_LABELS) -> DataFrame:
    """Persons that ``links`` (columns a and b, person ids) say are one, with a survivor per group.

    The survivor is the one known best: from billing, then legacy, then an account, then an
    identity alone; of equals the one with an individual, then the smallest id. It takes over
    the group's first primary identity and account where it has none of its own. The others
    point to it in ``merged_person_id`` (never to another merged person, whatever chain or
    star the links form) and keep their former primaries in the ``prior_primary_`` columns. A
    link to an unknown person joins groups, but nothing points to that person.
    """
    classes = [labels.person, labels.legacy, labels.account, labels.identity]
    place = F.coalesce(F.array_position(F.array(*map(F.lit, classes)), F.col("source")), F.lit(0))
    order = [F.when(place == 0, len(classes) + 1).otherwise(place), F.col("individual_id").isNull().cast("int")]
    rows = store(survivors(person, "person_id", components(links, store), order), "survivors")
    gone = F.col("_survivor") != F.col("person_id")
    primary = ["primary_identity_id", "primary_legacy_account_id"]
    rank = [o.alias(f"o{i}") for i, o in enumerate(order)]
    firsts = [
        F.min(F.when(F.col(c).isNotNull(), F.struct(*rank, F.col("person_id").alias("key"), F.col(c).alias("value"))))["value"].alias(f"_{c}") for c in primary
    ]
    rows = rows.join(rows.groupBy("_root").agg(*firsts), "_root")
    out = {c: F.when(~gone, F.coalesce(F.col(c), F.col(f"_{c}"))) for c in primary}
    out |= {f"prior_{c}": F.when(gone, F.col(c)) for c in primary}
    out |= {"merged_person_id": F.when(gone, F.col("_survivor")), "state": F.when(gone, F.lit(MERGED)).otherwise(F.col("state"))}
    kept = [c for c in person.columns if c not in out]
    return rows.select(*kept, *[v.alias(n) for n, v in out.items()])
