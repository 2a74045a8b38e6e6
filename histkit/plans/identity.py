"""Staging histories of the identity sources, and the whole identity load."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histkit.functions.nested import oneof_value, strip_tokens
from histkit.functions.times import DEFAULT_ZONE, column_type, local_time, timestamp_literal
from histkit.operators import events as ev
from histkit.operators.events import union_all
from histkit.operators.quality import coverage_gap, duplicate_keys
from histkit.operators.resolve import identity_history, legacy_account_history, resolve_persons
from histkit.operators.scd2 import scd_stage
from histkit.operators.timeline import DEFAULT_LABELS, Labels, unified_timeline
from histkit.sources.files import materialize

Verbs = Mapping[str, DataFrame]

# Billing systems of a subscription, and what is cut from their references.
KNOWN_SYSTEMS = ("sms", "zuora", "charon", "internal")
REFERENCE_SYSTEMS = ("sms", "zuora", "internal")
REFERENCE_TOKENS = ("US_", "MX_", "PR_", "NL_", "0.0.0.1 /service/subscription_")
STATE_PRIORITY = (("active",), ("paused", "past_due", "pending_cancellation"))


def _window(verbs: Verbs, columns: Sequence, from_ts, to_ts, ts: str = "envelopeTime") -> DataFrame:
    """All verbs in one table: real events of the window, projected before anything is shuffled."""

    def one(df: DataFrame) -> DataFrame:
        df = ev.drop_test(df)
        if from_ts is not None:
            df = ev.events_in_window(df, from_ts, to_ts, ts)
        return df.select(*columns, ts)

    return ev.union_verbs({verb: one(df) for verb, df in verbs.items()})


def identity_stage(verbs: Verbs, from_ts, to_ts, zone: str = DEFAULT_ZONE) -> DataFrame:
    """Email and phone of an identity. On equal times the delete wins."""
    columns = [
        F.col("identityId").alias("identity_id"),
        F.coalesce(F.col("handle.emailAddress"), F.col("contact.emailAddress")).alias("email_address"),
        F.col("contact.PhoneNumber").alias("phone_number"),
        local_time("createdAt", zone).alias("create_est_timestamp"),
        local_time("lastUpdatedAt", zone).alias("update_est_timestamp"),
    ]
    rows = _window(verbs, columns, from_ts, to_ts)
    order = ["envelopeTime", "is_deleted", "email_address", "phone_number"]
    return scd_stage(
        rows,
        "identity_id",
        ["email_address", "phone_number"],
        order,
        zone=zone,
        keep=["create_est_timestamp", "update_est_timestamp"],
    )


def billing_stage(verbs: Verbs, from_ts, to_ts, zone: str = DEFAULT_ZONE) -> DataFrame:
    """Billing name and address of an identity. On equal times the surviving profile wins."""
    name, addr = "billingProfileName.firstAndLastName", "serviceAddress"
    address = {
        "city": "city",
        "state": "state",
        "zip_code": "zipCode",
        "address_line_1": "addressLine1",
        "address_line_2": "addressLine2",
        "country": "country",
    }
    columns = [
        F.col("id").alias("billing_profile_id"),
        F.col("identityId").alias("identity_id"),
        F.col("tenant").alias("tenant_id"),
        F.col(f"{name}.firstName").alias("first_name"),
        F.col(f"{name}.lastName").alias("last_name"),
        F.struct(*[F.col(f"{addr}.{c}").alias(o) for o, c in address.items()]).alias("address_struct"),
    ]
    rows = _window(verbs, columns, from_ts, to_ts)
    order = ["envelopeTime", ("is_deleted", "asc"), "billing_profile_id"]
    tracked = ["tenant_id", "first_name", "last_name", "address_struct"]
    return scd_stage(rows, "identity_id", tracked, order, zone=zone, keep=["billing_profile_id"])


def household_stage(verbs: Verbs, from_ts, to_ts, zone: str = DEFAULT_ZONE) -> DataFrame:
    """Individual and household linked to an identity; links without an individual are ignored."""
    columns = [
        F.col("identityId").alias("identity_id"),
        F.col("individualId").alias("individual_id"),
        F.col("householdId").alias("household_id"),
    ]
    rows = ev.require_nonblank(_window(verbs, columns, from_ts, to_ts), ["individual_id"])
    order = ["envelopeTime", "is_deleted", "individual_id"]
    return scd_stage(rows, "identity_id", ["individual_id", "household_id"], order, zone=zone)


def subscription_stage(
    verbs: Verbs,
    subscriptions: DataFrame,
    legacy: DataFrame,
    individuals: DataFrame,
    from_ts: datetime | str,
    to_ts: datetime | str,
    driven_by: str = "event",
    zone: str = DEFAULT_ZONE,
) -> DataFrame:
    """Legacy account and individual behind an identity's subscription.

    ``driven_by``: the window limits subscription events (``event``, for late events) or
    legacy updates (``legacy``, for late legacy rows); the other side is taken whole.
    ``subscriptions`` maps short ids to legacy ids (latest rows flagged ``Y``).

    Of the legacy rows of one reference only the best can win, whatever event it meets, so
    that side is reduced to one row per reference before the join.
    """
    columns = [
        F.col("subscriptionId").alias("subscription_id"),
        F.col("owner.identityId").alias("identity_id"),
        "state",
        strip_tokens(
            oneof_value("source", REFERENCE_SYSTEMS, "externalReference", "unknown"), REFERENCE_TOKENS
        ).alias("source_reference"),
    ]
    on_events = driven_by == "event"
    known = {v: ev.any_present(df, [f"source.{s}" for s in KNOWN_SYSTEMS]) for v, df in verbs.items()}
    events = _window(known, columns, from_ts if on_events else None, to_ts)

    updated = "etl_metadata_struct.etl_update_est_timestamp"
    accounts = legacy.where(F.col("account_id").isNotNull())
    if not on_events:
        # The window is UTC, the stored update time local.
        dtype = column_type(accounts, updated)
        lo, hi = (local_time(timestamp_literal(t, dtype), zone) for t in (from_ts, to_ts))
        accounts = accounts.where((F.col(updated) >= lo) & (F.col(updated) < hi))
    accounts = accounts.select(
        F.col("subscription_id").alias("_legacy_id"), "individual_id", "account_id", F.col(updated).alias("_updated")
    )
    latest = subscriptions.where(F.col("is_latest_rec_ind") == "Y").select(
        F.col("short_sbscrptn_id").alias("source_reference"),
        F.col("sms_sbscrptn_id").alias("_legacy_id"),
        "sbscrptn_key_id",
    )
    best = ev.top_rank(
        latest.join(accounts, "_legacy_id"),
        ["source_reference"],
        ["sbscrptn_key_id", "_updated", "account_id", "individual_id"],
    )
    best = best.join(individuals.select("individual_id", "household_id"), "individual_id", "left")
    best = best.select("source_reference", "individual_id", "account_id", "household_id", "sbscrptn_key_id", "_updated")

    rows = events.join(best, "source_reference")
    first, second = STATE_PRIORITY
    priority = F.when(F.col("state").isin(*first), 1).when(F.col("state").isin(*second), 2).otherwise(3)
    rows = rows.withColumn("_priority", priority)
    order = [
        "envelopeTime",
        "is_deleted",
        ("_priority", "asc"),
        "sbscrptn_key_id",
        "_updated",
        "subscription_id",
    ]
    return scd_stage(
        rows,
        "identity_id",
        ["account_id", "individual_id"],
        order,
        zone=zone,
        keep=["subscription_id", "source_reference", "household_id"],
    )


def identity_load(
    stages: Mapping[str, DataFrame],
    person: DataFrame,
    devices: DataFrame,
    individuals: DataFrame,
    labels: Labels = DEFAULT_LABELS,
    as_of: str | datetime | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Full load: (new person table, identity history including legacy accounts).

    The timeline and the person table feed several later steps, so both are written to the
    shared folder once.
    """
    line = materialize(unified_timeline(stages, labels=labels), "timeline")
    people = materialize(resolve_persons(person, line, devices, individuals, labels), "person")
    return people, full_history(line, people, devices, individuals, labels, as_of)


def full_history(
    line: DataFrame, people: DataFrame, devices: DataFrame, individuals: DataFrame, labels: Labels = DEFAULT_LABELS, as_of: str | datetime | None = None
) -> DataFrame:
    return union_all(
        [
            identity_history(line, people, labels, as_of),
            legacy_account_history(devices, individuals, people, labels, as_of=as_of),
        ]
    )


def validation_report(history: DataFrame, person: DataFrame, devices: DataFrame) -> DataFrame:
    """One row per check with the number of keys or rows that fail it."""
    legacy = history.where(F.col("source") == "legacy")
    checks = {
        "identity and start are unique": duplicate_keys(
            history.where(F.col("identity_id").isNotNull()), ["identity_id", "valid_from_est_timestamp"]
        ),
        "legacy accounts are unique": duplicate_keys(legacy, ["legacy_account_id"]),
        "legacy accounts are covered": coverage_gap(
            devices.where(F.col("subscription_id").isNotNull()), legacy, {"account_id": "legacy_account_id"}
        ),
        "individuals are unique persons": duplicate_keys(
            person.where(F.col("individual_id").isNotNull()), ["individual_id"]
        ),
        "every history row has a person": history.where(F.col("person_id").isNull()),
    }
    counts = [
        rows.agg(F.count(F.lit(1)).alias("failures")).select(F.lit(name).alias("check_name"), "failures")
        for name, rows in checks.items()
    ]
    return union_all(counts)
