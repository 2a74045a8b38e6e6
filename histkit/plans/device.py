"""Devices with their vehicle, profiles and subscriptions -> vehicle-device dimension rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histkit.functions.nested import classify, first_element, first_match, null_unless
from histkit.operators.events import top_rank
from histkit.operators.joins import Lookup, enrich, latest_snapshot

# Fixed value: states of a subscription that has ended.
ENDED = ("closed", "cancelled", "finished")


# The status words of the two rule lists below.
def service_status_rules(state: Column, accepted: Column, trial: Column, linked: Column, current: Column) -> list:
    """Service status of a device; the first rule that holds wins."""
    ended = trial.isin(*ENDED)
    return [
        (state == "nonDelivered", "demo"),
        (accepted.isNull(), "trial_eligible"),
        (ended & linked.isNull(), "trial_expired"),
        (~ended & accepted.isNotNull(), "trial"),
        (~current.isin(*ENDED), "selfpay"),
        (current.isin(*ENDED), "end"),
    ]


def service_status_rules_by_delivery(state: Column, accepted: Column, trial: Column, linked: Column, current: Column) -> list:
    """The other order in use: acceptance is looked at for delivered vehicles, before the trial's state."""
    delivered = state == "delivered"
    return [
        (state == "nonDelivered", "demo"),
        (delivered & accepted.isNull(), "trial_eligible"),
        (delivered & accepted.isNotNull(), "trial"),
        (trial.isin(*ENDED) & linked.isNull(), "trial_expired"),
        (~current.isin(*ENDED), "selfpay"),
        (current.isin(*ENDED), "end"),
    ]


def join_device_sources(
    devices: DataFrame, vehicles: DataFrame, profiles: DataFrame, subscriptions: DataFrame
) -> DataFrame:
    """Each device with its current vehicle, both profiles, and trial, linked and current subscription.

    Of several candidates per device the newest trial, then the newest current subscription
    counts; remaining ties go to the smallest ids. That rank depends on subscriptions only,
    so trials are completed and reduced to the best one per device first, and every lookup
    side to its best row per key. No join then multiplies rows of a busy device or identity.
    """
    subs = latest_snapshot(subscriptions, "snapshot_est_date").select(
        "subscription_id",
        "device_id",
        "identity_id",
        "state",
        "linked_to_subscription_id",
        F.col("subscription_timestamp_struct.start_est_timestamp").alias("start_est_timestamp"),
        F.col("current_phase_struct.phase_end_est_timestamp").alias("phase_end_est_timestamp"),
        first_match("beneficiary_id_array_struct", "type", "identity", "id").alias("beneficiary_identity_id"),
        F.col("source_timestamp_struct.create_est_timestamp").alias("create_est_timestamp"),
        F.col("source_timestamp_struct.update_est_timestamp").alias("update_est_timestamp"),
    )
    base = devices.select(
        "device_id",
        F.col("vehicle_attribute_struct.vehicle_id").alias("_vehicle_id"),
        F.col("vehicle_attribute_struct.radio_id").alias("radio_id"),
        "device_platform",
        F.col("source_timestamp_struct.update_est_timestamp").alias("_dvc_update"),
    )
    vehicle_columns = {
        "vehicle_id": "vehicle_id",
        "vehicle_type": "vehicle_type",
        "partner_name": "partner_name",
        "oem_owner_id": "oem_owner_id",
        "automotive_struct": "automotive_struct",
        "special_attribute_struct": "special_attribute_struct",
        "sale_country_code": "sale_country_code",
        "legal_terms_struct": "legal_terms_struct",
        "_veh_from": "valid_from_est_timestamp",
        "etl_metadata_struct": "etl_metadata_struct",
    }

    def profile(prefix: str) -> dict:
        return {
            f"{prefix}_profile_id": "profile_id",
            f"{prefix}_profile_language_code": "language_code",
            f"_{prefix}_update": F.col("source_timestamp_struct.update_est_timestamp"),
        }

    trial = {f"_trial_{c}": c for c in subs.columns if c != "device_id"}
    trials = subs.where(F.col("device_id").isNotNull()).select("device_id", *[F.col(c).alias(o) for o, c in trial.items()])
    linked = {f"_linked_{c}": c for c in ("state", "identity_id", "create_est_timestamp", "update_est_timestamp")}
    current = {
        f"_current_{c}": c
        for c in ("subscription_id", "state", "identity_id", "start_est_timestamp", "update_est_timestamp")
    }
    first_profile = [("profile_id", "asc")]
    newest = [("start_est_timestamp", "desc"), ("subscription_id", "asc")]
    trials = enrich(
        trials,
        [
            Lookup(subs, {"_trial_linked_to_subscription_id": "subscription_id"}, linked),
            Lookup(subs, {"_linked_identity_id": "identity_id"}, current, best=newest),
        ],
    )
    order = [
        ("_trial_start_est_timestamp", "desc"),
        ("_current_start_est_timestamp", "desc"),
        ("_trial_subscription_id", "asc"),
        ("_current_subscription_id", "asc"),
    ]
    trials = top_rank(trials, ["device_id"], order)
    completed = {c: c for c in trials.columns if c != "device_id"}
    rows = enrich(
        base,
        [
            # A filter on the vehicle after the left join keeps matched devices only: an inner join.
            Lookup(vehicles, {"_vehicle_id": "vehicle_id"}, vehicle_columns, F.col("is_current"), how="inner"),
            Lookup(profiles, {"device_id": "device_id"}, profile("demo"), best=first_profile),
            Lookup(profiles, {"oem_owner_id": "oem_profile_id"}, profile("oem_owner"), best=first_profile),
            Lookup(trials, {"device_id": "device_id"}, completed),
        ],
    )
    return top_rank(rows, ["device_id"], [*order, ("vehicle_id", "asc")])


def device_rows(joined: DataFrame, status_rules=service_status_rules, high: str = "9999-12-31") -> DataFrame:
    """Status, trial, linked and current subscription attributes of :func:`join_device_sources`."""
    state = F.col("special_attribute_struct.delivery_state")
    accepted = first_element("legal_terms_struct.accepted_est_timestamp")
    status = classify(
        status_rules(
            state,
            accepted,
            F.col("_trial_state"),
            F.col("_trial_linked_to_subscription_id"),
            F.col("_current_state"),
        ),
        "unknown",
    )
    trial_identity = F.col("_trial_beneficiary_identity_id")
    delivered_only = null_unless(
        state == "delivered",
        {
            "trial_subscription_id": F.col("_trial_subscription_id"),
            "trial_subscription_start_est_timestamp": F.col("_trial_start_est_timestamp"),
            "trial_subscription_end_est_timestamp": F.col("_trial_phase_end_est_timestamp"),
            "trial_subscription_state": F.col("_trial_state"),
            "trial_identity_id": trial_identity,
            "identity_id": F.coalesce(F.col("_current_identity_id"), trial_identity),
            "linked_to_subscription_id": F.col("_trial_linked_to_subscription_id"),
            "linked_to_subscription_state": F.col("_linked_state"),
            "linked_to_subscription_create_est_timestamp": F.col("_linked_create_est_timestamp"),
            "current_subscription_id": F.col("_current_subscription_id"),
            "current_subscription_state": F.col("_current_state"),
        },
    )
    automotive = [F.col(f"automotive_struct.{c}") for c in ("vin", "make", "model", "year")]
    # The earliest source time; a driver profile hides the device's own profile.
    valid_from = F.least(
        F.col("_veh_from"),
        F.col("_dvc_update"),
        F.coalesce(F.col("_oem_owner_update"), F.col("_demo_update")),
        F.col("_current_update_est_timestamp"),
        F.col("_linked_update_est_timestamp"),
        F.col("_trial_update_est_timestamp"),
    )
    dtype = joined.schema["_veh_from"].dataType
    return joined.select(
        "device_id",
        "radio_id",
        "device_platform",
        "vehicle_id",
        "vehicle_type",
        "partner_name",
        "oem_owner_id",
        *automotive,
        state.alias("delivery_state"),
        F.col("special_attribute_struct.vehicle_sale_type").alias("vehicle_sale_type"),
        "sale_country_code",
        "demo_profile_id",
        "demo_profile_language_code",
        "oem_owner_profile_id",
        "oem_owner_profile_language_code",
        status.alias("device_service_status"),
        accepted.alias("legal_terms_accept_est_timestamp"),
        *[c.alias(n) for n, c in delivered_only.items()],
        F.col("_trial_linked_to_subscription_id").isNotNull().alias("has_linked_to_subscription"),
        F.when(state == "delivered", trial_identity).isNull().alias("is_anonymous_trial"),
        valid_from.alias("valid_from_est_timestamp"),
        F.lit(high).cast(dtype).alias("valid_to_est_timestamp"),
        F.lit(True).alias("is_current"),
        "etl_metadata_struct",
    )
