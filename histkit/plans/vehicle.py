"""Vehicle events -> vehicle dimension rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from histkit.functions.nested import discriminator, first_match, oneof_key, sorted_structs, struct_of_arrays

# Sources of external ids, and legal-term fields with their output names.
ID_SOURCES = {"oem_owner_id": "oemOwner", "oem_id": "oem", "device_id": "device"}
LEGAL_FIELDS = {
    "app_version": ("appVersion", None),
    "country_code": ("countryCode", None),
    "consent_type": ("consentType", None),
    "language": ("language", None),
    "version": ("version", None),
    "device_platform": ("platform", None),
    "accepted_est_timestamp": ("acceptedAt", "timestamp"),
}
DELIVERED = "delivered"


def element_ids(df: DataFrame, arr: str = "externalIds") -> DataFrame:
    return df.withColumns({out: first_match(arr, "source", src, "id") for out, src in ID_SOURCES.items()})


def vehicle_type(df: DataFrame) -> DataFrame:
    variant = F.col("vehicleAttributes.automotive")
    return df.withColumns({"vehicle_type": discriminator({"automotive": variant}), "automotive_struct": variant})


def special_attributes(df: DataFrame, brand: str, out: str = "special_attribute_struct") -> DataFrame:
    """Delivery state (which alternative is set) and the sale type of delivered vehicles."""
    path = f"specialAttributes.{brand}.deliveryState"
    dtype = df.select(path).schema[0].dataType
    states = [f.name for f in dtype.fields] if isinstance(dtype, T.StructType) else []
    state = oneof_key(path, states)
    sale = F.when(state == DELIVERED, F.col(f"{path}.{DELIVERED}.vehicleType"))
    return df.withColumn(
        out, F.struct(state.alias("delivery_state"), sale.alias("vehicle_sale_type"))
    ).drop("specialAttributes")


def legal_terms(df: DataFrame, arr: str = "legalTerms") -> DataFrame:
    """Legal terms as a struct of sorted arrays, and as sorted structs whose fields stay together."""
    return df.withColumns(
        {
            "legal_terms_struct": struct_of_arrays(arr, LEGAL_FIELDS),
            "legal_terms_array": sorted_structs(arr, LEGAL_FIELDS),
        }
    ).drop(arr)


# Output column -> input column, in order.
PROJECTION = {
    "vehicle_id": "vehicleId",
    "partner_name": "partner",
    "vehicle_source": "source",
    "oem_owner_id": "oem_owner_id",
    "oem_id": "oem_id",
    "device_id": "device_id",
    "sale_country_code": "countryOfSale",
    "activation_date": "activationDate",
    "vehicle_type": "vehicle_type",
    "has_user_opted_out": "userOptedOut",
    "automotive_struct": "automotive_struct",
    "special_attribute_struct": "special_attribute_struct",
    "legal_terms_struct": "legal_terms_struct",
    "source_timestamp_struct": "source_timestamp_struct",
    "valid_from_est_timestamp": "valid_from_est_timestamp",
    "valid_to_est_timestamp": "valid_to_est_timestamp",
    "is_current": "is_current",
    "request_context_struct": "request_context_struct",
    "etl_metadata_struct": "etl_metadata_struct",
    "dsrDetail": "dsrDetail",
}


def project_vehicle(df: DataFrame, brand: str) -> DataFrame:
    """The entity projection to pass to ``scd2_pipeline``; columns the events lack are left out."""
    rows = legal_terms(special_attributes(vehicle_type(element_ids(df)), brand))
    return rows.select(*[F.col(c).alias(out) for out, c in PROJECTION.items() if c in rows.columns])
