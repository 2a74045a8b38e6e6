"""Agent dimension: incremental extract with supervisor attributes, upsert, and sync of a copy."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histkit.functions.casts import NOT_DEFINED
from histkit.operators.joins import Lookup, enrich
from histkit.operators.merge import sync, upsert_replace
from histkit.operators.quality import require_rows
from histkit.sources.watermark import newer_than

OPEN_DATE = "9999-12-31"
KEY = ("agent_key_id",)

# Output column -> source column and what a missing value becomes.
AGENT_COLUMNS = {
    "agent_key_id": ("Agn_Rec_Key", None),
    "csr_id": ("CSR_ID", None),
    "rec_eff_ts": ("Agn_Role_Strt_Dt", None),
    "rec_exp_ts": ("Agn_Role_End_Dt", None),
    "agent_id": ("Agn_id", None),
    "agent_first_nm": ("Agn_Fst_NM", NOT_DEFINED),
    "agent_last_nm": ("Agn_Last_NM", NOT_DEFINED),
    "vendor_nm": ("Agn_Vend", NOT_DEFINED),
    "vendor_site_nm": ("Agn_Site", NOT_DEFINED),
    "vendor_lctn_nm": ("Agn_Loc", NOT_DEFINED),
    "agent_lob_cd": ("Agn_LOB", NOT_DEFINED),
    "agent_sms_role_cd": ("Agn_Role_SMS", NOT_DEFINED),
    "agent_mrktng_role_cd": ("Agn_Role_Mktg", NOT_DEFINED),
    "actvtn_src_cd": ("Avtn_Src", NOT_DEFINED),
    "intrctn_chnl_nm": ("Agn_Intrctn_Chnl_Nm", NOT_DEFINED),
    "is_work_at_home_ind": ("IS_WORK_AT_HOME_IND", None),
    "is_agent_actv_ind": ("Agn_Sts", None),
    "suprvsr_csr_id": ("Agn_Supr_CSR_ID", None),
    "is_latest_ind": ("Cur_Rec_Fl", None),
    "lob_tenure_band_code": ("Lob_tnre_band_cd", NOT_DEFINED),
    "lob_tenure_effective_date": ("Lob_tnre_eff_dt", OPEN_DATE),
    "interaction_channel_band_code": ("Intrctn_chnl_tnre_band_cd", NOT_DEFINED),
    "interaction_channel_effective_date": ("Intrctn_chnl_tnre_eff_dt", OPEN_DATE),
    "overall_tenure_band_code": ("Overall_tnre_band_cd", NOT_DEFINED),
    "overall_tenure_effective_date": ("Overall_tnre_eff_dt", OPEN_DATE),
    "agent_cep_flag": ("cep_fl", None),
    "agent_universal_flag": ("unvrsl_fl", None),
    "agent_lob_messaging_category": ("lob_msg_ctgry", NOT_DEFINED),
    "agent_lob_messaging_category_2": ("lob_msg_ctgry2", NOT_DEFINED),
    "agent_tier": ("Agn_tier", NOT_DEFINED),
    "update_ts": ("updt_ts", None),
    "is_lrng_lab_agent_ind": ("IS_LRNG_LAB_AGN_IND", None),
    "agent_tenure_band_code": ("AGN_TNRE_BAND_CD", NOT_DEFINED),
    "agent_tenure_effective_date": ("AGN_TNRE_EFF_DT", OPEN_DATE),
}
_SUPERVISOR = {
    "suprvsr_first_nm": "Agn_Fst_NM",
    "suprvsr_last_nm": "Agn_Last_NM",
    "suprvsr_lob_cd": "Agn_LOB",
    "suprvsr_sms_role_cd": "Agn_Role_SMS",
    "suprvsr_mrktng_role_cd": "Agn_Role_Mktg",
}


def extract_agents(source: DataFrame, watermark: datetime | str, as_of: str) -> DataFrame:
    """Agents changed since the watermark, with their supervisor's attributes."""
    parent = {"Agn_Supr_CSR_ID": "CSR_ID", "Agn_Supr_Rec_Key": "Agn_Rec_Key"}
    rows = enrich(newer_than(source, "updt_ts", watermark), [Lookup(source, parent, _SUPERVISOR)])
    out = []
    for name, (column, missing) in AGENT_COLUMNS.items():
        value = F.col(column)
        if missing is not None:
            value = F.coalesce(value, F.lit(missing).cast(source.schema[column].dataType))
        out.append(value.alias(name))
    out += [F.coalesce(F.col(n), F.lit(NOT_DEFINED)).alias(n) for n in _SUPERVISOR]
    return rows.select(*out, F.lit(as_of).cast("timestamp").alias("create_ts"))


def load_agents(target: DataFrame, stage: DataFrame) -> DataFrame:
    """Delete staged keys from the dimension and insert the stage; an empty stage is an error."""
    return upsert_replace(target, require_rows(stage), KEY)


def sync_agents(copy: DataFrame, dimension: DataFrame) -> DataFrame:
    """Bring a copy (key, agent, csr, expiry) in line with the dimension's open rows."""
    open_rows = dimension.where(F.col("rec_exp_ts").cast("date") == F.lit(OPEN_DATE).cast("date"))
    columns = ["agent_id", "csr_id", "rec_exp_ts"]
    return sync(copy, open_rows.select(*KEY, *columns), KEY, columns)
