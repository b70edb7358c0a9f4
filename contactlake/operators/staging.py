"""Staging view of the raw layer (trim, defaults, casts, key filter)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import DEFAULT_LEAD_STATUS, DEFAULT_SOURCE
from ..functions.expr import clean_text


def stg_contacts(raw: DataFrame) -> DataFrame:
    email = F.col("email")
    out = raw.where(F.col("contact_id").isNotNull() & email.isNotNull() & (email != ""))
    extra = [c for c in ("ingest_seq",) if c in raw.columns]
    return out.select(
        "contact_id", "email",
        clean_text("first_name").alias("first_name"),
        clean_text("last_name").alias("last_name"),
        clean_text("company_name").alias("company_name"),
        clean_text("job_title").alias("job_title"),
        clean_text("industry").alias("industry"),
        "annual_revenue", "numberofemployees",
        F.col("created_at").cast("timestamp").alias("created_at"),
        F.col("lastmodifieddate").cast("timestamp").alias("lastmodifieddate"),
        F.coalesce(clean_text("lead_status"), F.lit(DEFAULT_LEAD_STATUS)).alias("lead_status"),
        F.coalesce(clean_text("hs_analytics_source"), F.lit(DEFAULT_SOURCE)).alias("hs_analytics_source"),
        "hs_analytics_source_data_1",
        F.col("processed_at").cast("timestamp").alias("processed_at"),
        "run_id", *extra)
