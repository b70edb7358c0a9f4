"""Table schemas of every layer."""

from __future__ import annotations

from pyspark.sql import types as T

from .constants import API_EXTRA_PROPERTIES, API_PROPERTIES, CSV_COLUMNS

S, L, TS = T.StringType(), T.LongType(), T.TimestampType()

CONTACT_COLUMNS = [
    "contact_id", "email", "first_name", "last_name", "company_name", "job_title",
    "industry", "annual_revenue", "numberofemployees", "created_at", "lastmodifieddate",
    "lead_status", "hs_analytics_source", "hs_analytics_source_data_1", "processed_at",
    "run_id",
]

CONTACT_SCHEMA = T.StructType([
    T.StructField("contact_id", S, False),
    T.StructField("email", S, False),
    T.StructField("first_name", S),
    T.StructField("last_name", S),
    T.StructField("company_name", S),
    T.StructField("job_title", S),
    T.StructField("industry", S),
    T.StructField("annual_revenue", L),
    T.StructField("numberofemployees", L),
    T.StructField("created_at", TS),
    T.StructField("lastmodifieddate", TS),
    T.StructField("lead_status", S),
    T.StructField("hs_analytics_source", S),
    T.StructField("hs_analytics_source_data_1", S),
    T.StructField("processed_at", TS, False),
    T.StructField("run_id", S, False),
])

# the core table as written: partitioned by month, with every undated contact in one
# partition; read with this schema, since a folder of undated contacts alone has no type
CORE_LAYOUT_SCHEMA = T.StructType([*CONTACT_SCHEMA.fields, T.StructField("created_month", T.DateType())])

QUARANTINE_SCHEMA = T.StructType([
    T.StructField("id", S, False),
    T.StructField("original_data", S, False),
    T.StructField("error_message", S, False),
    T.StructField("error_type", S, False),
    T.StructField("run_id", S, False),
    T.StructField("quarantined_at", TS, False),
])

# raw and quarantine as written: partitioned by run and by the day of ingestion
INGEST_DAY = "ingest_date"

API_PROPERTIES_SCHEMA = T.StructType(
    [T.StructField(p, S) for p in API_PROPERTIES + API_EXTRA_PROPERTIES])
API_SCHEMA = T.StructType([
    T.StructField("id", S),
    T.StructField("properties", API_PROPERTIES_SCHEMA),
])
API_PAGE_SCHEMA = T.StructType([
    T.StructField("results", T.ArrayType(API_SCHEMA)),
    T.StructField("paging", T.StructType([
        T.StructField("next", T.StructType([T.StructField("after", S)]))])),
])

CSV_SCHEMA = T.StructType([T.StructField(c, S) for c in CSV_COLUMNS]
                          + [T.StructField("_corrupt_record", S)])

# invalid batch archive (V15): one JSON object per record, partitioned by run
INVALID_ARCHIVE_SCHEMA = T.StructType([
    T.StructField("original_data", S),
    T.StructField("error_message", S),
    T.StructField("error_type", S),
    T.StructField("ingest_seq", L),
    T.StructField("run_id", S),
])

MANIFEST_SCHEMA = T.StructType([
    T.StructField("blob_key", S, False),
    T.StructField("container", S, False),
    T.StructField("blob_name", S, False),
    T.StructField("record_count", L),
    T.StructField("file_path", S),
    T.StructField("created_at", TS),
    T.StructField("newest_at", TS),
])

RELATIONAL_COLUMNS = ["contact_id", "email", "first_name", "last_name", "created_at"]

RUN_AUDIT_SCHEMA = T.StructType([
    T.StructField("run_id", S, False),
    T.StructField("total", L),
    T.StructField("valid", L),
    T.StructField("invalid", L),
    T.StructField("raw_loaded", L),
    T.StructField("quarantined", L),
    T.StructField("core_merged", L),
    T.StructField("model_run", T.BooleanType()),
])
