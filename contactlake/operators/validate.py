"""Validation and normalisation (V1-V16) as Column expressions.

Each record gets one ``error_type`` (NULL = valid) from a ``when`` chain where the first
failing check wins, so every record lands in exactly one side of the split. The annotated
DataFrame is computed once (persisted or written by the caller) and filtered twice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import (API_EXTRA_PROPERTIES, API_PROPERTIES, CSV_COLUMNS,
                         ERR_MISSING_EMAIL, ERR_VALIDATION, MSG_API_MISSING_EMAIL,
                         MSG_CSV_MISSING_EMAIL, MSG_INT)
from ..functions.expr import email_ok, int_text_ok, parse_int, parse_ts
from ..schema import CONTACT_COLUMNS

MSG_SHAPE_API = "record does not match the API contact shape (id string, properties object of strings)"
MSG_SHAPE_CSV = "record does not match the CSV contact shape (8 string cells)"
MSG_EMAIL = "value is not a valid email address"


def _variant_type(v: Column, path: str) -> Column:
    return F.schema_of_variant(F.try_variant_get(v, path, "variant"))


def api_shape_ok(df: DataFrame) -> Column:
    """V3. With the original JSON (``raw`` VARIANT, or ``raw_json`` text) the JSON types
    are checked (a numeric id is BIGINT there, not STRING; a typed read would hide it);
    otherwise the typed columns are already strings and only presence is checked."""
    ok = F.col("id").isNotNull() & F.col("properties").isNotNull()
    v = None
    if "raw" in df.columns:
        v = F.col("raw")
    elif "raw_json" in df.columns:
        v = F.try_parse_json(F.col("raw_json"))
    if v is not None:
        # one look at the properties (NULL unless they are an object), then at their values
        members = F.try_variant_get(v, "$.properties", "map<string, variant>")
        named = F.map_filter(members, lambda k, _: k.isin(*API_PROPERTIES))
        ok = ok & (_variant_type(v, "$.id") == "STRING") & F.forall(
            F.map_values(named), lambda x: F.schema_of_variant(x).isin("STRING", "VOID"))
    return F.coalesce(ok, F.lit(False))


def _status(p) -> Column:
    # generator files carry hs_lead_status instead of leadstatus
    return F.upper(F.coalesce(p("leadstatus"), p("hs_lead_status")))


def validate_api(records: DataFrame, original_data: Column | None = None,
                 literal: bool = False) -> DataFrame:
    """V3, V5, V6, V9 over API records ``{id, properties{...}}``; adds
    ``error_type``, ``error_message``, ``original_data`` and the contact columns."""
    def p(name):
        return F.col(f"properties.{name}")

    email = p("email")
    # the checks are computed once per record, in a step of their own: the type, the message and
    # the values use them, and one step with all of it is too long for the JVM to compile
    checks = {"_shape_ok": api_shape_ok(records), "_email_ok": email_ok(email),
              "_rev_ok": int_text_ok(p("annualrevenue")), "_emp_ok": int_text_ok(p("numberofemployees"))}
    records = records.withColumns(checks)
    shape, mail_ok, rev_ok, emp_ok = [F.col(c) for c in checks]
    err = (F.when(~shape, F.lit(ERR_VALIDATION))
           .when(email.isNull() | (email == ""), F.lit(ERR_MISSING_EMAIL))
           .when(~mail_ok, F.lit(ERR_VALIDATION)))
    msg = (F.when(~shape, F.lit(MSG_SHAPE_API))
           .when(email.isNull() | (email == ""), F.lit(MSG_API_MISSING_EMAIL))
           .when(~mail_ok, F.lit(MSG_EMAIL)))
    if not literal:
        # A non-integer revenue / employee count quarantines the row
        err = err.when(~(rev_ok & emp_ok), F.lit(ERR_VALIDATION))
        msg = msg.when(~(rev_ok & emp_ok), F.lit(MSG_INT))
    if original_data is None:
        if "raw" in records.columns:
            original_data = F.to_json(F.col("raw"))
        elif "raw_json" in records.columns:
            original_data = F.col("raw_json")
        else:
            original_data = F.to_json(F.struct(F.col("id"), F.col("properties")),
                                      {"ignoreNullFields": "false"})
    revenue = parse_int(p("annualrevenue"), rev_ok)
    if literal:
        revenue = F.when(rev_ok, revenue).otherwise(
            F.raise_error(F.lit("invalid literal for int() in annualrevenue")))
    contact = {
        "contact_id": F.col("id"),
        "email": F.lower(email),
        "first_name": p("firstname"),
        "last_name": p("lastname"),
        "company_name": p("company"),
        "job_title": p("jobtitle"),
        "industry": p("industry"),
        "annual_revenue": F.nullif(revenue, F.lit(0)),          # T4: 0 → NULL
        "numberofemployees": parse_int(p("numberofemployees"), emp_ok),  # 0 stays 0
        "created_at": F.lit(None).cast("timestamp") if literal else parse_ts(p("createdate")),
        "lastmodifieddate": F.lit(None).cast("timestamp"),     # never filled (T5)
        "lead_status": F.lower(_status(p)) if literal else _status(p),
        "hs_analytics_source": p("hs_analytics_source"),
        "hs_analytics_source_data_1": p("hs_analytics_source_data_1"),
    }
    if literal:   # T2: every string lower-cased
        for k in ("contact_id", "first_name", "last_name", "company_name", "job_title",
                  "industry", "hs_analytics_source", "hs_analytics_source_data_1"):
            contact[k] = F.lower(contact[k])
    keep = [c for c in records.columns if c not in contact and c not in checks]
    return records.select(*keep, err.alias("error_type"), msg.alias("error_message"),
                          original_data.alias("original_data"),
                          *[v.alias(k) for k, v in contact.items()])


def csv_cell_count(line: Column) -> Column:
    """Number of cells of a CSV line, counting only commas outside double quotes (quoted
    runs are dropped first: one pass, whatever the number of cells)."""
    bare = F.regexp_replace(line, '"[^"]*"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1


def validate_csv(rows: DataFrame, literal: bool = False) -> DataFrame:
    """V2, V4, V6, V9 over rows read with ``CSV_SCHEMA`` (8 strings + corrupt record).

    Short rows (fewer cells than the header) fail the shape check; extra cells are
    ignored. An empty cell reads as NULL in Spark, so on a full row NULL means ''."""
    corrupt = F.col("_corrupt_record") if "_corrupt_record" in rows.columns else F.lit(None)
    short = corrupt.isNotNull() & (csv_cell_count(corrupt) < len(CSV_COLUMNS))
    cells = {c: F.when(~short, F.coalesce(F.col(c), F.lit(""))) for c in CSV_COLUMNS}
    email = cells["email"]
    rev = cells["annual_revenue"]
    err = (F.when(short, F.lit(ERR_VALIDATION))
           .when((email == "") | ~email.contains("@"), F.lit(ERR_MISSING_EMAIL))
           .when(~email_ok(email), F.lit(ERR_VALIDATION)))
    msg = (F.when(short, F.lit(MSG_SHAPE_CSV))
           .when((email == "") | ~email.contains("@"), F.lit(MSG_CSV_MISSING_EMAIL))
           .when(~email_ok(email), F.lit(MSG_EMAIL)))
    if not literal:
        err = err.when(~int_text_ok(rev), F.lit(ERR_VALIDATION))
        msg = msg.when(~int_text_ok(rev), F.lit(MSG_INT))
    revenue = parse_int(rev)
    if literal:
        revenue = F.when(int_text_ok(rev), revenue).otherwise(
            F.raise_error(F.lit("invalid literal for int() in annual_revenue")))
    parsed, keep_null = [F.col(c) for c in CSV_COLUMNS], {"ignoreNullFields": "false"}
    original = F.when(corrupt.isNull(), F.to_json(F.struct(*parsed), keep_null)) \
        .otherwise(F.to_json(F.struct(*parsed, corrupt.cast("string").alias("_corrupt_record")), keep_null))
    none = F.lit(None).cast("string")
    contact = {
        "contact_id": cells["contact_id"],
        "email": F.lower(email),
        "first_name": cells["first_name"],
        "last_name": cells["last_name"],
        "company_name": cells["company_name"],
        "job_title": cells["job_title"],
        "industry": none,
        "annual_revenue": F.nullif(revenue, F.lit(0)),
        "numberofemployees": F.lit(None).cast("bigint"),
        "created_at": F.lit(None).cast("timestamp") if literal else parse_ts(cells["created_at"]),
        "lastmodifieddate": F.lit(None).cast("timestamp"),
        "lead_status": none,
        "hs_analytics_source": none,
        "hs_analytics_source_data_1": none,
    }
    if literal:
        for k in ("contact_id", "first_name", "last_name", "company_name", "job_title"):
            contact[k] = F.lower(contact[k])
    keep = [c for c in rows.columns if c not in contact and c not in CSV_COLUMNS
            and c != "_corrupt_record"]
    return rows.select(*keep, err.alias("error_type"), msg.alias("error_message"),
                       original.alias("original_data"),
                       *[v.alias(k) for k, v in contact.items()])


def is_csv_format(df: DataFrame) -> bool:
    """V1: CSV iff the record shape has ``contact_id`` and ``first_name``."""
    return "contact_id" in df.columns and "first_name" in df.columns


def validate(df: DataFrame, literal: bool = False) -> DataFrame:
    return validate_csv(df, literal) if is_csv_format(df) else validate_api(df, literal=literal)


def valid_side(annotated: DataFrame, run_id=None, processed_at=None) -> DataFrame:
    """Valid contacts with V13 stamps (``processed_at``, ``run_id``); ``ingest_seq``
    carried through when present (the dedupe tie-breaker, T5)."""
    out = annotated.where(F.col("error_type").isNull())
    stamp_ts = processed_at if processed_at is not None else F.current_timestamp()
    if not isinstance(stamp_ts, Column):
        stamp_ts = F.lit(stamp_ts).cast("timestamp")
    cols = [c for c in CONTACT_COLUMNS if c not in ("processed_at", "run_id")]
    extra = ["ingest_seq"] if "ingest_seq" in annotated.columns else []
    return out.select(*cols, stamp_ts.alias("processed_at"),
                      F.lit(run_id).cast("string").alias("run_id") if run_id is not None
                      else F.col("run_id"), *extra)


def invalid_side(annotated: DataFrame) -> DataFrame:
    """V12 invalid side: ``{original_data, error_message, error_type}`` (+ seq)."""
    extra = [c for c in ("ingest_seq",) if c in annotated.columns]
    return annotated.where(F.col("error_type").isNotNull()) \
        .select("original_data", "error_message", "error_type", *extra)


def split(annotated: DataFrame, run_id=None, processed_at=None):
    return valid_side(annotated, run_id, processed_at), invalid_side(annotated)


def error_counts(annotated: DataFrame) -> DataFrame:
    """V12 summary: records per outcome ('valid' or the error type)."""
    return annotated.groupBy(F.coalesce("error_type", F.lit("valid")).alias("outcome")) \
        .agg(F.count(F.lit(1)).alias("records"))


def run_stats(annotated: DataFrame, run_id: str) -> DataFrame:
    """One-row statistics of a validated batch (single scan, partial aggregation)."""
    return annotated.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("error_type").isNull()).alias("valid"),
        F.count_if(F.col("error_type").isNotNull()).alias("invalid"),
    ).select(F.lit(run_id).alias("run_id"), "*")
