"""Registered queries: SURVEY §2 id → ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver tables of ``sf_dir`` through the fixture layer, so its
work grows with them; none runs on made-up input. Reports use the fixed clock
``AS_OF``. A query may also be given pre-built ``Layers`` (e.g. a materialized core)."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import CONTAINER_RAW, CSV_COLUMNS
from ..functions.expr import int_text_ok, parse_int, parse_ts
from ..operators import quality, suite
from ..operators.core import dedupe_latest, merge_snapshot, watermark_filter
from ..operators.staging import stg_contacts
from ..operators.validate import error_counts, run_stats, validate_api, validate_csv
from ..sources.readers import api_records_from_docs
from ..schema import CONTACT_COLUMNS, RELATIONAL_COLUMNS
from ..sources import fixtures as fx
from . import analytics as A
from . import marts as M

AS_OF = fx.AS_OF
Query = Callable[[SparkSession, str], DataFrame]

# fixed run ids of the fixture (one run per order year)
TARGET_LAST_RUN = "run_1999"
MERGE_RUN = "run_2001"
LIST_PREFIX = "run_199"
FIXTURE_RUN = "run_1"
SINCE = "2001-01-01 00:00:00"
S1_PROPERTIES = ["email", "company", "annualrevenue", "createdate", "numberofemployees",
                 "hs_analytics_source"]
READ_RUN = "run_1995"
STREAM_BATCHES = 2     # micro-batches the landed files are read in
W1_COLUMNS = ["contact_id", "email", "annual_revenue", "created_at", "hs_analytics_source"]
CSV_PROJECTION = ["contact_id", "email", "first_name", "last_name", "company_name", "job_title",
                  "annual_revenue", "created_at"]

_CACHE: dict[tuple[int, str], fx.Layers] = {}


def use_layers(spark: SparkSession, sf_dir: str, lz: fx.Layers) -> None:
    """Serve queries of ``sf_dir`` from given layers (e.g. written tables)."""
    _CACHE[(id(spark), sf_dir)] = lz


def get_layers(spark: SparkSession, sf_dir: str) -> fx.Layers:
    return _CACHE.get((id(spark), sf_dir)) or fx.layers(spark, sf_dir)


def _core(spark, sf_dir):
    return get_layers(spark, sf_dir).core_contacts


def _inv(spark, sf_dir):
    return get_layers(spark, sf_dir).invalid_contacts


def _raw(spark, sf_dir):
    return get_layers(spark, sf_dir).contacts_raw


def _c1(spark, sf_dir):
    return stg_contacts(_raw(spark, sf_dir)).select(*CONTACT_COLUMNS)


def _c2(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    target = dedupe_latest(raw.where(F.col("run_id") <= TARGET_LAST_RUN))
    return watermark_filter(raw, target).select("contact_id", "run_id", "processed_at", "ingest_seq")


def _c3(spark, sf_dir):
    return dedupe_latest(_raw(spark, sf_dir)).select(*CONTACT_COLUMNS)


def _c4(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    target = dedupe_latest(raw.where(F.col("run_id") < MERGE_RUN))
    return merge_snapshot(target, raw.where(F.col("run_id") == MERGE_RUN), mode="run",
                          now=AS_OF)


def _c5(spark, sf_dir):
    stg = stg_contacts(_raw(spark, sf_dir))
    target = dedupe_latest(stg.where(F.col("run_id") <= TARGET_LAST_RUN))
    src = watermark_filter(stg, target)
    return merge_snapshot(target, src, mode="watermark")


def _undated(df: DataFrame, share: int) -> DataFrame:
    """Without the time of creation where the customer number is a multiple of ``share``."""
    every = F.col("contact_id").cast("bigint") % share == 0
    return df.withColumn("created_at", F.when(~every, F.col("created_at")))


def _c4_store(spark, sf_dir):
    """C4 on a stored core: three batches (dated; moved and partly undated; undated only)
    merged through the key index, then the current version read."""
    from ..session import scratch_path
    from ..sources import corestore, sinks
    raw, path = _raw(spark, sf_dir), os.path.join(_landing(spark, "core"), "core_contacts")
    last = raw.where(F.col("run_id") == MERGE_RUN)
    for batch in (raw.where(F.col("run_id") < MERGE_RUN), _undated(last, 5), _undated(last.where("bigint(contact_id) % 7 = 0"), 7)):
        corestore.merge(spark, path, merge_snapshot(None, batch, now=AS_OF), scratch_path(spark, "merge-staging"))
    return sinks.read_core(spark, path).select(*CONTACT_COLUMNS)


def _c5_store(spark, sf_dir):
    """C5 on a stored core: the second batch is what is newer than the mark that the first
    merge recorded."""
    from ..session import scratch_path
    from ..sources import corestore, sinks
    stg, path = stg_contacts(_raw(spark, sf_dir)), os.path.join(_landing(spark, "core"), "core_contacts")
    first = stg.where(F.col("run_id") <= TARGET_LAST_RUN)
    for batch in (lambda: first, lambda: watermark_filter(stg, None, mark=sinks.read_watermark(spark, path))):
        corestore.merge(spark, path, merge_snapshot(None, batch(), mode="watermark"), scratch_path(spark, "merge-staging"))
    return sinks.read_core(spark, path).select(*CONTACT_COLUMNS)


def _api_annotated(spark, sf_dir):
    return validate_api(fx.api_records(fx.api_contacts(spark, sf_dir)))


def _v8(spark, sf_dir):
    return fx.api_contacts(spark, sf_dir).select("id", parse_ts("createdate").alias("created_at"))


def _v9(spark, sf_dir):
    a = fx.api_contacts(spark, sf_dir)
    return a.select("id", int_text_ok("annualrevenue").alias("revenue_ok"),
                    F.nullif(parse_int("annualrevenue"), F.lit(0)).alias("annual_revenue"))


def _v12(spark, sf_dir):
    return error_counts(_api_annotated(spark, sf_dir))


def _landing(spark, name: str) -> str:
    """A fresh folder in the shared checkpoint folder for landed files of one call."""
    import uuid

    from ..session import scratch_path
    return scratch_path(spark, "landing", f"{name}-{uuid.uuid4().hex[:12]}")


def _v3(spark, sf_dir):
    docs = fx.api_record_json(spark, sf_dir).select(F.col("rec").alias("doc"))
    return validate_api(api_records_from_docs(docs)) \
        .select("contact_id", "error_type", "error_message")


def _v4(spark, sf_dir):
    return validate_csv(fx.csv_rows(spark, sf_dir).drop("event_id")) \
        .select("contact_id", "error_type", "error_message")


def _v10(spark, sf_dir):
    return _api_annotated(spark, sf_dir).where(F.col("error_type").isNull()).select(
        "contact_id", "email", "company_name", "annual_revenue", "numberofemployees",
        "created_at", "lead_status", "hs_analytics_source")


def _v11(spark, sf_dir):
    return validate_csv(fx.csv_rows(spark, sf_dir).drop("event_id")) \
        .where(F.col("error_type").isNull()).select(*CSV_PROJECTION)


def _v14(spark, sf_dir):
    return run_stats(_api_annotated(spark, sf_dir), FIXTURE_RUN)


def _d6(spark, sf_dir):
    return quality.check_split(_api_annotated(spark, sf_dir))


def _s1(spark, sf_dir):
    from ..sources.readers import read_api_contacts
    from ..sources.sinks import write_lines
    path = write_lines(fx.api_landing(spark, sf_dir), _landing(spark, "api"), files=fx.landing_files(spark))
    r = read_api_contacts(spark, path)
    text = F.when(F.schema_of_variant("raw") == "STRING", F.try_variant_get("raw", "$", "string"))
    return r.select(F.col("id").alias("contact_id"),
                    *[F.col(f"properties.{c}").alias(c) for c in S1_PROPERTIES], F.trim(text).alias("text"))


def _s2(spark, sf_dir):
    from ..sources.readers import read_csv_contacts
    from ..sources.sinks import write_lines
    path = write_lines(fx.csv_lines(spark, sf_dir), _landing(spark, "csv"),
                       header=",".join(CSV_COLUMNS), files=fx.landing_files(spark))
    rows = read_csv_contacts(spark, path).withColumn("row_id", F.col("contact_id"))
    return validate_csv(rows).select(
        "row_id", F.coalesce("error_type", F.lit("valid")).alias("outcome"),
        "email", "company_name", "annual_revenue", "created_at")


def _s4(spark, sf_dir):
    from ..sources.readers import created_since
    return created_since(_core(spark, sf_dir), SINCE).select("contact_id", "created_at")


def _s11(spark, sf_dir):
    return _fixture_quarantine_rows(spark, sf_dir).select(
        "id", "error_type", "error_message", "run_id", "quarantined_at")


def _w1(spark, sf_dir):
    """API pages land as JSON Lines files; an availableNow file stream validates each
    micro-batch, appends raw and quarantine and merges core; the result is the core."""
    from ..sources.sinks import read_core, write_lines
    from ..streaming.stream import stream_contacts
    root = _landing(spark, "stream")
    landing = write_lines(fx.api_landing(spark, sf_dir), f"{root}/landing", files=fx.landing_files(spark))
    q = stream_contacts(spark, landing, f"{root}/warehouse", f"{root}/checkpoint",
                        fmt="json",
                        max_files_per_trigger=max(1, fx.landing_files(spark) // STREAM_BATCHES),
                        now=AS_OF)
    q.awaitTermination()          # availableNow ends by itself
    if q.exception() is not None:
        raise q.exception()
    return read_core(spark, f"{root}/warehouse/core_contacts").select(*W1_COLUMNS)


def _store(spark, sf_dir) -> str:
    """The raw contacts (one batch per run) and the quarantine written as a batch store with
    its manifest; written layers have theirs already."""
    lz = get_layers(spark, sf_dir)
    return lz.store or fx.write_store(lz.contacts_raw, lz.invalid_contacts, _landing(spark, "batches"))


def _s9(spark, sf_dir):
    """One named batch of the store; only its directory is opened."""
    from ..sources.readers import read_batch
    return read_batch(spark, _store(spark, sf_dir), CONTAINER_RAW, READ_RUN).select(
        "contact_id", "email", "created_at", "run_id", "ingest_seq")


def _s17(spark, sf_dir):
    from ..sources.sinks import run_query
    get_layers(spark, sf_dir).register()
    return run_query(spark, "SELECT contact_id, lead_status, annual_revenue FROM contacts "
                            "WHERE run_id = :run_id AND lead_status = :status",
                     {"run_id": READ_RUN, "status": "CLOSED"})


def _c7(spark, sf_dir):
    from ..operators.core import PARTITION_COLUMN, with_layout
    return with_layout(_core(spark, sf_dir).drop(PARTITION_COLUMN)).select(
        "contact_id", PARTITION_COLUMN)


def _m0(spark, sf_dir):
    """M0 + S16: the six marts registered as views (a failing one would be skipped), then
    read back by name from the registry: rows per view."""
    from functools import reduce
    lz = get_layers(spark, sf_dir)
    names = M.register_marts(lz.core_contacts, lz.invalid_contacts, AS_OF, log=lambda m: None)
    parts = [spark.table(n).agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(n).alias("view_name"), "row_count") for n in names]
    return reduce(lambda a, b: a.unionByName(b), parts)


def _s10(spark, sf_dir):
    """The valid API contacts stamped and written into a raw table (the run's
    partition replaced, so a retry does not duplicate), then that run read back."""
    from ..sources.sinks import append_raw
    path = os.path.join(_landing(spark, "raw"), "contacts_raw")
    valid = _api_annotated(spark, sf_dir).where(F.col("error_type").isNull())
    append_raw(valid, path, FIXTURE_RUN, AS_OF)
    return spark.read.parquet(path).where(F.col("run_id") == FIXTURE_RUN).select(
        "contact_id", "email", "annual_revenue", "created_at", "processed_at", "run_id")


def _v15(spark, sf_dir):
    """V15 (+ the JSON copy of S6): the invalid side archived as a JSON batch, read back."""
    from ..operators.validate import invalid_side
    from ..schema import INVALID_ARCHIVE_SCHEMA
    from ..sources.sinks import write_batch
    from ..constants import CONTAINER_INVALID
    recs = fx.api_records(fx.api_contacts(spark, sf_dir))
    bad = invalid_side(validate_api(recs, original_data=fx.fixture_original_data()))
    path = write_batch(bad, _landing(spark, "archive"), CONTAINER_INVALID, FIXTURE_RUN, fmt="json")
    return spark.read.schema(INVALID_ARCHIVE_SCHEMA).json(path) \
        .select("original_data", "error_message", "error_type", "run_id")


def _fixture_quarantine_rows(spark, sf_dir):
    from ..operators.validate import invalid_side
    from ..sources.sinks import quarantine_rows
    recs = fx.api_records(fx.api_contacts(spark, sf_dir))
    bad = invalid_side(validate_api(recs, original_data=fx.fixture_original_data()))
    return quarantine_rows(bad, FIXTURE_RUN, AS_OF)


def _s12(spark, sf_dir):
    """Schema-checked appends; the same rows appended twice are there twice."""
    from ..schema import QUARANTINE_SCHEMA
    from ..sources.sinks import append_table
    path = os.path.join(_landing(spark, "append"), "q")
    rows = _fixture_quarantine_rows(spark, sf_dir)
    append_table(rows, path, QUARANTINE_SCHEMA)
    append_table(rows, path, QUARANTINE_SCHEMA)
    return spark.read.parquet(path).select("id", "error_type", "run_id")


def _s14(spark, sf_dir):
    """The validated batch handed to the next stage as a written table, reloaded."""
    from ..sources.sinks import load_stage, save_stage
    base = _landing(spark, "stages")
    save_stage(_api_annotated(spark, sf_dir).select("contact_id", "error_type"), base,
               "validated", FIXTURE_RUN)
    return load_stage(spark, base, "validated", FIXTURE_RUN)


def _s15(spark, sf_dir):
    """Create the quarantine table if missing (twice: the second is a no-op),
    insert the run, read it back by table name."""
    import uuid

    from ..sources.sinks import create_table_if_missing, quarantine_schema_ddl
    name = f"contacts_quarantine_{uuid.uuid4().hex[:10]}"
    path = os.path.join(_landing(spark, "tables"), name)
    for _ in range(2):
        create_table_if_missing(spark, name, path, quarantine_schema_ddl(), ["run_id"])
    cols = spark.table(name).columns                 # insertInto matches by position
    _fixture_quarantine_rows(spark, sf_dir).select(*cols).write.insertInto(name)
    return spark.table(name).select("id", "error_type", "run_id", "quarantined_at")


def _tables(spark, sf_dir, *marts: str) -> dict[str, DataFrame]:
    """The layers that have data tests, by name."""
    from .model import MARTS
    lz = get_layers(spark, sf_dir)
    out = {"contacts_raw": lz.contacts_raw, "contacts_quarantine": lz.invalid_contacts,
           "stg_contacts": stg_contacts(lz.contacts_raw), "core_contacts": lz.core_contacts}
    return out | {m: MARTS[m](lz.core_contacts, lz.invalid_contacts, AS_OF) for m in marts}


def _d1(spark, sf_dir):
    return suite.suite_results(_tables(spark, sf_dir, "mart_lead_analytics", "mart_sales_funnel",
                                       "mart_industry_analytics", "mart_daily_trends"), checks={"not_null"})


def _d2(spark, sf_dir):
    return suite.suite_results(_tables(spark, sf_dir), checks={"unique"})


def _d3(spark, sf_dir):
    return suite.suite_results(_tables(spark, sf_dir), checks={"accepted_values"})


def _d4(spark, sf_dir):
    return suite.suite_results(_tables(spark, sf_dir), checks={"expression_is_true"})


def _c6(spark, sf_dir):
    """The model run over written tables, with one mart that cannot be built: its failure
    and the results of all tests are rows."""
    from ..session import scratch_path
    from ..sources import corestore, sinks
    from .model import MARTS, outcome_rows, run_model
    lz, root = get_layers(spark, sf_dir), _landing(spark, "model")

    def core(staging: DataFrame) -> DataFrame:
        path = os.path.join(root, "core_contacts")
        corestore.merge(spark, path, merge_snapshot(None, staging, mode="watermark"), scratch_path(spark, "merge-staging"))
        return sinks.read_core(spark, path)

    broken = {**MARTS, "mart_broken": lambda core, bad, as_of: core.select("no_such_column")}
    out = run_model(spark, lz.contacts_raw, lz.invalid_contacts, stg_contacts, core, os.path.join(root, "marts"), AS_OF, broken)
    rows = outcome_rows(spark, out)
    return rows.withColumn("status", F.when(F.col("status").startswith("failed"), "failed").otherwise(F.col("status"))) \
        .withColumn("good", F.lit(out.good))


def _d5(spark, sf_dir):
    """D5 from the manifest: the newest time of each batch was recorded when it was written."""
    from ..sources.sinks import read_manifest
    return quality.manifest_freshness(read_manifest(spark, _store(spark, sf_dir)), AS_OF)


def _s3(spark, sf_dir):
    from ..sources.readers import read_latest_batch
    return read_latest_batch(spark, _store(spark, sf_dir), CONTAINER_RAW).select("contact_id", "run_id", "ingest_seq")


def _s7(spark, sf_dir):
    from ..sources.sinks import read_manifest
    return read_manifest(spark, _store(spark, sf_dir)).where(F.col("container") == CONTAINER_RAW).select(
        "blob_key", "container", "blob_name", "record_count")


def _s8(spark, sf_dir):
    from ..sources.sinks import list_batches, read_manifest
    raw = read_manifest(spark, _store(spark, sf_dir)).where(F.col("container") == CONTAINER_RAW)
    return list_batches(raw, LIST_PREFIX).select("blob_name", "record_count")


def _s13(spark, sf_dir):
    from ..sources.sinks import relational_upsert_rows
    return relational_upsert_rows(None, _raw(spark, sf_dir))


def _s13_store(spark, sf_dir):
    """S13 on a stored target: the runs up to 1999 fill it, the later ones are upserted."""
    from ..sources.sinks import read_snapshot, relational_upsert
    raw, path = _raw(spark, sf_dir), _landing(spark, "relational")
    for batch in (raw.where(F.col("run_id") <= TARGET_LAST_RUN), raw.where(F.col("run_id") > TARGET_LAST_RUN)):
        replaced, inserted = relational_upsert(spark, path, batch)
    return read_snapshot(spark, path).withColumn("replaced", F.lit(replaced).cast("long")) \
        .withColumn("inserted", F.lit(inserted).cast("long"))


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {
        "m1": lambda s, d: M.lead_analytics(_core(s, d), AS_OF),
        "m2": lambda s, d: M.sales_funnel(_core(s, d)),
        "m3": lambda s, d: M.industry_analytics(_core(s, d)),
        "m4": lambda s, d: M.conversion_metrics(_core(s, d), AS_OF),
        "m5": lambda s, d: M.data_quality(_core(s, d), _inv(s, d)),
        "m6": lambda s, d: M.daily_trends(_core(s, d), AS_OF),
        "m0": _m0,
        "a1": lambda s, d: A.a1_leads_by_source(_core(s, d), AS_OF),
        "a2": lambda s, d: A.a2_source_campaign_week(_core(s, d)),
        "a3": lambda s, d: A.a3_top_sources(_core(s, d)),
        "a4": lambda s, d: A.a4_funnel_by_status(_core(s, d)),
        "a5": lambda s, d: A.a5_funnel_stage_conversion(_core(s, d), AS_OF),
        "a6": lambda s, d: A.a6_weekly_funnel(_core(s, d), AS_OF),
        "a7": lambda s, d: A.a7_conversion_periods(_core(s, d), AS_OF),
        "a8": lambda s, d: A.a8_time_to_convert(_core(s, d), AS_OF),
        "a9": lambda s, d: A.a9_monthly_acquisition(_core(s, d)),
        "a10": lambda s, d: A.a10_daily_new_leads(_core(s, d), AS_OF),
        "a11": lambda s, d: A.a11_week_over_week(_core(s, d), AS_OF),
        "a12": lambda s, d: A.a12_monthly_rolling(_core(s, d)),
        "a13": lambda s, d: A.a13_current_vs_previous(_core(s, d), AS_OF),
        "a14": lambda s, d: A.a14_top_industries(_core(s, d)),
        "a15": lambda s, d: A.a15_industry_heatmap(_core(s, d)),
        "a16": lambda s, d: A.a16_deal_size(_core(s, d)),
        "a17": lambda s, d: A.a17_company_size(_core(s, d)),
        "a18": lambda s, d: A.a18_quality_summary(_core(s, d), _inv(s, d)),
        "a19": lambda s, d: A.a19_errors_by_type(_inv(s, d)),
        "a20": lambda s, d: A.a20_error_detail(_inv(s, d)),
        "a21": lambda s, d: A.a21_errors_per_day(_inv(s, d), AS_OF),
        "a22": lambda s, d: A.a22_repeat_offenders(_inv(s, d)),
        "a23": lambda s, d: A.a23_validation_by_field(_inv(s, d)),
        "a24": lambda s, d: A.a24_daily_error_rate(_inv(s, d), _core(s, d), AS_OF),
        "a25": lambda s, d: A.a25_errors_by_source(_inv(s, d)),
        "c1": _c1, "c2": _c2, "c3": _c3, "c4": _c4, "c5": _c5, "c4_store": _c4_store, "c5_store": _c5_store, "c6": _c6,
        "v3": _v3, "v4": _v4, "v8": _v8, "v9": _v9, "v10": _v10, "v11": _v11, "v12": _v12,
        "v14": _v14, "v15": _v15,
        "d1": _d1, "d2": _d2, "d3": _d3, "d4": _d4, "d5": _d5, "d6": _d6,
        "s1": _s1, "s2": _s2, "s3": _s3, "s4": _s4, "s7": _s7, "s8": _s8, "s11": _s11,
        "s9": _s9, "s10": _s10, "s12": _s12, "s13": _s13, "s13_store": _s13_store, "s14": _s14, "s15": _s15, "s17": _s17, "c7": _c7, "w1": _w1,
    }
    return q
