"""The six marts (M1-M6) and their registry (M0).

Each mart is a function of the core table (and the quarantine for M5) and an explicit
clock ``as_of``; ``None`` means ``current_timestamp()``. Time windows filter
``created_at`` and, when the table carries the ``created_month`` partition column, that
column too, so a day-partitioned core is pruned at the scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..constants import UNASSIGNED_STAGE, UNKNOWN
from ..functions.expr import (as_of_lit, conversion_rate, converted_count, days_before,
                              is_converted, pct, round_half_up, safe_div, status_rank)
from ..schema import INGEST_DAY



def n_rows():
    """COUNT(*)."""
    return F.count(F.lit(1))


def since(df: DataFrame, as_of, days: int, col: str = "created_at") -> DataFrame:
    """``col >= as_of - days``, plus a partition-column bound for pruning."""
    lower = days_before(as_of, days)
    out = df.where(F.col(col) >= lower)
    if col == "created_at" and "created_month" in df.columns:
        out = out.where(F.col("created_month") >= F.trunc(F.to_date(lower), "month"))
    if col == "processed_at" and INGEST_DAY in df.columns:
        out = out.where(F.col(INGEST_DAY) >= F.to_date(lower))
    return out


def lead_analytics(core: DataFrame, as_of=None) -> DataFrame:
    """M1: per coalesced lead source over the last 90 days."""
    return (since(core, as_of, 90)
            .groupBy(F.coalesce("hs_analytics_source", F.lit(UNKNOWN)).alias("lead_source"))
            .agg(n_rows().alias("total_leads"),
                 F.countDistinct("contact_id").alias("unique_contacts"),
                 converted_count().alias("converted_leads"),
                 conversion_rate().alias("conversion_rate_pct"),
                 round_half_up(F.avg("annual_revenue"), 2).alias("avg_annual_revenue"),
                 F.sum("annual_revenue").alias("total_revenue")))


def sales_funnel(core: DataFrame, with_rank: bool = False) -> DataFrame:
    """M2: per raw lead status (NULL and a literal 'unassigned' stay two rows).

    The share uses a whole-set window, but over the aggregated rows only (one per
    status), never over the contacts."""
    agg = core.groupBy("lead_status").agg(
        n_rows().alias("contacts_count"),
        F.countDistinct("company_name").alias("unique_companies"),
        F.sum("annual_revenue").alias("pipeline_value"))
    total = F.sum("contacts_count").over(Window.partitionBy())
    cols = [F.coalesce("lead_status", F.lit(UNASSIGNED_STAGE)).alias("stage"),
            "contacts_count",
            pct(F.col("contacts_count"), total).alias("percentage_of_total"),
            "unique_companies", "pipeline_value"]
    if with_rank:
        cols.append(status_rank("lead_status").alias("_stage_order"))
    return agg.select(*cols)


def industry_analytics(core: DataFrame) -> DataFrame:
    """M3: per raw industry; NULL shown as 'unknown'."""
    return core.groupBy("industry").agg(
        n_rows().alias("total_leads"),
        F.countDistinct("contact_id").alias("unique_contacts"),
        F.countDistinct("company_name").alias("companies"),
        converted_count().alias("customers"),
        conversion_rate().alias("conversion_rate"),
        round_half_up(F.avg("annual_revenue"), 2).alias("avg_revenue"),
        F.sum("annual_revenue").alias("total_revenue"),
    ).select(F.coalesce("industry", F.lit(UNKNOWN)).alias("industry"),
             "total_leads", "unique_contacts", "companies", "customers",
             "conversion_rate", "avg_revenue", "total_revenue")


def period_metrics(core: DataFrame, as_of, periods: list[tuple[str, int | None]],
                   deal_size: bool = True) -> DataFrame:
    """Conversion per look-back period, in ONE scan: conditional aggregates per period,
    then one output row per period (a row even when the period is empty)."""
    aggs, rows = [], []
    closed = is_converted()
    for i, (label, days) in enumerate(periods):
        cond = F.lit(True) if days is None else (F.col("created_at") >= days_before(as_of, days))
        aggs += [F.count_if(cond).alias(f"n{i}"),
                 F.count_if(cond & closed).alias(f"c{i}")]
        if deal_size:
            aggs.append(F.avg(F.when(cond & closed, F.col("annual_revenue"))).alias(f"a{i}"))
    one = core.agg(*aggs)
    for i, (label, _) in enumerate(periods):
        fields = [F.lit(label).alias("period"),
                  F.col(f"n{i}").alias("total_leads"),
                  F.col(f"c{i}").alias("converted"),
                  pct(F.col(f"c{i}"), F.col(f"n{i}")).alias("conversion_rate")]
        if deal_size:
            fields.append(F.col(f"a{i}").alias("avg_deal_size"))
        rows.append(F.struct(*fields))
    return one.select(F.inline(F.array(*rows)))


def conversion_metrics(core: DataFrame, as_of=None) -> DataFrame:
    """M4: last 7 days, last 30 days, all time."""
    return period_metrics(core, as_of,
                          [("Last 7 days", 7), ("Last 30 days", 30), ("All time", None)])


def record_counts(core: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Row counts of core and quarantine in one aggregate, without a join: both sides
    are projected to a tag column, unioned, and counted per tag."""
    tagged = core.select(F.lit(1).alias("_core")).unionByName(
        quarantine.select(F.lit(0).alias("_core")))
    return tagged.agg(F.count_if(F.col("_core") == 1).alias("valid_count"),
                      F.count_if(F.col("_core") == 0).alias("invalid_count"))


def metric_rows(pairs, names=("metric", "value")):
    """Array of (label, value) structs with the same field names, for ``inline``."""
    return F.array(*[F.struct(F.lit(label).alias(names[0]), val.alias(names[1]))
                     for label, val in pairs])


def _num_text(x):
    """Print a DOUBLE the warehouse way: a whole number without '.0'."""
    return F.regexp_replace(x.cast("string"), r"\.0$", "")


def data_quality(core: DataFrame, quarantine: DataFrame) -> DataFrame:
    """M5: Total = valid + invalid; Valid = core rows; Invalid = quarantine rows."""
    c = record_counts(core, quarantine)
    v, i = F.col("valid_count"), F.col("invalid_count")
    return c.select(F.inline(metric_rows([
        ("Total Records", (v + i).cast("string")),
        ("Valid Records", v.cast("string")),
        ("Invalid Records", i.cast("string")),
        ("Data Quality Score %", _num_text(pct(v, v + i)))])))


def daily_trends(core: DataFrame, as_of=None) -> DataFrame:
    """M6: per day of creation over the last 30 days."""
    return (since(core, as_of, 30)
            .groupBy(F.to_date("created_at").alias("date"))
            .agg(n_rows().alias("new_leads"),
                 converted_count().alias("conversions"),
                 F.countDistinct("company_name").alias("new_companies")))


def build_marts(core: DataFrame, quarantine: DataFrame, as_of=None) -> dict[str, DataFrame]:
    """M0: name → mart DataFrame."""
    return {
        "vw_lead_analytics": lead_analytics(core, as_of),
        "vw_sales_funnel": sales_funnel(core),
        "vw_industry_analytics": industry_analytics(core),
        "vw_conversion_metrics": conversion_metrics(core, as_of),
        "vw_data_quality": data_quality(core, quarantine),
        "vw_daily_trends": daily_trends(core, as_of),
    }


def register_marts(core: DataFrame, quarantine: DataFrame, as_of=None,
                   log=print) -> list[str]:
    """Create-or-replace one temp view per mart; a failing mart is reported and
    skipped, the others are still registered."""
    done = []
    for name, builder in [
            ("vw_lead_analytics", lambda: lead_analytics(core, as_of)),
            ("vw_sales_funnel", lambda: sales_funnel(core)),
            ("vw_industry_analytics", lambda: industry_analytics(core)),
            ("vw_conversion_metrics", lambda: conversion_metrics(core, as_of)),
            ("vw_data_quality", lambda: data_quality(core, quarantine)),
            ("vw_daily_trends", lambda: daily_trends(core, as_of))]:
        try:
            builder().createOrReplaceTempView(name)
            done.append(name)
        except Exception as exc:  # noqa: BLE001 - one bad view must not stop the rest
            log(f"view {name} failed: {exc}")
    return done
