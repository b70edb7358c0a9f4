"""The 25 analytical reports (A1-A25) over core contacts and the quarantine.

``contacts`` is the core table; ``invalid`` is the quarantine in its analytics shape
(``processed_at`` = quarantine time). Every report takes an explicit ``as_of`` clock.
Windows without a partition (LAG, running averages, whole-set shares) only ever run
over already aggregated rows: one per week, month, day, stage or error type."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..constants import (FUNNEL_BUCKETS, FUNNEL_OTHER_BUCKET, LABEL_FORMAT, LABEL_MISSING,
                         LABEL_VALIDATION, MSG_INT, NO_CAMPAIGN, UNKNOWN)
from ..functions.expr import (conversion_rate, converted_count, days_before, error_label,
                              is_converted, jfield, month_start, parse_ts, pct,
                              round_half_up, sunday_week, with_json_fields)
from ..operators.percentile import percentile_of_counts, value_counts
from .marts import (metric_rows, n_rows, industry_analytics, lead_analytics, period_metrics, record_counts,
                    sales_funnel, since)



def source_or_unknown():
    return F.coalesce("hs_analytics_source", F.lit(UNKNOWN))


# ------------------------------------------------------------ 1. lead sources -------
def a1_leads_by_source(contacts: DataFrame, as_of=None) -> DataFrame:
    return lead_analytics(contacts, as_of).orderBy(F.col("total_leads").desc())


def a2_source_campaign_week(contacts: DataFrame) -> DataFrame:
    return (contacts.groupBy(
                source_or_unknown().alias("source"),
                F.coalesce("hs_analytics_source_data_1", F.lit(NO_CAMPAIGN)).alias("campaign"),
                sunday_week("created_at").alias("week_start"))
            .agg(n_rows().alias("leads_count"), converted_count().alias("converted_count"),
                 conversion_rate().alias("conversion_rate"))
            .orderBy(F.col("week_start").desc(), F.col("leads_count").desc()))


def a3_top_sources(contacts: DataFrame, min_leads: int = 10, k: int = 10) -> DataFrame:
    return (contacts.groupBy(source_or_unknown().alias("lead_source"))
            .agg(n_rows().alias("total_leads"), converted_count().alias("converted"),
                 conversion_rate().alias("conversion_rate"))
            .where(F.col("total_leads") >= min_leads)
            .orderBy(F.col("conversion_rate").desc_nulls_last(), F.col("lead_source").asc())
            .limit(k))


# ------------------------------------------------------------ 2. funnel -------------
def a4_funnel_by_status(contacts: DataFrame) -> DataFrame:
    f = sales_funnel(contacts, with_rank=True)
    return f.orderBy("_stage_order", "stage").drop("_stage_order")


def funnel_bucket(status="lead_status"):
    expr = None
    for name, members in FUNNEL_BUCKETS:
        cond = F.col(status).isin(*members)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(FUNNEL_OTHER_BUCKET))


def a5_funnel_stage_conversion(contacts: DataFrame, as_of=None) -> DataFrame:
    agg = since(contacts, as_of, 90).groupBy(funnel_bucket().alias("stage_bucket")) \
        .agg(n_rows().alias("count"))
    prev = F.lag("count").over(Window.orderBy("stage_bucket"))
    return (agg.select("stage_bucket", "count", prev.alias("previous_stage_count"))
            .withColumn("stage_conversion_rate",
                        pct(F.col("count"), F.col("previous_stage_count")))
            .orderBy("stage_bucket"))


def a6_weekly_funnel(contacts: DataFrame, as_of=None) -> DataFrame:
    s = F.col("lead_status")
    return (since(contacts, as_of, 90).groupBy(sunday_week("created_at").alias("week_start"))
            .agg(F.count_if(s.isin("NEW", "OPEN")).alias("new_leads"),
                 F.count_if(s == "IN_PROGRESS").alias("qualified"),
                 F.count_if(s.isin("ATTENDED", "CONNECTED")).alias("engaged"),
                 F.count_if(s == "WORKING").alias("working"),
                 F.count_if(s == "CLOSED").alias("converted"))
            .orderBy("week_start"))


# ------------------------------------------------------------ 3. conversion ---------
def a7_conversion_periods(contacts: DataFrame, as_of=None) -> DataFrame:
    return period_metrics(contacts, as_of, [("Last 7 days", 7), ("Last 30 days", 30),
                                            ("Last 90 days", 90), ("All time", None)])


def a8_time_to_convert(contacts: DataFrame, as_of=None) -> DataFrame:
    days = F.datediff(F.to_date("lastmodifieddate"), F.to_date("created_at"))
    return (since(contacts, as_of, 180).groupBy(source_or_unknown().alias("source"))
            .agg(n_rows().alias("total_leads"), converted_count().alias("converted"),
                 conversion_rate().alias("conversion_rate"),
                 round_half_up(F.avg(F.when(is_converted(), days)), 1).alias("avg_days_to_convert"))
            .orderBy(F.col("conversion_rate").desc()))


def a9_monthly_acquisition(contacts: DataFrame) -> DataFrame:
    return (contacts.groupBy(month_start("created_at").alias("month"))
            .agg(n_rows().alias("leads_generated"), converted_count().alias("customers_acquired"),
                 conversion_rate().alias("conversion_rate"),
                 F.sum("annual_revenue").alias("total_revenue"),
                 (F.sum("annual_revenue") / n_rows()).alias("revenue_per_lead"))
            .orderBy(F.col("month").desc()))


# ------------------------------------------------------------ 4. dynamics -----------
def a10_daily_new_leads(contacts: DataFrame, as_of=None) -> DataFrame:
    return (since(contacts, as_of, 30).groupBy(F.to_date("created_at").alias("date"))
            .agg(n_rows().alias("new_leads"), converted_count().alias("conversions"),
                 conversion_rate().alias("conversion_rate"),
                 F.countDistinct("company_name").alias("new_companies"))
            .orderBy(F.col("date").desc()))


def a11_week_over_week(contacts: DataFrame, as_of=None) -> DataFrame:
    agg = since(contacts, as_of, 90).groupBy(sunday_week("created_at").alias("week_start")) \
        .agg(n_rows().alias("weekly_leads"), converted_count().alias("weekly_conversions"))
    prev = F.lag("weekly_leads").over(Window.orderBy("week_start"))
    return (agg.select("week_start", "weekly_leads", prev.alias("previous_week"),
                       "weekly_conversions")
            .withColumn("week_over_week_change_pct",
                        pct(F.col("weekly_leads") - F.col("previous_week"), F.col("previous_week")))
            .select("week_start", "weekly_leads", "previous_week",
                    "week_over_week_change_pct", "weekly_conversions")
            .orderBy(F.col("week_start").desc()))


def a12_monthly_rolling(contacts: DataFrame) -> DataFrame:
    agg = contacts.groupBy(month_start("created_at").alias("month")).agg(
        n_rows().alias("monthly_leads"), converted_count().alias("monthly_conversions"),
        conversion_rate().alias("monthly_conversion_rate"))
    w = Window.orderBy("month").rowsBetween(-2, Window.currentRow)
    return (agg.select("month", "monthly_leads",
                       F.avg("monthly_leads").over(w).alias("rolling_3month_avg"),
                       "monthly_conversions", "monthly_conversion_rate")
            .orderBy(F.col("month").desc()))


def a13_current_vs_previous(contacts: DataFrame, as_of=None) -> DataFrame:
    """Current = last 30 days; previous = [as_of-60d, as_of-30d], both ends inclusive,
    so a row exactly at as_of-30d counts in both. One scan, two conditional sets."""
    cur = F.col("created_at") >= days_before(as_of, 30)
    prev = F.col("created_at").between(days_before(as_of, 60), days_before(as_of, 30))
    closed = is_converted()
    one = since(contacts, as_of, 60).agg(
        F.count_if(cur).alias("n0"), F.count_if(cur & closed).alias("c0"),
        F.count_if(prev).alias("n1"), F.count_if(prev & closed).alias("c1"))
    rows = [F.struct(F.lit(label).alias("period"), F.col(f"n{i}").alias("leads"),
                     F.col(f"c{i}").alias("conversions"),
                     pct(F.col(f"c{i}"), F.col(f"n{i}")).alias("conversion_rate"))
            for i, label in enumerate(["Current Period", "Previous Period"])]
    return one.select(F.inline(F.array(*rows)))


# ------------------------------------------------------------ 5. industries ---------
def a14_top_industries(contacts: DataFrame) -> DataFrame:
    return industry_analytics(contacts).orderBy(F.col("total_leads").desc())


def a15_industry_heatmap(contacts: DataFrame) -> DataFrame:
    s = F.col("lead_status")
    return (contacts.groupBy("industry")
            .agg(F.count_if((s == "NEW") | (s == "OPEN")).alias("new_leads"),
                 F.count_if(s == "IN_PROGRESS").alias("qualified"),
                 F.count_if(s.isin("ATTENDED", "CONNECTED")).alias("engaged"),
                 F.count_if(s == "WORKING").alias("working"),
                 F.count_if(s == "CLOSED").alias("converted"),
                 F.count_if(s == "UNQUALIFIED").alias("disqualified"),
                 n_rows().alias("total"))
            .select(F.coalesce("industry", F.lit(UNKNOWN)).alias("industry"), "new_leads",
                    "qualified", "engaged", "working", "converted", "disqualified", "total")
            .orderBy(F.col("total").desc()))


def a16_deal_size(contacts: DataFrame) -> DataFrame:
    """Per raw industry over revenue > 0, with the exact median (PERCENTILE_CONT 0.5)
    computed without gathering an industry in one task."""
    deals = contacts.where(F.col("annual_revenue") > 0).select("industry", "annual_revenue")
    counts = value_counts(deals, ["industry"], "annual_revenue")   # read once, its shuffle reused
    total = F.sum(F.col("_v") * F.col("_c"))
    stats = counts.groupBy("industry").agg(
        F.sum("_c").alias("deals_count"),
        round_half_up(total / F.sum("_c"), 2).alias("avg_deal_size"),
        F.min("_v").alias("min_deal"), F.max("_v").alias("max_deal"), total.alias("total_revenue"))
    med = percentile_of_counts(counts, ["industry"], 0.5, "median_deal_size").withColumnRenamed("industry", "_mi")
    # both sides hold one row per industry
    j = stats.join(med, stats["industry"].eqNullSafe(med["_mi"]), "left")
    return (j.select(F.coalesce("industry", F.lit(UNKNOWN)).alias("industry"), "deals_count",
                     "avg_deal_size", "median_deal_size", "min_deal", "max_deal",
                     "total_revenue")
            .orderBy(F.col("avg_deal_size").desc()))


def a17_company_size(contacts: DataFrame) -> DataFrame:
    e = F.col("numberofemployees")
    small, mid, large = F.count_if(e < 50), F.count_if(e.between(50, 250)), F.count_if(e > 250)
    return (contacts.groupBy("industry")
            .agg(small.alias("small_companies"), mid.alias("mid_companies"),
                 large.alias("large_companies"),
                 round_half_up(F.avg(e), 0).alias("avg_employees"))
            .select(F.coalesce("industry", F.lit(UNKNOWN)).alias("industry"),
                    "small_companies", "mid_companies", "large_companies", "avg_employees",
                    (F.col("small_companies") + F.col("mid_companies")
                     + F.col("large_companies")).alias("_banded"))
            .orderBy(F.col("_banded").desc()).drop("_banded"))


# ------------------------------------------------------------ 6. invalid data -------
def a18_quality_summary(contacts: DataFrame, invalid: DataFrame) -> DataFrame:
    """Analytics edition (T14): Total = contacts, Valid = contacts - invalid."""
    c = record_counts(contacts, invalid)
    t, i = F.col("valid_count").cast("double"), F.col("invalid_count").cast("double")
    return c.select(F.inline(metric_rows([
        ("Total Records", t), ("Valid Records", t - i), ("Invalid Records", i),
        ("Data Quality Score %", pct(t - i, t))])))


def invalid_contacts(quarantine: DataFrame) -> DataFrame:
    """The written quarantine as the reports read it, API and CSV records alike."""
    return quarantine.withColumnRenamed("quarantined_at", "processed_at")


def _label(labels: dict | None) -> Column:
    """The counted label of an error; values that are no integers are format errors."""
    return F.when(F.col("error_message") == MSG_INT, F.lit(LABEL_FORMAT)) \
        .otherwise(error_label("error_type", labels))


def _parsed(invalid: DataFrame, *names: str) -> DataFrame:
    return with_json_fields(invalid, "original_data", list(names))


def a19_errors_by_type(invalid: DataFrame) -> DataFrame:
    agg = _parsed(invalid, "contact_id").groupBy("error_type").agg(
        n_rows().alias("error_count"),
        F.countDistinct(jfield("contact_id")).alias("affected_records"))
    total = F.sum("error_count").over(Window.partitionBy())
    return (agg.select("error_type", "error_count",
                       pct(F.col("error_count"), total).alias("percentage"),
                       "affected_records")
            .orderBy(F.col("error_count").desc()))


def a20_error_detail(invalid: DataFrame) -> DataFrame:
    created = parse_ts(jfield("created_at"))
    return (_parsed(invalid, "email", "created_at").groupBy("error_type")
            .agg(n_rows().alias("total_errors"),
                 F.countDistinct(jfield("email")).alias("unique_emails_affected"),
                 F.min(created).alias("earliest_error"),
                 F.max(created).alias("latest_error"))
            .orderBy(F.col("total_errors").desc()))


def a21_errors_per_day(invalid: DataFrame, as_of=None, labels: dict | None = None) -> DataFrame:
    lab = _label(labels)
    return (since(invalid, as_of, 30, col="processed_at")
            .groupBy(F.to_date("processed_at").alias("error_date"))
            .agg(n_rows().alias("daily_errors"),
                 F.countDistinct("error_type").alias("unique_error_types"),
                 F.count_if(lab == LABEL_VALIDATION).alias("validation_errors"),
                 F.count_if(lab == LABEL_MISSING).alias("missing_field_errors"),
                 F.count_if(lab == LABEL_FORMAT).alias("format_errors"))
            .orderBy(F.col("error_date").desc()))


def a22_repeat_offenders(invalid: DataFrame, k: int = 20) -> DataFrame:
    """Top-k (the feature) of (e-mail, company) groups with more than one error.

    One pass over the quarantine. Distinct (group, type, message) triples are formed first
    (partial aggregation map-side), so the sets built per group hold distinct values
    only; the per-group aggregate falls back to sort-based aggregation and spills when
    groups are many. Ranking a first aggregate and gathering the sets only for the k
    winners would read the quarantine again, which costs more than the sets save."""
    email = jfield("email").alias("email")
    company = jfield("company_name").alias("company")
    trip = _parsed(invalid, "email", "company_name") \
        .groupBy(email, company, "error_type", "error_message").agg(n_rows().alias("_n"))
    return (trip.groupBy("email", "company")
            .agg(F.sum("_n").alias("error_count"),
                 F.array_join(F.sort_array(F.collect_set("error_type")), ", ").alias("error_types"),
                 F.array_join(F.sort_array(F.collect_set("error_message")), "; ").alias("error_messages"))
            .where(F.col("error_count") > 1)
            .orderBy(F.col("error_count").desc(), F.col("email").asc_nulls_first(),
                     F.col("company").asc_nulls_first())
            .limit(k))


def a23_validation_by_field(invalid: DataFrame) -> DataFrame:
    em, co, rv = jfield("email"), jfield("company_name"), jfield("annual_revenue")
    one = _parsed(invalid, "email", "company_name", "annual_revenue").agg(
        F.count_if(em.isNull() | (em == "")).alias("e"),
        F.count_if(co.isNull() | (co == "")).alias("c"),
        F.count_if(rv.try_cast("bigint").isNull() & rv.isNotNull()).alias("r"),
        n_rows().alias("t"))
    rows = [F.struct(F.lit(name).alias("field_name"), F.col(c).alias("null_or_empty"),
                     F.col("t").alias("total_invalid"))
            for name, c in [("email", "e"), ("company_name", "c"), ("annual_revenue", "r")]]
    return one.select(F.inline(F.array(*rows)))


def a24_daily_error_rate(invalid: DataFrame, contacts: DataFrame, as_of=None) -> DataFrame:
    """invalid / (invalid + contacts created that day), last 30 days: two daily
    aggregates and a left join of the (small) daily rows."""
    inv = since(invalid, as_of, 30, col="processed_at") \
        .groupBy(F.to_date("processed_at").alias("date")).agg(n_rows().alias("invalid_count"))
    lower_day = F.to_date(days_before(as_of, 30))
    c = contacts.where(F.col("created_at") >= lower_day.cast("timestamp"))
    if "created_month" in contacts.columns:
        c = c.where(F.col("created_month") >= F.trunc(lower_day, "month"))
    day = c.groupBy(F.to_date("created_at").alias("date")).agg(n_rows().alias("_day_contacts"))
    j = inv.join(day, "date", "left")
    rate = pct(F.col("invalid_count"),
               F.col("invalid_count") + F.coalesce("_day_contacts", F.lit(0)))
    return j.select("date", "invalid_count", rate.alias("error_rate_pct")) \
        .orderBy(F.col("date").desc())


def a25_errors_by_source(invalid: DataFrame, labels: dict | None = None) -> DataFrame:
    lab = _label(labels)
    src = jfield("hs_analytics_source")
    return (_parsed(invalid, "hs_analytics_source", "email").groupBy(src.alias("_src"))
            .agg(n_rows().alias("invalid_count"),
                 F.countDistinct(jfield("email")).alias("affected_emails"),
                 F.count_if(lab == LABEL_VALIDATION).alias("validation"),
                 F.count_if(lab == LABEL_MISSING).alias("missing_field"),
                 F.count_if(lab == LABEL_FORMAT).alias("invalid_format"))
            .select(F.coalesce("_src", F.lit(UNKNOWN)).alias("source"), "invalid_count",
                    "affected_emails", "validation", "missing_field", "invalid_format")
            .orderBy(F.col("invalid_count").desc()))
