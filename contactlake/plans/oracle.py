"""DuckDB SQL for each registered query (the correctness oracle).

The fixture views of FIXTURES.md §6 are inlined as CTEs over the pre-registered driver
tables; every body then states the report in plain SQL. Sums are cast to BIGINT
(DuckDB returns HUGEINT), roundings go through DECIMAL like the Spark side, NULL order
of tie-breaks is explicit."""

from __future__ import annotations

from ..constants import (ACCEPTED_INDUSTRY, ACCEPTED_LEAD_STATUS, API_PROPERTIES,
                         EMAIL_PATTERN, MSG_API_MISSING_EMAIL, MSG_CSV_MISSING_EMAIL)
from ..operators.validate import MSG_EMAIL, MSG_INT, MSG_SHAPE_API

AS_OF = "TIMESTAMP '2001-08-01 00:00:00'"
_EMAIL = EMAIL_PATTERN.replace("'", "''")


def _text(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def R(x: str, d: int = 2) -> str:
    return f"CAST(ROUND(CAST(({x}) AS DECIMAL(38,10)), {d}) AS DOUBLE)"


def PCT(num: str, den: str) -> str:
    return R(f"({num}) / NULLIF(({den}), 0) * 100")


CONV = "COUNT_IF(lead_status = 'CLOSED')"
RATE = PCT(CONV, "COUNT(*)")
WEEK = "CAST(date_trunc('week', created_at + INTERVAL 1 DAY) - INTERVAL 1 DAY AS DATE)"
MONTH = "CAST(date_trunc('month', created_at) AS DATE)"


def since(days: int, col: str = "created_at") -> str:
    return f"{col} >= {AS_OF} - INTERVAL {days} DAY"


def jv(name: str) -> str:
    """A member of a flat record, or of an API contact (nested, some under other names)."""
    api = {"contact_id": "id", "company_name": "properties.company", "annual_revenue": "properties.annualrevenue",
           "created_at": "properties.createdate"}.get(name, f"properties.{name}")
    return (f"COALESCE(json_extract_string(original_data, '$.{name}'), "
            f"json_extract_string(original_data, '$.{api}'))")


def parse_ts_sql(x: str) -> str:
    n0 = f"replace(trim({x}), 'Z', '+00:00')"
    n = f"(CASE WHEN {n0} LIKE '% +0000' THEN replace({n0}, ' +0000', '+00:00') ELSE {n0} END)"
    p = r"'^(\d{4}-\d{2}-\d{2})T(\d{2}:\d{2}:\d{2}(?:\.\d{1,6})?)(?:([+-])(\d{2}):(\d{2}))?$'"
    off = (f"(CASE WHEN regexp_extract({n}, {p}, 3) = '-' THEN -1 ELSE 1 END) * "
           f"(COALESCE(TRY_CAST(regexp_extract({n}, {p}, 4) AS INTEGER), 0) * 60 + "
           f"COALESCE(TRY_CAST(regexp_extract({n}, {p}, 5) AS INTEGER), 0))")
    return (f"(CASE WHEN trim({x}) LIKE '%T%' AND regexp_matches({n}, {p}) THEN "
            f"TRY_CAST(regexp_extract({n}, {p}, 1) || ' ' || regexp_extract({n}, {p}, 2) AS TIMESTAMP)"
            f" - to_minutes(CAST({off} AS BIGINT)) END)")


def int_ok_sql(x: str) -> str:
    return (f"({x} IS NULL OR {x} = '' OR "
            f"COALESCE(regexp_matches(trim({x}), '^[+-]?[0-9]+(_[0-9]+)*$') "
            f"AND TRY_CAST(replace(trim({x}), '_', '') AS BIGINT) IS NOT NULL, false))")


def parse_int_sql(x: str) -> str:
    return f"(CASE WHEN {int_ok_sql(x)} AND {x} <> '' THEN TRY_CAST(replace(trim({x}), '_', '') AS BIGINT) END)"


def clean_sql(x: str) -> str:
    return f"NULLIF(regexp_replace({x}, '^\\s+|\\s+$', '', 'g'), '')"


def dedupe_sql(src: str) -> str:
    return (f"SELECT * EXCLUDE (rk) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY contact_id "
            f"ORDER BY lastmodifieddate DESC NULLS LAST, processed_at DESC NULLS LAST, "
            f"ingest_seq DESC NULLS LAST) AS rk FROM {src}) t WHERE rk = 1")


CONTACT_COLS = ("contact_id, email, first_name, last_name, company_name, job_title, industry, "
                "annual_revenue, numberofemployees, created_at, lastmodifieddate, lead_status, "
                "hs_analytics_source, hs_analytics_source_data_1, processed_at, run_id")

FIXTURES = f"""
contacts_raw AS (
SELECT CAST(o_custkey AS STRING) AS contact_id,
       'user' || CAST(o_custkey AS STRING) || '@example.com' AS email,
       CASE WHEN o_orderkey % 9 = 0 THEN '  ' ELSE 'First' || CAST(o_custkey AS STRING) END AS first_name,
       'Last' || CAST(o_custkey AS STRING) AS last_name,
       c_name AS company_name,
       CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE 'Manager ' END AS job_title,
       NULLIF(c_mktsegment, 'HOUSEHOLD') AS industry,
       CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(FLOOR(o_totalprice) AS BIGINT) END AS annual_revenue,
       CAST(o_custkey % 400 AS BIGINT) AS numberofemployees,
       o_orderdate AS created_at,
       CASE WHEN o_orderkey % 17 = 0 THEN NULL
            ELSE o_orderdate + INTERVAL '1' DAY * (o_orderkey % 30) END AS lastmodifieddate,
       CASE o_orderkey % 10 WHEN 0 THEN 'NEW' WHEN 1 THEN 'OPEN' WHEN 2 THEN 'IN_PROGRESS'
            WHEN 3 THEN 'UNQUALIFIED' WHEN 4 THEN 'ATTENDED' WHEN 5 THEN 'CONNECTED'
            WHEN 6 THEN 'WORKING' WHEN 7 THEN 'CLOSED' WHEN 8 THEN 'CLOSED' END AS lead_status,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'google_ads' WHEN '2-HIGH' THEN 'linkedin'
            WHEN '3-MEDIUM' THEN 'referral' WHEN '4-NOT SPECIFIED' THEN 'organic' END AS hs_analytics_source,
       NULLIF(n_name, 'NATION_0') AS hs_analytics_source_data_1,
       o_orderdate + INTERVAL '30' DAY AS processed_at,
       'run_' || CAST(EXTRACT(YEAR FROM o_orderdate) AS STRING) AS run_id,
       o_orderkey AS ingest_seq
FROM orders
JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey),
core_contacts AS ({dedupe_sql('contacts_raw')}),
api_contacts AS (
SELECT CAST(event_id AS STRING) AS id,
       CASE event_id % 8 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'invalidemail.com'
            WHEN 3 THEN 'user@' WHEN 4 THEN 'user@domain' WHEN 5 THEN 'user name@company.com'
            ELSE 'User' || CAST(user_id AS STRING) || '@Company.com' END AS email,
       CASE event_id % 6 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '0' WHEN 3 THEN 'abc'
            ELSE CAST(CAST(FLOOR(value * 1000) AS BIGINT) AS STRING) END AS annualrevenue,
       CASE event_id % 7 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '15/01/2024'
            WHEN 3 THEN '2024-01-15' WHEN 4 THEN '2024-01-15T10:30:00 +0000'
            WHEN 5 THEN '2024-01-15T10:30:00Z +0000' ELSE '2024-01-15T10:30:00Z' END AS createdate,
       'Company ' || CAST(user_id % 20 AS STRING) AS company,
       event_type AS hs_analytics_source,
       ts - INTERVAL '8218' DAY AS processed_at,
       event_id, user_id, props
FROM events),
api_checked AS (
SELECT *, CASE WHEN email IS NULL OR email = '' THEN 'MissingEmail'
              WHEN NOT regexp_matches(email, '{_EMAIL}') THEN 'ValidationError'
              WHEN annualrevenue = 'abc' THEN 'ValidationError' END AS error_type
FROM api_contacts),
invalid_contacts AS (
SELECT id,
       CASE WHEN event_id % 2 = 1 THEN
         '{{"id":"' || id || '","properties":{{"email":' || COALESCE('"' || email || '"', 'null')
         || ',"company":"' || company || '","annualrevenue":'
         || COALESCE('"' || annualrevenue || '"', 'null')
         || ',"createdate":' || COALESCE('"' || createdate || '"', 'null')
         || ',"hs_analytics_source":"' || hs_analytics_source || '"}}}}'
       ELSE
         '{{"contact_id":"' || id || '","email":' || COALESCE('"' || email || '"', 'null')
         || ',"company_name":"' || company || '","annual_revenue":'
         || COALESCE('"' || annualrevenue || '"', 'null')
         || ',"created_at":' || COALESCE('"' || createdate || '"', 'null')
         || ',"hs_analytics_source":"' || hs_analytics_source || '"}}' END AS original_data,
       error_type,
       CASE WHEN email IS NULL OR email = '' THEN {_text(MSG_API_MISSING_EMAIL)}
            WHEN NOT regexp_matches(email, '{_EMAIL}') THEN {_text(MSG_EMAIL)}
            ELSE {_text(MSG_INT)} END AS error_message,
       processed_at, 'run_1' AS run_id
FROM api_checked WHERE error_type IS NOT NULL)
"""


def S(text: str) -> str:
    """SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


def JT(x: str) -> str:
    """JSON string of a text expression, or null (fixture texts need no escaping)."""
    return f"COALESCE('\"' || {x} || '\"', 'null')"


_K = "json_extract_string(props, '$.k')"
_FIRST = "'First' || CAST(user_id AS STRING)"
# API records as JSON text with type faults, the same text the Spark fixture builds
API_JSON = (
    "api_json AS (\nSELECT event_id, '{\"id\":' || CASE WHEN event_id % 5 = 0 "
    "THEN CAST(event_id AS STRING) ELSE '\"' || CAST(event_id AS STRING) || '\"' END"
    " || CASE WHEN event_id % 5 = 2 THEN '' ELSE "
    f"',\"properties\":{{\"email\":' || {JT('email')}"
    f" || ',\"firstname\":' || {JT(_FIRST)}"
    f" || ',\"company\":' || {JT('company')}"
    f" || ',\"annualrevenue\":' || {JT('annualrevenue')}"
    f" || ',\"createdate\":' || {JT('createdate')}"
    f" || ',\"numberofemployees\":' || CASE WHEN event_id % 5 = 1 THEN COALESCE({_K}, 'null') "
    f"ELSE {JT(_K)} END"
    f" || ',\"hs_analytics_source\":' || {JT('hs_analytics_source')} || '}}' END || '}}' AS rec\n"
    "FROM api_contacts)")


def _prop(name: str) -> str:
    return f"json_extract_string(rec, '$.properties.{name}')"


def _shape_ok() -> str:
    parts = ["json_type(rec, '$.id') = 'VARCHAR'",
             "COALESCE(json_type(rec, '$.properties') = 'OBJECT', false)"]
    parts += [f"COALESCE(json_type(rec, '$.properties.{p}') IN ('VARCHAR', 'NULL'), true)"
              for p in API_PROPERTIES]
    return " AND ".join(parts)


CSV_ROWS = f"""
csv_rows AS (
SELECT event_id, id AS contact_id, COALESCE(email, '') AS email,
       'First' || CAST(user_id AS STRING) AS first_name, 'Last' || CAST(user_id AS STRING) AS last_name,
       company AS company_name, '' AS job_title, COALESCE(annualrevenue, '') AS annual_revenue,
       COALESCE(createdate, '') AS created_at
FROM api_contacts),
csv_checked AS (
SELECT *,
       CASE WHEN email = '' OR NOT contains(email, '@') THEN 'MissingEmail'
            WHEN NOT regexp_matches(email, '{_EMAIL}') THEN 'ValidationError'
            WHEN NOT {int_ok_sql('annual_revenue')} THEN 'ValidationError' END AS error_type,
       CASE WHEN email = '' OR NOT contains(email, '@') THEN {S(MSG_CSV_MISSING_EMAIL)}
            WHEN NOT regexp_matches(email, '{_EMAIL}') THEN {S(MSG_EMAIL)}
            WHEN NOT {int_ok_sql('annual_revenue')} THEN {S(MSG_INT)} END AS error_message
FROM csv_rows)
"""


# original record text of the quarantine fixture (as the Spark fixture writes it)
FIXTURE_SRC_JSON = ("'{\"contact_id\":\"' || id || '\",\"email\":' || COALESCE('\"' || email || '\"', 'null')"
            " || ',\"company_name\":\"' || company || '\",\"annual_revenue\":'"
            " || COALESCE('\"' || annualrevenue || '\"', 'null')"
            " || ',\"created_at\":' || COALESCE('\"' || createdate || '\"', 'null')"
            " || ',\"hs_analytics_source\":\"' || hs_analytics_source || '\"}'")


def with_fixtures(body: str) -> str:
    return f"WITH {FIXTURES.strip()}\n{body.strip()}"


def with_more(extra_ctes: str, body: str) -> str:
    return f"WITH {FIXTURES.strip()},\n{extra_ctes.strip()}\n{body.strip()}"


LABEL = ("CASE WHEN error_message = 'value is not a valid integer' THEN 'invalid_format' ELSE "
         "CASE error_type WHEN 'ValidationError' THEN 'validation_error' "
         "WHEN 'MissingEmail' THEN 'missing_field' ELSE error_type END END")

STG = f"""
stg AS (
SELECT contact_id, email, {clean_sql('first_name')} AS first_name, {clean_sql('last_name')} AS last_name,
       {clean_sql('company_name')} AS company_name, {clean_sql('job_title')} AS job_title,
       {clean_sql('industry')} AS industry, annual_revenue, numberofemployees,
       CAST(created_at AS TIMESTAMP) AS created_at, CAST(lastmodifieddate AS TIMESTAMP) AS lastmodifieddate,
       COALESCE({clean_sql('lead_status')}, 'UNASSIGNED') AS lead_status,
       COALESCE({clean_sql('hs_analytics_source')}, 'unknown') AS hs_analytics_source,
       hs_analytics_source_data_1, CAST(processed_at AS TIMESTAMP) AS processed_at, run_id, ingest_seq
FROM contacts_raw
WHERE contact_id IS NOT NULL AND email IS NOT NULL AND email <> '')
"""


def _sql() -> dict[str, str]:
    q: dict[str, str] = {}
    m1 = f"""
SELECT COALESCE(hs_analytics_source, 'unknown') AS lead_source, COUNT(*) AS total_leads,
       COUNT(DISTINCT contact_id) AS unique_contacts, {CONV} AS converted_leads,
       {RATE} AS conversion_rate_pct, {R('AVG(annual_revenue)')} AS avg_annual_revenue,
       CAST(SUM(annual_revenue) AS BIGINT) AS total_revenue
FROM core_contacts WHERE {since(90)}
GROUP BY COALESCE(hs_analytics_source, 'unknown')"""
    q["m1"] = m1
    funnel = f"""
SELECT COALESCE(lead_status, 'unassigned') AS stage, COUNT(*) AS contacts_count,
       {PCT('COUNT(*)', 'SUM(COUNT(*)) OVER ()')} AS percentage_of_total,
       COUNT(DISTINCT company_name) AS unique_companies,
       CAST(SUM(annual_revenue) AS BIGINT) AS pipeline_value
FROM core_contacts GROUP BY lead_status"""
    q["m2"] = funnel
    industry = f"""
SELECT COALESCE(industry, 'unknown') AS industry, COUNT(*) AS total_leads,
       COUNT(DISTINCT contact_id) AS unique_contacts, COUNT(DISTINCT company_name) AS companies,
       {CONV} AS customers, {RATE} AS conversion_rate, {R('AVG(annual_revenue)')} AS avg_revenue,
       CAST(SUM(annual_revenue) AS BIGINT) AS total_revenue
FROM core_contacts GROUP BY industry"""
    q["m3"] = industry

    def period(label, days, deal=True):
        where = f"WHERE {since(days)}" if days else ""
        deal_col = ", AVG(CASE WHEN lead_status = 'CLOSED' THEN annual_revenue END) AS avg_deal_size" if deal else ""
        return (f"SELECT '{label}' AS period, COUNT(*) AS total_leads, {CONV} AS converted, "
                f"{RATE} AS conversion_rate{deal_col} FROM core_contacts {where}")
    q["m4"] = "\nUNION ALL\n".join([period("Last 7 days", 7), period("Last 30 days", 30),
                                    period("All time", None)])
    q["m5"] = """
, stats AS (SELECT (SELECT COUNT(*) FROM core_contacts) AS v, (SELECT COUNT(*) FROM invalid_contacts) AS i)
SELECT 'Total Records' AS metric, CAST(v + i AS VARCHAR) AS value FROM stats
UNION ALL SELECT 'Valid Records', CAST(v AS VARCHAR) FROM stats
UNION ALL SELECT 'Invalid Records', CAST(i AS VARCHAR) FROM stats
UNION ALL SELECT 'Data Quality Score %%', regexp_replace(CAST(%s AS VARCHAR), '\\.0$', '') FROM stats""" % PCT("v", "v + i")
    q["m6"] = f"""
SELECT CAST(created_at AS DATE) AS date, COUNT(*) AS new_leads, {CONV} AS conversions,
       COUNT(DISTINCT company_name) AS new_companies
FROM core_contacts WHERE {since(30)} GROUP BY CAST(created_at AS DATE)"""
    q["a1"] = m1
    q["a2"] = f"""
SELECT COALESCE(hs_analytics_source, 'unknown') AS source,
       COALESCE(hs_analytics_source_data_1, 'N/A') AS campaign, {WEEK} AS week_start,
       COUNT(*) AS leads_count, {CONV} AS converted_count, {RATE} AS conversion_rate
FROM core_contacts GROUP BY 1, 2, 3"""
    q["a3"] = f"""
SELECT COALESCE(hs_analytics_source, 'unknown') AS lead_source, COUNT(*) AS total_leads,
       {CONV} AS converted, {RATE} AS conversion_rate
FROM core_contacts GROUP BY 1 HAVING COUNT(*) >= 10
ORDER BY conversion_rate DESC NULLS LAST, lead_source ASC LIMIT 10"""
    q["a4"] = funnel
    bucket = ("CASE WHEN lead_status IN ('NEW', 'OPEN') THEN '1_leads' "
              "WHEN lead_status = 'IN_PROGRESS' THEN '2_qualified' "
              "WHEN lead_status IN ('ATTENDED', 'CONNECTED') THEN '3_engaged' "
              "WHEN lead_status = 'WORKING' THEN '4_working' "
              "WHEN lead_status = 'CLOSED' THEN '5_converted' ELSE '0_unassigned' END")
    q["a5"] = f"""
, funnel AS (SELECT {bucket} AS stage_bucket FROM core_contacts WHERE {since(90)}),
agg AS (SELECT stage_bucket, COUNT(*) AS count FROM funnel GROUP BY stage_bucket)
SELECT stage_bucket, count, LAG(count) OVER (ORDER BY stage_bucket) AS previous_stage_count,
       {PCT('count', 'LAG(count) OVER (ORDER BY stage_bucket)')} AS stage_conversion_rate
FROM agg"""
    q["a6"] = f"""
SELECT {WEEK} AS week_start,
       COUNT_IF(lead_status IN ('NEW', 'OPEN')) AS new_leads,
       COUNT_IF(lead_status = 'IN_PROGRESS') AS qualified,
       COUNT_IF(lead_status IN ('ATTENDED', 'CONNECTED')) AS engaged,
       COUNT_IF(lead_status = 'WORKING') AS working,
       COUNT_IF(lead_status = 'CLOSED') AS converted
FROM core_contacts WHERE {since(90)} GROUP BY 1"""
    q["a7"] = "\nUNION ALL\n".join([period("Last 7 days", 7), period("Last 30 days", 30),
                                    period("Last 90 days", 90), period("All time", None)])
    q["a8"] = f"""
SELECT COALESCE(hs_analytics_source, 'unknown') AS source, COUNT(*) AS total_leads,
       {CONV} AS converted, {RATE} AS conversion_rate,
       {R("AVG(CASE WHEN lead_status = 'CLOSED' THEN date_diff('day', CAST(created_at AS DATE), CAST(lastmodifieddate AS DATE)) END)", 1)} AS avg_days_to_convert
FROM core_contacts WHERE {since(180)} GROUP BY 1"""
    q["a9"] = f"""
SELECT {MONTH} AS month, COUNT(*) AS leads_generated, {CONV} AS customers_acquired,
       {RATE} AS conversion_rate, CAST(SUM(annual_revenue) AS BIGINT) AS total_revenue,
       CAST(SUM(annual_revenue) AS BIGINT) / COUNT(*) AS revenue_per_lead
FROM core_contacts GROUP BY 1"""
    q["a10"] = f"""
SELECT CAST(created_at AS DATE) AS date, COUNT(*) AS new_leads, {CONV} AS conversions,
       {RATE} AS conversion_rate, COUNT(DISTINCT company_name) AS new_companies
FROM core_contacts WHERE {since(30)} GROUP BY 1"""
    q["a11"] = f"""
, w AS (SELECT {WEEK} AS week_start, COUNT(*) AS weekly_leads, {CONV} AS weekly_conversions
        FROM core_contacts WHERE {since(90)} GROUP BY 1)
SELECT week_start, weekly_leads, LAG(weekly_leads) OVER (ORDER BY week_start) AS previous_week,
       {PCT('weekly_leads - LAG(weekly_leads) OVER (ORDER BY week_start)', 'LAG(weekly_leads) OVER (ORDER BY week_start)')} AS week_over_week_change_pct,
       weekly_conversions
FROM w"""
    q["a12"] = f"""
, m AS (SELECT {MONTH} AS month, COUNT(*) AS monthly_leads, {CONV} AS monthly_conversions,
               {RATE} AS monthly_conversion_rate FROM core_contacts GROUP BY 1)
SELECT month, monthly_leads,
       AVG(monthly_leads) OVER (ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS rolling_3month_avg,
       monthly_conversions, monthly_conversion_rate
FROM m"""
    q["a13"] = f"""
SELECT 'Current Period' AS period, COUNT(*) AS leads, {CONV} AS conversions, {RATE} AS conversion_rate
FROM core_contacts WHERE {since(30)}
UNION ALL
SELECT 'Previous Period' AS period, COUNT(*) AS leads, {CONV} AS conversions, {RATE} AS conversion_rate
FROM core_contacts
WHERE created_at BETWEEN {AS_OF} - INTERVAL 60 DAY AND {AS_OF} - INTERVAL 30 DAY"""
    q["a14"] = industry
    q["a15"] = """
SELECT COALESCE(industry, 'unknown') AS industry,
       COUNT_IF(lead_status = 'NEW' OR lead_status = 'OPEN') AS new_leads,
       COUNT_IF(lead_status = 'IN_PROGRESS') AS qualified,
       COUNT_IF(lead_status IN ('ATTENDED', 'CONNECTED')) AS engaged,
       COUNT_IF(lead_status = 'WORKING') AS working,
       COUNT_IF(lead_status = 'CLOSED') AS converted,
       COUNT_IF(lead_status = 'UNQUALIFIED') AS disqualified,
       COUNT(*) AS total
FROM core_contacts GROUP BY industry"""
    q["a16"] = f"""
SELECT COALESCE(industry, 'unknown') AS industry, COUNT(*) AS deals_count,
       {R('AVG(annual_revenue)')} AS avg_deal_size,
       CAST(quantile_cont(annual_revenue, 0.5) AS DOUBLE) AS median_deal_size,
       MIN(annual_revenue) AS min_deal, MAX(annual_revenue) AS max_deal,
       CAST(SUM(annual_revenue) AS BIGINT) AS total_revenue
FROM core_contacts WHERE annual_revenue > 0 GROUP BY industry"""
    q["a17"] = f"""
SELECT COALESCE(industry, 'unknown') AS industry,
       COUNT_IF(numberofemployees < 50) AS small_companies,
       COUNT_IF(numberofemployees BETWEEN 50 AND 250) AS mid_companies,
       COUNT_IF(numberofemployees > 250) AS large_companies,
       {R('AVG(numberofemployees)', 0)} AS avg_employees
FROM core_contacts GROUP BY industry"""
    q["a18"] = f"""
, s AS (SELECT CAST((SELECT COUNT(*) FROM core_contacts) AS DOUBLE) AS t,
               CAST((SELECT COUNT(*) FROM invalid_contacts) AS DOUBLE) AS i)
SELECT 'Total Records' AS metric, t AS value FROM s
UNION ALL SELECT 'Valid Records', t - i FROM s
UNION ALL SELECT 'Invalid Records', i FROM s
UNION ALL SELECT 'Data Quality Score %', {PCT('t - i', 't')} FROM s"""
    q["a19"] = f"""
SELECT error_type, COUNT(*) AS error_count,
       {PCT('COUNT(*)', 'SUM(COUNT(*)) OVER ()')} AS percentage,
       COUNT(DISTINCT {jv('contact_id')}) AS affected_records
FROM invalid_contacts GROUP BY error_type"""
    q["a20"] = f"""
SELECT error_type, COUNT(*) AS total_errors,
       COUNT(DISTINCT {jv('email')}) AS unique_emails_affected,
       MIN({parse_ts_sql(jv('created_at'))}) AS earliest_error,
       MAX({parse_ts_sql(jv('created_at'))}) AS latest_error
FROM invalid_contacts GROUP BY error_type"""
    q["a21"] = f"""
SELECT CAST(processed_at AS DATE) AS error_date, COUNT(*) AS daily_errors,
       COUNT(DISTINCT error_type) AS unique_error_types,
       COUNT_IF({LABEL} = 'validation_error') AS validation_errors,
       COUNT_IF({LABEL} = 'missing_field') AS missing_field_errors,
       COUNT_IF({LABEL} = 'invalid_format') AS format_errors
FROM invalid_contacts WHERE {since(30, 'processed_at')} GROUP BY 1"""
    q["a22"] = f"""
SELECT {jv('email')} AS email, {jv('company_name')} AS company, COUNT(*) AS error_count,
       array_to_string(list_sort(list_distinct(list(error_type))), ', ') AS error_types,
       array_to_string(list_sort(list_distinct(list(error_message))), '; ') AS error_messages
FROM invalid_contacts GROUP BY 1, 2 HAVING COUNT(*) > 1
ORDER BY error_count DESC, email ASC NULLS FIRST, company ASC NULLS FIRST LIMIT 20"""
    q["a23"] = f"""
SELECT 'email' AS field_name, COUNT_IF({jv('email')} IS NULL OR {jv('email')} = '') AS null_or_empty,
       (SELECT COUNT(*) FROM invalid_contacts) AS total_invalid FROM invalid_contacts
UNION ALL
SELECT 'company_name', COUNT_IF({jv('company_name')} IS NULL OR {jv('company_name')} = ''),
       (SELECT COUNT(*) FROM invalid_contacts) FROM invalid_contacts
UNION ALL
SELECT 'annual_revenue', COUNT_IF(TRY_CAST({jv('annual_revenue')} AS BIGINT) IS NULL AND {jv('annual_revenue')} IS NOT NULL),
       (SELECT COUNT(*) FROM invalid_contacts) FROM invalid_contacts"""
    q["a24"] = f"""
, inv AS (SELECT CAST(processed_at AS DATE) AS date, COUNT(*) AS invalid_count
          FROM invalid_contacts WHERE {since(30, 'processed_at')} GROUP BY 1),
day AS (SELECT CAST(created_at AS DATE) AS date, COUNT(*) AS n FROM core_contacts GROUP BY 1)
SELECT inv.date AS date, invalid_count,
       {PCT('invalid_count', 'invalid_count + COALESCE(day.n, 0)')} AS error_rate_pct
FROM inv LEFT JOIN day ON inv.date = day.date"""
    q["a25"] = f"""
SELECT COALESCE({jv('hs_analytics_source')}, 'unknown') AS source, COUNT(*) AS invalid_count,
       COUNT(DISTINCT {jv('email')}) AS affected_emails,
       COUNT_IF({LABEL} = 'validation_error') AS validation,
       COUNT_IF({LABEL} = 'missing_field') AS missing_field,
       COUNT_IF({LABEL} = 'invalid_format') AS invalid_format
FROM invalid_contacts GROUP BY {jv('hs_analytics_source')}"""
    # ---- staging / core
    q["c1"] = f", {STG.strip()}\nSELECT {CONTACT_COLS} FROM stg"
    q["c2"] = f"""
, t AS ({dedupe_sql("(SELECT * FROM contacts_raw WHERE run_id <= 'run_1999')")})
SELECT contact_id, run_id, processed_at, ingest_seq FROM contacts_raw
WHERE processed_at > (SELECT COALESCE(MAX(processed_at), TIMESTAMP '1970-01-01') FROM t)"""
    q["c3"] = f"SELECT {CONTACT_COLS} FROM core_contacts"
    q["c4"] = f"""
, t AS ({dedupe_sql("(SELECT * FROM contacts_raw WHERE run_id < 'run_2001')")}),
s AS ({dedupe_sql("(SELECT * FROM contacts_raw WHERE run_id = 'run_2001')")})
SELECT {CONTACT_COLS} FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.contact_id = t.contact_id)
UNION ALL
SELECT {CONTACT_COLS.replace('processed_at, run_id', f'{AS_OF} AS processed_at, run_id')} FROM s"""
    q["c5"] = f"""
, {STG.strip()},
t AS ({dedupe_sql("(SELECT * FROM stg WHERE run_id <= 'run_1999')")}),
src AS (SELECT * FROM stg WHERE processed_at > (SELECT COALESCE(MAX(processed_at), TIMESTAMP '1970-01-01') FROM t)),
s AS ({dedupe_sql('src')})
SELECT {CONTACT_COLS} FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.contact_id = t.contact_id)
UNION ALL SELECT {CONTACT_COLS} FROM s"""
    q["c5_store"] = q["c5"]
    undated = CONTACT_COLS.replace("created_at", "CASE WHEN CAST(contact_id AS BIGINT) % {0} <> 0 THEN created_at END AS created_at") \
        .replace("processed_at, run_id", f"{AS_OF} AS processed_at, run_id")
    q["c4_store"] = f"""
, t AS ({dedupe_sql("(SELECT * FROM contacts_raw WHERE run_id < 'run_2001')")}),
s AS ({dedupe_sql("(SELECT * FROM contacts_raw WHERE run_id = 'run_2001')")}),
u AS (SELECT * FROM s WHERE CAST(contact_id AS BIGINT) % 7 = 0)
SELECT {CONTACT_COLS.replace('processed_at, run_id', f'{AS_OF} AS processed_at, run_id')} FROM t
WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.contact_id = t.contact_id)
UNION ALL SELECT {undated.format(5)} FROM s WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.contact_id = s.contact_id)
UNION ALL SELECT {undated.format(7)} FROM u"""
    # ---- validation
    q["v8"] = f"SELECT id, {parse_ts_sql('createdate')} AS created_at FROM api_contacts"
    q["v9"] = (f"SELECT id, {int_ok_sql('annualrevenue')} AS revenue_ok, "
               f"NULLIF({parse_int_sql('annualrevenue')}, 0) AS annual_revenue FROM api_contacts")
    q["v12"] = ("SELECT COALESCE(error_type, 'valid') AS outcome, COUNT(*) AS records "
                "FROM api_checked GROUP BY 1")
    q["v3"] = f"""
, {API_JSON},
t AS (SELECT json_extract_string(rec, '$.id') AS contact_id, {_shape_ok()} AS shape_ok,
             {_prop('email')} AS email, {_prop('annualrevenue')} AS rev,
             {_prop('numberofemployees')} AS emp FROM api_json)
SELECT contact_id,
       CASE WHEN NOT shape_ok THEN 'ValidationError'
            WHEN email IS NULL OR email = '' THEN 'MissingEmail'
            WHEN NOT regexp_matches(email, '{_EMAIL}') THEN 'ValidationError'
            WHEN NOT ({int_ok_sql('rev')} AND {int_ok_sql('emp')}) THEN 'ValidationError' END AS error_type,
       CASE WHEN NOT shape_ok THEN {S(MSG_SHAPE_API)}
            WHEN email IS NULL OR email = '' THEN {S(MSG_API_MISSING_EMAIL)}
            WHEN NOT regexp_matches(email, '{_EMAIL}') THEN {S(MSG_EMAIL)}
            WHEN NOT ({int_ok_sql('rev')} AND {int_ok_sql('emp')}) THEN {S(MSG_INT)} END AS error_message
FROM t"""
    q["v4"] = f", {CSV_ROWS.strip()}\nSELECT contact_id, error_type, error_message FROM csv_checked"
    q["v10"] = f"""
SELECT id AS contact_id, lower(email) AS email, company AS company_name,
       NULLIF({parse_int_sql('annualrevenue')}, 0) AS annual_revenue,
       CAST(NULL AS BIGINT) AS numberofemployees, {parse_ts_sql('createdate')} AS created_at,
       CAST(NULL AS VARCHAR) AS lead_status, hs_analytics_source
FROM api_checked WHERE error_type IS NULL"""
    q["v11"] = f"""
, {CSV_ROWS.strip()}
SELECT contact_id, lower(email) AS email, first_name, last_name, company_name, job_title,
       NULLIF({parse_int_sql('annual_revenue')}, 0) AS annual_revenue,
       {parse_ts_sql('created_at')} AS created_at
FROM csv_checked WHERE error_type IS NULL"""
    stats = ("SELECT 'run_1' AS run_id, COUNT(*) AS total, COUNT_IF(error_type IS NULL) AS valid, "
             "COUNT_IF(error_type IS NOT NULL) AS invalid FROM api_checked")
    q["v14"] = stats
    q["d6"] = (f"SELECT 'valid_plus_invalid_equals_total' AS \"check\", total, valid, invalid, "
               f"CASE WHEN valid + invalid = total THEN 'pass' ELSE 'fail' END AS status "
               f"FROM ({stats}) x")
    q["s1"] = f"""
, {API_JSON}
SELECT json_extract_string(rec, '$.id') AS contact_id, {_prop('email')} AS email,
       {_prop('company')} AS company, {_prop('annualrevenue')} AS annualrevenue,
       {_prop('createdate')} AS createdate, {_prop('numberofemployees')} AS numberofemployees,
       {_prop('hs_analytics_source')} AS hs_analytics_source, CAST(NULL AS VARCHAR) AS text
FROM api_json
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, '{{"torn":' || CAST(page AS VARCHAR) || ','
FROM (SELECT DISTINCT event_id // 100 AS page FROM events) p WHERE page % 6 = 4
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'tail ' || CAST(page AS VARCHAR)
FROM (SELECT DISTINCT event_id // 100 AS page FROM events) p WHERE page % 6 = 5"""
    short = "event_id % 11 = 10"
    q["s2"] = f"""
, {CSV_ROWS.strip()}
SELECT contact_id AS row_id,
       CASE WHEN {short} THEN 'ValidationError' ELSE COALESCE(error_type, 'valid') END AS outcome,
       CASE WHEN NOT {short} THEN lower(email) END AS email,
       CASE WHEN NOT {short} THEN CASE WHEN event_id % 17 = 3 THEN company_name || chr(10) || '"Ltd", Inc'
         ELSE company_name END END AS company_name,
       CASE WHEN NOT {short} THEN NULLIF({parse_int_sql('annual_revenue')}, 0) END AS annual_revenue,
       CASE WHEN NOT {short} THEN {parse_ts_sql('created_at')} END AS created_at
FROM csv_checked"""
    q["w1"] = f"""
, {API_JSON},
t AS (SELECT json_extract_string(rec, '$.id') AS contact_id, {_shape_ok()} AS shape_ok,
             {_prop('email')} AS email, {_prop('annualrevenue')} AS rev,
             {_prop('numberofemployees')} AS emp, {_prop('createdate')} AS createdate,
             {_prop('hs_analytics_source')} AS hs_analytics_source FROM api_json)
SELECT contact_id, lower(email) AS email, NULLIF({parse_int_sql('rev')}, 0) AS annual_revenue,
       {parse_ts_sql('createdate')} AS created_at, hs_analytics_source
FROM t
WHERE shape_ok AND email IS NOT NULL AND email <> '' AND regexp_matches(email, '{_EMAIL}')
  AND {int_ok_sql('rev')} AND {int_ok_sql('emp')}"""
    views = ["vw_lead_analytics", "vw_sales_funnel", "vw_industry_analytics",
             "vw_conversion_metrics", "vw_data_quality", "vw_daily_trends"]
    bodies = [q[k].strip() for k in ("m1", "m2", "m3", "m4", "m5", "m6")]
    bodies = [("WITH " + b[1:].strip()) if b.startswith(",") else b for b in bodies]
    q["m0"] = "\nUNION ALL\n".join(
        f"SELECT '{v}' AS view_name, COUNT(*) AS row_count FROM ({b}) x"
        for v, b in zip(views, bodies))
    api_msg = (f"CASE WHEN email IS NULL OR email = '' THEN {S(MSG_API_MISSING_EMAIL)} "
               f"WHEN NOT regexp_matches(email, '{_EMAIL}') THEN {S(MSG_EMAIL)} "
               f"ELSE {S(MSG_INT)} END")
    q["v15"] = (f"SELECT {FIXTURE_SRC_JSON} AS original_data, {api_msg} AS error_message, error_type, "
                f"'run_1' AS run_id FROM api_checked WHERE error_type IS NOT NULL")
    q["s10"] = f"""
SELECT id AS contact_id, lower(email) AS email,
       NULLIF({parse_int_sql('annualrevenue')}, 0) AS annual_revenue,
       {parse_ts_sql('createdate')} AS created_at, {AS_OF} AS processed_at, 'run_1' AS run_id
FROM api_checked WHERE error_type IS NULL"""
    once = (f"SELECT sha256('run_1||' || {FIXTURE_SRC_JSON}) AS id, error_type, 'run_1' AS run_id "
            f"FROM api_checked WHERE error_type IS NOT NULL")
    q["s12"] = f"{once}\nUNION ALL\n{once}"
    q["s14"] = "SELECT id AS contact_id, error_type FROM api_checked"
    q["s15"] = (f"SELECT sha256('run_1||' || {FIXTURE_SRC_JSON}) AS id, error_type, 'run_1' AS run_id, "
                f"{AS_OF} AS quarantined_at FROM api_checked WHERE error_type IS NOT NULL")
    q["s9"] = ("SELECT contact_id, email, created_at, run_id, ingest_seq FROM contacts_raw "
               "WHERE run_id = 'run_1995'")
    q["s17"] = ("SELECT contact_id, lead_status, annual_revenue FROM core_contacts "
                "WHERE run_id = 'run_1995' AND lead_status = 'CLOSED'")
    q["c7"] = f"SELECT contact_id, {MONTH} AS created_month FROM core_contacts"
    q["s4"] = ("SELECT contact_id, created_at FROM core_contacts "
               "WHERE created_at >= TIMESTAMP '2001-01-01 00:00:00'")
    q["s11"] = f"""
SELECT sha256('run_1||' || {FIXTURE_SRC_JSON}) AS id, error_type,
       CASE WHEN email IS NULL OR email = '' THEN {S(MSG_API_MISSING_EMAIL)}
            WHEN NOT regexp_matches(email, '{_EMAIL}') THEN {S(MSG_EMAIL)}
            ELSE {S(MSG_INT)} END AS error_message,
       'run_1' AS run_id, {AS_OF} AS quarantined_at
FROM api_checked WHERE error_type IS NOT NULL"""
    # ---- data tests
    def bodyless(k: str) -> str:
        b = q[k].strip()
        return ("WITH " + b[1:].strip()) if b.startswith(",") else b

    suite_ctes = (f", {STG.strip()}" + "".join(f",\n{name} AS ({bodyless(k)})" for name, k in (
        ("mart_lead_analytics", "m1"), ("mart_sales_funnel", "m2"), ("mart_industry_analytics", "m3"), ("mart_daily_trends", "m6")))
        + f",\ncore_merged AS (SELECT {CONTACT_COLS} FROM ({dedupe_sql('stg')}) x)")

    def test(tab, check, col, bad, gate=True, source=None):
        """One data test: ``bad`` counts failing rows of ``source`` (default: the table)."""
        no = "fail" if gate else "warn"
        return (f"SELECT '{tab}' AS \"table\", '{check}' AS \"check\", '{col}' AS \"column\", {bad} AS failing_rows, "
                f"CASE WHEN {bad} = 0 THEN 'pass' ELSE '{no}' END AS status FROM {source or tab}")

    def unique(tab, col, gate=True, source=None):
        groups = f"(SELECT {col}, COUNT(*) AS k FROM {source or tab} WHERE {col} IS NOT NULL GROUP BY {col}) x"
        return test(tab, "unique", col, "COUNT_IF(k > 1)", gate, groups)

    def accepted(tab, col, vals, source=None):
        lst = ", ".join("'" + v.replace("'", "''") + "'" for v in vals)
        return test(tab, "accepted_values", col, f"COUNT_IF({col} IS NOT NULL AND {col} NOT IN ({lst}))", False, source)

    def expression(tab, source=None):
        return test(tab, "expression_is_true", "annual_revenue", "COUNT_IF(NOT COALESCE(annual_revenue >= 0, true))", False, source)

    def layer_tests(core):
        keyed = {"contacts_raw": ("contact_id", "email", "run_id"), "contacts_quarantine": ("id",),
                 "stg_contacts": ("contact_id", "email", "run_id"),
                 "core_contacts": ("contact_id", "email", "created_at", "processed_at", "run_id")}
        at = {"contacts_quarantine": "invalid_contacts", "stg_contacts": "stg", "core_contacts": core}
        return {
            "d1": [test(t, "not_null", c, f"COUNT_IF({c} IS NULL)", True, at.get(t)) for t, cs in keyed.items() for c in cs]
            + [test(t, "not_null", c, f"COUNT_IF({c} IS NULL)") for t, c in (
                ("mart_lead_analytics", "lead_source"), ("mart_sales_funnel", "stage"),
                ("mart_industry_analytics", "industry"), ("mart_daily_trends", "date"))],
            "d2": [unique("contacts_quarantine", "id", True, "invalid_contacts"), unique("stg_contacts", "contact_id", False, "stg"),
                   unique("core_contacts", "contact_id", True, core)],
            "d3": [accepted("stg_contacts", "lead_status", ACCEPTED_LEAD_STATUS, "stg"),
                   accepted("core_contacts", "lead_status", ACCEPTED_LEAD_STATUS, core),
                   accepted("core_contacts", "industry", ACCEPTED_INDUSTRY, core)],
            "d4": [expression("stg_contacts", "stg"), expression("core_contacts", core)]}

    for k, parts in layer_tests("core_contacts").items():
        q[k] = suite_ctes + "\n" + "\nUNION ALL\n".join(parts)
    nodes = ["stg_contacts", "core_contacts", "mart_lead_analytics", "mart_sales_funnel", "mart_industry_analytics",
             "mart_conversion_metrics", "mart_data_quality", "mart_daily_trends", "mart_broken"]
    built = [f"SELECT '{n}' AS \"table\", 'build' AS \"check\", NULL AS \"column\", NULL AS failing_rows, "
             f"'{'failed' if n == 'mart_broken' else 'built'}' AS status" for n in nodes]
    every = "\nUNION ALL\n".join(built + [p for parts in layer_tests("core_merged").values() for p in parts])
    q["c6"] = f"""{suite_ctes}
SELECT "table" AS node, "check", "column", failing_rows, status, false AS good FROM ({every}) t"""

    def fresh(name, tab, col, warn, err):
        age = f"((epoch_us({AS_OF}) - epoch_us(MAX({col}))) / 3600000000.0)"
        st = f"CASE WHEN MAX({col}) IS NULL THEN 'error' "
        if err is not None:
            st += f"WHEN {age} > {err} THEN 'error' "
        st += f"WHEN {age} > {warn} THEN 'warn' ELSE 'pass' END"
        return (f"SELECT '{name}' AS \"table\", MAX({col}) AS max_loaded_at, "
                f"ROUND({age}, 2) AS age_hours, {st} AS status FROM {tab}")
    q["d5"] = fresh("contacts_raw", "contacts_raw", "processed_at", 6, 24) + "\nUNION ALL\n" + \
        fresh("contacts_quarantine", "invalid_contacts", "processed_at", 12, None)
    # ---- sources / sinks
    q["s3"] = ("SELECT contact_id, run_id, ingest_seq FROM contacts_raw "
               "WHERE run_id = (SELECT MAX(run_id) FROM contacts_raw)")
    q["s7"] = ("SELECT 'raw/' || run_id AS blob_key, 'raw' AS container, run_id AS blob_name, "
               "COUNT(*) AS record_count FROM contacts_raw GROUP BY run_id")
    q["s8"] = ("SELECT run_id AS blob_name, COUNT(*) AS record_count FROM contacts_raw "
               "WHERE run_id LIKE 'run_199%' GROUP BY run_id")
    q["s13"] = ("SELECT contact_id, email, first_name, last_name, created_at FROM ("
                "SELECT *, ROW_NUMBER() OVER (PARTITION BY contact_id ORDER BY ingest_seq DESC) AS r "
                "FROM contacts_raw) x WHERE r = 1")
    last = ("(SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY contact_id ORDER BY ingest_seq DESC) AS r "
            "FROM contacts_raw WHERE run_id {} 'run_1999') x WHERE r = 1)")
    cols = "contact_id, email, first_name, last_name, created_at"
    q["s13_store"] = f"""
, t AS {last.format('<=')},
b AS {last.format('>')}
SELECT u.*, (SELECT COUNT(*) FROM b WHERE contact_id IN (SELECT contact_id FROM t)) AS replaced,
       (SELECT COUNT(*) FROM b WHERE contact_id NOT IN (SELECT contact_id FROM t)) AS inserted
FROM (SELECT {cols} FROM t WHERE contact_id NOT IN (SELECT contact_id FROM b) UNION ALL SELECT {cols} FROM b) u"""
    return q


def _count_if_as_filter(sql: str) -> str:
    """BQ COUNTIF is 0 when no row qualifies; DuckDB COUNT_IF is NULL when every
    predicate is NULL. Rewrite ``COUNT_IF(p)`` as ``COUNT(*) FILTER (WHERE p)``."""
    out, i, tok = [], 0, "COUNT_IF("
    while True:
        j = sql.find(tok, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        out.append(sql[i:j])
        depth, k = 1, j + len(tok)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        out.append(f"COUNT(*) FILTER (WHERE {_count_if_as_filter(sql[j + len(tok):k - 1])})")
        i = k


def oracle_sql() -> dict[str, str]:
    out = {}
    for k, body in _sql().items():
        b = body.strip()
        sql = with_more(b[1:], "") if b.startswith(",") else with_fixtures(b)
        out[k] = _count_if_as_filter(sql)
    return out
