"""Contact tables derived from the driver's TPC-H-style tables (FIXTURES.md §6).

The driver has no contacts, so each view below is a DataFrame computed from the given
parquet tables; its work therefore grows with them. One fixed clock for all reports:
``AS_OF`` (the largest order date at every scale)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.core import dedupe_latest
from ..session import ensure_utc
from ..schema import CONTACT_COLUMNS

AS_OF = "2001-08-01 00:00:00"
EVENT_SHIFT_DAYS = 8218


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _dealt(rows: DataFrame, key: str) -> DataFrame:
    """Rows dealt over all cores by a unique key: a driver table is one file, however large,
    and what is derived and written from it should not follow its row groups."""
    return rows.repartition(landing_files(rows.sparkSession), key)


def _ts(col: str):
    """Driver parquet stores TIMESTAMP_NTZ; contacts use UTC instants."""
    return F.col(col).cast("timestamp")


def contacts_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw contact per order, keyed by the customer: ids repeat on purpose."""
    ensure_utc(spark)
    orders = _dealt(driver_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"), "o_orderkey")
    customer = driver_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment", "c_nationkey")
    nation = driver_table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), "n_name")
    # orders x customer is a big-to-big equi-join on custkey: shuffle join; AQE splits a
    # customer that owns a skewed share of the orders. nation is broadcast by the planner
    # only while its file statistics are under the broadcast threshold (a size check that
    # needs no job); beyond it the planner keeps a shuffle join.
    j = orders.join(customer, "o_custkey").join(nation, "c_nationkey")
    k = F.col("o_orderkey")
    cust = F.col("o_custkey").cast("string")
    status = F.when(k % 10 == 0, "NEW").when(k % 10 == 1, "OPEN") \
        .when(k % 10 == 2, "IN_PROGRESS").when(k % 10 == 3, "UNQUALIFIED") \
        .when(k % 10 == 4, "ATTENDED").when(k % 10 == 5, "CONNECTED") \
        .when(k % 10 == 6, "WORKING").when(k % 10 == 7, "CLOSED").when(k % 10 == 8, "CLOSED")
    pr = F.col("o_orderpriority")
    source = F.when(pr == "1-URGENT", "google_ads").when(pr == "2-HIGH", "linkedin") \
        .when(pr == "3-MEDIUM", "referral").when(pr == "4-NOT SPECIFIED", "organic")
    odate = _ts("o_orderdate")
    return j.select(
        cust.alias("contact_id"),
        F.concat(F.lit("user"), cust, F.lit("@example.com")).alias("email"),
        F.when(k % 9 == 0, F.lit("  ")).otherwise(F.concat(F.lit("First"), cust)).alias("first_name"),
        F.concat(F.lit("Last"), cust).alias("last_name"),
        F.col("c_name").alias("company_name"),
        F.when(k % 7 == 0, F.lit("")).otherwise(F.lit("Manager ")).alias("job_title"),
        F.nullif(F.col("c_mktsegment"), F.lit("HOUSEHOLD")).alias("industry"),
        F.when(k % 13 == 0, F.lit(None).cast("bigint"))
         .otherwise(F.floor("o_totalprice").cast("bigint")).alias("annual_revenue"),
        (F.col("o_custkey") % 400).cast("bigint").alias("numberofemployees"),
        odate.alias("created_at"),
        F.when(k % 17 == 0, F.lit(None).cast("timestamp"))
         .otherwise(odate + F.make_dt_interval((k % 30).cast("int"))).alias("lastmodifieddate"),
        status.alias("lead_status"),
        source.alias("hs_analytics_source"),
        F.nullif(F.col("n_name"), F.lit("NATION_0")).alias("hs_analytics_source_data_1"),
        (odate + F.make_dt_interval(F.lit(30))).alias("processed_at"),
        F.concat(F.lit("run_"), F.year("o_orderdate").cast("string")).alias("run_id"),
        k.alias("ingest_seq"),
    )


def core_contacts(raw: DataFrame) -> DataFrame:
    """The C3 result over the raw fixture: one row per contact."""
    return dedupe_latest(raw, "contact_id", keep_columns=CONTACT_COLUMNS + ["ingest_seq"])


def api_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat API-shaped records from the events table, covering validator branches."""
    return _api_flat(spark, sf_dir)


def _api_flat(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    ensure_utc(spark)
    base = ["event_id", "ts", "user_id", "event_type", "value"]
    ev = _dealt(driver_table(spark, sf_dir, "events").select(*base, *[c for c in extra if c not in base]), "event_id")
    e = F.col("event_id")
    email = F.when(e % 8 == 0, F.lit(None).cast("string")).when(e % 8 == 1, "") \
        .when(e % 8 == 2, "invalidemail.com").when(e % 8 == 3, "user@") \
        .when(e % 8 == 4, "user@domain").when(e % 8 == 5, "user name@company.com") \
        .otherwise(F.concat(F.lit("User"), F.col("user_id").cast("string"), F.lit("@Company.com")))
    revenue = F.when(e % 6 == 0, F.lit(None).cast("string")).when(e % 6 == 1, "") \
        .when(e % 6 == 2, "0").when(e % 6 == 3, "abc") \
        .otherwise(F.floor(F.col("value") * 1000).cast("bigint").cast("string"))
    created = F.when(e % 7 == 0, F.lit(None).cast("string")).when(e % 7 == 1, "") \
        .when(e % 7 == 2, "15/01/2024").when(e % 7 == 3, "2024-01-15") \
        .when(e % 7 == 4, "2024-01-15T10:30:00 +0000") \
        .when(e % 7 == 5, "2024-01-15T10:30:00Z +0000").otherwise("2024-01-15T10:30:00Z")
    return ev.select(
        e.cast("string").alias("id"),
        email.alias("email"),
        revenue.alias("annualrevenue"),
        created.alias("createdate"),
        F.concat(F.lit("Company "), (F.col("user_id") % 20).cast("string")).alias("company"),
        F.col("event_type").alias("hs_analytics_source"),
        (_ts("ts") - F.make_dt_interval(F.lit(EVENT_SHIFT_DAYS))).alias("processed_at"),
        *extra,
    )


def api_records(flat: DataFrame) -> DataFrame:
    """Nest the flat fixture into the API record shape ``{id, properties{...}}``."""
    from ..constants import API_EXTRA_PROPERTIES, API_PROPERTIES
    props = [F.col(p).alias(p) if p in flat.columns else F.lit(None).cast("string").alias(p)
             for p in API_PROPERTIES + API_EXTRA_PROPERTIES]
    return flat.select("id", F.struct(*props).alias("properties"),
                       *[c for c in flat.columns if c not in API_PROPERTIES and c != "id"])


def fixture_original_data() -> F.Column:
    """Original record text of the quarantine fixture (flat, fixed key order)."""
    return F.to_json(F.struct(
        F.col("id").alias("contact_id"),
        F.col("properties.email").alias("email"),
        F.col("properties.company").alias("company_name"),
        F.col("properties.annualrevenue").alias("annual_revenue"),
        F.col("properties.createdate").alias("created_at"),
        F.col("properties.hs_analytics_source").alias("hs_analytics_source"),
    ), {"ignoreNullFields": "false"})


def invalid_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected fixture records, through the validator (V12), as the quarantine holds them
    (T10): records of odd events keep the text of an API contact, the others that of a
    flat row."""
    from ..operators.validate import validate_api
    from ..plans.analytics import invalid_contacts as as_reported
    recs = api_records(api_contacts(spark, sf_dir))
    nested = F.to_json(F.struct(F.col("id"), F.struct(
        "properties.email", "properties.company", "properties.annualrevenue", "properties.createdate",
        "properties.hs_analytics_source").alias("properties")), {"ignoreNullFields": "false"})
    text = F.when(F.col("id").cast("bigint") % 2 == 1, nested).otherwise(fixture_original_data())
    annotated = validate_api(recs, original_data=text)
    bad = annotated.where(F.col("error_type").isNotNull())
    return as_reported(bad.select(
        "id", "original_data", "error_type", "error_message",
        F.col("processed_at").alias("quarantined_at"), F.lit("run_1").alias("run_id")))


# ---- documents and files of the two batch formats --------------------------------------
# fixed value: records per API page (the source's page size)
API_PAGE_SIZE = 100


def landing_files(spark: SparkSession) -> int:
    """Files a fixture batch lands in: one per core, as a source writing pages in
    parallel would; the readers then split the batch across tasks."""
    return spark.sparkContext.defaultParallelism


def _json_text(x) -> F.Column:
    """JSON string of a text column, or ``null``. Fixture texts hold no quote or
    backslash, so nothing needs escaping."""
    return F.coalesce(F.concat(F.lit('"'), x, F.lit('"')), F.lit("null"))


def api_record_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One API contact per event as JSON text (``event_id``, ``rec``), with the JSON type
    faults a typed read would hide: a numeric ``id`` (event_id % 5 = 0), a numeric
    ``numberofemployees`` taken from the event's own JSON ``props`` (% 5 = 1), and no
    ``properties`` object at all (% 5 = 2)."""
    a = _api_flat(spark, sf_dir, "event_id", "user_id", "props")
    e = F.col("event_id")
    kind = e % 5
    k = F.get_json_object("props", "$.k")
    rid = F.when(kind == 0, e.cast("string")).otherwise(_json_text(e.cast("string")))
    emp = F.when(kind == 1, F.coalesce(k, F.lit("null"))).otherwise(_json_text(k))
    props = F.concat(
        F.lit(',"properties":{"email":'), _json_text(F.col("email")),
        F.lit(',"firstname":'), _json_text(F.concat(F.lit("First"), F.col("user_id").cast("string"))),
        F.lit(',"company":'), _json_text(F.col("company")),
        F.lit(',"annualrevenue":'), _json_text(F.col("annualrevenue")),
        F.lit(',"createdate":'), _json_text(F.col("createdate")),
        F.lit(',"numberofemployees":'), emp,
        F.lit(',"hs_analytics_source":'), _json_text(F.col("hs_analytics_source")),
        F.lit("}"))
    rec = F.concat(F.lit('{"id":'), rid, F.when(kind == 2, F.lit("")).otherwise(props), F.lit("}"))
    return a.select("event_id", rec.alias("rec"))


def api_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """API pages ``{"results":[...],"paging":{"next":{"after":...}}}``, one text per page
    (column ``doc``, and the page's number ``page``). A page is the records of 100 consecutive
    event ids, which are unique, so no page ever exceeds 100 records."""
    r = api_record_json(spark, sf_dir).withColumn("page", F.floor(F.col("event_id") / API_PAGE_SIZE))
    g = r.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("event_id", "rec"))).alias("recs"))
    body = F.array_join(F.transform("recs", lambda x: x["rec"]), ",")
    after = F.element_at("recs", -1)["event_id"].cast("string")
    doc = F.concat(F.lit('{"results":['), body, F.lit('],"paging":{"next":{"after":'),
                   _json_text(after), F.lit("}}}"))
    return g.select("page", doc.alias("doc"))


def api_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed JSON text (column ``line``) of all layouts, by page number: pages on a line,
    pages followed by another page on the same line (the page's array again, without contacts),
    indented pages, indented arrays, and pages after a torn line that names the page
    (``{"torn":<page>, ``) or before trailing text (`` tail <page>``)."""
    p = api_pages(spark, sf_dir)
    page, doc = F.col("page"), F.col("doc")
    array = F.regexp_extract(doc, r"^\{\"results\":(\[.*\]),\"paging\":", 1)

    def indented(x):
        return F.regexp_replace(F.regexp_replace(x, r"([{\[,])(?=[\"{])", "$1\n  "), r"([}\]])(?=[}\]])", "$1\n ")

    kind = page % 6
    text = F.when(kind == 1, F.concat(doc, F.lit(' {"results":[]}'))) \
        .when(kind == 2, indented(doc)).when(kind == 3, indented(array)) \
        .when(kind == 4, F.concat(F.lit('{"torn":'), page.cast("string"), F.lit(", \n"), doc)) \
        .when(kind == 5, F.concat(doc, F.lit(" tail "), page.cast("string"))).otherwise(doc)
    return p.select(text.alias("line"))


def csv_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV contact rows (8 string cells, '' for an empty cell) from the events table."""
    from ..constants import CSV_COLUMNS
    a = _api_flat(spark, sf_dir, "event_id", "user_id")
    u = F.col("user_id").cast("string")
    cells = {
        "contact_id": F.col("id"),
        "email": F.coalesce("email", F.lit("")),
        "first_name": F.concat(F.lit("First"), u),
        "last_name": F.concat(F.lit("Last"), u),
        "company_name": F.col("company"),
        "job_title": F.lit(""),
        "annual_revenue": F.coalesce("annualrevenue", F.lit("")),
        "created_at": F.coalesce("createdate", F.lit("")),
    }
    return a.select("event_id", *[cells[c].alias(c) for c in CSV_COLUMNS])


def csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text lines of a CSV batch (column ``line``, no header): the row of
    event_id % 11 = 10 stops after 5 cells (a short row), the row of event_id % 13 = 12
    carries a ninth cell (ignored by the reader's shape rule), and the company of
    event_id % 17 = 3 is a quoted cell with a line break, a comma and quotes."""
    from ..constants import CSV_COLUMNS
    r = csv_rows(spark, sf_dir)      # the landing write deals lines out
    e = F.col("event_id")
    company = F.when(e % 17 == 3, F.concat(F.lit('"'), F.col("company_name"), F.lit('\n""Ltd"", Inc"'))) \
        .otherwise(F.col("company_name"))
    cells = [company if c == "company_name" else F.col(c) for c in CSV_COLUMNS]
    full = F.concat_ws(",", *cells)
    short = F.concat_ws(",", *cells[:5])
    line = F.when(e % 11 == 10, short).when(e % 13 == 12, F.concat(full, F.lit(",extra"))) \
        .otherwise(full)
    return r.select(line.alias("line"))


@dataclass
class Layers:
    """The four contact tables of one scale, as lazy DataFrames."""
    contacts_raw: DataFrame
    core_contacts: DataFrame
    api_contacts: DataFrame
    invalid_contacts: DataFrame
    #: the batch store that raw and quarantine were written to, if they were
    store: str | None = None

    def register(self) -> "Layers":
        for name in ("contacts_raw", "core_contacts", "api_contacts", "invalid_contacts"):
            getattr(self, name).createOrReplaceTempView(name)
        self.core_contacts.createOrReplaceTempView("contacts")
        return self


def layers(spark: SparkSession, sf_dir: str) -> Layers:
    raw = contacts_raw(spark, sf_dir)
    return Layers(raw, core_contacts(raw), api_contacts(spark, sf_dir),
                  invalid_contacts(spark, sf_dir))


def write_store(raw: DataFrame, invalid: DataFrame, base: str) -> str:
    """Raw and quarantined records as batches by run, with the manifest of the store."""
    from ..constants import CONTAINER_INVALID, CONTAINER_RAW
    from .sinks import write_batch
    write_batch(raw, base, CONTAINER_RAW, None, newest="processed_at")
    write_batch(invalid, base, CONTAINER_INVALID, None, newest="processed_at", day="processed_at")
    return base


def materialized_layers(spark: SparkSession, sf_dir: str, out_dir: str) -> Layers:
    """Write raw and quarantine (batches by run, with their manifest) and core (by month of
    creation, clustered) once, then read them back: what a deployment does; reports then scan
    the written tables with partition pruning and pushed filters."""
    from ..constants import CONTAINER_INVALID, CONTAINER_RAW
    from ..operators.core import with_layout
    store = write_store(contacts_raw(spark, sf_dir), invalid_contacts(spark, sf_dir), f"{out_dir}/store")
    raw = spark.read.parquet(f"{store}/{CONTAINER_RAW}")
    with_layout(core_contacts(raw)).write.mode("overwrite").partitionBy("created_month") \
        .parquet(f"{out_dir}/core_contacts")
    core = spark.read.parquet(f"{out_dir}/core_contacts")
    inv = spark.read.parquet(f"{store}/{CONTAINER_INVALID}")
    return Layers(raw, core, api_contacts(spark, sf_dir), inv, store)
