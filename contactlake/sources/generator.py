"""Synthetic API contacts for load tests, generated by Spark.

``spark.range(n)`` gives the record numbers; every field is picked from small literal
arrays by ``xxhash64(record, field, seed)``, so the data is deterministic for a seed and
generated in parallel. A share of records is made invalid in one of five ways, a share
is copied (same content, another position; about ``dup_share`` of them) and records are numbered in a shuffled
order. Names and companies come from a rule, not from a list."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import API_EXTRA_PROPERTIES, API_PROPERTIES

# ---- fixed values: value domains of generated contacts -----------------------------
INDUSTRIES = ["SaaS", "Marketing", "CRM", "AI"]
LIFECYCLE_STAGES = ["lead", "marketingqualifiedlead", "opportunity", "customer"]
SOURCES = ["google_ads", "linkedin", "referral", "organic"]
EMPLOYEE_COUNTS = [5, 10, 25, 50, 100, 250, 500, 1000]
# status per lifecycle stage: candidate statuses
STAGE_STATUS = {
    "lead": ["NEW", "OPEN", "CONNECTED"],
    "marketingqualifiedlead": ["IN_PROGRESS", "ATTENDED"],
    "opportunity": ["WORKING", "IN_PROGRESS"],
    "customer": ["CLOSED"],
}
INVALID_KINDS = ["invalid_email", "invalid_date", "missing_field", "null_email", "empty_fields"]
BAD_EMAILS = ["invalidemail.com", "user@", "user@domain", "user name@company.com",
              "user!#$%@company.com"]
BAD_DATES = ["%Y-%m-%d", "%d/%m/%Y", "%m-%d-%Y", "%Y/%m/%d %H:%M", "invalid", "", "Z+0000"]


def _pick(arr, h):
    a = F.array(*[F.lit(x) for x in arr])
    return F.element_at(a, (F.pmod(h, F.lit(len(arr))) + 1).cast("int"))


def synthetic_contacts(spark: SparkSession, n: int = 1000, invalid_share: float = 0.25,
                       dup_share: float = 0.03, seed: int = 42,
                       now: str = "2024-06-30 00:00:00") -> DataFrame:
    """Rows ``{id, properties{...}}`` ready for ``validate_api``."""
    def h(field):
        return F.xxhash64(F.col("n"), F.lit(field), F.lit(seed))

    base = spark.range(1, n + 1).withColumnRenamed("id", "n")
    n_invalid = int(n * invalid_share)
    first = F.concat(F.lit("Name"), F.pmod(h("first"), F.lit(997)).cast("string"))
    last = F.concat(F.lit("Surname"), F.pmod(h("last"), F.lit(991)).cast("string"))
    company = F.concat(F.lit("Company"), F.pmod(h("company"), F.lit(40)).cast("string"))
    domain = F.lower(F.regexp_replace(company, " ", ""))
    email = F.concat(F.lower(first), F.lit("."), F.lower(last), F.lit("@"), domain, F.lit(".com"))
    created = F.date_format(F.to_timestamp(F.lit(now)) - F.make_dt_interval(
        (F.pmod(h("days"), F.lit(180)) + 1).cast("int")), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    stage = _pick(LIFECYCLE_STAGES, h("stage"))
    status = F.coalesce(*[F.when(stage == k, _pick(v, h("status"))) for k, v in STAGE_STATUS.items()])
    kind = F.when(F.col("n") > n - n_invalid, _pick(INVALID_KINDS, h("kind")))
    rows = base.select(
        "n",
        F.when(kind == "invalid_email", _pick(BAD_EMAILS, h("bad_email")))
         .when(kind == "null_email", F.lit(None)).otherwise(email).alias("email"),
        F.when(kind.isin("missing_field", "empty_fields") & (F.pmod(h("miss"), F.lit(2)) == 0),
               F.lit(None)).otherwise(first).alias("firstname"),
        last.alias("lastname"),
        F.concat(company, F.lit(" Inc")).alias("company"),
        F.when(kind == "invalid_date", _pick(BAD_DATES, h("bad_date"))).otherwise(created).alias("createdate"),
        _pick(INDUSTRIES, h("industry")).alias("industry"),
        stage.alias("lifecyclestage"), status.alias("hs_lead_status"),
        _pick(SOURCES, h("source")).alias("hs_analytics_source"),
        (F.pmod(h("revenue"), F.lit(4_950_001)) + 50_000).cast("string").alias("annualrevenue"),
        _pick([str(x) for x in EMPLOYEE_COUNTS], h("employees")).alias("numberofemployees"))
    # copies: records whose hash falls in the lowest dup_share of the range are repeated
    # (a distributed filter; about n * dup_share copies)
    dup_pick = F.pmod(F.xxhash64(F.col("n"), F.lit("dup"), F.lit(seed)), F.lit(1_000_000))
    dups = rows.where(dup_pick < F.lit(int(dup_share * 1_000_000)))
    allrows = rows.unionByName(dups)
    # ids in a shuffled (hashed) order: a distributed range sort, then per-partition
    # increasing ids; unique, not consecutive
    numbered = allrows.withColumn(
        "_k", F.xxhash64(F.col("n"), F.monotonically_increasing_id(), F.lit(seed)))
    props = [F.col(c).alias(c) if c in allrows.columns else F.lit(None).cast("string").alias(c)
             for c in API_PROPERTIES + API_EXTRA_PROPERTIES]
    return numbered.orderBy("_k", "n").select(
        F.monotonically_increasing_id().cast("string").alias("id"),
        F.struct(*props).alias("properties"))
