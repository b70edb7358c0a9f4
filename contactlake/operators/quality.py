"""Data tests D1-D6. Each returns ``(check, column, failing_rows, status)`` rows.

Every check is one aggregate over the table (partial aggregation map-side); a
uniqueness test groups by the key and counts the keys seen more than once."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import (CONTAINER_INVALID, CONTAINER_RAW, QUARANTINE_FRESHNESS_WARN_H, RAW_FRESHNESS_ERROR_H,
                         RAW_FRESHNESS_WARN_H)
from ..functions.expr import as_of_lit


def _status(failing):
    return F.when(failing == 0, F.lit("pass")).otherwise(F.lit("fail"))


def _rows(one: DataFrame, check: str, columns: list[str], prefix: str) -> DataFrame:
    rows = [F.struct(F.lit(check).alias("check"), F.lit(c).alias("column"),
                     F.col(f"{prefix}{i}").alias("failing_rows"),
                     _status(F.col(f"{prefix}{i}")).alias("status"))
            for i, c in enumerate(columns)]
    return one.select(F.inline(F.array(*rows)))


def check_not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """One scan, ``count_if(col IS NULL)`` per column."""
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(columns)])
    return _rows(one, "not_null", columns, "n")


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """Number of key values present more than once (NULL keys are not tested)."""
    dup = (df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("k"))
             .agg(F.count_if(F.col("k") > 1).alias("n0")))
    return _rows(dup, "unique", [column], "n")


def check_accepted_values(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """D3: non-NULL values outside the accepted set."""
    c = F.col(column)
    one = df.agg(F.count_if(c.isNotNull() & ~c.isin(*values)).alias("n0"))
    return _rows(one, "accepted_values", [column], "n")


def check_expression(df: DataFrame, column: str, predicate: str) -> DataFrame:
    """Rows where ``column <predicate>`` is false (NULL passes)."""
    cond = F.expr(f"`{column}` {predicate}")
    one = df.agg(F.count_if(~F.coalesce(cond, F.lit(True))).alias("n0"))
    return _rows(one, "expression_is_true", [column], "n")


def check_freshness(df: DataFrame, name: str, loaded_at: str, as_of=None,
                    warn_hours: int | None = None, error_hours: int | None = None) -> DataFrame:
    """Age of the newest row against warn / error thresholds."""
    newest = F.max(loaded_at)
    age_h = (F.unix_micros(as_of_lit(as_of)) - F.unix_micros(newest)) / F.lit(3_600_000_000.0)
    status = F.when(newest.isNull(), F.lit("error"))
    if error_hours is not None:
        status = status.when(age_h > error_hours, F.lit("error"))
    if warn_hours is not None:
        status = status.when(age_h > warn_hours, F.lit("warn"))
    status = status.otherwise(F.lit("pass"))
    return df.agg(F.lit(name).alias("table"), newest.alias("max_loaded_at"),
                  F.round(age_h, 2).alias("age_hours"), status.alias("status"))


def check_partition(total: int, valid: int, invalid: int) -> bool:
    """Every record of a run is either valid or invalid."""
    return total == valid + invalid


def core_suite(core: DataFrame, accepted_status: list[str], accepted_industry: list[str]) -> DataFrame:
    """Tests of the core model: not_null x5, unique key, accepted values x2."""
    parts = [check_not_null(core, ["contact_id", "email", "created_at", "processed_at", "run_id"]),
             check_unique(core, "contact_id"),
             check_accepted_values(core, "lead_status", accepted_status),
             check_accepted_values(core, "industry", accepted_industry)]
    return reduce(DataFrame.unionByName, parts)


def source_freshness(raw: DataFrame, quarantine: DataFrame, as_of=None,
                     quarantine_time: str = "quarantined_at", raw_time: str = "processed_at") -> DataFrame:
    return check_freshness(raw, "contacts_raw", raw_time, as_of,
                           RAW_FRESHNESS_WARN_H, RAW_FRESHNESS_ERROR_H).unionByName(
        check_freshness(quarantine, "contacts_quarantine", quarantine_time, as_of,
                        QUARANTINE_FRESHNESS_WARN_H, None))


def manifest_freshness(manifest: DataFrame, as_of=None) -> DataFrame:
    """D5 of the raw and the quarantine batches from a stored manifest (``newest_at`` of each
    batch), without opening a batch."""
    def newest(container: str) -> DataFrame:
        return manifest.where(F.col("container") == container)

    return source_freshness(newest(CONTAINER_RAW), newest(CONTAINER_INVALID), as_of, "newest_at", "newest_at")


def check_split(annotated: DataFrame) -> DataFrame:
    """D6 over a validated batch: every record lands in exactly one side, so
    valid + invalid = total (one scan, one row)."""
    one = annotated.agg(F.count(F.lit(1)).alias("total"),
                        F.count_if(F.col("error_type").isNull()).alias("valid"),
                        F.count_if(F.col("error_type").isNotNull()).alias("invalid"))
    ok = F.col("valid") + F.col("invalid") == F.col("total")
    return one.select(F.lit("valid_plus_invalid_equals_total").alias("check"), "total", "valid",
                      "invalid", F.when(ok, "pass").otherwise("fail").alias("status"))
