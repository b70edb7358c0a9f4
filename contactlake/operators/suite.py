"""Data tests of whole tables (D1-D4): every test of a table in one scan.

A table's rows are grouped by the column that should be unique (or not grouped without one);
each group counts its rows and its failures of every other test, and the groups are added
up: one scan, one shuffle with partial aggregation, whatever the number of tests. The rows
that fail can be asked for by key."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import ACCEPTED_INDUSTRY, ACCEPTED_LEAD_STATUS

RESULT = "table string, check string, column string, failing_rows long, status string"


@dataclass(frozen=True)
class Test:
    """One data test. ``gate``: a failure fails the run that it belongs to, else it is a warning."""
    check: str
    column: str
    values: tuple = ()
    predicate: str = ""
    gate: bool = True

    def fails(self) -> Column:
        """Whether a row fails (``unique`` is a test of groups, not of rows)."""
        c = F.col(self.column)
        if self.check == "not_null":
            return c.isNull()
        if self.check == "accepted_values":
            return c.isNotNull() & ~c.isin(*self.values)
        if self.check == "expression_is_true":
            return ~F.coalesce(F.expr(f"`{self.column}` {self.predicate}"), F.lit(True))
        raise ValueError(f"unknown check {self.check!r}")


def _not_null(*columns: str) -> list[Test]:
    return [Test("not_null", c) for c in columns]


def _accepted(column: str, values: list[str]) -> Test:
    return Test("accepted_values", column, tuple(values), gate=False)


# fixed values: the tests of every layer. Accepted values warn (the sets are arguments of the
# deployment); staging may hold a contact twice (it is not deduplicated), so that warns, too
TESTS: dict[str, list[Test]] = {
    "contacts_raw": _not_null("contact_id", "email", "run_id"),
    "contacts_quarantine": [*_not_null("id"), Test("unique", "id")],
    "stg_contacts": [*_not_null("contact_id", "email", "run_id"), Test("unique", "contact_id", gate=False),
                     _accepted("lead_status", ACCEPTED_LEAD_STATUS),
                     Test("expression_is_true", "annual_revenue", predicate=">= 0", gate=False)],
    "core_contacts": [*_not_null("contact_id", "email", "created_at", "processed_at", "run_id"), Test("unique", "contact_id"),
                      _accepted("industry", ACCEPTED_INDUSTRY), _accepted("lead_status", ACCEPTED_LEAD_STATUS),
                      Test("expression_is_true", "annual_revenue", predicate=">= 0", gate=False)],
    "mart_lead_analytics": _not_null("lead_source"),
    "mart_sales_funnel": _not_null("stage"),
    "mart_industry_analytics": _not_null("industry"),
    "mart_daily_trends": _not_null("date"),
}


def table_results(df: DataFrame, table: str, tests: list[Test]) -> DataFrame:
    """``(table, check, column, failing_rows, status)`` of one table. A null key is no repeat."""
    unique = [t for t in tests if t.check == "unique"]
    rows = [t for t in tests if t.check != "unique"]
    counts = [F.count_if(t.fails()).alias(f"f{i}") for i, t in enumerate(rows)]
    if unique:  # one more scan for each further unique column: the layers have one at most
        key = unique[0].column
        groups = df.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"), *counts)
        one = groups.agg(F.count_if((F.col("_n") > 1) & F.col("_key").isNotNull()).alias("u0"),
                         *[F.coalesce(F.sum(f"f{i}"), F.lit(0)).alias(f"f{i}") for i in range(len(rows))])
    else:
        one = df.agg(*counts)
    named = [*zip(unique[:1], ["u0"]), *((t, f"f{i}") for i, t in enumerate(rows))]
    out = one.select(F.inline(F.array(*[F.struct(
        F.lit(table).alias("table"), F.lit(t.check).alias("check"), F.lit(t.column).alias("column"),
        F.col(c).cast("long").alias("failing_rows"),
        F.when(F.col(c) == 0, "pass").otherwise("fail" if t.gate else "warn").alias("status")) for t, c in named])))
    return reduce(DataFrame.unionByName, [out, *[table_results(df, table, [t]) for t in unique[1:]]])


def suite_results(tables: dict[str, DataFrame], tests: dict[str, list[Test]] | None = None,
                  checks: set[str] | None = None) -> DataFrame:
    """Results of the tests of the given tables, or of some kinds of them (``checks``)."""
    tests = TESTS if tests is None else tests
    chosen = {n: [t for t in tests.get(n, []) if checks is None or t.check in checks] for n in tables}
    return reduce(DataFrame.unionByName, [table_results(tables[n], n, ts) for n, ts in chosen.items() if ts])


def failing_keys(df: DataFrame, table: str, tests: list[Test], key: str) -> DataFrame:
    """``(table, check, column, key)`` of every failing row (for ``unique``: every repeated key)."""
    rows = [t for t in tests if t.check != "unique"]
    named = F.array(*[F.struct(F.lit(t.check).alias("check"), F.lit(t.column).alias("column"), t.fails().alias("bad"))
                      for t in rows]) if rows else None
    key_text = F.col(key).cast("string").alias("key")
    parts = []
    if rows:
        parts.append(df.select(key_text, F.inline(F.filter(named, lambda t: t["bad"])))
                     .select(F.lit(table).alias("table"), "check", "column", "key"))
    for t in (t for t in tests if t.check == "unique"):
        repeated = df.where(F.col(t.column).isNotNull()).groupBy(t.column).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
        parts.append(repeated.select(F.lit(table).alias("table"), F.lit("unique").alias("check"),
                                     F.lit(t.column).alias("column"), F.col(t.column).cast("string").alias("key")))
    return reduce(DataFrame.unionByName, parts)
