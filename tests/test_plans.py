"""Physical plans: JVM-side expressions only (but for the framing of landed text), no all-pairs joins, pruning and pushdown on
the written tables, a partial top-1 before the dedupe shuffle, bounded broadcasts."""
import re

import pytest

from contactlake.operators.core import dedupe_latest
from contactlake.plans import analytics, catalog, marts
from contactlake.session import scratch_path
from contactlake.sources import fixtures

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.fixture(scope="module")
def written(spark):
    import uuid
    lz = fixtures.materialized_layers(spark, SF, scratch_path(spark, f"plans-{uuid.uuid4().hex[:8]}"))
    return lz


#: keys that frame landed text (Arrow batches of lines); what they return is read through it
FRAMED = {"s1", "s2"}


@pytest.mark.parametrize("key", sorted(catalog.queries()))
def test_no_python_and_no_all_pairs(spark, key):
    p = plan(catalog.queries()[key](spark, SF))
    bad = ["BatchEvalPython", "ArrowEvalPython", "PythonUDF", "InPandas", "FlatMapGroupsInArrow", "FlatMapCoGroupsInArrow",
           "CartesianProduct", "BroadcastNestedLoopJoin"]
    for node in bad if key in FRAMED else [*bad, "MapInArrow"]:
        assert node not in p, f"{key}: {node}"


def test_dedupe_limits_before_the_shuffle(spark):
    raw = fixtures.contacts_raw(spark, SF)
    p = plan(dedupe_latest(raw))
    # a partial WindowGroupLimit runs map-side, before the exchange on the key
    assert "WindowGroupLimit" in p
    assert re.search(r"WindowGroupLimit[^\n]*\n(.|\n)*Exchange", p)


def test_report_prunes_and_pushes_on_the_written_core(spark, written):
    p = plan(marts.lead_analytics(written.core_contacts, fixtures.AS_OF))
    assert re.search(r"PartitionFilters: \[.*created_month", p)
    assert re.search(r"PushedFilters: \[.*created_at", p)
    schema = re.search(r"ReadSchema: struct<([^>]*)>", p).group(1)
    assert "first_name" not in schema and "email" not in schema      # only used columns


def test_top_offenders_one_pass_top_k(spark, written):
    p = plan(analytics.a22_repeat_offenders(written.invalid_contacts))
    assert len(re.findall(r"\(\d+\) Scan parquet", p)) == 1         # the quarantine read once
    assert "TakeOrderedAndProject" in p                               # per-partition top-k


def test_median_never_gathers_a_group(spark, written):
    p = plan(analytics.a16_deal_size(written.core_contacts))
    assert "percentile(" not in p.lower().replace("percentile_cont", "") and "collect_list" not in p


def test_deal_sizes_read_the_deals_once(spark, written):
    df = analytics.a16_deal_size(written.core_contacts)
    df.collect()
    p = df._jdf.queryExecution().executedPlan().toString()
    final = p.split("Initial Plan")[0]
    assert len(re.findall(r"FileScan parquet", final)) == 1


def test_quarantine_windows_prune_days(spark, written):
    for df in (analytics.a21_errors_per_day(written.invalid_contacts, fixtures.AS_OF),
               analytics.a24_daily_error_rate(written.invalid_contacts, written.core_contacts, fixtures.AS_OF)):
        assert re.search(r"PartitionFilters: \[[^\n]*ingest_date", plan(df))
