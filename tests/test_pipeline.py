"""End-to-end runs: batch pipeline, idempotent retry, marts over the warehouse, stream."""
import os
import tempfile

from pyspark.sql import functions as F

from contactlake.operators.quality import check_partition, core_suite
from contactlake.plans import marts
from contactlake.plans.pipeline import run_audit, run_batch
from contactlake.session import scratch_path
from contactlake.sources import mock, sinks
from contactlake.sources.generator import synthetic_contacts
from contactlake.streaming.stream import stream_contacts

CSV = """contact_id,email,first_name,last_name,company_name,job_title,annual_revenue,created_at
c1,a@b.com,A,B,Co,CEO,100,2024-01-15T10:30:00Z
c1,a2@b.com,A,B,Co,CEO,200,2024-01-16T10:30:00Z
c2,,A,B,Co,CEO,100,2024-01-15T10:30:00Z
"""


def test_mock_run_and_retry(spark, tmpdir_path):
    page = mock.write_mock_page(os.path.join(tmpdir_path, "page.json"))
    wh = os.path.join(tmpdir_path, "wh")
    staging = scratch_path(spark, "merge-staging")
    before = set(os.listdir(staging)) if os.path.exists(staging) else set()
    s1 = run_batch(spark, page, "json", wh, run_id="run_a", now="2024-03-01 00:00:00")
    assert (s1.total, s1.valid, s1.invalid) == (3, 2, 1)
    assert check_partition(s1.total, s1.valid, s1.invalid)            # D6
    assert (s1.raw_loaded, s1.quarantined, s1.core_merged) == (2, 1, 2)
    s2 = run_batch(spark, page, "json", wh, run_id="run_a", now="2024-03-01 00:00:00")
    assert s2.raw_loaded == 2 and s2.quarantined == 1                  # retry replaces
    raw = spark.read.parquet(os.path.join(wh, "contacts_raw"))
    assert raw.count() == 2
    core = sinks.read_core(spark, os.path.join(wh, "core_contacts"))
    assert core.count() == 2
    assert run_audit(spark, wh).count() == 1                           # replaced, too
    assert not os.path.exists(scratch_path(spark, "stages", "stages", "run_a"))   # cleaned up
    assert set(os.listdir(staging)) <= before
    q = spark.read.parquet(os.path.join(wh, "contacts_quarantine"))
    assert q.select("id").distinct().count() == 1                      # deterministic id
    m = marts.lead_analytics(core, "2024-03-01 00:00:00").collect()
    assert sum(r["total_leads"] for r in m) == 2
    suite = {(r["check"], r["column"]): r["status"]
             for r in core_suite(core, ["NEW"], ["unknown"]).collect()}
    assert suite[("unique", "contact_id")] == "pass"


def test_csv_run_dedupes_and_watermark_mode(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "c.csv")
    with open(path, "w") as fh:
        fh.write(CSV)
    wh = os.path.join(tmpdir_path, "wh")
    s = run_batch(spark, path, "csv", wh, run_id="run_1", now="2024-03-01 00:00:00")
    assert (s.total, s.valid, s.invalid, s.core_merged) == (3, 2, 1, 1)
    core = sinks.read_core(spark, os.path.join(wh, "core_contacts"))
    assert [r["email"] for r in core.collect()] == ["a2@b.com"]        # last record wins
    s2 = run_batch(spark, path, "csv", wh, run_id="run_2", mode="model",
                   now="2024-03-02 00:00:00")
    assert s2.model_run and s2.core_merged == -1
    core = sinks.read_core(spark, os.path.join(wh, "core_contacts"))
    assert core.count() == 1 and core.first()["lead_status"] == "UNASSIGNED"


def test_stream_available_now(spark, tmpdir_path):
    landing = os.path.join(tmpdir_path, "landing")
    os.makedirs(landing)
    mock.write_mock_page(os.path.join(landing, "p1.json"))
    wh = os.path.join(tmpdir_path, "wh")
    q = stream_contacts(spark, landing, wh, os.path.join(tmpdir_path, "ckpt"))
    q.awaitTermination(120)
    assert spark.read.parquet(os.path.join(wh, "contacts_raw")).count() == 2
    assert sinks.read_core(spark, os.path.join(wh, "core_contacts")).count() == 2


def test_generator_shape(spark):
    df = synthetic_contacts(spark, n=2000, seed=42)
    total = df.count()
    assert 2000 < total < 2000 + 2 * 60
    assert df.select("id").distinct().count() == total
    from contactlake.operators.validate import validate
    ann = validate(df)
    bad = ann.where(F.col("error_type").isNotNull()).count()
    assert 0 < bad <= 500 + 120


def test_merge_of_undated_contacts(spark, tmpdir_path):
    """A batch of undated contacts alone, into a dated core and into an undated one."""
    head = CSV.splitlines()[0] + "\n"
    for first in ("c1,a@b.com,A,B,Co,CEO,1,2024-01-15T10:30:00Z\n", "c1,a@b.com,A,B,Co,CEO,1,\n"):
        wh = tempfile.mkdtemp(dir=tmpdir_path)
        for k, rows in enumerate([first, "c2,b@b.com,A,B,Co,CEO,2,\n", "c1,c@b.com,A,B,Co,CEO,3,\nc2,d@b.com,A,B,Co,CEO,4,\n"]):
            path = os.path.join(wh, f"in{k}.csv")
            with open(path, "w") as f:
                f.write(head + rows)
            run_batch(spark, path, "csv", wh, run_id=f"run_{k}", now=f"2024-03-0{k + 1} 00:00:00")
        core = sinks.read_core(spark, os.path.join(wh, "core_contacts"))
        assert sorted((r["contact_id"], r["annual_revenue"], r["created_at"]) for r in core.collect()) == \
            [("c1", 3, None), ("c2", 4, None)]


def test_malformed_rows_are_kept_whole(spark, tmpdir_path):
    wide = ",".join(f'"x{k}"' for k in range(8000))
    rows = ["c1,a@b.com,A,B,Co,CEO,100,2024-01-15T10:30:00Z,NINTH", "c2,short", "c3,c@b.com,A,B,Co,CEO,99999999999999999999,", wide]
    path = os.path.join(tmpdir_path, "bad.csv")
    with open(path, "w") as f:
        f.write(CSV.splitlines()[0] + "\n" + "\n".join(rows) + "\n")
    wh = os.path.join(tmpdir_path, "wh")
    stats = run_batch(spark, path, "csv", wh, run_id="r", now="2024-03-01 00:00:00")
    assert (stats.total, stats.valid, stats.invalid) == (4, 1, 3)
    raw = spark.read.parquet(os.path.join(wh, "batches", "raw")).collect()
    assert {r["_corrupt_record"] for r in raw if r["_corrupt_record"]} == {rows[0], rows[1], rows[3]}
    bad = {r["original_data"] for r in spark.read.parquet(os.path.join(wh, "contacts_quarantine")).collect()}
    assert any("c2,short" in t for t in bad) and any("99999999999999999999" in t for t in bad) and any("x7999" in t for t in bad)
