"""Run plumbing: format detection (V1), run ids (V13), processed archive (V16), stage
hand-over (S14), JSON Lines stream in several micro-batches (W1)."""
import os
import re

from contactlake.operators.validate import is_csv_format
from contactlake.plans.pipeline import new_run_id, run_batch
from contactlake.sources import mock, readers, sinks
from contactlake.streaming.stream import stream_contacts


def test_format_detection(spark, tmpdir_path):
    page = mock.write_mock_page(os.path.join(tmpdir_path, "page.json"))
    assert not is_csv_format(readers.read_api_contacts(spark, page))
    path = os.path.join(tmpdir_path, "c.csv")
    with open(path, "w") as fh:
        fh.write("contact_id,email,first_name,last_name,company_name,job_title,annual_revenue,"
                 "created_at\nc1,a@b.com,A,B,Co,CEO,100,2024-01-15T10:30:00Z\n")
    assert is_csv_format(readers.read_csv_contacts(spark, path))


def test_run_id_format():
    a, b = new_run_id(), new_run_id()
    assert re.fullmatch(r"\d{8}_\d{6}_[0-9a-f]{8}", a) and a != b


def test_processed_archive_and_stage(spark, tmpdir_path):
    page = mock.write_mock_page(os.path.join(tmpdir_path, "page.json"))
    wh = os.path.join(tmpdir_path, "wh")
    run_batch(spark, page, "json", wh, run_id="run_p", now="2024-03-01 00:00:00",
              archive_processed=True, log=lambda m: None)
    processed = spark.read.parquet(os.path.join(wh, "batches", "processed"))
    assert processed.where("run_id = 'run_p'").count() == 2
    invalid = spark.read.json(os.path.join(wh, "batches", "invalid"))
    assert invalid.count() == 1
    df = spark.range(5)
    base = os.path.join(tmpdir_path, "stages")
    sinks.save_stage(df, base, "x", "r1")
    assert sinks.load_stage(spark, base, "x", "r1").count() == 5


def test_jsonl_stream_in_micro_batches(spark, tmpdir_path):
    landing = os.path.join(tmpdir_path, "landing")
    os.makedirs(landing)
    rec = '{{"id":"{i}","properties":{{"email":"u{i}@x.com","createdate":"2024-01-1{d}T10:00:00Z"}}}}'
    for f in range(3):
        name = os.path.join(landing, f"part-{f}.jsonl")
        with open(name, "w") as fh:
            # the same ids in every file: later micro-batches update them
            fh.write('{"results":[' + ",".join(rec.format(i=i, d=f) for i in range(4)) + "]}\n")
        os.utime(name, (1_700_000_000 + 60 * f, 1_700_000_000 + 60 * f))   # file order
    wh = os.path.join(tmpdir_path, "wh")
    q = stream_contacts(spark, landing, wh, os.path.join(tmpdir_path, "ckpt"),
                        max_files_per_trigger=1, now="2024-03-01 00:00:00")
    q.awaitTermination(300)
    raw = spark.read.parquet(os.path.join(wh, "contacts_raw"))
    assert raw.select("run_id").distinct().count() == 3          # one run per micro-batch
    core = sinks.read_core(spark, os.path.join(wh, "core_contacts"))
    assert core.count() == 4 and core.select("contact_id").distinct().count() == 4
    # the last file's records won (unconditional update); no stale copy survives
    assert {r["d"] for r in core.selectExpr("day(created_at) AS d").collect()} == {12}


def test_high_water_mark_recorded_after_merges(spark, tmpdir_path):
    from pyspark.sql import functions as F

    from contactlake.operators.core import TS_TEXT
    page = mock.write_mock_page(os.path.join(tmpdir_path, "page.json"))
    wh = os.path.join(tmpdir_path, "wh")
    core_path = os.path.join(wh, "core_contacts")

    def core_max():
        core = sinks.read_core(spark, core_path)
        return core.agg(F.date_format(F.max("processed_at"), TS_TEXT)).first()[0]

    run_batch(spark, page, "json", wh, run_id="r1", now="2024-03-01 00:00:00", log=lambda m: None)
    assert sinks.read_watermark(spark, core_path) == "2024-03-01 00:00:00.000000" == core_max()
    # the model path merges by watermark: source rows newer than the recorded mark
    s = run_batch(spark, page, "json", wh, run_id="r2", mode="model", now="2024-03-02 00:00:00",
                  log=lambda m: None)
    assert s.model_run
    assert sinks.read_watermark(spark, core_path) == core_max() == "2024-03-02 00:00:00.000000"


def test_batch_run_over_json_lines(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "pages.jsonl")
    with open(path, "w") as fh:
        for p in range(3):
            fh.write('{"results":[' + ",".join(
                '{"id":"c%d","properties":{"email":"u%d@x.com"}}' % (10 * p + i, i)
                for i in range(5)) + ']}\n')
        fh.write('{"results":[{"id":"bad","properties":{"email":"nope"}}]}\n')
    s = run_batch(spark, path, "json", os.path.join(tmpdir_path, "wh"), run_id="r1",
                  now="2024-03-01 00:00:00", log=lambda m: None)
    assert (s.total, s.valid, s.invalid, s.core_merged) == (16, 15, 1, 15)


def test_merge_reads_only_needed_runs_and_skips_empty_ones(spark, tmpdir_path):
    wh = os.path.join(tmpdir_path, "wh")
    page = mock.write_mock_page(os.path.join(tmpdir_path, "page.json"))
    bad = os.path.join(tmpdir_path, "bad.json")
    with open(bad, "w") as fh:
        fh.write('[{"id":"x","properties":{"email":"nope"}}]')
    s0 = run_batch(spark, bad, "json", wh, run_id="r0", now="2024-03-01 00:00:00",
                   log=lambda m: None)
    assert (s0.valid, s0.core_merged) == (0, 0)                 # empty run: nothing to merge
    s1 = run_batch(spark, page, "json", wh, run_id="r1", now="2024-03-02 00:00:00",
                   log=lambda m: None)
    assert s1.core_merged == 2
    raw = os.path.join(wh, "contacts_raw")
    assert sinks.raw_runs_after(spark, raw, None) == ["r1"]
    assert sinks.raw_runs_after(spark, raw, "2024-03-02 00:00:00.000000") == []
    # a model (watermark) run after that finds its own run newer than the mark
    s2 = run_batch(spark, page, "json", wh, run_id="r2", mode="model",
                   now="2024-03-03 00:00:00", log=lambda m: None)
    assert s2.model_run
    assert sinks.read_core(spark, os.path.join(wh, "core_contacts")).count() == 2


def test_stream_empty_file_is_a_zero_run(spark, tmpdir_path):
    landing = os.path.join(tmpdir_path, "landing")
    os.makedirs(landing)
    open(os.path.join(landing, "empty.jsonl"), "w").close()
    wh = os.path.join(tmpdir_path, "wh")
    q = stream_contacts(spark, landing, wh, os.path.join(tmpdir_path, "ckpt"),
                        now="2024-03-01 00:00:00")
    q.awaitTermination(300)
    audit = spark.read.parquet(os.path.join(wh, "run_audit")).collect()
    assert [(r["total"], r["core_merged"]) for r in audit] == [(0, 0)]


def test_a_run_again_on_another_day_replaces_its_rows(spark, tmpdir_path):
    page = mock.write_mock_page(os.path.join(tmpdir_path, "page.json"))
    wh = os.path.join(tmpdir_path, "wh")
    for day in ("2024-03-01", "2024-03-02"):
        run_batch(spark, page, "json", wh, run_id="r", now=f"{day} 00:00:00", log=lambda m: None)
    for table, rows in (("contacts_raw", 2), ("contacts_quarantine", 1)):
        got = spark.read.parquet(os.path.join(wh, table))
        assert got.count() == rows and {str(r["ingest_date"]) for r in got.collect()} == {"2024-03-02"}
