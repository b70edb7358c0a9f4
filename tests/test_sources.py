"""Batch store round trips."""
import os

from pyspark.sql import functions as F

from contactlake.schema import QUARANTINE_SCHEMA
from contactlake.sources import readers, sinks


def test_batches_overwrite_and_latest(spark, tmpdir_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    base = os.path.join(tmpdir_path, "store")
    assert sinks.read_manifest(spark, base).count() == 0
    sinks.write_batch(df, base, "raw", "20240101_000000_aaaa")
    sinks.write_batch(df, base, "raw", "20240102_000000_bbbb")
    sinks.write_batch(df.limit(1), base, "raw", "20240102_000000_bbbb")     # same name
    sinks.write_batch(df, base, "processed", "20240103_000000_cccc")
    assert [r["k"] for r in readers.read_latest_batch(spark, base, "raw", "2024").collect()] == [1]
    assert readers.read_latest_batch(spark, base, "raw", "2025").count() == 0
    assert readers.read_batch(spark, base, "raw", "nope").count() == 0
    assert readers.read_batch(spark, base, "raw", "nope", schema=df.schema).columns == ["k", "v"]
    man = {r["blob_key"]: (r["record_count"], r["file_path"]) for r in sinks.read_manifest(spark, base).collect()}
    assert man == {f"{c}/{n}": (k, f"{base}/{c}/run_id={n}") for c, n, k in (
        ("raw", "20240101_000000_aaaa", 2), ("raw", "20240102_000000_bbbb", 1), ("processed", "20240103_000000_cccc", 2))}
    raw = sinks.read_manifest(spark, base).where("container = 'raw'")
    assert [r["blob_name"] for r in sinks.list_batches(raw, "2024").collect()] == ["20240101_000000_aaaa", "20240102_000000_bbbb"]


def test_many_batches_in_one_write_keep_the_others(spark, tmpdir_path):
    base = os.path.join(tmpdir_path, "store")
    rows = spark.createDataFrame([("a", "2024-01-01 00:00:00"), ("a", "2024-01-03 00:00:00"), ("b", "2024-01-02 00:00:00")],
                                 "run_id string, t string").withColumn("t", F.col("t").cast("timestamp"))
    sinks.write_batch(rows, base, "raw", None, newest="t")
    sinks.write_batch(rows.where("run_id = 'b'").limit(0).unionByName(rows.where("run_id = 'a'").limit(1)), base, "raw", None, newest="t")
    got = {r["blob_name"]: (r["record_count"], str(r["newest_at"])) for r in sinks.read_manifest(spark, base).collect()}
    assert got["b"] == (1, "2024-01-02 00:00:00") and got["a"][0] == 1


def test_json_batch_as_objects_or_arrays(spark, tmpdir_path):
    base = os.path.join(tmpdir_path, "store")
    for name, text in (("lines", '{"k":1,"v":"a"}\n{"k":2}\n'), ("object", '{\n "k": 1,\n "v": "a"\n}'),
                       ("array", '[{"k":1,"v":"a"},\n {"k":2}]'), ("empty", "")):
        folder = os.path.join(base, "raw", f"run_id={name}")
        os.makedirs(folder)
        with open(os.path.join(folder, "raw_batch.json"), "w") as fh:
            fh.write(text)
    schema = spark.createDataFrame([], "k int, v string").schema
    for name, want in (("lines", [(1, "a"), (2, None)]), ("object", [(1, "a")]), ("array", [(1, "a"), (2, None)]),
                       ("empty", []), ("unknown", [])):
        got = readers.read_batch(spark, base, "raw", name, "json", schema)
        assert sorted((r["k"], r["v"]) for r in got.collect()) == want, name
    assert sorted(r["record"] for r in readers.read_batch(spark, base, "raw", "array", "json").collect()) == ['{"k":1,"v":"a"}', '{"k":2}']


def test_upsert_onto_a_filled_target(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "target")
    kind = "contact_id string, email string, first_name string, last_name string, created_at timestamp, ingest_seq long"

    def batch(*rows):
        return spark.createDataFrame([(i, e, None, None, None, k) for k, (i, e) in enumerate(rows)], kind)

    assert sinks.relational_upsert(spark, path, batch(("1", "a"), ("1", "b"), ("2", "c"))) == (0, 2)
    assert sinks.relational_upsert(spark, path, batch(("2", "d"), ("3", "e"), ("2", "f"))) == (1, 1)
    assert sinks.relational_upsert(spark, path, batch()) == (0, 0)
    assert {r["contact_id"]: r["email"] for r in sinks.read_snapshot(spark, path).collect()} == {"1": "b", "2": "f", "3": "e"}


def test_json_copy_single_object(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "one.json")
    with open(p, "w") as fh:
        fh.write('{"id": "x1", "properties": {"email": "a@b.com"}}')
    recs = readers.read_api_contacts(spark, p)
    assert [r["id"] for r in recs.collect()] == ["x1"]


def test_append_table_schema_checked(spark, tmpdir_path):
    df = spark.createDataFrame([("i", "{}", "m", "ValidationError", "r", None)],
                               "id string, original_data string, error_message string, "
                               "error_type string, run_id string, quarantined_at timestamp")
    path = os.path.join(tmpdir_path, "q")
    sinks.append_table(df, path, QUARANTINE_SCHEMA)
    sinks.append_table(df, path, QUARANTINE_SCHEMA)
    assert spark.read.parquet(path).count() == 2


def test_relational_upsert_later_duplicate_wins(spark):
    b = spark.createDataFrame(
        [("1", "a@x.com", "A", "B", None, 1), ("1", "b@x.com", "A", "B", None, 2),
         ("2", "c@x.com", "C", "D", None, 3)],
        "contact_id string, email string, first_name string, last_name string, "
        "created_at timestamp, ingest_seq long")
    out = {r["contact_id"]: r["email"] for r in sinks.relational_upsert_rows(None, b).collect()}
    assert out == {"1": "b@x.com", "2": "c@x.com"}
    t = spark.createDataFrame([("2", "old@x.com", "C", "D", None), ("3", "z@x.com", "E", "F", None)],
                              "contact_id string, email string, first_name string, "
                              "last_name string, created_at timestamp")
    out = {r["contact_id"]: r["email"] for r in sinks.relational_upsert_rows(t, b).collect()}
    assert out == {"1": "b@x.com", "2": "c@x.com", "3": "z@x.com"}


def test_snapshot_pointer(spark, tmpdir_path):
    from contactlake.schema import CONTACT_COLUMNS
    base = os.path.join(tmpdir_path, "core")
    assert sinks.read_snapshot(spark, base) is None
    df = spark.createDataFrame([("1", "2024-01-01 00:00:00")], "contact_id string, created_at string") \
        .withColumn("created_at", F.col("created_at").cast("timestamp")) \
        .withColumn("lead_status", F.lit("NEW")).withColumn("industry", F.lit(None).cast("string"))
    p0 = sinks.publish_snapshot(df, base)
    p1 = sinks.publish_snapshot(df, base)
    assert p0.endswith("v=0") and p1.endswith("v=1")
    assert sinks.read_snapshot(spark, base).count() == 1


def test_views_tables_and_params(spark, tmpdir_path):
    from contactlake.plans import marts
    from contactlake.sources import fixtures
    lz = fixtures.layers(spark, "/root/testdata/sf0.001")
    done = marts.register_marts(lz.core_contacts, lz.invalid_contacts, fixtures.AS_OF)
    assert len(done) == 6
    got = sinks.run_query(spark, "SELECT value FROM vw_data_quality WHERE metric = :m",
                          {"m": "Valid Records"}).first()["value"]
    assert int(got) == lz.core_contacts.count()
    path = os.path.join(tmpdir_path, "qt")
    sinks.create_table_if_missing(spark, "quarantine_t", path, sinks.quarantine_schema_ddl(),
                                  ["run_id"])
    sinks.create_table_if_missing(spark, "quarantine_t", path, sinks.quarantine_schema_ddl(),
                                  ["run_id"])
    assert spark.table("quarantine_t").count() == 0
    spark.sql("DROP TABLE quarantine_t")
