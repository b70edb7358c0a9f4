"""JSON Lines pages with JSON type faults (S1, V3), CSV landing with short and long rows
(S2, V2), observed write counts, the top-k report against brute force, spread."""
import json
import os

from pyspark.sql import functions as F

from contactlake.constants import CSV_COLUMNS, ERR_MISSING_EMAIL, ERR_VALIDATION
from contactlake.operators.validate import MSG_SHAPE_API, validate_api, validate_csv
from contactlake.plans import analytics
from contactlake.sources import readers, sinks

GOOD = '"properties":{"email":"a@b.com","annualrevenue":"10"}'


def test_jsonl_pages_type_faults(spark, tmpdir_path):
    page1 = ('{"results":[{"id":"1",' + GOOD + '},{"id":2,' + GOOD + '},'
             '{"id":"3","properties":{"email":"a@b.com","numberofemployees":5}}],'
             '"paging":{"next":{"after":"3"}}}')
    page2 = '[{"id":"4","properties":{"email":""}},{"id":"5"},{"id":"6","properties":"x"}]'
    path = os.path.join(tmpdir_path, "pages.jsonl")
    with open(path, "w") as fh:
        fh.write(page1 + "\n\n" + page2 + "\n")
    recs = readers.read_api_contacts(spark, path)
    out = {r["contact_id"]: (r["error_type"], r["error_message"])
           for r in validate_api(recs).collect()}
    assert out["1"] == (None, None)
    # a numeric id or property is read as text by a typed read; the VARIANT check sees it
    assert out["2"] == (ERR_VALIDATION, MSG_SHAPE_API)
    assert out["3"] == (ERR_VALIDATION, MSG_SHAPE_API)
    assert out["4"][0] == ERR_MISSING_EMAIL
    assert out["5"] == (ERR_VALIDATION, MSG_SHAPE_API)        # no properties
    assert out["6"] == (ERR_VALIDATION, MSG_SHAPE_API)        # properties not an object
    assert len(out) == 6
    # the quarantine keeps the record's JSON text
    bad = validate_api(recs).where("contact_id = '2'").first()["original_data"]
    assert '"id":2' in bad


def _indented(folder):
    """An indented array, an indented page, lines of which one is torn, a file that is torn in its first line."""
    texts = {"a b.json": json.dumps([{"id": str(i), "properties": {"email": f"a{i}@b.com"}} for i in range(3)], indent=2),
             "p.json": json.dumps({"results": [{"id": "10", "properties": {"email": "p@b.com"}}], "paging": None}, indent=2),
             "l.json": '{"id":"20",' + GOOD + '}\n{"id":"21", torn\n{"id":"22",' + GOOD + '}\n',
             "t.json": '\n{"id":"30", "torn\n{"id":"31",' + GOOD + '}\n'}
    os.makedirs(folder)
    for name, text in texts.items():
        with open(os.path.join(folder, name), "w") as fh:
            fh.write(text)
    return {"0", "1", "2", "10", "20", "22", "31"}, {'{"id":"21", torn', '{"id":"30", "torn'}


def test_indented_documents_and_torn_lines(spark, tmpdir_path):
    folder = os.path.join(tmpdir_path, "in")
    good, torn = _indented(folder)
    out = validate_api(readers.read_api_contacts(spark, folder)).collect()
    assert sorted(r["contact_id"] for r in out if r["error_type"] is None) == sorted(good)
    page = readers.read_api_contacts(spark, os.path.join(folder, "p.json")).collect()
    assert [r["id"] for r in page] == ["10"]
    bad = [r for r in out if r["error_type"] is not None]
    assert len(bad) == 2 and {json.loads(r["original_data"]) for r in bad} == torn


def test_two_indented_documents_in_a_file(spark, tmpdir_path):
    text = json.dumps({"id": "1", "properties": {"email": "a@b.com"}}, indent=2) + "\n"
    with open(os.path.join(tmpdir_path, "two.json"), "w") as fh:
        fh.write(text * 2)
    out = validate_api(readers.read_api_contacts(spark, tmpdir_path)).collect()
    assert [(r["contact_id"], r["error_type"]) for r in out] == [("1", None)] * 2


def test_stream_of_indented_documents(spark, tmpdir_path):
    from contactlake.streaming.stream import stream_contacts
    folder, root = os.path.join(tmpdir_path, "in"), os.path.join(tmpdir_path, "wh")
    good, torn = _indented(folder)
    stream_contacts(spark, folder, root, os.path.join(tmpdir_path, "ckpt")).awaitTermination()
    assert sorted(r["contact_id"] for r in spark.read.parquet(root + "/contacts_raw").collect()) == sorted(good)
    kept = spark.read.parquet(root + "/contacts_quarantine").collect()
    assert len(kept) == 2 and {json.loads(r["original_data"]) for r in kept} == torn


def test_csv_stream_of_cells_with_line_breaks(spark, tmpdir_path):
    from contactlake.streaming.stream import stream_contacts
    folder, root = os.path.join(tmpdir_path, "in"), os.path.join(tmpdir_path, "wh")
    os.makedirs(folder)
    with open(os.path.join(folder, "c.csv"), "w") as fh:
        fh.write(",".join(CSV_COLUMNS) + '\n1,a@b.com,A,B,"Co\nLtd",T,5,2024-01-15T10:30:00Z\n')
    stream_contacts(spark, folder, root, os.path.join(tmpdir_path, "ckpt"), fmt="csv").awaitTermination()
    rows = spark.read.parquet(root + "/contacts_raw").collect()
    assert [(r["contact_id"], r["company_name"]) for r in rows] == [("1", "Co\nLtd")]


def test_csv_landing_short_and_long_rows(spark, tmpdir_path):
    lines = spark.createDataFrame(
        [("1,a@b.com,A,B,Co,T,5,2024-01-15T10:30:00Z",),
         ("2,a@b.com,A,B,Co",),                                        # short row
         ("3,a@b.com,A,B,Co,T,5,2024-01-15T10:30:00Z,extra",),         # long row
         ("4,,A,B,Co,,,",)], "line string")
    path = sinks.write_lines(lines, os.path.join(tmpdir_path, "csv"),
                             header=",".join(CSV_COLUMNS), files=2)
    rows = readers.read_csv_contacts(spark, path).withColumn("row_id", F.col("contact_id"))
    out = {r["row_id"]: r for r in validate_csv(rows).collect()}
    assert out["1"]["error_type"] is None and out["1"]["annual_revenue"] == 5
    assert out["2"]["error_type"] == ERR_VALIDATION
    assert out["3"]["error_type"] is None                   # extra cell ignored
    assert out["4"]["error_type"] == ERR_MISSING_EMAIL
    # every landed file starts with the header
    for f in os.listdir(path):
        if f.endswith(".csv"):
            with open(os.path.join(path, f)) as fh:
                assert fh.readline().strip() == ",".join(CSV_COLUMNS)


def test_observed_run_counts(spark, tmpdir_path):
    df = spark.range(25).select(F.col("id").cast("string").alias("k"), F.lit("r1").alias("run_id"))
    assert sinks._write_run_counted(df, os.path.join(tmpdir_path, "t")) == 25
    assert sinks._write_run_counted(df.limit(3), os.path.join(tmpdir_path, "t")) == 3
    assert spark.read.parquet(os.path.join(tmpdir_path, "t")).count() == 3   # run replaced


def test_top_offenders_brute_force_hot_group(spark):
    rows = []
    # one (e-mail, company) group holds a third of all rows
    for i in range(300):
        rows.append((f"h{i}", '{"email":"hot@x.com","company_name":"H"}', "MissingEmail",
                     f"m{i % 7}"))
    for g in range(60):
        for j in range(g % 4 + 1):
            rows.append((f"g{g}_{j}", '{"email":"u%d@x.com","company_name":null}' % g,
                         "ValidationError" if j % 2 else "MissingEmail", f"n{j}"))
    inv = spark.createDataFrame(rows, "id string, original_data string, error_type string, "
                                      "error_message string")
    got = [tuple(r) for r in analytics.a22_repeat_offenders(inv, k=20).collect()]
    # brute force in Python
    groups = {}
    for _, doc, et, msg in rows:
        import json
        d = json.loads(doc)
        key = (d["email"], d["company_name"])
        g = groups.setdefault(key, [0, set(), set()])
        g[0] += 1
        g[1].add(et)
        g[2].add(msg)
    exp = sorted(((k[0], k[1], v[0], ", ".join(sorted(v[1])), "; ".join(sorted(v[2])))
                  for k, v in groups.items() if v[0] > 1),
                 key=lambda t: (-t[2], t[0] is not None, t[0] or "", t[1] is not None, t[1] or ""))
    assert got == exp[:20]
