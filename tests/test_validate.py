"""Validator branches (V1-V12) on the mock batch and a CSV case table."""
import os

from pyspark.sql import functions as F

from contactlake.operators.validate import error_counts, split, validate
from contactlake.sources import mock, readers

CSV = """contact_id,email,first_name,last_name,company_name,job_title,annual_revenue,created_at
c1,a@b.com,A,B,Co,CEO,100,2024-01-15T10:30:00Z
c2,,A,B,Co,CEO,100,2024-01-15T10:30:00Z
c3,nomail.com,A,B,Co,CEO,100,2024-01-15T10:30:00Z
c4,user@domain,A,B,Co,CEO,100,2024-01-15T10:30:00Z
c5,a@b.com,A,B
c6,a@b.com,A,B,Co,CEO,100,2024-01-15T10:30:00Z,extra
c7,a@b.com,A,B,Co,CEO,abc,2024-01-15T10:30:00Z
c8,a@b.com,A,B,Co,CEO,0,bad-date
c9,a@b.com,,,,,,
"""


def test_mock_batch(spark, tmpdir_path):
    path = mock.write_mock_page(os.path.join(tmpdir_path, "page.json"))
    ann = validate(readers.read_api_contacts(spark, path))
    valid, invalid = split(ann, run_id="r1")
    assert valid.count() == 2 and invalid.count() == 1
    assert invalid.first()["error_type"] == "ValidationError"
    c1 = valid.where("contact_id = 'contact_1'").first()
    assert str(c1["created_at"]) == "2024-01-15 10:30:00"
    assert c1["email"] == "test1@example.com"


def test_api_types_checked(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "arr.json")
    with open(path, "w") as fh:
        fh.write('[{"id": 7, "properties": {"email": "a@b.com"}},'
                 ' {"id": "8", "properties": {"email": "a@b.com", "annualrevenue": 5}},'
                 ' {"id": "9", "properties": {"email": "A@B.COM", "annualrevenue": "0",'
                 ' "numberofemployees": "0", "hs_lead_status": "closed"}}]')
    ann = validate(readers.read_api_contacts(spark, path))
    rows = {r["id"]: r for r in ann.collect()}
    assert rows["7"]["error_type"] == "ValidationError"      # numeric id
    assert rows["8"]["error_type"] == "ValidationError"      # numeric property
    r9 = rows["9"]
    assert r9["error_type"] is None and r9["email"] == "a@b.com"
    assert r9["annual_revenue"] is None and r9["numberofemployees"] == 0   # T4
    assert r9["lead_status"] == "CLOSED"                                    # T8 + upper


def test_csv_cases(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "c.csv")
    with open(path, "w") as fh:
        fh.write(CSV)
    ann = validate(readers.read_csv_contacts(spark, path))
    got = {r["contact_id"] or r["original_data"]: r["error_type"] for r in ann.collect()}
    by_id = {}
    for r in ann.collect():
        key = r["contact_id"] if r["contact_id"] else r["original_data"]
        by_id[key] = r
    assert got
    assert by_id["c1"]["error_type"] is None
    assert by_id["c2"]["error_type"] == "MissingEmail"
    assert by_id["c3"]["error_type"] == "MissingEmail"
    assert by_id["c4"]["error_type"] == "ValidationError"
    assert by_id["c6"]["error_type"] is None                 # extra cell accepted
    assert by_id["c7"]["error_type"] == "ValidationError"    # T3
    assert by_id["c8"]["error_type"] is None and by_id["c8"]["annual_revenue"] is None
    assert by_id["c8"]["created_at"] is None
    assert by_id["c9"]["error_type"] is None and by_id["c9"]["first_name"] == ""
    short = [r for r in ann.collect() if r["error_type"] == "ValidationError"
             and '"c5"' in (r["original_data"] or "")]
    assert len(short) == 1                                   # short row
    counts = {r["outcome"]: r["records"] for r in error_counts(ann).collect()}
    assert sum(counts.values()) == 9


def test_literal_mode(spark, tmpdir_path):
    path = mock.write_mock_page(os.path.join(tmpdir_path, "page.json"))
    ann = validate(readers.read_api_contacts(spark, path), literal=True)
    valid, _ = split(ann, run_id="r1")
    rows = valid.collect()
    assert all(r["created_at"] is None for r in rows)        # T1
    assert all(r["first_name"] == r["first_name"].lower() for r in rows)   # T2
