"""The stream of landed pages: its text is scanned no more often than needed, line by line work
is done for brackets only, and checks are computed once a record."""
import json
import os
import random

import pyarrow as pa
import pytest

from contactlake.constants import EMAIL_PATTERN
from contactlake.operators.validate import validate_api
from contactlake.sources import framing, readers


def text_lines(rnd):
    """Lines of JSON and of signs that may be no JSON at all."""
    page = {"results": [{"id": str(k), "properties": {"a": rnd.choice(["x", "{", '"', "\\", ""]), "b": None, "c": 1}}
                        for k in range(rnd.randint(0, 4))]}
    lines = json.dumps(page, indent=rnd.choice([None, 0, 2])).split("\n")
    for _ in range(rnd.choice([0, 0, 3])):
        signs = ["{", "}", "[", "]", '"', "\\", ",", ":", "a", " ", "\x01", '"results":[', '"k":"v",', " ", "é"]
        lines.insert(rnd.randint(0, len(lines)), "".join(rnd.choice(signs) for _ in range(rnd.randint(0, 6))))
    return lines * rnd.choice([1, 2])


@pytest.mark.parametrize("record_bytes", [1 << 20, 12])
def test_runs_of_lines_are_as_line_by_line(record_bytes, monkeypatch):
    monkeypatch.setattr(framing, "RECORD_BYTES", record_bytes)
    rnd = random.Random(3)
    for _ in range(400):
        lines = text_lines(rnd)
        one = framing.Effect()
        for x in lines:
            one = one.then(framing.Json.effect(x))
        cut = rnd.randint(0, len(lines))
        both = framing.Json.fold(framing.Json.fold(framing.Effect(), pa.array(lines[:cut], pa.string())),
                                 pa.array(lines[cut:], pa.string()))
        assert both == one
        state = rnd.choice([framing.State(), framing.State(2, "{\x01", ","), framing.State(3, "{\x01", "{"),
                            framing.State(1, "{", ","), framing.State(2, "[{", ",")])
        a, b = [framing.JsonUnits("f", 5, framing.replace(state), False) for _ in range(2)]
        for x in lines:
            a.line(x)
        for part in (lines[:cut], lines[cut:]):
            if part:
                b.lines(pa.array(part, pa.string()))
        a.finish()
        b.finish()
        assert a.rows == b.rows
        assert (a.state, a.number) == (b.state, b.number)


def test_one_text_scan_for_all_fragments(spark, tmpdir_path):
    """Whole units in one scan, the fragments of the others, long and short, in one more."""
    os.makedirs(folder := os.path.join(tmpdir_path, "in"))
    with open(os.path.join(folder, "a.json"), "w") as fh:
        json.dump([{"id": str(k), "properties": {"email": "a@b.com"}} for k in range(40)], fh, indent=2)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        rows = readers.read_api_contacts(spark, folder)
        assert sorted(int(r.id) for r in rows.collect()) == list(range(40))
        assert rows._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 2
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_a_record_is_checked_once(spark):
    rows = spark.createDataFrame([('{"id":"1","properties":{"email":"A@b.com","annualrevenue":"0"}}',),
                                  ('{"id":"2","properties":{"email":"a@b"}}',)], "doc string")
    out = validate_api(readers.api_records_from_docs(rows))
    assert sorted((r.contact_id, r.email, r.annual_revenue, r.error_type is None) for r in out.collect()) == \
        [("1", "a@b.com", None, True), ("2", "a@b", None, False)]
    assert out._jdf.queryExecution().optimizedPlan().toString().count(EMAIL_PATTERN) == 1
