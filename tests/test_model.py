"""Data tests of whole tables, and the model run as a graph."""
import os

from pyspark.sql import functions as F

from contactlake.operators import suite
from contactlake.plans import model
from contactlake.plans.pipeline import Warehouse, run_batch
from contactlake.sources import mock

ROWS = [("1", "a", "NEW", 5), ("1", "b", "OPEN", -1), ("2", None, "odd", None), (None, "c", None, 0), (None, "d", "NEW", 1)]
TESTS = [suite.Test("not_null", "id"), suite.Test("not_null", "mail"), suite.Test("unique", "id"),
         suite.Test("accepted_values", "status", ("NEW", "OPEN"), gate=False),
         suite.Test("expression_is_true", "n", predicate=">= 0")]


def frame(spark, rows=ROWS):
    return spark.createDataFrame(rows, "id string, mail string, status string, n int")


def test_all_tests_of_a_table(spark):
    df = frame(spark)
    got = {(r["check"], r["column"]): (r["failing_rows"], r["status"]) for r in suite.table_results(df, "t", TESTS).collect()}
    assert got == {("not_null", "id"): (2, "fail"), ("not_null", "mail"): (1, "fail"), ("unique", "id"): (1, "fail"),
                   ("accepted_values", "status"): (1, "warn"), ("expression_is_true", "n"): (1, "fail")}
    keys = {(r["check"], r["column"], r["key"]) for r in suite.failing_keys(df, "t", TESTS, "mail").collect()}
    assert keys == {("not_null", "id", "c"), ("not_null", "id", "d"), ("not_null", "mail", None), ("unique", "id", "1"),
                    ("accepted_values", "status", None), ("expression_is_true", "n", "b")}
    empty = suite.table_results(frame(spark, []), "t", TESTS).collect()
    assert len(empty) == 5 and all(r["failing_rows"] == 0 and r["status"] == "pass" for r in empty)


def test_tests_of_a_table_are_one_scan(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "t")
    frame(spark).write.parquet(path)
    p = suite.table_results(spark.read.parquet(path), "t", TESTS)._jdf.queryExecution().executedPlan().toString()
    assert p.count("FileScan parquet") == 1


def test_a_failing_node_skips_what_follows(spark, tmpdir_path):
    nodes = [model.Node("a", ("src",), lambda t: t["src"]), model.Node("b", ("a",), lambda t: 1 / 0),
             model.Node("c", ("b",), lambda t: t["b"]), model.Node("d", ("a",), lambda t: t["a"])]
    tables, state = model.run_graph(nodes, {"src": spark.range(1)})
    assert state["a"] == state["d"] == "built" and state["b"].startswith("failed: division") and state["c"] == "skipped"
    assert set(tables) == {"src", "a", "d"} and not model.Outcome(state).good
    assert model.Outcome({"a": "built"}, [("t", "unique", "k", 2, "warn")]).good
    assert not model.Outcome({"a": "built"}, [("t", "unique", "k", 2, "fail")]).good


def test_model_path_writes_marts_and_falls_back(spark, tmpdir_path):
    wh = os.path.join(tmpdir_path, "wh")
    page = mock.write_mock_page(os.path.join(tmpdir_path, "page.json"))
    s = run_batch(spark, page, "json", wh, run_id="r1", mode="model", now="2024-03-01 00:00:00", log=lambda m: None)
    assert s.model_run and s.core_merged == -1
    at = Warehouse(wh)
    funnel = spark.read.parquet(os.path.join(at.marts, "mart_sales_funnel"))
    assert str(funnel.select(F.max("refreshed_at")).first()[0]) == "2024-03-01 00:00:00"
    rows = spark.read.parquet(at.model_runs).where("run_id = 'r1'").collect()
    assert sum(r["check"] == "build" for r in rows) == 8 and all(r["status"] in ("built", "pass", "warn") for r in rows)
    # an undated contact fails the not_null test of core: reported, and the run merges by itself
    undated = os.path.join(tmpdir_path, "undated.json")
    with open(undated, "w") as fh:
        fh.write('{"id":"u","properties":{"email":"u@b.com"}}\n')
    said = []
    s = run_batch(spark, undated, "json", wh, run_id="r2", mode="model", now="2024-03-02 00:00:00", log=said.append)
    assert not s.model_run and s.core_merged == 1 and "core_contacts.created_at not_null: 1" in said[-1]
    rows = spark.read.parquet(at.model_runs).where("run_id = 'r2' AND status = 'fail'").collect()
    assert [(r["node"], r["column"]) for r in rows] == [("core_contacts", "created_at")]
