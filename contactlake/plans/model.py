"""The model run: staging, core, six marts, then the data tests, as a graph.

Every node names the nodes it follows. A node that fails is reported and what follows from
it is skipped; the others still run. The run is good if every node was built and no gating
test failed."""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..functions.expr import as_of_lit
from ..operators.suite import suite_results
from . import marts

#: mart → what it is built from, in the order of the views
MARTS: dict[str, Callable[[DataFrame, DataFrame, object], DataFrame]] = {
    "mart_lead_analytics": lambda core, bad, as_of: marts.lead_analytics(core, as_of),
    "mart_sales_funnel": lambda core, bad, as_of: marts.sales_funnel(core),
    "mart_industry_analytics": lambda core, bad, as_of: marts.industry_analytics(core),
    "mart_conversion_metrics": lambda core, bad, as_of: marts.conversion_metrics(core, as_of),
    "mart_data_quality": lambda core, bad, as_of: marts.data_quality(core, bad),
    "mart_daily_trends": lambda core, bad, as_of: marts.daily_trends(core, as_of),
}


@dataclass
class Node:
    name: str
    after: tuple[str, ...]
    build: Callable[[dict[str, DataFrame]], DataFrame | None]


@dataclass
class Outcome:
    """What became of the nodes (``built``, ``failed: ...`` or ``skipped``), and the test rows."""
    nodes: dict[str, str] = field(default_factory=dict)
    tests: list[tuple] = field(default_factory=list)

    @property
    def good(self) -> bool:
        return all(s == "built" for s in self.nodes.values()) and all(t[4] != "fail" for t in self.tests)


def run_graph(nodes: list[Node], sources: dict[str, DataFrame]) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """Build the nodes in order; the tables (sources included) and what became of each node."""
    tables, state = dict(sources), {}
    for n in nodes:
        if any(a not in tables for a in n.after):
            state[n.name] = "skipped"
            continue
        try:
            tables[n.name] = n.build(tables)
            state[n.name] = "built"
        except Exception as exc:  # noqa: BLE001 - reported; what does not follow from it still runs
            state[n.name] = f"failed: {str(exc).splitlines()[0] if str(exc) else type(exc).__name__}"
    return tables, state


def write_mart(df: DataFrame, path: str, as_of) -> DataFrame:
    """A mart as a written table with the time of its refresh."""
    df.withColumn("refreshed_at", as_of_lit(as_of)).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def run_model(spark: SparkSession, raw: DataFrame, quarantine: DataFrame, staging: Callable[[DataFrame], DataFrame],
              core: Callable[[DataFrame], DataFrame], marts_root: str, as_of=None,
              only: dict[str, Callable] | None = None) -> Outcome:
    """Run the graph over given sources. ``staging`` maps raw to staging; ``core`` merges staging
    and returns the core table. Marts are written under ``marts_root``. All tests of a table
    are one scan of it; their results are the only rows collected."""
    nodes = [Node("stg_contacts", ("contacts_raw",), lambda t: staging(t["contacts_raw"])),
             Node("core_contacts", ("stg_contacts",), lambda t: core(t["stg_contacts"]))]
    for name, build in (MARTS if only is None else only).items():
        nodes.append(Node(name, ("core_contacts", "contacts_quarantine"), lambda t, name=name, build=build: write_mart(
            build(t["core_contacts"], t["contacts_quarantine"], as_of), os.path.join(marts_root, name), as_of)))
    tables, state = run_graph(nodes, {"contacts_raw": raw, "contacts_quarantine": quarantine})
    tests = [tuple(r) for r in suite_results(tables).collect()]
    return Outcome(state, tests)


def outcome_rows(spark: SparkSession, out: Outcome) -> DataFrame:
    """``(node, check, column, failing_rows, status)``: a row for each node and for each test."""
    rows = [(n, "build", None, None, s) for n, s in out.nodes.items()] + out.tests
    return spark.createDataFrame(rows, "node string, check string, column string, failing_rows long, status string")
