"""Plan-shape rules every registered query must keep (the scale contract)."""

import re

import pytest

from conftest import SF_SMALL
from runway.catalog import QUERIES

FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct",
             "BroadcastNestedLoopJoin", "FlatMapGroupsInPandas")
SAFE_BELOW_SINGLE = ("partial_", "TakeOrderedAndProject", "LocalLimit")


def _plan(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_rules(spark, name):
    plan = _plan(spark, name)
    for bad in FORBIDDEN:
        assert bad not in plan, f"{name}: {bad}"
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            below = lines[i + 1]
            assert any(s in below for s in SAFE_BELOW_SINGLE), f"{name}: {below}"
    # each source table is scanned at most once
    scans = re.findall(r"FileScan parquet .*?Location: \S+\((\d+) paths\)\[([^\]]+)\]", plan)
    tables = [loc for _, loc in scans if "runway-scratch" not in loc]
    assert len(tables) == len(set(tables)), f"{name}: {tables}"


def test_scan_reads_only_needed_columns(spark):
    plan = _plan(spark, "busiest_route")
    scans = re.findall(r"FileScan parquet .*?Location: \S+\((\d+) paths\)\[([^\]]+)\]", plan)
    assert len(scans) == 4          # lineitem, supplier, orders, customer: once each
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
    assert "struct<l_orderkey:bigint,l_suppkey:bigint>" in schemas
    assert all("l_extendedprice" not in s and "o_totalprice" not in s for s in schemas)


def test_filters_reach_the_scan(spark):
    plan = _plan(spark, "fuel_by_year")
    assert "PushedFilters" in plan
    plan = QUERIES["busiest_route_one_year"](spark, SF_SMALL)._jdf.queryExecution() \
        .optimizedPlan().toString()
    assert "1997" in plan


def test_route_analyses_read_the_count_table_only(spark):
    for name in ("carriers_on_top_routes", "carrier_route_vs_total"):
        scans = re.findall(r"FileScan parquet .*?Location: \S+\(\d+ paths\)\[([^\]]+)\]", _plan(spark, name))
        assert scans and all("runway-scratch" in s for s in scans)


def test_top_k_is_pushed_below_the_sql_window(spark):
    plan = _plan(spark, "top5_routes_sql")
    w = plan.index("Window")
    assert "TakeOrderedAndProject" in plan[w:]


def test_stored_trips_prune_year_partitions(spark):
    from runway.session import scratch_path
    from runway.sources import roles
    from runway.sources.store import load_stored, store_partitioned
    path = scratch_path(spark, "trips-by-year")
    store_partitioned(roles.trips(spark, SF_SMALL), path, partition_by=("year",))
    plan = load_stored(spark, path).where("year = 1997")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*year[^\]]*= 1997", plan), plan


def test_package_source_avoids_slow_or_unsafe_calls():
    import pathlib
    root = pathlib.Path(__file__).resolve().parent.parent / "runway"
    banned = ("localCheckpoint(", "crossJoin(", "pandas_udf", "F.udf(", "@udf", ".rdd.",
              ".cache()", ".persist(", ".collect()")
    for p in root.rglob("*.py"):
        if p.parent.name == "llm":  # its own rules are tested with it
            continue
        src = p.read_text()
        for b in banned:
            assert b not in src, f"{p.name}: {b}"


def test_public_functions_are_documented():
    import inspect
    import runway
    missing = [n for n, f in vars(runway).items()
               if inspect.isfunction(f) and not n.startswith("_") and not (f.__doc__ or "").strip()]
    assert not missing, missing
