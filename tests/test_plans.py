"""Plan-shape checks: the properties that matter at scale, asserted on the
physical plan with automatic broadcasts off (as if every table were huge)."""

import contextlib
import io
import re

import pytest

import __spark_entry__ as entry
from lunchbox.operators import calc
from lunchbox.periods import Period
from lunchbox.sources.builder import build_model, d

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def at_scale(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_flagship_has_two_shuffles_and_no_cross_join(at_scale):
    plan = plan_of(entry.queries()["monthly_purchase"](at_scale, SF))
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 2
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert "Window" not in plan
    # the fact union is aggregated map-side before its shuffle
    assert re.search(r"HashAggregate\(keys=\[employee_id#\d+L?\], functions=\[partial_", plan)
    # the only single-partition exchange is the one-row subquery for the part table's key range
    assert len(re.findall(r"Exchange SinglePartition", plan)) == 1


def test_employee_side_of_the_shuffle_carries_keys_only(at_scale):
    plan = formatted(entry.queries()["monthly_purchase"](at_scale, SF))
    inputs = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[([^\]]*)\]\nArguments: hashpartitioning", plan)
    emp_side = [i for i in inputs if "registration" in i]
    assert len(emp_side) == 1
    cols = sorted(c.split("#")[0] for c in emp_side[0].split(", "))
    assert cols == ["employee_id", "registration", "union_id"]


def test_orders_scanned_once_by_the_flagship(at_scale):
    plan = formatted(entry.queries()["monthly_purchase"](at_scale, SF))
    assert len(re.findall(r"Location: InMemoryFileIndex \[[^\]]*orders\.parquet\]", plan)) == 1
    assert "PushedFilters: [Or(" in plan
    # every generator (period attach, event split) runs inside whole-stage codegen
    assert re.findall(r"\(\d+\) Generate", plan) and not re.findall(r"\(\d+\) Generate\n", plan)


def test_single_scan_path_equals_table_path(spark):
    from lunchbox.sources.testdata import catalog
    m = catalog(spark, "/root/testdata/sf0.01")
    one = sorted(tuple(r) for r in calc.monthly_purchase(m).collect())
    per_table = sorted(tuple(r) for r in calc.monthly_purchase(m.with_tables(events=None)).collect())
    assert one == per_table and len(one) > 500


def test_event_filters_reach_the_scan(at_scale):
    df = entry.queries()["monthly_purchase"](at_scale, SF)
    plan = formatted(df)
    assert "EqualTo(o_orderstatus,F)" in plan
    assert "EqualTo(o_orderpriority,1-URGENT)" in plan
    # column pruning: the orders scan reads only what it uses
    scans = re.findall(r"ReadSchema: struct<([^>]*o_orderkey[^>]*)>", plan)
    assert scans and all("o_totalprice" not in s for s in scans)


def test_hot_employee_in_every_feed(spark):
    """One employee holds a third of every feed: results stay exact."""
    p = Period(d("2025-04-15"), d("2025-05-15"))
    hot, n = 1, 300
    emps = [(i, 1000 + i, 1, "ANALISTA", 1, "Trabalhando", None, None) for i in range(1, n + 1)]
    vac = [(k, hot if k % 3 == 0 else 2 + k % (n - 1), p.start, p.end, 1) for k in range(900)]
    hires = [(k, hot if k % 3 == 0 else 2 + k % (n - 1), d("2025-04-20") if k != 897 else d("2025-05-01"))
             for k in range(900)]
    m = build_model(spark, p, states=[(1, "S", "SS", "35.00")], unions=[(1, "U full", "U", 1)],
                    working_days=[(1, p.start, p.end, 400)], employees=emps, vacations=vac, hires=hires)
    rows = {r["employee_id"]: r for r in calc.purchase_calc(m).collect()}
    assert len(rows) == n
    # hot: 300 vacation days; last hire row (id 897) wins: 15 of 31 days
    assert rows[hot]["vacation_days"] == 300
    assert rows[hot]["effective_hire_date"] == d("2025-05-01")
    assert rows[hot]["employee_hire_date"] == d("2025-04-20")
    assert rows[hot]["days"] == round(100 * 15 / 31)


def test_single_scan_path_equals_table_path_over_several_periods(spark):
    from lunchbox.periods import Period
    from lunchbox.sources.testdata import catalog
    m = catalog(spark, "/root/testdata/sf0.01")
    ps = [Period(d("1998-03-15"), d("1998-04-15")), m.period, Period(d("1998-04-20"), d("1998-05-19"))]
    cols = ["employee_id", "period_label", "days", "total", "notes", "vacation_days", "on_leave"]
    one = sorted(repr(tuple(r)) for r in calc.purchase_calc(m, ps).select(cols).collect())
    per_table = sorted(repr(tuple(r)) for r in
                       calc.purchase_calc(m.with_tables(events=None), ps).select(cols).collect())
    assert one == per_table
    labels = {r["period_label"] for r in calc.purchase_calc(m, ps).select("period_label").collect()}
    assert labels == {"04/1998", "05/1998"}


def test_three_period_run_keeps_one_shuffle_join(at_scale):
    plan = plan_of(entry.queries()["monthly_purchase_periods"](at_scale, SF))
    assert len(re.findall(r"SortMergeJoin", plan)) == 1
    assert "CartesianProduct" not in plan
    # the only nested loop is the broadcast holiday list of the calendar
    assert len(re.findall(r"BroadcastNestedLoopJoin", plan)) <= 1


def test_twenty_four_periods_equal_single_runs(spark):
    from lunchbox.sources.testdata import catalog
    m = catalog(spark, SF)
    ps = [Period(d(f"{1996 + k // 12}-{k % 12 + 1:02d}-15"), d(f"{1996 + (k + 1) // 12}-{(k + 1) % 12 + 1:02d}-15")) for k in range(24)]
    cols = ["employee_id", "period_start", "days_after_hire", "days", "notes", "vacation_days"]
    together = sorted(repr(tuple(r)) for r in calc.purchase_calc(m, ps).select(cols).collect())
    single = sorted(repr(tuple(r)) for p in ps[::6] for r in calc.purchase_calc(m, [p]).select(cols).collect())
    starts = {repr(p.start) for p in ps[::6]}
    assert [r for r in together if any(s in r for s in starts)] == single and len(together) > 24 * 100


@pytest.mark.parametrize("n", [1, 24])
def test_periods_do_not_multiply_rows_before_the_shuffle(at_scale, n):
    from lunchbox.sources.testdata import catalog
    m = catalog(at_scale, SF)
    ps = [Period(d(f"{1990 + k}-04-15"), d(f"{1990 + k}-05-15")) for k in range(n)]
    plan = plan_of(calc.purchase_calc(m, ps))
    # below the join's two exchanges nothing is generated but the events of an order
    join = plan.index("SortMergeJoin")
    assert plan[join:].count("Generate") == 1 and plan[:join].count("Generate explode") == 1
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 2


@pytest.mark.parametrize("name", ["dq_foreign_keys", "dq_unmatched", "kpi_counts", "table_counts"])
def test_reference_counts_take_one_aggregation(at_scale, name):
    plan = plan_of(entry.queries()[name](at_scale, SF))
    # the sheets of dq_unmatched and the jobs of kpi_counts are all broadcast or columns of the feeds
    assert len(re.findall(r"Exchange hashpartitioning", plan)) <= 3
    assert "SortMergeJoin" not in plan
