import re

import pytest
from conftest import SF, same

from barline import plans
from barline.plans import resampled
from barline.sources import panels


@pytest.mark.parametrize("name", sorted(plans.ORACLE_SQL))
def test_query_matches_sql(spark, name):
    same(spark, plans.QUERIES[name], plans.ORACLE_SQL[name])


@pytest.mark.parametrize("name", sorted(set(plans.QUERIES) - set(plans.ORACLE_SQL)))
def test_query_without_sql_gives_rows(spark, name):
    assert plans.QUERIES[name](spark, SF).count() > 0


def test_months_without_difference_are_no_wins(spark):
    """On these tables a month's differences add up to 0, which sums of doubles miss by their order."""
    name, sf = "l07_arm_comparison", "/root/testdata/sf0.1"
    same(spark, plans.QUERIES[name], plans.ORACLE_SQL[name], sf)


@pytest.mark.parametrize("name", ["f14_nested_choice", "l10_overfit_splits"])
def test_arm_days_are_worked_out_once(spark, name):
    """Their users read the written rows; the panel behind them is not in their plan."""
    assert "l_shipdate" not in plans.QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()


def test_panel_has_more_parts_for_more_rows(spark, monkeypatch):
    """However many rows there are, a task of a panel query takes as many."""
    monkeypatch.setattr(panels, "ROWS", 500)
    rows = spark.read.parquet(f"{SF}/lineitem.parquet").count()
    frame = panels.panel(spark, SF)
    dealt = re.findall(r"Exchange hashpartitioning\((\w+)#\d+L?, (\d+)\)", frame._jdf.queryExecution().executedPlan().toString())
    assert ("l_suppkey", str(-(-rows // 500))) in dealt
    for name in ("a17_keyed_upsert", "a18_first_wins"):
        assert "hashpartitioning(l_suppkey#" in (plan := plans.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()) and f", {-(-rows // 500)})" in plan
        same(spark, plans.QUERIES[name], plans.ORACLE_SQL[name])


def test_arm_days_are_narrowed_in_the_panels_parts(spark, monkeypatch):
    """Of an arm's rows of a day, a part hands on the first five only; before that the panel is shuffled once, by code."""
    sf, frames, limit = "/root/testdata/sf0.1", [], "spark.sql.autoBroadcastJoinThreshold"
    monkeypatch.setattr(panels, "ROWS", 20_000)
    monkeypatch.setattr(resampled, "written", lambda rows, name: frames.append(rows) or rows)
    before = spark.conf.get(limit)
    spark.conf.set(limit, "1m")  # as on larger tables, where the bars are too large to be broadcast
    try:
        resampled.arm_days(spark, sf)
        plan = re.sub(r"#\d+L?", "", frames[0]._jdf.queryExecution().executedPlan().toString())
    finally:
        spark.conf.set(limit, before)
    parts = -(-spark.read.parquet(f"{sf}/lineitem.parquet").count() // 20_000)
    assert re.findall(r"Exchange hashpartitioning\(([\w, ]+), (\d+)\)", plan) == [("arm, date", "4"), ("l_suppkey", str(parts)), ("code", str(parts))]  # the last one deals the table of codes
    assert re.search(r"Exchange hashpartitioning\(arm, date, \d+\)[^\n]*\n[^\n]*WindowGroupLimit \[arm, date\], [^\n]*, 5, Partial", plan)
    monkeypatch.undo()
    same(spark, plans.QUERIES["l10_overfit_splits"], plans.ORACLE_SQL["l10_overfit_splits"])


@pytest.mark.parametrize(("name", "keys"), [("m10_buyers_of_a_day", ["l_orderkey", "buyer", "code, day"]), ("b22_reweighted_score", ["date"])])
def test_buyers_and_days_have_more_parts_for_more_rows(spark, monkeypatch, name, keys):
    monkeypatch.setattr(panels, "ROWS", 500)
    parts = -(-spark.read.parquet(f"{SF}/lineitem.parquet").count() // 500)
    plan = re.sub(r"#\d+L?", "", plans.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString())
    assert all(f"Exchange hashpartitioning({k}, {parts})" in plan for k in keys)
    same(spark, plans.QUERIES[name], plans.ORACLE_SQL[name])


def test_rows_of_conformal_values_are_worked_out_once(spark):
    plan = plans.QUERIES["l15_conformal"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "l_suppkey" not in plan


def test_rows_of_the_linear_models_are_worked_out_once(spark):
    """Learning and scoring read the written features; the panel is in neither's plan."""
    plan = plans.QUERIES["k05_hits"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "l_shipdate" not in plan
