"""Registered queries against their SQL on the smallest sample."""

import os
import re
from datetime import date

import duckdb
import pytest

import __spark_entry__ as entry
from tallyroom.sources.sample import PARQUET
from tools.check import norm

FOLDER = "/root/testdata/sf0.001"
SAMPLE = ["scan_cross_layer", "read_gather_collect", "sink_upsert", "sink_bom_lines", "join_in_list", "join_text_contains",
          "win_share_of_total", "win_dense_rank", "v_category_market_signal", "v_pipeline_priority_candidates",
          "v_triage_similarity_candidates", "v_store_campaign_current", "v_recipe_cogs", "v_recipe_workbench",
          "v_recipe_formulation_context", "p_shelf_life_risk", "p_demand_plan", "p_ops_evidence", "complaint_clusters",
          "campaign_final_plan", "pipeline_rank", "recipe_what_if", "hier_rollup", "vector_neighbors", "st_sliding_14d"]

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="sample data not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in PARQUET:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return c


def test_every_query_has_a_check():
    """All but the optional training-data queries, whose own tests hold them against brute force."""
    unchecked = set(entry.queries()) - set(entry.oracle_sql())
    assert not {k for k in unchecked if not re.fullmatch(r"op\d+_\w+|pipeline", k)}
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("key", SAMPLE)
def test_matches_sql(spark, con, key):
    df = entry.queries()[key](spark, FOLDER)
    cols = sorted(df.columns)
    got = sorted(tuple(norm(v) for v in r) for r in df.select(*cols).collect())
    cur = con.execute(entry.oracle_sql()[key])
    names = [d[0] for d in cur.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    assert sorted(names) == cols
    assert got == sorted(tuple(norm(r[i]) for i in order) for r in cur.fetchall())


@pytest.mark.parametrize("key", ["v_recipe_workbench", "v_recipe_formulation_context", "campaign_expansion_gap",
                                 "v_review_complaint_candidates", "v_idea_priority_inputs", "join_in_list", "name_similarity"])
def test_no_pairing_joins(spark, key):
    plan = entry.queries()[key](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_filters_and_columns_reach_the_scan(spark):
    plan = entry.queries()["filter_trailing_days"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" not in plan and "o_totalprice" not in plan
    plan = entry.queries()["filter_range"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_quantity,10.0)" in plan


def test_conditions_on_days_reach_the_scan(spark, tmp_path):
    from tallyroom.operators import gather
    from tallyroom.plans import compliance

    spark.range(10).selectExpr("CAST(id AS STRING) AS k", "DATE '2026-01-01' + CAST(id AS INT) AS expires_on", "id AS v").write.parquet(
        str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t"))
    spec = {"group_by": ["k"], "agg": [{"as": "v", "op": "sum", "col": "v"}],
            "filter_rows": {"compute": [{"as": "left", "days_until": "expires_on"}],
                            "where": [{"field": "left", "op": "gte", "value": 2}, {"field": "left", "op": "lte", "value": 4}]}}
    for df, count, pushed in ((gather.rollup(rows, spec, date(2026, 1, 1)), 3, ["GreaterThanOrEqual(expires_on", "LessThan(expires_on"]),
                              (compliance.expiry_within(rows, "expires_on", date(2026, 1, 1), 5), 6, ["LessThan(expires_on"])):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert df.count() == count and all(p in plan for p in pushed)


def test_history_is_dropped_before_it_is_summed(spark):
    """The newest day per store is found first; the sum comes after the semi-join."""
    plan = entry.queries()["p_shelf_life_risk"](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("LeftSemi") > plan.index("total_available")


def test_shared_rows_are_made_once(spark):
    """The plan reads the written ladder, not the ads; the board reads the written stock rows."""
    plan = entry.queries()["campaign_final_plan"](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert "l_extendedprice" not in plan and "l_discount" not in plan
    board = entry.queries()["kpi_status"](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert "report_date" not in board


def test_ad_rows_move_once(spark):
    """Both groupings of the history use one partitioning by campaign and month."""
    plan = entry.queries()["v_store_campaign_history"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert sum("hashpartitioning(" in x and "campaign_id" in x for x in plan.splitlines()) == 1


def _plan(spark, key):
    return entry.queries()[key](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", ["v_recipe_workbench", "dq_truncation_check"])
def test_recipe_lines_move_before_the_board_is_planned(spark, key):
    """The board reads lines in buckets by recipe; the lines themselves are neither scanned nor moved again."""
    plan = _plan(spark, key)
    assert "l_partkey" not in plan and "l_orderkey" not in plan and "Bucketed: true" in plan
    moved = [x for x in plan.splitlines() if "Exchange hashpartitioning(recipe_id" in x or "Exchange hashpartitioning(ingredient_id" in x]
    assert len(moved) <= 2  # the recipes' statuses, for lines and for candidates


def test_candidates_are_packed_in_the_recipes_row(spark):
    plan = _plan(spark, "v_recipe_formulation_context")
    assert "l_partkey" not in plan and "Bucketed: true" in plan and "Generate" not in plan


def test_disk_holds_one_source_of_the_board_at_a_time(spark):
    """The board's plan moves nothing: each source's row was written before the next source began."""
    plan = _plan(spark, "kpi_status")
    assert "Exchange" not in plan and "lineitem" not in plan
