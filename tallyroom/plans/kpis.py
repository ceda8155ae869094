"""Indicators, their board and the goal roll-up.

Indicators that read the same table share one aggregate, so the board scans
each source once.
"""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroom.constants import GOAL_KPIS, GOALS, KPI_TARGETS, OPS_BAR, OPS_RX, PRODUCT_RX
from tallyroom.functions import days_until, in_trailing_days, list_size, matches_any, safe_divide, share_pct, sum_if
from tallyroom.plans.ideas import v_idea_priority_inputs
from tallyroom.plans.inventory import newest_per_store, sold, v_stocked_at
from tallyroom.plans.marketing import v_store_campaign_current
from tallyroom.plans.products import product_facets
from tallyroom.sources.readers import literal_table
from tallyroom.sources.sinks import written_once


def listing_kpis(t, as_of) -> DataFrame:
    return t.listing_package.where("is_active").agg(
        share_pct(F.col("blocking_gaps") == "").alias("kpi_listing_ready_share"),
        F.round(F.avg(list_size("blocking_gaps")), 2).alias("kpi_blocking_gaps_per_sku"),
        share_pct(F.col("allergen_underdeclared").isNotNull()).alias("kpi_allergen_underdeclaration"),
        share_pct(F.col("ingredient_source") == "own").alias("kpi_own_recipe_share"),
        share_pct(~F.col("nutrient_basis").isin("unknown", "no_panel")).alias("kpi_panel_basis_known"),
        share_pct(F.col("mandatory_nutrients_blank").isNull()).alias("kpi_mandatory_nutrients"))


def claim_kpis(t, as_of) -> DataFrame:
    return t.listing_claim_check.agg(
        share_pct(F.col("verdict") == "substantiated").alias("kpi_claim_substantiation"),
        F.count_if(F.col("verdict").isin("MISMATCH", "CONTRADICTED", "MALFORMED_CLAIM")).alias("kpi_contradicted_claims"))


def stock_kpis(t, as_of, stocked: DataFrame | None = None) -> DataFrame:
    return (v_stocked_at(t) if stocked is None else stocked).agg(F.sum("qty_expiring_within_risk_days").alias("kpi_wastage_risk"),
                                                                 F.sum("expired_stock").alias("kpi_expired_stock_units"))


def expiry_value_kpi(t, as_of, stocked: DataFrame | None = None) -> DataFrame:
    per_sku = (v_stocked_at(t) if stocked is None else stocked).groupBy(F.col("sku_id").alias("sku")).agg(
        F.sum("qty_expiring_within_risk_days").cast("decimal(20,2)").alias("q"))
    cost = product_facets(t).select("sku", F.col("total_cogs_inr").cast("decimal(18,3)").alias("c"))
    return per_sku.join(cost, "sku").agg(F.round(F.sum(F.col("q") * F.col("c")), 0).alias("kpi_expiry_value_at_risk"))


def low_stock_kpis(t, as_of, stocked: DataFrame | None = None) -> DataFrame:
    limits = t.low_stock_config.select("sku_id", F.col("store_id").alias("master_store_id"), "min_count",
                                       "absolute_risk_count")
    return (v_stocked_at(t) if stocked is None else stocked).join(limits, ["sku_id", "master_store_id"]).agg(
        share_pct(F.col("total_stock") <= F.col("min_count")).alias("kpi_low_stock_rate"),
        F.count_if(F.col("total_stock") <= F.col("absolute_risk_count")).alias("kpi_critical_low_count"))


def sell_through_kpi(t, as_of) -> DataFrame:
    held = F.col("available_quantity") > 0
    stock = newest_per_store(t, [F.sum(F.when(held, F.col("available_quantity"))).alias("on_hand"),
                                 F.min(F.when(held, F.col("expiry_date"))).alias("soonest")])
    forecast = (t.forecast_results.where(F.col("is_latest_forecast") & F.col("days_ahead").between(1, 3))
                .groupBy(F.col("master_store_id").alias("store_id"), F.col("sku_id").alias("product_sku"))
                .agg(F.sum("predicted_sales_quantity").alias("fc3")))
    return (stock.where(days_until("soonest", as_of).between(0, 3))
            .join(forecast, ["store_id", "product_sku"], "left")
            .agg(F.round(F.avg(F.col("on_hand") - F.coalesce("fc3", F.lit(0.0))), 1).alias("kpi_sell_through_gap")))


def review_kpis(t, as_of) -> DataFrame:
    recent = in_trailing_days("review_date", as_of, 90)
    low = recent & (F.col("star_rating") <= 3)
    return t.customer_review_events.agg(
        F.round(F.avg("star_rating"), 6).alias("kpi_avg_store_rating"),
        F.round(safe_divide(F.count_if(low) * F.lit(100.0), F.count_if(recent)), 1).alias("kpi_low_rating_share"))


def complaint_kpis(t, as_of) -> DataFrame:
    """Both complaint indicators from one count per store."""
    per_store = (t.customer_complaint_events.where(in_trailing_days("complaint_received_at", as_of, 60))
                 .groupBy("master_store_id")
                 .agg(F.count_if(matches_any("issue_type", OPS_RX)).alias("ops"), F.count("*").alias("n")))
    return per_store.agg(
        F.round(safe_divide(F.sum("ops") * F.lit(100.0), F.sum("n")), 1).alias("kpi_ops_complaint_share"),
        F.count_if(F.col("ops") >= OPS_BAR).alias("kpi_stores_over_bar"))


def near_expiry_kpi(t, as_of) -> DataFrame:
    complaints = t.customer_complaint_events.where(
        in_trailing_days("complaint_received_at", as_of, 60) & matches_any("issue_type", PRODUCT_RX)
        & F.col("order_id").isNotNull()).select(F.col("order_id").alias("online_order_id"))
    # only lines of these complaints, and only their stock and limits, are made distinct, summed and moved on
    lines = (sold(t).select("online_order_id", "store_id", "sku_id", "order_date")
             .join(complaints.distinct(), "online_order_id", "left_semi").distinct())
    held = written_once(complaints.join(lines, "online_order_id").select("store_id", "sku_id", "order_date"), "kpi-traced")
    batch = (t.order_day_inventory.where(F.col("available_quantity") > 0)
             .select("store_id", F.col("product_sku").alias("sku_id"), F.col("snapshot_date").alias("order_date"), "expiry_date")
             .join(held.distinct(), ["store_id", "sku_id", "order_date"], "left_semi")
             .groupBy("store_id", "sku_id", "order_date").agg(F.min("expiry_date").alias("soonest")))
    limits = t.low_stock_config.select("store_id", "sku_id", "min_days_shelf_life").join(
        held.select("store_id", "sku_id").distinct(), ["store_id", "sku_id"], "left_semi")
    traced = (written_once(held.join(batch, ["store_id", "sku_id", "order_date"], "left"), "kpi-traced")
              .join(limits, ["store_id", "sku_id"], "left"))
    left = F.datediff("soonest", "order_date")
    return traced.agg(share_pct(F.coalesce(left <= F.coalesce("min_days_shelf_life", F.lit(2)), F.lit(False)))
                      .alias("kpi_near_expiry_complaints"))


def forecast_accuracy_kpi(t, as_of) -> DataFrame:
    keys = ["sku_id", "store_id", "d"]
    predicted = (t.forecast_results.where(F.col("is_latest_forecast")
                                          & in_trailing_days("forecast_date", as_of, 30))
                 .groupBy("sku_id", F.col("master_store_id").alias("store_id"), F.col("forecast_date").alias("d"))
                 .agg(F.sum("predicted_sales_quantity").alias("predicted")))
    actual = (sold(t).where(in_trailing_days("order_date", as_of, 30))
              .groupBy("sku_id", "store_id", F.col("order_date").alias("d")).agg(F.sum("quantity").alias("actual")))
    error = F.abs(safe_divide(F.col("predicted") - F.col("actual"), "actual"))
    return predicted.join(actual, keys).where(F.col("actual") > 0).agg(
        F.round(100 - F.avg(error) * 100, 1).alias("kpi_forecast_accuracy"))


def forecast_coverage_kpi(t, as_of) -> DataFrame:
    return t.forecast_results.where("is_latest_forecast").agg(
        F.datediff(F.max("forecast_date"), F.lit(as_of)).cast("bigint").alias("kpi_forecast_coverage"))


def campaign_kpis(t, as_of) -> DataFrame:
    wasted = (F.coalesce("roi", F.lit(0.0)) == 0) & (F.col("ad_spend_rs") >= 200)
    return v_store_campaign_current(t, as_of).agg(
        F.round(safe_divide(F.sum("ad_sales_rs"), F.sum("ad_spend_rs")), 2).alias("kpi_blended_roi"),
        F.round(sum_if(wasted, "ad_spend_rs", otherwise=0.0), 0).alias("kpi_zero_return_spend"),
        F.round(F.avg(F.col("overall_m2o_pct") - F.col("ads_m2o_pct")), 1).alias("kpi_ads_conversion_gap"))


def margin_kpi(t, as_of) -> DataFrame:
    money = "decimal(18,3)"
    return product_facets(t).where(F.col("is_active") & (F.col("mrp_inr") > 0)).agg(
        F.round(safe_divide(F.sum(F.col("mrp_inr").cast(money) - F.col("total_cogs_inr").cast(money)),
                            F.sum(F.col("mrp_inr").cast(money))) * 100, 1).alias("kpi_margin_pct"))


def brief_kpis(t, as_of) -> DataFrame:
    return v_idea_priority_inputs(t, as_of).agg(
        F.round(F.avg("days_in_stage"), 1).alias("kpi_pipeline_aging"),
        F.count_if(F.col("days_in_stage") >= 90).alias("kpi_stalled_briefs"),
        share_pct((F.col("cogs_fit") != "UNKNOWN") & F.col("days_in_stage").isNotNull()).alias("kpi_brief_scorable_share"))


KPI_SOURCES = {
    listing_kpis: ["kpi_listing_ready_share", "kpi_blocking_gaps_per_sku", "kpi_allergen_underdeclaration",
                   "kpi_own_recipe_share", "kpi_panel_basis_known", "kpi_mandatory_nutrients"],
    claim_kpis: ["kpi_claim_substantiation", "kpi_contradicted_claims"],
    stock_kpis: ["kpi_wastage_risk", "kpi_expired_stock_units"],
    expiry_value_kpi: ["kpi_expiry_value_at_risk"],
    low_stock_kpis: ["kpi_low_stock_rate", "kpi_critical_low_count"],
    sell_through_kpi: ["kpi_sell_through_gap"],
    review_kpis: ["kpi_avg_store_rating", "kpi_low_rating_share"],
    complaint_kpis: ["kpi_ops_complaint_share", "kpi_stores_over_bar"],
    near_expiry_kpi: ["kpi_near_expiry_complaints"],
    forecast_accuracy_kpi: ["kpi_forecast_accuracy"],
    forecast_coverage_kpi: ["kpi_forecast_coverage"],
    campaign_kpis: ["kpi_blended_roi", "kpi_zero_return_spend", "kpi_ads_conversion_gap"],
    margin_kpi: ["kpi_margin_pct"],
    brief_kpis: ["kpi_pipeline_aging", "kpi_stalled_briefs", "kpi_brief_scorable_share"],
}


STOCKED = [stock_kpis, expiry_value_kpi, low_stock_kpis]  # read the latest stock rows


def on_target(value: Column, target: Column, comparison: Column) -> Column:
    """NULL value: not known, so NULL."""
    return F.when(comparison == "gte", value >= target).when(comparison == "lte", value <= target).when(
        comparison == "eq", value == target)


def kpi_rows(t, dates: dict, only: list[str] | None = None) -> DataFrame:
    """``(kpi, value)`` rows. ``dates`` maps a source function to its date, with
    ``None`` for the default. The latest stock rows are made once for all sources that read them, and each
    source's own row is written, so that disk holds the moved rows of one source at a time."""
    parts = []
    wanted_of = {source: [n for n in names if only is None or n in only] for source, names in KPI_SOURCES.items()}
    shared = {}
    if sum(bool(wanted_of[s]) for s in STOCKED) > 1:
        shared["stocked"] = written_once(v_stocked_at(t, [
            "sku_id", "master_store_id", "total_stock", "expired_stock", "qty_expiring_within_risk_days"]), "kpi-stocked")
    for source, wanted in wanted_of.items():
        if not wanted:
            continue
        # written one after the other: what one source has moved is cleared before the next begins
        wide = written_once(source(t, dates.get(source, dates[None]), **(shared if source in STOCKED else {})), "kpi-row")
        rows = F.array(*[F.struct(F.lit(n).alias("kpi"), F.col(n).cast("double").alias("value")) for n in wanted])
        parts.append(wide.select(F.inline(rows)))
    return reduce(DataFrame.unionByName, parts)


def kpi_status(rows: DataFrame) -> DataFrame:
    target = F.create_map(*[F.lit(x) for k, (v, _) in KPI_TARGETS.items() for x in (k, v)])
    compare = F.create_map(*[F.lit(x) for k, (_, c) in KPI_TARGETS.items() for x in (k, c)])
    return (rows.withColumn("target", target[F.col("kpi")]).withColumn("comparison", compare[F.col("kpi")])
            .withColumn("on_target", on_target(F.col("value"), F.col("target"), F.col("comparison"))))


def kpi_board(t, dates: dict, only: list[str] | None = None) -> DataFrame:
    return kpi_status(kpi_rows(t, dates, only))


def kpi_goal_rollup(board: DataFrame, spark) -> DataFrame:
    """Indicator status carried to its goal and every goal above it."""
    parents = dict(GOALS)

    def chain(goal):
        while goal:
            yield goal
            goal = parents[goal]

    pairs = sorted({(above, kpi) for goal, kpi, _ in GOAL_KPIS for above in chain(goal)})
    links = literal_table(spark, pairs, "goal string, kpi string")
    status = board.select("kpi", "value", "on_target")
    return links.join(status, "kpi").groupBy("goal").agg(
        F.count("*").alias("kpis"), F.count_if("on_target").alias("on_target"),
        F.count_if(F.col("on_target").isNull()).alias("unknown"))


def kpi_goal_values(measures: DataFrame, goal: str, period: str, kpi: str, value: str, op: str) -> DataFrame:
    """Per goal, indicator and period, the measures combined as the goal's
    metadata says (sum, avg or min)."""
    return (measures.groupBy(goal, kpi, op, period)
            .agg(F.sum(value).alias("__s"), F.avg(value).alias("__a"), F.min(value).alias("__m"))
            .withColumn("value", F.round(F.when(F.col(op) == "sum", F.col("__s")).when(F.col(op) == "avg", F.col("__a"))
                                         .otherwise(F.col("__m")), 4))
            .drop("__s", "__a", "__m"))
