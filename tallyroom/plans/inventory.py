"""Stock, expiry risk, demand planning and the store and product widgets."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroom.functions import days_until, ladder
from tallyroom.operators.gather import resolve_names
from tallyroom.operators.joins import nearest_link
from tallyroom.operators.ranking import top_n
from tallyroom.operators.snapshots import latest_row, latest_snapshot

STOCK_TIES = ["total_stock", "safe_stock", "expired_stock", "qty_expiring_within_risk_days", "soonest_expiry",
              "wastage_flag", "low_stock_flag", "shelf_life_days"]


STOCKED = ["sku_id", "master_store_id", "total_stock", "safe_stock", "expired_stock", "soonest_expiry",
           "qty_expiring_within_risk_days", "wastage_flag", "low_stock_flag", "shelf_life_days"]


def v_stocked_at(t, columns: list[str] = STOCKED) -> DataFrame:
    """Latest stock row per store and SKU. Rows that tie in every column wanted need no further
    tie-break, so columns after the last of these do not travel."""
    ties = STOCK_TIES[:1 + max((i for i, c in enumerate(STOCK_TIES) if c in columns), default=-1)]
    return latest_row(t.flagged_inventory, ["master_store_id", "sku_id"], "report_date", ties).select(*columns)


def v_transfer_route(t) -> DataFrame:
    return t.store_transfer_distances.select(
        F.col("from_store_id").cast("string").alias("from_store_id"),
        F.col("to_store_id").cast("string").alias("to_store_id"),
        F.col("distance_km").cast("double").alias("distance_km"), "preferred_for_transfer")


def names_of(df: DataFrame, key: str, name: str) -> DataFrame:
    return df.select(F.col(key).alias("id"), F.col(name).alias("name"))


def newest_rows(t, stores: DataFrame | None = None) -> DataFrame:
    """Batches of each store's newest snapshot; with ``stores`` (store_id), of those only.

    The newest day per store is one small aggregate; history is dropped by a semi-join
    before anything is summed.
    """
    stock = t.store_inventory_daily
    if stores is not None:
        stock = stock.join(stores.select("store_id").distinct(), "store_id", "left_semi")
    newest = stock.groupBy("store_id").agg(F.max("snapshot_date").alias("snapshot_date"))
    return stock.join(newest, ["store_id", "snapshot_date"], "left_semi")


def newest_per_store(t, value_cols: list, stores: DataFrame | None = None) -> DataFrame:
    """Rolled-up stock of each store's newest snapshot."""
    return newest_rows(t, stores).groupBy("store_id", "snapshot_date", "product_sku").agg(*value_cols)


def p_shelf_life_risk(t, as_of: date, stores: DataFrame | None = None) -> DataFrame:
    """At-risk (store, SKU) pairs of the newest snapshot, expired stock left out; with
    ``stores`` (store_id), of those stores only."""
    alive = days_until("expiry_date", as_of) >= 0
    stock = newest_per_store(t, [
        F.sum(F.when(alive, F.col("available_quantity"))).alias("total_available"),
        F.min(F.when(alive, F.col("expiry_date"))).alias("soonest_expiry"),
        F.count_if(alive & F.col("batch_row_number").isNotNull()).alias("batches"),
        F.count_if(alive).alias("live_rows")], stores).where("live_rows > 0").drop("live_rows", "snapshot_date")
    limits = t.low_stock_config.select(F.col("sku_id").alias("product_sku"), "store_id", "min_days_shelf_life",
                                       "min_count", "absolute_risk_count")
    days, qty = F.col("days_to_expiry"), F.col("total_available")
    short_life, low = days <= F.col("min_days_shelf_life"), qty <= F.col("min_count")
    risky = (stock.join(limits, ["store_id", "product_sku"], "left")
             .withColumn("days_to_expiry", days_until("soonest_expiry", as_of))
             .withColumn("risk_type", ladder((short_life & low, "both"), (short_life, "wastage"),
                                             (qty <= F.col("absolute_risk_count"), "critical_low"),
                                             (low, "low_stock"), otherwise="ok"))
             .where(F.col("risk_type") != "ok")
             .drop("min_days_shelf_life", "min_count", "absolute_risk_count"))
    named = resolve_names(risky, "store_id", names_of(t.master_store, "master_store_id", "store_name"), "store_name")
    named = resolve_names(named, "product_sku", names_of(t.dim_product, "sku", "display_name"), "product_name")
    return named.orderBy("days_to_expiry")


def p_demand_plan(t, as_of: date) -> DataFrame:
    """Three-day forecast against unexpired stock with one action per pair."""
    ahead = F.col("forecast_date").between(F.lit(as_of + timedelta(1)), F.lit(as_of + timedelta(3)))
    forecast = (t.forecast_results.where(F.col("is_latest_forecast") & ahead)
                .groupBy(F.col("master_store_id").alias("store_id"), F.col("sku_id").alias("product_sku"))
                .agg(F.sum("predicted_sales_quantity").alias("forecast_3d")))
    left = days_until("expiry_date", as_of)
    stock = newest_per_store(t, [
        F.sum(F.when(left >= 0, F.col("available_quantity"))).alias("available_quantity"),
        F.sum(F.when(left >= 0, F.when(left <= 3, F.col("available_quantity")).otherwise(0.0))).alias("expiring_qty"),
        F.min(F.when(left >= 0, F.col("expiry_date"))).alias("soonest_expiry"),
        F.count_if(left >= 0).alias("live_rows")]).where("live_rows > 0").drop("live_rows", "snapshot_date")
    nearest = nearest_link(v_transfer_route(t), "from_store_id", "to_store_id", "distance_km").select(
        F.col("from_store_id").alias("store_id"), F.col("to_store_id").alias("nearest_store_id"), "distance_km")
    plan = (forecast.join(stock, ["store_id", "product_sku"], "full")
            .fillna(0, ["available_quantity", "forecast_3d", "expiring_qty"])
            .join(nearest, "store_id", "left")
            .withColumn("days_to_expiry", days_until("soonest_expiry", as_of))
            .withColumn("forecast_units", F.greatest(F.ceil("forecast_3d"), F.lit(1)).cast("bigint")))
    expiring = F.col("expiring_qty") > 0
    plan = (plan.withColumn("action", ladder(
        (expiring & (F.col("days_to_expiry") <= 1), "liquidate"),
        (expiring & F.col("nearest_store_id").isNotNull(), "transfer"), (expiring, "liquidate"),
        (F.col("available_quantity") < F.col("forecast_3d"), "supply_factory"), otherwise="hold"))
        .where(F.col("action") != "hold").drop("forecast_3d"))
    stores = names_of(t.master_store, "master_store_id", "store_name")
    plan = resolve_names(plan, "store_id", stores, "store_name")
    plan = resolve_names(plan, "nearest_store_id", stores, "nearest_store_name")
    plan = resolve_names(plan, "product_sku", names_of(t.dim_product, "sku", "display_name"), "product_name")
    return plan.orderBy("days_to_expiry")


# ---- widgets, for all entities at once ------------------------------------------------------

def sold(t) -> DataFrame:
    return t.business_analytics.where(F.col("order_state") != "Cancelled")


def w_sales_by_sku(t, as_of: date) -> DataFrame:
    return (sold(t).where(F.col("order_date") >= F.trunc(F.lit(as_of), "MM"))
            .groupBy("store_id", "sku_id")
            .agg(F.min("item_source_name").alias("item_name"), F.sum("quantity").alias("quantity"),
                 F.sum("total").cast("double").alias("revenue")))


def w_available_by_store(t) -> DataFrame:
    """Per product and store the newest snapshot's quantity; rows are summed per
    day first."""
    per_day = t.store_inventory_daily.groupBy("product_sku", "store_id", "snapshot_date").agg(
        F.sum("available_quantity").alias("available_quantity"))
    return latest_row(per_day, ["product_sku", "store_id"], "snapshot_date").drop("snapshot_date")


def w_inventory_latest(t) -> DataFrame:
    """Every row of each store's newest snapshot."""
    return latest_snapshot(t.store_inventory_daily, ["store_id"], "snapshot_date")


def w_forecast_by_store(t) -> DataFrame:
    return (t.forecast_results.where(F.col("is_latest_forecast") & F.col("days_ahead").between(1, 3))
            .groupBy("sku_id", "master_store_id").agg(F.round(F.sum("predicted_sales_quantity"), 1).alias("forecast_qty")))


def top_per_entity(df: DataFrame, entity: str, by: str, n: int, ties: list[str]) -> DataFrame:
    return top_n(df, [entity], [F.col(by).desc_nulls_last(), *[F.asc(c) for c in ties]], n)
