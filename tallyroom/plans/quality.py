"""Data-quality checks and rowset audits. Every check is a violations table;
the report counts them in one pass each."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroom.constants import REPORT_MAX_AGE_DAYS
from tallyroom.functions import days_since, days_until, match_key
from tallyroom.operators.sets import union_rows
from tallyroom.plans.products import v_product_ingredient


def dq_unique(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("rows")).where("rows > 1")


def dq_resolves(live: DataFrame, live_key: str, master: DataFrame, master_key: str) -> DataFrame:
    """Live keys without a master row once case and blanks are normalised."""
    keys = live.groupBy(match_key(live_key).alias("k")).agg(F.count("*").alias("rows"))
    return keys.join(master.select(match_key(master_key).alias("k")).distinct(), "k", "left_anti")


def dq_bom_closed(t) -> DataFrame:
    """Active products without an ingredient."""
    return t.dim_product.where("is_active").join(v_product_ingredient(t), "sku", "left_anti").select("sku")


def dq_result_pass(t) -> DataFrame:
    return t.supplier_certificate.where(F.col("result") == "Fail").select("supplier_id", "certificate_id")


def dq_report_age(t, as_of: date) -> DataFrame:
    """Active products whose newest nutrition lab report is over a year old; one without a dated
    report is not listed, as it has no age."""
    newest = t.product_nutrition.groupBy("sku").agg(F.max("lab_reported_on").alias("reported_on"))
    return (t.dim_product.where("is_active").select("sku").join(newest, "sku")
            .withColumn("age_days", days_since("reported_on", as_of)).where(F.col("age_days") > REPORT_MAX_AGE_DAYS))


def dq_transfer_viable(t, as_of: date, km_per_day: float = 500.0, min_days_left: int = 2) -> DataFrame:
    """Stock whose life after the trip to the nearest store falls under the
    minimum: live batches of each store's newest snapshot, by their soonest expiry."""
    from tallyroom.operators.joins import nearest_link
    from tallyroom.plans.inventory import newest_rows, v_transfer_route

    route = nearest_link(v_transfer_route(t), "from_store_id", "to_store_id", "distance_km").select(
        F.col("from_store_id").alias("store_id"), F.col("to_store_id").alias("nearest_store_id"), "distance_km")
    stock = (newest_rows(t).where(F.col("expiry_date") >= F.lit(as_of)).groupBy("store_id", "product_sku")
             .agg(F.min("expiry_date").alias("expiry_date")))
    left = days_until("expiry_date", as_of) - F.ceil(F.col("distance_km") / km_per_day)
    return (stock.join(route, "store_id").withColumn("days_after_transit", left.cast("bigint"))
            .where(F.col("days_after_transit") < min_days_left)
            .select("store_id", "product_sku", "nearest_store_id", "days_after_transit"))


def dq_report(t, as_of: date) -> DataFrame:
    """Constraint, severity and number of violations."""
    checks = [
        ("product_sku_unique", "error", dq_unique(t.dim_product, "sku")),
        ("live_sku_resolves", "warning", dq_resolves(t.flagged_inventory, "sku_id", t.dim_product, "sku")),
        ("bom_must_close", "warning", dq_bom_closed(t)),
        ("quality_inspection_validity", "error", dq_result_pass(t)),
        ("nutrition_report_current", "info", dq_report_age(t, as_of)),
        ("channel_transfer_viability", "warning", dq_transfer_viable(t, as_of)),
    ]
    return union_rows(*[df.agg(F.count("*").alias("violations")).select(
        F.lit(name).alias("constraint_name"), F.lit(severity).alias("severity"), "violations")
        for name, severity, df in checks])


def dq_truncation_check(rowset: DataFrame, tag: str = "src", marker: str = "9_END",
                        by: list[str] = ()) -> DataFrame:
    """Whether each rowset still carries its end marker."""
    return rowset.groupBy(*by).agg(F.count("*").alias("rows"),
                                   F.max(F.col(tag) == marker).alias("is_complete"))


def dq_size_audit(rowset: DataFrame, tag: str, budget: int) -> DataFrame:
    """Characters per grain of a packed rowset against a budget. Row sizes are
    summed; the rows are never gathered into one text."""
    chars = F.length(F.to_json(F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
                                          for c in rowset.columns])))
    return (rowset.groupBy(tag).agg(F.count("*").alias("rows"), F.sum(chars).alias("chars"))
            .withColumn("over_budget", F.col("chars") > budget))
