"""Complaint events, tracing and escalation."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroom.constants import (CONDITION_TERMS, LATE_TERMS, OPS_BAR, OPS_CATEGORIES, OPS_TERMS, PRODUCT_RX,
                                 ROOT_CAUSE_CLASSES, SPAN_DAYS, SPAN_MIN_REVIEWS, WRONG_MISSING_TERMS)
from tallyroom.functions import contains_any, day_index, in_trailing_days, ladder, match_key, matches_any
from tallyroom.operators.joins import join_many, join_same_day, left_join
from tallyroom.operators.ranking import best_span, top_n
from tallyroom.plans.products import v_review_complaint_candidates


def v_complaint_events(t) -> DataFrame:
    return t.customer_complaint_events.withColumn("event_id", F.coalesce("event_id", "email_message_id"))


def v_complaint_resolved(t) -> DataFrame:
    products = t.dim_product.select(F.col("sku").alias("sku_id"), match_key("display_name").alias("k"))
    events = v_complaint_events(t).select("event_id", match_key("item_name").alias("k"))
    return join_many(events, products, ["k"], "event_id").select("event_id", "sku_id")


def issue_class(c="issue_type"):
    return ladder(*[(contains_any(c, terms), name) for name, terms in ROOT_CAUSE_CLASSES], otherwise="Review")


def p_complaint_root_cause(t, as_of: date, complaint_days: int = 7, order_days: int = 14) -> DataFrame:
    """Recent complaints traced to their order lines and to the stock held in
    that store on the order day."""
    complaints = (v_complaint_events(t).where(F.col("complaint_received_at") >= F.lit(as_of - timedelta(complaint_days)))
                  .select(F.col("order_id").alias("online_order_id"), "master_store_id", "issue_type", "item_name",
                          "customer_comments", "complaint_received_at"))
    lines = (t.business_analytics.where(F.col("order_date") >= F.lit(as_of - timedelta(order_days)))
             .select("online_order_id", "store_id", "sku_id", "item_source_name", "order_date"))
    stock = (t.order_day_inventory
             .where((F.col("available_quantity") > 0) & (F.col("snapshot_date") >= F.lit(as_of - timedelta(order_days))))
             .groupBy("store_id", F.col("product_sku").alias("sku_id"), F.col("snapshot_date").alias("order_date"))
             .agg(F.min("expiry_date").alias("earliest_expiry_that_day"),
                  F.sum("available_quantity").alias("inventory_that_day")))
    limits = t.low_stock_config.select("store_id", "sku_id", "min_days_shelf_life")
    # complaints without an order, or whose order is unknown, have no store and SKU to match
    apart = ["complaint_received_at", "customer_comments", "item_name"]
    traced = left_join(complaints, lines, ["online_order_id"], apart)
    traced = join_same_day(traced, stock, {"store_id": "store_id", "sku_id": "sku_id", "order_date": "order_date"}, apart)
    traced = left_join(traced, limits, ["store_id", "sku_id"], apart)
    stores = t.master_store.select("master_store_id", "store_name")
    products = t.dim_product.select(F.col("sku").alias("sku_id"), F.col("display_name").alias("product_name"))
    named = left_join(left_join(traced, stores, ["master_store_id"], apart), products, ["sku_id"], apart)
    return (named
            .select("master_store_id", "store_name", F.col("complaint_received_at").alias("complaint_date"),
                    F.col("customer_comments").alias("complaint"), "issue_type",
                    F.col("item_name").alias("complaint_item"), F.col("item_source_name").alias("order_item"),
                    "sku_id", "product_name", "order_date", "earliest_expiry_that_day", "inventory_that_day",
                    "min_days_shelf_life", issue_class().alias("category"))
            .orderBy("complaint_date"))


def p_store_reviews(t, as_of: date, days: int = 30) -> DataFrame:
    return (t.customer_review_events.where(F.col("review_date") >= F.lit(as_of - timedelta(days)))
            .join(t.master_store.select("master_store_id", "store_name"), "master_store_id", "left")
            .select("master_store_id", "store_name", F.col("star_rating").alias("rating"),
                    F.col("review_text").alias("review"), F.col("review_date").cast("date").alias("review_date"),
                    F.col("customer_name").alias("customer"),
                    F.when(F.col("star_rating") <= 3, "low").otherwise("ok").alias("rating_band")))


def ops_counts(t, as_of: date, days: int = 60) -> DataFrame:
    """Last-mile complaint counts per store; all five come from one aggregate."""
    def hits(terms):
        return F.count_if(contains_any("issue_type", terms))

    return (t.customer_complaint_events.where(in_trailing_days("complaint_received_at", as_of, days))
            .groupBy("master_store_id")
            .agg(hits(OPS_TERMS).alias("ops_complaints"), hits(LATE_TERMS).alias("late_delivery"),
                 hits(CONDITION_TERMS).alias("bad_condition"), hits(WRONG_MISSING_TERMS).alias("wrong_missing"),
                 F.count("master_store_id").alias("total_complaints")))


def p_ops_concentration(t, as_of: date, days: int = 60, bar: int = OPS_BAR) -> DataFrame:
    """Stores at or over the bar, worst first."""
    return (ops_counts(t, as_of, days).where(F.col("ops_complaints") >= bar)
            .join(t.master_store.select("master_store_id", "store_name"), "master_store_id", "left")
            .orderBy(F.desc("ops_complaints")))


def p_ops_evidence(t, as_of: date, days: int = 60, bar: int = OPS_BAR) -> DataFrame:
    """The classified last-mile complaints of the stores over the bar."""
    category = ladder(*[(contains_any("issue_type", terms), name) for name, terms in OPS_CATEGORIES])
    counts = ops_counts(t, as_of, days).where(F.col("ops_complaints") >= bar).select(
        "master_store_id", F.col("ops_complaints").alias("store_ops_count"))
    return (v_complaint_events(t).where(in_trailing_days("complaint_received_at", as_of, days))
            .withColumn("ops_category", category).where(F.col("ops_category").isNotNull())
            .join(counts, "master_store_id")
            .join(t.master_store.select("master_store_id", "store_name"), "master_store_id", "left")
            .select("master_store_id", "store_name", "issue_type", F.col("item_name").alias("complaint_item"),
                    F.col("customer_comments").alias("complaint"), "order_id",
                    F.col("complaint_received_at").alias("complaint_date"), "ops_category", "store_ops_count"))


def theme_rules(c="issue_type"):
    """Theme and kind of a complaint from its category text."""
    ops = [(contains_any(c, terms), f"OPERATIONS|{name}") for name, terms in OPS_CATEGORIES]
    food = [(matches_any(c, word), f"PRODUCT|{word}") for word in PRODUCT_RX.split("|")]
    return ladder(*ops, *food, otherwise="OTHER|unclassified")


def complaint_clusters(t) -> DataFrame:
    """Clusters of complaint events by the item they are filed under."""
    return clusters(v_complaint_events(t).select(
        "event_id", "master_store_id", match_key("item_name").alias("product"), theme_rules().alias("kind_theme"),
        day_index("complaint_received_at").alias("n"),
        F.date_format("complaint_received_at", "yyyy-MM-dd").alias("d")))


def review_clusters(t, as_of: date) -> DataFrame:
    """Clusters of low-rated reviews by the product that the review's own text names; a review
    that names none belongs to no cluster. The theme is read off the whole text."""
    named = v_review_complaint_candidates(t, as_of).where(F.col("p") != "")
    return clusters(named.select(F.col("review_id").alias("event_id"), F.col("s").alias("master_store_id"),
                                 F.col("p").alias("product"), theme_rules("t").alias("kind_theme"), "n", "d"))


def clusters(rows: DataFrame, span: int = SPAN_DAYS, bar: int = SPAN_MIN_REVIEWS, evidence: int = 4) -> DataFrame:
    """Groups of (product, theme) of rows (event_id, master_store_id, product, kind_theme, n, d): the
    14-day window with most rows, its stores, and up to four lines of evidence. Operations themes
    never qualify."""
    events = rows.where(F.col("product").isNotNull()).select(
        "event_id", "master_store_id", "product", F.split_part("kind_theme", F.lit("|"), F.lit(1)).alias("kind"),
        F.split_part("kind_theme", F.lit("|"), F.lit(2)).alias("theme"), "n", "d")
    keys = ["product", "kind", "theme"]
    spans = best_span(events, keys, "n", span)
    inside = events.join(spans, keys).where(F.col("n").between(F.col("window_first"), F.col("window_last")))
    facts = inside.groupBy(*keys).agg(F.count_distinct("master_store_id").alias("store_count"),
                                      F.min("d").alias("window_start"), F.max("d").alias("window_end"))
    shown = top_n(inside, keys, [F.asc("n"), F.asc("event_id")], evidence).groupBy(*keys).agg(
        F.expr("string_agg(d || ' ' || event_id, '\n') WITHIN GROUP (ORDER BY rnk)").alias("evidence"))
    return (spans.join(facts, keys).join(shown, keys)
            .withColumn("span", F.col("window_last") - F.col("window_first"))
            .withColumn("qualifies", (F.col("kind") == "PRODUCT") & (F.col("hits") >= bar))
            .select(*keys, "window_first", "window_last", "span", F.col("hits").alias("review_count"), "store_count",
                    "window_start", "window_end", "evidence", "qualifies"))
