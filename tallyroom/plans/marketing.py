"""Campaign roll-ups, action ladders, expansion gaps and seasonal planning."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyroom.constants import (CAMPAIGN_ACTIONS, CAUTIOUS_PCT, CONFIDENT_PCT, CRITICAL_SPEND, EVENT_TYPES, HIGH_SPEND,
                                 LOW_SPEND, MIN_AD_ORDERS, PROOF_ORDERS, PROOF_SPEND, REDUCE_PCT, ROI_BOUNDS,
                                 SEASON_DAYS_AFTER, SEASON_DAYS_BEFORE, SEASON_MILESTONES, SEASONAL_ACTIONS,
                                 SURE_ORDERS)
from tallyroom.functions import audience_key, ladder, match_key, month_of, safe_divide
from tallyroom.operators.joins import join_any_id
from tallyroom.operators.ranking import first_per
from tallyroom.operators.sets import concat_unless_rejected, missing_values

TOTALS = ["ad_spend_rs", "ad_sales_rs", "ad_orders", "ad_impressions", "ad_clicks"]
LABELS = ["product_type", "targeting", "segments", "ads_m2o_pct", "overall_m2o_pct"]


def _campaign_totals(ads: DataFrame, mapping: DataFrame, grain: list[str], spans: list[Column],
                     spans_out: list[Column]) -> DataFrame:
    """Totals per (store, campaign, ...). Daily rows are first summed per ad id,
    which is what travels into the id join; ratios come from the totals.

    With a grain, rows move once, by campaign and grain: both groupings hold these columns."""
    if grain:
        ads = ads.repartition("campaign_id", *grain)
    per_ad = ads.groupBy("res_id", "campaign_id", *grain).agg(
        *[F.sum(c).alias(c) for c in TOTALS], *[F.min(c).alias(c) for c in LABELS], *spans)
    stores = mapping.select("master_store_id", "zomato_id", "swiggy_id")
    resolved = join_any_id(per_ad, "res_id", stores, {"zomato_id": "ZOMATO", "swiggy_id": "SWIGGY"}, tag="platform")
    sums = resolved.groupBy("master_store_id", "campaign_id", *grain).agg(
        F.min("res_id").alias("res_id"), F.min("platform").alias("platform"),
        *[F.min(c).alias(c) for c in LABELS], *spans_out, *[F.sum(c).alias(c) for c in TOTALS])
    spend, sales = F.col("ad_spend_rs"), F.col("ad_sales_rs")
    return sums.select(
        "master_store_id", "campaign_id", *grain, "res_id", "platform", "product_type", "targeting", "segments",
        *[c for c in sums.columns if c in ("date", "start_date", "end_date", "window_start", "window_end")],
        F.round(spend, 0).cast("double").alias("ad_spend_rs"), F.round(sales, 0).cast("double").alias("ad_sales_rs"),
        "ad_orders", "ad_impressions", "ad_clicks",
        safe_divide(sales, spend).alias("roi"),
        F.col("ads_m2o_pct").cast("double").alias("ads_m2o_pct"),
        F.col("overall_m2o_pct").cast("double").alias("overall_m2o_pct"),
        safe_divide(sales - spend, spend).alias("roas"),
        safe_divide("ad_clicks", "ad_impressions").alias("ctr"))


def v_store_campaign_current(t, as_of: date) -> DataFrame:
    """Month-to-date totals of the campaigns running on ``as_of``."""
    live = t.raw_marketing_data.where((F.col("date") >= F.trunc(F.lit(as_of), "MM"))
                                      & F.lit(as_of).between(F.col("start_date"), F.col("end_date")))
    return _campaign_totals(
        live, t.store_channel_mapping, [],
        [F.max("date").alias("date"), F.min("start_date").alias("start_date"), F.max("end_date").alias("end_date")],
        [F.max("date").alias("date"), F.min("start_date").alias("start_date"), F.max("end_date").alias("end_date")])


def v_store_campaign_history(t) -> DataFrame:
    """The same totals per calendar month, over all history."""
    ads = t.raw_marketing_data.withColumn("month", month_of("date"))
    return _campaign_totals(
        ads, t.store_channel_mapping, ["month"],
        [F.min("date").alias("window_start"), F.max("date").alias("window_end")],
        [F.min("window_start").alias("window_start"), F.max("window_end").alias("window_end")])


def v_segment_on_channel(t) -> DataFrame:
    channels = t.dim_channel.select("channel_id", F.upper("channel_name").alias("k"))
    return t.marketing_segment_master.withColumn("k", F.upper("channel")).join(channels, "k").select(
        "segment_id", "channel_id")


def v_segment_budget(t) -> DataFrame:
    segments = t.marketing_segment_master.select("segment_id", F.col("segment_code").alias("segment_type"),
                                                 F.upper("channel").alias("k"))
    return (t.marketing_budget.withColumn("k", F.upper("channel")).join(segments, ["segment_type", "k"])
            .select("segment_id", "master_store_id", "store_name", "channel", "budget_month",
                    F.col("allocated_budget_rs").cast("double").alias("allocated_budget_rs"),
                    F.col("expected_revenue_rs").cast("double").alias("expected_revenue_rs")))


# ---- ladders -----------------------------------------------------------------------------

def boundary_distance(roi: Column) -> Column:
    return F.array_min(F.array(*[F.abs(roi - F.lit(b)) for b in ROI_BOUNDS]))


def campaign_ladder(df: DataFrame, actions: dict[str, str] = CAMPAIGN_ACTIONS) -> DataFrame:
    """One action per row from spend, sample size and return on spend, with
    category, confidence, priority and an approximate money effect."""
    spend, orders, roi = F.col("ad_spend_rs"), F.col("ad_orders"), F.coalesce("roi", F.lit(0.0))
    rung = ladder((spend == 0, "no_spend"), (orders < MIN_AD_ORDERS, "thin"), (roi == 0, "zero"),
                  (roi < 0.75, "stop"), (roi < 1.0, "reduce"), (roi < 1.5, "hold"), (roi < 2.5, "cautious"),
                  (roi <= 10, "confident"), otherwise="outlier")
    df = df.withColumn("rung", rung)
    is_rung = F.col("rung")
    early = is_rung.isin("no_spend", "thin")
    edge = boundary_distance(roi)
    raises = is_rung.isin("cautious", "confident")
    stops = is_rung.isin("zero", "stop")
    return (df
            .withColumn("suggested_action", ladder(
                *[(is_rung == k, v) for k, v in {**actions, "zero": actions["stop"]}.items()]))
            .withColumn("category", ladder(
                (is_rung == "no_spend", "no_spend"), (is_rung == "thin", "insufficient_sample"),
                ((is_rung == "zero") & (spend >= CRITICAL_SPEND), "critical_failure"), (stops, "underperforming"),
                (is_rung == "reduce", "weak"), (is_rung == "hold", "breakeven"), (is_rung == "cautious", "good"),
                (is_rung == "confident", "excellent"), otherwise="outlier"))
            .withColumn("confidence", ladder(
                (early | (orders < SURE_ORDERS) | (edge <= 0.1) | (is_rung == "outlier"), "LOW"),
                (edge >= 0.3, "HIGH"), otherwise="MEDIUM"))
            .withColumn("priority", ladder(
                (early, "LOW"), ((spend >= HIGH_SPEND) & (stops | raises), "HIGH"),
                ((spend < LOW_SPEND) | is_rung.isin("hold", "outlier"), "LOW"), otherwise="MEDIUM"))
            .withColumn("estimated_impact", F.round(ladder(
                (stops, spend), (is_rung == "reduce", spend * (REDUCE_PCT / 100)),
                (is_rung == "cautious", spend * (CAUTIOUS_PCT / 100) * roi),
                (is_rung == "confident", spend * (CONFIDENT_PCT / 100) * roi)), 2)))


def with_previous_month(history: DataFrame) -> DataFrame:
    """Each month beside the calendar month before it; a gap gives NULL. ``history`` has a row per
    store, campaign and month."""
    w = Window.partitionBy("master_store_id", "campaign_id").orderBy("month")
    follows = (F.col("master_store_id").isNotNull() & F.col("campaign_id").isNotNull()
               & (F.add_months(F.lag("month").over(w), 1) == F.col("month")))
    return history.select("*", F.when(follows, F.lag("roi").over(w)).alias("prev_roi"),
                          F.when(follows, F.lag("ad_spend_rs").over(w)).alias("prev_spend_rs"))


# ---- expansion ------------------------------------------------------------------------------

def proof_points(acted: DataFrame, rungs: list[str]) -> DataFrame:
    return acted.where(F.col("rung").isin(rungs) & (F.col("ad_spend_rs") >= PROOF_SPEND)
                       & (F.col("ad_orders") >= PROOF_ORDERS))


def best_proof(acted: DataFrame) -> DataFrame:
    """A store's strongest proven campaign."""
    return first_per(proof_points(acted, ["confident"]), ["master_store_id"],
                     [F.desc("roi"), F.asc("campaign_id"), F.asc("res_id")])


def campaign_expansion_gap(acted: DataFrame) -> DataFrame:
    """Audiences running somewhere but not at a proven store, each with the
    store's proof point. Audience names are compared after normalising."""
    present = acted.where(F.col("product_type").isNotNull()).select(
        "master_store_id", audience_key("segments").alias("segment"))
    proof = best_proof(acted.where(F.col("product_type").isNotNull()))
    gaps = missing_values(proof, "master_store_id", present, "segment")
    return (gaps.join(proof.select("master_store_id", F.col("campaign_id").alias("proof_campaign_id"), "platform",
                                   "product_type", "roi", "ad_sales_rs", "ad_spend_rs"), "master_store_id")
            .withColumn("category", F.lit("strategic_expansion"))
            .withColumn("suggested_action", F.concat(F.lit("new_campaign:"), "segment"))
            .withColumn("confidence", F.lit("MEDIUM"))
            .withColumn("priority", F.when(F.col("ad_spend_rs") >= HIGH_SPEND, "HIGH").otherwise("MEDIUM")))


def campaign_unspent_budget(budget: DataFrame, running: DataFrame, as_of: date) -> DataFrame:
    """Budget rows of the current month whose store runs nothing on that channel."""
    live = running.select("master_store_id", F.col("platform").alias("k")).distinct()
    rows = budget.where((F.col("allocated_budget_rs") > 0)
                        & (F.col("budget_month") == F.trunc(F.lit(as_of), "MM"))).withColumn("k", F.upper("channel"))
    return (rows.join(live, ["master_store_id", "k"], "left_anti")
            .withColumn("platform", F.col("k")).drop("k")
            .withColumn("category", F.lit("strategic_expansion"))
            .withColumn("suggested_action", F.lit("new_campaign:budget_allocated_unused"))
            .withColumn("confidence", F.lit("LOW"))
            .withColumn("priority", F.when(F.col("allocated_budget_rs") >= HIGH_SPEND, "HIGH").otherwise("MEDIUM")))


PLAN_COLUMNS = ["master_store_id", "campaign_id", "platform", "segments", "category", "suggested_action",
                "confidence", "priority", "ad_spend_rs", "roi"]


def campaign_final_plan(acted: DataFrame, gaps: DataFrame, unspent: DataFrame, hold_actions: bool = False,
                        skip_expansion: bool = False) -> DataFrame:
    """The sets that were not rejected, HIGH first, keeping the set order inside
    a band."""
    none = F.lit(None)
    actions = acted.select(*PLAN_COLUMNS, F.lit(1).cast("bigint").alias("seq"))
    expansion = gaps.select(
        "master_store_id", none.cast("string").alias("campaign_id"), "platform", F.col("segment").alias("segments"),
        "category", "suggested_action", "confidence", "priority", "ad_spend_rs", "roi",
        F.lit(2).cast("bigint").alias("seq")).unionByName(unspent.select(
            "master_store_id", none.cast("string").alias("campaign_id"), "platform",
            none.cast("string").alias("segments"), "category", "suggested_action", "confidence", "priority",
            F.lit(0.0).alias("ad_spend_rs"), none.cast("double").alias("roi"), F.lit(3).cast("bigint").alias("seq")))
    plan = concat_unless_rejected([(actions, hold_actions), (expansion, skip_expansion)])
    return sort_by_band(plan, "seq", "master_store_id", "campaign_id", "segments")


def band_order(c="priority") -> Column:
    return ladder((F.col(c) == "HIGH", 1), (F.col(c) == "MEDIUM", 2), otherwise=3).cast("bigint")


def sort_by_band(df: DataFrame, *then: str) -> DataFrame:
    return df.withColumn("band_order", band_order()).orderBy("band_order", *then)


# ---- seasonal ----------------------------------------------------------------------------------

def seasonal_window(event_date: date) -> tuple[Column, Column]:
    """First and last calendar month touched by the window around an event."""
    day = F.lit(event_date)
    return (F.trunc(F.date_sub(day, SEASON_DAYS_BEFORE), "MM"), F.trunc(F.date_add(day, SEASON_DAYS_AFTER), "MM"))


def in_seasonal_window(history: DataFrame, event_date: date) -> DataFrame:
    first, last = seasonal_window(event_date)
    return history.where(F.col("month").between(first, last))


def event_months(events: DataFrame) -> DataFrame:
    """Events with one row per calendar month of their window."""
    start = F.date_sub("event_date", SEASON_DAYS_BEFORE)
    end = F.date_add("event_date", SEASON_DAYS_AFTER)
    return events.select("title", "event_date", start.alias("window_start"), end.alias("window_end"),
                         F.explode(F.sequence(F.trunc(start, "MM"), F.trunc(end, "MM"),
                                              F.expr("interval 1 month"))).alias("month"))


def seasonal_ladder(history: DataFrame, event_date: date) -> DataFrame:
    return campaign_ladder(in_seasonal_window(history, event_date), SEASONAL_ACTIONS)


def seasonal_budget_gap(acted: DataFrame, budget: DataFrame, event_this_year: date) -> DataFrame:
    """Proven campaigns of last season whose store has no budget on the platform
    for this year's event month."""
    funded = budget.where((F.col("allocated_budget_rs") > 0)
                          & (F.col("budget_month") == F.trunc(F.lit(event_this_year), "MM"))).select(
        "master_store_id", F.upper("channel").alias("platform")).distinct()
    return (proof_points(acted, ["cautious", "confident"])
            .join(funded, ["master_store_id", "platform"], "left_anti")
            .withColumn("category", F.lit("seasonal_budget_gap"))
            .withColumn("suggested_action", F.lit("allocate_budget_for_event"))
            .withColumn("confidence", F.lit("MEDIUM"))
            .withColumn("priority", F.when(F.col("ad_spend_rs") >= HIGH_SPEND, "HIGH").otherwise("MEDIUM")))


def seasonal_timeline(events: DataFrame) -> DataFrame:
    """Eight dated milestones around every event."""
    steps = F.array(*[F.struct(F.lit(d).alias("offset_days"), F.lit(s).alias("milestone"))
                      for d, s in SEASON_MILESTONES])
    return (events.select("title", "event_date", F.inline(steps))
            .select("title", "milestone", F.expr("date_add(event_date, offset_days)").alias("due_date")))


def upcoming_events(events: DataFrame, as_of: date, weeks: int = 6) -> DataFrame:
    day = F.lit(as_of)
    return events.where(F.col("event_date").between(day, F.date_add(day, 7 * weeks))).withColumn(
        "type_order", F.array_position(F.array(*[F.lit(x) for x in EVENT_TYPES]), F.col("event_type")))


def event_pick(events: DataFrame, as_of: date, weeks: int = 6) -> DataFrame:
    """The nearest upcoming event; equal dates follow the fixed type order."""
    return upcoming_events(events, as_of, weeks).orderBy("event_date", "type_order", "title").limit(1)
