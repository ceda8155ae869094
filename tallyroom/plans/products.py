"""Product master views and category signals."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroom.constants import LOW_STARS
from tallyroom.functions import day_index, in_trailing_days, is_present, match_key, product_family, safe_divide, sum_if
from tallyroom.operators.joins import longest_term
from tallyroom.operators.sets import prefer


def product_facets(t) -> DataFrame:
    """Product with its three one-to-one facets, line and category ids included."""
    return (t.dim_product
            .join(t.product_pricing, "sku", "left")
            .join(t.product_packaging, "sku", "left")
            .join(t.product_nutrition, "sku", "left"))


def v_product_enriched(t) -> DataFrame:
    return product_facets(t).select(
        "sku", "display_name", "flavour", "size_gm", "size_label", "version", "status", "veg_nonveg",
        "is_active", "description", "images_link",
        F.col("base_price_inr").cast("double").alias("base_price_inr"),
        F.col("gst_rate").cast("double").alias("gst_rate"),
        F.col("mrp_inr").cast("double").alias("mrp_inr"),
        F.col("total_cogs_inr").cast("double").alias("total_cogs_inr"),
        "shelf_life_days", "packaging_type", "gs1_barcode", "org_labelling_compliance", "serving_size")


def v_product_claim(t) -> DataFrame:
    return t.product_highlight.select(
        F.concat("sku", F.lit("-"), F.col("highlight_seq").cast("string")).alias("claim_id"),
        "sku", "highlight_seq", "highlight_text")


def v_nutrient_dim(t) -> DataFrame:
    return t.product_nutrient.select("nutrient_name").distinct()


def v_product_line_capability(t) -> DataFrame:
    """Per product line and category: active SKUs, cost range, mean shelf life."""
    return (product_facets(t).where("is_active")
            .groupBy("product_line_id", "category_id")
            .agg(F.count("*").alias("active_skus"),
                 F.round(F.min(F.col("total_cogs_inr").cast("double"))).alias("min_cogs_inr"),
                 F.round(F.max(F.col("total_cogs_inr").cast("double"))).alias("max_cogs_inr"),
                 F.round(F.avg("shelf_life_days")).alias("avg_shelf_life_days"))
            .join(t.dim_product_line, "product_line_id").join(t.dim_category, "category_id")
            .select("product_line_id", "product_line_name", "category_name", "active_skus",
                    "min_cogs_inr", "max_cogs_inr", "avg_shelf_life_days"))


def sku_category(t) -> DataFrame:
    return t.dim_product.join(t.dim_category, "category_id").select("sku", "category_name", "is_active")


# ---- category market signal -------------------------------------------------------

def trailing_vs_prior(lines: DataFrame, categories: DataFrame, as_of: date, days: int = 90) -> DataFrame:
    """Trailing and prior window totals per category in one pass.

    Totals are combined per SKU before the category join, so a best-selling SKU
    arrives there as a single row.
    """
    recent = F.col("order_date") >= F.date_sub(F.lit(as_of), days)
    per_sku = (lines.where((F.col("order_state") != "Cancelled")
                           & (F.col("order_date") >= F.date_sub(F.lit(as_of), 2 * days)))
               .groupBy(F.col("sku_id").alias("sku"))
               .agg(sum_if(recent, "quantity").alias("u"), sum_if(recent, "total").alias("r"),
                    sum_if(~recent, "quantity").alias("p")))
    return (per_sku.join(categories, "sku").groupBy("category_name")
            .agg(F.sum("u").alias("units_90d"), F.sum("r").cast("double").alias("net_revenue_90d"),
                 F.sum("p").alias("units_prior_90d"))
            .withColumn("growth_pct", F.round(
                safe_divide(F.col("units_90d") - F.col("units_prior_90d"), "units_prior_90d") * 100, 1)))


def forward_forecast(forecast: DataFrame, categories: DataFrame, as_of: date) -> DataFrame:
    """Latest forecast for the next one to three days; past dates do not count."""
    per_sku = (forecast.where(F.col("is_latest_forecast") & F.col("days_ahead").between(1, 3)
                              & (F.col("forecast_date") >= F.lit(as_of)))
               .groupBy(F.col("sku_id").alias("sku")).agg(F.sum("predicted_sales_quantity").alias("q")))
    return (per_sku.join(categories, "sku").groupBy("category_name")
            .agg(F.round(F.sum("q"), 1).alias("forecast_units_next")))


def presence_counts(t) -> DataFrame:
    """Active SKUs per category and how many carry each compliance mark."""
    allergens = t.map_product_allergen.select("sku").distinct().withColumn("declared", F.lit(True))
    facts = (product_facets(t).where("is_active").join(t.dim_category, "category_id")
             .join(allergens, "sku", "left"))
    return facts.groupBy("category_name").agg(
        F.count("*").alias("active_skus_in_category"),
        F.count_if(is_present("org_labelling_compliance")).alias("skus_with_label_compliance"),
        F.count_if(F.trim("gs1_barcode") != "").alias("skus_with_barcode"),
        F.count_if(F.col("declared").isNotNull()).alias("skus_with_declared_allergens"))


def channel_coverage(t) -> DataFrame:
    """Distinct channels listed and mapped per category. Rows are reduced to one
    per (SKU, channel), then one per (category, channel); nothing is counted
    through a fan-out."""
    active = sku_category(t).where("is_active").select("sku", "category_name")
    pairs = t.map_product_channel.groupBy("sku", "channel_id").agg(
        F.max(F.col("applicable").isNotNull()).alias("listed"))
    per_channel = (active.join(pairs, "sku").groupBy("category_name", "channel_id")
                   .agg(F.max("listed").alias("listed")))
    known = t.dim_channel.select("channel_id", F.lit(True).alias("known"))
    counts = (per_channel.join(known, "channel_id", "left").groupBy("category_name")
              .agg(F.count_if("listed").alias("channels_listed"),
                   F.count_if(F.col("known")).alias("channels_mapped")))
    return (active.select("category_name").distinct().join(counts, "category_name", "left")
            .fillna(0, ["channels_listed", "channels_mapped"]))


def competitor_counts(t) -> DataFrame:
    """Active competitor products per normalised category text."""
    makers = t.dim_competitor.where("is_active").select("competitor_id", match_key("category").alias("category_key"))
    per_maker = (t.dim_competitor_product.where("is_active").groupBy("competitor_id")
                 .agg(F.count("*").alias("n")))
    return (per_maker.join(makers, "competitor_id").groupBy("category_key")
            .agg(F.sum("n").alias("active_competitor_products"),
                 F.count_distinct("competitor_id").alias("distinct_competitors")))


def v_category_market_signal(t, as_of: date) -> DataFrame:
    """All category facts, left-joined from the category list so that a category
    without sales or SKUs stays with NULLs."""
    categories = sku_category(t).select("sku", "category_name")
    return (t.dim_category.select("category_name")
            .join(trailing_vs_prior(t.business_analytics, categories, as_of), "category_name", "left")
            .join(forward_forecast(t.forecast_results, categories, as_of), "category_name", "left")
            .join(presence_counts(t), "category_name", "left")
            .join(channel_coverage(t), "category_name", "left")
            .withColumn("category_key", match_key("category_name"))
            .join(competitor_counts(t), "category_key", "left").drop("category_key"))


# ---- families and reviews ------------------------------------------------------------

def families(t) -> DataFrame:
    """Active product families with their smallest SKU and entry-pack cost."""
    return (product_facets(t).where("is_active")
            .groupBy(product_family("display_name").alias("fam"))
            .agg(F.min("sku").alias("sku"),
                 F.round(F.min(F.col("total_cogs_inr").cast("double"))).cast("bigint").alias("cogs")))


def v_product_family_names(t) -> DataFrame:
    """The closed family vocabulary, one row per family: its name, and its name with the
    entry pack's cost where there is one. No cell grows with the vocabulary."""
    pair = F.when(F.col("cogs").isNotNull(), F.format_string("%s=%d", "fam", "cogs"))
    return families(t).select(F.lit("FAMILIES").alias("id"), F.col("fam").alias("nm"), pair.alias("cg"))


def v_review_complaint_candidates(t, as_of: date, days: int = 30) -> DataFrame:
    """Low-rated recent reviews, whole, with the SKU of the longest family they name."""
    low = (t.customer_review_events
           .where(in_trailing_days("review_date", as_of, days) & (F.col("star_rating") <= LOW_STARS))
           .select("review_id", F.col("master_store_id").alias("s"), F.col("review_date").cast("date").alias("day"),
                   "review_text"))
    named = longest_term(low, "review_text", "review_id", families(t).select("fam", "sku"), "fam", "sku")
    return named.select(
        "review_id", "s", F.date_format("day", "yyyy-MM-dd").alias("d"), day_index("day").alias("n"),
        F.col("review_text").alias("t"), F.coalesce("sku", F.lit("")).alias("p"))


def v_product_ingredient(t) -> DataFrame:
    """Recipe-first membership: the legacy map serves SKUs without a current recipe."""
    current = t.dim_recipe.where(F.col("is_current") & F.col("sku").isNotNull()).select("recipe_id", "sku")
    from_recipe = current.join(t.map_recipe_ingredient.select("recipe_id", "ingredient_id"), "recipe_id").select(
        "sku", "ingredient_id")
    return prefer(from_recipe, t.map_product_ingredient.select("sku", "ingredient_id"), "sku", owners=current)
