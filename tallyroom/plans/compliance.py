"""Prices, claims, regulation, listings and renewals."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroom.constants import PRICE_GAP_HIGH_PCT, RENEWAL_DAYS
from tallyroom.functions import days_until, ladder, safe_divide
from tallyroom.operators.snapshots import latest_row
from tallyroom.plans.products import product_facets, v_product_ingredient
from tallyroom.plans.recipes import claim_bans, name_tags
from tallyroom.sources.sinks import written_once


def price_gap(t, real_gap_pct: float = 5.0) -> DataFrame:
    """Own price against each matched competitor price and the suggested move."""
    own = t.product_pricing.select("sku", F.col("mrp_inr").cast("double").alias("own_price"))
    rival = t.dim_competitor_product.where("is_active").select(
        "competitor_product_id", F.col("price_inr").cast("double").alias("competitor_price"))
    gap = F.round(safe_divide(F.col("own_price") - F.col("competitor_price"), "competitor_price") * 100, 1)
    size = F.abs("gap_pct")
    return (t.map_competitor_product.join(own, "sku").join(rival, "competitor_product_id")
            .withColumn("gap_pct", gap)
            .withColumn("risk", ladder((size >= PRICE_GAP_HIGH_PCT, "High"), (size.isNotNull(), "Medium")))
            .withColumn("move", ladder((size >= PRICE_GAP_HIGH_PCT, "reprice"), (size >= real_gap_pct, "review"),
                                       otherwise="hold"))
            .select("sku", "competitor_product_id", "own_price", "competitor_price", "gap_pct", "risk", "move"))


def claim_rules(t) -> DataFrame:
    """Claims of a product that an ingredient of it contradicts."""
    claims = t.product_highlight.select("sku", F.col("highlight_text").alias("claim"),
                                        F.inline(claim_bans(F.lower("highlight_text")))).where(
        F.col("source") == "claim")
    tags = t.dim_ingredient.select("ingredient_id", "ingredient_name",
                                   F.explode(name_tags(F.col("ingredient_name"))).alias("banned_tag"))
    members = v_product_ingredient(t)
    tagged = members.join(tags, "ingredient_id").groupBy("sku", "banned_tag").agg(
        F.min("ingredient_name").alias("invalidated_by"), F.count("*").alias("ingredients"))
    return claims.join(tagged, ["sku", "banned_tag"]).select("sku", "claim", "rule", "banned_tag", "invalidated_by",
                                                             "ingredients")


def words(c):
    return F.array_distinct(F.filter(F.split(F.lower(c), "[^a-z]+"), lambda w: F.length(w) > 2))


def word_bitmaps(rows: DataFrame, label: str) -> DataFrame:
    """(w, bucket, bits) of the different ids behind each word, from rows (w, id). Ids are numbered once,
    and 32,768 of them share a bitmap, so a word has a row per bucket and not per id."""
    rows = rows.distinct()
    numbers = written_once(rows.select(F.col("id").alias("known")).distinct()
                           .withColumn("no", F.monotonically_increasing_id() + 1), label)
    return (rows.join(numbers, rows["id"].eqNullSafe(numbers["known"])).groupBy("w", F.bitmap_bucket_number("no").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("no")).alias("bits")))


def ids_behind(kinds: DataFrame, bitmaps: DataFrame, out: str) -> DataFrame:
    """Different ids behind any word of each word list ``ws``."""
    return (kinds.select("ws", F.explode("ws").alias("w")).join(bitmaps, "w").groupBy("ws", "bucket")
            .agg(F.bitmap_or_agg("bits").alias("bits")).groupBy("ws").agg(F.sum(F.bitmap_count("bits")).alias(out)))


def regulation_impact(changes: DataFrame, key: str, body: str, products: DataFrame, sku: str, name: str,
                      suppliers: DataFrame) -> DataFrame:
    """Per change: matched product words, affected SKUs and their suppliers.

    Product words are few, so the texts' words are reduced to them, and changes with the same words
    are counted once. SKUs and suppliers are counted exactly by bitmaps per word; no row stands for a
    change and a SKU, or for a change and a supplier.
    """
    vocabulary = products.select(F.col(sku).alias("id"), F.explode(words(F.col(name))).alias("w")).distinct()
    hits = (changes.where(F.col(key).isNotNull()).select(key, F.explode(words(F.col(body))).alias("w")).distinct()
            .join(vocabulary.select("w").distinct(), "w", "left_semi"))
    sets = written_once(hits.groupBy(key).agg(F.array_sort(F.collect_set("w")).alias("ws")), "matched-words")
    kinds = sets.select("ws").distinct()
    supplied = suppliers.select(F.col(sku).alias("id"), "supplier_id").distinct()
    sources = vocabulary.join(supplied, "id").select("w", F.col("supplier_id").alias("id"))
    affected = ids_behind(kinds, word_bitmaps(vocabulary.select("w", "id"), "sku-numbers"), "affected_skus")
    behind = ids_behind(kinds, word_bitmaps(sources, "supplier-numbers"), "affected_suppliers")
    return (sets.join(affected, "ws").join(behind, "ws", "left")
            .select(key, F.size("ws").cast("bigint").alias("matched_words"), "affected_skus",
                    F.coalesce("affected_suppliers", F.lit(0)).alias("affected_suppliers")))


def exposure_overlap(own: DataFrame, cited: DataFrame, key: str) -> DataFrame:
    """Own rows that share an actioned claim or ingredient."""
    return own.join(cited.select(key).distinct(), key, "left_semi")


def long_fields(df: DataFrame, keys: list[str], fields: list[str], out: str) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias(out)) for f in fields])
    return df.select(*keys, F.inline(rows))


def listing_drift(t) -> DataFrame:
    """Field by field differences of each channel listing from the approved
    record; NULL against a value is a difference, NULL against NULL is not."""
    fields = ["brand", "net_quantity", "claim"]
    live = long_fields(t.channel_listing, ["sku", "channel_id"], fields, "live_value")
    approved = long_fields(t.approved_listing, ["sku"], fields, "approved_value")
    return live.join(approved, ["sku", "field"]).where(~F.col("live_value").eqNullSafe(F.col("approved_value")))


MANDATORY_FIELDS = ["display_name", "size_label", "serving_size", "veg_nonveg", "mrp_inr", "shelf_life_days",
                    "gs1_barcode", "org_labelling_compliance", "total_cogs_inr"]


def declaration_matrix(t) -> DataFrame:
    """Every active SKU against every mandatory field, missing ones flagged."""
    rows = long_fields(product_facets(t).where("is_active"), ["sku"], MANDATORY_FIELDS, "value")
    return rows.select("sku", "field", (F.col("value").isNull() | (F.trim("value") == "")).alias("missing"))


def expiry_within(df: DataFrame, expires: str, as_of: date, days: int = RENEWAL_DAYS) -> DataFrame:
    return df.where(F.col(expires) < F.lit(as_of + timedelta(days + 1))).withColumn(
        "days_left", days_until(expires, as_of)).withColumn(
        "status", F.when(F.col("days_left") < 0, "expired").otherwise("expiring"))


def non_responders(t, as_of: date, days: int = 7) -> DataFrame:
    """Register entries without a recent check-in, or whose address moved."""
    newest = latest_row(t.store_checkin, ["master_store_id"], "checkin_date", ["address"])
    stale = F.col("checkin_date").isNull() | (days_until("checkin_date", as_of) < -days)
    moved = ~stale & (F.col("address") != F.col("licensed_address"))
    return (t.store_register.join(newest, "master_store_id", "left")
            .withColumn("issue", ladder((stale, "no_response"), (moved, "address_changed")))
            .where(F.col("issue").isNotNull()))
