"""Scalar functions, each applied to whole tables."""

from pyspark.sql import functions as F

from tallyroom import functions as fn
from tallyroom.constants import AS_OF_INVENTORY, AS_OF_SALES
from tallyroom.operators import gather as G
from tallyroom.plans import ideas, marketing, products, recipes
from tallyroom.registry.base import I, S, add, num_text
from tallyroom.registry.check_views import family

col = F.col

add("fn_concat", lambda t: products.v_product_claim(t),
    """SELECT sku || '-' || highlight_seq AS claim_id, sku, highlight_seq, highlight_text FROM product_highlight""")
add("fn_cast_string", lambda t: t.flagged_inventory.select(
    "sku_id", "master_store_id", fn.num_text("total_stock", 2).alias("stock_text"),
    col("shelf_life_days").cast("string").alias("life_text")),
    f"""SELECT sku_id, master_store_id, {num_text('total_stock', 2)} AS stock_text,
               CAST(shelf_life_days AS VARCHAR) AS life_text FROM flagged_inventory""")
add("fn_format_g", lambda t: ideas.score_briefs(ideas.active_briefs(t, AS_OF_SALES)).select(
    "idea_id", fn.score_text("cogs_score").alias("cogs"), fn.score_text("brief_subtotal").alias("subtotal")),
    """SELECT idea_id, CASE WHEN cogs_score = 2.5 THEN '2.5' ELSE CAST(CAST(cogs_score AS INT) AS VARCHAR) END AS cogs,
              CAST(CAST(brief_subtotal AS INT) AS VARCHAR) AS subtotal
       FROM brief_scores WHERE stage IN ('Capture', 'Triage', 'Feasibility')""")
add("fn_format_kv", lambda t: products.families(t).where(col("cogs").isNotNull()).select(
    F.format_string("%s=%d", "fam", "cogs").alias("pair")),
    "SELECT fam || '=' || cogs AS pair FROM family_list WHERE cogs IS NOT NULL")
add("fn_upper_lower_trim", lambda t: t.dim_competitor.select(
    "competitor_id", fn.match_key("category").alias("up"), F.lower(F.trim("category")).alias("low")),
    "SELECT competitor_id, upper(trim(category)) AS up, lower(trim(category)) AS low FROM dim_competitor")
add("fn_length", lambda t: t.documents.select("doc_id", F.length("text").cast("bigint").alias("chars")),
    "SELECT doc_id, length(text) AS chars FROM documents")
add("fn_substr", lambda t: t.documents.select("doc_id", F.substring("text", 0, 140).alias("from_0"),
                                              F.substring("text", 1, 140).alias("from_1"),
                                              F.length("text").cast("bigint").alias("chars")),
    """SELECT doc_id, substr(text, 1, 140) AS from_0, substr(text, 1, 140) AS from_1, length(text) AS chars
       FROM documents""")
add("fn_strpos", lambda t: t.documents.select("doc_id", F.instr("text", "the").cast("bigint").alias("pos")),
    "SELECT doc_id, strpos(text, 'the') AS pos FROM documents")
add("fn_regexp_replace", lambda t: t.dim_product.select("sku", fn.product_family("display_name").alias("fam")),
    f"SELECT sku, {family('display_name')} AS fam FROM dim_product")
add("fn_regexp_contains", lambda t: t.dim_ingredient.select(
    "ingredient_id", F.lower("ingredient_name").rlike(r"\begg|milk|^sugar$").alias("hit")),
    r"SELECT ingredient_id, regexp_matches(lower(ingredient_name), '\begg|milk|^sugar$') AS hit FROM dim_ingredient")
add("fn_regexp_extract", lambda t: t.dim_recipe.select(
    "recipe_id", fn.extract_or_null("recipe_id", r"-v(\d+)$").alias("v"),
    fn.extract_or_null("recipe_name", r"-v(\d+)$").alias("none")),
    """SELECT recipe_id, regexp_extract(recipe_id, '-v([0-9]+)$', 1) AS v, CAST(NULL AS VARCHAR) AS none
       FROM dim_recipe""")
add("fn_count_delims", lambda t: t.listing_package.select(
    "sku", fn.list_size("blocking_gaps").cast("bigint").alias("gaps")),
    """SELECT sku, CASE WHEN blocking_gaps = '' THEN 0 ELSE len(string_split(blocking_gaps, ';')) END AS gaps
       FROM listing_package""")
add("fn_strip_family", lambda t: products.families(t).select("fam", "sku"), "SELECT fam, sku FROM family_list")
add("fn_ifnull", lambda t: t.dim_idea.select("idea_id", F.ifnull("stage", F.lit("unknown")).alias("stage")),
    "SELECT idea_id, ifnull(stage, 'unknown') AS stage FROM dim_idea")
add("fn_coalesce", lambda t: t.customer_complaint_events.select(
    F.coalesce("event_id", "email_message_id").alias("id"), "order_id"),
    "SELECT coalesce(event_id, email_message_id) AS id, order_id FROM customer_complaint_events")
add("fn_nullif", lambda t: t.product_packaging.select("sku", F.nullif("gs1_barcode", F.lit("")).alias("barcode")),
    "SELECT sku, nullif(gs1_barcode, '') AS barcode FROM product_packaging")
add("fn_if", lambda t: t.dim_recipe.select("recipe_id", F.when(col("is_current"), "yes").otherwise("no").alias("cur")),
    "SELECT recipe_id, if(is_current, 'yes', 'no') AS cur FROM dim_recipe")
add("fn_case_simple", lambda t: ideas.v_idea_priority_inputs(t, AS_OF_SALES).select("idea_id", "stage", "stage_rank"),
    """SELECT idea_id, stage, CAST(CASE stage WHEN 'Capture' THEN 1 WHEN 'Triage' THEN 2 WHEN 'Feasibility' THEN 3
              WHEN 'Pipeline' THEN 4 WHEN 'Development' THEN 5 END AS BIGINT) AS stage_rank
       FROM dim_idea WHERE stage IS NULL OR stage NOT IN ('Rejected', 'Launch')""")
add("fn_case_searched", lambda t: ideas.v_idea_priority_inputs(t, AS_OF_SALES).select("idea_id", "cogs_fit"),
    "SELECT idea_id, cogs_fit FROM idea_inputs")
BUCKET = {"as": "band", "bucket": [
    {"when": {"field": "total_stock", "op": "lt", "value": 10}, "value": "low"},
    {"when": {"field": "total_stock", "op": "lt", "ref": "shelf_life_days"}, "value": {"col": "wastage_flag"}},
    {"else": "ok"}]}
add("fn_bucket_dsl", lambda t: G.compute(t.flagged_inventory, [BUCKET], AS_OF_SALES).select(
    "sku_id", "master_store_id", "band"),
    """SELECT sku_id, master_store_id, CASE WHEN total_stock < 10 THEN 'low'
              WHEN total_stock < shelf_life_days THEN wastage_flag ELSE 'ok' END AS band FROM flagged_inventory""")
add("fn_safe_divide", lambda t: t.raw_marketing_data.select(
    "res_id", "campaign_id", "date", fn.safe_divide("ad_sales_rs", "ad_spend_rs").alias("roi")),
    """SELECT res_id, campaign_id, date, CAST(ad_sales_rs AS DOUBLE) / nullif(CAST(ad_spend_rs AS DOUBLE), 0) AS roi
       FROM raw_marketing_data""")
add("fn_safe_cast", lambda t: t.orders.select(
    "o_orderkey", F.split_part("o_orderpriority", F.lit("-"), F.lit(1)).try_cast("bigint").alias("good"),
    F.split_part("o_orderpriority", F.lit("-"), F.lit(2)).try_cast("bigint").alias("bad")),
    """SELECT o_orderkey, TRY_CAST(split_part(o_orderpriority, '-', 1) AS BIGINT) AS good,
              TRY_CAST(split_part(o_orderpriority, '-', 2) AS BIGINT) AS bad FROM orders""")
add("fn_cast_num", lambda t: t.product_pricing.select(
    "sku", col("total_cogs_inr").cast("double").alias("as_double"),
    F.round(col("total_cogs_inr").cast("double")).cast("bigint").alias("as_int")),
    """SELECT sku, CAST(total_cogs_inr AS DOUBLE) AS as_double,
              CAST(round(CAST(total_cogs_inr AS DOUBLE)) AS BIGINT) AS as_int FROM product_pricing""")
add("fn_round", lambda t: t.orders.select("o_orderkey", F.round("o_totalprice").alias("r0"),
                                          F.round("o_totalprice", 1).alias("r1")),
    "SELECT o_orderkey, round(o_totalprice) AS r0, round(o_totalprice, 1) AS r1 FROM orders")
add("fn_abs", lambda t: t.customer.select("c_custkey", F.abs("c_acctbal").alias("size")),
    "SELECT c_custkey, abs(c_acctbal) AS size FROM customer")
add("fn_ceil", lambda t: t.orders.select("o_orderkey", F.ceil(col("o_totalprice") / 1000).alias("thousands")),
    "SELECT o_orderkey, CAST(ceil(o_totalprice / 1000) AS BIGINT) AS thousands FROM orders")
add("fn_floor_at", lambda t: t.forecast_results.select(
    "sku_id", "master_store_id", F.greatest(F.ceil(col("predicted_sales_quantity") / 20 - 1), F.lit(1)).alias("units")),
    """SELECT sku_id, master_store_id, CAST(greatest(ceil(predicted_sales_quantity / 20 - 1), 1) AS BIGINT) AS units
       FROM forecast_results""")
add("fn_sub", lambda t: G.compute(t.flagged_inventory, [{"as": "used", "sub": ["total_stock", "safe_stock"]}],
                                  AS_OF_SALES).select("sku_id", "master_store_id", "used"),
    "SELECT sku_id, master_store_id, total_stock - safe_stock AS used FROM flagged_inventory")
add("fn_current_date", lambda t: t.dim_recipe.select("recipe_id", fn.days_since("created_on", AS_OF_SALES).alias("age")),
    f"SELECT recipe_id, {S} - created_on AS age FROM dim_recipe")
add("fn_date_of_ts", lambda t: t.events.select("event_id", fn.as_date("ts").alias("day")),
    "SELECT event_id, CAST(ts AS DATE) AS day FROM events")
add("fn_date_diff", lambda t: recipes.v_ingredient_current_cost(t, AS_OF_INVENTORY).select(
    "ingredient_id", "price_age_days"), f"SELECT ingredient_id, {I} - effective_from AS price_age_days FROM ingredient_rates")
add("fn_days_until", lambda t: t.store_inventory_daily.select(
    "store_id", "product_sku", fn.days_until("expiry_date", AS_OF_INVENTORY).alias("days_left")),
    f"SELECT store_id, product_sku, expiry_date - {I} AS days_left FROM store_inventory_daily")
add("fn_day_index", lambda t: t.events.select("event_id", fn.day_index("ts").alias("n")),
    "SELECT event_id, CAST(ts AS DATE) - DATE '2026-01-01' AS n FROM events")
add("fn_date_sub", lambda t: t.dim_recipe.select(
    "recipe_id", F.date_sub("created_on", 90).alias("d90"),
    (col("created_on").cast("timestamp_ntz") - F.expr("INTERVAL 30 DAYS")).cast("date").alias("d30")),
    "SELECT recipe_id, created_on - 90 AS d90, created_on - 30 AS d30 FROM dim_recipe")
add("fn_month_trunc", lambda t: t.raw_marketing_data.select(
    "res_id", "campaign_id", "date", fn.month_of("date").alias("month")),
    "SELECT res_id, campaign_id, date, CAST(date_trunc('month', date) AS DATE) AS month FROM raw_marketing_data")
add("fn_format_date", lambda t: t.customer_review_events.select(
    "review_id", F.date_format("review_date", "yyyy-MM-dd").alias("d")),
    "SELECT review_id, strftime(review_date, '%Y-%m-%d') AS d FROM customer_review_events")
add("fn_array_cond", lambda t: ideas.v_idea_priority_inputs(t, AS_OF_SALES).select(
    "idea_id", F.concat_ws(",", F.when(col("cogs_fit") == "UNKNOWN", "cogs_vs_target"),
                           F.when(col("days_in_stage").isNull(), "time_in_stage")).alias("missing")),
    """SELECT idea_id, array_to_string(list_filter([CASE WHEN cogs_fit = 'UNKNOWN' THEN 'cogs_vs_target' END,
              CASE WHEN days_in_stage IS NULL THEN 'time_in_stage' END], lambda x: x IS NOT NULL), ',') AS missing
       FROM idea_inputs""")
add("fn_array_join_default", lambda t: ideas.score_briefs(ideas.v_idea_priority_inputs(t, AS_OF_SALES)).select(
    "idea_id", "unknowns"), "SELECT idea_id, unknowns FROM brief_scores")
add("fn_unnest_structs", lambda t: recipes.verdict_rows(recipes.v_recipe_cogs(t, AS_OF_INVENTORY)).groupBy(
    "rule", "verdict").agg(F.count("*").alias("recipes")),
    "SELECT rule, verdict, count(*) AS recipes FROM verdicts GROUP BY ALL")
add("fn_pack", lambda t: t.dim_recipe.select("recipe_id", fn.pack("|", "status", "version_no", "recipe_name").alias("d")),
    """SELECT recipe_id, concat_ws('|', coalesce(status, ''), coalesce(CAST(version_no AS VARCHAR), ''), recipe_name) AS d
       FROM dim_recipe""")
add("fn_unpack", lambda t: t.dim_recipe.select(
    "recipe_id", fn.pack("|", "status", "version_no", "recipe_name").alias("d")).select(
    "recipe_id", fn.unpack("d", "|", 0).alias("status"), fn.unpack("d", "|", 2).alias("name")),
    "SELECT recipe_id, coalesce(status, '') AS status, recipe_name AS name FROM dim_recipe")
add("fn_json_len", lambda t: t.dim_competitor.select(
    "competitor_id", F.length(F.to_json(F.struct("competitor_id", "category"))).cast("bigint").alias("chars")),
    """SELECT competitor_id, length('{"competitor_id":"' || competitor_id || '","category":"' || category || '"}') AS chars
       FROM dim_competitor""")
add("fn_platform_of_id", lambda t: marketing.v_store_campaign_history(t).groupBy("platform").agg(
    F.count("*").alias("rows")), "SELECT platform, count(*) AS rows FROM campaign_months GROUP BY 1")
add("fn_unit_normalise", lambda t: t.dim_ingredient_price.select(
    "price_id", fn.price_per_kg("price_inr", "price_uom", "density_g_per_ml").alias("per_kg")),
    """SELECT price_id, CASE price_uom WHEN 'kg' THEN CAST(price_inr AS DOUBLE) WHEN 'L' THEN
              CAST(price_inr AS DOUBLE) / coalesce(CAST(density_g_per_ml AS DOUBLE), 1.0) END AS per_kg
       FROM dim_ingredient_price""")
add("fn_gross_from_net", lambda t: t.map_recipe_ingredient.select(
    "recipe_line_id", "ingredient_id", fn.gross_from_net("qty_net_g", "loss_pct").alias("gross")),
    """SELECT recipe_line_id, ingredient_id, qty_net_g / nullif(1 - loss_pct / 100, 0) AS gross
       FROM map_recipe_ingredient""")
add("fn_tolerance_fit", lambda t: recipes.v_recipe_cogs(t, AS_OF_INVENTORY).groupBy("target_fit").agg(
    F.count("*").alias("recipes")), "SELECT target_fit, count(*) AS recipes FROM recipe_costs GROUP BY 1")
