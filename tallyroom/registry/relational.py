"""Projections, filters, joins, aggregates, windows, sorts and set operators."""

from pyspark.sql import functions as F

from tallyroom import functions as fn
from tallyroom.constants import AS_OF_INVENTORY, AS_OF_SALES, OPS_RX
from tallyroom.operators import gather as G
from tallyroom.operators import joins as J
from tallyroom.operators import ranking as K
from tallyroom.operators import sets as SET
from tallyroom.operators import snapshots as SNAP
from tallyroom.plans import complaints, graph, ideas, inventory, marketing, products, quality, recipes
from tallyroom.registry.base import C, I, S, add
from tallyroom.registry.check_views import family

col = F.col

# ---- projections -------------------------------------------------------------------------
add("proj_columns", lambda t: t.dim_product.select("sku", "display_name", "status"),
    "SELECT sku, display_name, status FROM dim_product")
add("proj_rename", lambda t: t.forecast_results.withColumnsRenamed(
    {"sku_id": "product_sku", "master_store_id": "store_id"}).select("product_sku", "store_id", "forecast_date"),
    "SELECT sku_id AS product_sku, master_store_id AS store_id, forecast_date FROM forecast_results")
add("proj_drop", lambda t: t.dim_category.drop("category_id").join(
    t.dim_product.groupBy(col("category_id").alias("category_name")).agg(F.count("*").alias("n")), "category_name"),
    "SELECT category_name, count(*) AS n FROM dim_product JOIN dim_category USING (category_id) GROUP BY 1")
add("proj_star_except", lambda t: t.dim_competitor.drop("is_active"),
    "SELECT * EXCLUDE (is_active) FROM dim_competitor")
add("proj_star_replace", lambda t: complaints.v_complaint_events(t),
    "SELECT * REPLACE (coalesce(event_id, email_message_id) AS event_id) FROM customer_complaint_events")
add("proj_star_qualified", lambda t: t.dim_competitor.alias("s").select(
    "s.*", F.length("s.competitor_name").cast("bigint").alias("name_length")),
    "SELECT s.*, length(s.competitor_name) AS name_length FROM dim_competitor s")
add("proj_computed_bool", lambda t: recipes.v_ingredient_current_cost(t, AS_OF_INVENTORY).select(
    "ingredient_id", "is_costed"), "SELECT ingredient_id, is_costed FROM ingredient_rates")
add("proj_staged", lambda t: t.map_recipe_ingredient.withColumn(
    "qty_gross_g", fn.gross_from_net("qty_net_g", "loss_pct")).withColumn(
    "waste_g", F.round(col("qty_gross_g") - col("qty_net_g"), 6)).select("recipe_line_id", "ingredient_id", "waste_g"),
    """SELECT recipe_line_id, ingredient_id, round(qty_net_g / (1 - loss_pct / 100) - qty_net_g, 6) AS waste_g
       FROM map_recipe_ingredient""")

# ---- filters -------------------------------------------------------------------------------
add("filter_bool", lambda t: t.dim_product.where("is_active").select("sku"), "SELECT sku FROM dim_product WHERE is_active")
add("filter_eq", lambda t: t.forecast_results.where(col("is_latest_forecast") & (col("days_ahead") == 1)).select(
    "sku_id", "master_store_id", "forecast_date"),
    "SELECT sku_id, master_store_id, forecast_date FROM forecast_results WHERE is_latest_forecast AND days_ahead = 1")
add("filter_ne", lambda t: t.dim_idea.where(col("stage") != "Rejected").select("idea_id", "stage"),
    "SELECT idea_id, stage FROM dim_idea WHERE stage <> 'Rejected'")
add("filter_range", lambda t: t.flagged_inventory.where((col("total_stock") >= 10) & (col("total_stock") < 20)).select(
    "sku_id", "master_store_id", "total_stock"),
    "SELECT sku_id, master_store_id, total_stock FROM flagged_inventory WHERE total_stock >= 10 AND total_stock < 20")
add("filter_between", lambda t: t.raw_marketing_data.where(
    F.lit(AS_OF_SALES).between(col("start_date"), col("end_date"))).select("res_id", "campaign_id", "date"),
    f"SELECT res_id, campaign_id, date FROM raw_marketing_data WHERE {S} BETWEEN start_date AND end_date")
add("filter_half_open", lambda t: t.dim_ingredient_price.where(
    fn.in_force("effective_from", "effective_to", AS_OF_INVENTORY)).select("price_id", "effective_from"),
    f"""SELECT price_id, effective_from FROM dim_ingredient_price
        WHERE effective_from <= {I} AND {I} < coalesce(effective_to, DATE '9999-12-31')""")
add("filter_in_list", lambda t: t.dim_idea.where(col("stage").isin("Capture", "Triage", "Feasibility")).select(
    "idea_id", "stage"), "SELECT idea_id, stage FROM dim_idea WHERE stage IN ('Capture', 'Triage', 'Feasibility')")
add("filter_not_in_null_arm", lambda t: t.dim_idea.where(
    col("stage").isNull() | ~col("stage").isin("Rejected", "Launch")).select("idea_id", "stage"),
    "SELECT idea_id, stage FROM dim_idea WHERE coalesce(stage, '') NOT IN ('Rejected', 'Launch')")
add("filter_null_sentinel", lambda t: t.dim_recipe.where(G.condition(
    {"field": "parent_recipe_id", "op": "ne", "value": None})).select("recipe_id", "parent_recipe_id"),
    "SELECT recipe_id, parent_recipe_id FROM dim_recipe WHERE parent_recipe_id IS NOT NULL")
add("filter_contains", lambda t: t.customer_complaint_events.where(
    fn.contains_any("issue_type", ["Late", "late"])).select("email_message_id", "issue_type"),
    """SELECT email_message_id, issue_type FROM customer_complaint_events
       WHERE contains(issue_type, 'Late') OR contains(issue_type, 'late')""")
add("filter_regex_any", lambda t: t.customer_complaint_events.where(fn.matches_any("issue_type", OPS_RX)).select(
    "email_message_id", "issue_type"),
    f"""SELECT email_message_id, issue_type FROM customer_complaint_events
        WHERE regexp_matches(lower(coalesce(issue_type, '')), '{OPS_RX}')""")
add("filter_all_of", lambda t: t.flagged_inventory.where(G.condition({"all": [
    {"field": "total_stock", "op": "lte", "value": 5}, {"field": "wastage_flag", "op": "eq", "value": "A"},
    {"field": "shelf_life_days", "op": "gt", "value": 20}]})).select("sku_id", "master_store_id", "report_date"),
    """SELECT sku_id, master_store_id, report_date FROM flagged_inventory
       WHERE total_stock <= 5 AND wastage_flag = 'A' AND shelf_life_days > 20""")
add("filter_col_ref", lambda t: t.flagged_inventory.where(G.condition(
    {"field": "total_stock", "op": "lt", "ref": "shelf_life_days"})).select("sku_id", "master_store_id", "total_stock"),
    "SELECT sku_id, master_store_id, total_stock FROM flagged_inventory WHERE total_stock < shelf_life_days")

PRE_AGG = {"group_by": ["store_id"],
           "filter_rows": {"compute": [{"as": "days_left", "days_until": "expiry_date"}],
                           "where": [{"field": "days_left", "op": "gte", "value": 0}]},
           "agg": [{"as": "units", "op": "sum", "col": "available_quantity"},
                   {"as": "soonest", "op": "min", "col": "expiry_date"}]}
add("filter_pre_agg", lambda t: G.rollup(t.store_inventory_daily, PRE_AGG, AS_OF_INVENTORY),
    f"""SELECT store_id, sum(available_quantity) AS units, min(expiry_date) AS soonest
        FROM store_inventory_daily WHERE expiry_date >= {I} GROUP BY store_id""")
add("filter_post_agg", lambda t: complaints.ops_counts(t, AS_OF_SALES).where("ops_complaints >= 3").select(
    "master_store_id", "ops_complaints"),
    "SELECT master_store_id, ops_complaints FROM ops_by_store WHERE ops_complaints >= 3")


def trailing(days):
    return lambda t: t.business_analytics.where(fn.in_trailing_days("order_date", AS_OF_SALES, days)).select(
        "online_order_id", "sku_id", "order_date")


add("filter_trailing_days", trailing(90),
    f"SELECT online_order_id, sku_id, order_date FROM business_analytics WHERE order_date >= {S} - 90")
add("filter_month_to_date", lambda t: t.raw_marketing_data.where(
    col("date") >= F.trunc(F.lit(marketing_day()), "MM")).select("res_id", "campaign_id", "date"),
    f"SELECT res_id, campaign_id, date FROM raw_marketing_data WHERE date >= date_trunc('month', {C})")


def marketing_day():
    from tallyroom.constants import AS_OF_CAMPAIGN
    return AS_OF_CAMPAIGN


add("filter_presence_text", lambda t: t.product_packaging.where(fn.is_present("org_labelling_compliance")).select(
    "sku", "org_labelling_compliance"),
    """SELECT sku, org_labelling_compliance FROM product_packaging
       WHERE trim(org_labelling_compliance) <> '' AND trim(org_labelling_compliance) <> 'false'""")
add("filter_entity_where", lambda t: recipes.v_recipe_cogs(t, AS_OF_INVENTORY).where(G.condition(
    {"field": "status", "op": "in", "value": ["Draft", "InTrial"]})).select("recipe_id", "status", "target_fit"),
    "SELECT recipe_id, status, target_fit FROM recipe_costs WHERE status IN ('Draft', 'InTrial')")

# ---- joins -------------------------------------------------------------------------------------
add("join_inner", lambda t: t.dim_product.join(t.dim_category, "category_id").select("sku", "category_name"),
    "SELECT sku, category_name FROM dim_product JOIN dim_category USING (category_id)")
add("join_left", lambda t: t.dim_product.select("sku").join(
    t.map_product_allergen.distinct(), "sku", "left"),
    "SELECT p.sku, a.allergen FROM dim_product p LEFT JOIN (SELECT DISTINCT * FROM map_product_allergen) a USING (sku)")
add("join_left_using", lambda t: t.dim_product.join(t.product_pricing, "sku", "left").select(
    "sku", "display_name", "shelf_life_days"),
    "SELECT sku, display_name, shelf_life_days FROM dim_product LEFT JOIN product_pricing USING (sku)")
add("join_left_extra_pred", lambda t: t.dim_competitor_product.join(
    t.dim_competitor.where("is_active").select("competitor_id", "competitor_name"), "competitor_id", "left").select(
    "competitor_product_id", "competitor_id", "competitor_name"),
    """SELECT p.competitor_product_id, p.competitor_id, m.competitor_name FROM dim_competitor_product p
       LEFT JOIN dim_competitor m ON m.competitor_id = p.competitor_id AND m.is_active""")
add("join_full_outer", lambda t: (
    t.forecast_results.groupBy(col("master_store_id").alias("store_id"), col("sku_id").alias("product_sku"))
    .agg(F.sum("predicted_sales_quantity").alias("forecast"))
    .join(t.store_inventory_daily.groupBy("store_id", "product_sku").agg(F.sum("available_quantity").alias("stock")),
          ["store_id", "product_sku"], "full").fillna(0, ["forecast", "stock"])),
    """SELECT store_id, product_sku, coalesce(forecast, 0) AS forecast, coalesce(stock, 0) AS stock
       FROM (SELECT master_store_id AS store_id, sku_id AS product_sku, sum(predicted_sales_quantity) AS forecast
             FROM forecast_results GROUP BY ALL) FULL JOIN
            (SELECT store_id, product_sku, sum(available_quantity) AS stock FROM store_inventory_daily GROUP BY ALL)
       USING (store_id, product_sku)""")
add("join_chain", lambda t: J.left_join(J.left_join(
    t.customer_complaint_events.select("email_message_id", "order_id"),
    t.business_analytics.select(col("online_order_id").alias("order_id"), "store_id", "sku_id"),
    ["order_id"], ["email_message_id"]),
    t.low_stock_config.select("store_id", "sku_id", "min_count"), ["store_id", "sku_id"], ["email_message_id"]),
    """SELECT c.email_message_id, c.order_id, b.store_id, b.sku_id, l.min_count FROM customer_complaint_events c
       LEFT JOIN business_analytics b ON b.online_order_id = c.order_id
       LEFT JOIN low_stock_config l ON l.store_id = b.store_id AND l.sku_id = b.sku_id""")
add("join_multi_key", lambda t: marketing.v_segment_budget(t).groupBy("segment_id", "budget_month").agg(
    F.count("*").alias("rows")), "SELECT segment_id, budget_month, count(*) AS rows FROM budget_rows GROUP BY ALL")
add("join_cross_scalar", lambda t: t.dim_product.select("sku").withColumn(
    "portfolio_max", ideas.cost_envelope(t).select("hi").scalar()),
    "SELECT sku, (SELECT max(max_cogs_inr) FROM capability) AS portfolio_max FROM dim_product")
add("join_cross_filtered", lambda t: recipes.candidate_counts(t, AS_OF_INVENTORY),
    """SELECT r.recipe_id, (SELECT count(*) FROM swap_pool) - count(s.ingredient_id) AS n_cand
       FROM dim_recipe r LEFT JOIN own_items o USING (recipe_id)
       LEFT JOIN swap_pool s ON s.ingredient_id = o.ingredient_id GROUP BY r.recipe_id""")
add("join_normalised_key", lambda t: t.dim_category.withColumn("k", fn.match_key("category_name")).join(
    t.dim_competitor.select("competitor_id", fn.match_key("category").alias("k")), "k").select(
    "category_name", "competitor_id"),
    """SELECT category_name, competitor_id FROM dim_category, dim_competitor
       WHERE upper(trim(category)) = upper(trim(category_name))""")
add("join_cast_key", lambda t: inventory.v_transfer_route(t).join(
    t.master_store.select(col("master_store_id").alias("to_store_id"), "store_name"), "to_store_id").select(
    "from_store_id", "to_store_id", "store_name"),
    """SELECT CAST(r.from_store_id AS VARCHAR) AS from_store_id, s.master_store_id AS to_store_id, s.store_name
       FROM store_transfer_distances r JOIN master_store s ON s.master_store_id = CAST(r.to_store_id AS VARCHAR)""")
add("join_in_list", lambda t: J.join_any_id(
    t.raw_marketing_data.select("res_id", "campaign_id", "date"), "res_id", t.store_channel_mapping,
    {"zomato_id": "ZOMATO", "swiggy_id": "SWIGGY"}, tag="platform"),
    "SELECT res_id, campaign_id, date, master_store_id, platform FROM store_ads")
add("join_text_contains", lambda t: J.longest_term(
    t.customer_review_events.select("review_id", "review_text"), "review_text", "review_id",
    products.families(t).select("fam", "sku"), "fam", "sku").select("review_id", "sku"),
    """SELECT v.review_id, f.sku FROM customer_review_events v
       LEFT JOIN (SELECT upper(fam) AS fam, min(sku) AS sku FROM family_list GROUP BY 1) f
         ON contains(upper(v.review_text), f.fam)
       QUALIFY row_number() OVER (PARTITION BY v.review_id ORDER BY length(f.fam) DESC NULLS LAST, f.fam) = 1""")
add("join_regex", lambda t: recipes.tag_by_regex(t), "SELECT ingredient_id, tag FROM ingredient_tags")
add("join_validity_asof", lambda t: SNAP.in_force_row(
    t.dim_ingredient_price, ["ingredient_id"], "effective_from", "effective_to", AS_OF_INVENTORY,
    ["price_id", "price_inr"]).select("ingredient_id", "price_id", "effective_from", "effective_to"),
    f"""SELECT ingredient_id, price_id, effective_from, effective_to FROM dim_ingredient_price
        WHERE effective_from <= {I} AND (effective_to > {I} OR effective_to IS NULL)
        QUALIFY row_number() OVER (PARTITION BY ingredient_id ORDER BY effective_from DESC, price_id DESC) = 1""")
add("join_same_day_trace", lambda t: J.join_same_day(
    t.business_analytics.select("online_order_id", "store_id", "sku_id", "order_date"),
    t.order_day_inventory.groupBy("store_id", "product_sku", "snapshot_date").agg(
        F.min("expiry_date").alias("soonest")),
    {"store_id": "store_id", "sku_id": "product_sku", "order_date": "snapshot_date"}),
    """SELECT b.online_order_id, b.store_id, b.sku_id, b.order_date, i.soonest FROM business_analytics b
       LEFT JOIN (SELECT store_id, product_sku, snapshot_date, min(expiry_date) AS soonest FROM order_day_inventory
                  GROUP BY ALL) i
         ON i.store_id = b.store_id AND i.product_sku = b.sku_id AND i.snapshot_date = b.order_date""")
add("join_self_parent", lambda t: J.attach_parent(
    t.dim_recipe.where("parent_recipe_id IS NOT NULL").select("recipe_id", "parent_recipe_id"), "parent_recipe_id",
    t.map_recipe_ingredient.select(col("recipe_id"), "ingredient_id", "qty_net_g"), "recipe_id"),
    """SELECT c.recipe_id, c.parent_recipe_id, l.ingredient_id, l.qty_net_g
       FROM dim_recipe c JOIN map_recipe_ingredient l ON l.recipe_id = c.parent_recipe_id""")
add("semi_exists", lambda t: t.dim_product.join(
    t.map_product_allergen.select("sku"), "sku", "left_semi").select("sku"),
    "SELECT sku FROM dim_product p WHERE EXISTS (SELECT 1 FROM map_product_allergen a WHERE a.sku = p.sku)")
add("anti_not_exists", lambda t: t.dim_product.join(t.map_product_allergen, "sku", "left_anti").select("sku"),
    "SELECT sku FROM dim_product p WHERE NOT EXISTS (SELECT 1 FROM map_product_allergen a WHERE a.sku = p.sku)")
add("anti_not_in_correlated", lambda t: t.dim_recipe.where("parent_recipe_id IS NOT NULL").select(
    "recipe_id", "parent_recipe_id").join(
    t.map_recipe_ingredient.select(col("recipe_id").alias("parent_recipe_id"), "ingredient_id").distinct(),
    "parent_recipe_id").join(recipes.recipe_members(t), ["recipe_id", "ingredient_id"], "left_anti"),
    """SELECT DISTINCT c.recipe_id, c.parent_recipe_id, l.ingredient_id FROM dim_recipe c
       JOIN map_recipe_ingredient l ON l.recipe_id = c.parent_recipe_id
       WHERE l.ingredient_id NOT IN (SELECT ingredient_id FROM map_recipe_ingredient m WHERE m.recipe_id = c.recipe_id)""")
add("semi_in_correlated", lambda t: t.dim_recipe.where("parent_recipe_id IS NOT NULL").select(
    "recipe_id", "parent_recipe_id").join(
    t.map_recipe_ingredient.select(col("recipe_id").alias("parent_recipe_id"), "role").distinct(), "parent_recipe_id")
    .join(t.map_recipe_ingredient.select("recipe_id", "role"), ["recipe_id", "role"], "left_semi"),
    """SELECT DISTINCT c.recipe_id, c.parent_recipe_id, l.role FROM dim_recipe c
       JOIN map_recipe_ingredient l ON l.recipe_id = c.parent_recipe_id
       WHERE l.role IN (SELECT role FROM map_recipe_ingredient m WHERE m.recipe_id = c.recipe_id)""")


def broken_by_recipe(t):
    """Rules that each recipe's ingredients break: tags and bans stay arrays on
    their own rows, so one join per line is enough."""
    tags = t.dim_ingredient.select("ingredient_id", recipes.name_tags(col("ingredient_name")).alias("tags"))
    return (recipes.recipe_members(t).join(tags, "ingredient_id").join(recipes.recipe_bans(t), "recipe_id")
            .withColumn("broken", F.array_join(recipes.broken_rules(col("bans"), col("tags")), "+"))
            .select("recipe_id", "ingredient_id", "broken"))


add("scalar_corr_agg", broken_by_recipe, """
    SELECT o.recipe_id, o.ingredient_id, coalesce((
             SELECT string_agg(DISTINCT r.rule, '+' ORDER BY r.rule) FROM ingredient_tags g
             JOIN recipe_rules r ON r.banned_tag = g.tag
             WHERE r.recipe_id = o.recipe_id AND g.ingredient_id = o.ingredient_id), '') AS broken
    FROM own_items o""")
config_edges = lambda t: t.low_stock_config.select(
    col("sku_id").alias("src"), col("store_id").alias("dst"), "min_days_shelf_life", "min_count")
add("link_bring", lambda t: G.link_bring(
    t.flagged_inventory.select("sku_id", "master_store_id", "report_date"), config_edges(t), "sku_id",
    ["min_days_shelf_life", "min_count"], match="master_store_id"),
    """SELECT f.sku_id, f.master_store_id, f.report_date, l.min_days_shelf_life, l.min_count FROM flagged_inventory f
       LEFT JOIN low_stock_config l ON l.sku_id = f.sku_id AND l.store_id = f.master_store_id""")
add("link_pick_min", lambda t: t.master_store.select("master_store_id").join(
    J.nearest_link(inventory.v_transfer_route(t), "from_store_id", "to_store_id", "distance_km").select(
        col("from_store_id").alias("master_store_id"), col("to_store_id").alias("nearest_store_id"), "distance_km"),
    "master_store_id", "left"),
    """SELECT s.master_store_id, n.nearest_store_id, n.distance_km FROM master_store s
       LEFT JOIN nearest n ON n.store_id = s.master_store_id""")
add("link_bring_target", lambda t: G.resolve_names(
    products.v_product_ingredient(t), "ingredient_id",
    inventory.names_of(t.dim_ingredient, "ingredient_id", "ingredient_name"), "material_name"),
    """SELECT m.sku, m.ingredient_id, i.ingredient_name AS material_name FROM members m
       LEFT JOIN dim_ingredient i USING (ingredient_id)""")
add("link_related_grouped", lambda t: graph.related_grouped(SET.union_rows(
    graph.load_edges(t.map_product_channel, "stocked_at", "sku", "channel_id"),
    graph.load_edges(t.map_product_allergen, "declares_allergen", "sku", "allergen"))).select(
    "src", "type", F.array_join("neighbours", ",").alias("neighbours")),
    """SELECT src, type, string_agg(dst, ',' ORDER BY dst) AS neighbours FROM (
         SELECT DISTINCT sku AS src, 'stocked_at' AS type, channel_id AS dst FROM map_product_channel
         UNION SELECT sku, 'declares_allergen', allergen FROM map_product_allergen) GROUP BY ALL""")
add("resolve_names", lambda t: G.resolve_names(
    t.forecast_results.groupBy("master_store_id").agg(F.count("*").alias("rows")), "master_store_id",
    inventory.names_of(t.master_store, "master_store_id", "store_name"), "store_name"),
    """SELECT f.master_store_id, count(*) AS rows, min(s.store_name) AS store_name FROM forecast_results f
       LEFT JOIN master_store s USING (master_store_id) GROUP BY f.master_store_id""")

# ---- aggregates ------------------------------------------------------------------------------------
add("agg_group", lambda t: t.business_analytics.groupBy("store_id", "order_state").agg(
    F.sum("quantity").alias("units"), F.sum("total").cast("double").alias("revenue")),
    """SELECT store_id, order_state, sum(quantity) AS units, CAST(sum(total) AS DOUBLE) AS revenue
       FROM business_analytics GROUP BY ALL""")
add("agg_global", lambda t: t.business_analytics.agg(F.sum("total").cast("double").alias("revenue"),
                                                     F.max("order_date").alias("last_day")),
    "SELECT CAST(sum(total) AS DOUBLE) AS revenue, max(order_date) AS last_day FROM business_analytics")
add("agg_count_star", lambda t: t.map_recipe_ingredient.groupBy("role").agg(F.count("*").alias("lines")),
    "SELECT role, count(*) AS lines FROM map_recipe_ingredient GROUP BY role")
add("agg_count_distinct", lambda t: t.map_product_channel.groupBy("channel_id").agg(
    F.count_distinct("sku").alias("skus")),
    "SELECT channel_id, count(DISTINCT sku) AS skus FROM map_product_channel GROUP BY channel_id")
add("agg_count_distinct_if", lambda t: t.map_product_channel.groupBy("sku").agg(
    F.count_distinct(F.when(col("applicable").isNotNull(), col("channel_id"))).alias("listed")),
    """SELECT sku, count(DISTINCT CASE WHEN applicable IS NOT NULL THEN channel_id END) AS listed
       FROM map_product_channel GROUP BY sku""")
add("agg_countif", lambda t: t.flagged_inventory.groupBy("master_store_id").agg(
    F.count_if("low_stock_flag").alias("low")),
    "SELECT master_store_id, count(*) FILTER (low_stock_flag) AS low FROM flagged_inventory GROUP BY 1")
add("agg_sum_if", lambda t: t.business_analytics.groupBy("sku_id").agg(
    fn.sum_if(col("order_date") >= F.lit(AS_OF_SALES.replace(month=6)), "quantity").alias("recent_or_null"),
    fn.sum_if(col("order_date") >= F.lit(AS_OF_SALES.replace(month=6)), "quantity", otherwise=0.0).alias("recent_or_0")),
    """SELECT sku_id, sum(quantity) FILTER (order_date >= DATE '2001-06-01') AS recent_or_null,
              sum(CASE WHEN order_date >= DATE '2001-06-01' THEN quantity ELSE 0 END) AS recent_or_0
       FROM business_analytics GROUP BY sku_id""")
for name, f in {"sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max}.items():
    add(f"agg_{name}", (lambda f: lambda t: t.flagged_inventory.groupBy("master_store_id").agg(
        F.round(f("total_stock"), 6).alias("stock")))(f),
        f"SELECT master_store_id, round({name}(total_stock), 6) AS stock FROM flagged_inventory GROUP BY 1")
add("agg_any_value", lambda t: t.business_analytics.groupBy("sku_id").agg(F.min("item_source_name").alias("item_name")),
    "SELECT sku_id, any_value(item_source_name) AS item_name FROM business_analytics GROUP BY sku_id")
add("agg_any_value_expr", lambda t: J.join_any_id(
    t.raw_marketing_data.select("res_id", "campaign_id").distinct(), "res_id", t.store_channel_mapping,
    {"zomato_id": "ZOMATO", "swiggy_id": "SWIGGY"}, tag="platform").groupBy("master_store_id", "campaign_id").agg(
    F.min("platform").alias("platform")),
    "SELECT master_store_id, campaign_id, min(platform) AS platform FROM store_ads GROUP BY ALL")
add("agg_string_ordered", lambda t: t.product_highlight.groupBy("sku").agg(
    F.expr("string_agg(highlight_text, ' | ') WITHIN GROUP (ORDER BY highlight_seq DESC)").alias("claims")),
    """SELECT sku, string_agg(highlight_text, ' | ' ORDER BY highlight_seq DESC) AS claims
       FROM product_highlight GROUP BY sku""")
add("agg_string_distinct", lambda t: t.map_recipe_ingredient.select("recipe_id", "role").distinct().groupBy(
    "recipe_id").agg(F.expr("string_agg(role, '+') WITHIN GROUP (ORDER BY role)").alias("roles")),
    "SELECT recipe_id, string_agg(DISTINCT role, '+' ORDER BY role) AS roles FROM map_recipe_ingredient GROUP BY 1")
add("agg_string_skip_null", lambda t: t.map_product_channel.select("sku", "applicable").distinct().groupBy("sku").agg(
    F.expr("string_agg(applicable, ',') WITHIN GROUP (ORDER BY applicable)").alias("formats")),
    "SELECT sku, string_agg(DISTINCT applicable, ',' ORDER BY applicable) AS formats FROM map_product_channel GROUP BY 1")
add("agg_string_unordered", lambda t: t.product_highlight.groupBy("sku").agg(
    F.expr("string_agg(highlight_text, ' ') WITHIN GROUP (ORDER BY highlight_seq)").alias("claims")),
    """SELECT sku, string_agg(highlight_text, ' ' ORDER BY highlight_seq) AS claims
       FROM product_highlight GROUP BY sku""")
add("agg_ratio_of_sums", lambda t: t.raw_marketing_data.groupBy("campaign_id").agg(
    fn.safe_divide(F.sum("ad_sales_rs"), F.sum("ad_spend_rs")).alias("roi")),
    """SELECT campaign_id, CAST(sum(ad_sales_rs) AS DOUBLE) / nullif(CAST(sum(ad_spend_rs) AS DOUBLE), 0) AS roi
       FROM raw_marketing_data GROUP BY 1""")
add("agg_share_pct", lambda t: t.listing_claim_check.groupBy("sku").agg(
    fn.share_pct(col("verdict") == "substantiated").alias("pct")),
    """SELECT sku, round(count(*) FILTER (verdict = 'substantiated') * 100.0 / count(*), 1) AS pct
       FROM listing_claim_check GROUP BY sku""")
add("agg_distinct_rows", lambda t: t.map_product_allergen.select("sku").distinct(),
    "SELECT DISTINCT sku FROM map_product_allergen")
add("agg_pre_join", lambda t: t.dim_category.select("category_name").join(
    products.channel_coverage(t), "category_name", "left").join(products.presence_counts(t), "category_name", "left"),
    """SELECT d.category_name, n.channels_listed, n.channels_mapped, p.* EXCLUDE (category_name) FROM dim_category d
       LEFT JOIN category_channels n USING (category_name) LEFT JOIN category_presence p USING (category_name)""")
add("agg_two_level", lambda t: t.map_recipe_ingredient.groupBy("ingredient_id", "role").agg(F.count("*").alias("n"))
    .groupBy("ingredient_id").agg(F.count("*").alias("roles"), F.max("n").alias("most")),
    """SELECT ingredient_id, count(*) AS roles, max(n) AS most FROM (
         SELECT ingredient_id, role, count(*) AS n FROM map_recipe_ingredient GROUP BY ALL) GROUP BY 1""")
add("agg_mode", lambda t: K.commonest(t.map_recipe_ingredient, "ingredient_id", "role"),
    "SELECT ingredient_id, role FROM main_roles")
ROLLUP = {"group_by": ["store_id", "product_sku"],
          "agg": [{"as": "units", "op": "sum", "col": "available_quantity"},
                  {"as": "soonest", "op": "min", "col": "expiry_date"},
                  {"as": "batches", "op": "count", "col": "batch_row_number"},
                  {"as": "any_day", "op": "first", "col": "snapshot_date"}]}
ROLLUP_SQL = """SELECT store_id, product_sku, sum(available_quantity) AS units, min(expiry_date) AS soonest,
    count(batch_row_number) AS batches, min(snapshot_date) AS any_day FROM store_inventory_daily GROUP BY ALL"""
add("agg_rollup_dsl", lambda t: G.rollup(t.store_inventory_daily, ROLLUP, AS_OF_INVENTORY), ROLLUP_SQL)
add("agg_flag_sum", lambda t: complaints.ops_counts(t, AS_OF_SALES), "SELECT * FROM ops_by_store")
add("agg_conditional_amount", lambda t: t.store_inventory_daily.groupBy("store_id").agg(
    F.sum(F.when(fn.days_until("expiry_date", AS_OF_INVENTORY) <= 3, col("available_quantity")).otherwise(0.0)).alias(
        "expiring_qty")),
    f"""SELECT store_id, sum(CASE WHEN expiry_date - {I} <= 3 THEN available_quantity ELSE 0 END) AS expiring_qty
        FROM store_inventory_daily GROUP BY store_id""")

# ---- windows ---------------------------------------------------------------------------------------
add("win_latest_row", lambda t: inventory.v_stocked_at(t).select("master_store_id", "sku_id", "total_stock"),
    "SELECT master_store_id, sku_id, total_stock FROM stocked")
add("win_qualify", lambda t: SNAP.latest_row(t.forecast_results, ["sku_id"], "forecast_date", [
    "master_store_id", "days_ahead", "predicted_sales_quantity"]).select(
    "sku_id", "master_store_id", "forecast_date", "predicted_sales_quantity"),
    """SELECT sku_id, master_store_id, forecast_date, predicted_sales_quantity FROM forecast_results
       QUALIFY row_number() OVER (PARTITION BY sku_id ORDER BY forecast_date DESC, master_store_id DESC,
                                  days_ahead DESC, predicted_sales_quantity DESC) = 1""")
add("win_qualify_over_agg", lambda t: K.first_per(
    t.business_analytics.groupBy("store_id", "sku_id").agg(F.count("*").alias("n")), ["store_id"],
    [F.desc("n"), F.asc("sku_id")]),
    """SELECT store_id, sku_id, count(*) AS n FROM business_analytics GROUP BY store_id, sku_id
       QUALIFY row_number() OVER (PARTITION BY store_id ORDER BY count(*) DESC, sku_id) = 1""")
add("win_latest_snapshot", lambda t: SNAP.latest_snapshot(t.store_inventory_daily, ["store_id"], "snapshot_date"),
    "SELECT * FROM newest_stock")
add("win_latest_global", lambda t: SNAP.latest_global(t.store_inventory_daily, "snapshot_date"),
    "SELECT * FROM store_inventory_daily WHERE snapshot_date = (SELECT max(snapshot_date) FROM store_inventory_daily)")
add("win_share_of_total", lambda t: K.share_of_total(
    t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", col("l_extendedprice").cast("decimal(18,2)").alias("amt")),
    ["l_orderkey"], "amt", "share_pct").drop("amt"),
    """SELECT l_orderkey, l_linenumber, l_partkey,
              round(l_extendedprice / CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) OVER (PARTITION BY l_orderkey)
                    AS DOUBLE) * 100, 1) AS share_pct FROM lineitem""")
add("win_count_all", lambda t: K.top_n(t.map_recipe_ingredient.select("recipe_id", "ingredient_id").distinct(),
                                       ["recipe_id"], [F.asc("ingredient_id")], 2).join(
    recipes.recipe_members(t).groupBy("recipe_id").agg(F.count("*").alias("n_all")), "recipe_id"),
    """SELECT recipe_id, ingredient_id, row_number() OVER (PARTITION BY recipe_id ORDER BY ingredient_id) AS rnk,
              count(*) OVER (PARTITION BY recipe_id) AS n_all FROM own_items QUALIFY rnk <= 2""")
add("win_topn_group", lambda t: K.top_n(
    t.business_analytics.select("store_id", "online_order_id", "sku_id", col("total").cast("double").alias("total")),
    ["store_id"], [F.desc("total"), F.asc("online_order_id"), F.asc("sku_id")], 12),
    """SELECT store_id, online_order_id, sku_id, CAST(total AS DOUBLE) AS total,
              row_number() OVER (PARTITION BY store_id ORDER BY total DESC, online_order_id, sku_id) AS rnk
       FROM business_analytics QUALIFY rnk <= 12""")
add("win_topn_two_keys", lambda t: K.top_n(
    t.map_recipe_ingredient.select("recipe_id", "role", "ingredient_id", "qty_net_g"), ["recipe_id", "role"],
    [F.desc("qty_net_g"), F.asc("ingredient_id")], 2),
    """SELECT recipe_id, role, ingredient_id, qty_net_g,
              row_number() OVER (PARTITION BY recipe_id, role ORDER BY qty_net_g DESC, ingredient_id) AS rnk
       FROM map_recipe_ingredient QUALIFY rnk <= 2""")
add("win_longest_match", lambda t: K.first_per(
    products.families(t).select(F.substring("fam", 1, 1).alias("initial"), "fam"), ["initial"],
    [F.length("fam").desc(), F.asc("fam")]),
    """SELECT substr(fam, 1, 1) AS initial, fam FROM family_list
       QUALIFY row_number() OVER (PARTITION BY substr(fam, 1, 1) ORDER BY length(fam) DESC, fam) = 1""")
add("win_best_span", lambda t: K.best_span(
    t.events.select("user_id", "event_type", fn.day_index("ts").alias("n")), ["user_id", "event_type"], "n", 14),
    """SELECT user_id, event_type, n AS window_first, window_last, CAST(hits AS BIGINT) AS hits FROM (
         SELECT user_id, event_type, n, count(*) OVER w AS hits, max(n) OVER w AS window_last
         FROM (SELECT user_id, event_type, date_diff('day', DATE '2026-01-01', CAST(ts AS DATE)) AS n FROM events)
         WINDOW w AS (PARTITION BY user_id, event_type ORDER BY n RANGE BETWEEN CURRENT ROW AND 14 FOLLOWING))
       QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY hits DESC, n) = 1""")
add("win_dense_rank", lambda t: K.exact_rank(
    ideas.v_idea_priority_inputs(t, AS_OF_SALES).select("idea_id", "stage_rank", "days_in_stage"), [],
    [-F.coalesce("stage_rank", F.lit(0)), -F.coalesce("days_in_stage", F.lit(-1))], [F.asc("idea_id")], "rank"),
    """SELECT idea_id, stage_rank, days_in_stage, row_number() OVER (
         ORDER BY coalesce(stage_rank, 0) DESC, coalesce(days_in_stage, -1) DESC, idea_id) AS rank FROM idea_inputs""")
add("win_prev_month", lambda t: marketing.with_previous_month(marketing.v_store_campaign_history(t)).select(
    "master_store_id", "campaign_id", "month", "roi", "prev_roi", "prev_spend_rs"),
    """SELECT master_store_id, campaign_id, month, roi,
              CASE WHEN lag(month) OVER w = month - INTERVAL 1 MONTH THEN lag(roi) OVER w END AS prev_roi,
              CASE WHEN lag(month) OVER w = month - INTERVAL 1 MONTH THEN lag(ad_spend_rs) OVER w END AS prev_spend_rs
       FROM campaign_months WINDOW w AS (PARTITION BY master_store_id, campaign_id ORDER BY month)""")

# ---- sorts and limits ---------------------------------------------------------------------------------
add("sort_by", lambda t: t.dim_competitor.select("competitor_id", "category").orderBy("category", "competitor_id"),
    "SELECT competitor_id, category FROM dim_competitor ORDER BY category, competitor_id")
add("sort_desc_by_negation", lambda t: G.post(complaints.ops_counts(t, AS_OF_SALES), {
    "compute": [{"as": "neg_ops", "sub": [0, "ops_complaints"]}], "sort_by": "neg_ops"}, AS_OF_SALES).select(
    "master_store_id", "neg_ops"),
    "SELECT master_store_id, 0 - ops_complaints AS neg_ops FROM ops_by_store ORDER BY neg_ops")
add("sort_topk", lambda t: inventory.v_stocked_at(t).select("sku_id", "master_store_id", "total_stock").orderBy(
    F.desc("total_stock"), "sku_id", "master_store_id").limit(50),
    """SELECT sku_id, master_store_id, total_stock FROM stocked
       ORDER BY total_stock DESC, sku_id, master_store_id LIMIT 50""")
add("sort_sql_desc", lambda t: t.business_analytics.groupBy("sku_id").agg(
    F.sum("total").cast("double").alias("revenue")).orderBy(F.desc("revenue")),
    "SELECT sku_id, CAST(sum(total) AS DOUBLE) AS revenue FROM business_analytics GROUP BY 1 ORDER BY revenue DESC")
add("limit_n", lambda t: t.dim_product.select("sku", "display_name").orderBy("sku").limit(120),
    "SELECT sku, display_name FROM dim_product ORDER BY sku LIMIT 120")
add("sort_importance_tag", lambda t: ideas.v_triage_similarity_candidates(t, AS_OF_SALES).groupBy("src").agg(
    F.count("*").alias("rows")).orderBy("src"),
    "SELECT src, count(*) AS rows FROM triage_rows GROUP BY src ORDER BY src")
add("sort_priority_band", lambda t: marketing.sort_by_band(marketing.campaign_ladder(
    marketing.v_store_campaign_current(t, marketing_day())).select("master_store_id", "campaign_id", "priority"),
    "master_store_id", "campaign_id"),
    """SELECT master_store_id, campaign_id, priority,
              CAST(CASE priority WHEN 'HIGH' THEN 1 WHEN 'MEDIUM' THEN 2 ELSE 3 END AS BIGINT) AS band_order
       FROM campaign_now_acted ORDER BY band_order, master_store_id, campaign_id""")
add("sort_event_type", lambda t: marketing.upcoming_events(t.calendar_events, AS_OF_SALES.replace(month=6)).orderBy(
    "event_date", "type_order", "title").select("title", "event_date", "event_type",
                                                col("type_order").cast("bigint").alias("type_order")),
    """SELECT title, event_date, event_type, CAST(list_position(['Global', 'National', 'Cultural', 'Religious',
              'Marketing/Seasonal', 'Regional', 'Industry'], event_type) AS BIGINT) AS type_order
       FROM calendar_events WHERE event_date BETWEEN DATE '2001-06-01' AND DATE '2001-06-01' + 42""")

# ---- set operators ----------------------------------------------------------------------------------------
add("set_union_all", lambda t: SET.union_rows(
    t.forecast_results.select("sku_id"), t.flagged_inventory.select("sku_id")).groupBy("sku_id").agg(
    F.count("*").alias("rows")),
    """SELECT sku_id, count(*) AS rows FROM (SELECT sku_id FROM forecast_results UNION ALL
       SELECT sku_id FROM flagged_inventory) GROUP BY 1""")
add("set_union_distinct", lambda t: SET.union_rows(
    t.map_product_allergen.select("sku"), t.map_product_channel.select("sku")).distinct(),
    "SELECT sku FROM map_product_allergen UNION SELECT sku FROM map_product_channel")
add("set_union_preferred", lambda t: products.v_product_ingredient(t), "SELECT sku, ingredient_id FROM members")
add("set_tagged_union", lambda t: SET.tagged_union(
    P=t.dim_product.select(col("sku").alias("id"), col("display_name").alias("nm")),
    I=t.dim_ingredient.select(col("ingredient_id").alias("id"), col("ingredient_name").alias("nm"))),
    """SELECT 'P' AS src, sku AS id, display_name AS nm FROM dim_product
       UNION ALL SELECT 'I', ingredient_id, ingredient_name FROM dim_ingredient""")
add("set_sentinel_row", lambda t: quality.dq_truncation_check(SET.union_rows(
    t.dim_product.select(F.lit("2_PORT").alias("src"), col("sku").alias("id")),
    t.spark.range(1).select(F.lit("9_END").alias("src"), F.lit("END").alias("id")))),
    "SELECT count(*) + 1 AS rows, true AS is_complete FROM dim_product")
add("set_concat_gated", lambda t: SET.concat_unless_rejected([
    (t.dim_product.where("is_active").select("sku"), False),
    (t.dim_product.where("NOT is_active").select("sku"), True)]), "SELECT sku FROM dim_product WHERE is_active")
add("set_missing_values", lambda t: SET.missing_values(
    t.business_analytics, "sku_id", t.business_analytics, "order_state"),
    """SELECT s.sku_id, v.order_state FROM (SELECT DISTINCT sku_id FROM business_analytics) s,
         (SELECT DISTINCT order_state FROM business_analytics) v
       WHERE NOT EXISTS (SELECT 1 FROM business_analytics b WHERE b.sku_id = s.sku_id AND b.order_state = v.order_state)""")
