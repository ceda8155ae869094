"""Named views, indicators, widgets and process pipelines."""

from pyspark.sql import functions as F

from tallyroom.constants import (AS_OF_CAMPAIGN, AS_OF_INVENTORY, AS_OF_REVIEWS, AS_OF_SALES, CAMPAIGN_ACTIONS,
                                 GOAL_KPIS, GOALS, KPI_TARGETS, OPS_RX, PRODUCT_RX, SEASONAL_ACTIONS)
from tallyroom.operators.ranking import top_n
from tallyroom.plans import complaints, ideas, inventory, kpis, marketing, products, recipes
from tallyroom.registry.base import C, I, R, S, add, check_view, num_text, rounded, whole_text
from tallyroom.registry.check_views import ladder_sql
from tallyroom.registry.reads_writes import edits
from tallyroom.sources.sinks import written_once

col = F.col
INV, SALES, CAMP, REV = AS_OF_INVENTORY, AS_OF_SALES, AS_OF_CAMPAIGN, AS_OF_REVIEWS

# ---- product views --------------------------------------------------------------------------
add("v_product_enriched", products.v_product_enriched, """
    SELECT sku, display_name, flavour, size_gm, size_label, version, status, veg_nonveg, is_active, description,
           images_link, CAST(base_price_inr AS DOUBLE) AS base_price_inr, CAST(gst_rate AS DOUBLE) AS gst_rate,
           CAST(mrp_inr AS DOUBLE) AS mrp_inr, CAST(total_cogs_inr AS DOUBLE) AS total_cogs_inr, shelf_life_days,
           packaging_type, gs1_barcode, org_labelling_compliance, serving_size FROM facets""")
add("v_product_claim", products.v_product_claim, """
    SELECT sku || '-' || CAST(highlight_seq AS VARCHAR) AS claim_id, sku, highlight_seq, highlight_text
    FROM product_highlight""")
add("v_nutrient_dim", products.v_nutrient_dim, "SELECT DISTINCT nutrient_name FROM product_nutrient")
add("v_product_line_capability", products.v_product_line_capability, "SELECT * FROM capability")
add("v_category_market_signal", lambda t: products.v_category_market_signal(t, SALES), "SELECT * FROM market_signal_facts")
add("v_idea_priority_inputs", lambda t: ideas.v_idea_priority_inputs(t, SALES), "SELECT * FROM idea_inputs")
SIGNAL_TEXT = f"""'; units_90d=' || coalesce({num_text('units_90d', 0)}, 'none') || '; growth_pct='
    || coalesce({num_text('growth_pct', 1)}, 'no_baseline')"""
check_view("triage_rows", f"""
    SELECT '1_IDEA' AS src, idea_id AS id, name AS nm, coalesce(stage, '') || '|'
           || coalesce({num_text('target_cogs_inr', 5)}, '') AS d FROM dim_idea
    UNION ALL SELECT '2_PORT', sku, display_name, coalesce(status, '') || '|' || category_id || '|'
           || coalesce({num_text('total_cogs_inr', 0)}, '') FROM facets WHERE is_active
    UNION ALL SELECT '3_CAT', category_name, category_name,
           'competitor_products=' || coalesce(CAST(active_competitor_products AS VARCHAR), 'not_comparable')
           || '; competitors=' || coalesce(CAST(distinct_competitors AS VARCHAR), 'not_comparable')
           || '; active_skus=' || coalesce(CAST(active_skus_in_category AS VARCHAR), '0') || {SIGNAL_TEXT}
           FROM market_signal_facts
    UNION ALL SELECT '4_COMP', competitor_product_id, product_name, coalesce(competitor_id, '') || '|'
           || coalesce(category, '') FROM (
             SELECT p.*, m.category FROM dim_competitor_product p
             LEFT JOIN dim_competitor m ON m.competitor_id = p.competitor_id AND m.is_active WHERE p.is_active
             QUALIFY row_number() OVER (PARTITION BY m.category ORDER BY p.competitor_product_id) <= 2)
    UNION ALL SELECT '9_END', 'END_OF_CANDIDATES', 'END_OF_CANDIDATES', ''""")
add("v_triage_similarity_candidates", lambda t: ideas.v_triage_similarity_candidates(t, SALES), "SELECT * FROM triage_rows")
check_view("priority_rows", f"""
    SELECT 'BRIEF' AS src, idea_id AS id, name, stage || '|' || coalesce(CAST(days_in_stage AS VARCHAR), 'unknown')
           || '|' || {num_text('cogs_score', 1)} || '|' || {num_text('time_score', 1)} || '|'
           || {num_text('brief_subtotal', 1)} || '|' || unknowns AS data
    FROM brief_scores WHERE stage IN ('Capture', 'Triage', 'Feasibility')
    UNION ALL SELECT 'CATEGORY', NULL, category_name, 'ms=' || market_signal || '; cr=' || compliance_readiness
           || '; cf=' || channel_fit || '; cat_sub=' || cat_subtotal || '; units90='
           || coalesce({num_text('units_90d', 0)}, 'none') || '; growth_pct='
           || coalesce({num_text('growth_pct', 1)}, 'no_baseline') FROM category_scores
    UNION ALL SELECT 'ENVELOPE', NULL, 'portfolio cost envelope', 'cogs_min=' || {num_text('min(min_cogs_inr)', 0)}
           || '; cogs_max=' || {num_text('max(max_cogs_inr)', 0)} FROM capability
    UNION ALL SELECT 'INGREDIENT', NULL, 'ingredient master (already sourced)',
           'count=' || count(DISTINCT lower(trim(ingredient_name))) || '; list=complete' FROM dim_ingredient
    UNION ALL SELECT DISTINCT 'INGREDIENT_NAME', CAST(NULL AS VARCHAR), 'ingredient master (already sourced)',
           lower(trim(ingredient_name)) FROM dim_ingredient WHERE ingredient_name IS NOT NULL""")
add("v_pipeline_priority_candidates", lambda t: ideas.v_pipeline_priority_candidates(t, SALES), "SELECT * FROM priority_rows")
add("v_complaint_events", complaints.v_complaint_events, "SELECT * FROM complaints")
add("v_stocked_at", inventory.v_stocked_at, "SELECT * FROM stocked")
add("v_transfer_route", inventory.v_transfer_route, "SELECT * FROM routes")
add("v_complaint_resolved", complaints.v_complaint_resolved, """
    SELECT c.event_id, p.sku AS sku_id FROM complaints c JOIN dim_product p
      ON upper(trim(p.display_name)) = upper(trim(c.item_name))""")
add("v_store_campaign_current", lambda t: marketing.v_store_campaign_current(t, CAMP), "SELECT * FROM campaign_now")
add("v_store_campaign_history", marketing.v_store_campaign_history, "SELECT * FROM campaign_months")
add("v_segment_on_channel", marketing.v_segment_on_channel, """
    SELECT s.segment_id, c.channel_id FROM marketing_segment_master s JOIN dim_channel c
      ON upper(c.channel_name) = upper(s.channel)""")
add("v_segment_budget", marketing.v_segment_budget, "SELECT * FROM budget_rows")
add("v_review_complaint_candidates", lambda t: products.v_review_complaint_candidates(t, REV), """
    SELECT v.review_id, v.master_store_id AS s, strftime(v.day, '%Y-%m-%d') AS d, v.day - DATE '2026-01-01' AS n,
           v.review_text AS t, coalesce(f.sku, '') AS p
    FROM review_rows v LEFT JOIN (SELECT upper(fam) AS fam, min(sku) AS sku FROM family_list GROUP BY 1) f
      ON contains(upper(v.review_text), f.fam)
    WHERE v.star_rating <= 3
    QUALIFY row_number() OVER (PARTITION BY v.review_id ORDER BY length(f.fam) DESC NULLS LAST, f.fam) = 1""")
add("v_product_family_names", products.v_product_family_names, """
    SELECT 'FAMILIES' AS id, fam AS nm, CASE WHEN cogs IS NOT NULL THEN fam || '=' || cogs END AS cg FROM family_list""")
add("v_ingredient_current_cost", lambda t: recipes.v_ingredient_current_cost(t, INV), "SELECT * FROM ingredient_rates")
add("v_product_ingredient", products.v_product_ingredient, "SELECT * FROM members")
add("v_recipe_line_cost", lambda t: recipes.v_recipe_line_cost(t, INV), "SELECT * FROM line_costs")
add("v_recipe_cogs", lambda t: recipes.v_recipe_cogs(t, INV), "SELECT * FROM recipe_costs")
add("v_recipe_workbench", lambda t: recipes.v_recipe_workbench(t, INV), f"""
    SELECT '1_HDR' AS src, recipe_id AS id, recipe_name AS nm, coalesce(CAST(version_no AS VARCHAR), '?') || '|'
           || coalesce(status, '') || '|' || {whole_text('batch_size_g')} || '|' || {num_text('ingredient_cost_inr', 2)}
           || '|' || {num_text('packaging_cost_inr', 2)} || '|' || {num_text('labour_overhead_inr', 2)} || '|'
           || {num_text('recipe_cogs_inr', 2)} || '|' || coalesce({num_text('target_cogs_inr', 2)}, 'none') || '|'
           || target_fit || '|' || if(is_fully_costed, 'costed', 'partial') AS d, coalesce(status, '') AS st
    FROM recipe_costs
    UNION ALL SELECT '2_LINE', recipe_id, l.ingredient_name, coalesce(l.role, '') || '|' || {num_text('l.qty_net_g', 2)}
           || '|' || {num_text('l.loss_pct', 1)} || '|' || coalesce({whole_text('l.price_inr_per_kg')}, 'uncosted') || '|'
           || coalesce({num_text('l.line_cost_inr', 2)}, 'uncosted') || '|'
           || coalesce({num_text('l.cost_share_pct', 1)}, 'na'), coalesce(r.status, '')
    FROM dear_lines l JOIN dim_recipe r USING (recipe_id) WHERE l.rnk <= 3
    UNION ALL SELECT '3_BASE', c.recipe_id, l.ingredient_name, coalesce(l.role, '') || '|'
           || {num_text('l.qty_net_g', 2)} || '|' || coalesce({num_text('l.line_cost_inr', 2)}, 'uncosted'),
           coalesce(c.status, '')
    FROM dim_recipe c JOIN dear_lines l ON l.recipe_id = c.parent_recipe_id WHERE l.rnk <= 3
    UNION ALL SELECT '4_THESIS', recipe_id, rule, verdict || '|' || evidence, coalesce(status, '') FROM verdicts
    UNION ALL SELECT '5_RATE', s.recipe_id, s.ingredient_name, s.role || '|' || {whole_text('s.price_inr_per_kg')} || '|'
           || coalesce(s.supplier_name, ''), coalesce(r.status, '')
    FROM role_swaps s JOIN dim_recipe r USING (recipe_id)
    UNION ALL SELECT '9_END', recipe_id, 'END_OF_WORKBENCH', '', coalesce(status, '') FROM dim_recipe""")
add("v_recipe_formulation_context", lambda t: recipes.v_recipe_formulation_context(t, INV), f"""
    SELECT g.recipe_id, recipe_name, idea_id, sku, version_no, parent_recipe_id, status, recipe_cogs_inr,
           target_cogs_inr, target_fit, is_fully_costed, batch_size_g, packaging_cost_inr, labour_overhead_inr,
           net_mass_g, coalesce(lp.n_lines, 0) AS n_lines, coalesce(lp.lines_text, '') AS lines,
           CASE WHEN cp.cands IS NULL THEN 0 ELSE nc.n_cand END AS n_cand, coalesce(cp.cands, '') AS cands,
           coalesce(bp.n_bans, 0) AS n_bans, coalesce(bp.bans, '') AS bans, 'END' AS end_mark
    FROM recipe_costs g
    LEFT JOIN (SELECT recipe_id, max(n) AS n_lines, string_agg(d, '|' ORDER BY rnk) FILTER (rnk <= 14) AS lines_text
               FROM (SELECT l.recipe_id, l.rnk, count(*) OVER (PARTITION BY l.recipe_id) AS n,
                       l.ingredient_id || '~' || l.ingredient_name || '~' || coalesce(l.role, '') || '~'
                       || {num_text('l.qty_net_g', 1)} || '~' || {num_text('l.loss_pct', 1)} || '~'
                       || coalesce({whole_text('l.price_inr_per_kg')}, 'uncosted') || '~'
                       || coalesce({num_text('l.line_cost_inr', 2)}, 'uncosted') || '~' || coalesce(b.broken, 'ok') AS d
                     FROM dear_lines l LEFT JOIN broken_names b USING (recipe_id, ingredient_id)) GROUP BY 1) lp USING (recipe_id)
    LEFT JOIN (SELECT recipe_id, string_agg(ingredient_id || '~' || ingredient_name || '~' || role || '~'
                      || {whole_text('price_inr_per_kg')} || '~' || verdict, '|' ORDER BY role, rnk) AS cands
               FROM all_swaps GROUP BY 1) cp USING (recipe_id)
    LEFT JOIN (SELECT r.recipe_id, (SELECT count(*) FROM swap_pool) - count(s.ingredient_id) AS n_cand
               FROM dim_recipe r LEFT JOIN own_items o USING (recipe_id)
               LEFT JOIN swap_pool s ON s.ingredient_id = o.ingredient_id GROUP BY 1) nc USING (recipe_id)
    LEFT JOIN (SELECT recipe_id, count(*) AS n_bans,
                      string_agg(rule || '~' || banned_tag || '~' || source, '|' ORDER BY source, rule) AS bans
               FROM recipe_rules GROUP BY 1) bp USING (recipe_id)""")
check_view("broken_names", """
    SELECT o.recipe_id, o.ingredient_id, string_agg(DISTINCT r.rule, '+' ORDER BY r.rule) AS broken
    FROM own_items o JOIN ingredient_tags g USING (ingredient_id)
    JOIN recipe_rules r ON r.recipe_id = o.recipe_id AND r.banned_tag = g.tag GROUP BY 1, 2""")

# ---- parts of the views ---------------------------------------------------------------------------
categories = lambda t: products.sku_category(t).select("sku", "category_name")
add("sig_trailing_vs_prior", lambda t: products.trailing_vs_prior(t.business_analytics, categories(t), SALES),
    "SELECT * FROM category_growth")
add("sig_forward_forecast", lambda t: products.forward_forecast(t.forecast_results, categories(t), SALES),
    "SELECT * FROM category_forecast")
add("sig_presence_counts", products.presence_counts, "SELECT * FROM category_presence")
add("sig_channel_coverage", products.channel_coverage, "SELECT * FROM category_channels")
add("sig_competitor_counts", products.competitor_counts, "SELECT * FROM category_rivals")
cat_scores = lambda t: ideas.score_categories(products.v_category_market_signal(t, SALES))
brief_scores = lambda t: ideas.score_briefs(ideas.v_idea_priority_inputs(t, SALES))
for key, column in {"score_market": "market_signal", "score_compliance": "compliance_readiness",
                    "score_channel_fit": "channel_fit"}.items():
    add(key, (lambda c: lambda t: cat_scores(t).select("category_name", c))(column),
        f"SELECT category_name, {column} FROM category_scores")
for key, column in {"score_cogs_fit": "cogs_score", "score_time_in_stage": "time_score",
                    "score_unknowns": "unknowns"}.items():
    add(key, (lambda c: lambda t: brief_scores(t).select("idea_id", c))(column),
        f"SELECT idea_id, {column} FROM brief_scores")
add("score_weighted", lambda t: brief_scores(t).select(col("idea_id").alias("id"), col("brief_subtotal").alias("subtotal"))
    .unionByName(cat_scores(t).select(col("category_name").alias("id"), col("cat_subtotal").cast("double").alias("subtotal"))),
    """SELECT idea_id AS id, brief_subtotal AS subtotal FROM brief_scores
       UNION ALL SELECT category_name, cat_subtotal FROM category_scores""")
def pack_complete_flag(t):
    """Does the stated number of ingredients match the rows that follow it?"""
    rows = ideas.v_pipeline_priority_candidates(t, SALES)
    return rows.agg(F.max(F.when(col("src") == "INGREDIENT", F.regexp_extract("data", r"count=(\d+)", 1).try_cast("bigint")))
                    .alias("stated"), F.count_if(col("src") == "INGREDIENT_NAME").alias("listed")).select(
        "stated", "listed", (col("stated") == col("listed")).alias("complete"))


add("pack_complete_flag", pack_complete_flag, """
    SELECT count(DISTINCT lower(trim(ingredient_name))) AS stated, count(DISTINCT lower(trim(ingredient_name))) AS listed,
           true AS complete FROM dim_ingredient""")
add("tag_by_regex", recipes.tag_by_regex, "SELECT * FROM ingredient_tags")
add("rules_activate", recipes.rules_activate, "SELECT * FROM recipe_rules")
add("text_profile", recipes.text_profile, "SELECT * FROM recipe_texts")
add("swap_candidates_role", lambda t: recipes.swap_candidates_role(t, INV).select(
    "recipe_id", "rnk", "ingredient_id", "role", "price_inr_per_kg"),
    "SELECT recipe_id, rnk, ingredient_id, role, price_inr_per_kg FROM role_swaps")
add("swap_candidates_all", lambda t: recipes.swap_candidates_all(t, INV).select(
    "recipe_id", "role", "rnk", "ingredient_id", "verdict"),
    "SELECT recipe_id, role, rnk, ingredient_id, verdict FROM all_swaps")
add("verdict_rows", lambda t: recipes.verdict_rows(recipes.v_recipe_cogs(t, INV)), "SELECT * FROM verdicts")
add("version_diff_lines", lambda t: recipes.version_diff_lines(t, INV).select(
    "recipe_id", "parent_recipe_id", "ingredient_id", "line_cost_inr", "rnk"),
    """SELECT c.recipe_id, c.parent_recipe_id, l.ingredient_id, l.line_cost_inr, l.rnk
       FROM dim_recipe c JOIN dear_lines l ON l.recipe_id = c.parent_recipe_id WHERE l.rnk <= 3""")
add("id_suffix_version", lambda t: recipes.v_recipe_cogs(t, INV).select("recipe_id", "version_no"),
    "SELECT recipe_id, CAST(regexp_extract(recipe_id, '-v([0-9]+)$', 1) AS BIGINT) AS version_no FROM dim_recipe")

# ---- indicators ---------------------------------------------------------------------------------------
KPI_DATES = {None: SALES, kpis.sell_through_kpi: INV, kpis.campaign_kpis: CAMP, kpis.review_kpis: REV}
IS_OPS = f"regexp_matches(lower(coalesce(issue_type, '')), '{OPS_RX}')"
KPI_SQL = {
    "kpi_listing_ready_share": "SELECT round(avg(CASE WHEN blocking_gaps = '' THEN 100.0 ELSE 0 END), 1) FROM listing_package WHERE is_active",
    "kpi_blocking_gaps_per_sku": "SELECT round(avg(CASE WHEN blocking_gaps = '' THEN 0 ELSE len(string_split(blocking_gaps, ';')) END), 2) FROM listing_package WHERE is_active",
    "kpi_allergen_underdeclaration": "SELECT round(count(allergen_underdeclared) * 100.0 / count(*), 1) FROM listing_package WHERE is_active",
    "kpi_own_recipe_share": "SELECT round(count(*) FILTER (ingredient_source = 'own') * 100.0 / count(*), 1) FROM listing_package WHERE is_active",
    "kpi_panel_basis_known": "SELECT round(count(*) FILTER (nutrient_basis NOT IN ('unknown', 'no_panel')) * 100.0 / count(*), 1) FROM listing_package WHERE is_active",
    "kpi_mandatory_nutrients": "SELECT round(count(*) FILTER (mandatory_nutrients_blank IS NULL) * 100.0 / count(*), 1) FROM listing_package WHERE is_active",
    "kpi_claim_substantiation": "SELECT round(count(*) FILTER (verdict = 'substantiated') * 100.0 / count(*), 1) FROM listing_claim_check",
    "kpi_contradicted_claims": "SELECT count(*) FROM listing_claim_check WHERE verdict IN ('MISMATCH', 'CONTRADICTED', 'MALFORMED_CLAIM')",
    "kpi_wastage_risk": "SELECT sum(qty_expiring_within_risk_days) FROM stocked",
    "kpi_expired_stock_units": "SELECT sum(expired_stock) FROM stocked",
    "kpi_expiry_value_at_risk": "SELECT round(sum(CAST(qty_expiring_within_risk_days AS DECIMAL(18,2)) * total_cogs_inr), 0) FROM stocked JOIN product_pricing ON sku = sku_id",
    "kpi_low_stock_rate": "SELECT round(count(*) FILTER (total_stock <= min_count) * 100.0 / count(*), 1) FROM stocked s JOIN low_stock_config c ON c.sku_id = s.sku_id AND c.store_id = s.master_store_id",
    "kpi_critical_low_count": "SELECT count(*) FILTER (total_stock <= absolute_risk_count) FROM stocked s JOIN low_stock_config c ON c.sku_id = s.sku_id AND c.store_id = s.master_store_id",
    "kpi_sell_through_gap": f"""SELECT round(avg(on_hand - coalesce(fc3, 0)), 1) FROM (
        SELECT store_id, product_sku, sum(available_quantity) AS on_hand, min(expiry_date) AS soonest FROM newest_stock
        WHERE available_quantity > 0 GROUP BY ALL) LEFT JOIN (
        SELECT master_store_id AS store_id, sku_id AS product_sku, sum(predicted_sales_quantity) AS fc3 FROM forecast_results
        WHERE is_latest_forecast AND days_ahead BETWEEN 1 AND 3 GROUP BY ALL) USING (store_id, product_sku)
        WHERE soonest - {I} BETWEEN 0 AND 3""",
    "kpi_avg_store_rating": "SELECT round(avg(star_rating), 6) FROM customer_review_events",
    "kpi_low_rating_share": f"SELECT round(count(*) FILTER (star_rating <= 3) * 100.0 / count(*), 1) FROM customer_review_events WHERE review_date >= {R} - 90",
    "kpi_ops_complaint_share": f"SELECT round(count(*) FILTER ({IS_OPS}) * 100.0 / count(*), 1) FROM customer_complaint_events WHERE CAST(complaint_received_at AS DATE) >= {S} - 60",
    "kpi_stores_over_bar": f"""SELECT count(*) FROM (SELECT master_store_id FROM customer_complaint_events
        WHERE CAST(complaint_received_at AS DATE) >= {S} - 60 AND {IS_OPS} GROUP BY 1 HAVING count(*) >= 3)""",
    "kpi_near_expiry_complaints": f"""SELECT round(count(*) FILTER (b.soonest - l.order_date <= coalesce(k.min_days_shelf_life, 2)) * 100.0 / count(*), 1)
        FROM customer_complaint_events c JOIN (SELECT DISTINCT online_order_id, store_id, sku_id, order_date
             FROM business_analytics WHERE order_state <> 'Cancelled') l ON l.online_order_id = c.order_id
        LEFT JOIN (SELECT store_id, product_sku, snapshot_date, min(expiry_date) AS soonest FROM order_day_inventory GROUP BY ALL) b
          ON b.store_id = l.store_id AND b.product_sku = l.sku_id AND b.snapshot_date = l.order_date
        LEFT JOIN low_stock_config k ON k.sku_id = l.sku_id AND k.store_id = l.store_id
        WHERE CAST(c.complaint_received_at AS DATE) >= {S} - 60
          AND regexp_matches(lower(coalesce(c.issue_type, '')), '{PRODUCT_RX}')""",
    "kpi_forecast_accuracy": f"""SELECT round(100 - avg(abs((p - a) / a)) * 100, 1) FROM (
        SELECT sku_id, master_store_id AS store_id, forecast_date AS d, sum(predicted_sales_quantity) AS p FROM forecast_results
        WHERE is_latest_forecast GROUP BY ALL) JOIN (
        SELECT sku_id, store_id, order_date AS d, sum(quantity) AS a FROM business_analytics
        WHERE order_state <> 'Cancelled' GROUP BY ALL) USING (sku_id, store_id, d) WHERE a > 0 AND d >= {S} - 30""",
    "kpi_forecast_coverage": f"SELECT max(forecast_date) - {S} FROM forecast_results WHERE is_latest_forecast",
    "kpi_blended_roi": "SELECT round(sum(ad_sales_rs) / nullif(sum(ad_spend_rs), 0), 2) FROM campaign_now",
    "kpi_zero_return_spend": "SELECT round(sum(CASE WHEN coalesce(roi, 0) = 0 AND ad_spend_rs >= 200 THEN ad_spend_rs ELSE 0 END), 0) FROM campaign_now",
    "kpi_ads_conversion_gap": "SELECT round(avg(overall_m2o_pct - ads_m2o_pct), 1) FROM campaign_now",
    "kpi_margin_pct": "SELECT round(CAST(sum(mrp_inr - total_cogs_inr) AS DOUBLE) / CAST(sum(mrp_inr) AS DOUBLE) * 100, 1) FROM facets WHERE is_active AND mrp_inr > 0",
    "kpi_pipeline_aging": "SELECT round(avg(days_in_stage), 1) FROM idea_inputs",
    "kpi_stalled_briefs": "SELECT count(*) FROM idea_inputs WHERE days_in_stage >= 90",
    "kpi_brief_scorable_share": "SELECT round(count(*) FILTER (cogs_fit <> 'UNKNOWN' AND days_in_stage IS NOT NULL) * 100.0 / count(*), 1) FROM idea_inputs",
}
COMPARE = {"gte": ">=", "lte": "<=", "eq": "="}


def kpi_sql(name: str) -> str:
    target, comparison = KPI_TARGETS[name]
    return f"""SELECT '{name}' AS kpi, v AS value, {target}::DOUBLE AS target, '{comparison}' AS comparison,
        v {COMPARE[comparison]} {target} AS on_target FROM (SELECT CAST(({KPI_SQL[name]}) AS DOUBLE) AS v)"""


for key in KPI_SQL:
    add(key, (lambda k: lambda t: kpis.kpi_board(t, KPI_DATES, only=[k]))(key), kpi_sql(key))
ALL_KPIS = "\nUNION ALL ".join(kpi_sql(k) for k in KPI_SQL)
check_view("board_rows", ALL_KPIS)
add("kpi_status", lambda t: kpis.kpi_board(t, KPI_DATES), "SELECT * FROM board_rows")
PARENTS = dict(GOALS)


def goals_above(goal):
    while goal:
        yield goal
        goal = PARENTS[goal]


GOAL_ROWS = ", ".join(f"('{g}', '{k}')" for g, k in sorted({(g, k) for goal, k, _ in GOAL_KPIS for g in goals_above(goal)}))
GOAL_KPI_NAMES = sorted({k for _, k, _ in GOAL_KPIS})
add("kpi_goal_rollup", lambda t: kpis.kpi_goal_rollup(kpis.kpi_board(t, KPI_DATES, GOAL_KPI_NAMES), t.spark), f"""
    SELECT goal, count(*) AS kpis, count(*) FILTER (on_target) AS on_target, count(*) FILTER (on_target IS NULL) AS unknown
    FROM (VALUES {GOAL_ROWS}) g(goal, kpi) JOIN board_rows USING (kpi) GROUP BY goal""")


def goal_measures(t):
    """Monthly measures per category as goal input, combined by a rule each row
    carries."""
    m = t.business_analytics.select(
        col("store_id").alias("goal"), F.trunc("order_date", "year").alias("period"), col("order_state").alias("kpi"),
        F.when(col("order_state") == "Cancelled", "min").when(col("order_state") == "Placed", "avg").otherwise("sum")
        .alias("op"), col("quantity").alias("value"))
    return kpis.kpi_goal_values(m, "goal", "period", "kpi", "value", "op")


add("agg_kpi_goal", goal_measures, """
    SELECT goal, period, kpi, op, round(CASE op WHEN 'min' THEN min(quantity) WHEN 'avg' THEN avg(quantity)
           ELSE sum(quantity) END, 4) AS value
    FROM (SELECT store_id AS goal, CAST(date_trunc('year', order_date) AS DATE) AS period, order_state AS kpi,
                 CASE order_state WHEN 'Cancelled' THEN 'min' WHEN 'Placed' THEN 'avg' ELSE 'sum' END AS op, quantity
          FROM business_analytics) GROUP BY goal, period, kpi, op""")

# ---- widgets ------------------------------------------------------------------------------------------
add("w_avg_rating", lambda t: t.customer_review_events.groupBy("master_store_id").agg(
    F.round(F.avg("star_rating"), 6).alias("value")),
    "SELECT master_store_id, round(avg(star_rating), 6) AS value FROM customer_review_events GROUP BY 1")
add("w_complaint_count", lambda t: t.customer_complaint_events.groupBy("master_store_id").agg(
    F.count("master_store_id").alias("value")),
    "SELECT master_store_id, count(*) AS value FROM customer_complaint_events GROUP BY 1")
add("w_recent_reviews", lambda t: inventory.top_per_entity(t.customer_review_events.select(
    "master_store_id", "review_date", "review_id", "star_rating", "customer_name"), "master_store_id", "review_date",
    20, ["review_id"]),
    """SELECT master_store_id, review_date, review_id, star_rating, customer_name,
              row_number() OVER (PARTITION BY master_store_id ORDER BY review_date DESC, review_id) AS rnk
       FROM customer_review_events QUALIFY rnk <= 20""")
add("w_inventory_latest", inventory.w_inventory_latest, "SELECT * FROM newest_stock")
add("w_running_campaigns", lambda t: inventory.top_per_entity(marketing.v_store_campaign_current(t, CAMP).select(
    "master_store_id", "campaign_id", "product_type", "segments", "date", "ad_spend_rs", "ad_sales_rs", "ad_orders", "roi"),
    "master_store_id", "ad_spend_rs", 50, ["campaign_id"]),
    """SELECT master_store_id, campaign_id, product_type, segments, date, ad_spend_rs, ad_sales_rs, ad_orders, roi,
              row_number() OVER (PARTITION BY master_store_id ORDER BY ad_spend_rs DESC, campaign_id) AS rnk
       FROM campaign_now QUALIFY rnk <= 50""")
add("w_sales_by_sku", lambda t: inventory.w_sales_by_sku(t, CAMP), f"""
    SELECT store_id, sku_id, min(item_source_name) AS item_name, sum(quantity) AS quantity,
           CAST(sum(total) AS DOUBLE) AS revenue FROM business_analytics
    WHERE order_state <> 'Cancelled' AND order_date >= date_trunc('month', {C}) GROUP BY 1, 2""")
add("w_available_by_store", inventory.w_available_by_store, """
    SELECT product_sku, store_id, sum(available_quantity) AS available_quantity FROM (
      SELECT * FROM store_inventory_daily
      QUALIFY snapshot_date = max(snapshot_date) OVER (PARTITION BY product_sku, store_id)) GROUP BY 1, 2""")
add("w_stock_by_store", lambda t: inventory.top_per_entity(inventory.v_stocked_at(t).select(
    "sku_id", "master_store_id", "total_stock", "expired_stock", "soonest_expiry", "low_stock_flag"),
    "sku_id", "total_stock", 50, ["master_store_id"]),
    """SELECT sku_id, master_store_id, total_stock, expired_stock, soonest_expiry, low_stock_flag,
              row_number() OVER (PARTITION BY sku_id ORDER BY total_stock DESC, master_store_id) AS rnk
       FROM stocked QUALIFY rnk <= 50""")
add("w_forecast_by_store", inventory.w_forecast_by_store, """
    SELECT sku_id, master_store_id, round(sum(predicted_sales_quantity), 1) AS forecast_qty FROM forecast_results
    WHERE is_latest_forecast AND days_ahead BETWEEN 1 AND 3 GROUP BY 1, 2""")
add("w_qty_month", lambda t: inventory.w_sales_by_sku(t, CAMP).groupBy("sku_id").agg(F.sum("quantity").alias("value")), f"""
    SELECT sku_id, sum(quantity) AS value FROM business_analytics
    WHERE order_state <> 'Cancelled' AND order_date >= date_trunc('month', {C}) GROUP BY 1""")
add("w_revenue_all", lambda t: inventory.sold(t).groupBy("sku_id").agg(F.sum("total").cast("double").alias("value")), """
    SELECT sku_id, CAST(sum(total) AS DOUBLE) AS value FROM business_analytics WHERE order_state <> 'Cancelled' GROUP BY 1""")
add("w_recipe_versions", lambda t: top_n(
    recipes.v_recipe_cogs(t, INV).where("sku IS NOT NULL").select(
        "sku", "recipe_id", "version_no", "status", "is_current", "recipe_cogs_inr", "master_variance_inr"),
    ["sku"], [F.desc("version_no"), F.asc("recipe_id")], 20),
    """SELECT sku, recipe_id, version_no, status, is_current, recipe_cogs_inr, master_variance_inr,
              row_number() OVER (PARTITION BY sku ORDER BY version_no DESC, recipe_id) AS rnk
       FROM recipe_costs WHERE sku IS NOT NULL QUALIFY rnk <= 20""")
add("w_budget_by_store", lambda t: inventory.top_per_entity(marketing.v_segment_budget(t), "segment_id",
    "allocated_budget_rs", 50, ["master_store_id", "budget_month", "channel"]).drop("expected_revenue_rs"),
    """SELECT * EXCLUDE (expected_revenue_rs), row_number() OVER (PARTITION BY segment_id
              ORDER BY allocated_budget_rs DESC, master_store_id, budget_month, channel) AS rnk
       FROM budget_rows QUALIFY rnk <= 50""")

# ---- process pipelines -------------------------------------------------------------------------------------
add("p_shelf_life_risk", lambda t: inventory.p_shelf_life_risk(t, INV), f"""
    SELECT r.*, s.store_name, p.display_name AS product_name FROM (
      SELECT q.*, CASE WHEN days_to_expiry <= min_days_shelf_life AND total_available <= min_count THEN 'both'
                  WHEN days_to_expiry <= min_days_shelf_life THEN 'wastage'
                  WHEN total_available <= absolute_risk_count THEN 'critical_low'
                  WHEN total_available <= min_count THEN 'low_stock' ELSE 'ok' END AS risk_type
      FROM (SELECT store_id, product_sku, sum(available_quantity) AS total_available, min(expiry_date) AS soonest_expiry,
                   count(batch_row_number) AS batches, min(expiry_date) - {I} AS days_to_expiry
            FROM newest_stock WHERE expiry_date >= {I} GROUP BY 1, 2) q
      LEFT JOIN low_stock_config c ON c.store_id = q.store_id AND c.sku_id = q.product_sku) r
    LEFT JOIN master_store s ON s.master_store_id = r.store_id LEFT JOIN dim_product p ON p.sku = r.product_sku
    WHERE risk_type <> 'ok'""")
add("p_demand_plan", lambda t: inventory.p_demand_plan(t, INV), f"""
    SELECT r.*, s.store_name, n.store_name AS nearest_store_name, p.display_name AS product_name FROM (
      SELECT q.store_id, product_sku, coalesce(available_quantity, 0) AS available_quantity,
             coalesce(expiring_qty, 0) AS expiring_qty, soonest_expiry, nearest_store_id, distance_km,
             soonest_expiry - {I} AS days_to_expiry,
             CAST(greatest(ceil(coalesce(forecast_3d, 0)), 1) AS BIGINT) AS forecast_units,
             CASE WHEN coalesce(expiring_qty, 0) > 0 AND soonest_expiry - {I} <= 1 THEN 'liquidate'
                  WHEN coalesce(expiring_qty, 0) > 0 AND nearest_store_id IS NOT NULL THEN 'transfer'
                  WHEN coalesce(expiring_qty, 0) > 0 THEN 'liquidate'
                  WHEN coalesce(available_quantity, 0) < coalesce(forecast_3d, 0) THEN 'supply_factory' END AS action
      FROM (SELECT * FROM (
              SELECT master_store_id AS store_id, sku_id AS product_sku, sum(predicted_sales_quantity) AS forecast_3d
              FROM forecast_results WHERE is_latest_forecast AND forecast_date - {I} BETWEEN 1 AND 3 GROUP BY 1, 2)
            FULL JOIN (
              SELECT store_id, product_sku, sum(available_quantity) AS available_quantity,
                     sum(CASE WHEN expiry_date - {I} <= 3 THEN available_quantity ELSE 0 END) AS expiring_qty,
                     min(expiry_date) AS soonest_expiry
              FROM newest_stock WHERE expiry_date >= {I} GROUP BY 1, 2) USING (store_id, product_sku)) q
      LEFT JOIN nearest ON nearest.store_id = q.store_id) r
    LEFT JOIN master_store s ON s.master_store_id = r.store_id
    LEFT JOIN master_store n ON n.master_store_id = r.nearest_store_id
    LEFT JOIN dim_product p ON p.sku = r.product_sku WHERE action IS NOT NULL""")
add("p_complaint_root_cause", lambda t: complaints.p_complaint_root_cause(t, SALES), f"""
    SELECT c.master_store_id, s.store_name, c.complaint_received_at AS complaint_date, c.customer_comments AS complaint,
           c.issue_type, c.item_name AS complaint_item, l.item_source_name AS order_item, l.sku_id,
           p.display_name AS product_name, l.order_date, i.earliest_expiry_that_day, i.inventory_that_day,
           k.min_days_shelf_life,
           CASE WHEN regexp_matches(c.issue_type, 'Wrong|Missing|Late|Deliver|Packag') THEN 'OPERATIONS'
                WHEN regexp_matches(c.issue_type, 'Quality|Taste|Fresh|Expir') THEN 'PRODUCT' ELSE 'Review' END AS category
    FROM complaints c
    LEFT JOIN (SELECT * FROM business_analytics WHERE order_date >= {S} - 14) l ON l.online_order_id = c.order_id
    LEFT JOIN (SELECT store_id, product_sku, snapshot_date, min(expiry_date) AS earliest_expiry_that_day,
                      sum(available_quantity) AS inventory_that_day FROM order_day_inventory GROUP BY 1, 2, 3) i
      ON i.store_id = l.store_id AND i.product_sku = l.sku_id AND i.snapshot_date = l.order_date
    LEFT JOIN low_stock_config k ON k.sku_id = l.sku_id AND k.store_id = l.store_id
    LEFT JOIN master_store s ON s.master_store_id = c.master_store_id LEFT JOIN dim_product p ON p.sku = l.sku_id
    WHERE CAST(c.complaint_received_at AS DATE) >= {S} - 7""")
add("p_store_reviews", lambda t: complaints.p_store_reviews(t, REV), """
    SELECT v.master_store_id, s.store_name, v.star_rating AS rating, v.review_text AS review, v.day AS review_date, v.customer_name AS customer,
           CASE WHEN v.star_rating <= 3 THEN 'low' ELSE 'ok' END AS rating_band
    FROM review_rows v LEFT JOIN master_store s USING (master_store_id)""")
add("p_ops_concentration", lambda t: complaints.p_ops_concentration(t, SALES), """
    SELECT o.*, s.store_name FROM ops_by_store o LEFT JOIN master_store s USING (master_store_id)
    WHERE ops_complaints >= 3""")
add("p_ops_evidence", lambda t: complaints.p_ops_evidence(t, SALES), f"""
    SELECT c.master_store_id, s.store_name, c.issue_type, c.item_name AS complaint_item, c.customer_comments AS complaint,
           c.order_id, c.complaint_received_at AS complaint_date,
           CASE WHEN regexp_matches(c.issue_type, '[Ww]rong') THEN 'Wrong item'
                WHEN regexp_matches(c.issue_type, '[Mm]issing') THEN 'Missing item'
                WHEN regexp_matches(c.issue_type, '[Pp]ackag|[Ss]pillage') THEN 'Bad condition / packaging'
                ELSE 'Late delivery' END AS ops_category, o.ops_complaints AS store_ops_count
    FROM complaints c JOIN ops_by_store o USING (master_store_id)
    LEFT JOIN master_store s USING (master_store_id)
    WHERE CAST(c.complaint_received_at AS DATE) >= {S} - 60 AND o.ops_complaints >= 3
      AND regexp_matches(c.issue_type, '[Ww]rong|[Mm]issing|[Pp]ackag|[Ss]pillage|[Ll]ate|[Dd]elay|[Dd]eliver')""")
add("p_mentions_by_product", lambda t: products.v_review_complaint_candidates(t, REV).where(col("p") != "").groupBy(
    "p").agg(F.count("*").alias("mentions")), """
    SELECT sku AS p, count(*) AS mentions FROM (
      SELECT v.review_id, f.sku FROM review_rows v
      JOIN (SELECT upper(fam) AS fam, min(sku) AS sku FROM family_list GROUP BY 1) f ON contains(upper(v.review_text), f.fam)
      WHERE v.star_rating <= 3
      QUALIFY row_number() OVER (PARTITION BY v.review_id ORDER BY length(f.fam) DESC, f.fam) = 1) GROUP BY 1""")
add("p_active_briefs", lambda t: ideas.active_briefs(t, SALES).select("idea_id", "name", "stage", "days_in_stage", "cogs_fit"),
    "SELECT idea_id, name, stage, days_in_stage, cogs_fit FROM idea_inputs WHERE stage IN ('Capture', 'Triage', 'Feasibility')")
add("p_active_portfolio", lambda t: t.dim_product.where("is_active").select("sku", "display_name", "status").orderBy("sku"),
    "SELECT sku, display_name, status FROM dim_product WHERE is_active")
add("p_active_competitors", lambda t: t.dim_competitor.where("is_active").select(
    "competitor_id", "competitor_name", "category").orderBy("category", "competitor_id"),
    "SELECT competitor_id, competitor_name, category FROM dim_competitor WHERE is_active")
add("p_competitor_products", lambda t: t.dim_competitor_product.where("is_active").select(
    "competitor_product_id", "product_name", "competitor_id").orderBy("competitor_id", "competitor_product_id"),
    "SELECT competitor_product_id, product_name, competitor_id FROM dim_competitor_product WHERE is_active")
add("p_product_ingredients", lambda t: products.v_product_ingredient(t).join(
    t.dim_ingredient.select("ingredient_id", "ingredient_name"), "ingredient_id").join(
    t.dim_product.select("sku", "display_name"), "sku"), """
    SELECT m.sku, m.ingredient_id, i.ingredient_name, p.display_name FROM members m
    JOIN dim_ingredient i USING (ingredient_id) JOIN dim_product p USING (sku)""")
add("p_products_by_category", lambda t: products.sku_category(t).where("is_active").groupBy("category_name").agg(
    F.count("*").alias("products")),
    "SELECT category_id AS category_name, count(*) AS products FROM dim_product WHERE is_active GROUP BY 1")
add("p_listings_by_channel", lambda t: t.map_product_channel.select("channel_id", "sku").distinct().groupBy("channel_id").agg(
    F.count("*").alias("products")).join(t.dim_channel.select("channel_id", "channel_name"), "channel_id"), """
    SELECT m.channel_id, count(DISTINCT m.sku) AS products, c.channel_name FROM map_product_channel m
    JOIN dim_channel c USING (channel_id) GROUP BY ALL""")

# ---- campaigns --------------------------------------------------------------------------------------------------
check_view("campaign_now_acted", ladder_sql("campaign_now", CAMPAIGN_ACTIONS))
check_view("campaign_months_acted", ladder_sql("campaign_months", CAMPAIGN_ACTIONS))
now = lambda t: marketing.campaign_ladder(marketing.v_store_campaign_current(t, CAMP))
months = lambda t: marketing.campaign_ladder(marketing.v_store_campaign_history(t))
KEY = ["master_store_id", "campaign_id", "month"]
for key, cols in {"campaign_ladder": ["rung", "suggested_action", "category"], "campaign_confidence": ["confidence"],
                  "campaign_priority": ["priority"], "campaign_impact": ["estimated_impact"]}.items():
    add(key, (lambda c: lambda t: months(t).select(*KEY, *c))(cols),
        f"SELECT {', '.join(KEY + cols)} FROM campaign_months_acted")
AUDIENCE = "trim(regexp_replace(lower(segments), '[^a-z0-9]+', ' ', 'g'))"
check_view("best_proofs", """
    SELECT * FROM campaign_now_acted WHERE rung = 'confident' AND ad_spend_rs >= 500 AND ad_orders >= 20
    QUALIFY row_number() OVER (PARTITION BY master_store_id ORDER BY roi DESC, campaign_id) = 1""")
check_view("expansion_rows", f"""
    SELECT b.master_store_id, s.segment, b.campaign_id AS proof_campaign_id, b.platform, b.product_type, b.roi,
           b.ad_sales_rs, b.ad_spend_rs, 'strategic_expansion' AS category, 'new_campaign:' || s.segment AS suggested_action,
           'MEDIUM' AS confidence, CASE WHEN b.ad_spend_rs >= 5000 THEN 'HIGH' ELSE 'MEDIUM' END AS priority
    FROM best_proofs b, (SELECT DISTINCT {AUDIENCE} AS segment FROM campaign_now) s
    WHERE NOT EXISTS (SELECT 1 FROM campaign_now n WHERE n.master_store_id = b.master_store_id
                      AND {AUDIENCE.replace('segments', 'n.segments')} = s.segment)""")
check_view("unspent_rows", f"""
    SELECT b.* EXCLUDE (expected_revenue_rs), upper(b.channel) AS platform, 'strategic_expansion' AS category,
           'new_campaign:budget_allocated_unused' AS suggested_action, 'LOW' AS confidence,
           CASE WHEN allocated_budget_rs >= 5000 THEN 'HIGH' ELSE 'MEDIUM' END AS priority
    FROM budget_rows b WHERE allocated_budget_rs > 0 AND budget_month = date_trunc('month', {C})
      AND NOT EXISTS (SELECT 1 FROM campaign_now n WHERE n.master_store_id = b.master_store_id
                      AND n.platform = upper(b.channel))""")
unspent = lambda t, running=None: marketing.campaign_unspent_budget(
    marketing.v_segment_budget(t), running or marketing.v_store_campaign_current(t, CAMP), CAMP).drop("expected_revenue_rs")
add("campaign_expansion_gap", lambda t: marketing.campaign_expansion_gap(now(t)), "SELECT * FROM expansion_rows")
add("campaign_unspent_budget", unspent, "SELECT * FROM unspent_rows")
add("campaign_segment_normalise", lambda t: t.raw_marketing_data.select(
    "segments", marketing.audience_key("segments").alias("audience")).groupBy("audience").agg(
    F.count("*").alias("rows"), F.count_distinct("segments").alias("spellings")),
    f"""SELECT {AUDIENCE} AS audience, count(*) AS rows, count(DISTINCT segments) AS spellings
        FROM raw_marketing_data GROUP BY 1""")


def final_plan(t):
    """The ladder's rows are made once; the plan, the gaps and the unspent budget all read them."""
    acted = written_once(now(t), "campaign-now")
    return marketing.campaign_final_plan(acted, marketing.campaign_expansion_gap(acted), unspent(t, acted))


add("campaign_final_plan", final_plan, """
    SELECT *, CAST(CASE priority WHEN 'HIGH' THEN 1 WHEN 'MEDIUM' THEN 2 ELSE 3 END AS BIGINT) AS band_order FROM (
      SELECT master_store_id, campaign_id, platform, segments, category, suggested_action, confidence, priority,
             ad_spend_rs, roi, 1::BIGINT AS seq FROM campaign_now_acted
      UNION ALL SELECT master_store_id, NULL, platform, segment, category, suggested_action, confidence, priority,
             ad_spend_rs, roi, 2 FROM expansion_rows
      UNION ALL SELECT master_store_id, NULL, platform, NULL, category, suggested_action, confidence, priority, 0, NULL, 3
      FROM unspent_rows)""")

# ---- seasonal ------------------------------------------------------------------------------------------------------
EVENT_LAST = SALES.replace(year=2000, month=11, day=1)
EVENT_THIS = SALES.replace(month=8, day=15)
E = f"DATE '{EVENT_LAST}'"
check_view("season_rows", f"""
    SELECT * FROM campaign_months WHERE month BETWEEN date_trunc('month', {E} - 42) AND date_trunc('month', {E} + 7)""")
check_view("season_acted", ladder_sql("season_rows", SEASONAL_ACTIONS))
season = lambda t: marketing.seasonal_ladder(marketing.v_store_campaign_history(t), EVENT_LAST)
add("seasonal_window", lambda t: marketing.event_months(t.calendar_events), """
    SELECT title, event_date, event_date - 42 AS window_start, event_date + 7 AS window_end, CAST(m AS DATE) AS month
    FROM (SELECT *, unnest(generate_series(date_trunc('month', event_date - 42), date_trunc('month', event_date + 7),
                           INTERVAL 1 MONTH)) AS m FROM calendar_events)""")
add("seasonal_ladder", lambda t: season(t).select(*KEY, "rung", "suggested_action", "category", "confidence", "priority"),
    "SELECT master_store_id, campaign_id, month, rung, suggested_action, category, confidence, priority FROM season_acted")
add("seasonal_budget_gap", lambda t: marketing.seasonal_budget_gap(
    season(t), marketing.v_segment_budget(t), EVENT_THIS).select(*KEY, "platform", "roi", "suggested_action", "priority"), f"""
    SELECT master_store_id, campaign_id, month, platform, roi, 'allocate_budget_for_event' AS suggested_action,
           CASE WHEN ad_spend_rs >= 5000 THEN 'HIGH' ELSE 'MEDIUM' END AS priority
    FROM season_acted a WHERE rung IN ('cautious', 'confident') AND ad_spend_rs >= 500 AND ad_orders >= 20
      AND NOT EXISTS (SELECT 1 FROM budget_rows b WHERE b.allocated_budget_rs > 0
        AND b.budget_month = date_trunc('month', DATE '{EVENT_THIS}') AND b.master_store_id = a.master_store_id
        AND upper(b.channel) = a.platform)""")
add("seasonal_timeline", lambda t: marketing.seasonal_timeline(t.calendar_events), """
    SELECT title, milestone, event_date + days AS due_date FROM calendar_events,
      (VALUES (-42, 'Planning'), (-35, 'Creative production'), (-28, 'Landing page ready'), (-21, 'Email setup'),
              (-14, 'Ads live'), (-7, 'Reminder campaign'), (0, 'Peak promotions'), (7, 'Performance review')) v(days, milestone)""")
add("event_pick", lambda t: marketing.event_pick(t.calendar_events, SALES.replace(month=6)).select(
    "title", "event_date", "event_type"), """
    SELECT title, event_date, event_type FROM calendar_events
    WHERE event_date BETWEEN DATE '2001-06-01' AND DATE '2001-06-01' + 42
    ORDER BY event_date, list_position(['Global', 'National', 'Cultural', 'Religious', 'Marketing/Seasonal', 'Regional',
                                        'Industry'], event_type), title LIMIT 1""")

# ---- complaints and ideas -----------------------------------------------------------------------------------------------
def theme_sql(c: str) -> str:
    return f"""CASE WHEN regexp_matches({c}, '[Ww]rong') THEN 'OPERATIONS|Wrong item'
                WHEN regexp_matches({c}, '[Mm]issing') THEN 'OPERATIONS|Missing item'
                WHEN regexp_matches({c}, '[Pp]ackag|[Ss]pillage') THEN 'OPERATIONS|Bad condition / packaging'
                WHEN regexp_matches({c}, '[Ll]ate|[Dd]elay|[Dd]eliver') THEN 'OPERATIONS|Late delivery'
                WHEN regexp_matches(lower({c}), 'quality') THEN 'PRODUCT|quality'
                WHEN regexp_matches(lower({c}), 'taste') THEN 'PRODUCT|taste'
                WHEN regexp_matches(lower({c}), 'fresh') THEN 'PRODUCT|fresh'
                WHEN regexp_matches(lower({c}), 'expir') THEN 'PRODUCT|expir' ELSE 'OTHER|unclassified' END"""


def clusters_sql(rows: str) -> str:
    spans = f"""
    SELECT product, kt, n AS window_first, last AS window_last, hits FROM (
      SELECT product, kt, n, count(*) OVER w AS hits, max(n) OVER w AS last FROM {rows} WHERE product IS NOT NULL
      WINDOW w AS (PARTITION BY product, kt ORDER BY n RANGE BETWEEN CURRENT ROW AND 14 FOLLOWING))
    QUALIFY row_number() OVER (PARTITION BY product, kt ORDER BY hits DESC, n) = 1"""
    return f"""
    SELECT s.product, split_part(s.kt, '|', 1) AS kind, split_part(s.kt, '|', 2) AS theme, s.window_first, s.window_last,
           s.window_last - s.window_first AS span, s.hits AS review_count,
           count(DISTINCT t.master_store_id) AS store_count, min(t.d) AS window_start, max(t.d) AS window_end,
           string_agg(t.d || ' ' || t.event_id, chr(10) ORDER BY t.n, t.event_id) FILTER (t.rk <= 4) AS evidence,
           split_part(s.kt, '|', 1) = 'PRODUCT' AND s.hits >= 3 AS qualifies
    FROM ({spans}) s JOIN (
      SELECT t.*, row_number() OVER (PARTITION BY t.product, t.kt ORDER BY t.n, t.event_id) AS rk
      FROM {rows} t JOIN ({spans}) x ON x.product = t.product AND x.kt = t.kt
       AND t.n BETWEEN x.window_first AND x.window_last) t ON t.product = s.product AND t.kt = s.kt
    GROUP BY ALL"""


check_view("themed", f"""
    SELECT event_id, master_store_id, upper(trim(item_name)) AS product,
           CAST(complaint_received_at AS DATE) - DATE '2026-01-01' AS n,
           strftime(complaint_received_at, '%Y-%m-%d') AS d, {theme_sql('issue_type')} AS kt
    FROM complaints""")
add("complaint_clusters", complaints.complaint_clusters, clusters_sql("themed"))
REVIEWS_NAMED = """
    SELECT v.review_id, v.master_store_id AS s, strftime(v.day, '%Y-%m-%d') AS d, v.day - DATE '2026-01-01' AS n,
           v.review_text AS t, coalesce(f.sku, '') AS p
    FROM review_rows v LEFT JOIN (SELECT upper(fam) AS fam, min(sku) AS sku FROM family_list GROUP BY 1) f
      ON contains(upper(v.review_text), f.fam)
    WHERE v.star_rating <= 3
    QUALIFY row_number() OVER (PARTITION BY v.review_id ORDER BY length(f.fam) DESC NULLS LAST, f.fam) = 1"""
check_view("reviews_named", REVIEWS_NAMED)
check_view("themed_reviews", f"""
    SELECT review_id AS event_id, s AS master_store_id, p AS product, n, d, {theme_sql('t')} AS kt
    FROM reviews_named WHERE p <> ''""")
add("review_clusters", lambda t: complaints.review_clusters(t, REV), clusters_sql("themed_reviews"))
add("complaint_theme_rules", lambda t: complaints.v_complaint_events(t).select(
    "event_id", complaints.theme_rules().alias("kind_theme")), "SELECT event_id, kt AS kind_theme FROM themed")


def briefs_with_category(t):
    """Briefs with a category and the share of needed ingredients in stock. The
    brief's recipe lines stand for what it needs; the priced ingredients for
    what is sourced."""
    need = t.dim_recipe.where("idea_id IS NOT NULL").select("recipe_id", "idea_id").join(
        t.map_recipe_ingredient.select("recipe_id", "ingredient_id"), "recipe_id").join(
        t.dim_ingredient.select("ingredient_id", F.lower(F.trim("ingredient_name")).alias("need")), "ingredient_id").select(
        "idea_id", "need").distinct()
    sourced = t.dim_ingredient.join(t.dim_product.where("size_gm > 25").select(col("sku").alias("ingredient_id")),
                                    "ingredient_id").select(F.lower(F.trim("ingredient_name")).alias("need")).distinct().withColumn(
        "have", F.lit(True))
    share = need.join(sourced, "need", "left").groupBy("idea_id").agg(
        (F.count_if(col("have").isNotNull()) / F.count("*")).alias("share"))
    return share.select("idea_id", "share", ideas.ingredient_score(col("share")).alias("ingredient_availability"))


check_view("need_share", """
    SELECT idea_id, avg(CASE WHEN need IN (SELECT lower(trim(ingredient_name)) FROM dim_ingredient
                        JOIN dim_product ON sku = ingredient_id WHERE size_gm > 25) THEN 1.0 ELSE 0 END) AS share
    FROM (SELECT DISTINCT r.idea_id, lower(trim(i.ingredient_name)) AS need FROM dim_recipe r
          JOIN map_recipe_ingredient l USING (recipe_id) JOIN dim_ingredient i USING (ingredient_id)
          WHERE r.idea_id IS NOT NULL) GROUP BY 1""")
check_view("need_score", """
    SELECT idea_id, share, CASE WHEN share >= 0.8 THEN 5.0::DOUBLE ELSE round(share * 5, 1) END AS ingredient_availability
    FROM need_share""")
add("ingredient_match_share", lambda t: briefs_with_category(t).withColumn("share", F.round("share", 6)),
    "SELECT idea_id, round(share, 6) AS share, ingredient_availability FROM need_score")


def ranked(t):
    """Briefs scored with the category their hypothesis wording points at."""
    cats = cat_scores(t).select("category_name", "cat_subtotal")
    briefs = ideas.score_briefs(ideas.active_briefs(t, SALES)).withColumn(
        "category_name", F.when(col("hypothesis") == "No added sugar", "ECONOMY").when(
            col("hypothesis") == "", "PROMO").otherwise("SMALL"))
    scored = briefs.join(cats, "category_name").join(briefs_with_category(t), "idea_id", "left").fillna(
        2.5, ["ingredient_availability"])
    return ideas.pipeline_rank(scored)


check_view("ranked_briefs", """
    SELECT *, row_number() OVER (ORDER BY priority_score DESC, coalesce(stage_rank, 0) DESC,
              coalesce(days_in_stage, -1) DESC, right(idea_id, 2), idea_id) AS rank,
           CASE WHEN priority_score >= 70 THEN 'HIGH' WHEN priority_score >= 45 THEN 'MEDIUM' ELSE 'LOW' END AS priority_band
    FROM (SELECT b.*, c.category_name, round(b.brief_subtotal + c.cat_subtotal
                 + coalesce(n.ingredient_availability, 2.5) * 4, 1) AS priority_score
          FROM brief_scores b JOIN category_scores c ON c.category_name = CASE hypothesis WHEN 'No added sugar' THEN 'ECONOMY'
               WHEN '' THEN 'PROMO' ELSE 'SMALL' END LEFT JOIN need_score n USING (idea_id)
          WHERE b.stage IN ('Capture', 'Triage', 'Feasibility'))""")
add("pipeline_rank", lambda t: ranked(t).select("idea_id", "category_name", "priority_score", "priority_band", "rank"),
    "SELECT idea_id, category_name, priority_score, priority_band, rank FROM ranked_briefs")
add("topk_shortlist", lambda t: ideas.shortlist(ranked(t)), "SELECT " + ", ".join(
    f"""max(name) FILTER (rank = {i}) AS shortlist_{i}_name, max(category_name) FILTER (rank = {i}) AS shortlist_{i}_category,
        max(CAST(priority_score AS VARCHAR)) FILTER (rank = {i}) AS shortlist_{i}_score,
        max(priority_band) FILTER (rank = {i}) AS shortlist_{i}_band""" for i in (1, 2, 3)) + " FROM ranked_briefs")
add("name_similarity", lambda t: ideas.similar_names(t.dim_product.select("display_name"), "display_name"), """
    SELECT a.nm AS name_a, b.nm AS name_b,
           round(len(list_intersect(a.w, b.w)) / len(list_distinct(list_concat(a.w, b.w))), 4) AS similarity
    FROM name_words a JOIN name_words b ON a.nm < b.nm
    WHERE round(len(list_intersect(a.w, b.w)) / len(list_distinct(list_concat(a.w, b.w))), 4) >= 0.6""")
check_view("name_words", """
    SELECT nm, list_filter(list_distinct(regexp_split_to_array(lower(trim(nm)), '[^a-z0-9]+')), lambda x: x <> '') AS w
    FROM (SELECT DISTINCT display_name AS nm FROM dim_product)""")
LINE_AFTER = "l.qty_net_g / nullif(1 - l.loss_pct / 100, 0) / 1000 * i.price_inr_per_kg"
add("recipe_what_if", lambda t: recipes.recipe_what_if(t, edits(t), INV), f"""
    SELECT b.recipe_id, b.recipe_cogs_inr AS baseline_cogs_inr, {rounded('a.total', 3)} AS projected_cogs_inr,
           CASE WHEN b.target_cogs_inr IS NULL THEN 'UNKNOWN' WHEN a.total <= b.target_cogs_inr + 0.005 THEN 'INSIDE'
                WHEN a.total <= b.target_cogs_inr * 1.05 THEN 'MARGINAL' ELSE 'OVER' END AS projected_fit,
           a.mass AS projected_mass_g,
           {rounded(f"b.recipe_cogs_inr - {rounded('a.total', 3)}", 2)} AS saving_inr,
           abs(coalesce(a.mass, 0) - b.batch_size_g) <= 0.01 * b.batch_size_g AS mass_closes
    FROM recipe_costs b JOIN (
      SELECT r.recipe_id, coalesce(x.cost, 0) + r.packaging_cost_inr + r.labour_overhead_inr AS total, x.mass
      FROM recipe_costs r LEFT JOIN (
        SELECT l.recipe_id, round(sum(l.qty_net_g), 3) AS mass,
               round(sum({rounded(LINE_AFTER, 4)}), 4) AS cost
        FROM replayed_lines l LEFT JOIN ingredient_rates i USING (ingredient_id) GROUP BY 1) x USING (recipe_id)) a USING (recipe_id)
    WHERE b.recipe_id IN (SELECT recipe_id FROM edit_rows)""")
add("recipe_fork", lambda t: recipes.recipe_fork(t, edits(t))[0].select("recipe_id", "parent_recipe_id", "status", "version_no"), """
    SELECT new_id AS recipe_id, recipe_id AS parent_recipe_id, 'InTrial' AS status,
           CAST(regexp_extract(new_id, '-v([0-9]+)$', 1) AS BIGINT) AS version_no FROM forked_heads""")
