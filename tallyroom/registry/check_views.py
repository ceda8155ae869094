"""SQL forms of the shared views, written straight from their meaning so that
they check the Spark plans rather than repeat them."""

from tallyroom.constants import (FAMILY_PREFIX_RX, FAMILY_SIZE_RX, FORMULATION_RULES, INGREDIENT_TAGS, OPS_TERMS)
from tallyroom.registry.base import C, I, R, S, check_view, num_text, rounded, whole_text


def family(expr: str) -> str:
    return (f"trim(regexp_replace(regexp_replace({expr}, '{FAMILY_PREFIX_RX}', '', 'g'), "
            f"'{FAMILY_SIZE_RX}', '', 'g'))")


check_view("facets", """
    SELECT * FROM dim_product LEFT JOIN product_pricing USING (sku)
    LEFT JOIN product_packaging USING (sku) LEFT JOIN product_nutrition USING (sku)""")
check_view("capability", """
    SELECT product_line_id, product_line_name, category_name, count(*) AS active_skus,
           round(min(CAST(total_cogs_inr AS DOUBLE))) AS min_cogs_inr,
           round(max(CAST(total_cogs_inr AS DOUBLE))) AS max_cogs_inr,
           round(avg(shelf_life_days)) AS avg_shelf_life_days
    FROM facets JOIN dim_product_line USING (product_line_id) JOIN dim_category USING (category_id)
    WHERE is_active GROUP BY ALL""")
check_view("category_sales", f"""
    SELECT category_id AS category_name,
           sum(quantity) FILTER (order_date >= {S} - 90) AS units_90d,
           CAST(sum(total) FILTER (order_date >= {S} - 90) AS DOUBLE) AS net_revenue_90d,
           sum(quantity) FILTER (order_date < {S} - 90) AS units_prior_90d
    FROM business_analytics JOIN dim_product ON sku = sku_id
    WHERE order_state <> 'Cancelled' AND order_date >= {S} - 180 GROUP BY category_id""")
check_view("category_growth", """
    SELECT *, round((units_90d - units_prior_90d) / nullif(units_prior_90d, 0) * 100, 1) AS growth_pct
    FROM category_sales""")
check_view("category_forecast", f"""
    SELECT category_id AS category_name, round(sum(predicted_sales_quantity), 1) AS forecast_units_next
    FROM forecast_results JOIN dim_product ON sku = sku_id
    WHERE is_latest_forecast AND days_ahead IN (1, 2, 3) AND forecast_date >= {S} GROUP BY category_id""")
check_view("category_presence", """
    SELECT category_id AS category_name, count(*) AS active_skus_in_category,
           count(*) FILTER (trim(org_labelling_compliance) NOT IN ('', 'false')) AS skus_with_label_compliance,
           count(*) FILTER (trim(gs1_barcode) <> '') AS skus_with_barcode,
           count(*) FILTER (sku IN (SELECT sku FROM map_product_allergen)) AS skus_with_declared_allergens
    FROM facets WHERE is_active GROUP BY category_id""")
check_view("category_channels", """
    SELECT p.category_id AS category_name,
           count(DISTINCT CASE WHEN m.applicable IS NOT NULL THEN m.channel_id END) AS channels_listed,
           count(DISTINCT c.channel_id) AS channels_mapped
    FROM dim_product p LEFT JOIN map_product_channel m ON m.sku = p.sku
    LEFT JOIN dim_channel c ON c.channel_id = m.channel_id WHERE p.is_active GROUP BY p.category_id""")
check_view("category_rivals", """
    SELECT upper(trim(category)) AS category_key, count(*) AS active_competitor_products,
           count(DISTINCT m.competitor_id) AS distinct_competitors
    FROM dim_competitor_product p JOIN dim_competitor m ON m.competitor_id = p.competitor_id
    WHERE p.is_active AND m.is_active GROUP BY 1""")
check_view("market_signal_facts", """
    SELECT d.category_name, g.* EXCLUDE (category_name), f.forecast_units_next, p.* EXCLUDE (category_name),
           n.channels_listed, n.channels_mapped, x.active_competitor_products, x.distinct_competitors
    FROM dim_category d LEFT JOIN category_growth g ON g.category_name = d.category_name
    LEFT JOIN category_forecast f ON f.category_name = d.category_name
    LEFT JOIN category_presence p ON p.category_name = d.category_name
    LEFT JOIN category_channels n ON n.category_name = d.category_name
    LEFT JOIN category_rivals x ON x.category_key = upper(trim(d.category_name))""")
check_view("idea_inputs", f"""
    SELECT idea_id, name, stage, hypothesis, thesis_fit, target_cogs_inr, days_in_stage, stage_rank,
           lo AS portfolio_min_cogs_inr, hi AS portfolio_max_cogs_inr,
           CASE WHEN target_cogs_inr IS NULL THEN 'UNKNOWN' WHEN target_cogs_inr < lo THEN 'BELOW'
                WHEN target_cogs_inr > hi THEN 'ABOVE' ELSE 'INSIDE' END AS cogs_fit
    FROM (SELECT idea_id, name, stage, hypothesis, thesis_fit, CAST(target_cogs_inr AS DOUBLE) AS target_cogs_inr,
                 date_diff('day', CAST(stage_entered_at AS DATE), {S}) AS days_in_stage,
                 CAST(nullif(list_position(['Capture', 'Triage', 'Feasibility', 'Pipeline', 'Development'], stage), 0)
                      AS BIGINT) AS stage_rank
          FROM dim_idea WHERE stage IS NULL OR stage NOT IN ('Rejected', 'Launch')),
         (SELECT round(min(min_cogs_inr)) AS lo, round(max(max_cogs_inr)) AS hi FROM capability)""")
check_view("brief_scores", """
    SELECT *, cogs_score * 4 + time_score * 2 AS brief_subtotal FROM (
      SELECT *, CASE cogs_fit WHEN 'INSIDE' THEN 5.0::DOUBLE WHEN 'BELOW' THEN 4 WHEN 'ABOVE' THEN 2 ELSE 2.5 END
                 AS cogs_score,
             CASE WHEN days_in_stage IS NULL THEN 2.5::DOUBLE WHEN days_in_stage < 15 THEN 0
                  WHEN days_in_stage < 31 THEN 1 WHEN days_in_stage < 46 THEN 2 WHEN days_in_stage < 61 THEN 3
                  WHEN days_in_stage < 90 THEN 4 ELSE 5 END AS time_score,
             CASE WHEN cogs_fit = 'UNKNOWN' AND days_in_stage IS NULL THEN 'cogs_vs_target,time_in_stage'
                  WHEN cogs_fit = 'UNKNOWN' THEN 'cogs_vs_target' WHEN days_in_stage IS NULL THEN 'time_in_stage'
                  ELSE 'none' END AS unknowns
      FROM idea_inputs)""")
check_view("category_scores", """
    SELECT *, market_signal * 5 + compliance_readiness * 3 + channel_fit * 2 AS cat_subtotal FROM (
      SELECT *, CAST(CASE WHEN coalesce(units_90d, 0) <= 0 THEN 0 WHEN units_90d < 500 THEN 1
                     WHEN units_90d < 2000 THEN 2 ELSE 3 END
                + CASE WHEN coalesce(growth_pct, -1) < 0 THEN 0 WHEN growth_pct < 25 THEN 1 ELSE 2 END AS BIGINT)
                AS market_signal,
             CAST(round(5 * coalesce((skus_with_label_compliance + skus_with_barcode + skus_with_declared_allergens)
                        / nullif(3.0 * active_skus_in_category, 0), 0)) AS BIGINT) AS compliance_readiness,
             CAST(round(5 * coalesce(channels_listed / nullif(channels_mapped, 0), 0)) AS BIGINT) AS channel_fit
      FROM market_signal_facts)""")
check_view("family_list", f"""
    SELECT {family('display_name')} AS fam, min(sku) AS sku,
           CAST(round(min(CAST(total_cogs_inr AS DOUBLE))) AS BIGINT) AS cogs
    FROM facets WHERE is_active GROUP BY 1""")
check_view("complaints", """
    SELECT * REPLACE (coalesce(event_id, email_message_id) AS event_id) FROM customer_complaint_events""")
check_view("members", """
    SELECT DISTINCT r.sku, l.ingredient_id FROM dim_recipe r JOIN map_recipe_ingredient l USING (recipe_id)
    WHERE r.is_current AND r.sku IS NOT NULL
    UNION SELECT sku, ingredient_id FROM map_product_ingredient m
    WHERE sku NOT IN (SELECT sku FROM dim_recipe WHERE is_current AND sku IS NOT NULL)""")

# ---- recipes ------------------------------------------------------------------------
check_view("ingredient_rates", f"""
    SELECT i.ingredient_id, i.ingredient_name, p.supplier_name, CAST(p.price_inr AS DOUBLE) AS price_inr, p.price_uom,
           CASE p.price_uom WHEN 'kg' THEN CAST(p.price_inr AS DOUBLE)
                WHEN 'L' THEN CAST(p.price_inr AS DOUBLE) / nullif(coalesce(CAST(p.density_g_per_ml AS DOUBLE), 1.0), 0)
           END AS price_inr_per_kg,
           p.effective_from, p.effective_to, p.price_source, p.price_id IS NOT NULL AS is_costed,
           date_diff('day', p.effective_from, {I}) AS price_age_days
    FROM dim_ingredient i LEFT JOIN (
      SELECT * FROM dim_ingredient_price WHERE effective_from <= {I} AND (effective_to IS NULL OR effective_to > {I})
      QUALIFY row_number() OVER (PARTITION BY ingredient_id
                                 ORDER BY effective_from DESC, price_id DESC, price_inr DESC) = 1) p USING (ingredient_id)""")
check_view("priced", """
    SELECT l.*, l.qty_net_g / nullif(1 - l.loss_pct / 100, 0) AS qty_gross_g, r.ingredient_name, r.price_inr_per_kg,
           r.is_costed, r.price_source, r.supplier_name,
           l.qty_net_g / nullif(1 - l.loss_pct / 100, 0) / 1000 * r.price_inr_per_kg AS raw_cost
    FROM map_recipe_ingredient l LEFT JOIN ingredient_rates r USING (ingredient_id)""")
check_view("line_costs", f"""
    SELECT * EXCLUDE (raw_cost), {rounded('raw_cost', 4)} AS line_cost_inr,
           {rounded('raw_cost / nullif(sum(raw_cost) OVER (PARTITION BY recipe_id), 0) * 100', 1)} AS cost_share_pct
    FROM priced""")
check_view("recipe_costs", f"""
    SELECT recipe_id, sku, idea_id, recipe_name, parent_recipe_id, status, is_current, version_no, batch_size_g,
           target_cogs_inr, packaging_cost_inr, labour_overhead_inr, lines, uncosted_lines, net_mass_g, gross_mass_g,
           ingredient_cost_inr, master_cogs_inr, {rounded('total', 3)} AS recipe_cogs_inr,
           uncosted_lines = 0 AS is_fully_costed,
           {rounded('net_mass_g / nullif(gross_mass_g, 0) * 100', 2)} AS yield_pct,
           {rounded('net_mass_g - batch_size_g', 3)} AS mass_variance_g,
           {rounded('ingredient_cost_inr / nullif(total, 0) * 100', 1)} AS ingredient_share_pct,
           {rounded('labour_overhead_inr / nullif(total, 0) * 100', 1)} AS overhead_share_pct,
           {rounded('total / nullif(net_mass_g, 0) * 100', 3)} AS cogs_per_100g_inr,
           {rounded('total - master_cogs_inr', 3)} AS master_variance_inr,
           {rounded('(total - master_cogs_inr) / nullif(master_cogs_inr, 0) * 100', 2)} AS master_variance_pct,
           CASE WHEN target_cogs_inr IS NULL THEN 'UNKNOWN' WHEN total <= target_cogs_inr + 0.005 THEN 'INSIDE'
                WHEN total <= target_cogs_inr * 1.05 THEN 'MARGINAL' ELSE 'OVER' END AS target_fit
    FROM (SELECT r.* REPLACE (coalesce(version_no, TRY_CAST(regexp_extract(recipe_id, '-v([0-9]+)$', 1) AS BIGINT))
                              AS version_no, coalesce(r.packaging_cost_inr, 0)::DOUBLE AS packaging_cost_inr),
                 coalesce(a.lines, 0) AS lines, coalesce(a.uncosted_lines, 0) AS uncosted_lines, a.net_mass_g,
                 a.gross_mass_g, coalesce(a.cost, 0) AS ingredient_cost_inr,
                 coalesce(a.cost, 0) + coalesce(r.packaging_cost_inr, 0)::DOUBLE + r.labour_overhead_inr AS total,
                 CAST(pp.total_cogs_inr AS DOUBLE) AS master_cogs_inr
          FROM dim_recipe r LEFT JOIN (
            SELECT recipe_id, count(*) AS lines, count(*) FILTER (NOT coalesce(is_costed, false)) AS uncosted_lines,
                   {rounded('sum(qty_net_g)', 3)} AS net_mass_g, {rounded('sum(qty_gross_g)', 3)} AS gross_mass_g,
                   {rounded('sum(line_cost_inr)', 4)} AS cost FROM line_costs GROUP BY recipe_id) a USING (recipe_id)
          LEFT JOIN product_pricing pp ON pp.sku = r.sku)""")
TAG_ROWS = ", ".join(f"('{tag}', '{rx}', '{no}')" for tag, rx, no in INGREDIENT_TAGS)
RULE_ROWS = ", ".join(f"('{rule}', '{rx}', '{tag}', '{src}')" for rule, rx, tag, src in FORMULATION_RULES)
check_view("ingredient_tags", f"""
    SELECT ingredient_id, tag FROM dim_ingredient, (VALUES {TAG_ROWS}) AS tag_rules(tag, rx, no_rx)
    WHERE regexp_matches(lower(ingredient_name), rx)
      AND (no_rx = '' OR NOT regexp_matches(lower(ingredient_name), no_rx))""")
check_view("recipe_texts", """
    SELECT r.recipe_id, lower(concat_ws(' ', coalesce(r.recipe_name, ''), coalesce(i.name, ''),
           coalesce(i.hypothesis, ''), coalesce(i.thesis_fit, ''), coalesce(h.claims, ''))) AS txt
    FROM dim_recipe r LEFT JOIN dim_idea i ON i.idea_id = r.idea_id
    LEFT JOIN (SELECT sku, string_agg(highlight_text, ' ' ORDER BY highlight_seq, highlight_text) AS claims
               FROM product_highlight GROUP BY sku) h ON h.sku = r.sku""")
check_view("recipe_rules", f"""
    SELECT recipe_id, rule, banned_tag, source FROM recipe_texts,
           (VALUES {RULE_ROWS}) AS rule_rows(rule, rx, banned_tag, source)
    WHERE rx = '' OR regexp_matches(txt, rx)""")
check_view("main_roles", """
    SELECT ingredient_id, role FROM (SELECT ingredient_id, role, count(*) AS n FROM map_recipe_ingredient GROUP BY ALL)
    QUALIFY row_number() OVER (PARTITION BY ingredient_id ORDER BY n DESC, role) = 1""")
check_view("swap_pool", """
    SELECT ingredient_id, ingredient_name, role, price_inr_per_kg, supplier_name,
           row_number() OVER (PARTITION BY role ORDER BY price_inr_per_kg, ingredient_id) AS pos
    FROM ingredient_rates JOIN main_roles USING (ingredient_id) WHERE is_costed""")
check_view("own_items", "SELECT DISTINCT recipe_id, ingredient_id FROM map_recipe_ingredient")
check_view("deepest", "SELECT max(n) AS most FROM (SELECT count(*) AS n FROM own_items GROUP BY recipe_id)")
check_view("role_swaps", """
    SELECT w.recipe_id, s.*, row_number() OVER (PARTITION BY w.recipe_id ORDER BY s.price_inr_per_kg, s.ingredient_id)
           AS rnk
    FROM (SELECT DISTINCT recipe_id, role FROM map_recipe_ingredient) w
    JOIN (SELECT * FROM swap_pool, deepest WHERE pos <= 12 + most) s ON s.role = w.role
    ANTI JOIN own_items o ON o.recipe_id = w.recipe_id AND o.ingredient_id = s.ingredient_id
    QUALIFY rnk <= 12""")
check_view("all_swaps", """
    SELECT q.recipe_id, q.role, q.rnk, q.ingredient_id, q.ingredient_name, q.price_inr_per_kg,
           coalesce('VIOLATES:' || (SELECT string_agg(DISTINCT rr.rule, '+' ORDER BY rr.rule)
                    FROM recipe_rules rr JOIN ingredient_tags it ON it.tag = rr.banned_tag
                    WHERE rr.recipe_id = q.recipe_id AND it.ingredient_id = q.ingredient_id), 'ALLOWED') AS verdict
    FROM (SELECT r.recipe_id, s.role, s.ingredient_id, s.ingredient_name, s.price_inr_per_kg,
                 row_number() OVER (PARTITION BY r.recipe_id, s.role ORDER BY s.price_inr_per_kg, s.ingredient_id) AS rnk
          FROM dim_recipe r CROSS JOIN (SELECT * FROM swap_pool, deepest WHERE pos <= 2 + most) s
          ANTI JOIN own_items o ON o.recipe_id = r.recipe_id AND o.ingredient_id = s.ingredient_id
          QUALIFY rnk <= 2) q""")
DEAR = "line_cost_inr DESC NULLS LAST, ingredient_id, line_seq, role, qty_net_g, loss_pct"
check_view("dear_lines", f"""
    SELECT *, row_number() OVER (PARTITION BY recipe_id ORDER BY {DEAR}) AS rnk FROM line_costs""")
check_view("verdicts", f"""
    SELECT recipe_id, status, unnest([
      {{'rule': 'target_cogs', 'verdict': target_fit,
        'evidence': {num_text('recipe_cogs_inr', 2)} || ' vs ' || coalesce({num_text('target_cogs_inr', 2)}, 'no target')}},
      {{'rule': 'mass_closes', 'verdict': CASE WHEN abs(coalesce(mass_variance_g, 0)) <= 0.01 * batch_size_g
                                         THEN 'PASS' ELSE 'FAIL' END,
        'evidence': {num_text('coalesce(net_mass_g, 0)', 1)} || 'g vs declared ' || {whole_text('batch_size_g')} || 'g'}},
      {{'rule': 'fully_costed', 'verdict': CASE WHEN is_fully_costed THEN 'PASS' ELSE 'FAIL' END,
        'evidence': uncosted_lines || ' of ' || lines || ' lines lack a rate'}},
      {{'rule': 'yield_plausible', 'verdict': CASE WHEN coalesce(yield_pct, 100) BETWEEN 80 AND 100 THEN 'PASS'
                                             ELSE 'REVIEW' END,
        'evidence': {num_text('coalesce(yield_pct, 0)', 2)} || '%'}}], recursive := true)
    FROM recipe_costs""")

# ---- marketing -----------------------------------------------------------------------
AD_SUMS = """min(res_id) AS res_id, min(platform) AS platform, min(product_type) AS product_type,
       min(targeting) AS targeting, min(segments) AS segments,
       round(CAST(sum(ad_spend_rs) AS DOUBLE), 0) AS ad_spend_rs, round(CAST(sum(ad_sales_rs) AS DOUBLE), 0) AS ad_sales_rs,
       CAST(sum(ad_orders) AS BIGINT) AS ad_orders, CAST(sum(ad_impressions) AS BIGINT) AS ad_impressions,
       CAST(sum(ad_clicks) AS BIGINT) AS ad_clicks,
       CAST(sum(ad_sales_rs) AS DOUBLE) / nullif(CAST(sum(ad_spend_rs) AS DOUBLE), 0) AS roi,
       CAST(min(ads_m2o_pct) AS DOUBLE) AS ads_m2o_pct, CAST(min(overall_m2o_pct) AS DOUBLE) AS overall_m2o_pct,
       CAST(sum(ad_sales_rs) - sum(ad_spend_rs) AS DOUBLE) / nullif(CAST(sum(ad_spend_rs) AS DOUBLE), 0) AS roas,
       CAST(sum(ad_clicks) AS DOUBLE) / nullif(CAST(sum(ad_impressions) AS DOUBLE), 0) AS ctr"""
check_view("store_ads", """
    SELECT m.master_store_id, r.*, CASE WHEN r.res_id = CAST(m.zomato_id AS VARCHAR) THEN 'ZOMATO' ELSE 'SWIGGY' END
           AS platform
    FROM raw_marketing_data r JOIN store_channel_mapping m
      ON r.res_id IN (CAST(m.zomato_id AS VARCHAR), CAST(m.swiggy_id AS VARCHAR))""")
check_view("campaign_now", f"""
    SELECT master_store_id, campaign_id, max(date) AS date, min(start_date) AS start_date, max(end_date) AS end_date,
           {AD_SUMS}
    FROM store_ads WHERE date >= date_trunc('month', {C}) AND {C} BETWEEN start_date AND end_date GROUP BY 1, 2""")
check_view("campaign_months", f"""
    SELECT master_store_id, campaign_id, CAST(date_trunc('month', date) AS DATE) AS month,
           min(date) AS window_start, max(date) AS window_end, {AD_SUMS}
    FROM store_ads GROUP BY 1, 2, 3""")
check_view("budget_rows", """
    SELECT s.segment_id, b.master_store_id, b.store_name, b.channel, b.budget_month,
           CAST(b.allocated_budget_rs AS DOUBLE) AS allocated_budget_rs,
           CAST(b.expected_revenue_rs AS DOUBLE) AS expected_revenue_rs
    FROM marketing_budget b JOIN marketing_segment_master s
      ON s.segment_code = b.segment_type AND upper(s.channel) = upper(b.channel)""")


IMPACT = """CASE WHEN rung IN ('zero', 'stop') THEN ad_spend_rs WHEN rung = 'reduce' THEN ad_spend_rs * 0.3::DOUBLE
                 WHEN rung = 'cautious' THEN ad_spend_rs * 0.15::DOUBLE * r
                 WHEN rung = 'confident' THEN ad_spend_rs * 0.3::DOUBLE * r END"""


def ladder_sql(source: str, actions: dict) -> str:
    """All ladder outputs over a campaign rowset."""
    roi = "coalesce(roi, 0)"
    edge = f"least(abs({roi} - 0.75), abs({roi} - 1.0), abs({roi} - 1.5), abs({roi} - 2.5), abs({roi} - 10.0))"
    return f"""
    SELECT * EXCLUDE (edge, r),
      CASE rung {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in {**actions, 'zero': actions['stop']}.items())} END
        AS suggested_action,
      CASE rung WHEN 'no_spend' THEN 'no_spend' WHEN 'thin' THEN 'insufficient_sample'
        WHEN 'zero' THEN CASE WHEN ad_spend_rs >= 200 THEN 'critical_failure' ELSE 'underperforming' END
        WHEN 'stop' THEN 'underperforming' WHEN 'reduce' THEN 'weak' WHEN 'hold' THEN 'breakeven'
        WHEN 'cautious' THEN 'good' WHEN 'confident' THEN 'excellent' ELSE 'outlier' END AS category,
      CASE WHEN rung IN ('no_spend', 'thin', 'outlier') OR ad_orders < 20 OR edge <= 0.1 THEN 'LOW'
           WHEN edge >= 0.3 THEN 'HIGH' ELSE 'MEDIUM' END AS confidence,
      CASE WHEN rung IN ('no_spend', 'thin') THEN 'LOW'
           WHEN ad_spend_rs >= 5000 AND rung IN ('zero', 'stop', 'cautious', 'confident') THEN 'HIGH'
           WHEN ad_spend_rs < 1000 OR rung IN ('hold', 'outlier') THEN 'LOW' ELSE 'MEDIUM' END AS priority,
      {rounded(IMPACT, 2)} AS estimated_impact
    FROM (SELECT *, {roi} AS r, {edge} AS edge,
            CASE WHEN ad_spend_rs = 0 THEN 'no_spend' WHEN ad_orders < 5 THEN 'thin' WHEN {roi} = 0 THEN 'zero'
                 WHEN {roi} < 0.75 THEN 'stop' WHEN {roi} < 1 THEN 'reduce' WHEN {roi} < 1.5 THEN 'hold'
                 WHEN {roi} < 2.5 THEN 'cautious' WHEN {roi} <= 10 THEN 'confident' ELSE 'outlier' END AS rung
          FROM {source})"""


# ---- stock -----------------------------------------------------------------------------
check_view("stocked", """
    SELECT * EXCLUDE (report_date) FROM flagged_inventory
    QUALIFY row_number() OVER (PARTITION BY master_store_id, sku_id ORDER BY report_date DESC, total_stock DESC,
            safe_stock DESC, expired_stock DESC, qty_expiring_within_risk_days DESC, soonest_expiry DESC,
            wastage_flag DESC, low_stock_flag DESC, shelf_life_days DESC) = 1""")
check_view("newest_stock", """
    SELECT * FROM store_inventory_daily
    QUALIFY snapshot_date = max(snapshot_date) OVER (PARTITION BY store_id)""")
check_view("routes", """
    SELECT CAST(from_store_id AS VARCHAR) AS from_store_id, CAST(to_store_id AS VARCHAR) AS to_store_id,
           CAST(distance_km AS DOUBLE) AS distance_km, preferred_for_transfer FROM store_transfer_distances""")
check_view("nearest", """
    SELECT from_store_id AS store_id, to_store_id AS nearest_store_id, distance_km FROM routes
    QUALIFY row_number() OVER (PARTITION BY from_store_id ORDER BY distance_km, to_store_id) = 1""")
OPS_HIT = " OR ".join(f"contains(issue_type, '{w}')" for w in OPS_TERMS)
check_view("ops_by_store", f"""
    SELECT master_store_id, count(*) FILTER ({OPS_HIT}) AS ops_complaints,
           count(*) FILTER (regexp_matches(issue_type, '[Ll]ate|[Dd]elay')) AS late_delivery,
           count(*) FILTER (regexp_matches(issue_type, '[Pp]ackag|[Ss]pillage')) AS bad_condition,
           count(*) FILTER (regexp_matches(issue_type, '[Ww]rong|[Mm]issing')) AS wrong_missing,
           count(master_store_id) AS total_complaints
    FROM customer_complaint_events WHERE CAST(complaint_received_at AS DATE) >= {S} - 60 GROUP BY master_store_id""")
check_view("review_rows", f"""
    SELECT *, CAST(review_date AS DATE) AS day FROM customer_review_events
    WHERE CAST(review_date AS DATE) >= {R} - 30""")

# ---- review edits -------------------------------------------------------------------------
check_view("edit_rows", """
    SELECT 'RCP-' || l_orderkey || '-v' || (l_orderkey % 3 + 1) AS recipe_id,
           CAST(l_linenumber * 100 + l_quantity AS BIGINT) AS round_no,
           CASE WHEN l_returnflag = 'A' THEN 'SET' WHEN l_returnflag = 'R' THEN 'SCALE'
                WHEN l_linestatus = 'F' THEN 'ZERO' ELSE 'ADD' END AS kind,
           CAST(CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN l_suppkey ELSE l_partkey END AS VARCHAR)
               AS ingredient_id,
           CASE WHEN l_returnflag = 'R' THEN 0.85::DOUBLE WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 0
                ELSE l_quantity - 20 END AS amount,
           l_discount > 0.085 AS withdrawn
    FROM lineitem""")
check_view("live_edits", "SELECT * FROM edit_rows WHERE NOT withdrawn")
check_view("last_absolute", """
    SELECT recipe_id, ingredient_id, round_no, kind, amount FROM live_edits WHERE kind <> 'SCALE'
    QUALIFY row_number() OVER (PARTITION BY recipe_id, ingredient_id ORDER BY round_no DESC, amount DESC, kind DESC) = 1""")
check_view("edit_factor", """
    SELECT e.recipe_id, e.ingredient_id, product(e.amount) AS factor FROM live_edits e
    LEFT JOIN last_absolute a ON a.recipe_id = e.recipe_id AND a.ingredient_id = e.ingredient_id
    WHERE e.kind = 'SCALE' AND (a.round_no IS NULL OR e.round_no > a.round_no) GROUP BY ALL""")
check_view("replayed_lines", """
    SELECT recipe_id, ingredient_id, qty AS qty_net_g, loss AS loss_pct FROM (
      SELECT recipe_id, ingredient_id, round(coalesce(a.amount, k.qty_net_g) * coalesce(x.factor, 1), 6) AS qty,
             coalesce(k.loss_pct, 0) AS loss, k.qty_net_g IS NOT NULL OR a.kind = 'ADD' AS keep
      FROM (SELECT recipe_id, ingredient_id, sum(qty_net_g) AS qty_net_g,
                   round(sum(loss_pct * qty_net_g) / nullif(sum(qty_net_g), 0), 6) AS loss_pct
            FROM map_recipe_ingredient GROUP BY ALL) k
      FULL JOIN last_absolute a USING (recipe_id, ingredient_id)
      FULL JOIN edit_factor x USING (recipe_id, ingredient_id))
    WHERE keep AND qty > 0""")
check_view("forked_heads", """
    SELECT recipe_id, regexp_replace(recipe_id, '-v[0-9]+$', '') || '-v'
           || (coalesce(version_no, CAST(regexp_extract(recipe_id, '-v([0-9]+)$', 1) AS BIGINT)) + 1) AS new_id
    FROM dim_recipe WHERE recipe_id IN (SELECT recipe_id FROM live_edits)""")
