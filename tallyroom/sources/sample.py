"""Mapping of the driver's parquet tables onto the retail model.

Each entry is one projection written in SQL that Spark and DuckDB both accept,
so the same text defines the input of a query and of its SQL check. ``{name}``
stands for another table: a parquet file or an earlier entry.
"""

PARQUET = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
           "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

SAMPLE_SQL = {
    # ---- products -----------------------------------------------------------------
    "dim_product": """
        SELECT CAST(p_partkey AS STRING) AS sku,
               CASE p_type WHEN 'ECONOMY' THEN 'Dessert - ' WHEN 'PROMO' THEN 'SNACK-'
                    WHEN 'LARGE' THEN 'Mithai -' WHEN 'SMALL' THEN 'fudge - ' ELSE '' END
               || CASE WHEN p_size > 25 THEN split_part(p_name, ' ', 2) ELSE p_name END
               || ' - ' || CAST(p_size AS STRING) || ' gm' AS display_name,
               split_part(p_name, ' ', 1) AS flavour,
               CAST(p_size AS DOUBLE) AS size_gm,
               CAST(p_size AS STRING) || ' gm' AS size_label,
               'v1' AS version,
               CASE WHEN p_size > 40 THEN 'Live' WHEN p_size > 30 THEN 'OccasionallyLive'
                    WHEN p_size > 20 THEN 'UnderTrial' WHEN p_size > 10 THEN 'UnderDevelopment'
                    ELSE 'Retired' END AS status,
               CASE WHEN p_size > 45 THEN 'NonVeg' ELSE 'Veg' END AS veg_nonveg,
               p_size > 10 AS is_active,
               p_name AS description,
               CAST(NULL AS STRING) AS images_link,
               p_brand AS product_line_id,
               p_type AS category_id
        FROM {part}""",
    "product_pricing": """
        SELECT CAST(p_partkey AS STRING) AS sku,
               CAST(p_retailprice AS DECIMAL(18,2)) AS base_price_inr,
               CAST(CASE WHEN p_size > 30 THEN 18 ELSE 5 END AS DECIMAL(5,2)) AS gst_rate,
               CAST(CAST(p_retailprice AS DECIMAL(18,2)) * CAST(1.1 AS DECIMAL(3,1)) AS DECIMAL(18,3)) AS mrp_inr,
               CASE WHEN p_size = 13 THEN NULL
                    ELSE CAST(CAST(p_retailprice AS DECIMAL(18,2)) * CAST(0.4 AS DECIMAL(3,1)) AS DECIMAL(18,3))
               END AS total_cogs_inr,
               CAST(p_size * 3 AS BIGINT) AS shelf_life_days
        FROM {part}""",
    "product_packaging": """
        SELECT CAST(p_partkey AS STRING) AS sku,
               split_part(p_name, ' ', 2) AS packaging_type,
               CASE WHEN p_size < 15 THEN '' WHEN p_size < 20 THEN NULL
                    ELSE '890' || lpad(CAST(p_partkey AS STRING), 9, '0') END AS gs1_barcode,
               CASE WHEN p_size < 18 THEN 'false' WHEN p_size < 24 THEN NULL ELSE ' true ' END
                   AS org_labelling_compliance
        FROM {part}""",
    "product_nutrition": """
        SELECT CAST(p_partkey AS STRING) AS sku, CAST(p_size AS STRING) || ' g' AS serving_size,
               CASE WHEN p_size <> 44 THEN DATE '2001-07-01' - CAST(p_size * 20 AS INT) END AS lab_reported_on
        FROM {part}""",
    "product_highlight": """
        SELECT CAST(p_partkey AS STRING) AS sku, CAST(1 AS BIGINT) AS highlight_seq,
               CASE WHEN p_size > 40 THEN 'Vegan and nut-free' WHEN p_size > 30 THEN 'Gluten free'
                    WHEN p_size > 20 THEN 'No added sugar' ELSE 'Eggless' END AS highlight_text
        FROM {part}
        UNION ALL
        SELECT CAST(p_partkey AS STRING), CAST(2 AS BIGINT), 'Made with ' || p_name
        FROM {part}""",
    "product_nutrient": """
        SELECT CAST(p_partkey AS STRING) AS sku, lower(p_type) AS nutrient_name,
               CAST(p_size AS DOUBLE) AS amount
        FROM {part}""",
    "dim_product_line": """
        SELECT DISTINCT p_brand AS product_line_id, 'Line ' || p_brand AS product_line_name FROM {part}""",
    "dim_category": "SELECT DISTINCT p_type AS category_id, p_type AS category_name FROM {part}",
    "map_product_allergen": """
        SELECT CAST(l_partkey * 2 AS STRING) AS sku,
               CASE l_returnflag WHEN 'R' THEN 'Milk' WHEN 'A' THEN 'Nut' END AS allergen
        FROM {lineitem}""",
    "dim_channel": """
        SELECT 'CH-' || CAST(n_nationkey AS STRING) AS channel_id,
               CASE n_nationkey WHEN 1 THEN 'Swiggy' WHEN 2 THEN 'Zomato' ELSE n_name END AS channel_name,
               CASE WHEN n_nationkey < 10 THEN 'Delivery' WHEN n_nationkey < 20 THEN 'Retail'
                    ELSE 'Kiosk' END AS channel_type
        FROM {nation}""",
    "map_product_channel": """
        SELECT CAST(l_partkey AS STRING) AS sku, 'CH-' || CAST(l_linenumber AS STRING) AS channel_id,
               CASE l_returnflag WHEN 'A' THEN 'Suitable For' WHEN 'R' THEN 'Small Pack' END AS applicable
        FROM {lineitem}""",
    "listing_package": """
        SELECT CAST(p_partkey AS STRING) AS sku, p_size > 10 AS is_active,
               CASE WHEN p_size > 40 THEN '' WHEN p_size > 25 THEN 'barcode'
                    WHEN p_size > 15 THEN 'barcode;label' ELSE 'barcode;label;panel' END AS blocking_gaps,
               CASE WHEN p_size > 45 THEN 'milk' END AS allergen_underdeclared,
               CASE WHEN p_size > 20 THEN 'own' ELSE 'sibling' END AS ingredient_source,
               CASE WHEN p_size > 30 THEN 'per_100g' WHEN p_size > 20 THEN 'unknown'
                    ELSE 'no_panel' END AS nutrient_basis,
               CASE WHEN p_size < 22 THEN 'fat' END AS mandatory_nutrients_blank
        FROM {part}""",
    "listing_claim_check": """
        SELECT CAST(l_partkey AS STRING) AS sku,
               CASE l_returnflag || l_linestatus WHEN 'AF' THEN 'MISMATCH' WHEN 'AO' THEN 'CONTRADICTED'
                    WHEN 'RF' THEN 'MALFORMED_CLAIM' WHEN 'RO' THEN 'unverified'
                    ELSE 'substantiated' END AS verdict
        FROM {lineitem}""",
    # ---- ideas, competitors -----------------------------------------------------------
    "dim_idea": """
        SELECT 'IDEA_' || CAST(o_orderkey AS STRING) AS idea_id,
               lower(replace(substr(o_orderpriority, 3), 'NOT SPECIFIED', 'open')) || ' bar '
               || CAST(CAST(floor(o_totalprice / 25000) AS BIGINT) AS STRING) || ' '
               || CASE o_orderstatus WHEN 'F' THEN 'nut' WHEN 'O' THEN 'date' ELSE 'seed' END AS name,
               CASE WHEN o_orderkey % 11 = 0 THEN NULL
                    WHEN o_orderpriority = '1-URGENT' THEN 'Capture'
                    WHEN o_orderpriority = '2-HIGH' THEN 'Triage'
                    WHEN o_orderpriority = '3-MEDIUM' THEN 'Feasibility'
                    WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'Pipeline'
                    WHEN o_orderstatus = 'F' THEN 'Rejected'
                    WHEN o_orderstatus = 'O' THEN 'Launch' ELSE 'Development' END AS stage,
               CASE o_orderstatus WHEN 'F' THEN 'Vegan and gluten-free bite'
                    WHEN 'O' THEN 'No added sugar' ELSE '' END AS hypothesis,
               CASE WHEN o_totalprice > 250000 THEN 'egg free' END AS thesis_fit,
               CASE WHEN o_orderkey % 7 = 0 THEN NULL
                    ELSE CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.002 AS DECIMAL(4,3)) END AS target_cogs_inr,
               CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderdate END AS stage_entered_at
        FROM {orders}""",
    "dim_competitor": """
        SELECT 'C' || CAST(s_suppkey AS STRING) AS competitor_id, s_name AS competitor_name,
               CASE WHEN s_nationkey < 5 THEN ' economy' WHEN s_nationkey < 10 THEN 'Promo '
                    WHEN s_nationkey < 15 THEN 'LARGE' WHEN s_nationkey < 20 THEN 'standard'
                    ELSE 'Beverages' END AS category,
               s_acctbal > 0 AS is_active
        FROM {supplier}""",
    "dim_competitor_product": """
        SELECT 'CP' || CAST(c_custkey AS STRING) AS competitor_product_id,
               'C' || CAST(c_nationkey AS STRING) AS competitor_id,
               c_name AS product_name, c_mktsegment AS size, c_acctbal > 0 AS is_active,
               CAST(c_acctbal AS DECIMAL(18,2)) AS price_inr
        FROM {customer}""",
    "map_competitor_product": """
        SELECT 'CP' || CAST(c_custkey AS STRING) AS competitor_product_id,
               CAST(c_custkey AS STRING) AS sku,
               CASE WHEN c_acctbal > 5000 THEN 0.9 ELSE 0.6 END AS match_confidence
        FROM {customer}""",
    # ---- recipes -----------------------------------------------------------------------
    "dim_ingredient": """
        SELECT CAST(p_partkey AS STRING) AS ingredient_id,
               CASE WHEN p_name = 'small plate' THEN 'Sugar' ELSE split_part(p_name, ' ', 1) || ' '
               || CASE split_part(p_name, ' ', 2) WHEN 'rod' THEN 'almond milk' WHEN 'gear' THEN 'cocoa butter'
                       WHEN 'ring' THEN 'palm jaggery' WHEN 'widget' THEN 'wheat flour'
                       WHEN 'bolt' THEN 'gelatin' WHEN 'plate' THEN 'milk powder'
                       WHEN 'anvil' THEN 'palm oil' ELSE 'oats' END END AS ingredient_name,
               p_brand AS category
        FROM {part}""",
    "map_product_ingredient": """
        SELECT CAST(l_partkey AS STRING) AS sku, CAST(l_suppkey AS STRING) AS ingredient_id
        FROM {lineitem}""",
    "dim_ingredient_price": """
        SELECT 'IPR-' || CAST(l_partkey AS STRING) || '-' || CAST(l_orderkey AS STRING) || '-'
               || CAST(l_linenumber AS STRING) || '-' || CAST(l_suppkey AS STRING) AS price_id,
               CAST(l_partkey AS STRING) AS ingredient_id,
               'Supplier ' || CAST(l_suppkey AS STRING) AS supplier_name,
               CAST(l_extendedprice / l_quantity AS DECIMAL(18,8)) AS price_inr,
               CASE l_linestatus WHEN 'O' THEN 'kg' ELSE 'L' END AS price_uom,
               CASE l_returnflag WHEN 'N' THEN NULL
                    ELSE CAST(0.9 AS DECIMAL(4,2)) + CAST(l_discount AS DECIMAL(4,2)) END AS density_g_per_ml,
               CAST(l_shipdate AS DATE) AS effective_from,
               CASE l_returnflag WHEN 'A' THEN NULL
                    ELSE CAST(l_shipdate AS DATE) + l_linenumber * 30 END AS effective_to,
               l_returnflag AS price_source
        FROM {lineitem}""",
    "dim_recipe": """
        SELECT 'RCP-' || CAST(o_orderkey AS STRING) || '-v' || CAST(o_orderkey % 3 + 1 AS STRING) AS recipe_id,
               CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey AS STRING) END AS sku,
               CASE WHEN o_orderstatus = 'P' THEN 'IDEA_' || CAST(o_orderkey AS STRING) END AS idea_id,
               'Recipe ' || CAST(o_orderkey AS STRING) AS recipe_name,
               CASE WHEN o_orderpriority <> '1-URGENT' THEN CAST(o_orderkey % 3 + 1 AS BIGINT) END AS version_no,
               CASE WHEN o_orderkey % 3 <> 0 THEN 'RCP-' || CAST(o_orderkey - 1 AS STRING) || '-v'
                    || CAST(o_orderkey % 3 AS STRING) END AS parent_recipe_id,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'Draft' WHEN '2-HIGH' THEN 'InTrial'
                    WHEN '3-MEDIUM' THEN 'Approved' WHEN '4-NOT SPECIFIED' THEN NULL
                    ELSE 'Retired' END AS status,
               o_orderstatus = 'F' AS is_current,
               CAST(100 AS DOUBLE) AS batch_size_g,
               CASE WHEN o_orderpriority <> '3-MEDIUM' THEN 2.5 END AS packaging_cost_inr,
               CAST(4.25 AS DOUBLE) AS labour_overhead_inr,
               CASE WHEN o_orderkey % 7 <> 0
                    THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.001 AS DECIMAL(4,3)) AS DOUBLE)
               END AS target_cogs_inr,
               CAST(NULL AS STRING) AS author, CAST(NULL AS STRING) AS notes,
               CAST(o_orderdate AS DATE) AS created_on
        FROM {orders}""",
    "map_recipe_ingredient": """
        SELECT 'RCPL-' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS recipe_line_id,
               'RCP-' || CAST(l_orderkey AS STRING) || '-v' || CAST(l_orderkey % 3 + 1 AS STRING) AS recipe_id,
               CAST(l_partkey AS STRING) AS ingredient_id,
               l_quantity AS qty_net_g, l_quantity AS qty_authored, 'g' AS uom,
               CAST(CAST(l_tax AS DECIMAL(4,2)) * 100 AS DOUBLE) AS loss_pct,
               CASE l_returnflag || l_linestatus WHEN 'AF' THEN 'Base' WHEN 'AO' THEN 'Fat'
                    WHEN 'NF' THEN 'Spice' WHEN 'NO' THEN 'Sweetener' WHEN 'RF' THEN 'Nut'
                    ELSE 'Binder' END AS role,
               CAST(l_linenumber AS BIGINT) AS line_seq,
               l_quantity < 3 AS is_optional
        FROM {lineitem}""",
    # ---- orders, stock, forecast ---------------------------------------------------------
    "business_analytics": """
        SELECT CAST(l.l_suppkey AS STRING) AS store_id, CAST(l.l_partkey AS STRING) AS sku_id,
               'item ' || CAST(l.l_partkey AS STRING) AS item_source_name,
               CASE o.o_orderstatus WHEN 'P' THEN 'Cancelled' WHEN 'F' THEN 'Completed'
                    ELSE 'Placed' END AS order_state,
               CAST(o.o_orderkey AS STRING) AS online_order_id,
               l.l_quantity AS quantity,
               CAST(l.l_extendedprice AS DECIMAL(18,2)) AS total,
               CAST(o.o_orderdate AS DATE) AS order_date
        FROM {lineitem} l JOIN {orders} o ON o.o_orderkey = l.l_orderkey""",
    "forecast_results": """
        SELECT CAST(l_partkey AS STRING) AS sku_id, CAST(l_suppkey AS STRING) AS master_store_id,
               CAST(l_shipdate AS DATE) AS forecast_date, l_quantity AS predicted_sales_quantity,
               CAST(l_linenumber AS BIGINT) AS days_ahead, l_linestatus = 'O' AS is_latest_forecast
        FROM {lineitem}""",
    "store_inventory_daily": """
        SELECT CAST(l_suppkey AS STRING) AS store_id, CAST(l_partkey AS STRING) AS product_sku,
               l_quantity AS available_quantity,
               CAST(l_shipdate AS DATE) + l_linenumber * 2 AS expiry_date,
               CAST(date_trunc('month', l_shipdate) AS DATE) AS snapshot_date,
               CAST(l_linenumber AS BIGINT) AS batch_row_number
        FROM {lineitem}""",
    "order_day_inventory": """
        SELECT CAST(l.l_suppkey AS STRING) AS store_id, CAST(l.l_partkey AS STRING) AS product_sku,
               l.l_quantity AS available_quantity,
               CAST(o.o_orderdate AS DATE) + l.l_linenumber AS expiry_date,
               CAST(o.o_orderdate AS DATE) AS snapshot_date,
               CAST(l.l_linenumber AS BIGINT) AS batch_row_number
        FROM {lineitem} l JOIN {orders} o ON o.o_orderkey = l.l_orderkey""",
    "flagged_inventory": """
        SELECT CAST(l_partkey AS STRING) AS sku_id, CAST(l_suppkey AS STRING) AS master_store_id,
               l_quantity AS total_stock, l_quantity - l_linenumber AS safe_stock,
               CASE WHEN l_returnflag = 'R' THEN CAST(l_linenumber AS DOUBLE) ELSE 0.0E0 END AS expired_stock,
               CASE WHEN l_returnflag = 'A' THEN CAST(l_linenumber AS DOUBLE) ELSE 0.0E0 END
                   AS qty_expiring_within_risk_days,
               CAST(l_shipdate AS DATE) + l_linenumber AS soonest_expiry,
               CAST(l_shipdate AS DATE) AS report_date,
               l_returnflag AS wastage_flag, l_quantity < 10 AS low_stock_flag,
               CAST(l_linenumber * 10 AS BIGINT) AS shelf_life_days
        FROM {lineitem}""",
    "low_stock_config": """
        SELECT CAST(l_partkey AS STRING) AS sku_id, CAST(l_suppkey AS STRING) AS store_id,
               CAST(max(l_quantity) AS BIGINT) AS min_count,
               CAST(min(l_linenumber) * 3 AS BIGINT) AS absolute_risk_count,
               CAST(max(l_linenumber) AS BIGINT) AS min_days_shelf_life
        FROM {lineitem} GROUP BY l_partkey, l_suppkey""",
    "store_transfer_distances": """
        SELECT a.s_suppkey AS from_store_id, b.s_suppkey AS to_store_id,
               abs(CAST(a.s_acctbal AS DECIMAL(18,2)) - CAST(b.s_acctbal AS DECIMAL(18,2))) AS distance_km,
               a.s_nationkey = b.s_nationkey AS preferred_for_transfer
        FROM (SELECT s_suppkey, s_acctbal, s_nationkey, s_suppkey + 1 AS other FROM {supplier}
              UNION ALL SELECT s_suppkey, s_acctbal, s_nationkey, s_suppkey + 2 FROM {supplier}
              UNION ALL SELECT s_suppkey, s_acctbal, s_nationkey, s_suppkey - 3 FROM {supplier}) a
        JOIN {supplier} b ON b.s_suppkey = a.other""",
    "master_store": """
        SELECT CAST(s_suppkey AS STRING) AS master_store_id, s_name AS store_name,
               CASE WHEN s_acctbal > 5000 THEN 'Dark' ELSE 'Retail' END AS type,
               CAST(s_nationkey AS STRING) AS city_id
        FROM {supplier}""",
    # ---- complaints, reviews --------------------------------------------------------------
    "customer_complaint_events": """
        SELECT CASE WHEN e.event_id % 10 <> 0 THEN 'e' || CAST(e.event_id AS STRING) END AS event_id,
               'm' || CAST(e.event_id AS STRING) AS email_message_id,
               CASE e.event_type WHEN 'error' THEN CASE WHEN e.value < 20 THEN 'Wrong item'
                                                        ELSE 'item missing' END
                    WHEN 'click' THEN CASE WHEN e.value < 20 THEN 'Late delivery' ELSE 'packaging spillage' END
                    WHEN 'view' THEN 'Quality issue' WHEN 'signup' THEN 'Taste and Freshness'
                    ELSE CASE WHEN e.value < 50 THEN 'Other' END END AS issue_type,
               ' ' || upper(p.display_name) || ' ' AS item_name,
               e.props AS customer_comments, 'email' AS source_system,
               CASE WHEN e.value < 100 THEN CAST(e.event_id AS STRING) END AS order_id,
               CAST(e.user_id AS STRING) AS master_store_id,
               e.ts - INTERVAL 8218 DAY AS complaint_received_at
        FROM {events} e LEFT JOIN {dim_product} p ON p.sku = CAST(e.user_id AS STRING)""",
    "customer_review_events": """
        SELECT CAST(d.doc_id AS STRING) AS review_id, d.text AS review_text,
               CAST(CASE WHEN l.toxic = 1 THEN 1 WHEN l.quality = 0 THEN 2 WHEN l.quality = 1 THEN 5
                    ELSE 3 END AS DOUBLE) AS star_rating,
               d.lang AS source_system, d.source AS customer_name,
               replace(d.source, 'src', '') AS master_store_id,
               DATE '2024-01-31' - CAST(d.n_chars % 150 AS INT) AS review_date
        FROM {documents} d LEFT JOIN {labels} l ON l.doc_id = d.doc_id""",
    # ---- marketing ---------------------------------------------------------------------------
    "raw_marketing_data": """
        SELECT CAST(l.l_suppkey AS STRING) AS res_id, 'CMP-' || CAST(l.l_partkey % 50 AS STRING) AS campaign_id,
               l.l_linestatus AS product_type, l.l_returnflag AS targeting,
               CASE l.l_returnflag WHEN 'A' THEN 'Young Professionals - Lunch'
                    WHEN 'N' THEN 'young professionals / lunch' ELSE 'Families' END
               || CASE WHEN l.l_linenumber > 4 THEN ' Weekend' ELSE '' END AS segments,
               CAST(o.o_orderdate AS DATE) AS date,
               CAST(o.o_orderdate AS DATE) - l.l_linenumber AS start_date,
               CAST(o.o_orderdate AS DATE) + l.l_linenumber * 10 AS end_date,
               CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * CAST(l.l_discount AS DECIMAL(4,2)) AS DECIMAL(22,4))
                   AS ad_spend_rs,
               CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * CAST(l.l_tax AS DECIMAL(4,2)) AS DECIMAL(22,4))
                   AS ad_sales_rs,
               CAST(l.l_quantity AS BIGINT) AS ad_orders,
               CAST(l.l_quantity * 1000 AS BIGINT) AS ad_impressions,
               CAST(l.l_quantity * l.l_linenumber AS BIGINT) AS ad_clicks,
               CASE WHEN l.l_discount > 0 THEN CAST(l.l_discount AS DECIMAL(4,2)) * 100 END AS ads_m2o_pct,
               CAST(l.l_tax AS DECIMAL(4,2)) * 100 AS overall_m2o_pct
        FROM {lineitem} l JOIN {orders} o ON o.o_orderkey = l.l_orderkey""",
    "store_channel_mapping": """
        SELECT CAST(s_suppkey AS STRING) AS master_store_id, s_suppkey AS zomato_id, s_suppkey + 1 AS swiggy_id
        FROM {supplier}""",
    "marketing_segment_master": """
        SELECT DISTINCT 'SEG-' || c_mktsegment || '-' || CASE WHEN c_acctbal > 5000 THEN '1'
                   WHEN c_acctbal > 1000 THEN '2' ELSE '3' END AS segment_id,
               c_mktsegment AS segment_code, lower(c_mktsegment) AS segment_name,
               CASE WHEN c_acctbal > 5000 THEN 'SWIGGY' WHEN c_acctbal > 1000 THEN 'ZOMATO'
                    ELSE 'PETPOOJA' END AS channel
        FROM {customer}""",
    "marketing_budget": """
        SELECT CAST(c_nationkey AS STRING) AS master_store_id,
               'Store ' || CAST(c_nationkey AS STRING) AS store_name,
               CASE WHEN c_acctbal > 8000 THEN 'petpooja' WHEN c_custkey % 2 = 0 THEN 'swiggy'
                    ELSE 'zomato' END AS channel,
               CAST(date_trunc('month', DATE '2001-06-15' + CAST(c_custkey % 3 * 31 AS INT)) AS DATE) AS budget_month,
               CAST(c_acctbal AS DECIMAL(18,2)) AS allocated_budget_rs,
               CAST(c_acctbal AS DECIMAL(18,2)) * 2 AS expected_revenue_rs,
               c_mktsegment AS segment_type
        FROM {customer}""",
    "calendar_events": """
        SELECT 'Event ' || CAST(o_orderkey AS STRING) AS title, CAST(o_orderdate AS DATE) AS event_date,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'Global' WHEN '2-HIGH' THEN 'National'
                    WHEN '3-MEDIUM' THEN 'Cultural' WHEN '5-LOW' THEN 'Regional' ELSE 'Religious' END AS event_type
        FROM {orders}""",
    # ---- compliance ---------------------------------------------------------------------------
    "approved_listing": """
        SELECT CAST(p_partkey AS STRING) AS sku, p_name AS title, p_brand AS brand,
               CASE WHEN p_size > 45 THEN NULL ELSE CAST(p_size AS STRING) END AS net_quantity,
               p_type AS claim
        FROM {part}""",
    "channel_listing": """
        SELECT CAST(l_partkey AS STRING) AS sku, 'CH-' || CAST(l_linenumber AS STRING) AS channel_id,
               CASE WHEN min(l_quantity) < 5 THEN NULL ELSE max(l_returnflag) END AS claim,
               'Brand#' || CAST(min(l_linenumber) AS STRING) AS brand,
               CAST(CAST(max(l_quantity) AS BIGINT) AS STRING) AS net_quantity
        FROM {lineitem} GROUP BY l_partkey, l_linenumber""",
    "supplier_certificate": """
        SELECT CAST(l_suppkey AS STRING) AS supplier_id, CAST(l_orderkey AS STRING) || '-'
               || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING) AS certificate_id,
               CAST(l_shipdate AS DATE) AS expires_on,
               CASE l_returnflag WHEN 'R' THEN 'Fail' ELSE 'Pass' END AS result
        FROM {lineitem}""",
    "store_checkin": """
        SELECT CAST(user_id AS STRING) AS master_store_id, CAST(ts - INTERVAL 8218 DAY AS DATE) AS checkin_date,
               'NATION_' || CAST(user_id % 25 AS STRING) AS address
        FROM {events}""",
    "store_register": """
        SELECT CAST(s_suppkey AS STRING) AS master_store_id,
               'NATION_' || CAST(s_nationkey AS STRING) AS licensed_address,
               DATE '2001-08-01' + CAST(floor(s_acctbal / 100) AS INT) AS licence_expires_on
        FROM {supplier}""",
    "regulatory_change": """
        SELECT 'REG-' || p_brand || '-' || p_type AS change_id,
               'Draft limit for ' || min(p_name) || ' sold as ' || lower(p_type) AS body
        FROM {part} GROUP BY p_brand, p_type""",
    "signal_catalog": """
        SELECT CAST(p_partkey AS STRING) AS signal_id, p_type AS category,
               CASE WHEN p_size > 25 THEN 'Signal' ELSE 'Event' END AS kind, p_brand AS owner,
               CASE WHEN p_size > 35 THEN 'Daily' WHEN p_size > 15 THEN 'Weekly' ELSE 'Monthly' END AS cadence,
               p_name || ' ' || lower(p_type) AS feeds_text,
               CASE WHEN p_size > 48 THEN '' ELSE p_name END AS entities_text
        FROM {part}""",
    "feed_output": """
        SELECT DISTINCT split_part(p_name, ' ', 1) AS feed_id, CAST(l_partkey AS STRING) AS signal_id
        FROM {lineitem} JOIN {part} ON p_partkey = l_partkey""",
}
