"""Graph, hierarchy, catalog, quality, compliance, streaming and spec queries."""

from pyspark.sql import functions as F

from tallyroom.constants import AS_OF_INVENTORY, AS_OF_SALES, OPS_BAR, OPS_RX, SPAN_DAYS, SPAN_MIN_REVIEWS
from tallyroom.functions import matches_any
from tallyroom.operators import gather as G
from tallyroom.plans import compliance, graph, ideas, inventory, quality, recipes
from tallyroom.registry.base import I, S, add, check_view
from tallyroom.registry.reads_writes import COLLECT_SPEC, COLLECT_SQL
from tallyroom.registry.relational import ROLLUP, ROLLUP_SQL
from tallyroom.registry.scalars import BUCKET
from tallyroom.session import scratch_dir
from tallyroom.sources.sinks import KeyedTable, written_once
from tallyroom.streaming import jobs

col = F.col

# ---- graph ---------------------------------------------------------------------------------
add("graph_nodes", lambda t: graph.graph_nodes(t).select(
    "entity_type", "id", F.size("properties").cast("bigint").alias("properties"),
    F.coalesce(F.element_at("properties", "product_name"), F.element_at("properties", "material_name"),
               F.element_at("properties", "type")).alias("label")), """
    SELECT 'Products' AS entity_type, sku AS id, 2::BIGINT AS properties, display_name AS label FROM facets
    UNION ALL SELECT 'Materials', ingredient_id, 2, ingredient_name FROM dim_ingredient
    UNION ALL SELECT 'Channel', channel_id, 1, channel_type FROM dim_channel
    UNION ALL SELECT 'Channel', master_store_id, 1, type FROM master_store""")
check_view("edge_rows", """
    SELECT 'requires_material' AS type, sku AS src, ingredient_id AS dst FROM members
    UNION ALL SELECT DISTINCT 'stocked_at', sku, channel_id FROM map_product_channel
    UNION ALL SELECT DISTINCT 'channel_located_in', master_store_id, city_id FROM master_store""")
add("graph_edges", graph.graph_edges, "SELECT * FROM edge_rows")
add("graph_cardinality_check", lambda t: graph.cardinality_violations(
    graph.graph_edges(t), ["channel_located_in", "stocked_at"]), """
    SELECT type, src, count(*) AS targets FROM edge_rows WHERE type IN ('channel_located_in', 'stocked_at')
    GROUP BY 1, 2 HAVING count(*) > 1""")
add("graph_dangling_check", lambda t: graph.dangling_edges(
    graph.load_edges(t.business_analytics, "sold_in", "sku_id", "store_id"),
    graph.load_nodes(t.master_store.where(col("type") == "Dark"), "Channel", "master_store_id", {"type": "type"})), """
    SELECT DISTINCT 'sold_in' AS type, sku_id AS src, store_id AS dst FROM business_analytics
    WHERE store_id NOT IN (SELECT master_store_id FROM master_store WHERE type = 'Dark')""")


def supply_paths(t):
    """Product -> store -> nation -> region, counted."""
    sold_in = t.lineitem.select(col("l_partkey").alias("src"), col("l_suppkey").alias("dst")).distinct()
    store_nation = t.supplier.select(col("s_suppkey").alias("src"), col("s_nationkey").cast("bigint").alias("dst"))
    nation_region = t.nation.select(col("n_nationkey").cast("bigint").alias("src"),
                                    col("n_regionkey").cast("bigint").alias("dst"))
    return graph.khop_paths(t.part.select(col("p_partkey").alias("id")), [sold_in, store_nation, nation_region])


add("graph_khop", supply_paths, """
    SELECT origin, CAST(n_regionkey AS BIGINT) AS node, count(*) AS paths
    FROM (SELECT DISTINCT l_partkey AS origin, l_suppkey FROM lineitem) JOIN supplier ON s_suppkey = l_suppkey
    JOIN nation ON n_nationkey = s_nationkey GROUP BY ALL""")


def vector_neighbors(t):
    """Ten nearest stored vectors of one probe per label (its smallest id)."""
    probes = t.embeddings.join(t.embeddings.groupBy("label").agg(F.min("vec_id").alias("vec_id")).select("vec_id"),
                               "vec_id", "left_semi")
    return graph.vector_neighbors(t.embeddings, probes, "vec_id", "embedding", 10)


add("vector_neighbors", vector_neighbors, """
    SELECT a.vec_id AS probe_id, b.vec_id AS neighbor_id,
           round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS similarity,
           row_number() OVER (PARTITION BY a.vec_id ORDER BY
             list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) DESC, b.vec_id) AS rank
    FROM embeddings a JOIN embeddings b ON b.vec_id <> a.vec_id
    WHERE a.vec_id IN (SELECT min(vec_id) FROM embeddings GROUP BY label) QUALIFY rank <= 10""")


def geography(t):
    """Region > nation > store as parent pointers."""
    return (t.region.select(F.concat(F.lit("R"), "r_regionkey").alias("id"), F.lit(None).cast("string").alias("parent"))
            .unionByName(t.nation.select(F.concat(F.lit("N"), "n_nationkey").alias("id"),
                                         F.concat(F.lit("R"), "n_regionkey").alias("parent")))
            .unionByName(t.supplier.select(F.concat(F.lit("S"), "s_suppkey").alias("id"),
                                           F.concat(F.lit("N"), "s_nationkey").alias("parent")))
            .unionByName(t.customer.select(F.concat(F.lit("C"), "c_custkey").alias("id"),
                                           F.concat(F.lit("N"), "c_nationkey").alias("parent"))))


add("hier_closure", lambda t: graph.ancestor_closure(geography(t), "id", "parent"), """
    WITH RECURSIVE geo AS (
      SELECT 'R' || r_regionkey AS id, NULL AS parent FROM region
      UNION ALL SELECT 'N' || n_nationkey, 'R' || n_regionkey FROM nation
      UNION ALL SELECT 'S' || s_suppkey, 'N' || s_nationkey FROM supplier
      UNION ALL SELECT 'C' || c_custkey, 'N' || c_nationkey FROM customer),
    up AS (SELECT id AS descendant, id AS ancestor, 0::BIGINT AS depth FROM geo
           UNION ALL SELECT u.descendant, g.parent, u.depth + 1 FROM up u JOIN geo g ON g.id = u.ancestor
           WHERE g.parent IS NOT NULL)
    SELECT * FROM up""")


def region_sales(t):
    per_store = t.business_analytics.groupBy("store_id").agg(F.sum("quantity").alias("q"), F.count("*").alias("n"))
    places = t.supplier.join(t.nation, col("s_nationkey") == col("n_nationkey")).join(
        t.region, col("n_regionkey") == col("r_regionkey")).select(
        col("s_suppkey").cast("string").alias("store_id"), "r_name", "n_name")
    return graph.hier_rollup(per_store.join(places, "store_id"), ["r_name", "n_name"],
                             [F.sum("q").alias("units"), F.sum("n").alias("rows")])


add("hier_rollup", region_sales, """
    SELECT r_name, n_name, CAST(grouping(r_name, n_name) AS BIGINT) AS level_id, sum(quantity) AS units, count(*) AS rows
    FROM business_analytics JOIN supplier ON CAST(s_suppkey AS VARCHAR) = store_id
    JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY ROLLUP (r_name, n_name)""")
add("vocab_check", lambda t: graph.vocab_check(t.dim_product, "status", graph.vocabulary(t.spark, "ProductStatus")), """
    SELECT status AS value, count(*) AS rows FROM dim_product
    WHERE status NOT IN ('Live', 'OccasionallyLive', 'UnderTrial', 'UnderDevelopment', 'Discontinued') GROUP BY 1""")
add("vocab_label_order", lambda t: graph.vocab_label_order(
    t.dim_idea.select("idea_id", "stage"), "stage", graph.vocabulary(t.spark, "IdeaStage")), """
    SELECT idea_id, stage, label, CAST(o AS BIGINT) AS sort_order FROM dim_idea LEFT JOIN (VALUES STAGE_ROWS)
      AS v(stage, label, o) USING (stage)""".replace("STAGE_ROWS", ", ".join(
    f"('{m}', '{label}', {i + 1})" for i, (m, label) in enumerate(graph.VOCABULARIES["IdeaStage"]))))
catalog = lambda t: t.signal_catalog.select(
    "signal_id", "category", "kind", "cadence", "owner", F.split("feeds_text", " ").alias("feeds"),
    F.filter(F.split("entities_text", " "), lambda x: x != "").alias("entities"))
add("catalog_explode", lambda t: graph.catalog_explode(
    catalog(t), "signal_id", {"feeds": "sourced_from", "entities": "concerns"}), """
    SELECT signal_id, 'sourced_from' AS relation, unnest(string_split(feeds_text, ' ')) AS value FROM signal_catalog
    UNION ALL SELECT signal_id, 'concerns', CASE WHEN entities_text = '' THEN NULL ELSE e END
    FROM (SELECT signal_id, entities_text, unnest(string_split(entities_text, ' ')) AS e FROM signal_catalog)""")
add("catalog_symmetry", lambda t: graph.catalog_symmetry(
    catalog(t).select("signal_id", F.explode("feeds").alias("feed_id")), t.feed_output, ["signal_id", "feed_id"]), """
    SELECT signal_id, feed_id, CASE WHEN l IS NULL THEN 'missing_in_left' ELSE 'missing_in_right' END AS mismatch FROM (
      SELECT DISTINCT signal_id, unnest(string_split(feeds_text, ' ')) AS feed_id, 1 AS l FROM signal_catalog)
    FULL JOIN (SELECT DISTINCT signal_id, feed_id, 1 AS r FROM feed_output) USING (signal_id, feed_id)
    WHERE l IS NULL OR r IS NULL""")
add("catalog_counts", lambda t: t.signal_catalog.groupBy("category", "kind").pivot(
    "cadence", ["Daily", "Weekly", "Monthly"]).count().fillna(0).withColumnsRenamed(
    {"Daily": "daily", "Weekly": "weekly", "Monthly": "monthly"}), """
    SELECT category, kind, count(*) FILTER (cadence = 'Daily') AS daily, count(*) FILTER (cadence = 'Weekly') AS weekly,
           count(*) FILTER (cadence = 'Monthly') AS monthly FROM signal_catalog GROUP BY 1, 2""")

# ---- data quality --------------------------------------------------------------------------------
add("dq_unique", lambda t: quality.dq_unique(t.map_recipe_ingredient, "recipe_line_id"),
    "SELECT recipe_line_id, count(*) AS rows FROM map_recipe_ingredient GROUP BY 1 HAVING count(*) > 1")
add("dq_resolves", lambda t: quality.dq_resolves(
    t.customer_complaint_events.where("master_store_id IS NOT NULL"), "master_store_id", t.master_store, "master_store_id"), """
    SELECT master_store_id AS k, count(*) AS rows FROM customer_complaint_events
    WHERE master_store_id NOT IN (SELECT master_store_id FROM master_store) GROUP BY 1""")
check_view("dq_bom", "SELECT sku FROM dim_product WHERE is_active AND sku NOT IN (SELECT sku FROM members)")
add("dq_bom_closed", quality.dq_bom_closed, "SELECT sku FROM dq_bom")
add("dq_result_pass", quality.dq_result_pass,
    "SELECT supplier_id, certificate_id FROM supplier_certificate WHERE NOT (result <> 'Fail')")
AFTER_SNAPSHOTS = AS_OF_INVENTORY.replace(month=11, day=2)  # when the newest batches come near their dates
A = f"DATE '{AFTER_SNAPSHOTS}'"
check_view("old_reports", f"""
    SELECT sku, max(lab_reported_on) AS reported_on, {A} - max(lab_reported_on) AS age_days
    FROM product_nutrition JOIN dim_product USING (sku) WHERE is_active GROUP BY 1
    HAVING {A} - max(lab_reported_on) > 365""")
add("dq_report_age", lambda t: quality.dq_report_age(t, AFTER_SNAPSHOTS), "SELECT * FROM old_reports")
check_view("transfer_rows", f"""
    SELECT store_id, product_sku, nearest_store_id, left_days AS days_after_transit FROM (
      SELECT q.store_id, q.product_sku, n.nearest_store_id,
             CAST(e - {A} - ceil(n.distance_km / 500.0) AS BIGINT) AS left_days
      FROM (SELECT s.store_id, s.product_sku, min(s.expiry_date) AS e FROM store_inventory_daily s
            JOIN (SELECT store_id, max(snapshot_date) AS d FROM store_inventory_daily GROUP BY 1) m
              ON m.store_id = s.store_id AND m.d = s.snapshot_date
            WHERE s.expiry_date >= {A} GROUP BY 1, 2) q
      JOIN nearest n USING (store_id)) WHERE left_days < 2""")
add("dq_transfer_viable", lambda t: quality.dq_transfer_viable(t, AFTER_SNAPSHOTS), "SELECT * FROM transfer_rows")
add("dq_report", lambda t: quality.dq_report(t, AFTER_SNAPSHOTS), f"""
    SELECT 'product_sku_unique' AS constraint_name, 'error' AS severity,
           (SELECT count(*) FROM (SELECT sku FROM dim_product GROUP BY 1 HAVING count(*) > 1)) AS violations
    UNION ALL SELECT 'live_sku_resolves', 'warning', (SELECT count(DISTINCT sku_id) FROM flagged_inventory
           WHERE upper(trim(sku_id)) NOT IN (SELECT upper(trim(sku)) FROM dim_product))
    UNION ALL SELECT 'bom_must_close', 'warning', (SELECT count(*) FROM dq_bom)
    UNION ALL SELECT 'quality_inspection_validity', 'error', (SELECT count(*) FROM supplier_certificate WHERE result = 'Fail')
    UNION ALL SELECT 'nutrition_report_current', 'info', (SELECT count(*) FROM old_reports)
    UNION ALL SELECT 'channel_transfer_viability', 'warning', (SELECT count(*) FROM transfer_rows)""")
add("dq_truncation_check", lambda t: quality.dq_truncation_check(
    recipes.v_recipe_workbench(t, AS_OF_INVENTORY), by=["id"]).groupBy("is_complete").agg(F.count("*").alias("rowsets")),
    "SELECT true AS is_complete, count(*) AS rowsets FROM dim_recipe")
add("dq_size_audit", lambda t: quality.dq_size_audit(
    ideas.v_triage_similarity_candidates(t, AS_OF_SALES), "src", 9000), """
    SELECT src, count(*) AS rows, CAST(sum(length('{"src":"","id":"","nm":"","d":""}') + length(src) + length(id)
           + length(nm) + length(d)) AS BIGINT) AS chars,
           sum(length('{"src":"","id":"","nm":"","d":""}') + length(src) + length(id) + length(nm) + length(d)) > 9000
             AS over_budget
    FROM triage_rows GROUP BY src""")

# ---- compliance -------------------------------------------------------------------------------------
add("price_gap", compliance.price_gap, """
    SELECT *, CASE WHEN abs(gap_pct) >= 15 THEN 'High' WHEN gap_pct IS NOT NULL THEN 'Medium' END AS risk,
           CASE WHEN abs(gap_pct) >= 15 THEN 'reprice' WHEN abs(gap_pct) >= 5 THEN 'review' ELSE 'hold' END AS move
    FROM (SELECT m.sku, m.competitor_product_id, CAST(p.mrp_inr AS DOUBLE) AS own_price,
                 CAST(c.price_inr AS DOUBLE) AS competitor_price,
                 round((CAST(p.mrp_inr AS DOUBLE) - CAST(c.price_inr AS DOUBLE)) / nullif(CAST(c.price_inr AS DOUBLE), 0) * 100, 1)
                   AS gap_pct
          FROM map_competitor_product m JOIN product_pricing p USING (sku)
          JOIN dim_competitor_product c USING (competitor_product_id) WHERE c.is_active)""")
add("claim_rules", compliance.claim_rules, """
    SELECT h.sku, h.highlight_text AS claim, r.rule, r.banned_tag, x.invalidated_by, x.ingredients
    FROM product_highlight h JOIN claim_words r ON regexp_matches(lower(h.highlight_text), r.rx)
    JOIN (SELECT m.sku, g.tag, min(i.ingredient_name) AS invalidated_by, count(*) AS ingredients FROM members m
          JOIN ingredient_tags g USING (ingredient_id) JOIN dim_ingredient i USING (ingredient_id) GROUP BY 1, 2) x
      ON x.sku = h.sku AND x.tag = r.banned_tag""")
check_view("claim_words", r"""
    SELECT * FROM (VALUES ('vegan', '\bvegan\b', 'DAIRY'), ('gluten_free', '\bgluten[ -]?free\b', 'GLUTEN'),
      ('nut_free', '\bnut[ -]?free\b', 'NUT'), ('soy_free', '\bsoy[ -]?free\b', 'SOY'),
      ('egg_free', '\begg[ -]?free\b|\beggless\b', 'EGG'),
      ('no_added_sugar', '\blow[ -]?sugar\b|\bsugar[ -]?free\b|\bno added sugar\b|\bdiabetic\b', 'WHOLE_SWEETENER'))
      AS c(rule, rx, banned_tag)""")
suppliers = lambda t: t.lineitem.select(
    col("l_partkey").cast("string").alias("sku"), col("l_suppkey").alias("supplier_id"))
add("regulation_impact", lambda t: compliance.regulation_impact(
    t.regulatory_change, "change_id", "body", t.dim_product, "sku", "description", suppliers(t)), """
    SELECT h.change_id, count(DISTINCT h.w) AS matched_words, count(DISTINCT v.sku) AS affected_skus,
           count(DISTINCT s.l_suppkey) AS affected_suppliers
    FROM change_words h JOIN sku_words v ON v.w = h.w
    LEFT JOIN (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) s ON CAST(s.l_partkey AS VARCHAR) = v.sku
    GROUP BY h.change_id""")
check_view("change_words", """
    SELECT DISTINCT change_id, w FROM (
      SELECT change_id, unnest(regexp_split_to_array(lower(body), '[^a-z]+')) AS w FROM regulatory_change)
    WHERE length(w) > 2""")
check_view("sku_words", """
    SELECT DISTINCT sku, w FROM (SELECT sku, unnest(regexp_split_to_array(lower(description), '[^a-z]+')) AS w
                                 FROM dim_product) WHERE length(w) > 2""")
cited = lambda t: t.product_highlight.join(
    t.map_competitor_product.where("match_confidence > 0.8").select("sku"), "sku", "left_semi")
add("exposure_overlap", lambda t: compliance.exposure_overlap(
    t.product_highlight.select("sku", "highlight_text"), cited(t), "highlight_text"), """
    SELECT sku, highlight_text FROM product_highlight WHERE highlight_text IN (
      SELECT highlight_text FROM product_highlight
      WHERE sku IN (SELECT sku FROM map_competitor_product WHERE match_confidence > 0.8))""")
add("listing_drift", compliance.listing_drift, """
    SELECT l.sku, l.field, l.channel_id, l.live_value, a.approved_value FROM (
      SELECT sku, channel_id, unnest(['brand', 'net_quantity', 'claim']) AS field,
             unnest([brand, net_quantity, claim]) AS live_value FROM channel_listing) l
    JOIN (SELECT sku, unnest(['brand', 'net_quantity', 'claim']) AS field,
                 unnest([brand, net_quantity, claim]) AS approved_value FROM approved_listing) a
      ON a.sku = l.sku AND a.field = l.field WHERE l.live_value IS DISTINCT FROM a.approved_value""")
add("declaration_matrix", compliance.declaration_matrix, """
    SELECT sku, field, v IS NULL OR trim(v) = '' AS missing FROM (
      SELECT sku, unnest(['display_name', 'size_label', 'serving_size', 'veg_nonveg', 'mrp_inr', 'shelf_life_days',
                          'gs1_barcode', 'org_labelling_compliance', 'total_cogs_inr']) AS field,
             unnest([display_name, size_label, serving_size, veg_nonveg, CAST(mrp_inr AS VARCHAR),
                     CAST(shelf_life_days AS VARCHAR), gs1_barcode, org_labelling_compliance,
                     CAST(total_cogs_inr AS VARCHAR)]) AS v
      FROM facets WHERE is_active)""")
add("expiry_within", lambda t: compliance.expiry_within(t.supplier_certificate, "expires_on", AS_OF_SALES).select("supplier_id", "certificate_id", "expires_on", "days_left", "status"), f"""
    SELECT supplier_id, certificate_id, expires_on, expires_on - {S} AS days_left,
           CASE WHEN expires_on < {S} THEN 'expired' ELSE 'expiring' END AS status
    FROM supplier_certificate WHERE expires_on <= {S} + 60""")
add("non_responders", lambda t: compliance.non_responders(t, AS_OF_SALES, days=4), f"""
    SELECT * FROM (
      SELECT r.*, c.checkin_date, c.address, CASE WHEN c.checkin_date IS NULL OR c.checkin_date < {S} - 4 THEN 'no_response'
             WHEN c.address <> r.licensed_address THEN 'address_changed' END AS issue
      FROM store_register r LEFT JOIN (SELECT * FROM store_checkin QUALIFY row_number() OVER (
        PARTITION BY master_store_id ORDER BY checkin_date DESC, address DESC) = 1) c USING (master_store_id))
    WHERE issue IS NOT NULL""")

# ---- streaming -------------------------------------------------------------------------------------------
STREAM_SQL = """
    SELECT CASE WHEN event_id % 10 <> 0 THEN 'e' || event_id ELSE 'm' || event_id END AS event_id,
           CAST(user_id AS VARCHAR) AS master_store_id,
           CASE event_type WHEN 'error' THEN 'Wrong item' WHEN 'click' THEN 'Late delivery'
                ELSE upper(event_type[1]) || event_type[2:] END AS issue_type, value, ts FROM events"""
check_view("streamed", STREAM_SQL)
stream = lambda t: jobs.complaint_stream(jobs.file_stream(t.spark, t.folder, "events"))


def slide(width: int, step: int) -> str:
    """Window starts of each event: multiples of ``step`` days since 1970-01-01
    whose window of ``width`` days holds it."""
    return f"""
    SELECT *, CAST(w AS DATE) AS window_start FROM (
      SELECT s.*, unnest(generate_series(
          DATE '1970-01-01' + CAST({step} * ((CAST(ts AS DATE) - DATE '1970-01-01') // {step}) AS INT)
            - {step} * {width // step - 1},
          DATE '1970-01-01' + CAST({step} * ((CAST(ts AS DATE) - DATE '1970-01-01') // {step}) AS INT),
          INTERVAL {step} DAY)) AS w FROM streamed s)"""


add("st_tumbling_daily", lambda t: jobs.run_to_table(
    t.spark, jobs.tumbling_daily(stream(t)), "daily", ["master_store_id", "day"]), """
    SELECT master_store_id, CAST(ts AS DATE) AS day, count(*) AS complaints,
           count(*) FILTER (issue_type IN ('Wrong item', 'Late delivery')) AS ops_complaints FROM streamed GROUP BY 1, 2""")
def daily_themes(t):
    return jobs.run_to_table(t.spark, jobs.daily_by_theme(stream(t)), "themes", ["master_store_id", "issue_type", "day"])


add("st_sliding_14d", lambda t: jobs.day_windows(
    daily_themes(t), ["master_store_id", "issue_type"], "hits", SPAN_DAYS + 1, 1).withColumn(
    "alert", col("hits") >= SPAN_MIN_REVIEWS), f"""
    SELECT master_store_id, issue_type, window_start, count(*) AS hits, count(*) >= 3 AS alert
    FROM ({slide(15, 1)}) GROUP BY 1, 2, 3""")
add("st_trailing_60d", lambda t: jobs.day_windows(
    daily_themes(t).where(matches_any("issue_type", OPS_RX)).withColumnRenamed("hits", "ops_complaints"),
    ["master_store_id"], "ops_complaints", 60, 10).withColumn("over_bar", col("ops_complaints") >= OPS_BAR), f"""
    SELECT master_store_id, window_start, count(*) AS ops_complaints, count(*) >= 3 AS over_bar
    FROM ({slide(60, 10)}) WHERE issue_type IN ('Wrong item', 'Late delivery') GROUP BY 1, 2""")


def st_dedup(t):
    """The event files read twice over arrive once."""
    doubled = stream(t).unionByName(stream(t))
    return jobs.run_to_table(t.spark, jobs.deduplicated(doubled), "dedup", ["event_id"], mode="append").select(
        "event_id", "master_store_id", "issue_type", "value")


add("st_dedup", st_dedup, "SELECT event_id, master_store_id, issue_type, value FROM streamed")


def st_latest_state(t):
    """Newest stock per store and SKU, kept up to date from the stock stream."""
    source = jobs.file_stream(t.spark, t.folder, "lineitem").select(
        col("l_suppkey").alias("store_id"), col("l_partkey").alias("sku_id"),
        col("l_shipdate").cast("date").alias("report_date"), col("l_quantity").alias("total_stock"))
    table = KeyedTable(t.spark, scratch_dir(t.spark, "state"), ["store_id", "sku_id"],
                       newer=["report_date", "total_stock"])
    jobs.latest_state(source, table, scratch_dir(t.spark, "state-checkpoint"))
    return table.read()


add("st_latest_state", st_latest_state, """
    SELECT l_suppkey AS store_id, l_partkey AS sku_id, CAST(l_shipdate AS DATE) AS report_date, l_quantity AS total_stock
    FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_suppkey, l_partkey
                                             ORDER BY CAST(l_shipdate AS DATE) DESC, l_quantity DESC) = 1""")


def st_threshold_join(t):
    """Stock rows at or under their threshold, as events."""
    source = jobs.file_stream(t.spark, t.folder, "lineitem").select(
        col("l_suppkey").cast("string").alias("store_id"), col("l_partkey").cast("string").alias("sku_id"),
        col("l_orderkey").alias("order_key"), col("l_linenumber").alias("line"), col("l_quantity").alias("total_stock"))
    limits = t.low_stock_config.select("store_id", "sku_id", "min_count", "absolute_risk_count")
    low = source.join(limits, ["store_id", "sku_id"], "left").where(
        col("total_stock") <= col("absolute_risk_count")).select("store_id", "sku_id", "total_stock", "min_count")
    out = scratch_dir(t.spark, "low-stock")

    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    jobs.run_available(low, write, scratch_dir(t.spark, "low-stock-checkpoint"), mode="append")
    return t.spark.read.parquet(out).drop("batch")


add("st_threshold_join", st_threshold_join, """
    SELECT f.master_store_id AS store_id, f.sku_id, f.total_stock, c.min_count FROM flagged_inventory f
    JOIN low_stock_config c ON c.store_id = f.master_store_id AND c.sku_id = f.sku_id
    WHERE f.total_stock <= c.absolute_risk_count""")


def st_sweep(t):
    """The expiry-risk pipeline run from the stock stream: each batch re-evaluates the
    stores that it brings stock rows for, and replaces those stores' risks."""
    out = KeyedTable(t.spark, scratch_dir(t.spark, "sweep"), ["store_id"])
    trigger = jobs.file_stream(t.spark, t.folder, "lineitem").select(col("l_suppkey").cast("string").alias("store_id"))

    def write(batch, batch_id):
        stores = written_once(batch.select("store_id").distinct(), "sweep-stores")
        out.replace_groups(inventory.p_shelf_life_risk(t, AS_OF_INVENTORY, stores).select(
            "store_id", "product_sku", "total_available", "risk_type"), stores, batch_id)

    jobs.run_available(trigger, write, scratch_dir(t.spark, "sweep-checkpoint"), mode="append")
    return out.read()


add("st_sweep", st_sweep, f"""
    SELECT store_id, product_sku, total_available, CASE WHEN left_days <= min_days_shelf_life AND total_available <= min_count
             THEN 'both' WHEN left_days <= min_days_shelf_life THEN 'wastage'
             WHEN total_available <= absolute_risk_count THEN 'critical_low' ELSE 'low_stock' END AS risk_type
    FROM (SELECT store_id, product_sku, sum(available_quantity) AS total_available, min(expiry_date) - {I} AS left_days
          FROM newest_stock WHERE expiry_date >= {I} GROUP BY 1, 2) q
    JOIN low_stock_config c USING (store_id)
    WHERE c.sku_id = q.product_sku AND (left_days <= min_days_shelf_life OR total_available <= absolute_risk_count
                                        OR total_available <= min_count)""")


def st_late_data(t):
    """Counts of a stream whose last part brings events that happened long before those of the
    first ones: the ones behind the watermark are dropped, the rest are stored. What was dropped is read
    from the run's progress, what was kept from the table."""
    turn = F.coalesce(col("event_id") % 10, F.lit(1))
    parts = [t.events.where(part) for part in (turn.between(1, 5), turn > 5, turn == 0)]
    table = KeyedTable(t.spark, scratch_dir(t.spark, "late"), ["master_store_id", "day", "event_id"])
    dropped = jobs.run_parts(t.spark, parts, lambda source: jobs.daily_by_event(jobs.complaint_stream(source)), table, "late")
    return table.read().agg(F.sum("events").alias("kept")).withColumn(
        "dropped", dropped.agg(F.coalesce(F.sum("dropped"), F.lit(0))).scalar())


# late rows are judged by the watermark of the batch before the last: the first file's newest time
# less two days; a day that ends by then is closed
add("st_late_data", st_late_data, """
    SELECT count(*) FILTER (open) AS kept, count(*) FILTER (NOT open) AS dropped FROM (
      SELECT event_id % 10 <> 0 OR date_trunc('day', ts) + INTERVAL 1 DAY
             > (SELECT max(ts) - INTERVAL 2 DAY FROM events WHERE event_id % 10 BETWEEN 1 AND 5) AS open FROM events)""")

# ---- declarative specs ----------------------------------------------------------------------------------------
add("udf_dsl_compute", lambda t: G.compute(t.flagged_inventory, [
    {"as": "days_left", "days_until": "soonest_expiry"}, {"as": "whole", "ceil": "total_stock"},
    {"as": "gap", "sub": ["total_stock", "expired_stock"]}, BUCKET], AS_OF_INVENTORY).select(
    "sku_id", "master_store_id", "days_left", "whole", "gap", "band"), f"""
    SELECT sku_id, master_store_id, soonest_expiry - {I} AS days_left, CAST(ceil(total_stock) AS BIGINT) AS whole,
           total_stock - expired_stock AS gap, CASE WHEN total_stock < 10 THEN 'low'
           WHEN total_stock < shelf_life_days THEN wastage_flag ELSE 'ok' END AS band FROM flagged_inventory""")
add("udf_dsl_agg", lambda t: G.rollup(t.store_inventory_daily, ROLLUP, AS_OF_INVENTORY), ROLLUP_SQL)
add("udf_dsl_pipeline", lambda t: G.gather(t, COLLECT_SPEC, AS_OF_INVENTORY), COLLECT_SQL)
add("udtf_unnest", lambda t: recipes.verdict_rows(recipes.v_recipe_cogs(t, AS_OF_INVENTORY)).select(
    "recipe_id", "rule", "verdict"), "SELECT recipe_id, rule, verdict FROM verdicts")
