"""Scans, declarative reads and table writes."""

from pyspark.sql import functions as F

from tallyroom.constants import AS_OF_INVENTORY, AS_OF_SALES
from tallyroom.operators import gather as G
from tallyroom.operators.sets import union_rows
from tallyroom.plans import graph, inventory, products, recipes
from tallyroom.registry.base import I, add
from tallyroom.session import scratch_dir
from tallyroom.sources import readers, sinks

add("scan_table", lambda t: t.part.select("p_partkey", "p_name", "p_size"),
    "SELECT p_partkey, p_name, p_size FROM part")
add("scan_view", lambda t: products.v_product_line_capability(t).groupBy("category_name").agg(
    F.sum("active_skus").alias("active_skus"), F.min("min_cogs_inr").alias("min_cogs_inr")),
    "SELECT category_name, CAST(sum(active_skus) AS BIGINT) AS active_skus, min(min_cogs_inr) AS min_cogs_inr "
    "FROM capability GROUP BY category_name")


def scan_cross_layer(t):
    """Master, order and forecast layers in one query, each reduced to one row
    per SKU first."""
    sales = inventory.sold(t).groupBy(F.col("sku_id").alias("sku")).agg(F.sum("quantity").alias("sold_units"))
    ahead = (t.forecast_results.where("is_latest_forecast").groupBy(F.col("sku_id").alias("sku"))
             .agg(F.sum("predicted_sales_quantity").alias("forecast_units")))
    return t.dim_product.select("sku", "display_name").join(sales, "sku", "left").join(ahead, "sku", "left")


add("scan_cross_layer", scan_cross_layer, """
    SELECT p.sku, p.display_name, s.sold_units, f.forecast_units FROM dim_product p
    LEFT JOIN (SELECT sku_id, sum(quantity) AS sold_units FROM business_analytics
               WHERE order_state <> 'Cancelled' GROUP BY 1) s ON s.sku_id = p.sku
    LEFT JOIN (SELECT sku_id, sum(predicted_sales_quantity) AS forecast_units FROM forecast_results
               WHERE is_latest_forecast GROUP BY 1) f ON f.sku_id = p.sku""")
add("source_literal", lambda t: t.dim_idea.where("stage IS NOT NULL").join(
    readers.literal_table(t.spark, [("Capture", 1), ("Triage", 2), ("Feasibility", 3)],
                          "stage string, stage_no bigint"), "stage").groupBy("stage", "stage_no").agg(
    F.count("*").alias("ideas")),
    """SELECT stage, CAST(stage_no AS BIGINT) AS stage_no, count(*) AS ideas
       FROM dim_idea JOIN (VALUES ('Capture', 1), ('Triage', 2), ('Feasibility', 3)) v(stage, stage_no) USING (stage)
       GROUP BY ALL""")
add("source_const_row", lambda t: union_rows(
    t.dim_idea.select(F.lit("1_IDEA").alias("src"), F.col("idea_id").alias("id")),
    t.spark.range(1).select(F.lit("9_END").alias("src"), F.lit("END_OF_CANDIDATES").alias("id"))),
    "SELECT '1_IDEA' AS src, idea_id AS id FROM dim_idea UNION ALL SELECT '9_END', 'END_OF_CANDIDATES'")

dark_stores = lambda t: t.master_store.where(F.col("type") == "Dark")
add("read_entity_link", lambda t: readers.read_entity_link(
    t.flagged_inventory, "master_store_id", dark_stores(t), "master_store_id",
    ["master_store_id", "sku_id", "total_stock", "report_date"]),
    """SELECT master_store_id, sku_id, total_stock, report_date FROM flagged_inventory
       WHERE master_store_id IN (SELECT master_store_id FROM master_store WHERE type = 'Dark')""")
add("read_entity_link_str", lambda t: readers.read_entity_link(
    t.forecast_results, "sku_id", t.dim_product.where(F.col("status") == "Live"), "sku",
    ["sku_id", "master_store_id", "forecast_date", "predicted_sales_quantity"]),
    """SELECT sku_id, master_store_id, forecast_date, predicted_sales_quantity FROM forecast_results
       WHERE sku_id IN (SELECT sku FROM dim_product WHERE status = 'Live')""")
add("read_search", lambda t: readers.read_search(t.dim_idea, ["idea_id", "name", "stage"], ["idea_id"], limit=300),
    "SELECT idea_id, name, stage FROM dim_idea ORDER BY idea_id LIMIT 300")
add("read_filtered", lambda t: readers.read_filtered(
    t.dim_recipe, ["recipe_id", "status", "version_no"],
    {"combinator": "AND", "conditions": [{"column": "status", "op": "in", "value": ["Draft", "InTrial"]},
                                         {"column": "version_no", "op": "gte", "value": 2}]}),
    """SELECT recipe_id, status, version_no FROM dim_recipe
       WHERE status IN ('Draft', 'InTrial') AND version_no >= 2""")

STOCK_SPEC = {
    "base": {"dataset": "store_inventory_daily",
             "columns": ["store_id", "product_sku", "available_quantity", "expiry_date", "snapshot_date",
                         "batch_row_number"]},
}
add("read_gather_base", lambda t: G.gather(t, STOCK_SPEC, AS_OF_INVENTORY),
    """SELECT store_id, product_sku, available_quantity, expiry_date, snapshot_date, batch_row_number
       FROM store_inventory_daily""")

COLLECT_SPEC = {
    "collect": [
        {"as": "forecast", "dataset": "forecast_results",
         "columns": ["sku_id", "master_store_id", "forecast_date", "predicted_sales_quantity", "is_latest_forecast"],
         "reduce": {
             "rename": {"sku_id": "product_sku", "master_store_id": "store_id"},
             "rollup": {"group_by": ["store_id", "product_sku"],
                        "filter_rows": {"compute": [{"as": "days_out", "days_until": "forecast_date"}],
                                        "where": [{"field": "is_latest_forecast", "op": "eq", "value": True},
                                                  {"field": "days_out", "op": "gte", "value": 1},
                                                  {"field": "days_out", "op": "lte", "value": 30}]},
                        "agg": [{"as": "forecast", "op": "sum", "col": "predicted_sales_quantity"}]}}},
        {"as": "stock", "dataset": "store_inventory_daily",
         "columns": ["store_id", "product_sku", "available_quantity", "snapshot_date", "batch_row_number"],
         "reduce": {
             "latest_snapshot": {"by": ["store_id"], "on": "snapshot_date"},
             "rollup": {"group_by": ["store_id", "product_sku"],
                        "agg": [{"as": "on_hand", "op": "sum", "col": "available_quantity"},
                                {"as": "batches", "op": "count", "col": "batch_row_number"}]}}},
    ],
    "join": [{"left": "forecast", "right": "stock", "on": ["store_id", "product_sku"], "how": "outer"}],
    "post": {"fillna": {"forecast": 0, "on_hand": 0, "batches": 0},
             "compute": [{"as": "action", "bucket": [
                 {"when": {"field": "on_hand", "op": "lt", "ref": "forecast"}, "value": "supply"},
                 {"when": {"field": "forecast", "op": "eq", "value": 0}, "value": "idle"},
                 {"else": "hold"}]}]},
}
COLLECT_SQL = f"""
    SELECT store_id, product_sku, coalesce(forecast, 0) AS forecast, coalesce(on_hand, 0) AS on_hand,
           coalesce(batches, 0) AS batches,
           CASE WHEN coalesce(on_hand, 0) < coalesce(forecast, 0) THEN 'supply'
                WHEN coalesce(forecast, 0) = 0 THEN 'idle' ELSE 'hold' END AS action
    FROM (SELECT master_store_id AS store_id, sku_id AS product_sku, sum(predicted_sales_quantity) AS forecast
          FROM forecast_results WHERE is_latest_forecast AND forecast_date - {I} BETWEEN 1 AND 30 GROUP BY ALL) f
    FULL JOIN (SELECT store_id, product_sku, sum(available_quantity) AS on_hand, count(batch_row_number) AS batches
               FROM newest_stock GROUP BY ALL) s USING (store_id, product_sku)"""
add("read_gather_collect", lambda t: G.gather(t, COLLECT_SPEC, AS_OF_INVENTORY), COLLECT_SQL)
add("read_param_sql", lambda t: readers.read_param_sql(
    t.spark, "SELECT store_id, sku_id, sum(quantity) AS quantity FROM {lines} "
             "WHERE order_state <> :skip AND order_date >= :since GROUP BY store_id, sku_id",
    {"skip": "Cancelled", "since": AS_OF_SALES.replace(month=7)}, lines=t.business_analytics),
    """SELECT store_id, sku_id, sum(quantity) AS quantity FROM business_analytics
       WHERE order_state <> 'Cancelled' AND order_date >= DATE '2001-07-01' GROUP BY ALL""")
add("read_catalog", lambda t: graph.vocab_label_order(
    t.dim_product.select("sku", "status"), "status", graph.vocabulary(t.spark, "ProductStatus")).groupBy(
    "status", "label", "sort_order").agg(F.count("*").alias("skus")),
    """SELECT status, label, CAST(sort_order AS BIGINT) AS sort_order, count(*) AS skus FROM dim_product
       LEFT JOIN (VALUES ('Live', 1, 'Live'), ('OccasionallyLive', 2, 'Occasionally Live'),
                  ('UnderTrial', 3, 'Under Trial'), ('UnderDevelopment', 4, 'Under Development'),
                  ('Discontinued', 5, 'Discontinued')) v(status, sort_order, label) USING (status) GROUP BY ALL""")

prop = lambda name: F.element_at("properties", name)
add("load_nodes", lambda t: graph.load_nodes(
    t.dim_ingredient, "Materials", "ingredient_id",
    {"material_name": "ingredient_name", "material_type": "category"}).select(
    "entity_type", "id", prop("material_name").alias("material_name"), prop("material_type").alias("material_type")),
    """SELECT 'Materials' AS entity_type, ingredient_id AS id, min(ingredient_name) AS material_name,
              min(category) AS material_type FROM dim_ingredient GROUP BY ingredient_id""")
add("load_nodes_multi", lambda t: graph.channel_nodes(t).select("entity_type", "id", prop("type").alias("type")),
    """SELECT 'Channel' AS entity_type, channel_id AS id, channel_type AS type FROM dim_channel
       UNION ALL SELECT 'Channel', master_store_id, type FROM master_store""")
add("load_edges", lambda t: graph.load_edges(t.map_product_channel, "stocked_at", "sku", "channel_id"),
    "SELECT DISTINCT 'stocked_at' AS type, sku AS src, channel_id AS dst FROM map_product_channel")


# ---- writes --------------------------------------------------------------------------

def table(t, label):
    return sinks.VersionedTable(t.spark, scratch_dir(t.spark, label))


def keyed(t, label, key):
    return sinks.KeyedTable(t.spark, scratch_dir(t.spark, label), key)


def ddl_replace(t):
    competitors = table(t, "competitor")
    competitors.replace(t.dim_competitor)
    return competitors.replace(t.dim_competitor.where("is_active"))


add("ddl_replace", ddl_replace, "SELECT * FROM dim_competitor WHERE is_active")


def ddl_if_absent(t):
    competitors = table(t, "competitor")
    competitors.create_if_absent(t.dim_competitor)
    return competitors.create_if_absent(t.dim_competitor.where(F.lit(False)))


add("ddl_if_absent", ddl_if_absent, "SELECT * FROM dim_competitor")


def recipe_updates(t):
    """Recipes of the newest orders: a new status, no note, and new recipes."""
    changed = t.dim_recipe.where(F.col("created_on") >= F.lit(AS_OF_SALES.replace(month=1)))
    return union_rows(
        changed.select("recipe_id", F.lit("Approved").alias("status"), F.lit(None).cast("double").alias("batch_size_g")),
        changed.select(F.concat("recipe_id", F.lit("-new")).alias("recipe_id"), F.lit("Draft").alias("status"),
                       F.lit(50.0).alias("batch_size_g")))


def sink_upsert(t):
    stored = keyed(t, "recipe", ["recipe_id"])
    stored.upsert(t.dim_recipe.select("recipe_id", "recipe_name", "status", "batch_size_g"))
    return stored.upsert(recipe_updates(t))


add("sink_upsert", sink_upsert, """
    SELECT recipe_id, recipe_name, CASE WHEN created_on >= DATE '2001-01-01' THEN 'Approved' ELSE status END AS status,
           batch_size_g FROM dim_recipe
    UNION ALL SELECT recipe_id || '-new', NULL, 'Draft', 50.0::DOUBLE FROM dim_recipe
    WHERE created_on >= DATE '2001-01-01'""")


def sink_upsert_keygen(t):
    """Briefs from stalled ideas, written under generated ids."""
    ideas = keyed(t, "idea", ["idea_id"])
    ideas.upsert(t.dim_idea.select("idea_id", "name", "stage"))
    fresh = t.dim_idea.where(F.col("stage").isNull()).select("name").distinct().select(
        F.lit("").alias("idea_id"), F.concat(F.lit("Reformulation: "), "name").alias("name"),
        F.lit("Triage").alias("stage"))
    return ideas.upsert(sinks.with_keys(fresh, "idea_id", "IDEA_", ["name"]))


add("sink_upsert_keygen", sink_upsert_keygen, """
    SELECT idea_id, name, stage FROM dim_idea
    UNION ALL SELECT 'IDEA_' || upper(sha256(nm)), nm, 'Triage'
    FROM (SELECT DISTINCT 'Reformulation: ' || name AS nm FROM dim_idea WHERE stage IS NULL)""")


def sink_stage_advance(t):
    """Approve every idea with a target cost; only earlier stages move."""
    ideas = table(t, "stage")
    approved = t.dim_idea.where(F.col("target_cogs_inr").isNotNull())
    return ideas.replace(sinks.stage_advance(t.dim_idea.select("idea_id", "stage"), approved))


add("sink_stage_advance", sink_stage_advance, """
    SELECT idea_id, CASE WHEN target_cogs_inr IS NOT NULL AND stage IN ('Capture', 'Triage', 'Feasibility')
                         THEN 'Pipeline' ELSE stage END AS stage FROM dim_idea""")
add("sink_report_table", lambda t: sinks.report_table(
    inventory.v_stocked_at(t), ["master_store_id", "sku_id", "total_stock", "soonest_expiry"],
    ["master_store_id", "sku_id"], scratch_dir(t.spark, "report")),
    "SELECT master_store_id, sku_id, total_stock, soonest_expiry FROM stocked")


def edits(t):
    """Review edits derived from the order lines, one per line."""
    line = t.lineitem
    kind = F.when(F.col("l_returnflag") == "A", "SET").when(F.col("l_returnflag") == "R", "SCALE").when(
        F.col("l_linestatus") == "F", "ZERO").otherwise("ADD")
    return line.select(
        F.concat(F.lit("RCP-"), F.col("l_orderkey").cast("string"), F.lit("-v"),
                 (F.col("l_orderkey") % 3 + 1).cast("string")).alias("recipe_id"),
        (F.col("l_linenumber") * 100 + F.col("l_quantity")).cast("bigint").alias("round_no"), kind.alias("kind"),
        F.when(kind == "ADD", F.col("l_suppkey")).otherwise(F.col("l_partkey")).cast("string").alias("ingredient_id"),
        F.when(kind == "SCALE", 0.85).when(kind == "ZERO", 0.0).otherwise(F.col("l_quantity") - 20).alias("amount"),
        (F.col("l_discount") > 0.085).alias("withdrawn"))


def sink_bom_lines(t):
    """Fork the edited recipes: parents first, then their lines."""
    headers, lines = recipes.recipe_fork(t, edits(t))
    heads = keyed(t, "fork-head", ["recipe_id"])
    heads.upsert(t.dim_recipe.select(*headers.columns))
    heads.upsert(headers)
    bom = keyed(t, "fork-line", ["recipe_line_id"])
    bom.upsert(lines)
    return bom.read().join(heads.read().select("recipe_id", "parent_recipe_id", "status"), "recipe_id")


add("sink_bom_lines", sink_bom_lines, """
    SELECT 'RCPL-' || f.new_id || '-' || l.ingredient_id AS recipe_line_id, f.new_id AS recipe_id, l.ingredient_id,
           l.qty_net_g, l.loss_pct, f.recipe_id AS parent_recipe_id, 'InTrial' AS status
    FROM replayed_lines l JOIN forked_heads f USING (recipe_id)
    QUALIFY row_number() OVER (PARTITION BY f.new_id, l.ingredient_id ORDER BY l.qty_net_g DESC NULLS LAST, l.loss_pct DESC NULLS LAST) = 1""")
