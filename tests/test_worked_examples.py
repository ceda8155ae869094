"""Small literal rows for the rules whose edges matter."""

from datetime import date

from pyspark.sql import functions as F

from tallyroom import functions as fn
from tallyroom.operators import gather as G
from tallyroom.operators.ranking import best_span, commonest, share_of_total
from tallyroom.operators.snapshots import in_force_row, latest_global, latest_row, latest_snapshot
from tallyroom.plans import complaints, ideas, marketing, products, recipes
from tallyroom.sources.tables import GivenTables

DAY = date(2026, 6, 1)


def rows(df, *cols):
    return sorted([tuple(r) for r in df.select(*cols).collect()], key=str)


def test_best_span_of_the_documented_days(spark):
    df = spark.createDataFrame([("p", n) for n in (196, 204, 212, 220)], "k string, n bigint")
    got = best_span(df, ["k"], "n", 14).collect()[0]
    assert (got.window_first, got.window_last, got.hits) == (196, 204, 2)


def test_positional_pack_of_a_scored_brief(spark):
    df = spark.createDataFrame([("i", "Feasibility", 134, "INSIDE")], "idea_id string, stage string, days_in_stage bigint, cogs_fit string")
    r = ideas.score_briefs(df).select(fn.pack("|", "stage", "days_in_stage", fn.score_text("cogs_score"),
                                              fn.score_text("time_score"), fn.score_text("brief_subtotal"), "unknowns"))
    assert r.collect()[0][0] == "Feasibility|134|5|5|30|none"


def test_missing_input_is_neutral_and_listed(spark):
    df = spark.createDataFrame([("i", None, "UNKNOWN")], "idea_id string, days_in_stage bigint, cogs_fit string")
    r = ideas.score_briefs(df).collect()[0]
    assert (r.cogs_score, r.time_score, r.unknowns) == (2.5, 2.5, "cogs_vs_target,time_in_stage")


def test_time_ladder_edges(spark):
    days = [14, 15, 30, 31, 45, 46, 60, 61, 89, 90]
    df = spark.createDataFrame([(d, "INSIDE") for d in days], "days_in_stage bigint, cogs_fit string")
    got = [r.time_score for r in ideas.score_briefs(df).orderBy("days_in_stage").collect()]
    assert got == [0, 1, 1, 2, 2, 3, 3, 4, 4, 5]


def test_category_without_skus_scores_a_real_zero(spark):
    df = spark.createDataFrame([("c", None, None, None, None, None, None, None, None)],
                               "category_name string, units_90d double, growth_pct double, skus_with_label_compliance bigint,"
                               "skus_with_barcode bigint, skus_with_declared_allergens bigint, active_skus_in_category bigint,"
                               "channels_listed bigint, channels_mapped bigint")
    r = ideas.score_categories(df).collect()[0]
    assert (r.market_signal, r.compliance_readiness, r.channel_fit, r.cat_subtotal) == (0, 0, 0, 0)


def test_growth_without_a_baseline_is_null(spark):
    lines = spark.createDataFrame([("a", "Placed", 5.0, 1.0, date(2026, 5, 20)), ("a", "Cancelled", 9.0, 1.0, date(2026, 1, 20))],
                                  "sku_id string, order_state string, quantity double, total double, order_date date")
    cats = spark.createDataFrame([("a", "c")], "sku string, category_name string")
    r = products.trailing_vs_prior(lines, cats, DAY).collect()[0]
    assert (r.units_90d, r.units_prior_90d, r.growth_pct) == (5.0, None, None)


def test_validity_is_half_open_and_never_fans_out(spark):
    prices = spark.createDataFrame(
        [("a", "p1", date(2026, 1, 1), None), ("a", "p2", date(2026, 3, 1), None), ("b", "p3", date(2026, 1, 1), DAY),
         ("c", "p4", DAY, None), ("d", "p5", date(2026, 6, 2), None)],
        "ingredient_id string, price_id string, effective_from date, effective_to date")
    got = in_force_row(prices, ["ingredient_id"], "effective_from", "effective_to", DAY, ["price_id"])
    assert rows(got, "ingredient_id", "price_id") == [("a", "p2"), ("c", "p4")]


def recipe_tables(spark, **over):
    tables = dict(
        dim_ingredient=spark.createDataFrame([("i1", "Milk"), ("i2", "Oats"), ("i3", "Rye")], "ingredient_id string, ingredient_name string"),
        dim_ingredient_price=spark.createDataFrame(
            [("p1", "i1", "s", 90.0, "L", None, date(2026, 1, 1), None, "x"), ("p2", "i2", "s", 50.0, "kg", None, date(2026, 1, 1), None, "x")],
            "price_id string, ingredient_id string, supplier_name string, price_inr double, price_uom string,"
            "density_g_per_ml double, effective_from date, effective_to date, price_source string"),
        map_recipe_ingredient=spark.createDataFrame(
            [("l1", "R-v1", "i1", 100.0, 0.0, "Base"), ("l2", "R-v1", "i2", 50.0, 50.0, "Fat"), ("l3", "R-v1", "i3", 10.0, 100.0, "Fat")],
            "recipe_line_id string, recipe_id string, ingredient_id string, qty_net_g double, loss_pct double, role string")
        .withColumns({"line_seq": F.lit(1).cast("bigint"), "qty_authored": F.lit(1.0), "uom": F.lit("g"), "is_optional": F.lit(False)}),
        dim_recipe=spark.createDataFrame(
            [("R-v1", "s1", "R", "Draft", 160.0, 9.005)], "recipe_id string, sku string, recipe_name string, status string, batch_size_g double, target_cogs_inr double")
        .withColumns({"idea_id": F.lit(None).cast("string"), "parent_recipe_id": F.lit(None).cast("string"),
                      "is_current": F.lit(True), "version_no": F.lit(None).cast("bigint"),
                      "packaging_cost_inr": F.lit(None).cast("double"), "labour_overhead_inr": F.lit(None).cast("double")}),
        product_pricing=spark.createDataFrame([("s1", None)], "sku string, total_cogs_inr double"))
    return GivenTables(spark, **{**tables, **over})


def test_recipe_costing_edges(spark):
    t = recipe_tables(spark)
    lines = {r.recipe_line_id: r for r in recipes.v_recipe_line_cost(t, DAY).collect()}
    assert lines["l1"].line_cost_inr == 9.0          # litres without a density divide by one
    assert lines["l2"].qty_gross_g == 100.0 and lines["l2"].line_cost_inr == 5.0
    assert lines["l3"].qty_gross_g is None and lines["l3"].line_cost_inr is None
    head = recipes.v_recipe_cogs(t, DAY).collect()[0]
    assert head.version_no == 1 and head.recipe_cogs_inr == 14.0
    assert head.uncosted_lines == 1 and head.is_fully_costed is False
    assert head.master_variance_inr is None and head.net_mass_g == 160.0


def test_target_tolerance(spark):
    df = spark.createDataFrame([(10.0, None), (10.005, 10.0), (10.5, 10.0), (10.51, 10.0)], "cost double, target double")
    got = [r[0] for r in df.select(fn.target_fit("cost", "target")).collect()]
    assert got == ["UNKNOWN", "INSIDE", "MARGINAL", "OVER"]


def test_name_tag_exclusions(spark):
    names = {"Coconut milk": [], "Cocoa butter": [], "Palm jaggery": ["WHOLE_SWEETENER"], "Palm oil": ["PALM_OR_HYDROGENATED"],
             "Sugar": ["REFINED_SUGAR"], "Coconut sugar": ["WHOLE_SWEETENER"], "Eggplant": ["EGG"], "Whey": ["DAIRY"]}
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = {r.n: r.tags for r in df.select("n", recipes.name_tags(F.col("n")).alias("tags")).collect()}
    assert got == names


def test_claim_rules_switch_on_with_the_text(spark):
    df = spark.createDataFrame([("a vegan bar",), ("a bar",)], "txt string")
    got = [{b.rule for b in r[0]} for r in df.select(recipes.claim_bans(F.col("txt"))).collect()]
    assert "vegan" in got[0] and "vegan" not in got[1] and len(got[1]) == 5


def test_membership_prefers_the_current_recipe(spark):
    t = GivenTables(
        spark,
        dim_recipe=spark.createDataFrame([("r1", "a", True), ("r2", "b", False)], "recipe_id string, sku string, is_current boolean"),
        map_recipe_ingredient=spark.createDataFrame([("r1", "x"), ("r2", "y")], "recipe_id string, ingredient_id string"),
        map_product_ingredient=spark.createDataFrame([("a", "old"), ("b", "old"), ("b", "old")], "sku string, ingredient_id string"))
    assert rows(products.v_product_ingredient(t), "sku", "ingredient_id") == [("a", "x"), ("b", "old")]


def test_campaign_ladder_edges(spark):
    cases = [(0.0, 50, None, "cannot_evaluate"), (900.0, 4, 3.0, "not_enough_data"), (900.0, 9, 0.0, "stop"), (900.0, 9, 0.74, "stop"),
             (900.0, 9, 0.75, "reduce_budget"), (900.0, 9, 1.0, "maintain"), (900.0, 9, 1.5, "increase_budget_cautious"),
             (900.0, 9, 2.5, "increase_budget_confident"), (900.0, 9, 10.0, "increase_budget_confident"), (900.0, 9, 10.01, "validate_outlier")]
    df = spark.createDataFrame([(s, o, r, i) for i, (s, o, r, _) in enumerate(cases)],
                               "ad_spend_rs double, ad_orders bigint, roi double, i int")
    got = marketing.campaign_ladder(df).orderBy("i").collect()
    assert [r.suggested_action for r in got] == [c[3] for c in cases]
    assert got[2].category == "critical_failure" and got[0].priority == "LOW"


def test_three_meanings_of_latest(spark):
    df = spark.createDataFrame([("s1", "a", 1), ("s1", "b", 2), ("s1", "c", 2), ("s2", "a", 3)], "store string, sku string, d int")
    assert rows(latest_row(df, ["store", "sku"], "d"), "sku", "d") == [("a", 1), ("a", 3), ("b", 2), ("c", 2)]
    assert rows(latest_snapshot(df, ["store"], "d"), "sku", "d") == [("a", 3), ("b", 2), ("c", 2)]
    assert rows(latest_global(df, "d"), "sku", "d") == [("a", 3)]


def test_null_arms(spark):
    df = spark.createDataFrame([(None, 1), ("Rejected", 2), ("Triage", 3)], "stage string, i int")
    assert [r.i for r in df.where(F.col("stage").isNull() | ~F.col("stage").isin("Rejected")).orderBy("i").collect()] == [1, 3]
    packed = df.select(fn.pack("|", "stage", "i").alias("d")).collect()
    assert packed[0].d == "|1"


def test_bucket_falls_through_on_null(spark):
    spec = {"as": "b", "bucket": [{"when": {"field": "x", "op": "lte", "ref": "y"}, "value": "low"}, {"else": "ok"}]}
    df = spark.createDataFrame([(1, 2), (1, None), (3, 2)], "x int, y int")
    assert [r.b for r in G.compute(df, [spec], DAY).collect()] == ["low", "ok", "ok"]


def test_shares_sum_to_hundred_and_mode_ties(spark):
    df = spark.createDataFrame([("r", 1.0), ("r", 3.0), ("q", 2.0)], "k string, v double")
    got = share_of_total(df, ["k"], "v", "pct").groupBy("k").agg(F.sum("pct")).collect()
    assert all(r[1] == 100.0 for r in got)
    m = spark.createDataFrame([("i", "b"), ("i", "a"), ("j", None), ("j", "z")], "i string, role string")
    assert rows(commonest(m, "i", "role"), "i", "role") == [("i", "a"), ("j", None)]


def test_conditional_sum_policies_and_number_text(spark):
    df = spark.createDataFrame([(1.0,)], "v double")
    r = df.agg(fn.sum_if(F.col("v") > 5, "v").alias("a"), fn.sum_if(F.col("v") > 5, "v", otherwise=0.0).alias("b")).collect()[0]
    assert r.a is None and r.b == 0.0
    got = spark.createDataFrame([(12.5,), (3.0,), (100.0,), (0.126,)], "v double").select(fn.num_text("v", 2)).collect()
    assert [g[0] for g in got] == ["12.5", "3", "100", "0.13"]


def test_version_suffix_and_generated_key(spark):
    df = spark.createDataFrame([("RCP-a-v7", None, ""), ("RCP-b", 2, "K1")], "id string, v bigint, k string")
    got = df.select(fn.version_of("v", "id").alias("v"), fn.generated_key("k", "P_", "id").alias("k")).collect()
    assert [g.v for g in got] == [7, 2] and got[1].k == "K1" and got[0].k.startswith("P_") and len(got[0].k) == 2 + 64


def test_review_clusters_follow_the_product_that_the_text_names(spark, monkeypatch):
    from datetime import timedelta

    day = date(2026, 3, 20)
    texts = ["The Date Bar had no taste", "date bar: taste was off", "DATE BAR lost its taste", "wrong item, not the date bar",
             "nut bite without taste", "no product, no taste"]
    reviews = [(f"r{i}", "s1", day - timedelta(3 * i), x, 1.0) for i, x in enumerate(texts)]
    t = GivenTables(
        spark,
        customer_review_events=spark.createDataFrame(reviews, "review_id string, master_store_id string, review_date date, review_text string, star_rating double"),
        dim_product=spark.createDataFrame([("1", "Dessert - Date Bar - 40 gm", True), ("2", "Nut Bite - 20 gm", True)], "sku string, display_name string, is_active boolean"),
        product_pricing=spark.createDataFrame([("1", 10.0), ("2", 5.0)], "sku string, total_cogs_inr double"))
    monkeypatch.setattr(products, "product_facets", lambda t: t.dim_product.join(t.product_pricing, "sku"))
    got = {(r["product"], r["theme"]): (r["review_count"], r["qualifies"]) for r in complaints.review_clusters(t, day).collect()}
    assert got == {("1", "taste"): (3, True), ("1", "Wrong item"): (1, False), ("2", "taste"): (1, False)}
