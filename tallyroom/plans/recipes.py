"""Recipe costing, workbench, formulation context and what-if edits."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroom.constants import FORMULATION_RULES, INGREDIENT_TAGS
from tallyroom.functions import (days_since, gross_from_net, num_text, pack, price_per_kg, safe_divide, target_fit,
                                 version_of, whole_text)
from tallyroom.operators.joins import attach_parent, left_join
from tallyroom.operators.ranking import commonest, share_of_total, top_n
from tallyroom.operators.sets import tagged_union
from tallyroom.operators.snapshots import in_force_row
from tallyroom.operators.swaps import owner_groups, ranked_catalog, unused_lists
from tallyroom.sources.sinks import written_once

DEAREST_SHOWN = 3
DEAREST_CONTEXT = 14
SWAPS_SHOWN = 12
SWAPS_PER_ROLE = 2


# ---- tags and bans ---------------------------------------------------------------------

def name_tags(name: Column) -> Column:
    """Tags of an ingredient name as an array, from fixed literal patterns."""
    text = F.lower(name)
    hits = []
    for tag, pattern, exclusion in INGREDIENT_TAGS:
        hit = text.rlike(pattern)
        if exclusion:
            hit = hit & ~text.rlike(exclusion)
        hits.append(F.when(hit, F.lit(tag)))
    return F.array_compact(F.array(*hits))


def tag_bits(tags: Column) -> Column:
    """Tags as the bits of a number, in their order in ``INGREDIENT_TAGS``: a few bytes beside a line that moves."""
    bits = F.lit(0)
    for i, (tag, _, _) in enumerate(INGREDIENT_TAGS):
        bits = bits.bitwiseOR(F.when(F.array_contains(tags, tag), F.lit(1 << i)).otherwise(F.lit(0)))
    return bits


def tags_of(bits: Column) -> Column:
    return F.array_compact(F.array(*[F.when(bits.bitwiseAND(F.lit(1 << i)) != 0, F.lit(tag))
                                     for i, (tag, _, _) in enumerate(INGREDIENT_TAGS)]))


def claim_bans(text: Column) -> Column:
    """Rules in force for a brief: brand rules always, claim rules when the text
    makes the claim."""
    rules = []
    for rule, pattern, tag, source in FORMULATION_RULES:
        row = F.struct(F.lit(rule).alias("rule"), F.lit(tag).alias("banned_tag"), F.lit(source).alias("source"))
        rules.append(F.when(text.rlike(pattern), row) if pattern else row)
    return F.array_compact(F.array(*rules))


def broken_rules(bans: Column, tags: Column) -> Column:
    """Sorted names of the rules that a tagged ingredient breaks."""
    rules = F.transform(F.filter(bans, lambda b: F.array_contains(tags, b["banned_tag"])), lambda b: b["rule"])
    return F.sort_array(F.array_distinct(rules))


def tag_by_regex(t) -> DataFrame:
    return t.dim_ingredient.select("ingredient_id", F.explode(name_tags(F.col("ingredient_name"))).alias("tag"))


def text_profile(t) -> DataFrame:
    """Lower-cased wording of each recipe: its name, idea and product claims."""
    highlights = t.product_highlight.groupBy("sku").agg(
        F.expr("string_agg(highlight_text, ' ') WITHIN GROUP (ORDER BY highlight_seq, highlight_text)").alias("claims"))
    ideas = t.dim_idea.select("idea_id", F.col("name").alias("idea_name"), "hypothesis", "thesis_fit")
    return (t.dim_recipe.select("recipe_id", "recipe_name", "idea_id", "sku")
            .transform(left_join, ideas, ["idea_id"], ["recipe_id"]).transform(left_join, highlights, ["sku"], ["recipe_id"])
            .select("recipe_id", F.lower(pack(" ", "recipe_name", "idea_name", "hypothesis", "thesis_fit",
                                              "claims")).alias("txt")))


def recipe_bans(t) -> DataFrame:
    return text_profile(t).select("recipe_id", claim_bans(F.col("txt")).alias("bans"))


def rules_activate(t) -> DataFrame:
    return recipe_bans(t).select("recipe_id", F.inline("bans"))


# ---- costing -----------------------------------------------------------------------------

def v_ingredient_current_cost(t, as_of: date) -> DataFrame:
    """Rate in force per ingredient; an ingredient without one stays, uncosted."""
    rates = in_force_row(t.dim_ingredient_price, ["ingredient_id"], "effective_from", "effective_to", as_of,
                         ties=["price_id", "price_inr"])
    return (t.dim_ingredient.select("ingredient_id", "ingredient_name").join(rates, "ingredient_id", "left")
            .select("ingredient_id", "ingredient_name", "supplier_name",
                    F.col("price_inr").cast("double").alias("price_inr"), "price_uom",
                    price_per_kg("price_inr", "price_uom", "density_g_per_ml").alias("price_inr_per_kg"),
                    "effective_from", "effective_to", "price_source",
                    F.col("price_id").isNotNull().alias("is_costed"),
                    days_since("effective_from", as_of).alias("price_age_days")))


def priced_lines(t, as_of: date, rates: DataFrame | None = None) -> DataFrame:
    rates = (v_ingredient_current_cost(t, as_of) if rates is None else rates).select(
        "ingredient_id", "ingredient_name", "price_inr_per_kg", "is_costed", "price_source", "supplier_name")
    return with_costs(t.map_recipe_ingredient
                      .withColumn("qty_net_g", F.col("qty_net_g").cast("double"))
                      .withColumn("loss_pct", F.col("loss_pct").cast("double"))
                      .join(rates, "ingredient_id", "left"))


def with_costs(lines: DataFrame) -> DataFrame:
    return (lines.withColumn("qty_gross_g", gross_from_net("qty_net_g", "loss_pct"))
            .withColumn("line_cost_raw", F.col("qty_gross_g") / 1000 * F.col("price_inr_per_kg")))


def lines_by_recipe(t, rates: DataFrame) -> DataFrame:
    """Priced lines in buckets by recipe, without those of no recipe: they move once to their rates and
    once to their recipes, with the columns that recipe boards show. ``rates`` may have more columns than the shown."""
    lines = t.map_recipe_ingredient.where(F.col("recipe_id").isNotNull()).select(
        "recipe_id", "ingredient_id", "line_seq", "role", F.col("qty_net_g").cast("double").alias("qty_net_g"),
        F.col("loss_pct").cast("double").alias("loss_pct"))
    shown = ["ingredient_id", "ingredient_name", "price_inr_per_kg", "is_costed", *[c for c in rates.columns if c in ("is_listed", "tag_bits")]]
    return with_costs(written_once(lines.join(rates.select(*shown), "ingredient_id", "left"), "recipe-lines", by=["recipe_id"]))


def v_recipe_line_cost(t, as_of: date, priced: DataFrame | None = None) -> DataFrame:
    """Every line priced on gross mass with its share of the recipe's cost. ``priced`` may hold the
    lines with some of the columns."""
    shared = share_of_total(priced_lines(t, as_of) if priced is None else priced, ["recipe_id"], "line_cost_raw", "cost_share_pct")
    columns = ["recipe_line_id", "recipe_id", "ingredient_id", "line_seq", "role", "qty_authored", "uom", "is_optional",
               "qty_net_g", "loss_pct", "qty_gross_g", "ingredient_name", "price_inr_per_kg", "is_costed", "price_source",
               "supplier_name"]
    if priced is not None:
        columns = [c for c in (*columns, "tag_bits") if c in shared.columns]
    return shared.select(*columns, F.round("line_cost_raw", 4).alias("line_cost_inr"), "cost_share_pct")


def cost_recipes(recipes: DataFrame, lines: DataFrame, pricing: DataFrame) -> DataFrame:
    """Header-level costing from priced lines (``line_cost_inr`` per line)."""
    sums = lines.groupBy("recipe_id").agg(
        F.count("*").alias("lines"),
        F.count_if(~F.coalesce("is_costed", F.lit(False))).alias("uncosted_lines"),
        F.round(F.sum("qty_net_g"), 3).alias("net_mass_g"),
        F.round(F.sum("qty_gross_g"), 3).alias("gross_mass_g"),
        F.round(F.sum("line_cost_inr"), 4).alias("ingredient_cost_inr"))
    zero = F.lit(0.0)
    master = pricing.select("sku", F.col("total_cogs_inr").cast("double").alias("master_cogs_inr"))
    # by recipe last, so that what is joined by recipe after it needs no other move
    costed = (left_join(recipes, master, ["sku"], ["recipe_id"]).join(sums, "recipe_id", "left")
              .withColumn("version_no", version_of("version_no", "recipe_id"))
              .withColumn("batch_size_g", F.col("batch_size_g").cast("double"))
              .withColumn("target_cogs_inr", F.col("target_cogs_inr").cast("double"))
              .withColumn("packaging_cost_inr", F.coalesce(F.col("packaging_cost_inr").cast("double"), zero))
              .withColumn("labour_overhead_inr", F.coalesce(F.col("labour_overhead_inr").cast("double"), zero))
              .fillna(0, ["lines", "uncosted_lines", "ingredient_cost_inr"])
              .withColumn("total", F.col("ingredient_cost_inr") + F.col("packaging_cost_inr")
                          + F.col("labour_overhead_inr")))
    variance = F.col("total") - F.col("master_cogs_inr")
    return costed.select(
        "recipe_id", "sku", "idea_id", "recipe_name", "parent_recipe_id", "status", "is_current", "version_no",
        "batch_size_g", "target_cogs_inr", "packaging_cost_inr", "labour_overhead_inr", "lines", "uncosted_lines",
        "net_mass_g", "gross_mass_g", "ingredient_cost_inr", "master_cogs_inr",
        F.round("total", 3).alias("recipe_cogs_inr"),
        (F.col("uncosted_lines") == 0).alias("is_fully_costed"),
        F.round(safe_divide("net_mass_g", "gross_mass_g") * 100, 2).alias("yield_pct"),
        F.round(F.col("net_mass_g") - F.col("batch_size_g"), 3).alias("mass_variance_g"),
        F.round(safe_divide("ingredient_cost_inr", "total") * 100, 1).alias("ingredient_share_pct"),
        F.round(safe_divide("labour_overhead_inr", "total") * 100, 1).alias("overhead_share_pct"),
        F.round(safe_divide("total", "net_mass_g") * 100, 3).alias("cogs_per_100g_inr"),
        F.round(variance, 3).alias("master_variance_inr"),
        F.round(safe_divide(variance, "master_cogs_inr") * 100, 2).alias("master_variance_pct"),
        target_fit("total", "target_cogs_inr").alias("target_fit"))


def v_recipe_cogs(t, as_of: date) -> DataFrame:
    lines = priced_lines(t, as_of).withColumn("line_cost_inr", F.round("line_cost_raw", 4))
    return cost_recipes(t.dim_recipe, lines, t.product_pricing)


# ---- swap candidates --------------------------------------------------------------------

def swap_catalog(t, as_of: date, rates: DataFrame | None = None) -> DataFrame:
    """Priced ingredients under their commonest role, ranked by price in it."""
    roles = commonest(t.map_recipe_ingredient, "ingredient_id", "role").where(F.col("role").isNotNull())
    priced = (v_ingredient_current_cost(t, as_of) if rates is None else rates).where("is_costed").select(
        "ingredient_id", "ingredient_name", "price_inr_per_kg", "supplier_name",
        name_tags(F.col("ingredient_name")).alias("tags"))
    pool = written_once(priced.join(roles, "ingredient_id"), "swap-pool")
    return written_once(ranked_catalog(pool, "role", "price_inr_per_kg", "ingredient_id"), "swap-catalog")


def recipe_lines(t) -> DataFrame:
    return t.map_recipe_ingredient.select("recipe_id", "ingredient_id")


def recipe_members(t) -> DataFrame:
    return recipe_lines(t).distinct()


def role_lists(t, as_of: date, n: int = SWAPS_SHOWN, lines: DataFrame | None = None,
               catalog: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Per recipe, ``places``: the ``n`` cheapest priced ingredients of its own roles that it does not use
    yet, by their place among the ingredients of the second table. ``lines`` may hold the recipes' lines in buckets."""
    lines = t.map_recipe_ingredient if lines is None else lines
    wanted = lines.where(F.col("role").isNotNull()).select("recipe_id", "role").distinct()
    catalog = swap_catalog(t, as_of) if catalog is None else catalog
    found, head = unused_lists(owner_groups(wanted, "recipe_id", "role"), lines.select("recipe_id", "ingredient_id"), catalog,
                               "recipe_id", "role", "ingredient_id", n, ["price_inr_per_kg", "ingredient_id"])
    return found.select("recipe_id", F.slice(F.sort_array(F.flatten("free")), 1, n).alias("places")), head


def _placed(lists: DataFrame, head: DataFrame) -> DataFrame:
    """A row per place, its rank in the list as ``rnk``, with the ingredient that stands there."""
    rows = lists.select(*[c for c in lists.columns if c != "places"], F.posexplode("places").alias("__at", "place"))
    return rows.join(head, "place").withColumn("rnk", (F.col("__at") + 1).cast("bigint")).drop("__at", "place")


def swap_candidates_role(t, as_of: date, n: int = SWAPS_SHOWN) -> DataFrame:
    """The ``n`` cheapest priced ingredients of a recipe's own roles that it does
    not use yet."""
    return _placed(*role_lists(t, as_of, n))


def swap_lists_all(t, as_of: date, n: int = SWAPS_PER_ROLE, catalog: DataFrame | None = None,
                   lines: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Per recipe, ``free``: for every role, in order, the places of its ``n`` cheapest unused ingredients in the
    second table. ``lines`` may hold the recipes' lines in buckets."""
    catalog = swap_catalog(t, as_of) if catalog is None else catalog
    roles = catalog.agg(F.sort_array(F.collect_set("role")))
    # Only ids and places travel through the search.
    wanted = t.dim_recipe.groupBy("recipe_id").agg(F.count("*").alias("n")).withColumn("roles", roles.scalar()).select(
        "recipe_id", F.transform("roles", lambda r: F.struct(r.alias("g"), F.col("n").alias("n"))).alias("groups"))
    used = recipe_lines(t) if lines is None else lines.select("recipe_id", "ingredient_id")
    found, head = unused_lists(wanted, used, catalog, "recipe_id", "role", "ingredient_id", n, ["role", "pos"])
    return found.withColumn("free", F.transform("free", lambda places: F.slice(places, 1, n))), head


def swap_verdict(broken: Column) -> Column:
    """Of the joined names of the rules that a candidate breaks."""
    return F.when(broken == "", F.lit("ALLOWED")).otherwise(F.concat(F.lit("VIOLATES:"), broken))


def swap_candidates_all(t, as_of: date, n: int = SWAPS_PER_ROLE, catalog: DataFrame | None = None,
                        bans: DataFrame | None = None) -> DataFrame:
    """The ``n`` cheapest unused ingredients of every role, judged against the
    recipe's bans."""
    found, head = swap_lists_all(t, as_of, n, catalog)
    bans = recipe_bans(t) if bans is None else bans  # joined one row per recipe
    rows = found.join(bans, "recipe_id").select("recipe_id", "bans", F.explode("free").alias("places"))
    broken = F.array_join(broken_rules(F.col("bans"), F.col("tags")), "+")
    return _placed(rows, head).withColumn("__broken", broken).withColumn("verdict", swap_verdict(F.col("__broken"))).drop("__broken")


def with_listed(rates: DataFrame, catalog: DataFrame) -> DataFrame:
    """Rates with ``is_listed``, whether the ingredient is in the catalog, and ``tag_bits``: both are found once an
    ingredient, not once a line."""
    listed = catalog.select("ingredient_id").distinct().withColumn("is_listed", F.lit(True))
    return rates.withColumn("tag_bits", tag_bits(name_tags(F.col("ingredient_name")))).join(listed, "ingredient_id", "left")


def candidate_counts(t, as_of: date, catalog: DataFrame | None = None, lines: DataFrame | None = None) -> DataFrame:
    """How many priced ingredients a recipe does not use: the catalog size less
    its own members found there. ``lines`` may hold the recipes' lines in buckets, with ``is_listed``."""
    catalog = (swap_catalog(t, as_of) if catalog is None else catalog).select("ingredient_id")
    if lines is None:
        members = recipe_members(t).join(catalog, "ingredient_id", "left_semi")
    else:
        members = lines.where("is_listed").select("recipe_id", "ingredient_id").distinct()
    own = members.groupBy("recipe_id").agg(F.count("*").alias("own"))
    return (t.dim_recipe.select("recipe_id").join(own, "recipe_id", "left")
            .withColumn("n_cand", catalog.agg(F.count("*")).scalar() - F.coalesce("own", F.lit(0))).drop("own"))


# ---- workbench ------------------------------------------------------------------------------

def _dearest(df: DataFrame, n: int) -> DataFrame:
    order = [F.desc_nulls_last("line_cost_inr"), F.asc("ingredient_id"), F.asc("line_seq"), F.asc("role"),
             F.asc("qty_net_g"), F.asc("loss_pct")]
    return top_n(df, ["recipe_id"], order, n)


def verdict_rows(cogs: DataFrame) -> DataFrame:
    """Four rules per recipe as four rows ``(rule, verdict, evidence)``."""
    def rule(name, verdict, evidence):
        return F.struct(F.lit(name).alias("rule"), verdict.alias("verdict"), evidence.alias("evidence"))

    def passes(cond, fail):
        return F.when(cond, F.lit("PASS")).otherwise(F.lit(fail))

    mass_ok = F.abs(F.coalesce("mass_variance_g", F.lit(0.0))) <= 0.01 * F.col("batch_size_g")
    rows = F.array(
        rule("target_cogs", F.col("target_fit"),
             F.concat(num_text("recipe_cogs_inr", 2), F.lit(" vs "),
                      F.coalesce(num_text("target_cogs_inr", 2), F.lit("no target")))),
        rule("mass_closes", passes(mass_ok, "FAIL"),
             F.concat(num_text(F.coalesce("net_mass_g", F.lit(0.0)), 1), F.lit("g vs declared "),
                      whole_text("batch_size_g"), F.lit("g"))),
        rule("fully_costed", passes(F.col("is_fully_costed"), "FAIL"),
             F.concat(F.col("uncosted_lines").cast("string"), F.lit(" of "), F.col("lines").cast("string"),
                      F.lit(" lines lack a rate"))),
        rule("yield_plausible", passes(F.coalesce("yield_pct", F.lit(100.0)).between(80, 100), "REVIEW"),
             F.concat(num_text(F.coalesce("yield_pct", F.lit(0.0)), 2), F.lit("%"))))
    return cogs.select("recipe_id", "status", F.inline(rows))


def version_diff_lines(t, as_of: date, n: int = DEAREST_SHOWN, lines: DataFrame | None = None) -> DataFrame:
    """The parent version's dearest lines under the child's id."""
    lines = v_recipe_line_cost(t, as_of) if lines is None else lines
    children = t.dim_recipe.where(F.col("parent_recipe_id").isNotNull()).select(
        "recipe_id", "parent_recipe_id", "status")
    dearest = _dearest(lines, n)
    return attach_parent(children, "parent_recipe_id", dearest, "recipe_id")


def v_recipe_workbench(t, as_of: date) -> DataFrame:
    """Header, dearest lines, parent's lines, verdicts, swap rates and an end
    marker per recipe, packed behind one tag."""
    rates = written_once(v_ingredient_current_cost(t, as_of), "ingredient-rates")
    catalog = swap_catalog(t, as_of, rates)
    priced = lines_by_recipe(t, rates)
    costed = v_recipe_line_cost(t, as_of, priced)
    cogs = written_once(cost_recipes(t.dim_recipe, costed, t.product_pricing).select(
        "recipe_id", "recipe_name", "status", "version_no", "batch_size_g", "ingredient_cost_inr", "packaging_cost_inr",
        "labour_overhead_inr", "recipe_cogs_inr", "target_cogs_inr", "target_fit", "is_fully_costed", "uncosted_lines", "lines",
        "mass_variance_g", "net_mass_g", "yield_pct"), "recipe-cogs")
    status = F.coalesce("status", F.lit("")).alias("st")
    statuses = t.dim_recipe.select("recipe_id", "status")
    head = cogs.select(
        F.col("recipe_id").alias("id"), F.col("recipe_name").alias("nm"),
        F.concat(F.coalesce(F.col("version_no").cast("string"), F.lit("?")), F.lit("|"),
                 F.coalesce("status", F.lit("")), F.lit("|"), whole_text("batch_size_g"), F.lit("|"),
                 num_text("ingredient_cost_inr", 2), F.lit("|"), num_text("packaging_cost_inr", 2), F.lit("|"),
                 num_text("labour_overhead_inr", 2), F.lit("|"), num_text("recipe_cogs_inr", 2), F.lit("|"),
                 F.coalesce(num_text("target_cogs_inr", 2), F.lit("none")), F.lit("|"), F.col("target_fit"),
                 F.lit("|"), F.when(F.col("is_fully_costed"), "costed").otherwise("partial")).alias("d"), status)
    lines = _dearest(costed, DEAREST_SHOWN).join(statuses, "recipe_id").select(
        F.col("recipe_id").alias("id"), F.col("ingredient_name").alias("nm"),
        F.concat(F.coalesce("role", F.lit("")), F.lit("|"), num_text("qty_net_g", 2), F.lit("|"),
                 num_text("loss_pct", 1), F.lit("|"),
                 F.coalesce(whole_text("price_inr_per_kg"), F.lit("uncosted")), F.lit("|"),
                 F.coalesce(num_text("line_cost_inr", 2), F.lit("uncosted")), F.lit("|"),
                 F.coalesce(num_text("cost_share_pct", 1), F.lit("na"))).alias("d"), status)
    base = version_diff_lines(t, as_of, lines=costed).select(
        F.col("recipe_id").alias("id"), F.col("ingredient_name").alias("nm"),
        F.concat(F.coalesce("role", F.lit("")), F.lit("|"), num_text("qty_net_g", 2), F.lit("|"),
                 F.coalesce(num_text("line_cost_inr", 2), F.lit("uncosted"))).alias("d"), status)
    verdicts = verdict_rows(cogs).select(
        F.col("recipe_id").alias("id"), F.col("rule").alias("nm"),
        F.concat("verdict", F.lit("|"), "evidence").alias("d"), status)
    # the statuses join one row per recipe, before its candidates become rows
    swaps, swap_head = role_lists(t, as_of, lines=priced, catalog=catalog)
    swap_texts = swap_head.select("place", F.col("ingredient_name").alias("nm"), F.concat(
        "role", F.lit("|"), whole_text("price_inr_per_kg"), F.lit("|"), F.coalesce("supplier_name", F.lit(""))).alias("d"))
    swap_rates = _placed(swaps.join(statuses, "recipe_id"), swap_texts).select(F.col("recipe_id").alias("id"), "nm", "d", status)
    end = t.dim_recipe.select(F.col("recipe_id").alias("id"), F.lit("END_OF_WORKBENCH").alias("nm"),
                              F.lit("").alias("d"), status)
    return tagged_union(**{"1_HDR": head, "2_LINE": lines, "3_BASE": base, "4_THESIS": verdicts,
                           "5_RATE": swap_rates, "9_END": end})


# ---- formulation context ---------------------------------------------------------------------

def packed_lines(lines: DataFrame, bans: DataFrame) -> DataFrame:
    counts = lines.groupBy("recipe_id").agg(F.count("*").alias("n_lines"))
    # most lines break no rule, which two numbers tell
    broken = F.when(F.col("tag_bits").bitwiseAND(F.col("ban_bits")) == 0, F.lit("")).otherwise(
        F.array_join(broken_rules(F.col("bans"), tags_of(F.col("tag_bits"))), "+"))
    shown = _dearest(lines, DEAREST_CONTEXT).join(bans, "recipe_id").withColumn("broken", broken).select(
        "recipe_id", "rnk",
        F.concat(F.coalesce("ingredient_id", F.lit("?")), F.lit("~"), "ingredient_name", F.lit("~"),
                 F.coalesce("role", F.lit("")), F.lit("~"), num_text("qty_net_g", 1), F.lit("~"),
                 num_text("loss_pct", 1), F.lit("~"),
                 F.coalesce(whole_text("price_inr_per_kg"), F.lit("uncosted")), F.lit("~"),
                 F.coalesce(num_text("line_cost_inr", 2), F.lit("uncosted")), F.lit("~"),
                 F.when(F.col("broken") != "", F.col("broken")).otherwise(F.lit("ok"))).alias("d"))
    text = shown.groupBy("recipe_id").agg(F.expr("string_agg(d, '|') WITHIN GROUP (ORDER BY rnk)").alias("lines"))
    return counts.join(text, "recipe_id", "left")


def packed_swaps(t, as_of: date, catalog: DataFrame, bans: DataFrame, lines: DataFrame) -> DataFrame:
    """Texts of the candidates of :func:`swap_candidates_all` by role and rank. They are packed inside the recipe's row, from
    one row that holds the head of the catalog; candidates are no rows of their own."""
    found, head = swap_lists_all(t, as_of, catalog=catalog, lines=lines)
    text = F.concat("ingredient_id", F.lit("~"), "ingredient_name", F.lit("~"), "role", F.lit("~"),
                    whole_text("price_inr_per_kg"), F.lit("~"))
    heads = head.agg(F.array_sort(F.collect_list(F.struct("place", text.alias("text"), "tags", tag_bits(F.col("tags")).alias("bits")))))
    judged = bans.groupBy("recipe_id").agg(  # one, but for repeated ids
        F.array_sort(F.collect_list(F.struct("ban_bits", "bans"))).alias("judged"))

    def verdict(bans, tags):
        names = F.array(F.array_join(broken_rules(bans, tags), "+"))
        return F.element_at(F.transform(names, swap_verdict), 1)

    def shown(place):
        item = F.get(F.col("heads"), place)
        return F.transform("judged", lambda j: F.concat(item["text"], F.when(
            j["ban_bits"].bitwiseAND(item["bits"]) == 0, swap_verdict(F.lit(""))).otherwise(verdict(j["bans"], item["tags"]))))

    texts = F.array_compact(F.flatten(F.transform(F.flatten("free"), shown)))
    rows = found.join(judged, "recipe_id").withColumn("heads", heads.scalar()).select("recipe_id", texts.alias("texts"))
    return rows.select("recipe_id", F.when(F.size("texts") > 0, F.array_join("texts", "|")).alias("cands"))


def v_recipe_formulation_context(t, as_of: date) -> DataFrame:
    """One row per recipe: costing header plus packed lines, swaps and bans."""
    rates = written_once(v_ingredient_current_cost(t, as_of), "ingredient-rates")
    catalog = swap_catalog(t, as_of, rates)
    priced = lines_by_recipe(t, with_listed(rates, catalog))
    costed = v_recipe_line_cost(t, as_of, priced)
    bans = written_once(recipe_bans(t).where(F.col("recipe_id").isNotNull()).withColumn("ban_bits", tag_bits(F.col("bans.banned_tag"))),
                        "recipe-bans", by=["recipe_id"])
    ordered = F.array_sort(F.transform("bans", lambda b: F.struct(
        b["source"].alias("source"), b["rule"].alias("rule"), b["banned_tag"].alias("banned_tag"))))
    packed_bans = bans.select(
        "recipe_id", F.size("bans").cast("bigint").alias("n_bans"),
        F.array_join(F.transform(ordered, lambda b: F.concat(b["rule"], F.lit("~"), b["banned_tag"], F.lit("~"),
                                                             b["source"])), "|").alias("bans"))
    return (cost_recipes(t.dim_recipe, costed, t.product_pricing).drop("lines")
            .join(packed_lines(costed, bans), "recipe_id", "left")
            .join(candidate_counts(t, as_of, catalog, priced), "recipe_id", "left")
            .join(packed_swaps(t, as_of, catalog, bans, priced), "recipe_id", "left")
            .join(packed_bans, "recipe_id", "left")
            .select("recipe_id", "recipe_name", "idea_id", "sku", "version_no", "parent_recipe_id", "status",
                    "recipe_cogs_inr", "target_cogs_inr", "target_fit", "is_fully_costed", "batch_size_g",
                    "packaging_cost_inr", "labour_overhead_inr", "net_mass_g",
                    F.coalesce("n_lines", F.lit(0)).alias("n_lines"), F.coalesce("lines", F.lit("")).alias("lines"),
                    F.when(F.col("cands").isNull(), 0).otherwise(F.col("n_cand")).alias("n_cand"),
                    F.coalesce("cands", F.lit("")).alias("cands"),
                    F.coalesce("n_bans", F.lit(0)).alias("n_bans"), F.coalesce("bans", F.lit("")).alias("bans"),
                    F.lit("END").alias("end_mark")))


# ---- what-if edits ------------------------------------------------------------------------------

def replay_edits(lines: DataFrame, edits: DataFrame) -> DataFrame:
    """Lines after all edits that were not withdrawn.

    ``edits`` has ``recipe_id, round_no, kind, ingredient_id, amount, withdrawn``
    with kinds SET, ZERO, ADD (absolute) and SCALE (factor). Per line the last
    absolute edit gives the base and later factors multiply it; both are
    combinable aggregates, so no history is gathered into a list. Added lines
    carry no loss; a line at zero leaves the recipe.
    """
    key = ["recipe_id", "ingredient_id"]
    live = edits.where(~F.col("withdrawn"))
    absolute = live.where(F.col("kind") != "SCALE").groupBy(*key).agg(
        F.max(F.struct("round_no", F.when(F.col("kind") == "ZERO", 0.0).otherwise(F.col("amount")).alias("amount"),
                       "kind")).alias("last"))
    factors = (live.where(F.col("kind") == "SCALE")
               .join(absolute.select(*key, F.col("last.round_no").alias("since")), key, "left")
               .where(F.col("since").isNull() | (F.col("round_no") > F.col("since")))
               .groupBy(*key).agg(F.product("amount").alias("factor")))
    changed = (absolute.select(*key, F.col("last.amount").alias("base"), F.col("last.kind").alias("last_kind"))
               .join(factors, key, "full"))
    known = lines.groupBy(*key).agg(F.sum("qty_net_g").alias("qty_net_g"),
                                    F.round(safe_divide(F.sum(F.col("loss_pct") * F.col("qty_net_g")),
                                                        F.sum("qty_net_g")), 6).alias("loss_pct"))
    merged = known.join(changed, key, "full")
    start = F.coalesce("base", "qty_net_g")
    keep = F.col("qty_net_g").isNotNull() | (F.col("last_kind") == "ADD")
    return (merged.where(keep)
            .withColumn("qty_net_g", F.round(start * F.coalesce("factor", F.lit(1.0)), 6))
            .withColumn("loss_pct", F.coalesce("loss_pct", F.lit(0.0)))
            .where(F.col("qty_net_g") > 0).select(*key, "qty_net_g", "loss_pct"))


def recipe_what_if(t, edits: DataFrame, as_of: date) -> DataFrame:
    """Baseline against projected cost, fit band and the 1 % mass check."""
    rates = v_ingredient_current_cost(t, as_of).select("ingredient_id", "price_inr_per_kg", "is_costed")
    projected = (replay_edits(t.map_recipe_ingredient, edits)
                 .withColumn("qty_gross_g", gross_from_net("qty_net_g", "loss_pct"))
                 .join(rates, "ingredient_id", "left")
                 .withColumn("line_cost_inr", F.round(F.col("qty_gross_g") / 1000 * F.col("price_inr_per_kg"), 4)))
    after = cost_recipes(t.dim_recipe, projected, t.product_pricing).select(
        "recipe_id", "batch_size_g", F.col("recipe_cogs_inr").alias("projected_cogs_inr"),
        F.col("target_fit").alias("projected_fit"), F.col("net_mass_g").alias("projected_mass_g"))
    before = v_recipe_cogs(t, as_of).select("recipe_id", F.col("recipe_cogs_inr").alias("baseline_cogs_inr"))
    touched = edits.select("recipe_id").distinct()
    return (before.join(touched, "recipe_id", "left_semi").join(after, "recipe_id")
            .withColumn("saving_inr", F.round(F.col("baseline_cogs_inr") - F.col("projected_cogs_inr"), 2))
            .withColumn("mass_closes", F.abs(F.coalesce("projected_mass_g", F.lit(0.0)) - F.col("batch_size_g"))
                        <= 0.01 * F.col("batch_size_g"))
            .drop("batch_size_g"))


def recipe_fork(t, edits: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Header and line rows of the next version of every edited recipe."""
    touched = edits.where(~F.col("withdrawn")).select("recipe_id").distinct()
    heads = t.dim_recipe.join(touched, "recipe_id", "left_semi")
    version = version_of("version_no", "recipe_id") + 1
    new_id = F.concat(F.regexp_replace("recipe_id", r"-v\d+$", ""), F.lit("-v"), version.cast("string"))
    headers = heads.select(new_id.alias("recipe_id"), F.col("recipe_id").alias("parent_recipe_id"), "recipe_name",
                           "sku", "idea_id", F.lit("InTrial").alias("status"), version.alias("version_no"),
                           "batch_size_g", "packaging_cost_inr", "labour_overhead_inr", "target_cogs_inr")
    lines = (replay_edits(t.map_recipe_ingredient, edits)
             .join(headers.select(F.col("parent_recipe_id").alias("recipe_id"), F.col("recipe_id").alias("new_id")),
                   "recipe_id")
             .select(F.concat(F.lit("RCPL-"), "new_id", F.lit("-"), "ingredient_id").alias("recipe_line_id"),
                     F.col("new_id").alias("recipe_id"), "ingredient_id", "qty_net_g", "loss_pct"))
    return headers, lines
