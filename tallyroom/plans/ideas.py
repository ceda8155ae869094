"""Idea pipeline: inputs, scores, candidate rowsets and ranking."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyroom.constants import (BAND_HIGH, BAND_MEDIUM, CLOSED_STAGES, COGS_SCORE, NEUTRAL_SCORE, OPEN_STAGES,
                                 STAGE_RANK, TIME_LADDER, TIME_TOP, WEIGHTS)
from tallyroom.functions import (days_since, flags_list, ladder, mapped, num_text, pack, safe_divide, score_text)
from tallyroom.operators.ranking import exact_rank, top_n
from tallyroom.operators.sets import tagged_union
from tallyroom.plans.products import product_facets, v_category_market_signal, v_product_line_capability
from tallyroom.sources.sinks import written_once


def cost_envelope(t) -> DataFrame:
    return v_product_line_capability(t).agg(F.min("min_cogs_inr").alias("lo"), F.max("max_cogs_inr").alias("hi"))


def v_idea_priority_inputs(t, as_of: date) -> DataFrame:
    """Active ideas with days in stage, stage rank and fit to the cost envelope.
    The envelope is two scalar subqueries rather than a cross join."""
    envelope = cost_envelope(t)
    target = F.col("target_cogs_inr").cast("double")
    return (t.dim_idea
            .where(F.col("stage").isNull() | ~F.col("stage").isin(CLOSED_STAGES))
            .withColumn("portfolio_min_cogs_inr", F.round(envelope.select("lo").scalar()))
            .withColumn("portfolio_max_cogs_inr", F.round(envelope.select("hi").scalar()))
            .select("idea_id", "name", "stage", "hypothesis", "thesis_fit", target.alias("target_cogs_inr"),
                    days_since("stage_entered_at", as_of).alias("days_in_stage"),
                    mapped("stage", STAGE_RANK).cast("bigint").alias("stage_rank"),
                    "portfolio_min_cogs_inr", "portfolio_max_cogs_inr",
                    ladder((target.isNull(), "UNKNOWN"), (target < F.col("portfolio_min_cogs_inr"), "BELOW"),
                           (target > F.col("portfolio_max_cogs_inr"), "ABOVE"), otherwise="INSIDE").alias("cogs_fit")))


def score_categories(signal: DataFrame) -> DataFrame:
    """Category factors 0-5 and their weighted subtotal (at most 50). No SKUs
    scores a real 0."""
    volume = ladder((F.coalesce("units_90d", F.lit(0.0)) <= 0, 0), (F.col("units_90d") < 500, 1),
                    (F.col("units_90d") < 2000, 2), otherwise=3)
    growth = ladder((F.col("growth_pct").isNull() | (F.col("growth_pct") < 0), 0),
                    (F.col("growth_pct") < 25, 1), otherwise=2)
    marks = F.col("skus_with_label_compliance") + F.col("skus_with_barcode") + F.col("skus_with_declared_allergens")
    ratio = F.coalesce(safe_divide(marks, 3 * F.col("active_skus_in_category")), F.lit(0.0))
    listed = F.coalesce(safe_divide("channels_listed", "channels_mapped"), F.lit(0.0))
    return (signal.withColumn("market_signal", (volume + growth).cast("bigint"))
            .withColumn("compliance_readiness", F.round(5 * ratio).cast("bigint"))
            .withColumn("channel_fit", F.round(5 * listed).cast("bigint"))
            .withColumn("cat_subtotal",
                        F.col("market_signal") * WEIGHTS["market_signal"]
                        + F.col("compliance_readiness") * WEIGHTS["compliance_readiness"]
                        + F.col("channel_fit") * WEIGHTS["channel_fit"]))


def score_briefs(inputs: DataFrame) -> DataFrame:
    """Idea factors and their weighted subtotal (at most 30); missing input
    takes the neutral midpoint and is listed."""
    days = F.col("days_in_stage")
    rungs = [((days < bound) if op == "<" else (days <= bound), score) for op, bound, score in TIME_LADDER]
    return (inputs
            .withColumn("cogs_score", mapped("cogs_fit", COGS_SCORE, otherwise=NEUTRAL_SCORE))
            .withColumn("time_score", ladder((days.isNull(), NEUTRAL_SCORE), *rungs, otherwise=TIME_TOP))
            .withColumn("unknowns", flags_list((F.col("cogs_fit") == "UNKNOWN", "cogs_vs_target"),
                                               (days.isNull(), "time_in_stage")))
            .withColumn("brief_subtotal", F.col("cogs_score") * WEIGHTS["cogs_vs_target"]
                        + F.col("time_score") * WEIGHTS["time_in_stage"]))


def active_briefs(t, as_of: date) -> DataFrame:
    return v_idea_priority_inputs(t, as_of).where(F.col("stage").isin(OPEN_STAGES))


def v_pipeline_priority_candidates(t, as_of: date) -> DataFrame:
    """Four grains behind one tag: scored briefs, scored categories, the cost
    envelope, and the ingredient list in one self-declaring cell."""
    nothing = F.lit(None).cast("string").alias("id")
    briefs = score_briefs(active_briefs(t, as_of)).select(
        F.col("idea_id").alias("id"), "name",
        F.concat(F.coalesce("stage", F.lit("unknown")), F.lit("|"),
                 F.coalesce(F.col("days_in_stage").cast("string"), F.lit("unknown")), F.lit("|"),
                 pack("|", score_text("cogs_score"), score_text("time_score"), score_text("brief_subtotal"),
                      "unknowns")).alias("data"))
    cats = score_categories(v_category_market_signal(t, as_of)).select(
        nothing, F.col("category_name").alias("name"),
        F.concat(F.lit("ms="), F.col("market_signal").cast("string"),
                 F.lit("; cr="), F.col("compliance_readiness").cast("string"),
                 F.lit("; cf="), F.col("channel_fit").cast("string"),
                 F.lit("; cat_sub="), F.col("cat_subtotal").cast("string"),
                 F.lit("; units90="), F.coalesce(num_text("units_90d", 0), F.lit("none")),
                 F.lit("; growth_pct="), F.coalesce(num_text("growth_pct", 1), F.lit("no_baseline"))).alias("data"))
    envelope = cost_envelope(t).select(
        nothing, F.lit("portfolio cost envelope").alias("name"),
        F.concat(F.lit("cogs_min="), F.coalesce(num_text("lo", 0), F.lit("unknown")),
                 F.lit("; cogs_max="), F.coalesce(num_text("hi", 0), F.lit("unknown"))).alias("data"))
    # the ingredient list is one row per name, and one row that states how many there are
    names = (t.dim_ingredient.select(F.lower(F.trim("ingredient_name")).alias("data"))
             .where(F.col("data").isNotNull()).distinct())
    label = F.lit("ingredient master (already sourced)").alias("name")
    count = names.agg(F.count("*").alias("n")).select(
        nothing, label, F.concat(F.lit("count="), F.col("n").cast("string"), F.lit("; list=complete")).alias("data"))
    return tagged_union(BRIEF=briefs, CATEGORY=cats, ENVELOPE=envelope, INGREDIENT=count,
                        INGREDIENT_NAME=names.select(nothing, label, "data"))


def v_triage_similarity_candidates(t, as_of: date) -> DataFrame:
    """Five grains for similarity triage, closed by an end marker whose absence
    shows a cut."""
    ideas = t.dim_idea.select(F.col("idea_id").alias("id"), F.col("name").alias("nm"),
                              pack("|", "stage", num_text("target_cogs_inr", 5)).alias("d"))
    portfolio = product_facets(t).where("is_active").join(t.dim_category, "category_id").select(
        F.col("sku").alias("id"), F.col("display_name").alias("nm"),
        pack("|", "status", "category_name", num_text("total_cogs_inr", 0)).alias("d"))
    s = v_category_market_signal(t, as_of)
    cats = s.select(
        F.col("category_name").alias("id"), F.col("category_name").alias("nm"),
        F.concat(F.lit("competitor_products="),
                 F.coalesce(F.col("active_competitor_products").cast("string"), F.lit("not_comparable")),
                 F.lit("; competitors="),
                 F.coalesce(F.col("distinct_competitors").cast("string"), F.lit("not_comparable")),
                 F.lit("; active_skus="), F.coalesce(F.col("active_skus_in_category").cast("string"), F.lit("0")),
                 F.lit("; units_90d="), F.coalesce(num_text("units_90d", 0), F.lit("none")),
                 F.lit("; growth_pct="), F.coalesce(num_text("growth_pct", 1), F.lit("no_baseline"))).alias("d"))
    makers = t.dim_competitor.where("is_active").select("competitor_id", "category")
    rivals = top_n(t.dim_competitor_product.where("is_active").join(makers, "competitor_id", "left"),
                   ["category"], [F.asc("competitor_product_id")], 2).select(
        F.col("competitor_product_id").alias("id"), F.col("product_name").alias("nm"),
        pack("|", "competitor_id", "category").alias("d"))
    return tagged_union(**{"1_IDEA": ideas, "2_PORT": portfolio, "3_CAT": cats, "4_COMP": rivals,
                           "9_END": end_marker(t.spark)})


def end_marker(spark) -> DataFrame:
    mark = F.lit("END_OF_CANDIDATES")
    return spark.range(1).select(mark.alias("id"), mark.alias("nm"), F.lit("").alias("d"))


# ---- ranking ------------------------------------------------------------------------

def ingredient_score(share) -> F.col:
    """Share of needed ingredients already sourced -> 0..5, full marks at 80 %."""
    return F.when(share >= 0.8, F.lit(5.0)).otherwise(F.round(share * 5, 1))


def pipeline_rank(scored: DataFrame) -> DataFrame:
    """Priority = idea subtotal + category subtotal + ingredient factor x 4, with
    band and a rank without ties: later stage, then longer wait, then id (its
    last two characters first, which spreads a crowded score over many slices)."""
    scored = scored.withColumn("priority_score", F.round(
        F.col("brief_subtotal") + F.col("cat_subtotal")
        + F.col("ingredient_availability") * WEIGHTS["ingredient_availability"], 1))
    scored = scored.withColumn("priority_band", ladder((F.col("priority_score") >= BAND_HIGH, "HIGH"),
                                                       (F.col("priority_score") >= BAND_MEDIUM, "MEDIUM"),
                                                       otherwise="LOW"))
    scored = written_once(scored, "scored-briefs")
    levels = [-F.col("priority_score"), -F.coalesce("stage_rank", F.lit(0)),
              -F.coalesce("days_in_stage", F.lit(-1)), F.right("idea_id", F.lit(2))]
    return exact_rank(scored, [], levels, [F.asc("idea_id")], "rank")


def shortlist(ranked: DataFrame, size: int = 3) -> DataFrame:
    """The top ranks as one flat row; a missing rank reads 'NONE'."""
    cols = []
    for i in range(1, size + 1):
        hit = F.col("rank") == i
        cols += [F.coalesce(F.max(F.when(hit, F.col("name"))), F.lit("NONE")).alias(f"shortlist_{i}_name"),
                 F.coalesce(F.max(F.when(hit, F.col("category_name"))), F.lit("NONE")).alias(f"shortlist_{i}_category"),
                 F.coalesce(F.max(F.when(hit, F.col("priority_score").cast("string"))),
                            F.lit("NONE")).alias(f"shortlist_{i}_score"),
                 F.coalesce(F.max(F.when(hit, F.col("priority_band"))), F.lit("NONE")).alias(f"shortlist_{i}_band")]
    return ranked.where(F.col("rank") <= size).agg(*cols)


def name_tokens(c):
    return F.array_sort(F.array_distinct(F.filter(F.split(F.lower(F.trim(c)), "[^a-z0-9]+"), lambda w: w != "")))


SUBSET_WORDS = 10  # names of at most so many words meet in what they must share, longer ones in two rare words


def _name_keys(sets: DataFrame, threshold: float) -> DataFrame:
    """Meeting points (shared, lo, hi) of word sets (words, n): two sets of ``lo`` and ``hi`` words that
    reach the threshold have one in common.

    Such sets share ``need`` words or more. Up to ``SUBSET_WORDS`` words a key is any ``need`` words of
    the set, so that whoever meets there is similar; beyond it is any two of the rarest
    ``n - need + 2``, of which similar sets share two.
    """
    partner = F.explode(F.expr(f"sequence(int(ceil(n * {threshold}D - 1e-9D)), int(floor(n / {threshold}D + 1e-9D)))"))
    sized = (sets.withColumn("m", partner).withColumn("lo", F.least("n", "m")).withColumn("hi", F.greatest("n", "m"))
             .withColumn("need", F.expr(f"int(ceil({threshold}D / (1 + {threshold}D) * (n + m) - 1e-9D))")).drop("m"))
    picked = "transform(filter(sequence(1, int(pow(2, n)) - 1), b -> bit_count(b) = need), b -> array_join(filter(words, (w, i) -> getbit(b, i) = 1), ' '))"
    short = sized.where(F.col("hi") <= SUBSET_WORDS).withColumn("shared", F.explode(F.expr(picked)))

    long_names = sized.where(F.col("hi") > SUBSET_WORDS)
    freq = sets.select(F.explode("words").alias("w")).groupBy("w").agg(F.count("*").alias("f"))
    ordered = (sets.where(F.floor(F.col("n") / threshold + 1e-9) > SUBSET_WORDS).select("words", F.explode("words").alias("w")).join(freq, "w")
               .groupBy("words").agg(F.array_sort(F.collect_list(F.struct("f", "w"))).alias("rare")))
    two = """flatten(transform(slice(rare.w, 1, n - need + 2), (w, i) ->
                transform(slice(rare.w, i + 2, greatest(n - need - i, 0)), v -> concat_ws(' ', w, v))))"""
    rare = long_names.join(ordered, "words").withColumn("shared", F.explode(F.expr(two)))
    columns = ["words", "n", "shared", "lo", "hi"]
    return short.select(*columns).unionByName(rare.select(*columns))


def similar_names(names: DataFrame, name: str, threshold: float = 0.6) -> DataFrame:
    """Pairs of distinct names whose word sets overlap by at least ``threshold``
    (Jaccard), exactly.

    Names with equal word sets are compared as one and expanded at the end. Sets meet in what
    similar ones must share, see :func:`_name_keys`, never in a single word, so a common word
    forms no group and joined rows follow the similar pairs.
    """
    members = (names.select(F.col(name).alias("nm")).where(F.col(name).isNotNull()).distinct()
               .withColumn("words", name_tokens(F.col("nm"))).where(F.size("words") > 0))
    members = written_once(members, "name-sets")
    sets = members.select("words").distinct().withColumn("n", F.size("words"))
    keys = written_once(_name_keys(sets, threshold), "name-keys")
    left = keys.where("n = lo").select(F.col("words").alias("wa"), "shared", "lo", "hi")
    right = keys.where("n = hi").select(F.col("words").alias("wb"), "shared", "lo", "hi")
    both = F.size(F.array_intersect("wa", "wb"))
    pairs = (left.join(right, ["shared", "lo", "hi"]).where("lo < hi OR wa < wb").select("wa", "wb").distinct()
             .withColumn("similarity", F.round(safe_divide(both, F.size("wa") + F.size("wb") - both), 4))
             .where(F.col("similarity") >= threshold))
    across = (pairs.join(members.toDF("x", "wa"), "wa").join(members.toDF("y", "wb"), "wb")
              .select(F.least("x", "y").alias("name_a"), F.greatest("x", "y").alias("name_b"), "similarity"))
    equal = (members.toDF("name_a", "words").join(members.toDF("name_b", "words"), "words").where("name_a < name_b")
             .select("name_a", "name_b", F.lit(1.0).alias("similarity")))
    return across.unionByName(equal)
