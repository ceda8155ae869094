"""Fixed values. Results depend on them, so they are stated plainly here."""

from datetime import date

# --- dates the sample queries are evaluated at -------------------------------
AS_OF_SALES = date(2001, 8, 1)
AS_OF_INVENTORY = date(2001, 6, 15)
AS_OF_CAMPAIGN = date(2001, 7, 31)
AS_OF_REVIEWS = date(2024, 1, 31)
EVENT_SHIFT_DAYS = 8218  # 2024-01-31 -> 2001-08-01
DAY_INDEX_EPOCH = date(2026, 1, 1)
OPEN_END = date(9999, 12, 31)

# --- product naming ----------------------------------------------------------
FAMILY_PREFIX_RX = r"(?i)^(Dessert|Mithai|Snack|Savoury|Fudge)\s*-\s*"
FAMILY_SIZE_RX = r"(?i)[-\s]*\d+\s*(gm|gms|g|kg|ml)\b\.?"

# --- idea stages and scores --------------------------------------------------
STAGE_RANK = {"Capture": 1, "Triage": 2, "Feasibility": 3, "Pipeline": 4, "Development": 5}
CLOSED_STAGES = ["Rejected", "Launch"]
OPEN_STAGES = ["Capture", "Triage", "Feasibility"]
COGS_SCORE = {"INSIDE": 5.0, "BELOW": 4.0, "ABOVE": 2.0}
NEUTRAL_SCORE = 2.5
TIME_LADDER = [("<", 15, 0.0), ("<=", 30, 1.0), ("<=", 45, 2.0), ("<=", 60, 3.0), ("<", 90, 4.0)]
TIME_TOP = 5.0
WEIGHTS = {
    "market_signal": 5,
    "cogs_vs_target": 4,
    "ingredient_availability": 4,
    "compliance_readiness": 3,
    "channel_fit": 2,
    "time_in_stage": 2,
}
BAND_HIGH = 70
BAND_MEDIUM = 45

# --- ingredient name tags: (tag, pattern, exclusion) ---------------------------
INGREDIENT_TAGS = [
    ("NUT", r"almond|cashew|walnut|pistachio|hazelnut|peanut|pecan|macadamia|badam|kaju|pista", ""),
    ("DAIRY", r"milk|ghee|paneer|khoya|mawa|curd|dahi|cream|malai|whey|casein|cheese|rabri",
     r"coconut milk|almond milk|soy milk|oat milk|rice milk|cashew milk|plant milk"),
    ("GLUTEN", r"wheat|maida|atta|suji|semolina|rava|barley|\brye\b|malt|vermicelli|biscuit|wafer|bread", ""),
    ("REFINED_FLOUR", r"maida|refined flour|biscuit|cookie crumb|wafer|corn ?flour", ""),
    ("SOY", r"\bsoy|soya|tofu", ""),
    ("EGG", r"\begg|albumen", ""),
    ("REFINED_SUGAR",
     r"^sugar$|caster|icing|granulated|glucose|invert syrup|corn syrup|dextrose|maltodextrin", ""),
    ("WHOLE_SWEETENER", r"jaggery|\bgur\b|honey|\bdates?\b|date paste|maple|coconut sugar", ""),
    ("PALM_OR_HYDROGENATED",
     r"palm oil|palm fat|palm kernel|palm stearin|palmolein|palm shortening|hydrogenated"
     r"|interesterified|vanaspati|shortening|margarine", ""),
    ("ARTIFICIAL",
     r"artificial|synthetic|aspartame|sucralose|acesulfame|saccharin|benzoate|sorbate|colour|preservative", ""),
    ("ANIMAL_DERIVED", r"gelatin|carmine|\blard\b|tallow|rennet|isinglass|shellac", ""),
]

# --- formulation rules: (rule, claim pattern, banned tag, source) ---------------
FORMULATION_RULES = [
    ("vegan", r"\bvegan\b", "DAIRY", "claim"),
    ("gluten_free", r"\bgluten[ -]?free\b", "GLUTEN", "claim"),
    ("nut_free", r"\bnut[ -]?free\b", "NUT", "claim"),
    ("soy_free", r"\bsoy[ -]?free\b", "SOY", "claim"),
    ("egg_free", r"\begg[ -]?free\b|\beggless\b", "EGG", "claim"),
    ("no_added_sugar", r"\blow[ -]?sugar\b|\bsugar[ -]?free\b|\bno added sugar\b|\bdiabetic\b",
     "WHOLE_SWEETENER", "claim"),
    ("brand_no_refined_sugar", "", "REFINED_SUGAR", "brand"),
    ("brand_no_refined_flour", "", "REFINED_FLOUR", "brand"),
    ("brand_no_palm", "", "PALM_OR_HYDROGENATED", "brand"),
    ("brand_no_artificial", "", "ARTIFICIAL", "brand"),
    ("brand_no_animal", "", "ANIMAL_DERIVED", "brand"),
]

# --- complaint wording -----------------------------------------------------------
OPS_RX = r"late|delay|deliver|packag|spillage|wrong|missing"
PRODUCT_RX = r"quality|taste|fresh|expir"
LATE_TERMS = ["Late", "late", "Delay", "delay"]
CONDITION_TERMS = ["Packag", "packag", "Spillage", "spillage"]
WRONG_MISSING_TERMS = ["Wrong", "wrong", "Missing", "missing"]
OPS_TERMS = ["Late", "late", "Delay", "delay", "Deliver", "deliver", "Packag", "packag",
             "Spillage", "spillage", "Wrong", "wrong", "Missing", "missing"]
ROOT_CAUSE_CLASSES = [("OPERATIONS", ["Wrong", "Missing", "Late", "Deliver", "Packag"]),
                      ("PRODUCT", ["Quality", "Taste", "Fresh", "Expir"])]
OPS_CATEGORIES = [("Wrong item", ["Wrong", "wrong"]),
                  ("Missing item", ["Missing", "missing"]),
                  ("Bad condition / packaging", ["Packag", "packag", "Spillage", "spillage"]),
                  ("Late delivery", ["Late", "late", "Delay", "delay", "Deliver", "deliver"])]
OPS_BAR = 3

# --- campaign rules ---------------------------------------------------------------
MIN_AD_ORDERS = 5
CRITICAL_SPEND = 200
ROI_BOUNDS = [0.75, 1.0, 1.5, 2.5, 10.0]
REDUCE_PCT = 30
CAUTIOUS_PCT = 15
CONFIDENT_PCT = 30
HIGH_SPEND = 5000
LOW_SPEND = 1000
PROOF_SPEND = 500
PROOF_ORDERS = 20
SURE_ORDERS = 20
CAMPAIGN_ACTIONS = {
    "no_spend": "cannot_evaluate", "thin": "not_enough_data", "stop": "stop",
    "reduce": "reduce_budget", "hold": "maintain", "cautious": "increase_budget_cautious",
    "confident": "increase_budget_confident", "outlier": "validate_outlier",
}
SEASONAL_ACTIONS = {
    "no_spend": "cannot_evaluate", "thin": "not_enough_data", "stop": "avoid_repeat",
    "reduce": "repeat_reduced_budget", "hold": "repeat_same_budget",
    "cautious": "repeat_increased_budget_cautious",
    "confident": "repeat_increased_budget_confident", "outlier": "validate_before_repeating",
}
SEASON_DAYS_BEFORE = 42
SEASON_DAYS_AFTER = 7
SEASON_MILESTONES = [(-42, "Planning"), (-35, "Creative production"), (-28, "Landing page ready"),
                     (-21, "Email setup"), (-14, "Ads live"), (-7, "Reminder campaign"),
                     (0, "Peak promotions"), (7, "Performance review")]
EVENT_TYPES = ["Global", "National", "Cultural", "Religious", "Marketing/Seasonal", "Regional", "Industry"]

# --- review clusters, prices, renewals ----------------------------------------------
SPAN_DAYS = 14
SPAN_MIN_REVIEWS = 3
LOW_STARS = 3
PRICE_GAP_HIGH_PCT = 15.0
RENEWAL_DAYS = 60
REPORT_MAX_AGE_DAYS = 365

# --- indicators: id -> (target, comparison) ----------------------------------------
KPI_TARGETS = {
    "kpi_listing_ready_share": (90.0, "gte"),
    "kpi_blocking_gaps_per_sku": (1.0, "lte"),
    "kpi_allergen_underdeclaration": (0.0, "lte"),
    "kpi_claim_substantiation": (90.0, "gte"),
    "kpi_contradicted_claims": (0.0, "lte"),
    "kpi_own_recipe_share": (80.0, "gte"),
    "kpi_panel_basis_known": (100.0, "gte"),
    "kpi_mandatory_nutrients": (100.0, "gte"),
    "kpi_wastage_risk": (0.0, "eq"),
    "kpi_expiry_value_at_risk": (25000.0, "lte"),
    "kpi_expired_stock_units": (0.0, "eq"),
    "kpi_low_stock_rate": (5.0, "lte"),
    "kpi_critical_low_count": (0.0, "eq"),
    "kpi_sell_through_gap": (0.0, "lte"),
    "kpi_avg_store_rating": (4.0, "gte"),
    "kpi_low_rating_share": (15.0, "lte"),
    "kpi_ops_complaint_share": (30.0, "lte"),
    "kpi_stores_over_bar": (0.0, "eq"),
    "kpi_near_expiry_complaints": (10.0, "lte"),
    "kpi_forecast_accuracy": (80.0, "gte"),
    "kpi_forecast_coverage": (3.0, "gte"),
    "kpi_blended_roi": (1.5, "gte"),
    "kpi_zero_return_spend": (0.0, "lte"),
    "kpi_ads_conversion_gap": (5.0, "lte"),
    "kpi_margin_pct": (60.0, "gte"),
    "kpi_pipeline_aging": (45.0, "lte"),
    "kpi_stalled_briefs": (0.0, "eq"),
    "kpi_brief_scorable_share": (90.0, "gte"),
}

# --- goals: (goal, parent) and (goal, indicator, aggregation) -----------------------
GOALS = [
    ("grow_profitably", None),
    ("reduce_stock_wastage", "grow_profitably"),
    ("improve_customer_satisfaction", "grow_profitably"),
    ("plan_and_spend_on_data", "grow_profitably"),
    ("launch_new_products_faster", "grow_profitably"),
    ("reduce_expiring_stock", "reduce_stock_wastage"),
    ("avoid_stock_outs", "reduce_stock_wastage"),
    ("remove_expired_stock", "reduce_stock_wastage"),
    ("dont_sell_near_expiry_stock", "improve_customer_satisfaction"),
    ("reduce_low_ratings", "improve_customer_satisfaction"),
    ("improve_forecast_accuracy", "plan_and_spend_on_data"),
    ("cut_wasted_ad_spend", "plan_and_spend_on_data"),
    ("improve_ad_conversion", "plan_and_spend_on_data"),
    ("decide_on_pending_ideas", "launch_new_products_faster"),
    ("complete_new_product_data", "launch_new_products_faster"),
]
GOAL_KPIS = [
    ("reduce_expiring_stock", "kpi_wastage_risk", "sum"),
    ("reduce_expiring_stock", "kpi_expiry_value_at_risk", "sum"),
    ("avoid_stock_outs", "kpi_low_stock_rate", "avg"),
    ("avoid_stock_outs", "kpi_critical_low_count", "sum"),
    ("remove_expired_stock", "kpi_expired_stock_units", "sum"),
    ("dont_sell_near_expiry_stock", "kpi_near_expiry_complaints", "avg"),
    ("dont_sell_near_expiry_stock", "kpi_avg_store_rating", "avg"),
    ("reduce_low_ratings", "kpi_low_rating_share", "avg"),
    ("reduce_low_ratings", "kpi_avg_store_rating", "avg"),
    ("improve_forecast_accuracy", "kpi_forecast_accuracy", "avg"),
    ("improve_forecast_accuracy", "kpi_forecast_coverage", "min"),
    ("cut_wasted_ad_spend", "kpi_blended_roi", "avg"),
    ("cut_wasted_ad_spend", "kpi_zero_return_spend", "sum"),
    ("improve_ad_conversion", "kpi_ads_conversion_gap", "avg"),
    ("decide_on_pending_ideas", "kpi_pipeline_aging", "avg"),
    ("decide_on_pending_ideas", "kpi_stalled_briefs", "sum"),
    ("complete_new_product_data", "kpi_brief_scorable_share", "avg"),
]
