"""Fixed values.

Thresholds, labels, column names and rates that results depend on. They are
domain constants: changing one changes the meaning of a result column.
"""

from __future__ import annotations

# ---- ladders: (input column, comparison, ((bound, label), ...), otherwise) ----
LADDERS = {
    "credit_score_bucket": (
        "credit_score",
        ">=",
        ((750, "Excellent"), (700, "Good"), (650, "Fair"), (600, "Poor")),
        "Very Poor",
    ),
    "utilization_category": ("credit_utilization_ratio", "<", ((0.3, "Low"), (0.6, "Medium")), "High"),
    "credit_experience": ("credit_history_months", ">=", ((60, "Experienced"), (24, "Moderate")), "Limited"),
    "loan_term_category": ("loan_term_months", "<=", ((24, "Short"), (60, "Medium")), "Long"),
    "interest_rate_bucket": ("interest_rate", "<", ((9, "Low"), (12, "Medium")), "High"),
    "loan_amount_bucket": (
        "loan_amount",
        "<",
        ((100_000, "Small"), (500_000, "Medium"), (2_000_000, "Large")),
        "Very Large",
    ),
    "age_group": ("age", "<", ((25, "18-24"), (35, "25-34"), (45, "35-44"), (55, "45-54")), "55+"),
    "income_bracket": (
        "monthly_income",
        "<",
        ((30_000, "Low"), (60_000, "Middle"), (100_000, "Upper-Middle")),
        "High",
    ),
    "risk_rating": (
        "default_probability",
        "<",
        ((0.1, "Very Low"), (0.25, "Low"), (0.5, "Medium"), (0.75, "High")),
        "Very High",
    ),
}
DPD_CURRENT = "Current"
DPD_LADDER = ("current_dpd", "<=", ((30, "DPD-30"), (60, "DPD-60"), (90, "DPD-90")), "DPD-90+")

# ---- value maps ----
EMPLOYMENT_STABILITY = {"Salaried": 100, "Professional": 90, "Self-Employed": 70}
EMPLOYMENT_STABILITY_OTHER = 60
INCOME_MULTIPLIER = {"Salaried": 1.0, "Self-Employed": 1.2, "Business": 1.5, "Professional": 1.8}
SEASONS = {"Spring": (3, 4, 5), "Summer": (6, 7, 8), "Fall": (9, 10, 11)}
SEASON_OTHER = "Winter"

# ---- combined risk score ----
SCORE_FLOOR, SCORE_CEILING, SCORE_STEP = 300, 900, 6
DPD_FULL_SCALE = 180
RISK_WEIGHTS = {"score": 0.4, "dpd": 0.3, "dti": 0.2, "late": 0.1}

# ---- pricing and labels ----
BASE_RATE, BASE_SCORE, SCORE_POINTS_PER_PERCENT = 8.5, 750, 50
RATE_MIN, RATE_MAX = 7.0, 18.0
DPD_PROBABILITY_SPAN = 450
DEFAULT_DPD, WATCH_DPD, WATCH_SCORE, WATCH_LATE = 90, 30, 650, 2
WRITTEN_OFF = "Written-Off"
LGD_RANGE = (0.40, 0.70)

# ---- hashing ----
HASH_SEPARATOR = "||"
NULL_MARK = "\\0"

# ---- quality report wording: (check, detail suffix) ----
NULL_CHECK_COLUMNS = ("customer_id", "loan_id", "loan_amount", "credit_score")
NULL_CHECK_NAME, NULL_CHECK_DETAIL = "Null check - {}", "nulls found"
RULE_CHECKS = {
    "score_range": ("Credit score range (300-900)", "invalid scores"),
    "dpd_sign": ("DPD non-negative", "negative values"),
    "amount_sign": ("Loan amount positive", "invalid amounts"),
    "date_logic": ("Valid date logic", "invalid dates"),
}
CRITICAL_FEATURES = (
    "credit_score_bucket",
    "loan_to_annual_income",
    "emi_burden_pct",
    "dpd_category",
    "combined_risk_score",
    "pd_proxy",
)

# ---- dashboard ----
TARGET_DEFAULT_RATE = 8.5
DPD_EDGES = (0, 1, 30, 60, 90, 180)
DPD_EDGE_LABELS = ("Current", "1-30", "31-60", "61-90", "90+")
SCORE_BINS = 30
HIGH_RISK = "High"
HIGH_RISK_ROWS = 20
HIGH_RISK_COLUMNS = ("loan_id", "customer_id", "loan_amount", "current_dpd", "credit_score", "risk_category")
SUMMARY_COLUMNS = ("age", "monthly_income", "credit_score", "loan_amount", "interest_rate", "current_dpd")

# ---- table layout ----
BRONZE_PARTITIONS = ("loan_status",)
SILVER_PARTITIONS = ("risk_category", "loan_purpose")
AUDIT_COLUMNS = ("ingestion_timestamp", "source_file", "record_hash")

# ---- training feature lists ----
TARGET = "is_default"
FULL_NUMERIC = (
    "credit_score", "credit_history_months", "credit_utilization_ratio",
    "loan_amount", "loan_term_months", "interest_rate", "ltv_ratio", "dti_ratio",
    "loan_to_annual_income", "emi_burden_pct", "total_debt_burden",
    "monthly_income", "existing_emi", "existing_loans", "per_capita_income",
    "current_dpd", "max_dpd_12m", "late_payments_12m", "payment_history_pct",
    "payment_consistency_score", "payment_behavior_score",
    "age", "dependents", "family_size", "employment_stability_score",
    "combined_risk_score", "pd_proxy", "loan_vintage_months", "days_since_disbursement",
)
FULL_CATEGORICAL = (
    "employment_type", "education", "marital_status", "city_tier", "loan_purpose",
    "loan_status", "credit_score_bucket", "utilization_category", "loan_term_category",
    "interest_rate_bucket", "dpd_category", "age_group", "income_bracket",
)
RECORDED_NUMERIC = (
    "credit_score", "loan_amount", "monthly_income", "interest_rate", "loan_term_months",
    "current_dpd", "max_dpd_12m", "late_payments_12m", "payment_history_pct",
    "existing_emi", "existing_loans", "ltv_ratio", "dti_ratio", "age", "dependents",
    "credit_history_years", "emi_burden_pct", "total_debt_burden",
    "payment_consistency_score", "payment_behavior_score", "per_capita_income",
    "employment_stability_score", "combined_risk_score", "loan_vintage_months",
    "days_since_disbursement", "loan_maturity_pct",
)
RECORDED_CATEGORICAL = ("employment_type", "education", "city_tier", "marital_status")
SMOKE_NUMERIC = (
    "credit_score", "loan_amount", "monthly_income",
    "current_dpd", "late_payments_12m", "dti_ratio",
)
SMOKE_CATEGORICAL = ("employment_type", "loan_purpose")
# columns the default label is computed from, or that restate it
LABEL_LEAKS = ("loan_status", "dpd_category", "current_dpd", "combined_risk_score", "pd_proxy",
               "payment_behavior_score")

# ---- boosted-tree settings ----
TREE_DEPTH, LEARNING_RATE, ROUNDS, SMOKE_ROUNDS, PATIENCE = 6, 0.1, 200, 100, 20
TEST_SHARE, SPLIT_SEED = 0.2, 42
