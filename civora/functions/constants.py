"""Fixed values.

These must equal the reference's values for identical output (labels,
thresholds, vocabularies). They are kept together, in their natural order,
as plain text. Logical column names use this library's neutral vocabulary.
"""

# --- Fixed values: tiers -------------------------------------------------------
TIER_HIGH = 0.70
TIER_MEDIUM = 0.40
RISK_TIER_LABELS = ("high", "medium", "low")
READINESS_TIER_LABELS = ("ready", "in_progress", "not_ready")

# --- Fixed values: ordinal maps ------------------------------------------------
RISK_LEVELS = {"Low": 0, "Medium": 1, "High": 2, "Critical": 3}
COOPERATION_LEVELS = {"Highly Cooperative": 4, "Cooperative": 3, "Neutral": 2,
                      "Uncooperative": 1}

# --- Fixed values: churn explanation labels ------------------------------------
CHURN_FEATURE_LABELS = {
    "recency_days": "No recent donation",
    "frequency": "Low donation frequency",
    "avg_gap_days": "Long gaps between donations",
    "total_value_log": "Low total giving",
    "avg_value_log": "Declining average gift size",
    "donation_trend": "Decreasing donation amounts",
    "tenure_days": "Short supporter tenure",
    "num_campaigns": "Low campaign engagement",
    "ever_recurring": "Not a recurring donor",
}

# --- Fixed values: case explanation labels -------------------------------------
CONCERN_LABELS = {
    "health_trend": "Declining health scores",
    "incidents_last_30d": "Recent incidents filed",
    "open_incidents": "Unresolved incidents",
    "sessions_with_concerns": "Concerns flagged in sessions",
    "overdue_plans": "Overdue intervention plans",
    "visits_with_safety_concerns": "Safety concerns noted during family visit",
    "avg_attendance": "Low school attendance",
    "plan_completion_rate": "Low intervention plan completion",
    "sessions_last_30d": "Few recent counseling sessions",
}
STRENGTH_LABELS = {
    "sessions_with_progress": "Progress noted in counseling sessions",
    "avg_edu_progress": "Education progress improving",
    "edu_trend": "Education progress trending upward",
    "positive_visit_rate": "Positive family visitation outcomes",
    "avg_health_score": "Stable health scores",
    "plan_completion_rate": "Intervention plans on track",
    "avg_family_cooperation": "Good family cooperation",
}

# --- Fixed values: profile labels (flag column -> label, in order) -------------
ABUSE_FLAG_LABELS = [
    ("sub_cat_physical_abuse", "Physical Abuse"),
    ("sub_cat_sexual_abuse", "Sexual Abuse"),
    ("sub_cat_trafficked", "Trafficked"),
    ("sub_cat_osaec", "OSAEC"),
    ("sub_cat_child_labor", "Child Labor"),
    ("sub_cat_cicl", "CICL"),
]
NO_SUBTYPE = "No Sub-type"
LABEL_SEP = " · "          # " · "
AGE_BANDS = ("Under 10", "10–13", "14–17", "18+", "Unknown")   # 10–13, 14–17

# --- Fixed values: session frequency bands -------------------------------------
FREQ_BANDS = ("1–3", "4–6", "7+")          # right-closed (0,3], (3,6], (6,99]
FREQ_EDGES = (0, 3, 6, 99)
FREQ_BAND_TO_INT = {"1–3": 2, "4–6": 5, "7+": 8}
FREQ_BAND_DEFAULT = "4–6"
FREQ_INT_DEFAULT = 5

# --- Fixed values: confidence tiers --------------------------------------------
CONFIDENCE_CASES = (15, 5)        # high >= 15, medium >= 5
CONFIDENCE_CONTENT = (30, 10)     # high >= 30, medium >= 10

# --- Fixed values: content recommendations -------------------------------------
PLATFORMS = ["Facebook", "Instagram", "TikTok", "WhatsApp", "LinkedIn"]
COMBO_COLS = ["post_type", "media_type", "content_topic", "sentiment_tone",
              "has_call_to_action", "call_to_action_type", "features_resident_story"]
MIN_SAMPLES_PER_COMBO = 3
MIN_SLICE_ROWS = 5
CONVERTS_FACTOR = 1.5
NOISE_ENGAGEMENT = 0.12
NOISE_FACTOR = 0.8

# --- Fixed values: impact statements -------------------------------------------
OUTCOME_LABELS = {"education": "average education progress",
                  "health": "average health and wellbeing scores"}
DIRECTION_WORDS = {True: "improvement in", False: "decline in"}

# --- Fixed values: intervention composite weights ------------------------------
W_HEALTH, W_EDU, W_INCIDENTS = 0.40, 0.35, 0.25
MIN_CLUSTER_SIZE = 5
ROSTER_MIN_SESSIONS = 3

# --- Fixed values: rare categories, gates --------------------------------------
RARE_CUTOFF = 0.05
OTHER = "Other"
SITE_ALERT_RATE = 0.30
STATEMENT_COVERAGE_MIN = 0.60

# --- Fixed values: row-specific churn explanation rules (notebook form) --------
ROW_FACTOR_TEXT = {
    "recency_frequency_ratio": "Recency/frequency ratio is elevated",
    "frequency": "Only made 1–2 donations (low loyalty)",
    "ever_recurring": "Not a recurring donor",
    "overdue_flag": "Silent longer than their historical average gap",
}
ROW_FACTOR_RECENCY_DAYS = 60
ROW_FACTOR_RATIO = 30
ROW_FACTOR_FALLBACK = "Insufficient history for detailed explanation"

# --- Fixed values: row-specific case concern rules (notebook form) -------------
ROW_CONCERN_TEXT = {
    "high_sev_last_30d": "High-severity incident filed in the last 30 days",
    "incidents_last_30d": "Multiple recent incidents (last 30 days)",
    "health_30d_change": "Declining health score over the past month",
    "health_trend_slope": "Negative trend in health scores over time",
    "days_since_session": "Extended gap since last social worker session",
    "edu_trend_slope": "Declining education progress trend",
    "plans_on_hold": "Intervention plans on hold",
    "unresolved_incidents": "Unresolved incidents on record",
}
ROW_CONCERN_SESSION_GAP = 14
