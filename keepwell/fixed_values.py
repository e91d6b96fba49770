"""Fixed values.

Labels, thresholds and text formats below are part of the result contract:
consumers filter and group on them, so they are stated once, as plain text.
Every function that uses one also takes it as an argument.
"""

# --- domains -----------------------------------------------------------------
COMPLETED = "Completed"
REFUND_STATUSES_N = ("Refunded", "Returned", "Cancelled")
REFUND_STATUSES_P = ("Refunded", "Returned")
ECOMMERCE = "Ecommerce"
IN_STORE = "In-Store"
LOYALTY_TIERS = ("Bronze", "Silver", "Gold", "Platinum")
NON_MEMBER = "Non-Member"
RISK_BANDS = ("High", "Medium", "Low")
SOURCE_ECOMMERCE = "Postgres Ecommerce"
SOURCE_POS = "POS"
NEVER_PURCHASED_DAYS = 9999
ACTIVITY_WINDOWS = (30, 90)
CHURN_AFTER_DAYS = 90
LABEL_NOISE_RATE = 0.12

# --- segments ----------------------------------------------------------------
SEGMENT_BY_TIER = {
    "Platinum": "VIP",
    "Gold": "High-Value",
    "Silver": "Growing",
    "Bronze": "Standard",
}
SEGMENT_OLD_NON_MEMBER = "At-Risk Non-Member"
SEGMENT_NEW_NON_MEMBER = "New Non-Member"
SEGMENT_OTHER = "Unknown"
NEW_CUSTOMER_DAYS = 365

# --- score card (notebook variant): (strictly greater than, points) ------------
RECENCY_POINTS = ((180, 40), (90, 25), (60, 15), (30, 5))
# (at most, points)
FREQUENCY_POINTS = ((0, 30), (1, 20), (3, 10))
# (strictly greater than, points)
REFUND_POINTS = ((0.3, 20), (0.15, 10))
TIER_POINTS = {"Bronze": 10, "Silver": 5}
# (at least, band)
SCORE_BANDS = ((60, "High"), (30, "Medium"))
PROBABILITY_BANDS = ((0.6, "High"), (0.3, "Medium"))
LOWEST_BAND = "Low"

REASON_RECENCY_N = "Long time since last purchase"
REASON_FREQUENCY_N = "Low purchase frequency"
REASON_REFUND_N = "High refund/return rate"
REASON_NONE_N = "Low engagement signals"
SECOND_FREQUENCY_N = "Declining transaction frequency"
SECOND_REFUND_N = "Quality or satisfaction concerns"
SECOND_TIER_N = "Low loyalty tier"
SECOND_NONE_N = "Needs re-engagement"
ACTION_BY_BAND_N = {
    "High": "Immediate intervention: personalized retention offer",
    "Medium": "Proactive outreach: re-engagement campaign",
    "Low": "Monitor and maintain: loyalty rewards",
}

# --- additive score (pipeline variant) -----------------------------------------
REASON_GAP_P = "Extended purchase gap (180+ days)"
REASON_NONE_P = "No recent engagement"
SECOND_FREQUENCY_P = "Low purchase frequency"
SECOND_REVENUE_P = "Low customer lifetime value"
SECOND_REFUND_P = "High return rate"
SECOND_NONE_P = "Limited engagement"
ACTION_BY_BAND_P = {
    "High": "Send re-engagement campaign with 15% discount",
    "Medium": "Send personalized product recommendations",
    "Low": "Continue loyalty rewards program",
}

# --- deployed model scores ------------------------------------------------------
REASON_GAP_ML = "Extended purchase gap (180+ days)"
REASON_INACTIVE_ML = "No recent engagement (90+ days)"
REASON_NONE_ML = "Declining engagement"
SECOND_FREQUENCY_ML = "Low purchase frequency"
SECOND_REVENUE_ML = "Low revenue decline"
SECOND_REFUND_ML = "High refund rate"
SECOND_NONE_ML = "Limited engagement"

# --- text formats, notebook variant: missing parts take the given default -------
SUMMARY_N = (
    "{loyalty_tier} tier customer with ${total_revenue} lifetime value. Prefers "
    "{preferred_channel} shopping in {favorite_category}. Last purchase: "
    "{days_since_last_purchase} days ago."
)
SUMMARY_DEFAULTS_N = {
    "loyalty_tier": "Standard",
    "preferred_channel": "mixed channels",
    "favorite_category": "various categories",
}
NEXT_ACTION_N = {
    "High": (
        "URGENT: Win-back campaign. Customer showing high churn risk. Recommend immediate "
        "personalized outreach with exclusive offer in {favorite_category}. Assign to retention specialist."
    ),
    "Medium": (
        "Re-engagement needed. Send targeted email campaign featuring {favorite_category} "
        "with loyalty points incentive via {preferred_channel}."
    ),
    "Low": (
        "Maintain engagement. Continue personalized recommendations in {favorite_category}. "
        "Celebrate loyalty milestones and offer early access to new arrivals."
    ),
}
NEXT_ACTION_DEFAULTS_N = {
    "High": {"favorite_category": "preferred category"},
    "Medium": {"favorite_category": "best-selling items", "preferred_channel": "preferred channel"},
    "Low": {"favorite_category": "favorite category"},
}
TOP_TIERS = ("Gold", "Platinum")
OFFER_TOP_TIER_N = "30% off + 2x points on next purchase in {favorite_category}"
OFFER_N = {
    "High": "20% off + free shipping in {favorite_category}",
    "Medium": "15% off + bonus loyalty points in {favorite_category}",
    "Low": "Early access to new arrivals in {favorite_category} + 500 bonus points",
}
OFFER_DEFAULTS_N = {
    "High": {"favorite_category": "any category"},
    "Medium": {"favorite_category": "selected categories"},
    "Low": {"favorite_category": "your favorite category"},
}
MESSAGE_N = {
    "High": (
        "Hi {full_name}, we miss you! As a valued {loyalty_tier} member, "
        "here's an exclusive offer just for you."
    ),
    "Medium": (
        "Hello {full_name}, we have new arrivals in {favorite_category}! "
        "Check them out with your special discount."
    ),
    "Low": (
        "Hi {full_name}, thank you for being a loyal customer! "
        "Enjoy exclusive early access and bonus rewards."
    ),
}
MESSAGE_DEFAULTS_N = {
    "High": {"loyalty_tier": "customer"},
    "Medium": {"favorite_category": "categories you love"},
    "Low": {},
}

# --- text formats, pipeline variant: missing parts are left out -------------------
SUMMARY_P = "{full_name} is a {loyalty_tier} member with $ {total_revenue} in lifetime revenue."
NEXT_ACTION_P = {
    "High": "Immediate re-engagement: Send 15% discount via preferred channel",
    "Medium": "Nurture: Send category recommendations and loyalty perk",
    "Low": "Maintain: Continue rewards and early access to new products",
}
OFFER_P = {
    "High": "15% off your next {favorite_category} purchase",
    "Medium": "Free shipping on next order + 2x loyalty points",
    "Low": "VIP early access to new arrivals",
}
OFFER_DEFAULT_CATEGORY_P = "store"
MESSAGE_P = {
    "High": "Hi {full_name} - we miss you! Here's 15% off to welcome you back.",
    "Medium": "Hi {full_name} - check out our latest {favorite_category} selections.",
    "Low": "Hi {full_name} - as a valued {loyalty_tier} member, enjoy early access.",
}

# --- model features --------------------------------------------------------------
NUMERIC_FEATURES = (
    "points_balance",
    "customer_tenure_days",
    "days_since_last_purchase",
    "transactions_last_30d",
    "transactions_last_90d",
    "revenue_last_30d",
    "revenue_last_90d",
    "avg_order_value",
    "refund_return_rate",
)
CATEGORICAL_FEATURES = ("loyalty_tier", "preferred_channel", "favorite_category")
LABEL = "churn_label_proxy"
UNKNOWN_CATEGORY = "Unknown"
BOX_PLOT_FEATURES = (
    "days_since_last_purchase",
    "transactions_last_90d",
    "revenue_last_90d",
    "refund_return_rate",
)
SPLIT_SHARES = (("train", 0.70), ("validation", 0.15), ("test", 0.15))
SPLIT_SEED = 42

# Limits of the reasons in variant N: points of a part of the score card from which it is named.
RECENCY_NAMED_N = 25
FREQUENCY_NAMED_N = 20
REFUND_NAMED_N = 10
SECOND_FREQUENCY_NAMED_N = 10
BRONZE_TIER = "Bronze"

# Limits and points of the additive score in variant P.
LONG_GAP_DAYS_P = 180
GAP_DAYS_P = 90
FEW_TRANSACTIONS_P = 5
LOW_REVENUE_P = 500
LEAST_REVENUE_P = 100
MANY_REFUNDS_P = 3
LONG_GAP_POINTS_P = 40
GAP_POINTS_P = 20
FEW_TRANSACTIONS_POINTS_P = 15
LOW_REVENUE_POINTS_P = 15
MANY_REFUNDS_POINTS_P = 10
MOST_POINTS_P = 100

# Limits of the reasons beside model scores.
LONG_GAP_DAYS_ML = 180
GAP_DAYS_ML = 90
FEW_TRANSACTIONS_ML = 3
LOW_REVENUE_ML = 200
HIGH_REFUND_RATE_ML = 0.1
