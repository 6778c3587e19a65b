"""Fixed values that must equal the published behaviour for results to match.

Everything in this module is data, stated plainly and in its natural order; the code
that uses it lives elsewhere.
"""

from __future__ import annotations

# --- fixed values: RFM segment patterns over the two-character cell "<R><F>" --------
SEGMENT_PATTERNS = [
    ("[1-2][1-2]", "Hibernating"),
    ("[1-2][3-4]", "At Risk"),
    ("[1-2]5", "Can't Lose Them"),
    ("3[1-2]", "About to Sleep"),
    ("33", "Need Attention"),
    ("[3-4][4-5]", "Loyal Customers"),
    ("41", "Promising"),
    ("51", "New Customers"),
    ("[4-5][2-3]", "Potential Loyalists"),
    ("5[4-5]", "Champions"),
]

# --- fixed values: recommended action per segment -----------------------------------
SEGMENT_ACTIONS = {
    "Champions": "Reward; early access, referrals, VIP perks.",
    "Loyal Customers": "Upsell higher-value items; ask for reviews.",
    "Potential Loyalists": "Membership/loyalty offers to deepen the habit.",
    "New Customers": "Onboarding support; build the second-order habit.",
    "Promising": "Targeted offers and brand awareness.",
    "Need Attention": "Limited-time offers on past favourites.",
    "About to Sleep": "Reactivate with relevant recommendations.",
    "At Risk": "Win-back campaign; personalised reorders.",
    "Can't Lose Them": "Aggressive win-back; they were valuable.",
    "Hibernating": "Low-cost reactivation; otherwise let lapse.",
}

# --- fixed values: dashboard segment order (healthiest first) -----------------------
HEALTH_ORDER = [
    "Champions", "Loyal Customers", "Potential Loyalists",
    "New Customers", "Promising", "Need Attention", "About to Sleep",
    "At Risk", "Can't Lose Them", "Hibernating",
]

# --- fixed values: segment health band ----------------------------------------------
SEGMENT_HEALTH = {
    "Champions": "Grow", "Loyal Customers": "Grow", "Potential Loyalists": "Grow",
    "New Customers": "Nurture", "Promising": "Nurture", "Need Attention": "Nurture",
    "About to Sleep": "Rescue", "At Risk": "Rescue", "Can't Lose Them": "Rescue",
    "Hibernating": "Dormant",
}

# --- fixed values: loyalty band thresholds on reorder_rate --------------------------
LOYALTY_HIGH = 0.62
LOYALTY_MEDIUM = 0.56

# --- fixed values: pipeline parameters ----------------------------------------------
RFM_BANDS = 5
SEED = 42
TEST_SIZE = 0.25
MIN_HISTORY_ORDERS = 3
PRODUCT_MIN_PURCHASES = 20
PRODUCT_TOP_K = 200
STICKY_MIN_PURCHASES = 100
STICKY_TOP_K = 8
PROPENSITY_TOP_K = 10
GAP_MIN, GAP_MAX = 0, 30
PRICE_NOISE_LOW, PRICE_NOISE_HIGH = 0.5, 4.0
PRICE_TIERS = 7
PRICE_BASE = 2
PRICE_CENTS = "0.99"
PERMUTATION_REPEATS = 5

# --- fixed values: the 14 model features, in order ----------------------------------
FEATURES = [
    "u_total_orders", "u_avg_basket", "u_avg_dspo", "u_reorder_rate",
    "p_total_purchases", "p_reorder_rate", "p_unique_users", "p_avg_cart_pos",
    "up_orders", "up_avg_cart_pos", "up_order_rate", "up_orders_since_last",
    "up_tenure_orders", "up_purchase_rate",
]

# --- fixed values: boosted-trees settings -------------------------------------------
GBT_ROUNDS = 300
GBT_RATE = 0.08
GBT_DEPTH = 6
GBT_PENALTY = 1.0
GBT_LEAVES = 31
GBT_LEAF_ROWS = 20
GBT_BINS = 255
GBT_HELD = 0.1
GBT_HELD_ABOVE = 10_000
GBT_PATIENCE = 10
