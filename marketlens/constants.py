"""Fixed business values.

FIXED VALUES: the entries below must equal the source business rules for the
results to match (region list, seed rows, currencies, UTC offsets, multipliers,
holiday multipliers, DQ rates, accepted values, freshness thresholds). They are
stated plainly, in natural order.
"""

from __future__ import annotations

# --- FIXED VALUES: regions (seed rows: region, continent, timezone_offset) ---
REGIONS = ["us-east", "us-west", "eu-west", "eu-central", "apac-au", "apac-jp"]

SEED_REGIONS = [
    ("us-east", "North America", -5),
    ("us-west", "North America", -8),
    ("eu-west", "Europe", 0),
    ("eu-central", "Europe", 1),
    ("apac-au", "Asia Pacific", 10),
    ("apac-jp", "Asia Pacific", 9),
]

# --- FIXED VALUES: primary trading currency per region ---
REGION_CURRENCY = {
    "us-east": "USD",
    "us-west": "USD",
    "eu-west": "EUR",
    "eu-central": "EUR",
    "apac-au": "AUD",
    "apac-jp": "JPY",
}

# --- FIXED VALUES: fixed UTC offsets in hours (no DST) ---
REGION_UTC_OFFSETS = {
    "us-east": -5,
    "us-west": -8,
    "eu-west": 0,
    "eu-central": 1,
    "apac-au": 10,
    "apac-jp": 9,
}

# --- FIXED VALUES: volume model ---
BASE_ORDERS_PER_REGION_PER_HOUR = 200

# local hour 0..23
INTRADAY_MULTIPLIERS = [
    0.10, 0.07, 0.05, 0.04, 0.04, 0.06,
    0.15, 0.30, 0.55, 0.70, 0.80, 0.90,
    1.05, 1.00, 0.85, 0.85, 0.95, 1.15,
    1.45, 1.65, 1.55, 1.35, 0.95, 0.55,
]

# weekday, 0 = Monday .. 6 = Sunday
DOW_MULTIPLIERS = [0.85, 0.90, 0.95, 0.95, 1.05, 1.20, 1.10]

# month 1..12
MONTHLY_MULTIPLIERS = [0.80, 0.85, 0.95, 0.95, 1.00, 0.90, 0.85, 0.90, 1.00, 1.05, 1.35, 1.40]

VOLUME_NOISE_PCT = 15

# --- FIXED VALUES: holiday multipliers per region ---
# Named days: thanksgiving (4th Thursday of November), black_friday (+1 day),
# cyber_monday (+4 days), memorial_day (last Monday of May), labor_day (1st
# Monday of September), fixed dates as month-day, golden_week = 04-29..05-05
# ramping 0.5 + 0.1 * i.
HOLIDAY_MULTIPLIERS = {
    "us": {
        "black_friday": 4.0,
        "cyber_monday": 3.0,
        "thanksgiving": 1.5,
        "memorial_day": 1.3,
        "labor_day": 1.2,
        "christmas_eve": 2.0,
        "christmas_day": 0.3,
        "new_years_eve": 1.5,
        "new_years_day": 0.6,
    },
    "eu-west": {
        "black_friday": 2.5,
        "cyber_monday": 2.0,
        "christmas_eve": 2.0,
        "christmas_day": 0.3,
        "boxing_day": 2.5,
        "new_years_eve": 1.3,
        "new_years_day": 0.5,
    },
    "eu-central": {
        "black_friday": 2.2,
        "cyber_monday": 1.8,
        "christmas_eve": 2.2,
        "christmas_day": 0.3,
        "new_years_eve": 1.3,
        "new_years_day": 0.5,
    },
    "apac-au": {
        "black_friday": 2.0,
        "cyber_monday": 1.8,
        "click_frenzy": 2.5,
        "christmas_eve": 1.8,
        "christmas_day": 0.2,
        "boxing_day": 3.5,
        "new_years_eve": 1.2,
        "new_years_day": 0.5,
    },
    "apac-jp": {
        "singles_day": 3.0,
        "black_friday": 1.5,
        "super_sale": 2.0,
        "christmas_eve": 1.5,
        "christmas_day": 0.8,
        "new_years_eve": 0.4,
        "new_years_day": 0.3,
    },
}

# Golden Week (apac-jp only): seven days from 04-29, multiplier 0.5 + 0.1 * day index
GOLDEN_WEEK_REGION = "apac-jp"
GOLDEN_WEEK_START = (4, 29)
GOLDEN_WEEK_DAYS = 7
GOLDEN_WEEK_FIRST = 0.5
GOLDEN_WEEK_STEP = 0.1

# calendar group used by each region
HOLIDAY_GROUP = {
    "us-east": "us",
    "us-west": "us",
    "eu-west": "eu-west",
    "eu-central": "eu-central",
    "apac-au": "apac-au",
    "apac-jp": "apac-jp",
}

# fixed month-day holidays
FIXED_HOLIDAY_DATES = {
    "christmas_eve": (12, 24),
    "christmas_day": (12, 25),
    "boxing_day": (12, 26),
    "new_years_eve": (12, 31),
    "new_years_day": (1, 1),
    "singles_day": (11, 11),
    "click_frenzy": (11, 13),
    "super_sale": (6, 15),
}

# --- FIXED VALUES: data-quality injection rates (configured reference rates) ---
DQ_RATES = {
    "duplicate_order_rate": 0.02,
    "null_customer_rate": 0.01,
    "negative_revenue_rate": 0.005,
    "revenue_mismatch_rate": 0.01,
    "orphaned_items_rate": 0.005,
    "invalid_currency_rate": 0.003,
}

# --- FIXED VALUES: accepted values ---
ORDER_STATUSES = ["pending", "confirmed", "shipped", "delivered", "returned"]
CUSTOMER_TIERS = ["bronze", "silver", "gold"]
EVENT_TYPES = ["impression", "click", "purchase"]

# --- FIXED VALUES: freshness (hours) and tolerances ---
FRESHNESS_WARN_HOURS = 2
FRESHNESS_ERROR_HOURS = 6
RECENT_ROWS_WINDOW_HOURS = 2
RECONCILIATION_TOLERANCE = 0.01

# Surrogate keys: our stand-in for NULL and the separator between key parts
SURROGATE_NULL = "<null key>"
SURROGATE_SEPARATOR = "-"
