"""Constants that results must share. Stated plainly, all in one place."""

# Holidays with a fixed date (month-day), used to derive the calendar.
FIXED_HOLIDAYS = ["0101", "0301", "0505", "0606", "0815", "1003", "1009", "1225"]

# Months of the base period of the visitor indices.
BASE_MONTHS = 12

# Seasonal multipliers of moves, January to December (in hundredths).
SEASON_MOVING = [85, 95, 125, 110, 105, 95, 90, 85, 120, 110, 100, 90]

# Yearly growth of the flow version (hundredths per year) and its base year.
FLOW_GROWTH = 2
FLOW_BASE_YEAR = 1995

# Derived features.
HOLIDAY_FLAG_MIN = 2
CLOSURE_PENALTY = 0.3
SIGNAL_WEIGHTS = {"rental_count": 0.5, "net_move": 0.01, "sales_chg_pct": 0.1}

# Forecast.
HORIZON = 3
Z_95 = 1.959963984540054
RIDGE = 1.0

# Decisions.
CHANNELS = [
    ("digital_capture", 25), ("partner_referrals", 20), ("b2b_outreach", 15),
    ("experiential_offer", 15), ("installation_buffer", 15), ("test_reserve", 10),
]
CONVERSION_RATE = 0.001
DEVIATION_LIMIT = 15.0
SALES_MOVE_PCT = 3.0
TOURISM_HIGH = 120.0
STABILITY_LOW, STABILITY_HIGH = 50.0, 80.0
SIGNAL_STRONG, SIGNAL_NORMAL = 50.0, 20.0
CITATION_CHARS = 300
CITATIONS = 3
