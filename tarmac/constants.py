"""Labels, lookup tables and limits that results must agree on."""

# --- fixed values: carrier names by the first two characters of a flight id ---
CARRIER_BY_PREFIX = {
    "AI": "Air India",
    "SJ": "SpiceJet",
    "6F": "IndiGo",
    "UK": "Vistara",
    "G8": "Go First",
}

# --- fixed values: one spelling per carrier in reports ---
CARRIER_SPELLING = {
    "AIR INDIA": "Air India",
    "SPICEJET": "SpiceJet",
    "INDIGO": "IndiGo",
    "VISTARA": "Vistara",
    "GO FIRST": "Go First",
}

# --- fixed values: report labels of payment methods ---
PAYMENT_LABEL = {
    "NETBANKING": "Net Banking",
    "UPI": "UPI",
    "CARD": "Credit/Debit Card",
    "CREDIT_CARD": "Credit/Debit Card",
    "DEBIT_CARD": "Credit/Debit Card",
}
DEFAULT_PAYMENT_LABEL = "UPI"

# --- fixed values: departure slots in display order, (label, first hour, hour after the last) ---
SLOTS_WITH_HOURS = [
    ("Early Morning (05-09)", 5, 9),
    ("Morning (09-12)", 9, 12),
    ("Afternoon (12-17)", 12, 17),
    ("Evening (17-21)", 17, 21),
]
NIGHT_WITH_HOURS = "Night (21-05)"
SLOTS_PLAIN = [
    ("Early Morning", 5, 9),
    ("Morning", 9, 12),
    ("Afternoon", 12, 17),
    ("Evening", 17, 21),
]
NIGHT_PLAIN = "Night"
UNKNOWN_LABEL = "Unknown"

# --- fixed values: age groups in display order ---
AGE_GROUPS = ["Under 18", "18-30", "31-45", "46-60", "60+"]

# --- fixed values: text that stands for a missing value ---
NULL_TOKEN_UPPER = "NAN"
NULL_TOKEN_LOWER = "nan"
CARRIER_UNKNOWN = "UNKNOWN"
CARRIER_PLACEHOLDERS = ["NAN", "", "NONE"]
CARRIER_UNRESOLVED_IN_REPORTS = ["Unknown", "UNKNOWN", "NAN", ""]
HASH_MISSING = "HASH_MISSING"

# --- fixed values: thresholds ---
MAX_JOURNEY_MINUTES = 1440
DELAY_FACTOR = 1.30
HISTOGRAM_BINS = 40
TOP_FLYERS = 20
TOP_ROUTES = 10

# --- fixed values: statuses kept apart in reports ---
STATUS_KEPT = ["CONFIRMED", "CANCELLED"]
STATUS_DEFAULT = "CONFIRMED"

SLOT_ORDER_WITH_HOURS = [s[0] for s in SLOTS_WITH_HOURS] + [NIGHT_WITH_HOURS]
SLOT_ORDER_PLAIN = [s[0] for s in SLOTS_PLAIN] + [NIGHT_PLAIN]

# Rows of one key that a single task may hold; larger keys are split (see operators.skew).
ROWS_PER_TASK = 5_000_000
