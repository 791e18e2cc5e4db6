"""Fixed values the results depend on: reason texts, placeholder rows and generator word lists."""

from __future__ import annotations

# --- fixed values: pipeline names, dead-letter reasons, ledger outcomes ---
CLAIM_PIPELINE = "fact_claim"
LINE_PIPELINE = "fact_claim_line"
CLAIM_SOURCE = "source.claims"
LINE_SOURCE = "source.claim_lines"

NO_MEMBER = "member not found for service date"
NO_PROVIDER = "provider not found for service date"
NO_SERVICE_DATE = "service date not in dim_date"
NO_PROCESSED_DATE = "processed date not in dim_date"
HEADER_REJECTED = "header rejected: "
NO_HEADER = "header not loaded"
NOT_PLACED = "line not loaded"
REASON_LENGTH = 200

LOADED = "loaded"
REJECTED = "rejected"
HELD = "held_with_header"
COLLAPSED = "collapsed"
CONFLICT = "conflict"
UNACCOUNTED = "unaccounted"

# --- fixed values: dates ---
OPEN_END = "9999-12-31"
UNKNOWN_START = "1900-01-01"
CALENDAR_START = "2020-01-01"
CALENDAR_END = "2030-12-31"
LAST_SERVICE_MONTH_END = "2026-09-30"

# --- fixed values: the placeholder row of every dimension ---
UNKNOWN_KEY = -1
UNKNOWN_ROWS = {
    "dim_plan": {
        "plan_key": -1, "plan_id": 0, "plan_code": "N/A", "plan_name": "Not Applicable",
        "plan_type": "N/A", "deductible": 0, "oop_max": 0, "coinsurance_pct": 0,
    },
    "dim_date": {
        "date_key": -1, "calendar_date": None, "year_number": 0, "quarter_number": 0, "month_number": 0,
        "month_name": "Not Applicable", "day_of_month": 0, "day_of_week": 0, "day_name": "Not Applicable",
        "week_of_year": 0, "is_weekend": False, "year_month": "N/A",
    },
    "dim_diagnosis": {
        "diagnosis_key": -1, "diagnosis_code": "N/A", "description": "Not Applicable",
        "category_code": "N/A", "category_name": "Not Applicable",
    },
    "dim_procedure": {
        "procedure_key": -1, "procedure_code": "N/A", "description": "Not Applicable",
        "category_name": "Not Applicable",
    },
    "dim_member": {
        "member_key": -1, "member_id": -1, "first_name": "Not Applicable", "last_name": "Not Applicable",
        "date_of_birth": None, "gender": "U", "plan_key": -1, "plan_id": 0, "state": "NA",
        "zip_code": "00000", "enrollment_date": UNKNOWN_START, "effective_start": UNKNOWN_START,
        "effective_end": OPEN_END, "is_current": True,
    },
    "dim_provider": {
        "provider_key": -1, "provider_id": -1, "npi": "0000000000", "provider_name": "Not Applicable",
        "provider_type": "Not Applicable", "specialty": "Not Applicable", "network_status": "Not Applicable",
        "city": "Not Applicable", "state": "NA", "network_effective_date": UNKNOWN_START,
        "effective_start": UNKNOWN_START, "effective_end": OPEN_END, "is_current": True,
    },
}

# --- fixed values: diagnosis chapter letters and names ---
CHAPTERS = {
    "A": "Infectious and parasitic diseases",
    "B": "Neoplasms",
    "C": "Endocrine and metabolic diseases",
    "D": "Mental and behavioral disorders",
    "E": "Diseases of the nervous system",
    "F": "Diseases of the eye",
    "G": "Diseases of the ear",
    "H": "Diseases of the circulatory system",
    "I": "Diseases of the respiratory system",
    "J": "Diseases of the digestive system",
    "K": "Diseases of the skin",
    "L": "Diseases of the musculoskeletal system",
    "M": "Diseases of the genitourinary system",
    "N": "Pregnancy and childbirth",
    "O": "Perinatal conditions",
    "P": "Congenital conditions",
    "Q": "Symptoms and abnormal findings",
    "R": "Factors influencing health status",
}

# --- fixed values: reference rows and word lists of the claims fixture ---
PLANS = [
    (1, "HMO-BAS", "HMO Basic", "HMO", 1500, 5000, 20),
    (2, "HMO-PLS", "HMO Plus", "HMO", 500, 3000, 10),
    (3, "PPO-STD", "PPO Standard", "PPO", 2000, 6500, 20),
    (4, "PPO-PRM", "PPO Premium", "PPO", 1000, 4500, 10),
    (5, "EPO-ESS", "EPO Essential", "EPO", 1000, 5000, 15),
    (6, "EPO-CHO", "EPO Choice", "EPO", 500, 3500, 10),
    (7, "HDHP-BRZ", "HDHP Bronze", "HDHP", 3500, 7000, 20),
    (8, "HDHP-SLV", "HDHP Silver", "HDHP", 2500, 6000, 10),
]
LOCATIONS = [
    (0, "Austin", "TX"), (1, "San Diego", "CA"), (2, "Miami", "FL"), (3, "Buffalo", "NY"),
    (4, "Chicago", "IL"), (5, "Pittsburgh", "PA"), (6, "Columbus", "OH"), (7, "Atlanta", "GA"),
    (8, "Raleigh", "NC"), (9, "Detroit", "MI"),
]
FIRST_NAMES = ["Ava", "Liam", "Mia", "Noah", "Zoe", "Ethan", "Lila", "Owen", "Nora", "Jude", "Aria", "Leo"]
LAST_NAMES = [
    "Nguyen", "Patel", "Garcia", "Kim", "Singh", "Brown", "Martinez", "Johnson", "Davis", "Wilson",
    "Anderson", "Thomas",
]
GENDERS = ["F", "M", "F", "M", "X"]
RESERVED_PROVIDER = "Northstar Family Medicine"
PRACTICE_NAMES = [
    "Avery", "Blake", "Cameron", "Drew", "Ellis", "Finley", "Gray", "Harper", "Indigo", "Jordan",
]
PRACTICE_KINDS = ["Clinic", "Medical Group", "Specialty", "Practice", "Associates"]
SPECIALTIES = [
    "Cardiology", "Orthopedics", "Pediatrics", "Internal Medicine", "Radiology", "Emergency Medicine",
    "General Surgery", "Oncology", "Family Medicine", "Psychiatry", "Dermatology", "Ophthalmology",
]
DENIAL_REASONS = [
    "Medical necessity", "Duplicate claim", "Timely filing", "Not a covered benefit", "Missing authorization",
]
# procedure sequence number up to which a category reaches
PROCEDURE_CATEGORIES = [
    (1500, "Evaluation and Management"), (2500, "Anesthesia"), (5000, "Surgery"), (6500, "Radiology"),
    (7500, "Pathology and Laboratory"), (8500, "Medicine"),
]
ALLOWED_SHARE = "0.72"
PAID_SHARE = "0.85"
