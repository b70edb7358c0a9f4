"""Fixed values that must equal the reference for right results.

They are stated here plainly, together, in their natural order.
"""

# ---- fixed values: lead status domain and funnel stage order -------------------------
STATUS_ORDER = [
    ("NEW", 1),
    ("OPEN", 2),
    ("IN_PROGRESS", 3),
    ("UNQUALIFIED", 4),
    ("ATTENDED", 5),
    ("CONNECTED", 6),
    ("WORKING", 7),
    ("CLOSED", 8),
]
STATUS_OTHER_RANK = 9
CONVERTED_STATUS = "CLOSED"

# ---- fixed values: accepted values of the data tests ---------------------------------
ACCEPTED_LEAD_STATUS = [
    "NEW", "OPEN", "IN_PROGRESS", "UNQUALIFIED", "ATTENDED", "CONNECTED", "WORKING",
    "CLOSED", "UNASSIGNED",
]
ACCEPTED_INDUSTRY = [
    "Technology", "Healthcare", "Finance", "Manufacturing", "Retail", "Education",
    "Real Estate", "Consulting", "Energy", "Media", "E-commerce", "Aerospace",
    "Telecommunications", "Transportation", "Hospitality", "unknown",
]

# ---- fixed values: funnel buckets of the stage-conversion report ---------------------
FUNNEL_BUCKETS = [
    ("1_leads", ["NEW", "OPEN"]),
    ("2_qualified", ["IN_PROGRESS"]),
    ("3_engaged", ["ATTENDED", "CONNECTED"]),
    ("4_working", ["WORKING"]),
    ("5_converted", ["CLOSED"]),
]
FUNNEL_OTHER_BUCKET = "0_unassigned"

# ---- fixed values: defaults of the staging layer -------------------------------------
DEFAULT_LEAD_STATUS = "UNASSIGNED"
DEFAULT_SOURCE = "unknown"
UNKNOWN = "unknown"
NO_CAMPAIGN = "N/A"
UNASSIGNED_STAGE = "unassigned"
EPOCH = "1970-01-01 00:00:00"

# ---- fixed values: error types and messages of the validator -------------------------
ERR_VALIDATION = "ValidationError"
ERR_MISSING_EMAIL = "MissingEmail"
MSG_CSV_MISSING_EMAIL = "Field 'email' is required and must be valid"
MSG_API_MISSING_EMAIL = "Field 'properties.email' is required and cannot be empty"
# labels counted by the error analytics, and the map from produced types to them
LABEL_VALIDATION = "validation_error"
LABEL_MISSING = "missing_field"
LABEL_FORMAT = "invalid_format"
MSG_INT = "value is not a valid integer"
# the API property that holds a contact column of another name
API_NAMES = {"company_name": "company", "annual_revenue": "annualrevenue", "created_at": "createdate"}
ERROR_LABELS = {ERR_VALIDATION: LABEL_VALIDATION, ERR_MISSING_EMAIL: LABEL_MISSING}

# ---- fixed values: e-mail syntax (dot-atom local part, dotted domain) ----------------
EMAIL_PATTERN = (
    r"^[A-Za-z0-9!#$%&'*+/=?^_`{|}~-]+([.][A-Za-z0-9!#$%&'*+/=?^_`{|}~-]+)*"
    r"@([A-Za-z0-9]([A-Za-z0-9-]*[A-Za-z0-9])?[.])+[A-Za-z]([A-Za-z0-9-]*[A-Za-z0-9])$"
)

# ---- fixed values: source shapes -----------------------------------------------------
CSV_COLUMNS = [
    "contact_id", "email", "first_name", "last_name", "company_name", "job_title",
    "annual_revenue", "created_at",
]
API_PROPERTIES = [
    "email", "firstname", "lastname", "createdate", "company", "jobtitle", "industry",
    "annualrevenue", "numberofemployees", "hs_analytics_source",
    "hs_analytics_source_data_1", "leadstatus",
]
# generator-only property names read as fall-backs (status) or ignored (stage)
API_EXTRA_PROPERTIES = ["hs_lead_status", "lifecyclestage"]

# ---- fixed values: Unicode White_Space code points (what trimming strips) ------------
# The set Java's (?U)\s matches: TAB..CR, SPACE, NEL, NBSP, OGHAM SPACE MARK,
# EN QUAD..HAIR SPACE, LINE / PARAGRAPH SEPARATOR, NARROW NBSP, MEDIUM MATH SPACE,
# IDEOGRAPHIC SPACE.
WHITE_SPACE_RANGES = [
    (0x0009, 0x000D), (0x0020, 0x0020), (0x0085, 0x0085), (0x00A0, 0x00A0),
    (0x1680, 0x1680), (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F),
    (0x205F, 0x205F), (0x3000, 0x3000),
]
WHITE_SPACE = "".join(chr(c) for lo, hi in WHITE_SPACE_RANGES for c in range(lo, hi + 1))

# ---- fixed values: freshness of the landing tables (hours) ---------------------------
RAW_FRESHNESS_WARN_H = 6
RAW_FRESHNESS_ERROR_H = 24
QUARANTINE_FRESHNESS_WARN_H = 12

# ---- fixed values: container names of the batch store --------------------------------
CONTAINER_RAW = "raw"
CONTAINER_PROCESSED = "processed"
CONTAINER_INVALID = "invalid"
