"""Fixed values.

Everything in this module is a value that must equal the reference's output for
results to be right: status and reason codes, check names and severities, gate
texts, code lists and the text formats accepted by the parsers. They are listed
plainly and in their natural order; nothing else in the package hard-codes them.
"""

from __future__ import annotations

# --- Fixed values: comparison statuses, in sort order 1..4 -------------------
MATCHED = "MATCHED"
MISMATCH = "MISMATCH"
CSV_ONLY = "CSV_ONLY"
QR_ONLY = "QR_ONLY"
STATUSES = (MATCHED, MISMATCH, CSV_ONLY, QR_ONLY)

# --- Fixed values: comparison reasons ----------------------------------------
VOTES_EQUAL = "VOTES_EQUAL"
VOTES_DIFFER = "VOTES_DIFFER"
MISSING_VOTE_VALUE = "MISSING_VOTE_VALUE"
CSV_CHOICE_MISSING = "CSV_CHOICE_MISSING"
QR_MISSING_IN_SCOPE = "QR_CHOICE_MISSING_FOR_IN_SCOPE_CSV_ROW"
CSV_OUTSIDE_SCOPE = "CSV_CONTEST_OUTSIDE_QR_SCOPE"

# --- Fixed values: verification source labels and record scopes -------------
CSV_SOURCE_LABEL = "COMELEC_TRANSMITTED_CSV"
QR_SOURCE_LABEL = "QR_PRE_TRANSMISSION"
SCOPE_COMPARISON = "CLUSTERED_PRECINCT_CONTEST_CANDIDATE"
SCOPE_REPORTING = "EXPECTED_CLUSTERED_PRECINCT"
SCOPE_STATUS_SUMMARY = "IN_SCOPE_CHOICE_LEVEL_VERIFICATION"
SCOPE_BY_PRECINCT = "IN_SCOPE_PRECINCT_VERIFICATION"
SCOPE_KPI = "PRECINCT_LEVEL_VERIFICATION_SUMMARY"
SCOPE_TIMELINE = "FIRST_QR_RECEIPT_PER_CLUSTERED_PRECINCT"
REPORTED = "REPORTED"
NOT_REPORTED = "NOT_REPORTED"

# --- Fixed values: environments and data status ------------------------------
PRODUCTION = "Production"
DATA_STATUS_PRODUCTION = "PRODUCTION"
DATA_STATUS_OTHER = "DEVELOPMENT_TEST"
SUBMISSION_ALL = "ALL_RECORDS"
SUBMISSION_CANONICAL = "CANONICAL"

# --- Fixed values: contest scope classification ------------------------------
REGION_WIDE_CONTEST_CODES = (
    "01295000", "01395000", "01495000", "01595000", "01695000", "01795000",
)
REGION_WIDE = "Region-wide"
LOCAL_DISTRICT = "Local district"
DEV_FALLBACK_SCOPE_CONTESTS = ("01295000", "01807001")

# --- Fixed values: geographic name overrides and verified aliases ------------
GEO_OVERRIDES = {
    "CITY OF COTABATO": "COTABATO CITY",
    "SPECIAL GEOGRAPHIC AREAS": "SPECIAL GEOGRAPHIC AREA",
}
GEO_ALIASES = {
    "TAGOLOAN": "TAGOLOAN II",
}

# --- Fixed values: header aliases of the precinct file ------------------------
PRECINCT_HEADER_ALIASES = {
    "PRV_NAME": "PROVINCE",
    "MUN_NAME": "MUNICIPALITY",
    "BRGY_NAME": "BARANGAY",
    "POLLPLACE": "POLLING_PLACE",
    "CLUSTERED_PREC": "CLUSTERED_PRECINCT",
}

# --- Fixed values: accepted reception-date layouts, tried in this order ------
# (Spark datetime patterns; one-digit month/day/hour/minute/second accepted)
RECEPTION_DATE_FORMATS = (
    "M-d-yyyy:H:m:s",
    "yyyy-M-d H:m:s",
    "M/d/yyyy H:m:s",
    "M/d/yyyy H:m",
    "yyyy-M-d'T'H:m:s",
    "yyyy-M-d",
)

# --- Fixed values: receipt-time layouts beside ISO-8601, month first ----------
INSTANT_FORMATS = (
    "M/d/yyyy H:m:s",
    "M/d/yyyy H:m",
    "M/d/yyyy",
    "M-d-yyyy H:m:s",
    "M-d-yyyy H:m",
    "M-d-yyyy",
    "yyyy/M/d H:m:s",
    "yyyy/M/d H:m",
    "yyyy/M/d",
)

# --- Fixed values: characters between the words of a header -------------------
HEADER_SEPARATORS = "-/_"

# --- Fixed values: characters that geographic names lose (upper-cased text) ---
GEO_NOT_KEPT = r"(?U)[^A-Z0-9\s]"

# --- Fixed values: flag and "active" tokens ----------------------------------
FLAG_TRUE = ("true", "1")
FLAG_FALSE = ("false", "0")
ACTIVE_TOKENS = ("TRUE", "1", "YES", "ACTIVE")

# --- Fixed values: ballot map labels -----------------------------------------
MAPPING_SOURCE_REGION_WIDE = "COMELEC_REGION_WIDE_VERIFIED"
MAPPING_SOURCE_DISTRICT = "APPROVED_DISTRICT_MAP"
CHOICE_REGION_WIDE = "REGION_WIDE"
CHOICE_DISTRICT = "DISTRICT"

# --- Fixed values: local time offset of the dashboards (UTC+8) --------------
LOCAL_TIME_ZONE = "+08:00"

# --- Fixed values: severities, check statuses, gate outcomes -----------------
BLOCKING = "BLOCKING"
WARNING = "WARNING"
INFO = "INFO"
PASS_STATUS = "PASS"
BLOCKED_STATUS = "BLOCKED"
REVIEW_STATUS = "REVIEW"
INFO_STATUS = "INFO"
ACTION_PASS = "No action required"
ACTION_BLOCKED = "Investigate before publishing"
ACTION_REVIEW = "Review and document discrepancy"
ACTION_INFO = "Monitor — election-in-progress information"
OVERALL_CHECK = "OVERALL QA STATUS"
OVERALL_BLOCKED = "BLOCKED"
OVERALL_WARNINGS = "READY_WITH_WARNINGS"
OVERALL_READY = "READY"
OVERALL_ACTION_BLOCKED = "Resolve all blocking issues before publishing."
OVERALL_ACTION_WARNINGS = "Review warnings before publishing."
OVERALL_ACTION_READY = "QA passed — ready to publish."
DECISION_BLOCKED = "DO_NOT_PUBLISH"
DECISION_REVIEW = "REVIEW_BEFORE_PUBLISH"
DECISION_READY = "READY_TO_PUBLISH"
GATE_ACTION_BLOCKED = "Resolve all blocking QA issues before publishing."
GATE_ACTION_REVIEW = "Review and document warnings before publishing."
GATE_ACTION_READY = "QA checks passed. Dataset is ready for publication."

# --- Fixed values: the check catalogue (key, display name, severity) ---------
CHECKS = (
    ("result_duplicates", "Result duplicates", BLOCKING),
    ("missing_result_precincts", "Precincts not yet in results", INFO),
    ("result_party_unmatched", "Result party unmatched", BLOCKING),
    ("result_candidate_unmatched", "Result candidate unmatched", BLOCKING),
    ("result_precinct_unmatched", "Result precinct unmatched", BLOCKING),
    ("repeated_contest_totals", "Repeated contest totals inconsistent", BLOCKING),
    ("acm_id_duplicates", "Duplicate ACM IDs", BLOCKING),
    ("acm_id_missing", "Missing ACM IDs", BLOCKING),
    ("result_value_invalid", "Invalid result numeric values", BLOCKING),
    ("reception_date_invalid", "Invalid reception dates", BLOCKING),
    ("registered_voter_invalid", "Invalid registered voter values", BLOCKING),
    ("required_value_blanks", "Required value blanks", BLOCKING),
    ("mobile_required_values", "Mobile required values invalid", BLOCKING),
    ("qr_orphan_er", "QR rows with unknown ER ID", BLOCKING),
    ("multiple_canonical_er", "Multiple canonical ERs per precinct", BLOCKING),
    ("duplicate_qr_choice", "Duplicate QR choices within ER", BLOCKING),
    ("ballot_map_duplicate_key", "Duplicate QR ballot mapping keys", BLOCKING),
    ("scope_readiness", "QR verification scope readiness", BLOCKING),
    ("unmapped_qr_choices", "Unmapped QR ballot choices", BLOCKING),
    ("qr_outside_scope", "Mapped QR contests outside configured scope", BLOCKING),
)

# --- Fixed values: issue codes ------------------------------------------------
DUPLICATE_RESULT_KEY = "DUPLICATE_RESULT_KEY"
PRECINCT_NOT_YET_IN_RESULTS = "PRECINCT_NOT_YET_IN_RESULTS"
PARTY_CODE_NOT_IN_MASTER = "PARTY_CODE_NOT_IN_MASTER"
CONTEST_CANDIDATE_KEY_NOT_IN_MASTER = "CONTEST_CANDIDATE_KEY_NOT_IN_MASTER"
PRECINCT_NOT_IN_MASTER = "PRECINCT_NOT_IN_MASTER"
INCONSISTENT_PREFIX = "INCONSISTENT_"
DUPLICATE_ACM_ID = "DUPLICATE_ACM_ID"
MISSING_ACM_ID = "MISSING_ACM_ID"
INVALID_PREFIX = "INVALID_"
UNPARSEABLE_RECEPTION_DATE = "UNPARSEABLE_RECEPTION_DATE"
RECEPTION_DATETIME_COLUMN_MISSING = "RECEPTION_DATETIME_COLUMN_MISSING"
INVALID_REGISTERED_VOTERS = "INVALID_REGISTERED_VOTERS"
REQUIRED_VALUE_BLANK = "REQUIRED_VALUE_BLANK"
ORPHAN_QR_ER_ID = "ORPHAN_QR_ER_ID"
MULTIPLE_CANONICAL_ER_PER_PRECINCT = "MULTIPLE_CANONICAL_ER_PER_PRECINCT"
DUPLICATE_QR_CHOICE = "DUPLICATE_QR_CHOICE"
DUPLICATE_BALLOT_MAP_KEY = "DUPLICATE_BALLOT_MAP_KEY"
MISSING_ER_ID = "MISSING_ER_ID"
MISSING_PRECINCT_ID = "MISSING_PRECINCT_ID"
INVALID_IS_DUPLICATE_FLAG = "INVALID_IS_DUPLICATE_FLAG"
BALLOTS_EXCEED_REGISTERED = "BALLOTS_COUNTED_EXCEEDS_REGISTERED_VOTERS"
MISSING_QR_ER_ID = "MISSING_QR_ER_ID"
MISSING_QR_RACE_CODE = "MISSING_QR_RACE_CODE"
INVALID_BALLOT_POSITION = "INVALID_BALLOT_POSITION"
INVALID_QR_VOTES = "INVALID_QR_VOTES"
NEGATIVE_QR_VOTES = "NEGATIVE_QR_VOTES"
PRODUCTION_SCOPE_MISSING = "PRODUCTION_SCOPE_MISSING"
SCOPE_CONTEST_UNKNOWN_IN_MASTER = "SCOPE_CONTEST_UNKNOWN_IN_MASTER"
SCOPE_CONTEST_HAS_NO_BALLOT_MAP = "SCOPE_CONTEST_HAS_NO_BALLOT_MAP"
QR_BALLOT_CHOICE_UNMAPPED = "QR_BALLOT_CHOICE_UNMAPPED"
MAPPED_QR_CONTEST_OUTSIDE_SCOPE = "MAPPED_QR_CONTEST_OUTSIDE_SCOPE"
