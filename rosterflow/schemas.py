"""Column lists, table schemas and fixed values of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Names, codes, patterns and messages that results must carry.
# ---------------------------------------------------------------------------

PROVIDER_COLUMNS = [
    "ssa_state_county_code",
    "name_of_physician_or_mid_level_practitioner",
    "npi",
    "specialty",
    "specialty_code",
    "contract_type",
    "provider_street_address",
    "provider_city",
    "provider_state",
    "provider_zip_code",
    "accepts_new_patients",
    "medical_group_affiliation",
    "uses_cms_ma_contract_amendment",
    "letter_of_intent",
    "accuracy_confidence",
]

FACILITY_COLUMNS = [
    "ssa_state_county_code",
    "facility_name",
    "npi",
    "specialty",
    "specialty_code",
    "facility_street_address",
    "facility_city",
    "facility_state",
    "facility_zip_code",
    "number_of_beds",
    "letter_of_intent",
    "accuracy_confidence",
]

ORG_PROVIDER_COLUMNS = [
    "ssa_state_county_code",
    "provider_name",
    "npi",
    "specialty",
    "provider_specialty_code",
    "contract_type",
    "street_address",
    "city",
    "state_code",
    "zip_code",
    "accepts_new_patients",
    "medical_group_affiliation",
    "uses_cms_ma_contract_amendment",
    "letter_of_intent",
    "accuracy_confidence",
]

ORG_FACILITY_COLUMNS = [
    "ssa_state_county_code",
    "facility_name",
    "npi",
    "specialty",
    "facility_specialty_code",
    "street_address",
    "city",
    "state_code",
    "zip_code",
    "number_of_beds",
    "letter_of_intent",
    "accuracy_confidence",
]

SUBMISSION_COLUMNS = {
    "provider": PROVIDER_COLUMNS,
    "facility": FACILITY_COLUMNS,
    "org_provider": ORG_PROVIDER_COLUMNS,
    "org_facility": ORG_FACILITY_COLUMNS,
}

REQUIRED_COLUMNS = {
    "provider": [
        "ssa_state_county_code",
        "name_of_physician_or_mid_level_practitioner",
        "npi",
        "specialty_code",
        "provider_street_address",
        "provider_city",
        "provider_state",
        "provider_zip_code",
    ],
    "facility": [
        "ssa_state_county_code",
        "facility_name",
        "npi",
        "specialty_code",
        "facility_street_address",
        "facility_city",
        "facility_state",
        "facility_zip_code",
    ],
}

ADDRESS_COLUMN = {"provider": "provider_street_address", "facility": "facility_street_address"}

# Specialty codes that hold when the reference table has none for the year.
FALLBACK_SPECIALTY_CODES = {
    "provider": [f"{i:03d}" for i in range(1, 30)],
    "facility": [f"{i:03d}" for i in range(40, 54)],
}

ACCURACY_VALUES = ["high", "medium", "low"]
YES_VALUES = ["Y", "YES", "TRUE", "1"]
NO_VALUES = ["N", "NO", "FALSE", "0"]
ACUTE_INPATIENT_CODE = "040"
PO_BOX_PATTERN = r"\b(?:p\.?\s*o\.?\s*box|post\s*office\s*box|po\s*box)\b"
PCT_BENEFICIARIES_REQUIRED = 90
ERROR_MESSAGE_LENGTH = 500
STUCK_AFTER_MINUTES = 15

MSG_MISSING_COLUMNS = "Missing required columns: "
MSG_SSA = "Invalid or unknown SSA State/County code: "
MSG_NPI = "NPI must be 10 digits"
MSG_SPECIALTY = {
    "provider": "Invalid provider specialty code: ",
    "facility": "Invalid facility specialty code: ",
}
MSG_ADDRESS_BLANK = "Address is required"
MSG_ADDRESS_PO_BOX = "P.O. Box is not allowed; geocodable street address required"
MSG_BEDS = "Number of Beds is required and must be > 0 for Acute Inpatient Hospitals (040)"
MSG_LOI = "Letter of Intent must be blank for non-applicant submissions"
MSG_ACCURACY = "Accuracy Confidence must be High, Medium, Low, or blank"
MSG_DUPLICATE = "Duplicate row (NPI + SSA code + specialty code)"
MSG_DAMAGED = "Quoted value is not closed"
MSG_BENEFICIARY = "BENEFICIARY file processing is not yet implemented"
MSG_UNKNOWN_TYPE = "Unknown file_type: "
MSG_UNEXPECTED = "Unexpected processing error: "
MSG_UNSUPPORTED = "Unsupported file type: "
MSG_NO_GEOID = "County boundary file must contain GEOID column"

SHEET_MIN_PROVIDER = "Minimum Provider #s"
SHEET_MIN_FACILITY = "Minimum Facility #s"
SHEET_TD_PROVIDER = "Provider Time & Distance"
SHEET_TD_FACILITY = "Facility Time & Distance"
SHEET_CON = "Certificate of Need"

MIN_COUNT_ID_COLUMNS = [
    "county",
    "st",
    "county_state",
    "ssacd",
    "total_beneficiaries",
    "county_designation",
    "pct_95_base_population_ratio",
    "beneficiaries_required_to_cover",
]
TIME_DISTANCE_ID_COLUMNS = ["county", "st", "county_state", "ssacd", "county_designation"]

GAZETTEER_COLUMN_MAP = [
    ("geoid", "geoid"),
    ("name", "name"),
    ("intptlat", "intptlat"),
    ("intptlong", "intptlong"),
    ("aland", "aland_sqmeters"),
    ("awater", "awater_sqmeters"),
    ("aland_sqmi", "aland_sqmi"),
    ("awater_sqmi", "awater_sqmi"),
]

REFERENCE_TABLES = ["county", "specialty_type", "time_distance_standard", "minimum_number_standard", "con_credit"]

FILE_TYPES = ["PROVIDER", "FACILITY", "BENEFICIARY"]
FILE_STATUSES = ["PENDING", "PROCESSING", "COMPLETED", "FAILED"]

# ---------------------------------------------------------------------------
# Table schemas
# ---------------------------------------------------------------------------


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "binary": T.BinaryType(),
    "strings": T.ArrayType(T.StringType()),
    "properties": T.MapType(T.StringType(), T.StringType()),
}


def table_schema(columns: str) -> T.StructType:
    """Schema from ``name type`` pairs; needs no session, unlike Spark's own parser."""
    pairs = [c.split() for c in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


SHEET_ROWS = table_schema("path string, source_year int, sheet string, row_idx bigint, cells strings")

COUNTY = table_schema(
    "ssa_county_code string, contract_year int, county_name string, state_code string, county_type string,"
    " total_medicare_beneficiaries bigint, con_state boolean"
)
SPECIALTY_TYPE = table_schema(
    "specialty_code string, contract_year int, specialty_name string, category string, telehealth_eligible boolean"
)
TIME_DISTANCE_STANDARD = table_schema(
    "ssa_county_code string, specialty_code string, contract_year int, max_time_minutes bigint,"
    " max_distance_miles bigint, pct_beneficiaries_required int, is_customized boolean"
)
MINIMUM_NUMBER_STANDARD = table_schema(
    "ssa_county_code string, specialty_code string, contract_year int, min_providers_required bigint,"
    " min_beds_required bigint, provider_ratio double, base_population_ratio_95th_pct double"
)
CON_CREDIT = table_schema("ssa_county_code string, specialty_code string, contract_year int")

_PROVIDER_TYPES = {"accepts_new_patients": "boolean", "uses_cms_ma_contract_amendment": "boolean"}
PROVIDER_HSD = table_schema(
    ", ".join(f"{c} {_PROVIDER_TYPES.get(c, 'string')}" for c in PROVIDER_COLUMNS) + ", source_year int"
)
FACILITY_HSD = table_schema(
    ", ".join(f"{c} {'bigint' if c == 'number_of_beds' else 'string'}" for c in FACILITY_COLUMNS) + ", source_year int"
)
ORG_PROVIDERS = table_schema(
    "id string, organization_id string, source_file_id string, ssa_state_county_code string, provider_name string,"
    " npi string, provider_specialty_code string, contract_type string, street_address string, city string,"
    " state_code string, zip_code string, latitude double, longitude double, medical_group_affiliation string,"
    " specialty string, accepts_new_patients boolean, uses_cms_ma_contract_amendment boolean,"
    " letter_of_intent boolean, accuracy_confidence string"
)
ORG_FACILITIES = table_schema(
    "id string, organization_id string, source_file_id string, ssa_state_county_code string, specialty string,"
    " facility_specialty_code string, npi string, number_of_beds bigint, facility_name string, street_address string,"
    " city string, state_code string, zip_code string, letter_of_intent boolean, accuracy_confidence string,"
    " latitude double, longitude double"
)
ZCTA_GAZETTEER = table_schema(
    "geoid string, name string, intptlat double, intptlong double, aland_sqmeters bigint, awater_sqmeters bigint,"
    " aland_sqmi double, awater_sqmi double, source_year int"
)
BOUNDARY_FEATURES = table_schema("path string, properties properties, srid int, geom binary")
COUNTY_BOUNDARIES = table_schema("geoid string, name string, source_year int, geom binary")
ORG_FILES = table_schema(
    "id string, file_type string, organization_id string, uploaded_by_id string, original_name string,"
    " mime_type string, size_bytes bigint, s3_bucket string, s3_key string, status string, error_message string,"
    " created_at timestamp, updated_at timestamp"
)
STATUS_LOG = table_schema(
    "file_id string, status string, error_message string, updated_at timestamp, batch_id bigint, seq bigint"
)
ISSUES = table_schema(
    "source_file string, row_index bigint, severity string, field string, message string, check_no int"
)

DECLARED_KEYS = {
    "county": ["ssa_county_code", "contract_year"],
    "specialty_type": ["specialty_code", "contract_year"],
    "time_distance_standard": ["ssa_county_code", "specialty_code", "contract_year"],
    "minimum_number_standard": ["ssa_county_code", "specialty_code", "contract_year"],
    "con_credit": ["ssa_county_code", "specialty_code", "contract_year"],
    "zcta_gazetteer": ["geoid", "source_year"],
    "county_boundaries": ["geoid", "source_year"],
    "org_files": ["id"],
}

DECLARED_NOT_NULL = {
    **DECLARED_KEYS,
    "provider_hsd": REQUIRED_COLUMNS["provider"],
    "facility_hsd": REQUIRED_COLUMNS["facility"],
    "zcta_gazetteer": ["geoid", "source_year", "intptlat", "intptlong"],
    "org_providers": ["id", "organization_id", "source_file_id"],
    "org_facilities": ["id", "organization_id", "source_file_id"],
    "org_files": [
        "id",
        "file_type",
        "organization_id",
        "uploaded_by_id",
        "original_name",
        "s3_bucket",
        "s3_key",
        "status",
        "created_at",
        "updated_at",
    ],
}
DECLARED_DOMAINS = {"org_files": {"file_type": FILE_TYPES, "status": FILE_STATUSES}}
