"""Fixed values.

These values must equal the ones the original jobs use, otherwise
golden hashes, column names and entity labels would differ.  They are
listed plainly and in their natural order.
"""

# --- fixed values (must match the original behaviour) -----------------------
# Column appended to full-update tables; holds md5(concat_ws("|", all columns)).
ROW_HASH_COLUMN = "MD5_ROW_HASH"
ROW_HASH_SEPARATOR = "|"
# Suffix of the column that replaces a hashed client id column.
CLIENT_ID_HASH_SUFFIX = "_hashed"
# Suffix of the column holding extracted entities of a free-text column.
FEATURE_EXTRACTION_SUFFIX = "_feature_extraction"
# Salt used by the original unit tests for client id hashing (golden value
# e59cb3f3...9596 for id 1).  Production runs pass their own salt.
TEST_HASH_SALT = "$2b$12$Lrw9ZQwsFNSu/6KGCCTWCu"
# Texts are cut to this many characters by the optional truncation operator.
MAX_TEXT_CHARS = 20_000
# Entities removed from free text, in the original order.
PII_ENTITIES = ("PERSON", "LOCATION", "DATE_TIME", "EMAIL_ADDRESS", "URL", "PHONE_NUMBER")
# Entity labels of feature extraction, in output order.
FEATURE_EXTRACTION_LABELS = ("DISEASE", "CHEMICAL")
# Field names of the schema validation report.
REPORT_UNCLASSIFIED_TABLES = "unclassified_tables"
REPORT_MISSING_TABLES = "classified_but_unexisting_tables"
REPORT_ANALYSED_TABLES = "analysed_tables"
REPORT_UNCLASSIFIED_COLUMNS = "unclassified_columns"
REPORT_MISSING_COLUMNS = "classified_but_unexisting_columns"
# Column names of the monitoring log in compatibility mode (as the original
# wrote them: the table name lands in "Row_Count", the count in "Value").
MONITOR_COMPAT_COLUMNS = ("Row_Count", "Date_Time", "Value")
# Time formats: monitoring timestamp, provisioning output folder.
MONITOR_TIME_FORMAT = "%Y-%m-%dT%H:%M"
PROVISION_FOLDER_FORMAT = "%Y-%m-%d-%H-%M-%S"
# ---------------------------------------------------------------------------

# Change-feed system columns (our own Parquet layout, always dropped by name).
CHANGE_TYPE_COLUMN = "_change_type"
BATCH_ID_COLUMN = "batch_id"
INSERT = "insert"
DELETE = "delete"
