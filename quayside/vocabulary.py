"""Names, labels and message formats that appear in folders, logs and results."""

# Results are compared with these texts, so they must not change.
MANIFEST_PREFIX = "RDS_Inventory"
HISTORY_FOLDER = "History"
DATABASE = "RDS_DB"
JOB_NAME = "SP_LOAD_CATEGORY"

VALIDATION = "VALIDATION"
TABLE_LOAD = "TABLE_LOAD"
VIEW_REFRESH = "VIEW_REFRESH"
ARCHIVE = "ARCHIVE"
FILE_MISSING = "FILE_MISSING"

RUNNING = "RUNNING"
SUCCESS = "SUCCESS"
FAILED = "FAILED"
SKIPPED = "SKIPPED"
ERROR = "ERROR"

FILE_IN_INVENTORY = "FILE_IN_INVENTORY"
FILE_NAME_EXISTS = "FILE_NAME_EXISTS"
COLUMN_COUNT = "COLUMN_COUNT"
ROW_COUNT = "ROW_COUNT"
ROWS_LOADED = "ROWS_LOADED"

PASS = "PASS"
FAIL = "FAIL"

SRC_FILE_NM = "SRC_FILE_NM"
LOAD_TS = "LOAD_TS"

MSG_IN_MANIFEST = "Found in {manifest}"
MSG_NOT_IN_MANIFEST = "File is in S3 but NOT listed in {manifest} - not loaded"
MSG_SKIPPED_UNLISTED = "File not in inventory"
MSG_SKIPPED_ABSENT = "File not found in S3"
MSG_LOOKED_FOR = "Looked for {folder}{file} on the stage"
MSG_COLUMN_COUNT = "Header columns vs inventory COL_CNT"
MSG_ROW_COUNT = "Data rows in file vs inventory ROW_CNT"
MSG_ROWS_LOADED = "Rows loaded into {table}"
MSG_CHECKS_FAILED = " check(s) failed - see OPS.AUDIT_LOG"
MSG_LEFT_IN_FOLDER = "Validation failed - file left in {folder}"
MSG_VALIDATION_FAILED = "Validation failed"
MSG_ROWS_DIFFER = "Loaded row count does not match inventory"
MSG_POINTS_TO = "Points to {table}"
MSG_MOVED_TO = "Moved to {folder}"
MSG_AUDIT_MISSING = "Listed in the inventory but not found in {folder}"
MSG_RUN_DIED = "The run ended before this step did"
MSG_STEP_MISSING = "In inventory, not in {folder}, never loaded"

ERROR_TEXT_LENGTH = 1000
CATEGORY_LENGTH = 10
