"""Declared schemas: nothing is inferred."""

RECORD = (
    "identifier STRING, body_code STRING, body_name STRING, title STRING, description STRING, "
    "decision_date DATE, source_url STRING, document_url STRING, partition_date STRING, "
    "content_type STRING, source_name STRING"
)
RECORD_COLUMNS = tuple(part.split()[0] for part in RECORD.split(", "))

STORAGE = "file_path STRING, file_hash STRING, content_fingerprint STRING, scraped_at TIMESTAMP"

# One stored row per (body_code, identifier) and run that changed it.
# ``landing_version`` names, in the curated zone, the object version and the extractor it was made with.
METADATA = f"storage_id STRING, {RECORD}, {STORAGE}, landing_version STRING, run_seq BIGINT, cell_seq BIGINT"

# One stored version per object key and run. It repeats the few record columns that let the
# transform prune by period and build its own keys without joining metadata to payloads. The
# last three are directories; ``kind`` keeps HTML and other files apart, so that each is read once.
OBJECTS = (
    "object_key STRING, payload BINARY, content_type STRING, identifier STRING, "
    "decision_date DATE, source_name STRING, run_seq BIGINT, cell_seq BIGINT, "
    "body_code STRING, kind STRING, period STRING"
)

CAPTURED = f"cell_seq BIGINT, item_seq BIGINT, {RECORD}, payload BINARY, error_code STRING, error_reason STRING"
LISTING_FAILURES = "cell_seq BIGINT, page_number INT, url STRING, error_code STRING, error_reason STRING"
TOTALS = "cell_seq BIGINT, reported_total BIGINT"
DEAD_CELLS = "cell_seq BIGINT, reason STRING"
CELLS = (
    "cell_seq BIGINT, start DATE, end DATE, label STRING, body_code STRING, body_name STRING, external_id STRING"
)
LISTING_PAGES = "cell_seq BIGINT, page_number INT, url STRING, payload BINARY, error_code STRING, error_reason STRING"

# The line-delimited exchange format, as one superset of its three row types.
HANDOFF = (
    "row_type STRING, cell_seq BIGINT, item_seq BIGINT, identifier STRING, body_code STRING, body_name STRING, "
    "title STRING, description STRING, decision_date STRING, source_url STRING, document_url STRING, "
    "partition_date STRING, content_type STRING, source_name STRING, local_path STRING, "
    "error_code STRING, error_reason STRING, reported_total BIGINT, url STRING, page_number INT, byte_count BIGINT"
)

CELL_SUMMARY = (
    "stage STRING, cell_seq BIGINT, partition STRING, body STRING, records_found BIGINT, records_written BIGINT, "
    "records_unchanged BIGINT, records_failed BIGINT, collection_complete BOOLEAN, accounted_for BOOLEAN"
)
RUN_SUMMARY = (
    "stage STRING, source STRING, start_date STRING, end_date STRING, partitions BIGINT, records_found BIGINT, "
    "records_written BIGINT, records_unchanged BIGINT, records_failed BIGINT, collection_complete BOOLEAN, "
    "accounted_for BOOLEAN, duration_seconds DOUBLE"
)
OUTCOMES = "cell_seq BIGINT, body_code STRING, identifier STRING, file_path STRING, action STRING, error_code STRING"
FAILURES = (
    "stage STRING, cell_seq BIGINT, partition STRING, body STRING, identifier STRING, url STRING, "
    "error_code STRING, reason STRING, is_collection BOOLEAN"
)

# Listing entries set aside, with where they stood.
REJECTS = "cell_seq BIGINT, page_number INT, position INT, identifier STRING, title STRING, document_url STRING, reject_reason STRING"

# The tables of the run log.
RUN_LOG = {"cell_summary": CELL_SUMMARY, "run_summary": RUN_SUMMARY, "failures": FAILURES, "outcomes": OUTCOMES, "rejects": REJECTS}
