"""Names, codes and texts that results must carry verbatim."""

# Source attribute -> canonical column, in canonical order of the source scan.
SOURCE_TO_CANONICAL = {
    "concept:name": "activity",
    "time:timestamp": "event_timestamp",
    "org:resource": "resource_id",
    "Cumulative net worth (EUR)": "cumulative_net_worth_eur",
    "case:Spend area text": "spend_area",
    "case:Company": "company_id",
    "case:Document Type": "document_type",
    "case:Sub spend area text": "sub_spend_area",
    "case:Purchasing Document": "purchasing_document_id",
    "case:Purch. Doc. Category name": "purchasing_document_category",
    "case:Vendor": "vendor_id",
    "case:Item Type": "item_type",
    "case:Item Category": "item_category",
    "case:Spend classification text": "spend_classification",
    "case:Source": "source_system",
    "case:Name": "case_name",
    "case:GR-Based Inv. Verif.": "gr_based_invoice_verification",
    "case:Item": "item_id",
    "case:concept:name": "case_id",
    "case:Goods Receipt": "goods_receipt_required",
}

# Columns cleaned while standardising.
IDENTIFIER_COLUMNS = (
    "case_id",
    "resource_id",
    "company_id",
    "purchasing_document_id",
    "vendor_id",
    "source_system",
    "item_id",
)
DESCRIPTIVE_COLUMNS = (
    "activity",
    "spend_area",
    "document_type",
    "sub_spend_area",
    "purchasing_document_category",
    "item_type",
    "item_category",
    "spend_classification",
    "case_name",
    "gr_based_invoice_verification",
    "goods_receipt_required",
)

# Columns cleaned again when staging.
STAGED_TEXT_COLUMNS = (
    "case_id",
    "case_name",
    "activity",
    "resource_id",
    "company_id",
    "vendor_id",
    "purchasing_document_id",
    "item_id",
    "document_type",
    "purchasing_document_category",
    "item_type",
    "item_category",
    "spend_area",
    "sub_spend_area",
    "spend_classification",
    "source_system",
)

# Attributes that every event of a case shares.
CASE_ATTRIBUTES = (
    "case_name",
    "company_id",
    "vendor_id",
    "purchasing_document_id",
    "document_type",
    "purchasing_document_category",
    "item_type",
    "item_category",
    "spend_area",
    "sub_spend_area",
    "spend_classification",
)

# The key that marks two events as potential duplicates.
DUPLICATE_KEY = (
    "case_id",
    "activity",
    "event_timestamp",
    "resource_id",
    "purchasing_document_id",
    "item_id",
)

# Texts that stand for "no resource".
MISSING_RESOURCE_TEXTS = ("NONE", "None", "none")

# Timestamp quality codes.
EXPECTED_PERIOD = "expected_period"
HISTORICAL_OUTLIER = "historical_outlier"
EDGE_BEFORE = "edge_period_before_main_window"
EDGE_AFTER = "edge_period_after_main_window"
INVALID_TIMESTAMP = "invalid_timestamp"

# The name of an event without activity, and what parts the activities of a variant.
MISSING_ACTIVITY_LABEL = "<MISSING_ACTIVITY>"
VARIANT_SEPARATOR = " -> "

# Batch rules in reporting order.
BATCH_RULES = (
    "FILE_READABLE",
    "DQ_SCHEMA_COLUMNS",
    "DQ_NOT_NULL_CASE_ID",
    "DQ_NOT_NULL_ACTIVITY",
    "DQ_NOT_NULL_EVENT_TIMESTAMP",
    "DQ_UNIQUE_EVENT_ID",
    "DQ_ROW_COUNT",
    "DQ_BATCH_ID",
    "DQ_IDEMPOTENCY",
)

# Injected fault -> the rule that must notice it.
FAULT_RULES = {
    "duplicate_events": "DQ_UNIQUE_EVENT_ID",
    "missing_case_id": "DQ_NOT_NULL_CASE_ID",
    "missing_timestamp": "DQ_NOT_NULL_EVENT_TIMESTAMP",
    "schema_drift": "DQ_SCHEMA_COLUMNS",
    "duplicate_batch_delivery": "DQ_IDEMPOTENCY",
    "corrupted_parquet": "FILE_READABLE",
}
