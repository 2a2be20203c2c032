"""Typed schemas: the complaint table, raw extracts and structured answers."""

from __future__ import annotations

from pyspark.sql import types as T

# Load order of the typed complaint table (16 columns; ingested_at is added by the upsert).
LOAD_COLUMNS = (
    "complaint_id",
    "date_received",
    "product",
    "sub_product",
    "issue",
    "sub_issue",
    "consumer_complaint_narrative",
    "company_public_response",
    "company",
    "state",
    "zip_code",
    "tags",
    "submitted_via",
    "date_sent_to_company",
    "company_response_to_consumer",
    "timely_response",
)

REQUIRED_COLUMNS = ("complaint_id", "date_received", "product", "issue", "company")

# Columns that must exist for the data checks (the six of the reference's schema test).
SCHEMA_CHECK_COLUMNS = ("complaint_id", "date_received", "product", "issue", "company",
                        "timely_response")

DATE_COLUMNS = ("date_received", "date_sent_to_company")

TRIMMED_COLUMNS = (
    "product",
    "sub_product",
    "issue",
    "sub_issue",
    "company",
    "state",
    "submitted_via",
    "company_response_to_consumer",
    "timely_response",
)

_TYPES = {
    "complaint_id": T.LongType(),
    "date_received": T.TimestampNTZType(),
    "date_sent_to_company": T.TimestampNTZType(),
}

COMPLAINT_SCHEMA = T.StructType(
    [T.StructField(c, _TYPES.get(c, T.StringType()), c not in REQUIRED_COLUMNS)
     for c in LOAD_COLUMNS]
    + [T.StructField("ingested_at", T.TimestampNTZType(), True)]
)

# A raw extract is read as text: every column a string, header as published.
RAW_HEADER = (
    "Date received",
    "Product",
    "Sub-product",
    "Issue",
    "Sub-issue",
    "Consumer complaint narrative",
    "Company public response",
    "Company",
    "State",
    "ZIP code",
    "Tags",
    "Consumer consent provided?",
    "Submitted via",
    "Date sent to company",
    "Company response to consumer",
    "Timely response?",
    "Consumer disputed?",
    "Complaint ID",
)


def raw_schema(header=RAW_HEADER) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in header])


# Structured answer for one theme; every field required.
THEME_ANSWER_SCHEMA = T.StructType([
    T.StructField("cluster_summary", T.StringType()),
    T.StructField("customer_need", T.StringType()),
    T.StructField("risk_implication", T.StringType()),
    T.StructField("urgency", T.StringType()),
    T.StructField("recommended_action", T.StringType()),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("requires_human_review", T.BooleanType()),
    T.StructField("evidence_complaint_ids", T.ArrayType(T.LongType())),
])

# Structured answer for a single complaint; every field required.
COMPLAINT_ANSWER_SCHEMA = T.StructType([
    T.StructField("summary", T.StringType()),
    T.StructField("primary_theme", T.StringType()),
    T.StructField("urgency", T.StringType()),
    T.StructField("recommended_action", T.StringType()),
    T.StructField("supporting_evidence", T.StringType()),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("requires_human_review", T.BooleanType()),
])
