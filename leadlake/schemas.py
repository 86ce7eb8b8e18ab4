"""Column lists and declared schemas of every table. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

#: Headers of the raw export and the staging column each becomes, in source order.
RAW_TO_STAGING = {
    "Name": "name",
    "Job Title": "job_title",
    "Company": "company",
    "Industry": "industry",
    "Location": "location",
    "Agent": "agent",
    "SDR Status": "sdr_status",
    "Comment Status": "comment_status",
    "Hot Score": "hot_score",
    "Source": "source",
    "Prioritized": "prioritized",
    "LinkedIn URL": "linkedin_url",
    "Added On": "added_on",
    "Last Contacted": "last_contacted",
    "Invite Sent At": "invite_sent_at",
    "Connected At": "connected_at",
}

DATE_COLUMNS = ["added_on", "last_contacted", "invite_sent_at", "connected_at"]
STAGING_COLUMNS = ["staging_id", *RAW_TO_STAGING.values(), "record_updated_at", "load_timestamp"]
FLAG_COLUMNS = ["is_contacted", "is_invite_sent", "is_connected", "is_prioritized", "is_hot_lead"]
KEY_COLUMNS = ["agent_key", "status_key", "date_key"]

_TIMES = {*DATE_COLUMNS, "record_updated_at", "load_timestamp"}


def _field(name: str) -> T.StructField:
    if name in _TIMES:
        return T.StructField(name, T.TimestampType())
    return T.StructField(name, T.DoubleType() if name == "hot_score" else T.StringType())


RAW = T.StructType([T.StructField(h, T.StringType()) for h in RAW_TO_STAGING])

#: Where a raw row came from; the order of these columns is the order of rows in the source.
SOURCE_ORDER = ["src_time", "src_file", "src_block", "src_row"]

STG_LEADS = T.StructType([_field(c) for c in STAGING_COLUMNS])

DEAD_LETTERS = T.StructType(
    [
        *STG_LEADS.fields,
        T.StructField("error_reason", T.StringType()),
        T.StructField("dead_letter_run_id", T.StringType()),
        T.StructField("dead_letter_timestamp", T.TimestampType()),
    ]
)

FCT_LEADS = T.StructType(
    [
        *STG_LEADS.fields,
        *[T.StructField(c, T.IntegerType()) for c in FLAG_COLUMNS],
        T.StructField("days_to_connection", T.IntegerType()),
        T.StructField("lead_status", T.StringType()),
    ]
)

FCT_LEADS_STAR = T.StructType(
    [*FCT_LEADS.fields, *[T.StructField(c, T.LongType()) for c in KEY_COLUMNS]]
)

DIM_AGENT = T.StructType(
    [
        T.StructField("agent_key", T.LongType(), False),
        T.StructField("agent_name", T.StringType(), False),
        T.StructField("valid_from", T.TimestampType(), False),
        T.StructField("valid_to", T.TimestampType()),
        T.StructField("is_current", T.BooleanType(), False),
    ]
)

DIM_LEAD_STATUS = T.StructType(
    [
        T.StructField("status_key", T.LongType(), False),
        T.StructField("lead_status", T.StringType(), False),
    ]
)

DIM_DATE = T.StructType(
    [
        T.StructField("date_key", T.LongType(), False),
        T.StructField("full_date", T.DateType(), False),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("month_name", T.StringType()),
        T.StructField("quarter", T.IntegerType()),
        T.StructField("day_of_month", T.IntegerType()),
        T.StructField("day_of_week", T.StringType()),
        T.StructField("week", T.IntegerType()),
    ]
)

#: The six columns of a date patch file.
DATE_PATCH = T.StructType(DIM_DATE.fields[:6])

PIPELINE_RUNS = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("pipeline_name", T.StringType()),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("completed_at", T.TimestampType()),
        T.StructField("rows_read", T.LongType()),
        T.StructField("rows_loaded", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("watermark_start", T.TimestampType()),
        T.StructField("watermark_end", T.TimestampType()),
        T.StructField("error_message", T.StringType()),
    ]
)

DQ_RESULTS = T.StructType(
    [
        T.StructField("dq_run_id", T.StringType()),
        T.StructField("dq_timestamp", T.TimestampType()),
        T.StructField("total_rows", T.LongType()),
        T.StructField("completeness_score", T.DoubleType()),
        T.StructField("uniqueness_score", T.DoubleType()),
        T.StructField("validity_score", T.DoubleType()),
        T.StructField("timeliness_score", T.DoubleType()),
        T.StructField("referential_integrity_score", T.DoubleType()),
        T.StructField("composite_dq_score", T.DoubleType()),
        T.StructField("threshold", T.DoubleType()),
        T.StructField("dq_status", T.StringType()),
    ]
)

RISK_COLUMNS = [
    "agent",
    "total_leads",
    "contacted_leads",
    "invite_sent_leads",
    "connected_leads",
    "hot_leads",
    "replied_leads",
    "ghosted_leads",
    "connection_rate",
    "acceptance_rate",
    "reply_rate",
    "ghosting_rate",
    "connection_rate_lower_95",
    "connection_rate_zscore",
    "ghosting_risk_points",
    "acceptance_risk_points",
    "connection_anomaly_points",
    "risk_score",
    "risk_level",
    "recommended_daily_capacity",
    "statistical_confidence",
    "model_status",
    "avg_days_to_connection",
]

_RISK_TEXT = {"agent", "risk_level", "statistical_confidence", "model_status"}
_RISK_POINTS = {
    "ghosting_risk_points",
    "acceptance_risk_points",
    "connection_anomaly_points",
    "risk_score",
}


def _risk_type(name: str) -> T.DataType:
    if name in _RISK_TEXT:
        return T.StringType()
    if name in _RISK_POINTS:
        return T.IntegerType()
    return T.LongType() if name.endswith(("_leads", "_capacity")) else T.DoubleType()


RISK_SCORES = T.StructType([T.StructField(c, _risk_type(c)) for c in RISK_COLUMNS])

#: Per lead, narrow: a digest of its staging row, and what the lead adds to the maintained sums.
LEAD_INDEX = T.StructType(
    [
        T.StructField("staging_id", T.StringType()),
        T.StructField("digest_1", T.LongType()),
        T.StructField("digest_2", T.LongType()),
        T.StructField("agent", T.StringType()),
        T.StructField("lead_status", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("industry", T.StringType()),
        T.StructField("added_day", T.DateType()),
        T.StructField("waiting_since", T.DateType()),
        T.StructField("ahead_until", T.TimestampType()),
        T.StructField("days_to_connection", T.IntegerType()),
        T.StructField("flags", T.IntegerType()),
    ]
)

#: Names of the counted conditions, in the order of their bits in `flags`. New ones go to the end.
COUNTED = [
    "contacted_leads", "invite_sent_leads", "connected_leads", "prioritized_leads", "hot_leads", "replied_leads",
    "rate_limited_leads", "valid_name", "valid_linkedin_url", "valid_added_on", "valid_agent", "valid_hot_scores",
    "valid_prioritized", "valid_statuses", "dated_rows", "rows_with_url",
]

#: Columns that name a sum: its kind, and the values that leads of the sum share (null for other kinds).
SUM_KEYS = {
    "kind": T.StringType(),
    "agent": T.StringType(),
    "lead_status": T.StringType(),
    "source": T.StringType(),
    "industry": T.StringType(),
    "day": T.DateType(),
    "moment": T.TimestampType(),
}
SUM_COUNTS = ["total_rows", *COUNTED, "connection_days", "connection_day_rows"]
LEAD_SUMS = T.StructType(
    [T.StructField(c, t) for c, t in SUM_KEYS.items()] + [T.StructField(c, T.LongType()) for c in SUM_COUNTS]
)

ALERTS = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("event", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("detail", T.StringType()),
    ]
)

#: Tables the store keeps, with their schemas.
#: Records that no reader could read, with their text.
MALFORMED_RECORDS = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("src_file", T.StringType()),
        T.StructField("raw_record", T.StringType()),
        T.StructField("error_reason", T.StringType()),
        T.StructField("set_aside_at", T.TimestampType()),
    ]
)

TABLES = {
    "stg_leads": STG_LEADS,
    "dead_letter_leads": DEAD_LETTERS,
    "malformed_records": MALFORMED_RECORDS,
    "fct_leads_star": FCT_LEADS_STAR,
    "lead_index": LEAD_INDEX,
    "lead_sums": LEAD_SUMS,
    "dim_agent": DIM_AGENT,
    "dim_lead_status": DIM_LEAD_STATUS,
    "dim_date": DIM_DATE,
    "pipeline_runs": PIPELINE_RUNS,
    "dq_results": DQ_RESULTS,
    "analytics_risk_scores": RISK_SCORES,
}
