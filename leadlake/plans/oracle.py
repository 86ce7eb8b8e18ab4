"""DuckDB statements equal to the named queries, on the same parquet tables."""

from __future__ import annotations

_ITEMS = """
SELECT l_orderkey, max(l_shipdate) AS contacted,
       min(l_shipdate) FILTER (l_linestatus = 'O') AS invited,
       max(l_shipdate) FILTER (l_linestatus = 'O' AND l_returnflag = 'R' AND l_quantity > 25) AS connected
FROM lineitem GROUP BY l_orderkey
"""

_RAW = """
SELECT o_orderkey AS src_ordinal, c_name AS name, o_orderpriority AS job_title,
       'Company ' || o_custkey AS company, c_mktsegment AS industry, r_name AS location,
       CASE WHEN o_orderkey % 101 = 0 THEN '  ' ELSE n_name END AS agent,
       CASE o_orderkey % 9 WHEN 0 THEN 'captured' WHEN 1 THEN 'invite sent' WHEN 2 THEN 'Connected'
            WHEN 3 THEN 'replied' WHEN 4 THEN 'rejected' WHEN 5 THEN ' Invite Sent '
            WHEN 6 THEN 'linkedin rate limited' WHEN 7 THEN 'enriched' END AS sdr_status,
       CAST(NULL AS VARCHAR) AS comment_status,
       CASE WHEN o_orderkey % 10 <> 0 THEN CAST(o_orderkey % 104 AS DOUBLE) END AS hot_score,
       o_orderstatus AS source,
       CASE o_orderkey % 5 WHEN 0 THEN 'Yes' WHEN 1 THEN ' no ' WHEN 2 THEN 'YES' WHEN 3 THEN 'maybe' END
           AS prioritized,
       CASE WHEN o_orderkey % 97 = 0 THEN NULL
            WHEN o_orderkey % 50 = 1 THEN ' HTTPS://www.linkedin.com/in/U' || (o_orderkey - 1) || ' '
            ELSE 'https://www.linkedin.com/in/u' || o_orderkey END AS linkedin_url,
       CASE WHEN o_orderkey % 89 <> 0 THEN o_orderdate END AS added_on,
       contacted AS last_contacted, invited AS invite_sent_at, connected AS connected_at
FROM orders
JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
LEFT JOIN items ON o_orderkey = l_orderkey
"""

_STAGING = """staging_id, name, job_title, company, industry, location, agent, sdr_status, comment_status,
       hot_score, source, prioritized, linkedin_url, added_on, last_contacted, invite_sent_at, connected_at,
       record_updated_at, load_timestamp"""

_NEWEST = "greatest(added_on, last_contacted, invite_sent_at, connected_at)"

_BASE = f"""
items AS ({_ITEMS}),
raw AS ({_RAW}),
identified AS (
  SELECT *, CASE WHEN trim(linkedin_url) <> '' THEN substr(sha256(lower(trim(linkedin_url))), 1, 32) END
            AS staging_id
  FROM raw),
dedup AS (
  SELECT * FROM identified
  QUALIFY row_number() OVER (PARTITION BY staging_id ORDER BY src_ordinal DESC) = 1),
stg AS (
  SELECT *, {_NEWEST} AS record_updated_at, TIMESTAMP '2002-01-01 00:00:00' AS load_timestamp FROM dedup),
reasons AS (
  SELECT {_STAGING},
         rtrim(CASE WHEN linkedin_url IS NULL OR trim(linkedin_url) = '' THEN 'Missing linkedin_url; ' ELSE '' END
            || CASE WHEN staging_id IS NULL THEN 'Missing staging_id; ' ELSE '' END
            || CASE WHEN added_on IS NULL THEN 'Missing added_on; ' ELSE '' END) AS error_reason
  FROM stg),
leads AS (SELECT {_STAGING} FROM reasons WHERE error_reason = ''),
fct AS (
  SELECT *,
    CAST(last_contacted IS NOT NULL AS INT) AS is_contacted,
    CAST(invite_sent_at IS NOT NULL AS INT) AS is_invite_sent,
    CAST(connected_at IS NOT NULL AS INT) AS is_connected,
    CASE WHEN upper(trim(prioritized)) = 'YES' THEN 1 ELSE 0 END AS is_prioritized,
    CASE WHEN hot_score >= 50 THEN 1 ELSE 0 END AS is_hot_lead,
    CAST(date_diff('day', CAST(added_on AS DATE), CAST(connected_at AS DATE)) AS INT) AS days_to_connection,
    coalesce(sdr_status, 'unknown') AS lead_status
  FROM leads)"""

_NORM = "replace(lower(trim(lead_status)), ' ', '_')"


def _calendar(day: str) -> str:
    return f"""CAST(strftime({day}, '%Y%m%d') AS BIGINT) AS date_key, CAST({day} AS VARCHAR) AS full_date,
       CAST(year({day}) AS INT) AS year, CAST(month({day}) AS INT) AS month, monthname({day}) AS month_name,
       CAST(quarter({day}) AS INT) AS quarter, CAST(day({day}) AS INT) AS day_of_month,
       dayname({day}) AS day_of_week, CAST(strftime({day}, '%U') AS INT) AS week"""


_AGENTS = """
  SELECT row_number() OVER (ORDER BY agent_name) AS agent_key, agent_name,
         TIMESTAMP '2002-01-01 00:00:00' AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to, 1 AS is_current
  FROM (SELECT DISTINCT trim(agent) AS agent_name FROM {facts}) WHERE agent_name <> ''"""

_STATUSES = f"""
  SELECT row_number() OVER (ORDER BY lead_status) AS status_key, lead_status
  FROM (SELECT DISTINCT {_NORM} AS lead_status FROM {{facts}})"""


def _days(column: str, facts: str) -> str:
    return f"""SELECT {_calendar('d')}
  FROM (SELECT DISTINCT CAST({column} AS DATE) AS d FROM {facts}) WHERE d IS NOT NULL"""


def _star(facts: str) -> str:
    """CTEs dim_agent, dim_status, dim_day and star over the given fact."""
    return f"""
dim_agent AS ({_AGENTS.format(facts=facts)}),
dim_status AS ({_STATUSES.format(facts=facts)}),
dim_day AS ({_days('added_on', facts)}),
star AS (
  SELECT f.* REPLACE (trim(f.agent) AS agent, replace(lower(trim(f.lead_status)), ' ', '_') AS lead_status),
         a.agent_key, s.status_key, d.date_key
  FROM {facts} f
  LEFT JOIN dim_agent a ON trim(f.agent) = a.agent_name
  LEFT JOIN dim_status s ON replace(lower(trim(f.lead_status)), ' ', '_') = s.lead_status
  LEFT JOIN dim_day d ON strftime(f.added_on, '%Y-%m-%d') = d.full_date)"""


_NAMED = "named AS (SELECT * FROM fct WHERE trim(agent) <> '')"
#: Leads of two loads: the newer batches first, then the first batch, which wins where both hold a lead.
_TWO_LOADS = f"""
arrived AS (SELECT *, CASE WHEN {_NEWEST} < TIMESTAMP '1997-01-01' THEN 2 ELSE 1 END AS load_no
  FROM identified WHERE trim(agent) <> ''),
each_load AS (SELECT * FROM arrived
  QUALIFY row_number() OVER (PARTITION BY load_no, staging_id ORDER BY src_ordinal DESC) = 1),
loaded AS (SELECT *, {_NEWEST} AS record_updated_at, TIMESTAMP '2002-01-01 00:00:00' AS load_timestamp
  FROM each_load WHERE staging_id IS NOT NULL AND added_on IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY staging_id ORDER BY load_no DESC) = 1)"""


def _with(*parts: str) -> str:
    *ctes, select = parts
    return "WITH " + ",\n".join([_BASE.strip(), *[c.strip() for c in ctes]]) + "\n" + select.strip()


def _sound(*parts: str) -> str:
    """Like `_with`, from raw leads that have an agent."""
    return _with(*parts).replace("FROM raw)", "FROM raw WHERE trim(agent) <> '')")


def _arrived(before: str | None, *parts: str) -> str:
    """Like `_sound`, from raw leads that arrive before a day."""
    until = f" AND {_NEWEST} < TIMESTAMP '{before}'" if before else ""
    return _with(*parts).replace("FROM raw)", f"FROM raw WHERE trim(agent) <> ''{until})")


def _on_star(select: str) -> str:
    return _with(_star("fct"), select)


_COUNTS = """count(*) AS total_leads, count_if(is_contacted = 1) AS contacted_leads,
  count_if(is_invite_sent = 1) AS invite_sent_leads, count_if(is_connected = 1) AS connected_leads,
  count_if(is_hot_lead = 1) AS hot_leads"""


def _pct(part: str, whole: str = "count(*)") -> str:
    return f"count_if({part} = 1)::DOUBLE / nullif({whole}, 0)::DOUBLE * 100"


def _batch(column: str = "record_updated_at") -> str:
    return f"""CASE WHEN {column} < TIMESTAMP '1997-01-01' THEN 1
    WHEN {column} < TIMESTAMP '1999-01-01' THEN 2 ELSE 3 END"""


_BATCHED = f"batched AS (SELECT *, {_batch()} AS batch FROM leads)"

_LEDGER = f"""{_BATCHED},
ledger AS (
  SELECT 'run-' || batch AS run_id, 'leads_ingestion' AS pipeline_name,
    TIMESTAMP '2002-01-01 00:00:00' AS started_at,
    TIMESTAMP '2002-01-01 00:00:00' + to_seconds(count(*)) AS completed_at,
    count(*) AS rows_read, CASE WHEN batch = 3 THEN 0 ELSE count(*) END AS rows_loaded,
    CASE WHEN batch = 3 THEN 'FAILED' ELSE 'SUCCESS' END AS status,
    CAST(NULL AS TIMESTAMP) AS watermark_start, max(record_updated_at) AS watermark_end,
    CASE WHEN batch = 3 THEN 'load failed' END AS error_message
  FROM batched GROUP BY batch)"""

_RESENT = f"""{_BATCHED},
resent AS (
  SELECT {_STAGING.replace('hot_score', 'hot_score + 1 AS hot_score')
          .replace('last_contacted', "TIMESTAMP '2001-12-01' AS last_contacted")
          .replace('record_updated_at', "greatest(added_on, TIMESTAMP '2001-12-01', invite_sent_at, connected_at) AS record_updated_at")}
  FROM batched WHERE batch = 1 AND sdr_status = 'captured')"""

_KNOWN_STATUSES = """known(status_key, lead_status) AS (
  VALUES (1, 'captured'), (2, 'connected'), (5, 'invite_sent'))"""


def _segment(column: str) -> str:
    return f"""SELECT {column}, count(*) AS total_leads, count_if(is_invite_sent = 1) AS invites_sent,
  count_if(is_connected = 1) AS connected_leads,
  {_pct('is_connected', 'count_if(is_invite_sent = 1)')} AS acceptance_rate,
  {_pct('is_connected')} AS conversion_rate FROM fct GROUP BY {column}"""


_GHOSTED = """invite_sent_at IS NOT NULL AND connected_at IS NULL
    AND date_diff('day', CAST(invite_sent_at AS DATE), DATE '2000-01-01') >= 7"""

_COMPLETE = """count(*) AS total_rows,
  count_if(name IS NOT NULL AND trim(name) <> '') AS valid_name,
  count_if(linkedin_url IS NOT NULL AND trim(linkedin_url) <> '') AS valid_linkedin_url,
  count_if(added_on IS NOT NULL) AS valid_added_on,
  count_if(agent IS NOT NULL AND trim(agent) <> '') AS valid_agent"""
_UNIQUE = """count(DISTINCT staging_id) AS unique_staging_ids,
  count(DISTINCT linkedin_url) AS unique_linkedin_urls"""
_VALID = """count_if(hot_score IS NULL OR (hot_score >= 0 AND hot_score <= 100)) AS valid_hot_scores,
  count_if(prioritized IS NULL OR upper(trim(prioritized)) IN ('YES', 'NO')) AS valid_prioritized,
  count_if(sdr_status IS NULL OR lower(trim(sdr_status)) IN
    ('captured', 'invite sent', 'connected', 'replied', 'rejected', 'unknown')) AS valid_statuses"""
_TIMELY = """count(record_updated_at) AS dated_rows,
  count_if(record_updated_at <= TIMESTAMP '2000-01-01') AS timely_records"""


def _ratio(found: str, checks: str) -> str:
    return f"coalesce(({found})::DOUBLE / nullif({checks}, 0)::DOUBLE * 100, 0.0)"


_S_COMPLETE = _ratio("valid_name + valid_linkedin_url + valid_added_on + valid_agent", "total_rows * 4")
_S_UNIQUE = (
    f"({_ratio('unique_staging_ids', 'total_rows')} + {_ratio('unique_linkedin_urls', 'total_rows')}) / 2"
)
_S_VALID = _ratio("valid_hot_scores + valid_prioritized + valid_statuses", "total_rows * 3")
_S_TIMELY = _ratio("timely_records", "dated_rows")
_S_REFER = _ratio("valid_agent", "total_rows")


def _dq(source: str, group: str = "") -> str:
    """Subquery with all scores, one row per group."""
    key = f"{group}, " if group else ""
    by = f"GROUP BY {group}" if group else ""
    return f"""
  SELECT *, completeness_score * CAST(0.25 AS DOUBLE) + uniqueness_score * CAST(0.2 AS DOUBLE)
      + validity_score * CAST(0.25 AS DOUBLE) + timeliness_score * CAST(0.15 AS DOUBLE)
      + referential_integrity_score * CAST(0.15 AS DOUBLE) AS composite_dq_score
  FROM (
    SELECT {key}total_rows, {_S_COMPLETE} AS completeness_score, {_S_UNIQUE} AS uniqueness_score,
      {_S_VALID} AS validity_score, {_S_TIMELY} AS timeliness_score, {_S_REFER} AS referential_integrity_score
    FROM (SELECT {key}{_COMPLETE}, {_UNIQUE}, {_VALID}, {_TIMELY} FROM {source} {by}))"""


_DQ_SELECT = """total_rows, completeness_score, uniqueness_score, validity_score, timeliness_score,
  referential_integrity_score, composite_dq_score, CAST(95.0 AS DOUBLE) AS threshold,
  CASE WHEN composite_dq_score >= 95 THEN 'PASS' ELSE 'FAIL' END AS dq_status"""

_RISK_BASE = f"""base AS (
  SELECT agent, {_COUNTS}, count_if({_GHOSTED}) AS ghosted_leads,
    count_if(lower(trim(coalesce(sdr_status, ''))) = 'replied') AS replied_leads,
    avg(days_to_connection) AS avg_days_to_connection
  FROM fct WHERE agent IS NOT NULL GROUP BY agent)"""


def _frac(part: str, whole: str) -> str:
    return f"coalesce({part}::DOUBLE / nullif({whole}, 0)::DOUBLE, 0.0)"


_RATES = f"""rates AS (
  SELECT *, {_frac('connected_leads', 'total_leads')} AS connection_rate,
    {_frac('connected_leads', 'invite_sent_leads')} AS acceptance_rate,
    {_frac('replied_leads', 'contacted_leads')} AS reply_rate,
    {_frac('ghosted_leads', 'invite_sent_leads')} AS ghosting_rate,
    connected_leads::DOUBLE AS s, total_leads::DOUBLE AS n FROM base)"""

_Z = "CAST(1.96 AS DOUBLE)"
_SCORED = f"""scored AS (
  SELECT rates.* EXCLUDE (s, n),
    CASE WHEN s > 0 THEN greatest(CAST(0.0 AS DOUBLE), (s + {_Z} * {_Z} / 2
        - {_Z} * sqrt(s * (n - s) / n + {_Z} * {_Z} / 4)) / (n + {_Z} * {_Z}))
      ELSE CAST(0.0 AS DOUBLE) END AS connection_rate_lower_95,
    CASE WHEN agents >= 2 AND total_leads >= 30 AND p0 > 0 AND p0 < 1
      THEN (connection_rate - p0) / sqrt(p0 * (1 - p0) / n) ELSE CAST(0.0 AS DOUBLE) END AS connection_rate_zscore
  FROM rates, (SELECT sum(connected_leads)::DOUBLE / sum(total_leads)::DOUBLE AS p0, count(*) AS agents FROM base)),
pointed AS (
  SELECT *,
    CASE WHEN invite_sent_leads < 5 THEN 0 WHEN ghosting_rate >= 0.5 THEN 35 WHEN ghosting_rate >= 0.3 THEN 20
      WHEN ghosting_rate >= 0.15 THEN 10 ELSE 0 END AS ghosting_risk_points,
    CASE WHEN invite_sent_leads < 5 THEN 0 WHEN acceptance_rate < 0.05 THEN 30 WHEN acceptance_rate < 0.1 THEN 20
      WHEN acceptance_rate < 0.15 THEN 10 ELSE 0 END AS acceptance_risk_points,
    CASE WHEN connection_rate_zscore <= -3 THEN 35 WHEN connection_rate_zscore <= -2 THEN 25
      WHEN connection_rate_zscore <= -1 THEN 10 ELSE 0 END AS connection_anomaly_points
  FROM scored),
leveled AS (
  SELECT *, risk_score >= 60 AS high, risk_score >= 30 AND risk_score < 60 AS medium FROM (
    SELECT *, ghosting_risk_points + acceptance_risk_points + connection_anomaly_points AS risk_score FROM pointed)),
risk AS (
  SELECT agent, total_leads, contacted_leads, invite_sent_leads, connected_leads, hot_leads, replied_leads,
    ghosted_leads, connection_rate, acceptance_rate, reply_rate, ghosting_rate, connection_rate_lower_95,
    connection_rate_zscore, ghosting_risk_points, acceptance_risk_points, connection_anomaly_points, risk_score,
    CASE WHEN high THEN 'HIGH' WHEN medium THEN 'MEDIUM' ELSE 'LOW' END AS risk_level,
    CAST(CASE WHEN total_leads < 30 THEN 100 WHEN connection_rate_lower_95 <= 0 THEN 50
      ELSE least(CASE WHEN high THEN 50 WHEN medium THEN 75 ELSE 100 END,
                 100, greatest(10, floor(5 / connection_rate_lower_95))) END AS BIGINT) AS recommended_daily_capacity,
    CASE WHEN total_leads >= 30 THEN 'Adequate for rate monitoring' ELSE 'Insufficient sample' END
      AS statistical_confidence,
    CASE WHEN total_leads >= 30 THEN 'STATISTICALLY_ACTIONABLE' ELSE 'MONITOR_ONLY' END AS model_status,
    avg_days_to_connection
  FROM leveled)"""


def _risk(select: str) -> str:
    return _with(_RISK_BASE, _RATES, _SCORED, select)


_SPAN = """span AS (
  SELECT min(CAST({first} AS DATE)) AS first_day, max(CAST(record_updated_at AS DATE)) AS last_day FROM leads),
calendar AS (
  SELECT CAST(unnest(generate_series(first_day::TIMESTAMP, last_day::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS d
  FROM span)"""

_VIEW = """f.staging_id, f.name, f.job_title, f.company, f.industry, f.location, a.agent_key, a.agent_name,
  s.status_key, s.lead_status, d.date_key, d.full_date, d.year, d.month, d.month_name, d.quarter,
  d.day_of_month, d.day_of_week, f.comment_status, f.hot_score, f.source, f.prioritized, f.linkedin_url,
  f.added_on, f.last_contacted, f.invite_sent_at, f.connected_at, f.record_updated_at, f.is_contacted,
  f.is_invite_sent, f.is_connected, f.is_prioritized, f.is_hot_lead, f.days_to_connection"""

_STAR_COUNTS = _COUNTS.replace("count(*) AS total_leads", "count(f.staging_id) AS total_leads")
_DIM_JOINS = """LEFT JOIN dim_agent a ON f.agent_key = a.agent_key
LEFT JOIN dim_status s ON f.status_key = s.status_key LEFT JOIN dim_day d ON f.date_key = d.date_key"""

_PROFILE = """SELECT trim(agent) AS agent_name,
    CASE WHEN sum(is_connected) * 100 >= count(*) * 28 THEN 'strong' ELSE 'weak' END AS profile"""

_SCD_VALID = """CAST(count(*) > 0 AND count_if(is_current = 1) > 0 AND count(valid_from) = count(*) AS INT)"""

_VERSIONS = """seen AS (
  SELECT trim(agent) AS agent_name, date_trunc('quarter', added_on) AS seen_at,
    CASE WHEN sum(is_connected) * 100 >= count(*) * 28 THEN 'strong' ELSE 'weak' END AS profile
  FROM fct WHERE trim(agent) <> '' GROUP BY ALL),
changes AS (SELECT * FROM seen
  QUALIFY lag(profile) OVER (PARTITION BY agent_name ORDER BY seen_at) IS DISTINCT FROM profile),
versions AS (
  SELECT agent_name, seen_at::TIMESTAMP AS valid_from, lead(seen_at) OVER w::TIMESTAMP AS valid_to,
    CAST(lead(seen_at) OVER w IS NULL AS INT) AS is_current, profile
  FROM changes WINDOW w AS (PARTITION BY agent_name ORDER BY seen_at))"""

ORACLE: dict[str, str] = {
    "csv_scan": _with(f"SELECT {_STAGING} FROM stg"),
    "csv_mixed_headers": _with(
        """SELECT name, job_title, company, industry, location, agent, sdr_status, comment_status,
             CAST(hot_score AS VARCHAR) AS hot_score, source, prioritized, linkedin_url,
             strftime(added_on, '%Y-%m-%d %H:%M:%S') AS added_on, strftime(last_contacted, '%Y-%m-%d %H:%M:%S') AS last_contacted,
             strftime(invite_sent_at, '%Y-%m-%d %H:%M:%S') AS invite_sent_at,
             strftime(connected_at, '%Y-%m-%d %H:%M:%S') AS connected_at FROM raw"""
    ),
    "stream_mixed_headers": _sound("SELECT * FROM leads").replace(
        "WHERE trim(agent) <> '')", "WHERE trim(agent) <> '' AND src_ordinal % 50 > 1)"
    ),
    "dead_letters_malformed": _with(
        """SELECT '{"Name": ' || src_ordinal AS raw_record, 'Malformed record;' AS error_reason,
             (SELECT count(*) FROM raw WHERE src_ordinal % 211 <> 0) AS leads_read
           FROM raw WHERE src_ordinal % 211 = 0"""
    ),
    "json_updated_after": _with(
        """late AS (SELECT * FROM identified
           WHERE greatest(added_on, last_contacted, invite_sent_at, connected_at) > TIMESTAMP '1999-01-01'
           QUALIFY row_number() OVER (PARTITION BY staging_id ORDER BY src_ordinal DESC) = 1)""",
        f"""SELECT {_STAGING} FROM (SELECT *, {_NEWEST} AS record_updated_at,
            TIMESTAMP '2002-01-01 00:00:00' AS load_timestamp FROM late)""",
    ),
    "lead_id": _with("SELECT src_ordinal, staging_id FROM identified"),
    "stg_leads": _with(f"SELECT {_STAGING} FROM stg"),
    "dedup_keep_last": _with("SELECT staging_id, src_ordinal FROM dedup"),
    "fct_leads": _with("SELECT * FROM fct"),
    "lead_lookup": _with(
        """SELECT name, sdr_status, hot_score, prioritized, last_contacted, invite_sent_at, connected_at
           FROM stg WHERE name = 'Customer#000000042'"""
    ),
    "fact_lookup": _with(
        """SELECT name, lead_status, is_contacted, is_invite_sent, is_connected, is_prioritized, is_hot_lead,
           days_to_connection FROM fct WHERE name = 'Customer#000000042'"""
    ),
    "validation_reasons": _with(
        "SELECT error_reason, count(*) AS records FROM reasons GROUP BY error_reason"
    ),
    "valid_leads": _with("SELECT * FROM leads"),
    "dead_letters": _with(
        """SELECT *, 'run-1' AS dead_letter_run_id, TIMESTAMP '2002-01-01 00:00:00' AS dead_letter_timestamp
           FROM reasons WHERE error_reason <> ''"""
    ),
    "dead_letters_every_row": _with(
        f"""nameless AS (SELECT *, {_NEWEST} AS record_updated_at,
            TIMESTAMP '2002-01-01 00:00:00' AS load_timestamp FROM identified WHERE staging_id IS NULL)""",
        f"""SELECT *, 'run-1' AS dead_letter_run_id, TIMESTAMP '2002-01-01 00:00:00' AS dead_letter_timestamp
           FROM (SELECT * FROM reasons WHERE error_reason <> '' AND staging_id IS NOT NULL
                 UNION ALL
                 SELECT {_STAGING}, 'Missing linkedin_url; Missing staging_id;'
                   || CASE WHEN added_on IS NULL THEN ' Missing added_on;' ELSE '' END FROM nameless)""",
    ),
    "run_records": _with(_LEDGER, "SELECT * FROM ledger"),
    "current_watermark": _with(
        _LEDGER,
        """SELECT max(watermark_end) AS watermark FROM ledger
           WHERE pipeline_name = 'leads_ingestion' AND status = 'SUCCESS' AND watermark_end IS NOT NULL""",
    ),
    "incremental_rows": _with(
        "SELECT * FROM leads WHERE record_updated_at > TIMESTAMP '1997-01-01 00:00:00'"
    ),
    "incremental_overlap": _with(
        "SELECT * FROM leads WHERE record_updated_at > TIMESTAMP '1999-01-01 00:00:00' - INTERVAL 30 DAY"
    ),
    "upsert_leads": _with(
        _RESENT,
        f"""SELECT * FROM resent
            UNION ALL SELECT {_STAGING} FROM batched WHERE staging_id NOT IN (SELECT staging_id FROM resent)""",
    ),
    "incremental_staging": _with(
        _RESENT,
        f"""SELECT * FROM resent
            UNION ALL SELECT {_STAGING} FROM batched WHERE staging_id NOT IN (SELECT staging_id FROM resent)""",
    ),
    "load_in_batches": _sound("SELECT * EXCLUDE (load_timestamp) FROM leads"),
    "load_then_risk": _sound(_RISK_BASE, _RATES, _SCORED, "SELECT * FROM risk"),
    "stream_staging": _sound("SELECT * FROM leads"),
    "load_two_pipelines": _with(_TWO_LOADS, f"SELECT {_STAGING} FROM loaded"),
    "load_broken_export": _with(
        """SELECT '{"Name": ' || src_ordinal AS raw_record, 'Malformed record;' AS error_reason,
             (SELECT count(*) FROM raw WHERE trim(agent) <> '') AS rows_read
           FROM raw WHERE src_ordinal % 211 = 0 AND trim(agent) <> ''"""
    ),
    "load_stream_then_batch": _with(_TWO_LOADS, f"SELECT {_STAGING} FROM loaded"),
    "load_edited_leads": _sound(
        f"""edited AS (SELECT * REPLACE (
              CASE WHEN src_ordinal % 7 = 0 THEN 'replied' ELSE sdr_status END AS sdr_status,
              CASE WHEN src_ordinal % 7 = 0 THEN hot_score + 1 ELSE hot_score END AS hot_score) FROM stg)""",
        f"""SELECT {_STAGING.replace("load_timestamp", "n.load_timestamp").replace("staging_id", "n.staging_id")}
            FROM (SELECT e.* REPLACE (CASE WHEN e.sdr_status IS DISTINCT FROM o.sdr_status
                      OR e.hot_score IS DISTINCT FROM o.hot_score
                    THEN TIMESTAMP '2002-01-02 00:00:00' ELSE o.load_timestamp END AS load_timestamp)
                  FROM edited e JOIN stg o USING (staging_id)) n
            WHERE n.staging_id IS NOT NULL AND n.added_on IS NOT NULL""",
    ),
    "load_future_date": _sound(
        f"""dated AS (SELECT *, {_NEWEST} AS record_updated_at FROM identified),
        first AS (SELECT * REPLACE (CASE WHEN src_ordinal % 211 = 5 THEN TIMESTAMP '2062-08-01'
              ELSE last_contacted END AS last_contacted) FROM dated WHERE record_updated_at < TIMESTAMP '1997-01-01'
            QUALIFY row_number() OVER (PARTITION BY staging_id ORDER BY src_ordinal DESC) = 1),
        one AS (SELECT *, TIMESTAMP '2002-01-01 00:00:00' AS load_timestamp, 1 AS load_no FROM first
            WHERE staging_id IS NOT NULL AND added_on IS NOT NULL AND src_ordinal % 211 <> 5),
        two AS (SELECT *, TIMESTAMP '2002-01-02 00:00:00' AS load_timestamp, 2 AS load_no FROM (SELECT * FROM dated
              QUALIFY row_number() OVER (PARTITION BY staging_id ORDER BY src_ordinal DESC) = 1)
            WHERE staging_id IS NOT NULL AND added_on IS NOT NULL
              AND record_updated_at > (SELECT max(record_updated_at) FROM one)),
        both_loads AS (SELECT * FROM (SELECT * FROM one UNION ALL SELECT * FROM two)
            QUALIFY row_number() OVER (PARTITION BY staging_id ORDER BY load_no DESC) = 1)""",
        f"""SELECT {_STAGING}, (SELECT count(*) FROM first WHERE src_ordinal % 211 = 5) AS set_aside FROM both_loads""",
    ),
    "load_failed_gate": _with(
        f"""good AS (SELECT * FROM identified WHERE trim(agent) <> '' AND {_NEWEST} < TIMESTAMP '1997-01-01'),
        kept AS (SELECT * FROM good QUALIFY row_number() OVER (PARTITION BY staging_id ORDER BY src_ordinal DESC) = 1),
        n AS (SELECT count(*) FILTER (staging_id IS NOT NULL AND added_on IS NOT NULL) AS staging_rows FROM kept)""",
        """SELECT 'good' AS run_id, 'SUCCESS' AS status, (SELECT count(*) FROM good) AS rows_read,
             staging_rows AS rows_loaded, staging_rows FROM n
           UNION ALL SELECT 'bad', 'FAILED', (SELECT count(*) FROM raw), 0, staging_rows FROM n""",
    ),
    "load_repeated": _sound(
        """SELECT run_id, 'SUCCESS' AS status, (SELECT count(*) FROM identified) AS rows_read, n AS rows_loaded,
             n AS staging_rows, 'SUCCESS,ALREADY_LOADED,SUCCESS' AS outcomes
           FROM (SELECT count(*) AS n FROM leads), (VALUES ('one'), ('two')) runs(run_id)"""
    ),
    "load_empty": _arrived("1999-01-01", "SELECT * FROM leads"),
    "load_then_reports": _sound(
        f"""SELECT 'funnel' AS report, NULL::VARCHAR AS key, {_COUNTS} FROM fct
        UNION ALL SELECT 'agent', agent, {_COUNTS} FROM fct GROUP BY agent
        UNION ALL SELECT 'status', lead_status, count(*), count_if(is_contacted = 1), NULL, count_if(is_connected = 1),
          count_if(is_hot_lead = 1) FROM fct GROUP BY lead_status
        UNION ALL SELECT 'source', source, count(*), NULL, count_if(is_invite_sent = 1), count_if(is_connected = 1), NULL
          FROM fct GROUP BY source
        UNION ALL SELECT 'industry', industry, count(*), NULL, count_if(is_invite_sent = 1), count_if(is_connected = 1), NULL
          FROM fct GROUP BY industry"""
    ),
    "load_then_daily_trend": _sound(
        f"""SELECT d.date_key, d.full_date, d.year, d.month, d.month_name, d.quarter, {_STAR_COUNTS}
            FROM fct f JOIN ({_days('added_on', 'fct')}) d ON strftime(f.added_on, '%Y-%m-%d') = d.full_date GROUP BY ALL"""
    ),
    "load_then_quality": " UNION ALL ".join(
        "SELECT * FROM ("
        + _arrived(
            before,
            f"""SELECT '2002010{n}000000000000' AS dq_run_id, TIMESTAMP '2002-01-0{n} 00:00:00' AS dq_timestamp,
                {_DQ_SELECT} FROM ({_dq('fct').replace("2000-01-01", f"2002-01-0{n}")})""",
        )
        + ")"
        for n, before in ((1, "1997-01-01"), (2, "1999-01-01"), (3, None))
    ),
    "published_views": _sound(
        _star("fct"),
        """SELECT a.agent_name, count(*) AS total_leads,
             round(count_if(is_connected = 1)::DOUBLE / count(*) * 100, 2) AS connection_rate,
             (SELECT count(*) FROM fct) AS all_leads
           FROM star f JOIN dim_agent a ON f.agent_key = a.agent_key GROUP BY a.agent_key, a.agent_name""",
    ),
    "required_tables": _with(
        f"""SELECT * FROM (VALUES ('dim_lead_status', 1, 0), ('dim_date', 0, 0)) v("table", "exists", "rows")
            UNION ALL SELECT 'dim_agent', 1, count(*) FROM ({_AGENTS.format(facts='fct')})"""
    ),
    "watermark_advance": _with(
        _BATCHED,
        """SELECT max(record_updated_at) FILTER (batch < 3) AS watermark_start,
                  max(record_updated_at) AS watermark_end, count(*) AS staging_rows FROM batched""",
    ),
    "full_refresh": _with("SELECT * FROM leads"),
    "dim_agent": _with(_AGENTS.format(facts="fct")),
    "dim_agent_incremental": _with(
        f"known AS ({_AGENTS.format(facts='(SELECT * FROM fct WHERE location = $$ASIA$$)')})",
        """SELECT * FROM known UNION ALL
           SELECT (SELECT max(agent_key) FROM known) + row_number() OVER (ORDER BY agent_name), agent_name,
             TIMESTAMP '2002-01-02 00:00:00', CAST(NULL AS TIMESTAMP), 1
           FROM (SELECT DISTINCT trim(agent) AS agent_name FROM fct)
           WHERE agent_name <> '' AND agent_name NOT IN (SELECT agent_name FROM known)""",
    ),
    "dim_lead_status": _with(
        """SELECT row_number() OVER (ORDER BY lead_status) AS status_key, lead_status
           FROM (SELECT DISTINCT lower(trim(lead_status)) AS lead_status FROM fct) WHERE lead_status <> ''"""
    ),
    "dim_status_incremental": _with(
        _KNOWN_STATUSES,
        f"""SELECT CAST(status_key AS BIGINT) AS status_key, lead_status FROM known
            UNION ALL
            SELECT 5 + row_number() OVER (ORDER BY lead_status), lead_status
            FROM (SELECT DISTINCT {_NORM} AS lead_status FROM fct)
            WHERE lead_status NOT IN (SELECT lead_status FROM known)""",
    ),
    "dim_date_observed": _with(_days("added_on", "fct")),
    "date_patch": _with(_SPAN.format(first="record_updated_at"), f"SELECT {_calendar('d')} FROM calendar"),
    "dim_date_calendar": _with(
        _SPAN.format(first="record_updated_at"), f"SELECT {_calendar('d')} FROM calendar"
    ),
    "dim_date_gap_fill": _with(
        _SPAN.format(first="record_updated_at"), f"SELECT {_calendar('d')} FROM calendar"
    ),
    "dim_date_range": _with(
        _SPAN.format(first="added_on"),
        """SELECT CAST(min(d) AS VARCHAR) AS min_date, CAST(max(d) AS VARCHAR) AS max_date, count(*) AS dates
           FROM calendar""",
    ),
    "dim_agent_scd2": _with(
        _NAMED,
        f"first_batch AS (SELECT * FROM named WHERE {_batch()} = 1)",
        f"before AS ({_PROFILE} FROM first_batch GROUP BY 1)",
        f"after AS ({_PROFILE} FROM named GROUP BY 1)",
        """dim AS (SELECT row_number() OVER (ORDER BY agent_name) AS agent_key, * FROM before),
           renewed AS (SELECT after.* FROM after LEFT JOIN dim USING (agent_name)
                       WHERE dim.profile IS DISTINCT FROM after.profile)""",
        """SELECT agent_key, agent_name, profile, TIMESTAMP '2002-01-01 00:00:00' AS valid_from,
             CASE WHEN agent_name IN (SELECT agent_name FROM renewed) THEN TIMESTAMP '2002-01-02 00:00:00' END
               AS valid_to,
             CASE WHEN agent_name IN (SELECT agent_name FROM renewed) THEN 0 ELSE 1 END AS is_current
           FROM dim
           UNION ALL
           SELECT (SELECT max(agent_key) FROM dim) + row_number() OVER (ORDER BY agent_name), agent_name, profile,
             TIMESTAMP '2002-01-02 00:00:00', CAST(NULL AS TIMESTAMP), 1 FROM renewed""",
    ),
    "dim_agent_late_changes": _with(_VERSIONS, "SELECT * FROM versions"),
    "star_fact_as_of": _with(
        _VERSIONS,
        """SELECT f.staging_id, trim(f.agent) AS agent, f.added_on, v.valid_from AS version_from, v.profile
           FROM fct f LEFT JOIN versions v ON v.agent_name = trim(f.agent) AND v.valid_from <= f.added_on
             AND (v.valid_to IS NULL OR f.added_on < v.valid_to)""",
    ),
    "scd_retype": _with(
        f"dim AS ({_AGENTS.format(facts='fct')})",
        """SELECT agent_key, agent_name, valid_from,
             CASE WHEN agent_name >= 'NATION_15' AND agent_name < 'NATION_2'
               THEN TIMESTAMP '2003-05-06 07:08:09' END AS valid_to, is_current FROM dim""",
    ),
    "star_fact": _on_star("SELECT * FROM star"),
    "star_missing_keys": _with(
        _star("fct"),
        """SELECT count_if(agent_key IS NULL) AS missing_agent_keys,
             count_if(status_key IS NULL) AS missing_status_keys,
             count_if(date_key IS NULL) AS missing_date_keys FROM star""",
    ),
    "fact_leads": _on_star("SELECT * EXCLUDE (agent, sdr_status, lead_status) FROM star"),
    "vw_leads_analytics": _on_star(f"SELECT {_VIEW} FROM star f {_DIM_JOINS}"),
    "orphans_nonnull": _on_star(
        """SELECT count(*) AS orphan_count FROM star f
           LEFT JOIN (SELECT * FROM dim_day WHERE full_date < '1997-01-01') d ON f.date_key = d.date_key
           WHERE f.date_key IS NOT NULL AND d.date_key IS NULL"""
    ),
    "orphans_all": _with(
        _star("fct"),
        """SELECT count(*) AS orphan_count FROM star f LEFT JOIN dim_agent a ON f.agent_key = a.agent_key
           WHERE a.agent_key IS NULL""",
    ),
    "status_unmatched": _with(
        _KNOWN_STATUSES,
        f"""SELECT count(*) AS unmatched_rows FROM (SELECT {_NORM} AS status FROM fct) f
            LEFT JOIN known k ON f.status = k.lead_status WHERE k.status_key IS NULL""",
    ),
    "lead_funnel": _with(
        f"""SELECT {_COUNTS}, {_pct('is_connected')} AS connection_rate, {_pct('is_invite_sent')} AS invite_rate
            FROM fct"""
    ),
    "lead_funnel_prioritized": _with(
        f"SELECT {_COUNTS}, count_if(is_prioritized = 1) AS prioritized_leads FROM fct"
    ),
    "lead_status": _with(
        """SELECT lead_status, count(*) AS lead_count, count_if(is_contacted = 1) AS contacted_count,
             count_if(is_connected = 1) AS connected_count, count_if(is_hot_lead = 1) AS hot_lead_count
           FROM fct GROUP BY lead_status"""
    ),
    "lead_status_counts": _with(
        "SELECT lead_status, count(*) AS lead_count FROM fct GROUP BY lead_status"
    ),
    "agent_performance": _with(
        f"SELECT agent, {_COUNTS}, {_pct('is_connected')} AS connection_rate FROM fct GROUP BY agent"
    ),
    "agent_performance_prioritized": _with(
        """SELECT agent, count(*) AS total_leads, count_if(is_contacted = 1) AS contacted,
             count_if(is_invite_sent = 1) AS invites_sent, count_if(is_connected = 1) AS connected,
             count_if(is_hot_lead = 1) AS hot_leads, count_if(is_prioritized = 1) AS prioritized
           FROM fct GROUP BY agent"""
    ),
    "star_funnel": _on_star(
        f"""SELECT {_COUNTS}, round({_pct('is_contacted')}, 2) AS contact_rate,
              round({_pct('is_invite_sent')}, 2) AS invite_rate,
              round({_pct('is_connected')}, 2) AS connection_rate FROM star"""
    ),
    "star_agent_performance": _on_star(
        f"""SELECT a.agent_key, a.agent_name, {_STAR_COUNTS}, round({_pct('is_connected')}, 2) AS connection_rate,
              round({_pct('is_hot_lead')}, 2) AS hot_lead_rate
            FROM star f JOIN dim_agent a ON f.agent_key = a.agent_key GROUP BY a.agent_key, a.agent_name"""
    ),
    "star_status": _on_star(
        """SELECT s.status_key, s.lead_status, count(f.staging_id) AS lead_count,
             count_if(is_contacted = 1) AS contacted_count, count_if(is_invite_sent = 1) AS invite_sent_count,
             count_if(is_connected = 1) AS connected_count, count_if(is_hot_lead = 1) AS hot_lead_count
           FROM star f JOIN dim_status s ON f.status_key = s.status_key GROUP BY s.status_key, s.lead_status"""
    ),
    "star_daily_trend": _on_star(
        f"""SELECT d.date_key, d.full_date, d.year, d.month, d.month_name, d.quarter, {_STAR_COUNTS}
            FROM star f JOIN dim_day d ON f.date_key = d.date_key GROUP BY ALL"""
    ),
    "fact_uniqueness": _with(
        """SELECT count(*) AS total_rows, count(DISTINCT staging_id) AS unique_ids,
             CAST(count(*) = count(DISTINCT staging_id) AS INT) AS unique_ids_match FROM fct"""
    ),
    "source_performance": _with(_segment("source")),
    "industry_performance": _with(_segment("industry")),
    "kpi_overview": _with(
        f"""SELECT *, connected_leads::DOUBLE / nullif(invites_sent, 0) * 100 AS acceptance_rate,
              replied_leads::DOUBLE / nullif(contacted_leads, 0) * 100 AS reply_rate,
              connected_leads::DOUBLE / nullif(total_leads, 0) * 100 AS conversion_rate,
              ghosted_leads::DOUBLE / nullif(invites_sent, 0) * 100 AS ghosting_rate,
              rate_limited_leads::DOUBLE / nullif(total_leads, 0) * 100 AS rate_limit_rate
            FROM (SELECT count(*) AS total_leads, count_if(is_contacted = 1) AS contacted_leads,
                    count_if(is_invite_sent = 1) AS invites_sent, count_if(is_connected = 1) AS connected_leads,
                    count_if(lower(trim(coalesce(sdr_status, ''))) = 'replied') AS replied_leads,
                    count_if({_GHOSTED}) AS ghosted_leads,
                    count_if({_NORM} = 'linkedin_rate_limited') AS rate_limited_leads FROM fct)"""
    ),
    "daily_leads": _with(
        """SELECT CAST(CAST(added_on AS DATE) AS VARCHAR) AS added_date, count(*) AS total_leads
           FROM fct GROUP BY 1"""
    ),
    "capacity_overview": _risk(
        """SELECT agent, risk_score, risk_level, 100 AS daily_ceiling, recommended_daily_capacity,
             100 - recommended_daily_capacity AS capacity_reduction FROM risk"""
    ),
    "dq_completeness": _with(
        f"SELECT *, {_S_COMPLETE} AS completeness_score FROM (SELECT {_COMPLETE} FROM fct)"
    ),
    "dq_uniqueness": _with(
        f"SELECT *, {_S_UNIQUE} AS uniqueness_score FROM (SELECT count(*) AS total_rows, {_UNIQUE} FROM fct)"
    ),
    "dq_validity": _with(
        f"SELECT *, {_S_VALID} AS validity_score FROM (SELECT count(*) AS total_rows, {_VALID} FROM fct)"
    ),
    "dq_timeliness": _with(
        f"SELECT *, {_S_TIMELY} AS timeliness_score FROM (SELECT {_TIMELY} FROM leads)"
    ),
    "dq_referential": _with(
        f"""SELECT *, {_S_REFER} AS referential_integrity_score FROM (SELECT count(*) AS total_rows,
            count_if(agent IS NOT NULL AND trim(agent) <> '') AS valid_agent FROM fct)"""
    ),
    "dq_composite": _with(f"SELECT {_DQ_SELECT} FROM ({_dq('fct')})"),
    "dq_history": _with(
        f"""SELECT '20020101000000000000' AS dq_run_id, TIMESTAMP '2002-01-01 00:00:00' AS dq_timestamp,
            {_DQ_SELECT} FROM ({_dq('fct')})"""
    ),
    "risk_base": _with(_RISK_BASE, "SELECT * FROM base"),
    "risk_rates": _with(_RISK_BASE, _RATES, "SELECT * EXCLUDE (s, n) FROM rates"),
    "risk_wilson": _risk(
        "SELECT agent, connected_leads, total_leads, connection_rate_lower_95 FROM scored"
    ),
    "risk_zscore": _risk("SELECT agent, connection_rate, total_leads, connection_rate_zscore FROM scored"),
    "risk_scores": _risk("SELECT * FROM risk"),
    "duplicate_ids": _with(
        """SELECT count(*) AS duplicates
           FROM (SELECT staging_id FROM identified GROUP BY staging_id HAVING count(*) > 1)"""
    ),
    "scd_check": _with(
        f"""SELECT count(*) AS total, count_if(is_current = 1) AS current_rows,
              count(valid_from) AS valid_from_rows, {_SCD_VALID} AS scd_valid FROM ({_AGENTS.format(facts='fct')})"""
    ),
    "scd_check_broken": _with(
        f"""SELECT count(*) AS total, count_if(is_current = 1) AS current_rows,
              count(valid_from) AS valid_from_rows, {_SCD_VALID} AS scd_valid
            FROM (SELECT * REPLACE (CASE WHEN agent_key % 5 > 0 THEN valid_from END AS valid_from)
                  FROM ({_AGENTS.format(facts='fct')}))"""
    ),
    "dim_counts": _on_star(
        """SELECT 'dim_agent' AS dimension, count(*) AS rows FROM dim_agent
           UNION ALL SELECT 'dim_lead_status', count(*) FROM dim_status
           UNION ALL SELECT 'dim_date', count(*) FROM dim_day"""
    ),
    "star_verification_failing": _with(
        _star("fct"),
        "doubled AS (SELECT * FROM star UNION ALL SELECT * FROM star WHERE date_key % 100 = 13)",
        """marked AS (SELECT staging_id, agent_key IS NULL AS no_agent,
             status_key IS NULL OR status_key NOT IN (SELECT status_key FROM dim_status WHERE lead_status <> 'replied') AS no_status,
             date_key IS NULL OR date_key NOT IN (SELECT date_key FROM dim_day WHERE full_date < '1997-01-01') AS no_date
           FROM doubled)""",
        """found AS (SELECT count(*) AS n, count_if(no_agent) AS a, count_if(no_status) AS s, count_if(no_date) AS d,
             (SELECT count(*) FROM (SELECT staging_id FROM marked GROUP BY 1 HAVING count(*) > 1)) AS twice FROM marked)""",
        """SELECT 'fact_rows' AS check, n AS value, CAST(n > 0 AS INT) AS passed FROM found
           UNION ALL SELECT 'duplicate_ids', twice, CAST(twice = 0 AS INT) FROM found
           UNION ALL SELECT 'orphan_agents', a, CAST(a = 0 AS INT) FROM found
           UNION ALL SELECT 'orphan_statuses', s, CAST(s = 0 AS INT) FROM found
           UNION ALL SELECT 'orphan_dates', d, CAST(d = 0 AS INT) FROM found
           UNION ALL SELECT 'scd_structure', count(*), CAST(count(*) > 0 AS INT) FROM dim_agent
           UNION ALL SELECT 'verdict', failed, CAST(failed = 0 AS INT) FROM (
             SELECT CAST(n = 0 AS INT) + CAST(twice > 0 AS INT) + CAST(a > 0 AS INT) + CAST(s > 0 AS INT)
               + CAST(d > 0 AS INT) AS failed FROM found)""",
    ),
    "star_verification": _on_star(
        """SELECT 'fact_rows' AS check, count(*) AS value, CAST(count(*) > 0 AS INT) AS passed FROM star
           UNION ALL SELECT 'duplicate_ids', count(*), CAST(count(*) = 0 AS INT)
             FROM (SELECT staging_id FROM star GROUP BY staging_id HAVING count(*) > 1)
           UNION ALL SELECT 'orphan_agents', count_if(agent_key IS NULL), CAST(count_if(agent_key IS NULL) = 0 AS INT) FROM star
           UNION ALL SELECT 'orphan_statuses', count_if(status_key IS NULL), CAST(count_if(status_key IS NULL) = 0 AS INT) FROM star
           UNION ALL SELECT 'orphan_dates', count_if(date_key IS NULL), CAST(count_if(date_key IS NULL) = 0 AS INT) FROM star
           UNION ALL SELECT 'scd_structure', count(*), CAST(count(*) > 0 AS INT) FROM dim_agent
           UNION ALL SELECT 'verdict', failed, CAST(failed = 0 AS INT) FROM (
             SELECT CAST(count(*) = 0 AS INT) + CAST(count(*) > count(DISTINCT staging_id) AS INT)
               + CAST(count_if(agent_key IS NULL) > 0 AS INT) + CAST(count_if(status_key IS NULL) > 0 AS INT)
               + CAST(count_if(date_key IS NULL) > 0 AS INT) AS failed FROM star)"""
    ),
    "alert_events": _with(
        _LEDGER,
        f"batch_fct AS (SELECT *, {_batch()} AS batch FROM fct)",
        f"""SELECT run_id, 'pipeline_failure' AS event, 'CRITICAL' AS severity, error_message AS detail
            FROM ledger WHERE status = 'FAILED'
            UNION ALL
            SELECT run_id, 'anomalous_run_duration', 'WARNING', 'duration_seconds=' || CAST(rows_read::DOUBLE AS VARCHAR)
            FROM ledger WHERE status = 'SUCCESS' AND rows_read > 300
            UNION ALL
            SELECT 'run-' || batch, 'dq_threshold_breach', 'CRITICAL', 'dq_score=' || CAST(round(composite_dq_score, 2) AS VARCHAR)
            FROM ({_dq('batch_fct', 'batch')}) WHERE composite_dq_score < 95""",
    ),
}
