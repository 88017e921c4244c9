"""The same queries in plain SQL, over the table ``events`` as given.

Rounded quotients are stated in integer arithmetic (half up), so they do not depend on floating-point rounding.
"""

from __future__ import annotations

EVENTS = """
ev AS (
  SELECT
    CASE WHEN event_id % 80 <> 2 THEN ts END AS event_timestamp,
    CAST(event_id AS VARCHAR) AS event_id,
    CASE WHEN event_id % 80 = 1 THEN NULL
         WHEN event_id % 10 < 3 THEN '192.168.0.' || CAST((event_id // 10) % 20 AS VARCHAR)
         ELSE '10.0.0.' || CAST(user_id AS VARCHAR) END AS ip_address,
    CASE WHEN event_id % 80 = 4 THEN 'nowhere'
         ELSE (['SE','NO','FI','DK','PL','CZ','AT','CH','NL','BE','PT','GR','IE','NZ','CL'])[user_id % 15 + 1]
         END AS country,
    event_type AS action,
    CASE WHEN event_id % 80 <> 3 THEN 'campaign_' || CAST(event_id % 10 + 1 AS VARCHAR) END AS campaign_id,
    (['mobile','desktop','tablet'])[event_id % 3 + 1] AS device,
    CASE WHEN event_id % 80 IN (1, 2) OR ts IS NULL THEN 1 ELSE 0 END AS is_malformed
  FROM events
)"""

COUNTS = "unique_users, total_hits, total_clicks, total_views"
LEVEL = """CASE WHEN unique_users = 0 THEN 'UNKNOWN'
     WHEN total_hits < 2 * unique_users THEN 'NORMAL'
     WHEN total_hits < 4 * unique_users THEN 'SUSPICIOUS'
     WHEN total_hits < 7 * unique_users THEN 'HIGH_RISK' ELSE 'CRITICAL' END"""
SUSPICIOUS = "(unique_users > 0 AND 2 * total_hits > 5 * unique_users)"
AS_OF = "TIMESTAMP '2024-01-31 00:05:00'"


def half_up(numerator: str, denominator: str, decimals: int) -> str:
    scale = 10**decimals
    return f"CAST((2 * {scale} * ({numerator}) + ({denominator})) // (2 * ({denominator})) AS DOUBLE) / {scale}"


RATIO = f"CASE WHEN unique_users = 0 THEN 0.0::DOUBLE ELSE {half_up('total_hits', 'unique_users', 2)} END"


def bot_share(ratio: str) -> str:
    return (
        f"CASE WHEN {ratio} <= 1.5 THEN 0.0::DOUBLE "
        f"WHEN {ratio} IS NOT NULL THEN 100.0::DOUBLE / (1.0::DOUBLE + exp(-6.0::DOUBLE * "
        f"(least(1.0::DOUBLE, ({ratio} - 1.5::DOUBLE) / 6.5::DOUBLE) - 0.5::DOUBLE))) END"
    )


def risk(percent: str) -> str:
    return (
        f"CASE WHEN {percent} IS NULL THEN NULL WHEN {percent} < 15 THEN 'LOW RISK' "
        f"WHEN {percent} < 40 THEN 'MODERATE' WHEN {percent} < 70 THEN 'HIGH RISK' ELSE 'CRITICAL' END"
    )


def windows(name: str, width: str, keys: str = "", hits: str = "count(*)") -> str:
    """Common table: window counts by the given keys, with scores."""
    extra = f", {keys}" if keys else ""
    return f"""
{name} AS (
  SELECT *, {RATIO} AS hits_per_user_ratio, {SUSPICIOUS} AS is_suspicious, {LEVEL} AS severity_level
  FROM (
    SELECT time_bucket(INTERVAL '{width}', event_timestamp, TIMESTAMP '1970-01-01') AS window_start,
           time_bucket(INTERVAL '{width}', event_timestamp, TIMESTAMP '1970-01-01') + INTERVAL '{width}' AS window_end
           {extra},
           count(DISTINCT ip_address) AS unique_users,
           {hits} AS total_hits,
           count(*) FILTER (WHERE action = 'click') AS total_clicks,
           count(*) FILTER (WHERE action = 'view') AS total_views,
           CAST(sum(is_malformed) AS BIGINT) AS malformed_events,
           count(*) AS total_events
    FROM ev WHERE event_timestamp IS NOT NULL
    GROUP BY ALL
  )
)"""


TRAFFIC_COLUMNS = f"window_start, window_end, {COUNTS}, hits_per_user_ratio, severity_level"
CAMPAIGN_COLUMNS = f"window_start, window_end, campaign_id, {COUNTS}, hits_per_user_ratio, severity_level"
COUNTRY_COLUMNS = f"window_start, window_end, country, {COUNTS}"
QUALITY_COLUMNS = "window_start, window_end, malformed_events, total_events"
INCIDENT = """CASE severity_level WHEN 'CRITICAL' THEN 'CRITICAL' WHEN 'HIGH_RISK' THEN 'HIGH'
     WHEN 'SUSPICIOUS' THEN 'MEDIUM' ELSE 'LOW' END"""
TAIL = "' - Ratio: ' || CAST(hits_per_user_ratio AS VARCHAR) || ' | Severity: ' || severity_level"


def alerts(source: str, scope: str) -> str:
    if scope == "global":
        key, kind, subject = "'GLOBAL'", "GLOBAL_RATIO_SPIKE", "'Global bot attack'"
    else:
        key, kind, subject = "campaign_id", "RATIO_SPIKE", "'Bot attack on ' || coalesce(campaign_id, '(none)')"
    return f"""SELECT window_start, window_end, {key} AS campaign_id, '{kind}' AS alert_type,
     {INCIDENT} AS severity, {subject} || {TAIL} AS message,
     total_hits, unique_users, hits_per_user_ratio, severity_level
     FROM {source} WHERE is_suspicious"""


def sql(*parts: str) -> str:
    """WITH clause over the event table plus common tables; the last part is the query."""
    return "WITH " + ",".join((EVENTS, *parts[:-1])) + "\n" + parts[-1]


def rolled(width: str, keys: str, columns: str, condition: str = "true") -> str:
    return sql(windows("m", width, keys), f"SELECT {columns} FROM m WHERE {condition}")


HOUR, DAY, WEEK = "1 hour", "1 day", "7 days"
NEWEST_HOUR = "time_bucket(INTERVAL '1 hour', max(event_timestamp), TIMESTAMP '1970-01-01')"


def cutoff(minutes: int, max_staleness: int) -> str:
    return f"""(SELECT CASE WHEN newest >= {AS_OF} - INTERVAL '{max_staleness} minutes' THEN newest
      ELSE {AS_OF} END - INTERVAL '{minutes} minutes' FROM (SELECT {NEWEST_HOUR} AS newest FROM ev))"""


LAST_WEEK = f"window_start >= {cutoff(7 * 24 * 60, 120)}"
CURRENT_DAY = f"window_start >= {AS_OF} - INTERVAL '24 hours'"
MONTH = f"window_start >= {AS_OF} - INTERVAL '744 hours'"
PAST_DAYS = f"""window_start >= {AS_OF} - INTERVAL '240 hours' - INTERVAL '30 minutes' - INTERVAL '72 hours'
  AND window_start <= {AS_OF} - INTERVAL '240 hours' - INTERVAL '30 minutes'"""
SERIES = "window_start, total_hits, unique_users, hits_per_user_ratio"
TOTALS = f"""SELECT campaign_id, total_hits, unique_users, ratio, round({bot_share('ratio')}, 1) AS bot_percent
FROM (
  SELECT campaign_id, h AS total_hits, u AS unique_users,
         CASE WHEN u > 0 THEN {half_up('h', 'u', 2)} END AS ratio
  FROM (SELECT campaign_id, CAST(sum(total_hits) AS BIGINT) AS h, CAST(sum(unique_users) AS BIGINT) AS u
        FROM m WHERE campaign_id IS NOT NULL AND {LAST_WEEK} GROUP BY campaign_id)
)"""
COUNTRY_TOTALS = f"""SELECT country, CAST(sum(total_hits) AS BIGINT) AS total_hits FROM m
WHERE country IS NOT NULL AND {LAST_WEEK} GROUP BY country HAVING sum(total_hits) >= 10"""
MALFORMED_PERCENT = half_up("100 * malformed_events", "total_events", 2)


def status(malformed: str, total: str) -> str:
    return (
        f"CASE WHEN 100 * {malformed} < 2 * {total} OR {total} = 0 THEN 'HEALTHY' "
        f"WHEN 100 * {malformed} < 5 * {total} THEN 'DEGRADED' ELSE 'UNHEALTHY' END"
    )


def recent_alerts(condition: str) -> str:
    return sql(
        windows("c", WEEK, "campaign_id"),
        windows("g", WEEK),
        f"a AS ({alerts('c', 'campaign')} UNION ALL {alerts('g', 'global')})",
        f"""SELECT strftime(window_start, '%H:%M:%S') AS time, coalesce(campaign_id, 'N/A') AS campaign,
          severity_level AS severity, printf('%.2f', hits_per_user_ratio) AS ratio,
          CASE WHEN length(message) > 40 THEN substr(message, 1, 40) || '...' ELSE message END AS message
        FROM (SELECT *, CASE severity_level WHEN 'CRITICAL' THEN 5 WHEN 'HIGH_RISK' THEN 4
                WHEN 'SUSPICIOUS' THEN 3 WHEN 'NORMAL' THEN 2 ELSE 1 END AS rank FROM a
              WHERE {MONTH} AND {condition}
              ORDER BY window_start DESC, rank DESC, campaign_id ASC NULLS LAST LIMIT 5)""",
    )


BASELINES = """
daily AS (
  SELECT campaign_id, CAST(date_diff('day', DATE '1970-01-01', CAST(window_start AS DATE)) AS BIGINT) AS day,
         hits_per_user_ratio AS r FROM m
), learned AS (
  SELECT campaign_id, calibration, count(r) AS samples, avg(r) AS mean_ratio, stddev_samp(r) AS deviation
  FROM (SELECT *, unnest(generate_series(day // 7 + 1, (day + 30) // 7)) AS calibration FROM daily)
  GROUP BY campaign_id, calibration
), thresholds AS (
  SELECT campaign_id, CAST(DATE '1970-01-01' + CAST(calibration * 7 AS INTEGER) AS TIMESTAMP) AS valid_from, samples,
         round(mean_ratio, 6) AS mean_ratio, round(deviation, 6) AS deviation,
         round(mean_ratio + 2 * deviation, 6) AS threshold, mean_ratio + 2 * deviation AS exact_threshold
  FROM learned
)"""

ADDRESSES = """
hourly AS (
  SELECT ip_address, time_bucket(INTERVAL '1 hour', event_timestamp, TIMESTAMP '1970-01-01') AS w, count(*) AS hits,
         count(*) FILTER (WHERE action = 'click') AS clicks,
         min(event_timestamp) AS first_seen, max(event_timestamp) AS last_seen
  FROM ev WHERE event_timestamp IS NOT NULL AND ip_address IS NOT NULL GROUP BY ALL
), activity AS (
  SELECT ip_address, min(first_seen) AS first_seen, max(last_seen) AS last_seen,
         CAST(sum(hits) AS BIGINT) AS total_hits, CAST(sum(clicks) AS BIGINT) AS total_clicks,
         count(*) AS active_windows, max(hits) AS peak_window_hits,
         round(date_diff('microsecond', min(first_seen), max(last_seen)) / 1e6, 3) AS duration_seconds
  FROM hourly GROUP BY ip_address
)"""


def oracle_sql() -> dict[str, str]:
    campaign_week = windows("c", WEEK, "campaign_id")
    global_week = windows("g", WEEK)
    return {
        "parse_events": sql(
            """SELECT date_trunc('milliseconds', event_timestamp) AS event_time, event_id, ip_address, country, action,
            campaign_id, device, is_malformed FROM ev"""
        ),
        "malformed_breakdown": sql(
            """SELECT count(*) AS total_events, CAST(sum(is_malformed) AS BIGINT) AS malformed_events,
            count(*) FILTER (WHERE event_timestamp IS NULL AND ip_address IS NOT NULL) AS bad_time_only,
            count(*) FILTER (WHERE event_timestamp IS NOT NULL AND ip_address IS NULL) AS missing_ip_only,
            count(*) FILTER (WHERE event_timestamp IS NULL AND ip_address IS NULL) AS bad_time_and_missing_ip,
            count(*) FILTER (WHERE campaign_id IS NULL) AS missing_campaign FROM ev"""
        ),
        "deduplicated_events": sql("SELECT event_id, event_timestamp, ip_address, campaign_id FROM ev"),
        "global_metrics": rolled(HOUR, "", TRAFFIC_COLUMNS),
        "campaign_metrics": rolled(HOUR, "campaign_id", CAMPAIGN_COLUMNS),
        "country_metrics": rolled(HOUR, "country", COUNTRY_COLUMNS),
        "quality_metrics": rolled(HOUR, "", QUALITY_COLUMNS),
        "metrics_grouping_sets": sql(
            windows("g", DAY),
            windows("c", DAY, "campaign_id"),
            windows("k", DAY, "country"),
            f"""SELECT window_start, window_end, 'global' AS grain, CAST(NULL AS VARCHAR) AS campaign_id,
              CAST(NULL AS VARCHAR) AS country, {COUNTS}, hits_per_user_ratio, is_suspicious, severity_level FROM g
            UNION ALL SELECT window_start, window_end, 'campaign', campaign_id, NULL, {COUNTS},
              hits_per_user_ratio, is_suspicious, severity_level FROM c
            UNION ALL SELECT window_start, window_end, 'country', NULL, country, {COUNTS},
              hits_per_user_ratio, is_suspicious, severity_level FROM k""",
        ),
        "campaign_metrics_excluding_malformed": (
            rolled(DAY, "campaign_id", CAMPAIGN_COLUMNS).replace(
                "WHERE event_timestamp IS NOT NULL", "WHERE event_timestamp IS NOT NULL AND is_malformed = 0"
            )
        ),
        "campaign_metrics_from_json": rolled(WEEK, "campaign_id", CAMPAIGN_COLUMNS),
        "campaign_metrics_by_sql": sql(
            windows("m", DAY, "campaign_id"),
            f"""SELECT window_start, campaign_id, unique_users, total_hits, hits_per_user_ratio, is_suspicious,
            severity_level, round({bot_share('hits_per_user_ratio')}, 6) AS bot_percent,
            {risk('(' + bot_share('hits_per_user_ratio') + ')')} AS risk_category FROM m""",
        ),
        "click_through_rate": sql(
            windows("m", DAY, "campaign_id"),
            f"""SELECT window_start, campaign_id, total_clicks, total_views, CASE WHEN total_views = 0 THEN 0.0::DOUBLE
            ELSE {half_up('total_clicks', 'total_views', 4)} END AS click_through_rate FROM m""",
        ),
        "campaign_alerts": sql(campaign_week, alerts("c", "campaign")),
        "global_alerts": sql(global_week, alerts("g", "global")),
        "alerts_all": sql(campaign_week, global_week, f"{alerts('c', 'campaign')} UNION ALL {alerts('g', 'global')}"),
        "alerts_three_days": sql(
            windows("c", "3 days", "campaign_id"),
            windows("g", "3 days"),
            f"{alerts('c', 'campaign')} UNION ALL {alerts('g', 'global')}",
        ),
        "quality_alerts": sql(
            windows("m", HOUR),
            f"""SELECT {QUALITY_COLUMNS}, {MALFORMED_PERCENT} AS malformed_percent,
            {status('malformed_events', 'total_events')} AS status
            FROM m WHERE 100 * malformed_events > 5 * total_events""",
        ),
        "bot_estimate": sql(
            windows("m", WEEK, "campaign_id"),
            f"""SELECT window_start, campaign_id, hits_per_user_ratio,
            round({bot_share('hits_per_user_ratio')}, 6) AS bot_percent FROM m""",
        ),
        "risk_category": sql(
            windows("m", WEEK, "campaign_id"),
            f"""SELECT {risk('(' + bot_share('hits_per_user_ratio') + ')')} AS risk_category, severity_level,
            count(*) AS windows FROM m GROUP BY 1, 2""",
        ),
        "top_campaigns": sql(
            windows("m", HOUR, "campaign_id"), f"{TOTALS} ORDER BY total_hits DESC, campaign_id LIMIT 5"
        ),
        "top_countries": sql(
            windows("m", HOUR, "country"), f"{COUNTRY_TOTALS} ORDER BY total_hits DESC, country LIMIT 5"
        ),
        "country_totals": sql(windows("m", HOUR, "country"), COUNTRY_TOTALS),
        "recent_alerts": recent_alerts("true"),
        "recent_alerts_of_campaign": recent_alerts("campaign_id IN ('campaign_2', 'GLOBAL')"),
        "quality_summary": sql(
            windows("m", HOUR),
            f"""SELECT total_events, malformed_events,
            CASE WHEN total_events = 0 THEN 0.0::DOUBLE ELSE {MALFORMED_PERCENT} END AS malformed_percent,
            {status('malformed_events', 'total_events')} AS status
            FROM (SELECT CAST(coalesce(sum(total_events), 0) AS BIGINT) AS total_events,
                         CAST(coalesce(sum(malformed_events), 0) AS BIGINT) AS malformed_events
                  FROM m WHERE {LAST_WEEK})""",
        ),
        "global_series": rolled(HOUR, "", SERIES, LAST_WEEK),
        "campaign_series": rolled(HOUR, "campaign_id", SERIES, f"{LAST_WEEK} AND campaign_id = 'campaign_2'"),
        "campaign_breakdown": rolled(
            HOUR,
            "campaign_id",
            f"""strftime(window_start, '%H:%M:%S') AS time, total_hits AS hits, unique_users AS users,
            hits_per_user_ratio AS ratio, round({bot_share('hits_per_user_ratio')}, 1) AS bot_percent""",
            f"{CURRENT_DAY} AND campaign_id = 'campaign_2'",
        ),
        "range_current": rolled(HOUR, "", TRAFFIC_COLUMNS, CURRENT_DAY),
        "range_historical": rolled(HOUR, "", TRAFFIC_COLUMNS, PAST_DAYS),
        "latest_window": rolled(HOUR, "", TRAFFIC_COLUMNS, "window_start = (SELECT max(window_start) FROM m)"),
        "campaign_profile": sql(
            windows("m", WEEK, "campaign_id"),
            f"""SELECT campaign_id, window_start, total_hits, unique_users, hits_per_user_ratio,
            round({bot_share('hits_per_user_ratio')}, 1) AS bot_percent,
            {risk('(' + bot_share('hits_per_user_ratio') + ')')} AS risk_category
            FROM m WHERE campaign_id = 'campaign_2' ORDER BY window_start DESC LIMIT 1""",
        ),
        "campaign_list": sql("""SELECT DISTINCT campaign_id FROM ev
            WHERE campaign_id IS NOT NULL AND event_timestamp IS NOT NULL"""),
        **dict.fromkeys(("pipeline_health", "stored_health"), sql(
            f"""SELECT coalesce(age < 300, false) AS is_healthy,
            CASE WHEN age IS NULL THEN 'No data in database' WHEN age < 60 THEN 'Pipeline healthy - data is current'
                 WHEN age < 300 THEN 'Pipeline may be catching up' ELSE 'Pipeline appears stopped or delayed' END
                 AS message, age AS staleness_seconds
            FROM (SELECT date_diff('microsecond', {NEWEST_HOUR}, {AS_OF}) / 1e6 AS age FROM ev)"""
        )),
        "data_age": sql(
            f"""SELECT {NEWEST_HOUR} AS latest_window,
            date_diff('microsecond', {NEWEST_HOUR}, {AS_OF}) / 1e6 AS age_seconds FROM ev"""
        ),
        "smart_cutoff": sql(f"SELECT {cutoff(5, 120)} AS cutoff"),
        "smart_cutoff_stale": sql(f"SELECT {cutoff(5, 10)} AS cutoff"),
        "recent_activity": sql(
            windows("m", HOUR),
            f"""SELECT count(*) AS recent_windows, count(*) > 0 AS is_active FROM m
            WHERE window_start >= {AS_OF} - INTERVAL '180 minutes'""",
        ),
        "tracer_lookup": sql(
            windows("m", HOUR, "campaign_id"),
            """SELECT campaign_id, window_start, total_hits FROM m WHERE campaign_id = 'campaign_2'
            ORDER BY window_start DESC LIMIT 1""",
        ),
        "table_stats": sql(
            windows("g", HOUR),
            windows("c", HOUR, "campaign_id"),
            windows("k", HOUR, "country"),
            f"a AS ({alerts('c', 'campaign')} UNION ALL {alerts('g', 'global')})",
            """SELECT 'traffic_metrics' AS table_name, count(*) AS row_count, max(window_start) AS latest_window FROM g
            UNION ALL SELECT 'campaign_metrics', count(*), max(window_start) FROM c
            UNION ALL SELECT 'country_metrics', count(*), max(window_start) FROM k
            UNION ALL SELECT 'quality_metrics', count(*), max(window_start) FROM g
            UNION ALL SELECT 'alerts', count(*), max(window_start) FROM a""",
        ),
        "ingest_rate": sql(
            """SELECT time_bucket(INTERVAL '1 minute', event_timestamp, TIMESTAMP '1970-01-01') AS bucket_start,
            count(*) AS events, count(*) / 60.0::DOUBLE AS events_per_second
            FROM ev WHERE event_timestamp IS NOT NULL GROUP BY 1"""
        ),
        "approx_users_bound": sql(
            windows("m", DAY, "campaign_id"),
            "SELECT window_start, campaign_id, unique_users AS exact_users, true AS within_bound FROM m",
        ),
        "sketch_merge_bound": sql(
            windows("m", DAY),
            "SELECT window_start, total_hits, unique_users AS exact_users, true AS within_bound FROM m",
        ),
        "learned_thresholds": sql(
            windows("m", HOUR, "campaign_id"),
            BASELINES,
            "SELECT campaign_id, valid_from, samples, mean_ratio, deviation, threshold FROM thresholds",
        ),
        "above_baseline": sql(
            windows("m", HOUR, "campaign_id"),
            BASELINES,
            """SELECT m.window_start, m.campaign_id, m.hits_per_user_ratio, t.threshold
            FROM m JOIN thresholds t ON m.campaign_id IS NOT DISTINCT FROM t.campaign_id
             AND t.valid_from <= m.window_start AND m.window_start < t.valid_from + INTERVAL '7 days'
            WHERE m.hits_per_user_ratio > t.exact_threshold""",
        ),
        "address_activity": sql(ADDRESSES, "SELECT * FROM activity"),
        "low_and_slow": sql(
            ADDRESSES,
            """SELECT ip_address, total_hits, active_windows, peak_window_hits FROM activity
            WHERE active_windows >= 20 AND peak_window_hits <= 2""",
        ),
        "detection_quality": sql(
            windows("m", WEEK, "campaign_id"),
            f"""
truth AS (
  SELECT time_bucket(INTERVAL '{WEEK}', event_timestamp, TIMESTAMP '1970-01-01') AS w, campaign_id AS campaign,
         2 * count(*) FILTER (WHERE ip_address LIKE '192.168.0.%') > count(*) AS a
  FROM ev WHERE event_timestamp IS NOT NULL GROUP BY ALL
)""",
            """SELECT true_positives, false_positives, false_negatives, true_negatives,
            CASE WHEN true_positives + false_positives > 0
                 THEN round(true_positives / (true_positives + false_positives), 6) END AS precision,
            CASE WHEN true_positives + false_negatives > 0
                 THEN round(true_positives / (true_positives + false_negatives), 6) END AS recall,
            CASE WHEN 2 * true_positives + false_positives + false_negatives > 0
                 THEN round(2 * true_positives / (2 * true_positives + false_positives + false_negatives), 6) END AS f1
            FROM (SELECT count(*) FILTER (WHERE p AND a) AS true_positives,
                         count(*) FILTER (WHERE p AND NOT a) AS false_positives,
                         count(*) FILTER (WHERE NOT p AND a) AS false_negatives,
                         count(*) FILTER (WHERE NOT p AND NOT a) AS true_negatives
                  FROM (SELECT is_suspicious AS p, a FROM m
                        JOIN truth ON w = window_start AND campaign IS NOT DISTINCT FROM campaign_id))""",
        ),
        "stream_global_metrics": rolled(HOUR, "", TRAFFIC_COLUMNS),
        "stream_campaign_metrics": rolled(HOUR, "campaign_id", CAMPAIGN_COLUMNS),
        "stream_country_metrics": rolled(HOUR, "country", COUNTRY_COLUMNS),
        "stream_quality_metrics": rolled(HOUR, "", QUALITY_COLUMNS),
        "stream_alerts": sql(
            campaign_week,
            global_week,
            f"""SELECT * FROM ({alerts('c', 'campaign')} UNION ALL {alerts('g', 'global')})""",
        ),
        "stream_unique_events": rolled(DAY, "", TRAFFIC_COLUMNS),
        "stream_users_bound": rolled(
            DAY,
            "campaign_id",
            "window_start, campaign_id, total_hits, unique_users AS exact_users, true AS within_bound",
        ),
        "stored_campaign_totals": sql(windows("m", HOUR, "campaign_id"), TOTALS),
        **dict.fromkeys(
            ("stored_after_two_backfills", "stored_after_new_checkpoint", "stored_stream_then_backfill"),
            rolled(HOUR, "campaign_id", CAMPAIGN_COLUMNS),
        ),
        "stored_global_series": rolled(HOUR, "", SERIES, LAST_WEEK),
    }
