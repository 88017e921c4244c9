"""The queries of ``extensions`` in plain SQL, over the table ``events`` as given."""

from __future__ import annotations

from adpulse.catalog import oracles
from adpulse.catalog.oracles import (
    BASELINES,
    CAMPAIGN_COLUMNS,
    DAY,
    HOUR,
    LAST_WEEK,
    MALFORMED_PERCENT,
    QUALITY_COLUMNS,
    WEEK,
    alerts,
    rolled,
    sql,
    status,
    windows,
)

STRETCHES = """
hourly AS (
  SELECT ip_address, time_bucket(INTERVAL '1 hour', event_timestamp, TIMESTAMP '1970-01-01') AS w, count(*) AS hits,
         count(*) FILTER (WHERE action = 'click') AS clicks,
         min(event_timestamp) AS first_seen, max(event_timestamp) AS last_seen
  FROM ev WHERE event_timestamp IS NOT NULL AND ip_address IS NOT NULL GROUP BY ALL
), marked AS (
  SELECT *, CASE WHEN w - lag(w + INTERVAL '1 hour') OVER o <= INTERVAL '6 hours' THEN 0 ELSE 1 END AS opens
  FROM hourly WINDOW o AS (PARTITION BY ip_address ORDER BY w)
), numbered AS (
  SELECT *, sum(opens) OVER (PARTITION BY ip_address ORDER BY w) AS stretch FROM marked
)"""
STRETCH_ROWS = """SELECT min(w) AS window_start, max(w) + INTERVAL '1 hour' AS window_end, ip_address,
  min(first_seen) AS first_seen, max(last_seen) AS last_seen, CAST(sum(hits) AS BIGINT) AS total_hits,
  CAST(sum(clicks) AS BIGINT) AS total_clicks, count(*) AS active_windows, max(hits) AS peak_window_hits,
  date_diff('microsecond', min(first_seen), max(last_seen)) / 1e6 AS duration_seconds,
  count(*) >= 3 AND max(hits) <= 2 AS is_low_and_slow
FROM numbered GROUP BY ip_address, stretch"""

# JSON carries milliseconds.
IN_MILLISECONDS = ("THEN ts END", "THEN date_trunc('milliseconds', ts) END")
HELD_OUT = "CAST('0x' || substr(md5(ip_address), 1, 4) AS BIGINT) % 4 = 0"

FEATURES = f"""
kinds AS (
  SELECT *, time_bucket(INTERVAL '{DAY}', event_timestamp, TIMESTAMP '1970-01-01') AS w
  FROM ev WHERE event_timestamp IS NOT NULL AND ip_address IS NOT NULL
), tops AS (
  SELECT ip_address, w, max(n) AS top FROM (
    SELECT ip_address, w, campaign_id, count(*) AS n FROM kinds WHERE campaign_id IS NOT NULL GROUP BY ALL
  ) GROUP BY ALL
), sums AS (
  SELECT ip_address, w, count(*) AS hits, count(*) FILTER (WHERE action = 'click') AS clicks,
         count(DISTINCT campaign_id) AS campaigns, count(DISTINCT country) AS countries, count(DISTINCT device) AS devices,
         count(*) FILTER (WHERE campaign_id IS NULL) AS without,
         date_diff('microsecond', min(event_timestamp), max(event_timestamp)) / 1e6 AS span
  FROM kinds GROUP BY ALL
), features AS (
  SELECT ip_address, w AS window_start, w + INTERVAL '{DAY}' AS window_end, hits, clicks / hits AS click_share,
         campaigns, countries, devices, coalesce(top, 0) / hits AS top_campaign_share,
         without / hits AS no_campaign_share, span AS span_seconds,
         CASE WHEN hits > 1 THEN span / (hits - 1) ELSE 0.0::DOUBLE END AS mean_pause_seconds
  FROM sums LEFT JOIN tops USING (ip_address, w)
)"""

LEARNED = f"""
spans AS (
  SELECT campaign_id AS campaign, valid_from, exact_threshold,
         lead(valid_from) OVER (PARTITION BY campaign_id ORDER BY valid_from) AS valid_until
  FROM thresholds WHERE exact_threshold IS NOT NULL
), c AS (
  SELECT m.* REPLACE (coalesce(hits_per_user_ratio > exact_threshold, is_suspicious) AS is_suspicious)
  FROM m LEFT JOIN spans ON campaign IS NOT DISTINCT FROM campaign_id AND CAST(window_start AS DATE) >= valid_from
    AND (valid_until IS NULL OR CAST(window_start AS DATE) < valid_until)
)"""


def drift(width: str, value: str, scope: str, history: int, min_history: int, min_hits: int, threshold: float) -> str:
    """``scope`` is a column or a constant."""
    return sql(
        f"""
k AS (
  SELECT time_bucket(INTERVAL '{width}', event_timestamp, TIMESTAMP '1970-01-01') AS window_start, {scope} AS scope,
         {value} AS value, count(*) AS hits
  FROM ev WHERE event_timestamp IS NOT NULL GROUP BY ALL
), numbered AS (
  SELECT *, epoch_us(window_start) // epoch_us(TIMESTAMP '1970-01-01' + INTERVAL '{width}') AS number FROM k
), own AS (
  SELECT *, coalesce(sum(hits) OVER (PARTITION BY scope, value ORDER BY number
    RANGE BETWEEN {history} PRECEDING AND 1 PRECEDING), 0) AS before FROM numbered
), totals AS (
  SELECT scope, number, total, coalesce(sum(total) OVER o, 0) AS total_before, count(total) OVER o AS windows_before
  FROM (SELECT scope, number, sum(hits) AS total FROM numbered GROUP BY ALL)
  WINDOW o AS (PARTITION BY scope ORDER BY number RANGE BETWEEN {history} PRECEDING AND 1 PRECEDING)
), joined AS (
  SELECT own.*, total, total_before, windows_before, hits * total_before - before * total AS rise
  FROM own JOIN totals ON own.scope IS NOT DISTINCT FROM totals.scope AND own.number = totals.number
), sums AS (
  SELECT window_start, scope, total, total_before, windows_before,
         (sum(abs(rise)) + total * (total_before - sum(before)))::DOUBLE / nullif(total * total_before, 0) / 2 AS drift
  FROM joined GROUP BY window_start, scope, total, total_before, windows_before
), most AS (
  SELECT * FROM joined QUALIFY row_number() OVER (PARTITION BY scope, number ORDER BY rise DESC, value DESC NULLS LAST) = 1
)""",
        f"""SELECT sums.window_start{'' if scope.startswith("'") else f', sums.scope AS {scope}'},
  CAST(sums.total AS BIGINT) AS total_hits, CAST(sums.total_before AS BIGINT) AS baseline_hits, round(drift, 6) AS drift,
  value, round(hits / sums.total, 6) AS value_share,
  CASE WHEN sums.total_before > 0 THEN round(before / sums.total_before, 6) END AS baseline_share,
  coalesce(sums.total >= {min_hits} AND sums.windows_before >= {min_history} AND drift >= {threshold}, false) AS is_alert
FROM sums JOIN most ON sums.window_start = most.window_start AND sums.scope IS NOT DISTINCT FROM most.scope""",
    )


def oracle_sql() -> dict[str, str]:
    learned = sql(
        windows("m", HOUR, "campaign_id"),
        windows("g", HOUR),
        BASELINES,
        LEARNED,
        f"{alerts('c', 'campaign')} UNION ALL {alerts('g', 'global')}",
    )
    sessions = sql(STRETCHES, STRETCH_ROWS)
    table_stats = oracles.oracle_sql()["table_stats"]
    return {
        "address_sessions": sessions,
        "stream_address_activity": sessions.replace(*IN_MILLISECONDS),
        "stored_distinct_campaign_users": sql(
            """SELECT campaign_id, count(*) AS total_hits, count(DISTINCT ip_address) AS exact_users, true AS within_bound
            FROM ev WHERE event_timestamp IS NOT NULL GROUP BY campaign_id"""
        ),
        "metrics_lattice": sql(
            windows("g", DAY),
            windows("c", DAY, "campaign_id"),
            windows("k", DAY, "country"),
            """SELECT window_start, 'global' AS grain, CAST(NULL AS VARCHAR) AS campaign_id, CAST(NULL AS VARCHAR) AS country,
              total_hits, total_clicks, total_views, unique_users AS exact_users, true AS within_bound FROM g
            UNION ALL SELECT window_start, 'campaign', campaign_id, NULL, total_hits, total_clicks, total_views, unique_users, true FROM c
            UNION ALL SELECT window_start, 'country', NULL, country, total_hits, total_clicks, total_views, unique_users, true FROM k""",
        ),
        "address_features": sql(FEATURES, "SELECT * FROM features"),
        "bot_classifier": sql(
            FEATURES,
            f"""SELECT count(*) FILTER (WHERE ip_address LIKE '192.168.0.%') AS held_out_bot_windows,
            count(*) FILTER (WHERE ip_address NOT LIKE '192.168.0.%') AS held_out_other_windows, true AS is_accurate
            FROM features WHERE {HELD_OUT}""",
        ),
        "learned_alerts": learned,
        "stream_learned_alerts": learned,
        "stream_untimed_events": sql(
            """SELECT event_id, ip_address, country, action, campaign_id, device, count(*) AS copies
            FROM ev WHERE event_timestamp IS NULL GROUP BY ALL"""
        ),
        "stream_quality_alerts": sql(
            windows("m", HOUR),
            f"""SELECT {QUALITY_COLUMNS}, {MALFORMED_PERCENT} AS malformed_percent, 'event_time' AS source,
            {status('malformed_events', 'total_events')} AS status
            FROM m WHERE 100 * malformed_events > 5 * total_events""",
        ),
        "stream_late_events": sql(
            f"""
timed AS (
  SELECT CAST(event_id AS BIGINT) % 50 = 7 AS late, event_timestamp,
         time_bucket(INTERVAL '{HOUR}', event_timestamp, TIMESTAMP '1970-01-01') AS window_start,
         time_bucket(INTERVAL '{HOUR}', event_timestamp, TIMESTAMP '1970-01-01') + INTERVAL '{HOUR}' AS window_end
  FROM ev WHERE event_timestamp IS NOT NULL
), passed AS (SELECT max(event_timestamp) - INTERVAL '30 seconds' AS mark, max(window_end) AS closed FROM timed WHERE NOT late)""",
            """SELECT window_start, window_end, count(*) AS arrived_events,
            count(*) FILTER (WHERE NOT (late AND window_end <= mark)) AS counted_events,
            count(*) FILTER (WHERE late AND window_end <= mark) AS late_events
            FROM timed, passed WHERE window_end <= closed GROUP BY ALL""",
        ).replace(*IN_MILLISECONDS),
        "stream_arrival_totals": sql(
            """SELECT count(*) + 1 AS events, count(*) FILTER (WHERE event_timestamp IS NULL) AS untimed_events,
            CAST(sum(is_malformed) + 1 AS BIGINT) AS malformed_events, 3::BIGINT AS batches FROM ev"""
        ),
        "stream_restarted": rolled(HOUR, "campaign_id", CAMPAIGN_COLUMNS),
        **dict.fromkeys(("stream_fan_out", "stream_query_per_table"), table_stats),
        "stream_updated_windows": rolled(HOUR, "", QUALITY_COLUMNS),
        "stream_in_event_zone": rolled(HOUR, "campaign_id", CAMPAIGN_COLUMNS),
        "stream_alert_stamps": sql(
            windows("c", WEEK, "campaign_id"),
            windows("g", WEEK),
            """SELECT window_start, campaign_id, true AS is_stamped FROM c WHERE is_suspicious
            UNION ALL SELECT window_start, 'GLOBAL', true FROM g WHERE is_suspicious""",
        ),
        "stream_state_size": sql(windows("m", HOUR), "SELECT count(*) AS closed_windows, 1::BIGINT AS state_rows FROM m"),
        "stored_compacted": rolled(HOUR, "campaign_id", CAMPAIGN_COLUMNS),
        "stored_series_in_zone": rolled(
            HOUR,
            "",
            "window_start + INTERVAL '2 hours' AS window_start, total_hits, unique_users, hits_per_user_ratio",
            LAST_WEEK,
        ),
        "processing_lag": rolled(HOUR, "", "window_start, true AS is_plausible"),
        "country_drift": drift(HOUR, "country", "''", 24, 12, 20, 0.3),
        "device_drift": drift(DAY, "device", "campaign_id", 7, 3, 10, 0.1),
        "heavy_addresses": sql(
            """SELECT ip_address, count(*) AS exact_hits, true AS within_bound FROM ev
            WHERE event_timestamp IS NOT NULL AND ip_address IS NOT NULL GROUP BY ip_address
            HAVING count(*) >= 0.01 * (SELECT count(*) FROM ev WHERE event_timestamp IS NOT NULL AND ip_address IS NOT NULL)"""
        ),
    }
