"""Volume-signal queries over the lineitem adapter."""

from __future__ import annotations

from ..operators import signals as S
from ..sources.adapters import event_complaints, volume_complaints
from .registry import register

# DuckDB view of lineitem in the complaint model (mirrors sources.adapters.volume_complaints).
VOLUME_CTE = """
c AS (
  SELECT l_orderkey * 8 + l_linenumber AS complaint_id, l_shipdate AS date_received,
         l_returnflag AS product, l_linestatus AS company
  FROM lineitem),
last_day AS (SELECT max(CAST(date_received AS DATE)) AS d FROM c)
"""

EVENTS_CTE = """
c AS (
  SELECT event_id AS complaint_id, ts AS date_received, event_type AS product,
         'user-' || CAST(user_id AS VARCHAR) AS company
  FROM events),
last_day AS (SELECT max(CAST(date_received AS DATE)) AS d FROM c)
"""


def _level(z: str, g: str) -> str:
    return (f"CASE WHEN {z} >= 3 THEN 'Critical' WHEN {z} >= 2 THEN 'Warning' "
            f"WHEN {g} >= 40 THEN 'Watch' ELSE 'Normal' END")


def _signals_sql(cte: str, grain: str, keys: str, order: str, rows: int, lag: int,
                 avg_name: str, cnt_name: str, status: str) -> str:
    return f"""
WITH {cte},
m AS ({grain}),
s AS (
  SELECT *,
    avg(complaint_count) OVER fr AS {avg_name},
    count(complaint_count) OVER fr AS {cnt_name},
    round(CAST(complaint_count - lag(complaint_count, {lag}) OVER o AS DOUBLE) * 100.0
          / CAST(nullif(lag(complaint_count, {lag}) OVER o, 0) AS DOUBLE), 2) AS week_over_week_growth,
    round((complaint_count - avg(complaint_count) OVER fr)
          / nullif(stddev_samp(complaint_count) OVER fr, 0), 2) AS anomaly_z_score
  FROM m
  WINDOW o AS (PARTITION BY {keys} ORDER BY {order}),
         fr AS (PARTITION BY {keys} ORDER BY {order} ROWS BETWEEN {rows} PRECEDING AND 1 PRECEDING))
SELECT *, {_level('anomaly_z_score', 'week_over_week_growth')} AS alert_level,
       CASE WHEN {status} THEN 'Complete' ELSE 'Incomplete' END AS data_status
FROM s"""


WEEKLY_GRAIN = ("SELECT CAST(date_trunc('week', date_received) AS DATE) AS week_start, product, company, "
                "count(*) AS complaint_count FROM c GROUP BY 1, 2, 3")
DAILY_GRAIN = ("SELECT CAST(date_received AS DATE) AS complaint_date, product, "
               "count(*) AS complaint_count FROM c GROUP BY 1, 2")

COMPANY_SIGNALS_SQL = _signals_sql(
    VOLUME_CTE, WEEKLY_GRAIN, "product, company", "week_start", 4, 1,
    "rolling_4_week_average", "baseline_weeks", "week_start + 6 <= (SELECT d FROM last_day) - 14")


def _product_signals_sql(cte: str) -> str:
    return _signals_sql(cte, DAILY_GRAIN, "product", "complaint_date", 28, 7,
                        "rolling_28_day_average", "baseline_days",
                        "complaint_date <= (SELECT d FROM last_day) - 14")


PRODUCT_SIGNALS_SQL = _product_signals_sql(VOLUME_CTE)


def _alerts_body(min_count: int) -> str:
    # Wrap the signal statement and apply the alert gates of F9.
    return f"""
SELECT sha256(CAST(week_start AS VARCHAR) || product || company) AS alert_id,
       week_start AS alert_date, product, company,
       complaint_count AS current_value,
       round(rolling_4_week_average, 2) AS baseline_value,
       week_over_week_growth, anomaly_z_score, alert_level,
       company || ' recorded ' || CAST(complaint_count AS VARCHAR) || ' ' || product
         || ' complaints versus a baseline of '
         || CAST(CAST(round(rolling_4_week_average, 2) AS DECIMAL(38,2)) AS VARCHAR)
         || '. Weekly growth was '
         || CAST(CAST(week_over_week_growth AS DECIMAL(38,2)) AS VARCHAR) || '%.' AS alert_explanation
FROM sig
WHERE data_status = 'Complete' AND baseline_weeks >= 3 AND complaint_count >= {min_count}
  AND week_start + 6 <= (SELECT max(CAST(l_shipdate AS DATE)) FROM lineitem) - 21
  AND alert_level IN ('Watch', 'Warning', 'Critical')"""


def alerts_sql(min_count: int = 20) -> str:
    return f"WITH sig AS ({COMPANY_SIGNALS_SQL}\n)\n{_alerts_body(min_count)}"


@register("weekly_company_metrics", f"WITH {VOLUME_CTE}\n{WEEKLY_GRAIN}")
def q_weekly(spark, sf):
    return S.weekly_company_metrics(volume_complaints(spark, sf))


@register("daily_product_metrics", f"WITH {VOLUME_CTE}\n{DAILY_GRAIN}")
def q_daily(spark, sf):
    return S.daily_product_metrics(volume_complaints(spark, sf))


@register("company_risk_signals", COMPANY_SIGNALS_SQL)
def q_company_signals(spark, sf):
    return S.company_risk_signals(volume_complaints(spark, sf))


@register("product_risk_signals", PRODUCT_SIGNALS_SQL)
def q_product_signals(spark, sf):
    return S.product_risk_signals(volume_complaints(spark, sf))


@register("event_product_signals", _product_signals_sql(EVENTS_CTE))
def q_event_signals(spark, sf):
    return S.product_risk_signals(event_complaints(spark, sf))


@register("risk_alerts", alerts_sql(20))
def q_alerts(spark, sf):
    return S.risk_alerts(volume_complaints(spark, sf))


@register("alerts_ordered", f"""
SELECT *, CAST(CASE alert_level WHEN 'Critical' THEN 1 WHEN 'Warning' THEN 2 WHEN 'Watch' THEN 3
                    ELSE 0 END AS INTEGER) AS severity_rank
FROM ({alerts_sql(20)}) a""")
def q_alerts_ordered(spark, sf):
    return S.alerts_ordered(S.risk_alerts(volume_complaints(spark, sf)))


@register("alert_summary", f"""
SELECT count(*) AS total_alerts,
       count(*) FILTER (WHERE alert_level = 'Critical') AS critical_alerts,
       count(*) FILTER (WHERE alert_level = 'Warning') AS warning_alerts,
       count(*) FILTER (WHERE alert_level = 'Watch') AS watch_alerts
FROM ({alerts_sql(20)}) a""")
def q_alert_summary(spark, sf):
    return S.alert_summary(S.risk_alerts(volume_complaints(spark, sf)))


def _latest_sql(signals_sql: str) -> str:
    return f"""
WITH ps AS ({signals_sql}
), ok AS (SELECT * FROM ps WHERE data_status = 'Complete' AND baseline_days >= 14)
SELECT complaint_date, product, complaint_count,
       round(rolling_28_day_average, 2) AS rolling_28_day_average,
       week_over_week_growth, anomaly_z_score, alert_level
FROM ok WHERE complaint_date = (SELECT max(complaint_date) FROM ok)"""


@register("latest_product_status", _latest_sql(PRODUCT_SIGNALS_SQL))
def q_latest(spark, sf):
    return S.latest_product_status(S.product_risk_signals(volume_complaints(spark, sf)))


@register("event_latest_status", _latest_sql(_product_signals_sql(EVENTS_CTE)))
def q_event_latest(spark, sf):
    return S.latest_product_status(S.product_risk_signals(event_complaints(spark, sf)))


def flagship(spark, sf, min_count: int = 20):
    """Entry-point query: gated company alerts, most severe first."""
    return S.alerts_ordered(S.risk_alerts(volume_complaints(spark, sf), min_count=min_count))



# A10 + D1 through the SQL API: DataFrames passed as query parameters (no global views).
ALERTS_VIEW_SQL = """
SELECT sha2(concat(CAST(week_start AS STRING), product, company), 256) AS alert_id,
       week_start AS alert_date, product, company, complaint_count AS current_value,
       round(rolling_4_week_average, 2) AS baseline_value, week_over_week_growth,
       anomaly_z_score, alert_level,
       concat(company, ' recorded ', CAST(complaint_count AS STRING), ' ', product,
              ' complaints versus a baseline of ',
              CAST(CAST(round(rolling_4_week_average, 2) AS DECIMAL(38,2)) AS STRING),
              '. Weekly growth was ', CAST(CAST(week_over_week_growth AS DECIMAL(38,2)) AS STRING),
              '%.') AS alert_explanation
FROM {signals}
WHERE data_status = 'Complete' AND baseline_weeks >= 3 AND complaint_count >= 20
  AND date_add(week_start, 6) <= date_sub((SELECT max(complaint_date) FROM {daily}), 21)
  AND alert_level IN ('Watch', 'Warning', 'Critical')"""


@register("risk_alerts_sql", alerts_sql(20))
def q_alerts_sql(spark, sf):
    vol = volume_complaints(spark, sf)
    return spark.sql(ALERTS_VIEW_SQL, signals=S.company_risk_signals(vol),
                     daily=S.daily_product_metrics(vol))
