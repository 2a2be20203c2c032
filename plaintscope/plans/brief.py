"""Executive brief query: alerts and product status (lineitem) + themes (documents)."""

from __future__ import annotations

from ..operators import brief as B
from ..operators import signals as S
from ..operators import themes as TH
from ..sources.adapters import narrative_complaints, volume_complaints
from ..session import cut_lineage
from .registry import register
from .themes import THEMES_WITH, sql_dec2
from .volume import PRODUCT_SIGNALS_SQL, _latest_sql, alerts_sql


def _sql_fixed(section: int, texts, start: int = 0, item: str = "''") -> str:
    return " UNION ALL ".join(
        f"SELECT {section} AS section, 0 AS severity, 0.0 AS z_order, {item} AS item, {start + i} AS sub, "
        f"'{t.replace(chr(39), chr(39) * 2)}' AS line" for i, t in enumerate(texts))


def _brief_sql() -> str:
    return f"""
WITH al AS ({alerts_sql(20)}),
ps AS ({_latest_sql(PRODUCT_SIGNALS_SQL)}),
th AS ({THEMES_WITH}
SELECT * FROM themes),
cnt AS (SELECT count(*) AS n, count(*) FILTER (WHERE alert_level = 'Critical') AS c,
               count(*) FILTER (WHERE alert_level = 'Warning') AS w,
               count(*) FILTER (WHERE alert_level = 'Watch') AS v FROM al),
top AS (SELECT *, row_number() OVER (PARTITION BY product ORDER BY theme_rank) AS k FROM th
        QUALIFY k <= 5)
{_sql_fixed(1, ["# Complaint watch report", ""])}
UNION ALL SELECT 1, 0, 0.0, '', 2, 'Settled up to '
   || CAST(coalesce((SELECT max(complaint_date) FROM ps), current_date) AS VARCHAR)
UNION ALL {_sql_fixed(1, [""], start=3)}
UNION ALL {_sql_fixed(2, B.SUMMARY)}
UNION ALL SELECT 2, 0, 0.0, '', 10 + i, '| ' || name || ' | ' || CAST(k AS VARCHAR) || ' |' FROM (
  SELECT 0 AS i, 'Critical' AS name, c AS k FROM cnt UNION ALL SELECT 1, 'Warning', w FROM cnt
  UNION ALL SELECT 2, 'Watch', v FROM cnt UNION ALL SELECT 3, 'all', n FROM cnt) levels
UNION ALL {_sql_fixed(3, B.PRODUCTS)}
UNION ALL SELECT 3, 0, 0.0, product, 10, '| ' || product || ' | ' || CAST(complaint_count AS VARCHAR) || ' | '
   || coalesce({sql_dec2('rolling_28_day_average')}, '-') || ' | ' || coalesce({sql_dec2('week_over_week_growth')}, '-')
   || ' | ' || coalesce(alert_level, '-') || ' |' FROM ps
UNION ALL {_sql_fixed(4, B.ALERTS)}
UNION ALL SELECT 4, CASE alert_level WHEN 'Critical' THEN 1 WHEN 'Warning' THEN 2 WHEN 'Watch' THEN 3 ELSE 0 END,
   -coalesce(anomaly_z_score, 0.0), concat_ws('|', CAST(alert_date AS VARCHAR), product, company), 10,
   '| ' || CAST(alert_date AS VARCHAR) || ' | ' || company || ' | ' || product || ' | ' || alert_level || ' | '
   || coalesce(CAST(anomaly_z_score AS VARCHAR), '-') || ' | ' || coalesce(alert_explanation, '-') || ' |' FROM al
UNION ALL {_sql_fixed(5, B.THEMES)}
UNION ALL SELECT 6, 0, 0.0, product, s, t FROM (SELECT DISTINCT product FROM top) p,
   (VALUES (0, NULL), (1, ''), (99, '')) v(s, t0), LATERAL (SELECT coalesce(t0, '**' || product || '**') AS t)
UNION ALL SELECT 6, 0, 0.0, product, CAST(k + 1 AS INTEGER), CAST(k AS VARCHAR) || '. ' || term || ' (in '
   || CAST(recent_mentions AS VARCHAR) || ' narratives, share up '
   || coalesce({sql_dec2('growth_rate_percent')}, '-') || ' %)' FROM top
UNION ALL {_sql_fixed(7, B.READING)}"""


def lines(spark, sf, text_sf=None):
    vol = volume_complaints(spark, sf)
    alerts = S.risk_alerts(vol)
    status = S.latest_product_status(S.product_risk_signals(vol))
    themes = cut_lineage(TH.emerging_themes(narrative_complaints(spark, text_sf or sf)))
    return B.brief_lines(alerts, status, themes)


@register("executive_brief", _brief_sql())
def q_brief(spark, sf):
    return lines(spark, sf)
