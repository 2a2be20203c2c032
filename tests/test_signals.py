"""Rolling-baseline signals and alert gates (FIXTURES F5)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from plaintscope.operators import signals as S

MONDAY = dt.date(2026, 5, 4)


def _weekly_rows(company, counts, start=MONDAY):
    rows = []
    for i, n in enumerate(counts):
        day = dt.datetime.combine(start + dt.timedelta(weeks=i), dt.time(12))
        rows += [(f"{company}-{i}-{j}", day, "Credit card", company) for j in range(n)]
    return rows


def _frame(spark, rows):
    return spark.createDataFrame(rows, "complaint_id string, date_received timestamp_ntz, "
                                       "product string, company string")


# Goldens (FIXTURES F5): prior weeks + current, baseline, growth %, z, level.
GOLDEN = [
    ("A", [15, 18, 18, 32], 17.00, 77.78, 8.66, "Critical"),
    ("B", [16, 19, 20, 35], 18.33, 75.00, 8.01, "Critical"),
    ("C", [9, 13, 16, 16, 22], 13.50, 37.50, 2.56, "Warning"),
    ("D", [12, 17, 17, 22], 15.33, 29.41, 2.31, "Warning"),
    ("E", [20, 29, 18, 28], 22.33, 55.56, 0.97, "Watch"),
]


@pytest.fixture(scope="module")
def signals(spark):
    rows = []
    for company, counts, *_ in GOLDEN:
        rows += _weekly_rows(company, counts)
    # a late row so every golden week is complete and settled
    rows.append(("late", dt.datetime(2026, 8, 30), "Credit card", "Z"))
    return S.company_risk_signals(_frame(spark, rows)).cache()


@pytest.mark.parametrize("company,counts,baseline,growth,z,level", GOLDEN)
def test_golden_weeks(signals, company, counts, baseline, growth, z, level):
    last = signals.where(F.col("company") == company).orderBy(F.col("week_start").desc()).first()
    assert last.complaint_count == counts[-1]
    assert round(last.rolling_4_week_average, 2) == baseline
    assert last.week_over_week_growth == growth
    assert last.anomaly_z_score == z
    assert last.alert_level == level
    assert last.baseline_weeks == len(counts) - 1


def test_alerts_apply_all_gates(spark):
    rows = []
    rows += _weekly_rows("ok", [15, 18, 18, 32])
    rows += _weekly_rows("two_prior", [15, 18, 32])          # baseline_weeks 2 < 3
    rows += _weekly_rows("small", [5, 6, 5, 19])              # current 19 < 20
    rows += _weekly_rows("flat", [20, 20, 20, 20])            # zero sd -> z NULL, growth 0
    rows.append(("late", dt.datetime(2026, 8, 30), "Credit card", "Z"))
    alerts = S.risk_alerts(_frame(spark, rows)).collect()
    assert [a.company for a in alerts] == ["ok"]
    a = alerts[0]
    assert a.baseline_value == 17.0
    assert a.alert_explanation == ("ok recorded 32 Credit card complaints versus a baseline of 17.00. "
                                   "Weekly growth was 77.78%.")
    assert len(a.alert_id) == 64


def test_settle_gate_drops_recent_weeks(spark):
    rows = _weekly_rows("ok", [15, 18, 18, 32])
    # last date only 20 days after the alert week ends: inside the 21-day rule
    end_of_alert_week = MONDAY + dt.timedelta(weeks=3, days=6)
    rows.append(("late", dt.datetime.combine(end_of_alert_week + dt.timedelta(days=20), dt.time(1)),
                 "Credit card", "Z"))
    assert S.risk_alerts(_frame(spark, rows)).count() == 0


def test_constant_history_has_null_z(spark):
    rows = _weekly_rows("flat", [20, 20, 20, 20])
    sig = S.company_risk_signals(_frame(spark, rows))
    last = sig.orderBy(F.col("week_start").desc()).first()
    assert last.anomaly_z_score is None
    assert last.alert_level == "Normal"


def test_product_signals_and_latest_status(spark):
    rows = []
    start = dt.datetime(2026, 6, 1, 9)
    for d in range(60):
        n = 10 + (d % 7)
        rows += [(f"p{d}-{j}", start + dt.timedelta(days=d), "Credit card", "X") for j in range(n)]
    sig = S.product_risk_signals(_frame(spark, rows))
    latest = S.latest_product_status(sig).collect()
    assert len(latest) == 1
    # 60 days from 06-01 -> last day 07-30; complete cut-off 14 days earlier
    assert latest[0].complaint_date == dt.date(2026, 7, 16)
    assert latest[0].week_over_week_growth == 0.0


def test_alert_order_and_summary(spark):
    df = spark.createDataFrame(
        [("Watch", 0.5), ("Critical", 3.5), ("Warning", 2.1), ("Critical", 4.0)],
        "alert_level string, anomaly_z_score double").withColumns(
        {"alert_date": F.lit(dt.date(2026, 1, 5)), "product": F.lit("p"), "company": F.lit("c")})
    order = [(r.alert_level, r.anomaly_z_score) for r in S.alerts_ordered(df).collect()]
    assert order == [("Critical", 4.0), ("Critical", 3.5), ("Warning", 2.1), ("Watch", 0.5)]
    s = S.alert_summary(df).first()
    assert (s.total_alerts, s.critical_alerts, s.warning_alerts, s.watch_alerts) == (4, 2, 1, 1)
