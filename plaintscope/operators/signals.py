"""Volume metrics, rolling-baseline signals and alerts.

Scale notes: the raw table is reduced first by a partial + final hash aggregate
(daily per product, weekly per product/company). Every window below runs on
those aggregates, whose size is (days or weeks) x groups, independent of how
many complaints a hot company holds. The aggregates are materialised once
(small), and the last complaint date is read from them, so each query scans the
raw table once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import ALERT_LEVELS, COMPLETE, DEFAULTS, INCOMPLETE, NORMAL_LEVEL, Thresholds
from ..functions.scalar import dec2_text, pct_growth
from ..session import cut_lineage


def daily_product_metrics(complaints: DataFrame) -> DataFrame:
    """Complaints per calendar day and product (only days with rows)."""
    return (complaints
            .groupBy(F.to_date("date_received").alias("complaint_date"), "product")
            .agg(F.count(F.lit(1)).alias("complaint_count")))


def weekly_company_metrics(complaints: DataFrame) -> DataFrame:
    """Complaints per Monday-started week, product and company."""
    return (complaints
            .groupBy(F.date_trunc("week", "date_received").cast("date").alias("week_start"),
                     "product", "company")
            .agg(F.count(F.lit(1)).alias("complaint_count")))


def last_complaint_date(complaints: DataFrame) -> Column:
    """MAX(complaint date) as an uncorrelated scalar subquery."""
    return complaints.agg(F.max(F.to_date("date_received"))).scalar()


def _alert_level(z: Column, growth: Column, th: Thresholds) -> Column:
    """z >= 3 Critical, z >= 2 Warning, growth >= 40 Watch, else Normal."""
    return (F.when(z >= th.critical_z, F.lit(ALERT_LEVELS[0]))
            .when(z >= th.warning_z, F.lit(ALERT_LEVELS[1]))
            .when(growth >= th.watch_growth, F.lit(ALERT_LEVELS[2]))
            .otherwise(F.lit(NORMAL_LEVEL)))


def _rolling_signals(metrics: DataFrame, keys: list[str], order: str, frame_rows: int,
                     growth_lag: int, avg_name: str, count_name: str, th: Thresholds) -> DataFrame:
    """F2/F3 + F4/F5 + F6 + F7: baseline over the `frame_rows` rows before the current one."""
    ordered = Window.partitionBy(*keys).orderBy(order)
    frame = ordered.rowsBetween(-frame_rows, -1)
    cnt = F.col("complaint_count")
    base_avg = F.avg(cnt).over(frame)
    base_sd = F.stddev_samp(cnt).over(frame)
    z = F.round(F.try_divide((cnt - base_avg), F.nullif(base_sd, F.lit(0.0))), 2)
    growth = F.round(pct_growth(cnt, F.lag(cnt, growth_lag).over(ordered)), 2)
    return (metrics
            .withColumn(avg_name, base_avg)
            .withColumn(count_name, F.count(cnt).over(frame))
            .withColumn("week_over_week_growth", growth)
            .withColumn("anomaly_z_score", z)
            .withColumn("alert_level",
                        _alert_level(F.col("anomaly_z_score"), F.col("week_over_week_growth"), th)))


def _weekly_with_last_day(complaints: DataFrame) -> tuple[DataFrame, Column]:
    """Weekly metrics materialised once, plus the last complaint date taken from
    them (each group also keeps its last day), so the raw table is scanned once."""
    weekly = cut_lineage(
        complaints.groupBy(F.date_trunc("week", "date_received").cast("date").alias("week_start"),
                           "product", "company")
        .agg(F.count(F.lit(1)).alias("complaint_count"),
             F.max(F.to_date("date_received")).alias("_last_day")))
    return weekly.drop("_last_day"), weekly.agg(F.max("_last_day")).scalar()


def _company_signals(complaints: DataFrame, th: Thresholds, lag_days: int) -> tuple[DataFrame, Column]:
    weekly, last = _weekly_with_last_day(complaints)
    sig = _rolling_signals(weekly, ["product", "company"], "week_start", th.company_baseline_weeks,
                           1, "rolling_4_week_average", "baseline_weeks", th)
    complete = F.date_add("week_start", 6) <= F.date_sub(last, lag_days)
    sig = sig.withColumn("data_status", F.when(complete, F.lit(COMPLETE)).otherwise(F.lit(INCOMPLETE)))
    return sig, last


def company_risk_signals(complaints: DataFrame, th: Thresholds = DEFAULTS,
                         lag_days: int | None = None) -> DataFrame:
    """Weekly signals per (product, company); 4-week baseline, current week excluded.

    The weekly aggregate (weeks x groups, small) is materialised once; the windows
    and the last-date cut-off both read it."""
    lag_days = th.publication_lag_days if lag_days is None else lag_days
    return _company_signals(complaints, th, lag_days)[0]


def product_risk_signals(complaints: DataFrame, th: Thresholds = DEFAULTS,
                         lag_days: int | None = None) -> DataFrame:
    """Daily signals per product; 28-day baseline, growth against 7 rows back.

    The daily aggregate (days x products, small) is materialised once; its max day
    is the last complaint date, so the raw table is scanned once."""
    lag_days = th.publication_lag_days if lag_days is None else lag_days
    daily = cut_lineage(daily_product_metrics(complaints))
    last = daily.agg(F.max("complaint_date")).scalar()
    sig = _rolling_signals(daily, ["product"], "complaint_date", th.product_baseline_days,
                           th.product_growth_lag, "rolling_28_day_average", "baseline_days", th)
    complete = F.col("complaint_date") <= F.date_sub(last, lag_days)
    return sig.withColumn("data_status",
                          F.when(complete, F.lit(COMPLETE)).otherwise(F.lit(INCOMPLETE)))


def risk_alerts(complaints: DataFrame, th: Thresholds = DEFAULTS,
                min_count: int | None = None) -> DataFrame:
    """gated company alerts with id, rounded baseline and explanation sentence."""
    min_count = th.min_alert_count if min_count is None else min_count
    sig, last = _company_signals(complaints, th, th.publication_lag_days)
    baseline = F.round(F.col("rolling_4_week_average"), 2)
    gated = sig.where(
        (F.col("data_status") == COMPLETE)
        & (F.col("baseline_weeks") >= th.min_baseline_weeks)
        & (F.col("complaint_count") >= min_count)
        & (F.date_add("week_start", 6) <= F.date_sub(last, th.settle_days))
        & F.col("alert_level").isin(*ALERT_LEVELS))
    return gated.select(
        F.sha2(F.concat(F.col("week_start").cast("string"), "product", "company"), 256)
        .alias("alert_id"),
        F.col("week_start").alias("alert_date"),
        "product",
        "company",
        F.col("complaint_count").alias("current_value"),
        baseline.alias("baseline_value"),
        "week_over_week_growth",
        "anomaly_z_score",
        "alert_level",
        F.concat(F.col("company"), F.lit(" recorded "), F.col("complaint_count").cast("string"),
                 F.lit(" "), F.col("product"), F.lit(" complaints versus a baseline of "),
                 dec2_text(baseline), F.lit(". Weekly growth was "),
                 dec2_text("week_over_week_growth"), F.lit("%.")).alias("alert_explanation"),
    )


def severity_rank(level: Column) -> Column:
    """Position in (Critical, Warning, Watch); anything else is 0 and sorts first."""
    return F.array_position(F.array(*[F.lit(x) for x in ALERT_LEVELS]), level).cast("int")


def alerts_ordered(alerts: DataFrame) -> DataFrame:
    """Alerts by severity list order, then z-score descending (ties: date, product, company)."""
    return (alerts.withColumn("severity_rank", severity_rank(F.col("alert_level")))
            .orderBy("severity_rank", F.col("anomaly_z_score").desc_nulls_last(),
                     "alert_date", "product", "company"))


def alert_summary(alerts: DataFrame) -> DataFrame:
    """One row of counts per alert level."""
    lvl = F.col("alert_level")
    return alerts.agg(
        F.count(F.lit(1)).alias("total_alerts"),
        F.count_if(lvl == ALERT_LEVELS[0]).alias("critical_alerts"),
        F.count_if(lvl == ALERT_LEVELS[1]).alias("warning_alerts"),
        F.count_if(lvl == ALERT_LEVELS[2]).alias("watch_alerts"),
    )


def latest_product_status(product_signals: DataFrame, th: Thresholds = DEFAULTS) -> DataFrame:
    """Product rows of the latest complete date with a full enough baseline."""
    ok = product_signals.where((F.col("data_status") == COMPLETE)
                               & (F.col("baseline_days") >= th.min_baseline_days))
    latest = ok.agg(F.max("complaint_date")).scalar()
    return (ok.where(F.col("complaint_date") == latest)
            .select("complaint_date", "product", "complaint_count",
                    F.round("rolling_28_day_average", 2).alias("rolling_28_day_average"),
                    "week_over_week_growth", "anomaly_z_score", "alert_level")
            .orderBy("product"))
