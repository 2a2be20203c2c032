"""Executive brief (R1, R2, E18) as a DataFrame of ordered report lines.

Each section is a small aggregate or a projection of an already-reduced table
(alerts, latest product status, top themes), unioned into one line table with
explicit sort columns. ``brief_text`` orders it with a distributed sort and
``write_brief`` writes it as Markdown part files in that order; nothing is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import ALERT_LEVELS
from ..functions.scalar import dec2_text
from .signals import severity_rank

LINE_COLUMNS = ("section", "severity", "z_order", "item", "sub", "line")

# Report text.
TITLE = "# Complaint watch report"
SUMMARY = ("## Alert counts", "", "| level | alerts |", "| --- | ---: |")
PRODUCTS = ("", "## Products on their last settled day", "",
            "| product | complaints | 28-day mean | change on last week, % | level |", "| --- | ---: | ---: | ---: | --- |")
ALERTS = ("", "## Alerts, gravest first", "", "| week | company | product | level | z | why |", "| --- | --- | --- | --- | ---: | --- |")
THEMES = ("", "## Phrases on the rise", "")
READING = ("## Reading guide", "",
           "* z: distance of a week from the mean of the four weeks before it, in their standard deviations.",
           "* Counts are raw: a large company has more complaints of any kind.",
           "* Days that publishers may still fill up are not judged.",
           "* A phrase rises when its share of last week's narratives exceeds its share in the four weeks before.")


def _line(section: int, item, sub, text, severity=None, z=None) -> list[Column]:
    return [F.lit(section).alias("section"),
            (severity if severity is not None else F.lit(0)).cast("int").alias("severity"),
            (z if z is not None else F.lit(0.0)).cast("double").alias("z_order"),
            (item if isinstance(item, Column) else F.lit(item)).cast("string").alias("item"),
            (sub if isinstance(sub, Column) else F.lit(sub)).cast("int").alias("sub"),
            text.alias("line")]


def _st(sub, text) -> Column:
    sub = sub if isinstance(sub, Column) else F.lit(sub)
    text = text if isinstance(text, Column) else F.lit(text)
    return F.struct(sub.cast("int").alias("sub"), text.alias("t"))


def _row(*cells: Column) -> Column:
    """A table row; a missing cell shows a dash."""
    out = [F.lit("|")]
    for c in cells:
        out += [F.lit(" "), F.coalesce(c, F.lit("-")), F.lit(" |")]
    return F.concat(*out)


def _fixed(anchor: DataFrame, section: int, texts, item: str = "", start: int = 0) -> DataFrame:
    rows = F.array(*[_st(start + i, t) for i, t in enumerate(texts)])
    return anchor.select(F.inline(rows)).select(*_line(section, item, F.col("sub"), F.col("t")))


def brief_lines(alerts: DataFrame, product_status: DataFrame, themes: DataFrame,
                per_product_themes: int = 5) -> DataFrame:
    """R1 + R2: every line of the brief with its sort position."""
    counts = alerts.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("alert_level") == ALERT_LEVELS[0]).alias("c"),
        F.count_if(F.col("alert_level") == ALERT_LEVELS[1]).alias("w"),
        F.count_if(F.col("alert_level") == ALERT_LEVELS[2]).alias("v"))
    report_day = F.coalesce(product_status.agg(F.max("complaint_date")).scalar(), F.current_date())
    one = counts.select(F.lit(1).alias("one"))
    header = one.select(F.inline(F.array(
        _st(0, TITLE),
        _st(1, F.lit("")),
        _st(2, F.concat(F.lit("Settled up to "), report_day.cast("string"))),
        _st(3, F.lit(""))))).select(*_line(1, "", F.col("sub"), F.col("t")))
    summary_head = _fixed(one, 2, SUMMARY)
    summary = counts.select(F.inline(F.array(*[
        _st(10 + i, F.concat(F.lit(f"| {name} | "), F.col(c).cast("string"), F.lit(" |")))
        for i, (name, c) in enumerate([*zip(ALERT_LEVELS, ("c", "w", "v")), ("all", "n")])]))).select(
        *_line(2, "", F.col("sub"), F.col("t")))
    prod_head = _fixed(one, 3, PRODUCTS)
    prod_lines = product_status.select(*_line(3, F.col("product"), 10, _row(
        F.col("product"), F.col("complaint_count").cast("string"), dec2_text("rolling_28_day_average"),
        dec2_text("week_over_week_growth"), F.col("alert_level"))))
    alert_head = _fixed(one, 4, ALERTS)
    alert_lines = alerts.select(*_line(
        4, F.concat_ws("|", F.col("alert_date").cast("string"), "product", "company"), 10,
        _row(F.col("alert_date").cast("string"), F.col("company"), F.col("product"), F.col("alert_level"),
             F.col("anomaly_z_score").cast("string"), F.col("alert_explanation")),
        severity=severity_rank(F.col("alert_level")),
        z=-F.coalesce(F.col("anomaly_z_score"), F.lit(0.0))))
    theme_head = _fixed(one, 5, THEMES)
    w = Window.partitionBy("product").orderBy("theme_rank")
    top = (themes.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= per_product_themes))
    products = top.select("product").distinct()
    prod_titles = products.select(F.col("product"), F.inline(F.array(
        _st(0, F.concat(F.lit("**"), F.col("product"), F.lit("**"))),
        _st(1, F.lit("")),
        _st(99, F.lit(""))))).select(*_line(6, F.col("product"), F.col("sub"), F.col("t")))
    theme_lines = top.select(*_line(
        6, F.col("product"), F.col("_k") + 1,
        F.concat(F.col("_k").cast("string"), F.lit(". "), F.col("term"), F.lit(" (in "),
                 F.col("recent_mentions").cast("string"), F.lit(" narratives, share up "),
                 F.coalesce(dec2_text("growth_rate_percent"), F.lit("-")), F.lit(" %)"))))
    method = _fixed(one, 7, READING)
    parts = [header, summary_head, summary, prod_head, prod_lines, alert_head, alert_lines, theme_head,
             prod_titles, theme_lines, method]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(*LINE_COLUMNS)


def brief_text(lines: DataFrame) -> DataFrame:
    """Lines in report order (a distributed sort; the result is one column)."""
    return lines.orderBy("section", "severity", "z_order", "item", "sub").select("line")


def write_brief(lines: DataFrame, path: str) -> None:
    """Markdown part files whose names follow the report order: the sort range-partitions
    the lines, so a long alert history is sorted and written by many tasks."""
    brief_text(lines).write.mode("overwrite").option("lineSep", "\n").text(path)
