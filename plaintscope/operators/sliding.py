"""Themes from stored daily counts: a window moves by the days that enter and leave.

``themes.emerging_themes`` tokenises the narratives of the whole window on each run. Here a narrative
is tokenised once, when its load arrives: the load becomes signed counts per product, day and term
(``daily_term_counts``) and is appended under its id. The counts of the window are a stored table of
their own. ``advance`` moves it to another anchor day: it reads the daily counts of the days whose
place in the window changes (four slices for one day: into the recent part, from there to the
baseline, out of the baseline, and the anchor day's own late rows) and appends them, signed, as a
layer: a map-only job. The themes add up the layers in one aggregate and write only the terms
frequent enough to be one. After ``MAX_LAYERS`` moves, a week of days at four slices each, the
layers are merged into one.

The window ends at midnight of the anchor day, as in the full run: a narrative of a later hour of a
day counts from the next day on. So a day's counts have two parts, ``late`` false (midnight, or no
time given) and true.

Corrections: a load may name the rows it replaces; their counts enter with a minus sign. Loads that
arrive late, in any order, or for days long in the window are taken in whole by the next ``advance``,
as the sums' manifest names the loads they hold. Retried loads are recognised by their id. If a job
fails between two steps, running it again is safe: each step commits by one manifest.

Rows without a narrative or a received date count nowhere; a NULL product has counts but no theme;
an empty narrative counts for the totals only.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULTS, Thresholds
from ..functions.text import explode_terms, with_terms
from ..session import cut_lineage
from ..sources.buckets import append_results, manifest, publish_layer, read_batches, read_table
from .themes import DOC_MARKER, frequent_terms, themes_from_counts, window_bounds

TEXT = "consumer_complaint_narrative"
MAX_LAYERS = 7


def daily_term_counts(complaints: DataFrame, sign: int = 1) -> DataFrame:
    """Narratives per product, day, part of the day and bigram; the term '' counts all narratives."""
    day = F.to_date("date_received")
    rows = (complaints.where(F.col(TEXT).isNotNull() & F.col("date_received").isNotNull())
            .select("product", day.alias("day"),
                    (F.col("date_received") > F.date_trunc("day", "date_received")).alias("late"), TEXT))
    staged = with_terms(rows, TEXT, "_bg")
    keys = ["product", "day", "late"]
    terms = explode_terms(staged.withColumn("_arr", F.array_distinct("_bg")), "_arr", "term", keys)

    def mentions(r: DataFrame, term) -> DataFrame:
        return r.groupBy(*keys, term).agg((F.count(F.lit(1)) * F.lit(sign)).alias("mentions"))

    # Dealt by the key before they are counted, as in ``themes.term_document_counts``.
    return (mentions(terms.repartition(*keys, "term"), "term")
            .unionByName(mentions(rows, F.lit(DOC_MARKER).alias("term"))))


def load_days(spark: SparkSession, counts_root: str, rows: DataFrame, batch_id: str,
              replaced: DataFrame | None = None) -> int:
    """Append a load's counts; ``replaced`` are the earlier versions of its rows, if any. Rows of a
    file lie in day order, so a reader of a few days skips the rest by the files' statistics."""
    held = manifest(spark, counts_root)
    if held and batch_id in held["folders"]:
        return held["version"]
    counts = daily_term_counts(rows)
    if replaced is not None:
        counts = (counts.unionByName(daily_term_counts(replaced, -1))
                  .groupBy("product", "day", "late", "term").agg(F.sum("mentions").alias("mentions"))
                  .where(F.col("mentions") != 0))

    def days(written: DataFrame) -> dict:
        r = written.agg(F.min("day").cast("string").alias("first"), F.max("day").cast("string").alias("last"),
                        F.coalesce(F.min("mentions") < 0, F.lit(False)).alias("takes_back")).first()
        return r.asDict()

    return append_results(counts.sortWithinPartitions("day", "late"), counts_root, batch_id, info=days)


def latest_day(spark: SparkSession, counts_root: str) -> dt.date | None:
    """E13 without a text: the latest day with a narrative. The manifest knows it unless a load took
    rows back; then the totals' rows of the daily counts tell."""
    state = manifest(spark, counts_root)
    notes = list(state["info"].values()) if state else []
    if any(n["takes_back"] for n in notes):
        left = (read_batches(spark, counts_root, state, sorted(state["folders"]))
                .where(F.col("term") == DOC_MARKER).groupBy("day").agg(F.sum("mentions").alias("n"))
                .where(F.col("n") > 0))
        return left.agg(F.max("day")).first()[0]
    last = max((n["last"] for n in notes if n["last"]), default=None)
    return dt.date.fromisoformat(last) if last else None


def _parts(anchor: dt.date, th: Thresholds) -> tuple[Column, Column]:
    """Whether a day's part lies in the recent and in the baseline part of the window."""
    day, end = F.col("day"), F.lit(anchor)
    start = F.lit(anchor - dt.timedelta(days=th.recent_days - 1))
    first = F.lit(anchor - dt.timedelta(days=th.recent_days + th.baseline_days - 1))
    return ((day >= start) & ((day < end) | ((day == end) & ~F.col("late"))), (day >= first) & (day < start))


def _moved_days(old: dt.date, new: dt.date, th: Thresholds) -> list[dt.date]:
    """Days with a part whose place differs between the two windows."""
    def place(day, late, anchor):
        ago = (anchor - day).days
        if ago < 0 or (ago == 0 and late):
            return 0
        return 1 if ago < th.recent_days else 2 if ago < th.recent_days + th.baseline_days else 0

    span = th.recent_days + th.baseline_days
    first, last = min(old, new) - dt.timedelta(days=span), max(old, new)
    days = [first + dt.timedelta(days=i) for i in range((last - first).days + 1)]
    return [d for d in days if any(place(d, late, old) != place(d, late, new) for late in (False, True))]


def _as_counts(rows: DataFrame, recent: Column, baseline: Column) -> DataFrame:
    return rows.select("product", "term", (F.col("mentions") * recent).alias("recent_mentions"),
                       (F.col("mentions") * baseline).alias("baseline_mentions"))


def _summed(rows: DataFrame) -> DataFrame:
    # A term's days lie in different files: little to add up before the rows are dealt.
    return (rows.repartition("product", "term").groupBy("product", "term")
            .agg(F.sum("recent_mentions").alias("recent_mentions"), F.sum("baseline_mentions").alias("baseline_mentions"))
            .withColumn("doc_freq", F.col("recent_mentions") + F.col("baseline_mentions"))
            .where(F.col("doc_freq") > 0))


def window_counts(spark: SparkSession, sums_root: str) -> DataFrame:
    """Recent and baseline mentions per product and term at the stored anchor day."""
    return _summed(read_table(spark, sums_root))


def advance(spark: SparkSession, counts_root: str, sums_root: str, anchor: dt.date,
            th: Thresholds = DEFAULTS, max_layers: int = MAX_LAYERS) -> int:
    """Bring the window's counts to ``anchor`` (a later or an earlier day) and to all loads. Returns
    the version; nothing is written when anchor and loads are those of the last one."""
    loads, sums = manifest(spark, counts_root), manifest(spark, sums_root)
    if loads is None:
        raise FileNotFoundError(f"{counts_root}: no load")
    span = [th.recent_days, th.baseline_days]
    if sums and sums["info"]["span"] != span:
        sums = None  # other window lengths: sums from the daily counts, still without a text
    held = set(sums["info"]["loads"]) if sums else set()
    old = dt.date.fromisoformat(sums["info"]["anchor"]) if sums else anchor
    if sums and old == anchor and held == set(loads["folders"]):
        return sums["version"]

    def of(ids, first, last):  # loads that hold a day of the range
        return sorted(b for b in ids if loads["info"][b]["first"]
                      and loads["info"][b]["first"] <= str(last) and loads["info"][b]["last"] >= str(first))

    as_int = lambda c: F.when(c, 1).otherwise(0)
    recent, baseline = _parts(anchor, th)
    first = anchor - dt.timedelta(days=sum(span) - 1)
    fresh = read_batches(spark, counts_root, loads, of(set(loads["folders"]) - held, first, anchor))
    parts = [_as_counts(fresh.where(F.col("day").between(F.lit(first), F.lit(anchor))), as_int(recent), as_int(baseline))]
    whole = not sums or len(sums["folders"]) >= max_layers
    if sums and whole:
        parts.append(read_table(spark, sums_root))
    moved = _moved_days(old, anchor, th) if sums else []
    if moved:
        was_recent, was_baseline = _parts(old, th)
        rows = read_batches(spark, counts_root, loads, of(held, moved[0], moved[-1])).where(F.col("day").isin(moved))
        parts.append(_as_counts(rows, as_int(recent) - as_int(was_recent), as_int(baseline) - as_int(was_baseline)))
    total = parts[0]
    for part in parts[1:]:
        total = total.unionByName(part)
    total = (_summed(total).drop("doc_freq") if whole
             else total.where((F.col("recent_mentions") != 0) | (F.col("baseline_mentions") != 0)))
    info = {"anchor": str(anchor), "loads": sorted(loads["folders"]), "span": span}
    return publish_layer(total, sums_root, info, whole)


def sliding_themes(spark: SparkSession, sums_root: str, th: Thresholds = DEFAULTS,
                   products: list[str] | None = None) -> DataFrame:
    """The themes of ``themes.emerging_themes`` at the anchor day of the stored counts."""
    info = manifest(spark, sums_root)["info"]
    counts = window_counts(spark, sums_root)
    if products is not None:
        counts = counts.where(F.col("product").isin(*products))
    return themes_from_counts(cut_lineage(frequent_terms(counts, th)), window_bounds(info["anchor"], th), th)


def replay(spark: SparkSession, root: str, complaints: DataFrame, last_days: int,
           th: Thresholds = DEFAULTS) -> DataFrame | None:
    """A history as its loads would have arrived: all but the last days in one load, then one load
    and one move of the window per day. Returns the themes of the last day (written), None without
    a narrative."""
    anchor = (complaints.where(F.col(TEXT).isNotNull())
              .agg(F.max(F.to_date("date_received"))).first()[0])
    if anchor is None:
        return None
    day = F.to_date("date_received")
    days = [anchor - dt.timedelta(days=i) for i in range(last_days - 1, -1, -1)]
    load_days(spark, f"{root}/daily", complaints.where(day < F.lit(days[0])), "history")
    for d in days:
        load_days(spark, f"{root}/daily", complaints.where(day == F.lit(d)), str(d))
        advance(spark, f"{root}/daily", f"{root}/window", d, th)
    return cut_lineage(sliding_themes(spark, f"{root}/window", th))
