"""Sliding theme counts against the full run: consecutive days, late hours, corrections, retries."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from plaintscope.config import Thresholds
from plaintscope.operators import sliding as SL
from plaintscope.operators import themes as TH
from plaintscope.sources import buckets as B

TH3 = Thresholds(recent_days=2, baseline_days=4, min_recent_mentions=1, min_doc_freq=1)
WORDS = ["late fee", "card lost", "late fee again", "bank closed card", "fee waived late fee", "", "card"]
ROWS = "complaint_id long, date_received timestamp_ntz, product string, consumer_complaint_narrative string"


def history(n_days, per_day=14):
    """Rows at midnight and later hours, with NULL products, texts and dates."""
    rows = []
    for i in range(n_days * per_day):
        day = dt.datetime(2024, 3, 1) + dt.timedelta(days=i // per_day, hours=(i % 3) * 5)
        rows.append((i, None if i % 41 == 40 else day, None if i % 13 == 12 else "ab"[i % 2],
                     None if i % 17 == 16 else f"{WORDS[i * 7 % 11 % len(WORDS)]} {WORDS[i % len(WORDS)]}"))
    return rows


def table(spark, rows):
    return spark.createDataFrame(rows, ROWS)


def on(rows, day):
    return [r for r in rows if r[1] is not None and r[1].date() == day]


def full(spark, rows, anchor, products=None):
    """The full run at the anchor day (the rows of later days not yet received)."""
    known = table(spark, [r for r in rows if r[1] is not None and r[1].date() <= anchor])
    ws = TH.window_bounds(anchor, TH3)
    labelled = TH.labelled_narratives(known, TH3, products, ws)
    counts = TH.term_document_counts(labelled, with_doc_marker=True)
    return sorted(map(tuple, TH.themes_from_counts(counts, ws, TH3).collect()), key=str)


def slid(spark, sums, products=None):
    return sorted(map(tuple, SL.sliding_themes(spark, sums, TH3, products).collect()), key=str)


def test_three_consecutive_days_equal_the_full_run(spark, tmp_path):
    rows = history(9)
    daily, sums = str(tmp_path / "daily"), str(tmp_path / "sums")
    first = dt.date(2024, 3, 7)
    SL.load_days(spark, daily, table(spark, [r for r in rows if r[1] is None or r[1].date() < first]), "history")
    for i in range(3):
        d = first + dt.timedelta(days=i)
        SL.load_days(spark, daily, table(spark, on(rows, d)), str(d))
        SL.advance(spark, daily, sums, d, TH3)
        want = full(spark, rows, d)
        assert slid(spark, sums) == want and len(want) > 5
    assert slid(spark, sums, ["a"]) == full(spark, rows, d, ["a"])
    assert SL.latest_day(spark, daily) == d
    # Every narrative was tokenised in one load only.
    marks = B.read_table(spark, daily).where("term = ''").agg(F.sum("mentions")).first()[0]
    assert marks == sum(r[1] is not None and r[3] is not None for r in rows)


def test_any_move_of_the_window(spark, tmp_path):
    rows = history(9)
    daily, sums = str(tmp_path / "daily"), str(tmp_path / "sums")
    SL.load_days(spark, daily, table(spark, rows), "all")
    for d in (3, 9, 5, 20):  # ahead by more than a day, back, and beyond every row
        SL.advance(spark, daily, sums, dt.date(2024, 3, d), TH3)
        assert slid(spark, sums) == full(spark, rows, dt.date(2024, 3, d))
    assert SL.window_counts(spark, sums).count() == 0


def test_layers_are_merged(spark, tmp_path):
    daily, sums = str(tmp_path / "daily"), str(tmp_path / "sums")
    SL.load_days(spark, daily, table(spark, history(9)), "all")
    layers = []
    for d in range(4, 10):
        SL.advance(spark, daily, sums, dt.date(2024, 3, d), TH3, max_layers=3)
        layers.append(len(B.manifest(spark, sums)["folders"]))
    assert layers == [1, 2, 3, 1, 2, 3]
    assert slid(spark, sums) == full(spark, history(9), dt.date(2024, 3, 9))
    merged = B.manifest(spark, sums)["folders"]
    assert B.read_batches(spark, sums, {"folders": merged, "schema": B.manifest(spark, sums)["schema"]}, ["4"]) \
        .groupBy("product", "term").count().where("count > 1").count() == 0


def test_only_moved_days_are_read():
    th = Thresholds()
    d = dt.date(2024, 5, 20)
    moved = SL._moved_days(d, d + dt.timedelta(days=1), th)
    ago = sorted((d - m).days for m in moved)
    # the new day, the old anchor day's later hours, out of recent, out of the baseline
    assert ago == [-1, 0, th.recent_days - 1, th.recent_days + th.baseline_days - 1]
    assert SL._moved_days(d, d, th) == []


def test_corrections_late_loads_and_retries(spark, tmp_path):
    rows = history(8)
    daily, sums = str(tmp_path / "daily"), str(tmp_path / "sums")
    late = rows[20:33]
    SL.load_days(spark, daily, table(spark, [r for r in rows if r not in late]), "a")
    SL.advance(spark, daily, sums, dt.date(2024, 3, 7), TH3)
    old = on(rows, dt.date(2024, 3, 6))
    new = [(r[0], r[1] - dt.timedelta(days=2), "b", "fee changed twice") for r in old]
    for _ in range(2):  # a retried load counts once
        SL.load_days(spark, daily, table(spark, late + new), "b", replaced=table(spark, old))
    now = [r for r in rows if r not in old] + new
    v = SL.advance(spark, daily, sums, dt.date(2024, 3, 8), TH3)
    assert slid(spark, sums) == full(spark, now, dt.date(2024, 3, 8))
    assert SL.advance(spark, daily, sums, dt.date(2024, 3, 8), TH3) == v
    # Taking back the last day's rows moves the latest day.
    gone = on(now, dt.date(2024, 3, 8))
    SL.load_days(spark, daily, table(spark, []), "c", replaced=table(spark, gone))
    assert SL.latest_day(spark, daily) == dt.date(2024, 3, 7)


def test_other_window_lengths_start_from_the_daily_counts(spark, tmp_path):
    daily, sums = str(tmp_path / "daily"), str(tmp_path / "sums")
    SL.load_days(spark, daily, table(spark, history(8)), "a")
    SL.advance(spark, daily, sums, dt.date(2024, 3, 8), Thresholds())
    SL.advance(spark, daily, sums, dt.date(2024, 3, 8), TH3)
    assert slid(spark, sums) == full(spark, history(8), dt.date(2024, 3, 8))


def test_empty_history(spark, tmp_path):
    daily, sums = str(tmp_path / "daily"), str(tmp_path / "sums")
    assert SL.latest_day(spark, daily) is None
    with pytest.raises(FileNotFoundError):
        SL.advance(spark, daily, sums, dt.date(2024, 3, 8), TH3)
    SL.load_days(spark, daily, table(spark, []), "none")
    assert SL.latest_day(spark, daily) is None
    SL.advance(spark, daily, sums, dt.date(2024, 3, 8), TH3)
    assert slid(spark, sums) == []
    assert SL.replay(spark, str(tmp_path / "r"), table(spark, []), 3) is None
