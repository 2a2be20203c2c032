"""Scan, null tokens, cleaning, dedup, upsert, coverage (FIXTURES F1, F2, F6, F7)."""

import datetime as dt

import pytest

from pyspark.sql import functions as F

from plaintscope.operators import clean as C
from plaintscope.operators import quality as Q
from plaintscope.schema import RAW_HEADER
from plaintscope.sources.complaints import (chunk_coverage, extract_grid, normalize_nulls,
                                            read_complaints, union_chunks)


def _raw(spark, rows):
    cols = ["Complaint ID", "Date received", "Product", "Issue", "Company", "Timely response?",
            "Consumer complaint narrative", "_row"]
    return spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in cols[:-1]) + ", `_row` int")


def test_normalize_name():
    assert C.normalize_name(" Timely response? ") == "timely_response"
    assert C.normalize_name("Sub-product") == "sub_product"
    assert C.normalize_name("Consumer complaint narrative") == "consumer_complaint_narrative"


def test_csv_scan_multiline_and_null_tokens(spark, tmp_path):
    header = ",".join(f'"{h}"' for h in RAW_HEADER)
    row1 = ['2026-07-01', 'Credit card', '', 'Billing', '', '"line one\nline ""two"""', '', 'Bank A',
            'NY', '01234', '', '', 'Web', '2026-07-02', 'Closed', 'Yes', '', '7']
    row2 = ['2026-07-02', 'NA', '', 'Fees', '', 'N/A', '', 'Bank B', '', '', '', '', 'Web', '', '',
            'No', '', '8']
    path = tmp_path / "extract.csv"
    path.write_text(header + "\n" + ",".join(row1) + "\n" + ",".join(row2) + "\n")
    df = normalize_nulls(read_complaints(spark, str(path)))
    rows = {r["Complaint ID"]: r for r in df.collect()}
    assert rows["7"]["Consumer complaint narrative"] == 'line one\nline "two"'
    assert rows["7"]["ZIP code"] == "01234"           # text, leading zero kept
    assert rows["8"]["Product"] is None               # NA token
    assert rows["8"]["Consumer complaint narrative"] is None


def test_clean_rules(spark):
    rows = [
        ("1", "2026-07-01", "Card", "Fees", "Bank", "yes", None, 1),
        ("2", "not a date", "Card", "Fees", "Bank", "yes", None, 2),        # bad date -> rejected
        ("3", "2026-07-01", "Card", "Fees", None, "yes", None, 3),          # NULL company -> rejected
        ("4", "2026-07-01", "Card", "Fees", "Bank", "yes", "old", 4),       # valid ...
        ("4", "bad", "Card", "Fees", "Bank", "yes", "new", 5),              # ... invalid duplicate
        ("5", "2026-07-01", "Card", "Fees", "Bank", "yes", "first", 6),
        ("5", "2026-07-02", "Card", "Fees", "Bank", "yes", "second", 7),    # later valid wins
        ("6", "2026-07-01", "  Card ", " Fees", "Bank ", " no ", None, 8),  # padded -> trimmed
        ("7", "2026-07-01", "   ", "Fees", "Bank", "yes", None, 9),         # blank product -> rejected
        ("8", "2026-07-01T10:00:00+02:00", "Card", "Fees", "Bank", "yes", None, 10),  # offset -> UTC
    ]
    out = {r.complaint_id: r for r in C.clean_complaints(_raw(spark, rows), ["_row"]).collect()}
    assert sorted(out) == [1, 4, 5, 6, 8]
    assert out[4].consumer_complaint_narrative == "old"
    assert out[5].consumer_complaint_narrative == "second"
    assert (out[6].product, out[6].issue, out[6].company, out[6].timely_response) == \
        ("Card", "Fees", "Bank", "no")
    assert out[8].date_received == dt.datetime(2026, 7, 1, 8, 0)
    summary = C.clean_summary(_raw(spark, rows), ["_row"]).first()
    assert summary.raw_records == 10
    assert summary.rejected_missing_required == 4
    assert summary.duplicate_ids_removed == 1
    assert summary.clean_records == 5


@pytest.mark.parametrize("max_keys", [200_000, 0])  # broadcast keys / whole-table aggregate
def test_upsert(spark, max_keys):
    t0, t1 = dt.datetime(2026, 1, 1), dt.datetime(2025, 6, 1)
    existing = spark.createDataFrame([(1, "NY", t0), (3, "TX", t1), (None, "CA", t1)],
                                     "complaint_id bigint, state string, ingested_at timestamp_ntz")
    incoming = spark.createDataFrame([(1, None, 1), (2, "A", 2), (2, "B", 3), (None, "WA", 4)],
                                     "complaint_id bigint, state string, seq int")
    merged = C.upsert(existing, incoming, seq="seq", batch_ts="2026-02-01 00:00:00",
                      max_broadcast_keys=max_keys)
    out = {r.complaint_id: r for r in merged.collect()}
    assert merged.count() == 4
    assert out[1].state is None and out[1].ingested_at == t0
    assert out[2].state == "B" and out[2].ingested_at == dt.datetime(2026, 2, 1)
    assert out[3].state == "TX" and out[3].ingested_at == t1       # untouched row kept as is
    assert out[None].state == "WA" and out[None].ingested_at == t1  # NULL keys match each other


@pytest.mark.parametrize("max_keys", [200_000, 0])
def test_upsert_leaves_repeated_stored_keys_alone(spark, max_keys):
    t = dt.datetime(2026, 1, 1)
    existing = spark.createDataFrame([(1, "a", t), (1, "b", t), (None, "c", t), (None, "d", t), (3, "e", t), (2, "f", t)],
                                     "complaint_id bigint, state string, ingested_at timestamp_ntz")
    incoming = spark.createDataFrame([(2, "new", 1)], "complaint_id bigint, state string, seq int")
    out = C.upsert(existing, incoming, seq="seq", batch_ts="2026-02-01 00:00:00", max_broadcast_keys=max_keys)
    assert sorted(r.state for r in out.collect()) == ["a", "b", "c", "d", "e", "new"]


def test_ids_are_exact_or_null(spark):
    texts = ["7", " 7.0 ", "12.7", "9007199254740993.0", "12345678901234567", "99999999999999999999", "x", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, complaint_id string")
    got = [r.complaint_id for r in C.standardize(df).orderBy("i").collect()]
    assert got == [7, 7, None, 9007199254740993, 12345678901234567, None, None, None]


def test_fractional_and_minute_dates(spark):
    texts = ["2026-08-08T00:00:00.000Z", "2026-08-08 10:11:12.5", "2026-08-08T10:11", "2026-08-08 10:11:12.123456+02:00"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.d for r in df.select("i", C.coerce_timestamp("t").alias("d")).orderBy("i").collect()]
    assert got == [dt.datetime(2026, 8, 8), dt.datetime(2026, 8, 8, 10, 11, 12, 500000), dt.datetime(2026, 8, 8, 10, 11),
                   dt.datetime(2026, 8, 8, 8, 11, 12, 123456)]


def test_rows_a_microsecond_apart_are_no_duplicates(spark):
    df = spark.createDataFrame([(1, dt.datetime(2026, 1, 1, 0, 0, 0, 1)), (1, dt.datetime(2026, 1, 1, 0, 0, 0, 2))],
                               "complaint_id bigint, d timestamp_ntz")
    assert Q.duplicate_row_count(df, "complaint_id").first()[0] == 0


def test_csv_columns_are_found_by_name(spark, tmp_path):
    from plaintscope.sources.complaints import read_complaints
    names = list(RAW_HEADER)
    back = names[::-1] + ["Extra"]
    (tmp_path / "a.csv").write_text(",".join(names) + "\n" + ",".join(f"a{n}" for n in names).replace("\n", "") + "\n")
    (tmp_path / "b.csv").write_text(",".join(back) + "\n" + ",".join(f"b{n}" for n in back) + "\nshort,row\n")
    df = read_complaints(spark, str(tmp_path), keep_corrupt=True)
    rows = {r[names[0]]: r for r in df.collect() if r["_corrupt_record"] is None}
    assert [rows["a" + names[0]][n] for n in names] == [f"a{n}" for n in names]
    assert [rows["b" + names[0]][n] for n in names] == [f"b{n}" for n in names]
    assert [r["_corrupt_record"] for r in df.collect() if r["_corrupt_record"]] == ["short,row"]
    (tmp_path / "c.csv").write_text("Issue\nx\n")
    with pytest.raises(ValueError):
        read_complaints(spark, str(tmp_path))


def test_union_chunks_and_dedup(spark):
    a = spark.createDataFrame([("1", "x", 1)], "id string, v string, o int")
    b = spark.createDataFrame([(2, "y", "1")], "o int, v string, id string")
    both = union_chunks(a, b)
    out = C.dedup_keep_last(both, "id", ["o"]).collect()
    assert [(r.id, r.v) for r in out] == [("1", "y")]


def test_extract_grid_and_coverage(spark):
    products = spark.createDataFrame([("Card",), ("Bank",)], "product string")
    grid = extract_grid(products, "2026-07-01", "2026-07-16", 7).where("product = 'Card'").orderBy("chunk_no")
    assert [(str(r.chunk_start), str(r.chunk_end)) for r in grid.collect()] == [
        ("2026-07-01", "2026-07-07"), ("2026-07-08", "2026-07-14"), ("2026-07-15", "2026-07-16")]
    rows = spark.createDataFrame([(dt.datetime(2026, 7, 2), "Card"), (dt.datetime(2026, 7, 16), "Card")],
                                 "date_received timestamp_ntz, product string")
    cov = {(r.product, r.chunk_no): r.records for r in
           chunk_coverage(rows, products, "2026-07-01", "2026-07-16", 7).collect()}
    assert cov[("Card", 0)] == 1 and cov[("Card", 1)] == 0 and cov[("Card", 2)] == 1
    assert cov[("Bank", 0)] == 0


def test_quality_report_and_data_checks(spark):
    df = spark.createDataFrame(
        [(1, dt.datetime(2026, 7, 1), "Card", "Fees", "Bank", "Yes", "n"),
         (1, dt.datetime(2026, 7, 1), "Card", "Fees", "Bank", "Yes", "n"),
         (None, None, None, None, None, " maybe ", None)],
        "complaint_id bigint, date_received timestamp_ntz, product string, issue string, "
        "company string, timely_response string, consumer_complaint_narrative string")
    rep = {r.check_name: (r.failed_records, r.pass_rate_percent) for r in Q.quality_report(df).collect()}
    assert rep["Total records"] == (0, 100.0)
    assert rep["Duplicate complaint ID"] == (1, 66.67)
    assert rep["Duplicate full rows"] == (1, 66.67)
    assert rep["Missing narratives"] == (1, 66.67)
    assert [r.value for r in Q.timely_domain(df).collect()] == ["maybe"]
    sc = {r.column_name: (r.present, r.missing) for r in Q.schema_check(df).collect()}
    assert sc["complaint_id"] == (True, 1)
    assert Q.duplicate_key_count(df.select("complaint_id"), "complaint_id").first()[0] == 1
    assert Q.duplicate_row_count(df, "complaint_id").first()[0] == 1
    assert Q.duplicate_row_count(df).first()[0] == 1
    top = Q.top_values(df, ["product"], 10).collect()
    assert [(r.value, r.records) for r in top] == [("Card", 2)]
    nulls = {r.value: r.records for r in Q.value_counts_with_null(df, "timely_response").collect()}
    assert nulls == {"Yes": 2, " maybe ": 1}


def test_write_brief_orders_lines(spark, tmp_path):
    import datetime as dt
    from plaintscope.operators import brief as B
    alerts = spark.createDataFrame(
        [(dt.date(2026, 7, 6), "Card", "Co A", "Watch", 0.5, "Co A recorded 28."),
         (dt.date(2026, 7, 6), "Card", "Co B", "Critical", 8.66, "Co B recorded 32.")],
        "alert_date date, product string, company string, alert_level string, "
        "anomaly_z_score double, alert_explanation string")
    status = spark.createDataFrame([(dt.date(2026, 8, 8), "Card", 174, 253.54, 21.68, "Normal")],
                                   "complaint_date date, product string, complaint_count long, "
                                   "rolling_28_day_average double, week_over_week_growth double, "
                                   "alert_level string")
    themes = spark.createDataFrame([("Card", "best buy", 9, 174.09, 1), ("Card", "proof received", 3, None, 2)],
                                   "product string, term string, recent_mentions long, "
                                   "growth_rate_percent double, theme_rank int")
    lines = B.brief_lines(alerts, status, themes)
    B.write_brief(lines, str(tmp_path / "brief"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "brief").glob("part-*")))
    assert text.startswith(B.TITLE + "\n\nSettled up to 2026-08-08\n")
    assert "| Critical | 1 |\n| Warning | 0 |\n| Watch | 1 |\n| all | 2 |\n" in text
    assert text.index("Co B") < text.index("Co A")                        # severity order
    assert "| Card | 174 | 253.54 | 21.68 | Normal |" in text
    assert "2. proof received (in 3 narratives, share up - %)" in text
    assert text.index("best buy") < text.index("proof received")


def test_dates_of_all_shapes(spark):
    cases = {"2026-08-08T01:02:03+0000": "2026-08-08 01:02:03", "2026-08-08T01:02:03-05": "2026-08-08 06:02:03",
             "2026-08-08 01:02 +02:00": "2026-08-07 23:02:00", "8/8/2026": "2026-08-08 00:00:00", "12/31/2025 23:59": "2025-12-31 23:59:00",
             "2026/08/08": "2026-08-08 00:00:00", "2026-8-8 1:02:03": "2026-08-08 01:02:03", "2026-08-08T01:02Z": "2026-08-08 01:02:00",
             " 2026-08-08T01:02:03.123456789Z\u00a0": "2026-08-08 01:02:03.123456", "2026-02-30": None, "13/1/2026": None, "2026": None,
             "2026-08": None, "01:02:03": None, "2026-08-08T25:00": None, "2026-08-08 Europe/Paris": None, "now": None, "": None,
             "2026-08-08T01:02:03+99:00": None, "20260808": None}
    df = spark.createDataFrame([(k,) for k in cases], "t string").select("t", C.coerce_timestamp("t").cast("string").alias("o"))
    assert {r.t: r.o for r in df.collect()} == cases


def test_dedup_beyond_the_broadcast_bound_is_the_same(spark, monkeypatch):
    df = spark.createDataFrame([(i % 7, i, f"t{i}") for i in range(20)] + [(50, 1, "x")], "id int, o int, t string")
    want = sorted(map(tuple, C.dedup_keep_last(df, "id", ["o"]).collect()))
    monkeypatch.setattr(C, "BROADCAST_MAX_ROWS", 2)
    assert C.repeated_keys(df.select("id"), "id") is None
    assert sorted(map(tuple, C.dedup_keep_last(df, "id", ["o"]).collect())) == want
