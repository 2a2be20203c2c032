"""Headers of many files are found in one job, whatever stands in them."""

import csv

import pytest

from plaintscope.schema import RAW_HEADER
from plaintscope.sources.complaints import header_records, read_complaints


def _write(path, header, rows, before=""):
    with open(path, "w", newline="") as f:
        f.write(before)
        out = csv.writer(f)
        out.writerow(header)
        out.writerows(rows)


def _jobs(spark, body):
    """Result of ``body`` and how many Spark jobs it started."""
    sc, group = spark.sparkContext, "headers"
    sc.setJobGroup(group, group)
    try:
        return body(), len(sc.statusTracker().getJobIdsForGroup(group))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_headers_are_read_in_one_job_from_odd_files(spark, tmp_path):
    head = list(RAW_HEADER)
    row = lambda i, names: [f"{n} of {i}" if n in RAW_HEADER else "x" for n in names]
    odd = ['odd\nname, "q"'] + head[::-1]
    for i in range(12):
        names = odd if i % 3 == 0 else head
        _write(tmp_path / f"part {i}%.csv", names, [row(i, names)] * (4000 if i == 1 else 2), "\n\n" if i % 4 == 0 else "")
    (tmp_path / "empty.csv").write_text("")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    found, jobs = _jobs(spark, lambda: header_records(spark, str(tmp_path)))
    assert jobs == 1 and len(found) == 12 and len({h for _, h in found}) == 2
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    df = read_complaints(spark, str(tmp_path))
    assert df.columns == head and df.count() == 11 * 2 + 4000
    assert df.where("`Complaint ID` = 'Complaint ID of 3' and Company = 'Company of 3'").count() == 2


def test_headers_are_right_where_the_split_settings_are_pinned(spark, tmp_path, monkeypatch):
    """A session that keeps small splits: files of many splits and many files in a partition."""
    head = list(RAW_HEADER)
    for i in range(30):
        names = ["a\nb"] + head if i % 2 else head
        _write(tmp_path / f"{i:02d}.csv", names, [["x\ny"] * len(names)] * (3000 if i < 2 else 1))
    conf = type(spark.conf)
    real = conf.set
    monkeypatch.setattr(conf, "set", lambda self, key, value: None if key.startswith("spark.sql.files.") else real(self, key, value))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    make = type(spark).newSession

    def pinned(self):
        session = make(self)
        real(session.conf, "spark.sql.files.maxPartitionBytes", "20k")
        real(session.conf, "spark.sql.files.openCostInBytes", "1")
        return session

    monkeypatch.setattr(type(spark), "newSession", pinned)
    found = header_records(spark, str(tmp_path))
    assert len(found) == 30 and len({f for f, _ in found}) == 30 and len({h for _, h in found}) == 2
    assert read_complaints(spark, str(tmp_path)).count() == 2 * 3000 + 28
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == old


def test_a_file_without_a_wanted_column_is_named(spark, tmp_path):
    _write(tmp_path / "a.csv", list(RAW_HEADER), [])
    _write(tmp_path / "b.csv", list(RAW_HEADER)[1:], [])
    with pytest.raises(ValueError, match="b.csv: no column"):
        read_complaints(spark, str(tmp_path))


def test_an_empty_folder_of_files_gives_no_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    df = read_complaints(spark, str(tmp_path), keep_order=True)
    assert df.count() == 0 and df.columns[:2] == list(RAW_HEADER)[:2]
