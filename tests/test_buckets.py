"""Bucketed tables: what an upsert touches, retries, versions, failed writes."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from plaintscope.operators.clean import upsert
from plaintscope.sources import buckets as B

ROWS = "complaint_id bigint, state string, seq int"


def files(root):
    return {os.path.join(d, f) for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet")}


def test_upsert_replaces_all_columns_but_the_first_time(spark, tmp_path):
    root = str(tmp_path / "complaints")
    assert B.publish_upsert(spark, root, spark.createDataFrame([(1, "NY", 1)], ROWS), seq="seq") == 1
    first = B.read_table(spark, root).first().ingested_at
    old = {f: os.path.getmtime(f) for f in files(root)}
    batch = spark.createDataFrame([(1, None, 1), (2, "A", 2), (2, "B", 3)], ROWS)
    assert B.publish_upsert(spark, root, batch, seq="seq") == 2
    out = {r.complaint_id: r for r in B.read_table(spark, root).collect()}
    assert out[1].state is None and out[1].ingested_at == first and out[2].state == "B"
    assert all(os.path.getmtime(f) == t for f, t in old.items())  # the input is never overwritten


def test_three_keys_of_a_thousand_buckets_write_three_buckets(spark, tmp_path):
    root = str(tmp_path / "t")
    base = spark.range(4000).select(F.col("id").alias("complaint_id"), F.lit("a").alias("state"), F.lit(0).alias("seq"))
    B.publish_upsert(spark, root, base, seq="seq", n_buckets=1000)
    before = files(root)
    state = B.manifest(spark, root)
    assert state["n_buckets"] == 1000 and len(state["folders"]) > 950
    B.publish_upsert(spark, root, spark.createDataFrame([(5, "b", 0), (77, "b", 0), (9999, "b", 0)], ROWS), seq="seq")
    new = files(root) - before
    assert {f.split("_bucket=")[1].split("/")[0] for f in new} == {
        str(r[0]) for r in spark.createDataFrame([(5,), (77,), (9999,)], "k bigint").select(B.bucket_of("k", 1000)).collect()}
    assert len(new) <= 3
    got = B.read_table(spark, root)
    assert got.count() == 4001 and got.where("state = 'b'").count() == 3


def test_same_as_a_whole_table_upsert(spark, tmp_path):
    root = str(tmp_path / "t")
    batches = [spark.createDataFrame([(i * k % 50 or None, f"{k}.{i}", i) for i in range(40)], ROWS) for k in (1, 3, 7)]
    whole = None
    for b in batches:
        B.publish_upsert(spark, root, b, seq="seq", n_buckets=8, splits=2)
        old = whole if whole is not None else b.limit(0).select("complaint_id", "state", F.lit(None).cast("timestamp_ntz").alias("ingested_at"))
        whole = upsert(old, b, seq="seq").checkpoint()
    rows = lambda df: sorted(map(tuple, df.select("complaint_id", "state").collect()), key=str)
    assert rows(B.read_table(spark, root)) == rows(whole)


def test_a_batch_is_taken_once(spark, tmp_path):
    root = str(tmp_path / "t")
    b = spark.createDataFrame([(1, "x", 1)], ROWS)
    assert B.publish_upsert(spark, root, b, seq="seq", batch_id="q#0") == 1
    assert B.publish_upsert(spark, root, spark.createDataFrame([(1, "late", 1)], ROWS), seq="seq", batch_id="q#1") == 2
    assert B.publish_upsert(spark, root, b, seq="seq", batch_id="q#0") == 2
    assert B.publish_upsert(spark, root, b.limit(0), seq="seq", batch_id="q#2") == 2
    assert B.read_table(spark, root).first().state == "late"


def test_old_versions_go_and_named_folders_stay(spark, tmp_path):
    root = str(tmp_path / "t")
    for v in range(6):
        B.publish_upsert(spark, root, spark.createDataFrame([(1, f"v{v}", 1), (100 + v, "once", 1)], ROWS), seq="seq", n_buckets=16)
    assert len(os.listdir(f"{root}/_manifests")) <= 2 * 2  # two manifests and their checksums
    named = set(B.manifest(spark, root)["folders"].values())
    assert all(os.path.isdir(f"{root}/{f}") for f in named)
    held = {f"data/{w}/{b}" for w in os.listdir(f"{root}/data") for b in os.listdir(f"{root}/data/{w}") if b.startswith("_bucket=")}
    assert len(held) <= len(named) + 2  # what the one older version still names
    got = {r.complaint_id: r.state for r in B.read_table(spark, root).collect()}
    assert got == {1: "v5"} | {100 + v: "once" for v in range(6)}


def test_a_write_without_a_commit_is_never_read(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    B.publish_upsert(spark, root, spark.createDataFrame([(1, "a", 1)], ROWS), seq="seq")
    with monkeypatch.context() as m:
        m.setattr(B, "_commit", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            B.publish_upsert(spark, root, spark.createDataFrame([(1, "b", 1)], ROWS), seq="seq")
    assert B.read_table(spark, root).first().state == "a" and len(os.listdir(f"{root}/data")) == 2
    B.publish_upsert(spark, root, spark.createDataFrame([(1, "c", 1)], ROWS), seq="seq")
    assert B.read_table(spark, root).first().state == "c"


def test_two_writers_of_one_version_are_told_apart(spark, tmp_path):
    root = str(tmp_path / "t")
    B.publish_upsert(spark, root, spark.createDataFrame([(1, "a", 1)], ROWS), seq="seq")
    with pytest.raises(RuntimeError, match="another writer"):
        B._commit(spark, root, B.manifest(spark, root))


def test_missing_and_empty_tables(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        B.read_table(spark, str(tmp_path / "none"))
    root = str(tmp_path / "t")
    B.publish_upsert(spark, root, spark.createDataFrame([], ROWS), seq="seq")
    assert B.read_table(spark, root).count() == 0 and B.read_table(spark, root).columns == ["complaint_id", "state", "ingested_at"]
    with pytest.raises(ValueError):
        B.publish_upsert(spark, root, spark.createDataFrame([(1, "a", 1)], ROWS), key="state")


def test_append_results_last_batch_wins_and_retries_are_one_batch(spark, tmp_path):
    root = str(tmp_path / "results")
    df = lambda *rows: spark.createDataFrame(list(rows), "product string, term string, v int")
    assert B.append_results(df(("p", "t", 1)), root) == 1
    assert B.append_results(df(("p", "t", 2), ("p", "u", 3)), root, batch_id="b2") == 2
    assert B.append_results(df(("p", "t", 9), ("p", "u", 9)), root, batch_id="b2") == 2
    assert B.append_results(df((None, "u", 4)), root, batch_id="b3") == 3
    got = {(r.product, r.term): r.v for r in B.read_results(spark, root, ["product", "term"]).collect()}
    assert got == {("p", "t"): 2, ("p", "u"): 3, (None, "u"): 4}
    assert B.read_table(spark, root).count() == 4  # every batch once


def test_maxima_from_the_manifest_equal_those_of_the_rows(spark, tmp_path):
    root, rows = str(tmp_path / "t"), "complaint_id long, d date, seq int"
    day = lambda n: dt.date(2024, 1, n)
    put = lambda data, **k: B.publish_upsert(spark, root, spark.createDataFrame(data, rows), seq="seq", n_buckets=4, **k)
    noted = {"d": F.col("d")}
    assert B.maximum(spark, root, "d", F.col("d")) is None
    put([(i, day(1 + i), 0) for i in range(9)], maxima=noted)
    assert B.maximum(spark, root, "d", F.lit(None)) == day(9)  # the rows are not asked
    put([(8, None, 0)], maxima=noted)  # the greatest one goes
    assert B.maximum(spark, root, "d", F.lit(None)) == day(8)
    put([(7, day(2), 0)])  # a batch without: its bucket is unknown, the rows are asked
    assert B.maximum(spark, root, "d", F.col("d")) == day(7)
    got = B.rows_of_keys(spark, root, spark.createDataFrame([(7,), (8,), (99,)], "_key long"))
    assert sorted((r.complaint_id, r.d) for r in got.collect()) == [(7, day(2)), (8, None)]
