"""End-to-end batch run over a CSV extract written from the events adapter."""

from pyspark.sql import functions as F

from data_dirs import SF001
from plaintscope import pipeline
from plaintscope.operators import quality as Q
from plaintscope.operators import themes as TH
from plaintscope.plans.cleaning import clean_table
from plaintscope.sources.adapters import raw_extract
from plaintscope.sources.buckets import maximum, read_table


def test_pipeline_end_to_end(spark, tmp_path):
    raw = raw_extract(spark, SF001)
    src = str(tmp_path / "extract")
    # One file in event order: file order is the input order keep-last relies on.
    (raw.orderBy("_row").drop("_chunk", "_row").coalesce(1)
     .write.option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(src))
    out = str(tmp_path / "run")
    pipeline.run(spark, src, out)
    table = read_table(spark, out + "/complaints").drop("ingested_at")
    want = clean_table(spark, SF001)
    assert table.count() == want.count()
    assert table.select(want.columns).exceptAll(want).count() == 0
    by_month = spark.read.parquet(out + "/complaints_by_month")
    assert by_month.count() == want.count() and "received_month" in by_month.columns
    qr = spark.read.option("header", True).csv(out + "/quality_report")
    assert qr.count() == 9
    own = Q.quality_report(table).select(*[F.col(c).cast("string") for c in qr.columns])
    assert sorted(map(tuple, qr.collect())) == sorted(map(tuple, own.collect()))
    cover = spark.read.option("header", True).csv(out + "/narrative_coverage").first()
    assert tuple(cover) == tuple(str(v) for v in Q.narrative_coverage(table).first())
    brief = spark.read.text(out + "/brief").collect()
    assert brief[0].value.startswith("# ")
    assert spark.read.parquet(out + "/theme_prompts").where(F.col("prompt").isNull()).count() == 0


def test_extracts_of_two_headers_run_together(spark, tmp_path):
    """Files that name their columns in another order, one with a column more, as chunks of one run."""
    raw = raw_extract(spark, SF001).orderBy("_row").drop("_row")
    names = [c for c in raw.columns if c != "_chunk"]
    src = str(tmp_path / "extract")
    for i, cols in enumerate((names, names[::-1], names[3:] + ["more"] + names[:3])):
        part = raw.withColumn("more", F.lit("x")).where(F.pmod(F.col("_chunk"), F.lit(3)) == i).select(*cols)
        (part.coalesce(1).write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False)
         .option("ignoreTrailingWhiteSpace", False).csv(f"{src}/chunk{i}"))
    out = str(tmp_path / "run")
    pipeline.run(spark, f"{src}/*", out)
    table = read_table(spark, out + "/complaints")
    want = clean_table(spark, SF001)
    # Chunks are read in path order here, so a repeated id may keep another chunk's row.
    assert table.select("complaint_id").exceptAll(want.select("complaint_id")).count() == 0
    once = raw.groupBy(F.col("`Complaint ID`").alias("i")).count().where("count = 1").select(F.col("i").cast("bigint").alias("complaint_id"))
    a, b = (x.drop("ingested_at").join(once, "complaint_id") for x in (table, want))
    assert a.select(b.columns).exceptAll(b).count() == 0 and a.count() == b.count() > 50


HEAD = ["Complaint ID", "Date received", "Product", "Issue", "Company", "Consumer complaint narrative"]


def _extract(spark, path, rows):
    from plaintscope.schema import RAW_HEADER
    df = spark.createDataFrame(rows, ", ".join(f"c{i} string" for i in range(len(HEAD))))
    cols = [F.col(f"c{HEAD.index(h)}").alias(h) if h in HEAD else F.lit(None).cast("string").alias(h) for h in RAW_HEADER]
    df.select(*cols).coalesce(1).write.option("header", True).csv(path)


def test_themes_of_batches_equal_a_run_over_the_whole_table(spark, tmp_path):
    """Three batches, the second correcting rows of the first, the last one run twice."""
    text = ["late fee charged", "card lost again", "late fee refused", "account closed early", None]
    def row(i, day, t):
        return (str(i), f"2024-05-{day:02d}", "ab"[i % 2], "billing", "c", t)
    first = [row(i, 1 + i % 20, text[i % 5]) for i in range(160)]
    second = [row(i, 21, "late fee charged twice") for i in range(30, 60)] + [row(500 + i, 21, "late fee") for i in range(9)]
    third = [row(600 + i, 22 + i % 2, text[i % 3]) for i in range(30)]
    out = str(tmp_path / "run")
    for name, rows, times in (("one", first, 1), ("two", second, 1), ("three", third, 2)):
        src = str(tmp_path / name)
        _extract(spark, src, rows)
        for _ in range(times):
            pipeline.run(spark, src, out, batch_id=name)
        table = read_table(spark, out + "/complaints")
        assert TH.anchor_day(table) == maximum(spark, out + "/complaints", TH.NARRATIVE_DAY, F.lit(None))
        want = TH.emerging_themes(table)
        got = spark.read.option("header", True).csv(out + "/emerging_themes")
        text_of = lambda df: sorted(tuple(map(str, r)) for r in df.collect())
        assert text_of(got) == text_of(want.select(*[F.col(c).cast("string") for c in want.columns]))
        assert got.count() > 3 or name == "one"
    assert table.count() == 160 + 9 + 30
