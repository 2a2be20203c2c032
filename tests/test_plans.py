"""Plan-shape checks for the properties the design relies on at scale."""

from data_dirs import SF001
from plaintscope.operators import signals as S
from plaintscope.operators import themes as TH
from plaintscope.plans.cleaning import clean_table
from plaintscope.sources.adapters import narrative_complaints, volume_complaints


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_signals_prune_columns_and_aggregate_partially(spark):
    plan = _plan(S.weekly_company_metrics(volume_complaints(spark, SF001)))
    assert "ReadSchema: struct<l_returnflag:string,l_linestatus:string,l_shipdate:timestamp_ntz>" in plan
    assert "partial_count" in plan


def test_dedup_shuffles_rows_of_repeated_keys_only(spark):
    """Two passes: the id alone finds repeated ids; rows of other ids pass an anti-join unshuffled."""
    from plaintscope.operators import clean as C
    plan = _plan(clean_table(spark, SF001))
    once, more = plan.split("SortAggregate", 1)
    # (the adapter's own spreading of a small file is a REPARTITION_BY_NUM)
    assert "ENSURE_REQUIREMENTS" not in once and plan.count("ENSURE_REQUIREMENTS") == 1
    assert "LeftAnti" in plan and "partial_max_by" in more and "LeftSemi" in more
    raw = spark.createDataFrame([(1, "long narrative")], "id int, narrative string")
    first = C.repeated_keys(raw.select("id"), "id")
    assert first.columns == ["_key"]


def test_first_pass_of_dedup_reads_the_key_alone(spark, tmp_path):
    from plaintscope.operators import clean as C
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "a", 1), (1, "b", 2), (None, "c", 1), (None, "d", 0), (3, "e", 1)], "id int, narrative string, o int").write.parquet(path)
    df = spark.read.parquet(path)
    counted = df.select("id").groupBy("id").count().where("count > 1")
    assert "ReadSchema: struct<id:int>" in _plan(counted)
    got = sorted(map(tuple, C.dedup_keep_last(df, "id", ["o"]).collect()), key=str)
    assert got == sorted([(1, "b", 2), (None, "c", 1), (3, "e", 1)], key=str)


def test_theme_top_k_uses_window_group_limit(spark):
    themes = TH.emerging_themes(narrative_complaints(spark, SF001))
    assert "WindowGroupLimit" in _plan(themes)


def test_evidence_join_is_broadcast(spark):
    d = narrative_complaints(spark, SF001)
    ev = TH.theme_evidence(d, TH.top_themes(TH.emerging_themes(d)))
    assert "BroadcastHashJoin" in _plan(ev)


def test_alert_cutoff_is_a_scalar_subquery(spark):
    plan = _plan(S.risk_alerts(volume_complaints(spark, SF001)))
    assert "Subquery" in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_theme_windows_reach_the_scan_once(spark):
    """The window bounds are literals from one anchor job: the labelled narratives
    plan scans the text once and plans no scalar subquery."""
    d = narrative_complaints(spark, SF001)
    plan = _plan(TH.theme_totals(TH.labelled_narratives(d)))
    assert plan.count("FileScan parquet") == 1
    assert "Subquery" not in plan


def test_upsert_touches_only_batch_keys(spark):
    """Within the key bound the stored rows are split by broadcast anti/semi joins;
    no shuffle join reads the stored table."""
    import datetime as dt
    from plaintscope.operators import clean as C
    existing = spark.range(1000).selectExpr("id AS complaint_id", "'NY' AS state",
                                            "TIMESTAMP_NTZ'2026-01-01 00:00:00' AS ingested_at")
    incoming = spark.createDataFrame([(1, "CA", 1), (5000, "TX", 2)],
                                     "complaint_id bigint, state string, seq int")
    merged = C.upsert(existing, incoming, seq="seq", batch_ts=dt.datetime(2026, 2, 1))
    plan = _plan(merged)
    assert plan.count("BroadcastHashJoin") == 2 and "LeftAnti" in plan and "LeftSemi" in plan
    assert "SortMergeJoin" not in plan
    rows = {r.complaint_id: r.state for r in merged.collect()}
    assert len(rows) == 1001 and rows[1] == "CA" and rows[5000] == "TX" and rows[2] == "NY"


def test_labels_join_documents_by_broadcast(spark):
    """The (size-checked) label table is broadcast: the documents' text is not shuffled
    for the join."""
    from plaintscope.operators import classify as K
    from plaintscope.sources.adapters import labelled_narratives
    plan = _plan(K.class_counts(K.usable_narratives(labelled_narratives(spark, SF001))))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_vocabulary_cut_needs_no_shuffle_join(spark):
    from plaintscope.operators.topk import top_k_by_count
    df = spark.range(3000).selectExpr("concat('t', id) AS term", "id % 5 AS c", "id % 2 AS g")
    assert "Join" not in _plan(top_k_by_count(df, [], "c", "term", 700))
    plan = _plan(top_k_by_count(df, ["g"], "c", "term", 700))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
