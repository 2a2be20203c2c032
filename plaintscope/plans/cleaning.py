"""Ingest queries over the raw events extract: null tokens, clean, dedup, upsert,
coverage, quality report, profile and data checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import NULL_TOKENS
from ..operators import clean as C
from ..session import cut_lineage
from ..operators import quality as Q
from ..schema import LOAD_COLUMNS, RAW_HEADER, TRIMMED_COLUMNS
from ..sources.adapters import raw_extract
from ..sources.complaints import chunk_coverage, normalize_nulls, union_chunks
from .registry import register

ORDER = ["_chunk", "_row"]

# ---------------------------------------------------------------- DuckDB mirrors
RAW_SQL = """
SELECT
  CASE WHEN event_id % 53 = 7 THEN 'not a date'
       WHEN event_id % 11 = 3 THEN strftime(ts, '%m/%d/%Y')
       WHEN event_id % 7 = 2 THEN strftime(ts, '%Y-%m-%d')
       ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS "Date received",
  CASE WHEN event_id % 41 = 5 THEN '   '
       WHEN event_id % 5 = 1 THEN '  ' || event_type || ' ' ELSE event_type END AS "Product",
  CASE WHEN event_id % 2 = 0 THEN 'sub-' || event_type ELSE 'N/A' END AS "Sub-product",
  CASE WHEN event_id % 59 = 11 THEN NULL
       ELSE 'issue-' || CAST(user_id % 12 AS VARCHAR) END AS "Issue",
  CASE WHEN event_id % 3 = 0 THEN 'detail-' || CAST(user_id % 5 AS VARCHAR) ELSE 'NA' END AS "Sub-issue",
  CASE WHEN event_id % 3 = 0 THEN props ELSE '' END AS "Consumer complaint narrative",
  CAST(NULL AS VARCHAR) AS "Company public response",
  CASE WHEN event_id % 67 = 13 THEN 'NULL'
       WHEN event_id % 13 = 4 THEN ' co-' || CAST(user_id % 40 AS VARCHAR) || ' '
       ELSE 'co-' || CAST(user_id % 40 AS VARCHAR) END AS "Company",
  CASE user_id % 4 WHEN 0 THEN 'NY' WHEN 1 THEN 'CA' WHEN 2 THEN 'TX' ELSE NULL END AS "State",
  lpad(CAST((user_id * 37) % 100000 AS VARCHAR), 5, '0') AS "ZIP code",
  CAST(NULL AS VARCHAR) AS "Tags",
  'N/A' AS "Consumer consent provided?",
  'Web' AS "Submitted via",
  strftime(CAST(ts AS DATE) + 1, '%Y-%m-%d') AS "Date sent to company",
  'Closed with explanation' AS "Company response to consumer",
  CASE WHEN event_id % 6 = 0 THEN 'Yes' WHEN event_id % 6 = 1 THEN ' no '
       WHEN event_id % 6 = 2 THEN 'YES' WHEN event_id % 6 = 3 THEN NULL
       WHEN event_id % 6 = 4 THEN 'No' WHEN event_id % 43 = 5 THEN 'Y' ELSE 'yes' END AS "Timely response?",
  CAST(NULL AS VARCHAR) AS "Consumer disputed?",
  CASE WHEN event_id % 97 = 96 THEN NULL
       ELSE CAST(CASE WHEN event_id % 10 = 9 THEN event_id - 5 ELSE event_id END AS VARCHAR)
  END AS "Complaint ID",
  CAST(floor((CAST(ts AS DATE) - DATE '2024-01-01') / 7) AS INTEGER) AS _chunk,
  event_id AS _row
FROM events"""

_TOKENS_SQL = ", ".join("'" + t.replace("'", "''") + "'" for t in NULL_TOKENS)
_TRIM = r"'^[\s\p{Z}]+|[\s\p{Z}]+$'"


def _nn(c: str) -> str:
    return f'CASE WHEN "{c}" IN ({_TOKENS_SQL}) THEN NULL ELSE "{c}" END AS "{c}"'


NULLS_SQL = f"SELECT {', '.join(_nn(c) for c in RAW_HEADER)}, _chunk, _row FROM ({RAW_SQL}) r"


def _ts(c: str) -> str:
    t = f"regexp_replace(\"{c}\", {_TRIM}, '', 'g')"
    fmts = ["%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%d", "%m/%d/%Y"]
    return "COALESCE(" + ", ".join(f"try_strptime({t}, '{f}')" for f in fmts) + ")"


def _std_col(raw_name: str) -> str:
    name = C.normalize_name(raw_name)
    if name == "complaint_id":
        t = f"regexp_replace(\"{raw_name}\", {_TRIM}, '', 'g')"
        d = f"TRY_CAST({t} AS DECIMAL(38, 10))"
        return f"CASE WHEN {d} = floor({d}) THEN TRY_CAST(floor({d}) AS BIGINT) END AS complaint_id"
    if name in ("date_received", "date_sent_to_company"):
        return f"{_ts(raw_name)} AS {name}"
    if name in TRIMMED_COLUMNS:
        return f"NULLIF(regexp_replace(\"{raw_name}\", {_TRIM}, '', 'g'), '') AS {name}"
    return f'"{raw_name}" AS {name}'


STD_SQL = f"SELECT {', '.join(_std_col(c) for c in RAW_HEADER)}, _chunk, _row FROM ({NULLS_SQL}) n"
KEPT_SQL = (f"SELECT * FROM ({STD_SQL}) s WHERE complaint_id IS NOT NULL AND date_received IS NOT NULL"
            " AND product IS NOT NULL AND issue IS NOT NULL AND company IS NOT NULL")
CLEAN_SQL = (f"SELECT {', '.join(LOAD_COLUMNS)} FROM ({KEPT_SQL}) k "
             "QUALIFY row_number() OVER (PARTITION BY complaint_id ORDER BY _chunk DESC, _row DESC) = 1")


# ---------------------------------------------------------------- Spark side
def clean_table(spark, sf, sort=False, materialize=False):
    """The cleaned complaint table. ``materialize`` writes it once (reliable
    checkpoint) for queries that read it several times, as the stored clean table
    would be read in a pipeline."""
    out = C.clean_complaints(normalize_nulls(raw_extract(spark, sf)), ORDER, sort=sort)
    return cut_lineage(out) if materialize else out


@register("null_tokens", NULLS_SQL)
def q_null_tokens(spark, sf):
    return normalize_nulls(raw_extract(spark, sf))


@register("clean_complaints", CLEAN_SQL)
def q_clean(spark, sf):
    return clean_table(spark, sf, sort=True)


@register("rejects", f"""
WITH s AS ({STD_SQL}), k AS ({KEPT_SQL})
SELECT (SELECT count(*) FROM s) AS raw_records,
       (SELECT count(*) FROM s) - (SELECT count(*) FROM k) AS rejected_missing_required,
       (SELECT count(*) - count(DISTINCT complaint_id) FROM k) AS duplicate_ids_removed,
       (SELECT count(DISTINCT complaint_id) FROM k) AS clean_records""")
def q_rejects(spark, sf):
    return C.clean_summary(normalize_nulls(raw_extract(spark, sf)), ORDER)


@register("history_dedup", f"""
SELECT * EXCLUDE (_chunk, _row) FROM ({RAW_SQL}) r
QUALIFY row_number() OVER (PARTITION BY "Complaint ID" ORDER BY _chunk DESC, _row DESC) = 1""")
def q_history_dedup(spark, sf):
    """A5 + F1: two date chunks with different column order, unioned, keep-last per raw id."""
    raw = raw_extract(spark, sf)
    early = raw.where(F.col("_chunk") < 2)
    late = raw.where(F.col("_chunk") >= 2).select(*reversed(raw.columns))
    both = union_chunks(early, late)
    return (C.dedup_keep_last(both, "Complaint ID", ORDER).drop(*ORDER))


EXISTING_TS = "2024-01-20 00:00:00"
BATCH_TS = "2024-02-01 00:00:00"


@register("upsert_merge", f"""
WITH k AS ({KEPT_SQL}),
old AS (SELECT {', '.join(LOAD_COLUMNS)}, TIMESTAMP '{EXISTING_TS}' AS ingested_at,
               0 AS _src, _chunk, _row FROM k WHERE _chunk <= 2
        QUALIFY row_number() OVER (PARTITION BY complaint_id ORDER BY _chunk DESC, _row DESC) = 1),
new AS (SELECT {', '.join(LOAD_COLUMNS)}, CAST(NULL AS TIMESTAMP) AS ingested_at,
               1 AS _src, _chunk, _row FROM k WHERE _chunk >= 2),
u AS (SELECT * FROM old UNION ALL SELECT * FROM new)
SELECT {', '.join(LOAD_COLUMNS)},
       COALESCE(min(ingested_at) OVER (PARTITION BY complaint_id), TIMESTAMP '{BATCH_TS}') AS ingested_at
FROM u
QUALIFY row_number() OVER (PARTITION BY complaint_id ORDER BY _src DESC, _row DESC) = 1""")
def q_upsert(spark, sf):
    """A8 + A9: the table as of week 2 (existing) merged with the batch of weeks 2+."""
    raw = normalize_nulls(raw_extract(spark, sf))
    # The stored table as of week 2: written once, as a published version would be
    # (the upsert reads it twice, once per side of the broadcast key split).
    existing = cut_lineage(
        C.clean_complaints(raw.where(F.col("_chunk") <= 2), ORDER, sort=False)
        .select(*LOAD_COLUMNS, F.lit(EXISTING_TS).cast("timestamp_ntz").alias("ingested_at")))
    incoming = C._standardize_keep(raw.where(F.col("_chunk") >= 2), ORDER)
    return C.upsert(existing, incoming, "complaint_id", seq="__ord1", batch_ts=BATCH_TS,
                    valid=~C.missing_required())


@register("chunk_coverage", f"""
WITH cl AS ({CLEAN_SQL}),
b AS (SELECT min(CAST(date_received AS DATE)) AS s, max(CAST(date_received AS DATE)) AS e FROM cl),
p AS (SELECT DISTINCT product FROM cl),
g AS (SELECT product, CAST(k AS INTEGER) AS chunk_no FROM p, b,
             range(0, CAST(floor((e - s) / 7) AS BIGINT) + 1) t(k)),
n AS (SELECT product, CAST(floor((CAST(date_received AS DATE) - (SELECT s FROM b)) / 7) AS INTEGER) AS chunk_no,
             count(*) AS records FROM cl GROUP BY 1, 2)
SELECT g.product, g.chunk_no, (SELECT s FROM b) + 7 * g.chunk_no AS chunk_start,
       least((SELECT s FROM b) + 7 * g.chunk_no + 6, (SELECT e FROM b)) AS chunk_end,
       COALESCE(n.records, 0) AS records
FROM g LEFT JOIN n USING (product, chunk_no)""")
def q_coverage(spark, sf):
    cl = clean_table(spark, sf, materialize=True)
    day = F.to_date("date_received")
    bounds = cl.agg(F.struct(F.min(day).alias("lo"), F.max(day).alias("hi"))).scalar()
    return chunk_coverage(cl, cl.select("product").distinct(), bounds.getField("lo"),
                          bounds.getField("hi"), 7)


def _quality_sql() -> str:
    cols = ", ".join(LOAD_COLUMNS)
    checks = [
        ("Total records", "0"),
        ("Missing complaint ID", "(SELECT count(*) FILTER (WHERE complaint_id IS NULL) FROM cl)"),
        ("Duplicate complaint ID",
         "(SELECT coalesce(sum(n - 1), 0) FROM (SELECT count(*) AS n FROM cl GROUP BY complaint_id))"),
        ("Missing received date", "(SELECT count(*) FILTER (WHERE date_received IS NULL) FROM cl)"),
        ("Missing product", "(SELECT count(*) FILTER (WHERE product IS NULL) FROM cl)"),
        ("Missing issue", "(SELECT count(*) FILTER (WHERE issue IS NULL) FROM cl)"),
        ("Missing company", "(SELECT count(*) FILTER (WHERE company IS NULL) FROM cl)"),
        ("Duplicate full rows",
         f"(SELECT coalesce(sum(n - 1), 0) FROM (SELECT count(*) AS n FROM cl GROUP BY {cols}))"),
        ("Missing narratives",
         "(SELECT count(*) FILTER (WHERE consumer_complaint_narrative IS NULL) FROM cl)"),
    ]
    parts = [f"SELECT {i} AS check_order, '{n}' AS check_name, CAST({f} AS BIGINT) AS failed_records"
             for i, (n, f) in enumerate(checks, start=1)]
    return f"""
WITH cl AS ({CLEAN_SQL}), r AS ({' UNION ALL '.join(parts)})
SELECT check_order, check_name, failed_records, (SELECT count(*) FROM cl) AS checked_records,
       round_even(CAST((SELECT count(*) FROM cl) - failed_records AS DOUBLE)
                  / CAST((SELECT count(*) FROM cl) AS DOUBLE) * 100.0, 2) AS pass_rate_percent
FROM r"""


@register("quality_report", _quality_sql())
def q_quality(spark, sf):
    return Q.quality_report(clean_table(spark, sf, materialize=True))


@register("narrative_coverage", f"""
WITH cl AS ({CLEAN_SQL})
SELECT count(*) AS records, count(consumer_complaint_narrative) AS with_narrative,
       round_even(CAST(count(consumer_complaint_narrative) AS DOUBLE) * 100.0
                  / CAST(count(*) AS DOUBLE), 2) AS coverage_percent FROM cl""")
def q_narrative_coverage(spark, sf):
    return Q.narrative_coverage(clean_table(spark, sf))


PROFILE_SQL = f"SELECT * EXCLUDE (_chunk, _row) FROM ({NULLS_SQL}) p"


def _profile_frame(spark, sf):
    return normalize_nulls(raw_extract(spark, sf)).drop(*ORDER)


@register("profile_shape", f"SELECT count(*) AS rows, CAST({len(RAW_HEADER)} AS BIGINT) AS columns "
                           f"FROM ({PROFILE_SQL}) p")
def q_profile_shape(spark, sf):
    return Q.profile_shape(_profile_frame(spark, sf))


@register("profile_missing", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE \"{c}\" IS NULL) AS missing "
    f"FROM ({PROFILE_SQL}) p" for c in RAW_HEADER))
def q_profile_missing(spark, sf):
    return Q.profile_missing(_profile_frame(spark, sf))


TOP_COLUMNS = ["Product", "Issue", "Company"]


@register("profile_top_values", f"""
WITH p AS ({PROFILE_SQL}),
pairs AS ({' UNION ALL '.join(f"SELECT '{c}' AS column_name, CAST(\"{c}\" AS VARCHAR) AS value FROM p"
                               for c in TOP_COLUMNS)}),
c AS (SELECT column_name, value, count(*) AS records FROM pairs WHERE value IS NOT NULL GROUP BY 1, 2)
SELECT column_name, value, records,
       CAST(row_number() OVER (PARTITION BY column_name ORDER BY records DESC, value) AS INTEGER) AS rank
FROM c QUALIFY rank <= 10""")
def q_profile_top(spark, sf):
    return Q.top_values(_profile_frame(spark, sf), TOP_COLUMNS, 10)


@register("profile_timely", f"""
SELECT "Timely response?" AS value, count(*) AS records FROM ({PROFILE_SQL}) p GROUP BY 1""")
def q_profile_timely(spark, sf):
    return Q.value_counts_with_null(_profile_frame(spark, sf), "Timely response?")


@register("timely_domain", f"""
SELECT DISTINCT lower(trim(timely_response)) AS value FROM ({CLEAN_SQL}) cl
WHERE timely_response IS NOT NULL AND lower(trim(timely_response)) NOT IN ('yes', 'no')""")
def q_timely_domain(spark, sf):
    return Q.timely_domain(clean_table(spark, sf))


@register("schema_check", f"""
WITH cl AS ({CLEAN_SQL})
{' UNION ALL '.join(f"SELECT count(*) AS records, '{c}' AS column_name, true AS present, "
                    f"count(*) FILTER (WHERE {c} IS NULL) AS missing FROM cl"
                    for c in ('complaint_id', 'date_received', 'product', 'issue', 'company',
                              'timely_response'))}""")
def q_schema_check(spark, sf):
    return Q.schema_check(clean_table(spark, sf))


@register("src_scan", f"SELECT * FROM ({STD_SQL}) s")
def q_src_scan(spark, sf):
    """A1 + A2 + A7: the raw extract written as CSV (shared checkpoint folder), scanned
    back with the fixed text schema, null tokens applied, typed."""
    import uuid
    from ..session import checkpoint_path
    from ..sources.complaints import read_complaints
    from ..sources.sinks import write_table
    path = checkpoint_path(spark, f"raw-extract-{uuid.uuid4().hex}")
    write_table(raw_extract(spark, sf), path, fmt="csv")
    back = normalize_nulls(read_complaints(spark, path, header=RAW_HEADER + tuple(ORDER)))
    typed = C.standardize(C.normalize_columns(back))
    return typed.withColumns({"_chunk": F.col("_chunk").cast("int"), "_row": F.col("_row").cast("bigint")})
