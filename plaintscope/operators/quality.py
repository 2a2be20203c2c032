"""Data-quality report, profile and data checks.

The NULL checks are one wide aggregate turned into report rows with ``inline``.
Both duplicate checks come from one grouped chain keyed by (id, row digest) over the rows
of repeated ids, with partial aggregation first, so hot keys collapse map-side and no whole
row is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import TIMELY_DOMAIN
from ..schema import SCHEMA_CHECK_COLUMNS
from .clean import by_repetition, repeated_keys


def duplicate_key_count(df: DataFrame, key: str) -> DataFrame:
    """Rows beyond the first per key (NULL keys count as one group)."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
            .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("duplicates")))


def row_digest(df: DataFrame):
    """SHA-256 of the row in a canonical JSON form (NULL fields omitted, so NULL and
    '' differ, and column order is fixed)."""
    # The default timestamp text stops at milliseconds.
    whole = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    return F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), whole), 256)


def duplicate_row_count(df: DataFrame, key: str | None = None) -> DataFrame:
    """Rows beyond the first per identical full row.

    Identical rows share every column, so the groups are keyed by (``key``, digest
    of the row): the shuffle carries an id and 32 bytes per row instead of whole
    rows with their narratives."""
    cols = ([F.col(f"`{key}`")] if key else []) + [row_digest(df).alias("_d")]
    return (df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
            .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("duplicates")))


# Quality checks in report order.
QUALITY_CHECKS = (
    "Total records",
    "Missing complaint ID",
    "Duplicate complaint ID",
    "Missing received date",
    "Missing product",
    "Missing issue",
    "Missing company",
    "Duplicate full rows",
    "Missing narratives",
)


def null_checks() -> list[Column]:
    """The report's counts that need no grouping, as aggregates: in a query of their own or observed
    while the table is written (``DataFrame.observe``)."""
    return [F.count(F.lit(1)).alias("total")] + [
        F.count_if(F.col(c).isNull()).alias(m) for m, c in (
            ("miss_id", "complaint_id"), ("miss_date", "date_received"), ("miss_product", "product"),
            ("miss_issue", "issue"), ("miss_company", "company"), ("miss_narr", "consumer_complaint_narrative"))]


def quality_report(complaints: DataFrame, observed: dict | None = None) -> DataFrame:
    """Nine checks with failed, checked and pass rate % (half-even, 2 places). With ``observed``
    (the values of ``null_checks`` over these rows) only the ids are read."""
    wide = complaints.agg(*null_checks())
    if observed is not None:
        wide = complaints.sparkSession.range(1).select(
            *[F.lit(v).cast("bigint").alias(m) for m, v in observed.items()])
    # Identical rows share their id: only rows of repeated ids are hashed and shuffled.
    repeated = repeated_keys(complaints.select("complaint_id"), "complaint_id")
    rows = complaints if repeated is None else by_repetition(complaints, "complaint_id", repeated)[1]
    pairs = rows.groupBy("complaint_id", row_digest(rows).alias("_d")).agg(F.count(F.lit(1)).alias("n"))
    per_id = pairs.groupBy("complaint_id").agg(F.sum("n").alias("m"),
                                               F.sum(F.col("n") - 1).alias("same_rows"))
    dups = per_id.agg(F.coalesce(F.sum(F.col("m") - 1), F.lit(0)).cast("bigint").alias("i"),
                      F.coalesce(F.sum("same_rows"), F.lit(0)).cast("bigint").alias("r"))
    both = dups.select(F.struct("i", "r")).scalar()      # one subquery, used twice
    dup_id, dup_row = both.getField("i"), both.getField("r")
    failed = [F.lit(0).cast("bigint"), F.col("miss_id"), dup_id, F.col("miss_date"),
              F.col("miss_product"), F.col("miss_issue"), F.col("miss_company"), dup_row,
              F.col("miss_narr")]
    rows = F.array(*[F.struct(F.lit(i).alias("check_order"), F.lit(n).alias("check_name"),
                              f.cast("bigint").alias("failed_records"))
                     for i, (n, f) in enumerate(zip(QUALITY_CHECKS, failed), start=1)])
    out = (wide.select(F.col("total").alias("checked_records"), F.inline(rows)))
    rate = F.bround(F.try_divide((F.col("checked_records") - F.col("failed_records")).cast("double"),
                                 F.col("checked_records").cast("double")) * 100.0, 2)
    return out.select("check_order", "check_name", "failed_records", "checked_records",
                      rate.alias("pass_rate_percent"))


def narrative_coverage(complaints: DataFrame, observed: dict | None = None) -> DataFrame:
    """Share of rows with a narrative, % to 2 places; from ``observed`` null checks if given."""
    if observed is not None:
        n, k = F.lit(observed["total"]).cast("bigint"), F.lit(observed["total"] - observed["miss_narr"]).cast("bigint")
        return complaints.sparkSession.range(1).select(
            n.alias("records"), k.alias("with_narrative"),
            F.bround(F.try_divide(k.cast("double") * 100.0, n.cast("double")), 2).alias("coverage_percent"))
    return complaints.agg(
        F.count(F.lit(1)).alias("records"),
        F.count("consumer_complaint_narrative").alias("with_narrative"),
        F.bround(F.try_divide(F.count("consumer_complaint_narrative").cast("double") * 100.0,
                              F.count(F.lit(1)).cast("double")), 2).alias("coverage_percent"))


def profile_shape(df: DataFrame) -> DataFrame:
    """Row and column counts."""
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.lit(len(df.columns)).cast("bigint").alias("columns"))


def profile_missing(df: DataFrame) -> DataFrame:
    """E5: missing values per column in one pass, most missing first (ties by name)."""
    wide = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"m{i}")
                    for i, c in enumerate(df.columns)])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"m{i}").alias("missing"))
                      for i, c in enumerate(df.columns)])
    return (wide.select(F.inline(pairs))
            .orderBy(F.col("missing").desc(), "column_name"))


def top_values(df: DataFrame, columns: list[str], k: int = 10) -> DataFrame:
    """E3 + G2: top-k value counts per column (NULL excluded; ties by value).

    One aggregate over (column, value) pairs produced by explode, then a window
    limit per column (Spark plans a WindowGroupLimit before the final sort).
    """
    from pyspark.sql import Window
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"),
                               F.col(f"`{c}`").cast("string").alias("value")) for c in columns])
    counts = (df.select(F.inline(pairs)).where(F.col("value").isNotNull())
              .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("records")))
    w = Window.partitionBy("column_name").orderBy(F.col("records").desc(), "value")
    return (counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k))


def value_counts_with_null(df: DataFrame, column: str) -> DataFrame:
    """Value counts keeping NULL as a group."""
    return (df.groupBy(F.col(f"`{column}`").alias("value"))
            .agg(F.count(F.lit(1)).alias("records")))


def timely_domain(df: DataFrame, column: str = "timely_response",
                  allowed=TIMELY_DOMAIN) -> DataFrame:
    """E14 + H2: observed (trimmed, lower-cased, non-NULL) values outside the allowed set."""
    observed = (df.select(F.lower(F.trim(F.col(column))).alias("value"))
                .where(F.col("value").isNotNull()).distinct())
    return observed.where(~F.col("value").isin(*allowed))


def schema_check(df: DataFrame, required=SCHEMA_CHECK_COLUMNS) -> DataFrame:
    """H3 + the reference's data tests: per required column, whether present and its
    NULL count (present columns only; one aggregate pass)."""
    present = [c for c in required if c in df.columns]
    wide = df.agg(F.count(F.lit(1)).alias("records"),
                  *[F.count_if(F.col(c).isNull()).alias(f"n_{c}") for c in present])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"),
                              F.lit(c in df.columns).alias("present"),
                              (F.col(f"n_{c}") if c in df.columns else F.lit(None).cast("bigint"))
                              .alias("missing"))
                     for c in required])
    return wide.select("records", F.inline(rows))
