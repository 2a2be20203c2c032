"""Exact top-k by a count, per group, without sorting a whole group in one task.

``row_number() <= k`` is planned as a WindowGroupLimit only for small k (Spark's
``windowGroupLimitThreshold``); for a vocabulary cap of 15,000-20,000 the plain window
would sort every term of a group in one task. Counts are integers with few
distinct values, so the cut is found from two small histograms, one row per group:

1. a (group, count) histogram gives the count value that holds the k-th row;
2. among rows of that value, a histogram on a two-character prefix of the tie column
   gives the prefix bucket that holds it. Binary string order of the prefixes agrees
   with the order of the full values.

The cut rows are broadcast behind their measured size; rows above the cut pass through a
map-side filter, and only the one boundary bucket per group is ranked by the tie column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import bounded_broadcast, cut_lineage


def _with_cut(df: DataFrame, cut: DataFrame, groups: list[str]) -> DataFrame:
    """``df`` beside its group's cut row (NULL when the group has none)."""
    cut = cut_lineage(cut)
    extra = [c for c in cut.columns if c not in groups]
    if not groups:  # one row: literals
        row = cut.first()
        return df.select("*", *[F.lit(row[c]).alias(c) for c in extra])
    for g in groups:
        cut = cut.withColumnRenamed(g, f"_cut_{g}")
    on = [df[g].eqNullSafe(F.col(f"_cut_{g}")) for g in groups]
    return df.join(bounded_broadcast(cut), on, "left").select(*df.columns, *extra)


def top_k_by_count(df: DataFrame, groups: list[str], count_col: str, tie_col: str,
                   k: int | None) -> DataFrame:
    """Rows of ``df`` ranked in the first ``k`` of their group by (count desc, tie asc).

    No ``groups``: the whole table is one group. ``k`` of None: no cap. ``df`` should be
    materialised (callers pass a checkpointed aggregate): one scalar job first measures the
    largest group, and when no group holds more than ``k`` rows they are returned as they
    are (same rows, fewer stages)."""
    if k is None:
        return df
    largest = (df.groupBy(*groups).agg(F.count(F.lit(1)).alias("_g"))
               .agg(F.max("_g")).first()[0])
    if largest is None or largest <= k:
        return df
    upto = Window.partitionBy(*groups).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    by_count = (df.groupBy(*groups, F.col(count_col).alias("_cut"))
                .agg(F.count(F.lit(1)).alias("_n"))
                .withColumn("_to", F.sum("_n").over(upto.orderBy(F.col("_cut").desc())))
                .where((F.col("_to") >= k) & (F.col("_to") - F.col("_n") < k))
                .select(*groups, "_cut", (k - F.col("_to") + F.col("_n")).alias("_need")))
    prefix = F.substring(F.col(tie_col), 1, 2)
    at_cut = _with_cut(df, by_count, groups).where(F.col(count_col) == F.col("_cut"))
    by_prefix = (at_cut.groupBy(*groups, "_cut", "_need", prefix.alias("_edge"))
                 .agg(F.count(F.lit(1)).alias("_n"))
                 .withColumn("_to", F.sum("_n").over(upto.orderBy("_edge")))
                 .where((F.col("_to") >= F.col("_need")) & (F.col("_to") - F.col("_n") < F.col("_need")))
                 .select(*groups, "_cut", "_edge",
                         (F.col("_need") - F.col("_to") + F.col("_n")).alias("_left")))
    marked = _with_cut(df, by_prefix, groups)
    same = F.col(count_col) == F.col("_cut")
    above = marked.where(F.col("_cut").isNull() | (F.col(count_col) > F.col("_cut"))
                         | (same & (prefix < F.col("_edge"))))
    rank = Window.partitionBy(*groups).orderBy(tie_col)
    edge = (marked.where(same & (prefix == F.col("_edge")))
            .withColumn("_r", F.row_number().over(rank)).where(F.col("_r") <= F.col("_left")))
    return above.select(*df.columns).unionByName(edge.select(*df.columns))
