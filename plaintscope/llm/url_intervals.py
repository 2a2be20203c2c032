"""Temporal list join: which dated list entries were active when a URL was captured.

A list arrives as dated entries ``(key, category, day, action)`` with action ``add`` or
``remove``. A key is a host or any of its parents (``example.org`` covers ``a.b.example.org``),
a host with a path prefix of whole segments (``example.org/a/b``), or host, path and query.
Entries become validity intervals ``[since, until)`` by one window over each (key, category):
the last entry of a day decides that day (``remove`` after ``add``), repeated adds extend the
interval, the last add stays open. Each capture is joined as of its fetch day to the intervals
of its own keys. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import bounded_broadcast, cut_lineage

URL = r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)(?::[0-9]*)?(/[^?#]*)?(\?[^#]*)?"
LISTED_DEPTH = 3  # path prefixes from which the made-up entries are picked
FOREVER = "9999-12-31"


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), URL, 1))


def _parts(url: Column) -> tuple[Column, Column, Column]:
    """Labels of the host, segments of the path, and host with path and query."""
    text = F.coalesce(url, F.lit(""))
    path, host = F.regexp_extract(text, URL, 2), host_of(url)
    return (F.split(host, r"\."), F.filter(F.split(path, "/"), lambda x: x != ""),
            F.concat(host, path, F.regexp_extract(text, URL, 3)))


def keys_of(url: Column, depth: Column | int) -> Column:
    """The keys a URL is looked up by: its host and all parents, the host with each path prefix of at
    most ``depth`` segments, and the whole."""
    labels, segments, whole = _parts(url)
    host = host_of(url)
    parents = F.transform(labels, lambda _, i: F.array_join(F.slice(labels, i + 1, F.size(labels)), "."))
    n = F.least(F.size(segments), F.lit(depth) if isinstance(depth, int) else depth)
    prefixes = F.when(n > 0, F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(
        host, F.lit("/"), F.array_join(F.slice(segments, 1, i), "/")))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(parents, prefixes, F.array(whole)))


def to_intervals(entries: DataFrame) -> DataFrame:
    """``key, category, since, until`` from ``key, category, day, action``.

    Entries with a null key, category, day or unknown action say nothing; repeated entries
    count once; a remove without an add before it changes nothing."""
    daily = (entries.where("key is not null and category is not null and day is not null "
                           "and action in ('add', 'remove')")
             .groupBy("key", "category", F.col("day").cast("date").alias("day"))
             .agg(F.max(F.col("action") == "remove").alias("removed")))
    w = Window.partitionBy("key", "category").orderBy("day")
    turned = daily.withColumn("before", F.lag("removed").over(w)).where("before is null or before <> removed")
    return (turned.withColumn("until", F.coalesce(F.lead("day").over(w), F.lit(FOREVER).cast("date")))
            .where("not removed").select("key", "category", F.col("day").alias("since"), "until"))


def active_entries(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """One row per row of ``captures(page_id, url, fetch_day)``: ``page_id, host, fetch_day,
    n_active, categories`` (distinct, sorted, comma-joined), ``active_since`` (earliest),
    ``blocked``.

    A capture without a url, host or day has no active entry. Repeated rows are judged
    each. A capture has a key per label, per path prefix as deep as any entry of the list, and one
    for the whole, so a URL of very many segments makes no more keys than the list can match. The
    join is on the key with the day as a further condition: a key has few intervals however many
    captures it has, and a hot host's captures can be split by the adaptive skew join; the intervals
    are broadcast when their measured count is small. Empty tables give no rows or no active
    entries. Other columns are not read, whatever their names."""
    rows = cut_lineage(captures.select(
        F.monotonically_increasing_id().alias("row"), "page_id", F.col("fetch_day").cast("date").alias("fetch_day"),
        "url", host_of(F.col("url")).alias("host")))
    turns = cut_lineage(to_intervals(entries))
    deepest = turns.agg(F.max(F.size(F.split(F.regexp_replace("key", r"\?.*", ""), "/")) - 1)).first()[0] or 0
    keys = keys_of(F.col("url"), int(deepest))
    intervals = bounded_broadcast(turns)
    hits = (rows.where("host <> ''").select("row", "fetch_day", F.explode(keys).alias("key"))
            .join(intervals, "key").where("since <= fetch_day and fetch_day < until")
            .groupBy("row").agg(F.count("*").alias("n_active"),
                                F.array_join(F.array_sort(F.collect_set("category")), ",").alias("categories"),
                                F.min("since").alias("active_since")))
    return (rows.join(hits, "row", "left")
            .select("page_id", "host", "fetch_day", F.coalesce("n_active", F.lit(0)).cast("long").alias("n_active"),
                    F.coalesce("categories", F.lit("")).alias("categories"), "active_since",
                    F.col("n_active").isNotNull().alias("blocked")))


def captures_of(pages: DataFrame) -> DataFrame:
    """The pages as captures; the tables hold no fetch time, so the id gives the day."""
    return pages.select("page_id", "url", F.expr("date_add(date'2024-01-01', cast(page_id % 365 as int))").alias("fetch_day"))


def _number(text: Column, seed: str, modulo: int) -> Column:
    return F.conv(F.substring(F.md5(F.concat(F.lit(seed), text)), 1, 6), 16, 10).cast("int") % modulo


def entries_of(pages: DataFrame) -> DataFrame:
    """Dated entries for hosts, their parents, path prefixes and whole URLs of the pages: each key
    picked by its md5 is added on some day, removed later and, for some, added again."""
    keys = (pages.where(host_of(F.col("url")) != "").select(F.explode(keys_of(F.col("url"), LISTED_DEPTH)).alias("key"))
            .distinct())
    k = F.col("key")
    picked = keys.where(_number(k, "pick", 3) == 0)
    category = F.element_at(F.array(*[F.lit(c) for c in ("ads", "adult", "malware")]), _number(k, "cat", 3) + 1)
    day0 = _number(k, "day", 300)
    day1 = day0 + 20 + _number(k, "len", 60)
    event = lambda d, a: F.struct(F.date_add(F.lit("2024-01-01").cast("date"), d).alias("day"), F.lit(a).alias("action"))
    events = F.array(event(day0, "add"), event(day0 + 5, "add"), event(day1, "remove"), event(day1 + 30, "add"))
    return (picked.select("key", category.alias("category"), F.explode(events).alias("e"),
                          (_number(k, "again", 2) == 0).alias("again"), day1.alias("d1"))
            .where(F.col("again") | (F.col("e.day") <= F.date_add(F.lit("2024-01-01").cast("date"), F.col("d1"))))
            .select("key", "category", "e.day", "e.action"))


URL_SQL = r"""
WITH u AS (SELECT page_id, DATE '2024-01-01' + (page_id % 365)::INT AS fetch_day,
  regexp_extract(coalesce(url, ''),
    '^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)(?::[0-9]*)?(/[^?#]*)?(\?[^#]*)?', ['h', 'p', 'q']) AS m FROM pages),
x AS (SELECT row_number() OVER () AS rn, page_id, fetch_day, lower(m.h) AS host, string_split(lower(m.h), '.') AS labels,
  list_filter(string_split(m.p, '/'), lambda s: s <> '') AS segments, lower(m.h) || m.p || m.q AS whole FROM u),
k AS (SELECT DISTINCT rn, fetch_day, unnest(list_concat(
    list_transform(range(1, len(labels) + 1), lambda i: array_to_string(labels[i:], '.')),
    list_transform(range(1, len(segments) + 1), lambda i: host || '/' || array_to_string(segments[1:i], '/')),
    [whole])) AS key FROM x WHERE host <> ''),
keys AS (SELECT DISTINCT unnest(list_concat(
    list_transform(range(1, len(labels) + 1), lambda i: array_to_string(labels[i:], '.')),
    list_transform(range(1, least(len(segments), 3) + 1), lambda i: host || '/' || array_to_string(segments[1:i], '/')),
    [whole])) AS key FROM x WHERE host <> ''),
n AS (SELECT key, ('0x' || substr(md5('pick' || key), 1, 6))::INT % 3 AS pick, ('0x' || substr(md5('cat' || key), 1, 6))::INT % 3 AS cat,
  ('0x' || substr(md5('day' || key), 1, 6))::INT % 300 AS d0, ('0x' || substr(md5('len' || key), 1, 6))::INT % 60 AS dl,
  ('0x' || substr(md5('again' || key), 1, 6))::INT % 2 AS again FROM keys),
iv AS (SELECT key, ['ads', 'adult', 'malware'][cat + 1] AS category, d0 AS a, d0 + 20 + dl AS b FROM n WHERE pick = 0
  UNION ALL SELECT key, ['ads', 'adult', 'malware'][cat + 1], d0 + 50 + dl, 1000000 FROM n WHERE pick = 0 AND again = 0),
hit AS (SELECT rn, count(*) AS n_active, string_agg(DISTINCT category, ',' ORDER BY category) AS categories,
  min(DATE '2024-01-01' + a::INT) AS active_since
  FROM k JOIN iv USING (key) WHERE fetch_day - DATE '2024-01-01' >= a AND fetch_day - DATE '2024-01-01' < b GROUP BY rn)
SELECT page_id, host, fetch_day, coalesce(n_active, 0) AS n_active, coalesce(categories, '') AS categories,
  active_since, n_active IS NOT NULL AS blocked FROM x LEFT JOIN hit USING (rn)
"""
