"""Quality rules with cross-document line frequency, in DataFrame functions only.

Words are runs of characters other than space and U+0009..U+000D; everything is computed
on whole texts. Base rule: fewer than ``MIN_WORDS`` words, or more than
``MAX_REPEAT_PERCENT`` percent of the words in five-word windows that occur twice or more.

Line rule: lines are normalised (lower case, blank runs to one space, trimmed) and hashed;
for each host (``source``) the distinct documents holding a line are counted, documents of
equal text once. A line is over the limit when more than ``MIN_LINE_DOCS`` documents and
more than ``MAX_LINE_PERCENT`` percent of the host's distinct documents hold it. Such lines
are removed from every document but the first that holds them (smallest doc_id of the
host's distinct texts), so a passage that floods a host survives once. A document that
loses more than ``MAX_LOST_PERCENT`` percent of its words is depleted and rejected.
``quality_rules`` gives the counts and verdicts, ``keep_good`` the passing rows with the
lines taken out of their text.

Counts travel as (host, line hash, document) rows: one per distinct line of a distinct
text, counted by an aggregate that combines before its shuffle, so neither a hot host nor
a hot line is gathered in one task. The over-limit lines number at most
100 / MAX_LINE_PERCENT x the lines per document of a host; they are broadcast when their
measured count is within the session's bound, else joined by shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import BROADCAST_MAX_ROWS, bounded_broadcast, cut_lineage

MIN_WORDS = 10
WINDOW = 5
MAX_REPEAT_PERCENT = 20
MIN_LINE_DOCS = 20
MAX_LINE_PERCENT = 10
MAX_LOST_PERCENT = 70

BLANK = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, BLANK), "")


def _has_word(line: Column) -> Column:
    return F.length(F.translate(line, " \t\x0b\x0c\r\n", "")) > 0


def lines(text: Column) -> Column:
    """The \\n-split lines that hold a word."""
    return F.filter(F.split(text, "\n"), _has_word)


def normalised(line: Column) -> Column:
    return F.trim(F.lower(F.regexp_replace(line, BLANK, " ")))


def _window_hashes(w: Column) -> Column:
    n = F.size(w) - (WINDOW - 1)
    return F.when(n > 0, F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(WINDOW)]))).otherwise(
        F.array().cast("array<bigint>"))


def _covered(hashes: Column) -> Column:
    """Words in windows whose hash occurs twice or more: windows sorted by hash, those
    equal to a neighbour kept, their places sorted, and the gaps between them cut at the
    window's length."""
    pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    # array_sort orders structs by their fields; equal hashes end up side by side.
    places = _let(pairs, lambda p: F.sort_array(F.transform(
        F.filter(p, lambda x, k: (F.get(p, k - 1)["h"] == x["h"]) | (F.get(p, k + 1)["h"] == x["h"])),
        lambda x: x["i"])))
    return _let(places, lambda s: F.aggregate(
        F.transform(s, lambda x, k: F.coalesce(F.least(F.get(s, k + 1) - x, F.lit(WINDOW)),
                                               F.lit(WINDOW))),
        F.lit(0).cast("int"), lambda a, x: a + x))


def repeated_words(w: Column) -> Column:
    """Words in five-word windows found twice or more, the first included."""
    return _let(_window_hashes(w), lambda h: F.when(
        F.size(F.array_distinct(h)) < F.size(h), _covered(h)).otherwise(F.lit(0)))


def word_stats(docs: DataFrame) -> DataFrame:
    """``docs`` columns ``doc_id, source, text`` to counts per row; null text has none."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    ls = lines(text)
    return docs.select(
        F.col("doc_id"), F.col("source"), F.xxhash64(text, F.length(text)).alias("text_hash"),
        _let(words(text), lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            repeated_words(w).cast("long").alias("n_repeat_words"))).alias("by_words"),
        F.length(F.regexp_replace(text, BLANK, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        _let(ls, lambda x: F.struct(
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            F.transform(x, lambda l: F.struct(
                F.xxhash64(normalised(l)).alias("line"),
                F.size(words(l)).alias("n"))).alias("lines"))).alias("by_lines"),
    ).select("doc_id", "source", "text_hash", "by_words.*", "word_chars", "n_symbols", "by_lines.*")


def _host() -> Column:
    return F.coalesce(F.col("source"), F.lit("\0"))


# Does this row lose the line? Its first holder does not; among rows without an id that is
# the text of the smallest hash.
LOSES = "not (doc_id <=> first_doc and (doc_id is not null or text_hash = first_text))"


def _judged(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The verdicts of ``quality_rules`` and the over-limit lines
    ``(host, line, first_doc, first_text)``."""
    s = cut_lineage(word_stats(docs.select("doc_id", "source", "text"))
                    .withColumn("row", F.monotonically_increasing_id()))
    s = s.withColumn("host", _host())
    # Distinct texts of a host, each by its first row.
    first = (s.groupBy("host", "text_hash").agg(F.min(F.struct("doc_id", "row")).alias("f"))
             .select("host", "text_hash", F.col("f.row").alias("row"), F.col("f.doc_id").alias("doc_id")))
    hosts = first.groupBy("host").agg(F.count("*").alias("host_docs"))
    held = (s.join(first.select("row"), "row", "left_semi")
            .select("host", "doc_id", "text_hash", F.explode(F.array_distinct("lines.line")).alias("line")))
    over = (held.groupBy("host", "line").agg(F.count("*").alias("n_docs"), F.min("doc_id").alias("first_doc"),
                                             F.min("text_hash").alias("first_text"))
            .where(F.col("n_docs") > MIN_LINE_DOCS)
            .join(F.broadcast(hosts) if hosts.limit(10_001).count() <= 10_000 else hosts, "host")
            .where(F.expr(f"100 * n_docs > {MAX_LINE_PERCENT} * host_docs"))
            .select("host", "line", "first_doc", "first_text"))
    over = cut_lineage(over)
    hit = (s.select("row", "host", "doc_id", "text_hash", F.explode("lines").alias("l"))
           .select("row", "host", "doc_id", "text_hash", "l.line", "l.n")
           .join(bounded_broadcast(over), ["host", "line"]).where(LOSES))
    lost = hit.groupBy("row").agg(F.sum("n").cast("long").alias("lost_words"))
    out = s.join(lost, "row", "left").withColumn("lost_words", F.coalesce("lost_words", F.lit(0)))
    base_failed = F.expr(f"n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words")
    return (out.withColumn("base_failed", base_failed)
            .withColumn("kept", F.expr(
                f"not base_failed and 100 * lost_words <= {MAX_LOST_PERCENT} * n_words"))
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "lost_words", "base_failed", "kept", "row", "text_hash", "host")), over


def quality_rules(docs: DataFrame) -> DataFrame:
    """One row per input row: ``doc_id``, the counts, ``lost_words``, ``base_failed``,
    ``kept``. Rows with null ``source`` form one host; null ids and repeated ids stay rows
    of their own (texts are matched by content, so repeated rows share the verdict unless
    one of them is the first holder of a line). Empty tables give no rows; columns beyond
    ``doc_id, text, source`` are not read."""
    return _judged(docs)[0].drop("host")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns and the text without its
    over-limit lines; ``n_chars``, if there, is that text's. Other lines, blank ones
    included, stay as they are. Rejected rows are matched by id, host and content, so
    repeated ids are told apart by their texts.

    The over-limit lines go to the rows as one array per host: at most
    100 / MAX_LINE_PERCENT x the lines per document of that host."""
    judged, over = _judged(docs)
    bad = cut_lineage(judged.where("not kept").select(
        F.col("doc_id").alias("rejected__id"), F.col("text_hash").alias("rejected__hash"),
        F.col("host").alias("rejected__host")).distinct())
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    text_hash = F.xxhash64(text, F.length(text))
    same = (F.col("doc_id").eqNullSafe(F.col("rejected__id")) & (text_hash == F.col("rejected__hash"))
            & (_host() == F.col("rejected__host")))
    good = docs.join(bounded_broadcast(bad), same, "left_anti")

    by_host = F.collect_list(F.struct("line", "first_doc", "first_text"))
    if over.limit(BROADCAST_MAX_ROWS + 1).count() <= BROADCAST_MAX_ROWS:
        of_host = F.broadcast(over.groupBy("host").agg(by_host.alias("over__lines")))
    else:
        of_host = over.groupBy("host").agg(by_host.alias("over__lines"))
    good = good.join(of_host.withColumnRenamed("host", "over__host"), _host() == F.col("over__host"), "left")
    own = lambda x: F.col("doc_id").eqNullSafe(x["first_doc"]) & (
        F.col("doc_id").isNotNull() | (text_hash == x["first_text"]))
    hashes = F.transform(F.split(text, "\n"), lambda l: F.xxhash64(normalised(l)))
    gone = F.array_intersect(hashes, F.col("over__lines.line"))
    gone = _let(gone, lambda g: F.when(F.size(g) > 0, F.array_except(g, F.transform(
        F.filter("over__lines", own), lambda x: x["line"]))).otherwise(g))
    left = _let(gone, lambda g: F.when(F.size(g) > 0, F.array_join(F.filter(
        F.split(text, "\n"), lambda l: ~F.array_contains(g, F.xxhash64(normalised(l)))), "\n")))
    good = good.withColumn("text__left", F.when(F.col("over__lines").isNotNull(), left))
    changed = {"text": F.col("text__left"), "n_chars": F.length("text__left")}
    return good.select([F.when(F.col("text__left").isNotNull(), changed[c].cast(kind)).otherwise(F.col(c)).alias(c)
                        if c in changed else F.col(c) for c, kind in docs.dtypes])


QUALITY_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, chr(0)) AS host, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, host, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
  list_filter(string_split(t, chr(10)),
              lambda x: length(regexp_replace(x, '[\x20\x09-\x0D]+', '', 'g')) > 0) AS ls FROM d),
win AS (SELECT doc_id, i, list_slice(ws, i, i + 4) AS g
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)),
rep AS (SELECT doc_id, g FROM win GROUP BY doc_id, g HAVING count(*) > 1),
pos AS (SELECT win.doc_id, count(DISTINCT i + j) AS n FROM win JOIN rep USING (doc_id, g),
        (SELECT unnest(range(0, 5)) AS j) GROUP BY win.doc_id),
hosts AS (SELECT host, count(DISTINCT t) AS host_docs FROM d GROUP BY host),
first_rows AS (SELECT host, t, min(doc_id) AS doc_id FROM d GROUP BY host, t),
norm AS (SELECT doc_id, host, unnest(ls) AS raw FROM w),
normed AS (SELECT doc_id, host, trim(lower(regexp_replace(raw, '[\x20\x09-\x0D]+', ' ', 'g')), ' ') AS line,
  len(list_filter(regexp_split_to_array(raw, '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS n FROM norm),
held AS (SELECT DISTINCT doc_id, host, line FROM normed WHERE (host, doc_id) IN (SELECT host, doc_id FROM first_rows)),
over_limit AS (SELECT host, line, min(doc_id) AS first_doc FROM held JOIN hosts USING (host)
  GROUP BY host, line, host_docs HAVING count(*) > 20 AND 100 * count(*) > 10 * host_docs),
lost AS (SELECT normed.doc_id, sum(n) AS lost FROM normed JOIN over_limit USING (host, line)
  WHERE normed.doc_id <> first_doc GROUP BY normed.doc_id),
f AS (SELECT doc_id, len(ws)::BIGINT AS n_words,
  length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
  length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
  (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
  coalesce(pos.n, 0)::BIGINT AS n_repeat_words, coalesce(lost, 0)::BIGINT AS lost_words
  FROM w LEFT JOIN pos USING (doc_id) LEFT JOIN lost USING (doc_id))
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND 100 * lost_words <= 70 * n_words AS kept
FROM f
"""
