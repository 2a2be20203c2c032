"""Text queries over the documents adapter: tokens, bigrams, themes, evidence,
redaction and prompts."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..config import DEFAULTS
from ..functions import text as X
from ..operators import sliding as SL
from ..operators import themes as TH
from ..session import checkpoint_path, cut_lineage
from ..sources.adapters import narrative_complaints
from ..sources.buckets import drop_table
from .registry import register

# ---------------------------------------------------------------- DuckDB mirrors
DOCS_CTE = """
d AS (
  SELECT doc_id AS complaint_id,
         CAST(DATE '2024-01-01' + CAST(doc_id % 35 AS INTEGER) AS TIMESTAMP) AS date_received,
         lang AS product, source AS issue, source AS company, text AS consumer_complaint_narrative
  FROM documents)"""

_SW = "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in X.STOP_WORDS) + "]"


def sql_tokens(t: str) -> str:
    return f"regexp_extract_all(lower({t}), '[\\p{{L}}\\p{{N}}_]{{2,}}')"


def sql_content(t: str) -> str:
    return f"list_filter({sql_tokens(t)}, lambda x: NOT list_contains({_SW}, x))"


def sql_pairs(lst: str) -> str:
    return f"list_transform(range(1, len({lst})), lambda i: {lst}[i] || ' ' || {lst}[i + 1])"


def sql_redact(t: str, n: int | None) -> str:
    # Written out here, not taken from the package. No look-around: the characters beside
    # a number are captured, so a second pass finds numbers one character apart.
    w = r"\p{L}\p{M}\p{N}_"
    r = f"regexp_replace({t}, '[{w}][{w}.+-]*@[{w}-]+\\.[{w}.-]*[{w}]', '[EMAIL REMOVED]', 'g')"
    number = rf"(^|[^{w}])\p{{Nd}}[\p{{Nd}}\p{{Z}}\t\n\x0B\f\r().-]{{7,}}\p{{Nd}}($|[^{w}])"
    for _ in range(2):
        r = f"regexp_replace({r}, '{number}', '\\1[NUMBER REMOVED]\\2', 'g')"
    return f"substring({r}, 1, {n})" if n else r


def sql_dec2(x: str) -> str:
    return f"CAST(CAST({x} AS DECIMAL(38,2)) AS VARCHAR)"


BIGRAMS_CTE = f"""
bg AS (SELECT *, {sql_pairs('ct')} AS bigrams
       FROM (SELECT *, {sql_content('consumer_complaint_narrative')} AS ct FROM d
             WHERE consumer_complaint_narrative IS NOT NULL) x)"""

WINDOWS_CTE = """
anchor AS (SELECT CAST(date_trunc('day', max(date_received)) AS DATE) AS recent_end
           FROM d WHERE consumer_complaint_narrative IS NOT NULL),
w AS (SELECT recent_end - 6 AS recent_start, recent_end, recent_end - 34 AS baseline_start,
             recent_end - 7 AS baseline_end FROM anchor)"""

LABEL_CTE = """
lab AS (SELECT bg.*, CASE WHEN date_received >= CAST(w.recent_start AS TIMESTAMP)
                          THEN 'recent' ELSE 'baseline' END AS period
        FROM bg, w
        WHERE date_received BETWEEN CAST(w.baseline_start AS TIMESTAMP) AND CAST(w.recent_end AS TIMESTAMP)),
tot AS (SELECT product, count(*) FILTER (WHERE period = 'recent') AS recent_total,
               count(*) FILTER (WHERE period = 'baseline') AS baseline_total
        FROM lab GROUP BY product
        HAVING count(*) FILTER (WHERE period = 'recent') > 0
           AND count(*) FILTER (WHERE period = 'baseline') > 0)"""

THEMES_BODY = f"""
terms AS (SELECT product, period, unnest(list_distinct(bigrams)) AS term FROM lab),
cnt AS (SELECT product, term, count(*) AS doc_freq,
               count(*) FILTER (WHERE period = 'recent') AS recent_mentions,
               count(*) FILTER (WHERE period = 'baseline') AS baseline_mentions
        FROM terms GROUP BY 1, 2 HAVING count(*) >= 3),
voc AS (SELECT * FROM cnt
        QUALIFY row_number() OVER (PARTITION BY product ORDER BY doc_freq DESC, term) <= 15000),
sc AS (SELECT product, term, recent_mentions, baseline_mentions,
              CAST(recent_mentions AS DOUBLE) / CAST(recent_total AS DOUBLE) AS rr,
              CAST(baseline_mentions AS DOUBLE) / CAST(baseline_total AS DOUBLE) AS br
       FROM voc JOIN tot USING (product)),
sc2 AS (SELECT product, term, recent_mentions, baseline_mentions, rr * 100.0 AS recent_rate_percent,
               br * 100.0 AS baseline_rate_percent,
               CASE WHEN br > 0 THEN (rr - br) * 100.0 / br END AS growth_rate_percent,
               (rr - br) * 100.0 AS emergence_score
        FROM sc
        WHERE recent_mentions >= 3 AND NOT regexp_matches(term, '(?i)(^| )x{{2,}}( |$)|\\p{{Nd}}')),
top AS (SELECT *, CAST(row_number() OVER (PARTITION BY product ORDER BY emergence_score DESC, term)
                       AS INTEGER) AS theme_rank
        FROM sc2 QUALIFY theme_rank <= 30),
themes AS (
  SELECT product, term, recent_mentions, baseline_mentions,
         round_even(recent_rate_percent, 2) AS recent_rate_percent,
         round_even(baseline_rate_percent, 2) AS baseline_rate_percent,
         round_even(growth_rate_percent, 2) AS growth_rate_percent,
         round_even(emergence_score, 2) AS emergence_score, theme_rank,
         recent_start, recent_end, baseline_start, baseline_end
  FROM top, w)"""

THEMES_WITH = f"WITH {DOCS_CTE},{BIGRAMS_CTE},{WINDOWS_CTE},{LABEL_CTE},{THEMES_BODY}"

TOP3_CTE = """
top3 AS (SELECT *, CAST(row_number() OVER (PARTITION BY product ORDER BY emergence_score DESC, term)
                        AS INTEGER) AS selection_rank
         FROM themes QUALIFY selection_rank <= 3)"""

EVIDENCE_CTE = f"""
cand AS (SELECT complaint_id, product, issue, date_received, consumer_complaint_narrative,
                unnest(list_distinct(bigrams)) AS term_key FROM bg),
ev AS (SELECT t.product, t.term, c.complaint_id, c.issue, c.date_received,
              {sql_redact('c.consumer_complaint_narrative', 1500)} AS redacted_narrative
       FROM cand c JOIN top3 t ON c.product = t.product AND c.term_key = lower(t.term)
       WHERE c.date_received >= CAST(t.recent_start AS TIMESTAMP)
         AND c.date_received < CAST(t.recent_end + 1 AS TIMESTAMP)),
evidence AS (SELECT product, term,
                    CAST(row_number() OVER (PARTITION BY product, term
                                            ORDER BY date_received, complaint_id) AS INTEGER) AS evidence_rank,
                    complaint_id, issue, redacted_narrative
             FROM ev QUALIFY evidence_rank <= 5)"""


# ---------------------------------------------------------------- Spark side
def docs(spark, sf):
    return narrative_complaints(spark, sf)


@register("tokens", f"""
WITH {DOCS_CTE}
SELECT complaint_id, len({sql_tokens('consumer_complaint_narrative')}) AS n_tokens,
       len({sql_content('consumer_complaint_narrative')}) AS n_content_tokens,
       sha256(array_to_string({sql_content('consumer_complaint_narrative')}, ' ')) AS content_hash
FROM d WHERE consumer_complaint_narrative IS NOT NULL""")
def q_tokens(spark, sf):
    d = docs(spark, sf).where(F.col("consumer_complaint_narrative").isNotNull())
    d = (d.withColumn("_t", X.tokens("consumer_complaint_narrative"))
         .withColumn("_ct", X.drop_stop_words(F.col("_t"))))
    t, ct = F.col("_t"), F.col("_ct")
    return d.select("complaint_id", F.size(t).cast("bigint").alias("n_tokens"),
                    F.size(ct).cast("bigint").alias("n_content_tokens"),
                    F.sha2(F.array_join(ct, " "), 256).alias("content_hash"))


@register("bigrams", f"""
WITH {DOCS_CTE},{BIGRAMS_CTE}
SELECT complaint_id, len(bigrams) AS n_bigrams, len(list_distinct(bigrams)) AS n_distinct_bigrams,
       sha256(array_to_string(bigrams, '|')) AS bigram_hash FROM bg""")
def q_bigrams(spark, sf):
    d = docs(spark, sf).where(F.col("consumer_complaint_narrative").isNotNull())
    d = X.with_terms(d, "consumer_complaint_narrative", "_bg")
    b = F.col("_bg")
    return d.select("complaint_id", F.size(b).cast("bigint").alias("n_bigrams"),
                    F.size(F.array_distinct(b)).cast("bigint").alias("n_distinct_bigrams"),
                    F.sha2(F.array_join(b, "|"), 256).alias("bigram_hash"))


@register("theme_windows", f"WITH {DOCS_CTE},{WINDOWS_CTE}\nSELECT * FROM w")
def q_theme_windows(spark, sf):
    return TH.theme_windows(docs(spark, sf))


@register("theme_totals", f"WITH {DOCS_CTE},{BIGRAMS_CTE},{WINDOWS_CTE},{LABEL_CTE}\nSELECT * FROM tot")
def q_theme_totals(spark, sf):
    return TH.theme_totals(TH.labelled_narratives(docs(spark, sf)))


@register("term_document_counts", f"""
WITH {DOCS_CTE},{BIGRAMS_CTE},{WINDOWS_CTE},{LABEL_CTE},
terms AS (SELECT product, period, unnest(list_distinct(bigrams)) AS term FROM lab)
SELECT product, term, count(*) AS doc_freq, count(*) FILTER (WHERE period = 'recent') AS recent_mentions,
       count(*) FILTER (WHERE period = 'baseline') AS baseline_mentions
FROM terms GROUP BY 1, 2""")
def q_term_counts(spark, sf):
    return TH.term_document_counts(TH.labelled_narratives(docs(spark, sf)))


@register("emerging_themes", f"{THEMES_WITH}\nSELECT * FROM themes")
def q_themes(spark, sf):
    return TH.emerging_themes(docs(spark, sf))


@register("top_themes", f"{THEMES_WITH},{TOP3_CTE}\nSELECT * FROM top3")
def q_top_themes(spark, sf):
    return TH.top_themes(TH.emerging_themes(docs(spark, sf)))


def _evidence(spark, sf):
    d = docs(spark, sf)
    # A few rows per product, read by the evidence lookup and again downstream.
    selected = cut_lineage(TH.top_themes(TH.emerging_themes(d)))
    return d, selected, TH.theme_evidence(d, selected)


@register("theme_evidence", f"{THEMES_WITH},{TOP3_CTE},{EVIDENCE_CTE}\nSELECT * FROM evidence")
def q_evidence(spark, sf):
    return _evidence(spark, sf)[2]


@register("themes_without_evidence", f"""{THEMES_WITH},{TOP3_CTE},{EVIDENCE_CTE}
SELECT * FROM top3 t WHERE NOT EXISTS (
  SELECT 1 FROM evidence e WHERE e.product = t.product AND e.term = t.term)""")
def q_no_evidence(spark, sf):
    _, selected, ev = _evidence(spark, sf)
    return TH.themes_without_evidence(selected, ev)


_NL = "chr(10)"


@register("theme_prompts", f"""{THEMES_WITH},{TOP3_CTE},{EVIDENCE_CTE},
per AS (SELECT product, term, count(*) AS supporting_records,
               string_agg(CAST(complaint_id AS VARCHAR), ';' ORDER BY evidence_rank) AS supplied_ids,
               string_agg('Complaint ' || CAST(complaint_id AS VARCHAR) || ' | issue: '
                          || coalesce(issue, 'Unknown') || {_NL} || redacted_narrative,
                          {_NL} || {_NL} ORDER BY evidence_rank) AS body
        FROM evidence GROUP BY 1, 2)
SELECT t.product, t.term, p.supporting_records, p.supplied_ids,
       '{TH.PROMPT_HEAD}' || {_NL} || 'Product: ' || t.product || {_NL} || 'Term: ' || t.term
       || {_NL} || 'Recent mentions: ' || CAST(t.recent_mentions AS VARCHAR)
       || {_NL} || 'Baseline mentions: ' || CAST(t.baseline_mentions AS VARCHAR)
       || {_NL} || 'Growth %: ' || coalesce({sql_dec2('t.growth_rate_percent')}, 'n/a')
       || {_NL} || 'Emergence score: ' || {sql_dec2('t.emergence_score')}
       || {_NL} || {_NL} || 'Records:' || {_NL} || p.body AS prompt
FROM top3 t JOIN per p USING (product, term)""")
def q_prompts(spark, sf):
    _, selected, ev = _evidence(spark, sf)
    return TH.theme_prompts(selected, ev)


@register("redact_pii", f"""
WITH {DOCS_CTE}
SELECT complaint_id, {sql_redact('consumer_complaint_narrative', DEFAULTS.theme_text_chars)} AS redacted_text,
       length({sql_redact('consumer_complaint_narrative', None)}) AS redacted_chars,
       md5({sql_redact('consumer_complaint_narrative', None)}) AS redacted_md5
FROM d WHERE consumer_complaint_narrative IS NOT NULL""")
def q_redact(spark, sf):
    d = docs(spark, sf).where(F.col("consumer_complaint_narrative").isNotNull())
    return d.select("complaint_id",
                    X.redact("consumer_complaint_narrative", DEFAULTS.theme_text_chars)
                    .alias("redacted_text"),
                    F.length(X.redact("consumer_complaint_narrative")).cast("bigint")
                    .alias("redacted_chars"),
                    F.md5(X.redact("consumer_complaint_narrative")).alias("redacted_md5"))


@register("first_narrative_prompt", f"""
WITH {DOCS_CTE},
f AS (SELECT * FROM d WHERE consumer_complaint_narrative IS NOT NULL
      ORDER BY date_received, complaint_id LIMIT 1)
SELECT complaint_id, product, issue AS recorded_issue,
       'Summarise this single complaint for a customer-risk analyst. Use only the text below and flag unclear or sensitive cases for review.'
       || {_NL} || 'Product: ' || coalesce(product, 'Unknown')
       || {_NL} || 'Recorded issue: ' || coalesce(issue, 'Unknown')
       || {_NL} || 'Narrative:' || {_NL} || {sql_redact('consumer_complaint_narrative', DEFAULTS.single_text_chars)} AS prompt
FROM f""")
def q_first_prompt(spark, sf):
    return TH.first_narrative_prompt(docs(spark, sf))


SELECTED_PRODUCTS = ["en", "de"]


@register("emerging_themes_selected", THEMES_WITH.replace(
    "WHERE date_received BETWEEN",
    "WHERE product IN ('en', 'de') AND date_received BETWEEN") + "\nSELECT * FROM themes")
def q_themes_selected(spark, sf):
    """The fixed product list of a run (the anchor day still uses every narrative)."""
    return TH.emerging_themes(docs(spark, sf), products=SELECTED_PRODUCTS)


@register("emerging_themes_sliding", f"{THEMES_WITH}\nSELECT * FROM themes")
def q_themes_sliding(spark, sf):
    """E11-E13 from stored daily counts: the history in one load, then three loads of a day, the
    window moved by each. The tables lie in the shared folder while the themes are made."""
    root = checkpoint_path(spark, f"sliding-{uuid.uuid4().hex}")
    d = docs(spark, sf)
    try:
        themes = SL.replay(spark, root, d, last_days=3)
        return themes if themes is not None else TH.emerging_themes(d)
    finally:
        drop_table(spark, root)
