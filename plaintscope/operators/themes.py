"""Emerging bigram themes, evidence lookup and prompts (E11-E13, T5-T8, D3, D6, D7,
F10, G4, G5, G8, S8, S10-S13, S20, E18).

Plan shape at scale: narratives are filtered to the analysis window first (the
date predicate reaches the scan), each narrative becomes its list of words, and
``term_counts.count_terms`` counts the distinct bigrams of blocks of narratives, deals what it
found by bucket of the term and adds it up there. A hot product does not concentrate work because
the bucket follows from the term. Top-k per
product is ``row_number() <= k``, which Spark plans as a WindowGroupLimit, so each
map task keeps at most k rows per product before the exchange. Totals per product
are a tiny aggregate joined on product (AQE broadcasts it after measuring it).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULTS, Thresholds
from ..functions.scalar import dec2_text
from ..functions.text import content_tokens, explode_terms, is_noise_term, redact, with_terms
from ..session import bounded_broadcast, cut_lineage
from .term_counts import count_terms
from .topk import top_k_by_count


def theme_windows(complaints: DataFrame, th: Thresholds = DEFAULTS) -> DataFrame:
    """E13 + S5/S6: anchor = day of the latest narrative; recent and baseline windows."""
    anchor = (complaints.where(F.col("consumer_complaint_narrative").isNotNull())
              .agg(F.date_trunc("day", F.max("date_received")).cast("date").alias("recent_end")))
    return anchor.select(
        F.date_sub("recent_end", th.recent_days - 1).alias("recent_start"),
        "recent_end",
        F.date_sub("recent_end", th.recent_days + th.baseline_days - 1).alias("baseline_start"),
        F.date_sub("recent_end", th.recent_days).alias("baseline_end"))


def anchor_day(complaints: DataFrame):
    """Day of the latest narrative, or None when there is none.

    One scalar aggregate (partial max per task, a single row to the driver).
    It is run once per query and its value is used as a literal: every window
    bound below then reaches the scan as a plain comparison (row-group and
    partition pruning on a date-laid-out table), and the narratives are not
    rescanned by a scalar subquery at each use of a bound (Spark plans every
    use as its own subquery and does not reuse them)."""
    row = (complaints.where(F.col("consumer_complaint_narrative").isNotNull())
           .agg(F.date_trunc("day", F.max("date_received")).cast("date").alias("d"))
           .first())
    return row["d"] if row else None


# Partition column of the month layout the batch run writes (``yyyy-MM``).
MONTH = "received_month"


def month_of(time) -> Column:
    return F.date_format(time, "yyyy-MM")


# The day E13 looks for the latest of, as the bucketed table's manifest keeps it.
NARRATIVE_DAY = "narrative_day"


def narrative_day() -> Column:
    return F.when(F.col("consumer_complaint_narrative").isNotNull(), F.to_date("date_received"))


def window_bounds(anchor, th: Thresholds = DEFAULTS) -> dict[str, Column]:
    """Recent and baseline window dates from the anchor day (NULL when None)."""
    end = F.lit(anchor).cast("date")
    return {"recent_start": F.date_sub(end, th.recent_days - 1), "recent_end": end,
            "baseline_start": F.date_sub(end, th.recent_days + th.baseline_days - 1),
            "baseline_end": F.date_sub(end, th.recent_days)}


def labelled_narratives(complaints: DataFrame, th: Thresholds = DEFAULTS,
                        products: list[str] | None = None,
                        ws: dict[str, Column] | None = None) -> DataFrame:
    """Narratives of the analysed products inside [baseline_start, recent_end]
    (upper bound at midnight of the last day), labelled recent / baseline."""
    ws = ws if ws is not None else window_bounds(anchor_day(complaints), th)
    ts = F.col("date_received")
    lo = ws["baseline_start"].cast("timestamp_ntz")
    hi = ws["recent_end"].cast("timestamp_ntz")
    df = complaints.where(F.col("consumer_complaint_narrative").isNotNull() & ts.between(lo, hi))
    if MONTH in complaints.columns:  # the month layout: its folders outside the window are not listed as input
        df = df.where(F.col(MONTH).between(month_of(lo), month_of(hi)))
    if products is not None:
        df = df.where(F.col("product").isin(*products))
    return df.withColumn(
        "period", F.when(ts >= ws["recent_start"].cast("timestamp_ntz"), F.lit("recent"))
        .otherwise(F.lit("baseline")))


def theme_totals(labelled: DataFrame) -> DataFrame:
    """Narratives per product and period; products with an empty period are dropped."""
    return (labelled.groupBy("product")
            .agg(F.count_if(F.col("period") == "recent").alias("recent_total"),
                 F.count_if(F.col("period") == "baseline").alias("baseline_total"))
            .where((F.col("recent_total") > 0) & (F.col("baseline_total") > 0)))


# Marker term counted once per document: no bigram is empty, so the aggregate row
# for "" is the document count per product and period.
DOC_MARKER = ""


def _by_term(rows: DataFrame, term) -> DataFrame:
    return (rows.groupBy("product", term)
            .agg(F.count(F.lit(1)).alias("doc_freq"),
                 F.count_if(F.col("period") == "recent").alias("recent_mentions"),
                 F.count_if(F.col("period") == "baseline").alias("baseline_mentions")))


def term_document_counts(labelled: DataFrame, with_doc_marker: bool = False, at_least: int = 1) -> DataFrame:
    """E12 + T5: documents containing each bigram that ``at_least`` documents of the product contain, split
    by period (binary presence)."""
    period = {name: F.coalesce(F.col("period") == name.split("_")[0], F.lit(False)).cast("long").alias(name)
              for name in ("recent_mentions", "baseline_mentions")}
    words = labelled.select("product", content_tokens("consumer_complaint_narrative").alias("words"), *period.values())
    counts = count_terms(words, ["product"], list(period), at_least=at_least)
    if with_doc_marker:
        told = labelled.where(F.col("consumer_complaint_narrative").isNotNull())
        counts = counts.unionByName(_by_term(told, F.lit(DOC_MARKER).alias("term")))
    return counts


def score_terms(counts: DataFrame) -> DataFrame:
    """S7 + S8: rates in %, growth % (NULL when the baseline rate is 0) and emergence
    score (difference of rates in points), from mentions and per-period totals."""
    rec = F.col("recent_mentions").cast("double") / F.col("recent_total").cast("double")
    base = F.col("baseline_mentions").cast("double") / F.col("baseline_total").cast("double")
    return counts.select("product", "term", "recent_mentions", "baseline_mentions",
                         (rec * 100.0).alias("recent_rate_percent"),
                         (base * 100.0).alias("baseline_rate_percent"),
                         F.when(base > 0, (rec - base) * 100.0 / base).alias("growth_rate_percent"),
                         ((rec - base) * 100.0).alias("emergence_score"))


def emerging_themes(complaints: DataFrame, th: Thresholds = DEFAULTS,
                    products: list[str] | None = None, anchor=None) -> DataFrame:
    """Recent-vs-baseline bigram themes per product, top `themes_kept` by emergence score. A caller
    who knows the latest day with a narrative (``buckets.maximum``) spares the pass that finds it."""
    ws = window_bounds(anchor if anchor is not None else anchor_day(complaints), th)
    labelled = labelled_narratives(complaints, th, products, ws)
    # The marker rows carry the per-period totals (E11). The aggregate is read by the totals and by the exact top-k several
    # times, so its frequent terms are written once; the many rare ones are not.
    counts = frequent_terms(term_document_counts(labelled, with_doc_marker=True, at_least=th.min_doc_freq), th)
    return themes_from_counts(cut_lineage(counts), ws, th)


def frequent_terms(all_counts: DataFrame, th: Thresholds = DEFAULTS) -> DataFrame:
    """T6, with the marker rows."""
    return all_counts.where((F.col("term") == DOC_MARKER) | (F.col("doc_freq") >= th.min_doc_freq))


def themes_from_counts(all_counts: DataFrame, ws: dict[str, Column],
                       th: Thresholds = DEFAULTS) -> DataFrame:
    """Themes from the (written) counts per product and term, marker rows included: those of
    ``term_document_counts`` or the sliding ones of ``operators.sliding``."""
    totals = (all_counts.where(F.col("term") == DOC_MARKER)
              .select("product", F.col("recent_mentions").alias("recent_total"),
                      F.col("baseline_mentions").alias("baseline_total"))
              .where((F.col("recent_total") > 0) & (F.col("baseline_total") > 0)))
    counts = all_counts.where((F.col("term") != DOC_MARKER)
                              & (F.col("doc_freq") >= th.min_doc_freq))                    # T6
    vocab = top_k_by_count(counts, ["product"], "doc_freq", "term",
                           th.max_theme_terms).drop("doc_freq")                            # G8
    scored = score_terms(vocab.join(totals, "product"))                                   # D7
    kept = scored.where((F.col("recent_mentions") >= th.min_recent_mentions)               # T7
                        & ~is_noise_term(F.col("term")))                                   # S10
    rank_w = Window.partitionBy("product").orderBy(F.col("emergence_score").desc(), "term")  # G4
    top = kept.withColumn("theme_rank", F.row_number().over(rank_w)).where(
        F.col("theme_rank") <= th.themes_kept)
    r2 = lambda c: F.bround(F.col(c), 2).alias(c)  # noqa: E731  (S4: half-even)
    return top.select(
        "product", "term", "recent_mentions", "baseline_mentions",
        r2("recent_rate_percent"), r2("baseline_rate_percent"), r2("growth_rate_percent"),
        r2("emergence_score"), "theme_rank",
        *[ws[c].alias(c) for c in ("recent_start", "recent_end", "baseline_start", "baseline_end")])


def top_themes(themes: DataFrame, per_product: int = DEFAULTS.themes_per_product) -> DataFrame:
    """F10 + G5: first `per_product` themes per product by score (then term)."""
    w = Window.partitionBy("product").orderBy(F.col("emergence_score").desc(), "term")
    return (themes.withColumn("selection_rank", F.row_number().over(w))
            .where(F.col("selection_rank") <= per_product))


def theme_evidence(complaints: DataFrame, selected: DataFrame,
                   th: Thresholds = DEFAULTS) -> DataFrame:
    """D3 + T8 + F10: up to `narratives_per_theme` supporting narratives per selected theme.

    A narrative supports a theme when it has the same product, was received
    within the theme's recent window (whole last day included) and its bigram set
    contains the term (lower-cased). The wanted terms of a product (a few) are broadcast and
    intersected with a narrative's bigrams inside the row, so only hits become rows; the
    first in (date_received, complaint_id) order are kept.

    On the month layout (a column ``received_month``) the wanted terms are keyed by product and
    month, and the join on the month prunes the scan at run time to the months of the selected
    windows (dynamic partition pruning), also where these lie far apart.
    """
    # The selection is a few rows per product and is read three times below:
    # checkpoint it once instead of recomputing the theme pipeline each time.
    sel = bounded_broadcast(cut_lineage(
        selected.select("product", F.lower(F.col("term")).alias("term_key"), "term",
                        "recent_start", "recent_end")))
    # Outer bounds of every selected window, read once from the (small, checkpointed)
    # selection and used as literals, so the date range reaches the narrative scan.
    bounds = sel.agg(F.min("recent_start").alias("lo"), F.max("recent_end").alias("hi")).first()
    lo = F.lit(bounds["lo"]).cast("date").cast("timestamp_ntz")
    hi = F.date_add(F.lit(bounds["hi"]).cast("date"), 1).cast("timestamp_ntz")
    on = ["product"]
    terms = sel
    if MONTH in complaints.columns:
        on.append(MONTH)
        # Stepped by days, since steps of a month can pass over the last one; a window is short.
        days = F.sequence("recent_start", "recent_end")
        terms = sel.select("product", "term_key", F.explode(F.array_distinct(F.transform(days, month_of))).alias(MONTH))
        # The months as such tell the optimiser that this side is selective.
        terms = terms.where((F.col(MONTH) >= month_of(lo)) & (F.col(MONTH) <= month_of(hi)))
    wanted = terms.groupBy(*on).agg(F.collect_set("term_key").alias("_wanted"))
    cand = (complaints
            .where(F.col("consumer_complaint_narrative").isNotNull()
                   & (F.col("date_received") >= lo) & (F.col("date_received") < hi))
            .join(bounded_broadcast(wanted), on))
    # Only a narrative that holds both words of a wanted term somewhere can hold the bigram; the
    # others are not tokenised.
    low = F.lower("consumer_complaint_narrative")
    cand = cand.where(F.exists("_wanted", lambda t: F.forall(F.split(t, " "), lambda x: F.contains(low, x))))
    cand = explode_terms(with_terms(cand, "consumer_complaint_narrative", "_bg")
                         .withColumn("_arr", F.array_intersect("_bg", "_wanted")), "_arr", "term_key",
                         ["complaint_id", "product", "issue", "date_received",
                          "consumer_complaint_narrative"])
    joined = cand.join(sel, ["product", "term_key"]).where(
        (F.col("date_received") >= F.col("recent_start").cast("timestamp_ntz"))
        & (F.col("date_received") < F.date_add("recent_end", 1).cast("timestamp_ntz")))
    w = Window.partitionBy("product", "term").orderBy("date_received", "complaint_id")
    return (joined.withColumn("evidence_rank", F.row_number().over(w))
            .where(F.col("evidence_rank") <= th.narratives_per_theme)
            .select("product", "term", "evidence_rank", "complaint_id", "issue",
                    redact("consumer_complaint_narrative", th.theme_text_chars)
                    .alias("redacted_narrative")))


def themes_without_evidence(selected: DataFrame, evidence: DataFrame) -> DataFrame:
    """Selected themes that found no supporting narrative (skipped downstream)."""
    return selected.join(evidence.select("product", "term").distinct(), ["product", "term"],
                         "left_anti")


# Our own prompt wording (not the reference's).
PROMPT_HEAD = ("Summarise this complaint theme for a customer-risk review, using only the "
               "records below. Report allegations as customer claims, cite only the listed "
               "complaint ids and flag the answer for human review when evidence is thin.")


def theme_prompts(selected: DataFrame, evidence: DataFrame) -> DataFrame:
    """S20 + E18: one prompt per theme with evidence; sections in evidence order."""
    section = F.concat(F.lit("Complaint "), F.col("complaint_id").cast("string"),
                       F.lit(" | issue: "), F.coalesce(F.col("issue"), F.lit("Unknown")),
                       F.lit("\n"), F.col("redacted_narrative"))
    per_theme = (evidence
                 .groupBy("product", "term")
                 .agg(F.sort_array(F.collect_list(F.struct("evidence_rank", section.alias("s"))))
                      .alias("_secs"),
                      F.count(F.lit(1)).alias("supporting_records"),
                      F.sort_array(F.collect_list(F.struct("evidence_rank", "complaint_id")))
                      .alias("_ids")))
    growth = F.coalesce(dec2_text("growth_rate_percent"), F.lit("n/a"))
    header = F.concat(F.lit(PROMPT_HEAD), F.lit("\nProduct: "), F.col("product"),
                      F.lit("\nTerm: "), F.col("term"),
                      F.lit("\nRecent mentions: "), F.col("recent_mentions").cast("string"),
                      F.lit("\nBaseline mentions: "), F.col("baseline_mentions").cast("string"),
                      F.lit("\nGrowth %: "), growth,
                      F.lit("\nEmergence score: "), dec2_text("emergence_score"))
    body = F.array_join(F.transform("_secs", lambda x: x["s"]), "\n\n")
    return (selected.join(per_theme, ["product", "term"])
            .select("product", "term", "supporting_records",
                    F.array_join(F.transform("_ids", lambda x: x["complaint_id"].cast("string")), ";")
                    .alias("supplied_ids"),
                    F.concat(header, F.lit("\n\nRecords:\n"), body).alias("prompt")))


def first_narrative_prompt(complaints: DataFrame, th: Thresholds = DEFAULTS) -> DataFrame:
    """G6 + S13: prompt for the first usable narrative in (date_received, complaint_id) order."""
    first = (complaints.where(F.col("consumer_complaint_narrative").isNotNull())
             .agg(F.min_by(F.struct("complaint_id", "product", "issue",
                                    "consumer_complaint_narrative"),
                           F.struct("date_received", "complaint_id")).alias("r"))
             .where(F.col("r").isNotNull())
             .select("r.*"))
    text = redact("consumer_complaint_narrative", th.single_text_chars)
    return first.select(
        "complaint_id", "product", F.col("issue").alias("recorded_issue"),
        F.concat(F.lit("Summarise this single complaint for a customer-risk analyst. Use only "
                       "the text below and flag unclear or sensitive cases for review."),
                 F.lit("\nProduct: "), F.coalesce("product", F.lit("Unknown")),
                 F.lit("\nRecorded issue: "), F.coalesce("issue", F.lit("Unknown")),
                 F.lit("\nNarrative:\n"), text).alias("prompt"))
