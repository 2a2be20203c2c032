"""Views of the driver's test tables in the complaint data model.

The test tables hold no complaints, so each adapter maps one table onto the
columns a job needs (SURVEY 7.3). Adapters are projections only; Catalyst
prunes the parquet scan to the mapped columns and pushes filters through them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import bounded_broadcast, spread

# Fixed value: calendar origin of the document adapter.
TEXT_ORIGIN = "2024-01-01"
TEXT_SPREAD_DAYS = 35


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def volume_complaints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem: received = ship date, product = return flag, company = line status."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("complaint_id"),
        F.col("l_shipdate").alias("date_received"),
        F.col("l_returnflag").alias("product"),
        F.col("l_linestatus").alias("company"),
    )


def event_complaints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events: received = ts, product = event type, company = user bucket."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").alias("complaint_id"),
        F.col("ts").alias("date_received"),
        F.col("event_type").alias("product"),
        F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("company"),
    )


def narrative_complaints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents: id = doc_id, product = lang, company = source, narrative = text,
    received = origin + (doc_id mod 35) days, issue = source."""
    docs = spread(table(spark, sf_dir, "documents"), "doc_id")
    received = F.date_add(F.lit(TEXT_ORIGIN).cast("date"),
                          F.pmod(F.col("doc_id"), F.lit(TEXT_SPREAD_DAYS)).cast("int"))
    return docs.select(
        F.col("doc_id").alias("complaint_id"),
        received.cast("timestamp_ntz").alias("date_received"),
        F.col("lang").alias("product"),
        F.col("source").alias("issue"),
        F.col("source").alias("company"),
        F.col("text").alias("consumer_complaint_narrative"),
    )


def labelled_narratives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """labels joined to documents: issue = 'q' + quality, narrative = text."""
    # The label table is joined by broadcast when its row count is within the bound
    # (the documents and their text then join map-side, unshuffled); above it, the
    # planner's shuffle join is used.
    labels = bounded_broadcast(table(spark, sf_dir, "labels").select("doc_id", "quality"))
    docs = spread(table(spark, sf_dir, "documents"), "doc_id")
    return (docs.join(labels, "doc_id")
            .select(F.col("doc_id").alias("complaint_id"),
                    F.col("text").alias("consumer_complaint_narrative"),
                    F.concat(F.lit("q"), F.col("quality").cast("string")).alias("issue")))


def raw_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as a raw text extract with the published header.

    Every field is text, as a CSV reader without inference yields it. Rules keyed
    on event_id inject the defects a real extract has: repeated ids (every tenth
    event repeats the id of the event five before it), missing ids, unparsable
    and mixed-layout dates, padded and blank text, null tokens and odd answers.
    ``_chunk`` (week of the event) and ``_row`` (event id) give input order.
    """
    ev = spread(table(spark, sf_dir, "events"), "event_id")
    e, u, t = F.col("event_id"), F.col("user_id"), F.col("event_type")
    s = lambda c: c.cast("string")
    id_num = F.when(e % 10 == 9, e - 5).otherwise(e)
    received = (F.when(e % 53 == 7, F.lit("not a date"))
                .when(e % 11 == 3, F.date_format("ts", "MM/dd/yyyy"))
                .when(e % 7 == 2, F.date_format("ts", "yyyy-MM-dd"))
                .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")))
    company = (F.when(e % 67 == 13, F.lit("NULL"))
               .when(e % 13 == 4, F.concat(F.lit(" co-"), s(u % 40), F.lit(" ")))
               .otherwise(F.concat(F.lit("co-"), s(u % 40))))
    timely = (F.when(e % 6 == 0, F.lit("Yes")).when(e % 6 == 1, F.lit(" no "))
              .when(e % 6 == 2, F.lit("YES")).when(e % 6 == 3, F.lit(None).cast("string"))
              .when(e % 6 == 4, F.lit("No")).when(e % 43 == 5, F.lit("Y"))
              .otherwise(F.lit("yes")))
    cols = {
        "Date received": received,
        "Product": (F.when(e % 41 == 5, F.lit("   "))
                    .when(e % 5 == 1, F.concat(F.lit("  "), t, F.lit(" "))).otherwise(t)),
        "Sub-product": F.when(e % 2 == 0, F.concat(F.lit("sub-"), t)).otherwise(F.lit("N/A")),
        "Issue": F.when(e % 59 == 11, F.lit(None).cast("string"))
                  .otherwise(F.concat(F.lit("issue-"), s(u % 12))),
        "Sub-issue": F.when(e % 3 == 0, F.concat(F.lit("detail-"), s(u % 5))).otherwise(F.lit("NA")),
        "Consumer complaint narrative": F.when(e % 3 == 0, F.col("props")).otherwise(F.lit("")),
        "Company public response": F.lit(None).cast("string"),
        "Company": company,
        "State": (F.when(u % 4 == 0, F.lit("NY")).when(u % 4 == 1, F.lit("CA"))
                  .when(u % 4 == 2, F.lit("TX")).otherwise(F.lit(None).cast("string"))),
        "ZIP code": F.lpad(s((u * 37) % 100000), 5, "0"),
        "Tags": F.lit(None).cast("string"),
        "Consumer consent provided?": F.lit("N/A"),
        "Submitted via": F.lit("Web"),
        "Date sent to company": F.date_format(F.date_add(F.to_date("ts"), 1), "yyyy-MM-dd"),
        "Company response to consumer": F.lit("Closed with explanation"),
        "Timely response?": timely,
        "Consumer disputed?": F.lit(None).cast("string"),
        "Complaint ID": F.when(e % 97 == 96, F.lit(None).cast("string")).otherwise(s(id_num)),
    }
    chunk = F.floor(F.datediff(F.to_date("ts"), F.lit(TEXT_ORIGIN).cast("date")) / 7).cast("int")
    return ev.select(*[c.alias(n) for n, c in cols.items()],
                     chunk.alias("_chunk"), e.alias("_row"))


def synthetic_theme_answers(selected: DataFrame, evidence: DataFrame) -> DataFrame:
    """Stand-in for model answers: one JSON answer per theme with evidence, built
    from the theme's own numbers so every validation path is exercised: ids that
    were not supplied (-1, -7), a repeated id, an urgency outside the enum
    ('Severe'), confidence above 1 and truncated (malformed) JSON."""
    per = (evidence.groupBy("product", "term")
           .agg(F.count(F.lit(1)).alias("supporting_records"),
                F.sort_array(F.collect_list(F.struct("evidence_rank", "complaint_id"))).alias("_ids")))
    ids = F.transform("_ids", lambda x: x["complaint_id"])
    rm = F.col("recent_mentions")
    answer_ids = (F.when(rm % 3 == 0, F.array(F.lit(-7).cast("bigint")))
                  .when(rm % 2 == 0, F.concat(F.array(F.lit(-1).cast("bigint")), ids, F.slice(ids, 1, 1)))
                  .otherwise(ids))
    urgency = F.element_at(F.array(*[F.lit(x) for x in ("Low", "Medium", "High", "Critical", "Severe")]),
                           (rm % 5 + 1).cast("int"))
    body = F.to_json(F.struct(
        F.concat(F.lit("Customers report "), F.col("term")).alias("cluster_summary"),
        F.concat(F.lit("Resolve "), F.col("term")).alias("customer_need"),
        F.lit("Service and conduct risk").alias("risk_implication"),
        urgency.alias("urgency"),
        F.concat(F.lit("Review cases mentioning "), F.col("term")).alias("recommended_action"),
        (rm.cast("double") / 10.0).alias("confidence"),
        (F.col("supporting_records") < 3).alias("requires_human_review"),
        answer_ids.alias("evidence_complaint_ids")))
    return (selected.join(per, ["product", "term"])
            .select("product", "term", "recent_mentions", "baseline_mentions", "growth_rate_percent",
                    "emergence_score", "supporting_records",
                    F.array_join(F.transform(ids, lambda x: x.cast("string")), ";").alias("supplied_ids"),
                    F.when(rm % 7 == 0, F.substring(body, 1, 25)).otherwise(body).alias("answer_json")))
