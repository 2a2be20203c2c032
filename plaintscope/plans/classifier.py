"""Classifier queries over labels joined to documents (class = 'q' + quality)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import classify as K
from ..session import cut_lineage
from ..sources.adapters import labelled_narratives
from .registry import register
from .themes import sql_content, sql_pairs

_TRIM = r"'^[\s\p{Z}]+|[\s\p{Z}]+$'"

SPLIT_CTE = f"""
l AS (SELECT lb.doc_id AS complaint_id, d.text AS narrative, 'q' || CAST(lb.quality AS VARCHAR) AS issue
      FROM labels lb JOIN documents d USING (doc_id)),
u AS (SELECT * FROM (
        SELECT complaint_id, regexp_replace(narrative, {_TRIM}, '', 'g') AS consumer_complaint_narrative,
               regexp_replace(issue, {_TRIM}, '', 'g') AS issue
        FROM l WHERE narrative IS NOT NULL AND issue IS NOT NULL) x
      WHERE consumer_complaint_narrative <> ''),
cc AS (SELECT issue, count(*) AS records FROM u GROUP BY issue),
el AS (SELECT * FROM u WHERE issue IN (SELECT issue FROM cc WHERE records >= 50)),
q0 AS (SELECT issue, count(*) AS records, (count(*) * 2000) // 10000 AS base,
              (count(*) * 2000) % 10000 AS rem FROM el GROUP BY issue),
q AS (SELECT issue, records,
             CAST(base + CASE WHEN row_number() OVER (ORDER BY rem DESC, issue)
                                   <= (SELECT CAST(ceil(sum(records) * 2000 / 10000) AS BIGINT) - sum(base) FROM q0)
                              THEN 1 ELSE 0 END AS BIGINT) AS test_quota
      FROM q0),
sp AS (SELECT el.*, row_number() OVER (PARTITION BY el.issue
                                       ORDER BY md5('42:' || CAST(complaint_id AS VARCHAR)), complaint_id)
                    <= q.test_quota AS is_test
       FROM el JOIN q USING (issue))"""

VOCAB_CTE = f"""
terms AS (SELECT complaint_id, is_test, unnest(list_concat(ct, {sql_pairs('ct')})) AS term
          FROM (SELECT complaint_id, is_test, {sql_content('consumer_complaint_narrative')} AS ct FROM sp) x),
tf AS (SELECT complaint_id, is_test, term, count(*) AS tf FROM terms GROUP BY 1, 2, 3),
st AS (SELECT term, count(*) AS doc_freq, CAST(sum(tf) AS BIGINT) AS term_freq FROM tf WHERE NOT is_test
       GROUP BY term HAVING count(*) >= 3),
voc AS (SELECT term, doc_freq, term_freq,
               CAST(row_number() OVER (ORDER BY term_freq DESC, term) - 1 AS INTEGER) AS term_index
        FROM st QUALIFY term_index < 20000)"""


def _split(spark, sf):
    return K.prepare_split(labelled_narratives(spark, sf))


@register("class_counts", f"WITH {SPLIT_CTE}\nSELECT * FROM cc")
def q_class_counts(spark, sf):
    return K.class_counts(K.usable_narratives(labelled_narratives(spark, sf)))


def _usable_ids(spark, sf):
    """(id, class) of the usable narratives, written once: the class counts and the
    eligibility semi-join both read it, and neither needs the text again."""
    return cut_lineage(K.usable_narratives(labelled_narratives(spark, sf))
                       .select("complaint_id", "issue"))


@register("class_eligible", f"WITH {SPLIT_CTE}\nSELECT complaint_id, issue FROM el")
def q_class_eligible(spark, sf):
    return K.eligible_rows(_usable_ids(spark, sf)).select("complaint_id", "issue")


@register("split_quotas", f"WITH {SPLIT_CTE}\nSELECT issue, records, test_quota FROM q")
def q_split_quotas(spark, sf):
    return K.split_quotas(K.eligible_rows(_usable_ids(spark, sf)))


@register("stratified_split", f"WITH {SPLIT_CTE}\nSELECT complaint_id, issue, is_test FROM sp")
def q_split(spark, sf):
    return _split(spark, sf).select("complaint_id", "issue", "is_test")


@register("class_weights", f"""WITH {SPLIT_CTE},
tr AS (SELECT issue, count(*) AS records FROM sp WHERE NOT is_test GROUP BY issue)
SELECT issue, records,
       CAST((SELECT sum(records) FROM tr) AS DOUBLE)
         / CAST((SELECT count(*) FROM tr) * records AS DOUBLE) AS weight
FROM tr""")
def q_class_weights(spark, sf):
    return K.class_weights(_split(spark, sf).where(~F.col("is_test")))


@register("tfidf_vocab", f"WITH {SPLIT_CTE},{VOCAB_CTE}\nSELECT * FROM voc")
def q_vocab(spark, sf):
    sp = _split(spark, sf)
    return K.tfidf_vocab(sp.where(~F.col("is_test")))


@register("tfidf_weights", f"""WITH {SPLIT_CTE},{VOCAB_CTE},
nt AS (SELECT count(*) AS n FROM sp WHERE NOT is_test),
raw AS (SELECT complaint_id, term, term_index,
               (1.0 + ln(CAST(tf AS DOUBLE)))
               * (ln(CAST(1 + n AS DOUBLE) / CAST(1 + doc_freq AS DOUBLE)) + 1.0) AS w
        FROM tf JOIN voc USING (term), nt)
SELECT complaint_id, term, term_index,
       round(w / sqrt(sum(w * w) OVER (PARTITION BY complaint_id)), 10) AS weight
FROM raw""")
def q_weights(spark, sf):
    sp = _split(spark, sf)
    train = sp.where(~F.col("is_test"))
    tf = cut_lineage(K.term_frequencies(sp, keep=("is_test",)))  # tokenised once
    vocab = cut_lineage(K.tfidf_vocab(train, tf=tf.where(~F.col("is_test"))))
    return (K.tfidf_weights(sp, vocab, F.lit(float(train.count())), tf=tf)
            .withColumn("weight", F.round("weight", 10)))


@register("issue_classifier")
def q_classifier(spark, sf):
    return K.train_and_predict(_split(spark, sf))[0]


@register("classification_report")
def q_report(spark, sf):
    return K.classification_report(K.train_and_predict(_split(spark, sf))[0])


@register("model_run_summary")
def q_run_summary(spark, sf):
    sp = _split(spark, sf)
    return K.run_summary(sp, K.classification_report(K.train_and_predict(sp)[0]))


@register("baseline_report", f"""WITH {SPLIT_CTE},
top AS (SELECT issue FROM sp WHERE NOT is_test GROUP BY issue ORDER BY count(*) DESC, issue LIMIT 1),
pr AS (SELECT complaint_id, issue, (SELECT issue FROM top) AS predicted_issue FROM sp WHERE is_test),
bt AS (SELECT issue, count(*) AS support, count(*) FILTER (WHERE issue = predicted_issue) AS tp FROM pr GROUP BY issue),
bp AS (SELECT predicted_issue AS issue, count(*) AS pc FROM pr GROUP BY 1),
per AS (SELECT issue, coalesce(support, 0) AS support, coalesce(tp, 0) AS tp, coalesce(pc, 0) AS pc
        FROM bt FULL JOIN bp USING (issue)),
m AS (SELECT issue, CASE WHEN pc > 0 THEN CAST(tp AS DOUBLE) / pc ELSE 0.0 END AS p,
             CASE WHEN support > 0 THEN CAST(tp AS DOUBLE) / support ELSE 0.0 END AS r,
             CAST(support AS DOUBLE) AS support FROM per),
cls AS (SELECT 0 AS row_order, issue, p AS precision, r AS recall,
               CASE WHEN p + r > 0 THEN 2.0 * p * r / (p + r) ELSE 0.0 END AS f1_score, support FROM m),
acc AS (SELECT CAST(count(*) FILTER (WHERE issue = predicted_issue) AS DOUBLE) / count(*) AS a FROM pr),
tot AS (SELECT sum(support) AS n, avg(precision) AS mp, avg(recall) AS mr, avg(f1_score) AS mf,
               sum(precision * support) AS wp, sum(recall * support) AS wr, sum(f1_score * support) AS wf
        FROM cls)
SELECT * FROM cls
UNION ALL SELECT 1, 'accuracy', a, a, a, a FROM acc
UNION ALL SELECT 2, 'macro avg', mp, mr, mf, n FROM tot
UNION ALL SELECT 3, 'weighted avg', wp / n, wr / n, wf / n, n FROM tot""")
def q_baseline_report(spark, sf):
    return K.classification_report(K.majority_baseline(_split(spark, sf)))
