"""Tokens, stop words, bigrams, noise terms and redaction (FIXTURES F8)."""

import random
import time

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F

from plaintscope.functions import text as X


def _one(spark, expr, value):
    return spark.createDataFrame([(value,)], "t string").select(expr(F.col("t")).alias("o")).first().o


def test_stop_words_are_sparks_default(spark):
    assert list(X.STOP_WORDS) == StopWordsRemover.loadDefaultStopWords("english")


def test_tokens_and_bigrams(spark):
    assert _one(spark, X.tokens, "The letter, was SENT a b") == ["the", "letter", "was", "sent"]
    df = spark.createDataFrame([("the letter was sent",), ("one",), ("",)], "t string")
    out = [r.b for r in X.with_terms(df, "t", "b").collect()]
    assert out == [["letter sent"], [], []]
    uni = X.with_terms(df, "t", "b", unigrams=True).first().b
    assert uni == ["letter", "sent", "letter sent"]


def test_noise_terms(spark):
    df = spark.createDataFrame([("xx account",), ("XXXX paid",), ("line 2",), ("best buy",),
                                ("taxx fee",)], "t string")
    noisy = [r.t for r in df.where(X.is_noise_term("t")).collect()]
    assert noisy == ["xx account", "XXXX paid", "line 2"]


def test_redaction(spark):
    assert _one(spark, X.redact, "a.b+c@ex.com") == "[EMAIL REMOVED]"
    assert _one(spark, X.redact, "call +1 (555) 123-4567 ok") == "call +[NUMBER REMOVED] ok"
    assert _one(spark, X.redact, "12345678") == "12345678"
    assert _one(spark, X.redact, "jos\u00e9@ex.com, m\u00fcller.k@ex.de") == "[EMAIL REMOVED], [EMAIL REMOVED]"
    assert _one(spark, X.redact, "06\u00a012\u00a034\u00a056\u00a078") == "[NUMBER REMOVED]"
    assert _one(spark, X.redact, "\u0660\u0661\u0662\u0663\u0664\u0665\u0666\u0667\u0668") == "[NUMBER REMOVED]"
    assert _one(spark, X.redact, "0612345678,0712345678;0812345678") == "[NUMBER REMOVED],[NUMBER REMOVED];[NUMBER REMOVED]"
    assert _one(spark, lambda c: X.redact(c, 5), "abcdefgh") == "abcde"


# The rule as one plain pattern, tried from every character: the definition, not fit for long words.
PLAIN_EMAIL = rf"[{X.WORD}][{X.WORD}.+-]*@[{X.WORD}-]+\.[{X.WORD}.-]*[{X.WORD}]"


def test_addresses_are_those_of_the_plain_pattern(spark):
    rng = random.Random(1)
    rows = ["a@b.c+d@e.f", "+.a@b.c", "a@b.c@d.e", "..@b.c", "a@b..c.", "a@-.-a", "é.ü@ж-1.рф!", "a@b.c-", "x a@b.c,d@e.f y", "a@b", "@a.b", "a+@b.c.d_"]
    rows += ["".join(rng.choice("ab1@@..+-_ é,") for _ in range(rng.randrange(1, 40))) for _ in range(3000)]
    df = spark.createDataFrame([(r,) for r in rows], "t string")
    bad = df.where(F.regexp_replace("t", X.EMAIL_PATTERN, "$1" + X.EMAIL_MASK) != F.regexp_replace("t", PLAIN_EMAIL, X.EMAIL_MASK))
    assert [r.t for r in bad.collect()] == []


def test_redaction_of_long_words_takes_linear_time(spark):
    n = 1_000_000
    texts = ["a" * n, "a." * (n // 2), "a@" * (n // 2), "a@b." + "-" * n, "1" * n + "x", "1 (" + "." * n, "a" * n + "@b.c end"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(X.redact("t").alias("r")).select(F.length("r").alias("n"), F.right("r", F.lit(4)).alias("e"))
    df.collect()
    start = time.perf_counter()
    got = df.collect()
    assert time.perf_counter() - start < 7 and got[-1].n == len(X.EMAIL_MASK) + 4
