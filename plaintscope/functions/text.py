"""Text column expressions: tokens, stop words, bigrams, noise filter, redaction.

All are built-in array / regex expressions evaluated inside whole-stage codegen
or the interpreted expression path on executors; no Python UDF is involved and
whole texts are processed (no prefixes).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Spark ML's default English stop-word list (StopWordsRemover,
# "english"), 181 words, in its published order. Removed before n-grams are formed.
STOP_WORDS = (
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your", "yours",
    "yourself", "yourselves", "he", "him", "his", "himself", "she", "her", "hers", "herself",
    "it", "its", "itself", "they", "them", "their", "theirs", "themselves", "what", "which",
    "who", "whom", "this", "that", "these", "those", "am", "is", "are", "was", "were", "be",
    "been", "being", "have", "has", "had", "having", "do", "does", "did", "doing", "a", "an",
    "the", "and", "but", "if", "or", "because", "as", "until", "while", "of", "at", "by",
    "for", "with", "about", "against", "between", "into", "through", "during", "before",
    "after", "above", "below", "to", "from", "up", "down", "in", "out", "on", "off", "over",
    "under", "again", "further", "then", "once", "here", "there", "when", "where", "why",
    "how", "all", "any", "both", "each", "few", "more", "most", "other", "some", "such", "no",
    "nor", "not", "only", "own", "same", "so", "than", "too", "very", "s", "t", "can", "will",
    "just", "don", "should", "now", "i'll", "you'll", "he'll", "she'll", "we'll", "they'll",
    "i'd", "you'd", "he'd", "she'd", "we'd", "they'd", "i'm", "you're", "he's", "she's",
    "it's", "we're", "they're", "i've", "we've", "you've", "they've", "isn't", "aren't",
    "wasn't", "weren't", "haven't", "hasn't", "hadn't", "don't", "doesn't", "didn't", "won't",
    "wouldn't", "shan't", "shouldn't", "mustn't", "can't", "couldn't", "cannot", "could",
    "here's", "how's", "let's", "ought", "that's", "there's", "what's", "when's", "where's",
    "who's", "why's", "would",
)

# token = run of two or more letters, digits or underscores (after lower-casing).
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"

# A term is noise if one of its words is all x's (masked text) or it has a digit.
NOISE_PATTERN = r"(?i)(^| )x{2,}( |$)|\p{Nd}"

# Redaction in any script: a word character is a letter, mark, number or underscore. An
# address starts and ends at a word character. It is looked for once per run of characters that
# may stand before the sign (at the run's start, or where the last address ended), and no part of
# the pattern is tried twice on a character, so a word of any length costs linear time. A number is nine or more digits, blanks and
# number signs between two digits, not joined to a word.
WORD = r"\p{L}\p{M}\p{N}_"
EMAIL_PATTERN = (rf"(?:(?<![{WORD}.+-])|\G)([.+-]*+)[{WORD}][{WORD}.+-]*+"
                 rf"@[{WORD}-]++\.[{WORD}.-]*[{WORD}]")
NUMBER_BODY = r"\p{Nd}[\p{Nd}\p{Z}\t\n\x0B\f\r().-]{7,}\p{Nd}"
NUMBER_PATTERN = rf"(?<![{WORD}]){NUMBER_BODY}(?![{WORD}])"
EMAIL_MASK = "[EMAIL REMOVED]"  # after the signs before the address (group 1)
NUMBER_MASK = "[NUMBER REMOVED]"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokens(text) -> Column:
    """Lower-cased word tokens of two or more characters, in text order."""
    return F.regexp_extract_all(F.lower(_c(text)), F.lit(TOKEN_PATTERN), 0)


def drop_stop_words(toks, stop_words=STOP_WORDS) -> Column:
    """Remove stop words, keeping order and repeats (array_except would dedup).

    An IN list of literals is planned as a hash-set lookup (InSet), about 5x
    faster than array_contains over a literal array, which scans it per token."""
    return F.filter(_c(toks), lambda x: ~x.isin(*stop_words))


def content_tokens(text, stop_words=STOP_WORDS) -> Column:
    return drop_stop_words(tokens(text), stop_words)


def ngrams2(toks) -> Column:
    """Adjacent pairs joined by one space; empty for fewer than two tokens."""
    t = _c(toks)
    n = F.size(t)
    pairs = F.zip_with(F.slice(t, 1, n - 1), F.slice(t, 2, n - 1),
                       lambda a, b: F.concat(a, F.lit(" "), b))
    return F.when(n >= 2, pairs).otherwise(F.array().cast("array<string>"))


def with_terms(df: DataFrame, text: str, out: str, unigrams: bool = False,
               stop_words=STOP_WORDS) -> DataFrame:
    """Add ``out``: distinct-free list of bigrams (T1-T3), or unigrams + bigrams (T4).

    The stop-word-free tokens are materialised as their own column first: the
    n-gram expression refers to them several times, and higher-order functions
    are interpreted (no common-subexpression elimination), so inlining would
    re-tokenise the whole text once per reference. Catalyst keeps the two
    projections apart because the token expression is not cheap to duplicate.
    """
    tok = f"__tok_{out}"
    staged = df.withColumn(tok, content_tokens(text, stop_words))
    grams = ngrams2(F.col(tok))
    terms = F.concat(F.col(tok), grams) if unigrams else grams
    return staged.withColumn(out, terms).drop(tok)


def explode_terms(df: DataFrame, array_col: str, out: str, keep: list[str]) -> DataFrame:
    """One row per array element, for arrays computed from text.

    ``explode`` makes Catalyst infer ``size(array) > 0`` and push that filter below
    the projection that builds the array, which re-runs the whole tokeniser per
    row. ``explode_outer`` infers nothing; its NULL rows (empty arrays) are dropped
    by a filter on the generated column, which cannot move below the generator.
    """
    return (df.select(*keep, F.explode_outer(array_col).alias(out))
            .where(F.col(out).isNotNull()))


def is_noise_term(term) -> Column:
    """Masked-text words (xx, XXXX) or any digit."""
    return _c(term).rlike(NOISE_PATTERN)


def redact(text, max_chars: int | None = None) -> Column:
    """E-mails, then long numbers, then truncate to max_chars characters."""
    t = F.regexp_replace(_c(text), EMAIL_PATTERN, "$1" + EMAIL_MASK)
    t = F.regexp_replace(t, NUMBER_PATTERN, NUMBER_MASK)
    return F.substring(t, 1, max_chars) if max_chars else t
