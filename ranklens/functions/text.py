"""Text analysis as column expressions (JVM-side, inside whole-stage codegen).

Word-break tokenisation is approximated by splitting on runs of characters
that are neither letters nor digits, after lower-casing.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: English stop words removed by the standard analyzer (index side)
ENGLISH_STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in", "into", "is", "it",
    "no", "not", "of", "on", "or", "such", "that", "the", "their", "then", "there", "these",
    "they", "this", "to", "was", "will", "with",
)

WORD_BREAK = r"[^\p{L}\p{N}]+"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokenize_unigram(text) -> Column:
    """Lower-cased word tokens, stop words kept."""
    t = F.split(F.trim(F.regexp_replace(F.lower(_col(text)), WORD_BREAK, " ")), " ")
    return F.array_remove(t, "")


def without_stop_words(tokens) -> Column:
    """Tokens without English stop words."""
    return F.filter(_col(tokens), lambda x: ~x.isin(*ENGLISH_STOP_WORDS))


def tokenize_standard(text) -> Column:
    """Lower-cased word tokens without English stop words (index side)."""
    return without_stop_words(tokenize_unigram(text))


def query_tokens(query, raw_terms: bool = False) -> Column:
    """Query terms: normalised like the index by default; ``raw_terms`` splits on single spaces only."""
    if raw_terms:
        return F.filter(F.split(_col(query), " "), lambda x: x != "")
    return tokenize_standard(query)


def stop_words_sql() -> str:
    return "[" + ", ".join(f"'{w}'" for w in ENGLISH_STOP_WORDS) + "]"
