"""The two composed workloads: corpus -> top words -> matrix, corpus -> DF -> TF-IDF."""

from __future__ import annotations

from pyspark.sql import DataFrame

from wordloom.operators.cooccurrence import pairs, stripes
from wordloom.operators.counts import top_k, word_counts
from wordloom.operators.relevance import document_frequency, tfidf
from wordloom.sources.lists import WordList, settled

LAYOUTS = ("pairs", "stripes")


def top_words(records: DataFrame, k: int = 50, *, stopwords: WordList = None) -> DataFrame:
    """``(word, n)``: the ``k`` most frequent words."""
    return top_k(word_counts(records, stopwords=stopwords), k)


def top_terms(records: DataFrame, k: int = 100, *, stopwords: WordList = None) -> DataFrame:
    """``(term, df)``: the ``k`` stems in most records."""
    return top_k(document_frequency(records, stopwords=stopwords), k, key="term", n="df")


def cooccurrence(
    records: DataFrame,
    *,
    k: int = 50,
    distance: int = 1,
    layout: str = "pairs",
    keep_isolated: bool = False,
    stopwords: WordList = None,
) -> DataFrame:
    """Co-occurrence of the corpus's own ``k`` top words."""
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}, got {layout!r}")
    stopwords = settled(stopwords)
    vocabulary = top_words(records, k, stopwords=stopwords).select("word")
    if layout == "pairs":
        return pairs(records, vocabulary, distance, stopwords=stopwords)
    return stripes(
        records, vocabulary, distance, stopwords=stopwords, keep_isolated=keep_isolated
    )


def top_term_scores(
    records: DataFrame,
    *,
    k: int = 100,
    n_docs: int | None = 10_000,
    stopwords: WordList = None,
) -> DataFrame:
    """TF-IDF of the ``k`` stems that occur in most records."""
    stopwords = settled(stopwords)
    terms = top_terms(records, k, stopwords=stopwords)
    return tfidf(records, terms, n_docs=n_docs, stopwords=stopwords)
