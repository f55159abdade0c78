"""Stems, document frequency, term frequency and TF-IDF."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.functions.arrays import with_runs
from wordloom.functions.porter import may_stem_to, stem_all, with_stem
from wordloom.functions.tokens import only, without
from wordloom.operators.words import exploded_words, refuse, with_words
from wordloom.session import kept as kept_frame
from wordloom.sources.lists import LITERAL_LIMIT, WordList, settled


def stem_vocabulary(
    records: DataFrame,
    *,
    stopwords: WordList = None,
    text: str = "text",
    min_len: int = 3,
    revision: str = "revised",
) -> DataFrame:
    """``(word, stem)`` for every distinct word."""
    words = with_words(
        records.select(text), stopwords=stopwords, text=text, min_len=min_len, distinct=True
    )
    return with_stem(exploded_words(words).distinct(), "word", "stem", revision)


def document_frequency(
    records: DataFrame,
    *,
    stopwords: WordList = None,
    text: str = "text",
    min_len: int = 3,
    revision: str = "revised",
) -> DataFrame:
    """``(term, df)``: in how many records a stem occurs.

    Distinct words, their stems and the distinct stems are all found inside the
    row, so only per-task sums of ``(term, df)`` are shuffled.
    """
    words = with_words(
        records.select(text), stopwords=stopwords, text=text, min_len=min_len, distinct=True
    )
    terms = words.select(F.array_distinct(stem_all("words", revision)).alias("words"))
    return (
        exploded_words(terms, "term")
        .where(F.col("term") != "")
        .groupBy("term")
        .agg(F.count("*").alias("df"))
    )


def _settled_table(df: DataFrame) -> DataFrame:
    """One row per term; of repeated terms the largest df counts."""
    known = df.where(F.col("term").isNotNull() & F.col("df").isNotNull())
    return known.groupBy("term").agg(F.max("df").cast("long").alias("df"))


def _split_table(df: DataFrame) -> tuple[list[tuple[str, int]], DataFrame | None]:
    """The most frequent terms, ``LITERAL_LIMIT`` at most, and the rest of the table if there is any.

    A table says itself which terms are hot.  Those that are taken out here have the largest
    df, so a term of the rest is in no more records than the last of them.
    """
    df = kept_frame(_settled_table(df))
    rows = df.orderBy(F.desc("df"), "term").limit(LITERAL_LIMIT + 1).collect()
    hot = [(r.term, r.df) for r in rows]
    if len(hot) <= LITERAL_LIMIT:
        return hot, None
    term, least = hot.pop()
    return hot, df.where((F.col("df") < least) | (F.col("df") == least) & (F.col("term") >= term))


def _scored(
    records: DataFrame, df: DataFrame, stopwords: WordList, text: str, min_len: int, revision: str
) -> DataFrame:
    """``(<record columns>, term, tf, df)`` for the terms of a table of any length.

    Hot terms are found inside the rows and get their df by a broadcast of ``LITERAL_LIMIT`` rows at
    most; they are never shuffled.  Only what is left of a long table is joined by term, in a second pass over
    the records that leaves hot terms out: a term that all records have is then no join key.
    """
    hot, rest = _split_table(df)
    stopwords = settled(stopwords)
    terms = [term for term, _ in hot]
    local = records.sparkSession.createDataFrame(sorted(hot), "term string, df long")
    found = _term_runs(records, terms, stopwords, text, min_len, revision).join(F.broadcast(local), "term")
    if rest is None:
        return found
    others = _term_runs(records, None, stopwords, text, min_len, revision, terms)
    return found.unionByName(others.join(rest, "term"))


def _term_runs(
    records: DataFrame,
    terms: list[str] | None,
    stopwords: WordList,
    text: str,
    min_len: int,
    revision: str,
    besides: list[str] | None = None,
) -> DataFrame:
    """``(<record columns>, term, tf)`` counted inside each row, one row per record and term.

    Of the listed terms only, or of all but those ``besides``.
    """
    refuse(records, text, "term", "tf", "df", "score")
    words = with_words(records, stopwords=stopwords, text=text, min_len=min_len)
    kept = [c for c in words.columns if c != "words"]
    if terms is not None:
        # most words cannot stem to a listed term: drop them before the stemmer
        words = words.withColumn("words", F.expr(f"filter(words, w -> {may_stem_to(terms)})"))
    stems = words.select(*kept, stem_all("words", revision).alias("__terms"))
    if terms is not None:
        stems = stems.withColumn("__terms", only("__terms", terms))
    elif besides:
        stems = stems.withColumn("__terms", without("__terms", besides))
    counted = with_runs(stems, "__terms", "__runs")
    return (
        counted.select(*kept, F.explode_outer("__runs").alias("__c"))
        .where(F.col("__c").isNotNull())
        .select(*kept, F.col("__c.value").alias("term"), F.col("__c.n").alias("tf"))
    )


def term_frequency(
    records: DataFrame,
    df: DataFrame,
    *,
    stopwords: WordList = None,
    text: str = "text",
    min_len: int = 3,
    revision: str = "revised",
) -> DataFrame:
    """``(<record columns>, term, tf)`` for the terms of ``df``, one row per record and term."""
    found = _scored(records, df, stopwords, text, min_len, revision)
    return found.select(*(c for c in records.columns if c != text), "term", "tf")


def tfidf(
    records: DataFrame,
    df: DataFrame,
    *,
    n_docs: int | None = 10_000,
    stopwords: WordList = None,
    text: str = "text",
    min_len: int = 3,
    revision: str = "revised",
) -> DataFrame:
    """``(<record columns>, term, score)`` with ``score = tf * ln(n_docs / df + 1)``.

    Only terms of the table ``df(term, df)`` are scored; of repeated terms the
    largest df counts.  ``n_docs=None`` counts the records.  With a table small enough for literals (checked) there is no
    shuffle at all; of a larger one the most frequent terms are treated that way, the rest is joined.
    """
    if n_docs is None:
        n_docs = records.count()
    found = _scored(records, df, stopwords, text, min_len, revision)
    idf = F.log(F.lit(float(n_docs)) / F.col("df") + 1)
    return found.select(*(c for c in records.columns if c != text), "term", (F.col("tf") * idf).alias("score"))
