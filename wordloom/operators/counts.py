"""Corpus-wide counts and reports over them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.functions.tokens import sql_list
from wordloom.operators.words import exploded_words, with_words
from wordloom.sources.lists import WordList, literal_words, settled, word_frame


def word_counts(
    records: DataFrame,
    *,
    stopwords: WordList = None,
    text: str = "text",
    min_len: int = 3,
    case_sensitive: bool = False,
) -> DataFrame:
    """``(word, n)``.  Counts are summed in the scan stage before the one shuffle.

    The stop list is applied to rows, in generated code, not inside the arrays;
    one too long for literals is taken off the counted words.
    """
    stopwords = settled(stopwords)
    stop = literal_words(stopwords)
    words = with_words(
        records.select(text), text=text, min_len=min_len, case_sensitive=case_sensitive
    )
    rows = exploded_words(words)
    if stop and sql_list(stop):
        rows = rows.where(f"word NOT IN ({sql_list(stop)})")
    counts = rows.groupBy("word").agg(F.count("*").alias("n"))
    if stop is None:
        counts = counts.join(word_frame(records.sparkSession, stopwords), "word", "left_anti")
    return counts


def top_k(counts: DataFrame, k: int, *, key: str = "word", n: str = "n") -> DataFrame:
    """The ``k`` largest rows; equal counts rank by key, descending."""
    return counts.orderBy(F.desc(n), F.desc(key)).limit(k)


def head(df: DataFrame, *keys: str, rows: int = 20) -> DataFrame:
    """Preview: the first rows in key order."""
    return df.orderBy(*keys).limit(rows)


def row_counts(results: dict[str, DataFrame]) -> DataFrame:
    """``(result, n_rows)`` for each named result."""
    counted = [
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("result"), "n_rows")
        for name, df in results.items()
    ]
    return reduce(DataFrame.unionByName, counted)
