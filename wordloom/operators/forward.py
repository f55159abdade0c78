"""A corpus tokenised once: records as arrays of word numbers, and the dictionary that spells them.

A word's number is its 64-bit hash, so numbers need no join and no order: records are numbered where
they are read.  The dictionary, one row a word, is built from the same pass's distinct words and refuses
two words with one number (not to be expected below a billion words).  Jobs over the index
read arrays of numbers instead of texts, only the column they need, and spell their small results.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.functions.porter import stem_all, with_stem
from wordloom.operators.cooccurrence import _half_pairs, _mirror, _summed
from wordloom.operators.words import exploded_words, refuse, with_words
from wordloom.sources.lists import WordList, literal_words, settled


class Index(NamedTuple):
    """``records``: their columns, ``words`` and ``terms`` (stems) as numbers, place by place; ``dictionary``: ``(number, word, term_number, term)``."""

    records: DataFrame
    dictionary: DataFrame


def build_index(records: DataFrame, path: str, *, text: str = "text", min_len: int = 3, revision: str = "revised") -> Index:
    """Write the index of ``records`` to the folder ``path`` and open it; stop words and vocabularies are applied when it is read.

    Nothing but distinct words is shuffled.  Null texts have null arrays; repeated records stay apart.
    """
    refuse(records, text, "words", "terms")
    spelled = with_words(records, text=text, min_len=min_len)
    kept = [c for c in records.columns if c != text]
    stems = spelled.select(*kept, "words", stem_all("words", revision).alias("terms"))
    numbered = stems.select(*kept, *[F.transform(c, lambda x: F.xxhash64(x)).alias(c) for c in ("words", "terms")])
    numbered.write.parquet(f"{path}/records")
    distinct = with_words(records.select(text), text=text, min_len=min_len, distinct=True)
    listed = with_stem(exploded_words(distinct).distinct(), "word", "term", revision)
    numbers = listed.select(F.xxhash64("word").alias("number"), "word", F.xxhash64("term").alias("term_number"), "term")
    numbers.write.parquet(f"{path}/dictionary")
    index = open_index(records.sparkSession, path)
    for number, name in (("number", "word"), ("term_number", "term")):
        twice = index.dictionary.select(number, name).distinct().groupBy(number).agg(F.count("*").alias("n"), F.min(name).alias("one"), F.max(name).alias("other"))
        if row := twice.where("n > 1").first():
            raise ValueError(f"{row.one!r} and {row.other!r} have the same number")
    return index


def open_index(spark: SparkSession, path: str) -> Index:
    return Index(spark.read.parquet(f"{path}/records"), spark.read.parquet(f"{path}/dictionary"))


def _numbers(words: WordList) -> str | None:
    """SQL list of the numbers of a list short enough for literals; None without a list."""
    if words is None:
        return None
    listed = literal_words(settled(words))
    if listed is None:
        raise ValueError("the index takes word lists that fit into literals; use with_words for longer ones")
    return ", ".join(f"xxhash64('{w}')" for w in listed if w.isascii() and w.isalpha()) or "NULL"


def _kept(vocabulary: WordList, stopwords: WordList, word: str) -> str:
    """SQL: the word number passes both lists."""
    keep, stop = _numbers(vocabulary), _numbers(stopwords)
    said = [f"{word} IN ({keep})"] if keep else []
    if stop and stop != "NULL":
        said.append(f"{word} NOT IN ({stop})")
    return " AND ".join(said) or "true"


def indexed_words(index: Index, *, stopwords: WordList = None, vocabulary: WordList = None) -> DataFrame:
    """The records with ``words`` as numbers, listed words applied; as :func:`with_words`, without reading a text."""
    kept = [c for c in index.records.columns if c not in ("words", "terms")]
    return index.records.select(*kept, F.expr(f"filter(words, w -> {_kept(vocabulary, stopwords, 'w')})").alias("words"))


def indexed_pairs(index: Index, vocabulary: WordList, distance: int = 1, *, stopwords: WordList = None) -> DataFrame:
    """``(l, r, n)`` as :func:`pairs`, from the index; only the summed matrix is spelled."""
    numbers = indexed_words(index, stopwords=stopwords, vocabulary=vocabulary).select("words")
    cells = _mirror(_summed(_half_pairs(numbers, distance)))
    spelled = index.dictionary.select("number", "word")
    left = cells.join(spelled.select(F.col("number").alias("l"), F.col("word").alias("lw")), "l")
    both = left.join(spelled.select(F.col("number").alias("r"), F.col("word").alias("rw")), "r")
    return both.select(F.col("lw").alias("l"), F.col("rw").alias("r"), "n")


def indexed_counts(index: Index, *, stopwords: WordList = None) -> DataFrame:
    """``(word, n)`` as :func:`word_counts`, from the index."""
    rows = index.records.select(F.explode_outer("words").alias("number")).where("number IS NOT NULL")
    sums = rows.where(_kept(None, stopwords, "number")).groupBy("number").agg(F.count("*").alias("n"))
    return sums.join(index.dictionary.select("number", "word"), "number").select("word", "n")


def indexed_document_frequency(index: Index, *, stopwords: WordList = None) -> DataFrame:
    """``(term, df)`` as :func:`document_frequency`, from the index; stems were found when it was built."""
    kept = f"filter(arrays_zip(words, terms), x -> {_kept(None, stopwords, 'x.words')})"
    distinct = index.records.select(F.expr(f"array_distinct(transform({kept}, x -> x.terms))").alias("terms"))
    rows = distinct.select(F.explode_outer("terms").alias("term_number")).where("term_number IS NOT NULL")
    sums = rows.groupBy("term_number").agg(F.count("*").alias("df"))
    spelled = index.dictionary.where("term <> ''").select("term_number", "term").distinct()
    return sums.join(spelled, "term_number").select("term", "df")
