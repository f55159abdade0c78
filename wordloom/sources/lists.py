"""Word lists and the term -> document frequency table."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple, Union

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.functions.tokens import java_trim
from wordloom.session import kept

#: Lists up to this many words become literals of the plan, hashed once per
#: task.  Longer lists stay DataFrames, of which rows get filters; rows and columns of every
#: result are the same either way.
LITERAL_LIMIT = 10_000

WordList = Union[Iterable[str], DataFrame, "LongList", None]


def parse_words(lines: DataFrame, *, raw: bool = False) -> DataFrame:
    """One word per line: trimmed, folded, no blanks, or ``raw``: lines as they are."""
    value = F.col(lines.columns[0])
    if raw:
        return lines.select(value.alias("word")).distinct()
    return (
        lines.select(F.lower(java_trim(value)).alias("word")).where(F.col("word") != "").distinct()
    )


def read_words(spark: SparkSession, *paths: str, raw: bool = False) -> DataFrame:
    """Union of word list files.  A missing file is an error."""
    if not paths:
        raise ValueError("no word list given")
    return parse_words(spark.read.text(list(paths)), raw=raw)


def parse_df_table(lines: DataFrame, *, value: str = "value", order: str = "pos") -> DataFrame:
    """``TERM<tab>DF`` lines as ``(term, df)``.

    Kept are lines of exactly two fields whose second is a 32-bit integer above
    zero (a term in no document has no score); of several lines for a term the
    last in ``order`` counts.
    """
    fields = F.split(java_trim(F.col(value)), "\t")
    number = java_trim(F.get("fields", F.lit(1)))
    return (
        lines.select(order, fields.alias("fields"))
        .where(F.size("fields") == 2)
        .select(order, java_trim(F.get("fields", F.lit(0))).alias("term"), number.alias("number"))
        .where(F.col("number").rlike(r"^[+-]?[0-9]+\z"))
        .select(order, "term", F.col("number").try_cast("int").alias("df"))
        .where(F.col("df").isNotNull())
        .groupBy("term")
        .agg(F.max_by("df", order).cast("long").alias("df"))
        .where(F.col("df") > 0)
    )


def read_df_table(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """A ``TERM<tab>DF`` file; order is position in the file, also across splits."""
    at = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id())
    return parse_df_table(spark.read.text(path).select("value", at.alias("pos")))


class LongList(NamedTuple):
    """A list known to be longer than ``LITERAL_LIMIT``."""

    frame: DataFrame


def settled(words: WordList) -> list[str] | LongList | None:
    """Find out once how long a list is: few words as a list, more as a :class:`LongList`.

    A DataFrame is looked at through ``limit``, so at most ``LITERAL_LIMIT + 1``
    words ever reach the driver.  A long list is stored, so that it is computed once.
    """
    if words is None or isinstance(words, LongList):
        return words
    if not isinstance(words, DataFrame):
        return sorted(set(words))
    distinct = words.select(F.col(words.columns[0]).alias("word")).distinct()
    rows = distinct.limit(LITERAL_LIMIT + 1).collect()
    if len(rows) <= LITERAL_LIMIT:
        return sorted(r.word for r in rows if r.word is not None)
    return LongList(kept(distinct.where(F.col("word").isNotNull())))


def literal_words(words: WordList) -> list[str] | None:
    """The words, sorted, if they are few enough for literals, else None; no list, no words."""
    found = settled(words)
    if found is None:
        return []
    return None if isinstance(found, LongList) or len(found) > LITERAL_LIMIT else found


def word_frame(spark: SparkSession, words: WordList) -> DataFrame:
    """The words as a DataFrame with the one column ``word``, no repeats."""
    if isinstance(words, LongList):
        return words.frame
    if isinstance(words, DataFrame):
        return words.select(F.col(words.columns[0]).alias("word")).distinct()
    return spark.createDataFrame([(w,) for w in sorted(set(words))], "word string")
