"""From records to word sequences: tokenise, then filter by word lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.functions.membership import membership
from wordloom.functions.tokens import only, tokens, without
from wordloom.session import kept as kept_frame
from wordloom.sources import lists
from wordloom.sources.lists import WordList, literal_words, settled, word_frame


def with_words(
    records: DataFrame,
    *,
    stopwords: WordList = None,
    vocabulary: WordList = None,
    text: str = "text",
    min_len: int = 3,
    case_sensitive: bool = False,
    distinct: bool = False,
) -> DataFrame:
    """Replace the text column by ``words``: tokens not stopped and, if given, in ``vocabulary``.

    Words keep their order and, unless ``distinct``, repeats; positions are
    those of the filtered list, and a record without words keeps its row.  Lists
    that fit into literals are applied inside the row, in the scan stage.  So are longer ones, by filters that
    are exact for the words of these records; to find their exceptions the records are read once more,
    and only words that may be listed are shuffled, once each.  The result is the same.
    """
    refuse(records, text, "words")
    stopwords, vocabulary = settled(stopwords), settled(vocabulary)
    kept = [c for c in records.columns if c != text]
    words = tokens(F.col(text), min_len=min_len, case_sensitive=case_sensitive)
    if distinct:
        words = F.array_distinct(words)
    out = records.select(*kept, words.alias("words"))
    if vocabulary is not None and None in (literal_words(vocabulary), literal_words(stopwords)):
        spark = records.sparkSession
        vocabulary = word_frame(spark, vocabulary).join(word_frame(spark, stopwords or []), "word", "left_anti")
        vocabulary, stopwords = settled(vocabulary), None
    stop = literal_words(stopwords)
    keep = None if vocabulary is None else literal_words(vocabulary)
    if keep is not None:
        return out.withColumn("words", only("words", set(keep) - set(stop or ())))
    if vocabulary is not None or stop is None:
        listed = word_frame(records.sparkSession, stopwords if vocabulary is None else vocabulary)
        found = membership(out, listed, lists.LITERAL_LIMIT, kept_frame)
        if found is not None:
            out = found.filtered(out, keep=vocabulary is not None)
        elif vocabulary is not None:
            out = _joined(out, None, listed)
        else:
            out = _joined(out, listed, None)
    return out.withColumn("words", without("words", stop)) if stop else out


def refuse(records: DataFrame, text: str, *names: str) -> None:
    """Key columns must not have the name of a column that the operator adds."""
    for c in records.columns:
        if c != text and (c in names or c.startswith("__")):
            raise ValueError(f"rename the key column {c!r}: the result has a column of that name")


def _joined(records: DataFrame, stop: DataFrame | None, keep: DataFrame | None) -> DataFrame:
    """Filter ``words`` by lists too long for a filter; the optimiser picks the joins by size.

    What is left of a word sequence depends on the sequence alone, so sequences
    are joined under their digest and come back to every record that has it: no
    record needs an id, and a task that runs again gives the same rows.  A record
    without any word left keeps its row.  A frequent word makes one large join
    key, which adaptive execution splits; equal sequences are put together
    before their shuffle.
    """
    kept = [c for c in records.columns if c != "words"]
    keyed = records.withColumn("__key", F.when(F.size("words") > 0, F.sha2(F.array_join("words", " "), 256)))
    rows = (
        keyed.where("__key IS NOT NULL")
        .select("__key", F.posexplode_outer("words").alias("__pos", "word"))
        .where(F.col("word").isNotNull())
    )
    if stop is not None:
        rows = rows.join(stop, "word", "left_anti")
    if keep is not None:
        rows = rows.join(keep, "word", "left_semi")
    left = rows.groupBy("__key").agg(F.sort_array(F.collect_set(F.struct("__pos", "word"))).alias("__seq"))
    none = F.when(F.col("words").isNotNull(), F.array().cast("array<string>"))
    return keyed.join(left, "__key", "left").select(*kept, F.coalesce("__seq.word", none).alias("words"))


def exploded_words(records: DataFrame, word: str = "word") -> DataFrame:
    """One row per word.  ``explode_outer``: a plain explode would tokenise every text twice."""
    kept = [c for c in records.columns if c != "words"]
    return records.select(*kept, F.explode_outer("words").alias(word)).where(
        F.col(word).isNotNull()
    )
