"""Document collections as DataFrames: one row is one record.

A record is what windows, document frequencies and term frequencies are counted
in: a whole document (``grain="doc"``) or one line of it (``grain="line"``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GRAINS = ("doc", "line")
LINE_END = r"\r\n|\r|\n"
_AFTER_LINE_END = r"(?<=\n)|(?<=\r)(?!\n)"


def _check_grain(grain: str) -> None:
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}, got {grain!r}")


def file_doc_id(path: Column) -> Column:
    """Document id of a file: its name without directory and without any ``.txt``."""
    return F.replace(F.substring_index(path, "/", -1), F.lit(".txt"), F.lit(""))


def _lines_of(text: Column) -> Column:
    """The lines of a text; a terminator ends a line, so none follows the last one."""
    n = F.length(text)
    unended = (
        F.when(F.endswith(text, F.lit("\r\n")), F.substring(text, 1, n - 2))
        .when(F.endswith(text, F.lit("\n")) | F.endswith(text, F.lit("\r")), F.substring(text, 1, n - 1))
        .otherwise(text)
    )
    return F.when(text != "", F.split(unended, LINE_END))


def _ended_lines(text: Column) -> Column:
    """The lines with their terminators."""
    return F.filter(F.split(text, _AFTER_LINE_END), lambda line: line != "")


def lines(docs: DataFrame, *, text: str = "text", max_line: int | None = None) -> DataFrame:
    """One row per line, with ``line_no`` from 0; the other columns are repeated.

    ``max_line`` skips lines whose bytes, terminator included, number that many
    or more; a last line without terminator has none to count.  ``line_no`` is
    the line's number in the whole text with or without the option.
    """
    kept = [c for c in docs.columns if c != text]
    parts = _lines_of(F.col(text)) if max_line is None else _ended_lines(F.col(text))
    exploded = docs.select(*kept, F.posexplode_outer(parts).alias("line_no", text))
    if max_line is None:
        return exploded.where(F.col("line_no").isNotNull())
    short = exploded.where(F.octet_length(text) < max_line)
    return short.withColumn(text, F.regexp_replace(text, f"(?:{LINE_END})$", ""))


def without_long_lines(docs: DataFrame, max_line: int, *, text: str = "text") -> DataFrame:
    """Whole documents again, less their lines of ``max_line`` bytes or more; the others are as they were."""
    kept = F.filter(_ended_lines(F.col(text)), lambda line: F.octet_length(line) < max_line)
    return docs.withColumn(text, F.array_join(kept, ""))


def records(
    docs: DataFrame, grain: str = "doc", *, text: str = "text", max_line: int | None = None
) -> DataFrame:
    """Bring a table of documents to the wanted grain."""
    _check_grain(grain)
    if grain == "line":
        return lines(docs, text=text, max_line=max_line)
    return docs if max_line is None else without_long_lines(docs, max_line, text=text)


def read_text(
    spark: SparkSession, path: str | list[str], grain: str = "doc", *, max_line: int | None = None
) -> DataFrame:
    """Text files, directories or globs as ``(doc_id, text)``.

    Line grain splits large files between tasks.  With ``max_line`` every file
    is read as a whole, since only then the ends of its lines are known; the
    lines, their numbers and their sizes are those of the same text in a table.
    """
    _check_grain(grain)
    raw = spark.read.text(path, wholetext=grain == "doc" or max_line is not None)
    out = raw.select(
        file_doc_id(F.col("_metadata.file_name")).alias("doc_id"), F.col("value").alias("text")
    )
    if max_line is None:
        return out
    return lines(out, max_line=max_line) if grain == "line" else without_long_lines(out, max_line)


def read_table(
    spark: SparkSession, path: str | list[str], *, keys: tuple[str, ...] = ("doc_id",), text: str = "text"
) -> DataFrame:
    """Key and text columns of a parquet table.  Tasks follow the files' row groups; no text is shuffled."""
    return spark.read.parquet(path).select(*keys, text)
