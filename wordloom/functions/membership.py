"""Exact membership in long word lists, tested inside the row.

A Bloom filter of the list is an aggregate: each word gives two bit places, and words
of 64 bits are put together with ``bit_or``, per task first.  Rows test their words
against it.  Of the corpus's different words only those that may be members are shuffled, and
joined with the list; the few that pass without being listed are exceptions, kept as
literals or in a filter of their own, whose exceptions are listed words, and so on.  Every level is
smaller by the rate of false hits, and the answer is exact for every word of the corpus.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.functions.tokens import sql_list

#: Bits of a filter for each word, and bits of the largest filter (4 MB).
BITS_A_WORD, MOST_BITS = 16, 1 << 25
#: Words a filter of the largest size is built for at most; one word in forty is a false hit there.
MOST_WORDS = MOST_BITS // 8


def filter_bits(words: DataFrame, size: int, level: int = 0) -> list[int]:
    """The filter's words of 64 bits, from a DataFrame with the column ``word``; ``size`` is a power of two.

    Levels hash differently: a false hit of one must not be likelier in the next.
    """
    code = f"xxhash64(word, {level})"
    places = words.selectExpr(f"explode_outer(array({code} & {size - 1}L, shiftright({code}, 32) & {size - 1}L)) AS p")
    held = places.groupBy(F.expr("cast(shiftright(p, 6) AS int)").alias("i"))
    rows = held.agg(F.expr("bit_or(shiftleft(1L, cast(p & 63 AS int)))").alias("b")).toArrow()
    out = [0] * (size // 64)
    for i, b in zip(rows.column("i").to_pylist(), rows.column("b").to_pylist(), strict=True):
        out[i] = b
    return out


def size_for(n: int) -> int:
    return min(MOST_BITS, max(64, 1 << (n * BITS_A_WORD - 1).bit_length()))


def hit(size: int, word: str = "w", level: int = 0) -> str:
    """SQL: both places of the word are set in the level's filter column."""
    bits, code = f"__bits{level}", f"xxhash64({word}, {level})"
    first, second = f"{code} & {size - 1}L", f"shiftright({code}, 32) & {size - 1}L"
    return " AND ".join(f"getbit(get({bits}, cast(shiftright({p}, 6) AS int)), cast({p} & 63 AS int)) = 1" for p in (first, second))


class Membership:
    """Filters of a list and of its exceptions, and the exceptions left as literals; ``levels`` are (bits, size)."""

    def __init__(self, levels: list[tuple[list[int], int]], rest: list[str]):
        self.levels, self.rest = levels, rest

    def attach(self, df: DataFrame) -> DataFrame:
        """The filters as columns: a scalar subquery of one row, which Spark hands to every task once."""
        for n, (bits, _) in enumerate(self.levels):
            row = pa.table({"bits": pa.array([bits], pa.list_(pa.int64()))})
            df = df.withColumn(f"__bits{n}", df.sparkSession.createDataFrame(row).scalar())
        return df

    def test(self, word: str = "w") -> str:
        """SQL: the word is in the list; for words of the corpus that the levels were made with."""
        listed = sql_list(self.rest)
        said = f"{word} IN ({listed})" if listed else "false"
        for n, (_, size) in reversed(list(enumerate(self.levels))):
            said = f"({hit(size, word, n)} AND NOT {said})"
        return said

    def filtered(self, records: DataFrame, keep: bool) -> DataFrame:
        """``words`` with listed words kept, or left out."""
        kept = [c for c in records.columns if c != "words"]
        chosen = F.expr(f"filter(words, w -> {'' if keep else 'NOT '}{self.test()})")
        return self.attach(records).select(*kept, chosen.alias("words"))


def membership(corpus: DataFrame, listed: DataFrame, limit: int, kept) -> Membership | None:
    """Levels for a list and the words of a corpus, or None for a list too long for a filter.

    ``corpus`` has arrays ``words``; ``listed`` one column ``word`` without repeats;
    ``limit`` is how many exceptions may be literals; ``kept`` stores a DataFrame that is used again.
    The corpus is read once here.  The driver gets filters of ``MOST_BITS`` bits and up to ``limit`` words.
    """
    n = listed.count()
    if n > MOST_WORDS:
        return None
    size = size_for(n)
    levels = [(filter_bits(listed, size), size)]
    may = Membership(levels, []).attach(corpus.select(F.array_distinct("words").alias("words")))
    passed = may.select(F.explode_outer(F.expr(f"filter(words, w -> {hit(size)})")).alias("word"))
    others = kept(passed.where("word IS NOT NULL").distinct().join(listed, "word", "left_anti"))
    # words of one side that the last filter lets pass are the next level
    near, far, counts = others, listed, [float("inf")] * 2
    while len(rest := near.limit(limit + 1).collect()) > limit:
        n = near.count()
        if n > MOST_WORDS or n >= counts[-2]:
            return None
        counts.append(n)
        size = size_for(n)
        levels.append((filter_bits(near, size, len(levels)), size))
        passed = Membership(levels, []).attach(far).where(hit(size, "word", len(levels) - 1))
        near, far = kept(passed.select("word")), near
    return Membership(levels, [r.word for r in rest])
