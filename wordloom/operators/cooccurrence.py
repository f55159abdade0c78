"""Windowed word co-occurrence, as pairs and as stripes.

Two words of a record co-occur when their positions differ by 1 to ``distance``
after stop words and words outside the vocabulary are gone.  The matrix holds
both (a, b) and (b, a); a word next to itself counts twice.

Every job computes half of the matrix, ``l <= r``, sums it with one shuffle
whose rows are already summed per task, and mirrors the small result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from wordloom.functions.pairs import record_cells
from wordloom.operators.words import refuse, with_words
from wordloom.sources.lists import WordList

#: Rows, or cells of stripes, in one batch of a per-record matrix.
ROWS_OUT = 100_000
#: Words of the records that are counted together; a longer record is counted alone.
WORDS_IN = 1 << 18

# Words zipped with the words ``lag`` positions on: fields `0` and `1`.  At lag 0
# the second field is null.
_ZIPPED = """
arrays_zip(slice(words, 1, size(words) - lag),
           slice(words, lag + 1, CASE WHEN lag = 0 THEN 0 ELSE size(words) END))"""
_LESSER = "least(p.`0`, p.`1`)"
_GREATER = "CASE WHEN p.`1` IS NOT NULL THEN greatest(p.`0`, p.`1`) END"


def _lags(distance: int, lone: bool) -> str:
    """SQL array of the lags 1..distance a record is long enough for.

    Lag 0 stands for words without a neighbour, emitted only if ``lone``.
    """
    alone = "CASE WHEN size(words) > 0 THEN array(0) END" if lone else "CAST(NULL AS ARRAY<INT>)"
    if distance < 1:
        return alone
    some = f"sequence(1, least({distance}, size(words) - 1))"
    return f"CASE WHEN size(words) > 1 THEN {some} ELSE {alone} END"


def _half_pairs(words: DataFrame, distance: int, lone: bool = False) -> DataFrame:
    """``(lag, l, r)``, one row per neighbouring pair, ``l <= r``; a lone word has ``r`` null.

    One lag at a time: a record then never needs more memory than its words,
    however large the distance.
    """
    return (
        words.selectExpr("words", f"explode_outer({_lags(distance, lone)}) AS lag")
        .selectExpr("lag", f"explode_outer({_ZIPPED}) AS p")
        .where("p IS NOT NULL")
        .selectExpr("lag", f"{_LESSER} AS l", f"{_GREATER} AS r")
    )


def _mirror(half: DataFrame) -> DataFrame:
    """Both triangles from one: ``(l, r, n)`` and ``(r, l, n)``, diagonal doubled."""
    kept = [c for c in half.columns if c not in ("l", "r", "n")]
    both = """
    CASE WHEN r IS NULL THEN array(struct(l, r, n))
         WHEN l = r THEN array(struct(l, r, n * 2 AS n))
         ELSE array(struct(l, r, n), struct(r AS l, l AS r, n)) END"""
    mirrored = half.select(*kept, F.expr(f"explode_outer({both})").alias("__p"))
    return mirrored.select(*kept, "__p.l", "__p.r", "__p.n")


def _summed(half: DataFrame) -> DataFrame:
    return half.groupBy("l", "r").agg(F.count("*").alias("n"))


def pairs(
    records: DataFrame,
    vocabulary: WordList,
    distance: int = 1,
    *,
    stopwords: WordList = None,
    text: str = "text",
    min_len: int = 3,
) -> DataFrame:
    """Matrix as rows ``(l, r, n)``; ``vocabulary=None`` takes every word."""
    words = with_words(
        records.select(text), stopwords=stopwords, vocabulary=vocabulary, text=text, min_len=min_len
    )
    return _mirror(_summed(_half_pairs(words, distance)))


def pairs_intervals(
    records: DataFrame,
    vocabulary: WordList,
    max_distance: int = 4,
    *,
    stopwords: WordList = None,
    text: str = "text",
    min_len: int = 3,
) -> DataFrame:
    """``(l, r, from, to, n)``: the count of a pair at every distance from ``from`` to ``to``, both included.

    A pair has a row for each lag it occurs at, however large ``max_distance`` is; the last ends there.
    Pairs are counted by lag in one pass over the corpus, and the counts accumulated over the distances in
    the small matrix, so the plan is the same for every ``max_distance``.
    """
    words = with_words(
        records.select(text), stopwords=stopwords, vocabulary=vocabulary, text=text, min_len=min_len
    )
    by_lag = _half_pairs(words, max_distance).groupBy("l", "r", "lag").agg(F.count("*").alias("n"))
    nearer = Window.partitionBy("l", "r").orderBy("lag")
    # n holds from this lag's distance to the one before the pair's next lag
    steps = by_lag.select(
        "l",
        "r",
        F.col("lag").cast("long").alias("from"),
        (F.coalesce(F.lead("lag").over(nearer), F.lit(max(max_distance, 1) + 1)) - 1).cast("long").alias("to"),
        F.sum("n").over(nearer).alias("n"),
    )
    return _mirror(steps).select("l", "r", "from", "to", "n")


def pairs_sweep(
    records: DataFrame,
    vocabulary: WordList,
    max_distance: int = 4,
    *,
    distances: list[int] | None = None,
    stopwords: WordList = None,
    text: str = "text",
    min_len: int = 3,
) -> DataFrame:
    """``(d, l, r, n)`` for every distance 1..max_distance, or for ``distances`` among them, from one pass over the corpus."""
    steps = pairs_intervals(records, vocabulary, max_distance, stopwords=stopwords, text=text, min_len=min_len)
    every = "sequence(`from`, `to`)"
    if distances is not None:
        asked = ", ".join(f"{int(d)}L" for d in sorted(set(distances)))
        every = f"filter(array({asked}), d -> d BETWEEN `from` AND `to`)" if asked else "CAST(array() AS ARRAY<BIGINT>)"
    return steps.select(F.explode_outer(F.expr(every)).alias("d"), "l", "r", "n").where("d IS NOT NULL")


def stripes_sweep(
    records: DataFrame,
    vocabulary: WordList,
    max_distance: int = 4,
    *,
    stopwords: WordList = None,
    text: str = "text",
    min_len: int = 3,
) -> DataFrame:
    """``(d, word, stripe)`` for every distance 1..max_distance from one pass over the corpus."""
    cells = pairs_sweep(records, vocabulary, max_distance, stopwords=stopwords, text=text, min_len=min_len)
    return _striped(cells, "d")


def pairs_by_record(
    records: DataFrame,
    vocabulary: WordList,
    distance: int = 1,
    *,
    stopwords: WordList = None,
    text: str = "text",
    min_len: int = 3,
) -> DataFrame:
    """``(<record columns>, l, r, n)``: the matrix of each record, without any shuffle.

    Counted in the tasks that read the records, in memory for a bounded number of words and
    pairs, or for the words of one longer record; neither the distance nor the size of the matrix counts.
    """
    refuse(records, text, "l", "r", "n")
    words = with_words(
        records, stopwords=stopwords, vocabulary=vocabulary, text=text, min_len=min_len
    )
    kept = [c for c in words.columns if c != "words"]
    schema = _with_fields(words, kept, "l string, r string, n long")
    out = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, spelled, rec, l, r, n in _record_counts(batches, distance, False):
            for at in range(0, len(rec), ROWS_OUT):
                cut = slice(at, at + ROWS_OUT)
                more = [spelled.take(pa.array(l[cut])), spelled.take(pa.array(r[cut])), pa.array(n[cut])]
                yield _rows(batch, kept, rec[cut], more, out)

    return words.select(*kept, "words").mapInArrow(run, schema)


def _record_counts(
    batches: Iterator[pa.RecordBatch], distance: int, lone: bool
) -> Iterator[tuple[pa.RecordBatch, pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Records with their words in order, and record, left word, right word and count of their pairs, piece by piece."""
    for whole in batches:
        ends = np.cumsum(pc.fill_null(pc.list_value_length(whole.column("words")), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < len(ends):
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + WORDS_IN, "right")))
            batch, at = whole.slice(at, stop - at), stop
            lists = batch.column("words")
            flat = lists.flatten().dictionary_encode()
            if not len(flat):
                continue
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            order = np.argsort(np.array(flat.dictionary.to_pylist(), dtype=object), kind="stable")
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            words = rank[flat.indices.to_numpy(zero_copy_only=False)]
            spelled = flat.dictionary.take(pa.array(order))
            for cells in record_cells(words, sizes, len(order), distance, lone):
                yield batch, spelled, *cells


def _rows(batch: pa.RecordBatch, kept: list[str], at: np.ndarray, more: list[pa.Array], out: pa.Schema) -> pa.RecordBatch:
    columns = [*(batch.column(c).take(pa.array(at)) for c in kept), *more]
    return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, out, strict=True)], schema=out)


def _with_fields(words: DataFrame, kept: list[str], fields: str) -> StructType:
    return StructType([*(words.schema[c] for c in kept), *StructType.fromDDL(fields).fields])


def roll_up(by_record: DataFrame) -> DataFrame:
    """Sum per-record matrices; equals :func:`pairs`."""
    return by_record.groupBy("l", "r").agg(F.sum("n").alias("n"))


def stripes(
    records: DataFrame,
    vocabulary: WordList,
    distance: int = 1,
    *,
    stopwords: WordList = None,
    keep_isolated: bool = False,
    parts: int = 1,
    text: str = "text",
    min_len: int = 3,
) -> DataFrame:
    """Matrix as ``(word, stripe)``, ``stripe`` a map neighbour -> count in neighbour order.

    ``keep_isolated`` adds words of the vocabulary that occur but never have a
    neighbour, with an empty map.  They come out of the same pass.

    A stripe is one row and as long as the vocabulary at most.  Where that is too
    long, also for ``vocabulary=None``, ``parts`` above 1 cuts every stripe by
    its neighbours' hash into rows ``(part, word, stripe)``, parts from 0; an empty map is in part 0.
    """
    words = with_words(
        records.select(text), stopwords=stopwords, vocabulary=vocabulary, text=text, min_len=min_len
    )
    cells = _mirror(_summed(_half_pairs(words, distance, lone=keep_isolated)))
    return _striped(cells) if parts == 1 else _striped(_in_parts(cells, parts), "part")


def _in_parts(cells: DataFrame, parts: int) -> DataFrame:
    if parts < 1:
        raise ValueError("parts must be at least 1")
    return cells.withColumn("part", F.when(F.col("r").isNull(), 0).otherwise(F.pmod(F.xxhash64("r"), F.lit(parts))).cast("int"))


def stripes_by_record(
    records: DataFrame,
    vocabulary: WordList,
    distance: int = 1,
    *,
    stopwords: WordList = None,
    keep_isolated: bool = True,
    text: str = "text",
    min_len: int = 3,
) -> DataFrame:
    """``(<record columns>, word, stripe)``: the stripes of each record, without any shuffle."""
    refuse(records, text, "word", "stripe", "l", "r", "n")
    words = with_words(
        records, stopwords=stopwords, vocabulary=vocabulary, text=text, min_len=min_len
    )
    kept = [c for c in words.columns if c != "words"]
    schema = _with_fields(words, kept, "word string, stripe map<string,bigint>")
    out = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, spelled, rec, l, r, n in _record_counts(batches, distance, keep_isolated):
            starts = np.concatenate([[0], np.flatnonzero((np.diff(rec) != 0) | (np.diff(l) != 0)) + 1])
            if not len(rec):
                continue
            # whole stripes, together of about ROWS_OUT cells
            cuts = np.unique(np.searchsorted(starts, np.arange(0, len(rec), ROWS_OUT)))
            for a, b in zip(cuts, [*cuts[1:], len(starts)]):
                first = starts[a:b]
                cells = slice(first[0], starts[b] if b < len(starts) else len(rec))
                held = np.flatnonzero(r[cells] >= 0) + first[0]
                offsets = np.searchsorted(held, [*first, cells.stop]).astype(np.int32)
                maps = pa.MapArray.from_arrays(pa.array(offsets), spelled.take(pa.array(r[held])), pa.array(n[held]))
                yield _rows(batch, kept, rec[first], [spelled.take(pa.array(l[first])), maps], out)

    return words.select(*kept, "words").mapInArrow(run, schema)


def merge_stripes(by_record: DataFrame, *, parts: int = 1) -> DataFrame:
    """Sum per-record stripes, or stripes in parts; equals :func:`stripes` with the same isolated words.

    Entries are summed one by one, so a frequent word's stripes are never
    gathered in one place before they are small.
    """
    half = by_record.selectExpr("word AS l", "explode_outer(stripe) AS (r, n)")
    cells = half.groupBy("l", "r").agg(F.sum("n").alias("n"))
    return _striped(cells) if parts == 1 else _striped(_in_parts(cells, parts), "part")


def _striped(matrix: DataFrame, *keys: str) -> DataFrame:
    """Gather ``(l, r, n)`` rows by ``l`` and the keys; a row with ``r`` null only keeps its word."""
    entry = F.expr("CASE WHEN r IS NOT NULL THEN struct(r, n) END")
    return (
        matrix.groupBy(*keys, "l")
        .agg(F.sort_array(F.collect_list(entry)).alias("entries"))
        .select(*keys, F.col("l").alias("word"), F.map_from_entries("entries").alias("stripe"))
    )


def stripes_to_pairs(striped: DataFrame) -> DataFrame:
    """``(l, r, n)`` back from stripes, whole or in parts."""
    return striped.select(
        F.col("word").alias("l"), F.explode_outer("stripe").alias("r", "n")
    ).where(F.col("r").isNotNull())
