"""Counting inside a row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_runs(df: DataFrame, values: str, out: str) -> DataFrame:
    """Add ``out``: ``array<struct<value, n>>``, the distinct values of an array and their counts.

    Sorts the array of each row and measures its runs, so a per-record count
    costs no shuffle and n log n time per record.  ``values`` is consumed.
    Each step is a projection of its own: an array that several expressions
    use is then computed once.
    """
    kept = [c for c in df.columns if c != values]
    runs = df.select(*kept, F.sort_array(values).alias("__sorted")).withColumn(
        "__starts",
        F.expr(
            "filter(transform(__sorted, (v, i) -> "
            "CASE WHEN i = 0 OR get(__sorted, i - 1) != v THEN i END), i -> i IS NOT NULL)"
        ),
    )
    return runs.select(
        *kept,
        F.expr(
            "transform(__starts, (at, j) -> named_struct('value', get(__sorted, at), 'n', "
            "CAST(coalesce(get(__starts, j + 1), size(__sorted)) - at AS BIGINT)))"
        ).alias(out),
    )
