"""Text forms of the results and the tab-separated sink."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pair_text(pairs: DataFrame) -> DataFrame:
    """``l`` and ``r`` as one string, ``(l,r)``, in column ``pair``."""
    kept = [c for c in pairs.columns if c not in ("l", "r", "n")]
    return pairs.select(*kept, F.format_string("(%s,%s)", "l", "r").alias("pair"), "n")


def stripe_text(stripes: DataFrame) -> DataFrame:
    """``stripe`` as ``{r1:n1, r2:n2}``, neighbours ascending, ``{}`` if there is none."""
    cells = F.transform(
        F.sort_array(F.map_entries("stripe")),
        lambda e: F.concat(e["key"], F.lit(":"), e["value"].cast("string")),
    )
    text = F.concat(F.lit("{"), F.array_join(cells, ", "), F.lit("}"))
    return stripes.withColumn("stripe", text)


def score_text(scores: DataFrame) -> DataFrame:
    """``score`` with four decimals, as text."""
    return scores.withColumn("score", F.format_string("%.4f", "score"))


def tsv_lines(df: DataFrame, out: str = "value") -> DataFrame:
    """The columns of each row as one tab-separated string; a null is an empty field."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
    return df.select(F.concat_ws("\t", *fields).alias(out))


def write_tsv(
    df: DataFrame,
    path: str,
    *order: str | Column,
    columns: list[str] | None = None,
    single_file: bool = False,
) -> None:
    """Write the columns tab-separated in the given order; an existing target is an error.

    The files of the target, taken by name, are in order as a whole.
    ``columns`` picks what is written, e.g. less than the order needs.
    ``single_file`` sorts and writes the finished rows in one task: for small
    results such as a top-k list or the matrix of a short vocabulary.
    """
    if single_file:
        # repartition, not coalesce: only the finished rows meet in one task
        ordered = df.repartition(1).sortWithinPartitions(*order) if order else df.repartition(1)
    else:
        ordered = df.orderBy(*order) if order else df
    tsv_lines(ordered.select(columns or df.columns)).write.mode("errorifexists").text(path)
