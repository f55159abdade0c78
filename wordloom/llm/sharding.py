"""Rendezvous hashing of stable record keys over weighted shards, in DataFrame expressions only.

Every (key, shard) pair has a hash of its own, read as an exponential waiting
time divided by the shard's weight; a record goes to the shard with the least.
A further shard can only take records, never move them between the others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wordloom.llm.common import table, text_of

LAW = "key"
#: Hash buckets of a shard in which slots are counted; the table of their sizes
#: has shards * BUCKETS rows, whatever the input.
BUCKETS = 256


def waiting_time(key: Column, shard: int, weight: float) -> Column:
    """The exponential waiting time of a key at a shard; null keys are one key."""
    drawn = F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 11)
    return -F.log((drawn + 0.5) / 2.0**53) / F.lit(float(weight))


def rendezvous(
    docs: DataFrame, weights: Sequence[float], *, key: str = "doc_id", shard: str = "shard", grown: str | None = None
) -> DataFrame:
    """Add the shard of each row, from 0, by its key and the weights alone.

    ``grown`` names a further column: the shard if one more of weight 1 joined.
    Equal waiting times go to the lower number; equal keys go together; a null
    key is a key like any other.  An empty table stays empty.  A column that
    has the name of a new one already is replaced.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive, one for each shard")
    own = docs[key].cast("string")
    best = F.array_min(
        F.array(*[F.struct(waiting_time(own, i, w).alias("t"), F.lit(i).alias("i")) for i, w in enumerate(weights)])
    )
    new = {shard: best.getField("i").cast("int")}
    if grown:
        more = waiting_time(own, len(weights), 1.0) < best.getField("t")
        new[grown] = F.when(more, len(weights)).otherwise(best.getField("i")).cast("int")
    return docs.withColumns(new)


def slots(assigned: DataFrame, *, shard: str = "shard", order: Sequence[str] = ("doc_id",), slot: str = "slot") -> DataFrame:
    """Number the rows of each shard from 0 without gaps.

    A shard's rows are dealt to hash buckets of ``order``; the bucket sizes,
    summed before any shuffle, give each bucket its first number, and rows are
    numbered inside buckets, so no task holds a whole shard.  Rows equal in
    ``order`` are interchangeable.
    """
    names = [c for c in assigned.columns if c != slot]
    dealt = assigned.select(
        F.struct(*[assigned[c] for c in names]).alias("row"),
        assigned[shard].alias("s"),
        F.pmod(F.xxhash64(*[assigned[c] for c in order]), F.lit(BUCKETS)).cast("int").alias("b"),
    )
    before = Window.partitionBy("s").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    first = (
        dealt.groupBy("s", "b")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("s", "b", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    )
    inside = Window.partitionBy("s", "b").orderBy(*[F.col("row").getField(c) for c in order])
    return (
        dealt.withColumn("n", F.row_number().over(inside))
        .join(F.broadcast(first), ["s", "b"])
        .select(*[F.col("row").getField(c).alias(c) for c in names], (F.col("first") + F.col("n") - 1).cast("long").alias(slot))
    )


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents over 40 equal shards by their doc_id, and over 41."""
    docs = table(spark, sf_dir, "documents")
    text = text_of(docs, "text")
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + F.lit(16)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        F.lit(LAW).alias("law"),
    )
    placed = rendezvous(rows, [1.0] * 40, grown="grown_shard")
    return slots(placed, order=("doc_id", "text_crc32", "size"))
