"""A corpus pipeline: quality rules, near duplicates, repeated passages, benchmark leaks, packing.

Every stage takes (session, documents, table folder) and is written as Parquet
before the next one reads it.  All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from wordloom.llm import decontamination, packing, quality_rules, simhash, suffix_dedup
from wordloom.llm.common import stored, table, tokenizer_file

#: Text that a task searches for benchmark words at a time, about; its words are Python objects of many times that.
SEARCH_BYTES = 2_000_000
#: No SQL expresses the learned rules, the fingerprints or the packing.
ORACLE_SQL = None


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rule nor a rule learned from the labels rejects."""
    rules = quality_rules.fit(docs, table(spark, sf_dir, "labels"))
    return quality_rules.judged(docs, rules).where("kept").select("row.*")


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every SimHash group the document with the least doc_id; a null id comes last.

    Rows get numbers in a stored table, so that of repeated rows one stays.
    """
    row = F.struct(*[docs[c] for c in docs.columns])
    numbered = stored(docs.select(F.monotonically_increasing_id().alias("id"), row.alias("row")))
    found = simhash.near_duplicates(numbered.select("id", "row.text"), key="id")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "id")
    first = (
        found.select(F.col("doc_id").alias("id"), "component_id")
        .join(numbered.select("id", "row.doc_id"), "id")
        .groupBy("component_id")
        .agg(F.min(order).alias("first"))
        .select(F.col("first.id").alias("id"))
    )
    return numbered.join(first, "id", "left_semi").select("row.*")


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts less the strings of 200 bytes or more that also stand elsewhere, cut at whole characters.

    A document may end up empty; it stays.  ``n_chars`` is counted anew; a null text stays null.
    Spans are stored before they are cut out: in one step each task would hold two
    Python workers, and Spark keeps them for the stages that follow.
    """
    found = stored(suffix_dedup.with_spans(docs)).select(F.col("row.text").alias("text"), "row", "spans")
    out = to_arrow_schema(found.schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = batch.column("text").to_pylist()
            for n, spans in enumerate(batch.column("spans").to_pylist()):
                if spans:
                    raw = kept[n].encode()
                    runs = suffix_dedup.whole_characters(raw, suffix_dedup.union(spans))
                    kept[n] = suffix_dedup.kept_bytes(raw, runs).decode()
            columns = [pa.array(kept, out[0].type), batch.column("row"), batch.column("spans")]
            yield pa.RecordBatch.from_arrays(columns, schema=out)

    done = found.mapInArrow(cut, found.schema)
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        counted = F.length("text").cast(dict(docs.dtypes)["n_chars"])
        new["n_chars"] = F.when(F.col("spans").isNotNull(), counted).otherwise(F.col("row.n_chars"))
    return done.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def not_in_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    found = decontamination.contamination(docs, table(spark, sf_dir, "benchmark"), batch_bytes=SEARCH_BYTES)
    return found.where(F.size("hits") == 0).select("row.*")


def in_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequence and place."""
    return packing.packed(packing.pieces(docs, tokenizer_file("byte_bpe_50k.json"), end_id=2))


STAGES = [
    ("quality rules", good_quality),
    ("simhash near-dedup", one_of_each),
    ("suffix-array dedup", without_repeats),
    ("benchmark decontamination", not_in_benchmark),
    ("best-fit packing", in_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each from the stored result of the one before."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
