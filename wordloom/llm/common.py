"""Helpers the operators share: stored intermediate tables, Arrow batches, token ids."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a temporary one only in a local session without it."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        shared = sc.getConf().get("spark.checkpoint.dir")
        if shared is None and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="wordloom-llm-"))
    return sc.getCheckpointDir()


def stored(df: DataFrame) -> DataFrame:
    """``df`` computed once, as Parquet in the shared folder: a lost executor costs one task, not the lineage.

    The files go when the session's file system is closed.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return spark.read.schema(df.schema).parquet(path)


def text_of(docs: DataFrame, text: str) -> Column:
    """The text column as string; null counts as empty."""
    return F.coalesce(docs[text].cast("string"), F.lit(""))


def label_remainder(key: Column, modulus: int) -> Column:
    """The fold of a key: crc32 of its decimal text, modulo ``modulus``; a null key's fold is that of ''."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % modulus


def slices(batch: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    """The batch in parts of about ``most`` bytes of a column at most, a row at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy())
    at = 0
    while at < len(ends):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")))
        yield batch.slice(at, stop - at)
        at = stop


def arrow(
    df: DataFrame,
    make: Callable[[pa.RecordBatch], dict | None],
    schema: str,
    *,
    start: Callable | None = None,
    most_text: int | None = None,
) -> DataFrame:
    """``mapInArrow`` with a function from one batch to columns; ``start()`` gives state per task.

    ``most_text`` cuts batches by the bytes of their text column.
    """
    fields = df.sparkSession.createDataFrame([], schema).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    out = to_arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = () if start is None else (start(),)
        for batch in (b for x in batches for b in (slices(x, "text", most_text) if most_text else (x,))):
            if batch.num_rows and (found := make(*state, batch)) is not None:
                columns = [found[f.name] for f in out]
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, out)], schema=out
                )

    return df.mapInArrow(run, fields)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The UTF-8 bytes of a string column, null as empty."""
    return [b"" if x is None else x for x in batch.column(column).cast(pa.binary()).to_pylist()]


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def encoding(path: str):
    """A byte-level BPE encoder from a JSON vocabulary file, ids as in the file; its added tokens are special tokens."""
    import json

    import tiktoken

    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    model = file["model"]
    codes = {c: b for b, c in byte_characters().items()}
    ranks = {bytes(codes[c] for c in piece): i for piece, i in model["vocab"].items() if all(c in codes for c in piece)}
    special = [p for p, i in model["vocab"].items() if i >= 256 + len(model["merges"])]
    for piece in special:
        ranks.pop(piece.encode(), None)
    for token in file["added_tokens"]:
        if token["single_word"] or token["lstrip"] or token["rstrip"]:
            raise ValueError(f"added token {token['content']!r} takes or asks for what is around it")
        ranks.pop(token["content"].encode(), None)
    added = {token["content"]: token["id"] for token in file["added_tokens"]}
    return tiktoken.Encoding("file", pat_str=WORDS, mergeable_ranks=ranks, special_tokens=added)


def encoder(path: str) -> Callable[[str], list[int]]:
    """Ids as ``tokenizers`` gives them without special tokens around: an added token inside a text is its one id."""
    found = encoding(path)
    return lambda text: found.encode(text, allowed_special="all")


# fixed value: the word pattern of the byte-level vocabulary
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_characters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabulary files."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
