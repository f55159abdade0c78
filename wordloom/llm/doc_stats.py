"""Statistics of whole texts, the inputs of quality rules and of the quality classifier."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from wordloom.llm.common import text_of, texts

COUNTS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_bytes",
    "n_lines",
    "n_upper",
    "n_digits",
    "n_exclaim",
    "n_stops",
    "n_distinct",
    "n_same",
    "longest_word",
)
WINDOW = 5
_SYMBOLS, _UPPER, _DIGITS = b"#*$%&|<>", bytes(range(65, 91)), bytes(range(48, 58))
_SPACE = b" \t\n\v\f\r"
_FOLLOWING = bytes(range(0x80, 0xC0))


def repeated_words(ids: np.ndarray, kinds: int, window: int = WINDOW) -> int:
    """How many words lie in a window of words that the text has twice or more."""
    n = len(ids) - window + 1
    if n < 2:
        return 0
    key, size = ids[:n].astype(np.uint64), kinds
    for k in range(1, window):
        if size * kinds >= 1 << 63:
            key = np.unique(key, return_inverse=True)[1].astype(np.uint64)
            size = int(key.max()) + 1
        key = key * np.uint64(kinds) + ids[k : n + k].astype(np.uint64)
        size *= kinds
    _, at, times = np.unique(key, return_inverse=True, return_counts=True)
    again = times[at] > 1
    if not again.any():
        return 0
    edge = np.zeros(len(ids) + 1, np.int64)
    starts = np.flatnonzero(again)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def without(raw: bytes, codes: bytes) -> int:
    return len(raw) - len(raw.translate(None, codes))


def counts(raw: bytes) -> tuple[int, ...]:
    """The counts named in ``COUNTS`` of one text; words are runs without ASCII white space."""
    words = raw.split()
    kinds: dict[bytes, int] = {}
    ids = np.fromiter((kinds.setdefault(w, len(kinds)) for w in words), np.int64, len(words))
    lines = raw.split(b"\n")
    with_words = [x for x in lines if x.strip(_SPACE)] if len(lines) > 1 else []
    return (
        len(words),
        len(raw) - without(raw, _SPACE + _FOLLOWING),
        without(raw, _SYMBOLS),
        len(with_words) - len(set(with_words)),
        repeated_words(ids, len(kinds)),
        len(raw),
        len(lines),
        without(raw, _UPPER),
        without(raw, _DIGITS),
        without(raw, b"!?"),
        without(raw, b".,"),
        len(kinds),
        int((ids[1:] == ids[:-1]).sum()),
        max(map(len, words), default=0),
    )


def doc_stats(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """``row``, the document as a struct, and the counts of its whole text.

    A null text is empty, repeated rows stay, and columns of any name fit into the struct.
    """
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), text_of(docs, text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = zip(*(counts(raw) for raw in texts(batch)))
                columns = [batch.column("row"), *(pa.array(c, pa.int64()) for c in found)]
                yield pa.RecordBatch.from_arrays(columns, names=["row", *COUNTS])

    schema = StructType([rows.schema["row"], *(StructField(c, LongType()) for c in COUNTS)])
    return rows.mapInArrow(run, schema)


def doc_counts(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and the counts."""
    return doc_stats(docs.select(docs[key].cast("long").alias("doc_id"), docs[text].alias("text")), text="text").select(
        "row.doc_id", *COUNTS
    )
