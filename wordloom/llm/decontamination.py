"""Wu-Manber search for windows of benchmark words in whole documents.

Texts become lower-case words with one space before, between and after them, so
that a window of words is a byte string.  A table over blocks of a few bytes
says how far a block can be from the end of any pattern's head; most places are
skipped by it.  Where the shift is zero, the block selects a bucket of patterns,
and these are compared directly.  Many places of a batch of documents are
searched side by side.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from wordloom.llm.common import slices, table, text_of, texts

WINDOW = 10
#: Benchmark text that one search holds; a larger benchmark is searched in blocks of this size.
BLOCK_BYTES = 8_000_000
#: Text searched at a time, about.
BATCH_BYTES = 8_000_000

_WORD = set(range(0x30, 0x3A)) | set(range(0x61, 0x7B)) | set(range(0x80, 0x100))
#: Lower-cases A-Z and blanks whatever is no word byte.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c in _WORD else 32 for c in range(256))


def words(raw: bytes) -> list[bytes]:
    return raw.translate(FOLD).split()


def windows(item: list[bytes], size: int = WINDOW) -> set[bytes]:
    """Spaced windows of an item; a shorter item is one window, one without words none."""
    if not item:
        return set()
    return {b" " + b" ".join(item[i : i + size]) + b" " for i in range(max(1, len(item) - size + 1))}


class WuManber:
    """Patterns of one class of lengths: shift table, suffix buckets, exact comparison."""

    def __init__(self, patterns: list[bytes], block: int, bits: int = 18):
        self.patterns, self.block, self.bits = patterns, block, bits
        self.head = min(map(len, patterns))
        self.longest = max(map(len, patterns))
        most = self.head - block + 1
        self.shift = np.full(1 << bits, most, np.int32)
        self.bucket: dict[int, list[bytes]] = defaultdict(list)
        heads = np.frombuffer(b"".join(p[: self.head] for p in patterns), np.uint8).reshape(len(patterns), self.head)
        for end in range(block, self.head + 1):
            codes = self.codes(heads[:, end - block : end])
            np.minimum.at(self.shift, codes, self.head - end)
        for p, code in zip(patterns, self.codes(heads[:, self.head - block :]).tolist(), strict=True):
            self.bucket[code].append(p)

    def codes(self, blocks: np.ndarray) -> np.ndarray:
        """Table positions of blocks, given as rows of bytes."""
        key = np.zeros(len(blocks), np.uint64)
        for j in range(self.block):
            key = (key << np.uint64(8)) | blocks[:, j].astype(np.uint64)
        return ((key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def candidates(self, text: np.ndarray, lane: int = 2048) -> np.ndarray:
        """Ends of pattern heads at which the shift is zero; every lane walks its own stretch of the text."""
        last = len(text) - self.head
        if last < 0:
            return np.empty(0, np.int64)
        start = np.arange(0, last + 1, lane, dtype=np.int64)
        at, stop = start + self.head, np.minimum(start + lane, last + 1) + self.head
        found, step = [], np.arange(-self.block, 0)
        while len(at):
            shift = self.shift[self.codes(text[at[:, None] + step])]
            zero = shift == 0
            if zero.any():
                found.append(at[zero])
            at = at + np.maximum(shift, 1)
            on = at < stop
            at, stop = at[on], stop[on]
        return np.sort(np.concatenate(found)) if found else np.empty(0, np.int64)

    def search(self, raw: bytes) -> Iterator[tuple[int, bytes]]:
        """(start, pattern) of every occurrence."""
        text = np.frombuffer(raw, np.uint8)
        ends = self.candidates(text)
        if len(ends):
            codes = self.codes(text[ends[:, None] + np.arange(-self.block, 0)])
            for end, code in zip(ends.tolist(), codes.tolist(), strict=True):
                for p in self.bucket.get(code, ()):
                    if raw.startswith(p, end - self.head):
                        yield end - self.head, p


def machines(patterns: list[bytes]) -> list[WuManber]:
    """One search for each class of pattern lengths, so that short patterns don't shorten the shifts of long ones."""
    classes = defaultdict(list)
    for p in patterns:
        size = len(p)
        classes[8 if size >= 40 else 5 if size >= 14 else 3].append(p)
    return [WuManber(found, block) for block, found in sorted(classes.items())]


def intervals(marks: np.ndarray) -> list[int]:
    """Flat list of starts and ends of the runs of true."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], marks.astype(np.int8), [0]])))
    return edge.tolist()


def searched(rows: DataFrame, items: list[tuple[str, bytes]], window: int, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Search every text for the windows of ``items`` and add what is found to ``hits`` and ``items``."""
    held = rows.sparkSession.sparkContext.broadcast(items)
    out = to_arrow_schema(rows.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owners = defaultdict(set)
        for name, raw in held.value:
            for w in windows(words(raw), window):
                owners[w].add(name)
        search = machines(list(owners))
        for batch in (part for whole in batches for part in slices(whole, "text", batch_bytes)):
            split = [words(raw) for raw in texts(batch)]
            joined = [b" " + b" ".join(x) + b" " for x in split]
            begin = np.cumsum([0] + [len(x) + 1 for x in joined])
            whole = b"\n".join(joined)
            by_doc = defaultdict(list)
            for machine in search:
                for s, p in machine.search(whole):
                    by_doc[int(np.searchsorted(begin, s, "right")) - 1].append((s, p))
            hits, names = batch.column("hits").to_pylist(), batch.column("items").to_pylist()
            for n, occurrences in by_doc.items():
                spaces = np.cumsum(np.frombuffer(joined[n], np.uint8) == 32)
                edge = np.zeros(len(split[n]) + 1, np.int64)
                found = set(names[n])
                for s, p in occurrences:
                    first = int(spaces[s - begin[n]]) - 1
                    edge[first] += 1
                    edge[first + p.count(b" ") - 1] -= 1
                    found |= owners[p]
                for a, b in zip(hits[n][::2], hits[n][1::2]):
                    edge[a] += 1
                    edge[b] -= 1
                hits[n], names[n] = intervals(np.cumsum(edge[:-1]) > 0), sorted(found)
            columns = [batch.column("row"), batch.column("text"), [len(x) for x in split], hits, names]
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, out)], schema=out
            )

    return rows.mapInArrow(run, rows.schema)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """``row``, the document as a struct, its words, the words hit as flat starts and ends, and the items that occur.

    The benchmark's size is measured; a task holds about ``block_bytes`` of it
    at most, and a larger benchmark is searched block by block, one after the
    other over the same rows.  About ``batch_bytes`` of text are searched at a time.  Null or empty texts have no words; null items and
    items without words never occur; rows with the same item_id are one item
    with the windows of all; repeated documents stay.  Nothing is shuffled.
    """
    listed = benchmark.select(benchmark[item].cast("string").alias("item"), benchmark[item_text].cast("string").alias("text"))
    listed = listed.where("item is not null and text is not null")
    size = listed.agg(F.sum(F.octet_length("text") + F.octet_length("item") + 16)).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    part = listed.withColumn("part", F.pmod(F.xxhash64("item", "text"), F.lit(blocks)))
    found = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        text_of(docs, text).alias("text"),
        F.lit(0).cast("long").alias("n_words"),
        F.expr("cast(array() as array<long>)").alias("hits"),
        F.expr("cast(array() as array<string>)").alias("items"),
    )
    for n in range(blocks):
        held = [(r.item, r.text.encode()) for r in part.where(F.col("part") == n).collect()]
        found = searched(found, sorted(held), window, batch_bytes)
    return found.drop("text")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document against every benchmark item."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    signed = F.transform("hits", lambda x, i: F.when(i % 2 == 0, -x).otherwise(x))
    return found.select(
        "row.doc_id",
        "n_words",
        F.aggregate(signed, F.lit(0).cast("long"), lambda a, x: a + x).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )
