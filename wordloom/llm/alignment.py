"""Alignment of two tokenizers' tokens over the same bytes, by products of sparse incidence matrices.

The rows of an incidence matrix are tokens and its columns bytes.  The product of one
tokenizer's matrix with the transposed matrix of the other holds the bytes that two
tokens share: the overlap links.  Where consecutive links have no token in common, both
tokenizers end a token, and a group of tokens ends.  The matrices of token ids and groups are multiplied the
same way: the product holds how many occurrences of two ids share a group, summed
without listing them.

Matrices are compressed sparse rows in numpy, products are Gustavson's: a row of the
product is the sum of the second matrix's rows that the first matrix's row selects.  Documents are stacked, so that one
product serves a batch of them.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from wordloom.llm.common import byte_characters, encoding, slices, stored, table, tokenizer_file

#: Text of one product, about; a longer document is one product of its own.
BATCH_BYTES = 1 << 20
#: Text whose documents meet the corpus-wide counts together; a longer document meets them alone.
CHUNK_BYTES = 1 << 22
#: Bytes whose tokens are multiplied at a time, and products that are summed at a time.
WINDOW_BYTES, STEP = 1 << 22, 1 << 22
#: White space that the fast encoder's pattern does not survive; such texts take the slow one.
LONG_SPACE = re.compile(r"\s{10000}")


@dataclass
class Csr:
    """Compressed sparse rows: row r has the columns ``indices[indptr[r] : indptr[r + 1]]`` with their values."""

    indptr: np.ndarray
    indices: np.ndarray
    data: np.ndarray
    columns: int

    @classmethod
    def of(cls, rows: np.ndarray, columns: np.ndarray, data: np.ndarray, shape: tuple[int, int]) -> Csr:
        """From entries in any order; entries of one place are summed."""
        if len(rows) > 1:
            code = rows.astype(np.int64) * max(1, shape[1]) + columns
            order = np.argsort(code, kind="stable")
            code = code[order]
            first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
            rows, columns, data = rows[order][first], columns[order][first], np.add.reduceat(data[order], first)
        indptr = np.zeros(shape[0] + 1, np.int64)
        np.cumsum(np.bincount(rows, minlength=shape[0]), out=indptr[1:])
        return cls(indptr, columns.astype(np.int64), data, shape[1])

    def rows(self) -> np.ndarray:
        """The row of each entry."""
        return np.repeat(np.arange(len(self.indptr) - 1), np.diff(self.indptr))

    def transposed(self) -> Csr:
        order = np.argsort(self.indices, kind="stable")
        indptr = np.zeros(self.columns + 1, np.int64)
        np.cumsum(np.bincount(self.indices, minlength=self.columns), out=indptr[1:])
        return Csr(indptr, self.rows()[order], self.data[order], len(self.indptr) - 1)

    def __matmul__(self, other: Csr) -> Csr:
        """Gustavson's product, over blocks of rows of a bounded number of products, a row at least."""
        each = np.diff(other.indptr)[self.indices]
        before = np.concatenate([[0], np.cumsum(each)])
        done = before[self.indptr]
        parts, height, row = [], len(self.indptr) - 1, 0
        while row < height:
            stop = max(row + 1, int(np.searchsorted(done, done[row] + STEP, "right")) - 1)
            lo, hi = self.indptr[row], self.indptr[stop]
            taken = np.repeat(np.arange(lo, hi), each[lo:hi])
            place = other.indptr[self.indices[taken]] + np.arange(len(taken)) - (before[taken] - before[lo])
            rows = np.repeat(np.arange(stop - row), done[row + 1 : stop + 1] - done[row:stop])
            parts.append(Csr.of(rows, other.indices[place], self.data[taken] * other.data[place], (stop - row, other.columns)))
            row = stop
        if len(parts) == 1:
            return parts[0]
        if not parts:
            return Csr(np.zeros(1, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), other.columns)
        counts = np.concatenate([np.diff(p.indptr) for p in parts])
        indptr = np.concatenate([[0], np.cumsum(counts)])
        return Csr(indptr, np.concatenate([p.indices for p in parts]), np.concatenate([p.data for p in parts]), other.columns)


def incidence(lengths: np.ndarray, start: int, stop: int) -> tuple[int, Csr]:
    """Tokens by bytes, of the tokens with bytes in [start, stop): (first token, matrix of the bytes there)."""
    ends = np.cumsum(lengths)
    first, last = int(np.searchsorted(ends, start, "right")), int(np.searchsorted(ends, stop, "left"))
    inside = np.clip(ends[first : last + 1], start, stop) - start
    indptr = np.concatenate([[0], inside])
    return first, Csr(indptr, np.arange(stop - start), np.ones(stop - start, np.int64), stop - start)


def overlaps(a: np.ndarray, b: np.ndarray, window: int = WINDOW_BYTES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links (token of a, token of b, bytes shared) in order, from the lengths of tokens over the same bytes."""
    total, found = int(a.sum()), []
    for start in range(0, total, window):
        stop = min(total, start + window)
        (i, left), (j, right) = incidence(a, start, stop), incidence(b, start, stop)
        shared = left @ right.transposed()
        found.append((shared.rows() + i, shared.indices + j, shared.data))
    if not found:
        return tuple(np.empty(0, np.int64) for _ in range(3))
    if len(found) == 1:
        return found[0]
    rows, columns, data = (np.concatenate(x) for x in zip(*found, strict=True))
    # a pair cut by a window's edge stands last in one window and first in the next
    first = np.flatnonzero(np.concatenate([[True], (rows[1:] != rows[:-1]) | (columns[1:] != columns[:-1])]))
    return rows[first], columns[first], np.add.reduceat(data, first)


@dataclass
class Vocabulary:
    """A tokenizer: ids of texts, and the bytes each id stands for."""

    encode: Callable[[list[str]], list]
    pieces: pa.Array

    def __post_init__(self):
        self.lengths = np.diff(np.frombuffer(self.pieces.buffers()[1], np.int32)[: len(self.pieces) + 1]).astype(np.int64)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of tokens one after the other."""
        found = self.pieces.take(pa.array(ids))
        return np.frombuffer(found.buffers()[2] or b"", np.uint8)[: int(self.lengths[ids].sum())]


@lru_cache(maxsize=2)
def byte_level(path: str) -> Vocabulary:
    """A byte-level vocabulary file; the strings of its special tokens are ordinary text, and a space is put before each text."""
    import json

    from tokenizers import Tokenizer

    codes = {c: b for b, c in byte_characters().items()}
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    names = {i: p for p, i in file["model"]["vocab"].items()} | {t["id"]: t["content"] for t in file["added_tokens"]}
    raw = [bytes(codes[c] for c in names[i]) if all(c in codes for c in names.get(i, "")) and i in names else b"" for i in range(max(names) + 1)]
    fast = encoding(path)

    @lru_cache(maxsize=1)
    def slow():
        found = Tokenizer.from_file(path)
        found.encode_special_tokens = True
        return found

    def encode(texts: list[str]) -> list:
        spaced = [" " + t for t in texts]
        return [
            slow().encode(t, add_special_tokens=False).ids if LONG_SPACE.search(t) else fast.encode_to_numpy(t, disallowed_special=())
            for t in spaced
        ]

    return Vocabulary(encode, pa.array(raw, pa.binary()))


@lru_cache(maxsize=2)
def pieces(path: str) -> Vocabulary:
    """A sentencepiece model that puts a space before each text."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    raw = [
        bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode()
        for i in range(model.vocab_size())
    ]
    return Vocabulary(lambda texts: model.encode(texts, num_threads=1), pa.array(raw, pa.binary()))


def _flat(lists: list) -> tuple[np.ndarray, np.ndarray]:
    """All ids, and where each document's begin and end."""
    ends = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
    if lists and all(isinstance(x, np.ndarray) for x in lists):
        return np.concatenate(lists).astype(np.int64), ends
    return np.fromiter(chain.from_iterable(lists), np.int64, int(ends[-1])), ends


def _per_document(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(values)])
    return sums[ends[1:]] - sums[ends[:-1]]


class Aligned:
    """Tokens, groups and links of a batch of texts; texts that do not come back from both tokenizers have no tokens."""

    def __init__(self, texts: list[str | None], a: Vocabulary, b: Vocabulary):
        self.a, self.b, self.size = a, b, len(texts)
        raw = [b" " + t.encode() if t else b"" for t in texts]
        known = np.array([i for i, t in enumerate(texts) if t], np.int64)
        said = [texts[i] for i in known]
        ids_a, ends_a = _flat(a.encode(said))
        ids_b, ends_b = _flat(b.encode(said))
        wanted = np.array([len(raw[i]) for i in known], np.int64)
        same = (_per_document(a.lengths[ids_a], ends_a) == wanted) & (_per_document(b.lengths[ids_b], ends_b) == wanted)
        while True:
            (kept_a, stop_a), (kept_b, stop_b) = (self._kept(i, e, same) for i, e in ((ids_a, ends_a), (ids_b, ends_b)))
            whole = np.frombuffer(b"".join(raw[i] for i in known[same]), np.uint8)
            wrong = np.flatnonzero((a.joined(kept_a) != whole) | (b.joined(kept_b) != whole))
            if not len(wrong):
                break
            same[np.flatnonzero(same)[np.unique(np.searchsorted(np.cumsum(wanted[same]), wrong, "right"))]] = False
        #: The document of each text that has tokens.
        self.document = known[same]
        self.ids_a, self.ids_b, self.ends_a, self.ends_b = kept_a, kept_b, stop_a, stop_b
        self.links = overlaps(a.lengths[kept_a], b.lengths[kept_b])
        i, j, _ = self.links
        new = np.concatenate([[True], (i[1:] != i[:-1]) & (j[1:] != j[:-1])]) if len(i) else np.empty(0, bool)
        group = np.cumsum(new) - 1
        self.groups = int(new.sum())
        self.group_a, self.group_b = np.empty(len(kept_a), np.int64), np.empty(len(kept_b), np.int64)
        self.group_a[i], self.group_b[j] = group, group

    @staticmethod
    def _kept(ids: np.ndarray, ends: np.ndarray, same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        counts = np.diff(ends)
        return ids[np.repeat(same, counts)], np.concatenate([[0], np.cumsum(counts[same])])

    def spread(self, values: np.ndarray, kind=np.int64) -> np.ndarray:
        """Values of the documents with tokens, zero for the others."""
        out = np.zeros(self.size, kind)
        out[self.document] = values
        return out

    def group_counts(self) -> np.ndarray:
        first = self.group_a[np.minimum(self.ends_a, max(0, len(self.group_a) - 1))] if len(self.group_a) else self.ends_a
        first = np.where(self.ends_a == len(self.group_a), self.groups, first)
        return np.diff(first)

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Shared-group links by ids: (place of the document, id of a, id of b, number of links), by document and ids."""
        wide = len(self.a.lengths)
        document = np.repeat(np.arange(len(self.document)), np.diff(self.ends_a))
        code, row = np.unique(document * wide + self.ids_a, return_inverse=True)
        left = Csr.of(row, self.group_a, np.ones(len(row), np.int64), (len(code), self.groups))
        right = Csr.of(self.group_b, self.ids_b, np.ones(len(self.ids_b), np.int64), (self.groups, len(self.b.lengths)))
        shared = left @ right
        code = code[shared.rows()]
        return code // wide, code % wide, shared.indices, shared.data

    def forms(self) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` of each document with tokens."""
        strings, wide_a, wide_b = _numbers(len(self.a.lengths), len(self.b.lengths))
        last_a = np.concatenate([self.group_a[1:] != self.group_a[:-1], [True]]) if len(self.group_a) else np.empty(0, bool)
        last_b = np.concatenate([self.group_b[1:] != self.group_b[:-1], [True]]) if len(self.group_b) else np.empty(0, bool)
        ends_b = np.zeros(len(self.ids_b), bool)
        ends_b[self.ends_b[1:] - 1] = True
        groups = np.arange(self.groups)
        before_b, through_a = np.searchsorted(self.group_b, groups, "left"), np.searchsorted(self.group_a, groups, "right")
        order = np.empty(len(self.ids_a) + len(self.ids_b), np.int64)
        order[np.arange(len(self.ids_a)) + before_b[self.group_a]] = self.ids_a + wide_a * last_a
        order[np.arange(len(self.ids_b)) + through_a[self.group_b]] = 2 * wide_a + self.ids_b + wide_b * (last_b + ends_b.astype(np.int64))
        text = strings.take(pa.array(order))
        ends = np.frombuffer(text.buffers()[1], np.int64)[: len(order) + 1][self.ends_a + self.ends_b].tolist()
        raw = text.buffers()[2]
        view = memoryview(raw) if raw is not None else memoryview(b"")
        return [bytes(view[s:e]) for s, e in zip(ends[:-1], ends[1:], strict=True)]


@lru_cache(maxsize=2)
def _numbers(wide_a: int, wide_b: int) -> tuple[pa.Array, int, int]:
    """Decimal ids with what may follow them: of a ``,`` or ``|``, of b ``,`` or ``;`` or nothing."""
    made = [f"{i}{end}" for wide, ends in ((wide_a, ",|"), (wide_b, (",", ";", ""))) for end in ends for i in range(wide)]
    return pa.array(made, pa.large_string()), wide_a, wide_b


def batches_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from slices(batch, "text", BATCH_BYTES)


def links(docs: DataFrame, a: str, b: str, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The overlap links of every document: key, places, ids, first byte (that of the space put before is 0), bytes shared, and group, one row a link.

    ``a`` is the path of a byte-level vocabulary file, ``b`` of a sentencepiece model.  Null and
    empty texts, and texts that a tokenizer changes, have no links.
    """
    given = docs.select(docs[key].alias(key), docs[text].cast("string").alias("text"))
    out = given.select(key).schema
    for name in ("a_place", "b_place", "a_id", "b_id", "start", "n_bytes", "group"):
        out = out.add(name, "long")
    schema = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right = byte_level(a), pieces(b)
        for batch in batches_of(batches):
            found = Aligned(batch.column("text").to_pylist(), left, right)
            i, j, shared = found.links
            place = np.searchsorted(found.ends_a, i, "right") - 1
            first = np.cumsum(shared) - shared
            base = first[np.searchsorted(i, found.ends_a[:-1])]
            groups = found.group_a[found.ends_a[:-1]]
            columns = [
                batch.column(key).take(pa.array(found.document[place])),
                i - found.ends_a[place], j - found.ends_b[place], found.ids_a[i], found.ids_b[j],
                first - base[place], shared, found.group_a[i] - groups[place],
            ]
            for s in range(0, len(i), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(c[s : s + (1 << 16)], f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return given.mapInArrow(run, out)


def _packed(codes: np.ndarray, counts: np.ndarray) -> bytes:
    """Rising codes and their counts, compressed."""
    return zstandard.ZstdCompressor(1).compress(np.concatenate([np.diff(codes, prepend=0), counts]).astype("<i8").tobytes())


def _unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), "<i8").reshape(2, -1)
    return np.cumsum(both[0]), both[1]


def alignments(docs: DataFrame, a: str, b: str, *, key: str = "doc_id", text: str = "text", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Of every document: key, tokens of a and b, groups, links, the groups' digest, and how common its links' id pairs are.

    A pair of ids is counted once for each document that links it, over the whole corpus.
    ``n_best`` are the links whose pair has the highest count of all pairs of its id of a,
    ``count_sum`` is the sum of the links' counts.  Null and empty texts, and texts that a tokenizer
    changes, have no tokens: zeros and an empty digest.  Rows of one key stay apart, every row
    is a document; a null key is a key; other columns are not read; an empty table gives no rows.

    Documents keep their id pairs in a stored table, in chunks of ``chunk_bytes`` of text.  Each chunk's different pairs
    are joined to their counts, so that a pair that all documents have costs one row a chunk.
    """
    spark = docs.sparkSession
    given = docs.select(docs[key].alias("key"), docs[text].cast("string").alias("text"))
    counted = given.select("key").schema
    for name, kind in [*((c, "long") for c in ("chunk", "n_a", "n_b", "n_groups", "n_links")), ("groups_sha256", "string"), ("pairs", "binary")]:
        counted = counted.add(name, kind)
    schema = to_arrow_schema(counted)

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right = byte_level(a), pieces(b)
        chunk, held = TaskContext.get().partitionId() << 32, 0
        for batch in batches_of(batches):
            found = Aligned(batch.column("text").to_pylist(), left, right)
            document, ids_a, ids_b, n = found.pairs()
            cuts = np.searchsorted(document, np.arange(len(found.document) + 1))
            sums = np.concatenate([[0], np.cumsum(n)])
            codes = ids_a << 32 | ids_b
            blobs, digests = [None] * found.size, [""] * found.size
            for place, s, e, form in zip(found.document.tolist(), cuts[:-1].tolist(), cuts[1:].tolist(), found.forms(), strict=True):
                blobs[place], digests[place] = _packed(codes[s:e], n[s:e]), hashlib.sha256(form).hexdigest()
            columns = [
                batch.column("key"),
                np.full(found.size, chunk),
                found.spread(np.diff(found.ends_a)), found.spread(np.diff(found.ends_b)),
                found.spread(found.group_counts()), found.spread(sums[cuts[1:]] - sums[cuts[:-1]]),
                digests, blobs,
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) if not isinstance(c, pa.Array) else c for c, f in zip(columns, schema, strict=True)], schema=schema)
            held += batch.column("text").nbytes
            if held >= chunk_bytes:
                chunk, held = chunk + 1, 0

    aligned = stored(given.mapInArrow(align, counted))

    def different(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chunks = batch.column("chunk").to_numpy()
            blobs = batch.column("pairs").to_pylist()
            for chunk in np.unique(chunks).tolist():
                codes = np.concatenate([_unpacked(blobs[i])[0] for i in np.flatnonzero(chunks == chunk)])
                code, n = np.unique(codes, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(code), chunk)), pa.array(code), pa.array(n)], names=["chunk", "code", "n"])

    linked = aligned.select("chunk", "pairs").where("pairs is not null")
    held = stored(linked.mapInArrow(different, "chunk long, code long, n long"))
    counts = held.groupBy("code").agg(F.sum("n").alias("n"))
    highest = F.max("n").over(Window.partitionBy(F.shiftright("code", 32)))
    counts = counts.withColumn("best", F.col("n") == highest)
    known = held.select("chunk", "code").join(counts, "code")
    result = aligned.select("key", "n_a", "n_b", "n_groups", "n_links").schema.add("n_best", "long").add("count_sum", "long").add("groups_sha256", "string")
    done = to_arrow_schema(result)

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        code, first = np.unique(right.column("code").to_numpy(), return_index=True)
        n, best = right.column("n").to_numpy()[first], right.column("best").to_numpy()[first]
        sums = []
        for blob in left.column("pairs").to_pylist():
            if blob is None:
                sums.append((0, 0))
                continue
            codes, times = _unpacked(blob)
            at = np.searchsorted(code, codes)
            sums.append((int(times[best[at]].sum()), int((times * n[at]).sum())))
        more = {"n_best": [x for x, _ in sums], "count_sum": [x for _, x in sums]}
        return pa.table([pa.array(more[f.name], f.type) if f.name in more else left.column(f.name) for f in done], schema=done)

    return aligned.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(meet, result)


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, by the byte-level vocabulary of 50,257 ids and the piece model of 32,000."""
    a, b = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")
    found = alignments(table(spark, sf_dir, "documents"), a, b)
    return found.select(F.col("key").cast("long").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
