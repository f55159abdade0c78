"""Removal of long strings that repeat anywhere, by merging Burrows-Wheeler transforms of shards.

A window is ``length`` bytes of one text.  Its anchor, the k-gram of least hash in
it, depends on the window's bytes alone, so equal windows have equal anchors in
equal places.  Three steps follow from this:

1.  Anchors that occur once in the corpus are dropped: their windows occur once.
2.  Each remaining anchor has a context, the stretch of text that holds the windows
    with this anchor.  Contexts are counted by digest; one that occurs twice
    repeats wholly.
3.  Only anchors with different contexts need their bytes.  These contexts meet by
    anchor, are aligned at it and cut into shards.  Every shard has
    its Burrows-Wheeler transform, column by column: the bytes before each column
    in the order of the suffixes that start there.  Shards are merged by refining
    their interleave one column at a time: a stable partition of the interleave
    by these bytes gives the interleave of the suffixes one byte longer.  Common
    prefixes of neighbours follow from the last column's by range minima, so no
    suffix is sorted again.  Neighbours that share ``length`` bytes or more form
    the repeated intervals.

An anchor with very many different contexts (a common passage in ever new
surroundings) would be one large group; its windows are counted one by one by
their digests instead, which any number of tasks can share.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.llm.common import arrow, stored, table, text_of, texts

LENGTH, GRAM = 200, 64
#: Different contexts of an anchor up to which they are merged in one task.
GROUP_CONTEXTS = 4000
#: Rows of a merge, and of each of its shards.
MERGE_ROWS, SHARD_ROWS = 16_000, 4_000
#: Bits of the map that tells repeated anchors before the shuffle (16 MB, whatever the
#: input).  It may let others through, which are dropped later; it never drops one.
MAP_BITS = 27
#: Digests of contexts that a task remembers, so as not to send them again.
SEEN_CONTEXTS = 100_000
_CHUNK = 1 << 20
_MIX = np.random.default_rng(5).integers(1, 1 << 63, 256, dtype=np.int64).astype(np.uint64) | np.uint64(1)
_STEP = np.random.default_rng(6).integers(1, 1 << 63, 16, dtype=np.int64).astype(np.uint64) | np.uint64(1)
_AT = np.uint64((1 << 24) - 1)


def gram_hashes(raw: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A 64-bit hash of the ``gram`` bytes (a power of two) from each place on, by doubling."""
    h, size = _MIX[raw], 1
    while size < gram:
        h = h[:-size] * _STEP[size.bit_length()] + (h[size:] ^ (h[size:] >> np.uint64(29)))
        size *= 2
    h = h * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(32))


def anchors(parts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> Iterator[tuple[bytes, np.ndarray, ...]]:
    """Buffers and the runs of windows with one anchor: hash, anchor's place, first and last window start.

    Texts are joined into buffers of bounded size; windows that reach over a
    text's end count for nothing.  A long text is read in stretches.
    """
    whole = b"".join(parts)
    ends = np.cumsum([len(x) for x in parts])
    for at in range(0, len(whole), _CHUNK):
        raw = np.frombuffer(whole, np.uint8, min(_CHUNK + length - 1, len(whole) - at), at)
        if len(raw) < length:
            return
        h = gram_hashes(raw, gram)
        key = (h & ~_AT) | np.arange(len(h), dtype=np.uint64)
        # sliding minimum over the grams of a window; the place breaks ties to the left
        span, size = length - gram + 1, 1
        while 2 * size <= span:
            key = np.minimum(key[:-size], key[size:])
            size *= 2
        rest = span - size
        key = np.minimum(key[: len(key) - rest], key[rest:]) if rest else key
        place = (key & _AT).astype(np.int64)
        start = np.arange(len(place)) + at
        place[ends[np.minimum(np.searchsorted(ends, start, "right"), len(ends) - 1)] < start + length] = -1
        first = np.concatenate([[0], np.flatnonzero(np.diff(place)) + 1])
        last = np.concatenate([first[1:], [len(place)]]) - 1
        good = place[first] >= 0
        first, last = first[good], last[good]
        yield h[place[first]], place[first] + at, first + at, last + at


def repeated(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """Hashes of the anchors that occur twice or more."""

    def make(batch: pa.RecordBatch) -> dict | None:
        found = [h for h, *_ in anchors(texts(batch), length, gram)]
        if not found:
            return None
        h, n = np.unique(np.concatenate(found), return_counts=True)
        return {"h": h.view(np.int64), "n": n}

    seen = arrow(docs.select("text"), make, "h long, n long", most_text=16 * _CHUNK)
    return seen.groupBy("h").agg(F.sum("n").alias("n")).where("n > 1").select("h")


def bit_map(keys: DataFrame, key: str, bits: int) -> np.ndarray:
    """A map of ``2 ** bits`` bits with those of the keys set, gathered as 64-bit words."""
    at = F.shiftrightunsigned(F.col(key), 64 - bits)
    words = keys.select(
        F.shiftrightunsigned(at, 6).cast("int").alias("w"),
        F.expr(f"shiftleft(1L, cast(shiftrightunsigned({key}, {64 - bits}) & 63 as int))").alias("b"),
    )
    found = words.groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[found.column("w").to_numpy()] = found.column("b").to_numpy().view(np.uint64)
    return out


def in_map(words: np.ndarray, key: np.ndarray, bits: int) -> np.ndarray:
    at = key >> np.uint64(64 - bits)
    return (words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def located(parts: list[bytes], known: np.ndarray, length: int, gram: int, bits: int) -> Iterator[tuple]:
    """Contexts of the anchors in the map: anchor's place in the context, bytes, digest, text, start there.

    The digest is the anchor's hash and 64 bits of MD5, which tell the contexts of one anchor apart.
    """
    whole, ends = b"".join(parts), np.cumsum([len(x) for x in parts])
    starts = ends - [len(x) for x in parts]
    for h, place, first, last in anchors(parts, length, gram):
        on = in_map(known, h, bits)
        h, place, first, last = h[on], place[on], first[on], last[on]
        owner = np.searchsorted(ends, first, "right")
        start = first - starts[owner]
        for x, a, p, q, n, lo in zip(*(v.tolist() for v in (h.view(np.int64), place, first, last, owner, start)), strict=True):
            ctx = whole[p : q + length]
            yield a - p, ctx, x.to_bytes(8, "big", signed=True) + hashlib.md5(b"%d," % (a - p) + ctx).digest()[:8], n, lo


def contexts(docs: DataFrame, known: np.ndarray, length: int, gram: int, bits: int) -> DataFrame:
    """Where the contexts are: digest ``ck``, last window start ``last``, text ``th`` and starts ``los`` in it.

    Equal texts of a batch give one row; ``times`` counts what it stands for.
    """
    held = docs.sparkSession.sparkContext.broadcast(known)

    def make(batch: pa.RecordBatch) -> dict | None:
        parts, digests, found = texts(batch), {}, {}
        for _, ctx, ck, n, lo in located(parts, held.value, length, gram, bits):
            if n not in digests:
                digests[n] = hashlib.md5(parts[n]).digest()
            row = found.setdefault((ck, digests[n]), [len(ctx) - length, [], 0])
            row[1].append(lo)
            row[2] += 1
        if not found:
            return None
        (cks, ths), (lasts, los, times) = zip(*found), zip(*found.values())
        return {"ck": cks, "last": lasts, "th": ths, "los": [sorted(set(x)) for x in los], "times": times}

    kinds = "ck binary, last int, th binary, los array<int>, times int"
    return arrow(docs.select("text"), make, kinds, most_text=4 * _CHUNK)


def context_bytes(docs: DataFrame, known: np.ndarray, length: int, gram: int, bits: int) -> DataFrame:
    """``off, ck, ctx``: the contexts of the anchors in the map, compressed, each about once a task."""
    held = docs.sparkSession.sparkContext.broadcast(known)

    def make(seen: set, batch: pa.RecordBatch) -> dict | None:
        if len(seen) > SEEN_CONTEXTS:
            seen.clear()
        found = {}
        for off, ctx, ck, _, _ in located(texts(batch), held.value, length, gram, bits):
            if ck not in seen:
                seen.add(ck)
                found[ck] = off, zlib.compress(ctx, 1, -15)
        if not found:
            return None
        offs, ctxs = zip(*found.values())
        return {"off": offs, "ck": list(found), "ctx": ctxs}

    return arrow(docs.select("text"), make, "off int, ck binary, ctx binary", start=set, most_text=4 * _CHUNK)


def anchor_of(ck: str) -> Column:
    return F.substring(ck, 1, 8)


def transform(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A shard's transform: for each column the bytes there in the order of the suffixes after it, and that order."""
    count, width = rows.shape
    bytes_at, order_at = np.empty((width, count), np.uint16), np.empty((width + 1, count), np.int32)
    order_at[width] = np.arange(count)
    for j in range(width - 1, -1, -1):
        bytes_at[j] = rows[order_at[j + 1], j]
        order_at[j] = order_at[j + 1][np.argsort(bytes_at[j], kind="stable")]
    return bytes_at, order_at


def merged(shards: list[np.ndarray], length: int) -> list[np.ndarray]:
    """For each shard, which windows (row, start column) also start elsewhere in the shards.

    Shards are rows of aligned bytes plus one, 0 where a row has none.  The
    interleave says from which shard each suffix of the merged order comes; it
    starts with one shard after the other and is refined from the last column to
    the first.
    """
    transforms = [transform(s) for s in shards]
    width = shards[0].shape[1]
    sizes = [len(s) for s in shards]
    out = [np.zeros(s.shape, bool) for s in shards]
    interleave = np.repeat(np.arange(len(shards), dtype=np.uint16), sizes)
    common = np.zeros(len(interleave) + 1, np.int32)
    for j in range(width - 1, -1, -1):
        codes = np.empty(len(interleave), np.uint16)
        slots = [np.flatnonzero(interleave == s) for s in range(len(shards))]
        for s, at in enumerate(slots):
            codes[at] = transforms[s][0][j]
        order = np.argsort(codes, kind="stable")
        interleave, sorted_codes = interleave[order], codes[order]
        same = np.flatnonzero((sorted_codes[1:] == sorted_codes[:-1]) & (sorted_codes[1:] > 0))
        now = np.zeros(len(common), np.int32)
        if len(same):
            pairs = np.stack([order[same] + 1, order[same + 1] + 1], 1).ravel()
            now[same + 1] = np.minimum(np.minimum.reduceat(common, pairs)[::2] + 1, length)
        common = now
        if j + length <= width:
            long = common >= length
            again = long[:-1] | long[1:]
            if again.any():
                for s in range(len(shards)):
                    marked = again[interleave == s]
                    if marked.any():
                        out[s][transforms[s][1][j][marked], j] = True
    return out


def flat_runs(marks: np.ndarray, shift: int) -> list[int]:
    """First and last of each run of true, less ``shift``."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], marks.view(np.int8), [0]])))
    edge[1::2] -= 1
    return (edge - shift).tolist()


RUNS = "ck binary, runs array<int>"


def merge_groups(different: DataFrame, length: int, gram: int) -> DataFrame:
    """The repeated window starts of each context, relative to it, for contexts dealt and sorted by anchor."""
    left = length - gram
    width = left + length

    def solve(rows: list[tuple]) -> tuple[list[bytes], list[list[int]]]:
        shards = []
        for at in range(0, len(rows), SHARD_ROWS):
            part = rows[at : at + SHARD_ROWS]
            shard = np.zeros((len(part), width), np.uint16)
            for i, (off, _, packed) in enumerate(part):
                ctx = zlib.decompress(packed, -15)
                shard[i, left - off : left - off + len(ctx)] = np.frombuffer(ctx, np.uint8)
                shard[i, left - off : left - off + len(ctx)] += 1
            shards.append(shard)
        cks, runs = [], []
        for at, marks in enumerate(merged(shards, length)):
            for i in np.flatnonzero(marks.any(1)).tolist():
                off, ck, _ = rows[at * SHARD_ROWS + i]
                cks.append(ck)
                runs.append(flat_runs(marks[i], left - off))
        return cks, runs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solved() -> pa.RecordBatch:
            cks, runs = solve(ready) if ready else ([], [])
            ready.clear()
            return pa.RecordBatch.from_arrays([pa.array(cks, pa.binary()), pa.array(runs, pa.list_(pa.int32()))], names=["ck", "runs"])

        group, ready = [], []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("off", "ck", "ctx")), strict=True):
                if group and row[1] == group[-1][1]:
                    continue
                if group and row[1][:8] != group[0][1][:8]:
                    ready += group if len(group) > 1 else []
                    group = []
                    if len(ready) >= MERGE_ROWS:
                        yield solved()
                group.append(row)
        ready += group if len(group) > 1 else []
        yield solved()

    dealt = different.repartition(anchor_of("ck")).sortWithinPartitions("ck")
    return dealt.mapInArrow(run, "ck binary, runs array<int>")


def count_windows(different: DataFrame, length: int) -> DataFrame:
    """The same for the contexts of very common anchors, window by window."""

    def make(batch: pa.RecordBatch) -> dict | None:
        out = defaultdict(list)
        for packed, ck in zip(*(batch.column(c).to_pylist() for c in ("ctx", "ck")), strict=True):
            ctx = zlib.decompress(packed, -15)
            for p in range(len(ctx) - length + 1):
                out["wk"].append(hashlib.md5(ctx[p : p + length]).digest())
                out["ck"].append(ck)
                out["p"].append(p)
        return out or None

    each = arrow(different.select("ctx", "ck").distinct(), make, "wk binary, ck binary, p int")
    again = each.groupBy("wk").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("wk").alias("rk"))
    hit = each.join(again, F.col("wk") == F.col("rk"), "left_semi").groupBy("ck").agg(F.collect_set("p").alias("ps"))
    return hit.select("ck", F.flatten(F.transform("ps", lambda p: F.array(p, p))).alias("runs"))


def union(flat: list[int]) -> list[int]:
    """Starts and ends of the maximal runs covered by the given spans."""
    out: list[int] = []
    for a, b in sorted(zip(flat[::2], flat[1::2])):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


def repeated_spans(docs: DataFrame, *, length: int = LENGTH, gram: int = GRAM, bits: int = MAP_BITS) -> DataFrame:
    """``th, spans``: for texts with repeated windows their digest and the bytes covered, as flat starts and ends."""
    rows = docs.select("text").where(F.octet_length("text") >= length)
    known = bit_map(repeated(rows, length, gram), "h", bits)
    found = stored(contexts(rows, known, length, gram, bits))
    counted = stored(found.groupBy("ck").agg(F.sum("times").alias("n"), F.max("last").alias("last")))
    runs = counted.where("n > 1").select("ck", F.array(F.lit(0), "last").alias("runs"))
    several = counted.groupBy(anchor_of("ck").alias("a")).agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    several = stored(several.select("a", "m", F.conv(F.hex("a"), 16, -10).cast("long").alias("h")))
    different = context_bytes(rows, bit_map(several, "h", bits), length, gram, bits)
    crowded = several.where(F.col("m") > GROUP_CONTEXTS).select("a")
    if crowded.limit(1).count():
        different, at = stored(different), anchor_of("ck") == F.col("a")
        runs = runs.unionByName(count_windows(different.join(crowded, at, "left_semi"), length))
        different = different.join(crowded, at, "left_anti")
    runs = runs.unionByName(merge_groups(different, length, gram)).select(F.col("ck").alias("rk"), "runs")
    places = found.select("ck", "th", F.explode("los").alias("lo"))
    covered = places.join(runs, F.col("ck") == F.col("rk")).select(
        "th",
        F.transform("runs", lambda x, i: x + F.col("lo") + F.when(i % 2 == 1, length).otherwise(0)).alias("spans"),
    )
    # a set: equal texts name the same spans, once a task
    return stored(covered.groupBy("th").agg(F.flatten(F.collect_set("spans")).alias("spans")))


def digest_of(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def with_spans(docs: DataFrame, *, text: str = "text", length: int = LENGTH, gram: int = GRAM, bits: int = MAP_BITS) -> DataFrame:
    """``row``, the document as a struct, and ``spans``: the spans of bytes to remove, not yet united, null if none.

    A null text is empty.  Equal texts of ``length`` bytes or more repeat
    wholly.  Only texts that may have spans, by a map of their digests, are shuffled to
    meet them.
    """
    own = text_of(docs, text)
    found = repeated_spans(docs.select(own.alias("text")), length=length, gram=gram, bits=bits)
    marked = bit_map(found.select(F.xxhash64("th").alias("k")), "k", bits)
    held = docs.sparkSession.sparkContext.broadcast(marked)

    @F.pandas_udf("boolean")
    def may(keys: pd.Series) -> pd.Series:
        return pd.Series(in_map(held.value, keys.to_numpy(np.int64).view(np.uint64), bits))

    keyed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), digest_of(own).alias("key"))
    keyed = keyed.withColumn("may", may(F.xxhash64("key")))
    rest = keyed.where("not may").select("row", F.lit(None).cast("array<int>").alias("spans"))
    met = keyed.where("may").join(found, F.col("key") == F.col("th"), "left").select("row", "spans")
    return met.unionByName(rest)


def kept_bytes(raw: bytes, runs: list[int]) -> bytes:
    edges = [0, *runs, len(raw)]
    return b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))


def whole_characters(raw: bytes, runs: list[int]) -> list[int]:
    """The runs, less bytes at their ends that belong to characters which reach outside."""
    out = []
    for a, b in zip(runs[::2], runs[1::2]):
        while a < b and raw[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(raw) and raw[b] & 0xC0 == 0x80:
            b -= 1
        if a < b:
            out += [a, b]
    return out


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What repeats of 200 bytes or more cover in every document, and what is left."""
    docs = table(spark, sf_dir, "documents")
    found = with_spans(docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")))
    found = found.select("row.*", "spans")

    def make(batch: pa.RecordBatch) -> dict:
        out = defaultdict(list)
        for raw, spans in zip(texts(batch), batch.column("spans").to_pylist(), strict=True):
            runs = union(spans or [])
            out["n_bytes"].append(len(raw))
            out["n_removed"].append(sum(runs[1::2]) - sum(runs[::2]))
            out["n_spans"].append(len(runs) // 2)
            out["kept_sha256"].append(hashlib.sha256(kept_bytes(raw, runs)).hexdigest())
        return {"doc_id": batch.column("doc_id")} | out

    return arrow(found, make, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
