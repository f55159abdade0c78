"""SimHash groups: fingerprints joined on a grid of segment popcounts, verified exactly.

A fingerprint is cut into segments and mapped to the number of set bits in each.
The Manhattan distance of these points is a lower bound of the bits that differ,
so fingerprints within two bits have points within distance two, and some point
lies within one of both.  Each fingerprint therefore visits its own grid point
and the points one step away; fingerprints that meet at a point are compared
bit by bit.  Copies share a fingerprint and enter the join once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.llm.common import arrow, stored, table, texts

BITS, SEED = 64, 42
SHINGLE, DISTANCE = 3, 2
#: Segments of the popcount embedding; more of them make grid points rarer and visits more.
SEGMENTS = 16
#: Members of a grid point up to which all of them are compared with each other; beyond, by flipped bits.
PAIRWISE = 1024
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(raw: bytes, size: int = SHINGLE) -> int:
    """Bits that more than half of the text's shingles have, repeats counted; no words give 0."""
    words = raw.translate(_LOWER).split()
    if not words:
        return 0
    n, join, h = max(1, len(words) - size + 1), b" ".join, xxhash.xxh64_intdigest
    hashes = np.fromiter((h(join(words[i : i + size]), SEED) for i in range(n)), np.uint64, n)
    # bit k of every hash, most significant first
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, 8192):
        part = hashes[at : at + 8192].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, *, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``doc_id`` and ``fp``, the fingerprint as a signed 64-bit number; null texts have no words."""

    def make(batch: pa.RecordBatch) -> dict:
        found = np.array([fingerprint(raw, shingle) for raw in texts(batch)], np.uint64)
        return {"doc_id": batch.column("doc_id"), "fp": found.view(np.int64)}

    rows = docs.select(docs[key].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"))
    return arrow(rows, make, "doc_id long, fp long")


def grid_points(fp: np.ndarray, segments: int) -> np.ndarray:
    """The keys of each fingerprint's own grid point and of its neighbours one step away.

    A key is the popcounts written in base ``width + 3``, shifted by one so that
    a step below zero has a digit too.
    """
    width = BITS // segments
    bits = np.unpackbits(fp.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    counts = bits.reshape(-1, segments, width).sum(2, dtype=np.uint64) + np.uint64(1)
    base = np.array([pow(width + 3, i, 1 << 64) for i in range(segments)], np.uint64)
    own = (counts * base).sum(1, dtype=np.uint64)
    return np.concatenate([own[:, None], own[:, None] + base, own[:, None] - base], axis=1)


def visits(prints: DataFrame, segments: int = SEGMENTS) -> DataFrame:
    """``cell, fp`` of every grid point that a fingerprint visits."""

    def make(batch: pa.RecordBatch) -> dict:
        fp = batch.column("fp").to_numpy().view(np.uint64)
        cells = grid_points(fp, segments)
        return {"cell": cells.ravel().view(np.int64), "fp": np.repeat(fp, cells.shape[1]).view(np.int64)}

    return arrow(prints.select("fp"), make, "cell long, fp long")


def roots(members: np.ndarray, distance: int) -> list[int]:
    """For each fingerprint of a grid point the smallest index linked to it, directly or through others here.

    Few members are all compared.  Many are linked through the fingerprints that
    they become with up to half the distance in bits flipped; two members within
    the distance share one of these, so nothing is left out.
    """
    parent = list(range(len(members)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def link(i: int, j: int) -> None:
        a, b = root(i), root(j)
        parent[max(a, b)] = min(a, b)

    if len(members) <= PAIRWISE or distance != 2:
        for i in range(len(members) - 1):
            apart = np.bitwise_count(members[i] ^ members[i + 1 :])
            for j in np.flatnonzero(apart <= distance).tolist():
                link(i, i + 1 + j)
    else:
        own, shared = np.arange(len(members)), [(members, np.arange(len(members)))]
        shared += [(members ^ np.uint64(1 << k), own) for k in range(BITS)]
        keys, at = np.concatenate([k for k, _ in shared]), np.concatenate([i for _, i in shared])
        order = np.argsort(keys, kind="stable")
        keys, at = keys[order], at[order]
        for x in np.flatnonzero(keys[1:] == keys[:-1]).tolist():
            link(int(at[x]), int(at[x + 1]))
    return [root(i) for i in range(len(members))]


def links(prints: DataFrame, *, segments: int = SEGMENTS, distance: int = DISTANCE) -> DataFrame:
    """``a, b``: enough verified links between distinct fingerprints to connect all that are within ``distance``.

    Points visited once are dropped before the shuffle's rows reach Python.  A
    point with m members yields at most m - 1 links.
    """
    if distance > 2:
        raise ValueError("grid points one step away serve distances up to 2")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(cell: np.ndarray) -> None:
            for i, r in enumerate(roots(cell, distance)):
                if r != i:
                    a.append(cell[r])
                    b.append(cell[i])

        held = np.empty(0, np.int64), np.empty(0, np.uint64)
        for batch in batches:
            a, b = [], []
            cells = np.concatenate([held[0], batch.column("cell").to_numpy()])
            fps = np.concatenate([held[1], batch.column("fp").to_numpy().view(np.uint64)])
            cut = np.flatnonzero(np.diff(cells)) + 1
            starts = np.concatenate([[0], cut])
            # the last point may go on in the next batch
            held = cells[starts[-1] :], fps[starts[-1] :]
            for s, e in zip(starts[:-1].tolist(), cut.tolist(), strict=True):
                if e - s > 1:
                    out(fps[s:e])
            yield pairs(a, b)
        a, b = [], []
        if len(held[1]) > 1:
            out(held[1])
        yield pairs(a, b)

    def pairs(a: list, b: list) -> pa.RecordBatch:
        both = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (a, b)]
        return pa.RecordBatch.from_arrays(both, names=["a", "b"])

    met = visits(prints, segments).repartition("cell").sortWithinPartitions("cell", "fp")
    return met.mapInArrow(run, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: the least node connected to each, by rounds of large-star and small-star steps.

    Each round is stored.  A node's least neighbour is summed before the shuffle
    and joined back, so that a node with many links is no single group.
    """
    edges = stored(edges.select("a", "b").where("a <> b"))
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("m"))
        large = (
            both.where("b > a").join(least, F.col("a") == F.col("k")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        ).distinct()
        # every edge now points from a larger node a to a smaller one b
        large = stored(large)
        low = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "k")
        joined = large.join(low, F.col("a") == F.col("k"))
        small = (
            joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(low.select(F.col("k").alias("a"), F.col("m").alias("b")))
            .distinct()
        )
        small = stored(small)
        # done when the edges are stars: every node points to one root, and no root points anywhere
        several = small.groupBy("a").count().where("count > 1").limit(1).count()
        inner = 0 if several else small.join(small.select(F.col("a").alias("x")), F.col("b") == F.col("x"), "left_semi").limit(1).count()
        if not several and not inner:
            break
        edges = small
    stars = small.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.unionByName(small.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def near_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """``doc_id, fp, component_id``: documents whose fingerprints are linked, and the least doc_id among them.

    Texts without words have fingerprint 0 and are linked like any other.
    Repeated rows stay.  A row without a doc_id takes part and gets its group's
    least id, null if no row of the group has one.
    """
    rows = stored(fingerprints(docs, key=key, text=text, shingle=shingle))
    prints = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    found = components(links(prints, distance=distance))
    grouped = prints.join(found, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    least = grouped.groupBy("root").agg(F.min("first").alias("component_id"))
    named = grouped.join(least, "root").select(F.col("fp").alias("__fp"), "component_id")
    return rows.join(named, F.col("fp") == F.col("__fp")).select("doc_id", "fp", "component_id")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and group of every document."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
