"""Packing of token pieces into sequences of fixed length.

A best-fit start, then swap-based local search: documents move, or are exchanged
one for one or two for one, from the emptiest sequences to fuller ones.  Every
step increases the sum of squared fills, so the emptiest sequences drain and
vanish.  For the search pieces of one length are the same, and so are sequences filled alike: it works
on their numbers, of which there are as many as lengths, whatever the size of the table.  The pieces then
take the places found for their length, in parallel.
"""

from __future__ import annotations

import heapq
import zlib
from array import array
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wordloom.llm.common import arrow, encoder, stored, table, tokenizer_file

CAPACITY = 1024
#: Pieces of one length that are numbered together in a task.
GROUP_ITEMS = 50_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(
    docs: DataFrame, tokenizer: str, *, end_id: int, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Encode each text, end it with ``end_id`` and cut what is longer than ``capacity``.

    One row per piece.  The string of an added token of the vocabulary file is one
    token in a text too.  The first piece takes the remainder, all others are
    full.  A null text is empty and gives one piece of one token; rows with
    equal or null keys stay apart.
    """
    end = array("I", [end_id])

    def make(encode, batch: pa.RecordBatch) -> dict:
        out = defaultdict(list)
        keys, all_texts = batch.column("key").to_pylist(), batch.column("text").to_pylist()
        for own, text in zip(keys, all_texts, strict=True):
            ids = array("I", encode(text or "")) + end
            raw, at, first = memoryview(ids.tobytes()), 0, len(ids) % capacity or capacity
            for n, stop in enumerate(range(first, len(ids) + 1, capacity)):
                out["doc_id"].append(own)
                out["piece"].append(n)
                out["start"].append(at)
                out["length"].append(stop - at)
                out["ids_crc32"].append(zlib.crc32(raw[4 * at : 4 * stop]))
                at = stop
        return out

    rows = docs.select(docs[key].cast("long").alias("key"), docs[text].cast("string").alias("text"))
    return arrow(rows, make, PIECES, start=lambda: encoder(tokenizer))


class Bins:
    """Sequences as fillings (sorted tuples of lengths) with their numbers, by free space and by the lengths they hold.

    Equal sequences are one entry, so work and memory go by the kinds of fillings, not by the number of pieces.
    """

    def __init__(self, capacity: int):
        self.capacity, self.count, self.free = capacity, {}, {}
        self.by_free = [{} for _ in range(capacity + 1)]
        # free space -> length -> fillings that hold it, and both as bits
        self.holding = [defaultdict(dict) for _ in range(capacity + 1)]
        self.held, self.mask = [0] * (capacity + 1), 0
        self.total, self.waiting = 0, []

    def add(self, filling: tuple[int, ...], n: int) -> None:
        self.total += n
        if filling in self.count:
            self.count[filling] += n
            return
        free = self.capacity - sum(filling)
        self.count[filling], self.free[filling] = n, free
        self.by_free[free][filling] = None
        self.mask |= 1 << free
        for x in set(filling):
            self.holding[free][x][filling] = None
            self.held[free] |= 1 << x
        heapq.heappush(self.waiting, (-free, filling))

    def take(self, filling: tuple[int, ...], n: int) -> None:
        self.total -= n
        self.count[filling] -= n
        if self.count[filling]:
            return
        del self.count[filling]
        free = self.free.pop(filling)
        del self.by_free[free][filling]
        if not self.by_free[free]:
            self.mask &= ~(1 << free)
        for x in set(filling):
            del self.holding[free][x][filling]
            if not self.holding[free][x]:
                self.held[free] &= ~(1 << x)

    def exchange(self, source: tuple, group: tuple, target: tuple, back: tuple) -> None:
        """``group`` goes from source to target and ``back`` the other way, in all sequences of these fillings that can be paired."""
        n = self.count[source] // 2 if source == target else min(self.count[source], self.count[target])
        self.take(source, n)
        self.take(target, n)
        for filling, out, into in ((source, group, back), (target, back, group)):
            left = list(filling)
            for x in out:
                left.remove(x)
            if left or into:
                self.add(tuple(sorted([*left, *into])), n)

    def other(self, fillings: dict, source: tuple) -> tuple | None:
        """One of the fillings; the source itself only if two sequences have it."""
        for x in fillings:
            if x != source or self.count[x] > 1:
                return x
        return None

    def best_fit(self, counts: dict[int, int]) -> None:
        """Longest first, each into the sequence with the least room that it fits in; equal pieces go together."""
        for x, n in sorted(counts.items(), reverse=True):
            while n:
                above = self.mask >> x
                if not above:
                    most = self.capacity // x
                    if n >= most:
                        self.add((x,) * most, n // most)
                    if n % most:
                        self.add((x,) * (n % most), 1)
                    break
                free = x + (above & -above).bit_length() - 1
                filling = next(iter(self.by_free[free]))
                most = min(free // x, n)
                times = min(self.count[filling], n // most)
                self.take(filling, times)
                self.add((x,) * most + filling, times)
                n -= most * times


def drain(bins: Bins, source: tuple[int, ...]) -> bool:
    """One step from sequences filled like ``source`` to fuller ones; False if no step is left.

    Moves are tried first, then exchanges of one or two pieces for a shorter one; of the exchanges the one that adds most to
    the other sequence.  That must be at least as full, so that the sum of squares grows.
    """
    widest, own = bins.free[source], sorted(set(source), reverse=True)
    for x in own:
        above = bins.mask >> x
        while above:
            free = x + (above & -above).bit_length() - 1
            if free > widest:
                break
            target = bins.other(bins.by_free[free], source)
            if target is not None:
                bins.exchange(source, (x,), target, ())
                return True
            above &= above - 1
    groups = {(x,): x for x in own}
    groups |= {(x, y): x + y for i, x in enumerate(own) for y in own[i:] if x != y or source.count(x) > 1}
    best, gain = None, 0
    frees = bins.mask & ((1 << (widest + 1)) - 1)
    while frees:
        free = frees.bit_length() - 1
        frees ^= 1 << free
        if free <= gain:
            break
        for group, total in groups.items():
            least = max(1, total - free)
            found = bins.held[free] >> least
            # the shortest piece there that makes room for the group
            back = least + (found & -found).bit_length() - 1
            if found and total - back > gain:
                target = bins.other(bins.holding[free][back], source)
                if target is not None:
                    best, gain = (source, group, target, (back,)), total - back
    if best is None:
        return False
    bins.exchange(*best)
    return True


def least_sequences(counts: dict[int, int], capacity: int) -> int:
    """A lower bound of the number of sequences, from the number of pieces of each length.

    For each threshold: lengths that go with none above it, those over half the
    capacity, and what of the rest above the threshold finds no room beside them.
    """
    count = np.zeros(capacity + 1, np.int64)
    for x, n in counts.items():
        count[x] = n
    total = np.cumsum(count * np.arange(capacity + 1))
    number, half = np.cumsum(count), capacity // 2
    bound = 0
    for k in range(half + 1):
        alone = number[capacity] - number[capacity - k]
        large, room = number[capacity - k] - number[half], total[capacity - k] - total[half]
        small = total[half] - (total[k - 1] if k else 0)
        more = max(0, small - (large * capacity - room))
        bound = max(bound, alone + large + -(-more // capacity))
    return int(bound)


def fillings(counts: dict[int, int], capacity: int = CAPACITY) -> dict[tuple[int, ...], int]:
    """How sequences are filled, and how many in each way, from the number of pieces of each length.

    Best fit first, then local search.  Ends when the number of sequences is the lower bound, or no
    sequence can be drained any further: one that could not is tried again after
    others have changed.
    """
    bins = Bins(capacity)
    bins.best_fit(counts)
    least = least_sequences(counts, capacity)
    stuck, changed = set(), False
    while bins.total > least:
        while bins.waiting and (bins.waiting[0][1] not in bins.count or bins.waiting[0][1] in stuck):
            heapq.heappop(bins.waiting)
        if not bins.waiting or not bins.waiting[0][0]:
            if not changed:
                break
            stuck, changed = set(), False
            bins.waiting = [(-f, x) for x, f in bins.free.items()]
            heapq.heapify(bins.waiting)
            continue
        source = bins.waiting[0][1]
        if drain(bins, source):
            changed = True
        else:
            stuck.add(source)
    return bins.count


class Places:
    """Where the pieces of a length go: the r-th of them to the r-th place for it, over all fillings."""

    def __init__(self, filled: dict[tuple[int, ...], int]):
        listed: dict[int, list[tuple[int, int, tuple[int, ...]]]] = defaultdict(list)
        first = 0
        for filling, n in filled.items():
            offsets = defaultdict(list)
            place = 0
            for x in filling:
                offsets[x].append(place)
                place += x
            for x, own in offsets.items():
                listed[x].append((n * len(own), first, tuple(own)))
            first += n
        self.sequences = first
        self.of = {}
        for x, entries in listed.items():
            ends = np.cumsum([n for n, _, _ in entries])
            flat = np.concatenate([np.array(own) for _, _, own in entries])
            copies = np.array([len(own) for _, _, own in entries])
            self.of[x] = ends, np.array([f for _, f, _ in entries]), copies, np.cumsum(copies) - copies, flat

    def find(self, length: int, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of the pieces of a length with these ranks."""
        ends, first, copies, at, flat = self.of[length]
        entry = np.searchsorted(ends, ranks, "right")
        inside = ranks - np.concatenate([[0], ends])[entry]
        return first[entry] + inside // copies[entry], flat[at[entry] + inside % copies[entry]]


def pack(lengths: list[int], capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(sequence, offset) of each length."""
    places = Places(fillings(Counter(lengths), capacity))
    seen: Counter = Counter()
    out = []
    for x in lengths:
        sequence, offset = places.find(x, np.array([seen[x]]))
        out.append((int(sequence[0]), int(offset[0])))
        seen[x] += 1
    return out


def ranked(rows: DataFrame, counts: dict[int, int], length: str, group_items: int) -> DataFrame:
    """Add ``__rank``, numbers from 0 without gaps among the rows of a length.

    Rows of a length are dealt over as many groups as hold ``group_items`` rows each, and numbered in
    them; a group's first number is the sum of those before it.
    """
    spark = rows.sparkSession
    groups = spark.createDataFrame([(x, -(-n // group_items)) for x, n in counts.items()], "__length long, __groups int")
    dealt = rows.join(F.broadcast(groups), F.col(length) == F.col("__length"))
    dealt = dealt.withColumn("__group", F.pmod(F.xxhash64("__id"), F.col("__groups")).cast("int")).drop("__groups")
    sizes = dealt.groupBy("__length", "__group").agg(F.count("*").alias("__n"))
    before = Window.partitionBy("__length").orderBy("__group").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(F.col("__length").alias("__l"), F.col("__group").alias("__g"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__first"))
    own = Window.partitionBy("__length", "__group").orderBy("__id")
    found = dealt.withColumn("__row", F.row_number().over(own))
    found = found.join(sizes, (F.col("__length") == F.col("__l")) & (F.col("__group") == F.col("__g")))
    return found.select(*rows.columns, (F.col("__first") + F.col("__row") - 1).alias("__rank"))


def packed(
    cut: DataFrame, *, capacity: int = CAPACITY, group_items: int = GROUP_ITEMS, length: str = "length"
) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a table of pieces no longer than ``capacity``.

    Full pieces are sequences by themselves and are not shuffled.  Of the others the driver gets the number of each
    length, ``capacity`` numbers at most, and finds how sequences are to be filled; pieces get numbers among those
    of their length, and so their places.  The table is stored first, so that the numbers given to its rows hold whatever is run again.
    """
    spark = cut.sparkSession
    rows = stored(cut.withColumn("__id", F.monotonically_increasing_id()))
    full = rows.where(F.col(length) >= capacity)
    whole = full.select("*", F.col("__id").alias("sequence_id"), F.lit(0).cast("long").alias("offset")).drop("__id")
    left = rows.where(F.col(length) < capacity)
    counts = {r[0]: r[1] for r in left.groupBy(F.col(length).cast("long")).count().collect()}
    if not counts:
        return whole
    places = spark.sparkContext.broadcast(Places(fillings(counts, capacity)))
    found = ranked(left, counts, length, group_items)

    @F.pandas_udf("sequence long, offset long")
    def place(lengths: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        out = np.zeros((2, len(lengths)), np.int64)
        values, number = lengths.to_numpy(), ranks.to_numpy()
        for x in np.unique(values).tolist():
            mine = values == x
            out[:, mine] = places.value.find(x, number[mine])
        return pd.DataFrame({"sequence": -1 - out[0], "offset": out[1]})

    placed = found.withColumn("__at", place(F.col(length).cast("long"), "__rank"))
    return whole.unionByName(placed.select(*cut.columns, F.col("__at.sequence").alias("sequence_id"), F.col("__at.offset").alias("offset")))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1024 tokens, each ended by id 2."""
    return packed(pieces(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), end_id=2))
