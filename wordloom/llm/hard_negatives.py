"""Hard negatives by exact search in a multiway hyperplane tree over integer vectors.

Every node of the tree has several split points, and a row goes to the nearest of
them.  For each split point and each sibling subtree the node keeps the least and
the greatest distance between the point and the subtree's rows, and for each
subtree the least and the greatest norm.  A window of inner products with an anchor is an annulus
around it; by the triangle inequality it lets each split point rule out the siblings whose
range of distances it cannot meet.  What is left is scored exactly in the leaves.

Split points come from a bounded sample; every row is in the index.  Leaves are
gathered into parts of bounded size, a leaf that is too large for one part is dealt over
several, and anchors are sent to the parts that hold a surviving leaf.
A task holds one part and reads the anchors sent to it as a stream.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from wordloom.llm.common import stored, table

#: Rows that split points are chosen from at most, and the numbers in them.
SAMPLE_ROWS, SAMPLE_VALUES = 16_384, 1 << 22
#: Split points of a node.
WAYS = 16
#: Rows of a leaf, about; numbers of a part at most.
LEAF_ROWS, PART_VALUES = 512, 1 << 19
#: Scores of one step in a leaf.
STEP_VALUES = 1 << 21
#: Positives of an anchor, negatives of a positive, and the window of scores in hundredths of the positive's.
POSITIVES, NEGATIVES, WINDOW = 5, 5, (80, 100)

_ROW = "part int, kind int, n long, id long, label long, v array<int>, asked array<long>"
_NO_BOUND = -(1 << 62)


def components(vector: Column, scale: int = 256) -> Column:
    """``floor(scale * x)`` of every component as int, held within +-2^28; null unless all components are finite numbers."""
    number = F.transform(vector, lambda x: x.cast("double"))
    fine = F.forall(number, lambda x: F.coalesce(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    most = float(1 << 28)
    held = F.transform(number, lambda x: F.floor(F.greatest(F.lit(-most), F.least(F.lit(most), x * scale))).cast("int"))
    return F.when(fine, held)


def matrix(column: pa.ListArray, dim: int) -> np.ndarray:
    """Vectors as rows of exact numbers; shorter ones are filled with zeros."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lengths), dim))
    out[np.arange(dim) < lengths[:, None]] = flat
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of ``a`` and ``b``: in floating point where no partial sum can reach 2^53."""
    widest = max(np.abs(a).max(initial=0), 1) * max(np.abs(b).max(initial=0), 1) * max(a.shape[1], 1)
    if widest < 1 << 53:
        return (a @ b.T).astype(np.int64)
    return a.astype(np.int64) @ b.T.astype(np.int64)


def squares(a: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", a, a)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(squares(a)[:, None] + squares(b) - 2.0 * (a @ b.T), 0))


class Tree:
    """Split points and children of every node; leaves are numbered so that those of a subtree are neighbours."""

    def __init__(self, sample: np.ndarray, rows: int, ways: int = WAYS, leaf_rows: int = LEAF_ROWS):
        self.points: list[np.ndarray] = []
        self.children: list[list[tuple[bool, int]]] = []
        self.leaves = 0
        self.ways, self.leaf_rows, self.weight = ways, leaf_rows, rows / max(1, len(sample))
        self.root = self._grow(sample)

    def _grow(self, sample: np.ndarray) -> tuple[bool, int]:
        """A node of the sample's rows, or a leaf: (is it a leaf, its number)."""
        wanted = min(self.ways, int(len(sample) * self.weight / self.leaf_rows) + 1, len(sample) // 2)
        if wanted < 2:
            self.leaves += 1
            return True, self.leaves - 1
        points = self._spread(sample, wanted)
        if len(points) < 2:
            self.leaves += 1
            return True, self.leaves - 1
        nearest = distances(sample, points).argmin(1)
        node = len(self.points)
        self.points.append(points)
        self.children.append([])
        self.children[node] = [self._grow(sample[nearest == j]) for j in range(len(points))]
        return False, node

    @staticmethod
    def _spread(sample: np.ndarray, wanted: int) -> np.ndarray:
        """Points far from each other among three times as many candidates."""
        some = sample[:: max(1, len(sample) // (3 * wanted))]
        chosen = [0]
        least = distances(some, some[:1])[:, 0]
        while len(chosen) < wanted and least.max() > 0:
            chosen.append(int(least.argmax()))
            least = np.minimum(least, distances(some, some[chosen[-1:]])[:, 0])
        return some[chosen]

    def walk(self, rows: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(node, child or -1 for a leaf, rows there, their distances to the node's points), and at leaves (-1, leaf, rows, empty)."""
        waiting = [(self.root, np.arange(len(rows)))]
        while waiting:
            (leaf, number), here = waiting.pop()
            if not len(here):
                continue
            if leaf:
                yield -1, number, here, np.empty((0, 0))
                continue
            away = distances(rows[here], self.points[number])
            nearest = away.argmin(1)
            for j, child in enumerate(self.children[number]):
                mine = nearest == j
                if mine.any():
                    yield number, j, here[mine], away[mine]
                    waiting.append((child, here[mine]))

    def leaves_of(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros(len(rows), np.int32)
        for node, number, here, _ in self.walk(rows):
            if node < 0:
                out[here] = number
        return out

    def ranges_of(self, rows: np.ndarray) -> Iterator[tuple[int, int, int, float, float]]:
        """(node, point, child, least, greatest): distances of the rows in a child to each point; squared norms as point -1."""
        norms = squares(rows)
        for node, j, here, away in self.walk(rows):
            if node >= 0:
                yield node, -1, j, norms[here].min(), norms[here].max()
                for i, (lo, hi) in enumerate(zip(away.min(0), away.max(0), strict=True)):
                    yield node, i, j, lo, hi

    def take_ranges(self, ranges: list[tuple[int, int, int, float, float]]) -> None:
        self.lo = [np.full((len(p), len(p)), np.inf) for p in self.points]
        self.hi = [np.full((len(p), len(p)), -np.inf) for p in self.points]
        self.norm = [np.full((len(p), 2), np.nan) for p in self.points]
        for node, i, j, lo, hi in ranges:
            if i < 0:
                self.norm[node][j] = lo, hi
            else:
                self.lo[node][i, j], self.hi[node][i, j] = lo, hi

    def survivors(self, rows: np.ndarray, least: np.ndarray, most: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, rows) where the leaf may hold a product with the row within one of its windows; windows are columns, empty if least > most."""
        norms = squares(rows)
        waiting = [(self.root, np.arange(len(rows)))]
        while waiting:
            (leaf, number), here = waiting.pop()
            if leaf:
                yield number, here
                continue
            away = distances(rows[here], self.points[number])[:, :, None]
            for j, child in enumerate(self.children[number]):
                (small, large), lo, hi = self.norm[number][j], self.lo[number][:, j], self.hi[number][:, j]
                if np.isnan(small):
                    continue
                outer2 = norms[here, None] + large - 2.0 * least[here]
                inner2 = norms[here, None] + small - 2.0 * most[here]
                outer = np.sqrt(np.maximum(outer2, 0))[:, None, :]
                inner = np.sqrt(np.maximum(inner2, 0))[:, None, :]
                # rounding must never rule out a row
                slack = 1e-6 * (1 + away + outer)
                meets = (np.maximum(away - outer, inner - away) - slack <= hi[:, None]) & (away + outer + slack >= lo[:, None])
                open_ = (least[here] <= most[here]) & (outer2 >= -1e-6 * (1 + norms[here, None] + large))
                left = (meets.all(1) & open_).any(1)
                if left.any():
                    waiting.append((child, here[left]))


class Index:
    """The tree and how its leaves are dealt to parts."""

    def __init__(self, tree: Tree, counts: dict[int, int], dim: int, part_values: int = PART_VALUES):
        self.tree, self.dim = tree, dim
        room = max(1, part_values // max(1, dim))
        self.first, self.copies = np.zeros(tree.leaves, np.int64), np.ones(tree.leaves, np.int64)
        part, held = 0, 0
        for leaf in range(tree.leaves):
            rows = counts.get(leaf, 0)
            if held and held + rows > room:
                part, held = part + 1, 0
            self.first[leaf], self.copies[leaf] = part, max(1, -(-rows // room))
            if rows > room:
                part += int(self.copies[leaf])
            else:
                held += rows

    def part_of(self, leaves: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """The part of each row: that of its leaf, or one of the leaf's by the row's number."""
        mixed = (numbers.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
        return self.first[leaves] + (mixed % self.copies[leaves].astype(np.uint64)).astype(np.int64)

    def parts_of(self, leaves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (row, part) of all parts that hold rows of each row's leaf."""
        copies = self.copies[leaves]
        which = np.repeat(np.arange(len(leaves)), copies)
        return which, self.first[leaves][which] + np.arange(len(which)) - (np.cumsum(copies) - copies)[which]

    def parts_asked(self, rows: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (row, part) where the part holds a leaf that survives for the row."""
        rowwise, parts = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for leaf, here in self.tree.survivors(rows, least, most):
            for copy in range(int(self.copies[leaf])):
                rowwise.append(here)
                parts.append(np.full(len(here), self.first[leaf] + copy))
        pairs = np.unique(np.stack([np.concatenate(parts), np.concatenate(rowwise)], 1), axis=0)
        return pairs[:, 1], pairs[:, 0]


def bounds(asked: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """The window of all scores from a bound on."""
    least = np.array([x[0] for x in asked.to_pylist()], float)[:, None]
    return least, np.full(least.shape, float(1 << 62))


def windows(asked: pa.ListArray, window: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest score of the window below each positive's score; rows with fewer positives have empty windows."""
    lists = asked.to_pylist()
    width = max(map(len, lists), default=0)
    least, most = np.ones((len(lists), width)), np.zeros((len(lists), width))
    for i, x in enumerate(lists):
        for k, score in enumerate(x):
            least[i, k], most[i, k] = -(-score * window[0] // 100), score * window[1] // 100
    return least, most


class Part:
    """The rows of a part, leaf by leaf, with what anchors ask of them."""

    def __init__(self, index: Index, held: list[pa.RecordBatch]):
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        self.index, self.v = index, matrix(rows.column("v"), index.dim)
        self.n = rows.column("n").to_numpy()
        self.label = rows.column("label").to_numpy()
        self.ids = rows.column("id")
        self.order = np.array([np.iinfo(np.int64).max if x is None else x for x in self.ids.to_pylist()], np.int64)
        leaf = index.tree.leaves_of(self.v)
        self.at = {int(x): np.flatnonzero(leaf == x) for x in np.unique(leaf)}

    def scores(self, anchors: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Inner products of anchors and rows in leaves that survive; elsewhere below every bound."""
        out = np.full((len(anchors), len(self.v)), _NO_BOUND - 1, np.int64)
        for leaf, here in self.index.tree.survivors(anchors, least, most):
            if (mine := self.at.get(leaf)) is not None:
                out[np.ix_(here, mine)] = products(anchors[here], self.v[mine])
        return out

    def best(self, found: np.ndarray, score: np.ndarray, wanted: int) -> np.ndarray:
        """The first rows by score, then id, then row number, of those found."""
        if len(found) > wanted:
            found = found[score[found] >= np.partition(score[found], -wanted)[-wanted]]
        return found[np.lexsort((self.n[found], self.order[found], -score[found]))][:wanted]

    def own(self, asked: pa.RecordBatch, wanted: int) -> Iterator[tuple]:
        """The best rows of the anchor's label in its own leaf."""
        anchors = matrix(asked.column("v"), self.index.dim)
        leaves = self.index.tree.leaves_of(anchors)
        score = np.zeros(len(self.v), np.int64)
        for n, label, leaf, v in zip(asked.column("n").to_pylist(), asked.column("label").to_pylist(), leaves.tolist(), anchors, strict=True):
            mine = self.at.get(leaf, np.empty(0, np.int64))
            mine = mine[(self.label[mine] == label) & (self.n[mine] != n)]
            score[mine] = products(v[None], self.v[mine])[0]
            for x in self.best(mine, score, wanted).tolist():
                yield n, int(score[x]), self.ids[x].as_py(), int(self.n[x]), 0

    def positives(self, asked: pa.RecordBatch, wanted: int) -> Iterator[tuple]:
        """The best rows of the anchor's label with a score from its bound on."""
        least, most = bounds(asked.column("asked"))
        scores = self.scores(matrix(asked.column("v"), self.index.dim), least, most)
        for n, label, bound, score in zip(asked.column("n").to_pylist(), asked.column("label").to_pylist(), least[:, 0], scores, strict=True):
            found = np.flatnonzero((self.label == label) & (self.n != n) & (score >= max(bound, _NO_BOUND)))
            for x in self.best(found, score, wanted).tolist():
                yield n, int(score[x]), self.ids[x].as_py(), int(self.n[x]), 0

    def negatives(self, asked: pa.RecordBatch, wanted: int, window: tuple[int, int]) -> Iterator[tuple]:
        """For each window the best rows of other labels in it."""
        least, most = windows(asked.column("asked"), window)
        scores = self.scores(matrix(asked.column("v"), self.index.dim), least, most)
        for i, (n, label, score) in enumerate(zip(asked.column("n").to_pylist(), asked.column("label").to_pylist(), scores, strict=True)):
            other = np.flatnonzero((self.label != label) & (score >= _NO_BOUND))
            for k in np.flatnonzero(least[i] <= most[i]).tolist():
                found = other[(score[other] >= least[i, k]) & (score[other] <= most[i, k])]
                for x in self.best(found, score, wanted).tolist():
                    yield n, int(score[x]), self.ids[x].as_py(), int(self.n[x]), k


def _runs(batches: Iterator[pa.RecordBatch], index: Index, step: int) -> Iterator[tuple[Part, pa.RecordBatch]]:
    """Anchors with the part they are sent to, a bounded number at a time; rows come before the anchors of their part."""
    current, held, part = None, [], None
    for batch in batches:
        parts, kinds = batch.column("part").to_numpy(), batch.column("kind").to_numpy()
        edges = np.flatnonzero((np.diff(parts) != 0) | (np.diff(kinds) != 0)) + 1
        for start, end in zip([0, *edges.tolist()], [*edges.tolist(), len(parts)], strict=True):
            if start == end:
                continue
            if parts[start] != current:
                current, held, part = parts[start], [], None
            piece = batch.slice(start, end - start)
            if kinds[start] == 0:
                held.append(piece)
            elif held or part:
                if part is None:
                    part, held = Part(index, held), []
                most = max(1, step // max(1, len(part.v)))
                for s in range(0, len(piece), most):
                    yield part, piece.slice(s, most)


def visited(
    indexed: DataFrame,
    anchors: DataFrame,
    held: Broadcast[Index],
    route: Callable[[Index, pa.RecordBatch], tuple[np.ndarray, np.ndarray]],
    look: Callable[[Part, pa.RecordBatch], Iterator[tuple]],
) -> DataFrame:
    """What anchors find in the parts they are routed to: n, score, id and number of the row, and the window."""
    spark = indexed.sparkSession
    out = spark.createDataFrame([], "n long, score long, id long, row long, k int").schema
    row, found = to_arrow_schema(spark.createDataFrame([], _ROW).schema), to_arrow_schema(out)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = held.value
        for batch in batches:
            most = max(1, STEP_VALUES // (index.dim * 8))
            for piece in (batch.slice(s, most) for s in range(0, len(batch), most)):
                which, parts = route(index, piece)
                sent = [piece.column(c).take(pa.array(which)) for c in row.names[2:]]
                yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(np.ones(len(parts)), pa.int32()), *sent], schema=row)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, asked in _runs(batches, held.value, STEP_VALUES):
            if rows := list(look(part, asked)):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), found, strict=True)], schema=found)

    sent = anchors.select("n", "id", "label", "v", "asked").mapInArrow(send, _ROW)
    return indexed.unionByName(sent).repartition("part").sortWithinPartitions("part", "kind").mapInArrow(meet, out)


def first(found: DataFrame, keys: list[str], wanted: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= wanted)


def build(rows: DataFrame, ways: int = WAYS, leaf_rows: int = LEAF_ROWS, part_values: int = PART_VALUES) -> tuple[DataFrame, Index]:
    """Rows (n, id, label, v) with their part, stored, and the index over all of them.

    The driver gets a sample of ``SAMPLE_ROWS`` different vectors at most, one count a
    leaf and one range for each node, split point and child; their number is bounded by the sample's size.
    """
    spark = rows.sparkSession
    total, dim = rows.agg(F.count("*"), F.max(F.size("v"))).first()
    dim = max(1, dim or 0)
    wanted = max(2, min(SAMPLE_ROWS, SAMPLE_VALUES // dim))
    code = F.xxhash64("v")
    some = rows.select(code.alias("code"), "v")
    if total > wanted:
        share = 1.5 * wanted / total
        some = some.where(F.abs(code % 1_000_000) < max(1, int(min(1.0, share) * 1_000_000)))
    some = some.groupBy("code").agg(F.any_value("v").alias("v")).orderBy("code").limit(wanted)
    vectors = [r.v for r in some.collect()]
    sample = np.zeros((len(vectors), dim))
    for i, v in enumerate(vectors):
        sample[i, : len(v)] = v
    tree = Tree(sample, total, ways, leaf_rows)
    shared = spark.sparkContext.broadcast(tree)

    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(kinds)
        for batch in batches:
            step = max(1, STEP_VALUES // dim)
            for piece in (batch.slice(s, step) for s in range(0, len(batch), step)):
                v = matrix(piece.column("v"), dim)
                leaves, counts = np.unique(shared.value.leaves_of(v), return_counts=True)
                found = list(shared.value.ranges_of(v)) + [(-1, int(x), 0, float(c), 0.0) for x, c in zip(leaves, counts, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), schema, strict=True)], schema=schema)

    kinds = spark.createDataFrame([], "node int, point int, child int, lo double, hi double").schema
    said = rows.select("v").mapInArrow(summaries, kinds).groupBy("node", "point", "child")
    said = said.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("lo").alias("rows")).collect()
    tree.take_ranges([(r.node, r.point, r.child, r.lo, r.hi) for r in said if r.node >= 0])
    index = Index(tree, {r.point: int(r.rows) for r in said if r.node < 0}, dim, part_values)
    held = spark.sparkContext.broadcast(index)
    schema = to_arrow_schema(spark.createDataFrame([], _ROW).schema)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = held.value
        for batch in batches:
            step = max(1, STEP_VALUES // dim)
            for piece in (batch.slice(s, step) for s in range(0, len(batch), step)):
                leaves = index.tree.leaves_of(matrix(piece.column("v"), dim))
                parts = index.part_of(leaves, piece.column("n").to_numpy())
                empty = pa.array([[]] * len(piece), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(parts, pa.int32()), pa.array(np.zeros(len(piece)), pa.int32()), *[piece.column(c) for c in schema.names[2:6]], empty],
                    schema=schema,
                )

    return stored(rows.select("n", "id", "label", "v").mapInArrow(dealt, _ROW)), index


def hard_negatives(
    rows: DataFrame,
    anchors: Column,
    *,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    window: tuple[int, int] = WINDOW,
    ways: int = WAYS,
    leaf_rows: int = LEAF_ROWS,
    part_values: int = PART_VALUES,
) -> DataFrame:
    """For each anchor's best rows of its label, the best rows of other labels whose score is in a window below theirs.

    ``rows`` has ``id`` long, ``label`` and ``v`` array<int>; rows with a null label or
    vector take no part.  ``anchors`` is a condition on these columns.  The score is the inner product,
    vectors of different lengths being filled with zeros; larger first, then smaller id, null ids last.  Repeated rows are rows of their own, also
    as anchors.  The window is in hundredths of the positive's score.  An empty table
    gives no rows.  The result is exact whatever the index rules out.
    """
    known = rows.select(F.monotonically_increasing_id().alias("n"), rows["id"], rows["label"].cast("long").alias("label"), rows["v"])
    known = stored(known.where("label is not null and v is not null"))
    indexed, index = build(known, ways, leaf_rows, part_values)
    asked = stored(known.where(anchors).withColumn("asked", F.array(F.lit(_NO_BOUND).cast("long"))))
    held = rows.sparkSession.sparkContext.broadcast(index)

    def home(index: Index, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        return index.parts_of(index.tree.leaves_of(matrix(batch.column("v"), index.dim)))

    def above(index: Index, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        return index.parts_asked(matrix(batch.column("v"), index.dim), *bounds(batch.column("asked")))

    def within(index: Index, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        return index.parts_asked(matrix(batch.column("v"), index.dim), *windows(batch.column("asked"), window))

    # the anchor's own leaf gives a bound on the scores of its best rows
    near = first(visited(indexed, asked, held, home, lambda part, batch: part.own(batch, positives)), ["n"], positives)
    bound = near.groupBy("n").agg(F.count("*").alias("found"), F.min("score").alias("least"))
    bound = bound.where(F.col("found") == positives).select("n", F.array("least").alias("bound"))
    bounded = asked.join(bound, "n", "left").withColumn("asked", F.coalesce("bound", "asked"))
    best = visited(indexed, bounded, held, above, lambda part, batch: part.positives(batch, positives))
    best = stored(first(best, ["n"], positives))
    scores = best.groupBy("n").agg(F.array_sort(F.collect_list(F.struct("rank", "score"))).alias("ranked"))
    asked = asked.drop("asked").join(scores.select("n", F.col("ranked.score").alias("asked")), "n")
    found = visited(indexed, asked, held, within, lambda part, batch: part.negatives(batch, negatives, window))
    found = first(found, ["n", "k"], negatives)
    pairs = best.select("n", (F.col("rank") - 1).alias("k"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    named = known.where(anchors).select("n", F.col("id").alias("anchor_id"))
    return (
        found.join(pairs, ["n", "k"])
        .join(named, "n")
        .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of ``embeddings``; anchors are those whose vec_id is divisible by 100."""
    rows = table(spark, sf_dir, "embeddings")
    label = rows["label"].cast("long")
    label = F.when(rows["vec_id"] % 7 == 0, (label + 1) % 10).otherwise(label)
    rows = rows.select(rows["vec_id"].cast("long").alias("id"), label.alias("label"), components(rows["embedding"]).alias("v"))
    return hard_negatives(rows, F.col("id") % 100 == 0)
