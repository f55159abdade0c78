import subprocess
import sys
from collections import Counter

import numpy as np
import plain
import pytest
from pyspark.sql import functions as F

from wordloom import operators as op
from wordloom import plans, sinks, sources
from wordloom.functions.pairs import record_cells
from wordloom.sources import lists

STOP = ["the", "and"]


@pytest.fixture(scope="module")
def vocabulary(docs):
    return [r.word for r in plans.top_words(docs, 50, stopwords=STOP).collect()]


@pytest.fixture(scope="module")
def texts(docs):
    return [r.text for r in docs.collect()]


def cells(df):
    rows = df.select("l", "r", "n").collect()
    out = {(r.l, r.r): r.n for r in rows}
    assert len(out) == len(rows)
    return out


def striped(df):
    return {r.word: r.stripe for r in df.collect()}


@pytest.mark.parametrize("d", [1, 2, 3, 4])
def test_pairs_equal_plain_python(docs, texts, vocabulary, d):
    got = cells(op.pairs(docs, vocabulary, d, stopwords=STOP))
    assert got == plain.pairs(texts, d, STOP, set(vocabulary))
    # the matrix as such: symmetric, even diagonal, known total
    assert all(got[b, a] == n for (a, b), n in got.items())
    assert all(n % 2 == 0 for (a, b), n in got.items() if a == b)
    lengths = [len(plain.tokens(t, STOP, set(vocabulary))) for t in texts]
    assert sum(got.values()) == 2 * sum(max(0, n - k) for n in lengths for k in range(1, d + 1))


def test_line_grain(docs, texts, vocabulary):
    lines = [line for t in texts for line in plain.lines(t)]
    got = cells(op.pairs(sources.records(docs, "line"), vocabulary, 2, stopwords=STOP))
    assert got == plain.pairs(lines, 2, STOP, set(vocabulary))
    assert got != cells(op.pairs(docs, vocabulary, 2, stopwords=STOP))


def test_every_word_and_distance_beyond_the_record(corpus):
    texts = ["one two three two", "four", "", "five five five", "one two"]
    for d in (1, 2, 5, 10**9):
        assert cells(op.pairs(corpus(*texts), None, d)) == plain.pairs(texts, min(d, 10))


def test_self_pair_counts_twice(corpus):
    assert cells(op.pairs(corpus("time time"), ["time"], 1)) == {("time", "time"): 2}


def test_distance_is_counted_after_filtering(corpus):
    docs = corpus("cat xxx yyy the dog")
    assert cells(op.pairs(docs, ["cat", "dog"], 1, stopwords=STOP)) == {
        ("cat", "dog"): 1, ("dog", "cat"): 1,
    }


@pytest.mark.parametrize("d", [0, -1])
def test_no_distance_no_pairs(corpus, d):
    docs = corpus("cat dog", "cat")
    assert cells(op.pairs(docs, ["cat", "dog"], d)) == {}
    assert cells(op.pairs_by_record(docs, ["cat", "dog"], d)) == {}
    assert cells(op.pairs_sweep(docs, ["cat", "dog"], d)) == {}
    assert striped(op.stripes(docs, ["cat", "dog"], d)) == {}
    alone = op.stripes(docs, ["cat", "dog"], d, keep_isolated=True)
    assert striped(alone) == {"cat": {}, "dog": {}}


def test_empty_vocabulary_gives_an_empty_matrix(corpus):
    assert cells(op.pairs(corpus("cat dog"), [], 1)) == {}


def test_by_record_and_roll_up(docs, texts, vocabulary):
    by_record = op.pairs_by_record(docs, vocabulary, 2, stopwords=STOP)
    assert by_record.columns == ["doc_id", "l", "r", "n"]
    got = {(r.doc_id, r.l, r.r): r.n for r in by_record.collect()}
    want = {}
    for r in docs.collect():
        for (a, b), n in plain.pairs([r.text], 2, STOP, set(vocabulary)).items():
            want[r.doc_id, a, b] = n
    assert got == want
    assert cells(op.roll_up(by_record)) == cells(op.pairs(docs, vocabulary, 2, stopwords=STOP))


def test_sweep_equals_single_runs(docs, vocabulary):
    sweep = op.pairs_sweep(docs, vocabulary, 4, stopwords=STOP).collect()
    for d in (1, 2, 3, 4):
        one = {(r.l, r.r): r.n for r in sweep if r.d == d}
        assert one == cells(op.pairs(docs, vocabulary, d, stopwords=STOP))


@pytest.mark.parametrize("d", [1, 3])
def test_stripes_are_pairs(docs, vocabulary, d):
    stripes = op.stripes(docs, vocabulary, d, stopwords=STOP)
    pairs = cells(op.pairs(docs, vocabulary, d, stopwords=STOP))
    assert cells(op.stripes_to_pairs(stripes)) == pairs
    for word, stripe in striped(stripes).items():
        assert stripe and {(word, r): n for r, n in stripe.items()}.items() <= pairs.items()


def test_isolated_words(corpus):
    docs = corpus("cat dog", "year", "cat", "moon year2 sun")
    vocabulary = ["cat", "dog", "year", "moon", "absent"]
    plainly = {"cat": {"dog": 1}, "dog": {"cat": 1}, "moon": {"year": 1}, "year": {"moon": 1}}
    assert striped(op.stripes(docs, vocabulary, 1)) == plainly
    docs = corpus("cat dog", "year", "cat", "moon moon")
    got = striped(op.stripes(docs, vocabulary, 1, keep_isolated=True))
    assert got == {"cat": {"dog": 1}, "dog": {"cat": 1}, "year": {}, "moon": {"moon": 2}}
    text = {r.word: r.stripe for r in sinks.stripe_text(op.stripes(docs, vocabulary, 1, keep_isolated=True)).collect()}
    assert text["year"] == "{}" and text["cat"] == "{dog:1}"


def test_stripes_by_record_and_merge(docs, vocabulary):
    by_record = op.stripes_by_record(docs, vocabulary, 2, stopwords=STOP)
    got = {(r.doc_id, r.word): r.stripe for r in by_record.collect()}
    want = {}
    for r in docs.collect():
        for w in plain.tokens(r.text, STOP, set(vocabulary)):
            want.setdefault((r.doc_id, w), {})
        for (a, b), n in plain.pairs([r.text], 2, STOP, set(vocabulary)).items():
            want[r.doc_id, a][b] = n
    assert got == want
    merged = striped(op.merge_stripes(by_record))
    assert merged == striped(op.stripes(docs, vocabulary, 2, stopwords=STOP, keep_isolated=True))


def test_stripe_neighbours_are_in_order(docs, vocabulary):
    for df in (op.stripes(docs, vocabulary, 2), op.stripes_by_record(docs, vocabulary, 2)):
        keys = df.select(F.map_keys("stripe").alias("keys")).collect()
        assert all(r["keys"] == sorted(r["keys"]) for r in keys)


def test_stripes_in_parts(docs, vocabulary):
    want = op.stripes(docs, vocabulary, 2, keep_isolated=True)
    cut = op.stripes(docs, vocabulary, 2, keep_isolated=True, parts=3)
    assert cut.columns == ["part", "word", "stripe"] and cut.select("part").distinct().count() == 3
    assert cells(op.stripes_to_pairs(cut)) == cells(op.pairs(docs, vocabulary, 2))
    def exact(df):
        return sorted((r.word, sorted(r.stripe.items())) for r in df.collect())
    assert exact(op.merge_stripes(cut)) == exact(want)
    again = op.merge_stripes(cut, parts=3)
    assert sorted(map(str, again.collect())) == sorted(map(str, cut.collect()))
    assert cells(op.stripes_to_pairs(op.stripes(docs, None, 1, parts=5))) == cells(op.pairs(docs, None, 1))
    with pytest.raises(ValueError):
        op.stripes(docs, vocabulary, 1, parts=0)


def test_stripes_sweep(docs, vocabulary):
    swept = op.stripes_sweep(docs, vocabulary, 3)
    for d in (1, 2, 3):
        one = swept.where(F.col("d") == d).select("word", "stripe")
        assert cells(op.stripes_to_pairs(one)) == cells(op.pairs(docs, vocabulary, d))


def test_sweep_plan_does_not_grow(docs, vocabulary):
    def size(d):
        return len(op.pairs_sweep(docs, vocabulary, d)._jdf.queryExecution().optimizedPlan().toString())
    assert abs(size(4) - size(400)) < 50
    assert op.pairs_sweep(docs, vocabulary, 10**6).where("d = 3").count() == op.pairs(docs, vocabulary, 3).count()


def test_long_record_and_large_distance(spark):
    """Two words in turns, 3,000 of them, at a distance as large: counts, not pairs, are kept."""
    docs = spark.createDataFrame([(1, "hot cold " * 1500), (2, "hot"), (3, "cold hot")], "doc_id long, text string")
    rows = {(r.doc_id, r.l, r.r): r.n for r in op.pairs_by_record(docs, None, 3000).collect()}
    assert rows == {
        (1, "hot", "hot"): 1500 * 1499, (1, "cold", "cold"): 1500 * 1499,
        (1, "hot", "cold"): 1500 * 1500, (1, "cold", "hot"): 1500 * 1500,
        (3, "hot", "cold"): 1, (3, "cold", "hot"): 1,
    }
    striped = {(r.doc_id, r.word): r.stripe for r in op.stripes_by_record(docs, None, 3000).collect()}
    assert striped[2, "hot"] == {} and striped[1, "hot"] == {"cold": 1500 * 1500, "hot": 1500 * 1499}


def test_long_vocabulary_gives_the_same_matrix(docs, spark, vocabulary, monkeypatch):
    want = cells(op.pairs(docs, vocabulary, 2, stopwords=STOP))
    frame = spark.createDataFrame([(w,) for w in vocabulary], "word string")
    monkeypatch.setattr(lists, "LITERAL_LIMIT", 10)
    assert cells(op.pairs(docs, frame, 2, stopwords=STOP)) == want


def test_pipeline(docs, texts):
    top = [r.word for r in plans.top_words(docs, 20, stopwords=STOP).collect()]
    got = cells(plans.cooccurrence(docs, k=20, distance=2, stopwords=STOP))
    assert got == plain.pairs(texts, 2, STOP, set(top))
    stripes = plans.cooccurrence(docs, k=20, distance=2, layout="stripes", stopwords=STOP)
    assert cells(op.stripes_to_pairs(stripes)) == got
    with pytest.raises(ValueError):
        plans.cooccurrence(docs, layout="cells")


def test_one_document_holds_most_of_the_corpus(spark):
    """A third and more of all words in one record, and one word a third of them."""
    long = " ".join(("hot", f"w{'abc'[i % 3]}x", "hot")[i % 3] for i in range(60_000))
    texts = [long] + ["hot cold cold"] * 50
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    vocabulary = ["hot", "cold", "wax", "wbx"]
    got = cells(op.pairs(docs, vocabulary, 3))
    want = Counter()
    words = plain.tokens(long, (), set(vocabulary))
    for k in (1, 2, 3):
        for a, b in zip(words, words[k:]):
            want[a, b] += 1
            want[b, a] += 1
    want += plain.pairs(texts[1:], 3, (), set(vocabulary))
    assert got == want
    rolled = op.roll_up(op.pairs_by_record(docs, vocabulary, 3))
    assert cells(rolled) == got


@pytest.mark.parametrize("distance,lone", [(0, True), (1, True), (3, False), (7, True), (10**9, True)])
@pytest.mark.parametrize("most", [1, 5, 40, 1 << 20])
def test_cells_in_pieces(distance, lone, most):
    rng = np.random.default_rng(distance % 97 + most)
    sizes = np.array([0, 1, 12, 2, 0, 30, 1, 7])
    words = np.concatenate([rng.integers(0, 6, sizes[:5].sum()), rng.integers(0, 3, 30), rng.integers(0, 9, 8)])
    want, at = Counter(), 0
    for rec, size in enumerate(sizes):
        mine = words[at : at + size].tolist()
        at += size
        for i, a in enumerate(mine):
            near = [b for j, b in enumerate(mine) if i != j and abs(i - j) <= distance]
            want.update((rec, a, b) for b in near)
            if lone and not near:
                want[rec, a, -1] = 0
    pieces = list(record_cells(words, sizes, 9, distance, lone, most))
    got = [cell for p in pieces for cell in zip(*(x.tolist() for x in p), strict=True)]
    assert got == sorted((*k, n) for k, n in want.items())
    if most == 1:
        rows = [{(r, l) for r, l in zip(p[0].tolist(), p[1].tolist())} for p in pieces]
        assert len(rows) == len({x for r in rows for x in r})  # no row of a matrix is cut


def test_intervals(docs, vocabulary):
    steps = op.pairs_intervals(docs, vocabulary, 10**9, stopwords=STOP)
    few = op.pairs_sweep(docs, vocabulary, 10**9, distances=[2, 4, 10**9], stopwords=STOP)
    assert steps.where("to = 1000000000").count() == steps.select("l", "r").distinct().count()
    for d in (2, 4, 10**9):
        held = steps.where(F.lit(d).between(F.col("from"), F.col("to")))
        want = cells(op.pairs(docs, vocabulary, d, stopwords=STOP))
        assert cells(held) == want == cells(few.where(F.col("d") == d))
    assert op.pairs_sweep(docs, vocabulary, 3, distances=[], stopwords=STOP).count() == 0


MEMORY = """
import resource, sys
import numpy as np
from wordloom.functions.pairs import record_cells
rng = np.random.default_rng(1)
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
sizes = np.array([int(x) for x in sys.argv[1].split(",")])
total = sum(int(p[3].sum()) for p in record_cells(rng.integers(0, 5000, sizes.sum()), sizes, 5000, int(sys.argv[2]), False))
print(total, (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""


@pytest.mark.parametrize("sizes,distance", [([300] * 800, 500), ([40_000], 500), ([3000], 10**9)])
def test_memory_does_not_follow_the_matrix(sizes, distance):
    """800 records of 300 words are what a task counts together; a matrix of all pairs would have 10^8 cells."""
    said = subprocess.run([sys.executable, "-c", MEMORY, ",".join(map(str, sizes)), str(distance)], capture_output=True, text=True, timeout=200, check=True)
    total, megabytes = map(int, said.stdout.split())
    assert total == sum(min(n - 1, distance) * (2 * n - min(n - 1, distance) - 1) for n in sizes)
    assert megabytes < 300
