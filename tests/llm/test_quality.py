import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wordloom.llm import quality_classifier as kernel
from wordloom.llm.doc_stats import COUNTS, counts
from wordloom.llm.quality_rules import RATIOS, DecisionList, fit, judged, learn


def brute(text):
    words = [w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", text)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if x.strip(" \t\n\v\f\r")]
    seen, dup = set(), 0
    for x in lines:
        dup += x in seen
        seen.add(x)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "é#", "x\n", "\n", "a b c d e ", " \t", "|<", " "]), max_size=40).map(" ".join))
def test_counts(text):
    assert counts(text.encode())[:5] == brute(text)


def test_many_kinds_of_words():
    words = [f"w{i}" for i in range(9000)] + [f"w{i}" for i in range(7)]
    assert counts(" ".join(words).encode())[4] == 14


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(3)
    def text(bad):
        words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(rng.randint(20, 80))]
        return " ".join(w + "###" if bad and rng.random() < 0.8 else w for w in words) + "."
    rows = [(i, text(i % 5 == 0), int(i % 5 != 0)) for i in range(1500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int").repartition(4)
    return df.select("doc_id", "text"), df.select("doc_id", "quality")


def test_rules_learn_and_keep_clean_documents(labelled):
    docs, labels = labelled
    rules = fit(docs, labels.where("doc_id % 3 <> 0"))
    assert rules.rules and str(rules).startswith("reject if ")
    rows = judged(docs, rules).select("row.doc_id", "kept").collect()
    good = [r.kept for r in rows if r.doc_id % 5]
    bad = [r.kept for r in rows if not r.doc_id % 5]
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.05


def test_numpy_and_spark_judge_alike(labelled):
    docs, labels = labelled
    rules = fit(docs, labels)
    rows = judged(docs, rules).select(*[F.col(a) / F.greatest(F.col(b), F.lit(1)) for a, b in RATIOS.values()], "rule").collect()
    x = {name: np.array([r[i] for r in rows]) for i, name in enumerate(RATIOS)}
    assert rules.rejects(x).tolist() == [r["rule"] is not None for r in rows]


def test_no_examples(spark, odd, none):
    labels = spark.createDataFrame([(2, None), (None, 1)], "doc_id long, quality int")
    rules = fit(odd, labels)
    assert rules.rules == [] and str(rules) == "\nelse keep"
    rows = judged(odd, rules).select("row.doc_id", "n_words", "base_failed", "kept").collect()
    assert len(rows) == 9 and all(r.base_failed for r in rows if r.n_words < 10)
    assert judged(none, DecisionList()).count() == 0
    assert learn({"a": np.zeros(0)}, np.zeros(0, bool), np.zeros(0, bool)).rules == []


def test_kernel_scores(labelled):
    docs, labels = labelled
    scores = kernel.quality_scores(docs, labels, F.col("doc_id") % 4 != 2).collect()
    held = [r for r in scores if r.doc_id % 4 == 2]
    assert all(0 <= r.score <= 1 for r in scores)
    assert np.mean([(r.score >= 0.7) == (r.doc_id % 5 != 0) for r in held]) > 0.97


def test_isotonic_rises():
    rng = np.random.default_rng(0)
    n = rng.integers(0, 20, 100)
    knots, levels = kernel.isotonic(n.astype(float), rng.binomial(n, np.linspace(0.1, 0.9, 100)).astype(float))
    assert (np.diff(levels) >= 0).all() and (np.diff(knots) >= 0).all() and 0 < levels[0] and levels[-1] < 1


def test_kernel_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(None, 1), (3, None)], "doc_id long, quality int")
    rows = kernel.quality_scores(odd, labels, F.lit(True)).collect()
    assert len(rows) == 9 and {r.score for r in rows} == {0.5}
    assert kernel.quality_scores(none, labels, F.lit(True)).count() == 0


def test_sums_equal_numpy(spark, labelled):
    from wordloom.llm.doc_stats import doc_counts

    stats = doc_counts(labelled[0])
    got = kernel.summed(stats, lambda b: np.array([b.num_rows, kernel.inputs(b).sum()]), 2)
    rows = stats.select(*COUNTS).toArrow()
    want = kernel.inputs(rows.to_batches()[0]).sum() if rows.num_rows and len(rows.to_batches()) == 1 else None
    assert got[0] == 1500 and (want is None or abs(got[1] - want) < 1e-6 * abs(want))


def test_rules_for_many_kinds_of_bad_rows():
    """More kinds than twelve, after one that no precise rule separates."""
    import numpy as np

    from wordloom.llm.quality_rules import learn

    rng = np.random.default_rng(4)
    kind = np.repeat(np.arange(40), 90)
    # odd kinds are bad, and lie between good ones; kind 41 is half good, half bad
    value = np.concatenate([kind + 0.5 * rng.random(len(kind)), 41 + 0.5 * rng.random(800)])
    bad = np.concatenate([kind % 2 == 1, rng.random(800) < 0.5])
    grows = rng.random(len(value)) < 2 / 3
    x = {"a": value, "b": rng.random(len(value))}
    found = learn(x, bad, grows)
    caught, clear = found.rejects(x), np.arange(len(value)) < len(kind)
    assert len(found.rules) > 12
    assert caught[bad & clear].mean() > 0.95 and caught[~bad & clear].mean() < 0.02
