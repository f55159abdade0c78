"""Membership in long lists: filters, their exceptions, and the plans that use them."""

import random
import re

import pytest
from pyspark.sql import functions as F

from wordloom import operators as op
from wordloom.functions import membership as mem
from wordloom.session import kept
from wordloom.sources import lists


def words(rng, n):
    return sorted({"".join(rng.choices("abcdef", k=rng.randint(3, 7))) for _ in range(n)})


def made(spark, seed, n=3000):
    """Texts over many words, a few in every text, and a list that half of them are in."""
    rng = random.Random(seed)
    every = words(rng, n)
    listed = rng.sample(every, len(every) // 2) + [f"zz{w}" for w in every[:300]]
    texts = [" ".join([every[0], every[1], *rng.choices(every, k=40)]) for _ in range(200)] + ["", "...", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    return docs, texts, set(listed), spark.createDataFrame([(w,) for w in listed], "word string")


@pytest.mark.parametrize("bits,limit", [(16, 10), (4, 10), (4, 40)])
def test_levels_are_exact(spark, monkeypatch, bits, limit):
    monkeypatch.setattr(mem, "BITS_A_WORD", bits)
    docs, texts, listed, frame = made(spark, bits + limit)
    corpus = op.with_words(docs)
    found = mem.membership(corpus, frame, limit, kept)
    assert len(found.levels) >= (2 if bits < 16 else 1), len(found.levels)
    for keep in (True, False):
        got = {r.doc_id: r.words for r in found.filtered(corpus, keep).collect()}
        for i, text in enumerate(texts):
            want = None if text is None else [w for w in re.findall("[a-z]{3,}", text) if (w in listed) == keep]
            assert got[i] == want


def test_no_listed_word_is_missed_by_the_filter(spark):
    docs, _, listed, frame = made(spark, 5)
    size = mem.size_for(len(listed))
    row = mem.Membership([(mem.filter_bits(frame, size), size)], [])
    passed = row.attach(frame).where(mem.hit(size, "word")).count()
    assert passed == len(listed)
    other = spark.createDataFrame([(f"x{i}y",) for i in range(20_000)], "word string")
    assert row.attach(other).where(mem.hit(size, "word")).count() < 20_000 * 0.03


def test_sizes():
    assert [mem.size_for(n) for n in (0, 1, 4, 5, 100, 1 << 40)] == [64, 64, 64, 128, 2048, mem.MOST_BITS]


def test_a_list_too_long_for_a_filter_is_joined(spark, monkeypatch):
    monkeypatch.setattr(lists, "LITERAL_LIMIT", 10)
    docs, _, _, frame = made(spark, 6)
    short = sorted(map(str, op.with_words(docs, stopwords=frame).collect()))
    monkeypatch.setattr(mem, "MOST_WORDS", 100)
    joined = op.with_words(docs, stopwords=frame)
    assert "Join" in joined._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(str, joined.collect())) == short


@pytest.mark.parametrize("which", ["stopwords", "vocabulary"])
def test_rows_are_filtered_in_the_scan_stage(spark, monkeypatch, which):
    monkeypatch.setattr(lists, "LITERAL_LIMIT", 100)
    docs, *_, frame = made(spark, 7)
    scan = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    text = op.with_words(scan, **{which: frame})._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "Join" not in text and "Python" not in text
    assert text.count("regexp_extract_all") == 1 and "Subquery" in text


def test_both_lists_are_long(spark, monkeypatch):
    docs, texts, listed, frame = made(spark, 8)
    monkeypatch.setattr(lists, "LITERAL_LIMIT", 20)
    stop = frame.where(F.col("word") < "c")
    got = {r.doc_id: r.words for r in op.with_words(docs, stopwords=stop, vocabulary=frame).collect()}
    for i, text in enumerate(texts):
        assert got[i] == (None if text is None else [w for w in re.findall("[a-z]{3,}", text) if w in listed and w >= "c"])
    # a short stop list beside a long vocabulary, and the other way round
    few = ["aaa", *sorted(listed)[:3]]
    got = op.with_words(docs, stopwords=few, vocabulary=frame).select(F.explode("words").alias("w")).distinct().collect()
    assert {r.w for r in got} <= listed - set(few)
    got = op.with_words(docs, stopwords=frame, vocabulary=[*few, "bbb"]).select(F.explode("words").alias("w")).distinct().collect()
    assert {r.w for r in got} <= {*few, "bbb"} - listed


def test_empty_corpus_and_nulls_in_the_list(spark, monkeypatch):
    monkeypatch.setattr(lists, "LITERAL_LIMIT", 1)
    frame = spark.createDataFrame([("abc",), ("abd",), ("not plain",), (None,)], "word string")
    docs = spark.createDataFrame([(1, "abc abd abe")], "doc_id long, text string")
    assert [r.words for r in op.with_words(docs, stopwords=frame).collect()] == [["abe"]]
    assert op.with_words(docs.limit(0), stopwords=frame).count() == 0
