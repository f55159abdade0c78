from collections import Counter

import plain
import pytest
from pyspark.sql import functions as F

from wordloom import operators as op
from wordloom import plans
from wordloom.functions import with_runs
from wordloom.sources import lists

STOP = ["the", "and", "der"]


def words_of(df):
    return {r.doc_id: r.words and list(r.words) for r in df.collect()}


def test_tokens(corpus):
    docs = corpus("Café au LAIT, l'été: x1yzz\tabc--ABC", "", "  ab the THE", "Hello World ab")
    assert words_of(op.with_words(docs)) == {
        1: ["caf", "lait", "yzz", "abc", "abc"], 2: [], 3: ["the", "the"], 4: ["hello", "world"],
    }
    assert words_of(op.with_words(docs, case_sensitive=True))[4] == ["ello", "orld"]
    assert words_of(op.with_words(docs, min_len=2))[3] == ["ab", "the", "the"]
    assert words_of(op.with_words(docs, stopwords=["abc", "the"])) == {
        1: ["caf", "lait", "yzz"], 2: [], 3: [], 4: ["hello", "world"],
    }
    with pytest.raises(ValueError):
        op.with_words(docs, min_len=0)


def test_vocabulary_less_stopwords(corpus):
    docs = corpus("aaa bbb ccc bbb ddd")
    got = op.with_words(docs, vocabulary=["bbb", "ccc", "aaa"], stopwords=["aaa"])
    assert words_of(got) == {1: ["bbb", "ccc", "bbb"]}
    assert words_of(op.with_words(docs, vocabulary=[])) == {1: []}


@pytest.mark.parametrize("limit", [1, 2, 3])
def test_long_lists_give_the_same_words(corpus, docs, monkeypatch, limit):
    """Around the limit the stop list, the vocabulary or both are joined."""
    vocabulary, stop = ["and", "for", "that", "was"], ["and", "xyz"]
    more = docs.sparkSession.createDataFrame([(900, "xyz and"), (901, ""), (902, None), (900, "xyz and")], "doc_id long, text string")
    docs = docs.unionByName(more)
    def exact(df):
        return df.columns, sorted(map(str, df.collect()))
    every = [dict(vocabulary=vocabulary, stopwords=stop), dict(vocabulary=vocabulary), dict(stopwords=stop)]
    before = [exact(op.with_words(docs, **o)) for o in every]
    want = words_of(op.with_words(docs, vocabulary=vocabulary, stopwords=stop))
    monkeypatch.setattr(lists, "LITERAL_LIMIT", limit)
    got = words_of(op.with_words(docs, vocabulary=vocabulary, stopwords=stop))
    assert got == want and [] in got.values()
    assert [exact(op.with_words(docs, **o)) for o in every] == before


def test_long_stop_list_in_counts(docs, monkeypatch):
    want = sorted(map(tuple, op.word_counts(docs, stopwords=STOP).collect()))
    monkeypatch.setattr(lists, "LITERAL_LIMIT", 2)
    assert sorted(map(tuple, op.word_counts(docs, stopwords=STOP).collect())) == want


def test_counts_equal_plain_python(docs):
    texts = [r.text for r in docs.collect()]
    want = Counter(w for t in texts for w in plain.tokens(t, STOP))
    got = {r.word: r.n for r in op.word_counts(docs, stopwords=STOP).collect()}
    assert got == want
    everything = op.word_counts(docs).agg(F.sum("n")).first()[0]
    assert everything == sum(len(plain.tokens(t)) for t in texts)


def test_ties_rank_by_word_descending(corpus):
    docs = corpus("nation present nation present other zzz")
    top = [tuple(r) for r in plans.top_words(docs, 3).collect()]
    assert top == [("present", 2), ("nation", 2), ("zzz", 1)]


def test_head_and_row_counts(docs):
    counts = op.word_counts(docs)
    first = [r.word for r in op.head(counts, "word", rows=5).collect()]
    assert first == sorted(r.word for r in counts.collect())[:5]
    sizes = op.row_counts({"words": counts, "docs": docs})
    assert {r.result: r.n_rows for r in sizes.collect()} == {"words": counts.count(), "docs": 200}


def test_runs(spark):
    df = spark.createDataFrame(
        [(1, ["b", "a", "b", "b"]), (2, []), (3, ["x"]), (4, None)], "id int, v array<string>"
    )
    got = {r.id: r.c and [tuple(x) for x in r.c] for r in with_runs(df, "v", "c").collect()}
    assert got == {1: [("a", 1), ("b", 3)], 2: [], 3: [("x", 1)], 4: None}


KEYS = ["n", "l", "r", "word", "words", "term", "tf", "df", "stripe", "score", "__key"]


@pytest.mark.parametrize("key", KEYS)
def test_key_columns_work_or_are_refused_by_name(docs, spark, key):
    named = docs.withColumnRenamed("doc_id", key)
    table = spark.createDataFrame([("the", 3), ("that", 2)], "term string, df long")
    calls = [
        lambda: op.with_words(named),
        lambda: op.pairs_by_record(named, ["the", "that"], 2),
        lambda: op.stripes_by_record(named, ["the", "that"], 2),
        lambda: op.term_frequency(named, table),
        lambda: op.tfidf(named, table),
    ]
    for call in calls:
        try:
            df = call()
        except ValueError as error:
            assert repr(key) in str(error)
        else:
            assert key in df.columns and df.count() > 0
    assert op.pairs(named, ["the", "that"], 2).count() > 0
