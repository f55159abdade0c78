import math
from collections import Counter

import plain
import pytest

from wordloom import operators as op
from wordloom import plans, sinks, sources
from wordloom.operators import relevance
from wordloom.sources import lists

STOP = ["the", "and", "der"]


def plain_df(texts):
    out = Counter()
    for text in texts:
        out.update({plain.stem(w) for w in plain.tokens(text, STOP)} - {""})
    return out


def table(spark, rows):
    return spark.createDataFrame(rows, "term string, df long")


def test_document_frequency(docs):
    texts = [r.text for r in docs.collect()]
    got = {r.term: r.df for r in op.document_frequency(docs, stopwords=STOP).collect()}
    assert got == plain_df(texts)
    assert max(got.values()) <= len(texts)
    lines = [line for t in texts for line in plain.lines(t)]
    by_line = op.document_frequency(sources.records(docs, "line"), stopwords=STOP)
    assert {r.term: r.df for r in by_line.collect()} == plain_df(lines)


def test_stems_collapse_inside_a_record(corpus):
    docs = corpus("uses used", "use", "nothing")
    got = {r.term: r.df for r in op.document_frequency(docs).collect()}
    assert got == {"us": 2, "noth": 1}


def test_length_and_stop_tests_precede_stemming(corpus):
    docs = corpus("us uses running run")
    got = {r.term for r in op.document_frequency(docs, stopwords=["run"]).collect()}
    assert got == {"us", "run"}


def test_term_frequency_and_scores(docs, spark):
    top = [(r.term, r.df) for r in plans.top_terms(docs, 30, stopwords=STOP).collect()]
    known = dict(top)
    # repeated terms: the largest df counts
    top += [(t, df - 1) for t, df in top[:10]] + [(None, 3), ("zzz", None)]
    want = {}
    for r in docs.collect():
        for t, n in Counter(plain.stem(w) for w in plain.tokens(r.text, STOP)).items():
            if t in known:
                want[r.doc_id, t] = n
    tf = op.term_frequency(docs, table(spark, top), stopwords=STOP)
    assert tf.columns == ["doc_id", "term", "tf"]
    assert {(r.doc_id, r.term): r.tf for r in tf.collect()} == want
    scores = op.tfidf(docs, table(spark, top), stopwords=STOP)
    assert scores.columns == ["doc_id", "term", "score"]
    got = {(r.doc_id, r.term): r.score for r in scores.collect()}
    assert got.keys() == want.keys()
    for key, tf_ in want.items():
        assert got[key] == pytest.approx(tf_ * math.log(10_000 / known[key[1]] + 1), abs=1e-9)


def test_long_df_table_gives_the_same(docs, spark, monkeypatch):
    top = [(r.term, r.df) for r in plans.top_terms(docs, 30, stopwords=STOP).collect()]
    # repeated terms: the largest df counts
    top += [(t, df - 1) for t, df in top[:10]] + [(None, 3), ("zzz", None)]
    frame = table(spark, top)
    want = sorted(map(tuple, op.tfidf(docs, frame, stopwords=STOP).collect()))
    want_tf = sorted(map(tuple, op.term_frequency(docs, frame, stopwords=STOP).collect()))
    monkeypatch.setattr(relevance, "LITERAL_LIMIT", 5)
    got_tf = op.term_frequency(docs, frame, stopwords=STOP)
    assert sorted(map(tuple, got_tf.collect())) == want_tf
    assert got_tf.columns == ["doc_id", "term", "tf"]
    got = op.tfidf(docs, frame, stopwords=STOP)
    assert got.columns == ["doc_id", "term", "score"]
    assert sorted(map(tuple, got.collect())) == want


def test_long_stop_list(docs, monkeypatch):
    want = sorted(map(tuple, op.document_frequency(docs, stopwords=STOP).collect()))
    monkeypatch.setattr(lists, "LITERAL_LIMIT", 2)
    assert sorted(map(tuple, op.document_frequency(docs, stopwords=STOP).collect())) == want


def test_published_scores(corpus, spark):
    """Term frequency 1, 2 and 9 with their document frequencies and N = 10000."""
    docs = corpus("first time times " + "early " * 9)
    df = table(spark, [("first", 7689), ("time", 7349), ("earli", 5473)])
    rows = sinks.score_text(op.tfidf(docs, df)).collect()
    assert {r.term: r.score for r in rows} == {"first": "0.8332", "time": "1.7179", "earli": "9.3534"}


def test_records_are_not_merged_by_id(spark):
    """Two records with one id stay two, as lines of one file do."""
    docs = spark.createDataFrame([("a", "time time"), ("a", "time")], "doc_id string, text string")
    df = table(spark, [("time", 2)])
    assert sorted(r.tf for r in op.term_frequency(docs, df).collect()) == [1, 2]
    assert op.document_frequency(docs).first().df == 2


def test_number_of_documents(corpus, spark):
    docs = corpus("time", "time", "moon")
    df = table(spark, [("time", 2)])
    got = [r.score for r in op.tfidf(docs, df, n_docs=None).collect()]
    assert got == pytest.approx([math.log(3 / 2 + 1)] * 2)


def test_pipeline_equals_its_parts(docs):
    whole = plans.top_term_scores(docs, k=10, stopwords=STOP)
    parts = op.tfidf(docs, plans.top_terms(docs, 10, stopwords=STOP), stopwords=STOP)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, parts.collect()))


def test_record_columns_may_have_any_name(spark):
    """Short names of the expressions do not get in the way of the caller's columns."""
    docs = spark.createDataFrame(
        [(1, 2, 3, 4, 5, 6, 7, "time moon time")],
        "c int, s int, p int, v int, i int, at int, lag int, text string",
    )
    df = table(spark, [("time", 2)])
    assert op.tfidf(docs, df).count() == 1
    assert tuple(op.term_frequency(docs, df).first()) == (1, 2, 3, 4, 5, 6, 7, "time", 2)
    assert op.pairs_by_record(docs, None, 1).count() == 2
    assert op.stripes_by_record(docs, ["time", "moon"], 1).count() == 2
    assert sources.records(docs, "line").count() == 1
