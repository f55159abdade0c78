"""The forward index: the same results as from texts, without reading them."""

import pytest

from wordloom import operators as op

STOP = ["the", "and", "der"]


@pytest.fixture(scope="module")
def index(spark, docs, tmp_path_factory):
    more = docs.sparkSession.createDataFrame([(900, ""), (901, None), (902, "Time, times; the timing"), (902, "Time, times; the timing")], "doc_id long, text string")
    every = docs.unionByName(more)
    path = str(tmp_path_factory.mktemp("index"))
    return every, op.build_index(every, path + "/one"), path + "/one"


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()))


def test_results_equal_those_from_texts(spark, index):
    docs, built, path = index
    top = [r.word for r in op.top_k(op.word_counts(docs, stopwords=STOP), 30).collect()]
    for one in (built, op.open_index(spark, path)):
        assert rows(op.indexed_counts(one, stopwords=STOP)) == rows(op.word_counts(docs, stopwords=STOP))
        assert rows(op.indexed_document_frequency(one, stopwords=STOP)) == rows(op.document_frequency(docs, stopwords=STOP))
    for d in (1, 3):
        assert rows(op.indexed_pairs(built, top, d, stopwords=STOP)) == rows(op.pairs(docs, top, d, stopwords=STOP))
    assert rows(op.indexed_pairs(built, [], 2)) == []


def test_no_text_is_read_again(index):
    _, built, _ = index
    for df in (op.indexed_pairs(built, ["time", "for"], 2), op.indexed_document_frequency(built)):
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "regexp_extract_all" not in text and "Python" not in text
    text = op.indexed_pairs(built, ["time", "for"], 2)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<words:array<bigint>>" in text


def test_null_and_empty_texts(index):
    _, built, _ = index
    got = {r.doc_id: r.words for r in op.indexed_words(built).where("doc_id >= 900").collect()}
    assert got[900] == [] and got[901] is None and len(got[902]) == 4


def test_lists_too_long_for_literals_are_refused(spark, index, monkeypatch):
    from wordloom.sources import lists

    monkeypatch.setattr(lists, "LITERAL_LIMIT", 1)
    with pytest.raises(ValueError, match="fit into literals"):
        op.indexed_words(index[1], stopwords=STOP)
