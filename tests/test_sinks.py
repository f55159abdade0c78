from glob import glob

import pytest
from pyspark.errors import AnalysisException

from wordloom import sinks


def lines(path):
    out = []
    for name in sorted(glob(f"{path}/part-*")):
        with open(name, encoding="utf-8") as f:
            out += f.read().splitlines()
    return out


@pytest.fixture(scope="module")
def counts(spark):
    rows = [(f"w{i:04d}", i * 7 % 101) for i in range(2000)] + [('q"uo te', 1), ("é", 2)]
    return spark.createDataFrame(rows, "word string, n long").repartition(7)


def test_sorted_files(counts, tmp_path):
    path = str(tmp_path / "out")
    sinks.write_tsv(counts, path, "word")
    want = sorted((f"{r.word}\t{r.n}" for r in counts.collect()), key=str.encode)
    assert lines(path) == want
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        sinks.write_tsv(counts, path, "word")


def test_single_file(counts, tmp_path):
    path = str(tmp_path / "out")
    sinks.write_tsv(counts.limit(300), path, "word", single_file=True)
    assert len(glob(f"{path}/part-*")) == 1
    got = lines(path)
    assert len(got) == 300 and got == sorted(got, key=str.encode)


def test_unsorted(counts, tmp_path):
    path = str(tmp_path / "out")
    sinks.write_tsv(counts, path)
    assert len(lines(path)) == 2002


def test_text_forms(spark):
    pairs = spark.createDataFrame([("a", "b", 3)], "l string, r string, n long")
    assert sinks.tsv_lines(sinks.pair_text(pairs)).first()[0] == "(a,b)\t3"
    stripes = spark.createDataFrame(
        [("a", {"c": 1, "b": 20}), ("d", {})], "word string, stripe map<string,long>"
    )
    text = [r.value for r in sinks.tsv_lines(sinks.stripe_text(stripes)).collect()]
    assert text == ["a\t{b:20, c:1}", "d\t{}"]
    scores = spark.createDataFrame([("7", "time", 1.71785), ("7", "x", 2.0)], "doc_id string, term string, score double")
    text = [r.value for r in sinks.tsv_lines(sinks.score_text(scores)).collect()]
    assert text == ["7\ttime\t1.7179", "7\tx\t2.0000"]


def test_nulls_are_empty_fields(spark):
    df = spark.createDataFrame([(None, "a", 1.0), ("k", None, None)], "id string, term string, score double")
    assert sorted(r.line for r in sinks.tsv_lines(df, "line").collect()) == ["\ta\t1.0", "k\t\t"]
