import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from wordloom import sources
from wordloom.sources import lists

MIXED = "a\rb\r\nc\n\nd"


def write(path, data):
    path.write_bytes(data.encode() if isinstance(data, str) else data)
    return str(path)


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_text_lines_and_documents(spark, tmp_path):
    write(tmp_path / "7.txt", MIXED)
    write(tmp_path / "100.txt.txt", "one\ntwo\n")
    write(tmp_path / "empty.txt", "")
    got = rows(sources.read_text(spark, str(tmp_path), "line"), "doc_id", "text")
    want = [("7", t) for t in ("a", "b", "c", "", "d")] + [("100", "one"), ("100", "two")]
    assert got == sorted(want)
    whole = dict(rows(sources.read_text(spark, str(tmp_path)), "doc_id", "text"))
    assert {k: v for k, v in whole.items() if v} == {"7": MIXED, "100": "one\ntwo\n"}


def test_text_glob_and_list(spark, tmp_path):
    for name in ("a1", "a2", "b1"):
        write(tmp_path / f"{name}.txt", name)
    assert rows(sources.read_text(spark, f"{tmp_path}/a*.txt", "line"), "doc_id") == [("a1",), ("a2",)]
    both = [f"{tmp_path}/a1.txt", f"{tmp_path}/b1.txt"]
    assert rows(sources.read_text(spark, both), "doc_id") == [("a1",), ("b1",)]


def test_bad_bytes_separate_words(spark, tmp_path):
    from wordloom import operators

    write(tmp_path / "x.txt", b"good\xff\xfeword caf\xc3\xa9s")
    counts = operators.word_counts(sources.read_text(spark, str(tmp_path)))
    assert rows(counts, "word", "n") == [("caf", 1), ("good", 1), ("word", 1)]


def test_table_lines_keep_order_and_terminators_end_lines(corpus):
    docs = corpus(MIXED, "x\n", "\n\n", "", "one")
    got = rows(sources.lines(docs), "doc_id", "line_no", "text")
    assert got == [
        (1, 0, "a"), (1, 1, "b"), (1, 2, "c"), (1, 3, ""), (1, 4, "d"),
        (2, 0, "x"), (3, 0, ""), (3, 1, ""), (5, 0, "one"),
    ]


def test_max_line_counts_bytes_and_terminators(corpus, spark, tmp_path):
    # sizes: 4 (with \n), 5 (with \r\n), 4 (two-byte letter and \n), 3 (unterminated)
    docs = corpus("abc\nabc\r\né1\nabc")
    assert rows(sources.lines(docs, max_line=5), "line_no", "text") == [(0, "abc"), (2, "é1"), (3, "abc")]
    assert rows(sources.lines(docs, max_line=4), "text") == [("abc",)]
    assert rows(sources.lines(docs, max_line=100), "text") == rows(sources.lines(docs), "text")
    assert sources.records(docs, max_line=5).first().text == "abc\né1\nabc"
    write(tmp_path / "f.txt", "abc\nabcd\n")
    assert rows(sources.read_text(spark, str(tmp_path), "line", max_line=5), "text") == [("abc",)]
    assert rows(sources.read_text(spark, str(tmp_path), max_line=5), "text") == [("abc\n",)]


@pytest.mark.parametrize("text", ["abc\nabcd", "abc\nabcd\n", "abcd\r\nabc\r\n\r\nab", "ab\rabcd\rabc", "abcd", "\n\nabcd\n"])
@pytest.mark.parametrize("limit", [4, 5, 6])
def test_max_line_means_the_same_in_files_and_tables(corpus, spark, tmp_path, text, limit):
    write(tmp_path / "1.txt", text)
    for grain, columns in (("line", ("line_no", "text")), ("doc", ("text",))):
        got = rows(sources.read_text(spark, str(tmp_path), grain, max_line=limit), *columns)
        assert got == rows(sources.records(corpus(text), grain, max_line=limit), *columns)
    numbered = dict(rows(sources.lines(corpus(text)), "line_no", "text"))
    assert all(numbered[n] == t for n, t in rows(sources.lines(corpus(text), max_line=limit), "line_no", "text"))


def test_the_last_line_without_terminator_has_none_to_count(spark, tmp_path):
    write(tmp_path / "f.txt", "abc\nabcd")
    assert rows(sources.read_text(spark, str(tmp_path), "line", max_line=5), "text") == [("abc",), ("abcd",)]


def test_grain_is_checked(docs, spark):
    with pytest.raises(ValueError):
        sources.records(docs, "page")
    with pytest.raises(ValueError):
        sources.read_text(spark, "/nowhere", "page")


def test_word_lists(spark, tmp_path):
    one = write(tmp_path / "1.txt", "The\r\n\r\n of \t\nwould\nwould\n \n")
    two = write(tmp_path / "2.txt", "de \nof\n")
    assert rows(sources.read_words(spark, one, two), "word") == [("de",), ("of",), ("the",), ("would",)]
    raw = rows(sources.read_words(spark, one, two, raw=True), "word")
    assert raw == [("",), (" ",), (" of \t",), ("The",), ("de ",), ("of",), ("would",)]


def test_missing_lists_raise(spark):
    with pytest.raises(AnalysisException):
        sources.read_words(spark, "/nowhere/stop.txt")
    with pytest.raises(AnalysisException):
        sources.read_df_table(spark, "/nowhere/df.txt")
    with pytest.raises(ValueError):
        sources.read_words(spark)


def test_df_table(spark, tmp_path):
    text = (
        "x\t3\nx\ny\tabc\nz\t1\t2\n  t \t +5 \nu\t5.0\nv\t99999999999\nw\t0\nneg\t-2\n"
        "dup\t1\ndup\t9\ndup\tbad\ntail\t4\t\n"
    )
    path = write(tmp_path / "df.txt", text)
    got = rows(sources.read_df_table(spark, path), "term", "df")
    assert got == [("dup", 9), ("t", 5), ("tail", 4), ("x", 3)]


def test_df_table_last_line_wins_across_splits(spark, tmp_path):
    body = "".join(f"t{i % 500}\t{i + 1}\n" for i in range(20_000))
    path = write(tmp_path / "df.txt", body)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        table = sources.read_df_table(spark, path)
        assert table.sparkSession.read.text(path).rdd.getNumPartitions() > 10
        assert dict(rows(table, "term", "df")) == {f"t{i % 500}": i + 1 for i in range(19_500, 20_000)}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_file_doc_id(spark):
    paths = ["/a.txt/100.txt.txt", "b/c", "5.txt", "/x/1.txt.gz"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    got = [r[0] for r in df.select(sources.file_doc_id(F.col("p"))).collect()]
    assert got == ["100", "c", "5", "1.gz"]


def test_literal_words(spark, monkeypatch):
    monkeypatch.setattr(lists, "LITERAL_LIMIT", 3)
    assert lists.literal_words(None) == []
    assert lists.literal_words(iter("baa")) == ["a", "b"]
    assert lists.literal_words("abcd") is None
    frame = spark.createDataFrame([(w,) for w in "abcab"], "x string")
    assert lists.literal_words(frame) == ["a", "b", "c"]
    assert lists.literal_words(frame.union(spark.createDataFrame([("d",)], "x string"))) is None
