"""The jobs from files to files, one after the other as a user would run them."""

import math
from glob import glob

import plain
import pytest

from wordloom import jobs

DOCS = {
    "10": "Time and tide, time and again!\nThe moon waits.",
    "11": "Tides of the moon; running times\r\nmoon moon",
    "12.txt": "cities run the moon",
}
STOP = "The\r\n\nand \nthe\n"


@pytest.fixture()
def corpus_dir(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for name, text in DOCS.items():
        (folder / f"{name}.txt").write_bytes(text.encode())
    (tmp_path / "stop.txt").write_bytes(STOP.encode())
    return tmp_path


def run(spark, folder, job, out, *options):
    args = [job, str(folder / "in"), str(folder / out), *options]
    jobs.run(spark, jobs.checked(jobs.parser().parse_args(args)))
    lines = []
    for name in sorted(glob(f"{folder}/{out}/part-*")):
        with open(name, encoding="utf-8", newline="\n") as f:
            lines += f.read().splitlines()
    return lines


def test_words_to_matrix(spark, corpus_dir):
    stop = ("--stopwords", str(corpus_dir / "stop.txt"))
    top = run(spark, corpus_dir, "top-words", "top", *stop, "-k", "3")
    assert top == ["moon\t5", "time\t2", "waits\t1"]
    names = run(spark, corpus_dir, "top-words", "names", *stop, "-k", "3", "--names-only", "--single-file")
    assert names == ["moon", "time", "waits"]
    vocabulary = glob(f"{corpus_dir}/names/part-*")[0]

    want = plain.pairs(DOCS.values(), 2, {"the", "and"}, {"moon", "time", "waits"})
    pairs = run(spark, corpus_dir, "cooccurrence", "p", *stop, "--vocabulary", vocabulary, "-d", "2")
    assert pairs == sorted(f"({a},{b})\t{n}" for (a, b), n in want.items())
    own = run(spark, corpus_dir, "cooccurrence", "own", *stop, "-k", "3", "-d", "2")
    assert own == pairs

    stripes = run(
        spark, corpus_dir, "cooccurrence", "s", *stop, "--vocabulary", vocabulary, "--layout", "stripes",
        "--grain", "line", "--keep-isolated",
    )
    assert stripes == ["moon\t{moon:2, waits:1}", "time\t{time:2}", "waits\t{moon:1}"]
    by_record = run(
        spark, corpus_dir, "cooccurrence", "r", *stop, "--vocabulary", vocabulary, "--by-record"
    )
    assert by_record == [
        "10\t(moon,time)\t1", "10\t(moon,waits)\t1", "10\t(time,moon)\t1", "10\t(time,time)\t2",
        "10\t(waits,moon)\t1", "11\t(moon,moon)\t4",
    ]


def test_whole_word_count_in_key_order(spark, corpus_dir):
    lines = run(spark, corpus_dir, "top-words", "all")
    assert lines == sorted(lines) and "the\t3" in lines
    folded = run(spark, corpus_dir, "top-words", "cs", "--case-sensitive")
    assert "ime\t1" in folded and "ides\t1" in folded


def test_stems_to_scores(spark, corpus_dir):
    stop = ("--stopwords", str(corpus_dir / "stop.txt"))
    top = run(spark, corpus_dir, "document-frequency", "df", *stop, "-k", "3", "--single-file")
    assert top == ["moon\t3", "time\t2", "tide\t2"]
    df = glob(f"{corpus_dir}/df/part-*")[0]
    scores = run(spark, corpus_dir, "tfidf", "scores", *stop, "--df", df)
    assert scores[0] == f"10\tmoon\t{math.log(10_000 / 3 + 1):.4f}"
    assert [line.split("\t")[:2] for line in scores] == [
        ["10", "moon"], ["10", "tide"], ["10", "time"],
        ["11", "moon"], ["11", "tide"], ["11", "time"], ["12", "moon"],
    ]
    assert f"11\tmoon\t{3 * math.log(10_000 / 3 + 1):.4f}" in scores
    own = run(spark, corpus_dir, "tfidf", "own", *stop, "-k", "3", "--n-docs", "0")
    assert f"12\tmoon\t{math.log(2):.4f}" in own


def test_parquet_corpus(spark, corpus_dir):
    rows = [(int(k[:2]), v) for k, v in DOCS.items()]
    spark.createDataFrame(rows, "id long, body string").write.parquet(str(corpus_dir / "table"))
    args = [
        "document-frequency", str(corpus_dir / "table"), str(corpus_dir / "out"), "--format", "parquet",
        "--key", "id", "--text", "body", "--grain", "line",
    ]
    jobs.run(spark, jobs.checked(jobs.parser().parse_args(args)))
    text = "".join(open(f, encoding="utf-8").read() for f in glob(f"{corpus_dir}/out/part-*"))
    assert "moon\t4\n" in text


@pytest.mark.parametrize("options", [
    ["cooccurrence", "in", "out", "--keep-isolated"],
    ["cooccurrence", "in", "out", "-k", "3", "--vocabulary", "v"],
    ["cooccurrence", "in", "out", "--by-record", "--single-file"],
    ["cooccurrence", "in", "out", "--max-distance", "3", "-d", "2"],
    ["cooccurrence", "in", "out", "--parts", "2"],
    ["tfidf", "in", "out", "-k", "3", "--df", "f"],
    ["tfidf", "in", "out", "--single-file"],
    ["top-words", "in", "out", "--single-file"],
    ["top-words", "in", "out", "--raw-stopwords"],
    ["top-words", "in", "out", "--head", "3"],
    ["top-words", "in", "--head", "3", "--count"],
    ["top-words", "in"],
])
def test_options_without_effect_are_refused(options):
    with pytest.raises(SystemExit) as error:
        jobs.checked(jobs.parser().parse_args(options))
    assert options[0] in str(error.value)


def test_preview_count_and_sweep(spark, corpus_dir, capsys):
    corpus = str(corpus_dir / "in")
    jobs.run(spark, jobs.checked(jobs.parser().parse_args(["top-words", corpus, "--head", "2", "-k", "5"])))
    jobs.run(spark, jobs.checked(jobs.parser().parse_args(["top-words", corpus, "--count"])))
    first, second, count = capsys.readouterr().out.split("\n")[:3]
    assert first == "moon\t5" and second.endswith("\t3") and int(count) > 5
    swept = run(spark, corpus_dir, "cooccurrence", "sweep", "-k", "3", "--max-distance", "2")
    one = run(spark, corpus_dir, "cooccurrence", "one", "-k", "3", "-d", "1")
    assert [x[2:] for x in swept if x.startswith("1\t")] == one
    striped = run(spark, corpus_dir, "cooccurrence", "ss", "-k", "3", "--max-distance", "2", "--layout", "stripes")
    assert [x[2:] for x in striped if x.startswith("2\t")] == run(
        spark, corpus_dir, "cooccurrence", "s2", "-k", "3", "-d", "2", "--layout", "stripes"
    )
