import re
from collections import Counter

import pytest
from brute_force import brute_print, groups, leaks, repeats
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from wordloom.llm.common import encoding, tokenizer_file
from wordloom.llm.suffix_dedup import kept_bytes, whole_characters

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The documents before the first and after each stage."""
    folder, docs = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs.collect()]
    for n, (_, stage) in enumerate(pipeline.STAGES):
        found = stage(spark, docs, SF)
        if n < len(pipeline.STAGES) - 1:
            assert found.columns == docs.columns and found.dtypes == docs.dtypes
        found.write.parquet(f"{folder}/{n}")
        docs = spark.read.parquet(f"{folder}/{n}")
        out.append(docs.collect())
    return out


def ids(rows):
    return sorted(r.doc_id for r in rows)


def test_rules_keep_good_documents(spark, stages):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = set(ids(stages[1]))
    dropped = [r for r in stages[0] if r.doc_id not in kept]
    assert dropped and set(stages[1]) <= set(stages[0])
    for r in dropped:
        words = r.text.split()
        short = len(words) < 10
        windows = Counter(zip(*(words[i:] for i in range(5))))
        assert short or max(windows.values(), default=0) > 1 or labels.get(r.doc_id, 0) == 0


def test_one_document_of_each_group_stays(stages):
    prints = {r.doc_id: brute_print(r.text or "") for r in stages[1]}
    want = {min(k for k, p in prints.items() if p in g) for g in groups(set(prints.values()))}
    assert ids(stages[2]) == sorted(want)


def test_repeats_go(stages):
    before = sorted(stages[2], key=lambda r: r.doc_id)
    want = {}
    for r, runs in zip(before, repeats([(r.text or "").encode() for r in before])):
        raw = (r.text or "").encode()
        want[r.doc_id] = kept_bytes(raw, whole_characters(raw, runs)).decode()
    assert {r.doc_id: r.text for r in stages[3]} == want
    assert all(r.n_chars == len(r.text) for r in stages[3])


def test_leaks_go(spark, stages):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = [r.doc_id for r in stages[3] if not leaks(r.text, items)[1]]
    assert ids(stages[4]) == sorted(want)


def test_all_tokens_are_packed(stages):
    encode = encoding(tokenizer_file("byte_bpe_50k.json")).encode_ordinary
    total = Counter()
    for r in stages[5]:
        total[r.doc_id] += r.length
    assert total == {r.doc_id: len(encode(r.text or "")) + 1 for r in stages[4]}


def test_run_equals_the_stages(spark, stages):
    rows = pipeline.run(spark, SF).collect()
    assert sorted((r.doc_id, r.piece, r.ids_crc32) for r in rows) == sorted((r.doc_id, r.piece, r.ids_crc32) for r in stages[5])


def test_odd_documents(spark, odd):
    docs = odd.select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.length("text").cast("long").alias("n_chars"), F.col("row"))
    for _, stage in pipeline.STAGES[:-1]:
        one = stage(spark, docs, SF)
        assert one.columns == docs.columns
        one.count()
        assert stage(spark, docs.limit(0), SF).count() == 0
    # repeated rows, and texts without words, leave one row each
    kept = pipeline.one_of_each(spark, docs, SF).collect()
    assert sum(r.doc_id == 1 for r in kept) == 1 and sum(not (r.text or "").strip() for r in kept) == 1


def workers(plan):
    """The most Python workers that a task of a plan holds: its Python nodes between two exchanges."""
    most, above = 0, []
    for line in plan.splitlines():
        at = re.match(r"[ :+-]*", line).end()
        above = [x for x in above if x[0] < at]
        n = above[-1][1] if above else 0
        n = 0 if "Exchange" in line.split("(")[0] else n + bool(re.search(r"^[ :+-]*(\*\(\d+\) )?(MapIn|ArrowEvalPython|FlatMapGroups)", line))
        above.append((at, n))
        most = max(most, n)
    return most


def test_no_task_holds_two_python_workers(spark):
    plan = pipeline.without_repeats(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF)._jdf.queryExecution().executedPlan().toString()
    assert workers(plan) == 1


def test_leaks_are_found_in_small_batches(spark, stages, monkeypatch):
    sizes = []

    def contamination(*args, batch_bytes, **more):
        sizes.append(batch_bytes)
        return found(*args, batch_bytes=2000, **more)

    found = pipeline.decontamination.contamination
    monkeypatch.setattr(pipeline.decontamination, "contamination", contamination)
    docs = spark.createDataFrame(stages[3], spark.read.parquet(f"{SF}/documents.parquet").schema)
    assert ids(pipeline.not_in_benchmark(spark, docs, SF).collect()) == ids(stages[4])
    assert sizes == [pipeline.SEARCH_BYTES]
