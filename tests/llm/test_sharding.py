from collections import Counter

import pytest
from pyspark.sql import functions as F

from wordloom.llm.sharding import op4_sharding, rendezvous, slots


def test_a_further_shard_only_takes(spark):
    keys = spark.range(20_000).withColumnRenamed("id", "doc_id")
    four = {r.doc_id: r for r in rendezvous(keys, [1.0] * 4, grown="grown").collect()}
    five = {r.doc_id: r.shard for r in rendezvous(keys, [1.0] * 5).collect()}
    moved = 0
    for k, r in four.items():
        assert r.grown == five[k]
        assert five[k] in (r.shard, 4)
        moved += five[k] != r.shard
    assert 0.17 < moved / 20_000 < 0.23


def test_weights_share_the_rows(spark):
    keys = spark.range(30_000).withColumnRenamed("id", "doc_id")
    n = Counter(r.shard for r in rendezvous(keys, [1.0, 2.0, 3.0]).collect())
    for shard, want in enumerate((5000, 10_000, 15_000)):
        assert abs(n[shard] - want) < 500


def test_slots_have_no_gaps_and_do_not_depend_on_partitions(spark):
    keys = spark.range(5000).select((F.col("id") % 4500).alias("doc_id"))
    def found(n):
        return slots(rendezvous(keys.repartition(n), [1.0] * 7)).collect()
    one = found(1)
    assert sorted(map(tuple, one)) == sorted(map(tuple, found(6)))
    for shard in range(7):
        at = sorted(r.slot for r in one if r.shard == shard)
        assert at == list(range(len(at)))


def test_odd_rows(odd, none):
    rows = slots(rendezvous(odd, [1.0] * 3), order=("doc_id", "text")).collect()
    assert len(rows) == 9
    assert len({r.shard for r in rows if r.doc_id is None}) == 1
    assert rendezvous(none, [1.0]).count() == 0
    assert {r.hits for r in rendezvous(odd, [1.0], shard="hits").collect()} == {0}
    with pytest.raises(ValueError):
        rendezvous(odd, [1.0, 0.0])


def test_query_is_native(spark):
    df = op4_sharding(spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
    rows = df.collect()
    n = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
    assert len(rows) == n and all(0 <= r.shard < 40 and r.grown_shard in (r.shard, 40) for r in rows)
