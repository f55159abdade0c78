import numpy as np
from brute_force import brute_print, groups

from wordloom.llm import simhash
from wordloom.llm.simhash import components, fingerprint, links, near_duplicates, roots


def test_fingerprint():
    for text in ("", " \n", "One", "a b", "A b c", "the quick Brown\tfox é É \n jumps " * 3, "x " * 20_000):
        assert fingerprint(text.encode()) == brute_print(text)


def planted(seed, n=150):
    rng = np.random.default_rng(seed)
    prints = [int(x) for x in rng.integers(0, 1 << 63, n, dtype=np.uint64) * 2 + rng.integers(0, 2, n, dtype=np.uint64)]
    for k in range(n):
        for _ in range(rng.integers(0, 4)):
            prints.append(prints[-1 - int(rng.integers(0, 3))] ^ (1 << int(rng.integers(64))) ^ (1 << int(rng.integers(64))))
    return set(prints) | {0, (1 << 64) - 1, 1, 3, 7, 15}


def test_links_connect_all_within_two_bits(spark):
    prints = planted(4)
    signed = {p - (1 << 64) if p >> 63 else p: p for p in prints}
    df = spark.createDataFrame([(s,) for s in signed], "fp long").repartition(4)
    found = {r.node: r.root for r in components(links(df)).collect()}
    got = {}
    for s, p in signed.items():
        got.setdefault(found.get(s, s), set()).add(p)
    assert sorted(map(frozenset, got.values()), key=min) == groups(prints)


def test_both_ways_inside_a_grid_point(monkeypatch):
    members = np.array(sorted(planted(9, 60)), np.uint64)
    few = roots(members, 2)
    monkeypatch.setattr(simhash, "PAIRWISE", 0)
    assert roots(members, 2) == few


def test_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001), (5, 5)], "a long, b long")
    found = {r.node: r.root for r in components(edges).collect()}
    assert {found[i] for i in range(301)} == {0} and found[1001] == 1000


def test_documents(spark, odd, none):
    rows = near_duplicates(odd).collect()
    assert len(rows) == 9
    empty = [r for r in rows if r.fp == 0]
    # null, empty and blank texts are one group, named by its least id
    assert len(empty) >= 4 and {r.component_id for r in empty} == {2}
    assert near_duplicates(none).count() == 0


def test_query_against_brute_force(spark):
    from wordloom.llm.simhash import op8_simhash

    path = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()}
    prints = {k: brute_print(t or "") for k, t in docs.items()}
    least = {}
    for g in groups(set(prints.values())):
        first = min(k for k, p in prints.items() if p in g)
        least |= {k: first for k, p in prints.items() if p in g}
    got = op8_simhash(spark, path).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in got} == {(k, f"{p:016x}", least[k]) for k, p in prints.items()}
