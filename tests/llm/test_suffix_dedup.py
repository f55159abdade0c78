import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from brute_force import repeats

from wordloom.llm import suffix_dedup
from wordloom.llm.suffix_dedup import kept_bytes, merged, union, whole_characters, with_spans

def texts_with_repeats(seed):
    rng = random.Random(seed)
    def prose(n):
        return "".join(rng.choice("abcdé fgh\nß") for _ in range(n))
    shared = [prose(n) for n in (120, 197, 203, 260, 900)]
    texts = []
    for k in range(40):
        parts = [prose(rng.randint(0, 400)) for _ in range(3)]
        texts.append(parts[0] + rng.choice(shared) + parts[1] + rng.choice(shared)[rng.randint(0, 30) :] + parts[2])
    texts += [texts[3], texts[3], "ab" * 400, "x" * 700, "ab" * 150, "\0" * 250, "", "short", texts[5][:210], texts[6][-201:] + "tail"]
    return texts


@pytest.mark.parametrize("seed,crowd", [(1, 4000), (2, 4000), (3, 2)])
def test_spans(spark, monkeypatch, seed, crowd):
    monkeypatch.setattr(suffix_dedup, "GROUP_CONTEXTS", crowd)
    monkeypatch.setattr(suffix_dedup, "SHARD_ROWS", 5)
    texts = texts_with_repeats(seed)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r.doc_id: union(r.spans or []) for r in with_spans(df, bits=16).select("row.doc_id", "spans").collect()}
    want = repeats([t.encode() for t in texts])
    assert [got[i] for i in range(len(texts))] == want


def test_merge_of_shards_equals_brute_force():
    rng = np.random.default_rng(2)
    rows = rng.integers(1, 3, (24, 12)).astype(np.uint16)
    rows[:, :2][rng.random((24, 2)) < 0.3] = 0
    rows[0, -3:] = 0
    for shards in ([rows], [rows[:5], rows[5:11], rows[11:]]):
        got = np.concatenate(merged(shards, 6))
        for j in range(12 - 6 + 1):
            often = Counter(bytes(r[j : j + 6].astype(np.uint8)) for r in rows)
            for i, r in enumerate(rows):
                w = r[j : j + 6]
                assert got[i, j] == (0 not in w and often[bytes(w.astype(np.uint8))] > 1)


def test_characters_stay_whole():
    raw = "aébé".encode()
    for a in range(len(raw) + 1):
        for b in range(a, len(raw) + 1):
            kept_bytes(raw, whole_characters(raw, [a, b])).decode()


def test_odd_rows(odd, none):
    rows = with_spans(odd).collect()
    assert sorted(map(str, (r.row for r in rows))) == sorted(map(str, odd.collect()))
    spans = {r.row.doc_id: union(r.spans or []) for r in rows}
    assert spans[6] == [0, 600] and spans[1] == [] and spans[3] == []
    assert spans[4][1] > 14_000
    assert with_spans(none).count() == 0


def test_digests_need_no_text_copies():
    assert hashlib.sha256(kept_bytes(b"abcdef", [1, 3])).hexdigest() == hashlib.sha256(b"adef").hexdigest()
