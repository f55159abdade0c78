import hashlib
import json
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from wordloom.llm import alignment as al
from wordloom.llm.common import byte_characters, tokenizer_file

A, B = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def tokens(text):
    """(ids of a, ids of b, their bytes), straight from the two libraries."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    if not hasattr(tokens, "known"):
        a = Tokenizer.from_file(A)
        a.encode_special_tokens = True
        codes = {c: x for x, c in byte_characters().items()}
        with open(A, encoding="utf-8") as f:
            names = {i: p for p, i in json.load(f)["model"]["vocab"].items()}
        tokens.known = a, SentencePieceProcessor(model_file=B), codes, names
    a, b, codes, names = tokens.known
    ids_a = a.encode(" " + text, add_special_tokens=False).ids
    ids_b = b.encode(text)
    raw_a = [bytes(codes[c] for c in names[i]) for i in ids_a]
    raw_b = []
    for p in map(b.id_to_piece, ids_b):
        raw_b.append(bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode())
    return ids_a, ids_b, raw_a, raw_b


def groups_of(text):
    if not text:
        return []
    ids_a, ids_b, raw_a, raw_b = tokens(text)
    whole = b" " + text.encode()
    if b"".join(raw_a) != whole or b"".join(raw_b) != whole:
        return []
    ends_a = np.cumsum([len(x) for x in raw_a]).tolist()
    ends_b = np.cumsum([len(x) for x in raw_b]).tolist()
    cuts = sorted(set(ends_a) & set(ends_b))
    found, last = [], 0
    for cut in cuts:
        found.append(
            ([i for i, e in zip(ids_a, ends_a) if last < e <= cut], [i for i, e in zip(ids_b, ends_b) if last < e <= cut])
        )
        last = cut
    return found


def brute_force(texts):
    count = defaultdict(int)
    every = [groups_of(t) for t in texts]
    for groups in every:
        for pair in {(x, y) for a, b in groups for x in a for y in b}:
            count[pair] += 1
    most = defaultdict(int)
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    rows = []
    for groups in every:
        links = [(x, y) for a, b in groups for x in a for y in b]
        form = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        rows.append((
            sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links),
            sum(count[p] == most[p[0]] for p in links), sum(count[p] for p in links),
            hashlib.sha256(form.encode()).hexdigest() if groups else "",
        ))
    return rows


TEXTS = [
    "The quick brown fox.", "The quick brown fox.", "", None, " ", "  two  spaces ", "\n\n\tx", "▁ is changed", "<|endoftext|> and <s></s>",
    "日本語のテキスト 𝄞𝄞", "naïve café – Straße", "a\x00b", "!!!???...", "x" * 500, "ab" * 700, "The fox, the fox; THE FOX 12345 67",
    "é" * 300, " " * 30_000 + "end", "<0x41> <unk>", "é combining",
]


@pytest.mark.parametrize("chunk", [200, 1 << 22])
def test_equals_brute_force(spark, chunk):
    rng = random.Random(1)
    words = "The quick brown fox jumps über naïve 日本 <|endoftext|> 12 \n".split(" ")
    texts = TEXTS + ["".join(rng.choice(words) + rng.choice(["", " ", "  "]) for _ in range(rng.randint(1, 60))) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.key: tuple(r[c] for c in COLUMNS) for r in al.alignments(df, A, B, chunk_bytes=chunk).collect()}
    assert [got[i] for i in range(len(texts))] == brute_force(texts)


def test_documents(spark, docs):
    rows = docs.orderBy("doc_id").collect()
    got = sorted(al.alignments(docs, A, B).collect(), key=lambda r: r.key)
    assert [tuple(r[c] for c in COLUMNS) for r in got] == brute_force([r.text for r in rows])


def test_links(spark):
    texts = [t for t in TEXTS if t and len(t) < 1000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    found = defaultdict(list)
    for r in al.links(df, A, B).collect():
        found[r.doc_id].append(tuple(r)[1:])
    for i, text in enumerate(texts):
        ids_a, ids_b, raw_a, raw_b = tokens(text)
        want = []
        if groups_of(text):
            ends_a, ends_b = np.cumsum([len(x) for x in raw_a]).tolist(), np.cumsum([len(x) for x in raw_b]).tolist()
            cuts = sorted(set(ends_a) & set(ends_b))
            for x, (p, e) in enumerate(zip(ids_a, ends_a)):
                for y, (q, f) in enumerate(zip(ids_b, ends_b)):
                    start, stop = max(e - len(raw_a[x]), f - len(raw_b[y])), min(e, f)
                    if start < stop:
                        want.append((x, y, p, q, start, stop - start, sum(c <= start for c in cuts)))
        assert sorted(found[i]) == sorted(want)


def test_products_equal_dense_ones(monkeypatch):
    rng = np.random.default_rng(3)
    for step in (5, 1 << 20):
        monkeypatch.setattr(al, "STEP", step)
        a, b = rng.integers(0, 3, (17, 11)) * (rng.random((17, 11)) < 0.3), rng.integers(0, 3, (11, 13)) * (rng.random((11, 13)) < 0.4)
        sparse = [al.Csr.of(*np.nonzero(m), m[np.nonzero(m)], m.shape) for m in (a, b)]
        product = sparse[0] @ sparse[1]
        dense = np.zeros((17, 13), int)
        np.add.at(dense, (product.rows(), product.indices), product.data)
        assert (dense == a @ b).all()
        back = sparse[0].transposed()
        assert (np.diff(back.indptr) == (a != 0).sum(0)).all()


def test_overlaps_across_windows():
    a, b = np.array([3, 1, 4, 1, 5]), np.array([2, 7, 5])
    for window in (1, 3, 5, 100):
        assert [x.tolist() for x in al.overlaps(a, b, window)] == [[0, 0, 1, 2, 3, 4], [0, 1, 1, 1, 1, 2], [2, 1, 1, 4, 1, 5]]
        i, j, n = al.overlaps(a, b, window)
        assert n.sum() == 14 and (np.bincount(i, n) == a).all() and (np.bincount(j, n) == b).all()
        assert len(i) == len(set(zip(i.tolist(), j.tolist())))


def test_odd_rows(spark, odd, none):
    rows = al.alignments(odd, A, B).collect()
    assert len(rows) == 9
    by = defaultdict(list)
    for r in rows:
        by[r.key].append(tuple(r[c] for c in COLUMNS))
    assert by[1][0] == by[1][1] and by[2] == [(0, 0, 0, 0, 0, 0, "")] == by[3]
    assert len(by[None]) == 2 and (0, 0, 0, 0, 0, 0, "") in by[None]
    assert al.alignments(none, A, B).count() == 0 and al.links(none, A, B).count() == 0
    assert al.links(odd, A, B).where(F.col("doc_id") == 4).count() > 3000
