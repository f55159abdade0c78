import zlib
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from wordloom.llm.common import encoder, encoding, tokenizer_file
from wordloom.llm.packing import Bins, Places, drain, fillings, least_sequences, pack, packed, pieces

PATH = tokenizer_file("byte_bpe_50k.json")
REFERENCE = Tokenizer.from_file(PATH)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 99), max_size=60))
def test_pack_is_sound(lengths):
    at = pack(lengths, 100)
    bins = defaultdict(list)
    for (b, offset), n in zip(at, lengths):
        bins[b].append((offset, n))
    for held in bins.values():
        place = 0
        for offset, n in sorted(held):
            assert offset == place
            place += n
        assert place <= 100
    least = least_sequences(Counter(lengths), 100)
    assert least <= len(bins) <= 1.5 * least + 1


def fewest(lengths, capacity):
    """The least number of sequences, by trying every way."""
    best = len(lengths)

    def put(i, fills):
        nonlocal best
        if len(fills) >= best:
            return
        if i == len(lengths):
            best = len(fills)
            return
        for f in sorted(set(fills)):
            if f + lengths[i] <= capacity:
                rest = list(fills)
                rest.remove(f)
                put(i + 1, [*rest, f + lengths[i]])
        put(i + 1, [*fills, lengths[i]])

    put(0, [])
    return best


def test_small_tables_against_all_ways():
    rng, right = np.random.default_rng(3), 0
    for n in range(150):
        lengths = sorted(rng.integers(5, 70, rng.integers(1, 10)).tolist(), reverse=True)
        found, best = len({b for b, _ in pack(lengths, 100)}), fewest(lengths, 100)
        assert least_sequences(Counter(lengths), 100) <= best <= found <= best + 1
        right += found == best
    assert right >= 148


def test_search_improves_on_best_fit():
    lengths = np.random.default_rng(1).integers(250, 400, 600).tolist()
    start = Bins(1024)
    start.best_fit(Counter(lengths))
    assert len({b for b, _ in pack(lengths)}) <= 0.98 * start.total


def test_a_step_increases_the_squares():
    def squares():
        return sum(n * (100 - bins.free[f]) ** 2 for f, n in bins.count.items())

    rng = np.random.default_rng(4)
    for _ in range(30):
        lengths = rng.integers(10, 60, 40).tolist()
        bins = Bins(100)
        for x in lengths[::2]:
            bins.add((x,), 2)
        steps, before = 0, squares()
        for source in [f for f in list(bins.count) for _ in range(5)]:
            if source in bins.count and drain(bins, source):
                assert squares() > before
                before, steps = squares(), steps + 1
                assert sum(sum(f) * n for f, n in bins.count.items()) == 2 * sum(lengths[::2])
                assert all(sum(f) <= 100 and n > 0 for f, n in bins.count.items()) and bins.total == sum(bins.count.values())
        assert steps


def test_best_fit_places_equal_pieces_as_one_by_one():
    for seed in range(20):
        rng = np.random.default_rng(seed)
        counts = {int(x): int(n) for x, n in zip(rng.integers(1, 60, 12), rng.integers(1, 9, 12))}
        together = Bins(100)
        together.best_fit(counts)
        fills: list[int] = []
        for x in sorted(counts, reverse=True):
            for _ in range(counts[x]):
                fits = [i for i, f in enumerate(fills) if f + x <= 100]
                if fits:
                    fills[max(fits, key=lambda i: fills[i])] += x
                else:
                    fills.append(x)
        got = sorted(100 - together.free[f] for f, n in together.count.items() for _ in range(n))
        assert got == sorted(fills)


def test_places_of_many_equal_pieces():
    filled = {(300, 300, 400): 5, (1000,): 2, (300, 700): 3}
    places = Places(filled)
    at = defaultdict(list)
    for x, n in ((300, 13), (400, 5), (700, 3), (1000, 2)):
        for b, o in zip(*places.find(x, np.arange(n)), strict=True):
            at[int(b)].append((int(o), x))
    assert len(at) == places.sequences == 10
    assert all([o for o, _ in sorted(held)] == np.cumsum([0, *(x for _, x in sorted(held))])[:-1].tolist() for held in at.values())


def test_every_token_has_one_place(spark, odd):
    rows = packed(pieces(odd, PATH, end_id=2), group_items=4).collect()
    text = {r.doc_id: r.text or "" for r in odd.collect() if r.doc_id is not None}
    encode = encoding(PATH).encode_ordinary
    for key, t in text.items():
        ids = encode(t) + [2]
        own = sorted((r for r in rows if r.doc_id == key), key=lambda r: r.piece)
        if key == 1:
            assert len(own) == 2 and own[0].ids_crc32 == own[1].ids_crc32
            continue
        assert [r.piece for r in own] == list(range(len(own)))
        assert sum(r.length for r in own) == len(ids) and all(r.length == 1024 for r in own[1:])
        for r in own:
            part = np.array(ids[r.start : r.start + r.length], "<u4").tobytes()
            assert r.ids_crc32 == zlib.crc32(part)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for held in sequences.values():
        place = 0
        for offset, n in sorted(held):
            assert offset == place
            place += n
        assert place <= 1024


def test_empty_table(none):
    assert packed(pieces(none, PATH, end_id=2)).count() == 0


def test_groups_meet_again(spark):
    rng = np.random.default_rng(1)
    rows = [(i, int(n)) for i, n in enumerate(rng.integers(1, 100, 3000))]
    out = packed(spark.createDataFrame(rows, "doc_id long, length long"), capacity=100, group_items=200).collect()
    total = sum(n for _, n in rows)
    assert len(out) == 3000
    assert len({r.sequence_id for r in out}) <= 1.03 * -(-total // 100)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<|endoftext|>", "<|endoftext|", "|>", " ", "\n", "see", "It's", "é", "12", "  \t", "　", "日本", "?!"]) | st.text(max_size=4), max_size=12))
def test_ids_are_those_of_tokenizers(parts):
    text = "".join(parts)
    assert encoder(PATH)(text) == REFERENCE.encode(text, add_special_tokens=False).ids


def test_added_token_in_a_text(spark):
    row = pieces(spark.createDataFrame([(1, "see <|endoftext|> here")], "doc_id long, text string"), PATH, end_id=2).first()
    ids = [3826, 220, 50256, 994, 2]
    assert row.length == 5 and row.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())


def test_surplus_of_one_group_meets_that_of_others(spark):
    """Few sequences fill exactly, and each group has too many of one kind."""
    rng = np.random.default_rng(2)
    rows = [(i, int(n)) for i, n in enumerate(rng.choice([300, 700], 4000))]
    out = packed(spark.createDataFrame(rows, "doc_id long, length long"), group_items=100).collect()
    fill, short = defaultdict(int), sum(n == 300 for _, n in rows)
    for r in out:
        fill[r.sequence_id] += r.length
    long = len(rows) - short
    best = long + -(-max(0, short - long) // 3)
    assert len(out) == 4000 and max(fill.values()) <= 1024
    assert len(fill) <= best + 2


def test_no_sequence_can_be_drained_at_the_end():
    rng, tried = np.random.default_rng(7), []
    for _ in range(40):
        counts = Counter(rng.integers(20, 70, 40).tolist())
        bins = Bins(100)
        for filling, n in fillings(counts, 100).items():
            bins.add(filling, n)
        if bins.total > least_sequences(counts, 100):
            tried.append(any(drain(bins, f) for f in list(bins.count) if bins.free[f]))
    assert tried and not any(tried)


def test_full_and_missing_pieces(spark):
    """Only full pieces; columns with clashing names; one length for all rows, in several groups."""
    wide = "doc_id long, length int, sequence string, offsets int, `order` int"
    full = spark.createDataFrame([(1, 1024, "a", 1, 1), (2, 1024, "b", 2, 2)], wide)
    assert {r.offset for r in packed(full).collect()} == {0}
    same = spark.createDataFrame([(i % 7, 500, "a", 1, 1) for i in range(1000)], wide).repartition(4)
    rows = packed(same, group_items=30).collect()
    assert len({(r.sequence_id, r.offset) for r in rows}) == 1000 and len({r.sequence_id for r in rows}) == 500
