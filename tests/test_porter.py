import random

import plain
import pytest
from hypothesis import given
from hypothesis import strategies as st

from wordloom.functions.porter import may_stem_to, stem_all, steps, with_stem, word_prefixes
from wordloom.operators import stem_vocabulary

# examples printed in the paper, and stems known from published runs
KNOWN = {
    "caresses": "caress", "ponies": "poni", "ties": "ti", "cats": "cat", "feed": "feed",
    "agreed": "agre", "plastered": "plaster", "bled": "bled", "motoring": "motor", "sing": "sing",
    "conflated": "conflat", "troubled": "troubl", "sized": "size", "hopping": "hop",
    "tanned": "tan", "falling": "fall", "hissing": "hiss", "fizzed": "fizz", "failing": "fail",
    "filing": "file", "happy": "happi", "sky": "sky", "relational": "relat",
    "conditional": "condit", "rational": "ration", "valenci": "valenc", "digitizer": "digit",
    "radicalli": "radic", "differentli": "differ", "vileli": "vile", "analogousli": "analog",
    "vietnamization": "vietnam", "predication": "predic", "operator": "oper",
    "feudalism": "feudal", "decisiveness": "decis", "hopefulness": "hope",
    "callousness": "callous", "formaliti": "formal", "sensitiviti": "sensit",
    "sensibiliti": "sensibl", "triplicate": "triplic", "formative": "form",
    "formalize": "formal", "electrical": "electr", "hopeful": "hope", "goodness": "good",
    "revival": "reviv", "allowance": "allow", "inference": "infer", "airliner": "airlin",
    "adjustable": "adjust", "defensible": "defens", "irritant": "irrit",
    "replacement": "replac", "adjustment": "adjust", "dependent": "depend",
    "adoption": "adopt", "communism": "commun", "activate": "activ", "effective": "effect",
    "bowdlerize": "bowdler", "probate": "probat", "rate": "rate", "cease": "ceas",
    "controll": "control", "roll": "roll", "running": "run", "cities": "citi",
    "history": "histori", "apos": "apo", "this": "thi", "days": "dai", "age": "ag",
    "january": "januari", "uses": "us", "used": "us",
}


def spark_stems(spark, words, revision="revised"):
    df = spark.createDataFrame([(list(words),)], "words array<string>")
    return df.select(stem_all("words", revision)).first()[0]


def odd_words():
    rng = random.Random(5)
    ends = (
        "ational tional enci anci izer bli abli alli entli eli ousli ization ation ator alism iveness "
        "fulness ousness aliti iviti biliti logi icate ative alize iciti ical ful ness al ance ence er "
        "ic able ible ant ement ment ent ion sion tion ou ism ate iti ous ive ize e ll ed ing eed s "
        "sses ies ated bled ized ying yyed yying eses"
    ).split()
    out = set()
    for _ in range(20_000):
        letters = rng.choice(("aby", "ylae", "bcdaeiouyl", "tswxyze"))
        head = "".join(rng.choice(letters) for _ in range(rng.randint(0, 6)))
        word = head + rng.choice(ends) + rng.choice(("", "", "s", "ed", "ing", "y"))
        if len(word) >= 3:
            out.add(word)
    return sorted(out)


def test_known_stems(spark):
    assert dict(zip(KNOWN, spark_stems(spark, KNOWN))) == KNOWN
    assert {w: plain.stem(w) for w in KNOWN} == KNOWN


def test_array_form_equals_definition_on_odd_words(spark):
    words = odd_words()
    got = spark_stems(spark, words)
    wrong = [(w, g, plain.stem(w)) for w, g in zip(words, got) if g != plain.stem(w)]
    assert not wrong, wrong[:20]


def test_printed_revision(spark):
    words = ["possibly", "archaeology", "conformabli", "geology", "nobly"] + odd_words()[:3000]
    got = spark_stems(spark, words, "1980")
    assert got == [plain.stem(w, "1980") for w in words]
    assert got[1] == "archaeologi" and spark_stems(spark, words[:2])[1] == "archaeolog"


def test_unknown_revision():
    with pytest.raises(ValueError):
        steps("2000")


def test_vocabulary_equals_definition(spark, docs):
    rows = stem_vocabulary(docs).collect()
    assert len(rows) == len({r.word for r in rows}) > 10_000
    assert [(r.word, r.stem) for r in rows if r.stem != plain.stem(r.word)] == []


def test_column_form_equals_array_form(spark):
    words = odd_words()[:5000]
    df = spark.createDataFrame([(w,) for w in words], "word string")
    column = {r.word: r.stem for r in with_stem(df, "word", "stem").collect()}
    assert [column[w] for w in words] == spark_stems(spark, words)


def starts_right(word, revision="revised"):
    (prefix,) = next(iter(word_prefixes([plain.stem(word, revision)], longest=99).values()))
    return word.startswith(prefix)


@given(st.text(alphabet="abeilnstyz", min_size=3, max_size=12))
def test_word_starts_with_prefix_of_its_stem(word):
    assert starts_right(word) and starts_right(word, "1980")


def test_prefix_property_on_odd_words():
    assert [w for w in odd_words() if not (starts_right(w) and starts_right(w, "1980"))] == []


def test_prefix_property_on_the_vocabulary(docs):
    words = {w for r in docs.collect() for w in plain.tokens(r.text)}
    assert [w for w in words if not starts_right(w)] == []


def test_prefix_test_never_rejects_a_hit(spark):
    words = odd_words()[:4000]
    for stems in ({plain.stem(w) for w in words[::40]}, {"a", "by"}, {"z"}, set()):
        df = spark.createDataFrame([(w,) for w in words], "w string")
        passed = {r.w for r in df.where(may_stem_to(stems)).collect()}
        assert {w for w in words if plain.stem(w) in stems} <= passed
    assert word_prefixes(["histori", "us", "i", "durabl"]) == {0: [""], 2: ["us"], 5: ["durab", "histo"]}
