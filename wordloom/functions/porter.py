"""Porter stemming (M. F. Porter, 1980) as plain SQL expressions.

Every step is a CASE over one word.  :func:`with_stem` applies the steps to a
column of words; :func:`stem_all` applies them to each element of an array
column, so the words of a record are stemmed inside the row that holds them and
no exploded token ever has to be shuffled.  The steps are written as SQL text:
the parser takes all of it at once, where hundreds of Column calls cost seconds.

Words are expected to be lower-case ``a``-``z``, as the tokeniser delivers them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.functions.tokens import sql_list

# The suffix rules of the published algorithm, step by step, in
# the order of the paper.  "revised" is the author's later public revision
# (bli/logi), "1980" the rules as printed.
STEP_2 = (
    ("ational", "ate"),
    ("tional", "tion"),
    ("enci", "ence"),
    ("anci", "ance"),
    ("izer", "ize"),
    ("bli", "ble"),
    ("alli", "al"),
    ("entli", "ent"),
    ("eli", "e"),
    ("ousli", "ous"),
    ("ization", "ize"),
    ("ation", "ate"),
    ("ator", "ate"),
    ("alism", "al"),
    ("iveness", "ive"),
    ("fulness", "ful"),
    ("ousness", "ous"),
    ("aliti", "al"),
    ("iviti", "ive"),
    ("biliti", "ble"),
    ("logi", "log"),
)
STEP_2_AS_PRINTED = tuple(
    ("abli", "able") if suffix == "bli" else (suffix, to)
    for suffix, to in STEP_2
    if suffix != "logi"
)
STEP_3 = (
    ("icate", "ic"),
    ("ative", ""),
    ("alize", "al"),
    ("iciti", "ic"),
    ("ical", "ic"),
    ("ful", ""),
    ("ness", ""),
)
STEP_4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment",
    "ent", "sion", "tion", "ou", "ism", "ate", "iti", "ous", "ive", "ize",
)
DOUBLES = "bb|cc|dd|ff|gg|hh|jj|kk|mm|nn|pp|qq|rr|tt|vv|ww|xx"
REVISIONS = ("revised", "1980")

# A consonant run and a vowel run.  A "y" opens either kind, depending on what
# stands before it, and never continues one.
_C = "[^aeiou][^aeiouy]*"
_V = "[aeiouy][aeiou]*"
_HEAD = f"^(?:{_C})?+"  # possessive: a leading "y" is a consonant, always


def _measure_above(m: int, rest: int) -> str:
    """Pattern: what precedes the last ``rest`` letters has measure > ``m``."""
    return f"{_HEAD}{(_V + _C) * m}{_V}[^aeiou].{{{rest}}}"


def _has_vowel(rest: int) -> str:
    """Pattern: what precedes the last ``rest`` letters holds a vowel."""
    return f"{_HEAD}[aeiouy].{{{rest}}}"


def _short(suffix: str = "") -> str:
    """Pattern: measure 1 and consonant-vowel-consonant (not w, x, y) before ``suffix``."""
    return f"^{_C}[aeiouy][^aeiouwxy]{suffix}$"


def _drop(n: int, add: str = "") -> str:
    """The word ``w`` less its last ``n`` letters, plus ``add``."""
    kept = f"substring(w, 1, length(w) - {n})" if n else "w"
    return f"concat({kept}, '{add}')" if add else kept


def _swap(old: str, new: str) -> str:
    """Replace the ending ``old`` by ``new``, touching only the letters that differ."""
    same = 0
    while same < min(len(old), len(new)) and old[same] == new[same]:
        same += 1
    return _drop(len(old) - same, new[same:])


def _case(*branches: tuple[str, str], otherwise: str = "w") -> str:
    whens = " ".join(f"WHEN {condition} THEN {value}" for condition, value in branches)
    return f"CASE {whens} ELSE {otherwise} END"


def _ends(*suffixes: str) -> str:
    return " OR ".join(f"endswith(w, '{s}')" for s in suffixes)


def _like(pattern: str) -> str:
    return f"w RLIKE '{pattern}'"


def _by_suffix(suffixes: Iterable[str], value: Callable[[str], str]) -> str:
    """First look at the last letter, then try the suffixes that end in it, longest first."""
    suffixes = sorted(suffixes, key=len, reverse=True)
    return _case(
        *[
            (_ends(letter), _case(*[(_ends(s), value(s)) for s in suffixes if s[-1] == letter]))
            for letter in sorted({s[-1] for s in suffixes})
        ]
    )


def _step_1a() -> str:
    plural = _case(
        (_ends("ss"), "w"), (_ends("sses", "ies"), _drop(2)), otherwise=_drop(1)
    )
    return _case((_ends("s"), plural))


def _step_1b() -> str:
    def tidy(suffix: str) -> str:
        n = len(suffix)
        doubled = f"(?:{DOUBLES}){suffix}$|{_HEAD}(?:{_V}{_C})*yy{suffix}$"
        return _case(
            (f"NOT {_like(_has_vowel(n))}", "w"),
            (_like(f"(?:at|bl|iz){suffix}$"), _drop(n, "e")),
            (_like(doubled), _drop(n + 1)),
            (_like(_short(suffix)), _drop(n, "e")),
            otherwise=_drop(n),
        )

    eed = _case((_like(_measure_above(0, 3)), _drop(1)))
    return _case(
        (_ends("ed"), _case((_ends("eed"), eed), otherwise=tidy("ed"))),
        (_ends("ing"), tidy("ing")),
    )


def _step_1c() -> str:
    return _case((_ends("y"), _case((_like(_has_vowel(1)), _drop(1, "i")))))


def _replacing(rules: tuple[tuple[str, str], ...]) -> str:
    table = dict(rules)
    return _by_suffix(
        table, lambda s: _case((_like(_measure_above(0, len(s))), _swap(s, table[s])))
    )


def _step_4() -> str:
    def strip(s: str) -> str:
        n = 3 if s in ("sion", "tion") else len(s)  # only "ion" goes
        return _case((_like(_measure_above(1, n)), _drop(n)))

    return _by_suffix(STEP_4, strip)


def _step_5() -> str:
    silent = f"{_like(_measure_above(0, 1))} AND NOT {_like(_short('e'))}"
    less_e = _case(
        (f"{_ends('lle')} AND {_like(_measure_above(1, 1))}", _drop(2)), otherwise=_drop(1)
    )
    return _case(
        (_ends("e"), _case((silent, less_e))),
        (_ends("ll"), _case((_like(_measure_above(1, 0)), _drop(1)))),
    )


def steps(revision: str = "revised") -> list[str]:
    """The steps, each an SQL expression over the word ``w``."""
    if revision not in REVISIONS:
        raise ValueError(f"revision must be one of {REVISIONS}, got {revision!r}")
    step_2 = STEP_2 if revision == "revised" else STEP_2_AS_PRINTED
    return [
        _step_1a(),
        _step_1b(),
        _step_1c(),
        _replacing(step_2),
        _replacing(STEP_3),
        _step_4(),
        _step_5(),
    ]


def with_stem(df: DataFrame, word: str, out: str, revision: str = "revised") -> DataFrame:
    """Add column ``out``, the stem of column ``word``: one word per row, generated code."""
    if "w" in df.columns and word != "w":
        raise ValueError("column w is needed for the steps")
    stemmed = df.withColumn("w", F.col(word))
    for step in steps(revision):
        stemmed = stemmed.withColumn("w", F.expr(step))
    return stemmed.withColumnRenamed("w", out)


def stem_all(words: str, revision: str = "revised") -> Column:
    """Stem each element of the array column named ``words``."""
    nested = words
    for step in steps(revision):
        nested = f"transform({nested}, w -> {step})"
    return F.expr(nested)


def word_prefixes(stems: Iterable[str], longest: int = 5) -> dict[int, list[str]]:
    """Prefixes, by length, one of which every word with a stem in ``stems`` starts with.

    The rules cut endings, so a stem is a prefix of its word, but for three ways
    to change the last letter: y becomes i, an e is put after what is left, and
    bility becomes bl.
    """
    found: dict[int, set[str]] = {}
    for stem in stems:
        changed = stem.endswith(("i", "e", "bl"))
        n = min(len(stem) - changed, longest)
        found.setdefault(n, set()).add(stem[:n])
    return {n: sorted(found[n]) for n in sorted(found)}


def may_stem_to(stems: Iterable[str]) -> str:
    """SQL test a word ``w`` must pass if its stem is one of ``stems`` (never a false no)."""
    tests = [
        f"substring(w, 1, {n}) IN ({sql_list(prefixes) or 'NULL'})" if n > 0 else "true"
        for n, prefixes in word_prefixes(stems).items()
    ]
    return " OR ".join(tests) or "false"
