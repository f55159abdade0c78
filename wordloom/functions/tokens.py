"""Tokenising expressions: text in, array of words out."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def tokens(text: Column, *, min_len: int = 3, case_sensitive: bool = False) -> Column:
    """Runs of at least ``min_len`` letters a-z, in order, with repeats.

    Everything outside a-z separates words, accented letters included.  With
    ``case_sensitive`` the text is not folded, so capitals separate as well.
    """
    if min_len < 1:
        raise ValueError("min_len must be at least 1")
    folded = text if case_sensitive else F.lower(text)
    return F.regexp_extract_all(folded, F.lit(f"[a-z]{{{min_len},}}"), F.lit(0))


def sql_list(words: Iterable[str]) -> str:
    """``'a', 'b'`` for an IN; words that are not plain a-z equal no token and are left out."""
    plain = sorted({w for w in words if re.fullmatch("[a-z]+", w)})
    return ", ".join(f"'{w}'" for w in plain)


def without(words: str, unwanted: Iterable[str]) -> Column:
    """Drop listed words from an array column; order and repeats of the others stay."""
    listed = sql_list(unwanted)
    return F.expr(f"filter({words}, w -> w NOT IN ({listed}))") if listed else F.col(words)


def only(words: str, wanted: Iterable[str]) -> Column:
    """Keep listed words of an array column; order and repeats stay, positions become dense."""
    return F.expr(f"filter({words}, w -> w IN ({sql_list(wanted) or 'NULL'}))")


def java_trim(text: Column) -> Column:
    """Strip every character up to U+0020 from both ends (``trim`` strips blanks only)."""
    return F.regexp_replace(text, r"^[\x00-\x20]+|[\x00-\x20]+$", "")
