"""Learned decision lists over document statistics.

Sequential covering: a conjunction of thresholds grows on one part of the
labelled rows by information gain, is pruned on the other, and joins the list if
it is precise there; what it covers leaves the sample, and the next one grows.
The list becomes ordered Spark conditional expressions, and can be read as text.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.llm.common import table
from wordloom.llm.doc_stats import COUNTS, doc_stats

#: Labelled rows that the list is fitted on, at most, taken in hash order of their ids.
SAMPLE_ROWS = 50_000
#: Bad rows of the growing part that a rule grows from, at least.
LEAST_BAD = 5
MIN_WORDS, MAX_REPEATED_PERCENT = 10, 20

#: Name -> (numerator, denominator) of the statistics that conditions compare.
RATIOS = {
    "chars_per_word": ("word_chars", "n_words"),
    "symbols_per_word": ("n_symbols", "n_words"),
    "duplicate_lines": ("n_dup_lines", "n_lines"),
    "repeated_words": ("n_repeat_words", "n_words"),
    "upper_per_char": ("n_upper", "word_chars"),
    "digits_per_char": ("n_digits", "word_chars"),
    "exclaim_per_word": ("n_exclaim", "n_words"),
    "distinct_words": ("n_distinct", "n_words"),
    "same_as_before": ("n_same", "n_words"),
}


@dataclass(frozen=True)
class Condition:
    ratio: str
    sign: str
    bound: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.ratio] >= self.bound if self.sign == ">=" else x[self.ratio] <= self.bound

    def column(self) -> Column:
        return ratio(self.ratio) >= self.bound if self.sign == ">=" else ratio(self.ratio) <= self.bound

    def __str__(self) -> str:
        return f"{self.ratio} {self.sign} {self.bound:.6g}"


@dataclass
class DecisionList:
    """Rules in order, each a conjunction that rejects; what none covers is kept."""

    rules: list[tuple[Condition, ...]] = field(default_factory=list)

    def number(self) -> Column:
        """The first rule that holds, from 0; null if none does."""
        out = F
        for n, rule in enumerate(self.rules):
            whole = F.lit(True)
            for c in rule:
                whole = whole & c.column()
            out = out.when(whole, F.lit(n))
        return F.lit(None).cast("int") if out is F else out

    def rejects(self, x: dict[str, np.ndarray]) -> np.ndarray:
        out = np.zeros(len(next(iter(x.values()))), bool)
        for rule in self.rules:
            out |= covered(rule, x)
        return out

    def __str__(self) -> str:
        return "\n".join("reject if " + " and ".join(map(str, r)) for r in self.rules) + "\nelse keep"


def ratio(name: str) -> Column:
    top, bottom = RATIOS[name]
    return F.col(top) / F.greatest(F.col(bottom), F.lit(1))


def covered(rule: tuple[Condition, ...], x: dict[str, np.ndarray]) -> np.ndarray:
    out = np.ones(len(next(iter(x.values()))), bool)
    for c in rule:
        out &= c.holds(x)
    return out


def best_condition(x: dict[str, np.ndarray], bad: np.ndarray, inside: np.ndarray) -> Condition | None:
    """The threshold with the largest gain among the rows that the rule covers so far.

    Bounds lie midway between neighbouring values; equal gains go to the first
    statistic in order and to the smaller bound.
    """
    p0, n0 = bad[inside].sum(), (~bad[inside]).sum()
    best, found = 1e-9, None
    for name, values in x.items():
        v, b = values[inside], bad[inside]
        order = np.argsort(v, kind="stable")
        v, b = v[order], b[order]
        cuts = np.flatnonzero(v[1:] > v[:-1]) + 1
        if not len(cuts):
            continue
        below_bad = np.cumsum(b)[cuts - 1]
        for sign, p, n in (("<=", below_bad, cuts - below_bad), (">=", p0 - below_bad, (len(v) - cuts) - (p0 - below_bad))):
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(p > 0, p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0))), -1.0)
            at = int(np.argmax(gain))
            if gain[at] > best:
                best, found = float(gain[at]), Condition(name, sign, float((v[cuts[at]] + v[cuts[at] - 1]) / 2))
    return found


def learn(
    x: dict[str, np.ndarray],
    bad: np.ndarray,
    grows: np.ndarray,
    *,
    precision: float = 0.98,
    most_rules: int | None = None,
    most_terms: int | None = None,
) -> DecisionList:
    """Learn a list that rejects ``bad`` rows; ``grows`` marks the growing part, the rest prunes.

    A rule is taken only if at least ``precision`` of what it covers in the
    pruning part, and in both parts together, is bad; so good rows stay.  The
    bad rows from which a rule grew that is not taken are set aside, and the
    next rule grows from others, until fewer than ``LEAST_BAD`` are left to grow
    from.  No rows, or no bad ones, give the empty list.
    """
    out, left, aside = DecisionList(), np.ones(len(bad), bool), np.zeros(len(bad), bool)
    while (most_rules is None or len(out.rules) < most_rules) and (bad & left & grows & ~aside).sum() >= LEAST_BAD:
        rule: tuple[Condition, ...] = ()
        inside = left & grows & ~aside
        while (most_terms is None or len(rule) < most_terms) and (~bad[inside]).any():
            more = best_condition(x, bad, inside)
            if more is None:
                break
            rule += (more,)
            inside = inside & more.holds(x)
        worth, best = -2.0, rule
        for n in range(1, len(rule) + 1):
            at = covered(rule[:n], x) & left & ~grows
            p, n_good = int(bad[at].sum()), int((~bad[at]).sum())
            value = (p - n_good) / (p + n_good) if p + n_good else -1.0
            if value > worth:
                worth, best = value, rule[:n]
        at = covered(best, x) & left
        pruned = at & ~grows
        sure = bad[pruned].mean() if pruned.any() else 0.0
        if not rule:
            break
        if sure < precision or bad[at].mean() < precision:
            aside |= inside & bad
            continue
        out.rules.append(best)
        left &= ~at
    return out


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))


def fit(
    docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "quality", rows: int = SAMPLE_ROWS
) -> DecisionList:
    """Learn from at most ``rows`` labelled documents that pass the base rule.

    The labels taken are the first by hash of doc_id, the same whatever the
    partitioning; their ids, 8 bytes each, are broadcast to the texts.  Null
    labels and unlabelled documents are no examples.
    """
    known = (
        labels.select(F.col("doc_id").alias("__id"), F.col(label).cast("int").alias("__label"))
        .where("__label is not null and __id is not null")
        .orderBy(F.xxhash64("__id"), "__id", "__label")
        .limit(rows)
    )
    taught = docs.select(docs[key].alias("__id"), docs[text].alias("text")).join(F.broadcast(known), "__id")
    sample = (
        doc_stats(taught)
        .where(~base_failed())
        .select("row.__id", "row.__label", *COUNTS)
        .orderBy(F.xxhash64("__id"), "__id", "__label", *COUNTS)
        .limit(rows)
        .select(*[ratio(r).alias(r) for r in RATIOS], "__label", (F.pmod(F.xxhash64("__id", F.lit(7)), F.lit(3)) < 2).alias("__grows"))
        .toPandas()
    )
    x = {r: sample[r].to_numpy(float) for r in RATIOS}
    return learn(x, sample["__label"].to_numpy() == 0, sample["__grows"].to_numpy(bool))


def judged(docs: DataFrame, rules: DecisionList, *, text: str = "text") -> DataFrame:
    """``row``, the document as a struct, its counts, ``base_failed``, the ``rule`` that rejects it, and ``kept``.

    Texts without words, null ones too, fail the base rule; repeated rows are
    judged alike.  Nothing is shuffled.
    """
    out = doc_stats(docs, text=text).withColumn("base_failed", base_failed()).withColumn("rule", rules.number())
    return out.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = judged(docs, fit(docs, table(spark, sf_dir, "labels")))
    return found.select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule"
    )
