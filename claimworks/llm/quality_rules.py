"""Quality rules: a decision list learned by sequential covering.

Every document is measured by built-in functions only.  The labelled measurements are
binned, and rules that reject documents are learned one after the other: a rule grows
condition by condition (largest information gain on two thirds of the labelled rows), is
pruned back to its best prefix on the remaining third, and takes the rows it covers out of
the following rules' sight.  All counts come from Spark aggregations over *all* labelled
rows; the driver sees at most bins x features of them.  The learned list is an ordered
``when`` expression.

Defined cases: a null or empty text has no words and is rejected by the base rule; a null
``doc_id`` is measured and judged like any other but has no label; repeated rows stay and
are judged alike; a document labelled more than once takes its lowest label and null labels
are ignored; without labels the list is empty and the base rule alone decides; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimworks.llm.common import SPACES, let, words
from claimworks.plans.workspace import write_table

MIN_WORDS = 50
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = (
    "mean_word", "symbol_ratio", "repeat_ratio", "dup_line_ratio", "upper_ratio",
    "digit_ratio", "mark_ratio", "distinct_ratio", "line_words",
)


# --- measurements ------------------------------------------------------------


def _covered(starts: Column) -> Column:
    """Words in the union of the 3-word windows that begin at the sorted ``starts``."""
    gaps = F.transform(
        starts, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(starts, k + 1) - p, F.lit(3)))
    )
    return F.aggregate(gaps, F.lit(0), lambda total, gap: total + gap)


def _repeated_starts(windows: Column) -> Column:
    """Start positions of the windows that occur twice or more, in order."""
    placed = F.sort_array(F.transform(windows, lambda h, k: F.struct(h.alias("h"), k.alias("k"))))

    def twice(found: Column) -> Column:
        same = F.filter(
            found,
            lambda x, k: F.coalesce(F.get(found, k - 1)["h"] == x["h"], F.lit(False))
            | F.coalesce(F.get(found, k + 1)["h"] == x["h"], F.lit(False)),
        )
        return F.sort_array(F.transform(same, lambda x: x["k"]))

    return let(placed, twice)


def repeat_words(tokens: Column) -> Column:
    """Words that lie in a 3-word window found twice or more in the text.

    Windows are compared by 64-bit hashes; only texts that repeat one sort them.
    """
    count = F.size(tokens)
    windows = F.transform(
        F.sequence(F.lit(0), count - 3),
        lambda k: F.xxhash64(F.get(tokens, k), F.get(tokens, k + 1), F.get(tokens, k + 2)),
    )
    found = let(
        windows,
        lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(
            let(_repeated_starts(w), _covered)
        ),
    )
    return F.when(count < 4, F.lit(0)).otherwise(found)


def _count(text: Column, outside: str) -> Column:
    """Characters of a text outside the class ``outside``."""
    return F.length(F.regexp_replace(text, outside, ""))


def measure(docs: DataFrame, whole: bool = False) -> DataFrame:
    """``doc_id`` and every measurement of the text, one row per document.

    With ``whole``, the document itself is carried along in the struct ``row``.
    """
    columns = [F.col("doc_id").cast("long").alias("doc_id")]
    if whole:
        columns.append(F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"))
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    of_words = let(
        words(text),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            repeat_words(w).cast("long").alias("n_repeat_words"),
            F.size(F.array_distinct(w)).cast("long").alias("n_distinct"),
        ),
    )
    of_lines = let(
        lines,
        lambda x: F.struct(
            F.size(x).cast("long").alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        ),
    )
    counted = docs.select(
        *columns,
        F.struct(
            of_words.alias("w"),
            of_lines.alias("l"),
            _count(text, SPACES).cast("long").alias("word_chars"),
            _count(text, r"[^#*$%&|<>]+").cast("long").alias("n_symbols"),
            _count(text, r"[^\p{Lu}]+").cast("long").alias("n_upper"),
            _count(text, r"[^0-9]+").cast("long").alias("n_digits"),
            _count(text, r"[^!?]+").cast("long").alias("n_marks"),
        ).alias("_m"),
    )
    m = F.col("_m")
    per_word = lambda value: value / F.greatest(m["w"]["n_words"], F.lit(1))
    per_char = lambda value: value / F.greatest(m["word_chars"], F.lit(1))
    return counted.select(
        *[name for name in counted.columns if name != "_m"],
        m["w"]["n_words"].alias("n_words"),
        m["word_chars"].alias("word_chars"),
        m["n_symbols"].alias("n_symbols"),
        m["l"]["n_dup_lines"].alias("n_dup_lines"),
        m["w"]["n_repeat_words"].alias("n_repeat_words"),
        base_failed(m["w"]["n_words"], m["w"]["n_repeat_words"]).alias("base_failed"),
        per_word(m["word_chars"]).alias("mean_word"),
        per_word(m["n_symbols"]).alias("symbol_ratio"),
        per_word(m["w"]["n_repeat_words"]).alias("repeat_ratio"),
        (m["l"]["n_dup_lines"] / F.greatest(m["l"]["n_lines"], F.lit(1))).alias("dup_line_ratio"),
        per_char(m["n_upper"]).alias("upper_ratio"),
        per_char(m["n_digits"]).alias("digit_ratio"),
        per_word(m["n_marks"]).alias("mark_ratio"),
        per_word(m["w"]["n_distinct"]).alias("distinct_ratio"),
        (m["w"]["n_words"] / F.greatest(m["l"]["n_lines"], F.lit(1))).alias("line_words"),
    )


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > 50 * n_words)


# --- the learned list --------------------------------------------------------


@dataclass(frozen=True)
class Condition:
    """``feature > threshold`` or ``feature <= threshold``."""

    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = F.col(self.feature)
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _all(rule: Sequence[Condition]) -> Column:
    return reduce(lambda a, b: a & b, [c.column() for c in rule], F.lit(True))


@dataclass(frozen=True)
class DecisionList:
    """Rules in order; a document that one of them covers is rejected."""

    rules: tuple[Rule, ...]

    def rejecting_rule(self) -> Column:
        """1-based number of the first rule that covers the row, 0 if none does."""
        if not self.rules:
            return F.lit(0)
        first, *rest = enumerate(self.rules, 1)
        chain = F.when(_all(first[1]), F.lit(first[0]))
        for number, rule in rest:
            chain = chain.when(_all(rule), F.lit(number))
        return chain.otherwise(F.lit(0))

    def __str__(self) -> str:
        lines = [f"{k}. reject if " + " and ".join(map(str, r)) for k, r in enumerate(self.rules, 1)]
        return "\n".join([*lines, "keep"])


def _gain(p: float, n: float, all_p: float, all_n: float) -> float:
    """Information gained on the covered positives (rejects) by adding a condition."""
    if p <= 0 or all_p <= 0:
        return 0.0
    return p * (math.log2(p / (p + n)) - math.log2(all_p / (all_p + all_n)))


def _cuts(rows: DataFrame, bins: int) -> dict[str, list[float]]:
    """At most ``2 * bins`` thresholds per feature: quantiles of either label."""
    shares = [k / bins for k in range(bins)]
    found = rows.groupBy("bad").agg(
        *[F.percentile_approx(f, shares, 1000).alias(f) for f in FEATURES]
    ).collect()  # two rows
    return {f: sorted({v for row in found for v in row[f] or ()}) for f in FEATURES}


def _bin(feature: str, cuts: Sequence[float]) -> Column:
    """How many cuts lie below the value."""
    if not cuts:
        return F.lit(0)
    return F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: F.col(feature) > c))


Aside = frozenset[tuple[str, bool]]  # features and directions


def _best(rows: DataFrame, aside: Aside = frozenset()) -> tuple[Condition | None, float, float]:
    """The condition of largest gain on ``rows`` that is not ``aside``, and the rows' label counts."""
    per_feature = F.explode(
        F.array(
            *[
                F.struct(F.lit(f).alias("feature"), F.col(f"bin_{f}").alias("bin"), F.col(f).alias("value"))
                for f in FEATURES
            ]
        )
    ).alias("x")
    stats = (
        rows.select("bad", per_feature)
        .groupBy("x.feature", "x.bin")
        .agg(
            F.sum("bad").alias("p"), F.count(F.lit(1)).alias("rows"),
            F.min("x.value").alias("least"), F.max("x.value").alias("most"),
        )
        .collect()  # at most features x bins rows
    )
    by_feature: dict[str, list] = {f: [] for f in FEATURES}
    for row in stats:
        by_feature[row.feature].append(row)
    some = max(by_feature.values(), key=len)
    all_p, all_n = float(sum(r.p for r in some)), float(sum(r.rows - r.p for r in some))
    best, best_gain = None, 0.0
    for feature in FEATURES:
        ordered = sorted(by_feature[feature], key=lambda r: r.bin)
        low_p = low_n = 0.0
        for at, row in enumerate(ordered[:-1]):
            low_p, low_n = low_p + row.p, low_n + row.rows - row.p
            # half way between the values on either side
            threshold = (row.most + ordered[at + 1].least) / 2
            for above, p, n in ((True, all_p - low_p, all_n - low_n), (False, low_p, low_n)):
                gain = _gain(p, n, all_p, all_n)
                if gain > best_gain + 1e-9 and (feature, above) not in aside:
                    best, best_gain = Condition(feature, above, threshold), gain
    return best, all_p, all_n


def _grown(rows: DataFrame, aside: Aside, most: int | None) -> list[Condition]:
    """Conditions added one by one, the best first, until they cover rejects only or none helps."""
    grown: list[Condition] = []
    while most is None or len(grown) < most:
        best, p, n = _best(rows.filter(_all(grown)), frozenset() if grown else aside)
        if best is None or p == 0 or n == 0:
            break
        grown.append(best)
    return grown


def learn(
    labelled: DataFrame,
    *,
    bins: int = 24,
    max_rules: int | None = None,
    max_conditions: int | None = None,
    min_precision: float = 0.8,
    min_rows: int = 4,
) -> DecisionList:
    """Learn the list from measured rows with a ``quality`` of 0 or 1 and a ``doc_id``.

    ``min_precision`` and ``min_rows`` are what a pruned rule must reach on the pruning
    third: its share of rejects, and the rejects it covers.  Where a rule fails, what its first condition
    measures is set aside and the next best one is tried; covering ends when none is left, or when too few
    rejects are left for any rule to pass.  Nothing else bounds the list unless ``max_rules`` or
    ``max_conditions`` says so.
    """
    marked = labelled.select(
        (1 - F.col("quality")).cast("long").alias("bad"),
        (F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(3)) == 0).alias("pruning"),
        *FEATURES,
    )
    marked = write_table(marked, "labelled-measures")
    rules: list[Rule] = []
    aside: Aside = frozenset()
    left = None
    while max_rules is None or len(rules) < max_rules:
        if left is None:
            # binned anew after each rule, so that what is left is told apart as finely as all was
            uncovered = marked.filter(DecisionList(tuple(rules)).rejecting_rule() == 0)
            cuts = _cuts(uncovered, bins)
            left = uncovered.select("*", *[_bin(f, cuts[f]).alias(f"bin_{f}") for f in FEATURES])
        grown = _grown(left.filter(~F.col("pruning")), aside, max_conditions)
        if not grown:
            break
        prefixes = [grown[:k] for k in range(1, len(grown) + 1)]
        pruned = left.filter("pruning").agg(
            F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"),
            *[F.coalesce(F.sum(F.when(_all(c), F.col("bad"))), F.lit(0)).alias(f"p{k}") for k, c in enumerate(prefixes)],
            *[F.count(F.when(_all(c), 1)).alias(f"r{k}") for k, c in enumerate(prefixes)],
        ).first()
        if pruned["bad"] < min_rows:
            break
        worth = lambda k: (2 * pruned[f"p{k}"] - pruned[f"r{k}"]) / max(1, pruned[f"r{k}"])  # noqa: E731,B023
        best_prefix = max(range(len(prefixes)), key=lambda k: (worth(k), -k))
        hits, covered = pruned[f"p{best_prefix}"], pruned[f"r{best_prefix}"]
        if hits < min_rows or hits < min_precision * covered:
            aside |= {(grown[0].feature, grown[0].above)}
            continue
        rules.append(tuple(prefixes[best_prefix]))
        left, aside = None, frozenset()  # what failed before may be worth something among the rows that are left
    return DecisionList(tuple(rules))


def with_labels(measured: DataFrame, labels: DataFrame) -> DataFrame:
    """The measured rows that pass the base rule and have a quality label."""
    quality = (
        labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
    )
    return measured.filter(~F.col("base_failed")).select("doc_id", *FEATURES).join(quality, "doc_id")


def judge(
    docs: DataFrame, labels: DataFrame, whole: bool = False, **options: float
) -> tuple[DataFrame, DecisionList]:
    """Every document's measurements with ``rule`` and ``kept``, and the learned list.

    The text is measured once, into a table that learning and judging read; ``rule`` is the
    number of the rule that rejects the document (0: none).  With ``whole`` the table carries
    the documents too, so that rejecting some needs no join.
    """
    measured = write_table(measure(docs, whole), "quality-measures")
    rules = learn(with_labels(measured, labels), **options)
    judged = measured.withColumn("rule", rules.rejecting_rule()).withColumn(
        "kept", ~F.col("base_failed") & (F.col("rule") == 0)
    )
    return judged, rules


def accepted(docs: DataFrame, labels: DataFrame, **options: float) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns."""
    judged, _ = judge(docs, labels, whole=True, **options)
    return judged.filter("kept").select("row.*")
