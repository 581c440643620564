"""Quality rules: a decision list learned by sequential covering and applied as one Spark expression.

Per-text measures are built-in column functions over the whole text. Labelled rows are reduced to ``(measure, bin)``
histograms by Spark; the driver only sees those (measures x bins, whatever the input) and grows one rule at a time:

1. grow: add the threshold that gains most (FOIL gain) on the growing rows not yet covered,
2. prune: drop trailing conditions while the rule gets better on the pruning rows,
3. keep the rule if it is precise enough on both, take out what it covers, and go on.

The rules become one ordered CASE expression: the number of the first rule that holds, else null (the text is kept).
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockwright.llm.common import UPPER, WHITE, let, table, text_of
from stockwright.sources.tables import stage

WORD_BREAK = r"[\x20\x09-\x0D]+"
HAS_WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
WINDOW = 5

# What rules may test; ratios, so that a threshold means the same for short and long texts.
MEASURES = {
    "symbols_per_word": lambda m: m["n_symbols"] / F.greatest(m["n_words"], F.lit(1)),
    "repeated_words": lambda m: m["n_repeat_words"] / F.greatest(m["n_words"], F.lit(1)),
    "repeated_lines": lambda m: m["n_dup_lines"] / F.greatest(m["n_lines"], F.lit(1)),
    "bars_per_word": lambda m: m["n_bars"] / F.greatest(m["n_words"], F.lit(1)),
    "shouts_per_word": lambda m: m["n_shouts"] / F.greatest(m["n_words"], F.lit(1)),
    "capitals": lambda m: m["n_capitals"] / F.greatest(m["word_chars"], F.lit(1)),
    # Unlike the plain share of distinct words, this hardly falls with the length of a text.
    "vocabulary": lambda m: F.log(m["n_distinct"] + 1.0) / F.log(m["n_words"] + 1.0001),
    "word_length": lambda m: m["word_chars"] / F.greatest(m["n_words"], F.lit(1)),
    "words_per_line": lambda m: m["n_words"] / F.greatest(m["n_lines"], F.lit(1)),
}


def repeat_words(words: Column) -> Column:
    """Words that lie in a five-word window found twice or more in the same text."""

    def window(i: Column) -> Column:
        return F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)])

    def covered(places: Column) -> Column:
        """Places sorted: each adds the words up to the next place, five at most."""
        step = F.transform(
            places, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(places, i + 1) - p, F.lit(WINDOW)))
        )
        return F.aggregate(step, F.lit(0), lambda total, x: total + x)

    def repeated(hashes: Column) -> Column:
        ordered = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def twins(pairs: Column) -> Column:
            same = F.filter(
                pairs,
                lambda p, j: F.get(pairs, j + 1)["h"].eqNullSafe(p["h"]) | ((j > 0) & F.get(pairs, j - 1)["h"].eqNullSafe(p["h"])),
            )
            return F.sort_array(F.transform(same, lambda p: p["i"]))

        return let(let(ordered, twins), covered)

    hashes = F.transform(F.sequence(F.lit(0), F.size(words) - WINDOW), window)
    return F.when(F.size(words) <= WINDOW, F.lit(0)).otherwise(
        let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(repeated(h)))
    )


def measured(text: Column) -> Column:
    """Counts of one whole text, as a struct."""

    def counts(text: Column) -> Column:
        words = F.array_remove(F.split(text, WORD_BREAK), "")
        lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(HAS_WORD))

        def without(chars: str) -> Column:
            return F.length(F.translate(text, chars, ""))

        def of_words(w: Column) -> Column:
            return F.struct(
                F.size(w).cast("long").alias("n_words"),
                F.size(F.array_distinct(w)).cast("long").alias("n_distinct"),
                repeat_words(w).cast("long").alias("n_repeat_words"),
            )

        def of_lines(x: Column) -> Column:
            return F.struct(
                F.size(x).cast("long").alias("n_lines"),
                (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            )

        size = F.length(text)
        return F.struct(
            let(words, of_words).alias("words"),
            let(lines, of_lines).alias("lines"),
            without(WHITE).cast("long").alias("word_chars"),
            (size - without(SYMBOLS)).cast("long").alias("n_symbols"),
            (size - without("|")).cast("long").alias("n_bars"),
            (size - without("!")).cast("long").alias("n_shouts"),
            (size - without(UPPER)).cast("long").alias("n_capitals"),
        )

    return let(text, counts)


def flat(counts: Column) -> list[Column]:
    names = ("word_chars", "n_symbols", "n_bars", "n_shouts", "n_capitals")
    return [
        *[counts["words"][n].alias(n) for n in ("n_words", "n_distinct", "n_repeat_words")],
        *[counts["lines"][n].alias(n) for n in ("n_lines", "n_dup_lines")],
        *[counts[n].alias(n) for n in names],
    ]


def base_failed(counts: DataFrame) -> Column:
    """The fixed rule: too few words, or too many of them repeated."""
    return (counts["n_words"] < 10) | (100 * counts["n_repeat_words"] > 20 * counts["n_words"])


@dataclass(frozen=True)
class Condition:
    """``measure > limit`` (or ``<= limit``)."""

    measure: str
    above: bool
    limit: float

    def holds(self, value: Column) -> Column:
        return value > self.limit if self.above else value <= self.limit

    def __str__(self) -> str:
        return f"{self.measure} {'>' if self.above else '<='} {self.limit:.6g}"


Rule = tuple[Condition, ...]


def verdict(rules: list[Rule], values: dict[str, Column]) -> Column:
    """Number from 1 of the first rule that holds, else null."""
    chain = None
    for n, rule in enumerate(rules, 1):
        holds = reduce(lambda a, b: a & b, [c.holds(values[c.measure]) for c in rule])
        chain = F.when(holds, n) if chain is None else chain.when(holds, n)
    return F.lit(None).cast("int") if chain is None else chain.cast("int")


def _limits(rows: DataFrame, bins: int) -> dict[str, list[float]]:
    """Midpoints between neighbouring quantiles of the two classes; at most 2 x bins + 1 for a measure."""
    levels = [i / bins for i in range(bins + 1)]
    found = rows.groupBy("bad").agg(*[F.percentile_approx(m, levels, 10000).alias(m) for m in MEASURES]).collect()
    limits = {}
    for m in MEASURES:
        values = sorted({v for row in found for v in (row[m] or [])})
        limits[m] = [(a + b) / 2 for a, b in zip(values, values[1:])]
    return limits


def _bin(value: Column, limits: list[float]) -> Column:
    """Number of limits below the value."""
    return F.size(F.filter(F.array(*map(F.lit, limits)).cast("array<double>"), lambda limit: value > limit))


def _gain(p0: int, n0: int, p: int, n: int) -> float:
    return 0.0 if p == 0 else p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0)))


def learn(labelled: DataFrame, bins: int = 32, max_rules: int = 12, max_conditions: int = 3, precision: float = 0.99,
          support: int = 3) -> list[Rule]:
    """Rules for bad texts from rows with the ``MEASURES``, ``bad`` (boolean) and ``grow`` (boolean, else pruning).

    A rule must cover ``support`` bad growing rows and reach ``precision`` on growing and pruning rows together.
    Without labelled rows of both kinds there are no rules. What comes to the driver is bounded by measures x bins.
    """
    rows = stage(labelled.select("bad", "grow", *MEASURES), "labelled")
    limits = _limits(rows, bins)
    # Number of limits below the value: the bin of the measure.
    binned = stage(
        rows.select(
            "bad",
            "grow",
            *MEASURES,
            F.array(*[_bin(F.col(m), limits[m]) for m in MEASURES]).alias("bin"),
        ),
        "binned",
    )

    def covered_by(rule: Rule) -> Column:
        return reduce(lambda a, b: a & b, [c.holds(F.col(c.measure)) for c in rule], F.lit(True))

    def grow(left: DataFrame) -> Rule:
        rule: Rule = ()
        while len(rule) < max_conditions:
            hits = left.where(F.col("grow") & covered_by(rule))
            counts = (
                hits.select("bad", F.posexplode("bin").alias("m", "b"))
                .groupBy("m", "b")
                .agg(F.count_if("bad").alias("p"), F.count_if(~F.col("bad")).alias("n"))
                .collect()
            )
            best = None
            for i, m in enumerate(MEASURES):
                of = {r["b"]: (r["p"], r["n"]) for r in counts if r["m"] == i}
                p0, n0 = sum(p for p, _ in of.values()), sum(n for _, n in of.values())
                if p0 == 0 or n0 == 0:
                    continue
                p = n = 0
                for b, limit in enumerate(limits[m]):
                    p, n = p + of.get(b, (0, 0))[0], n + of.get(b, (0, 0))[1]
                    for above, x, y in ((False, p, n), (True, p0 - p, n0 - n)):
                        gain = _gain(p0, n0, x, y)
                        if x >= support and gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                            best = (gain, Condition(m, above, limit), y)
            if best is None:
                break
            rule = (*rule, best[1])
            if best[2] == 0:
                break
        return rule

    def scores(left: DataFrame, rule: Rule) -> list[tuple[int, int, int, int]]:
        """Bad and good rows under each prefix of the rule, of growing and of pruning rows."""
        sums = []
        for k in range(1, len(rule) + 1):
            for part in (F.col("grow"), ~F.col("grow")):
                for kind in (F.col("bad"), ~F.col("bad")):
                    sums.append(F.count_if(covered_by(rule[:k]) & part & kind))
        row = left.agg(*[s.alias(f"s{i}") for i, s in enumerate(sums)]).first()
        return [tuple(row[4 * k : 4 * k + 4]) for k in range(len(rule))]

    rules: list[Rule] = []
    left = binned
    while len(rules) < max_rules:
        rule = grow(left)
        if not rule:
            break
        by_prefix = scores(left, rule)
        worth = [(p - n) / (p + n) if p + n else -1.0 for _, _, p, n in by_prefix]
        keep = max(range(len(rule)), key=lambda k: (worth[k], -k))
        a, b, p, n = by_prefix[keep]
        if (a + p) < precision * (a + b + p + n):
            a, b, p, n = by_prefix[-1]
            keep = len(rule) - 1
        if a < support or (a + p) < precision * (a + b + p + n):
            break
        rules.append(rule[: keep + 1])
        left = left.where(~covered_by(rule[: keep + 1]))
    return rules


def labelled_measures(counts: DataFrame, labels: DataFrame) -> DataFrame:
    """Measures of the texts with a quality label; a text is bad where its smallest label is 0.

    ``counts`` are rows of ``doc_id`` and the counts; two thirds of the ids grow rules, one third prunes them.
    """
    known = labels.where(F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    joined = counts.join(known, "doc_id")
    return joined.select(
        (F.col("quality") == 0).alias("bad"),
        (F.crc32(F.col("doc_id").cast("string")) % 3 != 0).alias("grow"),
        *[value(joined).cast("double").alias(name) for name, value in MEASURES.items()],
    )


def judged(counts: DataFrame, rules: list[Rule]) -> tuple[Column, Column]:
    """``rule`` and ``kept`` for rows with the counts."""
    rule = verdict(rules, {name: value(counts) for name, value in MEASURES.items()})
    return rule, ~base_failed(counts) & rule.isNull()


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document.

    A null text has no words and fails the fixed rule; repeated rows are judged each; without labels only the fixed
    rule applies; no documents give no rows.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counts = docs.select("doc_id", measured(text_of(docs)).alias("m")).select("doc_id", *flat(F.col("m")))
    counts = stage(counts, "measures")
    rules = learn(labelled_measures(counts, table(spark, sf_dir, "labels").select("doc_id", "quality")))
    rule, kept = judged(counts, rules)
    return counts.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed(counts).alias("base_failed"),
        kept.alias("kept"),
        rule.alias("rule"),
    )


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of ``docs`` that the fixed rule and the learned rules keep, with all their columns.

    The rules are learned from the labelled rows of ``docs`` itself.
    """
    whole = docs.select(F.struct("*").alias("row"), F.col("doc_id"), measured(text_of(docs)).alias("m"))
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    counts = stage(whole.select("row", "doc_id", *flat(F.col("m"))), "measures")
    rules = learn(labelled_measures(counts.drop("row"), labels))
    _, kept = judged(counts, rules)
    return counts.where(kept).select("row.*")
