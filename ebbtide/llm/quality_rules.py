"""Weakly supervised quality filter: rules vote or abstain, EM weighs them, a posterior decides.

The main path is DataFrame functions only.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ebbtide.llm.staging import id_back, id_or_least, keep

BLANKS = "[ \\t-\\r]+"
PLAIN = "(?<![^ \\t-\\r])\\p{L}++[.,;:]?(?![^ \\t-\\r])"  # letters, then one mark at most
# Frequent function words of the languages in the corpus.
STOP_WORDS = (
    "the of and to in a is that for it as was with be by on not he this are or his from at "
    "der die und das von zu mit den ist im für auf sich nicht ein eine des dem "
    "le la les et des une un du que qui dans est pour pas sur au par "
    "el los las y del se una por con para como su al lo es").split()


@dataclass(frozen=True)
class Rule:
    """Votes good up to one bound of a measure, bad from another, and abstains in between."""

    name: str
    measure: str
    good: float
    bad: float

    def vote(self) -> Column:
        value = F.expr(self.measure)
        rising = self.good < self.bad
        return F.when(value <= self.good if rising else value >= self.good, 1).when(
            value >= self.bad if rising else value <= self.bad, -1).otherwise(0)


RULES = (
    Rule("symbols", "try_divide(n_symbols, n_words)", 0.1, 0.25),
    Rule("plain_words", "try_divide(n_plain, n_words)", 0.8, 0.6),
    Rule("repeats", "try_divide(n_repeat_words, n_words)", 0.1, 0.25),
    Rule("capitals", "try_divide(n_upper, word_chars)", 0.2, 0.4),
    Rule("shouts", "try_divide(n_marks, n_words)", 0.15, 0.4),
    Rule("lines", "try_divide(n_dup_lines, n_lines)", 0.1, 0.3),
    Rule("function_words", "n_stop_words", 2, -1),
)


def left_over(text: Column, pattern: str) -> Column:
    """Characters that stay when all runs of pattern are taken out."""
    return F.char_length(F.regexp_replace(text, pattern, ""))


def measures(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, doc, counts): everything the rules look at, over whole texts; row is all of docs.

    Words are runs of anything but ASCII white space; a NULL text has none.
    """
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")).select(
        "row", F.coalesce(F.col("row")[text].cast("string"), F.lit("")).alias("text"))
    split = rows.select(
        "row", id_or_least(f"row.`{key}`").alias("doc"), "text",
        F.array_remove(F.split("text", BLANKS), "").alias("words"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike("[^ \\t-\\r]")).alias("lines"),
        F.regexp_replace("text", "[^#*$%&|<>!?\\p{Lu}]+", "").alias("signs"))
    counted = split.select(
        "row", "doc", "words",
        F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        left_over(F.col("signs"), "[^#*$%&|<>]+").cast("long").alias("n_symbols"),
        left_over(F.col("signs"), "\\P{Lu}+").cast("long").alias("n_upper"),
        left_over(F.col("signs"), "[^!?]+").cast("long").alias("n_marks"),
        F.regexp_count("text", F.lit(PLAIN)).cast("long").alias("n_plain"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.array_intersect("words", F.array(*map(F.lit, STOP_WORDS)))).cast("long")
        .alias("n_stop_words"))
    # a three-word window is one long: its hash, with its place in the low bits that a text of
    # this length needs, so windows that are equal stand side by side once the longs are sorted
    places = counted.withColumn("low", F.pow(
        F.lit(2), F.ceil(F.log2(F.col("n_words") + 2))).cast("long") - 1)
    high = F.bitwise_not("low")
    triples = places.withColumn("triples", F.sort_array(F.transform(
        F.slice("words", 1, F.greatest(F.col("n_words") - 2, F.lit(0)).cast("int")),
        lambda word, i: F.xxhash64(word, F.get("words", i + 1), F.get("words", i + 2))
        .bitwiseAND(high).bitwiseOR(i.cast("long")))))

    def same(x: Column, y: Column) -> Column:
        return F.coalesce(x.bitwiseXOR(y).bitwiseAND(high) == 0, F.lit(False))

    again = triples.withColumn("starts", F.sort_array(F.transform(
        F.filter("triples", lambda t, i: same(t, F.get("triples", i + 1))
                 | same(t, F.get("triples", i - 1))),
        lambda t: t.bitwiseAND(F.col("low")).cast("int"))))
    first = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n"))
    covered = F.aggregate(
        "starts", first,
        lambda acc, at: F.struct(at.alias("last"),
                                 (acc["n"] + F.least(F.lit(3), at - acc["last"])).alias("n")),
        lambda acc: acc["n"])
    return again.withColumn("n_repeat_words", covered).drop("words", "low", "triples", "starts")


@dataclass(frozen=True)
class VoteModel:
    """Prior of good text and, per rule, the share of good votes among good and bad texts."""

    prior: float
    shares: Mapping[str, tuple[float, float]]

    def log_odds(self) -> Column:
        total = F.lit(math.log(self.prior / (1 - self.prior)))
        for name, (good, bad) in self.shares.items():
            total = total + F.when(F.col(f"vote_{name}") == 1, math.log(good / bad)).when(
                F.col(f"vote_{name}") == -1, math.log((1 - good) / (1 - bad))).otherwise(0.0)
        return total


def fit_votes(patterns: Sequence[tuple[Sequence[int], int]], names: Sequence[str], *,
              rounds: int = 200, start: tuple[float, float] = (0.95, 0.6),
              prior: float = 0.8, weight: float = 2.0) -> VoteModel:
    """Expectation-maximisation over distinct vote patterns and how often each occurs.

    Votes are independent given the quality of a text and abstaining tells nothing. weight is
    the number of imagined votes that hold each share near its start, so a rule that never
    votes keeps it and no share becomes 0 or 1; they hold the prior near its start likewise.
    Stops when nothing moves any more.
    """
    shares, first = {name: start for name in names}, prior
    for _ in range(rounds):
        total = good_total = 0.0
        cast = {name: [[0.0, 0.0], [0.0, 0.0]] for name in names}
        for votes, count in patterns:
            odds = math.log(prior / (1 - prior))
            for name, vote in zip(names, votes):
                good, bad = shares[name]
                odds += math.log(good / bad) if vote == 1 else (
                    math.log((1 - good) / (1 - bad)) if vote == -1 else 0.0)
            share = 1 / (1 + math.exp(-max(-700.0, min(700.0, odds))))
            total += count
            good_total += share * count
            for name, vote in zip(names, votes):
                if vote:
                    for side, mass in enumerate((share * count, (1 - share) * count)):
                        cast[name][side][0] += mass * (vote == 1)
                        cast[name][side][1] += mass
        new = {name: tuple((yes + weight * s) / (n + weight)
                           for (yes, n), s in zip(cast[name], start)) for name in names}
        new_prior = (good_total + weight * first) / (total + weight)
        moved = max([abs(new_prior - prior)] + [
            abs(a - b) for name in names for a, b in zip(new[name], shares[name])])
        shares, prior = new, new_prior
        if moved < 1e-9:
            break
    return VoteModel(prior, shares)


def judged(docs: DataFrame, rules: Sequence[Rule], min_words: int, max_repeat_percent: int,
           key: str, text: str) -> DataFrame:
    """measures, base_failed and the vote of each rule."""
    failed = (F.col("n_words") < min_words) | (
        100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    return measures(docs, key=key, text=text).withColumn("base_failed", failed).withColumns(
        {f"vote_{rule.name}": rule.vote() for rule in rules})


def fitted(voted: DataFrame, rules: Sequence[Rule]) -> VoteModel:
    """The vote model of all texts, from the counts of their vote patterns."""
    votes = [f"vote_{rule.name}" for rule in rules]
    counts = voted.groupBy(*votes).agg(F.count(F.lit(1)).alias("n")).orderBy(*votes).collect()
    return fit_votes([(row[:-1], row[-1]) for row in counts], [rule.name for rule in rules])


def decided(voted: DataFrame, model: VoteModel, at_least: float) -> DataFrame:
    """Adds probability and kept."""
    return voted.withColumn("probability", 1 / (1 + F.exp(-model.log_odds()))).withColumn(
        "kept", ~F.col("base_failed") & (F.col("probability") >= at_least))


def quality_votes(docs: DataFrame, *, rules: Sequence[Rule] = RULES, min_words: int = 50,
                  max_repeat_percent: int = 50, at_least: float = 0.5, key: str = "doc_id",
                  text: str = "text") -> DataFrame:
    """Per row of docs: key, counts, base_failed, kept, probability and the vote of each rule.

    base_failed: fewer than min_words words, or over max_repeat_percent percent of the words in
    three-word windows that occur twice in the text. All other texts are judged by the posterior
    of the vote model, which is fitted on the votes of all texts: only the counts of the vote
    patterns, at most 3 per rule multiplied, come to the driver. An empty or NULL text has no
    words and fails; an empty table gives an empty result; repeated rows are judged alike;
    other columns are ignored.
    """
    voted = keep(judged(docs, rules, min_words, max_repeat_percent, key, text).drop("row"))
    return decided(voted, fitted(voted, rules), at_least).select(
        id_back(F.col("doc")).alias(key), "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed", "kept", "probability",
        *[f"vote_{rule.name}" for rule in rules])


def keep_quality(docs: DataFrame, *, rules: Sequence[Rule] = RULES, min_words: int = 50,
                 max_repeat_percent: int = 50, at_least: float = 0.5, key: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """The rows of docs, all columns, whose text is kept by the same rules.

    The texts are read twice, once to fit the model and once to filter, and never shuffled.
    """
    made = judged(docs, rules, min_words, max_repeat_percent, key, text)
    model = fitted(made, rules)
    # a running number keeps the optimiser from moving the filter below the measures, where it
    # would write out each of them again wherever another uses it
    held = decided(made, model, at_least).withColumn("held", F.monotonically_increasing_id())
    return held.where(F.col("kept") & (F.col("held") >= 0)).select("row.*")
