"""Quality rules as weak supervision: rules vote or abstain, expectation-maximisation weighs them.

Each rule looks at one property of a text and votes good (1), bad (-1) or
abstains (0).  How often a rule votes which way on good and on bad texts is
unknown; expectation-maximisation over the counts of vote patterns estimates it
together with the share of good texts, without labels.  The posterior
probability of good then decides, so one odd property doesn't reject a text and
several weak ones do.

Only DataFrame functions run over texts and votes.  The driver holds the
parameters: a few numbers per rule, whatever the input.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillspark.llm.tables import free_names, stored
from tillspark.llm.words import GAP

SYMBOLS = "#*$%&|<>"
#: Rounds of expectation-maximisation, and the change of any rate below which it ends earlier.
ROUNDS, STILL = 40, 1e-5
#: Pseudo-counts that keep every vote possible for either class.
PRIOR_VOTES = 0.5
#: Before the first round: the share of good texts, and rates of the votes bad, none and good on good and on bad texts.
FIRST_GOOD, FIRST_ON_GOOD, FIRST_ON_BAD = 0.85, (0.01, 0.09, 0.90), (0.30, 0.25, 0.45)

MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

#: Rules: the property, then the ranges in which it votes good and bad (from, to); outside of both it abstains.
RULES = {
    "length": ("n_words", (80, 1e9), (0, 50)),
    "word_length": ("word_chars / n_words", (3.0, 9.0), (13.0, 1e9)),
    "symbols": ("n_symbols / n_words", (0.0, 0.02), (0.1, 1e9)),
    "repeats": ("n_repeat_words / n_words", (0.0, 0.15), (0.3, 2.0)),
    "lines": ("n_dup_lines / n_lines", (0.0, 0.1), (0.4, 2.0)),
    "capitals": ("n_capitals / word_chars", (0.0, 0.12), (0.4, 2.0)),
    "marks": ("n_marks / n_words", (0.0, 0.3), (0.6, 1e9)),
    "variety": ("n_distinct / n_words", (0.25, 1.01), (0.0, 0.12)),
}


def properties(text: Column) -> list[dict[str, Column]]:
    """Columns to add one dict after the other: each uses those before it.

    A null text counts as empty.  Windows of three words are compared by their
    64-bit hashes, within one text only.
    """
    at = F.col
    body = F.coalesce(text, F.lit(""))
    window = lambda w, i: F.xxhash64(w, F.get(at("_words"), i + 1), F.get(at("_words"), i + 2))
    known_twice = lambda x, k: F.when(
        (x["h"] == F.get(at("_sorted"), k - 1)["h"]) | (x["h"] == F.get(at("_sorted"), k + 1)["h"]), x["i"]
    )
    gain = lambda i, k: F.least(F.lit(3), F.coalesce(F.get(at("_starts"), k + 1) - i, F.lit(3)))
    return [
        {"_body": body},
        {
            "_words": F.filter(F.split(at("_body"), GAP), lambda w: w != ""),
            "_lines": F.filter(F.split(at("_body"), "\n"), lambda x: F.length(F.translate(x, " \t\x0b\x0c\r", "")) > 0),
            "word_chars": F.length(F.translate(at("_body"), " \t\n\x0b\x0c\r", "")).cast("long"),
            "n_symbols": (F.length(at("_body")) - F.length(F.translate(at("_body"), SYMBOLS, ""))).cast("long"),
            "n_capitals": F.length(F.regexp_replace(at("_body"), r"[^\p{Lu}]+", "")).cast("long"),
            "n_marks": (F.length(at("_body")) - F.length(F.translate(at("_body"), "!?|*#$%&<>=_~^{}[]\\/+", ""))).cast("long"),
        },
        {
            "n_words": F.size("_words").cast("long"),
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_distinct": F.size(F.array_distinct("_words")).cast("long"),
            "_windows": F.slice(F.transform("_words", window), F.lit(1), F.greatest(F.size("_words") - 2, F.lit(0))),
        },
        {
            "_sorted": F.when(
                F.size(F.array_distinct("_windows")) < F.size("_windows"),
                F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
            )
        },
        {"_starts": F.sort_array(F.array_compact(F.transform("_sorted", known_twice)))},
        {
            "n_repeat_words": F.coalesce(
                F.aggregate(F.transform("_starts", gain), F.lit(0), lambda a, x: a + x), F.lit(0)
            ).cast("long")
        },
    ]


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def described(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns of the documents, their counts, and ``votes``: one number per rule."""
    carried = free_names(docs, *[f"_keep{i}" for i in range(len(keep))])
    out = docs.select(F.col("text").alias("_text"), *[F.col(c).alias(n) for c, n in zip(keep, carried, strict=True)])
    for step in properties(F.col("_text")):
        out = out.withColumns(step)
    return out.select(*[F.col(n).alias(f"kept_{i}") for i, n in enumerate(carried)], *COUNTS, votes().alias("votes"))


def votes() -> Column:
    def vote(expression: str, good: tuple[float, float], bad: tuple[float, float]) -> Column:
        top, _, under = expression.partition(" / ")
        value = F.col(top).cast("double")
        if under:
            value = F.when(F.col(under) > 0, value / F.col(under))
        within = lambda r: (value >= r[0]) & (value < r[1])
        return F.when(within(good), 1).when(within(bad), -1).otherwise(0)

    return F.array(*[vote(*rule) for rule in RULES.values()])


@dataclass(frozen=True)
class Model:
    """Log odds of good before any vote, and per rule and vote (-1, 0, 1) what that vote adds to them."""

    prior: float
    weights: tuple[tuple[float, float, float], ...]

    def posterior(self, votes: Column) -> Column:
        """Probability that a text with these votes is good."""
        table = F.array(*[F.array(*map(F.lit, w)) for w in self.weights])
        added = F.zip_with(votes, table, lambda v, w: F.get(w, v + 1))
        return 1 / (1 + F.exp(-F.aggregate(added, F.lit(self.prior), lambda a, x: a + x)))


def _model(good: float, rates: list[tuple[tuple, tuple]]) -> Model:
    """From the share of good texts and each rule's rates of votes on good and on bad texts.

    A rule's vote never counts against what it says: rules are taken to be
    better than chance, which also tells the two classes apart.
    """
    weights = []
    for on_good, on_bad in rates:
        bad, none, agree = (math.log(g / b) for g, b in zip(on_good, on_bad, strict=True))
        weights.append((min(bad, 0.0), none, max(agree, 0.0)))
    return Model(math.log(good / (1 - good)), tuple(weights))


def fit(described: DataFrame, rounds: int = ROUNDS) -> Model:
    """Estimate the rules from ``votes``; without rows, the model of the start.

    Patterns of votes are counted first: at most 3 to the number of rules, so
    every round reads a small table.  Abstaining is a vote of its own.
    """
    good, rates = FIRST_GOOD, [(FIRST_ON_GOOD, FIRST_ON_BAD)] * len(RULES)
    patterns = stored(described.groupBy("votes").agg(F.count(F.lit(1)).cast("double").alias("n")).coalesce(1), "vote-patterns")
    for _ in range(rounds):
        posterior = _model(good, rates).posterior(F.col("votes"))
        single = patterns.select(F.posexplode("votes").alias("rule", "vote"), "n", (F.col("n") * posterior).alias("g"))
        sums = {(r["rule"], r["vote"]): (r["n"], r["g"]) for r in single.groupBy("rule", "vote").agg(F.sum("n").alias("n"), F.sum("g").alias("g")).collect()}
        if not sums:
            break
        counts = [[sums.get((k, v), (0.0, 0.0)) for v in (-1, 0, 1)] for k in range(len(RULES))]
        n, g = (sum(c[i] for c in counts[0]) for i in (0, 1))
        before, smooth = rates, lambda part, whole: (part + PRIOR_VOTES) / (whole + 3 * PRIOR_VOTES)
        rates = [(tuple(smooth(c[1], g) for c in rule), tuple(smooth(c[0] - c[1], n - g) for c in rule)) for rule in counts]
        good = (g + PRIOR_VOTES) / (n + 2 * PRIOR_VOTES)
        if max(abs(x - y) for a, b in zip(before, rates, strict=True) for c, d in zip(a, b, strict=True) for x, y in zip(c, d, strict=True)) < STILL:
            break
    return _model(good, rates)


def base_failed() -> Column:
    """The rule that no vote can outweigh."""
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def judge(docs: DataFrame, keep: list[str], limit: float = 0.5) -> DataFrame:
    """Every document: ``keep`` columns, counts, base_failed, quality (posterior) and kept.

    Documents are described once, into a stored table that the model is applied
    to, and fitted on where the base rule leaves the verdict to it.  Repeated rows are judged alike, each for itself.
    """
    table = stored(described(docs, keep), "described", "zstd")
    quality = fit(table.filter(~base_failed())).posterior(F.col("votes"))
    rows = table.withColumns({"base_failed": base_failed(), "quality": quality})
    return rows.select(
        *[F.col(f"kept_{i}").alias(c) for i, c in enumerate(keep)], *COUNTS, "base_failed",
        (~F.col("base_failed") & (F.col("quality") >= limit)).alias("kept"), "quality",
    )


def good_documents(docs: DataFrame) -> DataFrame:
    """The documents that are kept, with all their columns as they were."""
    place = [f"c{i}" for i in range(len(docs.columns))]
    verdicts = judge(docs.toDF(*place).withColumn("text", F.col(place[docs.columns.index("text")])), place)
    return verdicts.filter("kept").select(*[F.col(p).alias(c) for p, c in zip(place, docs.columns, strict=True)])
