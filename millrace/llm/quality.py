"""Weak supervision of quality: rules vote or abstain, expectation-maximisation weighs them."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.text import SPACE_RUN, stored, words

SYMBOLS = "#*$%&|<>"
# Frequent function words of the languages of the corpus.
FUNCTION_WORDS = (
    "the of and to in a is that for it as was with be by on not he are this from at or an have "
    "la le les des et en un une du que qui dans pour pas sur est au avec "
    "der die und das den von zu mit sich dem nicht ein eine ist im auf für "
    "el los las del que se por con no una su para es al lo como de y"
).split()
FEW_WORDS, REPEATED_PERCENT = 50, 50
SORT_FROM = 32  # repeated windows from which positions come from one sort; both ways give the same count


def _without(text: Column, characters: str) -> Column:
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def _repeated_positions(hashes: Column, repeated: Column) -> Column:
    return F.filter(
        F.transform(hashes, lambda h, i: F.when(F.array_contains(repeated, h), i)), lambda p: p.isNotNull()
    )


def _sorted_positions(pairs: Column) -> Column:
    same = F.transform(
        pairs,
        lambda p, i: F.when((p["h"] == F.get(pairs, i - 1)["h"]) | (p["h"] == F.get(pairs, i + 1)["h"]), p["i"]),
    )
    return F.array_sort(F.filter(same, lambda p: p.isNotNull()))


def base_counts(docs: DataFrame) -> DataFrame:
    """One row per document with counts over its whole text; ``docs`` needs ``doc_id`` and ``text``.

    Null and empty texts count zero everywhere. Three-word windows are compared by 64-bit hash,
    within a document only. All columns of ``docs`` are kept in ``row``.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    step = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", text.alias("text"))
    step = step.withColumn("words", words(F.col("text")))
    n = F.size("words")
    step = step.withColumn(
        "hashes",
        F.when(n >= 3, F.transform(
            F.slice("words", 1, F.greatest(n - 2, F.lit(0))),
            lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2)),
        )).otherwise(F.array().cast("array<bigint>")),
    )
    step = step.withColumn("ordered", F.sort_array("hashes"))
    step = step.withColumn(
        "repeated",
        F.array_distinct(F.filter("ordered", lambda h, i: F.coalesce(h == F.get("ordered", i + 1), F.lit(False)))),
    )
    step = step.withColumn(
        "pairs",
        F.when(F.size("repeated") > SORT_FROM, F.sort_array(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))),
    )
    step = step.withColumn(
        "positions",
        F.when(F.size("repeated") == 0, F.array().cast("array<int>"))
        .when(F.size("repeated") <= SORT_FROM, _repeated_positions(F.col("hashes"), F.col("repeated")))
        .otherwise(_sorted_positions(F.col("pairs"))),
    )
    covered = F.aggregate(
        F.transform("positions", lambda p, i: F.least(F.lit(3), F.coalesce(F.get("positions", i + 1) - p, F.lit(3)))),
        F.lit(0), lambda total, x: total + x,
    )
    lines = F.filter(F.split("text", "\n", -1), lambda line: line.rlike(f"[^{SPACE_RUN[1:-2]}]"))
    step = step.withColumn("lines", lines)
    counts = F.struct(
        n.cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(_without(F.col("text"), SYMBOLS))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.length("text") - F.length(_without(F.col("text"), "!"))).cast("long").alias("n_shouts"),
        F.length(F.regexp_replace("text", "[^\\p{Lu}]+", "")).cast("long").alias("n_upper"),
        F.size(F.filter("words", lambda w: w.isin(*sorted(set(FUNCTION_WORDS))))).cast("long").alias("n_function"),
    )
    # one generated row: what is built on the counts is not merged into how they are made, nor made again for a filter
    return step.select("row", "doc_id", F.explode(F.array(counts)).alias("counts")).select("row", "doc_id", "counts.*")


def failed_base(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < FEW_WORDS) | (100 * n_repeat_words > REPEATED_PERCENT * n_words)


@dataclass(frozen=True)
class Rule:
    """Votes 1 (good) or -1 (bad) by whole-number comparisons ``a * left <= b * right``; 0 abstains."""

    name: str
    good: str
    bad: str


RULES = (
    Rule("few_symbols", "20 * n_symbols <= n_words", "5 * n_symbols >= n_words"),
    Rule("plain_case", "5 * n_upper <= word_chars", "2 * n_upper >= word_chars"),
    Rule("calm", "50 * n_shouts <= n_words", "5 * n_shouts >= n_words"),
    Rule("few_repeated_lines", "n_dup_lines = 0", "4 * n_dup_lines >= n_lines AND n_dup_lines >= 2"),
    Rule("few_repeated_words", "10 * n_repeat_words <= n_words", "3 * n_repeat_words >= n_words"),
    Rule("function_words", "12 * n_function >= n_words", "50 * n_function <= n_words"),
    Rule("word_length", "word_chars >= 3 * n_words AND word_chars <= 8 * n_words", "word_chars <= n_words OR word_chars >= 12 * n_words"),
    Rule("enough_words", "n_words >= 100", "n_words < 20"),
)
ROUNDS, STOP = 200, 1e-9
VOTES = (-1, 0, 1)


def vote(rule: Rule) -> Column:
    return F.expr(f"CASE WHEN {rule.bad} THEN -1 WHEN {rule.good} THEN 1 ELSE 0 END")


def with_votes(counts: DataFrame, rules=RULES) -> DataFrame:
    return counts.withColumns({r.name: vote(r) for r in rules})


@dataclass(frozen=True)
class Model:
    """``prior`` of good; ``chance[rule][vote]`` = (given bad, given good), votes -1, 0 and 1."""

    prior: float
    chance: dict[str, dict[int, tuple[float, float]]]
    rounds: int = 0
    converged: bool = False

    def log_odds(self) -> Column:
        total = F.lit(math.log(self.prior) - math.log1p(-self.prior))
        for name, by_vote in self.chance.items():
            odds = F.lit(0.0)
            for value, (bad, good) in by_vote.items():
                odds = F.when(F.col(name) == value, F.lit(math.log(good) - math.log(bad))).otherwise(odds)
            total = total + odds
        return total

    def belief(self, votes: dict[str, int]) -> float:
        odds = math.log(self.prior) - math.log1p(-self.prior)
        for name, value in votes.items():
            bad, good = self.chance[name][value]
            odds += math.log(good) - math.log(bad)
        return 1 / (1 + math.exp(-max(-700.0, odds)))

    def posterior(self) -> Column:
        return 1 / (1 + F.exp(-self.log_odds()))


def fit(votes: DataFrame, rules=RULES, rounds: int = ROUNDS, stop: float = STOP) -> Model:
    """Estimate prior and vote chances by expectation-maximisation over all rows.

    Spark counts the rows by vote pattern: at most 3 to the number of rules, whatever the input.
    The rounds weigh those counts, so they see every row and cost nothing that grows. Counts get one
    pseudo-vote, so that no chance is zero. An empty table gives even odds.
    """
    names = [r.name for r in rules]
    rows = votes.groupBy(*names).agg(F.count(F.lit(1)).alias("weight")).orderBy(*names).collect()
    patterns = [(tuple(r[n] for n in names), float(r["weight"])) for r in rows]
    beliefs = []
    for pattern, _ in patterns:
        ayes, noes = pattern.count(1), pattern.count(-1)
        beliefs.append((ayes + 1) / (ayes + 3 * noes + 2))  # a vote against starts as three votes for
    model, last = None, None
    for step in range(rounds):
        total = sum(w for _, w in patterns)
        good = sum(w * b for (_, w), b in zip(patterns, beliefs))
        chance = {n: {} for n in names}
        for k, n in enumerate(names):
            for v in VOTES:
                seen = [(w, w * b) for (p, w), b in zip(patterns, beliefs) if p[k] == v]
                ayes = sum(x for _, x in seen)
                chance[n][v] = (
                    (sum(w for w, _ in seen) - ayes + 1) / (total - good + len(VOTES)),
                    (ayes + 1) / (good + len(VOTES)),
                )
        prior = (good + 1) / (total + 2)
        flat = [prior, *(p for n in names for v in VOTES for p in chance[n][v])]
        done = last is not None and max(abs(a - b) for a, b in zip(flat, last)) < stop
        model, last = Model(prior, chance, step + 1, done), flat
        if done:
            break
        beliefs = [model.belief(dict(zip(names, p))) for p, _ in patterns]
    return model


def judged(votes: DataFrame, model: Model) -> DataFrame:
    base = failed_base(F.col("n_words"), F.col("n_repeat_words"))
    return votes.withColumns({"posterior": model.posterior(), "base_failed": base}).withColumn(
        "kept", ~F.col("base_failed") & (F.col("posterior") >= 0.5)
    )


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_shouts", "n_upper", "n_function")


def score_documents(docs: DataFrame) -> DataFrame:
    """Counts, votes, posterior probability of good and verdict of every document.

    Null text: no words, so ``base_failed``. Rows with equal ids are judged each by its own text.
    """
    counts = stored(base_counts(docs.select("doc_id", "text")).select("doc_id", *COUNTS), "quality")
    votes = with_votes(counts)
    return judged(votes, fit(votes)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.round("posterior", 4).alias("posterior"),
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, columns unchanged, whose text is kept. Only counts are written in between."""
    model = fit(with_votes(base_counts(docs.select("doc_id", "text"))))
    rows = judged(with_votes(base_counts(docs)), model).where("kept")
    return rows.select(*[F.col("row")[c].alias(c) for c in docs.columns])
