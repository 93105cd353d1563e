"""Quality rules as weak supervision: rules vote or abstain, EM weighs them.

Each rule looks at one measure of a text and votes good (1), bad (-1) or abstains
(0). Votes are taken as independent given the unknown quality; expectation-
maximisation estimates the share of good texts and, per rule, how often it
votes each way on good and on bad texts, from all texts' vote patterns. A
text is kept if its posterior probability of being good is ``KEEP`` or more.

Everything is DataFrame functions: one pass measures the texts and writes the
measures (no texts) into the shared folder; patterns are counted there (at most
3 to the number of rules); each round of EM is one aggregation of the
pattern table, of which one row of sums comes back. The posterior is an expression
with the estimates as constants, so the texts' rows are not shuffled.

Words are what white space (space, 9 to 13) separates. Repeated windows are found
per text by sorting its windows, so a long text takes n log n.

Defined cases: a null or empty text has no words and fails the base rules; without any text
that passes them the estimates are those of the start; repeated rows are judged one by one; an empty
table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesprep.llm.shared import stage

#: Base rules: fewest words, and most words in repeated windows in percent.
LEAST_WORDS = 50
MOST_REPEATED = 50
KEEP = 0.5
ROUNDS = 40
#: Weight of the start in the estimates, as a share of the texts: rules are taken to be better than chance.
TRUST = 0.01
SPACE = r"[\\x20\\x09-\\x0D]"
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
DIGITS = "0123456789"
SYMBOLS = "#*$%&|<>"
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

#: Name, measure (SQL over the measured columns), good where, bad where. Elsewhere the rule abstains.
RULES = (
    ("word_length", "word_chars / n_words", "x BETWEEN 3 AND 9", "x < 2.5 OR x > 12"),
    ("symbols", "n_symbols / n_words", "x < 0.02", "x > 0.1"),
    ("symbol_words", "n_symbol_words / n_words", "x < 0.05", "x > 0.2"),
    ("marks", "n_marks / n_words", "x < 0.35", "x > 0.5"),
    ("dup_lines", "n_dup_lines / n_lines", "x = 0", "x > 0.3"),
    ("repeats", "n_repeat_words / n_words", "x < 0.05", "x > 0.2"),
    ("variety", "n_distinct / n_words", "x > 0.4", "x < 0.25 AND n_words < 400"),
    ("capitals", "n_capitals / word_chars", "x < 0.15", "x > 0.3"),
    ("digits", "n_digits / word_chars", "x < 0.1", "x > 0.25"),
    ("exclamations", "n_exclamations / n_words", "x < 0.05", "x > 0.3"),
    ("sentences", "n_stops / n_lines", "x >= 0.7", "x < 0.3"),
)
NAMES = tuple(r[0] for r in RULES)
VOTES = (-1, 0, 1)


@dataclass(frozen=True)
class Estimates:
    """Share of good texts; per rule the probabilities of votes -1, 0, 1 on bad and on good texts."""

    prior: float
    bad: tuple[tuple[float, float, float], ...]
    good: tuple[tuple[float, float, float], ...]


START = Estimates(0.8, ((0.4, 0.2, 0.4),) * len(RULES), ((0.05, 0.15, 0.8),) * len(RULES))


def less(text: str, characters: str) -> Column:
    """Number of a text's characters that are among ``characters``."""
    return F.length(text) - F.length(F.translate(text, characters, ""))


def repeated_words(words: str) -> Column:
    """Words inside 3-word windows that occur twice or more.

    Hashes of the windows come first: where none occurs twice there is no repetition.
    Else the windows are sorted with their places, and equal neighbours are kept. The
    one-element ``transform``s bind a value to a name, so that it is worked out once.
    """
    return F.expr(f"""
    CASE WHEN size({words}) < 4 THEN 0L ELSE transform(array({words}), w ->
      CASE WHEN size(array_distinct(transform(sequence(0, size(w) - 3), i -> xxhash64(w[i], w[i + 1], w[i + 2])))) = size(w) - 2 THEN 0L
      ELSE transform(array(sort_array(transform(sequence(0, size(w) - 3), i -> struct(concat_ws(' ', w[i], w[i + 1], w[i + 2]) AS g, i AS i)))), s ->
        CAST(size(array_distinct(flatten(transform(
          filter(s, (x, k) -> x.g <=> get(s, k - 1).g OR x.g <=> get(s, k + 1).g),
          x -> array(x.i, x.i + 1, x.i + 2))))) AS BIGINT))[0]
      END)[0] END""")


def measures(docs: DataFrame, keep: Sequence[str], text: str) -> DataFrame:
    """``keep`` columns (as k0, k1, ..) and the measures of each text."""
    names = [f"k{i}" for i in range(len(keep))]
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names, strict=True)], F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"))
    rows = rows.select(
        *names,
        "t",
        F.expr(f"array_remove(split(t, '{SPACE}+'), '')").alias("w"),
        F.expr(f"filter(split(t, '\\n'), x -> x RLIKE '[^\\\\x20\\\\x09-\\\\x0D]')").alias("lines"),
    )
    counted = rows.select(
        *names,
        F.size("w").cast("long").alias("n_words"),
        F.coalesce(F.length(F.concat_ws("", "w")), F.lit(0)).cast("long").alias("word_chars"),
        less("t", SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words("w").alias("n_repeat_words"),
        F.size("lines").alias("n_lines"),
        F.size(F.array_distinct("w")).alias("n_distinct"),
        less("t", LETTERS).alias("n_capitals"),
        less("t", DIGITS).alias("n_digits"),
        less("t", "!").alias("n_exclamations"),
        less("t", MARKS).alias("n_marks"),
        F.regexp_count("t", F.lit(r"[#*$%&|<>](?=[\x20\x09-\x0D]|\z)")).alias("n_symbol_words"),
        F.expr(f"""size(filter(lines, x -> x RLIKE '[.!?…。]["\\'”’)»]?{SPACE}*$'))""").alias("n_stops"),
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    votes = [F.when(F.col("n_words") == 0, 0).when(F.expr(good.replace("x", f"({x})")), 1).when(F.expr(bad.replace("x", f"({x})")), -1).otherwise(0).cast("byte").alias(name) for name, x, good, bad in RULES]
    return counted.select(*names, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), *votes)


def posterior(e: Estimates) -> Column:
    """Probability of good quality of a row of votes."""
    logit = F.lit(math.log(e.prior / (1 - e.prior)))
    for name, good, bad in zip(NAMES, e.good, e.bad, strict=True):
        ratios = [math.log(g / b) for g, b in zip(good, bad, strict=True)]
        logit = logit + F.when(F.col(name) == -1, ratios[0]).when(F.col(name) == 0, ratios[1]).otherwise(ratios[2])
    return 1 / (1 + F.exp(-logit))


def estimate(patterns: DataFrame, rounds: int = ROUNDS) -> Estimates:
    """EM over vote patterns (columns of the rules, and n)."""
    e = START
    for _ in range(rounds):
        weighed = patterns.withColumn("p", F.col("n") * posterior(e)).withColumn("q", F.col("n") - F.col("p"))
        sums = [F.sum(F.when(F.col(name) == v, F.col(side)).otherwise(0.0)).alias(f"{name}_{side}_{v}") for name in NAMES for side in "pq" for v in VOTES]
        row = weighed.agg(F.sum("p").alias("p"), F.sum("q").alias("q"), *sums).first()
        if row["p"] is None:
            return e

        trust = TRUST * (row["p"] + row["q"])

        def shares(side: str, start: tuple[tuple[float, float, float], ...]) -> tuple[tuple[float, float, float], ...]:
            return tuple(tuple((row[f"{name}_{side}_{v}"] + trust * s) / (row[side] + trust) for v, s in zip(VOTES, rule, strict=True)) for name, rule in zip(NAMES, start, strict=True))

        after = Estimates((row["p"] + trust * START.prior) / (row["p"] + row["q"] + trust), shares("q", START.bad), shares("p", START.good))
        moved = max(abs(a - b) for x, y in zip(e.bad + e.good, after.bad + after.good, strict=True) for a, b in zip(x, y, strict=True))
        e = after
        if moved < 1e-5:
            break
    return e


def judge(docs: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` columns, the base measures, base_failed, the posterior and kept of each row."""
    measured = stage(measures(docs, keep, text), "rules-measured")
    patterns = stage(measured.where("NOT base_failed").groupBy(*NAMES).agg(F.count("*").alias("n")), "rules-patterns")
    p = posterior(estimate(patterns))
    return measured.select(
        *[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)],
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        p.alias("posterior"),
        (~F.col("base_failed") & (p >= KEEP)).alias("kept"),
    )
