"""Quality rules combined by weak supervision; DataFrame functions only.

Each rule votes good (1), bad (-1) or abstains (0). Expectation-maximisation over the counts of vote patterns (at most
3 to the number of rules, whatever the input) estimates how each rule votes on good and on bad documents; the posterior
probability of being good replaces "all rules must pass".

Edge cases: null text counts as empty; an empty text has counts of 0 and all rules abstain, so its posterior is the
share of good documents; repeated rows count each; an empty table keeps the starting values.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episodica.llm.common import GAP, let
from episodica.session import Scratch

WINDOW = 8
SYMBOLS = "#*$%&|<>"
RULES = ("symbols", "capitals", "word_length", "lines", "repeats", "plain")
FEATURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_capitals")


def _repeat_words(hashes: Column) -> Column:
    """Words in windows of WINDOW words that are found twice or more: equal window hashes are neighbours once sorted."""
    windows = F.transform(
        F.sequence(F.lit(0), F.size(hashes) - WINDOW), lambda i: F.xxhash64(*(F.get(hashes, i + k) for k in range(WINDOW)))
    )

    def covered(sorted_windows: Column) -> Column:
        again = F.filter(
            sorted_windows,
            lambda w, i: (F.get(sorted_windows, i - 1)["hash"] == w["hash"]) | (F.get(sorted_windows, i + 1)["hash"] == w["hash"]),
        )
        again = F.filter(again, lambda w: w.isNotNull())
        reach = lambda at: F.transform(at, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - p, F.lit(WINDOW))))
        return let(
            F.sort_array(F.transform(again, lambda w: w["at"])),
            lambda at: F.aggregate(reach(at), F.lit(0), lambda n, x: n + x),
        )

    def count(found: Column) -> Column:
        placed = F.sort_array(F.transform(found, lambda w, i: F.struct(w.alias("hash"), i.alias("at"))))
        return F.when(F.size(F.array_distinct(found)) == F.size(found), F.lit(0)).otherwise(let(placed, covered))

    return F.when(F.size(hashes) < WINDOW, F.lit(0)).otherwise(let(windows, count))


def features(text: Column) -> Column:
    """A struct of FEATURES (long) of the whole text."""
    text = F.coalesce(text, F.lit(""))
    blank = " \t\n\x0b\x0c\r"
    has_word = lambda line: ~F.substring(line, 1, 1).isin("", *blank) | (F.length(F.btrim(line, F.lit(blank))) > 0)
    lines = F.filter(F.split(text, "\n"), has_word)
    any_symbol = F.lit(False)
    for symbol in SYMBOLS:
        any_symbol = any_symbol | F.contains(text, F.lit(symbol))
    words = F.filter(F.split(text, GAP), lambda w: w != "")
    of_words = lambda ws: F.struct(
        F.size(ws).cast("long").alias("n_words"),
        F.length(F.array_join(ws, "")).cast("long").alias("word_chars"),
        F.size(F.filter(ws, lambda w: (w == F.upper(w)) & (w != F.lower(w)))).cast("long").alias("n_capitals"),
        let(F.transform(ws, lambda w: F.xxhash64(w)), _repeat_words).cast("long").alias("n_repeat_words"),
    )
    of_lines = lambda ls: F.struct(
        F.size(ls).cast("long").alias("n_lines"), (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines")
    )
    both = F.struct(let(words, of_words).alias("w"), let(lines, of_lines).alias("l"))
    return let(
        both,
        lambda b: F.struct(
            b["w"]["n_words"].alias("n_words"),
            b["w"]["word_chars"].alias("word_chars"),
            F.when(any_symbol, F.regexp_count(text, F.lit(f"[{SYMBOLS}]"))).otherwise(0).cast("long").alias("n_symbols"),
            b["l"]["n_lines"].alias("n_lines"),
            b["l"]["n_dup_lines"].alias("n_dup_lines"),
            b["w"]["n_repeat_words"].alias("n_repeat_words"),
            b["w"]["n_capitals"].alias("n_capitals"),
        ),
    )


def votes(f: Column) -> list[Column]:
    """One vote per rule from a features struct.

    All rules but the last vote bad or abstain. The last votes good on documents that are far from every limit; without
    it, one frequent kind of bad document would be a class to itself and all the other kinds count as good.
    """
    n, chars = f["n_words"], f["word_chars"]
    bad = [
        f["n_symbols"] * 10 > n,
        f["n_capitals"] * 5 > n * 2,
        (chars < n * 2) | (chars > n * 14),
        (f["n_dup_lines"] > 2) & (f["n_dup_lines"] * 10 > f["n_lines"] * 3),
        f["n_repeat_words"] * 4 > n,
    ]
    far = (
        (f["n_symbols"] * 20 <= n) & (f["n_capitals"] * 10 <= n * 3) & (chars >= n * 2.5) & (chars <= n * 12)
        & ~bad[3] & ~bad[4]
    )
    return [F.when((n > 0) & b, -1).otherwise(0) for b in bad] + [F.when((n > 0) & far, 1).otherwise(0)]


@dataclass(frozen=True)
class Supervision:
    """What the rules have been found to do: prior of good, and per rule and class the chance of each vote."""

    prior: float
    chances: tuple[tuple[dict[int, float], dict[int, float]], ...]  # per rule: on bad, on good documents

    def log_odds(self, ballots: list[Column]) -> Column:
        odds = F.lit(math.log(self.prior / (1 - self.prior)))
        for ballot, (bad, good) in zip(ballots, self.chances):
            weight = {v: math.log(good[v] / bad[v]) for v in (-1, 0, 1)}
            odds = odds + F.when(ballot == 1, weight[1]).when(ballot == -1, weight[-1]).otherwise(weight[0])
        return odds

    def posterior(self, ballots: list[Column]) -> Column:
        return 1 / (1 + F.exp(-self.log_odds(ballots)))


# Before any data: a rule that votes bad is right more often than not, most documents are good.
_BAD_OR_NOT = ({-1: 0.3, 0: 0.69, 1: 0.01}, {-1: 0.01, 0: 0.98, 1: 0.01})
_GOOD_OR_NOT = ({-1: 0.01, 0: 0.89, 1: 0.1}, {-1: 0.01, 0: 0.09, 1: 0.9})
START = Supervision(0.8, (_BAD_OR_NOT,) * (len(RULES) - 1) + (_GOOD_OR_NOT,))


def learn(ballots: DataFrame, scratch: Scratch, rounds: int = 12, start: Supervision = START) -> Supervision:
    """Expectation-maximisation over the counts of vote patterns in columns RULES.

    Each round is one aggregate over the small table of patterns that returns one row. ``start`` counts as 20 documents
    and 2 percent of the table; a rule that would vote bad more often on good documents than on bad ones says nothing.
    """
    patterns = scratch.save(ballots.groupBy(*RULES).agg(F.count("*").alias("docs")).coalesce(1), "quality-patterns")
    now = start
    for _ in range(rounds):
        weighed = patterns.withColumn("good", now.posterior([F.col(r) for r in RULES]) * F.col("docs")).withColumn(
            "bad", F.col("docs") - F.col("good")
        )
        sums = [F.sum(F.when(F.col(r) == v, F.col(c)).otherwise(0.0)).alias(f"{c}_{r}_{v + 1}") for r in RULES for v in (-1, 0, 1) for c in ("bad", "good")]
        row = weighed.agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"), *sums).first()
        if row["good"] is None:
            return start
        weight = 20 + 0.02 * (row["good"] + row["bad"])
        prior = (row["good"] + weight * start.prior) / (row["good"] + row["bad"] + weight)
        chances = []
        for r, believed in zip(RULES, start.chances):
            per_class = [{v: (row[f"{c}_{r}_{v + 1}"] + weight * p[v]) / (row[c] + weight) for v in (-1, 0, 1)} for c, p in zip(("bad", "good"), believed)]
            if per_class[0][-1] < per_class[1][-1] or per_class[0][1] > per_class[1][1]:
                per_class = [believed[0], believed[0]]
            chances.append(tuple(per_class))
        now = Supervision(prior, tuple(chances))
    return now


def base_failed(f: Column) -> Column:
    """Fewer than 20 words, or over 30 percent of them in repeated windows."""
    return (f["n_words"] < 20) | (100 * f["n_repeat_words"] > 30 * f["n_words"])


def judge(docs: DataFrame, scratch: Scratch, id: str = "doc_id", text: str = "text", threshold: float = 0.5) -> DataFrame:
    """doc_id, the features, the votes, base_failed, posterior (of being good) and kept, one row per document.

    The texts are read once; what they come down to is written, then counted, then judged.
    """
    measured = docs.select(F.col(id).alias("doc_id"), features(F.col(text)).alias("f"))
    saved = scratch.save(measured, "quality-features")
    saved = saved.select("*", *(v.cast("int").alias(r) for v, r in zip(votes(F.col("f")), RULES)))
    found = learn(saved, scratch)
    failed = base_failed(F.col("f"))
    posterior = found.posterior([F.col(r) for r in RULES])
    return saved.select(
        "doc_id", "f.*", *RULES, failed.alias("base_failed"), posterior.alias("posterior"),
        (~failed & (posterior >= threshold)).alias("kept"),
    )


def keep(docs: DataFrame, scratch: Scratch, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that judge() keeps, all columns as they are.

    The verdict is computed beside the row itself, so repeated or missing ids and columns of any name do no harm; the
    votes are counted in a first pass over the texts.
    """
    measured = docs.select(features(F.col(text)).alias("f"))
    saved = scratch.save(measured, "quality-features")
    found = learn(saved.select(*(v.cast("int").alias(r) for v, r in zip(votes(F.col("f")), RULES))), scratch)
    verdict = lambda f: ~base_failed(f) & (found.posterior(votes(f)) >= threshold)
    return docs.filter(let(features(F.col(text)), verdict))
