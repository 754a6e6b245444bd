"""A toxicity classifier with a counterfactual penalty on identity terms.

Logistic regression over the words of a text and their beginnings (so that compounds and inflections of a word count).
Features are chosen by how strongly they go with the label in a bounded sample of labelled texts. For each labelled
sentence with an identity term, swapping that term for another one, or for a neutral word, should not change the score;
as the score is a sum over features, the change is a difference of sums of weights, and the fit penalises its square
once per sentence and swap.

Edge cases: null or empty texts have no words and get the score of the intercept; null labels teach nothing; without
labels, or with labels of one kind only, all scores are the smoothed share of that label (0.5 without any); labels that
repeat an id count each, documents that repeat one teach once, labels of other ids than the documents' teach nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episodica.llm.common import NO_LETTER, words_of
from episodica.session import Scratch

#: Names of groups, a parameter of the fit.
IDENTITY = tuple(
    "women men girls boys gay lesbian bisexual transgender straight muslim muslims christian christians jewish jews hindu "
    "buddhist atheist black white asian latino african european american immigrant immigrants refugee refugees disabled "
    "deaf blind elderly young frauen männer schwule muslime christen juden ausländer femmes hommes musulmans chrétiens "
    "juifs immigrés mujeres hombres musulmanes cristianos judíos inmigrantes".split()
)
SENTENCE = r"[.!?\n]+"
#: Bytes of the beginnings of words that are features.
PREFIXES = (4, 6, 8)


@dataclass(frozen=True)
class Fit:
    #: Labelled rows of each label that the fit sees at most.
    most_per_label: int = 4000
    features: int = 512
    #: A word needs this many labelled texts and this large a G statistic.
    least_texts: int = 3
    least_evidence: float = 25.0
    ridge: float = 0.0002
    #: Weight of the counterfactual penalty.
    balance: float = 1.0
    identity: tuple[str, ...] = IDENTITY
    seed: int = 5


@dataclass(frozen=True)
class Model:
    words: np.ndarray  # sorted hashes
    weights: np.ndarray
    intercept: float

    def scores(self, column: pa.Array) -> np.ndarray:
        """Probability of label 1 for every text."""
        out = np.full(len(column), self.intercept)
        near = np.zeros(1 << 16, bool)
        near[(self.words >> np.uint64(48)).astype(np.int64)] = True
        for row, hashes, counts in words_of(column, NO_LETTER, prefixes=PREFIXES):
            at = np.flatnonzero(near[(hashes >> np.uint64(48)).astype(np.int64)])
            place = np.searchsorted(self.words, hashes[at])
            place[place == len(self.words)] = 0
            hit = self.words[place] == hashes[at] if len(self.words) else np.zeros(0, bool)
            text = np.searchsorted(np.cumsum(counts), at[hit], "right")
            pairs = np.unique(text * len(self.words) + place[hit])
            out[row : row + len(counts)] += np.bincount(pairs // max(1, len(self.words)), self.weights[pairs % max(1, len(self.words))], len(counts))
        return 1 / (1 + np.exp(-np.clip(out, -500, 500)))


def hash_terms(words: tuple[str, ...]) -> np.ndarray:
    """Per word a row of its hash and those of its beginnings; a word that isn't one run of letters raises."""
    rows = [np.zeros((0, 1 + len(PREFIXES)), np.uint64)]
    for _, hashes, counts in words_of(pa.array(list(words), pa.string()), NO_LETTER, prefixes=PREFIXES):
        if (counts != 1 + len(PREFIXES)).any():
            raise ValueError("identity terms must be single words")
        rows.append(hashes.reshape(-1, 1 + len(PREFIXES)))
    return np.concatenate(rows)


def solve(x: np.ndarray, y: np.ndarray, weight: np.ndarray, terms: np.ndarray, times: np.ndarray, ridge: float, balance: float) -> tuple[np.ndarray, float]:
    """Weights and intercept by Newton's method. ``terms``: the features of each identity term; ``times``: the sentences
    that hold it. Each is swapped for every other term and for a neutral word, which has no features."""
    n, d = x.shape
    x = np.hstack([x, np.ones((n, 1))])
    penalty = np.zeros((d + 1, d + 1))
    swapped = np.vstack([terms, np.zeros((1, d))])
    for term, count in zip(terms, times):
        change = term - swapped
        penalty[:d, :d] += count * change.T @ change
    penalty *= balance / n
    penalty[np.arange(d), np.arange(d)] += ridge
    penalty[d, d] += 1e-6
    w, weight = np.zeros(d + 1), weight / weight.sum()
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + penalty @ w
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + penalty
        step = np.linalg.solve(curve, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w[:d], float(w[d])


def _labelled(docs: DataFrame, labels: DataFrame, scratch: Scratch, usable: Column, rule: Fit, id: str, text: str, label: str):
    """A bounded sample of labelled texts and the number of labels of each kind, both of labels whose id is in ``docs``."""
    known = labels.filter(usable).select(F.col(id).alias("id"), F.col(label).cast("int").alias("y")).filter("y in (0, 1) and id is not null")
    there = docs.select(F.col(id).alias("doc")).distinct()
    known = scratch.save(known.join(there, F.col("id") == F.col("doc"), "left_semi"), "toxicity-labels")
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    order = F.xxhash64(F.lit(rule.seed), "id")
    pick = lambda y: known.filter(F.col("y") == y).orderBy(order, "id").limit(rule.most_per_label)
    # At most twice most_per_label rows of an id and a label: a proven bound for a broadcast.
    sample = F.broadcast(pick(0).unionByName(pick(1)))
    texts = docs.select(F.col(id).alias("doc"), F.col(text).alias("text"))
    once = texts.join(F.broadcast(pick(0).unionByName(pick(1)).select(F.col("id").alias("doc")).distinct()), "doc", "left_semi").dropDuplicates(["doc"])
    return once.join(sample, F.col("doc") == F.col("id")).select("id", "y", "text"), counts


def _words_and_terms(sample: DataFrame, terms: np.ndarray) -> DataFrame:
    """Per labelled text its distinct words, and per identity term the number of its sentences that hold it."""
    ordered = np.sort(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column("text")
            words = [np.zeros(0, np.int64)] * len(text)
            for row, hashes, counts in words_of(text, NO_LETTER, prefixes=PREFIXES):
                for i, part in enumerate(np.split(hashes, np.cumsum(counts)[:-1])):
                    words[row + i] = np.unique(part).view(np.int64)
            held = []
            for found, whole in zip(words, text):
                in_text = found[np.isin(found.view(np.uint64), ordered)]
                sentences = []
                if len(in_text):
                    pieces = pc.split_pattern_regex(pa.array([whole.as_py()]), SENTENCE)[0].values
                    for _, hashes, counts in words_of(pieces, NO_LETTER):
                        for part in np.split(hashes, np.cumsum(counts)[:-1]):
                            part = np.unique(part)
                            sentences.extend(part[np.isin(part, ordered)].view(np.int64).tolist())
                held.append(sentences)
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(words, pa.list_(pa.int64())), pa.array(held, pa.list_(pa.int64()))], ["y", "words", "terms"])

    return sample.select("y", "text").mapInArrow(run, "y int, words array<long>, terms array<long>")


def fit(
    docs: DataFrame, labels: DataFrame, scratch: Scratch, usable: Column | None = None, rule: Fit = Fit(), id: str = "doc_id", text: str = "text", label: str = "toxic"
) -> Model:
    """Fit on up to ``most_per_label`` labelled texts of each label; ``usable`` is a condition on the labels' rows.

    What reaches the driver is bounded by the rule: the chosen words and, per sampled text, which of them it holds.
    """
    sample, counts = _labelled(docs, labels, scratch, F.lit(True) if usable is None else usable, rule, id, text, label)
    terms = np.unique(hash_terms(rule.identity), axis=0)
    saved = scratch.save(_words_and_terms(sample, terms[:, 0]), "toxicity-sample")
    seen = {r["y"]: r["n"] for r in saved.groupBy("y").agg(F.count("*").alias("n")).collect()}
    empty = Model(np.zeros(0, np.uint64), np.zeros(0), 0.0)
    ones, zeros = seen.get(1, 0), seen.get(0, 0)
    if not ones or not zeros:
        share = (ones + 1) / (ones + zeros + 2)
        return Model(empty.words, empty.weights, math.log(share / (1 - share)))

    a, n = F.col("a").cast("double"), F.col("n").cast("double")
    part = lambda got, expected: F.when(got > 0, got * F.log(got / expected)).otherwise(0.0)
    all_texts = float(ones + zeros)
    evidence = 2 * (
        part(a, n * ones / all_texts) + part(n - a, n * zeros / all_texts)
        + part(ones - a, (all_texts - n) * ones / all_texts) + part(zeros - n + a, (all_texts - n) * zeros / all_texts)
    )
    words = (
        saved.select("y", F.explode("words").alias("word")).groupBy("word").agg(F.sum("y").alias("a"), F.count("*").alias("n"))
        .filter(n >= rule.least_texts).withColumn("evidence", evidence).filter(F.col("evidence") >= rule.least_evidence)
        .orderBy(F.desc("evidence"), "word").limit(rule.features)
    )
    chosen = np.array([r["word"] for r in words.select("word").collect()], np.int64).view(np.uint64)
    chosen = np.union1d(chosen, terms[:, 0])
    wanted = chosen.view(np.int64).tolist()
    rows = saved.select("y", F.filter("words", lambda w: w.isin(wanted)).alias("words"), "terms").toPandas()

    x = np.zeros((len(rows), len(chosen)))
    for i, held in enumerate(rows["words"]):
        x[i, np.searchsorted(chosen, np.asarray(held, np.int64).view(np.uint64))] = 1
    y = rows["y"].to_numpy(float)
    weight = np.where(y == 1, counts[1] / ones, counts[0] / zeros)
    held = np.concatenate([np.asarray(t, np.int64) for t in rows["terms"]]).view(np.uint64)
    times = (held[None, :] == terms[:, :1]).sum(axis=1)
    has = np.array([np.isin(chosen, term) for term in terms], float).reshape(-1, len(chosen))
    weights, intercept = solve(x, y, weight, has, times, rule.ridge, rule.balance)
    return Model(chosen, weights, intercept)


def score(model: Model):
    """A column function: the model's score of a text column, for every row."""

    @F.arrow_udf("double")
    def toxicity(text: pa.Array) -> pa.Array:
        return pa.array(model.scores(text))

    return toxicity
