"""Mixing sources to target weights: how often each document is repeated so that every source meets its target.

A source's whole copies come first. The rest of its budget is a bounded subset-sum over the counts of documents by exact
length: a proportional share of every length, then a knapsack table over what is left, and within a length the
documents with the smallest seeded hash.

Edge cases: a null or empty text has size 0 and is never taken; a null source is a source of its own, the last one;
documents without an id tie in hash and any of them may be taken; a source without words has target 0; repeated rows
count each.
"""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from episodica.llm.common import WORD, unused
from episodica.session import Scratch

# Width of the knapsack table, in words.
TABLE = 1 << 16


@dataclass(frozen=True)
class Mix:
    weights: tuple[int, ...] = (5, 2, 1)
    budget: float = 1.5
    most: float = 2.0
    seed: int = 17
    #: Hash ranges that a group of equally long documents is split into before ranking.
    ranges: int = 4096


def targets(sizes: DataFrame, rule: Mix) -> DataFrame:
    """One row per source: source_size and target.

    Raising a common level fills sources in proportion to weight until each stops at its limit; that is where sharing
    the excess again and again ends. Only rows of one per source are ordered.
    """
    weights = F.array(*(F.lit(float(w)) for w in rule.weights))
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    by_limit = Window.orderBy("ratio", F.asc_nulls_last("source"))
    sources = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("weight", F.get(weights, (F.row_number().over(by_name) - 1) % len(rule.weights)))
        .withColumn("most", F.col("source_size") * F.lit(rule.most))
        .withColumn("ratio", F.col("most") / F.col("weight"))
        .withColumn("budget", F.sum("source_size").over(everything) * F.lit(rule.budget))
        .withColumn("before", F.sum("most").over(by_limit.rowsBetween(Window.unboundedPreceding, 0)) - F.col("most"))
        .withColumn("open", F.sum("weight").over(by_limit.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.col("budget") - F.col("before")) / F.col("open"))
    )
    level = F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).over(everything)
    share = F.least("most", F.coalesce(level * F.col("weight"), F.col("most")))
    return sources.select("source", "source_size", F.greatest(share, F.lit(0.0)).alias("target"))


def fit_counts(lengths: list[int], counts: list[int], budget: int) -> list[int]:
    """How many of each length to take so that the sum comes closest to ``budget`` from below.

    All lengths first give their proportional share, and a knapsack makes up the rest. Where that misses the budget, the
    shares give back an eighth, a half and all of it (at most TABLE words) to the knapsack; so for up to TABLE words the
    result is the best that any choice gives.
    """
    total = sum(n * c for n, c in zip(lengths, counts))
    budget = min(budget, total)
    if budget <= 0:
        return [0] * len(lengths)
    best, least = [], budget + 1
    for shared in (budget, budget - budget // 8, budget // 2, 0):
        shared = max(shared, budget - TABLE)
        taken = _fit(lengths, counts, budget, [c * shared // total for c in counts])
        missed = budget - sum(n * t for n, t in zip(lengths, taken))
        if missed < least:
            best, least = taken, missed
        if not missed:
            break
    return best


def _fit(lengths: list[int], counts: list[int], budget: int, taken: list[int]) -> list[int]:
    """``taken`` and what a bounded knapsack adds to it."""
    rest = budget - sum(n * t for n, t in zip(lengths, taken))
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    for i in order:  # down to the width of the table
        more = min(counts[i] - taken[i], max(0, (rest - TABLE) // lengths[i]))
        taken[i] += more
        rest -= more * lengths[i]
    # Bounded knapsack: bit s of `reach` says whether sum s can be made; each step adds a power-of-two bundle.
    reach, mask, steps = 1, (1 << (rest + 1)) - 1, []
    for i in order:
        free, bundle = min(counts[i] - taken[i], rest // lengths[i]), 1
        while free > 0 and not reach >> rest & 1:
            bundle = min(bundle, free)
            steps.append((i, bundle, reach))
            reach |= (reach << (bundle * lengths[i])) & mask
            free -= bundle
            bundle *= 2
    at = reach.bit_length() - 1
    for i, bundle, earlier in reversed(steps):
        if not earlier >> at & 1:
            taken[i] += bundle
            at -= bundle * lengths[i]
    return taken


def _fit_source(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("size")
    rows["extra"] = fit_counts(rows["size"].tolist(), rows["docs"].tolist(), int(rows["budget"].iloc[0]))
    return rows[["sid", "size", "extra"]]


def mix(docs: DataFrame, scratch: Scratch, rule: Mix = Mix(), id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """doc_id, source, size, source_size, target, repeats (0 up to ``most``), one row per document.

    Texts are read once, for their sizes. The fit of a source sees one row per distinct length: at most about the root
    of twice its words. Ranking splits equally long documents by hash range, so a group of any size spreads.
    """
    sizes = scratch.save(
        docs.select(
            F.col(id).alias("doc_id"),
            F.col(source).alias("source"),
            F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        ),
        "mix-sizes",
    )
    per_source = scratch.save(
        targets(sizes, rule)
        .withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long"))
        .withColumn("budget", F.round(F.col("target") - F.col("whole") * F.col("source_size")).cast("long"))
        .withColumn("sid", F.row_number().over(Window.orderBy(F.asc_nulls_last("source")))),
        "mix-sources",
    )
    named = sizes.withColumnRenamed("source", "of").join(per_source, F.col("of").eqNullSafe(F.col("source")))
    named = named.drop("of")
    lengths = (
        sizes.groupBy("source", "size").agg(F.count("*").alias("docs")).withColumnRenamed("source", "of")
        .join(per_source, F.col("of").eqNullSafe(F.col("source"))).filter((F.col("size") > 0) & (F.col("budget") > 0))
    )
    fitted = lengths.select("sid", "size", "docs", "budget").groupBy("sid").applyInPandas(_fit_source, "sid int, size long, extra long")
    ranged = named.withColumn("h", F.xxhash64(F.lit(rule.seed), "doc_id")).withColumn("part", F.pmod("h", F.lit(rule.ranges)))
    parts = (
        ranged.groupBy("sid", "size", "part").agg(F.count("*").alias("n"))
        .withColumn("earlier", F.sum("n").over(Window.partitionBy("sid", "size").orderBy("part")) - F.col("n"))
        .join(fitted.filter("extra > 0"), ["sid", "size"])
        .select("sid", "size", "part", (F.col("extra") - F.col("earlier")).alias("left"))
        .filter("left > 0")
    )
    ranked = ranged.join(parts, ["sid", "size", "part"], "left").withColumn(
        "rank", F.row_number().over(Window.partitionBy("sid", "size", "part").orderBy("h", "doc_id"))
    )
    extra = F.when(F.col("rank") <= F.coalesce("left", F.lit(0)), F.lit(1)).otherwise(F.lit(0))
    repeats = F.when(F.col("size") > 0, F.col("whole") + extra).otherwise(F.lit(0)).cast("long")
    return ranked.select("doc_id", "source", "size", "source_size", "target", repeats.alias("repeats"))


def apply(docs: DataFrame, scratch: Scratch, rule: Mix = Mix(), id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mix itself: each row of ``docs`` as often as mix() says, columns as they are.

    Rows that agree in id, source and size are interchangeable in mix(); together they are repeated as often as it counts.
    Where it takes one more copy of some of them only, they are numbered, and the first ones get it.
    """
    mixed = mix(docs, scratch, rule, id, text, source)
    own_id, own_source, own_size, times_, more_, words, copy = (unused(docs, f"mix_{n}") for n in ("id", "source", "size", "times", "more", "words", "copy"))
    least = F.min("repeats")
    times = scratch.save(
        mixed.groupBy(F.col("doc_id").alias(own_id), F.col("source").alias(own_source), F.col("size").alias(own_size))
        .agg(least.alias(times_), (F.sum("repeats") - least * F.count("*")).alias(more_)).filter((F.col(times_) > 0) | (F.col(more_) > 0)),
        "mix-times",
    )
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    same = F.col(id).eqNullSafe(F.col(own_id)) & F.col(source).eqNullSafe(F.col(own_source)) & (F.col(words) == F.col(own_size))
    sized = docs.withColumn(words, size)
    repeated = sized.join(times.filter(F.col(more_) == 0), same).select(*docs.columns, times_)
    uneven = times.filter(F.col(more_) > 0)
    if not uneven.isEmpty():  # at most one id of each source and size, and only if it is null or repeated
        number = F.row_number().over(Window.partitionBy(own_id, own_source, own_size).orderBy(F.xxhash64(text)))
        some = sized.join(uneven, same).withColumn(times_, F.col(times_) + F.when(number <= F.col(more_), 1).otherwise(0)).filter(F.col(times_) > 0)
        repeated = repeated.unionByName(some.select(*docs.columns, times_))
    return repeated.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(times_).cast("int")))).select(*docs.columns)
