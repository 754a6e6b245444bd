"""Exact top-k inner products over integer vectors, by segment statistics from coarse to fine.

A vector is cut into segments; a segment is described by its mean and by the length of its deviations from that mean.
By Cauchy-Schwarz, the sum over segments of (length x mean x mean + deviation x deviation) is never below the inner
product, so |q|^2 + |x|^2 minus twice that sum is never above the squared distance. Bounds tighten from one segment to
four, sixteen and thirty-two; only pairs whose bound still reaches a query's k-th best score are computed exactly. Every
query first meets one block of candidates, and the k-th best score found there is its floor in all blocks. Where a level
drops hardly any pair, no finer one is tried, as its bounds would cost as much as the scores.

Edge cases: vectors that are null, empty or hold null or non-finite components take no part, nor do rows without an id;
shorter vectors count as padded with zeros; ties go to the smaller id; a query's own id is left out; a query with fewer
candidates than k returns them all; repeated rows are candidates each, but one query; scores beyond a long stop at its
limits.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEVELS = (1, 4, 16, 32)
#: A level beyond the second that drops less than this share of the pairs left is the last.
LEAST = 1 / 16
#: Queries whose bounds are held at a time.
ROWS = 128
FOUND = "query long, qkey long, id long, score long"


@dataclass(frozen=True)
class Search:
    k: int = 20
    scale: float = 64.0
    query_block: int = 1024
    candidate_block: int = 8192


def quantise(vector: Column, scale: float) -> Column:
    """Each component x as floor(scale * x); null if one is null or not finite."""
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < math.inf), F.lit(False)))
    return F.when(finite & (F.size(vector) > 0), F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long")))


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    if all(len(v) == width for v in vectors):
        return np.stack(vectors.to_numpy())
    out = np.zeros((len(vectors), width), np.int64)
    for row, v in zip(out, vectors):
        row[: len(v)] = v
    return out


def _statistics(x: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Means times the root of the segment's length, and lengths of the deviations."""
    parts = x.reshape(len(x), segments, -1)
    mean = parts.mean(axis=2)
    return mean * math.sqrt(parts.shape[2]), np.sqrt(((parts - mean[:, :, None]) ** 2).sum(axis=2))


def best_pairs(
    queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int, floor: np.ndarray | None = None, left: list[int] | None = None
):
    """Row indices and exact scores of each query's best k in this block; ``ids`` ascend, ties go to the smaller.

    Scores below a query's ``floor`` aren't wanted. ``left`` gets the number of pairs that are left after each level.
    """
    width = queries.shape[1]
    peak = lambda m: max(abs(int(m.min())), abs(int(m.max())))
    exact = peak(queries) * peak(vectors) * width < 1 << 53
    own = query_ids[:, None] == ids[None, :]
    if not exact:  # beyond what doubles hold exactly: plain integers, no bounds
        scores = queries.astype(object) @ vectors.T.astype(object)
        limit = (1 << 63) - 1
        at_q, at_x = np.nonzero(~own)
        found = np.array([max(-limit - 1, min(limit, int(s))) for s in scores[at_q, at_x]], np.int64)
    else:
        q, x = queries.astype(np.float64), vectors.astype(np.float64)
        floor = np.full(len(q), -np.inf) if floor is None else floor
        alive = ~own
        for segments in LEVELS:
            before = np.count_nonzero(alive)
            (q_mean, q_dev), (x_mean, x_dev) = _statistics(q, segments), _statistics(x, segments)
            bound = np.hstack([q_mean, q_dev]) @ np.hstack([x_mean, x_dev]).T
            bound += 1e-9 * np.abs(bound).max() + 1e-6
            alive &= bound >= floor[:, None]
            if len(x) > k:
                # The k candidates with the highest bounds raise each query's k-th best score so far.
                bound[~alive] = -np.inf
                first = np.argpartition(bound, len(x) - k, axis=1)[:, len(x) - k :]
                usable = np.take_along_axis(alive, first, 1).all(axis=1)
                reached = np.einsum("qd,qkd->qk", q, x[first]).min(axis=1)
                floor = np.where(usable, np.maximum(floor, reached), floor)
                alive &= bound >= floor[:, None]
            now = np.count_nonzero(alive)
            if left is not None:
                left.append(now)
            if segments >= LEVELS[1] and before - now < LEAST * before:
                break
        if np.count_nonzero(alive) > alive.size // 8:  # bounds that hardly tell: one product for all, then the k-th best
            exact_scores = q @ x.T
            exact_scores[~alive] = -np.inf
            if len(x) > k:
                alive &= exact_scores >= np.partition(exact_scores, len(x) - k, axis=1)[:, len(x) - k, None]
            at_q, at_x = np.nonzero(alive)
            found = exact_scores[at_q, at_x]
        else:
            at_q, at_x = np.nonzero(alive)
            found = np.concatenate([np.einsum("nd,nd->n", q[at_q[i : i + 65536]], x[at_x[i : i + 65536]]) for i in range(0, len(at_q), 65536)] or [np.zeros(0)])
        found = np.rint(found).astype(np.int64)
    order = np.lexsort((at_x, ~found, at_q))
    at_q, at_x, found = at_q[order], at_x[order], found[order]
    rank = np.arange(len(at_q)) - np.searchsorted(at_q, at_q)
    keep = rank < k
    return at_q[keep], at_x[keep], found[keep]


def search(vectors: DataFrame, is_query: Column, rule: Search = Search(), id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k best candidates of every query.

    Queries and candidates are dealt to blocks by hash; every pair of blocks meets in one task of bounded size, which
    returns at most k rows per query. A block of queries first meets one block of candidates alone, for their floors. ``is_query`` is a condition on the columns of ``vectors``.
    """
    rows = vectors.select(F.col(id).alias("id"), quantise(F.col(vector), rule.scale).alias("v"), is_query.alias("asks"))
    rows = rows.filter("id is not null and v is not null")
    counts = rows.agg(F.count("*").alias("all"), F.count_if("asks").alias("asks")).first()
    q_blocks, x_blocks = (max(1, math.ceil(n / size)) for n, size in ((counts["asks"], rule.query_block), (counts["all"], rule.candidate_block)))
    keyed = rows.withColumn("qkey", F.xxhash64("id", "v"))
    deal = lambda n: F.pmod(F.xxhash64(F.lit(7), "id"), F.lit(n)).cast("int")
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    queries = keyed.filter("asks").dropDuplicates(["id", "v"]).select("id", "qkey", "v", deal(q_blocks).alias("qb"), spread(x_blocks).alias("xb"))
    others = keyed.select(F.col("id").alias("of"), F.col("v").alias("offered"), deal(x_blocks).alias("xb"), spread(q_blocks).alias("qb"))

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"query": [], "qkey": [], "id": [], "score": []}).astype("int64")
        right = right.sort_values("of", kind="stable")
        width = max(left["v"].map(len).max(), right["offered"].map(len).max())
        width = -(-width // LEVELS[-1]) * LEVELS[-1]
        ids = right["of"].to_numpy(np.int64)
        asked, floor = left["id"].to_numpy(np.int64), left["floor"].to_numpy(np.float64)
        wanted, offered = _matrix(left["v"], width), _matrix(right["offered"], width)
        parts = [slice(at, at + ROWS) for at in range(0, len(asked), ROWS)]
        found = [(p.start, best_pairs(wanted[p], asked[p], offered, ids, rule.k, floor[p])) for p in parts]
        q, x, score = (np.concatenate(parts) for parts in zip(*((at + q, x, score) for at, (q, x, score) in found)))
        return pd.DataFrame({"query": asked[q], "qkey": left["qkey"].to_numpy(np.int64)[q], "id": ids[x], "score": score})

    def met(asking: DataFrame, offered: DataFrame) -> DataFrame:
        return asking.groupBy("qb", "xb").cogroup(offered.groupBy("qb", "xb")).applyInPandas(meet, FOUND)

    lowest = F.lit(-math.inf).alias("floor")
    if x_blocks > 1:
        own = F.col("xb") == F.pmod(F.xxhash64(F.lit(11), "qb"), F.lit(x_blocks))
        first = met(queries.filter(own).select("*", lowest), others.filter(own))
        reached = first.groupBy(F.col("query").alias("who"), F.col("qkey").alias("what")).agg(
            F.when(F.count("*") >= rule.k, F.min("score")).cast("double").alias("reached")
        )
        asking = queries.join(reached, (F.col("id") == F.col("who")) & (F.col("qkey") == F.col("what")), "left")
        # Scores beyond what doubles hold exactly are rounded, so the floor is a little lower.
        floor = F.coalesce(F.col("reached") - 1 - F.abs("reached") * 1e-12, F.lit(-math.inf))
        asking = asking.select("id", "qkey", "v", "qb", "xb", floor.alias("floor"))
    else:
        asking = queries.select("*", lowest)
    found = met(asking, others)
    order = Window.partitionBy("query", "qkey").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= rule.k)
    return ranked.select(F.col("query").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score")
