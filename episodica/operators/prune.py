"""Pruning a fact at its scan: to the ids of a set, and to the days of a set."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# At most so many 64-bit words are broadcast: 2 million rows of two numbers, 32 MB, whatever the number of ids.
MOST_WORDS = 1 << 21
# Ids per word that the filter is sized for, up to that bound.
IDS_PER_WORD = 4


def _word_and_mask(rows: DataFrame, id_column: str, words: int) -> tuple[Column, Column]:
    """The word of an id and its four bits there, from separate bits of one hash; whole numbers of any size agree."""
    whole = isinstance(rows.schema[id_column].dataType, T.IntegralType)
    h = F.xxhash64(F.col(id_column).cast("long" if whole else "string"))
    places = [F.shiftrightunsigned(h, shift).bitwiseAND(63).cast("int") for shift in (40, 46, 52, 58)]
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), place) for place in places]
    return F.pmod(h, F.lit(words)), reduce(Column.bitwiseOR, bits)


class IdFilter:
    """A Bloom filter of ids, as a small table of words that every task gets.

    It never drops an id of the set. It lets under 1 percent of others through for up to eight million ids, and
    more beyond, as its size stays bounded; so it only goes before an exact join.
    """

    def __init__(self, ids: DataFrame, id_column: str, count: int):
        self.words = min(MOST_WORDS, 1 << max(0, (count // IDS_PER_WORD).bit_length()))
        word, mask = _word_and_mask(ids, id_column, self.words)
        set_bits = ids.where(F.col(id_column).isNotNull()).select(word.alias("_word"), mask.alias("_mask"))
        self.table = set_bits.groupBy("_word").agg(F.bit_or("_mask").alias("_bits"))

    def keep(self, facts: DataFrame, id_column: str) -> DataFrame:
        """Facts whose id may be in the set."""
        word, mask = _word_and_mask(facts, id_column, self.words)
        hit = (word == F.col("_word")) & (F.col("_bits").bitwiseAND(mask) == mask)
        return facts.where(F.col(id_column).isNotNull()).join(F.broadcast(self.table), hit, "left_semi")


def key_ranges(keys: Iterable[int], most: int = 16) -> list[tuple[int, int]]:
    """Closed ranges that cover whole-number keys: runs of neighbours, joined over the smallest gaps until ``most`` are left."""
    ordered = sorted(set(keys))
    if not ordered:
        return []
    gaps = sorted(((b - a, i) for i, (a, b) in enumerate(zip(ordered, ordered[1:]), 1) if b - a > 1), reverse=True)
    cuts = sorted(i for _, i in gaps[: most - 1])
    return [(ordered[a], ordered[b - 1]) for a, b in zip([0, *cuts], [*cuts, len(ordered)])]


def in_ranges(column: str, ranges: list[tuple[int, int]]) -> Column:
    """Inside one of the ranges: literals, so that scans skip partitions, files and row groups by them."""
    parts = [F.col(column).between(F.lit(low), F.lit(high)) for low, high in ranges]
    return reduce(or_, parts) if parts else F.lit(False)
