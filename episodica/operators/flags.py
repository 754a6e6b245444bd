"""Interval existence: did an event of some kind happen for the entity between two dates?

Events come as one long table (id, day, flag), cases as one row per id with the bounds of a closed interval. Events are
first reduced to distinct (id, day, flag) with map-side combine: whatever the number of events, an id meets its case
with at most one row per flag and calendar day. Hits then combine to one row of booleans per case and task.

Where the cases themselves are aggregates of the rows that the events hang on, ``flags_in_one_pass`` takes both from one
table, with the flags as bits of a number.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def flags_of_ids(
    events: DataFrame,
    event_id: str,
    members: DataFrame,
    member_id: str,
    case: str,
    start: str,
    end: str,
    flags: Sequence[str],
) -> DataFrame:
    """Per case with a hit: one boolean per flag over the events of all its member ids.

    ``events`` has the id column, ``day`` (date) and ``flag``; ``members`` has the ids with their case and its bounds; a
    NULL bound takes no event.
    """
    events = events.selectExpr(f"`{event_id}` AS _id", "day", "flag")
    inside = F.expr(f"_id = `{member_id}` AND day >= `{start}` AND day <= `{end}`")
    hits = events.distinct().join(members, inside, "inner")
    return hits.groupBy(case).agg(*[F.bool_or(F.col("flag") == f).alias(f) for f in flags])


def with_flags(
    cases: DataFrame, events: DataFrame, key: str, start: str, end: str, flags: Sequence[str]
) -> DataFrame:
    """Cases with one boolean per flag, never NULL. ``events`` has the key column, ``day`` (date) and ``flag``."""
    bounds = cases.selectExpr(f"`{key}` AS _case", f"`{start}` AS _start", f"`{end}` AS _end")
    hits = flags_of_ids(events, key, bounds, "_case", "_case", "_start", "_end", flags)
    found = cases.join(hits, F.expr(f"`{key}` = _case"), "left").drop("_case")
    return found.withColumns({f: F.expr(f"coalesce(`{f}`, false)") for f in flags})


def flag_bits(flags: dict[str, Column]) -> Column:
    """One bit per flag, in order, set where its condition is true; for ``flags_in_one_pass``."""
    bits = [F.when(condition, F.lit(1 << i)).otherwise(F.lit(0)) for i, condition in enumerate(flags.values())]
    return reduce(Column.bitwiseOR, bits)


def flags_in_one_pass(
    rows: DataFrame, by: Sequence[str], bounds: dict[str, str], end: Column, start: str, flags: Sequence[str]
) -> DataFrame:
    """Cases and their flags from one table: each row may move its case's bounds and may hold an event.

    ``rows`` has the columns ``by`` of the case, those that ``bounds`` aggregates (name -> ``min`` or ``max``, ``start``
    among them), ``day`` (date) and ``bits`` of the event, both NULL without one. ``end`` is an expression of the
    aggregated bounds. The rows first shrink to one per case and day with map-side combine, so what a case collects is
    bounded by the calendar, however many events it has. Returns ``by``, the bounds, ``due`` and a boolean per flag.
    """
    merged = [F.expr(f"{how}(`{name}`)").alias(name) for name, how in bounds.items()]
    per_day = rows.groupBy(*by, "day").agg(*merged, F.bit_or("bits").alias("bits"))
    event = F.when(F.col("day").isNotNull(), F.struct("day", "bits"))
    cases = per_day.groupBy(*by).agg(*merged, F.collect_list(event).alias("_events")).withColumn("due", end)

    def happened(bit: int) -> Column:
        hit = F.exists("_events", lambda e: (e["bits"].bitwiseAND(bit) != 0) & (e["day"] >= F.col(start)) & (e["day"] <= F.col("due")))
        return F.coalesce(hit, F.lit(False))

    return cases.withColumns({f: happened(1 << i) for i, f in enumerate(flags)}).drop("_events")
