"""Per-entity summaries written back to every row.

A window over the entity would bring all its rows into one task. The summaries used here are all algebraic, so they are
aggregated with map-side combine and joined back; Spark broadcasts a small summary and splits hot entities of a large
one. Keys compare NULL-safe: rows with NULL keys form one group, as in a window partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episodica.operators.ordering import chosen, chosen_row, with_order_key


def earliest(rows: DataFrame, key: str, order: str, value: str, where: str) -> Column:
    """Aggregate: struct(key, order, value) of the row of ``rows`` with the lowest ``key`` (``with_order_key``) that meets ``where``.

    NULL orders come last. Its fields are NULL when no row meets it. ``value`` is an expression of fixed width (another
    one makes Spark sort the rows). Results merge by ``earliest_again``.
    """
    return chosen_row(rows, "min", key, where, {"order": f"`{order}`", "value": value})


def earliest_again(name: str) -> Column:
    """Aggregate over ``earliest`` results in column ``name``."""
    return chosen("min", f"`{name}`.key", {c: f"`{name}`.`{c}`" for c in ("order", "value")})


def attach(
    rows: DataFrame, by: Sequence[str], measures: dict[str, Column], measured: DataFrame | None = None
) -> DataFrame:
    """Every row with the aggregates of its entity: what ``agg(...) OVER (PARTITION BY by)`` returns.

    ``measured`` are the rows to aggregate, where they need columns that the result doesn't.
    """
    summary = (rows if measured is None else measured).groupBy(*by).agg(*[m.alias(name) for name, m in measures.items()])
    renamed = summary.selectExpr(*[f"`{k}` AS `_by_{k}`" for k in by], *[f"`{m}`" for m in measures])
    same = " AND ".join(f"`{k}` <=> `_by_{k}`" for k in by)
    return rows.join(renamed, F.expr(same), "inner").drop(*[f"_by_{k}" for k in by])


def attach_first_so_far(
    rows: DataFrame, by: Sequence[str], order: str, tie: str, values: dict[str, tuple[str, str]]
) -> DataFrame:
    """Every row with, per output name, the first value that met its condition up to and including this row's order.

    ``values`` maps an output name to the expressions (value, condition). Rows with equal order see each other. The first
    qualifying row of the whole entity is the first of any frame that reaches it, so one aggregate and a comparison
    replace the running window.
    """
    keyed = with_order_key(rows, order, tie)
    firsts = {f"_first_{out}": earliest(keyed, "_order_key", order, v, cond) for out, (v, cond) in values.items()}
    found = attach(rows, by, firsts, keyed)
    reached = {
        out: F.expr(f"CASE WHEN `{order}` IS NULL OR `{order}` >= _first_{out}.order THEN _first_{out}.value END")
        for out in values
    }
    return found.withColumns(reached).drop(*firsts)
