"""Top-1 per entity as a hash aggregate: one row per entity and task before the shuffle, nothing sorted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from episodica.operators.ordering import chosen, chosen_row, fixed_width, with_order_key


def best_of(rows: DataFrame, key: str, keep: Sequence[str], where: str | None = None) -> Column:
    """Aggregate: a struct whose ``keep`` fields come from the row of ``rows`` with the highest ``key``.

    The key comes from ``with_order_key``: a NULL order counts as highest, as in a descending sort with NULLs first, and
    keys are unique, so the kept fields never decide. ``keep`` takes columns of fixed width; look others up by the tie.
    ``where`` is a condition on the rows that take part; without any the fields are NULL. Results merge by
    ``best_again``.
    """
    fixed_width(rows, keep)
    return chosen_row(rows, "max", key, where, {c: f"`{c}`" for c in keep})


def best_again(name: str, keep: Sequence[str], also: dict[str, str] | None = None) -> Column:
    """Aggregate over ``best_of`` results in column ``name``; ``also`` takes further columns of the row with the best."""
    return chosen("max", f"`{name}`.key", {c: f"`{name}`.`{c}`" for c in keep} | (also or {}))


def latest_by(rows: DataFrame, by: Sequence[str], order: str, tie: str, keep: Sequence[str]) -> DataFrame:
    """One row per entity: ``by`` and the ``keep`` columns of its latest row; ties go to the highest ``tie``."""
    keyed = with_order_key(rows, order, tie)
    best = keyed.groupBy(*by).agg(best_of(keyed, "_order_key", keep).alias("_best"))
    return best.select(*by, *[f"_best.{c}" for c in keep])
