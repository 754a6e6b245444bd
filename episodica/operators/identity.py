"""Several ids, one entity: ids that share a natural key are the same person."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def members_of(
    ids: DataFrame, id_column: str, natural_key: Sequence[str], targets: DataFrame, carry: Sequence[str]
) -> DataFrame:
    """All ids whose natural key equals that of a target row, with the target's ``carry`` columns.

    The match is exact and a NULL in the natural key matches nothing. A target's natural key is unique.
    """
    wanted = targets.selectExpr(*[f"`{k}` AS `_nk_{k}`" for k in natural_key], *[f"`{c}`" for c in carry])
    same = " AND ".join(f"`{k}` = `_nk_{k}`" for k in natural_key)
    return ids.select(id_column, *natural_key).join(wanted, F.expr(same), "inner").select(id_column, *carry)


def merge_ids(
    facts: DataFrame,
    fact_id: str,
    members: DataFrame,
    member_id: str,
    entity: Sequence[str],
    per_id: dict[str, Column],
    merged: dict[str, Column],
    resolve: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Aggregate facts to the entities their ids belong to. ``merged`` merges the ``per_id`` aggregates of an entity.

    The facts shrink to one row per id before they meet the members, and those rows to one per entity: neither a hot id
    nor a hot entity puts its rows into one task, and the join is one row to one row. ``resolve`` may add entity columns
    to the rows per id.
    """
    by_id = facts.groupBy(F.col(fact_id).alias("_fact_id")).agg(*[m.alias(n) for n, m in per_id.items()])
    joined = by_id.join(members, F.expr(f"_fact_id = `{member_id}`"), "inner")
    if resolve:
        joined = resolve(joined)
    return joined.groupBy(*entity).agg(*[m.alias(n) for n, m in merged.items()])
