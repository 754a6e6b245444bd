"""Joins of a fact to its dimensions and to its child rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(
    fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, columns: dict[str, str], how: str = "left"
) -> DataFrame:
    """Add dimension columns (output name -> dimension column) under one role of the dimension.

    ``inner`` drops facts without a match, ``left`` keeps them. The dimension key is unique. No broadcast hint: Spark
    broadcasts a dimension below its size threshold; a larger one is merged and its hot keys are split at run time.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be inner or left, not {how!r}")
    role = dim.selectExpr(f"`{dim_key}` AS _key", *[f"`{c}` AS `{out}`" for out, c in columns.items()])
    return fact.join(role, F.expr(f"`{fact_key}` = _key"), how).drop("_key")


def with_child(parent: DataFrame, children: DataFrame, parent_key: str, child_key: str) -> DataFrame:
    """Parents that have at least one child row, each once.

    The parents' own filters (a lookback, dimensions) come first: they meet the children as they are, and equal rows are
    merged after that, in the join's own partitions. A small parent is broadcast, so the children are not shuffled at
    all; a parent with very many children is split by AQE and its rows are merged before and after a second shuffle.
    """
    keys = children.selectExpr(f"`{child_key}` AS _key")
    return parent.join(keys, F.expr(f"`{parent_key}` = _key"), "inner").drop("_key").distinct()
