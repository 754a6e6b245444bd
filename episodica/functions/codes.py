"""Code predicates."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def starts_with_any(code: Column, prefixes: Iterable[str]) -> Column:
    """True where the code begins with one of the prefixes."""
    return reduce(or_, [code.startswith(prefix) for prefix in prefixes])


def in_codes(code: str, codes: Iterable[str]) -> Column:
    """True where the column is in the set; exact match, sub-codes are not included."""
    listed = ", ".join("'" + c.replace("\\", "\\\\").replace("'", "\\'") + "'" for c in codes)
    return F.expr(f"`{code}` IN ({listed})")
