"""Text and sentinel expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def known(value: Column, sentinel) -> Column:
    """``value``, or NULL where it is the sentinel that stands for "not informed"."""
    return F.nullif(value, F.lit(sentinel))


def prefer_known(first: Column, sentinel, fallback: Column) -> Column:
    """``first`` unless it is NULL or the sentinel, else ``fallback``."""
    return F.coalesce(known(first, sentinel), fallback)


def join_text(*parts: Column, separator: str = ", ") -> Column:
    """The parts with the separator between them; a NULL part counts as empty text, the separator stays."""
    pieces: list[Column] = []
    for part in parts:
        if pieces:
            pieces.append(F.lit(separator))
        pieces.append(F.coalesce(part, F.lit("")))
    return F.concat(*pieces)


def yes_no(flag: Column, yes: str = "Sim", no: str = "Não") -> Column:
    """A label for a flag; NULL counts as no."""
    return F.when(flag, F.lit(yes)).otherwise(F.lit(no))
