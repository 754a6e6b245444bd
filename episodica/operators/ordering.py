"""Order keys of fixed width: (order, tie) as one decimal, so that first and last rows are found by hash aggregates.

An aggregate whose buffer holds only numbers, dates and decimals stays a hash aggregate; with a struct or a text in it,
every task would sort its rows by entity. The winner's order and tie are read back from its key, other fixed-width columns
are taken by ``max_by`` / ``min_by`` over it, and texts are fetched afterwards from the table whose key the tie is
(``lookup``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Beyond any day or time in microseconds; its product with the width of a tie still fits into 38 digits.
_LAST = 5 * 10**18
_WIDTH = 2**64

_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FIXED = (*_INTEGERS, T.BooleanType, T.FloatType, T.DoubleType, T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _number(rows: DataFrame, column: str) -> str:
    """SQL of a whole number in the column's order."""
    kind, name = rows.schema[column].dataType, f"`{column}`"
    if isinstance(kind, _INTEGERS):
        return f"CAST({name} AS BIGINT)"
    if isinstance(kind, T.DateType):
        return f"CAST(unix_date({name}) AS BIGINT)"
    if isinstance(kind, T.TimestampType):
        return f"unix_micros({name})"
    if isinstance(kind, T.TimestampNTZType):  # by its fields where the session's time zone could change the order
        if rows.sparkSession.conf.get("spark.sql.session.timeZone") in ("UTC", "Etc/UTC"):
            return f"unix_micros(CAST({name} AS TIMESTAMP))"
        seconds = f"unix_date(CAST({name} AS DATE)) * 86400L + hour({name}) * 3600 + minute({name}) * 60"
        return f"({seconds}) * 1000000L + CAST(extract(SECOND FROM {name}) * 1000000 AS BIGINT)"
    raise TypeError(f"{column} is {kind.simpleString()}; an order key takes whole numbers, dates and timestamps")


def with_order_key(rows: DataFrame, order: str, tie: str, name: str = "_order_key") -> DataFrame:
    """Rows with a decimal(38) that sorts by (order, tie), a NULL order last. Computed once a row, as a column.

    The tie is a whole number. An order of five quintillions or more (no date or time is) raises.
    """
    if not isinstance(rows.schema[tie].dataType, _INTEGERS):
        raise TypeError(f"{tie} is {rows.schema[tie].dataType.simpleString()}; a tie is a whole number")
    number = _number(rows, order)
    if isinstance(rows.schema[order].dataType, (T.LongType, T.TimestampType, T.TimestampNTZType)):
        number = f"CASE WHEN {number} NOT BETWEEN -{_LAST - 1} AND {_LAST - 1} THEN raise_error('order out of range') ELSE {number} END"
    wide = f"CAST(coalesce({number}, {_LAST}) AS DECIMAL(20, 0)) * CAST({_WIDTH}BD AS DECIMAL(20, 0))"
    low = f"CAST(coalesce(CAST(`{tie}` AS BIGINT), CAST(-{2**63}BD AS BIGINT)) AS DECIMAL(20, 0))"
    key = F.expr(f"CAST({wide} + {low} AS DECIMAL(38, 0))")
    return rows.select("*", key.alias(name, metadata={"order": order, "tie": tie}))


def _read_back(rows: DataFrame, key: str, found: str) -> dict[str, str]:
    """SQL of the order (whole numbers and dates) and the tie in a key ``found`` by an aggregate of column ``key``."""
    of = rows.schema[key].metadata
    low = f"pmod({found} + {2**63}BD, CAST({_WIDTH}BD AS DECIMAL(38, 0)))"
    tie, order = rows.schema[of["tie"]].dataType, rows.schema[of["order"]].dataType
    number = f"nullif(CAST(({found} + {2**63}BD - {low}) DIV {_WIDTH}BD AS BIGINT), {_LAST})"
    parts = {of["tie"]: f"CAST(nullif(CAST({low} - {2**63}BD AS BIGINT), CAST(-{2**63}BD AS BIGINT)) AS {tie.simpleString()})"}
    if isinstance(order, T.DateType):
        parts[of["order"]] = f"date_from_unix_date(CAST({number} AS INT))"
    elif isinstance(order, _INTEGERS):
        parts[of["order"]] = f"CAST({number} AS {order.simpleString()})"
    return parts


def fixed_width(rows: DataFrame, columns: Sequence[str]) -> None:
    """Raise for columns that would turn the aggregate into a sort."""
    wide = [c for c in columns if not isinstance(rows.schema[c].dataType, _FIXED)]
    if wide:
        raise TypeError(f"{', '.join(wide)} have no fixed width: look them up by the key of the row that was found")


def chosen(how: str, key: str, keep: dict[str, str]) -> Column:
    """Aggregate: struct of ``key`` and, per output name, an expression's value on the row with the ``max`` / ``min`` key."""
    fields = "".join(f", '{name}', {how}_by({value}, {key})" for name, value in keep.items())
    return F.expr(f"named_struct('key', {how}({key}){fields})")


def chosen_row(rows: DataFrame, how: str, key: str, where: str | None, keep: dict[str, str]) -> Column:
    """``chosen`` over rows with an order key, among those that meet ``where``; what the key tells is read back from it."""
    met = f"CASE WHEN {where} THEN `{key}` END" if where else f"`{key}`"
    told = _read_back(rows, key, f"{how}({met})")
    fields = {name: told.get(value.strip("`"), f"{how}_by({value}, {met})") for name, value in keep.items()}
    return F.expr(f"named_struct('key', {how}({met})" + "".join(f", '{n}', {v}" for n, v in fields.items()) + ")")
