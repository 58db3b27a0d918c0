"""Row guards: null keys, quarantine split, emptiness gate, promotion predicates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.operators.columns import quote


def all_present(columns: Sequence[str]) -> Column:
    return reduce(and_, [F.col(quote(c)).isNotNull() for c in columns])


def any_missing(columns: Sequence[str]) -> Column:
    return reduce(or_, [F.col(quote(c)).isNull() for c in columns])


def require_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep rows in which none of the columns is null."""
    return df.filter(all_present(columns))


def split_missing(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows without and rows with a null in the columns, as two lazy complements."""
    return df.filter(all_present(columns)), df.filter(any_missing(columns))


def cart_level(consumed_entry: str, promotion: str) -> Column:
    """A promotion on the whole cart: entry text `''`, or no entry text but a promotion code."""
    entry = F.col(quote(consumed_entry))
    return (entry == "") | (entry.isNull() & F.col(quote(promotion)).isNotNull())


def nonempty_or_null(column: str) -> Column:
    return (F.col(quote(column)) != "") | F.col(quote(column)).isNull()


def both_nonempty(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame] | None:
    """The pair, or None when either side has no row. Stops at the first row found."""
    return None if left.isEmpty() or right.isEmpty() else (left, right)
