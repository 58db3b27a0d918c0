"""Column-level operators: projection, renaming, audit columns, name cleaning."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Characters removed from, and replaced by `_` in, a column name.
REMOVED_CHARACTERS = ".)"
UNDERSCORED_CHARACTERS = " /-("


def quote(name: str) -> str:
    """A column name as an identifier, so that dots and spaces in it are plain characters."""
    return "`" + name.replace("`", "``") + "`"


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(quote(c)) for c in columns])


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by name, keeping order and unmapped columns; an unknown source name is an error."""
    unknown = [c for c in mapping if c not in df.columns]
    if unknown:
        raise ValueError(f"columns to rename not found: {unknown}")
    return df.select(*[F.col(quote(c)).alias(mapping.get(c, c)) for c in df.columns])


def project_renamed(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Select the mapping's source columns in its order, under their new names."""
    return df.select(*[F.col(quote(old)).alias(new) for old, new in mapping.items()])


def drop(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop columns that are there; names that are not are ignored."""
    return df.drop(*columns)


def add_audit(df: DataFrame, name: str, value: str | datetime) -> DataFrame:
    """Add one constant column; a `datetime` gives a timestamp column.

    A `datetime` without zone is a wall clock time of the session zone, as parsed text is, and
    not of the zone that the driver's machine happens to have.
    """
    if isinstance(value, datetime) and value.tzinfo is None:
        return df.withColumn(name, F.lit(value.isoformat(sep=" ")).cast("timestamp"))
    return df.withColumn(name, F.lit(value))


def lower_columns(df: DataFrame) -> DataFrame:
    return _rename_all(df, str.lower)


def clean_columns(df: DataFrame) -> DataFrame:
    """Make names free of `. ) space / - (`."""
    table = str.maketrans(
        {**{c: None for c in REMOVED_CHARACTERS}, **{c: "_" for c in UNDERSCORED_CHARACTERS}}
    )
    return _rename_all(df, lambda name: name.translate(table))


def _rename_all(df: DataFrame, new_name: Callable[[str], str]) -> DataFrame:
    names = [new_name(c) for c in df.columns]
    times = Counter(n.lower() for n in names)  # Spark's names differ by more than case
    clashes = sorted(n for n in names if times[n.lower()] > 1)
    if clashes:
        raise ValueError(f"several columns would be named {clashes}")
    return df.toDF(*names)
