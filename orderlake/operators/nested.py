"""Nested data: flattening of any depth, last element, delimited text to rows.

Everything here is planned from `df.schema` on the driver; no job runs until an action.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from orderlake.operators.columns import quote


def _is_struct(t: DataType) -> bool:
    return isinstance(t, StructType)


def _is_exploded(t: DataType) -> bool:
    """Arrays that hold structs or arrays become rows; arrays of scalars are values."""
    return isinstance(t, ArrayType) and isinstance(t.elementType, (StructType, ArrayType))


def flatten(df: DataFrame, separator: str = "_", keep: Sequence[str] = ()) -> DataFrame:
    """Open structs into `parent_child` columns and arrays of structs or arrays into rows.

    Runs level by level until only plain columns are left. Scalars, maps and arrays of scalars
    stay as they are. A null or empty array keeps one row of nulls; sibling arrays multiply.
    Plain columns keep their place, opened children follow in the order of their parents.
    Two paths that would get one name are an error. Columns in `keep` are left as they are.
    """
    paths = {c: c for c in df.columns}
    while any(
        (_is_struct(f.dataType) or _is_exploded(f.dataType)) and f.name not in keep
        for f in df.schema.fields
    ):
        df, paths = _open_level(df, paths, separator, keep)
    return df


def _open_level(
    df: DataFrame, paths: dict[str, str], separator: str, keep: Sequence[str]
) -> tuple[DataFrame, dict[str, str]]:
    # Spark takes one generator per projection, so each array is its own step. Arrays of
    # arrays lose one level here and stay in place for the next round.
    for field in df.schema.fields:
        if _is_exploded(field.dataType) and field.name not in keep:
            df = df.select(
                *[
                    F.explode_outer(quote(c)).alias(c) if c == field.name else F.col(quote(c))
                    for c in df.columns
                ]
            )

    kept: list[Column] = []
    opened: list[Column] = []
    kept_paths: list[tuple[str, str]] = []
    opened_paths: list[tuple[str, str]] = []
    for field in df.schema.fields:
        name = field.name
        if not _is_struct(field.dataType) or name in keep:
            kept.append(F.col(quote(name)))
            kept_paths.append((name, paths[name]))
            continue
        for child in field.dataType.fields:
            new = name + separator + child.name
            opened.append(F.col(f"{quote(name)}.{quote(child.name)}").alias(new))
            opened_paths.append((new, f"{paths[name]}.{child.name}"))

    named = kept_paths + opened_paths
    _refuse_clashes(df, named)
    return df.select(*kept, *opened), dict(named)


def _refuse_clashes(df: DataFrame, named: list[tuple[str, str]]) -> None:
    sensitive = df.sparkSession.conf.get("spark.sql.caseSensitive", "false") == "true"
    seen: dict[str, str] = {}
    for name, path in named:
        key = name if sensitive else name.lower()
        if key in seen:
            raise ValueError(f"{seen[key]} and {path} would both be named {name}")
        seen[key] = path


def last_element(array: str | Column) -> Column:
    """Last element of an array; null for a null or empty array, in and out of ANSI mode."""
    return F.try_element_at(F.col(array) if isinstance(array, str) else array, F.lit(-1))


def split_to_rows(df: DataFrame, column: str, delimiter: str = "|") -> DataFrame:
    """One row per piece of a delimited text. Null stays one row; empty pieces are kept."""
    return df.withColumn(column, F.explode_outer(F.split(F.col(quote(column)), re.escape(delimiter))))
