"""Vectors with whole-number components, as the vector operators take them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Largest size of a whole component. Sums of products of such components fit a long.
MOST = 1 << 24


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers; never null."""
    finite = lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False))
    return F.coalesce(F.forall(vector, finite), F.lit(False))


def whole(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component x; an error beyond MOST, where exact sums would not fit."""

    def component(x: Column) -> Column:
        value = F.floor(x.cast("double") * F.lit(float(scale)))
        far = F.abs(x.cast("double")) > F.lit(float(MOST) / scale)
        return F.when(far, F.raise_error(F.lit(f"a component is beyond {MOST} / {scale}")).cast("bigint")).otherwise(value)

    return F.transform(vector, component)
