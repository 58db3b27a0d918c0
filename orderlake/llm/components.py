"""Connected components of a link table, by hooking and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.tables import staged


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of a link between two nodes; root is one node per component.

    Each round hooks every node to its smallest neighbour, follows hooks twice and replaces nodes
    by what they hang on, until no link joins two different ones. The rounds grow with the
    logarithm of the longest path; all tables of a round are written, none passes the driver.
    """
    edges = staged(
        links.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).filter("a <> b").distinct(), "links"
    )
    known = None
    while not edges.isEmpty():
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = staged(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("root")), "hooks")
        up = hooks.select(F.col("node").alias("root"), F.col("root").alias("above"))
        roots = staged(hooks.join(up, "root").select("node", F.col("above").alias("root")), "roots")
        known = roots if known is None else staged(_followed(known, roots), "components")
        left = roots.select(F.col("node").alias("a"), F.col("root").alias("x"))
        right = roots.select(F.col("node").alias("b"), F.col("root").alias("y"))
        edges = staged(
            edges.join(left, "a")
            .join(right, "b")
            .filter("x <> y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
            .distinct(),
            "links",
        )
    if known is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return known


def _followed(known: DataFrame, roots: DataFrame) -> DataFrame:
    """`known` with each root replaced by what it hangs on now, if it still had links."""
    above = roots.select(F.col("node").alias("root"), F.col("root").alias("above"))
    return known.join(above, "root", "left").select("node", F.coalesce("above", "root").alias("root"))
