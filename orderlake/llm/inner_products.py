"""Exact top-k search by inner product: all queries against all rows, term at a time.

A vector is a sparse row: its terms are the places of its non-zero components. Queries and rows are
dealt into strips and cells of bounded size, and every strip meets every cell once. There, the cell's
components are inverted into postings by term; a query scatters its weighted postings into a dense
array with one score per row of the cell, a partition selection takes its best rows, and a window
merges the best of all cells. No row is left out by an index, so the result is exact.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake.llm.tables import staged
from orderlake.llm.vectors import usable, whole

#: Rows of a cell and queries of a strip, about. A row is sent once per strip, a query once per cell.
CELL_ROWS = 8192
STRIP_ROWS = 8192

FOUND = "query long, query_id long, vec_id long, score long"
_FOUND = pa.schema([(n, pa.int64()) for n in ("query", "query_id", "vec_id", "score")])


def top_products(
    vectors: DataFrame,
    asked: Column,
    k: int = 5,
    scale: int = 256,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest integer inner products of each query.

    Components x count as floor(scale * x). Queries are the rows for which `asked` is true (null is
    false); every row but the query's own is a candidate, ranks go from 1, and ties go to the smaller
    id, null last. Fewer candidates than k are all returned. Vectors that are null or hold a null or a
    component that is not finite take no part; a component beyond `vectors.MOST` / scale is an error.
    Shorter vectors count as filled up with zeros. Repeated rows are rows of their own, as queries and
    as candidates. An empty table gives no rows; other columns are not read.
    """
    rows = staged(
        vectors.filter(usable(F.col(vector_column))).select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_column).cast("long").alias("id"),
            F.coalesce(asked, F.lit(False)).alias("asked"),
            whole(F.col(vector_column), scale).alias("parts"),
        ),
        "whole-vectors",
    )
    queries = rows.filter("asked")
    cells = max(1, math.ceil(rows.count() / CELL_ROWS))
    strips = max(1, math.ceil(queries.count() / STRIP_ROWS))

    def dealt(df: DataFrame, own: str, n: int, other: str, m: int) -> DataFrame:
        every = F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
        return df.select("row", "id", "parts", F.pmod(F.xxhash64("row"), F.lit(n)).cast("int").alias(own), every.alias(other))

    found = (
        dealt(queries, "strip", strips, "cell", cells)
        .groupBy("strip", "cell")
        .cogroup(dealt(rows, "cell", cells, "strip", strips).groupBy("strip", "cell"))
        .applyInArrow(_best_of_cell(k), FOUND)
    )
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _best_of_cell(k: int):
    def best(queries: pa.Table, rows: pa.Table) -> pa.Table:
        if not queries.num_rows or not rows.num_rows:
            return _FOUND.empty_table()
        rows = rows.sort_by([("id", "ascending")])  # nulls come last
        postings = Postings(rows.column("parts").combine_chunks(), rows.num_rows)
        numbers = rows.column("row").to_numpy()
        own_place = {row: place for place, row in enumerate(numbers.tolist())}
        parts = queries.column("parts").combine_chunks()
        offsets, weights = parts.offsets.to_numpy(), parts.values.to_numpy(zero_copy_only=False)
        place, score, times = [], [], []
        for q, row in enumerate(queries.column("row").to_pylist()):
            scores = postings.scores(weights[offsets[q] : offsets[q + 1]])
            chosen = selected(scores, k + 1)
            chosen = chosen[chosen != own_place.get(row, -1)][:k]
            place.append(chosen)
            score.append(scores[chosen])
            times.append(len(chosen))
        at = pa.array(np.repeat(np.arange(queries.num_rows), times))
        return pa.Table.from_arrays(
            [
                queries.column("row").combine_chunks().take(at),
                queries.column("id").combine_chunks().take(at),
                rows.column("id").combine_chunks().take(pa.array(np.concatenate(place))),
                pa.array(np.concatenate(score)),
            ],
            schema=_FOUND,
        )

    return best


class Postings:
    """The rows of a cell by term: for each term, the rows that have it and their weights."""

    def __init__(self, parts: pa.ListArray, n: int):
        offsets = parts.offsets.to_numpy()
        weights = parts.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
        lengths = np.diff(offsets)
        rows = np.repeat(np.arange(n), lengths)
        terms = np.arange(len(weights)) - np.repeat(offsets[:-1] - offsets[0], lengths)
        there = np.flatnonzero(weights)
        there = there[np.argsort(terms[there], kind="stable")]
        self.n = n
        self.rows, self.weights = rows[there], weights[there]
        self.begins = np.searchsorted(terms[there], np.arange((lengths.max() if n else 0) + 1))

    def scores(self, query: np.ndarray) -> np.ndarray:
        """The inner product of a query with every row, one term after another."""
        scores = np.zeros(self.n, np.int64)
        for term in np.flatnonzero(query[: len(self.begins) - 1]):
            span = slice(self.begins[term], self.begins[term + 1])
            scores[self.rows[span]] += query[term] * self.weights[span]
        return scores


def selected(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores in falling order, ties by place; all places if there are fewer."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        above = np.flatnonzero(scores > least)
        places = np.concatenate([above, np.flatnonzero(scores == least)[: k - len(above)]])
    else:
        places = np.arange(len(scores))
    return places[np.lexsort((places, -scores[places]))]
