"""Vector codes: parts of vectors named by the nearest entry of a codebook, found through pivots.

The search is LAESA's. Each part's distances to a few fixed pivots are computed once and written with
the part. In a round, the difference of a part's and an entry's distance to a pivot is a lower bound
of their own distance; entries with the lowest bounds are measured first, exactly and in integers, and
entries whose bound is over the best distance so far are never measured. Codebooks are bounded (256
entries), so they travel with the function; sums of parts are added up by Spark.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.tables import staged
from orderlake.llm.vectors import usable, whole

PARTS = 4
ENTRIES = 256
ROUNDS = 4
#: Fixed pivots of a part position.
PIVOTS = 8
#: Entries measured before any is pruned.
FIRST = 8
#: Rows that a task works on at once, and pairs of a part and an entry measured at once.
BLOCK = 2048
PAIRS = 1 << 16

MEASURED = "vec_id long, label long, parts array<bigint>, far array<double>"
CODED = "vec_id long, label long, code string, error long"


def codes(
    vectors: DataFrame,
    scale: int = 1024,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error) of every kept vector, and the final codebooks.

    Components x count as floor(scale * x). A vector is kept if it is there and all its components are
    finite; a component beyond `vectors.MOST` / scale is an error. Vectors are cut into PARTS equal
    parts; those shorter than the longest, or than a multiple of PARTS, count as filled up with zeros.
    A codebook begins as the parts of the ENTRIES smallest ids (null last; rows of one id by their
    components), or of all if there are fewer. Each of ROUNDS rounds gives every part to the nearest
    entry, ties to the lower index, and replaces an entry by its parts' mean, rounded down; entries
    without parts stay. Repeated rows are coded as often as they come, null ids stay null. An empty
    table has no codes and empty codebooks. Other columns are not read.
    """
    kept = vectors.filter(usable(F.col(vector_column))).select(
        F.col(id_column).cast("long").alias("vec_id"),
        F.col(label_column).cast("long").alias("label"),
        whole(F.col(vector_column), scale).alias("parts"),
    )
    longest = kept.agg(F.max(F.size("parts"))).first()[0]
    if longest is None:
        return vectors.sparkSession.createDataFrame([], CODED), np.zeros((PARTS, 0, 0), np.int64)
    length = -(-longest // PARTS)
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "parts").limit(ENTRIES).collect()
    begun = _as_parts(pa.array([r.parts for r in first], pa.list_(pa.int64())), length)
    books = np.ascontiguousarray(begun.transpose(1, 0, 2))
    pivots = np.stack([_spread(book, PIVOTS) for book in books])

    measured = staged(kept.mapInArrow(_measure(pivots, length), MEASURED), "pivot-distances")
    for _ in range(ROUNDS):
        sums = measured.mapInArrow(_sum_up(books, pivots, length), "slot int, total long, times long")
        for slot, total, times in sums.groupBy("slot").agg(F.sum("total"), F.sum("times")).collect():
            books.reshape(-1)[slot] = total // times
    return staged(measured.mapInArrow(_encode(books, pivots, length), CODED), "vector-codes"), books


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components in decimal, by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def _as_parts(vectors: pa.ListArray, length: int) -> np.ndarray:
    """Vectors as (row, part, place), filled up with zeros."""
    offsets, values = vectors.offsets.to_numpy(), vectors.values.to_numpy(zero_copy_only=False)
    lengths = np.diff(offsets)
    rows = np.repeat(np.arange(len(vectors)), lengths)
    filled = np.zeros((len(vectors), PARTS * length), np.int64)
    filled[rows, np.arange(offsets[0], offsets[-1]) - np.repeat(offsets[:-1], lengths)] = values[offsets[0] : offsets[-1]]
    return filled.reshape(len(vectors), PARTS, length)


def _spread(entries: np.ndarray, most: int) -> np.ndarray:
    """Entries far from each other: the first, then always the one farthest from those taken."""
    taken = [0]
    nearest = ((entries - entries[0]) ** 2).sum(1)
    while len(taken) < min(most, len(entries)):
        taken.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, ((entries - entries[taken[-1]]) ** 2).sum(1))
    return entries[taken]


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distance of every row of `a` from every row of `b`, its square summed in integers."""
    return np.sqrt(np.stack([((a - row) ** 2).sum(1) for row in b], 1).astype(float))


def nearest(parts: np.ndarray, far: np.ndarray, entries: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The index of the nearest entry of each part, and the squared distance.

    `far` has the parts' distances to the pivots. A bound is lowered by more than its rounding, so that
    no entry which is as near as the best, of lower index perhaps, goes unmeasured.
    """
    n, most = len(parts), len(entries)
    near = _distances(pivots, entries)
    bound = np.abs(far[:, :1] - near[0])
    for p in range(1, len(pivots)):
        np.maximum(bound, np.abs(far[:, p : p + 1] - near[p]), out=bound)
    slack = 1e-9 * (far.max(initial=0) + near.max(initial=0))
    low = np.maximum(bound - slack, 0) ** 2 * (1 - 1e-9)

    first = min(FIRST, most)
    order = np.argpartition(low, first - 1, axis=1)[:, :first] if first < most else np.tile(np.arange(most), (n, 1))
    order.sort(axis=1)
    exact = ((parts[:, None, :] - entries[order]) ** 2).sum(2)
    at = exact.argmin(1)
    index, best = np.take_along_axis(order, at[:, None], 1)[:, 0], np.take_along_axis(exact, at[:, None], 1)[:, 0]
    np.put_along_axis(low, order, np.inf, axis=1)
    row, entry = np.nonzero(low <= best[:, None])
    for k in range(0, len(row), PAIRS):
        rows, tried = row[k : k + PAIRS], entry[k : k + PAIRS]
        exact = ((parts[rows] - entries[tried]) ** 2).sum(1)
        order = np.lexsort((tried, exact, rows))
        rows, lead = np.unique(rows[order], return_index=True)
        exact, tried = exact[order][lead], tried[order][lead]
        better = (exact < best[rows]) | ((exact == best[rows]) & (tried < index[rows]))
        index[rows[better]], best[rows[better]] = tried[better], exact[better]
    return index, best


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, batch.num_rows, BLOCK):
            yield batch.slice(k, BLOCK)


def _measure(pivots: np.ndarray, length: int):
    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            parts = _as_parts(block.column(2), length)
            far = np.stack([_distances(parts[:, p], pivots[p]) for p in range(PARTS)], 1).reshape(len(parts), -1)
            offsets = np.arange(len(parts) + 1, dtype=np.int32) * far.shape[1]
            column = pa.ListArray.from_arrays(pa.array(offsets), pa.array(far.reshape(-1)))
            yield pa.RecordBatch.from_arrays([*block.columns, column], names=[*block.schema.names, "far"])

    return measured


def _assigned(block: pa.RecordBatch, books: np.ndarray, pivots: np.ndarray, length: int):
    """(parts, entry index by row and part, squared distance by row and part) of a block."""
    parts = _as_parts(block.column(2), length)
    far = block.column(3)
    far = far.values.to_numpy(zero_copy_only=False)[far.offsets[0].as_py() : far.offsets[-1].as_py()]
    far = far.reshape(len(parts), PARTS, -1)
    both = [nearest(parts[:, p], far[:, p], books[p], pivots[p]) for p in range(PARTS)]
    return parts, np.stack([index for index, _ in both], 1), np.stack([best for _, best in both], 1)


def _sum_up(books: np.ndarray, pivots: np.ndarray, length: int):
    """A task's sum and count for each component of an entry that got parts."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, times = np.zeros_like(books), np.zeros(books.shape[:2], np.int64)
        for block in _blocks(batches):
            parts, index, _ = _assigned(block, books, pivots, length)
            for p in range(PARTS):
                np.add.at(total[p], index[:, p], parts[:, p])
                times[p] += np.bincount(index[:, p], minlength=books.shape[1])
        each = np.repeat(times.reshape(-1), length)
        slot = np.flatnonzero(each)
        columns = [pa.array(slot, pa.int32()), pa.array(total.reshape(-1)[slot]), pa.array(each[slot])]
        yield pa.RecordBatch.from_arrays(columns, names=["slot", "total", "times"])

    return sums


def _encode(books: np.ndarray, pivots: np.ndarray, length: int):
    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            _, index, best = _assigned(block, books, pivots, length)
            code = [row.tobytes().hex() for row in index.astype(np.uint8)]
            columns = [block.column(0), block.column(1), pa.array(code, pa.string()), pa.array(best.sum(1))]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "code", "error"])

    return coded


def with_label_errors(coded: DataFrame) -> DataFrame:
    """`coded` with label_error, the errors summed over equal labels; nulls are one label.

    The join's null-safe condition gives the sums a shuffle of their own, so that adaptive execution
    can split a label that holds most of the rows.
    """
    sums = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of")), "left").drop("of")
