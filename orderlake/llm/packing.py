"""Hierarchical packing of documents into windows of several lengths.

Windows are powers of two, the tiers. A document is cut into as many longest windows as it fills;
what remains is routed to the smallest tier that holds it. From the longest tier down, remainders
are laid into windows of their tier, and the gap that a window has left is filled from the
shorter tiers, the last piece being cut to the gap. So every window but the last of a block is full
to its tier's length and needs no padding; what remains at the end of a task goes to windows of
the powers of two that sum to it. Tasks pack on their own, so no text is shuffled and no task needs
more than its share.

Windows of one length are dealt to step groups in turn, counted over all tasks: a group holds as many
windows as make `group_tokens` tokens at most, so all groups of a length are equal but for its last, and
the steps of a training run cost the same. For this the pieces are written once, and the windows that
each task laid are summed up task by task; that sum has one row per task and length.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlake.llm.tables import giving_back, staged, text_slices
from orderlake.llm.tokens import with_end, word_encoder

TIERS = (256, 512, 1024, 2048)
#: Tokens of one step group of windows.
GROUP_TOKENS = 1 << 18
#: Sequence ids of a task begin at its number shifted by this.
TASK_BITS = 40

PIECE = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
    "offset long, tier int, number long"
)


class Packer:
    """Lays pieces of documents into windows; `pieces` takes what has been laid."""

    def __init__(self, tiers: tuple[int, ...], first_id: int):
        if sorted(set(tiers)) != list(tiers) or any(t < 1 or t & (t - 1) for t in tiers):
            raise ValueError("tiers must be ascending powers of two")
        self.tiers = tiers
        self.waiting = {tier: deque() for tier in tiers}
        self.tokens = dict.fromkeys(tiers, 0)
        self.next_id = first_id
        self.windows = {}
        self.pieces: list[tuple] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        """Cut off full longest windows, route the rest by its length."""
        longest, n = self.tiers[-1], len(ids)
        whole = n - n % longest
        for start in range(0, whole, longest):
            self._window(longest, [(doc_id, start, ids[start : start + longest], n)])
        if rest := n - whole:
            tier = next(t for t in self.tiers if t >= rest)
            self.waiting[tier].append((doc_id, whole, ids[whole:], n))
            self.tokens[tier] += rest

    def fill_tiers(self) -> None:
        """Make full windows of each tier from its own remainders and those of shorter tiers.

        The shortest pieces stay for the gaps of longer windows, which come first.
        """
        for k in range(len(self.tiers) - 1, -1, -1):
            tier, usable = self.tiers[k], self.tiers[: k + 1]
            while self.tokens[tier] and sum(self.tokens[t] for t in usable) >= tier:
                self._window(tier, self._take(tier, usable))

    def finish(self) -> None:
        """Lay out all that is left in windows whose lengths are powers of two."""
        self.fill_tiers()
        left = sum(self.tokens.values())
        for size in (1 << b for b in range(left.bit_length() - 1, -1, -1)):
            if left & size:
                self._window(size, self._take(size, self.tiers))

    def _take(self, room: int, usable: tuple[int, ...]) -> list[tuple]:
        """Remainders that fill `room`: of the longest tier that has any, then of shorter ones."""
        taken = []
        while room:
            tier = next(t for t in reversed(usable) if self.waiting[t])
            doc_id, start, ids, n = self.waiting[tier].popleft()
            self.tokens[tier] -= len(ids)
            if len(ids) > room:
                back = next(t for t in self.tiers if t >= len(ids) - room)
                self.waiting[back].appendleft((doc_id, start + room, ids[room:], n))
                self.tokens[back] += len(ids) - room
                ids = ids[:room]
            taken.append((doc_id, start, ids, n))
            room -= len(ids)
        return taken

    def _window(self, tier: int, pieces: list[tuple]) -> None:
        number = self.windows.get(tier, 0)
        self.windows[tier] = number + 1
        offset = 0
        for doc_id, start, ids, n in pieces:
            crc = zlib.crc32(np.ascontiguousarray(ids, "<u4"))
            self.pieces.append((doc_id, start, len(ids), crc, n, self.next_id, offset, tier, number))
            offset += len(ids)
        self.next_id += 1


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int,
    id_column: str = "doc_id",
    text_column: str = "text",
    tiers: tuple[int, ...] = TIERS,
    group_tokens: int = GROUP_TOKENS,
) -> DataFrame:
    """One row per piece of a document, with its place in a window (see the module).

    A null text is empty; every row has its end id, so it has a piece at least. Repeated rows are
    packed as often as they come, null ids stay null. Other columns are not read. An empty table
    has no pieces. Columns: those of a piece (its document's id, start, length, checksum and tokens),
    sequence_id and offset in its window, tier (the window's length) and step_group.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        packer = Packer(tiers, (task.partitionId() if task else 0) << TASK_BITS)
        schema = pa.schema(
            [(n, pa.int32() if n == "tier" else pa.int64()) for n in (c.split()[0] for c in PIECE.split(", "))]
        )

        def out() -> pa.RecordBatch:
            columns = list(zip(*packer.pieces, strict=True)) or [()] * len(schema)
            packer.pieces = []
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
            )

        for part in text_slices(batches, "text"):
            ids, begins = with_end(*word_encoder(tokenizer_path).encode(part.column(1)), end_id)
            ids = ids.astype("<u4")
            for k, doc_id in enumerate(part.column(0).to_pylist()):
                packer.add(doc_id, ids[begins[k] : begins[k + 1]])
            packer.fill_tiers()
            yield out()
        packer.finish()
        yield out()

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return with_step_groups(staged(rows.mapInArrow(giving_back(pieces), PIECE), "packed"), group_tokens)


def with_step_groups(pieces: DataFrame, group_tokens: int) -> DataFrame:
    """`step_group` in place of `number`: windows of one length are counted on from task to task."""
    pieces = pieces.withColumn("task", F.shiftright("sequence_id", TASK_BITS))
    laid = pieces.groupBy("task", "tier").agg((F.max("number") + 1).alias("laid"))
    earlier = Window.partitionBy("tier").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = laid.select("task", "tier", F.coalesce(F.sum("laid").over(earlier), F.lit(0)).alias("before"))
    per_group = F.greatest(F.lit(1), F.expr(f"{int(group_tokens)} div tier"))
    turn = F.floor((F.col("before") + F.col("number")) / per_group)
    group = F.shiftleft(F.col("tier").cast("long"), TASK_BITS) + turn
    return pieces.join(before, ["task", "tier"]).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier", group.alias("step_group")
    )
