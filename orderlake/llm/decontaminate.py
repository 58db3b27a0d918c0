"""Benchmark passages in documents, by greedy string tiling.

Tokens are white-space separated words in lower case without anything but letters and digits;
words of nothing else are no tokens. For a document and a benchmark item, the longest run of tokens
that both share and that touches no marked token is marked in both, again and again, down to runs
of `least` tokens: the tiles. The item's share of marked tokens is its coverage. Tiles may lie in
any order, so a passage whose parts were moved around is found like one in one piece.

Running Karp-Rabin hashes find the runs: the rolling hashes of all `least`-token windows of the
document are looked up among those of the items; the hits of a pair, joined along diagonals, are its
maximal runs. A pair in which the windows that were hit cover too little of the item cannot reach
the threshold and is not tiled.

The benchmark is the query set. It is taken in blocks of a bounded number of characters, each of
which goes to all tasks and is held against all documents where they lie; documents are not
shuffled. A larger benchmark makes more blocks, not larger ones.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.tables import giving_back, text_slices

#: Tokens of the shortest tile. An item with fewer has to be found whole.
LEAST = 5
#: Share of an item's tokens that tiles must cover.
COVERAGE = 0.8
#: Pairs of equal windows that are held at once (those of one text and one item's windows at least).
SEEDS = 1 << 20
#: Characters of benchmark text that go to a task at once (one item at least).
BLOCK_CHARS = 4_000_000

BASE = np.uint64(0x9E3779B97F4A7C15)
OVERLAP = "doc_id long, item_id long, tiles int, covered int, item_tokens int, coverage double"


def tokens_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct tokens, the tokens of all texts in turn as their numbers, and where texts begin."""
    words = pc.utf8_split_whitespace(pc.fill_null(texts, ""))
    coded = words.flatten().dictionary_encode()
    plain = pc.replace_substring_regex(pc.utf8_lower(coded.dictionary), r"[^\p{L}\p{N}]+", "")
    again = plain.dictionary_encode()
    numbers = again.indices.to_numpy(zero_copy_only=False)[coded.indices.to_numpy(zero_copy_only=False)]
    distinct = again.dictionary
    offsets = words.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    offsets = offsets - offsets[0]
    empty = pc.index(distinct, pa.scalar("", distinct.type)).as_py()
    if empty >= 0:
        there = numbers != empty
        offsets = np.append(0, np.cumsum(there))[offsets]
        numbers = numbers[there]
    return distinct, numbers, offsets


def rolling(numbers: np.ndarray, size: int) -> np.ndarray:
    """Hash of each window of `size` numbers, modulo 2^64."""
    n = len(numbers) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    values = (numbers.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    values ^= values >> np.uint64(32)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total = total * BASE + values[k : k + n]
    return total


class Items:
    """A block of benchmark items, ready to be looked for."""

    def __init__(self, ids: tuple[int | None, ...], texts: tuple[str | None, ...], least: int):
        distinct, self.numbers, self.offsets = tokens_of(pa.array(texts, pa.string()))
        self.words = distinct
        self.ids, self.least = ids, least
        lengths = np.diff(self.offsets)
        self.grams = []  # by window size: sorted hashes, their items and places
        for size in sorted(set(np.minimum(lengths[lengths > 0], least).tolist())):
            hashes, items, places = [], [], []
            for k in np.flatnonzero(np.minimum(lengths, least) == size):
                own = rolling(self.numbers[self.offsets[k] : self.offsets[k + 1]], size)
                hashes.append(own)
                items.append(np.full(len(own), k))
                places.append(np.arange(len(own)))
            hashes = np.concatenate(hashes)
            order = np.argsort(hashes, kind="stable")
            self.grams.append((size, hashes[order], np.concatenate(items)[order], np.concatenate(places)[order]))

    def overlaps(self, texts: pa.Array, coverage: float) -> Iterator[tuple[int, int | None, int, int, int]]:
        """(row, item id, tiles, covered tokens, tokens) of pairs that reach `coverage`."""
        distinct, numbers, offsets = tokens_of(texts)
        known = pc.index_in(distinct, value_set=self.words).fill_null(-1).to_numpy(zero_copy_only=False)
        tokens = known.astype(np.int64)[numbers] if len(numbers) else np.zeros(0, np.int64)
        for size, hashes, items, places in self.grams:
            n = len(tokens) - size + 1
            if n <= 0:
                continue
            # Only windows of the items' own words, all of one text, can be hit.
            foreign = np.append(0, np.cumsum(tokens < 0))
            starts = np.flatnonzero(foreign[size:] == foreign[:n])
            rows = np.searchsorted(offsets, starts, side="right") - 1
            whole = starts + size <= offsets[rows + 1]
            starts, rows = starts[whole], rows[whole]
            if not len(starts):
                continue
            windows = rolling(tokens, size)[starts]
            low, high = (np.searchsorted(hashes, windows, side=s) for s in ("left", "right"))
            hit = high > low
            starts, rows, low, high = starts[hit], rows[hit], low[hit], high[hit]
            # What a text covers of an item does not depend on how often it has a window, so each window
            # of a text is looked up once: for many equal ones there is no row of its own.
            order = np.lexsort((low, rows))
            once = order[(np.diff(rows[order], prepend=-1) != 0) | (np.diff(low[order], prepend=-1) != 0)]
            counts = np.bincount(rows[once], high[once] - low[once], len(offsets) - 1)
            for some in portions(np.flatnonzero(counts), counts, SEEDS):
                own = once[np.isin(rows[once], some)]
                count = high[own] - low[own]
                at = own[np.repeat(np.arange(len(own)), count)]
                pick = low[at] + np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
                seen = np.stack([rows[at], items[pick], places[pick], low[at]])
                seen = seen[:, np.lexsort(seen[2::-1])]
                pairs = np.flatnonzero(np.diff(seen[0], prepend=-1) | np.diff(seen[1], prepend=-1))
                for a, b in zip(pairs, [*pairs[1:], seen.shape[1]], strict=True):
                    row, item = int(seen[0, a]), int(seen[1, a])
                    wanted = self.numbers[self.offsets[item] : self.offsets[item + 1]]
                    need = coverage * len(wanted) - 1e-9
                    reach = np.zeros(len(wanted) + 1, np.int64)
                    reach[seen[2, a:b]] += 1
                    np.add.at(reach, seen[2, a:b] + size, -1)
                    if (np.cumsum(reach) > 0).sum() < need:
                        continue
                    first, last = np.searchsorted(rows, [row, row + 1])
                    text = tokens[offsets[row] : offsets[row + 1]]
                    runs = equal_runs(text, wanted, starts[first:last] - offsets[row], low[first:last], seen[2, a:b], seen[3, a:b], size)
                    marked, tiles = tile(len(text), len(wanted), runs, size)
                    if marked >= need:
                        yield row, self.ids[item], tiles, marked, len(wanted)


def portions(rows: np.ndarray, counts: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """`rows` in turn, so many at once that their counts add up to `most`; one row at least."""
    first = 0
    while first < len(rows):
        total = np.cumsum(counts[rows[first:]])
        n = max(1, int(np.searchsorted(total, most, side="right")))
        yield rows[first : first + n]
        first += n


def equal_runs(
    text: np.ndarray, item: np.ndarray, at: np.ndarray, name: np.ndarray, place: np.ndarray, own: np.ndarray, least: int
) -> np.ndarray:
    """(length, place in the item, place in the text) of all longest equal runs of `least` tokens and more.

    Windows of one name (`name` of the text's at `at`, `own` of the item's at `place`) are equal, if their
    hashes do not deceive; tokens are compared. Pairs of equal windows are made for some diagonals at a
    time, at most SEEDS of them, so two long texts of one word take no more memory than others.
    """
    width = len(item) + 1
    names, which = np.unique(own, return_inverse=True)
    keys = np.sort(which * width + place)
    of = np.minimum(np.searchsorted(names, name), len(names) - 1)
    there = names[of] == name
    at, of = at[there], of[there]
    order = np.argsort(at)
    at, base = at[order], of[order] * width
    found = [np.zeros((3, 0), np.int64)]
    if len(at):
        total = (np.searchsorted(keys, base + width) - np.searchsorted(keys, base)).sum()
        begin, end = int(at[0]) - len(item), int(at[-1]) + 1
        step = end - begin if total <= SEEDS else max(1, SEEDS // len(item))
        for low in range(begin, end, step):  # diagonals are numbered by place in the text less place in the item
            part = slice(*np.searchsorted(at, [low, low + step + len(item)]))
            t, b = at[part], base[part]
            first = np.searchsorted(keys, b + np.clip(t - low - step + 1, 0, len(item)))
            count = np.maximum(np.searchsorted(keys, b + np.clip(t - low + 1, 0, len(item))) - first, 0)
            pick = np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())
            p, t = keys[pick] - np.repeat(b, count), np.repeat(t, count)
            same = np.ones(len(t), bool)
            for k in range(least):
                same &= text[t + k] == item[p + k]
            p, t = p[same], t[same]
            order = np.lexsort((p, t - p))
            p, t = p[order], t[order]
            breaks = np.flatnonzero((np.diff(t - p, prepend=-(1 << 60)) != 0) | (np.diff(p, prepend=-9) != 1))
            found.append(np.stack([np.diff(breaks, append=len(p)) + least - 1, p[breaks], t[breaks]]))
    return np.concatenate(found, axis=1)


def tile(text_length: int, item_length: int, runs: np.ndarray, least: int) -> tuple[int, int]:
    """Marked tokens and tiles of a text and an item, from their equal runs.

    Of runs that are equally long, the first in the item and then in the text goes first. What is left
    of a run that meets marked tokens waits for its turn by its own length.
    """
    runs = runs[:, np.lexsort((runs[2], runs[1], -runs[0]))]
    rest: list[tuple[int, int, int]] = []
    in_text, in_item = np.zeros(text_length, bool), np.zeros(item_length, bool)
    marked = tiles = following = 0
    while marked < item_length and (rest or following < runs.shape[1]):
        whole = (-int(runs[0, following]), int(runs[1, following]), int(runs[2, following])) if following < runs.shape[1] else None
        if whole is None or (rest and rest[0] < whole):
            length, p, t = heapq.heappop(rest)
        else:
            length, p, t = whole
            following += 1
        length = -length
        free = ~(in_text[t : t + length] | in_item[p : p + length])
        if free.all():
            in_text[t : t + length] = in_item[p : p + length] = True
            marked, tiles = marked + length, tiles + 1
            continue
        edges = np.flatnonzero(np.diff(np.concatenate([[0], free.view(np.int8), [0]])))
        for a, b in edges.reshape(-1, 2).tolist():
            if b - a >= least:
                heapq.heappush(rest, (-(b - a), p + a, t + a))
    return marked, tiles


@lru_cache(maxsize=2)
def prepared(ids: tuple, texts: tuple, least: int) -> Items:
    return Items(ids, texts, least)


def item_blocks(benchmark: DataFrame, id_column: str, text_column: str, chars: int) -> Iterator[tuple[tuple, tuple]]:
    """The benchmark's ids and texts in blocks of some `chars` characters, dealt by hash."""
    rows = benchmark.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    total = rows.agg(F.sum(F.length("text")).alias("n")).first().n or 0
    blocks = -(-total // chars)
    for k in range(blocks):
        own = rows if blocks == 1 else rows.filter(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == k)
        block = sorted(own.collect(), key=lambda r: (r.id is None, r.id or 0, r.text or ""))
        yield tuple(r.id for r in block), tuple(r.text for r in block)


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    coverage: float = COVERAGE,
    least: int = LEAST,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_id_column: str = "item_id",
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """One row for each document and item whose tiles cover `coverage` of the item's tokens.

    Null and empty texts, and items without tokens, match nothing. Repeated documents or items each
    have rows of their own; null ids stay null.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    found = spark.createDataFrame([], OVERLAP)
    for block in item_blocks(benchmark, item_id_column, "text", block_chars):
        sent = spark.sparkContext.broadcast(block)

        def look(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            items = prepared(*sent.value, least)
            for part in text_slices(batches, "text"):
                ids = part.column(0).to_pylist()
                out = [(ids[r], i, t, m, n, m / n) for r, i, t, m, n in items.overlaps(part.column(1), coverage)]
                if out:
                    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.float64()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
                        names=[c.split()[0] for c in OVERLAP.split(", ")],
                    )

        found = found.unionAll(rows.mapInArrow(giving_back(look), OVERLAP))
    return found


def without_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    coverage: float = COVERAGE,
    least: int = LEAST,
    text_column: str = "text",
    item_id_column: str = "item_id",
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """The rows of `docs` in which no item reaches `coverage`, with all their columns."""
    spark = docs.sparkSession
    for block in item_blocks(benchmark, item_id_column, "text", block_chars):
        sent = spark.sparkContext.broadcast(block)

        docs = docs.filter(~_leaks(sent, coverage, least)(F.col("`" + text_column.replace("`", "``") + "`")))
    return docs


def _leaks(sent: Broadcast, coverage: float, least: int) -> Callable:
    """A function of a text: whether an item of the block reaches `coverage`."""

    @F.arrow_udf("boolean")
    def leaks(texts: pa.Array) -> pa.Array:
        items = prepared(*sent.value, least)
        flags = np.zeros(len(texts), bool)
        first = 0
        batch = pa.RecordBatch.from_arrays([texts.cast(pa.string())], names=["text"])
        for part in text_slices([batch], "text"):
            for row, *_ in items.overlaps(part.column(0), coverage):
                flags[first + row] = True
            first += part.num_rows
        return pa.array(flags)

    return leaks
