"""SimHash near-duplicates by the generalised pigeonhole principle.

A fingerprint has 64 bits, each 1 if it is set in over half the XXH64 hashes of a text's word
shingles. Two fingerprints within `max_bits` differing bits are linked; classes are the components.

Search: the bits are grouped into m partitions, those that go together in one, and partition i gets
a threshold t_i >= -1 such that sum(t_i + 1) = max_bits + 1. If two fingerprints differed in over
t_i bits of every partition, they would differ in over max_bits bits; so it is enough to compare
those within t_i bits in some partition. -1 leaves a partition out. The thresholds are found by
dynamic programming over the estimated number of candidates and of probes, for each m, from the
bits' joint counts over all fingerprints.

Only distinct fingerprints are searched, so exact copies cost nothing. Fingerprints that agree in a
partition form a cell; crowded cells are cut into blocks, and pairs of blocks are compared and give
links that span their components, not all pairs. So a cell of any size is spread over tasks and a
group of near copies gives as many links as it has members, times the blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from math import comb, lgamma

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.components import components
from orderlake.llm.tables import byte_texts, giving_back, staged

BITS = 64
SEED = 42
#: Fingerprints of a block of a crowded cell, in the mean.
BLOCK = 256
#: A-Z to a-z, in bytes.
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def text_fingerprint(text: bytes, shingle: int) -> int:
    """The fingerprint of a UTF-8 text as an unsigned integer; of no words: zero.

    Words are runs without ASCII white space (as bytes.split takes it), A-Z lower-cased. A text
    of fewer words than a shingle has one shingle, all of them.
    """
    words = text.translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    else:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths + 1) - 1
        starts = (ends - lengths)[: len(words) - shingle + 1].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = np.array(
            [digest(joined[i:j], SEED) for i, j in zip(starts, ends[shingle - 1 :].tolist(), strict=True)], np.uint64
        )
    set_bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    counts = set_bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def with_fingerprints(docs: DataFrame, text_column: str, shingle: int, out_column: str = "fingerprint") -> DataFrame:
    """Add the fingerprint as a long with the same bits. A null text counts as empty."""

    @F.arrow_udf("long")
    def of(texts: pa.Array) -> pa.Array:
        values = np.array([text_fingerprint(t, shingle) for t in byte_texts(texts)], np.uint64)
        return pa.array(values.view(np.int64))

    return docs.withColumn(out_column, of(F.col(text_column)))


@dataclass
class Partition:
    mask: int
    threshold: int

    def flips(self) -> list[int]:
        """What turns a partition's bits into all others within its threshold, as signed longs."""
        bits = [1 << b for b in range(BITS) if self.mask >> b & 1]
        return [signed(sum(c)) for t in range(self.threshold + 1) for c in combinations(bits, t)]


def signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def bit_counts(fingerprints: DataFrame) -> tuple[int, np.ndarray]:
    """How many rows there are, and the 64 x 64 numbers of rows with both bits set."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, joint = 0, np.zeros((BITS, BITS))
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            joint += bits.T @ bits
            rows += len(values)
        if rows:
            yield pa.RecordBatch.from_pydict(
                {"cell": pa.array(range(BITS * BITS + 1), pa.int32()), "n": pa.array([*joint.ravel(), rows], pa.float64())}
            )

    sums = fingerprints.mapInArrow(giving_back(count), "cell int, n double").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    values = np.zeros(BITS * BITS + 1)
    for row in sums:
        values[row.cell] = row.n
    return int(values[-1]), values[:-1].reshape(BITS, BITS)


def correlated_groups(n: int, joint: np.ndarray, m: int) -> list[list[int]]:
    """All bits in m groups of near-equal size, each grown by the bit that goes best with it."""
    p = np.diag(joint) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    correlation = np.abs((joint / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread))
    free, groups = set(range(BITS)), []
    for k in range(m):
        size = BITS // m + (k < BITS % m)
        strength = {b: sum(correlation[b, c] for c in free if c != b) for b in free}
        group = [max(sorted(free), key=strength.__getitem__)]
        free.remove(group[0])
        while len(group) < size:
            best = max(sorted(free), key=lambda b: correlation[b, group].sum())
            group.append(best)
            free.remove(best)
        groups.append(sorted(group))
    return groups


def within(n: int, joint: np.ndarray, bits: list[int], most: int) -> list[float]:
    """Estimated share of pairs that differ in at most t of `bits`, for t from 0 to `most`.

    The mean and variance of the number of differing bits follow exactly from the joint counts;
    a beta-binomial law of that mean and variance gives the shares.
    """
    k = len(bits)
    p11 = joint[np.ix_(bits, bits)] / max(n, 1)
    p1 = np.diag(p11)
    p10 = p1[:, None] - p11
    p00 = 1 - p1[:, None] - p1[None, :] + p11
    both = 2 * (p11 * p00 + p10 * p10.T)
    differ = 2 * p1 * (1 - p1)
    np.fill_diagonal(both, differ)
    mean = differ.sum()
    variance = both.sum() - mean**2
    share = min(max(mean / k, 1e-9), 1 - 1e-9)
    rho = (variance / max(k * share * (1 - share), 1e-12) - 1) / max(k - 1, 1)
    rho = min(max(rho, 1e-6), 1 - 1e-6)
    alpha, beta = share * (1 - rho) / rho, (1 - share) * (1 - rho) / rho
    log_beta = lambda a, b: lgamma(a) + lgamma(b) - lgamma(a + b)
    law = [comb(k, t) * np.exp(log_beta(t + alpha, k - t + beta) - log_beta(alpha, beta)) for t in range(most + 1)]
    return np.minimum(np.cumsum(law), 1).tolist()


def allocate(costs: list[list[float]], total: int) -> list[int]:
    """Thresholds, one per partition and -1 at least, of sum `total` and least cost.

    `costs[i][t]` is what partition i costs at threshold t; at -1 it costs nothing.
    """
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for cost in costs:
        following: dict[int, tuple[float, list[int]]] = {}
        for spent, (so_far, chosen) in best.items():
            for units in range(len(cost) + 1):
                now = so_far + (cost[units - 1] if units else 0.0)
                if spent + units not in following or now < following[spent + units][0]:
                    following[spent + units] = (now, [*chosen, units - 1])
        best = following
    return best[total + len(costs)][1]


def plan(n: int, joint: np.ndarray, max_bits: int) -> list[Partition]:
    """The partitions and thresholds of least estimated cost, over 2 to max_bits + 1 partitions."""
    best: tuple[float, list[Partition]] | None = None
    for m in range(min(2, max_bits + 1), max_bits + 2):
        groups = correlated_groups(n, joint, m)
        costs = []
        for bits in groups:
            shares = within(n, joint, bits, max_bits)
            probes = np.cumsum([comb(len(bits), t) for t in range(max_bits + 1)])
            costs.append([n * n / 2 * s + n * float(q) for s, q in zip(shares, probes, strict=True)])
        chosen = allocate(costs, max_bits - m + 1)
        cost = sum(c[t] for c, t in zip(costs, chosen, strict=True) if t >= 0)
        if best is None or cost < best[0]:
            parts = [Partition(sum(1 << b for b in bits), t) for bits, t in zip(groups, chosen, strict=True)]
            best = cost, [p for p in parts if p.threshold >= 0]
    return best[1]


def links_between(a: np.ndarray, b: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that span the components of the fingerprints of two blocks (of one, if they are one)."""
    nodes = np.unique(np.concatenate([a, b]))
    near = np.bitwise_count(nodes[:, None] ^ nodes[None, :]) <= max_bits
    labels = np.arange(len(nodes))
    while True:
        lower = np.where(near, labels[None, :], len(nodes)).min(axis=1)
        lower = lower[lower]
        if (lower == labels).all():
            break
        labels = lower
    moved = labels != np.arange(len(nodes))
    return nodes[moved], nodes[labels[moved]]


def near_links(fingerprints: DataFrame, partitions: list[Partition], max_bits: int, block: int = BLOCK) -> DataFrame:
    """Links (a, b) that join all distinct fingerprints within `max_bits` bits, maybe through others."""
    parts = F.array(
        *[
            F.struct(F.lit(i).alias("part"), F.col("fingerprint").bitwiseAND(F.lit(signed(p.mask))).alias("key"))
            for i, p in enumerate(partitions)
        ]
    )
    members = fingerprints.select("fingerprint", F.explode(parts).alias("cell")).select("fingerprint", "cell.*")
    crowded = (
        members.groupBy("part", "key")
        .count()
        .filter(F.col("count") > block)
        .select("part", "key", F.ceil(F.col("count") / block).cast("int").alias("blocks"))
    )
    cells = staged(
        members.join(crowded, ["part", "key"], "left")
        .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .withColumn("block", F.pmod(F.xxhash64("fingerprint"), F.col("blocks")).cast("int"))
        .groupBy("part", "key", "block")
        .agg(F.collect_list("fingerprint").alias("own"), F.max("blocks").alias("blocks")),
        "simhash-cells",
    )
    flips = F.array(*[F.array(*[F.lit(f) for f in p.flips()]) for p in partitions])
    # A pair of cells is looked at from the side with the smaller key, a cell with itself once for
    # each two blocks; a lone fingerprint has nothing to be compared with in its own cell.
    probes = (
        cells.select("part", "key", "block", "blocks", "own", F.explode(flips[F.col("part")]).alias("flip"))
        .withColumn("to", F.col("key").bitwiseXOR(F.col("flip")))
        .filter("to > key or flip = 0 and (blocks > 1 or size(own) > 1)")
        .select("part", F.col("to").alias("key"), F.col("block").alias("from_block"), "flip", F.col("own").alias("other"))
    )
    pairs = cells.join(probes, ["part", "key"]).filter("flip <> 0 or from_block <= block").select("own", "other")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, other = batch.column(0), batch.column(1)
            # Unsigned: bitwise_count takes a signed number's absolute value.
            left, right = own.flatten().to_numpy().view(np.uint64), other.flatten().to_numpy().view(np.uint64)
            ends_left = np.cumsum(own.value_lengths().to_numpy(zero_copy_only=False))
            ends_right = np.cumsum(other.value_lengths().to_numpy(zero_copy_only=False))
            starts_left, starts_right = np.append(0, ends_left), np.append(0, ends_right)
            single = (np.diff(starts_left) == 1) & (np.diff(starts_right) == 1)
            a, b = left[starts_left[:-1][single]], right[starts_right[:-1][single]]
            near = np.bitwise_count(a ^ b) <= max_bits
            found_a, found_b = [a[near]], [b[near]]
            for k in np.flatnonzero(~single):
                x, y = links_between(
                    left[starts_left[k] : ends_left[k]], right[starts_right[k] : ends_right[k]], max_bits
                )
                found_a.append(x)
                found_b.append(y)
            a, b = (np.concatenate(found).view(np.int64) for found in (found_a, found_b))
            yield pa.RecordBatch.from_pydict({"a": a, "b": b})

    return pairs.mapInArrow(giving_back(compare), "a long, b long")


def fingerprint_classes(fingerprints: DataFrame, max_bits: int) -> DataFrame:
    """(fingerprint, class) for distinct fingerprints; class is one fingerprint per component."""
    if not 0 <= max_bits < BITS:
        raise ValueError("max_bits must be from 0 to 63")
    distinct = staged(fingerprints.select("fingerprint").distinct(), "simhash-fingerprints")
    n, joint = bit_counts(distinct)
    if n < 2 or max_bits == 0:
        return distinct.withColumn("class", F.col("fingerprint"))
    links = near_links(distinct, plan(n, joint, max_bits), max_bits)
    roots = components(links).select(F.col("node").alias("fingerprint"), F.col("root").alias("class"))
    return distinct.join(roots, "fingerprint", "left").withColumn("class", F.coalesce("class", "fingerprint"))


def near_duplicates(
    docs: DataFrame, shingle: int = 4, max_bits: int = 4, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """`docs` with `fingerprint`, `class` and `component_id`, the smallest id of the row's class.

    Texts without words, null ones included, have fingerprint zero and are linked like others.
    Rows without an id take part; a class of only such rows has a null component_id. Repeated rows
    are in one class. Columns of these names in `docs` are replaced. An empty table gives no rows.
    """
    docs = docs.drop("fingerprint", "class", "component_id")
    found = labelled(with_fingerprints(docs, text_column, shingle), max_bits, id_column)
    return found.select(*[F.col(_quoted(c)) for c in docs.columns], "fingerprint", "class", "component_id")


def labelled(marked: DataFrame, max_bits: int, id_column: str = "doc_id") -> DataFrame:
    """Rows that have a fingerprint with `class` and `component_id`; see `near_duplicates`."""
    marked = staged(marked, "simhash-documents")
    smallest = staged(
        marked.groupBy("fingerprint").agg(F.min(F.col(_quoted(id_column))).alias("smallest")), "simhash-smallest"
    )
    classes = staged(fingerprint_classes(smallest, max_bits), "simhash-classes")
    named = smallest.join(classes, "fingerprint")
    ids = named.groupBy("class").agg(F.min("smallest").alias("component_id"))
    labels = staged(named.select("fingerprint", "class").join(ids, "class"), "simhash-labels")
    return marked.join(labels, "fingerprint")


def one_of_each(
    docs: DataFrame, shingle: int = 4, max_bits: int = 4, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The row with the smallest id of each class, with the columns of `docs`.

    Of a class without ids one row stays, and of rows that repeat an id in a class.
    """
    rows = staged(
        with_fingerprints(docs.select(F.struct(*[F.col(_quoted(c)) for c in docs.columns]).alias("row"),
                                      F.col(_quoted(text_column)).alias("text")), "text", shingle)
        .select("row", F.struct(F.col("row")[id_column].alias("id"), F.col("fingerprint")).alias("name")),
        "simhash-documents",
    )
    named = rows.select(F.col("name.fingerprint").alias("fingerprint"), F.col("name.id").alias(id_column))
    first = F.min(F.struct(F.col(_quoted(id_column)).isNull(), F.col(_quoted(id_column)).alias("id"), "fingerprint"))
    kept = staged(
        labelled(named, max_bits, id_column)
        .groupBy("class")
        .agg(first.alias("first"))
        .select(F.struct("first.id", "first.fingerprint").alias("name")),
        "simhash-kept",
    )
    # The kept names grow with the documents, so they are never broadcast; rows that repeat a name
    # then lie together already.
    found = rows.join(kept.hint("merge"), "name", "left_semi").dropDuplicates(["name"])
    return found.select(*[F.col("row")[c].alias(c) for c in docs.columns])


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
