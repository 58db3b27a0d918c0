"""Fingerprints from prefix polynomial hashes.

The prefix array of a text is S[i] = sum of (c_j + 1) * B^j over the code points c_j before i, by
two moduli near 2^31. Two spans of equal length are equal if their hashes agree after each is
shifted by the other's start: (S[i+n] - S[i]) * B^j = (S'[j+n] - S'[j]) * B^i. The longest common
extension of two positions is found by binary search over n.

A fingerprint is short: the length, the whole text's hashes, the hashes of prefixes that end at
the multiples of a power of two, and of suffixes likewise (the power is the smallest that gives at
most `RUNGS` of them), how many different spans of SPAN code points the text has, and the smallest
`SAMPLE` of their hashes. Equal texts have equal fingerprints, texts of another length or hash other
ones.

Two fingerprints are likened by what they hold, the same both ways: 1 for equal texts, else the larger
of two shares of the longer text. One is the longest common prefix and suffix among the rungs
that both have, by binary search; it is exact to a rung. The other is the share of common spans, wherever
they stand, told from the samples; it is exact if both texts have at most SAMPLE spans.

Where both texts' prefix arrays are at hand, spans that follow each other in both are counted: past each
difference, the next place at which SPAN code points are in both texts, in order, is found by their
hashes and extended to either side. Common spans of 2 * SPAN - 1 code points hold such a place.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.tables import text_slices

#: Moduli (primes) and bases. Products of two residues stay below 2^63.
MODULI = (2147483647, 2147483629)
BASES = (911382323, 972663749)
#: Most prefixes, and most suffixes, that a fingerprint holds.
RUNGS = 32
#: Code points whose hashes are looked up in the other text, and sampled.
SPAN = 16
#: Span hashes that a fingerprint holds, at most.
SAMPLE = 128

_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(k: int, n: int) -> np.ndarray:
    """B^0 .. B^(n-1) by the k-th modulus; kept, and doubled when longer ones are asked for."""
    known = _powers[k]
    while len(known) < n:
        step = np.uint64(pow(BASES[k], len(known), MODULI[k]))
        known = np.concatenate([known, known * step % np.uint64(MODULI[k])])
    _powers[k] = known
    return known[:n]


_inverses: list[np.ndarray] = [np.ones(1, np.uint64)]


def inverses(n: int) -> np.ndarray:
    """B^0 .. B^-(n-1) by the first modulus; kept like powers."""
    known = _inverses[0]
    while len(known) < n:
        step = np.uint64(pow(BASES[0], -len(known), MODULI[0]))
        known = np.concatenate([known, known * step % np.uint64(MODULI[0])])
    _inverses[0] = known
    return known[:n]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), "<u4")


class PrefixHashes:
    """Prefix arrays of one text by both moduli."""

    def __init__(self, codes: np.ndarray):
        self.n = len(codes)
        self.arrays = []
        self._spans: np.ndarray | None = None
        values = codes.astype(np.uint64) + np.uint64(1)
        for k, modulus in enumerate(MODULI):
            terms = values * powers(k, self.n) % np.uint64(modulus)
            sums = np.zeros(self.n + 1, np.uint64)
            np.cumsum(terms, out=sums[1:])  # below 2^31 each, so 2^33 code points fit
            sums %= np.uint64(modulus)
            self.arrays.append(sums)

    def span(self, k: int, start: int, n: int) -> int:
        """The k-th hash of a span, still times B^start."""
        sums = self.arrays[k]
        return (int(sums[start + n]) - int(sums[start])) % MODULI[k]

    def equal(self, start: int, other: PrefixHashes, at: int, n: int) -> bool:
        """Whether n code points from `start` equal those of `other` from `at`."""
        if n <= 0:
            return True
        if start + n > self.n or at + n > other.n:
            return False
        return all(
            self.span(k, start, n) * pow(BASES[k], at, m) % m
            == other.span(k, at, n) * pow(BASES[k], start, m) % m
            for k, m in enumerate(MODULI)
        )

    def extension(self, start: int, other: PrefixHashes, at: int) -> int:
        """Length of the longest common extension to the right of the two positions."""
        low, high = 0, min(self.n - start, other.n - at)
        while low < high:
            middle = (low + high + 1) // 2
            if self.equal(start, other, at, middle):
                low = middle
            else:
                high = middle - 1
        return low

    def extension_back(self, end: int, other: PrefixHashes, at: int, most: int) -> int:
        """Length of the longest common extension to the left of the two positions, `most` at most."""
        low, high = 0, most
        while low < high:
            middle = (low + high + 1) // 2
            if self.equal(end - middle, other, at - middle, middle):
                low = middle
            else:
                high = middle - 1
        return low

    def spans(self) -> np.ndarray:
        """Hashes by the first modulus of SPAN code points from every place; kept."""
        if self._spans is None:
            sums, modulus = self.arrays[0], np.uint64(MODULI[0])
            there = max(self.n - SPAN + 1, 0)
            sums = (sums[SPAN : SPAN + there] + modulus - sums[:there]) % modulus
            self._spans = sums * inverses(there) % modulus
        return self._spans

    def shared(self, other: PrefixHashes) -> int:
        """Code points in common spans that follow each other in both texts.

        These are the common prefix and suffix and, between them, from left to right the nearest spans.
        """
        total = self.extension(0, other, 0)
        i = j = total
        suffix = self.extension_back(self.n, other, other.n, min(self.n, other.n) - total)
        end, other_end = self.n - suffix, other.n - suffix
        first = -(-j // SPAN) * SPAN
        keys = other.spans()[first : max(other_end - SPAN + 1, 0) : SPAN]
        own = self.spans()[i : max(end - SPAN + 1, 0)]
        if not len(keys) or not len(own):
            return total + suffix
        order = np.argsort(keys, kind="stable")  # places of equal hashes ascend
        keys, base = keys[order], i
        at = np.searchsorted(keys, own)
        for k in np.flatnonzero(keys[np.minimum(at, len(keys) - 1)] == own):
            start = base + int(k)
            if start < i:
                continue
            low, high = at[k], np.searchsorted(keys, own[k], side="right")
            nearest = low + np.searchsorted(order[low:high], -(-(j - first) // SPAN))
            if nearest == high:
                continue
            place = first + int(order[nearest]) * SPAN
            n = min(self.extension(start, other, place), end - start, other_end - place)
            if n < SPAN:
                continue  # not equal by the second modulus
            total += n + self.extension_back(start, other, place, min(start - i, place - j))
            i, j = start + n, place + n
        return total + suffix

    def fingerprint(self) -> Fingerprint:
        n, step = self.n, 1
        while n // step > RUNGS:
            step *= 2
        ends = np.arange(1, n // step + 1, dtype=np.int64) * step
        prefixes, suffixes = [], []
        for k, (sums, modulus) in enumerate(zip(self.arrays, MODULI, strict=True)):
            prefixes.append(sums[ends])
            # A suffix of length e starts at n - e: divide its hash by B^(n - e), that is, multiply
            # by B^e and divide all alike by B^n.
            lift = powers(k, n + 1)[ends] * np.uint64(pow(BASES[k], -n, modulus)) % np.uint64(modulus)
            rest = (sums[n] + np.uint64(modulus) - sums[n - ends]) % np.uint64(modulus)
            suffixes.append(rest * lift % np.uint64(modulus))
        whole = tuple(int(sums[n]) for sums in self.arrays)
        pair = lambda a: a[0] << np.uint64(32) | a[1]
        kinds = np.sort(self.spans().astype(np.uint32))
        kinds = kinds[np.diff(kinds, prepend=np.uint32(2**32 - 1)) != 0]  # no hash is so large
        return Fingerprint(n, whole, step, pair(prefixes), pair(suffixes), len(kinds), kinds[:SAMPLE])


@dataclass
class Fingerprint:
    n: int
    whole: tuple[int, int]
    step: int
    prefixes: np.ndarray
    suffixes: np.ndarray
    kinds: int
    sample: np.ndarray

    def __str__(self) -> str:
        rungs = np.concatenate([self.prefixes, self.suffixes]).astype(">u8").tobytes().hex()
        sample = self.sample.astype(">u4").tobytes().hex()
        return f"{self.n:x}-{self.whole[0]:08x}{self.whole[1]:08x}-{rungs}-{self.kinds:x}-{sample}"

    @staticmethod
    def parse(text: str) -> Fingerprint:
        n, whole, rungs, kinds, sample = text.split("-")
        step = 1
        while int(n, 16) // step > RUNGS:
            step *= 2
        values = np.frombuffer(bytes.fromhex(rungs), ">u8").astype(np.uint64)
        half = len(values) // 2
        spans = np.frombuffer(bytes.fromhex(sample), ">u4").astype(np.uint32)
        return Fingerprint(
            int(n, 16), (int(whole[:8], 16), int(whole[8:], 16)), step, values[:half], values[half:], int(kinds, 16), spans
        )

    def likeness(self, other: Fingerprint) -> float:
        """1 for equal texts, else what the texts share over the longer one's length."""
        longest = max(self.n, other.n)
        if self.n == other.n and self.whole == other.whole:
            return 1.0
        step = max(self.step, other.step)
        ends = [
            step * _agreeing(a[step // self.step - 1 :: step // self.step], b[step // other.step - 1 :: step // other.step])
            for a, b in ((self.prefixes, other.prefixes), (self.suffixes, other.suffixes))
        ]
        # Unequal texts cannot share all of the longer one.
        return min(max(sum(ends), self.common_spans(other) * longest), min(self.n, other.n), longest - 1) / longest

    def common_spans(self, other: Fingerprint) -> float:
        """Common spans over those of the text that has more; of spans that a text repeats, one counts."""
        if not len(self.sample) or not len(other.sample):
            return 0.0
        either, times = np.unique(np.concatenate([self.sample, other.sample]), return_counts=True)
        if self.kinds > SAMPLE or other.kinds > SAMPLE:
            times = times[:SAMPLE]  # beyond, a sample may lack what its text has
        both = np.count_nonzero(times == 2) / len(times)
        return float(both / (1 + both) * (self.kinds + other.kinds) / max(self.kinds, other.kinds))


def _agreeing(a: np.ndarray, b: np.ndarray) -> int:
    """How many rungs agree from the first; a prefix that agrees agrees below, so bisect."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[middle - 1] == b[middle - 1]:
            low = middle
        else:
            high = middle - 1
    return low


def fingerprint(text: str) -> str:
    return str(PrefixHashes(code_points(text)).fingerprint())


def fingerprints(docs: DataFrame, text_column: str = "text", out_column: str = "fingerprint") -> DataFrame:
    """Add each text's fingerprint; a null text counts as empty. Rows and columns stay."""

    @F.arrow_udf("string")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(t or "") for t in texts.to_pylist()], pa.string())

    return docs.withColumn(out_column, of(F.col(text_column)))


def common_extensions(pairs: DataFrame, left: str, right: str, left_at: str, right_at: str) -> DataFrame:
    """Add `extension` (long) to rows of two texts and a code-point position in each.

    Null texts are empty; a null position, or one outside its text, has extension 0.
    """

    @F.arrow_udf("long")
    def of(a: pa.Array, b: pa.Array, i: pa.Array, j: pa.Array) -> pa.Array:
        out = []
        for x, y, p, q in zip(*(c.to_pylist() for c in (a, b, i, j)), strict=True):
            x, y = x or "", y or ""
            inside = p is not None and q is not None and 0 <= p <= len(x) and 0 <= q <= len(y)
            out.append(PrefixHashes(code_points(x)).extension(p, PrefixHashes(code_points(y)), q) if inside else 0)
        return pa.array(out, pa.int64())

    return pairs.withColumn("extension", of(F.col(left), F.col(right), F.col(left_at), F.col(right_at)))


EDITED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, next_fingerprint string, shared_edited long, shared_next long"
)


def in_successor_blocks(docs: DataFrame, id_column: str, text_column: str, blocks: int) -> DataFrame:
    """Rows (block, doc_id, text, ahead): ids in ranges, each with a copy of what follows it.

    The last document of a block is followed by the first of the next block that has any, and the
    very last by the very first, so that copy is added to the block, marked `ahead`. Only the
    blocks' bounds pass the driver: `blocks` numbers at most.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    ids = rows.select("doc_id").filter(F.col("doc_id").isNotNull())
    cuts = sorted(set(ids.approxQuantile("doc_id", [k / blocks for k in range(1, blocks)], 0.2 / blocks)))
    bounds = np.array([int(c) for c in cuts], np.int64)

    @F.arrow_udf("int")
    def block_of(values: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(bounds, values.to_numpy(zero_copy_only=False), side="right"), pa.int32())

    dealt = rows.filter(F.col("doc_id").isNotNull()).withColumn("block", block_of("doc_id"))
    firsts = sorted(
        (r.block, r.first)
        for r in ids.withColumn("block", block_of("doc_id")).groupBy("block").agg(F.min("doc_id").alias("first")).collect()
    )
    order = [block for block, _ in firsts]
    before = {first: order[k - 1] for k, (_, first) in enumerate(firsts)}
    heads = np.array(sorted(before), np.int64)
    owners = np.array([before[first] for first in sorted(before)], np.int32)

    @F.arrow_udf("int")
    def looked_at_from(values: pa.Array) -> pa.Array:
        ids = values.to_numpy(zero_copy_only=False)
        at = np.searchsorted(heads, ids)
        hit = (at < len(heads)) & (heads[np.minimum(at, len(heads) - 1)] == ids) if len(heads) else np.zeros(len(ids), bool)
        return pa.array(owners[np.minimum(at, max(len(heads) - 1, 0))] if len(heads) else np.zeros(0), pa.int32(), mask=~hit)

    own = F.struct(F.col("block"), F.lit(False).alias("ahead"))
    ahead = F.struct(F.col("looked").alias("block"), F.lit(True).alias("ahead"))
    return (
        dealt.withColumn("looked", looked_at_from("doc_id"))
        .withColumn(
            "place", F.explode(F.when(F.col("looked").isNull(), F.array(own)).otherwise(F.array(own, ahead)))
        )
        .select("place.block", "doc_id", "text", "place.ahead")
    )


def edited_by_successor(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", blocks: int | None = None
) -> DataFrame:
    """Fingerprint every text, its successor's, and the text with its second half overwritten.

    The successor is the next row in ascending (id, text) order; after the last comes the first.
    The last floor(n/2) code points are replaced by the first as many of the successor (all, if it
    has fewer). near_edited and near_next are the likenesses of the fingerprint to those two, and follow from
    the returned strings; shared_edited and shared_next count code points in spans that both texts have in one
    order. Null texts are empty. Rows without an id have no place in the order and are
    returned with null in all columns but n_chars and fingerprint. Repeated rows follow each
    other. An empty table gives no rows.
    """
    spark = docs.sparkSession
    blocks = blocks or 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [
                (name, {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}[kind])
                for name, kind in (c.split() for c in EDITED.split(", "))
            ]
        )
        last = None  # the row before, whose successor is still to come
        for part in text_slices(batches, "text"):
            out = []
            texts = pc.fill_null(part.column(2), "").to_pylist()
            rows = zip(part.column(0).to_pylist(), part.column(1).to_pylist(), texts, part.column(3).to_pylist(), strict=True)
            for block, doc_id, text, ahead in rows:
                codes = code_points(text)
                hashes = PrefixHashes(codes)
                mark = hashes.fingerprint()
                if last is not None and last[0] == block:
                    out.append(_edited(*last[1:], codes, hashes, mark))
                last = None if ahead else (block, doc_id, codes, hashes, mark)
            columns = list(zip(*out, strict=True)) or [()] * len(schema)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
            )

    dealt = in_successor_blocks(docs, id_column, text_column, blocks)
    known = (
        dealt.repartition("block")
        .sortWithinPartitions("block", "ahead", "doc_id", "text")
        .select("block", "doc_id", "text", "ahead")
        .mapInArrow(compare, EDITED)
    )
    nameless = fingerprints(
        docs.filter(F.col(id_column).isNull()).select(F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    ).select(
        F.lit(None).cast("long").alias("doc_id"), F.length("text").cast("long").alias("n_chars"),
        F.lit(None).cast("string").alias("edited_sha256"), "fingerprint",
        F.lit(None).cast("string").alias("edited_fingerprint"), F.lit(None).cast("double").alias("near_edited"),
        F.lit(None).cast("double").alias("near_next"), F.lit(None).cast("string").alias("next_fingerprint"),
        F.lit(None).cast("long").alias("shared_edited"), F.lit(None).cast("long").alias("shared_next"),
    )
    return known.unionAll(nameless)


def _edited(
    doc_id: int, codes: np.ndarray, hashes: PrefixHashes, mark: Fingerprint,
    following: np.ndarray, next_hashes: PrefixHashes, next_mark: Fingerprint,
) -> tuple:
    half = len(codes) // 2
    edited = np.concatenate([codes[: len(codes) - half], following[:half]])
    edited_hashes = PrefixHashes(edited)
    edited_mark = edited_hashes.fingerprint()
    digest = hashlib.sha256(edited.tobytes().decode("utf-32-le").encode()).hexdigest()
    return (
        doc_id, len(codes), digest, str(mark), str(edited_mark), mark.likeness(edited_mark), mark.likeness(next_mark),
        str(next_mark), hashes.shared(edited_hashes), hashes.shared(next_hashes),
    )
