import random
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from orderlake.llm import simhash


def brute_fingerprint(text, shingle=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in low + " ":
        if c in " \t\n\x0b\x0c\r":
            words += [word] if word else []
            word = ""
        else:
            word += c
    if not words:
        return 0
    parts = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64(p.encode(), 42).intdigest() for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(values, most):
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in combinations(root, 2):
        if bin(a ^ b).count("1") <= most:
            root[find(a)] = find(b)
    groups = {}
    for v in root:
        groups.setdefault(find(v), set()).add(v)
    return sorted(map(sorted, groups.values()))


@pytest.mark.parametrize(
    "text", ["", None, " \n\t", "one", "One TWO three", "a b c d e É ß\x0bx y", "the same words " * 40, "Ä b c d"]
)
def test_fingerprint(text):
    assert simhash.text_fingerprint((text or "").encode(), 4) == brute_fingerprint(text)


def test_fingerprints_use_sparks_hash(spark):
    text = "w x y z"
    hashed = spark.range(1).select(F.xxhash64(F.lit(text))).first()[0]
    assert hashed % 2**64 == xxhash.xxh64_intdigest(text.encode(), 42)


@pytest.mark.parametrize("most", [0, 1, 4, 6])
def test_classes_equal_all_pairs(spark, most, monkeypatch):
    draw = random.Random(most)
    values = {draw.getrandbits(64) for _ in range(150)} | {0, 2**64 - 1, 2**63}
    for _ in range(300):  # chains and crowds of near copies
        v = draw.choice(sorted(values))
        for b in draw.sample(range(64), draw.randint(1, 5)):
            v ^= 1 << b
        values.add(v)
    center = draw.getrandbits(64)
    values |= {center ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(20)}
    monkeypatch.setattr(simhash, "BLOCK", 16)
    df = spark.createDataFrame([(simhash.signed(v),) for v in values], "fingerprint long")
    found = {}
    for row in simhash.fingerprint_classes(df, most).collect():
        found.setdefault(row["class"], set()).add(row.fingerprint % 2**64)
    assert sorted(map(sorted, found.values())) == brute_classes(values, most)


def test_every_plan_keeps_the_pigeonhole():
    rng = np.random.default_rng(0)
    bits = rng.random((500, 64)) < rng.random(64)
    joint = bits.T.astype(float) @ bits
    for n in (10, 10_000, 10**9):
        for most in range(1, 8):
            parts = simhash.plan(n, joint, most)
            assert sum(p.threshold + 1 for p in parts) == most + 1
            masks = [p.mask for p in parts]
            assert all(a & b == 0 for a, b in combinations(masks, 2))


def test_allocation_is_the_cheapest():
    costs = [[3.0, 5.0, 9.0], [1.0, 8.0, 20.0], [2.0, 2.5, 4.0]]
    from itertools import product

    best = min(
        (sum(c[t] for c, t in zip(costs, ts, strict=True) if t >= 0), ts)
        for ts in product(range(-1, 3), repeat=3)
        if sum(ts) == 1
    )
    chosen = simhash.allocate(costs, 1)
    assert sum(c[t] for c, t in zip(costs, chosen, strict=True) if t >= 0) == best[0]


def test_near_duplicates_edges(spark):
    long = " ".join(f"w{i % 977}" for i in range(60_000))
    rows = [
        (5, "a b c d e f", "x"), (3, "A B c d  e\tf", "y"), (3, "A B c d  e\tf", "y"), (7, None, "z"), (8, "", "z"),
        (9, " \n ", None), (None, "a b c d e f", "n"), (None, "only nameless rows", "n"), (1, long, "l"), (2, long, "l"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, class string").withColumn("fingerprint", F.lit("old"))
    found = simhash.near_duplicates(docs).collect()
    assert len(found) == len(rows)
    by = {(r.doc_id, r.text): r.component_id for r in found}
    assert by[5, "a b c d e f"] == by[3, "A B c d  e\tf"] == by[None, "a b c d e f"] == 3
    assert by[7, None] == by[8, ""] == by[9, " \n "] == 7
    assert by[None, "only nameless rows"] is None and by[2, long] == 1
    assert {r.fingerprint for r in found if not (r.text or "").split()} == {0}

    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or -1, r["class"]) for r in kept.collect()) == [(-1, "n"), (1, "l"), (3, "y"), (7, "z")]
    assert simhash.near_duplicates(docs.limit(0)).collect() == [] == simhash.one_of_each(docs.limit(0)).collect()
