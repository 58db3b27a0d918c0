"""The conversation trie against a plain one, node by node."""

import hashlib
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from orderlake.llm import conversation_trie as ct
from tests.tools import comparable

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows, group=100, heads=6):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            pair = (role or "", text or "")
            token = ct.digest(f"{len(pair[0])}:{pair[0]}{pair[1]}")
            own.setdefault(c, []).append((turn is not None, turn or 0, token, pair))
    own = {c: [t[3] for t in sorted(turns)] for c, turns in own.items()}
    paths = {}
    for c, turns in own.items():
        base = c - (c % group if c >= 0 else -(-c % group))
        h = zlib.crc32(str(c).encode()) % heads
        paths[c] = own.get(base, [])[:h] + turns[h:]
    members = {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), []).append(c)
    kids, totals = {}, {}
    for node in members:
        if node:
            kids.setdefault(node[:-1], []).append(node)
    for node in sorted(members, key=len, reverse=True):
        saved = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        below = [totals[k] for k in kids.get(node, [])]
        totals[node] = (sum(b[0] for b in below) or 1, saved + sum(b[1] for b in below))
    return {
        (min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(kids.get(node, [])), *totals[node],
         hashlib.sha256(",".join(str(c) for c in sorted(m) if paths[c] == list(node)).encode()).hexdigest())
        for node, m in members.items()
    }


def built(spark, rows):
    table = spark.createDataFrame(rows, SCHEMA).repartition(7)
    table = table.withColumns({c: F.lit("clash") for c in ("depth", "node", "place", "token", "n_chars", "base")})
    found = ct.trie(*ct.rebuilt(ct.turns_in_order(table)))
    assert found.dtypes == [(n, "bigint") for n in found.columns[:-1]] + [("ends_sha256", "string")]
    return [tuple(r) for r in found.collect()]


def test_small_conversations_with_odd_rows(spark):
    draw = random.Random(4)
    rows = []
    for c in [-250, -7, -1, *range(90), 100, 101, 103, 150, 205, 299, 1 << 40]:
        for turn in range(draw.choice([1, 1, 2, 4, 7])):
            rows.append((c, draw.choice([turn, turn, None, 0]), draw.choice(["user", "assistant", None]), draw.choice(["a", "", None, "é😀", "b b"])))
    rows += rows[:40] + [(None, 1, "user", "nobody's"), (500, None, None, None)]
    got = built(spark, rows)
    assert len(got) == len(set(got)) and set(got) == brute(rows)
    assert any(r[1] == 0 and r[7] != hashlib.sha256(b"").hexdigest() for r in got)  # some have no turn left


def test_long_conversations_and_a_hot_one(spark):
    """Sequences over several runs that part in the middle of one, at a run's end and after it."""
    line = [("user" if k % 2 else "assistant", f"turn {k % 5}") for k in range(1300)]
    rows = []
    for c, n, own in [(0, 1300, 1300), (1, 1300, 700), (2, 600, 512), (3, 512, 512), (4, 513, 511), (5, 256, 256), (6, 257, 100)]:
        rows += [(c, k, *line[k]) if k < own else (c, k, "user", f"{c} on its own {k}") for k in range(n)]
    rows += [(c, 0, "user", "hot") for c in range(1000, 1400)]
    got = built(spark, rows)
    assert len(got) == len(set(got)) and set(got) == brute(rows)


def test_no_conversations(spark):
    assert built(spark, []) == []
    assert built(spark, [(None, 1, "user", "x")]) == []


def test_names_are_of_whole_prefixes():
    tokens = [ct.digest(str(k % 3)) for k in range(256)]
    whole = ct.halved("", tokens)
    for n in (0, 1, 2, 5, 128, 129, 255):
        assert ct.halved("", tokens[:n]) == whole[:n]
    assert len(set(whole)) == 256
    other = ct.halved("", ["x", *tokens[1:]])
    assert not set(other) & set(whole) and ct.halved("else", tokens)[0] != whole[0]


def test_a_long_conversation_is_in_many_tasks(spark):
    """The numbering sorts over all tasks: no task holds most of a conversation that has most rows."""
    rows = spark.range(40_000).select(
        F.when(F.col("id") % 3 > 0, F.lit(7)).otherwise(F.col("id") + 100).alias("conv_id"),
        (F.col("id") % 10).alias("turn"),
        F.lit("user").alias("role"),
        F.lit("same").alias("text"),
    )
    turns = ct.turns_in_order(rows)
    hot = turns.filter("conv_id = 7")
    assert [tuple(r) for r in hot.agg(F.min("place"), F.max("place"), F.count_distinct("place")).collect()] == [(1, 26_666, 26_666)]
    sizes = hot.groupBy(F.floor(F.col("place") / 10_000)).count()
    assert sizes.count() == 3


@pytest.mark.parametrize("name", ["op11_conversation_trie", "op12_exact_top_k", "op13_vector_codes"])
def test_query_equals_oracle(spark, name):
    duck = duckdb.connect()
    for table in ("conversations", "embeddings"):
        duck.execute(f"create view {table} as select * from '/root/testdata/sf0.01/{table}.parquet'")
    expected = duck.execute(contract.oracle_sql()[name]).to_arrow_table()
    result = contract.queries()[name](spark, "/root/testdata/sf0.01")
    assert sorted(result.columns) == sorted(expected.column_names)
    assert comparable(result.toArrow()) == comparable(expected)
