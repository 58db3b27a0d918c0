"""The prefix trie of conversations, by van Emde Boas recursion.

A segment of depths is cut at half its depth. The part of a sequence above the cut is named, together
with what stands before the segment; sequences of one name share the lower forest below the cut. So the
upper trie and all lower forests can be built at the same time, each by the same recursion, down to
single turns. Cuts are at multiples of powers of two, the same for sequences of any length. The first
halvings work on runs of RUN turns, whose digests are the turns of a shorter sequence; the last ones
work within a run, which is small. A name is a digest of all that it stands for (128 bits of SHA-256),
so a node is all rows of one depth and name, whoever made them.

Totals are grafted upward along the same cuts. Depth d is the last of the upper half of one segment,
(d - lowbit(d), d]. A node hands its value to its ancestors at the ends of the upper halves that
together make up 1..d, at most one for each bit of d; each of these hands the sum of what it got to its
ancestors within its own half. So work grows with turns x log(depth), in two joins whatever the depth.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake.llm.tables import staged
from orderlake.operators.joins import left_join

#: Turns of a run, a power of two.
RUN = 256
#: Hexadecimal digits of a digest.
DIGITS = 32
#: Bits of an id within a piece of a node's ids, and depths that a row is spread over at once.
PIECE_BITS = 12
SPREAD = 4096

TURNS = "conv_id long, depth long, token string, n_chars long"
NODES = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string"
)


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()[:DIGITS]


def _digest(text: Column) -> Column:
    return F.substring(F.sha2(text.cast("binary"), 256), 1, DIGITS)


def turns_in_order(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, token, n_chars): each conversation's turns from 1, by turn, null first.

    Turns of one number are ordered by their digest; repeated rows are turns of their own. Null role
    and text are empty; rows without a conv_id are left out. `token` tells (role, text) apart. Turns
    are numbered from a table sorted over all tasks, so that a very long conversation is in many.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").alias("turn"),
        _digest(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("token"),
        F.length(text).cast("long").alias("n_chars"),
        F.monotonically_increasing_id().alias("row"),
    )
    order = ["conv_id", "turn", "token", "row"]
    laid = staged(
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("conv_id", "token", "n_chars", F.monotonically_increasing_id().alias("at"))
        .withColumn("task", F.shiftright("at", 33)),
        "sorted-turns",
    )
    tasks = laid.groupBy("conv_id", "task").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv_id").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = tasks.select("conv_id", "task", (F.col("first") - F.coalesce(F.sum("n").over(before), F.lit(0))).alias("start"))
    numbered = left_join(laid, tasks, ["conv_id", "task"])
    return numbered.select("conv_id", (F.col("at") - F.col("start") + 1).alias("place"), "token", "n_chars")


def rebuilt(turns: DataFrame, group: int = 100, heads: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin like the first one of their group of ids: (turns, conversations).

    Conversation c gets the first h turns of conversation c - c % group, h = crc32(c) % heads, all of
    them if it has fewer and none if it is not there, then its own turns after its first h. The second
    frame has (conv_id, length) of every conversation, those without turns too.
    """
    turns = staged(turns, "numbered-turns")
    lengths = turns.groupBy("conv_id").agg(F.max("place").alias("own"))
    convs = lengths.select(
        "conv_id",
        "own",
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).alias("head"),
        (F.col("conv_id") - F.col("conv_id") % group).alias("base"),
    )
    # A base serves one group of ids and gives at most `heads` turns, so this gathering is bounded.
    bases = (
        turns.filter((F.col("conv_id") % group == 0) & (F.col("place") < heads))
        .groupBy(F.col("conv_id").alias("base"))
        .agg(F.array_sort(F.collect_list(F.struct("place", "token", "n_chars"))).alias("turns"))
    )
    empty = F.array().cast("array<struct<place: bigint, token: string, n_chars: bigint>>")
    convs = convs.join(bases, "base", "left").select(
        "conv_id", "own", "head", F.slice(F.coalesce("turns", empty), F.lit(1), F.col("head").cast("int")).alias("shared")
    )
    convs = staged(convs, "rebuilt-heads")
    begun = convs.select("conv_id", F.inline("shared")).withColumnRenamed("place", "depth")
    shift = convs.select("conv_id", "head", (F.size("shared") - F.col("head")).alias("shift"))
    rest = left_join(turns, shift, ["conv_id"]).filter("place > head")
    rest = rest.select("conv_id", (F.col("place") + F.col("shift")).alias("depth"), "token", "n_chars")
    length = F.size("shared") + F.greatest(F.col("own") - F.col("head"), F.lit(0))
    return begun.unionByName(rest), convs.select("conv_id", length.cast("long").alias("length"))


def named(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, name, n_chars): the name of each prefix of each sequence of TURNS."""
    turns = staged(turns, "trie-turns")
    deepest = turns.agg(F.max("depth")).first()[0] or 0
    runs = turns.groupBy("conv_id", F.floor((F.col("depth") - 1) / RUN).alias("run")).agg(
        F.array_sort(F.collect_list(F.struct("depth", "token", "n_chars"))).alias("turns")
    )
    if deepest > RUN:
        runs = staged(runs, "trie-runs")
        whole = runs.filter(F.size("turns") == RUN).select(
            "conv_id",
            (F.col("run") + 1).alias("depth"),
            _digest(F.array_join("turns.token", "")).alias("token"),
            F.lit(0).cast("long").alias("n_chars"),
        )
        before = named(whole).select("conv_id", F.col("depth").alias("run"), F.col("name").alias("before"))
        runs = left_join(runs, before, ["conv_id", "run"])
    else:
        runs = runs.withColumn("before", F.lit(None).cast("string"))
    runs = runs.select("conv_id", F.coalesce("before", F.lit("")).alias("before"), "turns")
    return runs.mapInArrow(_names, "conv_id long, depth long, name string, n_chars long")


def halved(before: str, tokens: list[str]) -> list[str]:
    """The names of all prefixes of a run, by cutting it at half its depth again and again."""
    names = [""] * len(tokens)

    def build(before: str, lo: int, size: int) -> None:
        if size == 1:
            names[lo] = digest(before + tokens[lo])
            return
        half = size // 2
        build(before, lo, half)
        if lo + half < len(tokens):
            cut = digest(before + digest("".join(tokens[lo : lo + half])))
            build(cut, lo + half, half)

    if tokens:
        build(before, 0, 1 << (len(tokens) - 1).bit_length())
    return names


def _names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        conv, before = batch.column(0), batch.column(1).to_pylist()
        runs = batch.column(2)
        turns, counts = runs.flatten(), runs.value_lengths()
        tokens, offsets = turns.field("token").to_pylist(), [0]
        for n in counts.to_pylist():
            offsets.append(offsets[-1] + n)
        names = [name for k, b in enumerate(before) for name in halved(b, tokens[offsets[k] : offsets[k + 1]])]
        row = pa.array([k for k, n in enumerate(counts.to_pylist()) for _ in range(n)], pa.int32())
        columns = [conv.take(row), turns.field("depth"), pa.array(names, pa.string()), turns.field("n_chars")]
        yield pa.RecordBatch.from_arrays(columns, names=["conv_id", "depth", "name", "n_chars"])


def trie(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """NODES of the sequences `turns` (TURNS; depths 1, 2, ... of each conv_id).

    `conversations` has (conv_id, length) of every sequence, those without turns too, which are members
    of the root only. A node goes by its smallest member and its depth; saved_tokens adds up the code
    points that each node of its subtree holds for all members but one; ends_sha256 is over the ids of
    the members that end there. No conversations make no nodes.
    """
    spark = turns.sparkSession
    root = conversations.agg(F.min("conv_id"), F.count(F.lit(1))).first()
    if root[0] is None:
        return spark.createDataFrame([], NODES)
    prefixes = staged(named(turns), "prefix-names")
    found = prefixes.groupBy("depth", "name").agg(F.min("conv_id").alias("node"), F.count(F.lit(1)).alias("n_convs"))
    # Every sequence's way through the trie: (conv_id, depth) is unique, node is the smallest member.
    ways = staged(left_join(prefixes, found, ["depth", "name"]).select("conv_id", "depth", "node", "n_convs", "n_chars"), "trie-ways")

    own = ways.filter("conv_id = node").select("node", "depth", "n_convs", "n_chars")
    above = ways.select(F.col("conv_id").alias("node"), (F.col("depth") + 1).alias("depth"), F.col("node").alias("parent"))
    top = spark.createDataFrame([(root[0], 0, root[1], 0, None)], "node long, depth long, n_convs long, n_chars long, parent long")
    nodes = own.join(above, ["node", "depth"], "left").withColumn("parent", F.coalesce("parent", F.lit(root[0])))
    nodes = staged(nodes.unionByName(top), "trie-nodes")
    children = (
        nodes.filter("depth > 0")
        .groupBy(F.col("parent").alias("node"), (F.col("depth") - 1).alias("depth"))
        .agg(F.count(F.lit(1)).alias("n_children"))
    )
    nodes = nodes.join(children, ["node", "depth"], "left").fillna(0, ["n_children"])
    nodes = nodes.withColumn("leaves", (F.col("n_children") == 0).cast("long"))
    nodes = staged(nodes.withColumn("saved", (F.col("n_convs") - 1) * F.col("n_chars")), "trie-values")

    totals, ends = grafted(nodes, ways), end_digests(conversations, ways, root[0])
    nothing = hashlib.sha256(b"").hexdigest()
    return (
        nodes.join(totals, ["node", "depth"], "left")
        .join(ends, ["node", "depth"], "left")
        .select(
            F.col("node").alias("conv_id"),
            "depth",
            F.col("parent").alias("parent_conv_id"),
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
        )
    )


def grafted(nodes: DataFrame, ways: DataFrame) -> DataFrame:
    """(node, depth, n_leaves, saved_tokens): leaves and saved summed over each node's subtree.

    Sums are taken by (conv_id, depth) before each join with `ways`, so its keys are unique on both
    sides and no node, however common, is one task's.
    """
    sums = [F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")]
    at_node = [F.col("node").alias("conv_id"), "depth"]
    step = ways.select("conv_id", "depth", "node")

    ends = "explode(transform(filter(sequence(0, 62), b -> shiftright(depth, b) & 1 = 1), b -> shiftleft(shiftright(depth, b), b)))"
    handed = nodes.filter("depth > 0").select("node", F.expr(ends).alias("depth"), "leaves", "saved")
    handed = handed.groupBy(*at_node).agg(*sums).join(step, ["conv_id", "depth"])
    handed = handed.groupBy("node", "depth").agg(*sums)

    # A half may be as deep as the trie, so it is opened in two steps of bounded arrays.
    first = F.expr(f"explode(sequence(depth - (depth & -depth) + 1, depth, {SPREAD}L))").alias("first")
    spread = handed.select("node", "depth", "leaves", "saved", first)
    every = F.expr(f"explode(sequence(first, least(first + {SPREAD - 1}, depth)))").alias("depth")
    spread = spread.select("node", every, "leaves", "saved")
    spread = spread.groupBy(*at_node).agg(*sums).join(step, ["conv_id", "depth"])
    totals = spread.groupBy("node", "depth").agg(*sums)
    whole = nodes.agg(F.min(F.when(F.col("depth") == 0, F.col("node"))).alias("node"), F.lit(0).cast("long").alias("depth"), *sums)
    return totals.unionByName(whole).select(
        "node", "depth", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens")
    )


def end_digests(conversations: DataFrame, ways: DataFrame, root: int) -> DataFrame:
    """(node, depth, ends_sha256) of the nodes at which sequences end.

    SHA-256 is a chain, so one task reads a node's ids in turn, whatever their number. They come to it
    as texts of up to 2 ** PIECE_BITS ids, sorted, and it holds no more than a batch of them.
    """
    last = ways.select("conv_id", F.col("depth").alias("length"), "node")
    ends = conversations.join(last, ["conv_id", "length"], "left").select(
        F.coalesce("node", F.lit(root)).alias("node"), F.col("length").alias("depth"), "conv_id"
    )
    ids = F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string"))
    pieces = ends.groupBy("node", "depth", F.shiftright("conv_id", PIECE_BITS).alias("piece")).agg(
        F.array_join(ids, ",").alias("ids")
    )
    order = ["node", "depth", "piece"]
    return pieces.repartition("node", "depth").sortWithinPartitions(*order).mapInArrow(
        _chained, "node long, depth long, ends_sha256 string"
    )


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's pieces joined by commas; a node's pieces follow each other."""
    key, state = None, None

    def out(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [[], [], []]
        types = [pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["node", "depth", "ends_sha256"]
        )

    for batch in batches:
        done = []
        for node, depth, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3).to_pylist(), strict=True):
            if key == (node, depth):
                state.update(b"," + ids.encode())
                continue
            if key is not None:
                done.append((*key, state.hexdigest()))
            key, state = (node, depth), hashlib.sha256(ids.encode())
        yield out(done)
    if key is not None:
        yield out([(*key, state.hexdigest())])
