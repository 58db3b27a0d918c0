"""Log probabilities of texts by a causal self-attention model over subword units.

Words are runs without ASCII white space, A-Z lower-cased; a text is its words and an end. A unit is
a subword id of the public tokenizer with a flag that says whether it is the last of its word, so
the units of a text give its words back (but for what the tokenizer folds: case and composition
beyond ASCII). A text's probability is the product of its units'.

Texts are cut into windows that overlap: each unit is scored once, with at least `OVERLAP` units before it
as context unless the text begins later. Windows go through masked attention in batches.

What is learnt, all of it from training rows only:
- Counts of words and units over all training rows, by shuffled sums. The words' counts give the
  base score. The units' counts decide which get slots in the output layer (the rest share one,
  divided by their counts) and give its biases, and their neighbours within words group the slots.
- The model, first a start on windows drawn at a rate that makes PRETRAIN_UNITS of them expected (all, if
  there are fewer), on the driver; then by all tasks, each on all its training windows from that start,
  whose models are averaged. So every training window gives a gradient, at any size of the corpus.

Documents are worked on in chunks: the distinct words of some CHUNK_BYTES of text, and the texts as
numbers of these. So a word is looked up once per chunk, not once per token. Units of words that
earlier chunks had are kept in columns (`UnitCache`): as Python strings they would be most of a task's memory.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm import attention
from orderlake.llm.tables import giving_back, staged, text_slices
from orderlake.llm.tokens import WordEncoder, word_encoder

CHUNK_BYTES = 8 << 20
#: A chunk is a row of some 14 MB, and the writer holds a group of rows. Sizes are looked at after each
#: row, not after a hundred, and a group ends at so many bytes.
CHUNK_FILES = {"parquet.page.size.row.check.min": "1", "parquet.block.size": str(64 << 20)}
#: Words whose units a task keeps, and those that go to the tokenizer at once.
KEPT_WORDS = 500_000
NEW_WORDS = 20_000
#: Texts of a chunk whose windows are laid out at once.
PORTION = 32
#: Groups of the output layer, and slots of a group; the last slot of all is for all other units.
GROUPS = 52
SLOTS = 52
#: Frequent units whose neighbourhood describes a unit when slots are grouped.
CONTEXTS = 32
PRETRAIN_UNITS = 2_500_000
#: Units that pretraining passes over, in whole passes over its windows.
PRETRAIN_WORK = 5_000_000
RATE, REFINE_RATE = 4e-3, 5e-4
#: Models are averaged in so many tasks before the driver gets them.
AVERAGERS = 8

END = "\n"  # no word has white space

CHUNK = (
    "chunk long, words array<string>, train binary, units binary, unit_ends binary, doc_ids array<long>, "
    "held_out array<boolean>, offsets binary, tokens binary"
)


def arrays(batch: pa.RecordBatch, row: int) -> dict:
    """One chunk's columns as numpy arrays (binary, not copied) or lists."""
    kinds = {"train": "<i8", "units": "<u4", "unit_ends": "<i8", "offsets": "<i8", "tokens": "<i4"}
    out = {}
    for name in batch.schema.names:
        value = batch.column(batch.schema.get_field_index(name))[row]
        out[name] = np.frombuffer(value.as_buffer(), kinds[name]) if name in kinds else value
    return out


class UnitCache:
    """Units of words: those of earlier calls, and what the tokenizer gives for new ones, some at a time."""

    def __init__(self, encoder: WordEncoder):
        self.encoder = encoder
        self.words = pa.array([], pa.string())
        self.units, self.ends = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def flat(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The units of distinct words in turn, and where each word's end."""
        at = pc.index_in(words, value_set=self.words)
        new = words.filter(at.is_null())
        units, ends = [self.units], [self.ends]
        for k in range(0, len(new), NEW_WORDS):
            more, their_ends = units_of(*self.encoder.flat(new.slice(k, NEW_WORDS).to_pylist()))
            ends.append(their_ends + sum(map(len, units)))
            units.append(more)
            self.encoder.forget()
        all_units, all_ends = np.concatenate(units), np.concatenate(ends)
        there = at.is_valid().to_numpy(zero_copy_only=False)
        places = at.fill_null(0).to_numpy().astype(np.int64)
        places[~there] = len(self.words) + np.arange(len(new))
        lengths = np.diff(all_ends, prepend=0)[places]
        out = all_units[_spread(all_ends[places] - lengths, lengths)], np.cumsum(lengths)
        if len(all_ends) > KEPT_WORDS:
            self.words, self.units, self.ends = words, *out
        else:
            self.words, self.units, self.ends = pa.concat_arrays([self.words, new]), all_units, all_ends
        return out


def chunks(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Rows (doc_id, text, held_out) as chunks."""

    @giving_back
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer_path)
        cache, end_unit = UnitCache(encoder), 2 * encoder.tokenizer.get_vocab_size()
        first = TaskContext.get().partitionId() << 32
        for number, part in enumerate(text_slices(batches, "text", CHUNK_BYTES)):
            yield chunk_of(part, first + number, cache, end_unit)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "held_out")
    return rows.mapInArrow(cut, CHUNK)


def chunk_of(part: pa.RecordBatch, number: int, cache: UnitCache, end_unit: int) -> pa.RecordBatch:
    """Some texts as a chunk."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(part.column(1), "")))
    offsets = lists.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten()
    coded = pc.if_else(pc.equal(flat, ""), None, flat).dictionary_encode()  # spaces at either end
    there = coded.indices.is_valid().to_numpy(zero_copy_only=False)
    tokens = coded.indices.fill_null(0).to_numpy(zero_copy_only=False)[there]
    ends = np.append(0, np.cumsum(there))[offsets - offsets[0]]
    words = pa.concat_arrays([coded.dictionary, pa.array([END])])
    tokens = np.insert(tokens, ends[1:], len(words) - 1).astype("<i4")
    offsets = ends + np.arange(len(ends))
    held = part.column(2).to_numpy(zero_copy_only=False).astype(bool)
    learnt = tokens[np.repeat(~held, np.diff(offsets))]
    del lists, flat, there
    units, unit_ends = cache.flat(coded.dictionary)
    return pa.RecordBatch.from_pydict(
        {
            "chunk": pa.array([number], pa.int64()),
            "words": pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words),
            "train": [np.bincount(learnt, minlength=len(words)).astype("<i8").tobytes()],
            "units": [np.append(units, np.array([end_unit], "<u4")).tobytes()],
            "unit_ends": [np.append(unit_ends, len(units) + 1).astype("<i8").tobytes()],
            "doc_ids": pa.array([part.column(0).to_pylist()], pa.list_(pa.int64())),
            "held_out": pa.array([held.tolist()], pa.list_(pa.bool_())),
            "offsets": [offsets.astype("<i8").tobytes()],
            "tokens": [tokens.tobytes()],
        }
    )


def units_of(ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Twice each id, and 1 more for the last of a word that has any."""
    units = ids * np.uint32(2)
    units[ends[np.diff(ends, prepend=0) > 0] - 1] += np.uint32(1)
    return units, ends


def word_counts(parts: DataFrame) -> DataFrame:
    """(word, c) of words that training rows have, the end included."""

    @giving_back
    def flat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                chunk = arrays(batch, row)
                known = pa.array(chunk["train"] > 0)
                words = chunk["words"].values.filter(known)
                yield pa.RecordBatch.from_pydict({"word": words, "c": pa.array(chunk["train"]).filter(known)})

    counted = parts.select("words", "train").mapInArrow(flat, "word string, c long")
    return counted.groupBy("word").agg(F.sum("c").alias("c"))


def summed(parts: DataFrame, size: int) -> np.ndarray:
    """An array from summed (cell, value) rows; its size is a parameter's, not the corpus's."""
    table = parts.groupBy("cell").agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros(size)
    out[table["cell"].to_numpy()] = table["value"].to_numpy()
    return out


def cells(values: np.ndarray) -> pa.RecordBatch:
    there = np.flatnonzero(values)
    return pa.RecordBatch.from_pydict({"cell": pa.array(there.astype(np.int32)), "value": pa.array(values[there].astype(float))})


def unit_counts(parts: DataFrame, kinds: int) -> np.ndarray:
    @giving_back
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(kinds)
        for batch in batches:
            for row in range(batch.num_rows):
                c = arrays(batch, row)
                lengths = np.diff(c["unit_ends"], prepend=0)
                total += np.bincount(c["units"], weights=np.repeat(c["train"], lengths), minlength=kinds)
        yield cells(total)

    return summed(parts.select("train", "units", "unit_ends").mapInArrow(count, "cell int, value double"), kinds)


def neighbours(parts: DataFrame, rank: np.ndarray) -> np.ndarray:
    """For each ranked unit, how often each of the first CONTEXTS comes before and after it in a word."""
    ranked = GROUPS * SLOTS

    @giving_back
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((ranked, 2, CONTEXTS))
        for batch in batches:
            for row in range(batch.num_rows):
                c = arrays(batch, row)
                weight = np.repeat(c["train"], np.diff(c["unit_ends"], prepend=0))
                units = rank[c["units"]]
                inside = np.ones(len(units), bool)
                inside[c["unit_ends"][c["unit_ends"] < len(units)]] = False
                inside[:1] = False
                at = np.flatnonzero(inside)
                a, b, w = units[at - 1], units[at], weight[at]
                near = a < CONTEXTS
                np.add.at(total, (b[near], 0, a[near]), w[near])
                near = b < CONTEXTS
                np.add.at(total, (a[near], 1, b[near]), w[near])
        yield cells(total.ravel())

    rows = parts.select("train", "units", "unit_ends").mapInArrow(count, "cell int, value double")
    return summed(rows, ranked * 2 * CONTEXTS).reshape(ranked, 2 * CONTEXTS)


class Units:
    """Which units have slots, where, and how the others share the last one."""

    def __init__(self, counts: np.ndarray, parts: DataFrame | None = None):
        size = GROUPS * SLOTS
        order = np.argsort(-counts, kind="stable")
        rank = np.full(len(counts), size - 1, np.int32)
        rank[order[: size - 1]] = np.arange(min(size - 1, len(counts)))
        places = np.arange(size)
        if parts is not None:
            near = neighbours(parts, rank)
            near = np.log1p(100 * near / (near.sum(axis=1, keepdims=True) + 1))
            axes, spread, _ = np.linalg.svd(near - near.mean(axis=0), full_matrices=False)
            places[np.concatenate(_halved(np.arange(size), (axes * spread)[:, :6], 0))] = np.arange(size)
        self.place = places[rank].astype(np.int32)  # of each unit, in the output layer
        own = np.bincount(self.place, weights=counts, minlength=size) + 0.5
        self.counts = own.reshape(GROUPS, SLOTS)
        self.extra = np.zeros(len(counts))
        rest = order[size - 1 :]
        self.extra[rest] = np.log((counts[rest] + 1) / (counts[rest] + 1).sum())

    def start(self) -> attention.Params:
        total = self.counts.sum(axis=1, keepdims=True)
        shape = attention.Shape(GROUPS, SLOTS)
        return attention.initial(shape, np.log(total[:, 0] / total.sum()), np.log(self.counts / total))


def _halved(members: np.ndarray, axes: np.ndarray, depth: int) -> list[np.ndarray]:
    """Members in an order in which neighbours are alike: halved along one axis after another."""
    if depth == axes.shape[1]:
        return [members]
    order = members[np.argsort(axes[members, depth], kind="stable")]
    half = len(order) // 2
    return _halved(order[:half], axes, depth + 1) + _halved(order[half:], axes, depth + 1)


def sequences(chunk: dict, place: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
    """The places of the units of some texts of a chunk."""
    ends = chunk["unit_ends"]
    lengths = np.diff(ends, prepend=0)
    starts = ends - lengths
    of_unit = place[chunk["units"]]
    out = []
    for row in rows:
        tokens = chunk["tokens"][chunk["offsets"][row] : chunk["offsets"][row + 1]]
        out.append(of_unit[_spread(starts[tokens], lengths[tokens])])
    return out


def _spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    ends = np.cumsum(lengths)
    return np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)


def drawn_windows(batches: Iterator[pa.RecordBatch], place: np.ndarray, rate: float, seed: int) -> Iterator[tuple]:
    """Windows of training texts, each with probability `rate`, chunk by chunk; places take two bytes."""
    for batch in batches:
        for row in range(batch.num_rows):
            chunk = arrays(batch, row)
            rng = np.random.default_rng([seed, chunk["chunk"].as_py()])
            rows = np.flatnonzero(~np.array(chunk["held_out"].as_py(), bool))
            # Texts in portions, so that their windows are never all there at once.
            for k in range(0, len(rows), PORTION):
                x, y, valid, _ = attention.windows(sequences(chunk, place, rows[k : k + PORTION]), GROUPS * SLOTS)
                keep = rng.random(len(x)) < rate
                yield x[keep].astype("<u2"), y[keep].astype("<u2"), valid[keep]


def pretrained(parts: DataFrame, units: Units, total: float) -> attention.Params:
    rate = min(1.0, PRETRAIN_UNITS / max(total, 1))
    place = units.place

    @giving_back
    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x, y, valid in drawn_windows(batches, place, rate, 1):
            if len(x):
                yield pa.RecordBatch.from_pydict(
                    {"x": [x.tobytes()], "y": [y.tobytes()], "valid": [valid.tobytes()]}
                )

    wanted = parts.select("chunk", "units", "unit_ends", "held_out", "offsets", "tokens")
    drawn = wanted.mapInArrow(draw, "x binary, y binary, valid binary").toArrow()
    start = units.start()
    if drawn.num_rows == 0:
        return start
    x, y, valid = (
        np.concatenate([np.frombuffer(b.as_py(), kind) for b in drawn[name]]).reshape(-1, attention.WINDOW)
        for name, kind in (("x", "<u2"), ("y", "<u2"), ("valid", "?"))
    )
    passes = int(np.clip(round(PRETRAIN_WORK / max(valid.sum(), 1)), 1, 8))
    return attention.fit(start, x, y, valid, SLOTS, RATE, passes, 3)


def trained(batches: Iterator[pa.RecordBatch], place: np.ndarray, start: attention.Params) -> tuple[attention.Params, int]:
    """The model after one pass over all training windows of some chunks, and how many these are.

    Chunks are learnt from one after another, so the windows of only one are there at once; the rate
    starts anew with each.
    """
    model, n = start, 0
    for batch in batches:
        for row in range(batch.num_rows):
            drawn = [d for d in drawn_windows(iter([batch.slice(row, 1)]), place, 1.0, 2) if len(d[0])]
            if drawn:
                x, y, valid = (np.concatenate(c) for c in zip(*drawn, strict=True))
                model = attention.fit(model, x, y, valid, SLOTS, REFINE_RATE, 1, 5)
                n += len(x)
    return model, n


def refined(parts: DataFrame, units: Units, start: attention.Params) -> attention.Params:
    """The mean of models that all tasks train on from `start`, weighted by their windows."""
    place = units.place
    sent = parts.sparkSession.sparkContext.broadcast(start)

    @giving_back
    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, n = trained(batches, place, sent.value)
        if n:
            yield _model_row(model, n)

    @giving_back
    def average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = None, 0
        for batch in batches:
            for row in batch.to_pylist():
                model = pickle.loads(row["model"])
                part = {k: a * row["n"] for k, a in model.items()}
                total = part if total is None else {k: total[k] + a for k, a in part.items()}
                n += row["n"]
        if n:
            yield _model_row({k: a / n for k, a in total.items()}, n)

    wanted = parts.select("chunk", "units", "unit_ends", "held_out", "offsets", "tokens")
    models = wanted.mapInArrow(train, "model binary, n long").repartition(AVERAGERS).mapInArrow(average, "model binary, n long")
    rows = models.collect()
    if not rows:
        return start
    n = sum(r.n for r in rows)
    loaded = [(pickle.loads(r.model), r.n) for r in rows]
    return {k: sum(m[k] * (w / n) for m, w in loaded).astype(np.float32) for k in start}


def _model_row(model: attention.Params, n: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"model": [pickle.dumps(model)], "n": pa.array([n], pa.int64())})


def rare_shares(chunk: dict, extra: np.ndarray) -> np.ndarray:
    """Of each text, the sum over its units of their shares in the last slot."""
    lengths = np.diff(chunk["unit_ends"], prepend=0)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    rare = np.bincount(owner, weights=extra[chunk["units"]], minlength=len(lengths))
    return np.diff(np.append(0, np.cumsum(rare[chunk["tokens"]]))[chunk["offsets"]])


def model_scores(parts: DataFrame, units: Units, model: attention.Params) -> DataFrame:
    """(chunk, row, score): log10 probability of every text."""
    sent = parts.sparkSession.sparkContext.broadcast((model, units.place, units.extra))

    @giving_back
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, place, extra = sent.value
        scorer = attention.Scorer(model, SLOTS)
        for batch in batches:
            for row in range(batch.num_rows):
                chunk = arrays(batch, row)
                n = len(chunk["offsets"]) - 1
                out = rare_shares(chunk, extra)
                for k in range(0, n, PORTION):
                    rows = np.arange(k, min(n, k + PORTION))
                    out[rows] += scorer.score(sequences(chunk, place, rows))
                yield pa.RecordBatch.from_pydict(
                    {
                        "chunk": pa.array(np.full(n, chunk["chunk"].as_py())),
                        "row": pa.array(np.arange(n, dtype=np.int32)),
                        "score": pa.array(out / np.log(10)),
                    }
                )

    wanted = parts.select("chunk", "units", "unit_ends", "offsets", "tokens")
    return wanted.mapInArrow(score, "chunk long, row int, score double")


BASE = "chunk long, row int, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double"


def base_scores(parts: DataFrame, counts: DataFrame, n: int, v: int) -> DataFrame:
    """Unigram scores: each chunk's words are joined with their counts, not each token."""
    schema = pa.schema(
        [
            (name, {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "double": pa.float64()}[kind])
            for name, kind in (c.split() for c in BASE.split(", "))
        ]
    )

    def score(chunk_rows: pa.Table, known: pa.Table) -> pa.Table:
        out = []
        for batch in chunk_rows.combine_chunks().to_batches():
            for row in range(batch.num_rows):
                chunk = arrays(batch, row)
                c = np.zeros(int(chunk["tokens"].max(initial=0)) + 1, np.int64)
                at = known["at"].to_numpy()
                inside = at < len(c)
                c[at[inside]] = known["c"].to_numpy()[inside]
                tokens, offsets = chunk["tokens"], chunk["offsets"]
                logs = np.append(0, np.cumsum((np.log10(c + 1) - np.log10(n + v + 1))[tokens]))
                seen = np.append(0, np.cumsum((c > 0)[tokens]))
                texts = len(offsets) - 1
                out.append(
                    pa.Table.from_arrays(
                        [
                            pa.array(np.full(texts, chunk["chunk"].as_py())),
                            pa.array(np.arange(texts, dtype=np.int32)),
                            chunk["doc_ids"].values,
                            chunk["held_out"].values,
                            pa.array(np.diff(offsets)),
                            pa.array(np.diff(seen[offsets])),
                            pa.array(np.diff(logs[offsets])),
                        ],
                        schema=schema,
                    )
                )
        return pa.concat_tables(out) if out else schema.empty_table()

    words = parts.select("chunk", F.posexplode("words").alias("at", "word"))
    known = words.join(counts, "word").select(F.col("chunk").alias("of_chunk"), "at", "c")
    wanted = parts.select("chunk", "doc_ids", "held_out", "offsets", "tokens")
    return wanted.groupBy("chunk").cogroup(known.groupBy("of_chunk")).applyInArrow(score, BASE)


def scored(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Scores for rows (doc_id, text, held_out); other columns are not read.

    Gives doc_id, held_out, n_tokens (words and the end), n_known (those that training rows have),
    train_tokens, base_score (log10 by add-one unigram counts) and score (log10 by the model). Null
    texts are empty and have the end only; a null held_out is a training row. Null ids stay null,
    repeated rows are scored each. Without training rows the model is its random start. An empty
    table gives no rows.
    """
    docs = docs.select("doc_id", "text", F.coalesce("held_out", F.lit(False)).alias("held_out"))
    parts = staged(chunks(docs, tokenizer_path), "lm-chunks", CHUNK_FILES)
    counts = staged(word_counts(parts), "lm-words")
    sums = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    n, v = sums.n or 0, sums.v
    kinds = 2 * word_encoder(tokenizer_path).tokenizer.get_vocab_size() + 1
    of_units = unit_counts(parts, kinds)
    units = Units(of_units, parts)
    model = refined(parts, units, pretrained(parts, units, of_units.sum()))
    found = base_scores(parts, counts, n, v).join(model_scores(parts, units, model), ["chunk", "row"])
    return found.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score"
    )
