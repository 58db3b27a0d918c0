"""Toxicity by weak supervision.

Many voters look at a text: seed words (a fixed lexicon), word beginnings that stand out
in toxic labelled texts (lexicon voters found in the data), and patterns of style. A generative label model
says how often each voter votes on toxic and on clean texts, and which voters go together within a
class; it is fitted by expectation maximisation over the votes of all rows, labelled ones being
held at their labels. Voters that go together share one say: each one's log odds are divided by
the sum of its correlations. A linear classifier is then trained on the posterior labels of all rows.

Rows are tables in Spark throughout: the driver gets sums per voter, per pair of voters or per pair
of features, whose number is a parameter. No row is sampled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.tables import giving_back, staged, text_slices

# Insults of four languages, each a voter.
SEEDS = (
    "arschloch asshole bastard bastardo cabron clown connard crétin disgusting dreck dumb dummkopf estúpido fool "
    "freak garbage hure idiot idiota idiote imbécil imbécile jerk loser moron pathetic pendejo salaud schlampe scum "
    "stupid stupide trash trottel ugly vermin wichser worthless"
).split()

#: Most voters found in the data, besides the seeds and patterns.
VOTERS = 80
#: Lengths of the word beginnings that may become voters.
STEMS = (4, 5, 6, 7)
#: How often a text must have one: once, or twice and once more for each WORDS_PER_TIME of its words,
#: as common beginnings turn up in any long text.
TIMES = (1, 2)
WORDS_PER_TIME = 400
#: Labelled texts that a found voter must be in, at least.
LEAST_TEXTS = 4
#: Rounds of expectation maximisation, and of Newton's method.
EM_ROUNDS = 3
NEWTON_ROUNDS = 8
#: Correlations below this, within a class, count as none: voters of one language go together a little.
LEAST_CORRELATION = 0.5
RIDGE = 1.0
THRESHOLD = 0.3

_WORD = re.compile(r"[^\W\d_]+")

# Patterns of style: (name, true if the counts of a text say so). c: its characters, words, letters
# in capitals, exclamation marks and second-person words.
PATTERNS = (
    ("shouting", lambda c: (c[2] > 0.3 * np.maximum(c[0], 1)) & (c[1] >= 5)),
    ("exclaiming", lambda c: (c[3] > 0.02 * np.maximum(c[0], 1)) & (c[3] >= 3)),
    ("addressing", lambda c: c[4] > 0.02 * np.maximum(c[1], 1)),
    ("short", lambda c: c[1] < 20),
)
SECOND_PERSON = {"you", "your", "du", "dein", "tu", "ton", "vous", "usted", "tú"}


def distinct_words(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Lower-case words of letters: the distinct ones, their numbers in turn, each one's text."""
    lists = pc.utf8_split_whitespace(pc.utf8_lower(pc.fill_null(texts, "")))
    coded = lists.flatten().dictionary_encode()
    raw = coded.dictionary.to_pylist()
    # A run without white space may be several words, or none.
    numbers: dict[str, int] = {}
    parts = [[numbers.setdefault(w, len(numbers)) for w in _WORD.findall(r)] for r in raw]
    flat = np.fromiter((n for p in parts for n in p), np.int64)
    counts = np.fromiter(map(len, parts), np.int64, len(parts))
    first = np.cumsum(counts) - counts
    at = coded.indices.to_numpy(zero_copy_only=False)
    each = counts[at]
    ends = np.cumsum(each)
    words = flat[np.repeat(first[at] - ends + each, each) + np.arange(ends[-1] if len(ends) else 0)]
    rows = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy(zero_copy_only=False)))
    return list(numbers), words, np.repeat(rows, each)


def found_voters(labelled: DataFrame, most: int = VOTERS) -> list[tuple[str, int]]:
    """Word beginnings that stand out in toxic texts, each with how often a text must have it.

    `labelled` has text and toxic (0 or 1). A candidate's log likelihood ratio must exceed what
    chance gives the best of all candidates; of one that begins another, the stronger stays.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text"):
            toxic = np.array(part.column(1).to_pylist(), np.int64)
            distinct, words, rows = distinct_words(part.column(0))
            yield _sums([""], [[len(toxic)]] * 2, [[toxic.sum()]] * 2)
            for length in STEMS:
                stems: dict[str, int] = {}
                of = [stems.setdefault(w[:length], len(stems)) if len(w) >= length else -1 for w in distinct]
                numbers = np.array(of, np.int64)[words] if len(words) else np.zeros(0, np.int64)
                keep = numbers >= 0
                pairs, hits = np.unique(numbers[keep] * len(toxic) + rows[keep], return_counts=True)
                lengths = np.bincount(rows, minlength=len(toxic))[pairs % len(toxic)]
                n, bad = [], []
                for times in TIMES:
                    stem, row = np.divmod(pairs[hits >= enough(times, lengths)], len(toxic))
                    n.append(np.bincount(stem, minlength=len(stems)))
                    bad.append(np.bincount(stem, weights=toxic[row], minlength=len(stems)))
                yield _sums(list(stems), n, bad)

    columns = [f"{what}{times}" for times in TIMES for what in ("n", "bad")]
    sums = staged(
        labelled.select("text", "toxic")
        .mapInArrow(giving_back(count), "stem string, " + ", ".join(f"{c} long" for c in columns))
        .groupBy("stem")
        .agg(*[F.sum(c).alias(c) for c in columns])
        .filter(F.col(columns[0]) >= F.when(F.col("stem") == "", 0).otherwise(LEAST_TEXTS)),
        "toxicity-stems",
    )
    total = sums.filter("stem = ''").first()
    if total is None or not 0 < total.bad1 < total.n1:
        return []
    rate = total.bad1 / total.n1
    each = [F.struct(F.lit(t).alias("times"), F.col(f"n{t}").alias("n"), F.col(f"bad{t}").alias("bad")) for t in TIMES]
    candidates = (
        sums.filter("stem <> ''").select("stem", F.explode(F.array(*each)).alias("c")).select("stem", "c.*")
    ).filter(F.col("n") >= LEAST_TEXTS)
    share = F.col("bad") / F.col("n")
    part_of = lambda p, q: F.when(p > 0, p * F.log(p / q)).otherwise(0.0)
    ratio = F.col("n") * (part_of(share, F.lit(rate)) + part_of(1 - share, F.lit(1 - rate)))
    bar = float(np.log(max(candidates.count(), 1)) + 3)
    strong = (
        candidates.withColumn("ratio", ratio)
        .filter((share > 2 * rate) & (share > 0.5) & (F.col("ratio") > bar))
        .orderBy(F.desc("ratio"), F.desc(F.length("stem")), "stem", "times")
        .limit(50 * most)  # the strongest only: the number of voters is a parameter
        .collect()
    )
    chosen: list[tuple[str, int]] = []
    for row in strong:
        begins = any(row.stem.startswith(f) or f.startswith(row.stem) for f, _ in chosen)
        if not begins and len(chosen) < most:
            chosen.append((row.stem, row.times))
    return chosen


def enough(times: np.ndarray | int, words: np.ndarray) -> np.ndarray:
    """Hits that a voter needs to vote on texts of so many words."""
    return times + (np.asarray(times) > 1) * words / WORDS_PER_TIME


def _sums(stems: list[str], n: list, bad: list) -> pa.RecordBatch:
    columns = [pa.array(np.asarray(c, np.int64)) for pair in zip(n, bad, strict=True) for c in pair]
    names = [f"{what}{times}" for times in TIMES for what in ("n", "bad")]
    return pa.RecordBatch.from_arrays([pa.array(stems, pa.string()), *columns], names=["stem", *names])


@dataclass
class Voters:
    """Seed words and found word beginnings, each with its place among the votes; patterns follow."""

    found: list[tuple[str, int]]

    def __post_init__(self) -> None:
        self.words = {w: k for k, w in enumerate(SEEDS)}
        self.stems = {stem: len(SEEDS) + k for k, (stem, _) in enumerate(self.found)}
        self.lengths = sorted({len(stem) for stem in self.stems})
        self.n_words = len(SEEDS) + len(self.found)
        self.size = self.n_words + len(PATTERNS) + 1
        #: Hits from which on a voter votes.
        self.times = np.array([1] * len(SEEDS) + [t for _, t in self.found] + [1] * (len(PATTERNS) + 1))

    def of_word(self, word: str) -> list[int]:
        own = [self.words.get(word)]
        own += [self.stems.get(word[:n]) for n in self.lengths if len(word) >= n]
        return [k for k in own if k is not None]

    def counts(self, texts: pa.Array) -> np.ndarray:
        """What each voter has: hits of words if they are enough to vote, 1 for a pattern that fits.

        The last one votes where no word or beginning does.
        """
        n = len(texts)
        distinct, words, rows = distinct_words(texts)
        out = np.zeros((n, self.size), np.float32)
        for word, hits in ((k, self.of_word(w)) for k, w in enumerate(distinct)):
            if hits:
                at = rows[words == word]
                for hit in hits:
                    np.add.at(out[:, hit], at, 1)
        strings = pc.fill_null(texts, "")
        length = pc.utf8_length(strings).to_numpy(zero_copy_only=False)
        per_row = np.bincount(rows, minlength=n)
        second = np.array([w in SECOND_PERSON for w in distinct], bool)
        addressed = np.bincount(rows[second[words]], minlength=n) if len(words) else np.zeros(n)
        capitals = pc.count_substring_regex(strings, r"\p{Lu}").to_numpy(zero_copy_only=False)
        marks = pc.count_substring(strings, "!").to_numpy(zero_copy_only=False)
        told = (length, per_row, capitals, marks, addressed)
        for k, (_, rule) in enumerate(PATTERNS):
            out[:, self.n_words + k] = rule(told)
        out = np.where(out >= enough(self.times[None, :], per_row[:, None]), out, 0)
        out[:, -1] = ~out[:, : self.n_words].any(axis=1)
        return out


def with_counts(docs: DataFrame, voters: Voters) -> DataFrame:
    """Add `hits`: the voters that hit and their counts, as (place, count) in binary."""

    @F.arrow_udf("binary")
    def of(texts: pa.Array) -> pa.Array:
        out = []
        batch = pa.RecordBatch.from_arrays([texts.cast(pa.string())], names=["text"])
        for part in text_slices([batch], "text"):
            for row in voters.counts(part.column(0)):
                places = np.flatnonzero(row)
                out.append(np.concatenate([places, np.minimum(row[places], 65535)]).astype("<u2").tobytes())
        return pa.array(out, pa.binary())

    return docs.withColumn("hits", of("text"))


def matrix(hits: pa.Array, size: int) -> np.ndarray:
    out = np.zeros((len(hits), size))
    for row, packed in zip(out, hits.to_pylist(), strict=True):
        pairs = np.frombuffer(packed, "<u2").reshape(2, -1)
        row[pairs[0]] = pairs[1]
    return out


@dataclass
class LabelModel:
    """How often voters vote in each class, and how much of its own say each one keeps."""

    prior: float
    rates: np.ndarray  # class, voter
    shares: np.ndarray  # voter

    def log_odds(self, votes: np.ndarray) -> np.ndarray:
        """A voter that does not vote abstains: a text of one language has no insults of another."""
        return np.log(self.prior / (1 - self.prior)) + votes @ (np.log(self.rates[1] / self.rates[0]) * self.shares)

    def posterior(self, votes: np.ndarray, toxic: np.ndarray) -> np.ndarray:
        """Probability of label 1; rows with a label (0 or 1, else -1) have it."""
        guessed = 1 / (1 + np.exp(-np.clip(self.log_odds(votes), -30, 30)))
        return np.where(toxic >= 0, toxic, guessed)


def first_model(size: int) -> LabelModel:
    """Before any row is seen: word voters mostly vote on toxic texts, patterns say nothing."""
    rates = np.full((2, size), 0.05)
    words = size - len(PATTERNS) - 1
    rates[0, :words], rates[1, :words] = 0.001, 0.2
    rates[:, -1] = 0.95, 0.1
    return LabelModel(0.1, rates, np.ones(size))


def refit(rows: DataFrame, model: LabelModel, size: int) -> LabelModel:
    """One round of expectation maximisation over all rows (hits, toxic or -1)."""

    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, size + 1, size + 1))
        for batch in batches:
            for k in range(0, batch.num_rows, 4096):
                part = batch.slice(k, 4096)
                votes = (matrix(part.column(0), size) > 0).astype(float)
                p = model.posterior(votes, part.column(1).to_numpy(zero_copy_only=False))
                full = np.hstack([votes, np.ones((len(votes), 1))])
                sums[1] += (full * p[:, None]).T @ full
                sums[0] += (full * (1 - p)[:, None]).T @ full
        yield cells(sums)

    sums = gathered(rows.select("hits", "toxic").mapInArrow(giving_back(expect), "cell int, value double"), (2, size + 1, size + 1))
    n = sums[:, -1, -1]
    prior = float(np.clip((n[1] + 1) / (n.sum() + 10), 1e-4, 0.9))
    rates = np.clip((sums[:, :-1, -1] + 0.05) / (n[:, None] + 1), 1e-6, 1 - 1e-6)
    # Voters that go together within a class are counted once between them.
    joint = sums[:, :-1, :-1] / np.maximum(n, 1e-9)[:, None, None]
    plain = sums[:, :-1, -1] / np.maximum(n, 1e-9)[:, None]
    spread = np.sqrt(np.maximum(plain * (1 - plain), 1e-9))
    correlation = (joint - plain[:, :, None] * plain[:, None, :]) / (spread[:, :, None] * spread[:, None, :])
    together = np.clip(correlation, 0, 1).max(axis=0)
    together[together < LEAST_CORRELATION] = 0
    np.fill_diagonal(together, 1)
    return LabelModel(prior, rates, 1 / together.sum(axis=1))


def cells(sums: np.ndarray) -> pa.RecordBatch:
    flat = sums.ravel()
    there = np.flatnonzero(flat)
    return pa.RecordBatch.from_pydict({"cell": pa.array(there.astype(np.int32)), "value": pa.array(flat[there])})


def gathered(parts: DataFrame, shape: tuple[int, ...]) -> np.ndarray:
    out = np.zeros(int(np.prod(shape)))
    for row in parts.groupBy("cell").agg(F.sum("value").alias("value")).collect():
        out[row.cell] = row.value
    return out.reshape(shape)


def features(counts: np.ndarray) -> np.ndarray:
    """What the classifier sees: each voter's log count, how many voters hit, and 1."""
    logs = np.log1p(counts)
    votes = counts[:, : counts.shape[1] - len(PATTERNS) - 1] > 0
    return np.hstack([logs, np.log1p(votes.sum(axis=1, keepdims=True)), np.ones((len(counts), 1))])


def trained(rows: DataFrame, model: LabelModel, size: int) -> np.ndarray:
    """Weights of a logistic regression on the posterior labels of all rows, by Newton's method."""
    d = size + 2
    weights = np.zeros(d)
    weights[-1] = np.log(model.prior / (1 - model.prior))
    for _ in range(NEWTON_ROUNDS):

        def slope(batches: Iterator[pa.RecordBatch], weights=weights) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((d + 1, d))
            for batch in batches:
                for k in range(0, batch.num_rows, 4096):
                    part = batch.slice(k, 4096)
                    counts = matrix(part.column(0), size)
                    target = model.posterior((counts > 0).astype(float), part.column(1).to_numpy(zero_copy_only=False))
                    x = features(counts)
                    p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
                    sums[:d] += (x * (p * (1 - p))[:, None]).T @ x
                    sums[d] += (target - p) @ x
            yield cells(sums)

        sums = gathered(rows.select("hits", "toxic").mapInArrow(giving_back(slope), "cell int, value double"), (d + 1, d))
        penalty = np.full(d, RIDGE)
        penalty[-1] = 1e-6
        step = np.linalg.solve(sums[:d] + np.diag(penalty), sums[d] - penalty * weights)
        step *= min(1.0, 4.0 / max(np.abs(step).max(), 1e-12))
        weights = weights + step
        if np.abs(step).max() < 1e-3:
            break
    return weights


@dataclass
class Classifier:
    voters: Voters
    weights: np.ndarray

    def score(self, texts: pa.Array) -> np.ndarray:
        return self.of_counts(self.voters.counts(texts))

    def of_counts(self, counts: np.ndarray) -> np.ndarray:
        z = features(counts) @ self.weights
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def scored(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """`docs` with `score` (0 to 1) and `predicted` (1 from `threshold` on) added.

    `labels` (id, toxic) must hold only what may be learned from. Its rows without an id or label
    are left out, several labels of one id count as toxic if any is. Null and empty texts are
    scored like others; rows without an id are scored but have no label. Labels of one class only,
    or none, leave the seed lexicon and patterns as voters. Columns of these names in `docs` are
    replaced; repeated rows are scored each.
    """
    docs = docs.drop("score", "predicted")
    rows = docs.select(
        F.struct(*[F.col(_quoted(c)) for c in docs.columns]).alias("row"),
        F.col(_quoted(id_column)).cast("long").alias("id"),
        F.coalesce(F.col(_quoted(text_column)), F.lit("")).alias("text"),
    )
    known = (
        labels.select(F.col(id_column).cast("long").alias("id"), F.col("toxic").cast("long").alias("toxic"))
        .dropna()
        .groupBy("id")
        .agg(F.max(F.when(F.col("toxic") > 0, 1).otherwise(0)).cast("long").alias("toxic"))
    )
    # Labels grow with the documents, so they are never broadcast.
    marked = staged(
        rows.select("id", "text").join(known.hint("merge"), "id").select("text", "toxic"), "toxicity-labelled"
    )
    voters = Voters(found_voters(marked))
    # The rows' texts are read once more; what follows works on the counts alone.
    counted = staged(with_counts(rows.select("id", "text"), voters).select("id", "hits"), "toxicity-counts")
    votes = staged(
        counted.join(known, "id", "left").select("hits", F.coalesce("toxic", F.lit(-1)).alias("toxic")), "toxicity-votes"
    )
    model = first_model(voters.size)
    for _ in range(EM_ROUNDS):
        model = refit(votes, model, voters.size)
    classifier = Classifier(voters, trained(votes, model, voters.size))

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        out = [np.zeros(0)]
        batch = pa.RecordBatch.from_arrays([texts.cast(pa.string())], names=["text"])
        for part in text_slices([batch], "text"):
            out.append(classifier.score(part.column(0)))
        return pa.array(np.concatenate(out))

    return (
        rows.withColumn("score", score("text"))
        .select(*[F.col(f"row.{_quoted(c)}").alias(c) for c in docs.columns], "score")
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    )


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
