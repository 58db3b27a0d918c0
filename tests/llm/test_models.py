"""Toxicity and the language model: held-out accuracy, gradients and brute-force counts."""

import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from orderlake.llm import attention, language_model, toxicity
from orderlake.llm.tables import held_out

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_held_out_is_crc32_of_the_text(spark):
    found = spark.range(200).select("id", held_out(F.col("id"), 4, 2).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in found)
    assert spark.range(1).select(held_out(F.lit(None).cast("long"), 4, 2)).first()[0] is False


def toxic_rows(n, seed):
    """Clean words, and in every eighth text some insults of one of two made-up languages."""
    draw = random.Random(seed)
    rows = []
    for k in range(n):
        words = [draw.choice(["wa", "no", "ti", "re"]) + draw.choice(["lo", "mi", "sa"]) * draw.randint(1, 3) for _ in range(draw.randint(5, 200))]
        toxic = int(k % 8 == 0)
        if toxic:
            stem = draw.choice(["grobu", "fiesto"])
            for _ in range(draw.randint(1, 4)):
                words[draw.randrange(len(words))] = stem + draw.choice(["a", "en", "ix", "o"])
        rows.append((k, " ".join(words).title() if k % 3 else " ".join(words), toxic))
    return rows


def test_toxicity_on_held_out_rows(spark):
    rows = toxic_rows(1600, 1)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i % 2 == 0], "doc_id long, toxic int")
    found = {r.doc_id: r for r in toxicity.scored(docs, labels).collect()}
    right = sum(found[i].predicted == y for i, _, y in rows if i % 2)
    assert right >= 0.99 * len(rows) / 2
    assert all(r.predicted == (r.score >= 0.3) for r in found.values())


def test_toxicity_edges(spark):
    rows = [(1, "you idiot"), (2, "fine words"), (3, None), (4, ""), (5, "x " * 100_000), (None, "stupid idiot scum"), (1, "you idiot")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"score": F.lit("s"), "row": F.lit("r")})
    for labels in ([], [(2, 0)], [(1, 1), (2, 0), (None, 1), (3, None), (1, 0)]):
        labelled = spark.createDataFrame(labels, "doc_id long, toxic int")
        found = toxicity.scored(docs, labelled)
        assert found.columns == ["doc_id", "text", "row", "score", "predicted"]
        got = found.collect()
        assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.row == "r" for r in got)
    assert toxicity.scored(docs.limit(0), labelled).collect() == []


def small_model():
    shape = attention.Shape(3, 4)
    rng = np.random.default_rng(0)
    flat = np.full((3, 4), 0.25)
    model = attention.initial(shape, np.log(np.full(3, 1 / 3)), np.log(flat))
    return shape, rng, {k: a.astype(np.float64) for k, a in model.items()}


def test_gradients():
    shape, rng, p = small_model()
    x, y = rng.integers(0, 13, (2, 7)), rng.integers(0, 12, (2, 7))
    valid = rng.random((2, 7)) < 0.7
    _, g = attention.gradients(p, x, y, valid, shape.slots)
    for name, a in p.items():
        for _ in range(6):
            at = tuple(rng.integers(0, n) for n in a.shape)
            if name == "place" and at[0] >= 7:
                continue
            step, old = 1e-5, a[at]
            a[at] = old + step
            up, _ = attention.gradients(p, x, y, valid, shape.slots)
            a[at] = old - step
            down, _ = attention.gradients(p, x, y, valid, shape.slots)
            a[at] = old
            assert g[name][at] == pytest.approx((up - down) / (2 * step), abs=2e-4)


def test_windows_count_every_place_once():
    rng = np.random.default_rng(1)
    lengths = (0, 1, attention.WINDOW, attention.WINDOW + 1, 500, 3)
    sequences = [rng.integers(0, 12, n) for n in lengths]
    x, y, valid, owner = attention.windows(sequences, 12)
    for k, own in enumerate(sequences):
        got = [v for row in np.flatnonzero(owner == k) for v in y[row][valid[row]]]
        assert got == own.tolist()
        if len(own):
            assert x[np.flatnonzero(owner == k)[0], 0] == 12
    assert len(attention.windows([], 12)[0]) == 0


def test_scorer_equals_the_plain_model_and_is_a_distribution():
    shape, rng, p = small_model()
    p = {k: a.astype(np.float32) for k, a in p.items()}
    sequences = [rng.integers(0, 12, n) for n in (1, 5, attention.WINDOW + 9)]
    x, y, valid, owner = attention.windows(sequences, 12)
    h, _ = attention.hidden(p, x)
    logs = attention.log_probabilities(p, h.reshape(-1, attention.WIDTH), y.ravel(), shape.slots).reshape(y.shape)
    plain = np.array([logs[owner == k][valid[owner == k]].sum() for k in range(3)])
    assert attention.Scorer(p, shape.slots).score(sequences) == pytest.approx(plain, rel=1e-4)
    # all continuations of one prefix sum to 1
    totals = attention.Scorer(p, shape.slots).score([np.array([3, 5, k]) for k in range(12)])
    prefix = attention.Scorer(p, shape.slots).score([np.array([3, 5])])[0]
    assert np.exp(totals - prefix).sum() == pytest.approx(1, rel=1e-4)


def test_fitting_learns_a_language_with_memory():
    """Units that follow from the one two places before: unigram counts tell nothing of them."""
    rng = np.random.default_rng(5)
    texts = []
    for _ in range(400):
        text = rng.integers(0, 12, 40)
        text[2:][rng.random(38) < 0.9] = -1
        for k in range(2, 40):
            if text[k] < 0:
                text[k] = (text[k - 2] * 5 + 3) % 12
        texts.append(text)
    shape, _, p = small_model()
    p = {k: a.astype(np.float32) for k, a in p.items()}
    x, y, valid, _ = attention.windows(texts[:360], 12)
    fitted = attention.fit(p, x, y, valid, shape.slots, 1e-2, 40, 1)
    held = attention.Scorer(fitted, shape.slots).score(texts[360:]).sum() / (40 * 40)
    assert held > -1.6 > -math.log(12)


def test_language_model(spark, monkeypatch):
    monkeypatch.setattr(language_model, "PRETRAIN_WORK", 60_000)
    draw = random.Random(4)
    stems = ["er", "on", "th", "an", "in", "re"]
    word = lambda: "".join(draw.choice(stems) for _ in range(draw.randint(1, 5)))
    rows = [(k, " ".join(word() for _ in range(draw.choice([2, 40, 300]))), k % 5 == 0) for k in range(120)]
    rows += [(500, None, False), (501, "", True), (502, " \n A  É\tb ", None), (None, "er on", False), (7, rows[7][1], False)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, held_out boolean").withColumn("chunk", F.lit("clash"))
    got = language_model.scored(docs.coalesce(2), PATH).collect()
    split = lambda t: [w.encode().lower().decode() for w in (t or "").replace("\n", " ").replace("\t", " ").split(" ") if w] + ["\n"]
    counts = {}
    for _, text, held in rows:
        for w in [] if held else split(text):
            counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    expected = []
    for doc_id, text, held in rows:
        words = split(text)
        base = sum(math.log10((counts.get(w, 0) + 1) / (n + v + 1)) for w in words)
        expected.append((doc_id, bool(held), len(words), sum(w in counts for w in words), round(base, 6)))
    found = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got]
    assert sorted(found, key=repr) == sorted(expected, key=repr)
    assert {r.train_tokens for r in got} == {n} and all(r.score < 0 and math.isfinite(r.score) for r in got)
    assert language_model.scored(docs.limit(0), PATH).collect() == []


def test_every_training_window_gives_a_gradient(spark, monkeypatch):
    draw = random.Random(6)
    rows = [(k, " ".join(draw.choice(["ther", "onan", "inre"]) for _ in range(draw.choice([1, 90, 400]))), k % 4 == 0) for k in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, held_out boolean").coalesce(1)
    parts = language_model.chunks(docs, PATH).union(language_model.chunks(docs.filter("doc_id > 30"), PATH)).toArrow()
    place = np.arange(200_000, dtype=np.int32) % (language_model.GROUPS * language_model.SLOTS)
    wanted = 0
    for batch in parts.to_batches():
        for row in range(batch.num_rows):
            chunk = language_model.arrays(batch, row)
            learnt = np.flatnonzero(~np.array(chunk["held_out"].as_py()))
            wanted += sum(map(len, language_model.sequences(chunk, place, learnt)))
    seen = []

    def fit(model, x, y, valid, slots, rate, passes, seed):
        seen.append((valid.sum(), passes))
        return model

    monkeypatch.setattr(attention, "fit", fit)
    # A corpus of any size: what a task learns from does not depend on the total.
    model, n = language_model.trained(iter(parts.to_batches()), place, {"start": 1})
    assert model == {"start": 1} and n > 0 and len(seen) == 2  # chunk by chunk
    assert sum(v for v, _ in seen) == wanted and {p for _, p in seen} == {1}
