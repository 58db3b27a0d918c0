"""Prefix hashes, line dedup, licences, chat pairs, decontamination: against brute force."""

import hashlib
import math
import random
import resource

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
import orderlake.llm.queries  # noqa: F401
from orderlake.llm import chat, decontaminate, licences, line_dedup, prefix_hash
from orderlake.llm.registry import ORACLE_SQL, QUERIES
from tests.tools import comparable

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_oracle(spark, name):
    duck = duckdb.connect()
    for t in ("documents", "pages", "conversations", "benchmark", "labels", "embeddings"):
        duck.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    expected = duck.execute(ORACLE_SQL[name]).to_arrow_table()
    result = QUERIES[name](spark, SMALL)
    assert sorted(result.columns) == sorted(expected.column_names)
    assert comparable(result.toArrow()) == comparable(expected)


# --- prefix hashes -------------------------------------------------------------------------

texts = st.text(alphabet="abÉ\U0001f600 ", max_size=60)


@given(texts, texts, st.integers(0, 60), st.integers(0, 60))
@settings(max_examples=200, deadline=None)
def test_extensions(a, b, i, j):
    i, j = min(i, len(a)), min(j, len(b))
    n = 0
    while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
        n += 1
    x, y = (prefix_hash.PrefixHashes(prefix_hash.code_points(t)) for t in (a, b))
    assert x.extension(i, y, j) == n


@given(texts, texts)
@settings(max_examples=200, deadline=None)
def test_fingerprints_tell_texts_apart(a, b):
    x, y = prefix_hash.fingerprint(a), prefix_hash.fingerprint(b)
    assert (x == y) == (a == b)
    near = prefix_hash.Fingerprint.parse(x).likeness(prefix_hash.Fingerprint.parse(y))
    assert 0 <= near <= 1 and (near == 1) == (a == b)


def test_likeness_of_long_texts():
    draw = random.Random(1)
    text = "".join(draw.choice("abcdefgh ") for _ in range(40_000))
    mark = lambda t: prefix_hash.PrefixHashes(prefix_hash.code_points(t)).fingerprint()
    assert mark(text).likeness(mark(text[:30_000] + "!" + text[30_001:])) > 0.9
    assert 0.2 < mark(text).likeness(mark(text[:10_000])) <= 0.25
    assert mark(text).likeness(mark(text[::-1])) < 0.1


def test_edited_by_successor(spark):
    draw = random.Random(2)
    rows = [(3 * k, "".join(draw.choice("ab É\n") for _ in range(draw.choice([0, 1, 2, 7, 300])))) for k in range(60)]
    rows += [(200, None), (201, "same"), (201, "same"), (202, "z" * 150_000), (None, "nameless"), (-5, "first")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("block", F.lit("x"))
    found = [r for r in prefix_hash.edited_by_successor(docs, blocks=7).collect() if r.doc_id is not None]
    ordered = sorted((i, t or "") for i, t in rows if i is not None)
    expected = []
    for k, (doc_id, text) in enumerate(ordered):
        following = ordered[(k + 1) % len(ordered)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        expected.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), prefix_hash.fingerprint(edited)))
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256, r.edited_fingerprint) for r in found) == sorted(expected)
    nameless = prefix_hash.edited_by_successor(docs, blocks=7).filter("doc_id is null").collect()
    assert [(r.n_chars, r.edited_sha256) for r in nameless] == [(8, None)]
    assert prefix_hash.edited_by_successor(docs.limit(0)).collect() == []
    one = prefix_hash.edited_by_successor(docs.filter("doc_id = 201").limit(1)).collect()
    assert [(r.doc_id, r.near_next) for r in one] == [(201, 1.0)]


def test_near_copies_share_spans_between_edits(spark):
    """A long copy with edits at both ends and scattered over the middle, one that shifts what follows."""
    draw = random.Random(3)
    text = "".join(draw.choice("abcdefgh ") for _ in range(120_000))
    copy = "X" + text[1:40_000] + "inserted" + text[40_000:80_000] + text[80_100:-1] + "Y"
    for k in range(5_000, 115_000, 10_000):
        copy = copy[:k] + "#" + copy[k + 1 :]
    docs = spark.createDataFrame([(1, text), (2, copy), (3, text[::-1])], "doc_id long, text string")
    found = {r.doc_id: r for r in prefix_hash.edited_by_successor(docs, blocks=2).collect()}
    assert 0.99 * len(copy) < found[1].shared_next < len(copy) and found[2].shared_next < 0.01 * len(copy)
    assert 0.95 < found[1].near_next < 1 and found[2].near_next < 0.01
    for r in found.values():
        own, edited, following = map(prefix_hash.Fingerprint.parse, (r.fingerprint, r.edited_fingerprint, r.next_fingerprint))
        assert (r.near_edited, r.near_next) == (own.likeness(edited), own.likeness(following))


@given(texts, texts)
@settings(max_examples=200, deadline=None)
def test_likeness_of_short_texts_is_exact_and_the_same_both_ways(a, b):
    a, b = a + b[:30] + "!" + a, b + a[:30]
    x, y = (prefix_hash.PrefixHashes(prefix_hash.code_points(t)).fingerprint() for t in (a, b))
    assert x.likeness(y) == y.likeness(x) == prefix_hash.Fingerprint.parse(str(x)).likeness(y)
    spans = [{t[k : k + prefix_hash.SPAN] for k in range(len(t) - prefix_hash.SPAN + 1)} for t in (a, b)]
    most = max(map(len, spans))
    if all(spans) and most <= prefix_hash.SAMPLE:
        assert x.common_spans(y) == pytest.approx(len(spans[0] & spans[1]) / most)
        assert x.likeness(y) >= min(len(spans[0] & spans[1]) / most, (min(len(a), len(b)) - 1) / max(len(a), len(b))) - 1e-9


@pytest.mark.parametrize("size", [200, 5_000, 60_000])
def test_a_moved_passage_counts_both_ways(size):
    draw = random.Random(size)
    head, passage, tail = ("".join(draw.choice("abcdefgh ") for _ in range(size)) for _ in range(3))
    mark = lambda t: prefix_hash.PrefixHashes(prefix_hash.code_points(t)).fingerprint()
    x, y, z = mark(head + passage + tail), mark(passage + tail + head), mark(head[::-1] + passage[::-1])
    assert 0.75 < x.likeness(y) == y.likeness(x) < 1
    assert x.likeness(z) < 0.05


@given(texts, texts)
@settings(max_examples=200, deadline=None)
def test_shared_spans_are_common_subsequences(a, b):
    a, b = a + b[:40] + "!" + a, b + a[:40] + "?" + a
    x, y = (prefix_hash.PrefixHashes(prefix_hash.code_points(t)) for t in (a, b))
    common = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, c in enumerate(a):
        for j, d in enumerate(b):
            common[i + 1][j + 1] = common[i][j] + 1 if c == d else max(common[i][j + 1], common[i + 1][j])
    assert x.shared(y) <= common[-1][-1]


def test_common_extensions(spark):
    rows = [("xxabc", "abd", 2, 0), (None, "a", 0, 0), ("a", "a", None, 0), ("a", "a", 9, 0), ("é" * 1000, "é" * 999, 0, 0)]
    df = spark.createDataFrame(rows, "a string, b string, i long, j long")
    assert [r.extension for r in prefix_hash.common_extensions(df, "a", "b", "i", "j").collect()] == [2, 0, 0, 0, 999]


# --- lines ---------------------------------------------------------------------------------


def test_boilerplate(spark):
    rows = [(k, "hot", f"menu \nown {k}\n\nfoot\nfoot" if k % 2 else f"own {k}\n menu") for k in range(40)]
    rows += [(100, "small", "menu\nx"), (101, "small", "menu\ny"), (102, None, "a\nb"), (103, None, None), (104, "hot", "")]
    rows += [(105, "hot", " menu"), (105, "hot", " menu"), (106, "hot", "x" * 200_000)]
    docs = spark.createDataFrame(rows, "doc_id long, host string, text string").withColumns(
        {"row": F.lit("r"), "lines": F.lit(1), "n_lines": F.lit(-1), "boilerplate": F.lit("b"), "pages": F.lit(0)}
    )
    found = line_dedup.drop_boilerplate(docs, F.col("host"), ratio=0.4, counts=True)
    got = {r.doc_id: (r.text, r.n_lines, r.n_dropped, r.row, r.boilerplate) for r in found.collect()}
    assert found.count() == len(rows)
    assert got[1] == ("own 1\n", 4, 3, "r", "b")
    assert got[2] == ("own 2", 2, 1, "r", "b")
    assert got[100][:3] == ("menu\nx", 2, 0)  # two pages are too few
    assert got[102][:3] == ("a\nb", 2, 0) and got[103][:3] == (None, 0, 0)
    assert got[104][:3] == ("", 0, 0) and got[105][:3] == ("", 1, 1)
    assert got[106][1:3] == (1, 0)
    plain = line_dedup.drop_boilerplate(docs, F.col("host"), ratio=0.4)
    assert plain.columns == docs.columns and {r.n_lines for r in plain.collect()} == {-1}
    assert line_dedup.drop_boilerplate(docs.limit(0), F.col("host")).collect() == []


def test_passages_of_a_large_source(spark):
    """A passage on some tens of thousands of documents goes; copies of a whole document and short lines stay."""
    words = lambda n, seed: " ".join(f"w{seed}x{k}" for k in range(n))
    passage, short, copied, rare = words(60, 1), words(49, 2), words(80, 3), words(70, 4)
    rows = [(k, "big", f"own {k}" + f"\n {passage} " * (k % 100 == 0) + f"\n{short}" * (k % 50 == 1)) for k in range(4000)]
    rows += [(5000 + k, "big", f"{copied}\nend") for k in range(9)] + [(6000 + k, "big", f"{rare}\n{k}") for k in range(2)]
    rows += [(7000, "other", passage), (7001, "big", None), (7002, None, passage)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    docs = docs.withColumn("lang", F.lit("en")).withColumn("n_chars", F.length("text").cast("long"))
    stage = dict(corpus_pipeline.STAGES)["line dedup"]
    found = {r.doc_id: r.text for r in stage(spark, docs, SMALL).collect()}
    expected = {i: t if i == 7000 or i == 7002 or t is None else t.replace(f"\n {passage} ", "") for i, _, t in rows}
    assert found == expected
    plain = line_dedup.drop_boilerplate(docs, F.col("source"), counts=True).agg(F.sum("n_dropped")).first()[0]
    assert plain == 0


def test_html_lines_and_hosts(spark):
    html = "<p class='a'>One<br/>Two <b>bold</b></p><script>var t='</p>';</script><!-- <p>no</p> --><pre>x</pre>"
    row = spark.createDataFrame([(html, "HTTPS://M.Example.org:80/a?b"), (None, "nothing")], "h string, u string").select(
        line_dedup.html_lines(F.col("h")).alias("t"), line_dedup.url_host(F.col("u")).alias("u")
    ).collect()
    assert [line.strip() for line in row[0].t.split("\n") if line.strip()] == ["One", "Two bold", "x"]
    assert row[0].u == "m.example.org:80" and tuple(row[1]) == (None, None)


# --- licences ------------------------------------------------------------------------------


def brute_words(text):
    out, word = [], ""
    for c in text or "":
        c = c.lower() if "A" <= c <= "Z" else c
        if "0" <= c <= "9" or "a" <= c <= "z" or ord(c) > 0x7F:
            word += c
        else:
            out += [word] if word else []
            word = ""
    return out + ([word] if word else [])


def test_licences(spark):
    apache = "Licensed under the Apache License, Version 2.0"
    gpl = "This work is licensed under the GNU General Public License, version 3."
    mit = licences.TEMPLATES[2][1]
    rows = [
        (1, f"x {apache}. y {apache}"), (2, gpl), (3, mit.upper()), (4, "mit license apache version 2"), (5, None), (6, ""),
        (7, "CC-BY-NC 4.0, under the MIT\nLicense"), (8, "é " * 20_000 + apache), (9, "license " * 3_000),
        (10, mit.replace("without restriction", "with some restriction")), (10, gpl), (11, "général public licence license gnu"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"words": F.lit("w"), "score": F.lit("s")})
    found = {(r.doc_id, (r.text or "")[:4]): r for r in licences.scan(docs).collect()}
    assert len(found) == len(rows)
    for doc_id, text in rows:
        r, words = found[doc_id, (text or "")[:4]], brute_words(text)
        places = [
            (label, i)
            for label, phrase in licences.BASE_PHRASES.items()
            for i in range(len(words))
            if words[i : i + len(phrase.split())] == phrase.split()
        ]
        assert r.n_words == len(words) and sorted(map(tuple, r.base_places)) == sorted(places)
        assert r.base_labels == sorted({p[0] for p in places}) and set(r.base_labels) <= set(r.labels)
        assert 0 <= r.score <= 1 and r.words == "w"
    labels = {k: v.labels for k, v in found.items()}
    assert labels[2, gpl[:4]] == ["gpl-3"] and labels[3, mit[:4].upper()] == ["mit"] and labels[4, "mit "] == []
    assert labels[7, "CC-B"] == ["cc-by-nc", "mit"] and labels[9, "lice"] == [] and labels[10, mit[:4]] == []
    assert found[2, gpl[:4]].alignments[0].first == 0 and found[2, gpl[:4]].score == pytest.approx(1)
    assert licences.scan(docs.limit(0)).collect() == []


def test_no_licence_is_crowded_out_by_another(spark):
    """Two licences in a file, and a text with every template word, among many that make the GPL's words common."""
    mit = licences.TEMPLATES[2][1]
    gpl = "This work is licensed under the GNU General Public License, version 3."
    all_words = " ".join(licences.VOCABULARY)
    apache = next(text for label, text, _ in licences.TEMPLATES if label == "apache-2")
    rows = [(1, f"{mit}. {gpl}"), (2, f"{all_words} " * 200 + gpl), (3, f"{all_words} {apache} x {all_words}")]
    rows += [(10 + k, "gnu general public licensed under the work is this version 3") for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in licences.scan(docs).collect()}
    assert found[1].labels == ["gpl-3", "mit"] and "gpl-3" in found[2].labels and "apache-2" in found[3].labels
    assert {r.label for r in found[1].alignments} == {"gpl-3", "mit"}


@pytest.mark.parametrize("seed", range(3))
def test_alignments_equal_all_starts(spark, seed):
    """Every start with all mandatory phrases and score enough, by brute force, from mutilated templates."""
    draw = random.Random(seed)
    rows = []
    for k in range(60):
        words = []
        for _ in range(draw.randint(1, 5)):
            part = draw.choice(licences.TEMPLATES)[1].split()
            words += [w if draw.random() < 0.95 else draw.choice(licences.VOCABULARY) for w in part]
            words += draw.choices(licences.VOCABULARY, k=draw.randint(0, 9))
        rows.append((k, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    n, frequency = licences.document_frequencies(docs)
    idf = {w: math.log((n + 1) / (frequency.get(w, 0) + 1)) + 1e-3 for w in licences.VOCABULARY}
    found = {r.doc_id: r for r in licences.scan(docs).collect()}
    for k, text in rows:
        words, expected = text.split(), []
        for label, template, phrases in licences.TEMPLATES:
            own = template.split()
            stands = [" ".join(own).split(p)[0].count(" ") for p in phrases]
            for i in range(-len(own), len(words)):
                at = lambda j: words[i + j] if 0 <= i + j < len(words) else None  # noqa: B023, E731
                if all(at(s + m) == w for s, p in zip(stands, phrases, strict=True) for m, w in enumerate(p.split())):
                    score = sum(idf[w] for j, w in enumerate(own) if at(j) == w) / sum(idf[w] for w in own)
                    expected += [(label, i, round(score, 6))] if score >= licences.LEAST_SCORE else []
        assert sorted((a.label, a.first, round(a.score, 6)) for a in found[k].alignments) == sorted(expected)


def test_every_wording_gives_its_label_alone(spark):
    """Each template by itself, and within other text, in capitals and with line breaks and stops."""
    rows = [
        (k, way, before + text.replace(" ", gap) + after)
        for k, (_, text, _) in enumerate(licences.TEMPLATES)
        for way, (before, gap, after) in enumerate([("", " ", ""), ("see file ", "\n * ", ". end")])
    ]
    docs = spark.createDataFrame([(k, w, t.upper() if w else t) for k, w, t in rows], "k long, way long, text string")
    for r in licences.scan(docs).collect():
        assert r.labels == [licences.TEMPLATES[r.k][0]], licences.TEMPLATES[r.k]
        assert r.score == pytest.approx(1)


def test_every_label_needs_a_telltale():
    phrases = [[p] for p in licences.BASE_PHRASES.values()] + [mandatory for _, _, mandatory in licences.TEMPLATES]
    assert all(any(t in p for p in options for t in licences.TELLTALES) for options in phrases)
    assert all(p in text for _, text, mandatory in licences.TEMPLATES for p in mandatory)


# --- chat ----------------------------------------------------------------------------------


def brute_pair(a, b, role="assistant"):
    n = 0
    while n < min(len(a), len(b)) and a[n][1:] == b[n][1:]:
        n += 1

    def render(turns):
        out, spans = "", []
        for _, who, text in turns:
            out += f"<|im_start|>{who or ''}\n"
            start = len(out)
            out += (text or "").replace("<|im_", "< |im_") + "<|im_end|>"
            spans += [(start, len(out))] if who == role else []
            out += "\n"
        return out, spans

    return (render(a[:n])[0], n, *render(a[n:]), *render(b[n:]))


def test_preference_rows(spark):
    draw = random.Random(3)
    sides = []
    for _ in range(2):
        turns = []
        for pair in range(40):
            for t in range(draw.randint(0, 5)):
                text = draw.choice(["same", "same", "other", "", None, "a<|im_end|>b", "é" * 5])
                turns.append((pair, t, draw.choice(["user", "assistant", None]), text))
        turns += [(99, 0, "user", "u"), (99, 0, "user", "u"), (99, 0, "assistant", "u")] + [(98, 0, "user", "x" * 100_000)]
        draw.shuffle(turns)
        sides.append(turns)
    ddl = "pair_id long, turn long, role string, text string"
    frames = [spark.createDataFrame(s, ddl).withColumn("a", F.lit(1)) for s in sides]
    found = chat.preference_rows(*frames).collect()
    key = lambda t: [(x is not None, x) for x in t[1:]]
    for r in found:
        a, b = (sorted([t for t in s if t[0] == r.pair_id], key=key) for s in sides)
        strip = lambda s: [(t[1], t[2], t[3]) for t in s]
        prompt, n, chosen, spans, rejected, other = brute_pair(strip(a), strip(b))
        assert (r.prompt, r.prompt_turns, r.chosen, r.rejected) == (prompt, n, chosen, rejected)
        assert [tuple(s) for s in r.chosen_mask] == spans and [tuple(s) for s in r.rejected_mask] == other
        assert r.differ == bool(chosen or rejected)
    assert {r.pair_id for r in found} == {t[0] for s in sides for t in s}
    assert chat.preference_rows(frames[0].limit(0), frames[1].limit(0)).collect() == []


# --- decontamination -----------------------------------------------------------------------


def brute_tiles(text, item, least):
    in_text, in_item, tiles = [False] * len(text), [False] * len(item), 0
    while True:
        best = (least - 1, 0, 0)
        for p in range(len(item)):
            for t in range(len(text)):
                n = 0
                while (p + n < len(item) and t + n < len(text) and item[p + n] == text[t + n]
                       and not in_text[t + n] and not in_item[p + n]):
                    n += 1
                if n > best[0]:
                    best = (n, p, t)
        n, p, t = best
        if n < least:
            return sum(in_item), tiles
        tiles += 1
        for k in range(n):
            in_text[t + k] = in_item[p + k] = True


def windows(tokens, size, names):
    """Places of all windows, and a number for each that equal ones share."""
    all_of = [tuple(tokens[k : k + size].tolist()) for k in range(len(tokens) - size + 1)]
    return np.arange(len(all_of)), np.array([names.setdefault(w, len(names)) for w in all_of], int)


@pytest.mark.parametrize("most", [1 << 20, 7])
@pytest.mark.parametrize("seed", range(6))
def test_tiles(seed, most, monkeypatch):
    monkeypatch.setattr(decontaminate, "SEEDS", most)
    draw = random.Random(seed)
    for _ in range(60):
        item = [draw.randrange(6) for _ in range(draw.randint(3, 25))]
        text = []
        for _ in range(draw.randint(1, 5)):
            a = draw.randrange(len(item))
            text += item[a : a + draw.randint(1, 12)] + [draw.randrange(6) for _ in range(draw.randint(0, 3))]
        text, item = np.array(text), np.array(item)
        names = {}
        (at, name), (place, own) = windows(text, 3, names), windows(item, 3, names)
        shuffled = np.random.default_rng(seed).permutation(len(at))
        runs = decontaminate.equal_runs(text, item, at[shuffled], name[shuffled], place, own, 3)
        assert decontaminate.tile(len(text), len(item), runs, 3) == brute_tiles(text.tolist(), item.tolist(), 3)


def test_deceiving_hashes_are_no_runs():
    text, item = np.array([1, 2, 3, 4]), np.array([1, 2, 9, 4])
    runs = decontaminate.equal_runs(text, item, np.arange(3), np.zeros(3, int), np.arange(3), np.zeros(3, int), 2)
    assert runs.T.tolist() == [[2, 0, 0]]


def test_one_word_a_million_times(spark):
    """Two texts of one word have as many equal windows as the product of their lengths."""
    items = decontaminate.Items((1, 2, 3), ("ha " * 300, "ha " * 7, "ha " * 100 + "w " * 300), 5)
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    found = list(items.overlaps(pa.array(["ha " * 1_000_000, "no", "ha ha ha ha ha ha"]), 0.8))
    assert (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) / 1024 < 1000
    assert sorted(found) == [(0, 1, 1, 300, 300), (0, 2, 1, 7, 7), (2, 2, 1, 6, 7)]


def test_rows_are_taken_in_portions():
    counts = np.array([5, 0, 9, 1, 1, 30, 2])
    parts = [p.tolist() for p in decontaminate.portions(np.flatnonzero(counts), counts, 10)]
    assert parts == [[0], [2, 3], [4], [5], [6]]


def test_overlaps(spark):
    draw = random.Random(5)
    words = lambda n: " ".join(f"w{draw.randrange(4000)}" for _ in range(n))
    items = [(k, words(30)) for k in range(30)] + [(50, "two words"), (51, None), (52, " !! "), (None, words(20)), (53, items_last := words(40))]
    passage = items[3][1].split()
    moved = " ".join(passage[15:] + ["and"] + passage[:15])
    docs = [
        (1, words(200) + " " + items[0][1].upper().replace(" ", ", ") + "! " + words(50)), (2, moved), (3, words(400)),
        (4, " ".join(passage[:20])), (5, None), (6, ""), (7, words(30_000) + " " + items[7][1] + " " + words(10)),
        (8, "here are two words"), (9, items[30 + 3][1]), (2, moved), (None, items_last),
    ]
    bench = spark.createDataFrame(items, "item_id long, text string")
    table = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    expected = [(None, 53), (1, 0), (2, 3), (2, 3), (7, 7), (8, 50), (9, None)]
    for chars in (4_000_000, 700):  # one block, several
        found = decontaminate.overlaps(table, bench, block_chars=chars).collect()
        assert sorted([(r.doc_id, r.item_id) for r in found], key=repr) == sorted(expected, key=repr)
        clean = decontaminate.without_leaks(table, bench, block_chars=chars)
        assert sorted(r.doc_id for r in clean.collect()) == [3, 4, 5, 6] and clean.columns == table.columns
    assert {r.tiles for r in found if r.doc_id == 2} == {2}
    assert decontaminate.overlaps(table.limit(0), bench).collect() == []
    assert decontaminate.overlaps(table, bench.limit(0)).collect() == []
    assert decontaminate.without_leaks(table, bench.limit(0)).count() == len(docs)


def test_no_seed_in_a_slice():
    items = decontaminate.Items((1,), ("a b c d e f",), 5)
    assert list(items.overlaps(pa.array(["f e d c b a", "", None]), 0.8)) == []
