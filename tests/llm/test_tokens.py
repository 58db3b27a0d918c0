"""Token encoding, packing and record files."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from orderlake.llm import packing, token_records
from orderlake.llm.tables import text_slices
from orderlake.llm.tokens import WordEncoder

PATH = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(PATH)
ENCODER = WordEncoder(PATH, cached=50)


def ids_of(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


@given(st.lists(st.one_of(st.none(), st.text(max_size=40), st.text(alphabet="aÉİ<|>endoftextENDOFTEXT,.!'s \n ́ ", max_size=40)), max_size=5))
@settings(max_examples=300, deadline=None)
def test_words_encode_like_whole_texts(texts):
    ids, begins = ENCODER.encode(pa.array(texts, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(begins[:-1], begins[1:], strict=True)] == [ids_of(t) for t in texts]


def test_special_tokens():
    texts = ["a<|endoftext|>b", "<|ENDOFTEXT|>", "<|startoftext|> x", "word, word. WORD!? word.,"]
    ids, begins = ENCODER.encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(begins[:-1], begins[1:], strict=True)] == [ids_of(t) for t in texts]


def test_text_slices():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * 10, None, "", "b" * 25, "c"]}).slice(1)
    parts = list(text_slices(iter([batch, batch.slice(0, 0)]), "text", 20))
    assert [p.column(0).to_pylist() for p in parts] == [[None, ""], ["b" * 25], ["c"]]


def documents(spark, n=300, seed=1):
    draw = random.Random(seed)
    rows = [(k, " ".join(draw.choice(["the", "word", "Ertionth,", "é", "x1"]) for _ in range(draw.choice([0, 3, 90, 900])))) for k in range(n)]
    rows += [(1000, None), (1001, "the " * 30_000), (7, rows[7][1]), (None, "nameless row")]
    draw.shuffle(rows)
    return rows, spark.createDataFrame(rows, "doc_id long, text string").withColumn("length", F.lit("clash")).repartition(5)


def test_packing(spark):
    rows, docs = documents(spark)
    pieces = packing.pack(docs, PATH, end_id=1).collect()
    full = {(i, t): [*ids_of(t), 1] for i, t in rows}
    assert sum(p.length for p in pieces) == sum(len(full[r]) for r in rows)
    windows = defaultdict(list)
    for p in pieces:
        windows[p.sequence_id].append(p)
        options = [v for (i, _), v in full.items() if i == p.doc_id and len(v) == p.doc_tokens]
        crcs = {zlib.crc32(np.array(v[p.start : p.start + p.length], "<u4")) for v in options}
        assert p.ids_crc32 in crcs
    groups = defaultdict(set)
    for own in windows.values():
        own.sort(key=lambda p: p.offset)
        total = 0
        for p in own:
            assert p.offset == total and p.length > 0
            total += p.length
        assert total == own[0].tier <= 2048 and total & (total - 1) == 0  # nothing is padded
        groups[own[0].step_group].add((own[0].tier, own[0].sequence_id))
    for members in groups.values():
        assert len({t for t, _ in members}) == 1 and sum(t for t, _ in members) <= packing.GROUP_TOKENS
    starts = defaultdict(list)
    for p in pieces:
        starts[p.doc_id].append((p.start, p.length))
    assert sorted(starts[1001])[0][0] == 0 and sum(n for _, n in starts[1001]) == len(full[1001, "the " * 30_000])
    assert packing.pack(docs.limit(0), PATH, 1).collect() == []
    with pytest.raises(ValueError):
        packing.Packer((3, 8), 0)


@pytest.mark.parametrize("group_tokens", [1, 600, 1 << 13])
def test_step_groups_are_equal_over_all_tasks(spark, group_tokens):
    """Of each length, every group has the same number of windows but one, however many tasks pack."""
    draw = random.Random(5)
    rows = [(k, "the " * draw.choice([0, 3, 100, 700, 5_000])) for k in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    pieces = packing.pack(docs, PATH, 1, tiers=(64, 128, 256), group_tokens=group_tokens).collect()
    assert len({p.sequence_id >> packing.TASK_BITS for p in pieces}) > 1
    groups = defaultdict(set)
    for p in pieces:
        groups[p.tier, p.step_group].add(p.sequence_id)
    assert len({g for _, g in groups}) == len(groups)
    for tier in {t for t, _ in groups}:
        sizes = sorted(len(members) for (t, _), members in groups.items() if t == tier)
        full = max(1, group_tokens // tier)
        assert sizes[1:] == [full] * (len(sizes) - 1) and 0 < sizes[0] <= full


def test_records_round_trip(spark, tmp_path):
    rows, docs = documents(spark)
    manifest = token_records.write_records(docs, str(tmp_path / "r"), PATH, end_id=2, shards=4)
    found = token_records.records_with_starts(token_records.read_records(spark, str(tmp_path / "r"), most=3000), manifest)
    got = sorted(found.collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    total = 0
    for r in got:
        assert r.start == total
        total += r.n_tokens
        options = {(len(v), zlib.crc32(np.array(v, "<u4"))) for i, t in rows if i == r.doc_id for v in [[*ids_of(t), 2]]}
        assert (r.n_tokens, r.ids_crc32) in options
    entry = manifest.orderBy("shard").first()
    doc_id, before, ids = token_records.read_record(token_records.uri(str(tmp_path / "r")), entry.file, 1, entry.width)
    assert (doc_id, before, len(ids)) == (got[1].doc_id, got[1].start, got[1].n_tokens)
    empty = token_records.write_records(docs.limit(0), str(tmp_path / "e"), PATH, end_id=2, shards=2)
    assert empty.count() == 0 and token_records.read_records(spark, str(tmp_path / "e")).count() == 0


def test_damage_is_found(tmp_path):
    data = bytearray(token_records.frame(token_records.payload_of(5, 7, np.arange(9), 2)))
    payload, end = token_records.unframe(memoryview(bytes(data)), 0)
    doc_id, before, ids = token_records.parse_payload(payload, 2)
    assert (doc_id, before, ids.tolist(), end) == (5, 7, list(range(9)), len(data))
    for k in range(len(data)):
        bad = bytes(data[:k]) + bytes([data[k] ^ 1]) + bytes(data[k + 1 :])
        with pytest.raises(ValueError):
            token_records.unframe(memoryview(bad), 0)
    with pytest.raises(ValueError):
        token_records.unframe(memoryview(bytes(data[:-1])), 0)
    index = token_records.index_bytes([(0, 3), (40, 9)])
    assert token_records.parse_index(index).tolist() == [[0, 3], [40, 9]]
    with pytest.raises(ValueError):
        token_records.parse_index(index[:-1] + bytes([index[-1] ^ 1]))
