"""The registered queries over whole small tables, against plain code from their contracts."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
import public_tokenizers
import xxhash
from tokenizers import Tokenizer

from orderlake.llm import licences, prefix_hash, queries  # noqa: F401 (registers the queries)
from orderlake.llm.registry import QUERIES

SMALL = "/root/testdata/sf0.001"
TOKENIZER = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
UPPER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LICENCE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@pytest.fixture(scope="module")
def documents():
    rows = pq.read_table(f"{SMALL}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    return {r["doc_id"]: r["text"] or "" for r in sorted(rows, key=lambda r: r["doc_id"])}


def rows_of(spark, name, documents):
    found = {r.doc_id: r for r in QUERIES[name](spark, SMALL).collect()}
    assert set(found) == set(documents)
    return found


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def remainder(doc_id, modulus):
    return zlib.crc32(str(doc_id).encode()) % modulus


def words_of(text):
    return WORD.findall(text.translate(UPPER))


def test_op1(spark, documents):
    marks = {}
    for doc_id, text in documents.items():
        words = words_of(text)
        shingles = [" ".join(words[k : k + 4]) for k in range(max(len(words) - 3, 1))] if words else []
        hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
        marks[doc_id] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    component = {i: i for i in marks}
    for a in sorted(marks):  # ascending, so that a class takes its smallest id
        reached = [a] if component[a] == a else []
        while reached:
            x = reached.pop()
            for b in marks:
                if component[b] == b != a and b > a and (marks[x] ^ marks[b]).bit_count() <= 4:
                    component[b] = a
                    reached.append(b)
    found = rows_of(spark, "op1_simhash_near_dedup", documents)
    assert {i: (r.fingerprint, r.component_id) for i, r in found.items()} == {
        i: (f"{m:016x}", component[i]) for i, m in marks.items()
    }


def test_op3(spark, documents):
    ids = list(documents)
    parse = prefix_hash.Fingerprint.parse
    found = rows_of(spark, "op3_document_fingerprints", documents)
    for k, doc_id in enumerate(ids):
        r, text, following = found[doc_id], documents[doc_id], documents[ids[(k + 1) % len(ids)]]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        marks = [prefix_hash.fingerprint(t) for t in (text, edited, following)]
        assert [r.fingerprint, r.edited_fingerprint] == marks[:2]
        assert (r.near_edited, r.near_next) == tuple(parse(marks[0]).likeness(parse(m)) for m in marks[1:])


def test_op5(spark, documents):
    tokens = {i: [*words_of(t), "\n"] for i, t in documents.items()}
    counts = Counter(w for i, own in tokens.items() if remainder(i, 7) != 2 for w in own)
    n, v = sum(counts.values()), len(counts)
    for doc_id, r in rows_of(spark, "op5_lm_scoring", documents).items():
        own = tokens[doc_id]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (remainder(doc_id, 7) == 2, len(own), n)
        assert r.n_known == sum(w in counts for w in own)
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own))
        assert math.isfinite(r.score) and r.score < 0


def test_op6(spark, documents):
    for doc_id, r in rows_of(spark, "op6_toxicity", documents).items():
        assert r.held_out == (remainder(doc_id, 4) == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)


def test_op7(spark, documents):
    start = 0
    found = rows_of(spark, "op7_token_records", documents)
    for doc_id, text in documents.items():
        ids = [*TOKENIZER.encode(text, add_special_tokens=False).ids, 2]
        r = found[doc_id]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), crc(ids))
        start += len(ids)


def test_op8(spark, documents):
    for doc_id, r in rows_of(spark, "op8_licence_scan", documents).items():
        words = LICENCE_WORD.findall(documents[doc_id].translate(UPPER))
        places = [
            (i, label)
            for label, phrase in licences.BASE_PHRASES.items()
            for i in range(len(words))
            if words[i : i + len(phrase.split())] == phrase.split()
        ]
        starts, labels = [i for i, _ in places], sorted({label for _, label in places})
        assert (r.n_words, r.n_base) == (len(words), len(places))
        assert (r.first_word, r.last_word) == (min(starts, default=None), max(starts, default=None))
        assert r.base_labels == ",".join(labels) and set(labels) <= set(r.labels.split(","))
        assert 0 <= r.score <= 1


def test_op10(spark, documents):
    pieces, windows = defaultdict(list), defaultdict(list)
    for r in QUERIES["op10_packing"](spark, SMALL).collect():
        pieces[r.doc_id].append(r)
        windows[r.sequence_id].append(r)
    assert set(pieces) == set(documents)
    for doc_id, text in documents.items():
        ids, at = [*TOKENIZER.encode(text, add_special_tokens=False).ids, 1], 0
        for r in sorted(pieces[doc_id], key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), crc(ids[at : at + r.length]))
            at += r.length
        assert at == len(ids)
    for own in windows.values():
        total = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == total
            total += r.length
        assert total <= 2048 and total & (total - 1) == 0
