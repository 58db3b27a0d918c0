"""The corpus pipeline on the smallest tables, stage by stage, against brute force."""

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from orderlake.llm import simhash
from orderlake.llm.tables import staged, table
from tests.llm.test_simhash import brute_classes, brute_fingerprint

SMALL = "/root/testdata/sf0.001"


def test_pipeline(spark):
    docs = table(spark, SMALL, "documents")
    seen = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = staged(stage(spark, docs, SMALL), "test-" + name.replace(" ", "-"))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        seen.append(docs.collect())
    raw, clean, lined, deduped, safe = ({r.doc_id: r for r in rows} for rows in seen)
    toxic = {r.doc_id for r in table(spark, SMALL, "labels").filter("toxic = 1").collect()}
    assert len(clean) >= 0.85 * len(raw)
    gone = set(raw) - set(clean)
    known = {r.doc_id for r in table(spark, SMALL, "labels").collect()}
    assert all(i in toxic for i in gone & known)

    lines, pages = {}, {}
    for r in clean.values():
        pages[r.source] = pages.get(r.source, 0) + 1
        for line in {line.strip(" ") for line in r.text.split("\n")} - {""}:
            lines[r.source, line] = lines.get((r.source, line), 0) + 1
    for i, r in clean.items():
        kept = [
            line for line in r.text.split("\n")
            if not (lines.get((r.source, line.strip(" ")), 0) >= 3 and lines[r.source, line.strip(" ")] > 0.1 * pages[r.source])
        ]
        assert lined[i].text == "\n".join(kept) and lined[i].n_chars == len(lined[i].text)

    marks = {i: brute_fingerprint(r.text) for i, r in lined.items()}
    groups = brute_classes(set(marks.values()), corpus_pipeline.MAX_BITS)
    assert set(deduped) == {min(i for i, m in marks.items() if m in group) for group in map(set, groups)}

    bench = [r.text.lower().split() for r in table(spark, SMALL, "benchmark").collect()]
    for i, r in deduped.items():
        text = " ".join(r.text.lower().split())
        if any(" ".join(words) in text for words in bench):
            assert i not in safe
    assert len(safe) >= 0.8 * len(deduped)

    tokenizer = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    total = {}
    for p in pieces:
        total[p.doc_id] = total.get(p.doc_id, 0) + p.length
    assert total == {i: len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1 for i, r in safe.items()}
    assert corpus_pipeline.run(spark, SMALL).count() > 0


def test_stages_on_an_empty_table(spark):
    docs = table(spark, SMALL, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SMALL).collect() == []
    assert simhash.one_of_each(docs).columns == docs.columns
