"""The registered queries and the pipeline on the supplied tables."""

import os
import zlib

import numpy as np
import pytest

import corpus_pipeline
from suite.compare import difference, duck
from tidemark.llm import mixing, toxicity
from tidemark.llm.common import stored, table
from tidemark.llm.oracle import ORACLE
from tidemark.llm.queries import QUERIES, tokenizer_file

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="supplied tables not found")


def test_one_query_for_each_operator():
    import __spark_entry__ as entry

    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(ORACLE))
def test_sql(spark, name):
    assert difference(QUERIES[name](spark, SF), duck(SF), ORACLE[name]) is None


def test_leaks_are_found(spark):
    docs = table(spark, SF, "documents").collect()
    items = table(spark, SF, "benchmark").collect()
    want = {(d.doc_id, i.item_id) for d in docs for i in items if i.text in (d.text or "")}
    assert {(r.doc_id, r.item_id) for r in QUERIES["op9_decontamination"](spark, SF).collect()} == want and want


def test_pipeline_stage_by_stage(spark):
    docs, seen = table(spark, SF, "documents"), {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stored(stage(spark, docs, SF), name)
        seen[name] = (before.collect(), docs.collect())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    ids = lambda rows: [r.doc_id for r in rows]

    before, after = seen["toxicity"]
    model = toxicity.fitted(table(spark, SF, "documents"), table(spark, SF, "labels"))
    scores = model.scores([r.text for r in before])
    assert sorted(ids(after)) == sorted(r.doc_id for r, s in zip(before, scores) if s < toxicity.THRESHOLD)

    before, after = seen["ngram_jaccard_join"]
    sets = {r.doc_id: _shingles(r.text, 5) for r in before}
    linked = {d: {e for e in sets if e != d and sets[d] and 100 * len(sets[d] & sets[e]) >= 80 * len(sets[d] | sets[e])} for d in sets}
    assert sorted(ids(after)) == sorted(d for d in sets if d == min(_reachable(d, linked)))

    before, after = seen["benchmark_decontamination"]
    items = [i.text for i in table(spark, SF, "benchmark").collect()]
    assert sorted(ids(after)) == sorted(r.doc_id for r in before if not any(i in r.text for i in items))

    before, after = seen["mixing_to_target_weights"]
    sizes = {r.doc_id: len(r.text.encode().split()) for r in before}
    assert set(ids(after)) <= set(sizes) and max(np.unique(ids(after), return_counts=True)[1]) <= 2
    by_source = {}
    for r in before:
        by_source[r.source] = by_source.get(r.source, 0) + sizes[r.doc_id]
    targets = mixing.capped_targets(by_source, mixing.source_weights(list(by_source)), mixing.Fraction(3, 2))
    for source, target in targets.items():
        taken = sum(sizes[r.doc_id] for r in after if r.source == source)
        assert abs(taken - target) <= max(sizes[r.doc_id] for r in before if r.source == source)

    before, after = seen["token_binary_output"]
    from tokenizers import Tokenizer

    tokenizer, start = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json")), 0
    got = {r.start: r for r in after}
    for r in sorted(before, key=lambda r: r.doc_id):
        found = np.array(tokenizer.encode(r.text, add_special_tokens=False).ids + [1], "<u4")
        assert (got[start].doc_id, got[start].n_tokens, got[start].ids_crc32) == (r.doc_id, len(found), zlib.crc32(found.tobytes()))
        start += len(found)
    assert len(got) == len(before)


def _shingles(text, size):
    words = text.encode().lower().split()
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)} or ({tuple(words)} if words else set())


def _reachable(start, linked):
    seen, todo = {start}, [start]
    while todo:
        for e in linked[todo.pop()] - seen:
            seen.add(e)
            todo.append(e)
    return seen


