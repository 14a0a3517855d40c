import hashlib
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from helpers import AWKWARD, edited, frame, prose
from tidemark.llm import mixing, simhash


def test_edit_likeness_of_every_row(spark):
    rows = AWKWARD + [(i, prose(i % 7, 30 + i)) for i in range(40)] + [(60, "x" * 9000)]
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    got = simhash.edit_likeness(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    want = []
    for i, (doc, text, *_) in enumerate(ordered):
        text, following = text or "", ordered[(i + 1) % len(ordered)][1] or ""
        n = len(text) // 4
        form = text[:len(text) - n] + following[:n]
        want.append((doc, len(text), hashlib.sha256(form.encode()).hexdigest()))
    key = lambda r: (r[0] is not None, r[0] or 0, r[2])
    assert sorted([(r.doc_id, r.n_chars, r.edited_sha256) for r in got], key=key) == sorted(want, key=key)
    prints = {}
    for r in got:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 and len(r.fingerprint) == 16
        prints.setdefault(r.doc_id, set()).add(r.fingerprint)
    assert prints[900] == prints[901] == prints[902] == {"0" * 16} and len(prints[905]) == 1
    assert simhash.edit_likeness(frame(spark, rows).limit(0)).count() == 0


def test_fingerprint_is_the_sign_of_the_votes(spark):
    rows = frame(spark, [(1, "a b c d e f g a b c d e"), (2, "A B  C D E F G A B C D E"), (3, "a b")])
    terms = rows.select("doc_id", simhash.word_hashes(F.col("text")).alias("w")).select("doc_id", simhash.shingle_hashes("w").alias("t"))
    held = {r.doc_id: r.t for r in terms.collect()}
    got = {r.doc_id: r.fingerprint & (1 << 64) - 1 for r in simhash.fingerprints(terms, ["doc_id"], "t").collect()}
    for doc, hashes in held.items():
        want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
        assert got[doc] == want
    assert got[1] == got[2] and len(held[1]) == 8 and len(held[3]) == 1


@pytest.mark.parametrize("radius", [1, 3])
def test_hamming_search_is_exact(spark, radius):
    import random

    rng = random.Random(radius)
    base = [rng.getrandbits(64) for _ in range(60)]
    values = base + [b ^ sum(1 << p for p in rng.sample(range(64), k)) for b in base for k in (0, 1, 3, 4)]
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    prints = spark.createDataFrame(signed, "fingerprint long")
    got = {(r.asked, r.found, r.distance) for r in simhash.within_radius(prints, prints, radius).collect()}
    distinct = {s[0] for s in signed}
    want = {(a, b, d) for a in distinct for b in distinct if (d := bin((a ^ b) & (1 << 64) - 1).count("1")) <= radius}
    assert got == want


def test_capped_targets():
    sizes = {"a": 10, "b": 1000, "c": 500, None: 0}
    targets = mixing.capped_targets(sizes, mixing.source_weights(list(sizes)), Fraction(3, 2))
    assert targets["a"] == 20 and targets[None] == 0 and sum(targets.values()) == Fraction(3, 2) * 1510
    assert all(t <= 2 * sizes[s] for s, t in targets.items())
    assert mixing.source_weights(["b", None, "a", "é"]) == {"a": 5, "b": 2, "é": 1, None: 5}
    assert mixing.capped_targets({}, {}, Fraction(3, 2)) == {}


def test_flow_prefers_fresh_words_and_meets_quotas():
    flow = mixing.routed_words({("a",): 100, ("a", "b"): 100, ("b",): 10}, {"a": 150, "b": 70})
    assert sum(f.get("a", 0) for f in flow.values()) == 150 and sum(f.get("b", 0) for f in flow.values()) == 70
    # 210 fresh words for 220: only ten words may be read again
    assert sum(max(0, sum(f.values()) - w) for f, w in zip(flow.values(), (100, 100, 10))) == 10
    alone = mixing.routed_words({("a",): 100, ("b",): 50}, {"a": 30, "b": 100})
    assert alone == {("a",): {"a": 30}, ("b",): {"b": 100}}


def test_flow_against_exhaustive_search():
    import itertools

    patterns, quotas = {("a",): 2, ("a", "b"): 3, ("b", "c"): 2}, {"a": 5, "b": 4, "c": 1}
    flow = mixing.routed_words(patterns, quotas)
    moved = sum(sum(f.values()) for f in flow.values())
    cost = sum(max(0, sum(f.values()) - patterns[p]) for p, f in flow.items())
    best = (0, 0)
    for x in itertools.product(range(5), range(7), range(7), range(5), range(5)):
        p = (x[0], x[1] + x[2], x[3] + x[4])
        if p[0] <= 4 and p[1] <= 6 and p[2] <= 4 and x[0] + x[1] <= 5 and x[2] + x[3] <= 4 and x[4] <= 1:
            best = max(best, (sum(p), -sum(max(0, a - b) for a, b in zip(p, (2, 3, 2)))))
    assert (moved, -cost) == best


def test_mix_takes_whole_documents_near_targets(spark):
    rows = [(i, prose(i, 20 + i % 50), f"s{i % 3}") for i in range(300)] + [(i, prose(i, 30), None) for i in range(300, 320)]
    rows += [(400, None, "s0"), (401, "", "s1"), (None, "no id here", "s1"), (402, "twice", "s2"), (402, "twice", "s2")]
    held = mixing.keyed(frame(spark, rows), F.array("source"), "t").cache()
    plan = mixing.plan_mix(held)
    got = mixing.with_copies(held, plan).collect()
    assert len(got) == len(rows) and all(0 <= r.mix_copies <= 2 for r in got)
    for source, target in plan.targets.items():
        taken = sum(r.mix_copies * r.mix_size for r in got if r.mix_row.source == source)
        assert abs(taken - target) <= 40
    again = mixing.with_copies(held.repartition(7), mixing.plan_mix(held.repartition(3))).collect()
    assert sorted((r.mix_id or -1, r.mix_copies) for r in got) == sorted((r.mix_id or -1, r.mix_copies) for r in again)
    docs = frame(spark, rows)
    mixed = mixing.mixed_documents(docs, F.array("source"), "t")
    assert mixed.columns == docs.columns and mixed.count() == sum(r.mix_copies for r in got)
    assert mixing.mixed_documents(docs.limit(0), F.array("source"), "t").count() == 0


def test_overlapping_sources(spark):
    rows = [(i, edited(prose(i, 25), i, 2), "x") for i in range(90)]
    docs = frame(spark, rows).withColumn("m", F.expr("CASE doc_id % 3 WHEN 0 THEN array('a') WHEN 1 THEN array('b', 'a') ELSE array('b') END"))
    plan = mixing.plan_mix(mixing.keyed(docs, F.col("m"), "t").cache())
    assert set(plan.rest) == {'["a"]', '["a","b"]', '["b"]'} and plan.sizes == {"a": 1500, "b": 1500}


def test_neighbours_equal_brute_force(spark):
    rows = AWKWARD + [(i, prose(i % 7, 300) if i % 3 else edited(prose(i % 7, 300), i, 1 + i % 4)) for i in range(80)]
    got = simhash.edit_neighbours(frame(spark, rows), F.col("doc_id") % 20 == 0).collect()
    prints = {int(r.fingerprint, 16) for r in got}
    assert len(got) == len(rows) and "print" not in got[0].asDict()
    for r in got:
        if r.doc_id is None or r.doc_id % 20:
            assert r.near_prints is None
        else:
            own = int(r.fingerprint, 16)
            assert r.near_prints == sum(0 < bin(own ^ p).count("1") <= 3 for p in prints)
    assert any(r.near_prints for r in got)
