import random

import numpy as np
import pytest

from helpers import AWKWARD, frame, prose
from tidemark.llm import toxicity as tox

BAD = ["vilewort", "grumbleton", "snarkish"]


def labelled(n, seed=0):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = prose(seed * 10_000 + i, rng.randrange(5, 150), 500).split()
        toxic = i % 3 == 0
        if toxic:
            for _ in range(1 + i % 3):
                words.insert(rng.randrange(len(words)), rng.choice(BAD) + rng.choice(["", "s", "ly"]))
        rows.append((i, " ".join(words), int(toxic)))
    return rows


@pytest.fixture(scope="module")
def model():
    rows = labelled(450)
    return tox.train([t for _, t, _ in rows], [y for *_, y in rows])


def test_gradients_are_those_of_differences():
    rng = np.random.default_rng(0)
    h, batch, steps = 3, 4, 5
    w = {k: rng.standard_normal(s) * 0.5 for k, s in {
        "words": (6, 2), "pieces": (7, 2), "in": (4, 6 * h), "in_bias": (6 * h,), "ahead": (h, 3 * h), "behind": (h, 3 * h), "heed": (2 * h,), "out": (2 * h,), "out_bias": (1,)}.items()}
    words, pieces = rng.integers(0, 6, (batch, steps)), rng.integers(0, 7, (batch, steps, 3))
    mask = np.arange(steps) < np.array([5, 5, 3, 1])[:, None]
    y, weight = np.array([1, 0, 1, 0.0]), np.array([2, 1, 2, 1.0])
    _, grads = tox.gradients(w, words, pieces, mask, y, weight)
    for name in w:
        for _ in range(6):
            at = tuple(rng.integers(0, s) for s in w[name].shape)
            was, eps = w[name][at], 1e-3
            w[name][at] = was + eps
            up = tox.gradients(w, words, pieces, mask, y, weight)[0]
            w[name][at] = was - eps
            down = tox.gradients(w, words, pieces, mask, y, weight)[0]
            w[name][at] = was
            assert abs((up - down) / (2 * eps) - grads[name][at]) < 2e-3, name


def plain_score(model, text):
    """One window, one step and one number at a time."""
    w, s = {k: v.astype(np.float64) for k, v in model.weights.items()}, model.settings
    words = tox.tokens(text)
    best = -np.inf
    sig = lambda x: 1 / (1 + np.exp(-x))
    for begin in tox.window_starts(len(words), s.window, s.stride):
        inputs = []
        for word in words[begin:begin + s.window] or [""]:
            row, found = model.word_input(word) if words else (0, [])
            letters = w["pieces"][found].mean(0) if found else np.zeros(s.piece_size)
            inputs.append(np.concatenate([w["words"][row], letters]) @ w["in"] + w["in_bias"])
        states = []
        for name, part, order in (("ahead", slice(0, 3 * s.hidden), 1), ("behind", slice(3 * s.hidden, None), -1)):
            state, out = np.zeros(s.hidden), []
            for g in [x[part] for x in inputs][::order]:
                back, h = state @ w[name], s.hidden
                z, r = sig(g[:h] + back[:h]), sig(g[h:2 * h] + back[h:2 * h])
                state = (1 - z) * np.tanh(g[2 * h:] + r * back[2 * h:]) + z * state
                out.append(state)
            states.append(np.array(out[::order]))
        both = np.concatenate(states, 1)
        heed = np.exp(both @ w["heed"])
        best = max(best, float((heed / heed.sum()) @ both @ w["out"] + w["out_bias"][0]))
    return sig(model.slope * best + model.offset)


def test_scores_equal_the_plain_network(model):
    texts = ["", None, "one", prose(1, 31), prose(2, 32), prose(3, 33), prose(4, 400), labelled(9)[0][1], "grumbleton " * 90, "123 !!"]
    got = model.scores(texts)
    assert np.allclose(got, [plain_score(model, t) for t in texts], atol=2e-4)
    assert np.allclose(model.scores(texts[::-1])[::-1], got, atol=1e-6)


def test_small_caches_change_nothing(model, monkeypatch):
    texts = [t for _, t, _ in labelled(30, 5)] + [prose(8, 900, 10**6)]
    want = model.scores(texts)
    monkeypatch.setattr(tox, "CACHED_WORDS", 300)
    model.gates = None
    assert np.allclose(model.scores(texts), want, atol=1e-5)
    model.gates = None


def test_held_out_accuracy(model):
    rows = labelled(300, 3)
    score = model.scores([t for _, t, _ in rows])
    y = np.array([y for *_, y in rows])
    assert ((score >= tox.THRESHOLD) == y).mean() > 0.95


def test_whole_long_text_is_scored(model):
    clean = prose(1, 20_000)
    for at in (0, 10_000, 19_999):
        words = clean.split()
        words[at] = "vilewort"
        assert model.scores([" ".join(words)])[0] > model.scores([clean])[0]


def test_windows_cover_and_overlap():
    for n in range(1, 200):
        starts = tox.window_starts(n, 32, 24)
        assert {p for a in starts for p in range(a, a + 32)} >= set(range(n)) and all(b - a <= 24 for a, b in zip(starts, starts[1:]))


def test_judged_rows_and_folds(spark):
    import zlib

    rows = [(i, t) for i, t, _ in labelled(240)] + AWKWARD
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in labelled(240)] + [(0, 1, None), (None, 1, 1), (10**6, 1, 1)], "doc_id long, quality int, toxic int")
    docs = frame(spark, rows)
    got = tox.judged(docs, labels).collect()
    assert sorted(repr(r.doc_id) for r in got) == sorted(repr(d) for d, _ in rows)
    for r in got:
        if r.doc_id is not None:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= tox.THRESHOLD)
    used = {r["doc_id"] for r in tox.training_rows(docs, labels, tox.Settings())}
    assert used and not any(zlib.crc32(str(i).encode()) % 4 == 2 for i in used)
    bounded = tox.training_rows(docs, labels, tox.Settings(toxic_rows=5, clean_rows=7))
    assert len(bounded) == 12
    kept = tox.without_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted == 0 for r in got)
    assert tox.judged(docs.limit(0), labels).count() == 0
    assert {r.score for r in tox.judged(docs, labels.limit(0)).collect()} == {float(tox._sigmoid(np.array(-30.0)))}


@pytest.mark.parametrize("broadcast", [2_000_000, 0])
def test_columns_with_inner_names_stay_as_they_came(spark, monkeypatch, broadcast):
    monkeypatch.setattr(tox, "BROADCAST_TEXTS", broadcast)
    from pyspark.sql import functions as F

    from tidemark.llm import jaccard

    rows = [(1, "you awful rotten wretch", "k", "x", 0.25, "r"), (2, "a calm day at the lake with friends", "q", None, None, "s"),
            (2, "a calm day at the lake with friends", "q", "y", None, "s"), (3, None, "n", "z", 1.0, "t"), (3, None, "n", "z", 1.0, "t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, llm_text_key string, llm_turn string, llm_toxicity double, `row` string")
    docs = docs.withColumn("first_key", F.lit("f")).withColumn("id", F.lit(7)).withColumn("key", F.lit("k")).withColumn("turn", F.lit(0.5))
    kept = tox.without_toxic(docs, spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int"))
    assert kept.columns == docs.columns and kept.exceptAll(docs).count() == 0
    one = jaccard.one_of_each_group(docs)
    assert one.columns == docs.columns and one.exceptAll(docs).count() == 0
    assert sorted((r.doc_id, r.llm_turn or "") for r in one.collect()) == [(1, "x"), (2, ""), (3, "z"), (3, "z")]
    big = 2**53 + 1
    wide = spark.createDataFrame([(big, "five words stand here now"), (None, "others are in this one"), (big + 2, "and again others over there")], "doc_id long, text string")
    assert {r.doc_id for r in jaccard.one_of_each_group(wide).collect()} == {big, None, big + 2}
    assert {r.doc_id for r in jaccard.jaccard_components(wide, 3, 90).collect()} == {big, None, big + 2}
