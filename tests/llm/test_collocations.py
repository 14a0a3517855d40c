import random
import re
from collections import Counter

import numpy as np
import pytest

from helpers import prose
from tidemark.llm import collocations as col

SCHEMA = "doc_id long, text string, lang string, phrase string, n long, w1 int, f double"


def frame(spark, rows):
    """Rows (lang, text) as a table whose other columns clash with inner names."""
    return spark.createDataFrame([(i, text, lang, "x", 1, 2, 0.5) for i, (lang, text) in enumerate(rows)], SCHEMA)


def plain(rows, least, first=2000, covered=80):
    counts: dict = {}
    for lang, text in rows:
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            words = [w for w in re.split("[ \t]+", piece) if w]
            for size in range(1, 5):
                for i in range(len(words) - size + 1):
                    counts.setdefault(lang or "und", Counter())[tuple(words[i:i + size])] += 1
    out = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        phrases = [p for p, c in f.items() if len(p) > 1 and c >= least]
        beside = Counter()
        for p in phrases:
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    beside[p[i:i + size]] = max(beside[p[i:i + size]], f[p])
        rows_ = []
        for p in phrases:
            if p in beside and 100 * beside[p] >= covered * f[p]:
                continue
            score, _, left, right = min((2000000 * f[p] // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            rows_.append((score, f[p], " ".join(p), left, right))
        rows_.sort(key=lambda r: (-r[0], -r[1], r[2].encode()))
        out += [(lang, i + 1, p, a, left, right, n, score) for i, (score, a, p, left, right) in enumerate(rows_[:first])]
    return sorted(out)


def found(spark, rows, least, first=2000):
    got = col.collocations(frame(spark, rows).repartition(3), least, first)
    return sorted(tuple(r) for r in got.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def texts(seed):
    rng = random.Random(seed)
    phrases = ["the quick brown fox", "New York", "red tape", "in spite of", "Èa éb", "a a a a a", "é x y"]
    rows = []
    for i in range(120):
        words = [rng.choice(phrases) if rng.random() < 0.4 else f"w{rng.randrange(12)}" for _ in range(rng.randrange(30))]
        text = "".join(w + rng.choice([" ", "  ", "\t", ", ", ".", "\n", " ", "\r\n", " ; "]) for w in words)
        rows.append((rng.choice(["en", "fr", None, "und"]), text))
    return rows + [("en", None), (None, ""), ("en", " .,; "), ("de", None), ("en", "z" * 50000), ("en", rows[0][1]), ("en", "\x00 . \x1c x")]


@pytest.mark.parametrize("seed,least", [(1, 5), (2, 2), (3, 30)])
def test_equal_to_counting_all_phrases(spark, seed, least):
    assert found(spark, texts(seed), least) == plain(texts(seed), least)


def test_full_cells_only_cost_time(spark, monkeypatch):
    monkeypatch.setattr(col, "frequent_cells", lambda texts, least, cells, pairs=None: np.full(cells // 8, 255, np.uint8))
    assert found(spark, texts(4), 3, first=7) == plain(texts(4), 3, first=7)


@pytest.mark.parametrize("part", [64, 1 << 16])
def test_cells_of_many_tasks_add_up(spark, monkeypatch, part):
    monkeypatch.setattr(col, "PART", part)
    monkeypatch.setattr(col, "AT_ONCE", 100)
    rows = [("en", prose(i, 50, 40)) for i in range(40)] + [("en", "w1 w2 " * 300)]
    texts_ = frame(spark, rows).repartition(8).select("lang", "text")
    grams = Counter(p for _, t in rows for n in (2, 3, 4) for p in zip(*[t.split()[k:] for k in range(n)]))
    for least in (3, 300):
        pairs = spark.sparkContext.broadcast(col.frequent_cells(texts_, least, 1 << 16))
        longer = col.frequent_cells(texts_, least, 1 << 16, pairs)
        passed = 0
        for gram, n in grams.items():
            hashes = np.array([col._hashes[w.encode()] for w in (*gram, *["."] * 4)], col.U)
            keys = col._phrases("en", hashes)[1][len(gram) - 2][:1]
            ok = col._listed(pairs.value if len(gram) == 2 else longer, keys)[0]
            assert ok or n < min(least, 255)
            passed += ok
        assert passed < len(grams) / 2


def test_amounts_beyond_64_bits(spark, monkeypatch):
    big = 4 * 10**15
    rows = [("en", 0, "", 3 * big), ("en", 1, "a", big), ("en", 1, "b", 2 * big), ("en", 2, "a b", big - 1)]
    monkeypatch.setattr(col, "phrase_counts", lambda documents, least: spark.createDataFrame(rows, "lang string, size int, phrase string, f long"))
    got = col.collocations(frame(spark, [])).collect()
    assert [(r.a, r.l, r.r, r.n, r.score) for r in got] == [(big - 1, big, 2 * big, 3 * big, 2000000 * (big - 1) // (3 * big))]


def test_empty_table(spark):
    assert found(spark, [], 1) == []
