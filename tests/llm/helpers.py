"""Small document tables with the awkward rows every operator has to take."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, source string, node string, score double, gram long, part int, mix_base int"


def frame(spark, rows):
    """Rows (doc_id, text[, source]) as a table with clashing extra columns."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else None, "n", 0.5, 1, 2, 3) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def prose(seed: int, words: int, vocabulary: int = 300) -> str:
    rng = random.Random(seed)
    return " ".join("w" + str(rng.randrange(vocabulary)) for _ in range(words))


def edited(text: str, seed: int, edits: int) -> str:
    rng = random.Random(seed)
    words = text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"edit{rng.randrange(10**6)}"
    return " ".join(words)


AWKWARD = [(None, "a row without an id"), (900, None), (901, ""), (902, " \n\t "), (903, "one"), (904, "Ünï çødé 🙂 text"), (905, "same row"), (905, "same row")]
