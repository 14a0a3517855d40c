"""Phrase collocations by top-order marginalisation.

Only the longest windows are counted: each word of a piece leads one window of
``LONGEST`` words, padded behind the end of its piece. Summing windows over their
last words gives every shorter phrase that starts with the rest, so one ROLLUP over
the window's columns yields the counts of all orders, down to the words of each
language; shorter n-grams are never taken out of the texts.

Windows are padded from where they cannot matter. A phrase seen ``least`` times
holds only phrases that are seen as often. A first pass counts pairs of neighbours in
hashed cells, saturated at ``least``, a second one the longer phrases whose pairs
passed: a cell below ``least`` holds no such phrase, and a window ends before one. A
phrase's cell is the same wherever it stands, so it keeps all its occurrences or
none. The number of cells follows the size of the texts up to ``MOST_CELLS`` (128 MB in
a task that counts; one bit a cell, 8 MB, for the driver and the tasks that read).
Where cells fill up beyond that, fewer windows are shortened: rows are shuffled that
end up unused, results stay the same.

Defined cases: null and blank texts have no words; a null language is ``und`` and
meets a language of that name; repeated rows count each; all whole texts are read;
sums are long, scores are worked out in decimals; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import in_slices, stored
from tidemark.llm.shingles import _ODD, U, WordHashes, mixed

LONGEST = 4
#: Bytes of text a cell, bounds of the number of cells, and cells in one row of their exchange.
CELL_BYTES, LEAST_CELLS, MOST_CELLS, PART = 16, 1 << 16, 1 << 26, 1 << 16
#: So many counted at once stay below 16 bits.
AT_ONCE = 60_000
#: Rows of a batch taken together.
TEXTS = 2000
STOP = b"."
_STOPS = bytes.maketrans(b",;:!?\n\x0b\x0c\r", STOP * 9)

_hashes = WordHashes()


def _spoken(batch: pa.RecordBatch) -> Iterator[tuple[bytes, list[bytes], np.ndarray]]:
    """Per language of the batch its words in order, STOP between pieces and at the
    end, and their hashes. STOP is no word: every text is parted at it."""
    texts: dict[str, list[bytes]] = {}
    for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
        texts.setdefault(lang, []).append(text)
    for lang, some in texts.items():
        words = STOP.join(some).lower().translate(_STOPS).replace(STOP, b" " + STOP + b" ").split()
        words += [STOP] * LONGEST
        yield lang, words, np.fromiter(map(_hashes.__getitem__, words), U, len(words))


def _phrases(lang: str, hashes: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Which places hold words, and hashes of the phrases of 2, 3 and more words from each place on."""
    n = len(hashes) - LONGEST + 1
    key = hashes[:n] + U(_hashes[b"lang " + lang.encode()])
    keys = []
    for k in range(1, LONGEST):
        key = mixed(key * _ODD[0] + hashes[k:n + k] * _ODD[1] + U(k))
        keys.append(key)
    return hashes != U(_hashes[STOP]), keys


def _listed(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    cells = keys & U(8 * len(bits) - 1)
    return (bits[cells >> U(3)] >> (U(7) - (cells & U(7))).astype(np.uint8) & 1).astype(bool)


def _both(open_: np.ndarray) -> np.ndarray:
    """Is a place open, and the one behind it?"""
    return open_ & np.append(open_[1:], False)


def _counted(least: int, cells: int, pairs) -> Callable:
    """Rows (part, at, counts) of a task: its cells, at most ``least`` each; ``at`` is empty
    where all cells are listed. Counts pairs, or with the bits of the frequent ``pairs`` what is longer."""
    def added(counts: np.ndarray, keys: np.ndarray) -> None:
        at = (keys & U(cells - 1)).astype(np.int64)
        for i in range(0, len(at), AT_ONCE):
            some = at[i:i + AT_ONCE]
            np.add.at(counts, some, 1)
            counts[some] = np.minimum(counts[some], least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(cells, np.uint16)
        for batch in batches:
            for lang, _, hashes in _spoken(batch):
                word, (first, *longer) = _phrases(lang, hashes)
                open_ = _both(word)[:len(first)]
                if pairs is None:
                    added(counts, first[open_])
                    continue
                open_ &= _listed(pairs.value, first)
                for keys in longer:
                    open_ = _both(open_)
                    added(counts, keys[open_])
        parts, at, held = [], [], []
        for part, some in enumerate(counts.reshape(-1, PART)):
            found = np.flatnonzero(some)
            if len(found):
                sparse = 3 * len(found) < PART
                parts.append(part)
                at.append(found.astype("<u2").tobytes() if sparse else b"")
                held.append((some[found] if sparse else some).astype(np.uint8).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(at, pa.binary()), pa.array(held, pa.binary())], ["part", "at", "counts"])

    return run


def _frequent_parts(least: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, at, counts in zip(*[batch.column(c).to_pylist() for c in range(3)]):
                total = sums.setdefault(part, np.zeros(PART, np.uint16))
                where = np.frombuffer(at, "<u2") if at else slice(None)
                total[where] = np.minimum(total[where] + np.frombuffer(counts, np.uint8), least)
        bits = [np.packbits(s >= least).tobytes() for s in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(bits, pa.binary())], ["part", "bits"])

    return run


def cells_for(size: int) -> int:
    """Number of cells for ``size`` bytes of text, a power of two."""
    return min(MOST_CELLS, max(LEAST_CELLS, 1 << (size // CELL_BYTES).bit_length()))


def frequent_cells(texts: DataFrame, least: int, cells: int, pairs=None) -> np.ndarray:
    """Bits of the cells in which some pair of neighbours may be seen ``least`` times;
    with the broadcast bits of these ``pairs``, of the cells of longer phrases."""
    least = min(least, 255)  # cells are exchanged as bytes; a lower bar only shortens fewer windows
    counted = texts.mapInArrow(in_slices(_counted(least, cells, pairs), TEXTS), "part int, at binary, counts binary").repartition("part")
    bits = np.zeros((cells // PART, PART // 8), np.uint8)
    for row in counted.mapInArrow(_frequent_parts(least), "part int, bits binary").collect():  # a bit a cell in all
        bits[row["part"]] = np.frombuffer(row["bits"], np.uint8)
    return bits.reshape(-1)


WORDS = [f"w{k}" for k in range(1, LONGEST + 1)]


def _windows(pairs, longer) -> Callable:
    """Windows of a batch, equal ones as one row with their number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, words, hashes in _spoken(batch):
                word, phrases = _phrases(lang, hashes)
                n = len(phrases[0])
                key, length, open_ = hashes[:n], np.ones(n, np.int64), word[:n]
                for keys in phrases:
                    open_ = _both(open_ if keys is not phrases[0] else word)[:n] & _listed((pairs if keys is phrases[0] else longer).value, keys)
                    length += open_
                    key = np.where(open_, keys, key)
                leads = np.flatnonzero(word[:n])
                _, first, counts = np.unique(key[leads], return_index=True, return_counts=True)
                first = leads[first]
                named = np.array(words, object)
                columns = []
                for k in range(LONGEST):
                    column = named[first + k]
                    column[length[first] <= k] = b""
                    columns.append(pa.array(column.tolist(), pa.binary()).cast(pa.string()))
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(first), pa.string()), *columns, pa.array(counts, pa.int64())], ["lang", *WORDS, "n"])

    return run


def phrase_counts(documents: DataFrame, least: int) -> DataFrame:
    """Rows (lang, size, phrase, f): every phrase of up to LONGEST words seen ``least``
    times, and with size 0 the number of words of each language."""
    texts = documents.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    shared = documents.sparkSession.sparkContext.broadcast
    cells = cells_for(texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    pairs = shared(frequent_cells(texts, least, cells))
    longer = shared(frequent_cells(texts, least, cells, pairs))
    schema = "lang string, " + ", ".join(f"{w} string" for w in WORDS) + ", n long"
    windows = texts.mapInArrow(in_slices(_windows(pairs, longer), TEXTS), schema)
    longest = windows.groupBy("lang", *WORDS).agg(F.sum("n").alias("n"))
    sums = longest.rollup("lang", *WORDS).agg(F.sum("n").alias("f"), F.grouping_id().alias("rolled"))
    # Every column rolled up sets one more bit from the right.
    size = LONGEST - F.bit_count("rolled")
    last = F.coalesce(*[F.col(w) for w in reversed(WORDS)])
    return sums.where(F.col("lang").isNotNull() & ((size == 0) | ((last != "") & (F.col("f") >= least)))).select(
        "lang", size.cast("int").alias("size"), F.concat_ws(" ", *WORDS).alias("phrase"), "f",
    )


def _span(words: str, start: str, length: str) -> str:
    return f"array_join(slice({words}, {start}, {length}), ' ')"


def collocations(documents: DataFrame, least: int = 30, first: int = 2000, covered: int = 80) -> DataFrame:
    """Per language the ``first`` phrases of 2 to LONGEST words by score: lang, rank,
    phrase, a, l, r, n, score. Of a phrase's cuts the lowest-scoring counts; phrases go
    that lie in a longer one with ``covered`` percent of their occurrences."""
    counts = stored(phrase_counts(documents, least), "phrases")
    phrases = counts.where("size > 1").selectExpr("lang", "phrase", "f AS a", "size", "split(phrase, ' ') AS words")
    cuts = phrases.selectExpr("*", "explode(sequence(1, size - 1)) AS k").selectExpr(
        "lang", "phrase", "a", "k", f"{_span('words', '1', 'k')} AS left", f"{_span('words', 'k + 1', 'size - k')} AS right")
    parts = lambda side, f: counts.select("lang", F.col("phrase").alias(side), F.col("f").alias(f))
    cut = cuts.join(parts("left", "l"), ["lang", "left"]).join(parts("right", "r"), ["lang", "right"])
    score = "CAST(a AS decimal(20, 0)) * 2000000 DIV (CAST(l AS decimal(20, 0)) + CAST(r AS decimal(20, 0)))"
    lowest = cut.selectExpr("lang", "phrase", "a", f"struct({score} AS score, k, l, r) AS cut").groupBy("lang", "phrase", "a").agg(F.min("cut").alias("cut"))
    longer = phrases.where("size > 2").selectExpr("lang", "a", "size", "words", "explode(sequence(2, size - 1)) AS held").selectExpr(
        "lang", "a", "words", "held", "explode(sequence(1, size - held + 1)) AS start",
    ).selectExpr("lang", f"{_span('words', 'start', 'held')} AS phrase", "a AS beside").groupBy("lang", "phrase").agg(F.max("beside").alias("beside"))
    swallowed = f"CAST(beside AS decimal(20, 0)) * 100 >= CAST(a AS decimal(20, 0)) * {covered}"
    kept = lowest.join(longer, ["lang", "phrase"], "left").where(f"beside IS NULL OR NOT ({swallowed})")
    line = Window.partitionBy("lang").orderBy(F.col("cut.score").desc(), F.col("a").desc(), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(line)).where(F.col("rank") <= first)
    totals = counts.where("size = 0").selectExpr("lang", "f AS n")
    return ranked.join(totals, "lang").selectExpr(
        "lang", "CAST(rank AS long) AS rank", "phrase", "a", "cut.l AS l", "cut.r AS r", "n", "CAST(cut.score AS long) AS score")
