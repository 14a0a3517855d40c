"""Token counts of a unigram tokenizer, without its tokens.

An Aho-Corasick automaton lists every vocabulary entry that occurs in a piece of
text. Dynamic programming over end positions carries the best score and the
number of tokens of the best segmentation; no back pointers are kept. Ties go
as in the tokenizer: of equal scores the segmentation whose last entry is longer
wins, and a character without an entry of its own costs ten below the lowest
score and counts as its UTF-8 bytes (byte fallback).

No entry holds a blank mark behind another character, or a newline, so the best
segmentation of a text is that of its words and the counts of words add up;
workers remember words. A vocabulary for which this does not hold, or whose
scores are not whole numbers (sums would depend on what stands before), is
refused rather than counted wrongly.

Entries such as ``</s>`` written out in a text count as that one entry, as in the
tokenizers library.

Defined cases: null and empty texts have 0 tokens; repeated rows stay; empty
tables give no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import in_slices

BLANK = "▁"
UNKNOWN_PENALTY = 10.0
CACHED_WORDS = 400_000


def vocabulary(path: str) -> list[tuple[str, float]]:
    """Entries and scores of a sentencepiece file, in id order."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class Counter:
    """Counts tokens for a vocabulary of (entry, score)."""

    def __init__(self, entries: list[tuple[str, float]]) -> None:
        import ahocorasick

        if any(s != int(s) for _, s in entries):
            raise ValueError("scores that are not whole numbers do not add up exactly")
        if any("\n" in p or BLANK in p.lstrip(BLANK) for p, _ in entries):
            raise ValueError("an entry reaches across a blank or a newline")
        self.automaton = ahocorasick.Automaton()
        for piece, score in entries:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(s for _, s in entries) - UNKNOWN_PENALTY
        self.opening: dict[str, int] = {}
        self.inner: dict[str, int] = {}

    def best(self, piece: str) -> tuple[float, int]:
        """Score and number of tokens of the best segmentation of ``piece``."""
        scores: list[float | None] = [0.0] + [None] * len(piece)
        counts = [0] * (len(piece) + 1)
        matches: list[list[tuple[int, float]]] = [[] for _ in piece]
        for last, found in self.automaton.iter(piece):
            matches[last].append(found)
        for last, found in enumerate(matches):
            end = last + 1
            alone = False
            for length, score in sorted(found, reverse=True):
                alone |= length == 1
                total = scores[end - length] + score
                if scores[end] is None or total > scores[end]:
                    scores[end], counts[end] = total, counts[end - length] + 1
            if not alone:
                total = scores[last] + self.unknown
                if scores[end] is None or total > scores[end]:
                    scores[end], counts[end] = total, counts[last] + len(piece[last].encode())
        return scores[-1], counts[-1]

    def _known(self, cache: dict[str, int], words: list[str], prefix: str) -> int:
        try:
            return sum(map(cache.__getitem__, words))
        except KeyError:
            pass
        missing = {w for w in words if w not in cache}
        if len(cache) + len(missing) > CACHED_WORDS:
            cache.clear()
            missing = set(words)
        for word in missing:
            cache[word] = self.best(prefix + word)[1]
        return sum(map(cache.__getitem__, words))

    def count(self, text: str) -> int:
        """Tokens of the text with one blank mark put before it."""
        if not text:
            return 0
        total = 0
        for at, line in enumerate(text.split("\n")):
            words = line.replace(" ", BLANK).split(BLANK)
            head = words.pop(0)
            if at == 0:
                words.insert(0, head)
            else:
                total += self.best("\n")[1]
                if "" not in words:
                    total += self._known(self.inner, [head], "") if head else 0
            if "" in words:  # runs of blanks may be one entry
                total += self.best((BLANK if at == 0 else "") + line.replace(" ", BLANK))[1]
            else:
                total += self._known(self.opening, words, BLANK)
        return total


_counters: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    if path not in _counters:
        _counters[path] = Counter(vocabulary(path))
    return _counters[path]


def token_counts(documents: DataFrame, vocabulary_path: str) -> DataFrame:
    """doc_id and n_tokens of every whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(vocabulary_path).count
        for batch in batches:
            found = [count(t) if t else 0 for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], ["doc_id", "n_tokens"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(in_slices(run), "doc_id long, n_tokens long")
