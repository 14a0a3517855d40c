"""Packing documents into sequences of bounded length: large-item matching, then best fit.

Pieces of more than a third of the capacity fit at most twice into a sequence.
They are matched greedily: the largest left goes with the largest that still fits
beside it, which gives as many pairs as any matching. Smaller pieces, largest
first, go where the smallest sufficient gap is left; new sequences are opened
only when no gap is large enough.

Pieces of one length are interchangeable, so the packing is worked out on the
number of pieces of each length: at most ``capacity`` counts reach the driver,
whatever the number of documents. A group of equal sequences stays one entry; a
step uses up a length or a group, so the plan has a few entries for each length.
Each piece then finds its place by its rank among the pieces of its length, which
is its rank inside its task plus the counts of the tasks before. No length is ever
sorted or gathered, however many pieces have it.

Ids are those of the tokenizers library. Texts of plain Latin letters, ASCII
marks and blanks are encoded from the rank file of the same vocabulary (tiktoken),
which gives the same ids in a quarter of the time; all others, and
texts that spell out a special token, go through the tokenizer itself.

Defined cases: null texts are empty and hold the end id alone; rows are separate
documents even where ids or texts repeat, null ids included; longer documents are
cut so that all pieces but the first are full; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import in_slices, stored

#: What the pattern of the vocabulary reads alike in both libraries.
_PLAIN = re.compile("[\t-\r -~À-ÖØ-öø-ÿ]*")


class Encoder:
    def __init__(self, tokenizer_path: str, ranks_path: str | None) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.ranks = _ranked(ranks_path) if ranks_path else None

    def __call__(self, text: str) -> np.ndarray:
        if self.ranks is not None and _PLAIN.fullmatch(text) and not any(s in text for s in self.special):
            return self.ranks.encode_to_numpy(text, disallowed_special=()).astype(np.uint32)
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)


def _ranked(path: str):
    import base64

    import tiktoken
    from public_tokenizers import PATTERN

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


_encoders: dict[tuple, Encoder] = {}


def encoder(tokenizer_path: str, ranks_path: str | None) -> Encoder:
    """The worker's encoder."""
    key = (tokenizer_path, ranks_path)
    if key not in _encoders:
        _encoders[key] = Encoder(*key)
    return _encoders[key]


# --- pieces ---------------------------------------------------------------------
def _cut(tokenizer_path: str, ranks_path: str | None, capacity: int, end_id: int, keep_ids: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path, ranks_path)
        task = TaskContext.get().partitionId()
        held = np.zeros(capacity + 1, np.int64)  # pieces of each length so far
        end = np.array([end_id], np.uint32)
        for batch in batches:
            rows: list[int] = []
            pieces, starts, lengths, sums, kept = [], [], [], [], []
            for row, text in enumerate(batch.column(1).to_pylist()):
                ids = np.concatenate([encode(text or ""), end]).astype("<u4")
                first = (len(ids) - 1) % capacity + 1
                edges = [0, *range(first, len(ids) + 1, capacity)]
                for k, (a, b) in enumerate(zip(edges, edges[1:])):
                    part = ids[a:b].tobytes()
                    rows.append(row)
                    pieces.append(k)
                    starts.append(a)
                    lengths.append(b - a)
                    sums.append(zlib.crc32(part))
                    kept.append(part if keep_ids else None)
            if not rows:
                continue
            sizes = np.array(lengths)
            order = np.argsort(sizes, kind="stable")
            ordered = sizes[order]
            opens = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
            ranks = np.empty(len(sizes), np.int64)
            ranks[order] = held[ordered] + np.arange(len(sizes)) - np.repeat(opens, np.diff(np.append(opens, len(sizes))))
            held += np.bincount(sizes, minlength=capacity + 1)
            columns = [
                batch.column(0).take(pa.array(rows)), pa.array(pieces, pa.int32()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()),
                pa.array(sums, pa.int64()), pa.array([task] * len(rows), pa.int32()), pa.array(ranks), pa.array(kept, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32", "task", "rank", "ids"])

    return run


def pieces(documents: DataFrame, tokenizer_path: str, ranks_path: str | None, capacity: int, end_id: int, keep_ids: bool = False) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32, task, rank, ids); ``rank`` counts the pieces
    of the same length that came before in the same task. Stored, as only the rows of one
    attempt of a task fit together."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, rank long, ids binary"
    return stored(rows.mapInArrow(in_slices(_cut(tokenizer_path, ranks_path, capacity, end_id, keep_ids)), schema), "pieces")


# --- plan -----------------------------------------------------------------------
def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Entries (length, first, sequence, each, offset): of the pieces of that length,
    those from rank ``first`` on go to the sequences from ``sequence`` on, ``each`` to
    one, side by side from ``offset`` on. Entries of one length have rising ``first``."""
    left = {s: n for s, n in counts.items() if n}
    used = dict.fromkeys(left, 0)
    entries: list[tuple[int, int, int, int, int]] = []
    gaps: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # by gap: (first sequence, how many)
    opened = 0

    def put(size: int, sequence: int, many: int, each: int, offset: int) -> None:
        entries.append((size, used[size], sequence, each, offset))
        used[size] += many * each
        left[size] -= many * each

    def fill(size: int, sequence: int, many: int, gap: int) -> None:
        """Puts pieces into ``many`` equal sequences as long as there are any."""
        each = gap // size
        full = min(many, left[size] // each)
        if full:
            put(size, sequence, full, each, capacity - gap)
            gaps[gap - size * each].append((sequence, full))
        rest = min(left[size], each) if full < many else 0
        if rest:
            put(size, sequence + full, 1, rest, capacity - gap)
            gaps[gap - size * rest].append((sequence + full, 1))
        behind = full + bool(rest)
        if behind < many:
            gaps[gap].append((sequence + behind, many - behind))

    sizes = sorted(left, reverse=True)
    large = [s for s in sizes if 3 * s > capacity]
    for size in large:
        while left[size]:
            beside = [t for t in large if t <= min(size, capacity - size) and left[t] > (t == size)]
            mate = beside[0] if beside else None
            many = left[size] if mate is None else left[size] // 2 if mate == size else min(left[size], left[mate])
            put(size, opened, many, 1, 0)
            if mate is not None:
                put(mate, opened, many, 1, size)
            gaps[capacity - size - (mate or 0)].append((opened, many))
            opened += many
    for size in sizes[len(large):]:
        for gap in range(size, capacity + 1):
            while left[size] and gaps[gap]:
                group = gaps[gap].pop()
                fill(size, *group, gap)
        if left[size]:
            many = -(-left[size] // (capacity // size))
            fill(size, opened, many, capacity)
            opened += many
    return entries


# --- places ---------------------------------------------------------------------
def packed(documents: DataFrame, tokenizer_path: str, ranks_path: str | None = None, capacity: int = 2048, end_id: int = 0, keep_ids: bool = False) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id and offset;
    with ``keep_ids`` also its ids (four bytes each, little endian)."""
    rows = pieces(documents, tokenizer_path, ranks_path, capacity, end_id, keep_ids)
    per_task = stored(rows.groupBy("length", "task").agg(F.count(F.lit(1)).alias("held")), "lengths")
    counts = {r["length"]: r["held"] for r in per_task.groupBy("length").agg(F.sum("held").alias("held")).collect()}
    by_length: dict[int, list] = {}
    for length, *entry in plan(counts, capacity):
        by_length.setdefault(length, []).append(tuple(entry))
    schema = "length long, entries array<struct<first: long, sequence: long, each: long, offset: long>>"
    entries = documents.sparkSession.createDataFrame(list(by_length.items()), schema)
    line = Window.partitionBy("length").orderBy("task")
    before = per_task.select("length", "task", (F.sum("held").over(line) - F.col("held")).alias("before"))
    # The plan holds a few entries for each of at most ``capacity`` lengths.
    placed = rows.join(before, ["length", "task"]).join(F.broadcast(entries), "length").withColumn("rank", F.col("rank") + F.col("before"))
    placed = placed.withColumn("entry", F.element_at(F.filter("entries", lambda e: e["first"] <= F.col("rank")), -1))
    ahead = F.col("rank") - F.col("entry.first")
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("entry.sequence") + F.floor(ahead / F.col("entry.each"))).alias("sequence_id"),
        (F.col("entry.offset") + (ahead % F.col("entry.each")) * F.col("length")).alias("offset"), *(["ids"] if keep_ids else []),
    )
