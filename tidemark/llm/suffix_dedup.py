"""Removal of byte strings of a given length that occur more than once.

The method is the column-wise construction of a suffix order for many documents:
in each round one more symbol of every document is put before its suffix, the
Burrows-Wheeler column of the collection tells the new order, and the common
prefixes of neighbours follow from those of the round before. Columns lie in a
sequential file and are read one by one, so memory holds two numbers a document.

Whole documents cannot be the columns: the number of rounds would be the length
of the longest, each a pass over everything. Two steps find a collection of
short documents that has every repeat:

1. Each string of ``length`` bytes has an anchor, the leftmost of its smallest
   hashed runs of ``GRAM`` bytes. Equal strings have equal anchors at equal
   places. The strings of one anchor occurrence lie in one *span* of fewer than
   ``2 * length`` bytes; a table of about one span per 80 bytes represents all
   strings.
2. A span that occurs twice is repeated as a whole, wherever it stands. A span
   whose anchor occurs nowhere else holds no repeat. What remains are spans that
   share an anchor but differ: they are the short documents, aligned at their
   anchor, and go through at most 360 rounds.

Spans met twice inside a task are settled there, so the copies of a text leave
each task once. Texts are shuffled once, to meet their repeated spans.

Defined cases: null texts are empty; texts shorter than ``length`` hold no such
string; overlapping and self-overlapping repeats count; identical rows repeat
each other; null ids are kept; empty tables give no rows; other columns are not
read.
"""

from __future__ import annotations

import hashlib
import tempfile
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import in_slices, stored
from tidemark.llm.shingles import U, mixed

GRAM = 40
PLACE_BITS = 20
STEP = 1 << 19
CHUNK = 400_000
FILTER_BITS = 25
ROWS = 4096
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_SYMBOLS = mixed(np.arange(1, 257, dtype=U) * U(0xD1342543DE82EF95))


class _Powers:
    """Powers of the base and of its inverse, as far as any text needed them."""

    up = np.ones(1, U)
    down = np.ones(1, U)

    @classmethod
    def to(cls, n: int) -> None:
        while len(cls.up) < n:
            for name, base in (("up", _BASE), ("down", _INVERSE)):
                old = getattr(cls, name)
                setattr(cls, name, np.concatenate([old, old * U(pow(base, len(old), 1 << 64))]))


def running_sums(data: np.ndarray) -> np.ndarray:
    """Sums from which the hash of any substring follows."""
    _Powers.to(len(data) + 1)
    out = np.zeros(len(data) + 1, U)
    np.cumsum(_SYMBOLS[data] * _Powers.down[:len(data)], out=out[1:])
    return out


def hashes(sums: np.ndarray, begin: np.ndarray | slice, end: np.ndarray | slice) -> np.ndarray:
    return mixed((sums[end] - sums[begin]) * _Powers.up[:len(sums)][begin])


def sliding_smallest(keys: np.ndarray, width: int) -> np.ndarray:
    """Smallest key of every run of ``width``."""
    n = len(keys) - width + 1
    blocks = -(-len(keys) // width)
    full = np.full(blocks * width, ~U(0))
    full[:len(keys)] = keys
    rows = full.reshape(blocks, width)
    ahead = np.minimum.accumulate(rows, 1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


def spans(data: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Per anchor occurrence: anchor hash, span hash, first string, number of
    strings, and the anchor's place in the span."""
    total = len(data) - length + 1
    if total <= 0:
        return tuple(np.zeros(0, t) for t in (U, U, np.int64, np.int64, np.int64))
    width = length - GRAM + 1
    sums = running_sums(data)
    grams = hashes(sums, slice(0, len(sums) - GRAM), slice(GRAM, None))
    mask = U((1 << PLACE_BITS) - 1)
    begins, anchors = [], []
    for base in range(0, total, STEP):
        part = grams[base:min(total, base + STEP) + width - 1]
        keys = (part & ~mask) | np.arange(len(part), dtype=U)
        low = sliding_smallest(keys, width) & mask
        first = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
        begins.append(first + base)
        anchors.append(low[first].astype(np.int64) + base)
    begin, anchor = np.concatenate(begins), np.concatenate(anchors)
    count = np.diff(np.append(begin, total))
    lead = anchor - begin
    whole = mixed(hashes(sums, begin, begin + count + length - 1) + (count * 1024 + lead).astype(U))
    return grams[anchor], whole, begin, count, lead


_NAMES = ["gram", "span", "weight", "doc_id", "text_key", "at", "n", "lead"]
_SCHEMA = "gram long, span long, weight int, doc_id long, text_key long, at int, n int, lead int"


def _bytes(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]


def _span_rows(length: int):
    """Rows of _SCHEMA. The first of a task's equal spans carries their number as
    weight; the others have weight 0 and are known to be repeated."""
    def out(parts: list[tuple], ids: list, keys: list[int]) -> pa.RecordBatch:
        gram, span, at, n, lead = (np.concatenate([p[i] for p in parts]) for i in range(5))
        owner = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
        order = np.lexsort((span, gram))
        same = np.zeros(len(order), bool)
        same[1:] = (gram[order][1:] == gram[order][:-1]) & (span[order][1:] == span[order][:-1])
        first = np.flatnonzero(~same)
        weight = np.zeros(len(order), np.int32)
        weight[order[first]] = np.diff(np.append(first, len(order)))
        key = np.array(keys, np.int64)[owner]
        # settled rows need no partner: they are dealt out by their place
        gram = np.where(weight == 0, mixed(key.view(U) + at.astype(U)), gram)
        return pa.RecordBatch.from_arrays([
            pa.array(gram.view(np.int64)), pa.array(span.view(np.int64)), pa.array(weight),
            pa.array(ids, pa.int64()).take(pa.array(owner)), pa.array(key),
            pa.array(at.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(lead.astype(np.int32)),
        ], _NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, ids, keys, held = [], [], [], 0
        for batch in batches:
            for doc, key, text in zip(batch.column("doc_id").to_pylist(), batch.column("text_key").to_pylist(), _bytes(batch)):
                found = spans(np.frombuffer(text, np.uint8), length)
                if len(found[0]):
                    parts.append(found)
                    ids.append(doc)
                    keys.append(key)
                    held += len(found[0])
                if held > CHUNK:
                    yield out(parts, ids, keys)
                    parts, ids, keys, held = [], [], [], 0
        if held:
            yield out(parts, ids, keys)

    return run


def judged_spans(documents: DataFrame, length: int) -> DataFrame:
    """Stored spans that matter: ``whole`` ones occur twice, ``compare`` ones share
    their anchor with a different span and take part in the comparison."""
    rows = documents.mapInArrow(in_slices(_span_rows(length)), _SCHEMA).withColumn("settled", F.col("weight") == 0)
    group = Window.partitionBy("gram", "settled")
    equal = Window.partitionBy("gram", "settled", "span")
    rows = rows.withColumns({
        "times": F.sum("weight").over(equal), "turn": F.row_number().over(equal.orderBy("at")),
        "differ": F.min("span").over(group) != F.max("span").over(group),
    }).withColumn("rarest", F.min("times").over(group))
    whole = F.col("settled") | (F.col("times") > 1)
    compare = ~F.col("settled") & F.col("differ") & (F.col("rarest") == 1) & (F.col("turn") == 1)
    return stored(rows.withColumns({"whole": whole, "compare": compare}).where("whole OR compare").select(*_NAMES, "whole", "compare"), "spans")


def _place(gram: np.ndarray, span: np.ndarray) -> np.ndarray:
    return (mixed(gram ^ (span * U(3))) >> U(64 - FILTER_BITS)).astype(np.int64)


def _filter(rows: DataFrame) -> bytes:
    """Bits of the spans to compare: 4 MB, whatever their number."""
    def long(batch: pa.RecordBatch, name: str) -> np.ndarray:
        return batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64).view(U)

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(1 << FILTER_BITS, bool)
        for batch in batches:
            out[_place(long(batch, "gram"), long(batch, "span"))] = True
        yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(np.packbits(out).tobytes(), 1)], pa.binary())], ["bits"])

    def united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
        for batch in batches:
            for found in batch.column("bits").to_pylist():
                out |= np.frombuffer(zlib.decompress(found), np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], ["bits"])

    return rows.select("gram", "span").mapInArrow(bits, "bits binary").repartition(1).mapInArrow(united, "bits binary").first()["bits"]


def _span_bytes(length: int, bits):
    """Rows (gram, span, bytes), each span once a task, for spans that may be compared."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.unpackbits(np.frombuffer(bits.value, np.uint8)).astype(bool)
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            grams, wholes, cut = [], [], []
            for text in _bytes(batch):
                gram, span, at, n, _ = spans(np.frombuffer(text, np.uint8), length)
                for i in np.flatnonzero(known[_place(gram, span)]).tolist():
                    name = (int(gram[i]), int(span[i]))
                    if name in seen:
                        continue
                    if len(seen) >= CHUNK:
                        seen.clear()
                    seen.add(name)
                    grams.append(gram[i])
                    wholes.append(span[i])
                    cut.append(text[at[i]:at[i] + n[i] + length - 1])
            yield pa.RecordBatch.from_arrays([
                pa.array(np.array(grams, U).view(np.int64)), pa.array(np.array(wholes, U).view(np.int64)), pa.array(cut, pa.binary()),
            ], ["gram", "span", "bytes"])

    return run


class Columns:
    """Short documents, aligned at their anchors, in a sequential file by column."""

    def __init__(self, left: int, right: int) -> None:
        self.left, self.width = left, left + right
        self.file = tempfile.TemporaryFile()
        self.blocks = 0
        self.waiting: list[tuple[bytes, int]] = []

    def add(self, data: bytes, lead: int) -> None:
        self.waiting.append((data, lead))
        if len(self.waiting) == ROWS:
            self._write()

    def _write(self) -> None:
        block = np.zeros((ROWS, self.width), np.uint8)
        for i, (data, lead) in enumerate(self.waiting):
            block[i, self.left - lead:self.left - lead + len(data)] = np.frombuffer(data, np.uint8)
        self.file.write(np.ascontiguousarray(block.T).tobytes())
        self.blocks += 1
        self.waiting = []

    def finished(self) -> np.ndarray:
        """All columns as [block, column, row of the block], mapped from the file."""
        if self.waiting:
            self._write()
        self.file.flush()
        return np.memmap(self.file, np.uint8, "r", shape=(self.blocks, self.width, ROWS))


def repeated_starts(columns: np.ndarray, left: int, group: np.ndarray, lead: np.ndarray, size: np.ndarray, length: int) -> Iterator[tuple[int, np.ndarray]]:
    """Column-wise construction. Yields (start relative to the anchor, documents
    whose string from there occurs in another document of their group).

    ``order`` is the suffix order of the collection so far, by group; ``shared`` the
    common prefix of each suffix with the one before. A round reads the column
    before, whose symbols in suffix order are the Burrows-Wheeler column, and a
    stable sort by it gives the next order. Two neighbours after the round with
    one symbol share it and the least of what lay between them.
    """
    n = len(group)
    order = np.arange(n)
    shared = np.zeros(n + 1, np.int32)
    ends = size - lead
    for at in range(int(ends.max(initial=0)) - 1, -int(lead.max(initial=0)) - 1, -1):
        column = columns[:, at + left, :].reshape(-1)[:n]
        inside = (at < ends) & (at >= -lead)
        symbol = np.where(inside, column.astype(np.int64) + 1, 0)[order]
        moved = np.argsort(group[order] * 257 + symbol, kind="stable")
        key = (group[order] * 257 + symbol)[moved]
        alike = np.flatnonzero((key[1:] == key[:-1]) & (symbol[moved][1:] > 0)) + 1
        after = np.zeros(n + 1, np.int32)
        if len(alike):
            a, b = moved[alike - 1] + 1, moved[alike] + 1
            after[alike] = 1 + np.minimum.reduceat(shared, np.stack([a, b], 1).ravel())[::2]
        order, shared = order[moved], after
        if at <= 0:
            long = shared >= length
            hit = long[:-1] | long[1:]
            if hit.any():
                yield at, order[hit]


def _compared(length: int):
    """Rows sorted by gram to repeated runs (doc_id, text_key, at, n)."""
    left = length - GRAM

    def repeats(columns: Columns, rows: list[tuple]) -> pa.RecordBatch:
        group = np.unique(np.array([r[0] for r in rows], np.int64), return_inverse=True)[1]
        lead, n = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
        alone = np.array([r[3] for r in rows])
        found = [[], []]
        for at, docs in repeated_starts(columns.finished(), left, group, lead, n + length - 1, length):
            docs = docs[alone[docs]]
            found[0].append(docs)
            found[1].append(np.full(len(docs), at))
        doc = np.concatenate(found[0]) if found[0] else np.zeros(0, np.int64)
        at = np.concatenate(found[1]) if found[1] else np.zeros(0, np.int64)
        start = at + lead[doc]
        order = np.lexsort((start, doc))
        doc, start = doc[order], start[order]
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (start[1:] != start[:-1] + 1)
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(doc)))
        chosen = [rows[d] for d in doc[first]]
        return pa.RecordBatch.from_arrays([
            pa.array([r[4] for r in chosen], pa.int64()), pa.array([r[5] for r in chosen], pa.int64()),
            pa.array(np.array([r[6] for r in chosen], np.int64) + start[first], pa.int32()), pa.array(count, pa.int32()),
        ], ["doc_id", "text_key", "at", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns, rows = Columns(left, length), []
        for batch in batches:
            names = ("gram", "lead", "n", "whole", "doc_id", "text_key", "at", "bytes")
            for gram, lead, n, whole, doc, key, at, data in zip(*[batch.column(c).to_pylist() for c in names]):
                if len(rows) >= CHUNK // 8 and gram != rows[-1][0]:
                    yield repeats(columns, rows)
                    columns, rows = Columns(left, length), []
                columns.add(data, lead)
                rows.append((gram, lead, n, not whole, doc, key, at))
        if rows:
            yield repeats(columns, rows)

    return run


def keyed(documents: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))


def repeated_runs(documents: DataFrame, length: int = 200) -> DataFrame:
    """Rows (doc_id, text_key, at, n): the ``n`` strings of ``length`` bytes from
    byte ``at`` on also start elsewhere. ``documents`` are rows of :func:`keyed`."""
    judged = judged_spans(documents, length)
    compare = judged.where("compare").drop("compare", "weight")
    bits = documents.sparkSession.sparkContext.broadcast(_filter(compare))
    cut = documents.select("text").mapInArrow(in_slices(_span_bytes(length, bits)), "gram long, span long, bytes binary").dropDuplicates(["gram", "span"])
    short = compare.join(cut, ["gram", "span"]).repartition("gram").sortWithinPartitions("gram")
    partly = short.mapInArrow(in_slices(_compared(length)), "doc_id long, text_key long, at int, n int")
    return judged.where("whole").select("doc_id", "text_key", "at", "n").unionByName(partly)


def without_repeats(documents: DataFrame, length: int = 200, keep_bytes: bool = False) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans (removed runs), kept_sha256
    and, if asked for, the kept bytes.

    Texts and their runs are brought together by one shuffle and a sort; a task
    holds one text at a time.
    """
    docs = keyed(documents)
    runs = repeated_runs(docs, length)
    both = docs.withColumns({"at": F.lit(None).cast("int"), "n": F.lit(None).cast("int")}).unionByName(runs.withColumn("text", F.lit(None).cast("string")))
    ordered = both.repartition("doc_id", "text_key").sortWithinPartitions("doc_id", "text_key", F.col("text").isNotNull())
    fields = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * keep_bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, found = None, []
        for batch in batches:
            out = []
            rows = zip(*[batch.column(c).to_pylist() for c in ("doc_id", "text_key", "at", "n")], batch.column("text").cast(pa.binary()).to_pylist())
            for doc, text_key, at, n, text in rows:
                if key != (doc, text_key):
                    key, found = (doc, text_key), []
                if text is None:
                    found.append((at, at + n + length - 1))
                    continue
                data = np.frombuffer(text, np.uint8)
                kept, removed, parts = text, 0, 0
                if found:
                    edge = np.zeros(len(data) + 1, np.int32)
                    ends = np.array(found)
                    np.add.at(edge, ends[:, 0], 1)
                    np.add.at(edge, ends[:, 1], -1)
                    gone = np.cumsum(edge[:-1]) > 0
                    removed = int(gone.sum())
                    parts = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                    kept = data[~gone].tobytes()
                out.append((doc, len(data), removed, parts, hashlib.sha256(kept).hexdigest(), *([kept] * keep_bytes)))
            kinds = [pa.int64()] * 4 + [pa.string()] + [pa.binary()] * keep_bytes
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * keep_bytes
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], kinds[i]) for i in range(len(kinds))], names)

    return ordered.mapInArrow(in_slices(run), fields)
