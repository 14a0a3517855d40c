"""Hard negatives by exact inner products, multiplied in a residue number system.

Components are whole numbers. A product of two component matrices is computed
modulo several small primes, each as one float32 multiplication: residues are
balanced around zero and so small that every sum stays below 2^24, where float32
is exact. The signed scores come back by Chinese remaindering (balanced mixed
radix, so no comparison with half the range is needed). As many primes are taken
as the largest possible score asks for.

Anchors are a stated part of the rows. They are compared with all rows in blocks:
a block of rows meets each block of anchors once, and only the best few of a block
per anchor leave the task; windows over those select the final ones. The first
round finds each anchor's positives, the second the negatives within the range
that each positive's score allows. Rows are shuffled once per round; blocks of
anchors are copied once per group of row blocks, so memory is bounded by one block
of each whatever the number of rows or the share of one label.

Defined cases: rows with a null label, a null vector, or a null or non-finite
component take no part; shorter vectors count as filled up with zeros, empty ones
as zeros; rows are separate even where ids repeat, and follow each other by id
(nulls last), then by stored order; null ids are no anchors unless the caller says
so; anchors without positives, and positives without negatives in range, give no
rows; an empty table gives none. Scores that could pass a hundredth of 64 bits
raise an error before anything is multiplied.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored

ROWS = 8192
ANCHORS = 1024
SLICE = 256
#: Row blocks that one copy of the anchors meets, at most on average.
GROUP = 16
INNER = 1024
EXACT = 1 << 24
NOTHING = np.iinfo(np.int64).min


def scaled(embedding: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component, as whole numbers."""
    return F.transform(embedding, lambda x: F.floor(x.cast("double") * scale))


def usable(label: Column, embedding: Column) -> Column:
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return label.isNotNull() & embedding.isNotNull() & F.coalesce(finite, F.lit(False))


# --- residues -----------------------------------------------------------------------
class Residues:
    """Exact integer products of matrices with ``inner`` columns whose results are at most ``bound``."""

    def __init__(self, inner: int, bound: int) -> None:
        half = int(((EXACT - 1) // max(1, min(inner, INNER))) ** 0.5)
        candidates = (p for p in range(2 * half + 1, 2, -1) if all(p % q for q in range(2, int(p ** 0.5) + 1)))
        self.primes: list[int] = []
        product = 1
        while product <= 2 * bound:
            self.primes.append(next(candidates))
            product *= self.primes[-1]

    @staticmethod
    def balanced(values: np.ndarray, prime: int) -> np.ndarray:
        half = prime // 2
        return (values + half) % prime - half

    def split(self, matrix: np.ndarray) -> list[np.ndarray]:
        return [self.balanced(matrix, p).astype(np.float32) for p in self.primes]

    def product(self, left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
        """Scores of each row of ``left`` with each row of ``right``, both as :meth:`split` gives them."""
        found = np.zeros((len(left[0]), len(right[0])), np.int64) if left else None
        radix = 1
        for p, a, b in zip(self.primes, left, right):
            rest = -found
            for i in range(0, a.shape[1], INNER):
                rest += (a[:, i:i + INNER] @ b[:, i:i + INNER].T).astype(np.int64)
            found += radix * self.balanced((rest % p) * pow(radix, -1, p), p)
            radix *= p
        return found


# --- blocks -------------------------------------------------------------------------
BLOCK = "block long, n int, numbers binary, ids binary, known binary, labels binary, values binary, limits binary"
_NAMES = [c.split(" ")[0] for c in BLOCK.split(", ")]


def _packed(rows: int, inner: int, kind: str, limits: int) -> Callable:
    """Blocks of at most ``rows`` rows in order of id. ``limits``: how many positive
    scores an anchor may carry (0 for plain rows)."""
    def block(tables: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(tables)
        ids = t.column("id")
        known = np.array(ids.is_valid())
        ids = ids.fill_null(0).to_numpy()
        numbers = t.column("number").to_numpy()
        order = np.lexsort((numbers, ids, ~known))
        lists = t.column("values").combine_chunks()
        sizes = np.diff(lists.offsets.to_numpy())
        values = np.zeros((len(ids), inner), kind)
        values[np.arange(inner) < sizes[:, None]] = lists.flatten().to_numpy()
        fields = [numbers, ids, known, t.column("label").to_numpy(), values]
        parts = [f[order].tobytes() for f in fields]
        carried = b""
        if limits:
            scores = np.full((len(ids), limits), NOTHING)
            for i, found in enumerate(t.column("limits").to_pylist()):
                scores[i, :len(found)] = found
            carried = scores[order].tobytes()
        name = int(numbers.min())
        return pa.RecordBatch.from_arrays(
            [pa.array([name], pa.int64()), pa.array([len(ids)], pa.int32()), *[pa.array([p], pa.binary()) for p in [*parts, carried]]], _NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        count = 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                held.append(batch.slice(at, rows - count))
                count += held[-1].num_rows
                at += held[-1].num_rows
                if count == rows:
                    yield block(held)
                    held, count = [], 0
        if held:
            yield block(held)

    return run


class _Block:
    def __init__(self, row: dict, inner: int, kind: str, limits: int = 0) -> None:
        self.numbers = np.frombuffer(row["numbers"], np.int64)
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.known = np.frombuffer(row["known"], bool)
        self.labels = np.frombuffer(row["labels"], np.int64)
        self.values = np.frombuffer(row["values"], kind).reshape(len(self.ids), inner).astype(np.int64)
        self.limits = np.frombuffer(row["limits"], np.int64).reshape(len(self.ids), limits) if limits else None


def _best(scores: np.ndarray, allowed: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per row the best allowed columns, one after the other: (rows, columns). Of equal
    scores the first column, so the smallest id, comes first."""
    masked = np.where(allowed, scores, NOTHING)
    rows = np.arange(len(masked))
    for _ in range(min(most, masked.shape[1])):
        at = masked.argmax(axis=1)
        real = masked[rows, at] != NOTHING
        if not real.any():
            return
        yield rows[real], at[real]
        masked[rows, at] = NOTHING


MINED = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
FOUND = "anchor long, place int, score long, id long, number long"


def _met(residues: Residues, inner: int, kind: str, choose: Callable, limits: int) -> Callable:
    """Pairs of blocks to the rows that ``choose`` picks: triples (place, rows, columns)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, split = None, None
        for batch in batches:
            for one in (batch.slice(i, 1) for i in range(batch.num_rows)):
                pair = {name: one.column(i)[0].as_py() for i, name in enumerate(one.schema.names)}
                theirs = _Block({n: pair[n] for n in _NAMES}, inner, kind)
                if last != pair["block"]:
                    last, split = pair["block"], residues.split(theirs.values)
                ours = _Block({n: pair[f"a_{n}"] for n in _NAMES}, inner, kind, limits)
                for i in range(0, len(ours.ids), SLICE):
                    part = slice(i, i + SLICE)
                    scores = residues.product(residues.split(ours.values[part]), split)
                    for place, rows, columns in choose(ours, part, theirs, scores):
                        ids = pa.array(theirs.ids[columns], mask=~theirs.known[columns])
                        yield pa.RecordBatch.from_arrays([
                            pa.array(ours.numbers[part][rows]), pa.array(np.full(len(rows), place, np.int32)), pa.array(scores[rows, columns]), ids, pa.array(theirs.numbers[columns]),
                        ], ["anchor", "place", "score", "id", "number"])

    return run


def _compared(blocks: DataFrame, anchors: DataFrame, groups: int, run: Callable) -> DataFrame:
    """Every block of rows with every block of anchors, joined by a group of row blocks."""
    copies = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"), *[F.col(n).alias(f"a_{n}") for n in _NAMES])
    grouped = blocks.withColumn("group", F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int"))
    # The number of partitions is given: blocks are small, but a pair of them is much work.
    met = grouped.repartition(groups, "group").join(copies.repartition(groups, "group"), "group")
    return met.drop("group").mapInArrow(run, FOUND)


def hard_negatives(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """``rows``: id (long), label (long) and values (array of whole numbers). For each
    anchor its first ``positives`` other rows of its label, and for each of them the first
    ``negatives`` rows of other labels with low * positive <= 100 * score <= high * positive.
    Columns anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    rows = stored(rows.select("id", "label", "values", F.coalesce(is_anchor, F.lit(False)).alias("anchor"), F.monotonically_increasing_id().alias("number")), "vectors")
    size = F.array_max(F.transform("values", F.abs))
    inner, largest, anchors_held = rows.agg(F.max(F.size("values")), F.max(size), F.count_if("anchor")).first()
    if not anchors_held:
        return rows.sparkSession.createDataFrame([], MINED)
    inner, largest = max(inner, 1), largest or 0
    bound = inner * largest * largest
    if 100 * bound >= 1 << 63:
        raise ValueError(f"scores of {inner} components up to {largest} do not fit 64 bits")
    kind = "<i2" if largest < 1 << 15 else "<i8"
    residues = Residues(inner, max(bound, 1))

    blocks = stored(rows.select("number", "id", "label", "values").mapInArrow(_packed(ROWS, inner, kind, 0), BLOCK), "vector-blocks")
    held = blocks.count()
    groups = max(-(-held // GROUP), min(held, rows.sparkSession.sparkContext.defaultParallelism))
    anchors = rows.where("anchor").select("number", "id", "label", "values")
    packed = anchors.mapInArrow(_packed(ANCHORS, inner, kind, 0), BLOCK)

    def alike(ours: _Block, part: slice, theirs: _Block, scores: np.ndarray):
        same = (ours.labels[part, None] == theirs.labels) & (ours.numbers[part, None] != theirs.numbers)
        for found in _best(scores, same, positives):
            yield 0, *found

    met = _compared(blocks, packed, groups, _met(residues, inner, kind, alike, 0))
    first = _first(met.drop("place"), ["anchor"], positives).withColumnRenamed("rank", "place")
    found = stored(first.select("anchor", "place", "score", "id"), "positives")

    limits = found.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("place", "score"))).alias("limits"))
    limited = anchors.join(limits, anchors["number"] == limits["anchor"]).select("number", "id", "label", "values", F.col("limits.score").alias("limits"))

    def unlike(ours: _Block, part: slice, theirs: _Block, scores: np.ndarray):
        other = ours.labels[part, None] != theirs.labels
        for k in range(positives):
            positive = ours.limits[part, k][:, None]
            real = positive != NOTHING
            positive = np.where(real, positive, 0)
            near = other & real & (low * positive <= 100 * scores) & (100 * scores <= high * positive)
            for rows, columns in _best(scores, near, negatives):
                yield k + 1, rows, columns

    met = _compared(blocks, limited.mapInArrow(_packed(ANCHORS, inner, kind, positives), BLOCK), groups, _met(residues, inner, kind, unlike, positives))
    mined = _first(met, ["anchor", "place"], negatives)
    known = found.select("anchor", "place", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    ids = anchors.select(F.col("number").alias("anchor"), F.col("id").alias("anchor_id"))
    return mined.join(known, ["anchor", "place"]).join(ids, "anchor").select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"),
    )


def _first(met: DataFrame, keys: list[str], most: int) -> DataFrame:
    """The first ``most`` rows of each key; Spark cuts every task's rows before it shuffles them."""
    line = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), "number")
    return met.withColumn("rank", F.row_number().over(line)).where(F.col("rank") <= most)
