"""Exact Jaccard self-join on word shingles: a grouped prefix join.

Documents with the same set are one class. What is joined are not single
shingles but *segments*: the hash space is cut into segments, and a segment's
token is the hash of all shingles of the document in it. Sets that link differ
in at most ``k`` shingles, so in at most ``k`` segments; the prefix theorem then
says that among the first ``k + 1`` tokens of both, in any order both share, one
is the same. Tokens of many shingles come first: they are the rare ones. Random
overlap and shared passages almost never fill a whole segment alike.

``k`` depends on size, so sizes fall into classes (ratio 1.5) with their own
segments, and a document near the upper edge also asks in the next class.

Shingles of great document frequency (frequent passages) are left out of the
segments. Which those are is read from a sketch of fixed size over the whole
corpus; leaving a shingle out everywhere is sound, as it cannot add
differences. A document that keeps too few segments also joins on its whole
set, and if it has too few even there, on its single shingles. Two documents
are missed by a level only if both have too few segments at it, so the next
level finds them: no link is lost.

Documents that share a token form a group. Tokens met more than once are linked
inside the task first, so a token of a third of all documents leaves each task
once. Components of these links are the candidates. A bitmap filter comes first:
every set has one bit per cell of its hash space (as many cells as shingles, at
least), set where it holds an odd number of shingles. A shingle that only one of
two sets holds turns one bit over, so two sets whose bitmaps differ in more bits
than linked sets may differ in shingles don't link. Sets that keep a partner
(each once) are compared exactly. Both comparisons run in blocks of bounded size,
ordered by set size, and a set goes only to blocks that hold a size it can link
with. Only true links make the final components.

Defined cases: a null, empty or blank text has no shingles and links with
nothing; fewer words than a shingle make one shingle of the whole sequence;
repeated rows and ids link through their equal sets; null ids are kept (the
component is null if no member has an id); empty tables give no rows; other
columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import LONG_ROWS, in_slices, stored
from tidemark.llm.graph import components
from tidemark.llm.shingles import U, mixed, shingle_set

SKETCH_BITS = 20
SKETCH_PARTS = 64
#: A shingle is frequent if its cell holds this many times the mean, and so many more.
HEAVY_RATIO, HEAVY_LEAST = 4, 100
CLASS_RATIO = 1.5
SEGMENTS_PER_PREFIX = 1.25
CHUNK = 1 << 18
BLOOM_BITS = 25
#: Shingles in one block of candidates: 16 MB of hashes.
BLOCK_SHINGLES = 2_000_000
#: The same for bitmaps: a 64th of the hashes, 4 MB.
BITMAP_SHINGLES = 32_000_000
DENSE_CELLS = 1_000_000
#: Tokens that one task sends to one of ``buckets`` tasks travel as one row.
LEAST_BUCKETS, MOST_BUCKETS = 32, 256
#: Up to so many dropped documents (16 bytes each) are broadcast, so that texts are not shuffled.
BROADCAST_ROWS = 2_000_000


def _texts(batch: pa.RecordBatch) -> list[bytes | None]:
    return batch.column("text").cast(pa.binary()).to_pylist()


def _binaries(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary())


def node_of(values: np.ndarray) -> bytes:
    return md5(values.tobytes()).digest()


def short(node: bytes) -> int:
    """Names a set while candidates are sought. Two sets of one short name would
    only become candidates of each other; they are compared by their nodes."""
    return int.from_bytes(node[:8], "little", signed=True)


def text_key() -> Column:
    """Tells rows with one id apart."""
    return F.xxhash64(F.coalesce("text", F.lit("")))


def bitmap_of(values: np.ndarray) -> bytes:
    """Per cell of the lowest bits, whether an odd number of shingles falls into it.
    A bitmap of half as many cells is the exclusive or of both halves."""
    cells = 1 << max(8, (len(values) - 1).bit_length())
    odd = np.bincount((values & U(cells - 1)).astype(np.int64), minlength=cells) & 1
    return np.packbits(odd.astype(bool)).tobytes()


# --- classes and sketch -------------------------------------------------------------
def _profiles(size: int) -> Callable:
    """Rows (doc_id, text_key, n_shingles, node, short, bitmap) and, at the task's end, parts of its sketch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(1 << SKETCH_BITS, np.uint32)
        names = ["doc_id", "text_key", "n_shingles", "node", "short", "bitmap", "part", "counts"]
        for batch in batches:
            counts, nodes, bitmaps, cells = [], [], [], []
            for text in _texts(batch):
                values = shingle_set(text, size)
                counts.append(len(values))
                nodes.append(node_of(values) if len(values) else None)
                bitmaps.append(bitmap_of(values) if len(values) else None)
                cells.append(values >> U(64 - SKETCH_BITS))
            if cells:
                sketch += np.bincount(np.concatenate(cells).astype(np.int64), minlength=len(sketch)).astype(np.uint32)
            n = len(counts)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("text_key"), pa.array(counts, pa.int64()), pa.array(nodes, pa.binary()),
                pa.array([None if x is None else short(x) for x in nodes], pa.int64()), _binaries(bitmaps), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()),
            ], names)
        if sketch.any():
            cut = [zlib.compress(part.tobytes(), 1) for part in np.split(sketch, SKETCH_PARTS)]
            yield pa.RecordBatch.from_arrays([
                *[pa.nulls(len(cut), pa.int64())] * 3, pa.nulls(len(cut), pa.binary()), pa.nulls(len(cut), pa.int64()), pa.nulls(len(cut), pa.binary()),
                pa.array(range(len(cut)), pa.int32()), pa.array(cut, pa.binary()),
            ], names)

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums sketch parts as they stream by; memory is that of one sketch."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, counts in zip(batch.column("part").to_pylist(), batch.column("counts").to_pylist()):
            found = np.frombuffer(zlib.decompress(counts), np.uint32).astype(np.uint64)
            sums[part] = sums[part] + found if part in sums else found
    if sums:
        yield pa.RecordBatch.from_arrays([
            pa.array(list(sums), pa.int32()), _binaries([zlib.compress(s.tobytes(), 1) for s in sums.values()]),
        ], ["part", "counts"])


def frequent_cells(profiles: DataFrame) -> np.ndarray:
    """One bit per sketch cell: does it hold frequent shingles? 128 KB, whatever the corpus."""
    parts = profiles.where("part IS NOT NULL").select("part", "counts").repartition("part").mapInArrow(_added, "part int, counts binary")
    sketch = np.zeros((SKETCH_PARTS, (1 << SKETCH_BITS) // SKETCH_PARTS), np.uint64)
    for row in parts.collect():
        sketch[row["part"]] = np.frombuffer(zlib.decompress(row["counts"]), np.uint64)
    cells = sketch.reshape(-1)
    return cells > max(HEAVY_RATIO * cells.mean(), cells.mean() + HEAVY_LEAST)


# --- candidates ---------------------------------------------------------------------
def most_different(size_sum: int, percent: int) -> int:
    """Largest symmetric difference of two linked sets of ``size_sum`` elements."""
    return size_sum * (100 - percent) // (100 + percent)


def size_class(size: int) -> int:
    c = int(np.log(size) / np.log(CLASS_RATIO))
    while class_end(c) <= size:
        c += 1
    while c and class_end(c - 1) > size:
        c -= 1
    return c


def class_end(c: int) -> int:
    """First size beyond class ``c``."""
    return int(np.ceil(CLASS_RATIO ** (c + 1)))


def asked_classes(size: int, percent: int) -> list[int]:
    """The set's own class, and those above that hold sets it may link with."""
    own = size_class(size)
    out, largest = [own], size * 100 // percent
    while class_end(out[-1]) <= largest:
        out.append(out[-1] + 1)
    return out


def segment_tokens(values: np.ndarray, c: int, level: int, percent: int) -> tuple[np.ndarray, bool]:
    """Prefix of the set's tokens in class ``c``; True if it has too few segments."""
    k = most_different(2 * (class_end(c) - 1), percent)
    if level == 2:
        tokens = mixed(values + U(c * 8 + level))
        return tokens, False
    segments = int(SEGMENTS_PER_PREFIX * (k + 1)) + 1
    place = ((mixed(values) >> U(33)) % U(segments)).astype(np.int64)
    held = np.bincount(place, minlength=segments)
    full = np.flatnonzero(held)
    if not len(full):
        return np.zeros(0, U), True
    order = np.argsort(place, kind="stable")
    begins = np.cumsum(held[full]) - held[full]
    sums = np.add.reduceat(mixed(values ^ U(0x5851F42D4C957F2D))[order], begins)
    tokens = mixed(sums + mixed(full.astype(U) * U(64) + U(c)) + U(level))
    if len(full) > k + 1:
        tokens = tokens[np.lexsort((tokens, -held[full]))[:k + 1]]
    return tokens, len(full) <= k


def group_tokens(values: np.ndarray, heavy: np.ndarray, percent: int) -> np.ndarray:
    """All tokens under which a set may meet its partners."""
    light = values[~heavy[(values >> U(64 - SKETCH_BITS)).astype(np.int64)]]
    out = []
    for c in asked_classes(len(values), percent):
        for level, used in enumerate((light, values, values)):
            tokens, few = segment_tokens(used, c, level, percent)
            out.append(tokens)
            if not few:
                break
    return np.concatenate(out)


def _meetings(size: int, percent: int, heavy_bits, buckets: int) -> Callable:
    """Rows (bucket, tokens, nodes, hubs) of parallel lists. Inside a task, documents with
    one token are linked to the smallest of them (hubs set); that one alone goes
    on under the token. A bucket holds all of a token, and its lists are in the order of
    the nodes: a token takes 10 to 16 bytes of the shuffle, 28 as a row of its own."""
    def linked(tokens: np.ndarray, at: np.ndarray, names: np.ndarray) -> pa.RecordBatch:
        order = np.lexsort((names[at], tokens))
        tokens, at = tokens[order], at[order]
        first = np.ones(len(tokens), bool)
        first[1:] = tokens[1:] != tokens[:-1]
        hub = at[np.maximum.accumulate(np.where(first, np.arange(len(tokens)), 0))]
        inner = ~first & (hub != at)
        pairs = np.unique(np.stack([at[inner], hub[inner]], 1), axis=0) if inner.any() else np.zeros((0, 2), np.int64)
        at = at[first]
        place = (tokens[first] % U(buckets)).astype(np.int64)
        order = np.lexsort((at, place))
        alone = packed(place[order], tokens[first][order].view(np.int64), names[at[order]], None)
        order = np.argsort(pairs[:, 0] % buckets, kind="stable")
        node, hub = names[pairs[order, 0]], names[pairs[order, 1]]
        return pa.concat_batches([alone, packed(pairs[order, 0] % buckets, node, node, hub)])

    def packed(place: np.ndarray, tokens: np.ndarray, nodes: np.ndarray, hubs: np.ndarray | None) -> pa.RecordBatch:
        held = np.flatnonzero(np.r_[True, place[1:] != place[:-1]]) if len(place) else np.zeros(0, np.int64)
        ends = pa.array(np.append(held, len(place)), pa.int32())
        lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (tokens, nodes)]
        hubs = pa.ListArray.from_arrays(pa.array(np.zeros(len(held) + 1), pa.int32()), pa.array([], pa.int64())) if hubs is None else pa.ListArray.from_arrays(ends, pa.array(hubs))
        return pa.RecordBatch.from_arrays([pa.array(place[held].astype(np.int32)), *lists, hubs], ["bucket", "tokens", "nodes", "hubs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heavy = np.unpackbits(np.frombuffer(heavy_bits.value, np.uint8)).astype(bool)
        seen: set[int] = set()
        nodes: list[int] = []
        tokens: list[np.ndarray] = []
        held = 0
        for batch in batches:
            for text in _texts(batch):
                values = shingle_set(text, size)
                if not len(values):
                    continue
                node = short(node_of(values))
                if node in seen:
                    continue
                seen.add(node)
                nodes.append(node)
                tokens.append(group_tokens(values, heavy, percent))
                held += len(tokens[-1])
                if held > CHUNK:
                    yield linked(np.concatenate(tokens), np.repeat(np.arange(len(nodes)), [len(t) for t in tokens]), np.array(nodes))
                    seen, nodes, tokens, held = set(), [], [], 0
        if held:
            yield linked(np.concatenate(tokens), np.repeat(np.arange(len(nodes)), [len(t) for t in tokens]), np.array(nodes))

    return run


def candidate_links(documents: DataFrame, heavy: np.ndarray, size: int, percent: int) -> DataFrame:
    """Edges (a, b) whose components hold every pair that may link."""
    spark = documents.sparkSession
    bits = spark.sparkContext.broadcast(np.packbits(heavy).tobytes())
    buckets = min(max(int(spark.conf.get("spark.sql.shuffle.partitions")), LEAST_BUCKETS), MOST_BUCKETS)
    lists = documents.select("text").mapInArrow(in_slices(_meetings(size, percent, bits, buckets)), "bucket int, tokens array<long>, nodes array<long>, hubs array<long>")
    met = lists.repartition("bucket").select("bucket", F.explode(F.arrays_zip("tokens", "nodes", "hubs")).alias("x")).select(
        "bucket", F.col("x.tokens").alias("token"), F.col("x.nodes").alias("node"), F.col("x.hubs").alias("hub"))
    group = Window.partitionBy("bucket", "token").orderBy(F.col("hub").isNotNull(), "node")
    smallest = F.first(F.when(F.col("hub").isNull(), F.col("node"))).over(group)
    return met.select(F.col("node").alias("a"), F.coalesce("hub", smallest).alias("b")).where("a != b").distinct()


# --- verification -------------------------------------------------------------------
def _cell(name: int) -> int:
    return name & ((1 << BLOOM_BITS) - 1)


def _possible(nodes: DataFrame) -> bytes:
    """Bits of the candidates' nodes: 4 MB, whatever their number. Extra hits cost
    work in the next pass and are removed by the join behind it."""
    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << (BLOOM_BITS - 3), np.uint8)
        for batch in batches:
            for name in batch.column("node").to_pylist():
                bits[_cell(name) >> 3] |= 1 << (_cell(name) & 7)
        if bits.any():
            yield pa.RecordBatch.from_arrays([_binaries([zlib.compress(bits.tobytes(), 1)])], ["bits"])

    def united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(1 << (BLOOM_BITS - 3), np.uint8)
        for batch in batches:
            for bits in batch.column("bits").to_pylist():
                out |= np.frombuffer(zlib.decompress(bits), np.uint8)
        yield pa.RecordBatch.from_arrays([_binaries([out.tobytes()])], ["bits"])

    parts = nodes.select("node").mapInArrow(collect, "bits binary")
    return parts.repartition(1).mapInArrow(united, "bits binary").first()["bits"]


def _candidate_sets(size: int, possible) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = possible.value
        seen: set[bytes] = set()
        for batch in batches:
            nodes, sets = [], []
            for text in _texts(batch):
                values = shingle_set(text, size)
                if not len(values):
                    continue
                node = node_of(values)
                cell = _cell(short(node))
                if node in seen or not bits[cell >> 3] >> (cell & 7) & 1:
                    continue
                if len(seen) >= CHUNK:
                    seen.clear()
                seen.add(node)
                nodes.append(node)
                sets.append(values.tobytes())
            yield pa.RecordBatch.from_arrays([_binaries(nodes), _binaries(sets)], ["node", "shingles"])

    return run


def _similar_bitmaps(left: list[tuple[int, bytes]], right: list[tuple[int, bytes]], percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of (size, bitmap) that may link, a few rows of left at a time.
    Bitmaps of different lengths are folded to the shorter one."""
    def levels(rows: list[tuple[int, bytes]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        sizes, lengths = np.array([r[0] for r in rows], np.int64), np.array([len(r[1]) for r in rows], np.int64)
        for length in np.unique(lengths).tolist():
            at = np.flatnonzero(lengths == length)
            yield at, sizes[at], np.frombuffer(b"".join([rows[k][1] for k in at]), np.uint64).reshape(len(at), -1)

    def folded(bits: np.ndarray, words: int) -> np.ndarray:
        return np.bitwise_xor.reduce(bits.reshape(len(bits), -1, words), axis=1)

    others = list(levels(right))
    for at_l, sizes_l, bits_l in levels(left):
        for at_r, sizes_r, bits_r in others:
            if 100 * sizes_l.max() < percent * sizes_r.min() or 100 * sizes_r.max() < percent * sizes_l.min():
                continue
            words = min(bits_l.shape[1], bits_r.shape[1])
            mine, theirs = folded(bits_l, words), np.ascontiguousarray(folded(bits_r, words).T)
            step = max(1, DENSE_CELLS // len(at_r))
            for a in range(0, len(at_l), step):
                some = mine[a:a + step]
                differ = np.zeros((len(some), len(at_r)), np.int32)
                for w in range(words):
                    differ += np.bitwise_count(some[:, w, None] ^ theirs[w])
                i, j = np.nonzero((100 + percent) * differ.astype(np.int64) <= (100 - percent) * (sizes_l[a:a + step, None] + sizes_r))
                yield at_l[i + a], at_r[j]


def _linked_pairs(left: list[np.ndarray], right: list[np.ndarray], percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (into left, into right) that link, a few rows of left at a time.
    Between the sets of one list, a shingle that only one of them holds is left out."""
    if not left or not right:  # a block number that no set has
        return
    sizes_l, sizes_r = np.array([len(v) for v in left]), np.array([len(v) for v in right])
    if left is right:
        flat = np.sort(np.concatenate(left))
        shared = np.unique(flat[1:][flat[1:] == flat[:-1]])
        del flat
    else:
        shared = np.intersect1d(np.unique(np.concatenate(left)), np.unique(np.concatenate(right)), assume_unique=True)

    def columns(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        found = []
        for values in sets:
            at = np.searchsorted(shared, values)
            at[at == len(shared)] = 0
            found.append(at[shared[at] == values].astype(np.int32))
        return np.repeat(np.arange(len(sets), dtype=np.int32), [len(f) for f in found]), np.concatenate(found)

    if not len(shared):
        return
    row_l, col_l = columns(left)
    row_r, col_r = (row_l, col_l) if left is right else columns(right)
    begin_l = np.searchsorted(row_l, np.arange(len(left) + 1))
    by_column = np.argsort(col_r, kind="stable")
    sorted_columns = col_r[by_column]
    step = max(1, min(512, DENSE_CELLS // max(len(right), 1)))
    width = max(1, DENSE_CELLS // max(step, len(right)))
    for a in range(0, len(left), step):
        b = min(len(left), a + step)
        rows, cols = row_l[begin_l[a]:begin_l[b]] - a, col_l[begin_l[a]:begin_l[b]]
        both = np.zeros((b - a, len(right)), np.float32)
        used = np.unique(cols)
        for w in range(0, len(used), width):
            chosen = used[w:w + width]
            dense_l = np.zeros((b - a, len(chosen)), np.float32)
            inside = (cols >= chosen[0]) & (cols <= chosen[-1])
            dense_l[rows[inside], np.searchsorted(chosen, cols[inside])] = 1
            span = by_column[np.searchsorted(sorted_columns, chosen[0]):np.searchsorted(sorted_columns, chosen[-1], "right")]
            place = np.searchsorted(chosen, col_r[span])
            hit = chosen[np.minimum(place, len(chosen) - 1)] == col_r[span]
            dense_r = np.zeros((len(chosen), len(right)), np.float32)
            dense_r[place[hit], row_r[span][hit]] = 1
            both += dense_l @ dense_r
        common = both.astype(np.int64)
        i, j = np.nonzero((100 + percent) * common >= percent * (sizes_l[a:b, None] + sizes_r[None, :]))
        yield i + a, j


def _smallest_roots(n: int, pairs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    root = np.arange(n)
    if not pairs:
        return root
    i = np.concatenate([p[0] for p in pairs])
    j = np.concatenate([p[1] for p in pairs])
    while True:
        low = np.minimum(root[i], root[j])
        was = root.copy()
        np.minimum.at(root, root[i], low)
        np.minimum.at(root, root[j], low)
        while (root[root] != root).any():
            root = root[root]
        if (root == was).all():
            return root


def _members(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[tuple[bool, list[tuple], list[tuple]]]:
    """Per (group, bi, bj) of rows sorted by them: whether the group is one block, and the rows
    of ``columns`` in both blocks; one list if it is the same block."""
    def halves() -> tuple[bool, list[tuple], list[tuple]]:
        _, bi, bj, whole = key
        left = [m[1:] for m in members if m[0] == bi]
        return whole, left, left if bi == bj else [m[1:] for m in members if m[0] == bj]

    key, members = None, []
    for batch in batches:
        for group, bi, bj, whole, *row in zip(*[batch.column(c).to_pylist() for c in ("group", "bi", "bj", "whole", "block", *columns)]):
            if key != (group, bi, bj, whole):
                if members:
                    yield halves()
                key, members = (group, bi, bj, whole), []
            members.append(tuple(row))
    if members:
        yield halves()


def _alike(percent: int) -> Callable:
    """Rows (a, b): links between names whose components hold every pair that the bitmaps let pass."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, left, right in _members(batches, ("short", "held", "bitmap")):
            everyone = left if left is right else left + right
            names = np.array([m[0] for m in everyone], np.int64)
            found, shift = [], 0 if left is right else len(left)
            for i, j in _similar_bitmaps([m[1:] for m in left], [m[1:] for m in right], percent):
                root = _smallest_roots(len(everyone), [(i, j + shift)])
                moved = np.flatnonzero(root != np.arange(len(root)))
                found.append((moved, root[moved]))
            root = _smallest_roots(len(everyone), found)
            moved = np.flatnonzero(root != np.arange(len(root)))
            yield pa.RecordBatch.from_arrays([pa.array(names[moved]), pa.array(names[root[moved]])], ["a", "b"])

    return run


def _verified(percent: int) -> Callable:
    """Rows sorted by (group, bi, bj) to (group, whole, node, root, links): the
    components inside one pair of blocks and the weight each node links with."""
    def links(whole: bool, left: list[tuple], right: list[tuple]) -> pa.RecordBatch:
        everyone = left if left is right else left + right
        shift = 0 if left is right else len(left)
        weight = np.zeros(len(everyone), np.int64)
        copies = np.array([m[1] for m in everyone], np.int64)
        found = []
        sets = [np.frombuffer(m[2], U) for m in left]
        for i, j in _linked_pairs(sets, sets if left is right else [np.frombuffer(m[2], U) for m in right], percent):
            if left is right:
                other = i != j
                i, j = i[other], j[other]
                np.add.at(weight, i, copies[j])
            else:
                np.add.at(weight, i, copies[j + shift])
                np.add.at(weight, j + shift, copies[i])
            root = _smallest_roots(len(everyone), [(i, j + shift)])
            moved = np.flatnonzero(root != np.arange(len(root)))
            found.append((moved, root[moved]))
        root = _smallest_roots(len(everyone), found)
        kept = np.flatnonzero((root != np.arange(len(root))) | (weight > 0))
        return pa.RecordBatch.from_arrays([
            pa.array([whole] * len(kept), pa.bool_()), _binaries([everyone[k][0] for k in kept]),
            _binaries([everyone[root[k]][0] for k in kept]), pa.array(weight[kept], pa.int64()),
        ], ["whole", "node", "root", "links"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole, left, right in _members(batches, ("node", "copies", "shingles")):
            yield links(whole, left, right)

    return run


def placed_blocks(known: DataFrame, shingles: int | None = None) -> DataFrame:
    """``known`` (root, node, held) with the block of each set: sets of a candidate component in order of size."""
    line = Window.partitionBy("root").orderBy("held", "node").rowsBetween(Window.unboundedPreceding, 0)
    return known.withColumn("block", F.floor(F.sum("held").over(line) / (shingles or BLOCK_SHINGLES)).cast("int"))


def block_pairs(placed: DataFrame, percent: int) -> DataFrame:
    """Per set the blocks ``low`` to ``high`` that hold a size it may link with:
    the smaller of two linked sets has ``percent`` of the larger one's size at least.
    Worked out on the distinct sizes of a component; ``whole`` tells that it is one block."""
    blocks = placed.groupBy("root", "block").agg(F.min("held").alias("least"), F.max("held").alias("most"))
    sizes = placed.select("root", "held").distinct()
    may_link = (F.col("least") * percent <= 100 * F.col("held")) & (100 * F.col("most") >= percent * F.col("held"))
    reach = sizes.join(blocks, "root").where(may_link).groupBy("root", "held").agg(F.min("block").alias("low"), F.max("block").alias("high"))
    last = blocks.groupBy("root").agg((F.max("block") == 0).alias("whole"))
    return placed.join(last, "root").join(reach, ["root", "held"]).withColumnRenamed("root", "group")


def paired(placed: DataFrame, percent: int, sets: DataFrame | None = None) -> DataFrame:
    """Sets once for each pair of blocks they belong to, pairs of blocks in one task each."""
    reach = block_pairs(placed, percent)
    reach = reach if sets is None else reach.join(sets, "node")
    blocks = [F.least("block", "other").alias("bi"), F.greatest("block", "other").alias("bj")]
    rows = reach.select("*", F.explode(F.sequence("low", "high")).alias("other")).select("*", *blocks).drop("low", "high", "other")
    return rows.repartition("group", "bi", "bj").sortWithinPartitions("group", "bi", "bj")


def linked_classes(documents: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(rows, classes). Rows: doc_id, text_key, n_shingles, node per document. Classes: node,
    root, links and copies for each distinct set with more than one document or
    with links; two sets have one root if a chain of links joins them."""
    spark = documents.sparkSession
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"), "text")
    profiles = stored(docs.mapInArrow(in_slices(_profiles(size)), "doc_id long, text_key long, n_shingles long, node binary, short long, bitmap binary, part int, counts binary"), "shingle-profiles", LONG_ROWS)
    rows = profiles.where("part IS NULL").select("doc_id", "text_key", "n_shingles", "node", "short", "bitmap")
    copies = stored(rows.where("node IS NOT NULL").groupBy("node").agg(F.count(F.lit(1)).alias("copies"), F.max("n_shingles").alias("held"), F.max("short").alias("short"), F.max("bitmap").alias("bitmap")), "shingle-classes", LONG_ROWS)

    met = components(candidate_links(docs, frequent_cells(profiles), size, percent), LONG_ROWS).withColumnRenamed("node", "short")
    known = copies.join(met, "short").select("root", "node", "short", "held", "bitmap")
    alike = paired(placed_blocks(known, BITMAP_SHINGLES), percent).mapInArrow(in_slices(_alike(percent)), "a long, b long")
    groups = stored(components(alike, LONG_ROWS), "candidates")
    possible = spark.sparkContext.broadcast(_possible(groups))
    sets = docs.select("text").mapInArrow(in_slices(_candidate_sets(size, possible)), "node binary, shingles binary").dropDuplicates(["node"])
    known = copies.join(groups.withColumnRenamed("node", "short"), "short").select("root", "node", "held", "copies")
    found = stored(paired(placed_blocks(known), percent, sets).mapInArrow(in_slices(_verified(percent)), "whole boolean, node binary, root binary, links long"), "verified", LONG_ROWS)
    parts = components(found.where("NOT whole").select(F.col("node").alias("a"), F.col("root").alias("b")))
    linked = found.groupBy("node").agg(F.sum("links").alias("links"), F.min(F.when(F.col("whole"), F.col("root"))).alias("one"))
    joined = linked.join(parts.withColumnRenamed("root", "far"), "node", "left")
    roots = joined.select("node", F.coalesce("far", "one", "node").alias("root"), "links")
    classes = copies.where("copies > 1").select("node", "copies").join(roots, "node", "full")
    return rows, classes.join(copies.select("node", F.col("copies").alias("all_copies")), "node").select(
        "node", F.coalesce("root", "node").alias("root"), F.coalesce("links", F.lit(0)).alias("links"), F.col("all_copies").alias("copies"),
    )


def jaccard_components(documents: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Per document: n_shingles, component_id (smallest id of its component) and
    n_links (documents it links with; copies of its own set count)."""
    rows, classes = linked_classes(documents, size, percent)
    classes = stored(classes, "linked-classes")
    smallest = rows.where("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("low"))
    lowest = classes.join(smallest, "node").groupBy("root").agg(F.min("low").alias("component_id"))
    labels = stored(classes.join(lowest, "root").select("node", "component_id", (F.col("links") + F.col("copies") - 1).alias("n_links")), "labels")
    return rows.join(labels, "node", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )


def one_of_each_group(documents: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Documents without links, and of each component the one with the smallest id
    (then text key); of identical rows the first by the remaining columns. All
    columns stay as they came."""
    rows, classes = linked_classes(documents, size, percent)
    members = rows.where("node IS NOT NULL").join(stored(classes, "linked-classes").select("node", "root"), "node")
    members = stored(members.select("root", F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key").alias("who")), "members")
    kept = members.groupBy("root").agg(F.min("who").alias("who"))
    dropped = stored(members.join(kept, ["root", "who"], "left_anti").select("who.doc_id", "who.text_key").distinct(), "dropped")
    dropped = F.broadcast(dropped) if dropped.count() <= BROADCAST_ROWS else dropped
    # The same (id, text) more than once, with words: of these rows alone all columns are brought together.
    repeated = rows.where("node IS NOT NULL").groupBy("doc_id", "text_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    repeated = stored(repeated.select("doc_id", "text_key"), "repeated")
    docs = documents.select(F.struct(*documents.columns).alias("row"), F.col("doc_id").cast("long").alias("id"), text_key().alias("key"))
    known = lambda keys: F.col("id").eqNullSafe(keys["doc_id"]) & (F.col("key") == keys["text_key"])
    left = docs.join(dropped, known(dropped), "left_anti")
    single = left.join(repeated, known(repeated), "left_anti").select("row")
    others = [F.col(f"row.{_quoted(c)}") for c in documents.columns if c not in ("doc_id", "text")]
    turn = F.row_number().over(Window.partitionBy("id", "key").orderBy(*(others or [F.lit(0)])))
    first = left.join(repeated, known(repeated), "left_semi").withColumn("turn", turn).where("turn = 1").select("row")
    return single.unionByName(first).select("row.*")


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
