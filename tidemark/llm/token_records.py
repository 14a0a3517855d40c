"""Token ids in length-delimited binary records, with an offset index.

File format (the one known as TFRecord): per record the payload's length (8
bytes, little endian), the masked CRC-32C of those 8 bytes, the payload, and its
masked CRC-32C. A payload is one document's ids, little endian, two bytes each
if the vocabulary allows and else four. Files hold documents in ascending
doc_id; the index, a Parquet table, has one row per record with its file,
offset and width, so that records can be read in any order.

A task writes to a file named after its attempt and reports it only by the index
rows it returns; files of lost attempts are never named by the index. Memory is
bounded by one Arrow batch.

Defined cases: null texts are empty and hold the end id alone; null ids sort
first; rows with one id follow the hash of their text; an empty table gives an empty index and no
files; other columns are not read. A record whose lengths or checksums do not
fit raises an error.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.common import LONG_ROWS, in_slices, stored
from tidemark.session import scratch_path

MASK_DELTA = 0xA282EAD8
CRC32C_POLYNOMIAL = 0x82F63B78
ROW = 64
#: Words remembered per worker; with their ids they take about 140 MB at most.
CACHED_WORDS = 700_000
CACHED_PIECES = 400_000
TEXTS = 1000
JOINED = 2000
READ_BYTES = 8 << 20


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(CRC32C_POLYNOMIAL), table >> 1).astype(np.uint32)
    return table


class Crc32c:
    """CRC-32C of many byte strings at once.

    Strings are cut into rows of 64 bytes whose raw remainders are computed side
    by side; a remainder is then moved over the bytes that follow it. Moving over
    2^b zero bytes is linear and kept as four tables of 256 entries per b.
    """

    def __init__(self) -> None:
        one = _byte_table()
        follow = [one]
        for _ in range(3):
            follow.append((follow[-1] >> 8) ^ one[follow[-1] & 255])
        self.follow = follow
        values = np.arange(256, dtype=np.uint32)
        step = np.stack([self._zero_byte(values << np.uint32(8 * p)) for p in range(4)])
        self.steps = [step]
        for _ in range(40):
            self.steps.append(np.stack([self._apply(self.steps[-1], t) for t in self.steps[-1]]))

    def _zero_byte(self, crc):
        return (crc >> np.uint32(8)) ^ self.follow[0][crc & np.uint32(255)]

    @staticmethod
    def _apply(step, crc):
        return step[0][crc & 255] ^ step[1][(crc >> 8) & 255] ^ step[2][(crc >> 16) & 255] ^ step[3][crc >> 24]

    def moved(self, crc: np.ndarray, zeros: np.ndarray) -> np.ndarray:
        crc = crc.copy()
        for b in range(int(zeros.max(initial=0)).bit_length()):
            on = np.flatnonzero((zeros >> b) & 1)
            crc[on] = self._apply(self.steps[b], crc[on])
        return crc

    def __call__(self, data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """``data``: all strings end to end as bytes."""
        if not len(lengths):
            return np.zeros(0, np.uint32)
        lengths = lengths.astype(np.int64)
        rows = np.maximum(1, -(-lengths // ROW))
        first = np.cumsum(rows) - rows
        padded = np.zeros(int(rows.sum()) * ROW, np.uint8)
        shift = (first + rows) * ROW - np.cumsum(lengths)
        padded[np.repeat(shift, lengths) + np.arange(len(data))] = data
        words = padded.view("<u4").reshape(-1, ROW // 4)
        crc = np.zeros(len(words), np.uint32)
        f = self.follow
        for column in range(ROW // 4):
            crc = crc ^ words[:, column]
            crc = f[3][crc & 255] ^ f[2][(crc >> 8) & 255] ^ f[1][(crc >> 16) & 255] ^ f[0][crc >> 24]
        behind = (np.repeat(first + rows, rows) - np.arange(len(words)) - 1) * ROW
        whole = np.bitwise_xor.reduceat(self.moved(crc, behind), first)
        start = self.moved(np.full(len(lengths), 0xFFFFFFFF, np.uint32), lengths)
        return ~(whole ^ start)


def masked(crc: np.ndarray) -> np.ndarray:
    crc = crc.astype(np.uint32)
    return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(MASK_DELTA)


class WordIds(dict):
    """Blank-separated word to its ids as bytes, filled on demand.

    The tokenizer drops blanks and never looks across them, so a text's ids are
    its words' ids end to end. It also cuts words into pieces before it merges
    anything (letters, single digits, marks), so a word of plain Latin letters, digits
    and marks has its pieces' ids; unknown pieces, far fewer than unknown words, go
    to the tokenizer's model alone: in their bytes' letters they are as its normaliser
    and cutter leave them. Where that does not hold for every such letter, they go to the
    tokenizer in one text, where each ends with a token that ends a word.
    """

    _PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
    _PIECE = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zà-öø-ÿß]+|[0-9]|[^a-zà-öø-ÿß0-9]+")

    def __init__(self, path: str, width: int) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = "<u2" if width == 2 else "<u4"
        self.width = width
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.ends[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith("</w>")]] = True
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        hidden = sorted(set(range(256)).difference(shown))
        self.letters = {**{b: b for b in shown}, **{b: 256 + k for k, b in enumerate(hidden)}}
        probe = [c + d for c in map(chr, [*range(33, 127), *range(192, 256)]) if self._PLAIN.fullmatch(c) for d in ("", c)]
        probe = [x for c in probe for x in self._PIECE.findall(c.lower())] + ["there", "ça", "1", "'ll", "?!..."]
        self.direct = self._by_model(probe) == [self.tokenizer.encode(x, add_special_tokens=False).ids for x in probe]
        self.met = np.zeros(1 << 23, bool)
        self.pieces: dict[str, bytes] = {}
        self[""] = b""

    def _by_model(self, pieces: list[str]) -> list[list[int]]:
        tokens, letters = self.tokenizer.model.tokenize, self.letters
        return [[t.id for t in tokens(p if p.isascii() else p.encode().decode("latin-1").translate(letters))] for p in pieces]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, a few hundred texts at a time."""
        return [ids for i in range(0, len(texts), TEXTS) for ids in self._encode_some(texts[i:i + TEXTS])]

    def _encode_some(self, texts: list[str]) -> list[bytes]:
        """Unknown words of all texts at once. A word stays remembered from its second
        appearance on: most words appear only once, and would push out the others."""
        split = [t.replace("\n", " ").split(" ") for t in texts]
        found = [list(map(self.get, words)) for words in split]
        missing = list({w for words, ids in zip(split, found) for w, x in zip(words, ids) if x is None})
        once = []
        if missing:
            self._learn(missing)
            met = np.fromiter(map(hash, missing), np.int64, len(missing)) & (len(self.met) - 1)
            once = [missing[i] for i in np.flatnonzero(~self.met[met]).tolist()]
            self.met[met] = True
        out = [b"".join([self[w] if x is None else x for w, x in zip(words, ids)]) for words, ids in zip(split, found)]
        for word in once:
            del self[word]
        if len(self) > CACHED_WORDS:
            self.clear()
            self[""] = b""
            self.met[:] = False
        return out

    def _learn(self, missing: list[str]) -> None:
        plain, piece = self._PLAIN.fullmatch, self._PIECE.findall
        simple = [w for w in missing if plain(w) and "<|" not in w]
        cut = [piece(w.lower()) for w in simple]
        unknown = list(set().union(*cut).difference(self.pieces))
        if len(self.pieces) + len(unknown) > CACHED_PIECES:
            self.pieces.clear()
            unknown = list(set().union(*cut))
        odd = set(missing).difference(simple)
        for i in range(0, len(unknown), JOINED):
            some = unknown[i:i + JOINED]
            if self.direct:
                found = self._by_model(some)
                ids = np.fromiter(chain.from_iterable(found), self.kind)
                self._keep(self.pieces, some, ids.tobytes(), np.cumsum([len(f) for f in found]))
                continue
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, self.kind)
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) != len(some):
                raise ValueError("the tokenizer cuts plain words otherwise than into letters, digits and marks")
            self._keep(self.pieces, some, ids.tobytes(), ends)
        known = self.pieces.__getitem__
        self.update(zip(simple, [known(c[0]) if len(c) == 1 else b"".join(map(known, c)) for c in cut]))
        if odd:
            words = list(odd)
            done = self.tokenizer.encode(words, is_pretokenized=True, add_special_tokens=False)
            ends = np.searchsorted(np.asarray(done.word_ids, np.int64), np.arange(1, len(words) + 1))
            self._keep(self, words, np.asarray(done.ids, self.kind).tobytes(), ends)

    def _keep(self, where: dict, words: list[str], ids: bytes, ends: np.ndarray) -> None:
        bounds = (ends * self.width).tolist()
        where.update(zip(words, [ids[a:b] for a, b in zip([0, *bounds], bounds)]))


_encoders: dict[tuple[str, int], WordIds] = {}


def encoder(path: str, width: int) -> WordIds:
    if (path, width) not in _encoders:
        _encoders.clear()
        _encoders[path, width] = WordIds(path, width)
    return _encoders[path, width]


def id_width(tokenizer_path: str, end_id: int) -> int:
    from tokenizers import Tokenizer

    return 2 if max(end_id + 1, Tokenizer.from_file(tokenizer_path).get_vocab_size()) <= 1 << 16 else 4


def opened(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


INDEX = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("shard", T.IntegerType()), T.StructField("file", T.StringType()),
    T.StructField("record", T.LongType()), T.StructField("offset", T.LongType()), T.StructField("n_tokens", T.LongType()),
    T.StructField("width", T.IntegerType()),
])


def _writer(folder: str, tokenizer_path: str, width: int, end_id: int) -> Callable:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, crc32c = encoder(tokenizer_path, width), Crc32c()
        end = end_id.to_bytes(width, "little")
        context = TaskContext.get()
        name = f"part-{context.partitionId():06d}-{context.taskAttemptId()}.rec"
        out, offset, record = None, 0, 0
        try:
            for batch in batches:
                if out is None:
                    system, root = opened(folder)
                    system.create_dir(root, recursive=True)
                    out = system.open_output_stream(f"{root}/{name}")
                payloads = [p + end for p in ids_of.encode_all(batch.column(1).to_pylist())]
                n = len(payloads)
                sizes = np.fromiter(map(len, payloads), np.int64, n)
                heads = sizes.astype("<u8")
                head_sums = masked(crc32c(heads.view(np.uint8), np.full(n, 8)))
                sums = masked(crc32c(np.frombuffer(b"".join(payloads), np.uint8), sizes))
                for size, head_sum, payload, check in zip(sizes.tolist(), head_sums.tolist(), payloads, sums.tolist()):
                    out.write(struct.pack("<QI", size, head_sum) + payload + struct.pack("<I", check))
                starts = offset + np.cumsum(sizes + 16) - (sizes + 16)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0), pa.array(np.full(n, context.partitionId(), np.int32)), pa.array([name] * n, pa.string()),
                    pa.array(record + np.arange(n)), pa.array(starts), pa.array(sizes // width), pa.array(np.full(n, width, np.int32)),
                ], INDEX.names)
                offset += int((sizes + 16).sum())
                record += n
        finally:
            if out is not None:
                out.close()

    return write


def write_records(documents: DataFrame, tokenizer_path: str, end_id: int) -> tuple[str, DataFrame]:
    """Encodes and writes all texts; returns the folder and the stored index."""
    folder = scratch_path(documents.sparkSession, "records")
    width = id_width(tokenizer_path, end_id)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    return folder, stored(ordered.mapInArrow(in_slices(_writer(folder, tokenizer_path, width, end_id)), INDEX), "records-index", LONG_ROWS)


def with_starts(records: DataFrame, held: str = "n_tokens") -> DataFrame:
    """Adds ``start``, the number of ids before each record in file order, summed over
    column ``held``. Only one sum per file meets in a single task."""
    sums = records.groupBy("shard").agg(F.sum(held).alias("held"))
    before = sums.select("shard", (F.sum("held").over(Window.orderBy("shard")) - F.col("held")).alias("before"))
    inside = F.sum(held).over(Window.partitionBy("shard").orderBy("record")) - F.col(held)
    return records.withColumn("inside", inside).join(before, "shard").withColumn("start", F.col("before") + F.col("inside")).drop("before", "inside")


def checked_payloads(raw: bytes, crc32c: Crc32c) -> list[bytes]:
    """Payloads of the records that ``raw`` holds end to end, checksums verified."""
    found, at = [], 0
    heads = []
    while at < len(raw):
        size, head_sum = struct.unpack_from("<QI", raw, at)
        if at + 16 + size > len(raw):
            raise ValueError(f"a record of {size} bytes ends beyond the {len(raw)} bytes read")
        (check,) = struct.unpack_from("<I", raw, at + 12 + size)
        heads.append((size, head_sum, check))
        found.append(raw[at + 12:at + 12 + size])
        at += 16 + size
    sizes = np.array([h[0] for h in heads], "<u8")
    if (masked(crc32c(sizes.view(np.uint8), np.full(len(sizes), 8))) != np.array([h[1] for h in heads], np.uint32)).any():
        raise ValueError("a record's length does not fit its checksum")
    if (masked(crc32c(np.frombuffer(b"".join(found), np.uint8), sizes)) != np.array([h[2] for h in heads], np.uint32)).any():
        raise ValueError("a record's payload does not fit its checksum")
    return found


def _runs(name: list[str], offset: np.ndarray, size: np.ndarray) -> Iterator[tuple[int, int]]:
    """Index ranges of rows whose records lie end to end, READ_BYTES at most or one record."""
    begin, held = 0, 0
    for i in range(len(name)):
        if i > begin and (name[i] != name[i - 1] or offset[i] != offset[i - 1] + size[i - 1] or held + size[i] > READ_BYTES):
            yield begin, i
            begin, held = i, 0
        held += size[i]
    if name:
        yield begin, len(name)


def read_records(folder: str, index: DataFrame, columns: list[str], derive: Callable, fields: list[T.StructField]) -> DataFrame:
    """Reads the records of ``index`` in its order. Rows have the index's
    ``columns`` and what ``derive(ids)`` returns for ``fields``."""
    schema = T.StructType([index.schema[c] for c in columns] + fields)
    kinds = [to_arrow_type(f.dataType) for f in fields]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crc32c, files = Crc32c(), {}
        system, root = opened(folder)
        try:
            for batch in batches:
                name, width = batch.column("file").to_pylist(), batch.column("width").to_numpy()
                offset = batch.column("offset").to_numpy()
                size = batch.column("n_tokens").to_numpy() * width + 16
                rows = []
                for begin, end in _runs(name, offset, size):
                    if name[begin] not in files:
                        for f in files.values():
                            f.close()
                        files = {name[begin]: system.open_input_file(f"{root}/{name[begin]}")}
                    raw = files[name[begin]].read_at(int(offset[end - 1] + size[end - 1] - offset[begin]), int(offset[begin]))
                    rows += [derive(np.frombuffer(p, f"<u{int(width[begin])}")) for p in checked_payloads(raw, crc32c)]
                found = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in columns], *found], schema.names)
        finally:
            for f in files.values():
                f.close()

    needed = list(dict.fromkeys([*columns, "file", "offset", "n_tokens", "width"]))
    return index.select(*needed).mapInArrow(read, schema)


def _digest(ids: np.ndarray) -> tuple[int, int]:
    return len(ids), zlib.crc32(ids.astype("<u4").tobytes())


def record_digests(documents: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """Writes the files, reads them back, and returns per document its place in
    the stream, its number of ids and their CRC-32."""
    folder, index = write_records(documents, tokenizer_path, end_id)
    fields = [T.StructField("read_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType())]
    read = stored(read_records(folder, index, ["doc_id", "shard", "record"], _digest, fields), "records-read")
    return with_starts(read, "read_tokens").select("doc_id", "start", F.col("read_tokens").alias("n_tokens"), "ids_crc32")
