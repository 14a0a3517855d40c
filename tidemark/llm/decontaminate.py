"""Benchmark decontamination by template canonicalisation.

Texts become template tokens: numbers, names and units turn into typed
placeholders, all else is lower-cased without outer punctuation. A number is a
run of digits with its marks, or a number word; what reads as one number
('twenty five', 'twenty-five', 'one hundred and five', '5 million', '1 000') is one, filled by its value; a unit is a unit word right
after a number; a name is a capitalised word (not one in capitals throughout) inside a
sentence, and neighbouring names are one. Windows of eight template tokens are joined by hash with those of
the benchmark, so a question asked anew with other numbers or names still meets
its original. Along each alignment of a document with an item, placeholders must
be filled consistently: one filler of the item always by the same filler of the
document and the other way round. Alignments of a document with an item whose
shifts differ by eight at most are taken together, the fullest first and as long
as their slots agree: words put in or left out do not part a copy. An item window
then counts if all its tokens lie in met windows.

Beside them, windows of eight literal words (all lower-cased without outer
punctuation, nothing replaced) are joined the same way, so that a word-for-word
copy is met whatever its slots, its case or the line in front of it.

A document is contaminated by an item if an alignment is consistent and holds
at least half of the item's windows, or six in all (thirteen tokens in a row).
Template and literal windows are counted apart; a literal count is given only
where no alignment of templates suffices.

Tasks first ask a filter of fixed size for the benchmark's windows, so nearly
nothing of a clean document is shuffled.

Defined cases: null and empty texts hold nothing; an item of fewer than eight
tokens is one window of its own length; template items of fewer than four tokens,
template windows with fewer literal tokens than placeholders, and literal items
of one or two words are no evidence; null and
repeated ids are kept apart by their text; repeated rows give one result row;
empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import in_slices, stored
from tidemark.llm.shingles import U, mixed, window_hashes

WINDOW = 8
LEAST_ITEM = 4
LEAST_WORDS = 3
SURE_WINDOWS = 6
#: Alignments that belong together differ by so much in shift at most.
SHIFTS = 8
FILTER_BITS = 23
CACHED_WORDS = 200_000

#: Number words, and unit words that count after a number.
NUMBER_WORDS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen"
    " eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion"
).split()
UNIT_WORDS = (
    "mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g gram grams kg kilogram kilograms oz ounce ounces"
    " lb lbs pound pounds ton tons tonne tonnes ml l liter liters litre litres gallon gallons cup cups s sec second seconds min"
    " minute minutes h hr hour hours day days week weeks month months year years mph kmh kph percent % cent cents dollar dollars"
    " euro euros usd eur celsius fahrenheit degree degrees hz khz mhz ghz w kw kwh v volt volts watt watts j joule joules kb mb gb tb"
).split()

_EDGE = "\"'`()[]{}<>.,;:!?…«»“”‘’*_#~|/\\"
#: Marks that may close a word of the plain kind.
_CLOSING = ",;.!?:"
_NUMBER = re.compile(r"[+\-$€£]?\d[\d.,:/]*(?:%|st|nd|rd|th)?\Z")
_VALUE = re.compile(r"([+\-$€£]?)(\d{1,3}(?:,\d{3})+|\d+)(\.\d+)?(%|st|nd|rd|th)?\Z")
_DIGIT = re.compile(r"\d")
_GLUED = re.compile(r"(\d)(" + "|".join(sorted((u for u in UNIT_WORDS if u.isalpha()), key=len, reverse=True)) + r")\b")
NUMBER, UNIT, NAME = (U(x) for x in (0x6E756D, 0x756E6974, 0x6E616D65))
#: Keeps the hashes of literal windows apart from those of templates.
LITERAL = U(0x6C69746572616C)
#: Flags of a word, in the lowest bits of its hash.
IS_NUMBER, MAY_BE_UNIT, CAPITAL, ENDS, FLAGS = 1, 2, 4, 8, 15


def _spoken() -> dict[str, int]:
    small = NUMBER_WORDS[:20]
    return {
        **{w: n for n, w in enumerate(small)}, **{w: 10 * n for n, w in enumerate(NUMBER_WORDS[20:28], 2)},
        "hundred": 100, "thousand": 1000, "million": 10**6, "billion": 10**9,
    }


def _is_number(low: str) -> bool:
    return bool(_NUMBER.match(low)) or low in _numbers or ("-" in low and all(w in _numbers for w in low.split("-")))


def _follows(a: int | Decimal, b: int) -> bool:
    """Do two neighbouring parts of a spoken number read as one number?"""
    if b >= 100:
        return True
    return a >= 100 or (20 <= a < 100 and a % 10 == 0 and 0 < b < 10) or (10 <= a < 100 and b >= 10)


def _value(parts: list) -> Decimal:
    total = now = Decimal(0)
    for p in parts:
        if p == 100:
            now = (now or 1) * 100
        elif p >= 1000 and isinstance(p, int):
            total, now = total + (now or 1) * p, Decimal(0)
        elif 10 <= now < 100 and p >= 10:  # years: nineteen eighty
            now = now * 100 + p
        else:
            now += p
    return total + now


class Numbers(dict):
    """Number word to (marks in front, parts or None, marks behind, digits or None)."""

    def __missing__(self, word: str) -> tuple:
        if len(self) >= CACHED_WORDS:
            self.clear()
        low = word.strip(_EDGE).lower()
        found = _VALUE.match(low)
        if found:
            front, digits, rest, behind = found.groups()
            parts = [Decimal(digits.replace(",", "") + (rest or ""))]
            value = front, parts, behind or "", digits if "," not in digits and not rest else None
        elif _DIGIT.search(low):
            value = low, None, "", None
        else:
            value = "", [_spoken_values[w] for w in low.split("-")], "", None
        self[word] = value
        return value


def _merged_numbers(words: list[str], at: list[int]) -> Iterator[tuple[int, int, int]]:
    """First word, last word and hash of the value of each number; ``at`` are the number words."""
    import xxhash

    known, n, i = set(at), len(words), 0
    while i < len(at):
        first = last = at[i]
        front, parts, behind, digits = _number_words[words[first]]
        parts = parts and list(parts)
        while parts and last + 1 < n and not behind and words[last][-1].isalnum():
            spoken = parts[-1] if len(parts) > 1 or digits is None else None
            to = last + 1
            if to not in known and words[to] == "and" and isinstance(spoken, int) and spoken >= 100 and to + 1 in known:
                ahead = _number_words[words[to + 1]]
                large = to + 2 in known and isinstance(part := (_number_words[words[to + 2]][1] or [None])[0], int) and part >= 100
                if ahead[0] or ahead[3] is not None or not ahead[1] or max(ahead[1]) >= 100 or large:
                    break
                to += 1
            if to not in known or not words[to][0].isalnum():
                break
            more_front, more, more_behind, more_digits = _number_words[words[to]]
            if more_front or not more:
                break
            if digits is not None and len(digits) <= 3 * (1 + (last - first)) and re.match(r"\d{3}(?!\d)", words[to]) and len(parts) == 1 and isinstance(more[0], Decimal):
                digits += words[to][:3]
                tail = more[0] % 1
                parts, behind = [Decimal(digits) + tail], more_behind
                digits = None if tail or more_digits is None else digits
            elif isinstance(more[0], int) and _follows(parts[-1], more[0]) and (isinstance(parts[-1], int) or more[0] >= 100):
                parts, behind, digits = parts + more, more_behind, None
            else:
                break
            last = to
        text = front + (format(_value(parts).normalize(), "f") if parts else "") + behind
        yield first, last, xxhash.xxh3_64_intdigest(text) & ~FLAGS
        while i < len(at) and at[i] <= last:
            i += 1


class Words(dict):
    """Word to the hash of its plain form (0 if nothing is left) with its flags."""

    def __missing__(self, word: str) -> int:
        import xxhash

        if len(self) >= CACHED_WORDS:
            self.clear()
        core = word[:-1] if word[-1] in _CLOSING else word
        if core.isalpha() and (core.islower() or core.istitle()):  # most words: letters, at most one mark behind them
            low = core.lower()
            flags = _special.get(low, 0) | CAPITAL * core[0].isupper() | ENDS * (word[-1] in ".!?:")
            value = self[word] = flags | (xxhash.xxh3_64_intdigest(low) & ~FLAGS)
            return value
        plain = word.strip(_EDGE)
        low = plain.lower()
        flags = IS_NUMBER * _is_number(low) | MAY_BE_UNIT * (low in _units)
        flags |= CAPITAL * (plain[:1].isupper() and not plain[1:].isupper()) | ENDS * (word.rstrip("\"'”’)»")[-1:] in (".", "!", "?", ":"))
        value = self[word] = flags | (xxhash.xxh3_64_intdigest(low) & ~FLAGS if low else 0)
        return value


_numbers, _units = frozenset(NUMBER_WORDS), frozenset(UNIT_WORDS)
_special = {**{w: IS_NUMBER for w in NUMBER_WORDS}, **{w: MAY_BE_UNIT for w in UNIT_WORDS}}
_spoken_values = _spoken()
_words, _number_words = Words(), Numbers()


def template(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Template tokens of a text and, for placeholders, what fills them (0 elsewhere)."""
    return _read(text)[:2]


def _read(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Template tokens, their fillers and the literal words of a text."""
    words = (_GLUED.sub(r"\1 \2", text) if _DIGIT.search(text) else text).split()
    if not words:
        return np.zeros(0, U), np.zeros(0, U), np.zeros(0, U)
    packed = np.fromiter(map(_words.__getitem__, words), U, len(words))
    plain, flags = packed & ~U(FLAGS), (packed & U(FLAGS)).astype(np.uint8)
    opens = np.ones(len(flags), bool)
    opens[1:] = (flags[:-1] & ENDS) > 0
    number = (flags & IS_NUMBER) > 0
    after = np.zeros(len(flags), bool)
    after[1:] = number[:-1]
    unit = ((flags & MAY_BE_UNIT) > 0) & after & ~number
    name = ((flags & CAPITAL) > 0) & ~opens & ~number & ~unit
    tokens = plain.copy()
    tokens[number], tokens[unit], tokens[name] = NUMBER, UNIT, NAME
    fill = np.where(number | unit | name, plain, U(0))
    within = np.zeros(len(flags), bool)
    if number.any():
        for first, last, value in _merged_numbers(words, np.flatnonzero(number).tolist()):
            fill[first] = value
            within[first + 1:last + 1] = True
    follows = np.zeros(len(flags), bool)
    follows[1:] = name[1:] & name[:-1]
    keep = ~follows & ~within & (plain != 0)
    return tokens[keep], fill[keep], plain[plain != 0]


def windows(tokens: np.ndarray, fill: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the windows that count as evidence."""
    hashes = window_hashes(tokens, size)
    if not len(hashes):
        return np.zeros(0, np.int64), hashes
    slots = np.concatenate([[0], np.cumsum(fill != 0)])
    at = np.flatnonzero(2 * (slots[size:] - slots[:-size]) <= size)
    return at, hashes[at]


def literal_windows(words: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of all windows of literal words."""
    hashes = window_hashes(words, size) ^ LITERAL
    return np.arange(len(hashes)), hashes


def _bit(hashes: np.ndarray) -> np.ndarray:
    return (mixed(hashes) >> U(64 - FILTER_BITS)).astype(np.int64)


def _slots(fill: np.ndarray, at: np.ndarray, size: int) -> list[list[int]]:
    signed = fill.view(np.int64)
    return [signed[a:a + size].tolist() if fill[a:a + size].any() else [] for a in at.tolist()]


_WINDOW_SCHEMA = "position int, size int, hash long, slots array<long>"


def _arrays(found: list[tuple[int, int, int, list[int]]]) -> list[pa.Array]:
    return [
        pa.array([f[0] for f in found], pa.int32()), pa.array([f[1] for f in found], pa.int32()),
        pa.array([f[2] for f in found], pa.int64()), pa.array([f[3] for f in found], pa.list_(pa.int64())),
    ]


def item_windows(benchmark: DataFrame) -> DataFrame:
    """Stored rows (item_id, literal, held, rank, position, size, hash, slots) of all items;
    ``rank`` counts the windows of an item that are evidence."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, literal, held, rank, found = [], [], [], [], []
            for item, text in zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist()):
                tokens, fill, words = _read(text or "")
                for plain, length, least in ((False, len(tokens), LEAST_ITEM), (True, len(words), LEAST_WORDS)):
                    size = min(WINDOW, length)
                    if size < least:
                        continue
                    at, hashes = literal_windows(words, size) if plain else windows(tokens, fill, size)
                    ids += [item] * len(at)
                    literal += [plain] * len(at)
                    held += [len(at)] * len(at)
                    rank += range(len(at))
                    found += zip(at.tolist(), [size] * len(at), hashes.view(np.int64).tolist(), [[]] * len(at) if plain else _slots(fill, at, size))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(literal, pa.bool_()), pa.array(held, pa.int32()), pa.array(rank, pa.int32()), *_arrays(found)],
                ["item_id", "literal", "held", "rank", "position", "size", "hash", "slots"],
            )

    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    return stored(items.mapInArrow(run, f"item_id long, literal boolean, held int, rank int, {_WINDOW_SCHEMA}"), "item-windows")


def _filter(items: DataFrame) -> bytes:
    """Bits of all item windows: 1 MB at any size of the benchmark."""
    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(1 << FILTER_BITS, bool)
        for batch in batches:
            out[_bit(batch.column("hash").to_numpy(zero_copy_only=False).astype(np.int64).view(U))] = True
        yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(np.packbits(out).tobytes(), 1)], pa.binary())], ["bits"])

    def united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
        for batch in batches:
            for found in batch.column("bits").to_pylist():
                out |= np.frombuffer(zlib.decompress(found), np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], ["bits"])

    parts = items.select("hash").mapInArrow(bits, "bits binary")
    return parts.repartition(1).mapInArrow(united, "bits binary").first()["bits"]


def _document_windows(sizes: list[tuple[bool, int]], bits) -> callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.unpackbits(np.frombuffer(bits.value, np.uint8)).astype(bool)
        for batch in batches:
            rows, found = [], []
            for row, text in enumerate(batch.column("text").to_pylist()):
                tokens, fill, words = _read(text or "")
                for plain, size in sizes:
                    at, hashes = literal_windows(words, size) if plain else windows(tokens, fill, size)
                    hit = known[_bit(hashes)]
                    at, hashes = at[hit], hashes[hit]
                    if len(at):
                        rows += [row] * len(at)
                        found += zip(at.tolist(), [size] * len(at), hashes.view(np.int64).tolist(), [[]] * len(at) if plain else _slots(fill, at, size))
            taken = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(taken), batch.column("text_key").take(taken), *_arrays(found)],
                ["doc_id", "text_key", "position", "size", "hash", "slots"],
            )

    return run


def _consistent(pairs: Column) -> Column:
    """Is each filler of the item always met by one filler of the document, and the other way round?"""
    one = lambda side: F.size(F.array_distinct(F.transform(pairs, lambda p: p[side]))) == F.size(pairs)
    return one("i") & one("d")


def _covered(met: Column, size: Column) -> Column:
    """Number of item windows that lie wholly in the met ones (sorted by position)."""
    def step(so_far: Column, w: Column) -> Column:
        joined = w["item_position"] - so_far["at"] <= size
        more = F.when(joined, w["rank"] - so_far["rank"]).otherwise(F.lit(1))
        return F.struct((so_far["n"] + more).cast("long").alias("n"), w["item_position"].alias("at"), w["rank"].alias("rank"))

    first = F.struct(F.lit(1).cast("long").alias("n"), met[0]["item_position"].alias("at"), met[0]["rank"].alias("rank"))
    return F.aggregate(met, first, step, lambda x: x["n"])


def contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows (doc_id, text_key, item_id, n_windows, item_windows, refilled), one per
    document and item. ``text_key`` is the text's xxhash64; ``refilled`` tells that
    a placeholder holds something else than in the item."""
    spark = documents.sparkSession
    items = item_windows(benchmark)
    sizes = sorted((r["literal"], r["size"]) for r in items.select("literal", "size").distinct().collect())  # 2 WINDOW values at most
    bits = spark.sparkContext.broadcast(_filter(items))
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"), "text")
    met = docs.mapInArrow(in_slices(_document_windows(sizes, bits)), f"doc_id long, text_key long, {_WINDOW_SCHEMA}")
    theirs = items.select("hash", "size", "item_id", "literal", "held", "rank", F.col("position").alias("item_position"), F.col("slots").alias("item_slots"))
    pairs = F.filter(F.arrays_zip(F.col("item_slots").alias("i"), F.col("slots").alias("d")), lambda p: (p["i"] != 0) | (p["d"] != 0))
    joined = met.join(theirs, ["hash", "size"]).select(
        "doc_id", "text_key", "item_id", "literal", "held", "size", F.struct("item_position", "rank").alias("window"),
        (F.col("position") - F.col("item_position")).alias("shift"), pairs.alias("pairs"),
    )
    aligned = joined.groupBy("doc_id", "text_key", "item_id", "literal", "shift").agg(
        F.max("held").alias("held"), F.max("size").alias("size"), F.collect_set("window").alias("met"), F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs"),
    ).where(_consistent(F.col("pairs")))
    # Each alignment with those at most SHIFTS beside it: 2 SHIFTS + 1 rows at any length of the text.
    near = Window.partitionBy("doc_id", "text_key", "item_id", "literal").orderBy("shift").rangeBetween(-SHIFTS, SHIFTS)
    beside = F.collect_list(F.struct((-F.size("met")).alias("less"), "shift", "met", "pairs")).over(near)
    others = F.filter(F.array_sort(beside), lambda x: x["shift"] != F.col("shift"))
    start = F.struct("met", "pairs")

    def joined_to(so_far: Column, x: Column) -> Column:
        both = F.array_union(so_far["pairs"], x["pairs"])
        return F.when(_consistent(both), F.struct(F.array_union(so_far["met"], x["met"]).alias("met"), both.alias("pairs"))).otherwise(so_far)

    aligned = aligned.withColumn("beside", others).withColumn("whole", F.aggregate("beside", start, joined_to)).select(
        "doc_id", "text_key", "item_id", "literal", "held", F.col("whole.pairs").alias("pairs"), _covered(F.array_sort("whole.met"), F.col("size")).alias("n_windows"),
    )
    enough = F.col("n_windows") >= F.least(F.lit(SURE_WINDOWS), F.ceil(F.col("held") / 2))
    best = aligned.where(enough).groupBy("doc_id", "text_key", "item_id").agg(
        F.max(F.struct(~F.col("literal"), "n_windows", "held")).alias("best"),
        F.min(F.when(~F.col("literal"), F.exists("pairs", lambda p: p["i"] != p["d"]))).alias("refilled"),
    )
    return best.select(
        "doc_id", "text_key", "item_id", "best.n_windows", F.col("best.held").cast("long").alias("item_windows"),
        F.coalesce("refilled", F.lit(False)).alias("refilled"),
    )


def clean_documents(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents without contamination, all columns as they came."""
    bad = stored(contaminated(documents, benchmark).select("doc_id", "text_key").distinct(), "contaminated")
    same = documents["doc_id"].cast("long").eqNullSafe(bad["doc_id"]) & (F.xxhash64(F.coalesce(documents["text"], F.lit(""))) == bad["text_key"])
    return documents.join(bad, same, "left_anti")
