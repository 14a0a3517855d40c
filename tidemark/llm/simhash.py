"""SimHash fingerprints and an exact search within a Hamming radius.

A text's terms are its runs of five words (its whole word sequence if it has
fewer), A-Z in lower case. Each occurrence of a term casts 64 signed votes, one
per bit of the term's hash; a term's weight is how often it occurs. The sum's
sign is the fingerprint's bit. Votes of two bits share one long (32 bits each),
so 32 plain sums over the exploded terms hold them all.

Defined cases: null and blank texts have no terms and the fingerprint 0; a tied
vote gives 0; null ids come before all others; rows with one id sort by text,
and identical rows stay apart; empty tables give no rows; other columns are not
read. Only built-in functions are used.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, stored

SHINGLE = 5
BITS = 64
FIRST_KEY = -(1 << 63)
MAX_CUTS = 512


def word_hashes(text: Column) -> Column:
    words = F.filter(F.split(ascii_lower(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def shingle_hashes(words: str, size: int = SHINGLE) -> Column:
    """Hashes of runs of ``size`` in the array column named ``words``. It has to
    be a column of its own: an expression would be computed anew per run."""
    parts = ", ".join(f"{words}[i + {k}]" for k in range(size))
    return F.expr(
        f"CASE WHEN size({words}) >= {size} THEN transform(sequence(0, size({words}) - {size}), i -> xxhash64({parts}))"
        f" WHEN size({words}) > 0 THEN array(xxhash64({words})) ELSE array() END"
    )


def _votes(term: str) -> list[Column]:
    return [F.sum(F.expr(f"shiftrightunsigned({term}, {j}) & 4294967297L")).alias(f"v{j}") for j in range(BITS // 2)]


def _sign_bits() -> Column:
    """The fingerprint from v0..v31 and the number of terms."""
    out = F.lit(0).cast("long")
    for j in range(BITS // 2):
        for shift, votes in ((j, f"v{j} & 4294967295L"), (j + BITS // 2, f"shiftrightunsigned(v{j}, 32)")):
            out = out.bitwiseOR(F.expr(f"CASE WHEN 2 * ({votes}) > terms THEN shiftleft(1L, {shift}) ELSE 0L END"))
    return out


def fingerprints(rows: DataFrame, keys: list[str], arrays: str) -> DataFrame:
    """One row per ``keys`` with the fingerprint of the hashes in column
    ``arrays``. If rows come partitioned by some of the keys, nothing moves."""
    terms = rows.select(*keys, F.explode_outer(arrays).alias("term"))
    summed = terms.groupBy(*keys).agg(F.count("term").alias("terms"), *_votes("term"))
    return summed.select(*keys, _sign_bits().alias("fingerprint"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def as_hex(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def cut_points(documents: DataFrame) -> list[int]:
    """Ids that cut the table into ranges of about equal size; at most MAX_CUTS."""
    parts = min(MAX_CUTS, 3 * int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    key = F.coalesce("doc_id", F.lit(FIRST_KEY))
    found = documents.agg(F.min(key), F.percentile_approx(key, [i / parts for i in range(1, parts)] or [0.5], 10_000)).first()
    return [] if found[0] is None else sorted({found[0], *found[1]})


def with_next(documents: DataFrame) -> DataFrame:
    """Rows (part, place, doc_id, text, next_text, ghost) in order of doc_id; the
    text after the last row is that of the first.

    A range's last row needs the first of the following range. Rows that begin
    a range therefore also stand, as ghosts, behind the range before it, so one
    shuffle of the texts is enough and no range waits for another.
    """
    cuts = cut_points(documents)
    keyed = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("doc_id", F.lit(FIRST_KEY)).alias("key"))
    listed = F.array(*[F.lit(c).cast("long") for c in cuts])
    at = F.size(F.filter(listed, lambda c: c <= F.col("key"))) - 1
    before = F.pmod(F.col("at") - 1, F.lit(max(1, len(cuts))))
    homes = F.array(F.struct(F.col("at").alias("part"), F.lit(False).alias("ghost")), F.struct(before.cast("int").alias("part"), F.lit(True).alias("ghost")))
    placed = keyed.withColumn("at", at).withColumn(
        "home", F.explode(F.filter(homes, lambda h: ~h["ghost"] | F.array_contains(listed, F.col("key")))),
    ).select("home.part", "home.ghost", "key", "doc_id", "text")
    order = Window.partitionBy("part").orderBy("ghost", "key", "text")
    return placed.select("part", F.row_number().over(order).alias("place"), "doc_id", "text", F.lead("text").over(order).alias("next_text"), "ghost")


def edit_likeness(documents: DataFrame) -> DataFrame:
    """Fingerprints of each text (also as a number, ``print``) and of its edited form (its
    last quarter replaced by the beginning of the next text), and their likeness."""
    n = F.length("text")
    quarter = F.floor(n / 4).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), n - quarter), F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), quarter),
    )
    rows = with_next(documents).select("part", "place", "doc_id", n.cast("long").alias("n_chars"), "ghost", "text", edited.alias("edited"))
    rows = rows.select(
        "part", "place", "doc_id", "n_chars", "ghost", F.sha2("edited", 256).alias("edited_sha256"),
        word_hashes(F.col("text")).alias("own_words"), word_hashes(F.col("edited")).alias("edited_words"),
    )
    keys = ["part", "place", "doc_id", "n_chars", "ghost", "edited_sha256"]
    terms = rows.select(*keys, shingle_hashes("own_words").alias("own"), shingle_hashes("edited_words").alias("other"))
    both = terms.select(*keys, F.posexplode(F.array("own", "other")).alias("form", "terms")).where(~F.col("ghost") | (F.col("form") == 0))
    prints = fingerprints(both, [*keys, "form"], "terms")
    order = Window.partitionBy("part").orderBy("place", "form")
    lined = prints.select(
        *keys, "form", "fingerprint", F.lead("fingerprint", 1).over(order).alias("edited_print"), F.lead("fingerprint", 2).over(order).alias("next_print"),
    ).where(~F.col("ghost") & (F.col("form") == 0))
    return lined.select(
        "doc_id", "n_chars", "edited_sha256", F.col("fingerprint").alias("print"), as_hex(F.col("fingerprint")).alias("fingerprint"), as_hex(F.col("edited_print")).alias("edited_fingerprint"),
        likeness(F.col("fingerprint"), F.col("edited_print")).alias("near_edited"), likeness(F.col("fingerprint"), F.col("next_print")).alias("near_next"),
    )


def block_masks(radius: int, kept: int = 2) -> Iterator[int]:
    """Masks of the permuted tables. 64 bits fall into ``radius + kept`` blocks;
    two fingerprints at most ``radius`` bits apart agree on ``kept`` of them."""
    blocks = radius + kept
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    for chosen in combinations(range(blocks), kept):
        mask = sum((1 << edges[b + 1]) - (1 << edges[b]) for b in chosen)
        yield mask - (1 << 64) if mask >> 63 else mask


def within_radius(queries: DataFrame, prints: DataFrame, radius: int = 3) -> DataFrame:
    """Pairs (asked, found, distance) of distinct fingerprints within ``radius``.

    Both inputs have a long column ``fingerprint``; equal ones are collapsed
    first, so copies cost nothing. Every table is keyed by the bits its mask
    keeps, and the full distance is checked before a pair counts.
    """
    def tables(df: DataFrame, name: str) -> DataFrame:
        masks = F.array(*[F.struct(F.lit(i).alias("table"), F.lit(m).cast("long").alias("mask")) for i, m in enumerate(block_masks(radius))])
        distinct = df.where(F.col("fingerprint").isNotNull()).select(F.col("fingerprint").alias(name)).distinct()
        return stored(
            distinct.select(name, F.explode(masks).alias("m")).select("m.table", F.col(name).bitwiseAND(F.col("m.mask")).alias("bits"), name), "simhash-tables",
        )

    pairs = tables(queries, "asked").join(tables(prints, "found"), ["table", "bits"])
    distance = F.bit_count(F.col("asked").bitwiseXOR(F.col("found")))
    return pairs.where(distance <= radius).select("asked", "found", distance.alias("distance")).distinct()


def edit_neighbours(documents: DataFrame, asked: Column, radius: int = 3) -> DataFrame:
    """:func:`edit_likeness` with ``near_prints``: for rows that are ``asked`` for, how many
    other fingerprints of the table lie within ``radius``; null for all others. Equal
    fingerprints are one, so a group of copies is looked up once."""
    rows = stored(edit_likeness(documents), "fingerprints")
    prints = rows.select(F.col("print").alias("fingerprint"))
    pairs = within_radius(rows.where(asked).select(F.col("print").alias("fingerprint")), prints, radius)
    near = pairs.groupBy("asked").agg(F.count_if(F.col("distance") > 0).alias("found"))
    known = rows.join(near, rows["print"] == near["asked"], "left")
    return known.withColumn("near_prints", F.when(asked, F.coalesce("found", F.lit(0)))).drop("print", "asked", "found")
