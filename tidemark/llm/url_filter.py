"""URL filter: a blocked Bloom filter in front of an exact hash join.

Rules (host and path prefix, with a verdict) and listed canonical URLs become
text keys. Every key sets eight bits in one block of 512 bits. A URL asks for
its canonical form and for each (host suffix, path prefix) a rule may have;
keys that pass the filter go to a hash join with the true keys, which removes
false positives. Only built-in functions are used.

Defined cases: a null URL or one without ``://`` has an empty host and path,
fits no rule, is in no list and is allowed; repeated rows each get a verdict;
an empty list or table gives "allow" or no rows; other columns of the input
are not read. Of rules as long as each other the one with the longer host wins.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, stored

PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(?:\?([^#]*))?"
#: Parameters that name a visit, not a page.
TRACKING = r"^(utm_[^=]*|ref|gclid|fbclid)(=|$)"
WORDS = 8
BITS_PER_KEY = 16
#: The filter is broadcast, so its size has a bound: 72 bytes for each block.
#: Longer lists only let more false positives through to the exact join.
MAX_BLOCKS = 1 << 18


def url_host(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, PARTS, 1)), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def canonical_url(url: Column) -> Column:
    """Host without ``www.`` or ``m.`` and default port, path without closing
    slashes, remaining parameters in order of their text. Null if there is no host."""
    host = F.regexp_replace(F.regexp_replace(url_host(url), r":(80|443)$", ""), r"^(www|m)\.", "")
    path = F.regexp_replace(url_path(url), "/+$", "")
    query = F.coalesce(F.regexp_extract(url, PARTS, 3), F.lit(""))
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda x: ~x.rlike(TRACKING) & (x != "")))
    return F.when(host != "", F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")))


def _bits(key: str) -> list[Column]:
    return [F.expr(f"shiftleft(1L, CAST(shiftright(xxhash64({key}, 1), {6 * i}) & 63 AS INT))") for i in range(WORDS)]


def _block(key: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def bloom_blocks(keys: DataFrame, blocks: int) -> DataFrame:
    """Filter over column ``key``: one row (block, w0..w7) per block in use."""
    masks = keys.select(_block("key", blocks).alias("block"), *[b.alias(f"w{i}") for i, b in enumerate(_bits("key"))])
    return masks.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def block_count(keys: int, max_blocks: int = MAX_BLOCKS) -> int:
    wanted = max(1, -(-keys * BITS_PER_KEY // (64 * WORDS)))
    return min(max_blocks, 1 << (wanted - 1).bit_length())


def possible_hits(candidates: DataFrame, bloom: DataFrame, blocks: int) -> DataFrame:
    """Rows of ``candidates`` whose ``key`` may be in the filter."""
    asked = candidates.withColumn("block", _block("key", blocks))
    for i, bit in enumerate(_bits("key")):
        asked = asked.withColumn(f"m{i}", bit)
    full = reduce(lambda a, b: a & b, [F.col(f"w{i}").bitwiseAND(F.col(f"m{i}")) == F.col(f"m{i}") for i in range(WORDS)])
    return asked.join(F.broadcast(bloom), "block").where(full).select(*candidates.columns)


def judged_urls(
    pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str, str]],
    row_id: str = "page_id", url: str = "url", max_blocks: int = MAX_BLOCKS,
) -> DataFrame:
    """Each row's id, host, path, rule and verdict.

    ``rules`` are (host, path prefix, verdict); the longest that fits decides.
    Without one, URLs whose canonical form is in ``listed`` (column
    ``canonical``) are blocked and all others allowed.
    """
    spark = pages.sparkSession
    ruled = spark.createDataFrame(
        [("r" + host + path, host + path, verdict, len(host)) for host, path, verdict in rules],
        "key string, rule string, verdict string, host_chars int",
    )
    urls = listed.where(F.col("canonical").isNotNull()).select(F.concat(F.lit("u"), "canonical").alias("key")).distinct()
    keys = stored(
        ruled.unionByName(urls.select("key", F.lit(None).cast("string").alias("rule"), F.lit("block").alias("verdict"), F.lit(0).alias("host_chars"))),
        "url-keys",
    )
    blocks = block_count(keys.count(), max_blocks)
    bloom = bloom_blocks(keys, blocks)

    rows = pages.select(F.col(row_id).alias("page_id"), F.col(url).alias("url"))
    labels = F.split(url_host(F.col("url")), r"\.")
    asked = [F.concat(F.lit("u"), canonical_url(F.col("url")))]
    for n, chars in sorted({(len(host.split(".")), len(path)) for host, path, _ in rules}):
        fits = (F.size(labels) >= n) & (F.length(url_path(F.col("url"))) >= chars)
        suffix = F.array_join(F.slice(labels, -n, n), ".")
        asked.append(F.when(fits, F.concat(F.lit("r"), suffix, F.substring(url_path(F.col("url")), 1, chars))))
    candidates = rows.select("page_id", "url", F.explode(F.array(*asked)).alias("key")).where(F.col("key").isNotNull())
    found = possible_hits(candidates, bloom, blocks).join(keys, "key")
    best = found.groupBy("page_id", "url").agg(
        F.max(F.when(F.col("rule").isNotNull(), F.struct(F.length("rule").alias("chars"), "host_chars", "rule", "verdict"))).alias("best"),
        F.max(F.col("rule").isNull()).alias("listed"),
    ).select(F.col("page_id").alias("found_id"), F.col("url").alias("found_url"), "best", "listed")
    same = rows["page_id"].eqNullSafe(best["found_id"]) & rows["url"].eqNullSafe(best["found_url"])
    return rows.join(best, same, "left").select(
        rows["page_id"].alias(row_id), url_host(rows["url"]).alias("host"), url_path(rows["url"]).alias("path"),
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.when(F.col("listed"), "block"), F.lit("allow")).alias("verdict"),
    )
