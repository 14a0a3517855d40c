"""One registered query per operator, over the whole tables it is meant for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import chat, collocations, decontaminate, jaccard, mixing, negatives, packing, simhash, suffix_dedup, token_counts, token_records, toxicity, url_filter
from tidemark.llm.common import stored, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

#: Host, path prefix and verdict of the rules of op3.
URL_RULES = (
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"), ("com", "/de/", "block"),
)


def query(function):
    QUERIES[function.__name__] = function
    return function


def tokenizer_file(name: str) -> str:
    """Where the public tokenizers' files lie on this cluster."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


@query
def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules first; beyond them, pages are blocked whose canonical URL is that
    of a page with an id divisible by 20, which stands in for a delivered list."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    listed = pages.where("page_id % 20 = 0").select(url_filter.canonical_url(F.col("url")).alias("canonical"))
    return url_filter.judged_urls(pages, listed, URL_RULES)


@query
def op4_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_records.record_digests(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), end_id=1)


@query
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = stored(mixing.keyed(docs, F.array("source"), "mix", keep=["source"]), "sized")
    plan = mixing.plan_mix(rows)
    targets = F.broadcast(mixing.targets_table(spark, plan))
    return mixing.with_copies(rows, plan).join(targets, F.col("mix_row.source").eqNullSafe(F.col("mix_source"))).select(
        F.col("mix_id").alias("doc_id"), F.col("mix_size").alias("size"), "source_size", "target",
        (F.col("mix_copies") * F.col("mix_size")).alias("taken"), "mix_row.source",
    )


@query
def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.without_repeats(table(spark, sf_dir, "documents"), length=200)


@query
def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string",
    )
    return chat.digests(chat.formatted(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)))


@query
def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the number of other fingerprints within three bits for ids divisible by 20."""
    return simhash.edit_neighbours(table(spark, sf_dir, "documents"), F.col("doc_id") % 20 == 0)


@query
def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"), size=3, percent=90)


@query
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and benchmark item found in it; clean documents have none."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_key")


@query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), least=30, first=2000)


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of ids divisible by 7 are moved on by one; anchors are the ids divisible by 50."""
    vectors = table(spark, sf_dir, "embeddings").where(negatives.usable(F.col("label"), F.col("embedding")))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("id"), label.cast("long").alias("label"), negatives.scaled(F.col("embedding")).alias("values"))
    return negatives.hard_negatives(rows, F.col("id") % 50 == 0)


@query
def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), tokenizer_file("byte_bpe_50k.tiktoken"), capacity=2048, end_id=0)
