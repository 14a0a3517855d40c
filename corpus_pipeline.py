"""From raw documents to a training stream: five stages over whole tables.

Each stage gets what the one before kept, as a Parquet table with the columns of
``documents``; the last returns the stream's index instead. Toxic documents go,
one document of each group of near-duplicates stays, documents with benchmark
questions go, sources are mixed to their targets (documents are dropped or
repeated), and what is left is written as binary token records.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.llm import decontaminate, jaccard, mixing, token_records, toxicity
from tidemark.llm.common import stored, table
from tidemark.llm.queries import tokenizer_file


def toxicity_filter(spark, docs, sf_dir):
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark, docs, sf_dir):
    return jaccard.one_of_each_group(docs, size=5, percent=80)


def decontamination(spark, docs, sf_dir):
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixing_to_weights(spark, docs, sf_dir):
    return mixing.mixed_documents(docs, F.array("source"), "mix")


def token_stream(spark, docs, sf_dir):
    return token_records.record_digests(docs, tokenizer_file("word_bpe_49k.json"), end_id=1)


STAGES = [
    ("toxicity", toxicity_filter),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("mixing_to_target_weights", mixing_to_weights),
    ("token_binary_output", token_stream),
]
#: The stages hold a trained network and a tokenizer, which SQL cannot express.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages in turn over ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
