"""Replay of dead letters into the event store.

    python -m tidemark.plans.replay --letters ... --root ... --ledger ... [--live]
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.quarantine import dlq_decode, dlq_replay_counts, needs_refetch, not_yet_replayed
from tidemark.session import scratch_path, spark_session
from tidemark.sinks.files import write_events, write_parquet

LETTER = T.StructType([T.StructField("message_id", T.StringType()), T.StructField("body", T.StringType())])
LEDGER = T.StructType([T.StructField("message_id", T.StringType())])
INTENT = T.StructType([*LEDGER.fields, T.StructField("batch", T.LongType())])


def _rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The stored table, or no rows where there is none yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    exists = folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
    return spark.read.schema(schema).parquet(path) if exists else spark.createDataFrame([], schema)


def pending(spark: SparkSession, letters_path: str, ledger_path: str) -> DataFrame:
    return not_yet_replayed(spark.read.schema(LETTER).json(letters_path), _rows(spark, ledger_path, LEDGER))


def run(
    spark: SparkSession, letters_path: str, root: str, ledger_path: str, live: bool = False
) -> DataFrame:
    """Counts of the replay. Nothing is written unless ``live``.

    Before anything else the letters of this replay are noted with a batch
    number no earlier replay has had. Their events go to folders of that batch,
    the letters into the ledger afterwards. After a failure the noted letters
    come back with their old number and replace what was written of them; other
    replays are never touched.
    """
    letters = pending(spark, letters_path, ledger_path)
    if not live:
        return dlq_replay_counts(letters, dry_run=True)
    table = scratch_path(spark, "letters")
    write_parquet(letters, table)
    letters = spark.read.schema(LETTER).parquet(table)
    intents_path = f"{ledger_path.rstrip('/')}-batches"
    noted = _rows(spark, intents_path, INTENT)
    number = (noted.agg(F.max("batch")).first()[0] or 0) + 1
    letters.select("message_id").distinct().join(noted, "message_id", "left_anti").withColumn("batch", F.lit(number).cast("long")) \
        .write.mode("append").parquet(intents_path)
    batches = _rows(spark, intents_path, INTENT).groupBy("message_id").agg(F.min("batch").alias("batch"))
    decoded = dlq_decode(letters)
    events = decoded.join(batches, "message_id")
    write_events(events, f"{root.rstrip('/')}/events", batch_id=-F.col("batch"))
    decoded.select("message_id").distinct().write.mode("append").parquet(ledger_path)
    return dlq_replay_counts(letters, dry_run=False)


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--letters", required=True)
    parser.add_argument("--root", required=True)
    parser.add_argument("--ledger", required=True)
    parser.add_argument("--live", action="store_true")
    parser.add_argument("--list", type=int, metavar="N", help="show up to N events of pending letters")
    args = parser.parse_args()
    spark = spark_session("replay")
    if args.list:
        letters = pending(spark, args.letters, args.ledger)
        dlq_decode(letters).select("session_id", "event_type", "is_late_arrival", "event_time").show(args.list, False)
        needs_refetch(letters).show(args.list, False)
        return
    run(spark, args.letters, args.root, args.ledger, args.live).show()


if __name__ == "__main__":
    main()
