"""Keyed state on plain files: append per batch, last write wins on read.

Changes lie in one folder per micro-batch. Compaction folds them into a base of one
row per key, dealt into buckets by the key's hash, and commits base and number of the
last folded batch with one manifest; buckets without changes stay as they are. A
reader opens the base and the batches behind it: before and after a commit both make up the same
state, and a batch that is run again after it was folded changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.money import as_double, price_if
from tidemark.schemas import TRIGGER_INTERVAL
from tidemark.sinks.manifest import RunStore

# Inside one batch a session can be closed and reopened; the later start wins,
# and for the same start the row with more events.
_ORDER = ("batch_id", "session_start", "event_count")


# Batches between two compactions, and buckets of the base.
COMPACT_EVERY = 100
BUCKETS = 64


def upsert_batch(path: str, compact_every: int | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: one folder per batch, replaced on a retry. With
    ``compact_every`` the changes are folded into the base after so many batches."""

    def write(changes: DataFrame, batch_id: int) -> None:
        changes.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite") \
            .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path)
        if compact_every and batch_id >= _base(changes.sparkSession, path).notes.get("batch", -1) + compact_every:
            fold_changes(changes.sparkSession, path, batch_id)

    return write


def start_upserts(changes: DataFrame, path: str, checkpoint: str, mode: str = "update",
                  available_now: bool = False, compact_every: int | None = None) -> StreamingQuery:
    writer = changes.writeStream.outputMode(mode).foreachBatch(upsert_batch(path, compact_every)) \
        .option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=TRIGGER_INTERVAL)
    return writer.start()


def state_changes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def latest_rows(changes: DataFrame, key: str, order: tuple[str, ...]) -> DataFrame:
    """The newest row per key; combined map-side, so one task never holds all
    versions of a key."""
    rest = [c for c in changes.columns if c != key and c not in order]
    newest = changes.groupBy(key).agg(F.max(F.struct(*order, *rest)).alias("row"))
    return newest.select(key, "row.*")


def latest_state(changes: DataFrame) -> DataFrame:
    """Current row per session id. A session that a boundary closed was opened
    again by the same event, so the newest row is never a ``closed`` one."""
    return latest_rows(changes.filter(F.col("status") != "closed"), "session_id", _ORDER)


def closed_rows(changes: DataFrame) -> DataFrame:
    return changes.filter(F.col("status") == "closed").drop("batch_id")


def compact_state(spark: SparkSession, path: str, target: str) -> None:
    """The current rows as a table of their own, under a new path."""
    current_state(spark, path).write.mode("overwrite").partitionBy("batch_id").parquet(target)


# --- base and changes ---------------------------------------------------------------
def _base(spark: SparkSession, path: str) -> RunStore:
    return RunStore(spark, f"{path.rstrip('/')}/_base")


def _batches(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the batch folders; one listing of their names."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in system.listStatus(folder)] if system.exists(folder) else []
    return sorted(int(n.removeprefix("batch_id=")) for n in names if n.startswith("batch_id="))


def _changes_after(spark: SparkSession, path: str, after: int, last: int | None = None) -> DataFrame | None:
    path = path.rstrip("/")
    chosen = [b for b in _batches(spark, path) if b > after and (last is None or b <= last)]
    if not chosen:
        return None
    return spark.read.option("basePath", path).parquet(*[f"{path}/batch_id={b}" for b in chosen])


def _bucket(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("string")


def fold_changes(spark: SparkSession, path: str, batch_id: int | None = None) -> None:
    """Folds the batches up to ``batch_id`` (all) into the base. Only buckets with
    changes are read and written again."""
    base = _base(spark, path)
    changes = _changes_after(spark, path, base.notes.get("batch", -1), batch_id)
    if changes is None:
        return
    changes = changes.where("status != 'closed'")
    buckets = sorted(r[0] for r in changes.select(_bucket("session_id")).distinct().collect())
    change = base.change()
    rows = changes if not base.paths("state", buckets) else changes.unionByName(base.read("state", changes.schema, buckets))
    change.replace("state", latest_state(rows).select(*changes.columns), _bucket("session_id"), buckets)
    change.notes["batch"] = max(b for b in _batches(spark, path) if batch_id is None or b <= batch_id)
    change.commit()


def current_state(spark: SparkSession, path: str) -> DataFrame:
    """Current row per session id, from the base and the batches behind it."""
    return _current(spark, path, None)


def session_state(spark: SparkSession, path: str, session_id: str) -> DataFrame:
    """The current row of one session: one bucket of the base is read."""
    bucket = spark.range(1).select(_bucket_of(session_id)).first()[0]
    return _current(spark, path, [bucket]).where(F.col("session_id") == session_id)


def _bucket_of(value: str) -> Column:
    return F.pmod(F.xxhash64(F.lit(value)), F.lit(BUCKETS)).cast("string")


def _current(spark: SparkSession, path: str, buckets: list[str] | None) -> DataFrame:
    base = _base(spark, path)
    changes = _changes_after(spark, path, base.notes.get("batch", -1))
    if not base.paths("state", buckets):
        return latest_state(state_changes(spark, path) if changes is None else changes)
    schema = changes.schema if changes is not None else spark.read.parquet(base.paths("state", buckets)[0]).schema
    rows = base.read("state", schema, buckets)
    return rows if changes is None else latest_state(changes.unionByName(rows))


def cart_counters(events: DataFrame) -> DataFrame:
    """Streaming counter per session: the sum of its cart additions."""
    return events.groupBy("session_id").agg(
        as_double(F.sum(price_if("event_type = 'cart'"))).alias("cart_total"), F.count(F.lit(1)).alias("event_count")
    )
