"""Tables made of runs: what a reader sees changes at once, by one small file.

A job writes the parts it replaces below a folder of its own run, then commits a
manifest that names, for each table and part, the runs whose files count. Readers
open the newest manifest and just the folders it names; nothing is listed but the
manifests. A run that is lost before its commit leaves files no manifest names.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, base: str, kind: str) -> list[int]:
    folder, system = _folder(spark, f"{base}/{kind}")
    if not system.exists(folder):
        return []
    names = [s.getPath().getName() for s in system.listStatus(folder)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0].isdigit())


def _put(spark: SparkSession, base: str, kind: str, number: int, content: dict) -> None:
    """A file that appears whole or not at all; an existing one is never replaced."""
    final, system = _folder(spark, f"{base}/{kind}/{number:08d}.json")
    draft, _ = _folder(spark, f"{base}/{kind}/_{uuid.uuid4().hex}")
    out = system.create(draft)
    out.write(bytearray(json.dumps(content, sort_keys=True).encode()))
    out.close()
    if system.exists(final) or not system.rename(draft, final):
        system.delete(draft, False)
        raise RuntimeError(f"another run has committed {kind} {number} of {base}")


def _get(spark: SparkSession, base: str, kind: str, number: int) -> dict:
    path = f"{base}/{kind}/{number:08d}.json"
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


class RunStore:
    """The tables below ``base`` as the newest manifest has them. Parts are folders
    ``part=<name>`` of a run; a part may have several runs (rows were added) or one
    (it was replaced)."""

    def __init__(self, spark: SparkSession, base: str) -> None:
        self.spark, self.base = spark, base.rstrip("/")
        found = _numbers(spark, self.base, "manifests")
        self.number = found[-1] if found else 0
        content = _get(spark, self.base, "manifests", self.number) if found else {}
        self.tables: dict[str, dict[str, list[int]]] = content.get("tables", {})
        self.notes: dict = content.get("notes", {})

    def parts(self, table: str) -> list[str]:
        return sorted(self.tables.get(table, {}))

    def paths(self, table: str, parts: list[str] | None = None) -> list[str]:
        known = self.tables.get(table, {})
        chosen = known if parts is None else [p for p in dict.fromkeys(parts) if p in known]
        return [f"{self.base}/{table}/run={run}/part={p}" for p in chosen for run in known[p]]

    def read(self, table: str, schema: T.StructType, parts: list[str] | None = None) -> DataFrame:
        paths = self.paths(table, parts)
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def change(self) -> Change:
        return Change(self)

    def published(self) -> int:
        """Number of the newest run whose results have been handed on."""
        return max(_numbers(self.spark, self.base, "published"), default=0)

    def changed_since(self, number: int, table: str) -> list[str]:
        """Parts of ``table`` that runs after ``number`` have written or emptied."""
        return sorted({p for n in range(number + 1, self.number + 1) for p in _get(self.spark, self.base, "manifests", n)["changed"].get(table, [])})

    def mark_published(self) -> None:
        if self.published() < self.number:
            _put(self.spark, self.base, "published", self.number, {})


class Change:
    """Parts written by one run, seen by nobody until :meth:`commit`."""

    def __init__(self, store: RunStore) -> None:
        self.store, self.number = store, store.number + 1
        self.tables = {t: {p: list(runs) for p, runs in parts.items()} for t, parts in store.tables.items()}
        self.changed: dict[str, list[str]] = {}
        self.notes = dict(store.notes)

    def _write(self, table: str, rows: DataFrame, part) -> list[str]:
        """Writes the rows by the text of column ``part``; returns the parts that exist now."""
        path = f"{self.store.base}/{table}/run={self.number}"
        dealt = rows.withColumn("part", part.cast("string"))
        # Inside a stream AQE is off and Spark drops the hint: every task would write every part.
        adaptive = dealt.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true"
        dealt = dealt.hint("rebalance", "part") if adaptive else dealt.repartition("part")
        dealt.write.mode("overwrite").partitionBy("part").parquet(path)
        folder, system = _folder(self.store.spark, path)
        names = [s.getPath().getName() for s in system.listStatus(folder)]
        return sorted(n.removeprefix("part=") for n in names if n.startswith("part="))

    def replace(self, table: str, rows: DataFrame, part, parts: list[str]) -> None:
        """``rows`` take the place of all rows in ``parts`` (and lie in no others)."""
        written = self._write(table, rows, part)
        if not set(written) <= set(parts):
            raise ValueError(f"rows of {table} outside the parts to replace: {sorted(set(written) - set(parts))}")
        known = self.tables.setdefault(table, {})
        for p in parts:
            known.pop(p, None)
        known.update({p: [self.number] for p in written})
        self.changed[table] = sorted(parts)

    def add(self, table: str, rows: DataFrame, part) -> None:
        known = self.tables.setdefault(table, {})
        written = self._write(table, rows, part)
        for p in written:
            known[p] = [*known.get(p, []), self.number]
        self.changed[table] = written

    def commit(self) -> RunStore:
        _put(self.store.spark, self.store.base, "manifests", self.number, {"tables": self.tables, "changed": self.changed, "notes": self.notes})
        return RunStore(self.store.spark, self.store.base)
