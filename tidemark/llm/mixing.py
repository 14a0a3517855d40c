"""Mixing sources to target weights by a min-cost flow.

Documents are summed up by membership pattern (the set of sources they belong
to). A flow network leads words from patterns to the quotas of their sources;
the second reading of a pattern costs more than the first, so cost is convex in
repetition and nothing is repeated while fresh words remain that could serve.
Each pattern's flow is then filled with whole documents in a seeded order.

Only sums per pattern and per source reach the driver: their number is that of
the sources and of their combinations, not of the documents. The order inside a
pattern is found by sums over cells of the seeded hash (4096, then 4096 within
the cell where the flow ends), so that only the documents of one cell out of
16.7 million are ever sorted together, however large a source is.

Defined cases: null or blank texts have size 0 and are taken 0 times; documents
without a source form a source of their own, last in order; identical rows are
separate documents; an empty table gives no rows; the input's columns travel in
one struct, so no name can clash.
"""

from __future__ import annotations

import json
from collections import deque
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, stored

CELL = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_weights(sources: list[str | None], weights: tuple[int, ...] = (5, 2, 1)) -> dict[str | None, int]:
    """Weights in turn over the sources by code point, null last."""
    ordered = sorted((s for s in sources if s is not None)) + [None] * (None in sources)
    return {s: weights[i % len(weights)] for i, s in enumerate(ordered)}


def capped_targets(sizes: dict, weights: dict, share: Fraction, most: int = 2) -> dict:
    """Words per source: ``share`` of all words split by weight, at most ``most``
    times a source's size, the rest split anew until no target is above."""
    open_, fixed = set(sizes), {}
    while True:
        left = share * sum(sizes.values()) - sum(fixed.values())
        weight = sum(weights[s] for s in open_)
        rate = left / weight if weight else Fraction(0)
        above = {s for s in open_ if weights[s] * rate > most * sizes[s]}
        if not above:
            return {s: fixed[s] if s in fixed else weights[s] * rate for s in sizes}
        fixed.update({s: Fraction(most * sizes[s]) for s in above})
        open_ -= above


def routed_words(patterns: dict[tuple, int], quotas: dict, readings: int = 2) -> dict[tuple, dict]:
    """Min-cost flow from patterns to sources; words by pattern and source.

    Reading ``r`` of a pattern holds as many words as the pattern and costs ``r``
    a word (0 for the first). Sources linked by no pattern are solved apart.
    Successive shortest paths: while words can flow, they take the cheapest way.
    """
    flow: dict[tuple, dict] = {p: {} for p in patterns}
    for some in _linked(patterns):
        _route({p: patterns[p] for p in some}, quotas, readings, flow)
    return flow


def _linked(patterns) -> list[list[tuple]]:
    by_source: dict = {}
    for p in patterns:
        for s in p:
            by_source.setdefault(s, []).append(p)
    groups, seen = [], set()
    for p in patterns:
        if p in seen:
            continue
        seen.add(p)
        group, waiting = [], [p]
        while waiting:
            q = waiting.pop()
            group.append(q)
            for s in q:
                for r in by_source.pop(s, ()):
                    if r not in seen:
                        seen.add(r)
                        waiting.append(r)
        groups.append(group)
    return groups


def _route(patterns: dict[tuple, int], quotas: dict, readings: int, flow: dict[tuple, dict]) -> None:
    room: list[int] = []
    cost: list[int] = []
    ends: list[int] = []
    leaving: dict = {}
    names: dict = {}

    def node(name) -> int:
        return names.setdefault(name, len(names))

    def arc(a: int, b: int, words: int, price: int) -> int:
        for x, y, w, c in ((a, b, words, price), (b, a, 0, -price)):
            leaving.setdefault(x, []).append(len(ends))
            ends.append(y)
            room.append(w)
            cost.append(c)
        return len(ends) - 2

    start, goal = node("start"), node("goal")
    carried = {}
    for p, words in patterns.items():
        for r in range(readings):
            arc(start, node(("pattern", p)), words, r)
        for s in p:
            carried[p, s] = arc(node(("pattern", p)), node(("source", s)), readings * words, 0)
    for s in {s for p in patterns for s in p}:
        arc(node(("source", s)), goal, quotas[s], 0)
    while True:
        best, via, waiting = {start: 0}, {}, deque([start])
        while waiting:
            a = waiting.popleft()
            for e in leaving[a]:
                if room[e] > 0 and best[a] + cost[e] < best.get(ends[e], 1 << 60):
                    best[ends[e]], via[ends[e]] = best[a] + cost[e], e
                    waiting.append(ends[e])
        if goal not in via:
            break
        path, at = [], goal
        while at != start:
            path.append(via[at])
            at = ends[via[at] ^ 1]
        words = min(room[e] for e in path)
        for e in path:
            room[e] -= words
            room[e ^ 1] += words
    for (p, s), e in carried.items():
        flow[p][s] = room[e ^ 1]


@dataclass
class MixPlan:
    """Targets by source; base copies and words left to fill by pattern, with the
    cell where filling ends and the words of the cells before it."""

    sizes: dict
    targets: dict
    base: dict[str, int]
    rest: dict[str, int]
    last: dict[str, tuple[str, int]]


def keyed(documents: DataFrame, members: Column, seed: str, keep: list[str] | None = None) -> DataFrame:
    """Rows (mix_row, mix_id, mix_pattern, mix_size, mix_order): the columns to keep
    (all), the id, the sources, the words and a seeded hash of the id."""
    return documents.select(
        F.struct(*(keep or documents.columns)).alias("mix_row"), F.col("doc_id").alias("mix_id"),
        F.to_json(F.array_sort(F.array_distinct(members))).alias("mix_pattern"), word_count(F.col("text")).alias("mix_size"),
        F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("mix_order"),
    )


def _ending_cells(rows: DataFrame, cell: Column, left: DataFrame) -> dict[str, tuple[str, int]]:
    """Per pattern of ``left`` (mix_pattern, words, before) the cell that holds the
    last word and the words before that cell. A row per pattern comes back."""
    sums = rows.groupBy("mix_pattern", cell.alias("cell")).agg(F.sum("mix_size").alias("held"))
    line = Window.partitionBy("mix_pattern").orderBy("cell")
    placed = sums.withColumn("until", F.sum("held").over(line)).join(F.broadcast(left), "mix_pattern")
    begin = F.col("before") + F.col("until") - F.col("held")
    here = placed.where((begin <= F.col("words")) & (F.col("words") < F.col("before") + F.col("until")))
    return {r["mix_pattern"]: (r["cell"], r["begin"]) for r in here.select("mix_pattern", "cell", begin.alias("begin")).collect()}


def plan_mix(rows: DataFrame, weights=source_weights, share: Fraction = Fraction(3, 2), most: int = 2) -> MixPlan:
    """Plan for rows of :func:`keyed`, which should be stored: they are read three times."""
    spark = rows.sparkSession
    summed = rows.groupBy("mix_pattern").agg(F.sum("mix_size").alias("words")).collect()
    keys = {tuple(json.loads(r["mix_pattern"])): r["mix_pattern"] for r in summed}
    found = {tuple(json.loads(r["mix_pattern"])): int(r["words"]) for r in summed}
    sizes: dict = {}
    for pattern, words in found.items():
        for s in pattern:
            sizes[s] = sizes.get(s, 0) + words
    targets = capped_targets(sizes, weights(list(sizes)), share, most)
    flow = routed_words(found, {s: int(t + Fraction(1, 2)) for s, t in targets.items()}, most)
    base, rest = {}, {}
    for pattern, words in found.items():
        base[keys[pattern]], rest[keys[pattern]] = divmod(sum(flow[pattern].values()), words) if words else (0, 0)
    if not rest:
        return MixPlan(sizes, targets, base, rest, {})
    schema = "mix_pattern string, words long, before long"
    first = _ending_cells(rows, F.substring("mix_order", 1, CELL), spark.createDataFrame([(k, w, 0) for k, w in rest.items()], schema))
    last: dict[str, tuple[str, int]] = {}
    if first:
        ends = spark.createDataFrame([(k, c) for k, (c, _) in first.items()], "mix_pattern string, end string")
        inside = rows.join(F.broadcast(ends), "mix_pattern").where(F.substring("mix_order", 1, CELL) == F.col("end"))
        last = _ending_cells(inside, F.substring("mix_order", 1, 2 * CELL), spark.createDataFrame([(k, rest[k], b) for k, (_, b) in first.items()], schema))
    return MixPlan(sizes, targets, base, rest, last)


def with_copies(rows: DataFrame, plan: MixPlan) -> DataFrame:
    """Adds mix_copies, how often each row of :func:`keyed` is taken.

    Whether a row lies before, in or behind its pattern's last cell is seen on the
    row alone; only rows in that cell are sorted. A document is taken while at
    least half of it fits.
    """
    if not plan.rest:
        return rows.withColumn("mix_copies", F.lit(0))
    ends = rows.sparkSession.createDataFrame(
        [(k, plan.base[k], plan.rest[k], *plan.last.get(k, ("", 0))) for k in plan.rest],
        "mix_pattern string, mix_base int, mix_rest long, mix_end string, mix_before long",
    )
    placed = rows.join(F.broadcast(ends), "mix_pattern").withColumn("mix_cell", F.substring("mix_order", 1, 2 * CELL))
    inside = F.col("mix_cell") == F.col("mix_end")
    clear = placed.where(~inside).withColumn("mix_extra", (F.col("mix_cell") < F.col("mix_end")).cast("int"))
    line = Window.partitionBy("mix_pattern").orderBy("mix_order", "mix_id", "mix_size").rowsBetween(Window.unboundedPreceding, 0)
    twice = 2 * (F.col("mix_before") + F.sum("mix_size").over(line)) - F.col("mix_size")
    edge = placed.where(inside).withColumn("mix_extra", (twice <= 2 * F.col("mix_rest")).cast("int"))
    both = clear.unionByName(edge).withColumn("mix_copies", F.col("mix_base") + F.col("mix_extra"))
    return both.drop("mix_base", "mix_rest", "mix_end", "mix_before", "mix_cell", "mix_extra")


def targets_table(spark, plan: MixPlan) -> DataFrame:
    """Per source its size and target; one row per source."""
    return spark.createDataFrame(
        [(s, plan.sizes[s], plan.targets[s].numerator / plan.targets[s].denominator) for s in plan.sizes],
        "mix_source string, source_size long, target double",
    )


def mixed_documents(documents: DataFrame, members: Column, seed: str, share: Fraction = Fraction(3, 2), most: int = 2) -> DataFrame:
    """Each document as often as the mix takes it, all columns as they came."""
    rows = keyed(documents, members, seed)
    plan = plan_mix(stored(rows.select("mix_pattern", "mix_size", "mix_order"), "sized"), share=share, most=most)
    copies = F.array_repeat(F.lit(0), F.col("mix_copies"))
    return with_copies(rows, plan).select("mix_row", F.explode(copies)).select("mix_row.*")
