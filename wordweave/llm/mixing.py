"""Mixing overlapping sources to target weights by a min-cost flow.

Documents are aggregated by membership pattern, the set of sources they belong to.
A pattern supplies its words once for nothing, a second time at cost 1, a third time
at cost 2 and so on (convex costs of repetition); sources take words up to their
quotas.  The flow says how many words each pattern gives; whole documents are then
selected in the order of a seeded hash.

Only the table of patterns passes through the driver.  Its rows are combinations of
the sources of a mixture, so a mixture's configuration bounds them, not the corpus;
more than ``MAX_PATTERNS`` raise an error.

Null texts have size 0.  Documents without a source, or with a null source, belong to
the source ``None``.  Rows equal in ``doc_id`` and text are taken or left together.
"""

from __future__ import annotations

import functools
from collections import deque
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wordweave.llm.common import WORD, free_name, text_or_empty, without_names
from wordweave.shared import save

MAX_PATTERNS = 100_000
# The hash range of a pattern is cut in 2**BITS parts at a time.
BITS = 10
# This many documents beyond the cut are tried at a time, in hash order, to fill what is left.
FILL = 256

Source = str | None


def in_order(sources: list[Source]) -> list[Source]:
    """By code point, null last."""
    return sorted(sources, key=lambda s: (s is None, s or ""))


def repeating_weights(sources: list[Source], weights: tuple[int, ...] = (5, 2, 1)) -> dict[Source, int]:
    return {s: weights[i % len(weights)] for i, s in enumerate(in_order(sources))}


def capped_targets(sizes: dict[Source, int], weights: dict[Source, int], max_repeats: int, total: int) -> dict[Source, Fraction]:
    """Shares of ``total`` by weight, none above ``max_repeats`` times its source's size."""
    targets: dict[Source, Fraction] = {}
    free = in_order(list(sizes))
    left = Fraction(total)
    while free:
        weight = sum(weights[s] for s in free)
        above = [s for s in free if weight == 0 or left * weights[s] > weight * max_repeats * sizes[s]]
        if not above:
            return targets | {s: left * weights[s] / weight for s in free}
        targets |= {s: Fraction(max_repeats * sizes[s]) for s in above}
        left -= sum(targets[s] for s in above)
        free = [s for s in free if s not in targets]
    return targets


class _Flow:
    """Maximum flow by Dinic's method; arcs may be added between calls."""

    def __init__(self, n: int):
        self.arcs: list[list[int]] = [[] for _ in range(n)]
        self.to: list[int] = []
        self.room: list[int] = []

    def arc(self, a: int, b: int, room: int) -> int:
        self.arcs[a].append(len(self.to))
        self.arcs[b].append(len(self.to) + 1)
        self.to += [b, a]
        self.room += [room, 0]
        return len(self.to) - 2

    def push(self, start: int, end: int) -> None:
        while True:
            level = [-1] * len(self.arcs)
            level[start] = 0
            queue = deque([start])
            while queue:
                a = queue.popleft()
                for e in self.arcs[a]:
                    if self.room[e] and level[self.to[e]] < 0:
                        level[self.to[e]] = level[a] + 1
                        queue.append(self.to[e])
            if level[end] < 0:
                return
            nexts = [0] * len(self.arcs)
            path: list[int] = []
            at = start
            while True:
                if at == end:
                    amount = min(self.room[e] for e in path)
                    for e in path:
                        self.room[e] -= amount
                        self.room[e ^ 1] += amount
                    path, at = [], start
                    continue
                while nexts[at] < len(self.arcs[at]):
                    e = self.arcs[at][nexts[at]]
                    if self.room[e] and level[self.to[e]] == level[at] + 1:
                        break
                    nexts[at] += 1
                else:
                    if not path:
                        break
                    level[at] = -1
                    at = self.to[path.pop() ^ 1]
                    continue
                path.append(e)
                at = self.to[e]


def route(patterns: dict[tuple[Source, ...], int], quotas: dict[Source, int], max_repeats: int) -> dict[tuple, dict[Source, int]]:
    """Words each pattern gives to each of its sources, at the least cost of repetition.

    Costs sit on the supply arcs alone and only depend on the repetition, so adding one
    repetition of all patterns at a time and augmenting gives a flow of least cost: an
    augmenting path never takes back what a cheaper supply arc carries.
    """
    names = in_order(list(quotas))
    rows = sorted(patterns, key=lambda p: [(s is None, s or "") for s in p])
    start, end = 0, 1
    flow = _Flow(2 + len(rows) + len(names))
    place = {s: 2 + len(rows) + i for i, s in enumerate(names)}
    for s in names:
        flow.arc(place[s], end, quotas[s])
    links = {}
    for i, p in enumerate(rows):
        for s in dict.fromkeys(p):
            if s in place:
                links[p, s] = flow.arc(2 + i, place[s], max_repeats * patterns[p])
    for _ in range(max_repeats):
        for i, p in enumerate(rows):
            flow.arc(start, 2 + i, patterns[p])
        flow.push(start, end)
    given: dict[tuple, dict[Source, int]] = {p: {} for p in rows}
    for (p, s), e in links.items():
        given[p][s] = flow.room[e ^ 1]
    return given


@dataclass(frozen=True)
class Mix:
    """A mixture: the documents with ``repeats`` and ``taken``, and what was planned."""

    rows: DataFrame
    source_sizes: dict[Source, int]
    targets: dict[Source, Fraction]
    given: dict[tuple, dict[Source, int]]


def _cut(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """Per pattern the hash below which all documents are taken: ``(pattern_id, start, end, left)``.

    The straddling part of the hash range is refined until few documents are in it.
    """
    rows = sized.join(F.broadcast(plan), "pattern_id").where(F.col("need") > 0)
    cut = plan.select("pattern_id", F.lit(-(2**63)).alias("start"), F.lit(2**63 - 1).alias("end"), F.col("need").alias("left"))
    shift = 64
    while shift > 0:
        shift = max(0, shift - BITS)
        part = F.shiftright("h", shift)
        inside = rows.drop("need").join(F.broadcast(cut.drop("end")), "pattern_id").where(
            (F.col("h") >= F.col("start")) & (part <= F.shiftright("start", shift) + (2**BITS - 1))
        )
        parts = inside.groupBy("pattern_id", part.alias("part")).agg(F.sum("size").alias("size"), F.count("*").alias("n"))
        running = Window.partitionBy("pattern_id").orderBy("part")
        summed = parts.join(F.broadcast(cut), "pattern_id").withColumns(
            {"upto": F.sum("size").over(running), "all": F.sum("n").over(Window.partitionBy("pattern_id"))}
        )
        straddling = summed.where((F.col("upto") > F.col("left")) & (F.col("upto") - F.col("size") <= F.col("left")))
        found = straddling.select(
            "pattern_id",
            F.shiftleft("part", shift).alias("start"),
            (F.col("left") - F.col("upto") + F.col("size")).alias("left"),
            "n",
            "all",
        ).collect()
        if not found:
            return cut
        # Hashes are uniform: this range holds about twice the documents that are tried.
        ends = [min(2**63 - 1, r["start"] + (max(1, 2 * FILL * 2**BITS // r["all"]) + 1 << shift)) for r in found]
        cut = sized.sparkSession.createDataFrame(
            [(r["pattern_id"], r["start"], end, r["left"]) for r, end in zip(found, ends, strict=True)],
            "pattern_id int, start long, end long, left long",
        )
        if max(r["n"] for r in found) <= FILL:
            break
    return cut


def _filled(sized: DataFrame, cut: DataFrame) -> DataFrame:
    """``(pattern_id, left, last, hashes)``: of ``FILL`` units at and after the cut, in hash order, what still fits.

    ``left`` is what is missing then and ``last`` the last hash tried.  Units without words are passed over.
    """
    after = sized.join(F.broadcast(cut), "pattern_id").where(F.col("h").between(F.col("start"), F.col("end")) & (F.col("size") > 0))
    units = after.groupBy("pattern_id", "h", "left", "end").agg(F.sum("size").alias("size"))
    nearest = units.withColumn("place", F.row_number().over(Window.partitionBy("pattern_id").orderBy("h"))).where(
        F.col("place") <= FILL
    )
    lists = nearest.groupBy("pattern_id").agg(
        F.first("left").alias("left"), F.first("end").alias("end"), F.sort_array(F.collect_list(F.struct("h", "size"))).alias("units")
    )
    fits = F.expr(
        """aggregate(units, struct(left AS left, array_repeat(0L, 0) AS hashes), (a, u) ->
             if(u.size <= a.left, struct(a.left - u.size AS left, array_append(a.hashes, u.h) AS hashes), a))"""
    )
    last = F.when(F.size("units") < FILL, F.col("end")).otherwise(F.element_at("units", -1)["h"])
    return lists.select("pattern_id", last.alias("last"), fits.alias("fits")).select("pattern_id", "fits.left", "last", "fits.hashes")


def _beyond(sized: DataFrame, cut: DataFrame) -> DataFrame:
    """``(pattern_id, h, filled)``: hashes at and after the cut that are taken too.

    What a fill leaves is cut and filled again from the fitting units beyond the last one
    tried, until none fits.
    """
    spark, taken = sized.sparkSession, []
    while True:
        fill = save(_filled(sized, cut), "mix-filled")
        taken.append(fill.select("pattern_id", F.explode("hashes").alias("h")))
        # Rows of patterns, which MAX_PATTERNS bounds.
        tried = {r["pattern_id"]: (r["left"], r["last"]) for r in fill.select("pattern_id", "left", "last").collect()}
        bounds = [(r["pattern_id"], *tried.get(r["pattern_id"], (r["left"], r["end"]))) for r in cut.collect()]
        bounds = F.broadcast(spark.createDataFrame(bounds, "pattern_id int, left long, last long"))
        rest = sized.join(bounds, "pattern_id").where((F.col("h") > F.col("last")) & (F.col("size") > 0) & (F.col("size") <= F.col("left")))
        rest = rest.groupBy("pattern_id", "h", "left").agg(F.sum("size").alias("size")).where(F.col("size") <= F.col("left"))
        rest = save(rest, "mix-rest")
        totals = rest.groupBy("pattern_id", "left").agg(F.sum("size").alias("size")).collect()
        needs = [(r["pattern_id"], r["left"]) for r in totals if r["size"] > r["left"]]
        plan = spark.createDataFrame(needs, "pattern_id int, need long")
        rest = rest.select("pattern_id", "size", "h")
        taken.append(rest.join(F.broadcast(plan), "pattern_id", "left_anti").select("pattern_id", "h"))
        if not needs:
            break
        sized = rest.join(F.broadcast(plan), "pattern_id", "left_semi")
        cut = _cut(sized, plan)
        taken.append(sized.join(F.broadcast(cut), "pattern_id").where(F.col("h") < F.col("start")).select("pattern_id", "h"))
    return functools.reduce(DataFrame.unionByName, taken).withColumn("filled", F.lit(True))


def mix(docs: DataFrame, sources: Column, weights: dict[Source, int] | None = None, max_repeats: int = 3, seed: int = 0) -> Mix:
    """Take documents so that each source's words come to its share of all words.

    ``sources`` is an array of the sources a document belongs to.  ``rows`` has the
    columns of ``docs`` and ``mix_size, mix_sources, mix_repeats, mix_taken``, which take
    the place of columns of these names.
    """
    given_names = without_names(docs, "mix_size", "mix_sources", "mix_repeats", "mix_taken").columns
    # Numbered names clash with no helper column.
    inner = {c: f"column_{i}" for i, c in enumerate(given_names)}
    members = F.when(F.size(sources) > 0, F.array_sort(F.array_distinct(sources))).otherwise(F.array(F.lit(None).cast("string")))
    hashed = docs.select(
        *[docs[f"`{c}`"].alias(name) for c, name in inner.items()],
        members.alias("mix_sources"),
        F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long").alias("mix_size"),
        F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text")).alias("mix_h"),
    )
    sized = save(
        hashed.select(F.col("mix_sources").alias("pattern"), F.col("mix_size").alias("size"), F.col("mix_h").alias("h")), "mix-sizes"
    )
    found = sized.groupBy("pattern").agg(F.sum("size").alias("size")).limit(MAX_PATTERNS + 1).collect()
    if len(found) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} combinations of sources; a mixture needs fewer")
    patterns = {tuple(r["pattern"]): r["size"] for r in found}
    # What several sources share counts for each of them.
    sizes: dict[Source, int] = {}
    for pattern, size in patterns.items():
        for s in pattern:
            sizes[s] = sizes.get(s, 0) + size
    targets = capped_targets(sizes, weights or repeating_weights(list(sizes)), max_repeats, sum(patterns.values()))
    given = route(patterns, {s: round(t) for s, t in targets.items()}, max_repeats)
    plan = []
    for i, (pattern, flows) in enumerate(given.items()):
        repeats, need = divmod(sum(flows.values()), max(1, patterns[pattern]))
        plan.append((i, list(pattern), repeats, need))
    spark = docs.sparkSession
    planned = spark.createDataFrame(plan, "pattern_id int, pattern array<string>, repeats long, need long")
    numbered = F.broadcast(planned.select("pattern_id", F.to_json("pattern").alias("pattern_key")))
    sized = sized.join(numbered, F.to_json("pattern") == F.col("pattern_key")).select("pattern_id", "size", "h")
    cut = _cut(sized, planned.select("pattern_id", "need").where("need > 0"))
    filled = save(_beyond(sized, cut), "mix-beyond")
    # Both tables have a row per pattern, so MAX_PATTERNS bounds the broadcasts.
    levels = planned.join(cut.select("pattern_id", "start"), "pattern_id", "left").select(
        "pattern_id", F.to_json("pattern").alias("pattern_key"), "repeats", F.coalesce("start", F.lit(-(2**63))).alias("start")
    )
    rows = hashed.join(F.broadcast(levels), F.to_json("mix_sources") == F.col("pattern_key")).join(
        filled.withColumnRenamed("h", "mix_h"), ["pattern_id", "mix_h"], "left"
    )
    more = F.when((F.col("mix_h") < F.col("start")) | F.coalesce("filled", F.lit(False)), 1).otherwise(0)
    repeats = (F.col("repeats") + more).cast("long")
    rows = rows.select(
        *[F.col(name).alias(c) for c, name in inner.items()],
        "mix_sources",
        "mix_size",
        repeats.alias("mix_repeats"),
        (repeats * F.col("mix_size")).alias("mix_taken"),
    )
    return Mix(rows, sizes, targets, given)


def repeated(mixture: Mix, columns: list[str]) -> DataFrame:
    """Each row as often as the mixture takes it."""
    times = F.expr("explode(array_repeat(0, int(mix_repeats)))").alias(copy := free_name(mixture.rows, "mix_copy"))
    return mixture.rows.where("mix_repeats > 0").select(*columns, times).drop(copy)


def own_source() -> Column:
    return F.array(F.col("source").cast("string"))


def op1_mixing(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    mixture = mix(docs, own_source())
    known = spark.createDataFrame(
        [(s, mixture.source_sizes[s], float(mixture.targets[s])) for s in mixture.targets],
        "mix_source string, source_size long, target double",
    )
    same = F.col("mix_sources")[0].eqNullSafe(F.col("mix_source"))
    return mixture.rows.join(F.broadcast(known), same).select(
        "doc_id", F.col("mix_size").alias("size"), "source_size", "target", F.col("mix_taken").alias("taken"), F.col("mix_repeats").alias("repeats")
    )
