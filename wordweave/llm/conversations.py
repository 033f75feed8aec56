"""Conversation structure repair by depth-first branch-and-bound.

Every row of a conversation is kept, given another role or deleted, and rows without text
may be inserted, so that the first letters of the roles read ``(s?(ua)+)?``.  Of the
cheapest ways the one whose audit, the edits' initials in order, is least is taken.

Search.  A node is a place between two rows and what the output may go on with.  Partial
repairs wait on an explicit stack, the most promising on top.  A suffix lower bound counts
what the rows ahead cost at least; a table for every node keeps the best ``(cost, audit)``
that reached it and drops what is worse; the incumbent, the best whole repair so far, drops
what cannot beat it.  When the stack is empty, the incumbent is proved the best.  At one
node two audits of equal cost hold the same rows' edits and differ in a letter, so the
lesser one stays the lesser whatever follows: dropping the worse loses nothing.

Length.  A conversation is read in order, ``BLOCK`` rows at a time.  Each block is searched
from every node that its predecessor left in doubt, at most four, and leaves the best
repair for each node at its end.  What these agree on is settled; a running digest goes
with each.  So memory does not grow with the rows of a conversation but by its audit, one
letter a row.  The digest of a conversation has to see its rows one after the other, so one
task reads them; rows are marked, and told from copies, before.

Odd rows.  Nulls count as one space in damage, roles and texts; a null ``conv_id`` is a
conversation of its own.  Rows of one turn are in the order of role and text.  A row with
an empty role can't be kept, as it has no initial.  Whole copies of a row are rows.  An empty
table gives an empty table; further columns are left out, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Rows that are searched at once.
BLOCK = 32

# Costs of the edits, and what an unfinished text adds unless it is deleted.
RELABEL, DELETE, INSERT, UNFINISHED = 2, 3, 2, 1

# Nodes: what the initials so far end with.
START, SYSTEM, USER, ASSISTANT = range(4)
KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
ALTERNATE = (USER, USER, ASSISTANT, USER)
ROLES = {USER: "user", ASSISTANT: "assistant"}
IN_ORDER = {"su", "ua", "au"}

# From an end of a block, another end is at most this far away or never better, see ``search``.
SLACK = 5

# White space, which text of no other characters is blank of.
SPACES = " \t\n\v\f\r"

RESULT = (
    "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
    "audit string, repaired_sha256 string"
)


@dataclass(frozen=True)
class Row:
    """What the search has to know of a row: its role's initial and its fault."""

    initial: str
    fault: str = ""

    @property
    def must_go(self) -> bool:
        return self.fault in ("blank", "duplicate")

    @property
    def price(self) -> int:
        return UNFINISHED if self.fault == "truncated" else 0


@dataclass(frozen=True)
class Partial:
    """A partial repair: its cost, its audit since what is settled, and the node it set out from."""

    cost: int
    audit: str
    origin: int


def lower_bounds(rows: list[Row]) -> list[int]:
    """For every place, what the rows from there on cost at least.

    A row costs its deletion, a relabelling, or its unfinished text.  Of two neighbours
    that may not follow each other one is changed or something comes between, for 2 or
    more beyond that; pairs that share no row add up.
    """
    bounds = [0] * (len(rows) + 1)
    after = ""
    for i in range(len(rows) - 1, -1, -1):
        row = rows[i]
        bounds[i] = bounds[i + 1]
        if row.must_go:
            bounds[i] += DELETE
            continue
        bounds[i] += row.price
        if row.initial not in ("s", "u", "a"):
            bounds[i] += RELABEL
            after = ""
        elif after and row.initial + after not in IN_ORDER:
            bounds[i] += 2
            after = ""
        else:
            after = row.initial
    return bounds


def steps(rows: list[Row], at: int, node: int) -> Iterator[tuple[str, int, int, int]]:
    """``(letter, cost, place, node)`` of every edit possible at a node."""
    yield "I", INSERT, at, ALTERNATE[node]
    if at < len(rows):
        row = rows[at]
        yield "D", DELETE, at + 1, node
        if not row.must_go:
            yield "R", RELABEL + row.price, at + 1, ALTERNATE[node]
            kept = KEPT.get((node, row.initial))
            if kept is not None:
                yield "K", row.price, at + 1, kept


def search(rows: list[Row], entries: dict[int, tuple[int, str]], last: bool) -> dict[int, Partial]:
    """The best partial repair for every node after ``rows``; of the whole if they are the ``last``.

    Ends dearer than the cheapest by more than ``SLACK`` are dropped: after ``u`` and ``a``
    the rest differs by one insertion; after an output that is empty or holds only ``s`` it
    is never cheaper than after ``a`` by more than one deletion.
    """
    n = len(rows)
    bounds = lower_bounds(rows)
    ends = (START, ASSISTANT) if last else (START, SYSTEM, USER, ASSISTANT)
    best: dict[tuple[int, int], Partial] = {}
    incumbent: tuple[int, str] | None = None
    stack: list[tuple[int, int, Partial]] = []

    def reach(at: int, node: int, partial: Partial) -> bool:
        nonlocal incumbent
        if incumbent is not None:
            total = partial.cost + bounds[at]
            if total > incumbent[0] + (0 if last else SLACK):
                return False
            if last and total == incumbent[0] and partial.audit > incumbent[1][: len(partial.audit)]:
                return False
        known = best.get((at, node))
        if known is not None and (known.cost, known.audit) <= (partial.cost, partial.audit):
            return False
        best[at, node] = partial
        if at == n and node in ends and (incumbent is None or (partial.cost, partial.audit) < incumbent):
            incumbent = partial.cost, partial.audit
        return True

    for node, (cost, audit) in entries.items():
        partial = Partial(cost, audit, node)
        if reach(0, node, partial):
            stack.append((0, node, partial))
    while stack:
        at, node, partial = stack.pop()
        if best[at, node] is not partial:
            continue
        found = []
        for letter, cost, to, to_node in steps(rows, at, node):
            further = Partial(partial.cost + cost, partial.audit + letter, partial.origin)
            if reach(to, to_node, further):
                found.append((further.cost + bounds[to], letter, to, to_node, further))
        found.sort(key=lambda f: f[:2], reverse=True)
        stack.extend((to, to_node, further) for _, _, to, to_node, further in found)
    at_end = {node: best[n, node] for node in ends if (n, node) in best}
    least = min((p.cost, p.audit) for p in at_end.values())
    if last:
        return {node: p for node, p in at_end.items() if (p.cost, p.audit) == least}
    return {node: p for node, p in at_end.items() if p.cost <= least[0] + SLACK}


def edited(rows: list[Row], said: list[tuple[str, str]], node: int, edits: str) -> tuple[list[tuple[str, str]], int]:
    """The ``(role, text)`` rows that the edits make, and the node they end at."""
    out, at = [], 0
    for letter in edits:
        if letter == "D":
            at += 1
            continue
        node = KEPT[node, rows[at].initial] if letter == "K" else ALTERNATE[node]
        if letter == "I":
            out.append((ROLES[node], ""))
            continue
        role, text = said[at]
        out.append((role if letter == "K" else ROLES[node], text))
        at += 1
    return out, node


@dataclass
class _Way:
    """A repair of all blocks so far, up to one node."""

    cost: int = 0
    audit: str = ""
    digest: object = field(default_factory=hashlib.sha256)
    empty: bool = True


class Repair:
    """Repairs one conversation whose rows come in order."""

    def __init__(self) -> None:
        self.settled: list[str] = []
        self.ways = {START: _Way()}
        self.rows: list[Row] = []
        self.said: list[tuple[str, str]] = []

    def add(self, row: Row, role: str, text: str) -> None:
        if len(self.rows) == BLOCK:
            self._search(last=False)
        self.rows.append(row)
        self.said.append((role, text))

    def _search(self, last: bool) -> None:
        entries = {node: (way.cost, way.audit) for node, way in self.ways.items()}
        ways = {}
        for node, partial in search(self.rows, entries, last).items():
            origin = self.ways[partial.origin]
            digest, empty = origin.digest.copy(), origin.empty
            for role, text in edited(self.rows, self.said, partial.origin, partial.audit[len(origin.audit) :])[0]:
                digest.update(f"{'' if empty else '\n'}{role}:{text}".encode())
                empty = False
            ways[node] = _Way(partial.cost, partial.audit, digest, empty)
        # What all ways have in common will not change any more.
        audits = [way.audit for way in ways.values()]
        low, high = min(audits), max(audits)
        same = next((i for i, (a, b) in enumerate(zip(low, high, strict=False)) if a != b), min(len(low), len(high)))
        if last:
            same = len(low)
        self.settled.append(low[:same])
        for way in ways.values():
            way.audit = way.audit[same:]
        self.ways, self.rows, self.said = ways, [], []

    def finish(self) -> tuple[int, str, str]:
        """``(cost, audit, sha256 of the repaired rows)``."""
        self._search(last=True)
        (way,) = self.ways.values()
        return way.cost, "".join(self.settled), way.digest.hexdigest()


def damaged(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text, copy, gone)``: seeded damage to the rows.

    ``gone`` rows are dropped ones; they stay so that their conversation is still there.
    """
    space = F.lit(" ")
    conv_id, turn = (F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn"))
    key = F.concat(conv_id, F.lit(":"), turn)
    kind = (F.crc32(key.cast("binary")) % 20).cast("int")
    role, text = F.coalesce(F.col("role"), space), F.coalesce(F.col("text"), space)
    marked = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), role.alias("role"), text.alias("text"), kind.alias("kind")
    )
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return marked.select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").when(F.col("kind") != 0, F.col("role")).otherwise("").alias("role"),
        F.when(F.col("kind").isin(0, 1), "")
        .when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        (F.col("kind") == 0).alias("gone"),
        F.explode(copies).alias("copy"),
    )


def with_faults(rows: DataFrame) -> DataFrame:
    """Add ``fault``: the first of blank, duplicate and truncated that holds, or an empty string.

    A duplicate is told from the first of its kind by their digests in order, so no set of
    what was said is held anywhere.
    """
    end = F.right(F.rtrim("text", F.lit(SPACES)), F.lit(1))
    told = rows.withColumns({"end": end, "told": F.sha2(F.concat_ws("\n", F.length("role").cast("string"), "role", "text"), 256)})
    same = Window.partitionBy("conv_id", "told", "gone").orderBy(F.col("turn").asc_nulls_first(), "copy")
    numbered = told.repartition("conv_id").withColumn("nth", F.row_number().over(same))
    fault = (
        F.when(F.col("gone"), "")
        .when(F.col("end") == "", "blank")
        .when(F.col("nth") > 1, "duplicate")
        .when(~F.col("end").isin(".", "!", "?"), "truncated")
        .otherwise("")
    )
    return numbered.select("conv_id", "turn", "role", "text", "copy", "gone", fault.alias("fault"))


class _Conversation:
    """Figures and repair of one conversation, row by row."""

    def __init__(self, conv_id: int | None) -> None:
        self.conv_id = conv_id
        self.repair = Repair()
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0, "": 0}
        self.before: str | None = None
        self.illegal = 0
        self.first = self.last = None
        self.turns = 0

    def add(self, turn: int | None, role: str, text: str, fault: str) -> None:
        initial = role[:1]
        self.faults[fault] += 1
        if self.before is not None and self.before + initial not in IN_ORDER:
            self.illegal += 1
        self.before = initial
        if turn is not None:
            if self.first is None:
                self.first = turn
            if self.last != turn:
                self.turns += 1
            self.last = turn
        self.repair.add(Row(initial, fault), role, text)

    def result(self) -> tuple:
        cost, audit, digest = self.repair.finish()
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        counts = [self.faults[name] for name in ("blank", "duplicate", "truncated")]
        return self.conv_id, gaps, *counts, self.illegal, cost, audit, digest


def repair(rows: DataFrame) -> DataFrame:
    """Figures and the cheapest repair of every conversation of :func:`damaged` rows."""
    marked = with_faults(rows)
    in_order = marked.sortWithinPartitions(
        F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text", "copy"
    ).select("conv_id", "turn", "role", "text", "fault", "gone")
    names = [part.split()[0] for part in RESULT.split(", ")]
    kinds = [pa.int64()] * 7 + [pa.string()] * 2

    def batch(results: list[tuple]) -> pa.RecordBatch:
        columns = zip(*results, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Conversation | None = None
        done: list[tuple] = []
        for rows_of in batches:
            columns = rows_of.columns
            for i in range(len(rows_of)):
                conv_id, turn, role, text, fault, gone = (c[i].as_py() for c in columns)
                if now is None or conv_id != now.conv_id:
                    if now is not None:
                        done.append(now.result())
                    if len(done) >= 1024:
                        yield batch(done)
                        done = []
                    now = _Conversation(conv_id)
                if not gone:
                    now.add(turn, role, text, fault)
        if now is not None:
            done.append(now.result())
        if done:
            yield batch(done)

    return in_order.mapInArrow(run, RESULT)


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet")))
