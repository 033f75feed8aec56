"""Hard negatives by threshold joins with an inverted index, in the manner of L2AP.

An anchor's positives are its nearest rows of its own label; a negative is a row of another
label whose score lies in a window below a positive's.  Both are threshold joins: all rows
that score at least ``t`` with an anchor, with ``t`` lowered until the windows are full or
their lower ends are reached.

Index.  Rows are dealt to blocks by a hash of their id.  In a block, dimensions come in
order of their weight, in groups.  A row is listed under a group only while the norm of
what it holds from there on, times the anchor's norm, could reach the threshold: by
Cauchy-Schwarz, what is left out cannot, so a row that is never listed is no candidate.
Partial scores add up list by list.  A pair goes on only while its partial score plus the
product of what remains of both norms reaches ``t``; the survivors' scores are completed
exactly.  Lower thresholds build longer lists from the same order.

Scale.  Anchors are a stated share of the rows and meet each block once; a block holds a
bounded number of rows, and anchors pass it in batches of bounded size.  A cell gives at
most the first few of each window, so no anchor, label or vector gathers more than that
from a block, and no pair of rows is listed that scores below its threshold.

Odd rows.  Rows with a null id, label or vector, or a component that is null, not finite or
beyond ``LIMIT``, take no part.  Of rows with one id the least by label and vector takes part, so
repeated rows count once.  Ties go to the smaller id.  Vectors of different lengths are
filled up with zeros.  An empty table gives an empty result; further columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wordweave.shared import save

ANCHOR_EVERY = 100
RELABEL_EVERY = 7
LABELS = 10
N_POSITIVES = 5
N_NEGATIVES = 10
SCALE = 256
# A negative scores from 30 to 90 hundredths of the positive.
LOWEST, HIGHEST, WHOLE = 30, 90, 100

# Rows of a block, anchors that pass it at once, dimensions of a group of lists.
BLOCK_ROWS = 8192
BATCH = 128
GROUP = 8

# Pairs completed at once.
PAIRS = 1 << 14

# Thresholds as shares of the largest score the norms allow, before the lower ends of the windows.
LEVELS = (0.85, 0.65, 0.5, 0.38, 0.28, 0.2, 0.14)

# Components beyond this are taken for damage like those that are not finite.
LIMIT = 1e100

# Up to here, sums of products are exact in double precision.
EXACT = 2.0**53


@dataclass
class Pairs:
    """Anchors and rows by their places in a batch and a block, with exact scores."""

    anchors: np.ndarray
    rows: np.ndarray
    scores: np.ndarray


class Index:
    """The rows of a block, in lists by groups of dimensions."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels = ids, labels
        self.order = np.argsort(-np.abs(vectors).sum(axis=0), kind="stable")
        self.vectors = vectors[:, self.order]
        self.starts = list(range(0, max(1, vectors.shape[1]), GROUP))
        self.left = self._norms(self.vectors)
        self.largest = float(np.abs(vectors).max(initial=0))

    def _norms(self, vectors: np.ndarray) -> np.ndarray:
        """Norms of what vectors hold from the start of each group on, rounded up."""
        squares = np.square(vectors).astype(np.float64)
        tails = np.cumsum(squares[:, ::-1], axis=1)[:, ::-1]
        at_starts = tails[:, self.starts] if vectors.shape[1] else np.zeros((len(vectors), 1))
        # The last column is what is left after all groups.
        return np.hstack([np.sqrt(at_starts) * (1 + 1e-9), np.zeros((len(vectors), 1))])

    def in_order(self, anchors: np.ndarray) -> np.ndarray:
        """Anchors with this index's dimensions in its order."""
        width = len(self.order)
        fitted = np.zeros((len(anchors), width))
        shared = min(width, anchors.shape[1])
        fitted[:, :shared] = anchors[:, :shared]
        return fitted[:, self.order]

    def reaching(self, anchors: np.ndarray, least: np.ndarray) -> Iterator[Pairs]:
        """All pairs that score at least ``least`` of their anchor, in pieces of bounded size."""
        norms = self._norms(anchors)
        whole = norms[:, 0]
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(least > 0, least / whole, -np.inf)
        # An anchor of zeros scores nothing above zero.
        lowest = np.min(np.where((whole == 0) & (least > 0), np.inf, ratio), initial=np.inf)
        # The first group that a row is not listed under any more.
        listed = (self.left[:, :-1] >= lowest).sum(axis=1) if lowest > 0 else np.full(len(self.ids), len(self.starts))
        by_lists = np.argsort(-listed, kind="stable")
        listed = listed[by_lists]
        rows = by_lists[: int((listed > 0).sum())] if lowest > 0 else by_lists
        if not len(rows):
            return
        vectors, left = self.vectors[rows], self.left[rows]
        listed = listed[: len(rows)]
        partial = np.zeros((len(anchors), len(rows)))
        for group, start in enumerate(self.starts):
            of_group = int((listed > group).sum())
            if not of_group:
                break
            dims = slice(start, start + GROUP)
            partial[:, :of_group] += anchors[:, dims] @ vectors[:of_group, dims].T
        # What remains of a row and an anchor after the row's last list.
        remains = left[np.arange(len(rows)), listed]
        possible = partial + norms[:, listed] * remains >= (least - 1e-6 * np.maximum(1, np.abs(least)))[:, None]
        exact = self.largest * float(np.abs(anchors).max(initial=0)) * max(1, anchors.shape[1]) < EXACT
        anchor_at, row_at = np.nonzero(possible)
        complete = exact and int(listed.min()) == len(self.starts)
        for i in range(0, len(anchor_at), PAIRS):
            a, r = anchor_at[i : i + PAIRS], row_at[i : i + PAIRS]
            if complete:
                scores = partial[a, r]
            elif exact:
                scores = np.einsum("ij,ij->i", anchors[a], vectors[r])
            else:
                scores = (_whole_numbers(anchors[a]) * _whole_numbers(vectors[r])).sum(axis=1)
            found = scores >= least[a]
            yield Pairs(a[found], rows[r[found]], scores[found])


def _whole_numbers(vectors: np.ndarray) -> np.ndarray:
    """Numbers of any size."""
    return np.array([[int(v) for v in row] for row in vectors], dtype=object).reshape(vectors.shape)


@dataclass
class Wanted:
    """An anchor with windows of scores; the first ``n`` rows of each window are wanted."""

    anchor_id: int
    label: int
    vector: np.ndarray
    # (positive_id, positive_score, least, most)
    windows: list[tuple[int | None, int, float, float]]


def first_in_windows(index: Index, wanted: list[Wanted], own_label: bool, n: int) -> Iterator[tuple]:
    """``(anchor_id, positive_id, positive_score, row_id, score)`` of the first ``n`` of every window.

    Thresholds go down level by level; an anchor whose windows are full, or whose lowest
    end is reached, drops out.
    """
    if not len(index.ids):
        return
    width = max(len(w.vector) for w in wanted)
    anchors = index.in_order(np.array([np.pad(w.vector, (0, width - len(w.vector))) for w in wanted], dtype=np.float64))
    lowest = np.array([min(least for _, _, least, _ in w.windows) for w in wanted])
    highest = np.array([max(most for _, _, _, most in w.windows) for w in wanted])
    norms = np.sqrt(np.square(anchors).sum(axis=1)) * np.max(index.left[:, 0], initial=0)
    at, labels = np.array([w.anchor_id for w in wanted]), np.array([w.label for w in wanted])
    open_ = np.arange(len(wanted))
    for level in (*LEVELS, None):
        least = lowest[open_] if level is None else np.maximum(norms[open_] * level, lowest[open_])
        # Above its highest window an anchor has nothing to look for.
        now = open_[least <= highest[open_]]
        if not len(now):
            continue
        least = least[np.isin(open_, now)]
        pieces = []
        for found in index.reaching(anchors[now], least):
            of = now[found.anchors]
            same = index.labels[found.rows] == labels[of]
            keep = (same & (index.ids[found.rows] != at[of])) if own_label else ~same
            keep &= found.scores <= highest[of]
            pieces.append(Pairs(of[keep], found.rows[keep], found.scores[keep]))
        of = np.concatenate([p.anchors for p in pieces]) if pieces else np.zeros(0, dtype=int)
        rows = np.concatenate([p.rows for p in pieces]) if pieces else np.zeros(0, dtype=int)
        scores = np.concatenate([p.scores for p in pieces]) if pieces else np.zeros(0)
        order = np.lexsort((index.ids[rows], -scores, of))
        of, rows, scores = of[order], rows[order], scores[order]
        still = []
        for place, reached in zip(now, least, strict=True):
            lo, hi = np.searchsorted(of, [place, place + 1])
            down = -scores[lo:hi]
            firsts = []
            for positive_id, positive_score, low, high in wanted[place].windows:
                first = int(np.searchsorted(down, -high, "left"))
                end = min(first + n, int(np.searchsorted(down, -max(low, reached), "right")))
                firsts.append((positive_id, positive_score, first, end, end - first < n and low < reached))
            if any(short for *_, short in firsts):
                still.append(place)
                continue
            for positive_id, positive_score, first, end, _ in firsts:
                for i in range(lo + first, lo + end):
                    yield wanted[place].anchor_id, positive_id, positive_score, int(index.ids[rows[i]]), int(scores[i])
        # Those above their windows so far wait for the next level.
        open_ = np.concatenate([np.array(still, dtype=int), open_[~np.isin(open_, now)]])
        if not len(open_):
            return


def vectors(embeddings: DataFrame) -> DataFrame:
    """``(vec_id, label, vector)``: the rows that take part, with whole components and one row an id."""
    scaled = F.transform("embedding", lambda x: x.cast("double") * F.lit(float(SCALE)))
    usable = F.forall("scaled", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(LIMIT)))
    label = F.col("label").cast("bigint")
    changed = F.when(F.col("vec_id") % RELABEL_EVERY == 0, (label + 1) % LABELS).otherwise(label)
    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), changed.alias("label"), scaled.alias("scaled"))
    kept = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("scaled").isNotNull() & F.coalesce(usable, F.lit(False)))
    one = kept.groupBy("vec_id").agg(F.min(F.struct("label", "scaled")).alias("row"))
    return one.select("vec_id", "row.label", F.col("row.scaled").alias("vector"))


def _meet(rows: DataFrame, anchors: DataFrame, n_blocks: int, own_label: bool, n: int) -> DataFrame:
    """The first rows of each window of ``anchors``, block by block."""
    block = F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)).cast("int")
    none = F.lit(None).cast("array<struct<positive_id:bigint,positive_score:bigint>>")
    left = rows.select(block.alias("block"), F.lit(0).alias("side"), "vec_id", "label", "vector", none.alias("positives"))
    blocks = F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))
    right = anchors.select(blocks.alias("block"), F.lit(1).alias("side"), "vec_id", "label", "vector", "positives")
    dealt = left.unionByName(right).repartition("block").sortWithinPartitions("block", "side", "vec_id")
    schema = "anchor_id bigint, positive_id bigint, positive_score bigint, row_id bigint, score bigint"
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        wanted: list[Wanted] = []
        index: Index | None = None
        now: int | None = None

        def ask() -> Iterator[pa.RecordBatch]:
            nonlocal wanted
            found = list(first_in_windows(index, wanted, own_label, n)) if wanted and index is not None else []
            wanted = []
            if found:
                columns = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

        for batch in batches:
            for block_no, side, vec_id, label, vector, positives in zip(*(_column(c) for c in batch.columns), strict=True):
                if block_no != now:
                    yield from ask()
                    held, index, now = [], None, block_no
                whole = np.floor(vector)
                if side == 0:
                    held.append((vec_id, label, whole))
                    continue
                if index is None:
                    index = _index(held)
                    held = []
                wanted.append(Wanted(vec_id, label, whole, _windows(positives)))
                if len(wanted) >= BATCH:
                    yield from ask()
        yield from ask()

    return dealt.mapInArrow(run, schema)


def _column(column: pa.Array) -> Iterator:
    """Values of a column; lists of numbers as arrays."""
    if pa.types.is_list(column.type) and pa.types.is_floating(column.type.value_type):
        numbers, ends = column.flatten().to_numpy(), np.cumsum(column.value_lengths().to_numpy())
        return iter(np.split(numbers, ends[:-1]) if len(ends) else [])
    return iter(column.to_pylist())


def _index(held: list[tuple]) -> Index:
    width = max((len(v) for *_, v in held), default=0)
    rows = np.zeros((len(held), width))
    for i, (_, _, v) in enumerate(held):
        rows[i, : len(v)] = v
    return Index(np.array([h[0] for h in held], dtype=np.int64), np.array([h[1] for h in held], dtype=np.int64), rows)


def _windows(positives: list[dict] | None) -> list[tuple[int | None, int, float, float]]:
    """Windows of negatives below positives; without positives one window for all scores."""
    if positives is None:
        return [(None, 0, -np.inf, np.inf)]
    found = []
    for p in positives:
        score = p["positive_score"]
        # The least and the greatest whole score within the window.
        found.append((p["positive_id"], score, float(-(-LOWEST * score // WHOLE)), float(HIGHEST * score // WHOLE)))
    return found


def _first(found: DataFrame, by: list[str], n: int) -> DataFrame:
    place = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc("row_id"))
    return found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= n)


def hard_negatives(embeddings: DataFrame, is_anchor: Column) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``."""
    rows = save(vectors(embeddings), "vectors")
    n_blocks = max(1, -(-rows.count() // BLOCK_ROWS))
    anchors = rows.where(is_anchor)
    none = F.lit(None).cast("array<struct<positive_id:bigint,positive_score:bigint>>")
    nearest = _meet(rows, anchors.withColumn("positives", none), n_blocks, True, N_POSITIVES)
    positives = _first(nearest, ["anchor_id"], N_POSITIVES).select(
        "anchor_id", F.struct(F.col("row_id").alias("positive_id"), F.col("score").alias("positive_score")).alias("positive")
    )
    lists = positives.where(F.col("positive.positive_score") >= 0).groupBy("anchor_id").agg(F.sort_array(F.collect_list("positive")).alias("positives"))
    with_lists = save(anchors.join(lists.withColumnRenamed("anchor_id", "vec_id"), "vec_id"), "positives")
    found = _meet(rows, with_lists, n_blocks, False, N_NEGATIVES)
    return _first(found, ["anchor_id", "positive_id"], N_NEGATIVES).select(
        "anchor_id",
        "positive_id",
        F.col("rank").cast("int").alias("rank"),
        F.col("row_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return hard_negatives(embeddings, F.col("vec_id") % ANCHOR_EVERY == 0)


OP13_SQL = f"""WITH vectors AS (
  SELECT vec_id, CASE WHEN vec_id % {RELABEL_EVERY} = 0 THEN (label + 1) % {LABELS} ELSE label END AS label,
         list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS row_id, a.label = b.label AS same,
         CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id WHERE a.vec_id % {ANCHOR_EVERY} = 0
),
positives AS (
  SELECT anchor_id, row_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, row_id) <= {N_POSITIVES}
)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.row_id) AS INTEGER) AS rank,
       s.row_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id
WHERE NOT s.same AND {WHOLE} * s.score BETWEEN {LOWEST} * p.positive_score AND {HIGHEST} * p.positive_score
QUALIFY rank <= {N_NEGATIVES}"""
