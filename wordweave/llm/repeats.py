"""Removal of repeated byte strings: every byte that a repeated string of ``LEAST`` bytes covers.

Every window of ``LEAST`` bytes belongs to one anchor: the leftmost least hash among the
half-length grams in it.  Equal windows have equal anchors, so only blocks (the run of
windows of one anchor) with one anchor hash need to meet.

1. Each document emits a row per block: anchor hash, a hash of the whole block, place.
2. A block that occurs twice as a whole is repeated in all its windows.  Such blocks are
   counted, never gathered.
3. A block that occurs once, under an anchor hash that has other blocks, is compared with
   one copy of each of those by a Burrows-Wheeler transform (:mod:`suffixes`).  Groups
   with more than ``HOT`` blocks are not gathered: their windows are hashed and counted.

No join deals all rows of a frequent anchor, block or window to one task (``matching``).

Documents are UTF-8 bytes; null texts are empty.  Rows with equal ids and texts repeat
each other.  Strings are judged on the input and never cross documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordweave.llm.common import map_rows, utf8
from wordweave.llm.minhash import mixed
from wordweave.llm.suffixes import repeated_starts
from wordweave.shared import hot_share, save

LEAST = 400
HOT = 2000
# Bytes of blocks that are transformed together, and those of a task.
BUNDLE = 1 << 20
TASK_BYTES = 4 * BUNDLE
# Keys with at least one row in so many are found by a broadcast of that many at most.
MAX_BROADCAST_KEYS = 10_000

_RNG = np.random.default_rng(7)
BYTE_HASH = _RNG.integers(0, 2**64, 256, dtype=np.uint64)
FACTOR = np.uint64(int(_RNG.integers(0, 2**62)) * 2 + 1)
INVERSE = np.uint64(pow(int(FACTOR), -1, 2**64))


def gram_hashes(raw: bytes, size: int) -> np.ndarray:
    """A rolling hash of every gram of ``size`` bytes."""
    n = len(raw)
    powers = np.cumprod(np.full(n, FACTOR, np.uint64), dtype=np.uint64)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(BYTE_HASH[np.frombuffer(raw, np.uint8)] * powers, dtype=np.uint64)])
    back = np.cumprod(np.full(n - size + 1, INVERSE, np.uint64), dtype=np.uint64)
    return mixed((sums[size:] - sums[:-size]) * back)


def sliding_least(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, from prefix and suffix minima of blocks."""
    n = len(keys)
    full = -(-n // width) * width
    padded = np.full(full, np.iinfo(keys.dtype).max, keys.dtype)
    padded[:n] = keys
    blocks = padded.reshape(-1, width)
    prefix = np.minimum.accumulate(blocks, axis=1).ravel()
    suffix = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(suffix[: n - width + 1], prefix[width - 1 : n])


def blocks_of(raw: bytes, least: int = LEAST) -> list[tuple[int, int, int]]:
    """``(anchor hash, first window, last window)`` for the runs of windows with one anchor."""
    if len(raw) < least:
        return []
    half = least // 2
    hashes = gram_hashes(raw, half)
    # High bits of the hash, then the place: ties go to the left.
    keys = (hashes >> np.uint64(32) << np.uint64(32)) | np.arange(len(hashes), dtype=np.uint64)
    owner = (sliding_least(keys, least - half + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    starts = np.flatnonzero(np.diff(owner, prepend=-1))
    ends = np.append(starts[1:], len(owner)) - 1
    return list(zip(hashes[owner[starts]].view(np.int64).tolist(), starts.tolist(), ends.tolist(), strict=True))


def _row_key() -> list:
    doc_id = F.col("doc_id").cast("long")
    return [F.coalesce(doc_id, F.lit(0)).alias("doc_no"), doc_id.isNull().alias("no_id"), F.xxhash64("text").alias("text_hash")]


_ROW = ["doc_no", "no_id", "text_hash"]


def matching(rows: DataFrame, keys: DataFrame, on: list[str], n: str) -> DataFrame:
    """``rows`` with the columns of their key in ``keys``, each once, of which ``rows`` has ``n``.

    Rows of frequent keys stay where they are; only the others meet by key.
    """
    hot = hot_share(n, rows.count(), MAX_BROADCAST_KEYS)
    frequent = F.broadcast(keys.where(hot))
    others = rows.join(F.broadcast(keys.where(hot).select(*on)), on, "left_anti")
    return rows.join(frequent, on).unionByName(others.join(keys.where(~hot), on))


def document_blocks(docs: DataFrame, least: int) -> DataFrame:
    def start():
        def one(row: dict) -> list[tuple]:
            raw, key = row["raw"], [row[c] for c in _ROW]
            return [(*key, h, xxhash.xxh3_64_intdigest(raw[a : b + least]) - (1 << 63), a, b) for h, a, b in blocks_of(raw, least)]

        return one

    schema = "doc_no long, no_id boolean, text_hash long, anchor long, block long, first int, last int"
    return map_rows(docs.select(*_row_key(), utf8().alias("raw")), schema, start)


def _contents(docs: DataFrame, wanted: DataFrame, least: int) -> DataFrame:
    """``(anchor, block, raw)`` of the wanted blocks."""
    lists = wanted.groupBy(*_ROW).agg(F.collect_list(F.struct("anchor", "block", "first", "last")).alias("blocks"))
    texts = docs.select(*_row_key(), utf8().alias("raw")).join(lists.hint("merge"), _ROW)

    def start():
        return lambda r: [(b["anchor"], b["block"], r["raw"][b["first"] : b["last"] + least]) for b in r["blocks"]]

    # Rows that repeat each other give a block twice.
    return map_rows(texts.select("raw", "blocks"), "anchor long, block long, raw binary", start).dropDuplicates(["anchor", "block"])


def _runs(starts: np.ndarray) -> list[tuple[int, int]]:
    cuts = np.flatnonzero(np.diff(starts) > 1)
    first = np.concatenate([starts[:1], starts[cuts + 1]])
    last = np.concatenate([starts[cuts], starts[-1:]])
    return list(zip(first.tolist(), last.tolist(), strict=True))


def _compared(blocks: DataFrame, least: int) -> DataFrame:
    """``(anchor, block, from, to)``: runs of windows that repeat among the blocks of one anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[tuple[int, int]] = []
        strings: list[bytes] = []
        size = 0

        def compare() -> pa.RecordBatch:
            rows = [(*k, a, b) for k, starts in zip(keys, repeated_starts(strings, least), strict=True) if len(starts) for a, b in _runs(starts)]
            columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["anchor", "block", "from", "to"])

        for batch in batches:
            for anchor, block, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                # Blocks of one anchor follow each other and stay together.
                if size >= BUNDLE and anchor != keys[-1][0]:
                    yield compare()
                    keys, strings, size = [], [], 0
                keys.append((anchor, block))
                strings.append(raw)
                size += len(raw)
        if keys:
            yield compare()

    # By what a task compares: compressed, the blocks of all tasks would pass for those of a few.
    size = blocks.agg(F.sum(F.length("raw"))).first()[0] or 0
    n_tasks = max(int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // TASK_BYTES))
    together = blocks.select("anchor", "block", "raw").repartition(n_tasks, "anchor").sortWithinPartitions("anchor")
    return together.mapInArrow(run, "anchor long, block long, `from` int, `to` int")


def _counted(blocks: DataFrame, least: int) -> DataFrame:
    """The same for anchors with many blocks: windows are hashed and counted, no group is gathered."""

    def start():
        def one(row: dict) -> list[tuple]:
            raw = row["raw"]
            windows = range(len(raw) - least + 1)
            return [(row["anchor"], row["block"], i, xxhash.xxh3_128_digest(raw[i : i + least])) for i in windows]

        return one

    windows = map_rows(blocks.select("anchor", "block", "raw"), "anchor long, block long, `from` int, window binary", start)
    windows = save(windows, "hot-windows")
    repeated = save(windows.groupBy("window").agg(F.count("*").alias("n")).where("n > 1"), "repeated-windows")
    return matching(windows, repeated, ["window"], "n").select("anchor", "block", "from", F.col("from").alias("to"))


def repeated_spans(docs: DataFrame, least: int = LEAST, hot: int = HOT) -> DataFrame:
    """Rows' keys and ``from, to``: runs of window starts that are repeated."""
    blocks = save(document_blocks(docs, least), "blocks")
    anchors = save(blocks.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1"), "shared-anchors")
    shared = save(matching(blocks, anchors, ["anchor"], "n").drop("n"), "shared-blocks")
    where = F.struct(*_ROW, "first", "last")
    counts = save(shared.groupBy("anchor", "block").agg(F.count("*").alias("copies"), F.min(where).alias("at")), "block-counts")
    whole = counts.where("copies > 1").select("anchor", "block", "copies")
    spans = matching(shared, whole, ["anchor", "block"], "copies").select(*_ROW, F.col("first").alias("from"), F.col("last").alias("to"))
    # Anchors with a block that occurs once, among others.
    mixed_anchors = counts.groupBy("anchor").agg(F.count("*").alias("n_blocks"), F.min("copies").alias("fewest"))
    mixed_anchors = save(mixed_anchors.where("n_blocks > 1 and fewest = 1").select("anchor", "n_blocks"), "mixed-anchors")
    open_blocks = save(matching(counts, mixed_anchors, ["anchor"], "n_blocks").select("anchor", "block", "n_blocks", "copies", "at.*"), "open-blocks")
    contents = save(_contents(docs, open_blocks, least).join(open_blocks.select("anchor", "block", "n_blocks"), ["anchor", "block"]), "open-contents")
    inside = _compared(contents.where(F.col("n_blocks") <= hot), least).unionByName(_counted(contents.where(F.col("n_blocks") > hot), least))
    single = open_blocks.where("copies = 1").select("anchor", "block", *_ROW, "first")
    found = inside.join(single, ["anchor", "block"]).select(*_ROW, (F.col("first") + F.col("from")).alias("from"), (F.col("first") + F.col("to")).alias("to"))
    return spans.unionByName(found)


def removed(n: int, runs: list[tuple[int, int]], least: int) -> list[tuple[int, int]]:
    """Maximal runs of covered bytes, ends exclusive."""
    out: list[list[int]] = []
    for a, b in sorted(runs):
        end = min(n, b + least)
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([a, end])
    return [(a, b) for a, b in out]


def without_repeats(docs: DataFrame, least: int = LEAST, hot: int = HOT) -> DataFrame:
    """``(doc_id, n_bytes, removed, kept)``: spans removed and the bytes that remain."""
    lists = repeated_spans(docs, least, hot).distinct().groupBy(*_ROW).agg(F.collect_list(F.struct("from", "to")).alias("runs"))
    lists = save(lists, "repeated-runs")
    rows = docs.select(*_row_key(), utf8().alias("raw")).join(lists.hint("merge"), _ROW, "left")

    def start():
        def one(row: dict) -> list[tuple]:
            raw = row["raw"]
            cuts = removed(len(raw), [(r["from"], r["to"]) for r in row["runs"] or ()], least)
            at, kept = 0, []
            for a, b in cuts:
                kept.append(raw[at:a])
                at = b
            kept.append(raw[at:])
            return [(None if row["no_id"] else row["doc_no"], len(raw), [{"from": a, "to": b} for a, b in cuts], b"".join(kept))]

        return one

    return map_rows(rows, "doc_id long, n_bytes long, removed array<struct<`from`: int, `to`: int>>, kept binary", start)


def op4_suffix_dedup(spark, sf_dir):
    found = without_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return found.select(
        "doc_id",
        "n_bytes",
        F.coalesce(F.expr("aggregate(removed, 0L, (a, r) -> a + r.`to` - r.`from`)"), F.lit(0)).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def brute_force(texts: list[bytes], least: int) -> list[list[tuple[int, int]]]:
    """Removed spans by counting every window, for tests."""
    counts: dict[bytes, int] = {}
    for t in texts:
        for i in range(len(t) - least + 1):
            w = hashlib.blake2b(t[i : i + least], digest_size=16).digest()
            counts[w] = counts.get(w, 0) + 1
    out = []
    for t in texts:
        starts = [i for i in range(len(t) - least + 1) if counts[hashlib.blake2b(t[i : i + least], digest_size=16).digest()] > 1]
        out.append(removed(len(t), [(i, i) for i in starts], least))
    return out
