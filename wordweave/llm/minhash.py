"""Near-duplicates by one-permutation hashing with optimal densification.

A document's set holds its distinct shingles of ``size`` words.  Equal word sequences
are collapsed first.  One hash of each shingle fills ``BANDS * ROWS`` bins; an empty bin
copies the first filled bin of its own fixed random order.  Bands of bins are buckets.
A bucket does not emit its pairs but a star: its members against two centres, the member
that shares buckets with the most others and the one with the least hash.  Stars are
compared by their sketches first, eight bits of every bin; texts are only fetched for those
whose sketches agree in nearly as many bins as the threshold asks for.  They are confirmed
on the full sets and connected.

Where other members of a bucket are in different components still, they are written as their
differences from the centre: shingles that a member has and the centre lacks, and the other
way round.  Two members that are both linked to the centre are connected.  Any other linked
pair shares so many differences that it meets in the rarest ones, as in a prefix filter; so
copies of one text, edited in different places, don't meet though they share most of their
text.  Members far from the centre meet in their rarest shingles instead.  So every pair of a
bucket is compared, known to be connected, or proven to be below the threshold, and the work
grows with the differences and not with the pairs.

A near-duplicate pair at the threshold is missed by all buckets with probability 3e-6, and
by the sketches where they err by six standard deviations; no other link is lost.

Null and empty texts have empty sets and link to nothing; a text of fewer than ``size``
words has its whole sequence as its only shingle.  Rows with equal ids are documents of
their own.  A null ``doc_id`` is never the smallest of a component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordweave.llm.common import free_name, map_rows, utf8
from wordweave.llm.components import components
from wordweave.shared import save

BANDS = 42
ROWS = 6
# A power of two; the bins beyond the bands serve the sketch alone.
BINS = 256
SEED = 1
DEVIATIONS = 6
# Hashes of confirmed classes that a task remembers.
REMEMBERED = 8 << 20


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    orders = np.stack([rng.permutation(BINS) for _ in range(BINS)])
    marks = rng.integers(1, 2**63, BINS, dtype=np.uint64)
    starts = (np.arange(BINS, dtype=np.uint64) << np.uint64(32)) * np.uint64(2**32 // BINS)
    return orders, marks, starts


ORDERS, MARKS, STARTS = _tables()


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads 64-bit hashes."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class Shingler:
    """Sorted distinct shingle hashes of texts; word hashes are remembered in a bounded table."""

    def __init__(self, size: int):
        self.size = size
        self.known: dict[bytes, int] = {}

    def hashes(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > 500_000:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        span = min(self.size, len(words))
        if not span:
            return h
        total = np.zeros(len(words) - span + 1, np.uint64)
        for k in range(span):
            total = mixed(total + h[k : len(words) - span + 1 + k] + np.uint64(k + 1))
        return np.unique(total + np.uint64(span))


def signature(hashes: np.ndarray) -> np.ndarray:
    """The least hash of each bin, empty bins filled by densification."""
    first = np.searchsorted(hashes, STARTS)
    values = hashes[np.minimum(first, len(hashes) - 1)]
    filled = (first < len(hashes)) & (values >> np.uint64(64 - BINS.bit_length() + 1) == np.arange(BINS, dtype=np.uint64))
    if not filled.all():
        empty = np.flatnonzero(~filled)
        donors = ORDERS[empty]
        values[empty] = values[donors[np.arange(len(empty)), filled[donors].argmax(1)]]
    return values


def sketch(hashes: np.ndarray) -> bytes | None:
    """Eight bits of every bin; ``ROWS`` bytes after the other are a bucket's key.

    The bits depend on the bin, so what densification copies agrees no more often by chance.
    """
    return mixed(signature(hashes) ^ MARKS).view(np.uint8)[::8].tobytes() if len(hashes) else None


def least_agreement(threshold: int) -> int:
    """Bins in which the sketches of two sets at the threshold agree, less ``DEVIATIONS`` standard deviations."""
    share = threshold / 100
    return int(BINS * share - DEVIATIONS * (BINS * share * (1 - share)) ** 0.5)


def fingerprints(docs: DataFrame, size: int) -> DataFrame:
    """``(doc_id, text_hash, class, n_shingles, sketch)``; ``class`` is null for empty sets."""

    def start():
        shingler = Shingler(size)

        def one(row: dict) -> list[tuple]:
            words = row["raw"].lower().split()
            hashes = shingler.hashes(words)
            same = hashlib.blake2b(b" ".join(words), digest_size=16).digest() if words else None
            return [(row["doc_id"], row["text_hash"], same, len(hashes), sketch(hashes))]

        return one

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), utf8().alias("raw"))
    return map_rows(rows, "doc_id long, text_hash long, class binary, n_shingles long, sketch binary", start)


def bucket_members(classes: DataFrame) -> DataFrame:
    """``(bucket, cid, n_shingles, label, n)`` for the buckets with ``n > 1`` classes."""
    band = F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("band")
    key = F.xxhash64("band", F.substring("sketch", F.col("band") * ROWS + 1, F.lit(ROWS))).alias("bucket")
    # Two numbers a row: this is the largest shuffle.
    placed = classes.select("cid", "sketch", band).select("cid", key)
    sizes = placed.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    return save(placed.join(sizes, "bucket").join(classes.select("cid", "n_shingles", "label"), "cid"), "shared-buckets")


def first_centres(members: DataFrame) -> DataFrame:
    """``(bucket, main, c)``: the member that shares buckets with the most others and the one with the least hash.

    ``main`` is the class of the first of them.
    """
    popular = members.groupBy("cid").agg(F.sum("n").alias("popularity"))
    member = F.struct("cid", "n_shingles", "label")
    centres = members.join(popular, "cid").groupBy("bucket").agg(
        F.max(F.struct("popularity", F.xxhash64("cid"), member.alias("m"))).alias("most"),
        F.min(F.struct(F.xxhash64("cid"), member.alias("m"))).alias("least"),
    )
    both = F.array_distinct(F.array("most.m", "least.m"))
    return save(centres.select("bucket", F.col("most.m.cid").alias("main"), F.explode(both).alias("c")), "centres")


def star_pairs(members: DataFrame, centres: DataFrame, threshold: int) -> DataFrame:
    """Distinct ``(a, b)`` of classes to compare: members of each bucket against its centres in other components."""
    pairs = members.select("bucket", "cid", "n_shingles", "label").join(centres, "bucket")
    close = F.least("n_shingles", "c.n_shingles") * 100 >= F.greatest("n_shingles", "c.n_shingles") * threshold
    pairs = pairs.where((F.col("cid") != F.col("c.cid")) & (F.col("label") != F.col("c.label")) & close)
    return pairs.select(F.least("cid", "c.cid").alias("a"), F.greatest("cid", "c.cid").alias("b")).distinct()


def alike(pairs: DataFrame, sketches: DataFrame, threshold: int) -> DataFrame:
    """The ``(a, b)`` whose sketches don't rule the threshold out; ``sketches`` has ``cid, sketch``."""
    for side in ("a", "b"):
        pairs = pairs.join(sketches.withColumnsRenamed({"cid": side, "sketch": f"sketch_{side}"}), side)
    least = least_agreement(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch[f"sketch_{side}"].to_pylist()), np.uint8).reshape(-1, BINS) for side in ("a", "b"))
            yield batch.select(["a", "b"]).filter(pa.array((x == y).sum(1) >= least))

    return pairs.select("a", "b", "sketch_a", "sketch_b").mapInArrow(run, "a long, b long")


def untested(members: DataFrame, centres: DataFrame, labels: DataFrame) -> DataFrame:
    """``(bucket, main, cid, label)``: members that were no centre, of buckets where such members are in more than one component."""
    were = centres.select("bucket", F.col("c.cid").alias("cid"))
    # A bucket of two has no pair without a centre.
    left = members.where("n > 2").join(were, ["bucket", "cid"], "left_anti")
    return open_buckets(left.join(centres.select("bucket", "main").distinct(), "bucket"), labels)


def open_buckets(members: DataFrame, labels: DataFrame) -> DataFrame:
    """The members, newly labelled, of buckets that hold more than one component."""
    found = labels.select(F.col("node").alias("cid"), F.col("label").alias("found"))
    left = members.join(found, "cid", "left").select("bucket", "main", "cid", F.coalesce("found", "label").alias("label"))
    left = save(left, "left-members")
    spans = left.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
    return save(left.join(spans.where("lo != hi").select("bucket"), "bucket", "left_semi"), "open-buckets")


def joined_labels(labels: DataFrame | None, links: DataFrame, nodes: DataFrame) -> DataFrame:
    """``labels`` (``node, label, root``) after more links: only the components that they touch are visited."""
    if labels is None:
        return components(links, nodes)
    roots = labels.select("node", "root")
    for side in ("a", "b"):
        root = roots.withColumnsRenamed({"node": side, "root": "to"})
        links = links.join(root, side, "left").withColumn(side, F.coalesce("to", side)).drop("to")
    moved = components(links.distinct(), nodes)
    after = moved.select(F.col("node").alias("root"), F.col("label").alias("label_after"), F.col("root").alias("root_after"))
    known = labels.join(after, "root", "left").select(
        "node", F.coalesce("label_after", "label").alias("label"), F.coalesce("root_after", "root").alias("root")
    )
    return save(known.unionByName(moved.join(labels.select("node"), "node", "left_anti")), "joined-labels")


def _with_texts(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    for side in ("a", "b"):
        # Texts are never broadcast, so the plan is the same at every size.
        pairs = pairs.join(texts.withColumnsRenamed({"cid": side, "raw": f"raw_{side}"}).hint("merge"), side)
    return pairs.select("a", "b", "raw_a", "raw_b")


class _Sets:
    """Shingles of the classes of a row; what was seen is remembered, as centres come again and again."""

    def __init__(self, size: int):
        self.shingler = Shingler(size)
        self.known: dict[int, np.ndarray] = {}
        self.held = 0

    def __call__(self, row: dict, side: str) -> np.ndarray:
        known, cid = self.known, row[side]
        if cid not in known:
            if self.held > REMEMBERED:
                known.clear()
                self.held = 0
            known[cid] = self.shingler.hashes(row[f"raw_{side}"].lower().split())
            self.held += len(known[cid])
        return known[cid]


def confirmed(pairs: DataFrame, texts: DataFrame, size: int, threshold: int) -> DataFrame:
    """The ``(a, b)`` whose full sets reach ``threshold`` percent; ``texts`` has ``cid, raw``."""

    def start():
        hashes = _Sets(size)

        def one(row: dict) -> list[tuple]:
            x, y = hashes(row, "a"), hashes(row, "b")
            inter = len(np.intersect1d(x, y, assume_unique=True))
            return [(row["a"], row["b"])] if 100 * inter >= threshold * (len(x) + len(y) - inter) else []

        return one

    return map_rows(_with_texts(pairs, texts), "a long, b long", start)


ITEMS = "centre long, cid long, inserted long, deleted long, slack long, least long, items array<long>"


def differences(pairs: DataFrame, texts: DataFrame, size: int, threshold: int) -> DataFrame:
    """``(centre, cid, inserted, deleted, slack, least, items, near, far)`` for pairs of a centre ``a`` and a member ``b``.

    A member is near the centre, far from it or both, so that two members at the threshold
    are both near or both far: Jaccard distances keep the triangle inequality.  ``items``
    are the shingles that one of the two has alone, for near members.
    """

    def start():
        hashes = _Sets(size)

        def one(row: dict) -> list[tuple]:
            centre, x = hashes(row, "a"), hashes(row, "b")
            inserted, deleted = (np.setdiff1d(p, q, assume_unique=True) for p, q in ((x, centre), (centre, x)))
            differing, union = len(inserted) + len(deleted), len(centre) + len(inserted)
            near, far = 2 * differing <= union, 100 * differing >= (threshold - 50) * union
            items = np.concatenate([inserted, deleted]).view(np.int64).tolist() if near else []
            slack = (100 - threshold) * len(centre)
            return [(row["a"], row["b"], len(inserted), len(deleted), slack, 1, items, near, far)]

        return one

    return map_rows(_with_texts(pairs, texts), f"{ITEMS}, near boolean, far boolean", start)


def whole_sets(members: DataFrame, texts: DataFrame, size: int, threshold: int) -> DataFrame:
    """The columns of :func:`differences` from an empty centre; ``members`` has ``main, cid``."""

    def start():
        hashes = _Sets(size)

        def one(row: dict) -> list[tuple]:
            x = hashes(row, "b")
            return [(row["main"], row["b"], len(x), 0, 0, -(-threshold * len(x) // 100), x.view(np.int64).tolist())]

        return one

    rows = members.select("main", F.col("cid").alias("b")).join(texts.withColumnsRenamed({"cid": "b", "raw": "raw_b"}).hint("merge"), "b")
    return map_rows(rows.select("main", "b", "raw_b"), ITEMS, start)


def meeting_pairs(rows: DataFrame, labels: DataFrame, threshold: int) -> DataFrame:
    """Distinct ``(a, b)`` of different components that may be linked; ``labels`` has ``cid, label``.

    Members x and y with ``o`` common items are linked if ``(100 + t) * o >= w(x) + w(y) - slack``
    with ``w = t * inserted + 100 * deleted`` and ``slack = (100 - t) * size of the centre``.  If
    both weigh no more than the slack, both are linked to the centre.  Otherwise the heavier
    one is beyond it, which bounds ``o`` from below for either side: they meet in the rarest
    items, of which each side offers all but that many.
    """
    whole = 100 + threshold
    rows = rows.withColumn("n_items", F.col("inserted") + F.col("deleted")).withColumn(
        "weight", F.col("inserted") * threshold + F.col("deleted") * 100
    )
    rows = rows.select(
        "*",
        F.expr(f"n_items - greatest(weight div {whole} + 1, (2 * weight - slack + {whole - 1}) div {whole})").alias("last_index"),
        F.expr(f"if(weight > slack, n_items - greatest((weight - slack + {whole - 1}) div {whole}, least), -1L)").alias("last_probe"),
    )
    items = rows.select("centre", "cid", F.explode("items").alias("item"))
    # Items of one member alone come first in the order and meet nothing.
    shared = items.groupBy("centre", "item").agg(F.count("*").alias("n")).where("n > 1")
    ordered = items.join(shared, ["centre", "item"]).groupBy("centre", "cid").agg(F.sort_array(F.collect_list(F.struct("n", "item"))).alias("shared"))
    placed = rows.drop("items", "least").join(ordered, ["centre", "cid"]).join(labels, "cid")
    # Whoever offers nothing is dropped before its items are listed.
    alone = F.col("n_items") - F.size("shared")
    offered = F.greatest("last_index", "last_probe") - alone + 1
    placed = placed.where(offered > 0).withColumn("alone", alone)
    placed = placed.select(
        "centre", "cid", "label", "weight", "slack", "n_items", "alone", "last_index", "last_probe",
        F.posexplode(F.slice("shared", F.lit(1), offered.cast("int"))).alias("at", "entry"),
    )
    placed = save(placed.select("*", (F.col("at") + F.col("alone")).alias("place"), F.col("entry.item").alias("item")).drop("entry", "at", "alone"), "rare-items")
    y, x = placed.where("place <= last_index").alias("y"), placed.where("place <= last_probe").alias("x")
    rest = F.least(F.col("x.n_items") - F.col("x.place"), F.col("y.n_items") - F.col("y.place"))
    met = x.join(
        y.hint("merge"),
        [
            F.col("x.centre") == F.col("y.centre"),
            F.col("x.item") == F.col("y.item"),
            F.col("x.label") != F.col("y.label"),
            (F.col("y.weight") < F.col("x.weight")) | ((F.col("y.weight") == F.col("x.weight")) & (F.col("y.cid") < F.col("x.cid"))),
            rest * whole >= F.col("x.weight") + F.col("y.weight") - F.col("x.slack"),
        ],
    )
    return met.select(F.least("x.cid", "y.cid").alias("a"), F.greatest("x.cid", "y.cid").alias("b")).distinct()


def class_components(docs: DataFrame, classes: DataFrame, size: int, threshold: int) -> DataFrame:
    """``(node, label, root)`` of the classes that are linked to others.

    Stars first, then the differences from centres, then the members far from them.
    """
    members = bucket_members(classes)
    centres = first_centres(members)
    nodes, sketches = classes.select(F.col("cid").alias("node"), "label"), classes.select("cid", "sketch")
    tested = save(alike(star_pairs(members, centres, threshold), sketches, threshold), "star-pairs")
    links = save(confirmed(tested, _texts(docs, classes, tested), size, threshold), "links")
    labels = joined_labels(None, links, nodes)

    def confirmed_of(rows: DataFrame, left: DataFrame) -> DataFrame:
        pairs = meeting_pairs(rows, left.select("cid", "label").distinct(), threshold)
        pairs = save(pairs.join(tested, ["a", "b"], "left_anti"), "meeting-pairs")
        return save(confirmed(pairs, _texts(docs, classes, pairs), size, threshold), "links")

    left = untested(members, centres, labels)
    if left.isEmpty():
        return labels
    pairs = save(left.select(F.col("main").alias("a"), F.col("cid").alias("b")).distinct(), "centre-pairs")
    apart = save(differences(pairs, _texts(docs, classes, pairs), size, threshold), "differences")
    links = confirmed_of(apart.where("near"), left)
    if not links.isEmpty():
        labels = joined_labels(labels, links, nodes)
    far = apart.where("far").select(F.col("centre").alias("main"), "cid")
    left = open_buckets(left.join(far, ["main", "cid"], "left_semi"), labels)
    if left.isEmpty():
        return labels
    pairs = save(left.select("main", "cid").distinct(), "far-members")
    texts = _texts(docs, classes, pairs.select(F.col("cid").alias("a"), F.col("cid").alias("b")))
    links = confirmed_of(save(whole_sets(pairs, texts, size, threshold), "whole-sets"), left)
    return labels if links.isEmpty() else joined_labels(labels, links, nodes)


def _texts(docs: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """``(cid, raw)`` for the classes of ``pairs``: the text of any document of a class; its first id finds it."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct()
    holders = save(classes.join(wanted, "cid", "left_semi").select("cid", "class", "first_id"), "candidates")
    keyed = docs.select(F.col("doc_id").cast("long"), utf8().alias("raw"))
    same = F.col("doc_id").eqNullSafe(F.col("first_id"))
    return save(_of_class(keyed.join(holders.hint("merge"), same)), "candidate-texts")


def near_duplicates(docs: DataFrame, size: int = 5, threshold: int = 80) -> DataFrame:
    """``(doc_id, text_hash, class, n_shingles, component_id, component)``, one row per document.

    ``component`` tells components apart whose ``component_id`` is null or the same.
    """
    rows = save(fingerprints(docs, size), "fingerprints")
    collapsed = rows.where("class is not null").groupBy("class").agg(
        F.min("doc_id").alias("first_id"), F.any_value("n_shingles").alias("n_shingles"), F.any_value("sketch").alias("sketch")
    )
    # A null id comes last.  Class ids are unique and fixed once the table is written; they
    # tell labels of equal ids apart.
    label = F.struct(F.col("first_id").isNull().alias("no_id"), F.col("first_id").alias("id"), "cid")
    classes = save(collapsed.withColumn("cid", F.monotonically_increasing_id()).withColumn("label", label), "classes")
    labels = class_components(docs, classes, size, threshold)
    found = labels.select(F.col("node").alias("cid"), F.col("label").alias("found"), "root")
    known = classes.join(found, "cid", "left").select(
        "class", F.coalesce("found", "label")["id"].alias("component_id"), F.coalesce("root", "cid").alias("component")
    )
    return rows.select("doc_id", "text_hash", "class", "n_shingles").join(known, "class", "left").select(
        "doc_id",
        "text_hash",
        "class",
        "n_shingles",
        F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        "component",
    )


def _of_class(texts: DataFrame) -> DataFrame:
    """Where an id occurs with several texts, only the text of the class, once for rows that repeat each other."""

    def start():
        # Rows of one id follow each other.
        last: dict = {"doc_id": None, "cids": set()}

        def one(row: dict) -> list[tuple]:
            if row["doc_id"] != last["doc_id"]:
                last.update(doc_id=row["doc_id"], cids=set())
            if row["cid"] in last["cids"]:
                return []
            same = hashlib.blake2b(b" ".join(row["raw"].lower().split()), digest_size=16).digest()
            if same != row["class"]:
                return []
            last["cids"].add(row["cid"])
            return [(row["cid"], row["raw"])]

        return one

    return map_rows(texts.select("doc_id", "cid", "class", "raw"), "cid long, raw binary", start)


def without_near_duplicates(docs: DataFrame, size: int = 5, threshold: int = 80) -> DataFrame:
    """The rows of ``docs``, all columns, with one document of each component.

    Where several texts of a component have its id (a null one, too), the one with the
    least hash stays.  Rows that repeat the id and text of the document that stays are
    that document.  Extra columns of any name are kept.
    """
    found = near_duplicates(docs, size, threshold)
    named = F.col("doc_id").eqNullSafe(F.col("component_id"))
    # Nearly always empty: components with several texts of one id.
    several = found.where(named & F.col("class").isNotNull()).groupBy("component").agg(
        F.min("text_hash").alias("least"), F.max("text_hash").alias("most")
    )
    several = several.where("least != most").select("component", "least")
    others = found.where(named).join(several, "component").where("text_hash != least")
    gone = found.where(~named).select("doc_id", "text_hash").unionByName(others.select("doc_id", "text_hash"))
    gone_id, gone_hash = (free_name(docs, name) for name in ("gone_id", "gone_hash"))
    gone = save(gone.distinct().withColumnsRenamed({"doc_id": gone_id, "text_hash": gone_hash}), "near-duplicates")
    same = docs["doc_id"].eqNullSafe(F.col(gone_id)) & (F.xxhash64(docs["text"]) == F.col(gone_hash))
    return docs.join(gone.hint("merge"), same, "left_anti")


def op3_minhash(spark, sf_dir):
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), size=2)
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return found.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


OP3_SQL = r"""
WITH RECURSIVE bodies AS (
  SELECT doc_id, regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS body
  FROM documents
),
words AS (
  SELECT doc_id, CASE WHEN body = '' THEN [] ELSE regexp_split_to_array(body, '[\x20\x09-\x0D]+') END AS w FROM bodies
),
sequences AS (SELECT w, min(doc_id) AS id FROM words GROUP BY w),
shingles AS (
  SELECT DISTINCT id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS s
  FROM (SELECT id, w, unnest(range(1, greatest(len(w), 2))) AS i FROM sequences WHERE len(w) > 0)
),
sizes AS (SELECT id, count(*) AS n FROM shingles GROUP BY id),
ranked AS (
  SELECT h.id, h.s, z.n, row_number() OVER (PARTITION BY h.id ORDER BY f.n, h.s) AS place
  FROM shingles h JOIN sizes z ON h.id = z.id JOIN (SELECT s, count(*) AS n FROM shingles GROUP BY s) f ON h.s = f.s
),
prefixes AS (SELECT id, s, n FROM ranked WHERE 5 * (place - 1) <= n),
candidates AS (
  SELECT DISTINCT a.id AS a, b.id AS b, a.n AS na, b.n AS nb
  FROM prefixes a JOIN prefixes b ON a.s = b.s AND a.id < b.id AND 5 * a.n >= 4 * b.n AND 5 * b.n >= 4 * a.n
),
links AS (
  SELECT c.a, c.b FROM candidates c JOIN shingles x ON x.id = c.a JOIN shingles y ON y.id = c.b AND y.s = x.s
  GROUP BY c.a, c.b, c.na, c.nb HAVING 100 * count(*) >= 80 * (c.na + c.nb - count(*))
),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT id AS a, id AS b FROM sequences
  UNION
  SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a
),
labels AS (SELECT a AS id, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(z.n, 0) AS n_shingles,
       CASE WHEN len(d.w) = 0 THEN d.doc_id ELSE l.component_id END AS component_id,
       CASE WHEN len(d.w) = 0 THEN true ELSE d.doc_id = l.component_id END AS kept
FROM words d JOIN sequences s ON d.w = s.w JOIN labels l ON l.id = s.id LEFT JOIN sizes z ON z.id = s.id"""
