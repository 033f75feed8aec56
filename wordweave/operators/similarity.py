"""Set-similarity self-join with a prefix filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordweave.functions.threshold import Threshold, jaccard, shared_words, unordered_pairs
from wordweave.operators.terms import metric
from wordweave.shared import hot_share, save

# A word with more postings than this is split into blocks that meet block by block.
BLOCK_POSTINGS = 4096

# Words that are split at most: 200,000 rows of two bigints, 3 MB to broadcast.
MAX_HOT_WORDS = 200_000

# Columns of a set's signature, 64 bits each.
SIGNATURE = ("bits0", "bits1")

# Copies of one set from which on its lines are not left to a plain shuffle.
HOT_COPIES = 100_000

# A broadcast of sets holds at most this many sets of at most this many words: 8 MB.
MAX_BROADCAST_SETS = 1000
MAX_BROADCAST_SET = 1024

# A set with more copies than this is split into blocks when its pairs are listed.
BLOCK_MEMBERS = 256


def _parity_bits(part: int) -> Column:
    """One part of the signature: each bit is the parity of the words of ``ids`` that hash to it.

    Every word hashes to one bit of one part.
    """
    flip = f"if(pmod(xxhash64(word), {len(SIGNATURE)}) = {part}, shiftleft(1L, int(hash(word) & 63)), 0L)"
    return F.expr(f"aggregate(ids, 0L, (bits, word) -> bits ^ {flip})")


def distinct_sets(id_sets: DataFrame) -> DataFrame:
    """``(set_id, ids, len, n_lines, bits0, bits1)``: equal line sets collapsed to one row.

    ``set_id`` is the smallest line key of the copies.  Any number of copies is
    folded on the map side, so a hot text costs one row per task.  The bits are a
    signature: two sets differ in at least as many words as their signatures in bits.
    """
    collapsed = id_sets.groupBy("ids").agg(F.min("key").alias("set_id"), F.count("*").alias("n_lines"))
    signature = [_parity_bits(part).alias(bits) for part, bits in enumerate(SIGNATURE)]
    return collapsed.select("set_id", "ids", F.size("ids").cast("bigint").alias("len"), "n_lines", *signature)


def set_members(id_sets: DataFrame, sets: DataFrame, hot_copies: int = HOT_COPIES) -> DataFrame:
    """``(set_id, n_lines, key)`` for the lines of sets that occur more than once.

    Where a set has more than ``hot_copies`` copies, the sets with the most copies,
    bounded in number and length, find their lines by broadcast, so that the copies do
    not meet in one task; the rest is shuffled.
    """
    repeated = sets.where(F.col("n_lines") > 1).select("ids", "set_id", "n_lines")
    hot = repeated.where((F.col("n_lines") > hot_copies) & (F.size("ids") <= MAX_BROADCAST_SET))
    if hot.isEmpty():
        return id_sets.join(repeated, "ids").select("set_id", "n_lines", "key")
    hot = hot.where(hot_share("n_lines", hot.agg(F.sum("n_lines")).first()[0], MAX_BROADCAST_SETS))
    of_hot = id_sets.join(F.broadcast(hot), "ids")
    rest = repeated.join(F.broadcast(hot.select("set_id")), "set_id", "left_anti")
    of_rest = id_sets.join(F.broadcast(hot.select("ids")), "ids", "left_anti").join(rest, "ids")
    return of_hot.unionByName(of_rest).select("set_id", "n_lines", "key")


def _postings(sets: DataFrame, prefix: Column) -> DataFrame:
    words = F.posexplode(F.slice("ids", F.lit(1), prefix)).alias("pos", "word_id")
    return sets.select("set_id", "len", *SIGNATURE, words)


def _block(key: str, n_blocks: str) -> Column:
    return F.pmod(F.xxhash64(key), F.col(n_blocks)).cast("int")


def _blocks(n_rows: str, size: int) -> Column:
    return F.expr(f"({n_rows} + {size - 1}) div {size}")


def _meet_in_blocks(index: DataFrame, probe: DataFrame, hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Give hot words a grid of blocks; each index-probe pair shares exactly one cell."""
    every_block = F.explode(F.sequence(F.lit(0), F.coalesce("n_blocks", F.lit(1)).cast("int") - 1))
    own_block = F.coalesce(_block("set_id", "n_blocks"), F.lit(0))
    index, probe = (
        side.join(F.broadcast(hot), "word_id", "left").withColumn("own", own_block).withColumn("other", every_block)
        for side in (index, probe)
    )
    return (
        index.withColumnsRenamed({"own": "i_block", "other": "p_block"}).drop("n_blocks"),
        probe.withColumnsRenamed({"own": "p_block", "other": "i_block"}).drop("n_blocks"),
    )


def hot_prefix_words(probe: DataFrame, block: int = BLOCK_POSTINGS) -> DataFrame:
    """``(word_id, n_blocks)`` for the words with more than ``block`` postings.

    At most ``MAX_HOT_WORDS``, so that the table can be broadcast: those with at least
    that share of the postings of all such words; others are too small to need splitting.
    """
    sizes = probe.groupBy("word_id").agg(F.count("*").alias("n_postings"))
    over = save(sizes.where(F.col("n_postings") > block), "long-postings")
    hottest = over.where(hot_share("n_postings", over.agg(F.sum("n_postings")).first()[0], MAX_HOT_WORDS))
    return hottest.select("word_id", _blocks("n_postings", block).alias("n_blocks"))


def candidate_pairs(
    sets: DataFrame, threshold: Threshold, max_postings: int | None = None, block: int = BLOCK_POSTINGS, whole: bool = False
) -> DataFrame:
    """Distinct ``(short_id, long_id)`` that may be similar; none that is similar is missing.

    The shorter set of a pair (by length, then id) looks up its index prefix, the
    longer one its probe prefix.  Lengths, the words left behind the shared word and
    the signatures must still allow the threshold.  ``max_postings`` is a known limit
    on the postings of one word, if there is one; at or below ``block`` no word needs
    splitting.  With ``whole`` there is no prefix filter: every two sets that share a word
    meet under each word they share, and only lengths and signatures are looked at.
    """
    index = _postings(sets, F.col("len") if whole else threshold.index_prefix("len"))
    probe = _postings(sets, F.col("len") if whole else threshold.probe_prefix("len"))
    on = ["word_id"]
    if max_postings is None or max_postings > block:
        hot = save(hot_prefix_words(probe, block), "hot-words")
        if not hot.isEmpty():
            index, probe = _meet_in_blocks(index, probe, hot)
            on += ["i_block", "p_block"]
    # Both sides are exploded, so the size of the stored table says nothing about a broadcast.
    pairs = index.alias("s").join(probe.alias("l").hint("merge"), _may_be_similar(on, threshold, whole))
    return pairs.select(F.col("s.set_id").alias("short_id"), F.col("l.set_id").alias("long_id")).distinct()


def _may_be_similar(on: list[str], threshold: Threshold, whole: bool) -> list[Column]:
    """Join condition between index postings ``s`` and probe postings ``l``."""
    s_len, l_len = F.col("s.len"), F.col("l.len")
    total = s_len + l_len
    left_over = F.least(s_len - F.col("s.pos"), l_len - F.col("l.pos"))
    differing = sum(F.bit_count(F.col(f"s.{bits}").bitwiseXOR(F.col(f"l.{bits}"))) for bits in SIGNATURE)
    return [
        *[F.col(f"s.{c}") == F.col(f"l.{c}") for c in on],
        (s_len < l_len) | ((s_len == l_len) & (F.col("s.set_id") < F.col("l.set_id"))),
        threshold.lengths_suffice(s_len, l_len),
        *([] if whole else [threshold.overlap_suffices(left_over, total)]),
        # Twice the overlap is the total length less the words that differ.
        threshold.overlap_suffices(total - differing, total * 2),
    ]


def score_pairs(pairs: DataFrame, sets: DataFrame, left: str, right: str) -> DataFrame:
    """Score a table of pairs against a ``(set_id, ids)`` table: adds ``inter`` and ``uni``.

    Where the table has ``n_lines``, ``n_left`` and ``n_right`` come from the same look-up.
    Pairs with an id the table does not hold are dropped.
    """
    lookup = sets.select("set_id", "ids", *[c for c in sets.columns if c == "n_lines"])
    paired = pairs.join(lookup.withColumnsRenamed({"set_id": left, "ids": "left_ids", "n_lines": "n_left"}), left).join(
        lookup.withColumnsRenamed({"set_id": right, "ids": "right_ids", "n_lines": "n_right"}), right
    )
    # Explode of a one-entry array: the intersection is taken once, however often it is used.
    inter = F.explode(F.array(shared_words(F.col("left_ids"), F.col("right_ids"))))
    return (
        paired.withColumn("inter", inter)
        .withColumn("uni", F.size("left_ids") + F.size("right_ids") - F.col("inter"))
        .drop("left_ids", "right_ids")
    )


def similar_sets(
    sets: DataFrame,
    threshold: Threshold,
    max_postings: int | None = None,
    block: int = BLOCK_POSTINGS,
    whole: bool = False,
    scan: DataFrame | None = None,
) -> DataFrame:
    """``(set_lo, set_hi, inter, uni, similarity)`` for all similar pairs of different sets.

    Sets with ``n_lines`` give ``n_lo`` and ``n_hi`` as well.  ``whole`` leaves out the
    prefix filter, as in :func:`candidate_pairs`.  ``scan`` is the same table for the pass
    that takes the postings, where ``sets`` are in buckets.
    """
    candidates = candidate_pairs(scan or sets, threshold, max_postings, block, whole)
    scored = score_pairs(candidates, sets, "short_id", "long_id")
    similar = scored.where(threshold.similarity_suffices(F.col("inter"), F.col("uni")))
    in_order = F.col("short_id") < F.col("long_id")
    copies = [
        F.when(in_order, first).otherwise(F.col(second)).alias(name)
        for first, second, name in ((F.col("n_left"), "n_right", "n_lo"), (F.col("n_right"), "n_left", "n_hi"))
        if "n_lines" in sets.columns
    ]
    return similar.select(
        F.least("short_id", "long_id").alias("set_lo"),
        F.greatest("short_id", "long_id").alias("set_hi"),
        "inter",
        "uni",
        jaccard(F.col("inter"), F.col("uni")).alias("similarity"),
        *copies,
    )


def similar_groups(similar: DataFrame, sets: DataFrame, threshold: Threshold) -> DataFrame:
    """All similar line pairs without listing them: ``(set_lo, set_hi, similarity, n_lo, n_hi)``.

    A row stands for ``n_lo * n_hi`` line pairs, or with ``set_lo = set_hi`` for the
    ``n * (n - 1) / 2`` pairs among ``n`` equal lines.  Its size does not grow with
    the square of the copies.  ``similar`` has the numbers of lines (:func:`similar_sets`).
    """
    repeated = sets.select("set_id", "n_lines").where(F.col("n_lines") > 1)
    columns = ["set_lo", "set_hi", "similarity", "n_lo", "n_hi"]
    across = similar.select(columns)
    if not threshold.admits_equal_sets:
        return across
    n = F.col("n_lines")
    within = repeated.select(
        F.col("set_id").alias("set_lo"),
        F.col("set_id").alias("set_hi"),
        F.lit(1.0).alias("similarity"),
        n.alias("n_lo"),
        n.alias("n_hi"),
    )
    return across.unionByName(within)


def set_texts(sets: DataFrame, vocab: DataFrame) -> DataFrame:
    """``(set_id, text)``: the words of each set, rarest first, joined by spaces."""
    spelled = sets.select("set_id", F.explode("ids").alias("word_id")).join(vocab.select("word_id", "tok"), "word_id")
    ordered = F.sort_array(F.collect_list(F.struct("word_id", "tok")))
    return spelled.groupBy("set_id").agg(F.array_join(F.transform(ordered, lambda w: w["tok"]), " ").alias("text"))


def with_texts(groups: DataFrame, sets: DataFrame, vocab: DataFrame) -> DataFrame:
    """Add ``text_lo`` and ``text_hi`` to :func:`similar_groups`."""
    ids = groups.select(F.explode(F.array("set_lo", "set_hi")).alias("set_id")).distinct()
    texts = set_texts(sets.join(ids, "set_id", "left_semi"), vocab)
    for side in ("lo", "hi"):
        groups = groups.join(texts.withColumnsRenamed({"set_id": f"set_{side}", "text": f"text_{side}"}), f"set_{side}")
    return groups


def line_links(groups: DataFrame, sets: DataFrame, members: DataFrame) -> DataFrame:
    """``(key, set_id, n_links)``: each line with its set and the number of lines similar to it.

    Says how often a line is matched without listing the pairs of :func:`similar_groups`.
    """
    same = F.col("set_lo") == F.col("set_hi")
    lo = F.struct(F.col("set_lo").alias("set_id"), F.when(same, F.col("n_lo") - 1).otherwise(F.col("n_hi")).alias("n"))
    hi = F.struct(F.col("set_hi").alias("set_id"), F.when(same, 0).otherwise(F.col("n_lo")).alias("n"))
    links = groups.select(F.explode(F.array(lo, hi)).alias("side")).groupBy("side.set_id").agg(F.sum("side.n").alias("n_links"))
    single = sets.where(F.col("n_lines") == 1).select("set_id", F.col("set_id").alias("key"))
    lines = single.unionByName(members.select("set_id", "key"))
    return lines.join(links, "set_id", "left").select("key", "set_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))


def line_pairs(groups: DataFrame, members: DataFrame, block: int = BLOCK_MEMBERS) -> DataFrame:
    """List every line pair of :func:`similar_groups` as ``(lo, hi, similarity)``.

    The result holds each pair of equal lines, so it grows with the square of the
    copies.  Copies are split into blocks that meet in cells: a task gets cells of at
    most ``block * block`` pairs and no group whole.  Further columns of ``groups``
    named ``*_lo`` and ``*_hi`` follow the keys they belong to.
    """
    carried = sorted(c[:-3] for c in groups.columns if c.endswith("_lo") and c not in ("set_lo", "n_lo"))
    own = groups.withColumn("lo_blocks", _blocks("n_lo", block)).withColumn("hi_blocks", _blocks("n_hi", block))
    cells = own.withColumn("lo_block", F.explode(F.expr("sequence(0, int(lo_blocks) - 1)"))).withColumn(
        "hi_block", F.explode(F.expr("sequence(if(set_lo = set_hi, lo_block, 0), int(hi_blocks) - 1)"))
    )
    blocked = members.withColumn("n_blocks", _blocks("n_lines", block)).select(
        "set_id", _block("key", "n_blocks").alias("block"), "key"
    )
    for side in ("lo", "hi"):
        lines = blocked.withColumnsRenamed({"set_id": f"set_{side}", "block": f"{side}_block", "key": f"key_{side}"})
        # A set that occurs once has no member rows; its id is the key of its only line.
        # For other sets a cell without a key is a block that no copy fell into.
        cells = cells.join(lines, [f"set_{side}", f"{side}_block"], "left").where(
            (F.col(f"n_{side}") == 1) | F.col(f"key_{side}").isNotNull()
        )
    a = F.coalesce("key_lo", "set_lo")
    b = F.coalesce("key_hi", "set_hi")
    one_cell = (F.col("set_lo") == F.col("set_hi")) & (F.col("lo_block") == F.col("hi_block"))
    pairs = cells.where(~one_cell | (F.col("key_lo") < F.col("key_hi")))
    in_order = a < b
    texts = []
    for name in carried:
        first, second = F.col(f"{name}_lo"), F.col(f"{name}_hi")
        texts.append(F.when(in_order, first).otherwise(second).alias(f"{name}_lo"))
        texts.append(F.when(in_order, second).otherwise(first).alias(f"{name}_hi"))
    return pairs.select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi"), "similarity", *texts)


def prefix_comparisons(sets: DataFrame, threshold: Threshold) -> DataFrame:
    """Number of pairs that share a prefix word, counted once per shared word, as a metric row."""
    prefix = F.slice("ids", F.lit(1), threshold.prefix_length("len"))
    sizes = sets.select(F.explode(prefix).alias("word_id"), "n_lines").groupBy("word_id").agg(F.sum("n_lines").alias("c"))
    return metric("comparisons", sizes, F.sum(unordered_pairs("c")), "decimal(38,0)")
