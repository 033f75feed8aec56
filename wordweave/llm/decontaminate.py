"""Benchmark decontamination by templates, with DataFrame functions only.

Numbers, names and units become typed placeholders, so a question whose values were
changed has the same template.  Windows of five template words are joined by hash.  A
document is contaminated by an item when it holds at least ``MIN_COVERAGE`` of the item's
windows and the values in the placeholders correspond: one value of the item stands for
one value of the document throughout.  A window may occur at several places; the values
correspond if they do in any alignment of item and document.

A name is a capitalised word that follows a lower-case letter, a comma or a semicolon.
Other capitalised words, as at the beginning of a sentence, may be names: windows that
hold one are made in both readings.  Signs before a number are words of their own, those of
money placeholders.  An item with fewer words than a window is one window of its own and is
looked up in windows of its length; if all its words are placeholders, a longer document
holds it with the same values only.  Null and empty texts have no windows.  Repeated
rows give repeated results; other columns play no part.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wordweave.llm.common import free_name
from wordweave.shared import save

WINDOW = 5
MIN_COVERAGE = 0.5
MIN_CONSISTENT = 0.8
# Runs whose offsets differ by so many words at most are near each other.
BAND = 16
# Item windows up to this number (24 bytes each) are broadcast; more are joined by a shuffle.
MAX_BROADCAST_WINDOWS = 1_000_000

# Units of measurement and money.
UNITS = "km kg cm mm ml mg km/h mph kwh kw hz ghz mhz gb mb tb lb lbs oz ft mi min h s m g l % € $ £ °c °f usd eur dollars euros miles metres meters hours minutes seconds days weeks months years kilograms grams litres liters percent"
# What is dropped from the words of a template.
MARKS = ".,;:!?\"“”„()[]{}…"

_SLOT = "\u0001"


# A row's identity without nulls, so that plain equi-joins find it.
_ROW = ["doc_no", "no_id", "text_hash"]
_PAIR = [*_ROW, "item_id"]
_ALIGNED = [*_PAIR, "anchor", "rule"]


def _merged(found: DataFrame) -> DataFrame:
    """What was found grows with the documents, so it is joined by a shuffle, never broadcast."""
    return found.hint("merge")


def _row_key() -> list[Column]:
    doc_id = F.col("doc_id")
    return [
        F.coalesce(doc_id, F.lit(0)).alias("doc_no"),
        doc_id.isNull().alias("no_id"),
        F.xxhash64("text").alias("text_hash"),
    ]


def _unit_pattern() -> str:
    names = sorted(UNITS.split(), key=lambda u: (-len(u), u))
    return "|".join("".join(f"\\{c}" if not c.isalnum() and c.isascii() else c for c in u) for u in names)


_NUMBER = r"\p{Nd}+(?:[.,]\p{Nd}+)*"
_WITH_UNIT = rf"({_NUMBER})\s?((?i:{_unit_pattern()}))(?![\p{{L}}\p{{Nd}}])"
_BARE_NUMBER = rf"(?<![{_SLOT}n\p{{Nd}}.,])({_NUMBER})"
_NAME = r"\p{Lu}(?<=[\p{Ll},;]\s\p{Lu})\p{L}*"
_PERHAPS_NAME = r"(^|\s)([.,;:!?\"“”„()\[\]{}…]*)(\p{Lu}\p{Ll}\p{L}*)"
_MONEY = r"([$€£])(?=\p{Nd})"
_SIGNS = r"([-−–+±=≈~<>≤≥*×÷^#]+)(?=[$€£]?\p{Nd})"


def marked_words(text: str) -> Column:
    """Words, lower-case and without marks; a placeholder is ``\\1n``, ``\\1u`` or ``\\1p`` and its value,
    ``\\1i`` a word that may be a name."""
    clean = F.translate(F.coalesce(F.col(text), F.lit("")), _SLOT, " ")
    # A dot or comma inside a number is no mark.
    names = F.regexp_replace(clean, _NAME, f"{_SLOT}p$0")
    names = F.regexp_replace(names, _PERHAPS_NAME, f"$1$2{_SLOT}i$3")
    signs = F.regexp_replace(F.regexp_replace(names, _SIGNS, " $1 "), _MONEY, f" {_SLOT}u$1 ")
    units = F.regexp_replace(signs, _WITH_UNIT, f"{_SLOT}n$1 {_SLOT}u$2")
    numbers = F.regexp_replace(units, _BARE_NUMBER, f"{_SLOT}n$1")
    has_digit = F.regexp_like(clean, F.lit(r"\p{Nd}"))
    marked = F.lower(F.when(has_digit, numbers).otherwise(names))
    return F.array_remove(F.split(F.translate(marked, MARKS, ""), r"\s+"), "")


def _hashed(words: Column) -> Column:
    """Per word the hashes of its readings (``plain``, ``named``) and of its value, and whether it is
    a placeholder (0), a word (1) or a word that may be a name (2)."""
    named = F.xxhash64(F.lit(f"{_SLOT}p"))

    def fields(plain: Column, named: Column, value: Column, kind: int) -> Column:
        return F.struct(plain.alias("plain"), named.alias("named"), value.alias("value"), F.lit(kind).alias("kind"))

    def one(w: Column) -> Column:
        value, typed, word = F.xxhash64(w), F.xxhash64(F.left(w, F.lit(2))), F.xxhash64(F.substring(w, 3, 1 << 30))
        kinds = F.when(~F.startswith(w, F.lit(_SLOT)), fields(value, value, value, 1))
        return kinds.when(F.startswith(w, F.lit(f"{_SLOT}i")), fields(word, named, value, 2)).otherwise(fields(typed, typed, value, 0))

    return F.transform(words, one)


def windows(texts: DataFrame, keys: list[str], window: int = WINDOW, lengths: list[int] | None = None) -> DataFrame:
    """``(*keys, n_windows, width, pos, window)`` for every window of every text.

    Windows have ``width`` words: each of ``lengths``, by default ``window`` or the whole
    of a shorter text; none is wider than ``window``.
    """
    # Explode of a one-entry array: the words are made once, however often they are used.
    words = texts.select(*keys, F.explode(F.array(_hashed(marked_words("text")))).alias("words")).where(F.size("words") > 0)
    size = F.size("words")
    # Each word beside those that follow it, so hashes of windows are compiled expressions.
    names = [f"w{i}" for i in range(window)]
    beside = F.arrays_zip(*[F.slice("words", i + 1, size).alias(name) for i, name in enumerate(names)])
    words = words.select(*keys, size.alias("size"), F.explode(F.array(beside)).alias("beside"))
    placed = words.select(*keys, "size", F.posexplode("beside").alias("pos", "at"))
    found = []
    for width in lengths or range(1, window + 1):
        plain, named, value = (F.xxhash64(*[F.col(f"at.{n}.{field}") for n in names[:width]]) for field in ("plain", "named", "value"))
        kinds = reduce(Column.bitwiseOR, [F.col(f"at.{n}.kind") for n in names[:width]])
        if width == window or lengths:
            fits = F.col("pos") + width <= F.col("size")
        else:
            fits = (F.col("pos") == 0) & (F.col("size") == width)
        # The reading as names, where it differs and a word is left.
        second = F.when(kinds == 3, named)
        if width < window:
            # A short window of placeholders alone stands for its values; if it is the whole text, also for its template.
            second = F.when((kinds == 0) & (F.col("size") == width), plain).otherwise(second)
            plain = F.when(kinds == 0, value).otherwise(plain)
        found += [F.struct(F.lit(width).alias("width"), F.when(fits, hashed).alias("window")) for hashed in (plain, second)]
    rows = placed.select(*keys, "size", "pos", F.explode(F.array(*found)).alias("found")).where("found.window is not null")
    return rows.select(*keys, (F.col("size") - F.col("found.width") + 1).alias("n_windows"), "found.width", "pos", "found.window")


def _values(texts: DataFrame, keys: list[str], name: str) -> DataFrame:
    """``(*keys, {name}_at, {name}, {name}_perhaps)`` for every placeholder, in both readings."""
    marked = texts.select(*keys, F.posexplode(marked_words("text")).alias(f"{name}_at", "word")).where(F.startswith("word", F.lit(_SLOT)))
    perhaps = F.startswith("word", F.lit(f"{_SLOT}i"))
    value = F.when(perhaps, F.concat(F.lit(f"{_SLOT}p"), F.substring("word", 3, 1 << 30))).otherwise(F.col("word"))
    return marked.select(*keys, f"{name}_at", value.alias(name), perhaps.alias(f"{name}_perhaps"))


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """``(doc_id, text_hash, item_id, n_matched, n_windows, n_slots, n_consistent)`` per document and item."""
    rows = docs.select(*_row_key(), "text")
    items = benchmark.select("item_id", "text").where(F.col("item_id").isNotNull())
    index = save(windows(items, ["item_id"], window).withColumnRenamed("pos", "item_pos"), "benchmark-windows")
    lengths = sorted({window, *(r["width"] for r in index.select("width").distinct().collect())})
    lookup = F.broadcast(index) if index.count() <= MAX_BROADCAST_WINDOWS else index
    hits = _hits(rows, lookup, window, lengths)
    matched = hits.select(*_PAIR, "n_windows", "width", "item_pos").distinct()
    matched = matched.groupBy(*_PAIR, "n_windows", "width").agg(F.count("*").alias("n_matched"))
    covered = save(matched.where(F.col("n_matched") >= F.ceil(F.col("n_windows") * F.lit(min_coverage))), "covered-items")
    # Rows that repeat each other are read once.
    wanted = rows.join(covered.select(*_ROW).distinct(), _ROW, "left_semi").groupBy(*_ROW).agg(F.any_value("text").alias("text"))
    wanted = save(wanted, "covered-documents")
    places = _alignments(_hits(wanted, lookup, window, lengths).join(_merged(covered.select(*_PAIR)), _PAIR, "left_semi"))
    # Of a pair's alignments the one with the largest part of consistent slots.
    part = F.col("n_consistent") / F.col("n_slots")
    best = _slots(places, covered, wanted, items).groupBy(*_PAIR).agg(
        F.max(F.struct(part, F.col("n_slots"), F.col("n_consistent"))).alias("best")
    )
    checked = covered.join(_merged(best), _PAIR, "left").select(
        F.when(~F.col("no_id"), F.col("doc_no")).alias("doc_id"),
        "text_hash",
        "item_id",
        "n_matched",
        "n_windows",
        F.coalesce("best.n_slots", F.lit(0)).alias("n_slots"),
        F.coalesce("best.n_consistent", F.lit(0)).alias("n_consistent"),
    )
    return checked.where(F.col("n_consistent") >= F.ceil(F.col("n_slots") * F.lit(MIN_CONSISTENT)))


def _hits(rows: DataFrame, lookup: DataFrame, window: int, lengths: list[int]) -> DataFrame:
    """``(*_PAIR, n_windows, width, item_pos, pos)`` for every place where a row holds a window of an item."""
    found = windows(rows, _ROW, window, lengths).drop("n_windows").join(lookup, ["window", "width"])
    return found.select(*_PAIR, "n_windows", "width", "item_pos", "pos")


def _alignments(hits: DataFrame) -> DataFrame:
    """``(*_PAIR, anchor, rule, item_pos, pos)``: one place per matched item window in each alignment.

    Windows that follow each other in item and document make a run; its offset is
    ``pos - item_pos``.  Every offset of a pair anchors two alignments: each window goes
    to its longest run near the anchor (rule 0) or to its nearest (rule 1), and without
    a run there to its longest run anywhere, so insertions are allowed.
    """
    offsets = hits.select(*_PAIR, "item_pos", (F.col("pos") - F.col("item_pos")).alias("off")).distinct()
    order = Window.partitionBy(*_PAIR, "off").orderBy("item_pos")
    islands = offsets.withColumn("island", F.col("item_pos") - F.row_number().over(order))
    runs = save(
        islands.groupBy(*_PAIR, "off", "island").agg(F.min("item_pos").alias("first"), F.count("*").alias("length")).drop("island"), "aligned-runs"
    )
    anchors = runs.select(*_PAIR, F.col("off").alias("anchor")).distinct()
    covers = F.explode(F.expr("sequence(first, int(first + length - 1))")).alias("item_pos")
    longest = runs.select(*_PAIR, "off", "length", covers).groupBy(*_PAIR, "item_pos").agg(F.max(F.struct("length", -F.col("off"), "off")).alias("run"))
    anywhere = longest.join(_merged(anchors), _PAIR).select(*_PAIR, "anchor", "item_pos", F.lit(0).alias("near"), "run.off", "run.length")
    band = F.floor(F.col("off") / BAND)
    around = F.explode(F.array(*[F.floor(F.col("anchor") / BAND) + i for i in (-1, 0, 1)])).alias("band")
    near = runs.withColumn("band", band).join(_merged(anchors.select("*", around)), [*_PAIR, "band"])
    near = near.where(F.abs(F.col("off") - F.col("anchor")) <= BAND).select(*_PAIR, "anchor", covers, F.lit(1).alias("near"), "off", "length")
    closeness = -F.abs(F.col("off") - F.col("anchor"))
    first, second = (F.when(F.col("rule") == 0, a).otherwise(b) for a, b in ((F.col("length"), closeness), (closeness, F.col("length"))))
    rules = F.explode(F.array(F.lit(0), F.lit(1))).alias("rule")
    choices = near.unionByName(anywhere).select("*", rules).groupBy(*_PAIR, "anchor", "rule", "item_pos")
    chosen = choices.agg(F.max(F.struct("near", first.alias("first"), second.alias("second"), "off")).alias("run"))
    return chosen.select(*_PAIR, "anchor", "rule", "item_pos", (F.col("item_pos") + F.col("run.off")).alias("pos"))


def _slots(places: DataFrame, covered: DataFrame, wanted: DataFrame, items: DataFrame) -> DataFrame:
    """Per alignment the number of placeholders in matched windows and of those whose values correspond."""
    inside = F.explode(F.expr("sequence(0, width - 1)")).alias("step")
    aligned = places.join(_merged(covered.select(*_PAIR, "width")), _PAIR).select(*_ALIGNED, "item_pos", "pos", inside)
    item_at, doc_at = ((F.col(at) + F.col("step")).alias(name) for at, name in (("item_pos", "item_at"), ("pos", "doc_at")))
    item_values = _values(items.join(covered.select("item_id").distinct(), "item_id", "left_semi"), ["item_id"], "item")
    aligned = aligned.select(*_ALIGNED, item_at, doc_at).distinct().join(item_values, ["item_id", "item_at"])
    doc_values = _values(wanted, _ROW, "doc")
    # Equal words that may be names are no sign of a correspondence.
    same_word = F.col("item_perhaps") & F.col("doc_perhaps") & (F.col("item") == F.col("doc"))
    matched = aligned.join(_merged(doc_values), [*_ROW, "doc_at"]).where(~same_word).select(*_ALIGNED, "item", "doc")
    counts = matched.groupBy(*_ALIGNED, "item", "doc").agg(F.count("*").alias("n"))
    # A value of the item corresponds to the document's value it meets most often.
    best = counts.groupBy(*_ALIGNED, "item").agg(F.sum("n").alias("n"), F.max(F.struct("n", "doc")).alias("top"))
    # And no two values of the item to one value of the document.
    single = best.groupBy(*_ALIGNED, F.col("top.doc").alias("doc")).agg(F.sum("n").alias("n"), F.max("top.n").alias("kept"))
    return single.groupBy(*_ALIGNED).agg(F.sum("n").alias("n_slots"), F.sum("kept").alias("n_consistent"))


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns of any name, that no benchmark item contaminates."""
    hit = save(contaminated(docs, benchmark).select("doc_id", "text_hash").distinct(), "contaminated")
    hit_id, hit_hash = (free_name(docs, name) for name in ("hit_id", "hit_hash"))
    hit = hit.withColumnsRenamed({"doc_id": hit_id, "text_hash": hit_hash})
    same = docs["doc_id"].eqNullSafe(F.col(hit_id)) & (F.xxhash64(docs["text"]) == F.col(hit_hash))
    return docs.join(hit, same, "left_anti")


def op10_decontaminate(spark, sf_dir):
    found = contaminated(
        spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"),
        spark.read.parquet(f"{sf_dir}/benchmark.parquet"),
    )
    return found.select("doc_id", "item_id", "n_matched", "n_windows", "n_slots", "n_consistent")
