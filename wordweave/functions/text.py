"""Tokenizers, line splitting and line keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The delimiters of mode ``delim``; line ends also delimit.
DELIMITERS = " .,?!\"'()[]$*-_;:|"
# Characters a token is stripped of at both ends.
BLANKS = "".join(chr(code) for code in range(0x21))

_DELIM_RUN = "[" + "".join(f"\\{c}" if c in "[]-" else c for c in DELIMITERS) + r"\r\n]+"
_NOT_ALNUM_RUN = r"[^a-z0-9]+"

# Keys of lines leave room for this many lines in a document.
LINES_PER_DOCUMENT = 1_000_000

TOKENIZERS = ("alnum", "delim")


def unstripped_words(text: Column | str, mode: str) -> Column:
    """Lower-case tokens of a text as an array, each still to be :func:`stripped`."""
    if mode not in TOKENIZERS:
        raise ValueError(f"unknown tokenizer {mode!r}, expected one of {TOKENIZERS}")
    return F.split(F.lower(text), _NOT_ALNUM_RUN if mode == "alnum" else _DELIM_RUN)


def stripped(word: Column | str, mode: str) -> Column:
    """A token without the blanks that its tokenizer strips; the result may be empty.

    Stripped after the split: one pass over a text, whatever runs of blanks it holds.
    """
    return F.btrim(word, F.lit(BLANKS)) if mode == "delim" else F.col(word) if isinstance(word, str) else word


def words(text: Column | str, mode: str) -> Column:
    """Lower-case tokens of a text as an array; may hold empty strings.

    ``delim`` splits on the fixed delimiters and line ends and strips blanks from
    each token; ``alnum`` splits on everything but ``a-z`` and ``0-9``.
    """
    split = unstripped_words(text, mode)
    return split if mode == "alnum" else F.transform(split, lambda w: stripped(w, mode))


def text_lines(text: str) -> Column:
    """Lines of a text as an array; a line end that closes the text opens no new line."""
    raw = F.col(text)
    unified = F.when(F.contains(raw, F.lit("\r")), F.regexp_replace(raw, r"\r\n?", "\n")).otherwise(raw)
    closed = F.when(F.endswith(unified, F.lit("\n")), F.substr(unified, F.lit(1), F.length(unified) - 1))
    return F.when(F.length(raw) > 0, F.split(F.coalesce(closed, unified), "\n", -1))


def line_key(doc_id: Column, line_no: Column, lines_per_document: int = LINES_PER_DOCUMENT) -> Column:
    """Pack ``(doc_id, line_no)`` into one bigint that sorts the same way."""
    packed = doc_id.cast("bigint") * F.lit(lines_per_document) + line_no
    too_long = F.raise_error(
        F.concat(F.lit("document "), doc_id.cast("string"), F.lit(" has more lines than its key range"))
    )
    return F.when(line_no < lines_per_document, packed).otherwise(too_long.cast("bigint"))
