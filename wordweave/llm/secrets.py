"""Secret scans: known shapes, and random strings by their token efficiency.

Text that people write costs few tokens a character under a byte-pair vocabulary;
random strings cost many.  A candidate is a run of key characters.  Known digests
(hexadecimal of a digest's length), UUIDs and identifiers (words and numbers joined by
``_``, ``-`` or ``/``) are no secrets; of the rest, those with a letter and a digit and
less than ``MAX_RATIO`` characters a token are reported as ``random``.  Where the whole
run isn't, its parts between separators are tried by themselves, so that a key behind a
path of words is found; a part of letters alone, or of one shape of a word, has to stay
below ``MAX_LETTER_RATIO``, which words of no language in the corpus do.

Null texts count as empty; rows that repeat each other, and null ids, are scanned each by
itself; an empty table has no rows; other columns play no part.  Spans are in code points of the whole text, the end
exclusive.  Long runs are encoded in blocks, so that a run of any length takes time in
proportion to it.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from collections.abc import Callable, Iterable
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordweave.llm.common import map_rows, text_or_empty

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

# Shapes of the base scan, with the least length of what must match.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
LEAST = {"assign": 12, "access": 18, "hex": 16}

# Lengths of hexadecimal digests, and how a byte-pair vocabulary splits text.
DIGEST_LENGTHS = (32, 40, 48, 56, 64, 96, 128)
PIECES = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

MIN_RANDOM = 16
MAX_RATIO = 2.2
MAX_LETTER_RATIO = 1.7
BLOCK = 256

RUN = re.compile(rf"[A-Za-z0-9+/_-]{{{MIN_RANDOM},}}={{0,2}}", re.ASCII)
PART = re.compile(rf"[A-Za-z0-9]{{{MIN_RANDOM},}}", re.ASCII)
UUID = re.compile(r"[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}", re.IGNORECASE | re.ASCII)
IDENTIFIER = re.compile(r"([A-Z]?[a-z]+|[A-Z]+|[0-9]+)([_/=-]+([A-Z]?[a-z]+|[A-Z]+|[0-9]{1,8}))*", re.ASCII)
_DIGIT = re.compile(r"[0-9]", re.ASCII)
_LETTER = re.compile(r"[A-Za-z]", re.ASCII)
_HEX_ONLY = re.compile(r"[0-9a-f]+|[0-9A-F]+", re.ASCII)

Span = tuple[int, int, int]


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Callable[[str], int]:
    """Number of tokens of a string; the vocabulary is loaded once a process."""
    import tiktoken

    lines = (line.split() for line in Path(path).read_bytes().splitlines() if line.strip())
    ranks = {base64.b64decode(piece): int(rank) for piece, rank in lines}
    encoding = tiktoken.Encoding(Path(path).name, pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})
    return lambda s: len(encoding.encode_ordinary(s))


def base_spans(text: str) -> list[Span]:
    """``(start, kind, end)`` with the kind as its place in ``KINDS``, in order."""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def is_known(run: str) -> bool:
    """Whether a run is a digest or a UUID."""
    body = run.strip("=/+_-")
    return bool(_HEX_ONLY.fullmatch(body) and len(body) in DIGEST_LENGTHS or UUID.fullmatch(body))


def is_identifier(run: str) -> bool:
    return bool(IDENTIFIER.fullmatch(run.strip("=/+_-")))


def ratio(run: str, count: Callable[[str], int]) -> float:
    """Characters a token."""
    return len(run) / max(1, sum(count(run[i : i + BLOCK]) for i in range(0, len(run), BLOCK)))


def is_mixed(run: str) -> bool:
    """Whether a run has letters and digits in no identifier's shape."""
    return bool(_DIGIT.search(run) and _LETTER.search(run)) and not is_identifier(run)


def random_spans(text: str, count: Callable[[str], int], max_ratio: float = MAX_RATIO) -> list[Span]:
    """Spans of random strings, of kind ``len(KINDS)``."""
    found = []
    for m in RUN.finditer(text):
        run = m[0]
        if is_known(run):
            continue
        if is_mixed(run) and ratio(run, count) < max_ratio:
            found.append((m.start(), len(KINDS), m.end()))
            continue
        for part in PART.finditer(run):
            least = max_ratio if is_mixed(part[0]) else min(max_ratio, MAX_LETTER_RATIO)
            if _LETTER.search(part[0]) and not is_known(part[0]) and ratio(part[0], count) < least:
                found.append((m.start() + part.start(), len(KINDS), m.start() + part.end()))
    return found


def rendered(spans: Iterable[Span]) -> str:
    names = (*KINDS, "random")
    return ",".join(f"{names[kind]}:{start}:{end}" for start, kind, end in spans)


def scan(docs: DataFrame, vocabulary: str = VOCABULARY, max_ratio: float = MAX_RATIO) -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans)``, one row per document."""

    def start():
        count = encoder(vocabulary)

        def one(row: dict) -> list[tuple]:
            text = row["text"]
            base = base_spans(text)
            more = random_spans(text, count, max_ratio)
            kinds = [kind for _, kind, _ in base]
            digest = hashlib.sha256(rendered(base).encode()).hexdigest()
            counts = [kinds.count(k) for k in range(len(KINDS))]
            return [(row["doc_id"], *counts, len(more), digest, rendered(sorted(base + more)))]

        return one

    schema = "doc_id long, n_assign long, n_access long, n_hex long, n_random long, base_sha256 string, spans string"
    return map_rows(docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")), schema, start)


def op2_secrets(spark, sf_dir):
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
