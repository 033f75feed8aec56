"""Byte-pair encoding in linear time, and decoding by an offset table.

A text is split into words as the vocabulary file says.  Each word is encoded by a
backtracking search: an Aho-Corasick automaton over all tokens gives the longest token
at every place; a token may follow another where no merge across their border would have
come before the merges that made them (the pair-compatibility table).  Two neighbours
that pass this test are what the merges would give, so the search needs no merge queue.
A place from which no way leads on is never tried twice, which bounds the steps by the
length of the word times the number of tokens that begin one another.

Nothing here trains: the vocabulary is a file of a public tokenizer, read once a process
and of a fixed size.

Documents.  Null texts count as empty and have no tokens.  Repeated rows and ids are
encoded row by row; other columns, whatever their names, are left out; an empty table
gives an empty table.  Texts of any length are encoded in blocks that end at a space, so
memory follows the longest run without one.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
import unicodedata
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordweave.llm.common import documents, text_or_empty

VOCABULARY = "/opt/tokenizers/word_bpe_49k.json"

# White space, which separates words.
SPACES = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

# Characters of a text that are normalised and split at once, and ids decoded at once.
BLOCK_CHARS = 1 << 18
BLOCK_IDS = 1 << 16

# Words and pairs whose answers a process remembers, and characters of a word it does remember.
MAX_WORDS = 300_000
MAX_PAIRS = 1_000_000
MAX_KNOWN_WORD = 64


def byte_characters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: itself if it
    prints, or the next free one from 256 on."""
    free = iter(range(256, 512))
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return [chr(b if b in prints else next(free)) for b in range(256)]


class Merges:
    """The tokens of a merge list and the search that splits words into them.

    Tokens are numbered by the time at which merging makes them: first the symbols, then
    one token a merge.  ``symbols`` are characters 0, 1, ... of the strings to encode.
    """

    def __init__(self, n_symbols: int, merges: list[tuple[int, int]]):
        import ahocorasick

        self.n_symbols = n_symbols
        self.parts = [(t, t) for t in range(n_symbols)] + merges
        self.merged = {pair: n_symbols + i for i, pair in enumerate(merges)}
        strings = [chr(t) for t in range(n_symbols)]
        for left, right in merges:
            strings.append(strings[left] + strings[right])
        self.lengths = [len(s) for s in strings]
        self.pairs: dict[tuple[int, int], bool] = {}
        # A token that its own string is not merged to appears in no encoding.
        made = [True] * n_symbols
        for token in range(n_symbols, len(self.parts)):
            left, right = self.parts[token]
            made.append(made[left] and made[right] and self._stay_apart(left, right, token))
        self.automaton = ahocorasick.Automaton()
        for token, string in enumerate(strings):
            if made[token]:
                self.automaton.add_word(string, token)
        self.shorter = [self._beginning(s) if made[t] else -1 for t, s in enumerate(strings)]
        self.automaton.make_automaton()

    def _beginning(self, string: str) -> int:
        """The longest token that is a proper beginning of ``string``, or -1."""
        for end in range(len(string) - 1, 0, -1):
            token = self.automaton.get(string[:end], -1)
            if token >= 0:
                return token
        return -1

    def _stay_apart(self, left: int, right: int, before: int) -> bool:
        """Whether no merge across the border of two tokens comes first.

        Goes back in time: the later of the two is taken apart, and the pair then at the
        border must not have merged before that moment.  Of equal merges the leftmost
        comes first, so a merge across wins a tie with one to its right and loses a
        tie with one to its left.
        """
        moment = 2 * before  # a merge across at time t happens if 2 * t is less
        pair = (left, right)
        while True:
            across = self.merged.get(pair)
            if across is not None and 2 * across < moment:
                return False
            left, right = pair
            if max(left, right) < self.n_symbols:
                return True
            if left > right:
                moment, pair = 2 * left, (self.parts[left][1], right)
            else:
                moment, pair = 2 * right + 1, (left, self.parts[right][0])

    def compatible(self, left: int, right: int) -> bool:
        """Whether ``right`` may follow ``left``; answers are kept in the pair table."""
        answer = self.pairs.get((left, right))
        if answer is None:
            if len(self.pairs) >= MAX_PAIRS:
                self.pairs.clear()
            # Later than any merge, so that the two themselves must not merge either.
            answer = self.pairs[left, right] = self._stay_apart(left, right, len(self.parts))
        return answer

    def encode(self, string: str) -> list[int]:
        """The tokens that merging makes of ``string``."""
        whole = self.automaton.get(string, -1)
        if whole >= 0:
            return [whole]
        n = len(string)
        longest = [-1] * n
        lengths, shorter = self.lengths, self.shorter
        for end, token in self.automaton.iter(string):
            # Ends come in order, so the last match from a place is its longest.
            longest[end + 1 - lengths[token]] = token
        dead = bytearray(n + 1)
        path: list[int] = []
        at, token = 0, longest[0] if n else -1
        while at < n:
            end = at + lengths[token]
            if not dead[end] and (not path or self.compatible(path[-1], token)):
                path.append(token)
                at = end
                if at < n:
                    token = longest[at]
                continue
            token = shorter[token]
            while token < 0:
                # No token fits here: go back and try shorter ones there.
                dead[at] = 1
                last = path.pop()
                at -= lengths[last]
                token = shorter[last]
        return path


class Remembered(dict):
    """What a function gives for short strings; those not asked for again are forgotten."""

    def __init__(self, function: Callable[[str], bytes]):
        super().__init__()
        self.function = function
        self.earlier: dict[str, bytes] = {}

    def __missing__(self, key: str) -> bytes:
        value = self.earlier.get(key)
        if value is None:
            value = self.function(key)
        if len(key) <= MAX_KNOWN_WORD:
            if len(self) >= MAX_WORDS:
                self.earlier = dict(self)
                self.clear()
            self[key] = value
        return value


class Vocabulary:
    """A byte-level vocabulary file with word ends: text to ids and back."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Regex, Tokenizer, pre_tokenizers

        content = Path(path).read_text(encoding="utf-8")
        spec = json.loads(content)
        model, vocab = spec["model"], spec["model"]["vocab"]
        suffix = model["end_of_word_suffix"]
        marks = byte_characters()
        own = [vocab[c] for c in marks] + [vocab[c + suffix] for c in marks]
        number = {vocab_id: i for i, vocab_id in enumerate(own)}
        merges = []
        for left, right in model["merges"]:
            merges.append((number[vocab[left]], number[vocab[right]]))
            own.append(vocab[left + right])
            number[own[-1]] = len(own) - 1
        self.merges = Merges(512, merges)
        self.ids = np.array(own, dtype="<u4")

        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        tokens = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        # Without a decoder in the file, tokens are joined by spaces; each is kept with one before it.
        pieces = [(" " + tokens.get(i, "")).encode() for i in range(max(tokens) + 1)]
        self.blob = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        self.offsets = np.concatenate(([0], np.cumsum([len(p) for p in pieces])))

        # What the file says of normalising and splitting, for characters on which Unicode versions differ.
        self._normalizer = Tokenizer.from_str(content).normalizer
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self._split = pre_tokenizers.Split(Regex(pattern), "removed", invert=True)
        self._words = regex.compile(pattern.replace(r"\s", SPACES))
        self._sure: set[str] = set()
        self._word_ids = Remembered(self._encoded)
        self._chunk_ids = Remembered(lambda chunk: b"".join(map(self._word_ids.__getitem__, self._words.findall(chunk))))

    def _is_sure(self, char: str) -> bool:
        """Whether this process's Unicode tables and the file's agree on a character."""
        if unicodedata.category(char) == "Cn":
            return False
        plain = self._lower(char)
        sample = f"a{plain}1{plain}!{plain}"
        return self._normalizer.normalize_str(char) in (plain, " ") and self._words.findall(sample) == [
            word for word, _ in self._split.pre_tokenize_str(sample)
        ]

    @staticmethod
    def _lower(text: str) -> str:
        # Character by character: a capital sigma does not depend on its neighbours.
        return text.replace("Σ", "σ").lower()

    def _normalised(self, text: str) -> str | None:
        """The text in normal form, or None if only the file's own rules are sure to give it."""
        if text.isascii():
            return text.lower()
        new = set(text) - self._sure
        unsure = [c for c in new if not self._is_sure(c)]
        self._sure.update(new.difference(unsure))
        if unsure or not unicodedata.is_normalized("NFC", text):
            return None
        return self._lower(text)

    def _block_ids(self, text: str) -> bytes:
        normalised = self._normalised(text)
        if normalised is None:
            words = self._split.pre_tokenize_str(self._normalizer.normalize_str(text))
            return b"".join([self._word_ids[word] for word, _ in words])
        # No word holds a space or a line end, so what is between them is split on its own.
        return b"".join(map(self._chunk_ids.__getitem__, normalised.replace("\n", " ").split(" ")))

    def _encoded(self, word: str) -> bytes:
        raw = word.encode()
        return self.ids[self.merges.encode(raw[:-1].decode("latin-1") + chr(256 + raw[-1]))].tobytes()

    def encode(self, text: str) -> Iterator[bytes]:
        """Blocks of ids as little-endian unsigned 32-bit integers."""
        for part in self._special.split(text) if "<" in text else [text]:
            if part in self.special:
                yield np.array([self.special[part]], dtype="<u4").tobytes()
                continue
            start = 0
            while start < len(part):
                end = part.find(" ", start + BLOCK_CHARS)
                end = len(part) if end < 0 else end
                yield self._block_ids(part[start:end])
                start = end

    def decode(self, ids: np.ndarray) -> bytes:
        """The UTF-8 bytes of the tokens, each with a space before it."""
        starts, lengths = self.offsets[ids], self.offsets[ids + 1] - self.offsets[ids]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ids) else 0
        return self.blob[np.arange(total) + np.repeat(starts - ends + lengths, lengths)].tobytes()


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def round_trip(words: Vocabulary, text: str) -> tuple[int, str, str]:
    """``(n_tokens, ids_sha256, decoded_sha256)`` of a text, encoded and decoded again block by block."""
    n_tokens = 0
    of_ids, of_text = hashlib.sha256(), hashlib.sha256()
    for block in words.encode(text):
        of_ids.update(block)
        ids = np.frombuffer(block, dtype="<u4").astype(np.int64)
        for i in range(0, len(ids), BLOCK_IDS):
            decoded = words.decode(ids[i : i + BLOCK_IDS])
            # Only the first token of a text has no space before it.
            of_text.update(decoded if n_tokens or i else decoded[1:])
        n_tokens += len(ids)
    return n_tokens, of_ids.hexdigest(), of_text.hexdigest()


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, str]]:
    """Rows one at a time, so that only one text is held as a Python string."""
    for batch in batches:
        doc_ids, texts = batch.columns
        for i in range(len(batch)):
            yield doc_ids[i].as_py(), texts[i].as_py()


def encode(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """``(doc_id, block_no, ids)``: the ids of each document in blocks, in order; no row without ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for doc_id, text in _texts(batches):
            for block_no, block in enumerate(b for b in words.encode(text) if b):
                ids = pa.array(np.frombuffer(block, dtype="<u4").astype(np.int32))
                lists = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc_id], pa.int64()), pa.array([block_no], pa.int32()), lists], ["doc_id", "block_no", "ids"]
                )

    columns = docs.select(F.col("doc_id").cast("bigint"), text_or_empty().alias("text"))
    return columns.mapInArrow(run, "doc_id bigint, block_no int, ids array<int>")


def digests(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)``, one row per document."""
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for batch in batches:
            rows = [(doc_id, *round_trip(words, text)) for doc_id, text in _texts(iter([batch]))]
            columns = zip(*rows, strict=True) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    columns = docs.select(F.col("doc_id").cast("bigint"), text_or_empty().alias("text"))
    return columns.mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(documents(spark, sf_dir))
