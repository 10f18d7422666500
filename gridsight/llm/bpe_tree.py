"""Byte-level BPE as a monoid: halves are encoded apart and joined at their seam.

A text is reduced as a tree whose leaves have bounded length. A segment carries its
pieces between certain cuts (see ``chunks``) with their ids; of the outermost two it
also knows the pattern's matches. Segments join in two windows that grow until what
lies outside is sure to stay:

* Matches. The pattern reads from left to right and looks ``AHEAD`` characters past
  a match's end at most, so matches of the left that end before its last ``AHEAD``
  characters stay. The others are matched again, together with a growing number of
  the right's, until a match ends where one of the right's does with ``AHEAD``
  characters still in the window: from there on the right's matches stay.
* Tokens of a match that lies across the seam. A row of tokens is what BPE makes of
  their bytes if every two neighbours are what it makes of theirs (the first merge
  across a border of two tokens would be made in those two alone as well). So only a
  window of tokens around the seam is encoded again, and it doubles until its outer
  tokens agree with their neighbours outside.

Joining is associative; its work is bounded by the window, not the segment, also
where there is no blank. Decoding concatenates up a tree of id ranges.

Defined results: a null or empty text has no ids and decodes to no bytes; texts of
any length are encoded whole; a stretch with characters that have no Unicode category
yet (libraries differ in them) is encoded again as a whole where it meets another;
repeated rows are encoded alike; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

import array
import base64
import hashlib
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession

from .chunks import MEMO_LENGTH, Memo

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
LEAF_CHARACTERS = 8192
LEAF_IDS = 4096
#: Characters past a match's end that the pattern looks at, at most.
AHEAD = 3
#: Matches and tokens on either side of a seam in the first window.
MATCHES, TOKENS = 4, 4


def packed(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    out = array.array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


def unpacked(raw: bytes) -> list[int]:
    out = array.array("I", raw)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tolist()


def default_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Run:
    """A piece by its matches and their ids; with ``matches`` None, a stretch that is only known as a whole."""

    __slots__ = ("text", "matches", "ids")

    def __init__(self, text: str | None, matches: list[str] | None, ids: list[list[int]]):
        self.text, self.matches, self.ids = text, matches, ids

    def whole(self) -> str:
        return self.text if self.matches is None else "".join(self.matches)

    def packed(self) -> bytes:
        return packed(list(chain.from_iterable(self.ids)))


class Codec:
    """Encoder and decoder of a rank file."""

    def __init__(self, path: str, pattern: str, *, leaf: int = LEAF_CHARACTERS, ahead: int = AHEAD):
        with open(path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.leaf, self.ahead = leaf, ahead
        self.split = regex.compile(pattern).findall
        one = self.encoding.encode_ordinary
        self.memo = Memo(lambda parts: [packed(one(" " + p)) for p in parts])
        self.agree = lru_cache(100_000)(self._agree)
        self._short = lru_cache(100_000)(lambda match: self._piece(match.encode()))

    def _match(self, match: str) -> list[int]:
        return self._short(match) if len(match) <= MEMO_LENGTH else self._piece(match.encode())

    def _piece(self, data: bytes) -> list[int]:
        return self.encoding._encode_single_piece(data)

    def _bytes(self, ids: list[int]) -> bytes:
        return self.encoding.decode_bytes(ids)

    def _agree(self, a: int, b: int) -> bool:
        return self._piece(self._bytes([a, b])) == [a, b]

    def run(self, text: str) -> Run:
        if any(unicodedata.category(c) == "Cn" for c in set(text)):
            return Run(text, None, [self.encoding.encode_ordinary(text)])
        matches = self.split(text)
        return Run(None, matches, list(map(self._match, matches)))

    def join_tokens(self, a: list[int], b: list[int]) -> list[int]:
        """The ids of two neighbouring stretches of one match."""
        k = TOKENS
        while True:
            middle = self._piece(self._bytes(a[-k:] + b[:k]))
            left, right = k >= len(a), k >= len(b)
            if (left or self.agree(a[-k - 1], middle[0])) and (right or self.agree(middle[-1], b[k])):
                return a[:-k] + middle + b[k:]
            k *= 2

    def join_runs(self, a: Run, b: Run) -> Run:
        """The run of two neighbouring runs; ``a`` and ``b`` are used up."""
        if a.matches is None or b.matches is None:
            return self.run(a.whole() + b.whole())
        open_, held, after = [], [], 0
        while a.matches and after < self.ahead:
            open_.append(a.matches.pop())
            held.append(a.ids.pop())
            after += len(open_[-1])
        open_.reverse()
        held.reverse()
        left, k = "".join(open_), MATCHES
        while True:
            taken = b.matches[:k]
            window = left + "".join(taken)
            found, j, kept = self.split(window), 0, 0
            last, ends = k >= len(b.matches), len(left)
            # Where the window's matches end one by one, against where the right's do.
            at = 0
            for kept, match in enumerate(found, 1):
                at += len(match)
                while ends < at and j < len(taken):
                    ends += len(taken[j])
                    j += 1
                if at == ends and at + self.ahead <= len(window):
                    break
            else:
                if not last:
                    k *= 2
                    continue
                kept, j = len(found), len(b.matches)
            break
        for n, match in enumerate(found[:kept]):
            if n + 1 == len(open_) and found[:n] == open_[:n] and taken and match == open_[n] + taken[0]:
                ids = self.join_tokens(held[n], b.ids[0])
            elif n < len(open_) and found[: n + 1] == open_[: n + 1]:
                ids = held[n]
            else:
                ids = self._match(match)
            a.matches.append(match)
            a.ids.append(ids)
        a.matches.extend(b.matches[j:])
        a.ids.extend(b.ids[j:])
        return a

    def _segment(self, text: str) -> list:
        """A leaf: its first piece as a run and, if there are more, the ids of the inner ones and the last as a run."""
        parts, ids = self.memo.of(text)
        return [self.run(parts[0])] if len(parts) == 1 else [self.run(parts[0]), *ids[:-1], self.run(" " + parts[-1])]

    def _join(self, a: list, b: list) -> list:
        met = self.join_runs(a.pop(), b[0])
        a.append(met.packed() if a and len(b) > 1 else met)
        a.extend(b[1:])
        return a

    def _reduce(self, text: str, low: int, high: int) -> list:
        if high - low <= self.leaf:
            return self._segment(text[low:high])
        middle = (low + high) // 2
        return self._join(self._reduce(text, low, middle), self._reduce(text, middle, high))

    def encode(self, text: str) -> bytes:
        """The ids of a whole text, packed."""
        return b"".join(x if isinstance(x, bytes) else x.packed() for x in self._reduce(text, 0, len(text)))

    def decode(self, ids: bytes) -> bytes:
        """The bytes of packed ids."""
        if len(ids) <= 4 * LEAF_IDS:
            return self.encoding.decode_bytes(unpacked(ids))
        middle = len(ids) // 8 * 4
        return self.decode(ids[:middle]) + self.decode(ids[middle:])


@lru_cache(2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def _pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def encode(docs: DataFrame, *, text: str = "text", id: str = "doc_id", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``doc_id`` and ``ids``: the token ids as a binary of little-endian unsigned 32-bit integers."""
    kind, path, pattern = docs.schema[id].dataType, path or default_path(VOCABULARY), pattern or _pattern()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = codec(path, pattern)
        for batch in batches:
            ids = [at.encode(x.as_py() or "") for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return docs.select(docs[id].alias("doc_id"), docs[text].alias("text")).mapInArrow(run, f"doc_id {kind.simpleString()}, ids binary")


def decode(frame: DataFrame, *, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``frame (doc_id, ids)`` with ``decoded``: the bytes of the ids. A null id list decodes to no bytes."""
    kind, path, pattern = frame.schema["doc_id"].dataType, path or default_path(VOCABULARY), pattern or _pattern()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = codec(path, pattern)
        for batch in batches:
            found = [at.decode(x.as_py() or b"") for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.binary())], ["doc_id", "ids", "decoded"])

    return frame.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind.simpleString()}, ids binary, decoded binary")


def round_trip(docs: DataFrame, *, text: str = "text", id: str = "doc_id", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Digests of encoding and decoding in one pass: ``doc_id, n_tokens, ids_sha256, decoded_sha256``."""
    kind, path, pattern = docs.schema[id].dataType, path or default_path(VOCABULARY), pattern or _pattern()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = codec(path, pattern)
        for batch in batches:
            counts, of_ids, of_bytes = [], [], []
            for x in batch.column(1):
                ids = at.encode(x.as_py() or "")
                counts.append(len(ids) // 4)
                of_ids.append(hashlib.sha256(ids).hexdigest())
                of_bytes.append(hashlib.sha256(at.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = f"doc_id {kind.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select(docs[id].alias("doc_id"), docs[text].alias("text")).mapInArrow(run, schema)


def op2_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(spark.read.parquet(f"{sf_dir}/documents.parquet"))
