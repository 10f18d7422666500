"""Packing by power-of-two decomposition.

A document's tokens, closed by an end id, are cut into full sequences of the
largest length and then into the binary digits of what is left. Every piece is a
sequence of its own: none crosses documents and none needs padding. Sequences
of equal length share a bucket, from which batches of one shape are drawn.

Sequence ids are made where the pieces are: bucket, then task, then a running
number, so a bucket's ids are one range and no exchange is needed.

Defined results: a null or empty text is the end id alone; a text of any length
is cut whole; repeated rows get pieces each; an empty table gives none; other
columns are not read.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from .bpe_tree import default_path, packed
from .chunks import Memo

VOCABULARY = "byte_bpe_50k.json"
LONGEST = 1024
END = 0
#: Bytes of pieces in a call of the tokenizer, and characters of texts whose pieces are looked up together.
BATCH_BYTES, TOGETHER = 1 << 14, 1 << 16
#: A blank beside other white space, or at the end: the pattern may take these together.
UNSAFE = re.compile(r"\s | \s| \Z")
#: Bits of a sequence id for the running number in a task, and for the task.
RUN_BITS, TASK_BITS = 34, 24


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        #: Bytes of every id: a token of a byte-level vocabulary has a character for each.
        self.sizes = np.zeros(self.tokenizer.get_vocab_size() + 1, np.int64)
        for token, id in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.sizes[id] = len(token)
        self.memo = Memo(self._pieces, batch_bytes=BATCH_BYTES)
        self._first = lru_cache(50_000)(lambda part: packed(self._ids(part)))

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _pieces(self, parts: list[str]) -> list[bytes]:
        """Ids of pieces that follow a blank, encoded as one text and told apart by their bytes.

        Where a token lies across two pieces, or a piece is not safely cut, each is encoded alone.
        """
        text = " " + " ".join(parts)
        if not UNSAFE.search(text) and not any(x in text for x in self.added):
            ids = np.array(self._ids(text), "<u4")
            ends, wanted = self.sizes[ids].cumsum(), np.cumsum([1 + (len(p) if p.isascii() else len(p.encode())) for p in parts])
            at = ends.searchsorted(wanted)
            if ends[-1] == wanted[-1] and (ends[at] == wanted).all():
                raw, cuts = ids.tobytes(), [0, *(4 * at + 4).tolist()]
                return [raw[low:high] for low, high in zip(cuts, cuts[1:])]
        return [packed(self._ids(" " + p)) for p in parts]

    def encode_all(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of whole texts; pieces not met before are encoded together, whichever texts they are from."""
        start = size = 0
        for end, text in enumerate(texts, 1):
            size += len(text)
            if size >= TOGETHER or end == len(texts):
                for first, others in self.memo.encoded(texts[start:end]):
                    yield b"".join([self._first(first), *others])
                start, size = end, 0

    def encode(self, text: str) -> bytes:
        return next(self.encode_all([text]))


@lru_cache(2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def lengths(tokens: int, longest: int = LONGEST) -> list[int]:
    """Full sequences, then the binary digits of the rest, largest first."""
    rest = tokens % longest
    return [longest] * (tokens // longest) + [1 << b for b in reversed(range(longest.bit_length())) if rest >> b & 1]


def pack(docs: DataFrame, *, text: str = "text", id: str = "doc_id", path: str | None = None, longest: int = LONGEST, with_ids: bool = False) -> DataFrame:
    """Pieces: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, bucket`` and, if asked for, ``ids``.

    ``longest`` is a power of two; ``bucket`` is the logarithm of a piece's length.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    kind, path = docs.schema[id].dataType, path or default_path(VOCABULARY)
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "bucket"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, task = encoder(path), TaskContext.get().partitionId()
        made = [0] * longest.bit_length()
        for batch in batches:
            rows: list[tuple] = []
            owners: list[int] = []
            for k, ids in enumerate(at.encode_all([x or "" for x in batch.column(1).to_pylist()])):
                ids += packed([END])
                total, start = len(ids) // 4, 0
                for length in lengths(total, longest):
                    bucket, piece = length.bit_length() - 1, ids[4 * start : 4 * (start + length)]
                    sequence = (((bucket << TASK_BITS) + task) << RUN_BITS) + made[bucket]
                    made[bucket] += 1
                    owners.append(k)
                    rows.append((start, length, zlib.crc32(piece), total, sequence, 0, bucket, *([piece] if with_ids else [])))
                    start += length
            columns = list(zip(*rows, strict=True)) or [()] * (7 + with_ids)
            kinds = [pa.int64()] * 6 + [pa.int32()] + [pa.binary()] * with_ids
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owners, pa.int64())), *[pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]], [*names, *["ids"] * with_ids])

    schema = f"doc_id {kind.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, bucket int" + ", ids binary" * with_ids
    return docs.select(docs[id].alias("doc_id"), docs[text].alias("text")).mapInArrow(run, schema)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
