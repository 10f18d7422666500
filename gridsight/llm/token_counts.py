"""Token counts: batches of pieces encoded in Arrow functions, lengths only.

Texts are split at safe boundaries (see ``chunks``), long ones first to stretches of
bounded length. Stretches of many texts are taken together by bytes; their pieces
not met before are encoded in batches of equal bytes, whichever texts they are from,
and a text's count is the sum over its pieces. Ids never leave the encoder.

Defined results: a null or empty text has no tokens; a text of any length is
counted whole; repeated rows are counted each; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe_tree import default_path
from .chunks import Memo, stretches

VOCABULARY = "piece_bpe_32k.model"
LIMIT = 4096
#: Bytes of pieces in a call of the encoder, characters of a stretch, and of stretches that are taken together.
BATCH_BYTES, STRETCH, TOGETHER = 1 << 20, 1 << 20, 1 << 22


class Counter:
    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        sign = "▁"
        self.safe = not any(sign in model.id_to_piece(i).lstrip(sign) for i in range(model.get_piece_size()))
        self._model = model
        self.memo = Memo(lambda parts: map(len, model.encode(parts, num_threads=1)), batch_bytes=BATCH_BYTES)

    def count(self, texts: list[str]) -> list[int]:
        """Token counts of whole texts."""
        if not self.safe:
            return [len(self._model.encode(x)) for x in texts]
        totals = [0] * len(texts)
        owners: list[int] = []
        held: list[str] = []
        size = 0

        def flush() -> None:
            cut, value = self.memo.all_of(held)
            for k, parts in zip(owners, cut, strict=True):
                totals[k] += sum(map(value, parts[1:]))
            firsts = [parts[0] for parts in cut]
            for k, ids in zip(owners, self._model.encode(firsts, num_threads=1), strict=True):
                totals[k] += len(ids)
            owners.clear()
            held.clear()

        for k, text in enumerate(texts):
            for stretch in stretches(text, STRETCH):
                owners.append(k)
                held.append(stretch)
                size += len(stretch)
                if size >= TOGETHER:
                    flush()
                    size = 0
        if held:
            flush()
        return totals


@lru_cache(2)
def counter(path: str) -> Counter:
    return Counter(path)


def count(docs: DataFrame, *, text: str = "text", id: str = "doc_id", path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row."""
    kind, path = docs.schema[id].dataType, path or default_path(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = counter(path)
        for batch in batches:
            found = at.count([x.as_py() or "" for x in batch.column(2)])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(docs[id].alias("doc_id"), F.coalesce(F.octet_length(docs[text]), F.lit(0)).cast("long").alias("n_bytes"), docs[text].alias("text"))
    counted = rows.mapInArrow(run, f"doc_id {kind.simpleString()}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count(spark.read.parquet(f"{sf_dir}/documents.parquet"))
