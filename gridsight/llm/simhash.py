"""SimHash near-duplicates by a segment-popcount embedding.

A 64-bit fingerprint is cut into 32 segments of two bits; the vector of their bit
counts is its embedding. Manhattan distance between embeddings never exceeds the
Hamming distance of the fingerprints, so fingerprints at most three bits apart
have embeddings within three, and one 32-bit half of them within one. The grid
has a cell per half-embedding; the range join matches a cell with itself and with
the cells one step up along each axis, which reaches every pair, and a pair
counts only if the fingerprints, compared exactly, differ in at most three bits.

Equal fingerprints are one vertex throughout. A crowded cell (near copies of one
text) would hold a square of pairs, so its fingerprints first meet at hubs: the
fingerprint itself and its 64 one-bit changes. All that meet at one hub are
within two bits of each other and are linked as a star. The grid join then skips
cells whose members are linked already, and elsewhere compares only rows outside
a cell's largest class with the others. A cell of over ``DENSE`` rows is cut by the
other half: that half's embeddings lie within three, so one of its 16-bit quarters
within one, and the same grid over quarters leaves about one pair in 75.

Defined results: null, empty and blank texts have fingerprint zero and are linked
like any other; repeated rows share a class; a null doc_id never becomes the
class id unless all of its class are null; of rows with the same id ``keep_one`` takes
the one whose text has the least 64-bit hash, and any of those alike; an empty table
gives an empty result.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from . import graph, scratch

BITS = 3
SHINGLE = 3
SEED = 42
#: Members of a cell from which hubs link it first.
CROWDED = 64
#: Rows of a cell from which it is cut: where comparing a row with the others costs more than the 18 rows it becomes.
DENSE = 1 << 14
_BLOCK = 1 << 16


def _hash_counts(words: list[bytes]) -> tuple[np.ndarray, int]:
    total, n = np.zeros(64, np.int64), max(1, len(words) - SHINGLE + 1)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, _BLOCK):
        part = words[at : at + _BLOCK + SHINGLE - 1]
        joined = map(b" ".join, zip(part, part[1:], part[2:])) if len(words) >= SHINGLE else [b" ".join(part)]
        hashes = np.fromiter((digest(x, SEED) for x in joined), np.uint64)
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return total, n


def fingerprint_of(text: bytes | None) -> int:
    """The signed 64-bit fingerprint of a UTF-8 text."""
    words = (text or b"").lower().split()  # bytes: only A-Z change, only ASCII blanks split
    if not words:
        return 0
    counts, n = _hash_counts(words)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.int64)[0])


@F.arrow_udf(LongType())
def _fingerprint(texts: pa.Array) -> pa.Array:
    return pa.array([fingerprint_of(x.as_buffer().to_pybytes() if x.is_valid else None) for x in texts.cast(pa.large_binary())], pa.int64())


def fingerprint(text: Column) -> Column:
    return _fingerprint(text)


def _embedding(fp: Column, half: int) -> Column:
    """Sixteen 2-bit counts of one half, packed in a long."""
    bits = F.shiftrightunsigned(fp, 32 * half).bitwiseAND(F.lit(0xFFFFFFFF))
    low = F.lit(0x55555555)
    return bits.bitwiseAND(low) + F.shiftright(bits, 1).bitwiseAND(low)


def _cells(frame: DataFrame, *, steps: bool) -> DataFrame:
    """Rows of ``frame (fp, ...)`` by cell; ``step``: 0 in its own cell, 1 one step up (``steps`` only)."""

    def entry(half: int, step: int):
        return lambda cell: F.struct(F.lit(half).alias("half"), cell.alias("cell"), F.lit(step).alias("step"))

    entries = []
    for half in (0, 1):
        own = _embedding(F.col("fp"), half)
        entries.append(F.array(entry(half, 0)(own)))
        if steps:
            axes = [F.when(F.shiftright(own, 2 * i).bitwiseAND(F.lit(3)) < 2, own + F.lit(1 << (2 * i))) for i in range(16)]
            entries.append(F.transform(F.array_compact(F.array(*axes)), entry(half, 1)))
    return frame.withColumn("_e", F.explode(F.concat(*entries))).select(*frame.columns, "_e.half", "_e.cell", "_e.step")


def _crowd_edges(points: DataFrame, crowded: int) -> DataFrame:
    """Star edges among fingerprints of crowded cells that are at most two bits apart."""
    own = _cells(points.select("fp"), steps=False)
    full = own.groupBy("half", "cell").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= crowded).drop("n")
    members = own.join(full, ["half", "cell"], "left_semi").select("fp").distinct()
    hubs = F.concat(F.array("fp"), F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.col("fp").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i))))
    met = scratch.table(members.select("fp", F.explode(hubs).alias("hub")), "hubs")
    centres = met.groupBy("hub").agg(F.min("fp").alias("centre"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    return met.join(centres, "hub").filter("fp <> centre").select(F.col("fp").alias("a"), F.col("centre").alias("b")).distinct()


def _quarters(fp: Column, half: Column) -> Column:
    """``(cell, step)`` of both quarters of a half: own cells and those a step up."""
    embedding = F.when(half == 0, _embedding(fp, 0)).otherwise(_embedding(fp, 1))

    def entries(quarter: int) -> list[Column]:
        own = F.shiftright(embedding, 16 * quarter).bitwiseAND(F.lit(0xFFFF))
        steps = [F.when(F.shiftright(own, 2 * i).bitwiseAND(F.lit(3)) < 2, own + F.lit(1 << (2 * i))) for i in range(8)]
        return [F.struct((F.lit(quarter << 16) + cell).alias("cell"), F.lit(int(k > 0)).alias("step")) for k, cell in enumerate([own, *steps])]

    return F.filter(F.array(*entries(0), *entries(1)), lambda e: e["cell"].isNotNull())


def _grid_edges(points: DataFrame, dense: int) -> DataFrame:
    """Class pairs with a link between fingerprints of ``points (fp, class)`` that share a grid cell."""
    entries = _cells(points, steps=True)
    sizes = entries.groupBy("half", "cell", "class").agg(F.count(F.lit(1)).alias("n"), F.min("step").alias("step"))
    mixed = sizes.groupBy("half", "cell").agg(F.max(F.struct("n", "class")).alias("top"), F.sum("n").alias("rows"), F.count(F.lit(1)).alias("classes"), F.min("step").alias("step"))
    # Where all are a step away, nobody is at home, and no pair can meet.
    mixed = mixed.filter("classes > 1 AND step = 0").select("half", "cell", F.col("top.class").alias("major"), (F.col("rows") > dense).alias("dense"))
    whole = F.array(F.struct(F.lit(0).cast("long").alias("cell"), F.lit(0).alias("step")))
    parts = F.when(F.col("dense"), _quarters(F.col("fp"), 1 - F.col("half"))).otherwise(whole)
    held = entries.join(mixed, ["half", "cell"]).withColumn("_q", F.explode(parts))
    met = scratch.table(held.select("fp", "class", "half", "cell", "step", "major", F.col("_q.cell").alias("quarter"), F.col("_q.step").alias("low")), "cells")
    one, other = met.filter("class <> major").alias("x"), met.alias("y")
    near = F.bit_count(F.col("x.fp").bitwiseXOR(F.col("y.fp"))) <= BITS
    same = [F.col(f"x.{c}") == F.col(f"y.{c}") for c in ("half", "cell", "quarter")]
    # Both a step up means neither is in this cell; such a pair meets in another.
    apart = [F.col("x.class") != F.col("y.class"), F.col("x.step") + F.col("y.step") < 2, F.col("x.low") + F.col("y.low") < 2]
    found = one.join(other, reduce(lambda a, b: a & b, [*same, *apart, near]))
    return found.select(F.least("x.class", "y.class").alias("a"), F.greatest("x.class", "y.class").alias("b")).distinct()


def link(points: DataFrame, *, crowded: int = CROWDED, dense: int = DENSE) -> DataFrame:
    """``(fp, class)`` for distinct fingerprints; the class is the least fingerprint reachable."""
    near = graph.components(_crowd_edges(points, crowded))
    first = scratch.table(points.select("fp").join(near, F.col("fp") == F.col("v"), "left").select("fp", F.coalesce("root", "fp").alias("class")), "classes")
    far = graph.components(_grid_edges(first, dense))
    return first.join(far, F.col("class") == F.col("v"), "left").select("fp", F.coalesce("root", "class").alias("class"))


def classes(prints: DataFrame, *, crowded: int = CROWDED, dense: int = DENSE) -> DataFrame:
    """``(fp, component_id)`` from ``prints (doc_id, fp)``: the least doc_id among all texts reachable."""
    points = scratch.table(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprints")
    linked = scratch.table(link(points, crowded=crowded, dense=dense).join(points, "fp"), "linked")
    names = linked.groupBy("class").agg(F.min("least").alias("component_id"))
    return linked.join(names, "class").select("fp", "component_id")


def near_duplicates(docs: DataFrame, *, text: str = "text", id: str = "doc_id", crowded: int = CROWDED) -> DataFrame:
    """``doc_id, fp, component_id`` for every row of ``docs``."""
    prints = scratch.table(docs.select(docs[id].alias("doc_id"), fingerprint(docs[text]).alias("fp")), "prints")
    return prints.join(classes(prints, crowded=crowded), "fp")


def keep_one(docs: DataFrame, *, text: str = "text", id: str = "doc_id", crowded: int = CROWDED) -> DataFrame:
    """One row of each class of near-duplicates, the one with the least id; columns as in ``docs``."""
    rows = scratch.table(
        docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.monotonically_increasing_id().alias("rid"), docs[id].alias("doc_id"), F.xxhash64(docs[text]).alias("hash"), fingerprint(docs[text]).alias("fp")), "rows"
    )
    prints = rows.select("rid", "doc_id", "hash", "fp")
    points = scratch.table(prints.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "hash", "rid")).alias("first")), "fingerprints")
    linked = link(points.select("fp"), crowded=crowded).join(points, "fp")
    best = linked.groupBy("class").agg(F.min("first").alias("first")).select(F.col("first.rid").alias("rid"))
    return rows.join(best, "rid", "left_semi").select("row.*")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
