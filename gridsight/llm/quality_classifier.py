"""Document quality by a sparse rule ensemble compiled to column expressions.

Texts are reduced to a struct of statistics by built-in functions. Trees grown on
a bounded labelled sample give conjunctive rules over them, lasso logistic
regression weighs the rules, and the survivors become one expression: scoring a
corpus is a projection without shuffle or Python.

Defined results: null and empty texts have zero statistics and are scored like
any other; rows with null labels are not learnt from; without labels of both
kinds every score is the smoothed share of good rows, one half for no rows at
all; repeated rows are scored alike; input columns of any name are untouched.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .quality_rules import SYMBOLS, UPPER, _count_of, _each, let, words_of
from .rule_ensemble import RuleEnsemble, fit

#: Labelled rows to learn from, at most; taken in the order of a hash of their ids.
MAX_TRAINING_ROWS = 8000
FOLDS, HELD_OUT = 4, 2
NAMES = ["words", "word_length", "symbols", "upper", "marks", "pairs", "variety", "lines", "line_variety"]


def statistics(text: Column) -> Column:
    """Struct of doubles: counts and shares of a whole text."""
    full = F.coalesce(text, F.lit(""))

    def share(part: Column, whole: Column) -> Column:
        return part.cast("double") / F.greatest(whole.cast("double"), F.lit(1.0))

    def of_words(w: Column) -> Column:
        n = F.size(w)
        pairs = F.when(n < 2, F.lit(0)).otherwise(F.size(F.filter(F.sequence(F.lit(0), n - 2), lambda i: F.get(w, i) == F.get(w, i + 1))))
        return F.struct(n.alias("n"), F.length(F.array_join(w, "")).alias("chars"), pairs.alias("pairs"), F.size(F.array_distinct(w)).alias("kinds"))

    def of_lines(lines: Column) -> Column:
        return F.struct(F.size(lines).alias("n"), F.size(F.array_distinct(lines)).alias("kinds"))

    def joined(s: Column) -> Column:
        w, lines = s["w"], s["l"]
        return F.struct(
            w["n"].cast("double").alias("words"),
            share(w["chars"], w["n"]).alias("word_length"),
            share(_count_of(full, SYMBOLS), w["chars"]).alias("symbols"),
            share(_count_of(full, UPPER), w["chars"]).alias("upper"),
            share(_count_of(full, "[!?]"), w["chars"]).alias("marks"),
            share(w["pairs"], w["n"]).alias("pairs"),
            share(w["kinds"], w["n"]).alias("variety"),
            lines["n"].cast("double").alias("lines"),
            share(lines["kinds"], lines["n"]).alias("line_variety"),
        )

    return let(F.struct(let(words_of(full), of_words).alias("w"), let(F.split(full, "\n"), of_lines).alias("l")), joined)


def held_out(id: Column) -> Column:
    return F.coalesce(F.crc32(id.cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, *, label: str = "quality", most: int = MAX_TRAINING_ROWS) -> RuleEnsemble:
    """Learn from labelled rows outside the held-out fold, ``most`` at most.

    Only statistics of the sampled rows reach the driver. The sample of ids is
    bounded by ``most``, which also bounds what the join broadcasts.
    """
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col("doc_id"))).select("doc_id", F.col(label).alias("y"))
    sample = usable.orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id", "y").limit(most)
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("doc_id", "y", statistics(F.col("text")).alias("s"))
    found = rows.orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id").limit(2 * most).select("y", *[F.col("s")[c].alias(c) for c in NAMES]).toPandas()
    return fit(NAMES, found[NAMES].to_numpy(float).reshape(-1, len(NAMES)), found["y"].to_numpy(float))


def score(docs: DataFrame, model: RuleEnsemble, *, text: str = "text") -> Column:
    """Score column of ``docs``: higher for better texts."""
    return let(statistics(docs[text]), model.compiled)


def keep_good(docs: DataFrame, model: RuleEnsemble, *, text: str = "text", least: float = 0.5) -> DataFrame:
    """Rows scored at ``least`` or more, with the columns of ``docs``."""
    return docs.filter(score(docs, model, text=text) >= least)


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = docs.select("doc_id", held_out(docs["doc_id"]).alias("held_out"), score(docs, model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))
