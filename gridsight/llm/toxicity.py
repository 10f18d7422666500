"""Toxicity of whole texts: every overlapping window is scored.

A text's words are cut into windows of 32 that overlap by eight. A bidirectional
gated recurrent network with attention pooling (``gru``) gives each window a
logit from word and character inputs. A token of over 24 characters is several
words: it is cut at its signs, and what is still longer into runs of 24 characters
that overlap by eight, so texts without blanks are read to their end; all grams of 4
and 6 characters of a word count. The text's score is a logistic function of
its largest logit and of how many windows are toxic by themselves, as a share of eight at most. The network is trained in numpy on a bounded labelled sample:
first every window of a toxic text counts as toxic, then only those the network
itself finds so, against the windows of clean texts it finds worst. Sampled texts of
any length are cut to windows on the executors, and those go to the driver.

Scoring is a projection in Arrow batches without shuffle. Equal texts get equal
scores whatever else is in their batch.

Defined results: null, empty and blank texts are scored as one window of an
unknown word; rows with null labels are not learnt from; without labels of both
kinds all scores are the smoothed share of toxic rows, one half for no rows at
all; texts of any length are scored whole, a block of windows at a time; repeated
rows are scored alike; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .gru import LONGEST, MOST_GRAMS, Adam, Network, grams, normal, pieces, sigmoid

#: Bounds of the training sample: labelled rows, and windows of one row, which are drawn evenly at random from all of a longer text.
MAX_TRAINING_ROWS, MAX_TRAINING_WINDOWS = 4000, 256
FOLDS, HELD_OUT = 3, 1
WINDOW, STEP = 32, 24
DIM, HIDDEN = 8, 8
#: A word or character gram gets a vector if it is in so many sampled texts and its log-likelihood ratio is so high; so many get one.
LEAST_TEXTS, LEAST_RATIO, MOST_WORDS, MOST_PIECES = 3, 15.0, 5_000, 10_000
_BLOCK = 1024
#: Toxic windows are a share of so many at most, so clean words around a passage do not hide it.
_SHARED = 8
#: Words whose rows are remembered.
_KNOWN = 300_000


def starts(words: int) -> list[int]:
    """First words of the windows of a text; the last window is flush with its end."""
    if words <= WINDOW:
        return [0]
    found = list(range(0, words - WINDOW, STEP))
    return [*found, words - WINDOW]


def split(text: str | None) -> list[str]:
    """Words of a text: its tokens between blanks, and the pieces of those over ``LONGEST`` characters."""
    found = (text or "").lower().split()
    if any(len(x) > LONGEST for x in found):
        found = [w for x in found for w in (pieces(x) if len(x) > LONGEST else (x,))]
    return found or [""]


def sampled(text: str | None, mark: int, most: int = MAX_TRAINING_WINDOWS) -> list[str]:
    """Windows of a text to learn from, each as normalised words joined by blanks; ``mark`` seeds the choice among more than ``most``."""
    words = list(map(normal, split(text)))
    begins = starts(len(words))
    if len(begins) > most:
        begins = sorted(np.random.default_rng(mark).choice(begins, most, replace=False).tolist())
    return [" ".join(words[s : s + WINDOW]) for s in begins]


def _evidence(best: np.ndarray, hits: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """The largest window logit, and the log share of windows that are toxic by themselves, of ``_SHARED`` at most."""
    return np.stack([best, np.log((hits + 0.5) / (np.minimum(windows, _SHARED) + 1))], 1)


class Scorer:
    """A network with the gates of words met so far; words without any known part share row 0."""

    def __init__(self, network: Network):
        self.network = network
        self.known: dict[str, int] = {}
        self.gates = self._held = network.gates(network.inputs(*network.features([""])))

    def _grow(self, more: np.ndarray) -> None:
        """Add rows to ``gates``, which is the filled part of an array that doubles."""
        size = len(self.gates) + len(more)
        if size > len(self._held):
            self._held = np.concatenate([self.gates, np.empty((max(len(more), len(self.gates), 1024), *more.shape[1:]), more.dtype)])
        self._held[len(self.gates) : size] = more
        self.gates = self._held[:size]

    def _rows(self, words: list[str]) -> np.ndarray:
        new = list(set(words).difference(self.known))
        if new:
            ids, rows = self.network.features([normal(w) for w in new])
            named = ids.astype(bool) | rows.any(1)
            at = np.where(named, np.cumsum(named) + len(self.gates) - 1, 0)
            self._grow(self.network.gates(self.network.inputs(ids[named], rows[named])))
            self.known.update(zip(new, at.tolist(), strict=True))
        return np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))

    def evidence(self, texts: list[str | None]) -> np.ndarray:
        """Per text: the largest window logit, and the log share of toxic windows."""
        best = np.full(len(texts), -np.inf)
        hits, windows = np.zeros(len(texts)), np.zeros(len(texts))
        full: list[np.ndarray] = []
        owners: list[int] = []
        size = 0

        def flush() -> None:
            nonlocal size
            if owners:
                at = np.concatenate(full)
                # Windows without any known part are all alike and evaluated once.
                some = np.flatnonzero(at.any(1))
                found = np.full(len(at), self.network.forward(self.gates, np.zeros((1, WINDOW), np.int64), None)[0])
                if len(some):
                    found[some] = self.network.forward(self.gates, at[some], None)
                np.maximum.at(best, np.array(owners), found)
                np.add.at(hits, np.array(owners), found > 0)
                full.clear()
                owners.clear()
                size = 0

        for k, text in enumerate(texts):
            words = split(text)
            # A stretch shares its last window's words with the next one, so no window is lost between them.
            begins = starts(len(words))
            windows[k] = len(begins)
            for i in range(0, len(begins), _BLOCK):
                part = begins[i : i + _BLOCK]
                stretch = words[part[0] : part[-1] + WINDOW]
                if len(self.known) > _KNOWN:
                    flush()  # rows of waiting windows are about to go
                    self.known, self.gates = {}, self.gates[:1]
                rows = self._rows(stretch)
                if len(rows) < WINDOW:
                    padded = np.zeros((1, WINDOW), np.int64)
                    padded[0, : len(rows)] = rows
                    best[k] = self.network.forward(self.gates, padded, np.array([len(rows)]))[0]
                    hits[k] = best[k] > 0
                    continue
                full.append(np.lib.stride_tricks.sliding_window_view(rows, WINDOW)[np.array(part) - part[0]])
                owners.extend([k] * len(part))
                size += len(part)
                if size >= _BLOCK:
                    flush()
        flush()
        return _evidence(best, hits, windows)

    def score(self, texts: list[str | None]) -> np.ndarray:
        weights = np.array(self.network.scale)
        return sigmoid(self.evidence(texts) @ weights[:-1] + weights[-1])


def _telling(held: list[np.ndarray], names: list[str], y: np.ndarray, most: int) -> dict[str, int]:
    """Names that tell the classes of texts apart, by the log-likelihood ratio; ``held`` has the distinct names of each text by number."""
    counts = np.zeros((2, len(names)))
    for found, label in zip(held, y.astype(int).tolist(), strict=True):
        counts[label][found] += 1
    b, a = counts
    ones, zeros = y.sum(), len(y) - y.sum()
    share = (a + b) / len(y)

    def part(seen: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-9) / np.maximum(expected, 1e-9)), 0)

    ratio = 2 * (part(a, share * ones) + part(b, share * zeros) + part(ones - a, (1 - share) * ones) + part(zeros - b, (1 - share) * zeros))
    some = np.flatnonzero((ratio >= LEAST_RATIO) & (a + b >= LEAST_TEXTS)).tolist()
    best = sorted(some, key=lambda k: (-ratio[k], names[k]))[:most]
    return {names[k]: i + 1 for i, k in enumerate(best)}


def _logistic(x: np.ndarray, y: np.ndarray, *, ridge: float = 0.5) -> tuple[float, ...]:
    """Logistic weights of the columns of ``x``, then the shift, by damped Newton steps."""
    design = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(design.shape[1])
    for _ in range(60):
        p = sigmoid(design @ w)
        step = np.linalg.solve(design.T @ (design * (p * (1 - p))[:, None]) + np.eye(len(w)) * ridge, design.T @ (p - y) + w * ridge)
        w = w - np.clip(step, -1, 1)
    return tuple(map(float, w))


def fit(texts: list[list[str]], labels: list[int], *, seed: int = 7, epochs: tuple[int, int] = (2, 6), rate: float = 0.02) -> Network:
    """Train on texts, each as its ``sampled`` windows, with 0/1 labels."""
    y_text = np.array(labels, float)
    ones = int(y_text.sum())
    if min(ones, len(y_text) - ones) < 5:
        flat = Network.fresh({}, {}, dim=DIM, hidden=HIDDEN, seed=seed)
        flat.scale = (0.0, 0.0, float(np.log((ones + 1) / (len(y_text) - ones + 1))))
        return flat
    draw = np.random.default_rng(seed)
    # Words and grams are numbers from here on: what the driver holds is a few arrays, not texts of pieces.
    row: dict[str, int] = {}
    windows, owner, per_text = [], [], []
    for k, held in enumerate(texts):
        windows += [np.array([row.setdefault(w, len(row)) for w in x.split(" ")], np.int32) for x in held]
        owner += [k] * len(held)
        per_text.append(np.unique(np.concatenate(windows[-len(held) :])))
    kinds = list(row)
    gram_row: dict[str, int] = {}
    gram_of = np.full((len(kinds), MOST_GRAMS), -1, np.int32)
    for k, w in enumerate(kinds):
        found = [gram_row.setdefault(g, len(gram_row)) for g in grams(w)]
        gram_of[k, : len(found)] = found
    of_texts = [x[x >= 0] for x in (np.unique(gram_of[held]) for held in per_text)]
    words_told = _telling(per_text, kinds, y_text, MOST_WORDS)
    network = Network.fresh(words_told, _telling(of_texts, list(gram_row), y_text, MOST_PIECES), dim=DIM, hidden=HIDDEN, seed=seed)
    del gram_row, gram_of, of_texts, row
    # Row 0 is a word without any known part.
    ids, rows = network.features(kinds)
    named = ids.astype(bool) | rows.any(1)
    place = np.where(named, np.cumsum(named), 0)
    ids, rows = np.r_[0, ids[named]], np.concatenate([np.zeros((1, rows.shape[1]), np.int64), rows[named]])
    at = np.zeros((len(windows), WINDOW), np.int64)
    size = np.array([len(x) for x in windows])
    for k, x in enumerate(windows):
        at[k, : len(x)] = place[x]
    del windows, kinds
    # Windows without a known part are alike; a text keeps one of them, and only if it has no other.
    owner = np.array(owner)
    counts = np.bincount(owner, minlength=len(texts))
    live = at.any(1)
    _, first = np.unique(owner, return_index=True)
    has = np.zeros(len(texts), bool)
    has[owner[live]] = True
    live[first[~has]] = True
    at, size, owner = at[live], size[live], owner[live]
    y = y_text[owner]
    adam = Adam(network.params, rate)

    def epoch(chosen: np.ndarray) -> None:
        order = draw.permutation(chosen)
        for i in range(0, len(order), 128):
            part = order[i : i + 128]
            used, local = np.unique(at[part], return_inverse=True)
            grad, dx = network.gradients(network.inputs(ids[used], rows[used]), local.reshape(len(part), WINDOW), size[part], y[part], np.ones(len(part)))
            word, at_word = np.unique(ids[used], return_inverse=True)
            held = rows[used]
            piece, at_piece = np.unique(held[held > 0], return_inverse=True)
            grad["word"], grad["piece"] = np.zeros((len(word), DIM), np.float32), np.zeros((len(piece), DIM), np.float32)
            np.add.at(grad["word"], at_word, dx[:, :DIM])
            np.add.at(grad["piece"], at_piece, (dx[:, DIM:] / 4)[np.nonzero(held)[0]])
            grad["word"][word == 0] = 0
            adam.step(grad, {"word": word, "piece": piece})

    def worst(score: np.ndarray, most: int) -> np.ndarray:
        """The windows of each text with the highest scores."""
        order = np.lexsort((-score, owner))
        begins = np.r_[True, owner[order][1:] != owner[order][:-1]]
        place = np.arange(len(order)) - np.maximum.accumulate(np.where(begins, np.arange(len(order)), 0))
        return order[place < most]

    def logits() -> np.ndarray:
        gates = network.gates(network.inputs(ids, rows))
        return np.concatenate([network.forward(gates, at[i : i + 512], size[i : i + 512]) for i in range(0, len(at), 512)])

    for _ in range(epochs[0]):
        some = worst(draw.random(len(at)), 3)
        epoch(np.union1d(some, np.flatnonzero(y == 1)))
    for k in range(epochs[1]):
        adam.rate = rate * (1 - k / epochs[1])
        now = logits()
        top = worst(now, 3)
        epoch(np.union1d(top[y[top] == 0], np.union1d(worst(now, 1), np.flatnonzero((y == 1) & (now > 0)))))
    # A text's other windows are all like row 0 and score as one of them does.
    now = logits()
    best, hits = np.full(len(texts), float(network.forward(network.gates(network.inputs(ids[:1], rows[:1])), np.zeros((1, WINDOW), np.int64), None)[0])), np.zeros(len(texts))
    seen = np.bincount(owner, minlength=len(texts))
    best[seen == counts] = -np.inf
    np.maximum.at(best, owner, now)
    np.add.at(hits, owner, now > 0)
    network.scale = _logistic(_evidence(best, hits, counts), y_text)
    return network


def held_out(id: Column) -> Column:
    return F.coalesce(F.crc32(id.cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, *, label: str = "toxic", most: int = MAX_TRAINING_ROWS, windows: int = MAX_TRAINING_WINDOWS) -> Network:
    """Learn from ``most`` labelled rows at most, outside the held-out fold, by no more than ``windows`` windows of each."""
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col("doc_id"))).select("doc_id", F.col(label).alias("y"))
    mark = F.xxhash64(F.col("doc_id").cast("string"))
    sample = usable.orderBy(mark, "doc_id", "y").limit(most)
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select(mark.alias("mark"), F.col("doc_id").cast("string").alias("name"), "y", "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [sampled(t.as_py(), m.as_py() & 0xFFFFFFFF, windows) for m, t in zip(batch.column(0), batch.column(3), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(held, pa.list_(pa.string()))], ["mark", "name", "y", "windows"])

    cuts = rows.withColumn("y", F.col("y").cast("int")).mapInArrow(cut, "mark long, name string, y int, windows array<string>")
    found = cuts.orderBy("mark", "name", "y", "windows").limit(most).collect()
    return fit([r["windows"] for r in found], [r["y"] for r in found])


def score(docs: DataFrame, network: Network, *, text: str = "text", id: str = "doc_id") -> DataFrame:
    """``doc_id, score`` of every row."""
    kind = docs.schema[id].dataType
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            found = scorer.score(batch.column(1).to_pylist()) if len(batch) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], ["doc_id", "score"])

    return docs.select(docs[id].alias("doc_id"), docs[text].alias("text")).mapInArrow(run, f"doc_id {kind.simpleString()}, score double")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    network = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score(docs, network)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
