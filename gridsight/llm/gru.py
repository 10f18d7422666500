"""A bidirectional gated recurrent network with attention pooling, in numpy.

Input is a window of words, each given by a word vector and the scaled sum of its
character-gram vectors. Both directions run as one stacked recurrence; pooled
states give one logit per window.
"""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass

import numpy as np

GRAMS = (4, 6)
#: Longer tokens are cut into several words by ``pieces``; each run of letters then shares eight characters with the next.
LONGEST, STRIDE = 24, 16
#: Grams of the longest word with its frame.
MOST_GRAMS = sum(LONGEST + 3 - n for n in GRAMS)
STRIP = ".,;:!?\"'()[]{}|#$%&*<>-_"
#: Stands where a run goes on in another word; a blank, so no token has it.
GOES_ON = "\x1f"
_MARKS = "".join(c for c in map(chr, range(0x300, 0x20000)) if unicodedata.category(c)[0] == "M")
_JOINTS = re.compile(f"((?:[^\\w{_MARKS}]|_)+)")


def pieces(token: str) -> list[str]:
    """The words of a token over ``LONGEST``: its parts between signs and the signs that are not punctuation, in overlapping runs where they are long."""
    found = []
    for part in filter(lambda x: x.strip(STRIP), _JOINTS.split(token)):
        if len(part) <= LONGEST:
            found.append(part)
            continue
        for i in range(0, len(part) - (LONGEST - STRIDE), STRIDE):
            found.append((GOES_ON if i else "") + part[i : i + LONGEST] + (GOES_ON if i + LONGEST < len(part) else ""))
    return found or [""]


def normal(word: str) -> str:
    """A word without punctuation around it."""
    return word.strip(STRIP)


def grams(word: str) -> list[str]:
    """All grams of a word between ``^`` and ``$``, which stand only where it begins and ends."""
    framed = f"^{word}$".replace(f"^{GOES_ON}", "").replace(f"{GOES_ON}$", "")
    return [framed[i : i + n] for n in GRAMS for i in range(len(framed) - n + 1)]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Network:
    """Vocabularies and parameters; row 0 of both tables is zero and stands for what is not known."""

    words: dict[str, int]
    pieces: dict[str, int]
    params: dict[str, np.ndarray]
    #: Weights of a text's evidence, then their shift.
    scale: tuple[float, ...] = (1.0, 0.0, 0.0)

    @classmethod
    def fresh(cls, words: dict[str, int], pieces: dict[str, int], *, dim: int, hidden: int, seed: int) -> Network:
        draw = np.random.default_rng(seed)

        def some(*shape: int) -> np.ndarray:
            return (draw.standard_normal(shape) / np.sqrt(shape[-2] if len(shape) > 1 else shape[0])).astype(np.float32)

        bias = np.zeros((2, 3 * hidden), np.float32)
        return cls(words, pieces, {
            "word": np.zeros((len(words) + 1, dim), np.float32), "piece": np.zeros((len(pieces) + 1, dim), np.float32),
            "w": some(2, 2 * dim, 3 * hidden), "b": bias, "u": some(2, hidden, 3 * hidden), "attend": some(2 * hidden), "out": some(2 * hidden), "bias": np.zeros(1, np.float32),
        })

    def features(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Word rows, and character-gram rows padded with 0, of normalised words."""
        ids = np.array([self.words.get(w, 0) for w in words], np.int64)
        known = [[self.pieces[g] for g in grams(w) if g in self.pieces] for w in words]
        rows = np.zeros((len(words), max(map(len, known), default=0)), np.int64)
        for k, found in enumerate(known):
            rows[k, : len(found)] = found
        return ids, rows

    def inputs(self, ids: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return np.concatenate([self.params["word"][ids], self.params["piece"][rows].sum(1) / 4], 1)

    def gates(self, x: np.ndarray) -> np.ndarray:
        """Input parts of both directions' gates: (words, 2, 3 hidden)."""
        return np.stack([x @ self.params["w"][d] + self.params["b"][d] for d in (0, 1)], 1)

    def forward(self, gates: np.ndarray, at: np.ndarray, size: np.ndarray | None, *, keep: bool = False):
        """Logits of windows. ``at`` (windows, length) picks rows of ``gates``; ``size`` has window lengths, None if all are full."""
        u = self.params["u"]
        hidden, (count, length) = u.shape[1], at.shape
        g = np.empty((length, 2, count, 3 * hidden), np.float32)
        for t in range(length):
            g[t, 0] = gates[at[:, t], 0]
            g[t, 1] = gates[at[:, length - 1 - t], 1]
        inside = None if size is None else np.arange(length)[:, None] < size[None, :]
        mask = None if inside is None else np.stack([inside, inside[::-1]], 1)[..., None].astype(np.float32)
        h = np.zeros((2, count, hidden), np.float32)
        states = np.empty((count, length, 2 * hidden), np.float32)
        tape = []
        for t in range(length):
            gh = h @ u
            zr = sigmoid(g[t, :, :, : 2 * hidden] + gh[:, :, : 2 * hidden])
            z, r = zr[:, :, :hidden], zr[:, :, hidden:]
            n = np.tanh(g[t, :, :, 2 * hidden :] + r * gh[:, :, 2 * hidden :])
            new = n + z * (h - n)
            if mask is not None:
                new = h + mask[t] * (new - h)
            if keep:
                tape.append((h, z, r, n, gh[:, :, 2 * hidden :]))
            h = new
            states[:, t, :hidden] = h[0]
            states[:, length - 1 - t, hidden:] = h[1]
        weight = states @ self.params["attend"]
        if inside is not None:
            weight = np.where(inside.T, weight, -1e9)
        weight = np.exp(weight - weight.max(1, keepdims=True))
        weight /= weight.sum(1, keepdims=True)
        pooled = np.einsum("bl,bld->bd", weight, states)
        logit = pooled @ self.params["out"] + self.params["bias"][0]
        return (logit, states, weight, pooled, tape, mask) if keep else logit

    def gradients(self, x: np.ndarray, at: np.ndarray, size: np.ndarray, y: np.ndarray, importance: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Gradients of the mean weighted log loss by parameter, and by the inputs ``x`` of the words."""
        p = self.params
        logit, states, weight, pooled, tape, mask = self.forward(self.gates(x), at, size, keep=True)
        count, length = at.shape
        hidden = p["u"].shape[1]
        d_logit = ((sigmoid(logit) - y) * importance / importance.sum()).astype(np.float32)
        grad = {"out": pooled.T @ d_logit, "bias": d_logit.sum(keepdims=True)}
        d_pooled = d_logit[:, None] * p["out"]
        d_states = weight[:, :, None] * d_pooled[:, None, :]
        d_weight = np.einsum("bld,bd->bl", states, d_pooled)
        d_score = weight * (d_weight - (weight * d_weight).sum(1, keepdims=True))
        grad["attend"] = np.einsum("bl,bld->d", d_score, states)
        d_states += d_score[:, :, None] * p["attend"]
        d_gates = np.zeros((len(x), 2, 3 * hidden), np.float32)
        grad["u"] = np.zeros_like(p["u"])
        dh = np.zeros((2, count, hidden), np.float32)
        back = p["u"].transpose(0, 2, 1)
        for t in reversed(range(length)):
            h, z, r, n, gn = tape[t]
            dh = dh + np.stack([d_states[:, t, :hidden], d_states[:, length - 1 - t, hidden:]])
            live = dh if mask is None else dh * mask[t]
            dn = live * (1 - z) * (1 - n * n)
            dz = live * (h - n) * z * (1 - z)
            dr = dn * gn * r * (1 - r)
            by_state = np.concatenate([dz, dr, dn * r], 2)
            by_input = np.concatenate([dz, dr, dn], 2)
            grad["u"] += h.transpose(0, 2, 1) @ by_state
            np.add.at(d_gates[:, 0], at[:, t], by_input[0])
            np.add.at(d_gates[:, 1], at[:, length - 1 - t], by_input[1])
            dh = (dh - live) + live * z + by_state @ back
        grad["w"] = np.stack([x.T @ d_gates[:, d] for d in (0, 1)])
        grad["b"] = d_gates.sum(0)
        return grad, sum(d_gates[:, d] @ p["w"][d].T for d in (0, 1))


class Adam:
    """Adam on whole arrays, and on touched rows of the tables."""

    def __init__(self, params: dict[str, np.ndarray], rate: float):
        self.params, self.rate, self.t = params, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}

    def step(self, grads: dict[str, np.ndarray], rows: dict[str, np.ndarray]) -> None:
        self.t += 1
        fix = self.rate * np.sqrt(1 - 0.999**self.t) / (1 - 0.9**self.t)
        for k, g in grads.items():
            at = rows.get(k, slice(None))
            self.m[k][at] = m = 0.9 * self.m[k][at] + 0.1 * g
            self.v[k][at] = v = 0.999 * self.v[k][at] + 0.001 * g * g
            self.params[k][at] -= fix * m / (np.sqrt(v) + 1e-8)
