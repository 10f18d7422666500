"""Texts cut where no tokenizer merge can reach across, and a memo of encoded pieces.

A cut is made at a single blank between two characters that are not blank. The
pre-tokenizer pattern of byte-level vocabularies starts a new match at such a
blank whatever stands around it, and the sentence-piece vocabulary has no piece
with its blank sign after another sign; so the pieces' encodings, in a row, are
the text's. Pieces that begin or end with white space stay whole and are never
looked up again.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from itertools import islice

CUT = re.compile(r"(?<=[^\s▁]) (?=[^\s▁])")
#: Entries of a memo, those it keeps when it is full (the first met, so the frequent ones), and the longest piece it holds, in characters.
MEMO_ENTRIES, MEMO_KEPT, MEMO_LENGTH = 1_000_000, 500_000, 64


def _open(part: str) -> bool:
    return not part or part[0].isspace() or part[-1].isspace() or "▁" in part


def stretches(text: str, size: int) -> Iterator[str]:
    """A text at safe cuts, each stretch of ``size`` characters or a little more; the blanks at the cuts are left out."""
    start = 0
    while len(text) - start > size:
        cut = CUT.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.end()
    yield text[start:] if start else text


class Memo:
    """Encodings of pieces; ``encode`` gets a list of pieces that are not known yet.

    Pieces in ``known`` begin and end with a character that is not blank, so a text
    cut at every blank is cut safely if its other pieces do, too.
    """

    def __init__(self, encode: Callable[[list[str]], Iterable], *, batch_bytes: int = 1 << 18):
        self.encode, self.known, self.batch_bytes = encode, {}, batch_bytes

    def _batches(self, parts: Iterable[str]) -> Iterator[tuple[list[str], list]]:
        """Pieces and their encodings, made in batches of about ``batch_bytes`` in UTF-8."""
        batch: list[str] = []
        size = 0
        for part in parts:
            batch.append(part)
            size += len(part) if part.isascii() else len(part.encode())
            if size >= self.batch_bytes:
                yield batch, list(self.encode(batch))
                batch, size = [], 0
        if batch:
            yield batch, list(self.encode(batch))

    def _cut(self, text: str) -> tuple[list[str], set[str]]:
        """Pieces of a text, and those after the first that are not known."""
        parts = text.split(" ")
        new = set(parts[1:]).difference(self.known)
        if _open(parts[0]) or any(map(_open, new)):
            parts = CUT.split(text)
            new = set(parts[1:]).difference(self.known)
        return parts, new

    def _learn(self, new: set[str], ends: set[str]) -> dict:
        """Encode pieces not known; those that are never looked up again, too long or in ``ends``, are returned."""
        known, extra = self.known, {}
        for batch, values in self._batches(new):
            if not ends and max(map(len, batch)) <= MEMO_LENGTH:
                known.update(zip(batch, values, strict=True))
            else:
                for part, value in zip(batch, values, strict=True):
                    (extra if len(part) > MEMO_LENGTH or part in ends else known)[part] = value
        return extra

    def _trim(self) -> None:
        if len(self.known) > MEMO_ENTRIES:
            self.known = dict(islice(self.known.items(), MEMO_KEPT))

    def all_of(self, texts: list[str]) -> tuple[list[list[str]], Callable[[str], object]]:
        """The pieces of each text, and a function from a piece that follows a blank to its encoding.

        Pieces met for the first time are encoded together, whichever texts they are from.
        """
        self._trim()
        cut, new, ends = [], set(), set()
        for text in texts:
            parts, unknown = self._cut(text)
            cut.append(parts)
            new |= unknown
            # Only the first and the last piece of a safe cut can begin or end with a blank.
            if len(parts) > 1 and parts[-1] in unknown and _open(parts[-1]):
                ends.add(parts[-1])
        known, extra = self.known, self._learn(new, ends)
        if not extra:
            return cut, known.__getitem__
        return cut, lambda part: known[part] if part in known else extra[part]

    def encoded(self, texts: list[str]) -> Iterator[tuple[str, list]]:
        """The first piece of each text, and the encodings of the others, each as a piece that follows a blank.

        As ``all_of``, but a piece that is known is looked up once. No encoding is empty.
        """
        self._trim()
        look, held, new, ends = self.known.get, [], set(), set()
        for text in texts:
            first, *rest = text.split(" ")
            values = list(map(look, rest))
            unknown = set() if all(values) else {p for p, v in zip(rest, values) if v is None}
            if _open(first) or any(map(_open, unknown)):
                first, *rest = CUT.split(text)
                values = list(map(look, rest))
                unknown = {p for p, v in zip(rest, values) if v is None}
                if rest and rest[-1] in unknown and _open(rest[-1]):
                    ends.add(rest[-1])
            new |= unknown
            held.append((first, values, [(k, p) for k, (p, v) in enumerate(zip(rest, values)) if v is None] if unknown else []))
        extra = self._learn(new, ends)
        for first, values, gaps in held:
            for k, part in gaps:
                values[k] = look(part) or extra[part]
            yield first, values

    def of(self, text: str) -> tuple[list[str], list]:
        """The pieces of a text, and the encodings of all but the first, each as a piece that follows a blank."""
        (parts,), value = self.all_of([text])
        return parts, list(map(value, parts[1:]))
