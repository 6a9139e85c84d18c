"""Words as problems 9 and 10 define them: runs of letters or digits, without case, accents and invisible signs."""

from __future__ import annotations

import unicodedata

import numpy as np

from quipuflow.llm.flat import codes

_DROP = np.uint32(0xFFFFFFFF)
_K = np.uint64(0x9E3779B97F4A7C15)
_B = np.uint64(0xC2B2AE3D27D4EB4F)
_TABLE: list[np.ndarray] = []


def _table() -> np.ndarray:
    """Of a code point of a decomposed, lowered text: itself, 0 for what parts words, _DROP for what doesn't count."""
    if not _TABLE:
        t = np.zeros(0x110000, dtype=np.uint32)
        for i in range(0x110000):
            c = unicodedata.category(chr(i))
            if c[0] in "LN":
                t[i] = i
            elif c[0] == "M" or c == "Cf" or (c == "Cc" and not (9 <= i <= 13 or 0x1C <= i <= 0x1F or i == 0x85)):
                t[i] = _DROP
        _TABLE.append(t)
    return _TABLE[0]


def plain(text: str) -> str:
    return unicodedata.normalize("NFD", text.lower())


class Words:
    """The words of some texts: hash, text number and place of each."""

    def __init__(self, texts: list[str | None]):
        parts = [plain(t) if t else "" for t in texts]
        c = codes("\n".join(parts))
        v = _table()[c]
        lens = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) + 1
        text_at = np.cumsum(lens) - lens
        keep = v != _DROP
        where = np.flatnonzero(keep)
        v = v[keep]
        letter = v != 0
        start = np.flatnonzero(letter & np.r_[True, ~letter[:-1]]) if len(v) else np.empty(0, dtype=np.int64)
        self.signs, self.start = v, start
        self.n = len(start)
        if not self.n:
            self.hash = np.empty(0, dtype=np.uint64)
            self.text = np.empty(0, dtype=np.int64)
            self.end = start
            return
        span = np.diff(np.r_[start, len(v)])
        used = v[start[0] :]
        place = np.arange(len(used)) - np.repeat(start - start[0], span)
        power = np.ones(int(span.max()), dtype=np.uint64)
        power[1:] = _B
        power = np.multiply.accumulate(power)
        h = np.add.reduceat(used.astype(np.uint64) * _K * power[place], start - start[0])
        self.hash = (h ^ (h >> np.uint64(31))) * _K
        self.end = start + np.add.reduceat((used != 0).astype(np.int64), start - start[0])
        self.text = np.searchsorted(text_at, where[start], side="right") - 1

    def window(self, first: int, n: int) -> bytes:
        """The signs of n words from the first on, words parted by a zero; for exact comparison."""
        seg = self.signs[self.start[first] : self.end[first + n - 1]] if n else self.signs[:0]
        return seg[(seg != 0) | np.r_[False, seg[:-1] != 0]].tobytes() if n else b""

    def list(self, first: int, n: int) -> list[str]:
        return [self.signs[self.start[i] : self.end[i]].tobytes().decode("utf-32-le") for i in range(first, first + n)]

    def windows(self, n: int) -> np.ndarray:
        """First words of the windows of n words that lie within one text."""
        if self.n < n:
            return np.empty(0, dtype=np.int64)
        return np.flatnonzero(self.text[: self.n - n + 1] == self.text[n - 1 :])
