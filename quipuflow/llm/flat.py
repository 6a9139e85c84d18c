"""Texts of a batch as one flat array of code points."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

#: Code points handled at once; bounds a Python worker's memory, not what is processed.
CHARS_AT_ONCE = 1_000_000


def groups(texts: Sequence[str | None], most: int = CHARS_AT_ONCE) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most `most` characters together; a longer text stands alone."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if size and size + n > most:
            yield at, i
            at, size = i, 0
        size += n
    if at < len(texts):
        yield at, len(texts)


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
