"""Problem 2: items over a size limit, cut at natural boundaries with overlap.

Every position of an item is a legal end of a piece; its level says how natural it is (after a
paragraph, a line, a sentence, a clause, a word, or anywhere). A table gives for each end the best
end of the piece after it: of the ends within reach, those of the best level present in the second
half of the piece, or else in the first, so long as the piece goes on beyond the one before, and of them the farthest; anywhere only where there is no other. By squaring this table (pointer doubling) all cuts that
follow from the first are marked in a logarithmic number of steps, without walking along them.

A piece begins `overlap` characters before the end of the one before it and holds at most `limit`
characters, so the pieces without their overlaps, put together, are the item. Items within the limit
come out as one piece; null items give none, empty ones one empty piece.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quipuflow.llm.flat import codes

LIMIT = 2048
OVERLAP = 200
_SPACE = (9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x2028, 0x2029, 0x3000, *range(0x2000, 0x200B))
_SENTENCE = (*map(ord, ".!?…。！？؟।॥۔።፧"),)
_CLOSING = (*map(ord, "\"'”’»)]」』）"),)
_CLAUSE = (*map(ord, ",;:،؛，、；：፤、—–"),)
_WIDE = (0x2E80, 0xFFFF)
LEVELS = ("anywhere", "word", "clause", "sentence", "line", "paragraph")


def levels(c: np.ndarray) -> np.ndarray:
    """Level of the cut before each position 0..n: 0 anywhere to 5 after a paragraph."""
    n = len(c)
    out = np.zeros(n + 1, dtype=np.int8)
    if not n:
        return out
    space = np.isin(c, _SPACE)
    out[1:][space] = 1
    nl = c == 10
    here = np.arange(n, dtype=np.int32)
    solid = np.maximum.accumulate(np.where(space, -1, here))  # last position that isn't blank
    before = np.where(solid >= 0, c[np.maximum(solid, 0)], 0)
    closing = np.isin(before, _CLOSING)
    prior = np.where(closing & (solid > 0), c[np.maximum(solid - 1, 0)], before)
    stop = np.isin(before, _SENTENCE) | (closing & np.isin(prior, _SENTENCE))
    clause = np.isin(before, _CLAUSE)
    wide = (before >= _WIDE[0]) & (before <= _WIDE[1])
    cut = out[1:]
    cut[clause & (space | wide)] = 2
    nxt_closing = np.r_[np.isin(c[1:], _CLOSING), False]
    cut[stop & (space | (wide & ~nxt_closing))] = 3
    cut[nl] = 4
    lines = np.flatnonzero(nl)
    if len(lines) > 1:
        a, b = lines[:-1], lines[1:]
        blanks = np.r_[0, np.cumsum(~space)]
        cut[b[blanks[b] == blanks[a]]] = 5
    # a cut belongs behind a run of blanks, not inside it
    inner = np.r_[space[1:], False] & space
    cut[inner & (cut < 4)] = 0
    # signs that stand on the one before them stay with it
    mark = np.r_[((c[1:] >= 0x300) & (c[1:] <= 0x36F)) | (c[1:] == 0x200D) | ((c[1:] >= 0xFE00) & (c[1:] <= 0xFE0F)), False]
    cut[mark] = -1
    return out


def cuts(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> np.ndarray:
    """Ends of the pieces, ascending; the last is the length."""
    n = len(text)
    if n <= limit:
        return np.array([n])
    if not 0 <= overlap < limit // 2:
        raise ValueError("the overlap must be less than half the limit")
    lev = levels(codes(text))
    end = np.arange(n + 1)
    origin = np.maximum(end - overlap, 0)
    reach = np.minimum(origin + limit, n)
    half = np.maximum(origin + limit // 2, end + 1)
    succ = reach.copy()
    open_ = reach < n
    for level, floor in [*((x, half) for x in range(5, 0, -1)), *((x, end + 1) for x in range(5, 0, -1)), (0, half)]:
        at = np.flatnonzero(lev >= level)
        if not len(at):
            continue
        k = np.searchsorted(at, reach, side="right") - 1
        best = at[np.maximum(k, 0)]
        fits = open_ & (k >= 0) & (best >= floor)
        succ[fits] = best[fits]
        open_ &= ~fits
    marked = np.zeros(n + 1, dtype=bool)
    first = int(succ[0])
    marked[first] = True
    table = succ.copy()
    table[n] = n
    while True:
        grown = marked.copy()
        grown[table[marked]] = True
        if (grown == marked).all():
            break
        marked = grown
        table = table[table]
    return np.flatnonzero(marked)


def pieces(df: DataFrame, keys: list[str], text_col: str = "content", limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """keys, piece_no from 1, n_pieces, char_start, char_end (exclusive), piece; one row per piece."""
    whole = df.where(F.col(text_col).isNotNull()).select(*keys, F.col(text_col).cast("string").alias("_text"))
    schema = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            row, no, count, start, end, text = [], [], [], [], [], []
            for i, t in enumerate(pdf["_text"]):
                ends = cuts(t, limit, overlap).tolist()
                begins = [0] + [max(0, e - overlap) for e in ends[:-1]]
                row += [i] * len(ends)
                no += range(1, len(ends) + 1)
                count += [len(ends)] * len(ends)
                start += begins
                end += ends
                text += [t[a:b] for a, b in zip(begins, ends)]
            out = pdf.iloc[row][keys].reset_index(drop=True)
            out["piece_no"], out["n_pieces"], out["char_start"], out["char_end"], out["piece"] = no, count, start, end, text
            yield out

    return whole.mapInPandas(run, f"{schema}, piece_no int, n_pieces int, char_start int, char_end int, piece string")


def items(interim: DataFrame, raw: DataFrame) -> DataFrame:
    """(item_table, item_key, chunk_index, content) of all chunks and pages."""
    chunks = interim.select(F.lit("interim_docs").alias("item_table"), F.col("source").alias("item_key"), F.posexplode("chunks").alias("chunk_index", "content"))
    pages = raw.select(F.lit("raw_pages").alias("item_table"), F.col("page_id").cast("string").alias("item_key"), F.lit(-1).alias("chunk_index"), "content")
    return chunks.unionByName(pages)
