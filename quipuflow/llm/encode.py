"""Problem 8: token ids of every text by a byte-level BPE of a public tokenizer.

Words are cut by character classes in numpy, each distinct word of a batch is encoded once, and the
distinct words are merged together in rounds: the symbols of all words lie in one flat array, a
round finds for every word its pair of lowest rank by binary search over the sorted pair keys and
merges all its occurrences. Equal words are found by a hash and confirmed by their bytes; words that
only share a hash are merged by themselves, so no text's ids depend on what is encoded with it.

The tokenizer file is read on the driver, checked (a byte-level BPE of the pattern built in here,
without normalizer, of at most MOST_BYTES) and sent to the tasks, so it need not lie on their machines.

Null and empty texts give an empty list. Special tokens are never produced: their strings are
ordinary text. Extra columns are left out; ids need not be unique.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quipuflow.llm.flat import codes, groups
from quipuflow.session import spread

DEFAULT_PATH = "/opt/tokenizers/byte_bpe_50k.json"
LETTER, NUMBER, SPACE, OTHER = 0, 1, 2, 3
#: Fixed values of the tokenizer's split pattern: the endings that an apostrophe takes with it.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")
#: Fixed bound of a tokenizer file, as it is broadcast.
MOST_BYTES = 64_000_000
#: Distinct words that a worker remembers; when full, the memory starts anew.
REMEMBERED = 400_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INF = np.int32(2**31 - 1)


def _classes() -> np.ndarray:
    """Class of every code point; \\s is the property White_Space."""
    out = np.full(0x110000, OTHER, dtype=np.uint8)
    for i in range(0x110000):
        c = unicodedata.category(chr(i))[0]
        if c == "L":
            out[i] = LETTER
        elif c == "N":
            out[i] = NUMBER
        elif c == "Z":
            out[i] = SPACE
    out[9:14] = SPACE
    out[0x85] = SPACE
    return out


def _byte_of_symbol() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies use for the 256 bytes."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(rest)}


class BpeEncoder:
    """ids of texts by the vocabulary and merges of a tokenizer file."""

    def __init__(self, source: bytes):
        whole = json.loads(source)
        model, cutter = whole["model"], whole.get("pre_tokenizer") or {}
        if model.get("type", "BPE") != "BPE" or cutter.get("type") != "ByteLevel" or cutter.get("add_prefix_space") or not cutter.get("use_regex", True) or whole.get("normalizer"):
            raise ValueError("only byte-level BPE with the usual pattern and without normalizer is supported")
        vocab, stand_in = model["vocab"], _byte_of_symbol()
        self.of_byte = np.zeros(256, dtype=np.int32)
        for ch, b in stand_in.items():
            self.of_byte[b] = vocab[ch]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([(vocab[a] << 32) | vocab[b] for a, b in pairs], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int32)
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank, self.made = keys[order], order.astype(np.int32), made[order]
        self.made_by_rank = made
        self.cls = _classes()
        self._forget()

    def _forget(self) -> None:
        self.known = np.empty(0, dtype=np.uint64)
        self.start = np.empty(0, dtype=np.int64)
        self.count = np.empty(0, dtype=np.int64)
        self.ids = np.empty(0, dtype=np.int32)
        self.bytes = np.empty(0, dtype=np.uint8)  # of the known words, to compare with
        self.byte_at = np.empty(0, dtype=np.int64)
        self.size = np.empty(0, dtype=np.int64)

    def word_starts(self, c: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
        """Positions in c at which a word begins."""
        n = len(c)
        k = self.cls[c]
        edge = np.zeros(n + 1, dtype=bool)
        edge[text_starts] = True
        edge[n] = True
        new = edge[:-1].copy()
        new[1:] |= k[1:] != k[:-1]
        space = k == SPACE
        # the last space before something else: a blank goes with what follows, others stand alone
        last = np.zeros(n, dtype=bool)
        last[:-1] = space[:-1] & ~space[1:] & ~edge[1:-1]
        new[last] = True
        blank = np.flatnonzero(last & (c == 32))
        new[blank + 1] = False
        # contractions, where an apostrophe begins a word
        quote = np.flatnonzero((c == 39) & new)
        if len(quote):
            ahead = lambda d: np.where(quote + d < n, c[np.minimum(quote + d, n - 1)], 0)
            one, two = ahead(1), ahead(2)
            one = np.where(edge[np.minimum(quote + 1, n)], 0, one)
            two = np.where(edge[np.minimum(quote + 2, n)] | (one == 0), 0, two)
            taken = np.zeros(len(quote), dtype=np.int64)
            for e in reversed(ENDINGS):
                hit = (one == ord(e[0])) if len(e) == 1 else (one == ord(e[0])) & (two == ord(e[1]))
                taken[hit] = len(e)
            hit = taken > 0
            new[quote[hit] + 1] = False
            after = quote[hit] + taken[hit] + 1
            new[after[after < n]] = True
        return np.flatnonzero(new)

    def merged(self, sym: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of words after all merges, with their numbers; words lie one after another."""
        words = len(length)
        out_sym: list[np.ndarray] = []
        out_word: list[np.ndarray] = []
        wid = np.repeat(np.arange(words), length)
        while len(sym):
            inside = wid[:-1] == wid[1:]
            rank = np.full(len(sym), _INF, dtype=np.int32)
            if len(sym) > 1:
                key = (sym[:-1].astype(np.int64) << 32) | sym[1:]
                at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                rank[:-1] = np.where(inside & (self.keys[at] == key), self.rank[at], _INF)
            first = np.flatnonzero(np.r_[True, ~inside])
            low = np.minimum.reduceat(rank, first)
            span = np.diff(np.r_[first, len(sym)])
            best = np.repeat(low, span)
            live = best != _INF
            if not live.all():
                out_sym.append(sym[~live])
                out_word.append(wid[~live])
                sym, wid, rank, best = sym[live], wid[live], rank[live], best[live]
                if not len(sym):
                    break
            hit = rank == best
            # of pairs that overlap, as in a run of one sign, every second is merged from the left
            begin = np.flatnonzero(hit & np.r_[True, ~hit[:-1]])
            pos = np.arange(len(hit))
            run = np.zeros(len(hit), dtype=np.int64)
            run[begin] = begin
            run = np.maximum.accumulate(run)
            hit &= ((pos - run) & 1) == 0
            at = np.flatnonzero(hit)
            sym = sym.copy()
            sym[at] = self.made_by_rank[rank[at]]
            keep = np.ones(len(sym), dtype=bool)
            keep[at + 1] = False
            sym, wid = sym[keep], wid[keep]
        if not out_sym:
            return np.empty(0, dtype=np.int32), np.zeros(words, dtype=np.int64)
        s, w = np.concatenate(out_sym), np.concatenate(out_word)
        order = np.argsort(w, kind="stable")
        return s[order], np.bincount(w, minlength=words)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and how many each text has."""
        joined = "".join(texts)
        counts = np.zeros(len(texts), dtype=np.int64)
        if not joined:
            return np.empty(0, dtype=np.int32), counts
        c = codes(joined)
        lens = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        text_at = np.cumsum(lens) - lens
        starts = self.word_starts(c, text_at[lens > 0])
        data = np.frombuffer(joined.encode("utf-8", "surrogatepass"), dtype=np.uint8)
        width = 1 + (c >= 0x80).astype(np.int64) + (c >= 0x800) + (c >= 0x10000)
        byte_at = np.cumsum(width) - width
        b0 = byte_at[starts]
        blen = np.diff(np.r_[b0, len(data)])
        # a word's hash: polynomial over its bytes, and its length
        place = np.arange(len(data)) - np.repeat(b0, blen)
        power = np.ones(int(blen.max()), dtype=np.uint64)
        if len(power) > 1:
            power[1:] = _BASE
            power = np.multiply.accumulate(power)
        h = np.add.reduceat((data.astype(np.uint64) + np.uint64(1)) * power[place], b0)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + blen.astype(np.uint64)
        u, sample, inverse = np.unique(h, return_index=True, return_inverse=True)
        # words of one hash that aren't the one that stands for it
        twin = sample[inverse]
        odd = ~_equal(data, b0, blen, data, b0[twin], blen[twin])
        at = np.searchsorted(self.known, u)
        have = at < len(self.known)
        have[have] = self.known[at[have]] == u[have]
        fresh = np.flatnonzero(~have)
        if len(fresh) and len(self.known) > REMEMBERED:
            self._forget()
            at, fresh = np.zeros(len(u), dtype=np.int64), np.arange(len(u))
        if len(fresh):
            w = sample[fresh]
            taken = _taken(b0[w], blen[w])
            ids, n = self.merged(self.of_byte[data[taken]], blen[w])
            known = np.concatenate([self.known, u[fresh]])
            order = np.argsort(known, kind="stable")
            self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(n) - n])[order]
            self.count = np.concatenate([self.count, n])[order]
            self.byte_at = np.concatenate([self.byte_at, len(self.bytes) + np.cumsum(blen[w]) - blen[w]])[order]
            self.size = np.concatenate([self.size, blen[w]])[order]
            self.ids = np.concatenate([self.ids, ids])
            self.bytes = np.concatenate([self.bytes, data[taken]])
            self.known = known[order]
            at = np.searchsorted(self.known, u)
        # known words of the same hash as another one here
        odd |= ~_equal(data, b0[sample], blen[sample], self.bytes, self.byte_at[at], self.size[at])[inverse]
        pool, start, count = self.ids, self.start[at][inverse], self.count[at][inverse]
        if odd.any():
            w = np.flatnonzero(odd)
            ids, n = self.merged(self.of_byte[data[_taken(b0[w], blen[w])]], blen[w])
            start[w], count[w] = len(pool) + np.cumsum(n) - n, n
            pool = np.concatenate([pool, ids])
        return self._laid_out(pool, start, count, starts, text_at, lens)

    @staticmethod
    def _laid_out(ids, start, n, starts, text_at, lens):
        take = np.repeat(start - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        text = np.searchsorted(text_at + lens, starts, side="right")
        counts = np.zeros(len(lens), dtype=np.int64)
        np.add.at(counts, text, n)
        return ids[take], counts


def _taken(at: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Places of the bytes of words, one after another."""
    return np.repeat(at - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))


def _equal(a: np.ndarray, a_at: np.ndarray, a_len: np.ndarray, b: np.ndarray, b_at: np.ndarray, b_len: np.ndarray) -> np.ndarray:
    """Whether the words of a are byte by byte those of b; no word is empty."""
    same = a_len == b_len
    if same.any():
        n = a_len[same]
        equal = a[_taken(a_at[same], n)] == b[_taken(b_at[same], n)]
        same[same] = np.logical_and.reduceat(equal, np.cumsum(n) - n)
    return same


_ENCODERS: dict[str, BpeEncoder] = {}


def read(path: str) -> bytes:
    """A tokenizer file, if it keeps to the bound."""
    with open(path, "rb") as f:
        source = f.read(MOST_BYTES + 1)
    if len(source) > MOST_BYTES:
        raise ValueError(f"{path} is larger than {MOST_BYTES} bytes")
    return source


def encoder(source: bytes) -> BpeEncoder:
    """One per worker process and file."""
    name = hashlib.sha256(source).hexdigest()
    if name not in _ENCODERS:
        _ENCODERS[name] = BpeEncoder(source)
    return _ENCODERS[name]


def encode_batch(texts: list[str | None], enc: BpeEncoder) -> tuple[np.ndarray, np.ndarray]:
    ids, counts = [np.empty(0, dtype=np.int32)], [np.empty(0, dtype=np.int64)]
    for a, b in groups(texts):
        i, n = enc.encode([t or "" for t in texts[a:b]])
        ids.append(i)
        counts.append(n)
    return np.concatenate(ids), np.concatenate(counts)


def token_ids(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = DEFAULT_PATH) -> DataFrame:
    """(id_col, ids array<int>) of every row; narrow, no shuffle."""
    kind = df.schema[id_col].dataType.simpleString()

    source = read(path)
    BpeEncoder(source)  # raises here rather than in the tasks
    shared = df.sparkSession.sparkContext.broadcast(source)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(shared.value)
        for batch in batches:
            ids, counts = encode_batch(batch.column(1).to_pylist(), enc)
            offsets = pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32))
            lists = pa.ListArray.from_arrays(offsets, pa.array(ids, type=pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["id", "ids"])

    src = spread(df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")))
    return src.mapInArrow(run, f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)
