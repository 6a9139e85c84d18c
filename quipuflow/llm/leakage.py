"""Problem 9: evaluation texts that stand, whole or in part, in a corpus.

Windows of as many words as a leak needs are embedded by the CGK random walk: a pointer walks along
the window, at each step its word is put out and a random bit of step and word says whether the
pointer moves on, so that windows a small edit distance apart become strings a small Hamming
distance apart. Bit sampling of the embedding gives the LSH keys; it is repeated as often as the
recall asked for needs (once for no edits, where equal windows have equal embeddings). With edits the windows
of a document are also taken so many words shorter and longer. Candidates are confirmed by the edit distance of their words.

Before the embedding, windows are passed over that can't be within the edits: those that hold more words unknown
to all items than edits are allowed, as each such word costs an edit, and those without a run of words
that an item has too, so long as e edits must leave one of e + 1 parts of a window intact. No leak is lost by that.

Items of at most BLOCK_CHARS characters are sent to all tasks as a table of keys, and the documents are read once
without a shuffle. More are joined by their keys: the documents are still read once, windows whose
key isn't in a filter of fixed size over all items' keys are left out (it lets some pass, and loses none), and the rest meets the items in a
salted join.

Null and empty texts, and texts shorter than a window, leak nothing. Repeated ids are one document
or item. Extra columns are left out.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from quipuflow.llm.flat import groups
from quipuflow.llm.words import Words
from quipuflow.session import cut, spread

WINDOW = 10
RECALL = 0.99
#: Positions of the embedding that one LSH key samples.
SAMPLED = 12
#: Characters of items that are sent to all tasks; more are joined.
BLOCK_CHARS = 8_000_000
#: Bits of the filter over the keys of more items: 16 MB, whatever their number.
FILTER_BITS = 1 << 27
SALTS = 8
SEED = 20_11
_MIX = np.uint64(0xFF51AFD7ED558CCD)


def lsh_keys(words: np.ndarray, first: np.ndarray, window: int, reps: int, sampled: int, length: int | None = None) -> np.ndarray:
    """reps x len(first) keys of the windows of `length` (or `window`) word hashes that begin at first; each repetition walks anew."""
    steps = 3 * window
    length = window if length is None else length
    keys = np.zeros((reps, len(first)), dtype=np.uint64)
    for r in range(reps):
        rng = np.random.default_rng(SEED + r)
        odd = rng.integers(1, 2**63, size=steps, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        weight = rng.integers(1, 2**63, size=steps, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        picks = set(rng.choice(steps, size=min(sampled, steps), replace=False).tolist())
        i = np.zeros(len(first), dtype=np.int64)
        for j in range(max(picks) + 1):
            inside = i < length
            x = np.where(inside, words[first + np.minimum(i, length - 1)], np.uint64(0))
            if j in picks:
                keys[r] += (x ^ (x >> np.uint64(32))) * weight[j]
            i += inside & (((x * odd[j]) >> np.uint64(63)) == 1)
        keys[r] = (keys[r] ^ (keys[r] >> np.uint64(33))) * _MIX + np.uint64(r)
    return keys


def run_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the run of n words from each word on; runs may go over the end of a text."""
    if len(words) < n:
        return np.empty(0, dtype=np.uint64)
    rng = np.random.default_rng(SEED + n)
    out = np.zeros(len(words) - n + 1, dtype=np.uint64)
    for i, c in enumerate(rng.integers(1, 2**63, size=n, dtype=np.uint64)):
        x = words[i : i + len(out)]
        out += (x ^ (x >> np.uint64(29))) * (c * np.uint64(2) + np.uint64(1))
    return (out ^ (out >> np.uint64(33))) * _MIX


def intact(window: int, edits: int) -> int:
    """Words of a run that so many edits must leave intact in a window."""
    return max(1, window // (edits + 1))


def with_runs(known: np.ndarray, first: np.ndarray, length: int, n: int) -> np.ndarray:
    """Those of the windows of `length` words in which a known run of n words begins and ends."""
    total = np.r_[0, np.cumsum(known)]
    end = np.minimum(first + length - n + 1, len(known))
    return first[total[np.maximum(end, first)] > total[np.minimum(first, len(known))]]


def edited(words: list, edits: int, rng: np.random.Generator) -> list:
    """words after so many random substitutions, insertions and deletions."""
    out = list(words)
    for _ in range(edits):
        at, kind = int(rng.integers(0, len(out))), int(rng.integers(0, 3))
        out[at : at + (kind != 1)] = [] if kind == 2 else [int(rng.integers(1, 2**63))]
    return out


def repetitions(window: int, edits: int, recall: float = RECALL) -> tuple[int, int]:
    """(keys, positions sampled by each) so that a window `edits` away meets its item with probability `recall`.

    Without edits equal windows have equal embeddings, so one key does. Otherwise the chance that a repetition brings a
    pair together is measured on random windows with random edits, pair by pair, as it differs with where the edits are.
    """
    if not edits:
        return 1, SAMPLED
    sampled = max(4, SAMPLED - 4 * edits)
    rng = np.random.default_rng(SEED)
    n, trials = 400, 60
    a = [rng.integers(1, 2**63, size=window).tolist() for _ in range(n)]
    b = [edited(x, edits, rng) for x in a]
    ka = lsh_keys(np.array(a, dtype=np.uint64).ravel(), np.arange(n) * window, window, trials, sampled)
    kb = np.zeros_like(ka)
    for length in {len(x) for x in b}:
        own = [i for i, x in enumerate(b) if len(x) == length]
        flat = np.array([b[i] for i in own], dtype=np.uint64).ravel()
        kb[:, own] = lsh_keys(flat, np.arange(len(own)) * length, window, trials, sampled, length)
    met = (ka == kb).mean(axis=0)
    reps = 1
    while reps < 500 and 1 - ((1 - met) ** reps).mean() < recall:
        reps += 1
    return reps, sampled


def edit_distance(a: list[str], b: list[str], most: int) -> int:
    """Edits between two lists of words, or more than `most`."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def _among(table: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Whether each of x is in a sorted table."""
    return table[np.minimum(np.searchsorted(table, x), len(table) - 1)] == x if len(table) else np.zeros(len(x), dtype=bool)


def within(a: np.ndarray, b: np.ndarray, edits: int) -> np.ndarray:
    """Of each row of a and of b, hashes of words, whether they are within so many edits: a band of the table of all rows at once."""
    n, m = a.shape[1], b.shape[1]
    if abs(n - m) > edits:
        return np.zeros(len(a), dtype=bool)
    far = np.full(len(a), edits + 1, dtype=np.int16)
    row = {o: np.full(len(a), o, dtype=np.int16) if 0 <= o <= m else far for o in range(-edits, edits + 1)}
    for i in range(1, n + 1):
        new: dict[int, np.ndarray] = {}
        for o in range(-edits, edits + 1):
            k = i + o
            if k < 0 or k > m:
                new[o] = far
            elif k == 0:
                new[o] = np.full(len(a), i, dtype=np.int16)
            else:
                best = row[o] + (a[:, i - 1] != b[:, k - 1])
                if o < edits:
                    best = np.minimum(best, row[o + 1] + 1)
                if o > -edits:
                    best = np.minimum(best, new[o - 1] + 1)
                new[o] = best
        row = new
    return row[m - n] <= edits


#: Pairs of windows compared at once; bounds a Python worker's memory, not what is compared.
PAIRS_AT_ONCE = 500_000


class ItemIndex:
    """LSH table of the windows of some items; equal windows are one, with the items that hold it."""

    def __init__(self, ids: list, texts: list[str | None], window: int, edits: int, recall: float):
        self.window, self.edits = window, edits
        self.reps, self.sampled = repetitions(window, edits, recall)
        w = Words(texts)
        self.vocabulary = np.unique(w.hash)
        self.bits = np.zeros(1 << 22, dtype=bool)
        self.bits[self.vocabulary >> np.uint64(42)] = True
        self.intact = intact(window, edits)
        self.runs = np.unique(run_hashes(w.hash, self.intact))
        number: dict[bytes, int] = {}
        places: list[int] = []
        self.items: list[set] = []
        for f in w.windows(window).tolist():
            k = number.setdefault(w.window(f, window), len(number))
            if k == len(places):
                places.append(f)
                self.items.append(set())
            self.items[k].add(ids[w.text[f]])
        self.words = list(number)
        first = np.array(places, dtype=np.int64)
        self.hashes = w.hash[first[:, None] + np.arange(window)] if len(first) else np.empty((0, window), dtype=np.uint64)
        keys = lsh_keys(w.hash, first, window, self.reps, self.sampled).ravel()
        order = np.argsort(keys, kind="stable")
        self.keys, self.of = keys[order], np.tile(np.arange(len(first)), self.reps)[order]

    def search(self, texts: list[str | None]) -> set[tuple[int, object]]:
        """(text number, item id) of all leaks."""
        w = Words(texts)
        out: set[tuple[int, object]] = set()
        if not w.n or not len(self.keys):
            return out
        known = self.bits[w.hash >> np.uint64(42)]
        at = np.flatnonzero(known)
        known[at] = _among(self.vocabulary, w.hash[at])
        total = np.r_[0, np.cumsum(known)]
        alike = _among(self.runs, run_hashes(w.hash, self.intact)) if self.edits else None
        sure: set[tuple[int, int]] = set()  # (text, window of items)
        for length in lengths(self.window, self.edits):
            first = w.windows(length)
            first = first[total[first + length] - total[first] >= length - self.edits]
            if self.edits:
                first = with_runs(alike, first, length, self.intact)
            for a in range(0, len(first), 20_000):
                self._confirmed(w, first[a : a + 20_000], length, sure)
        for text, k in sure:
            out |= {(text, item) for item in self.items[k]}
        return out

    def _confirmed(self, w: Words, first: np.ndarray, length: int, sure: set[tuple[int, int]]) -> None:
        """Adds to sure what the windows of `length` words that begin at first are within the edits of."""
        pairs = []
        for keys in lsh_keys(w.hash, first, self.window, self.reps, self.sampled, length):
            low = np.searchsorted(self.keys, keys)
            n = np.searchsorted(self.keys, keys, side="right") - low
            hit = np.flatnonzero(n)
            if len(hit):
                at = np.repeat(low[hit] - (np.cumsum(n[hit]) - n[hit]), n[hit]) + np.arange(int(n[hit].sum()))
                pairs.append(np.repeat(hit, n[hit]) * len(self.words) + self.of[at])
        if not pairs:
            return
        pairs = np.sort(np.concatenate(pairs))
        pairs = pairs[np.r_[True, pairs[1:] != pairs[:-1]]]
        for a in range(0, len(pairs), PAIRS_AT_ONCE):
            mine, theirs = np.divmod(pairs[a : a + PAIRS_AT_ONCE], len(self.words))
            close = within(w.hash[first[mine][:, None] + np.arange(length)], self.hashes[theirs], self.edits)
            for i, k in zip(first[mine[close]].tolist(), theirs[close].tolist()):
                pair = (int(w.text[i]), k)
                # hashes may lie: the words themselves decide
                if pair not in sure and (w.window(i, length) == self.words[k] if not self.edits else edit_distance(w.list(i, length), _listed(self.words[k]), self.edits) <= self.edits):
                    sure.add(pair)


def _listed(window: bytes) -> list[str]:
    return window.decode("utf-32-le").split("\0")


def lengths(window: int, edits: int) -> range:
    """Words that a document's window may have to be within the edits of an item's."""
    return range(max(1, window - edits), window + edits + 1)


_INDEXES: dict[str, ItemIndex] = {}


def leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, edits: int = 0, recall: float = RECALL) -> DataFrame:
    """(doc_id, item_id) of every document and item with `window` words in common, up to `edits` edits of words."""
    chosen = items.select(F.col(item_id).alias("item"), F.col(item_text).cast("string").alias("text")).where(F.length("text") > 0)
    size = chosen.agg(F.sum(F.length("text")).cast("long")).first()[0] or 0
    least = 2 * (window - edits) - 1
    src = spread(docs.select(F.col(doc_id).alias("doc"), F.col(text_col).cast("string").alias("text")).where(F.length("text") >= least))
    found = _searched(src, chosen, window, edits, recall) if size <= BLOCK_CHARS else _joined(src, chosen, window, edits, recall)
    return found.select(F.col("doc").alias(doc_id), F.col("item").alias(item_id)).distinct()


def _searched(src: DataFrame, chosen: DataFrame, window: int, edits: int, recall: float) -> DataFrame:
    """(doc, item), with all items in every task; their size is bounded by BLOCK_CHARS."""
    rows = chosen.collect()
    block = src.sparkSession.sparkContext.broadcast(([r.item for r in rows], [r.text for r in rows]))
    name = uuid.uuid4().hex  # of this search, so that no worker takes another one's index for it
    item_type = to_arrow_type(chosen.schema["item"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _INDEXES:
            _INDEXES.clear()
            _INDEXES[name] = ItemIndex(*block.value, window, edits, recall)
        index = _INDEXES[name]
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            pairs = [(ids[a + n], item) for a, b in groups(texts) for n, item in sorted(index.search(texts[a:b]))]
            docs_, items_ = [p[0] for p in pairs], [p[1] for p in pairs]
            yield pa.RecordBatch.from_arrays([pa.array(docs_, type=batch.schema.field(0).type), pa.array(items_, type=item_type)], names=["doc", "item"])

    return src.mapInArrow(run, f"doc {src.schema['doc'].dataType.simpleString()}, item {chosen.schema['item'].dataType.simpleString()}")


def _windows(df: DataFrame, id_col: str, window: int, edits: int, reps: int, sampled: int, sizes: range, only: Broadcast | None = None) -> DataFrame:
    """(id, key, words) of the windows of texts, each once a text and key.

    only: two filters; those windows whose key may be in the first, and that hold a run that may be in the second.
    """
    run_of = intact(window, edits)
    id_type = to_arrow_type(df.schema[id_col].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in groups(texts):
                w = Words(texts[a:b])
                seen: set[tuple] = set()
                for length in sizes:
                    first = w.windows(length)
                    if only is not None and edits:
                        first = with_runs(_may_hold(only.value[1], run_hashes(w.hash, run_of)), first, length, run_of)
                    keys = lsh_keys(w.hash, first, window, reps, sampled, length)
                    for r in range(reps):
                        at = np.arange(len(first)) if only is None else np.flatnonzero(_may_hold(only.value[0], keys[r]))
                        for i in at.tolist():
                            f = int(first[i])
                            seen.add((a + int(w.text[f]), int(keys[r, i].astype(np.int64)), w.window(f, length)))
                out = list(seen)
                yield pa.RecordBatch.from_arrays([pa.array([ids[x[0]] for x in out], type=id_type), pa.array([x[1] for x in out], type=pa.int64()), pa.array([x[2] for x in out], type=pa.binary())], names=["id", "key", "words"])

    return df.select(id_col, "text").mapInArrow(run, f"id {df.schema[id_col].dataType.simpleString()}, key long, words binary")


def _runs(df: DataFrame, n: int) -> DataFrame:
    """(key) of the runs of n words of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for a, b in groups(texts):
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(run_hashes(Words(texts[a:b]).hash, n)).view(np.int64))], names=["key"])

    return df.select("text").mapInArrow(run, "key long")


def _places(keys: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Two bits of the filter for each key."""
    k = keys.astype(np.uint64)
    return ((k >> np.uint64(7)) % np.uint64(size)).astype(np.int64), (((k * _MIX) >> np.uint64(20)) % np.uint64(size)).astype(np.int64)


def _may_hold(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    a, b = _places(keys, len(bits) << 3)
    return ((bits[a >> 3] >> (a & 7)) & (bits[b >> 3] >> (b & 7)) & 1) == 1


def _filter(keys: DataFrame, size: int) -> np.ndarray:
    """A Bloom filter of fixed size over the keys: their bits are put together by byte before they are collected."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = np.unique(np.concatenate(_places(batch.column(0).to_numpy().view(np.uint64), size)))
            yield pa.RecordBatch.from_arrays([pa.array(places >> 3, type=pa.int64()), pa.array((1 << (places & 7)).astype(np.int32))], names=["byte", "bit"])

    got = keys.select("key").mapInArrow(run, "byte long, bit int").groupBy("byte").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(size >> 3, dtype=np.uint8)
    out[got.column("byte").to_numpy()] = got.column("bits").to_numpy().astype(np.uint8)
    return out


def _joined(src: DataFrame, chosen: DataFrame, window: int, edits: int, recall: float) -> DataFrame:
    """(doc, item), by a join on the keys of windows."""
    reps, sampled = repetitions(window, edits, recall)
    theirs = cut(_windows(spread(chosen), "item", window, edits, reps, sampled, range(window, window + 1)))
    bits = src.sparkSession.sparkContext.broadcast((_filter(theirs, FILTER_BITS), _filter(_runs(spread(chosen), intact(window, edits)), FILTER_BITS) if edits else None))
    ours = _windows(src, "doc", window, edits, reps, sampled, lengths(window, edits), bits)
    ours = ours.select(F.col("id").alias("doc"), "key", F.col("words").alias("own"), F.pmod(F.xxhash64("id", "words"), F.lit(SALTS)).cast("int").alias("salt"))
    theirs = theirs.select(F.col("id").alias("item"), "key", "words", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    met = ours.join(theirs, ["key", "salt"])
    if not edits:
        return met.where(F.col("own") == F.col("words")).select("doc", "item")

    def near(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            keep = [edit_distance(_listed(a), _listed(b), edits) <= edits for a, b in zip(pdf["own"], pdf["words"])]
            yield pdf.loc[keep, ["doc", "item"]]

    schema = f"doc {src.schema['doc'].dataType.simpleString()}, item {chosen.schema['item'].dataType.simpleString()}"
    return met.select("doc", "item", "own", "words").distinct().mapInPandas(near, schema)
