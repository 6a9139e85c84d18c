"""Problem 1: the sentences of texts in many languages and scripts.

Candidate boundaries stand after the end marks of a script (with the quotes, brackets and note marks
that follow them), inside of quotes and brackets too, and, in Thai, at blanks. A maximum-entropy model decides each one from features of
the neighbouring tokens: how often the corpus ends paragraphs with the token before and begins them
with the token after, case, length, digits, script, quotation and brackets. No list of abbreviations is used:
the paragraph counts tell them. They come from all texts, by partial aggregation. Those of frequent tokens go to all tasks, those of the others are
joined to the texts that hold them, so that no token goes without its counts.

The model is trained here, on reliable boundaries of a bounded sample of pages (SAMPLE_PAGES):
paragraph ends and candidates between frequent paragraph ends and beginnings are boundaries;
candidates after tokens that surely never end a paragraph, or before tokens that surely never begin
one, are none, nor are those inside of quotes and brackets that are closed in their paragraph, or Thai blanks beside numbers. CERTAIN holds what
is known of any corpus, for samples without Thai or speech.

The texts are read once. What each says of its paragraphs and candidates is kept in the checkpoint
folder; the counts, the sample and the decisions read only that.

A blank line always ends a sentence, a line break alone never does. Null, empty and blank texts have
no sentences. Places are code points, 0-based, end exclusive, without white space at either end.
"""

from __future__ import annotations

import bisect
import copy
import itertools
import math
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipuflow.session import cut, spread

SAMPLE_PAGES = 600
#: Tokens that make up less than this share of all candidates are joined to the texts; at most 1 / share are sent to all tasks.
LEAST_SHARE = 1e-5
#: A token never ends or begins a paragraph if that would have at most this chance by luck.
LUCK = 1e-3
_CLOSE = "\"'”’»)\\]」』）》】›"
_BREAK = re.compile(r"\r?\n[^\S\n]*\r?\n\s*|\r[^\S\r\n]*\r\s*| ")
_CAND = re.compile(rf"([.!?…。！？؟।॥۔።፧፨｡]+)([{_CLOSE}]*(?:\[\d{{1,4}}\])*[{_CLOSE}]*)(\s*)")
_LAST = re.compile(rf"([.!?…。！？؟।॥۔።፧፨｡]+)[{_CLOSE}]*(?:\[\d{{1,4}}\])*[{_CLOSE}]*\Z")
_WIDE_MARK = frozenset("。！？…｡")
_PAIRS = {"“": "”", "«": "»", "「": "」", "『": "』", "(": ")", "（": "）", "《": "》", "‹": "›", "[": "]"}
_THAI = re.compile(r"[฀-๿]")
_OPEN = "¿¡\"'“‘«(（「『《["


def _script(ch: str) -> str:
    o = ord(ch)
    if o < 0x370:
        return "latin"
    if 0x0E00 <= o < 0x0E80:
        return "thai"
    if 0x2E80 <= o < 0xA4D0 or 0xAC00 <= o < 0xD7B0 or 0xF900 <= o < 0xFB00 or 0xFF00 <= o:
        return "wide"
    return f"u{o >> 8:x}"


def paragraphs(text: str) -> Iterator[tuple[int, int]]:
    """Places of the paragraphs, without white space at their ends."""
    at = 0
    for m in [*_BREAK.finditer(text), None]:
        end = m.start() if m else len(text)
        part = text[at:end]
        a = at + len(part) - len(part.lstrip())
        b = at + len(part.rstrip())
        if a < b:
            yield a, b
        at = m.end() if m else end


_BRACKETS = re.compile("[" + re.escape("\"" + "".join(_PAIRS) + "".join(_PAIRS.values())) + "]")


class _Depth:
    """How deep each place lies in quotes and brackets that are closed in the paragraph; opener of each closer."""

    def __init__(self, p: str):
        self.opener: dict[int, int] = {}
        stack: list[tuple[str, int]] = []
        straight = -1
        for m in _BRACKETS.finditer(p):
            c, i = m[0], m.start()
            if c == '"':
                if straight >= 0:
                    self.opener[i], straight = straight, -1
                else:
                    straight = i
            elif c in _PAIRS:
                stack.append((_PAIRS[c], i))
            elif any(c == x for x, _ in stack):
                while stack:
                    want, at = stack.pop()
                    if want == c:
                        self.opener[i] = at
                        break
        edges = sorted([(a, 1) for a in self.opener.values()] + [(b, -1) for b in self.opener])
        self.at = [e[0] for e in edges]
        self.deep = list(itertools.accumulate(e[1] for e in edges))

    def __getitem__(self, i: int) -> int:
        k = bisect.bisect_right(self.at, i)
        return self.deep[k - 1] if k else 0


_PARTS = re.compile("[\"'“”«»(（「『《[¿¡]")
_NUMBER = re.compile(r"[\d.,:/-]+")
_WORD = re.compile(r"[^\s,;:]+")
_ENDED = re.compile(r"[.!?。！？؟।…][”»」』\"’)）\]\d\[]*\s*\Z")
_COLON = re.compile(r"[:：,，、]\s*\Z")
_THAI_BLANK = re.compile(r"[^\S\r\n]+")


def _before(p: str, at: int) -> str:
    """Token that ends at `at`, lower case; numbers by their shape."""
    t = p[max(0, at - 24) : at]
    if not t or t[-1].isspace():
        return ""
    t = t.rsplit(None, 1)[-1]
    if _PARTS.search(t):
        t = _PARTS.split(t)[-1]
        if not t:
            return ""
    if t[-1] > "\u2e7f" and _script(t[-1]) == "wide":
        t = t[-2:]
    t = t.lower()
    if t[0].isdigit():
        return "0" * min(len(t), 5) if t.isdigit() else "0.0" if _NUMBER.fullmatch(t) else t
    return t


def _after(p: str, at: int) -> str:
    """Token that begins at `at`: wide scripts by two signs, capitalised words by their shape."""
    ch = p[at : at + 1]
    if not ch or ch in _OPEN:
        return ch
    if ch > "\u2e7f" and _script(ch) == "wide":
        return p[at : at + 2]
    if ch.isupper():
        return "Aa"
    if ch.isdigit():
        return "0"
    word = _WORD.match(p[at : at + 24])
    return word[0] if word else ch


#: What is said of a candidate: end, next, token before with its mark, token after, shape. Without tokens it isn't counted.
Candidate = tuple[int, int, str, str, str]


def _shape(p: str, mark: str, before: str, nxt: int, quote: int | None) -> str:
    """What else a candidate shows: mark, case, length and script of its neighbours, and the quotes it closes."""
    ch = p[nxt]
    case = "lower" if ch.islower() else "upper" if ch.isupper() else "digit" if ch.isdigit() else "open" if ch in _OPEN else "none" if ch.isalpha() else "sign"
    word = before.rstrip(".")
    short = "letter" if len(word) == 1 and word.isalpha() else "inner" if "." in word else "digits" if word[:1].isdigit() else f"len{min(len(word), 5)}"
    kind = "period" if mark == "." else "dots" if mark[0] == "…" or mark[0] == "." else mark[-1]
    if quote is None:
        speech = "no"
    else:
        ahead = p[:quote]
        speech = "whole" if not ahead.strip() or _ENDED.search(ahead) else "colon" if _COLON.search(ahead) else "within"
    return f"{kind} {case} {short} {_script(ch)} {speech}"


def candidates(p: str) -> Iterator[Candidate]:
    """Candidate boundaries inside a paragraph; the paragraph's end isn't one."""
    deep = _Depth(p)
    opener = deep.opener
    n = len(p)
    for m in _CAND.finditer(p):
        mark, tail, space = m.groups()
        end, nxt = m.end(2), m.end(3)
        if end >= n or nxt >= n:
            continue
        if not space and not (mark[-1] in _WIDE_MARK and (mark[-1] != "…" or _script(p[end]) == "wide")):
            continue
        quote = None
        if opener:
            # inside of quotes or brackets; the closers at hand are left behind
            if deep[end - 1] > 0 and not (tail and deep[end] == 0):
                yield end, nxt, "", "", "inside"
                continue
            if tail:
                closer = next((i for i in range(m.end(1), end) if i in opener and p[i] in "\"”»」』’"), None)
                quote = None if closer is None else opener[closer]
        before = _before(p, m.start())
        yield end, nxt, before + mark[0], _after(p, nxt), _shape(p, mark, before, nxt, quote)
    if _THAI.search(p):
        for m in _THAI_BLANK.finditer(p):
            a, b = p[m.start() - 1 : m.start()], p[m.end() : m.end() + 1]
            if a and b and a not in "\r\n" and b not in "\r\n" and (_THAI.match(a) or _THAI.match(b)):
                yield m.start(), m.end(), "", "", "thai inside" if deep[m.start()] > 0 else "thai number" if a.isdigit() or b.isdigit() else "thai"


def described(text: str | None) -> tuple[list[int], list[int], list[int], list[int], list[str], list[str], list[str], list[str]]:
    """begin and end of each paragraph; end, next, before, after and shape of each candidate; tokens at paragraph edges (a or b before them)."""
    begins, ends, edges = [], [], []
    out: list[Candidate] = []
    for a, b in paragraphs(text or ""):
        p = text[a:b]
        begins.append(a)
        ends.append(b)
        edges.append("a" + _after(p, 0))
        if last := _LAST.search(p, max(0, len(p) - 40)):
            edges.append("b" + _before(p, last.start(1)) + last[1][0])
        found = list(candidates(p))
        if found and found[-1][4][:4] == "thai":
            found.sort(key=lambda c: c[0])
        out += found if not a else [(e + a, n + a, x, y, z) for e, n, x, y, z in found]
    e, n, x, y, z = map(list, zip(*out)) if out else ([], [], [], [], [])
    return begins, ends, e, n, x, y, z, edges


def counts(text: str) -> list[tuple[str, str, int, int]]:
    """(side, token, times at a candidate or paragraph edge, times at a paragraph edge) of a text."""
    *_, before, after, _, edges = described(text)
    seen: dict[tuple[str, str], list[int]] = {}
    for side, tokens, edge in (("before", before, 0), ("after", after, 0), ("before", [t[1:] for t in edges if t[0] == "b"], 1), ("after", [t[1:] for t in edges if t[0] == "a"], 1)):
        for t in tokens:
            if t:
                x = seen.setdefault((side, t), [0, 0])
                x[0] += 1
                x[1] += edge
    return [(s, t, n, e) for (s, t), (n, e) in seen.items()]


class Vocabulary:
    """How often tokens stand at paragraph edges.

    totals: (times, times at an edge) of all tokens of a side, where rows aren't all.
    """

    def __init__(self, rows: list[tuple[str, str, int, int]], totals: dict[str, tuple[int, int]] | None = None):
        self.seen = {(s, t): (n, e) for s, t, n, e in rows}
        self.more: dict[tuple[str, str], tuple[int, int]] = {}
        self.rate = {}
        for side in ("before", "after"):
            if totals is None:
                n, e = (sum(v[i] for k, v in self.seen.items() if k[0] == side) for i in (0, 1))
            else:
                n, e = totals.get(side, (0, 0))
            self.rate[side] = min(0.9, max(0.01, e / n)) if n else 0.2

    def plus(self, more: dict[tuple[str, str], tuple[int, int]]) -> "Vocabulary":
        """The same with the counts of further tokens; rates stay."""
        v = copy.copy(self)
        v.more = more
        return v

    def least_never(self, side: str) -> int:
        """Least times that a token without edges must be seen to stand as "never"."""
        return math.ceil(math.log(LUCK) / math.log(1 - self.rate[side]) - 1e-9)

    def standing(self, side: str, token: str) -> str:
        n, e = self.seen.get((side, token)) or self.more.get((side, token), (0, 0))
        # far fewer edges than the average token has
        if n and e <= n * self.rate[side] / 40 and n * math.log(1 - self.rate[side]) <= math.log(LUCK):
            return "never"
        if e >= 3 and e >= n * self.rate[side] / 8:
            return "often"
        return "some" if e else "unseen"


def features(before: str, after: str, shape: str, v: Vocabulary) -> list[str]:
    if not before and not after:
        return ["bias", f"place={shape}"]
    end, start = v.standing("before", before), v.standing("after", after)
    mark, case, short, script, quote = shape.split(" ")
    kind = "period" if mark == "period" else "other"
    return [
        "bias",
        f"mark={mark}",
        f"end={end}|{kind}",
        f"start={start}",
        f"case={case}",
        f"case={case}|start={start}",
        f"short={short}|{kind}",
        f"short={short}|end={end}" if mark == "period" else "other mark",
        f"script={script}",
        f"quote={quote}|start={start}",
        f"quote={quote}|case={case}",
    ]


#: Labels of candidates without tokens, as they hold in all corpora.
CERTAIN = {"inside": 0, "thai inside": 0, "thai number": 0, "thai": 1}


def label(before: str, after: str, shape: str, v: Vocabulary) -> int | None:
    """1 or 0 for reliable boundaries and what is none; None where it isn't sure."""
    if not before and not after:
        return CERTAIN[shape]
    end, start = v.standing("before", before), v.standing("after", after)
    mark, case, *_ = shape.split(" ")
    if start == "never" or (case == "lower" and start != "often"):
        return 0
    if mark == "period" and end == "never":
        return 0
    if end in ("often", "some") and start == "often":
        return 1
    if mark != "period" and start == "often":
        return 1
    return None


class MaxEnt:
    """Two-way maximum-entropy model over sparse features."""

    def __init__(self):
        self.index: dict[str, int] = {}
        self.weight = np.zeros(0)
        self.scores: dict[tuple, float] = {}  # of rows met, of which there are few different ones

    def fit(self, rows: list[list[str]], labels: list[int], rounds: int = 300, rate: float = 1.0, prior: float = 1e-4) -> "MaxEnt":
        for r in rows:
            for f in r:
                self.index.setdefault(f, len(self.index))
        self.weight = np.zeros(len(self.index))
        if not rows:
            return self
        # equal rows count once, with their numbers
        groups: dict[tuple[tuple[int, ...], int], int] = {}
        for r, y in zip(rows, labels):
            k = (tuple(self.index[f] for f in r), y)
            groups[k] = groups.get(k, 0) + 1
        x = np.zeros((len(groups), len(self.index)))
        for i, (ids, _) in enumerate(groups):
            x[i, list(ids)] = 1
        y = np.array([k[1] for k in groups], dtype=float)
        n = np.sqrt(np.array(list(groups.values()), dtype=float))  # frequent sentences don't drown rare ones
        total, g2 = n.sum(), np.full(len(self.index), 1e-6)
        for _ in range(rounds):
            q = 1 / (1 + np.exp(-np.clip(x @ self.weight, -30, 30)))
            g = x.T @ ((y - q) * n) / total - prior * self.weight
            g2 += g * g
            self.weight += rate * g / np.sqrt(g2)
        return self

    def score(self, row: list[str]) -> float:
        key = tuple(row)
        if key not in self.scores:
            self.scores[key] = float(sum(self.weight[self.index[f]] for f in row if f in self.index))
        return self.scores[key]


class Decider:
    """The model with the counts; remembers what it decided on candidates that look alike."""

    def __init__(self, v: Vocabulary, model: MaxEnt):
        self.v, self.model = v, model
        self.known: dict[tuple[str, str, str], bool] = {}

    def __call__(self, before: str, after: str, shape: str, more: dict | None = None) -> bool:
        if more and (("before", before) in more or ("after", after) in more):
            return self.model.score(features(before, after, shape, self.v.plus(more))) > 0
        k = (before, after, shape)
        if k not in self.known:
            if len(self.known) > 500_000:
                self.known.clear()
            self.known[k] = self.model.score(features(before, after, shape, self.v)) > 0
        return self.known[k]


def pieces(begins, ends, cuts, nexts, before, after, shape, decide: Callable, more: dict | None = None) -> list[tuple[int, int]]:
    """Places of a described text's sentences."""
    out = []
    k, n = 0, len(cuts)
    for a, b in zip(begins, ends):
        at = a
        while k < n and cuts[k] < b:
            if cuts[k] > at and decide(before[k], after[k], shape[k], more):
                out.append((at, cuts[k]))
                at = nexts[k]
            k += 1
        if at < b:
            out.append((at, b))
    return out


def split(text: str | None, v: Vocabulary, model: MaxEnt) -> list[tuple[int, int]]:
    """Places of a text's sentences."""
    *said, _ = described(text)
    return pieces(*said, Decider(v, model))


def train(seen: Iterable[tuple[str, str, str]], v: Vocabulary) -> MaxEnt:
    """The model of candidates (before, after, shape)."""
    rows, labels = [], []
    for c in [*(("", "", s) for s in CERTAIN for _ in range(20)), *seen]:
        if (y := label(*c, v)) is not None:
            rows.append(features(*c, v))
            labels.append(y)
    return MaxEnt().fit(rows, labels)


SAID = "row long, begin array<int>, end array<int>, cut array<int>, next array<int>, before array<string>, after array<string>, shape array<string>, edge array<string>"


def lines_of(pages: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, row, what described gives) of the texts that aren't blank; row tells rows of one id apart."""
    kind = pages.schema[id_col].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            said = [described(t) for t in pdf["text"]]
            out = pdf[["id", "row"]].copy()
            for k, name in enumerate(("begin", "end", "cut", "next", "before", "after", "shape", "edge")):
                out[name] = [x[k] for x in said]
            yield out

    src = spread(pages.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where(F.col("text").rlike(r"\S")))
    return src.select("id", F.monotonically_increasing_id().alias("row"), "text").mapInPandas(run, f"id {kind}, {SAID}")


def _tokens() -> Column:
    """The tokens of a described text's candidates, with a or b before them."""
    told = lambda side, tokens: F.transform(F.filter(tokens, lambda t: t != ""), lambda t: F.concat(F.lit(side), t))
    return F.concat(told("b", F.col("before")), told("a", F.col("after")))


def tallies(said: DataFrame) -> DataFrame:
    """(side, token, n, edge): the counts of all tokens over all texts."""
    each = said.select(F.explode(F.concat(F.transform(_tokens(), lambda t: F.concat(F.lit("0"), t)), F.transform("edge", lambda t: F.concat(F.lit("1"), t)))).alias("t"))
    votes = each.groupBy("t").agg(F.count("*").alias("n"))
    side = F.when(F.substring("t", 2, 1) == "a", "after").otherwise("before")
    edge = F.when(F.substring("t", 1, 1) == "1", F.col("n")).otherwise(F.lit(0))
    return votes.select(side.alias("side"), F.expr("substring(t, 3)").alias("token"), "n", edge.alias("edge")).groupBy("side", "token").agg(F.sum("n").alias("n"), F.sum("edge").alias("edge"))


def vocabulary(votes: DataFrame, least_share: float = LEAST_SHARE) -> tuple[Vocabulary, DataFrame | None]:
    """Counts of frequent tokens, at most 1 / least_share, and the rows of the others; None if there are none.

    Left out is only what changes no standing: tokens met at edges alone, of which no candidate asks, and
    tokens without edges that are too few to stand as "never".
    """
    totals = {r.side: (r.n, r.edge) for r in votes.groupBy("side").agg(F.sum("n").alias("n"), F.sum("edge").alias("edge")).collect()}
    bare = Vocabulary([], totals)
    enough = F.when(F.col("side") == "before", bare.least_never("before")).otherwise(bare.least_never("after"))
    used = votes.where((F.col("edge") < F.col("n")) & ((F.col("edge") > 0) | (F.col("n") >= enough)))
    least = sum(n for n, _ in totals.values()) * least_share
    frequent = used.where(F.col("n") >= least).collect()
    v = Vocabulary([(r.side, r.token, r.n, r.edge) for r in frequent], totals)
    # a token with an edge and a candidate is seen twice
    return v, used.where(F.col("n") < least) if least > 2 else None


def looked_up(said: DataFrame, rare: DataFrame) -> DataFrame:
    """(row, more): the counts of the rarer tokens of each text."""
    wanted = said.select("row", F.explode(F.array_distinct(_tokens())).alias("t"))
    keyed = rare.select(F.concat(F.substring("side", 1, 1), "token").alias("t"), F.struct("side", "token", "n", "edge").alias("x"))
    return wanted.join(keyed, "t").groupBy("row").agg(F.collect_list("x").alias("more"))


def sample(said: DataFrame, n: int) -> list[tuple[str, str, str]]:
    """The candidates of the n texts of smallest hash; bounded by n."""
    rows = said.select("before", "after", "shape", F.xxhash64("id", "begin").alias("h")).orderBy("h").limit(n).collect()
    return [c for r in rows for c in zip(r.before, r.after, r["shape"])]


def sentences(pages: DataFrame, id_col: str = "page_id", text_col: str = "content", sample_pages: int = SAMPLE_PAGES, least_share: float = LEAST_SHARE) -> DataFrame:
    """(page_id, char_start, char_end), one row per sentence."""
    spark = pages.sparkSession
    said = cut(lines_of(pages, id_col, text_col))
    v, rare = vocabulary(cut(tallies(said)), least_share)
    seen = sample(said, sample_pages)
    known = v
    if rare is not None:
        tokens = spark.createDataFrame(sorted({x for b, a, _ in seen for x in (("before", b), ("after", a))}), "side string, token string")
        known = v.plus({(r.side, r.token): (r.n, r.edge) for r in tokens.join(rare, ["side", "token"]).collect()})
    shared = spark.sparkContext.broadcast((v, train(seen, known)))
    kind = pages.schema[id_col].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        decide = Decider(*shared.value)
        for pdf in frames:
            rows = []
            more = pdf["more"] if "more" in pdf else itertools.repeat(None)
            for i, *x, m in zip(pdf["id"], *(pdf[c] for c in ("begin", "end", "cut", "next", "before", "after", "shape")), more):
                rare_ = None if m is None else {(r["side"], r["token"]): (r["n"], r["edge"]) for r in m}
                rows += [(i, a, b) for a, b in pieces(*(y.tolist() for y in x), decide, rare_)]
            yield pd.DataFrame(rows, columns=["id", "char_start", "char_end"])

    src = said.drop("edge")
    if rare is not None:
        src = src.join(looked_up(said, rare), "row", "left")
    return src.mapInPandas(run, f"id {kind}, char_start int, char_end int").withColumnRenamed("id", id_col)
