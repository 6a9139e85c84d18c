"""Problem 6: the article of a page, without what its site puts around and into it.

The pages come as lines. Each line is a container. Its generalised paths are the line with digits,
calendar words, list marks and the site's name generalised, and, where a sign parts a label from what
it labels, the label alone ("etiquetas:", "| hace 0 horas"). Every page scores its containers: by
punctuation, length, and whether text follows right after it, or after a heading. Spark adds the scores up per host and
over all hosts. A path wins as frame where it stands on too many pages to be anyone's own text; a winning path
after which text goes on is an insert, one after which none does closes the article. The winning
paths go back to the pages of their host, which are then extracted again: from the headline to the
first closing container, without the inserts.

No list of labels is used; what is frame follows from the votes alone.

The text is read once. What each page says of its lines (64-bit keys and flags) is kept in the
checkpoint folder; votes and extraction read only that. Votes have partial aggregation. Pages and the
paths of their host are joined with salted keys, so a host of a third of all pages is spread over
many tasks; a host has few winning paths, as each stands on a fixed share of pages.

A null or blank content has no article; neither has a page of frame only. A page without any frame is
all article. Pages of equal content vote once. Extra columns are left out.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from urllib.parse import unquote

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quipuflow.session import cut, spread

#: A path is frame on a host if it stands on this share of its pages, and on at least MIN_PAGES.
HOST_SHARE, MIN_PAGES = 0.25, 5
#: Or if it stands on more than this share of all pages, by more than SURE standard deviations, and on MIN_HOSTS hosts.
POOLED_SHARE, SURE, MIN_HOSTS = 0.05, 2.0, 3
#: A winning path is an insert if text follows right after it in at least this share of its places.
OPENS = 0.15
SALTS = 16
#: Flags of a line.
TEXT, TITLE, OPEN, BLANK = 1, 2, 4, 8

#: Calendar words, without accents.
_MONTH = "enero|febrero|marzo|abril|mayo|junio|julio|agosto|sep?tiembre|octubre|noviembre|diciembre|january|february|march|april|may|june|july|august|september|october|november|december"
_DAY = "lunes|martes|miercoles|jueves|viernes|sabado|domingo|monday|tuesday|wednesday|thursday|friday|saturday|sunday"
_CALENDAR = re.compile(rf"\b(?:(?:{_MONTH})|({_DAY}))\b")
_BULLET = re.compile(r"^[^\S\n]*(?:[▸>*•·\-–»][^\S\n]+)+|(?<=»[^\S\n])[▸>*•][^\S\n]+", re.M)
_NUMBER = re.compile(r"\d+")
_BLANKS = re.compile(r"[^\S\n]+")
_LABEL = re.compile(r"\s*[:|>»·]")
_END = (".", "!", "?", "…", ";")


def _accents() -> dict[str, str]:
    """Signs to their letters without marks; marks that stand alone to nothing."""
    table = {chr(i): "" for i in range(0x300, 0x370)}
    for i in range(0xC0, 0x2000):
        d = unicodedata.normalize("NFD", chr(i))
        if len(d) > 1:
            table[chr(i)] = "".join(c for c in d if unicodedata.category(c) != "Mn")
    return table


_ACCENTS = _accents()
_OTHER = re.compile(r"[\u00c0-\u1fff]")
#: Longer lines are nobody's label or date.
SHORT = 60


def _bare(t: str) -> str:
    return _OTHER.sub(lambda m: _ACCENTS.get(m[0], m[0]), t.lower())


def host_of(url: str | None) -> str:
    m = re.match(r"\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#]+)", url or "", re.I)
    return m[1].lower() if m else ""


def site_of(host: str) -> str:
    parts = [p for p in host.split(":")[0].split(".") if p not in ("www", "m", "es", "com")]
    return re.sub(r"\d+$", "", parts[0]) if parts else ""


def _calendar(m: re.Match) -> str:
    return "0day" if m[1] else "0month"


def generalised(bare: str, site: str) -> list[str]:
    """Generalised path of each line of a text without accents; '' for a blank one. Calendar words count in short lines."""
    t = _NUMBER.sub("0", _BLANKS.sub(" ", _BULLET.sub("", bare)))
    if site:
        t = re.sub(rf"\b{re.escape(_bare(site))}\b", "0site", t)
    return [_CALENDAR.sub(_calendar, x) if len(x) <= SHORT else x for x in (y.strip() for y in t.split("\n"))]


def labels(path: str) -> tuple[str, str]:
    """What a path begins with up to a sign that parts labels, and what it ends with from one on; '' where none is."""
    m = _LABEL.search(path, 1)
    if not m or m.end() > SHORT:
        return "", ""
    last = max(path.rfind(x) for x in "|·")
    return path[: m.end()], path[last:] if last > 0 else ""


def slug_title(url: str | None) -> str:
    return unquote((url or "").rstrip("/").rpartition("/")[2]).replace("_", " ").strip()


def _text_like(line: str) -> bool:
    """A sentence, rather than a link or a label."""
    return len(line) >= 25 and line.rstrip("»”\"') ")[-1:] in _END and " " in line


def key(text: str) -> int:
    """64-bit key of a path; votes carry keys, as paths are long."""
    return xxhash.xxh64_intdigest(text) - (1 << 63)


_NONE = key("")


def described(content: str, title: str | None, url: str | None) -> tuple[list[int], list[int], list[int], list[int]]:
    """Of each line the keys of its path and of its labels, and its flags."""
    raw = [x.strip() for x in content.split("\n")]
    bare = _bare(content)
    paths = generalised(bare, site_of(host_of(url)))
    names = {_bare(t.strip()) for t in (title, slug_title(url)) if t and t.strip()}
    flags = []
    # whether text follows, right away or after a heading; what stands before a colon makes a link or a comment of it
    follows = after_next = False
    for x, p, b in zip(reversed(raw), reversed(paths), reversed(bare.split("\n"))):
        if not x:
            flags.append(BLANK)
            continue
        text, labelled = _text_like(x), labels(p)[0] != ""
        flags.append((TEXT if text else 0) | (TITLE if b.strip() in names else 0) | (OPEN if follows or after_next else 0))
        after_next = follows and not text and not labelled
        follows = text and not labelled
    flags.reverse()
    # a sentence isn't labelled by what stands before its colon
    parted = [("", "") if f & (TEXT | BLANK) else labels(p) for p, f in zip(paths, flags)]
    return [key(p) for p in paths], [key(a) for a, _ in parted], [key(b) for _, b in parted], flags


def article(flags: list[int], inserts: list[bool], closing: list[bool], error: bool = False) -> list[int]:
    """Numbers of the article's lines."""
    n = len(flags)
    frame = [a or b for a, b in zip(inserts, closing)]
    start = next((i for i, f in enumerate(flags) if f & TITLE), None)
    headline = start is not None
    if start is None:
        start = next((i for i, f in enumerate(flags) if f & TEXT and not frame[i]), None)
        if start is None:
            return []
        # a heading right above the first paragraph belongs to it, unless it is frame
        while start and not flags[start - 1] & BLANK and not frame[start - 1] and not any(frame[: start - 1]):
            start -= 1
    out = []
    for i in range(start, n):
        if flags[i] & BLANK:
            continue
        if i == start and headline:
            out.append(i)
        elif closing[i]:
            break
        elif inserts[i]:
            k = next((k for k in range(i + 1, n) if not flags[k] & BLANK), None)
            if k is None or closing[k]:
                break
        else:
            out.append(i)
    if headline and len(out) == 1:
        # a headline over nothing: no article
        return [] if any(frame) else out
    return out


def votes_of(paths: list[int], heads: list[int], tails: list[int], flags: list[int]) -> tuple[list[int], list[int], list[int]]:
    """The keys of a page, that of '' for the page itself; in how many places each is, and after how many text follows."""
    seen: dict[int, list[int]] = {_NONE: [1, 0]}
    for p, a, b, f in zip(paths, heads, tails, flags):
        open_ = 1 if f & OPEN else 0
        for k in {p, a, b}:
            if k != _NONE:
                x = seen.get(k)
                if x is None:
                    seen[k] = [1, open_]
                else:
                    x[0] += 1
                    x[1] += open_
    return list(seen), [x[0] for x in seen.values()], [x[1] for x in seen.values()]


LINES = "id {}, host long, mark long, path array<long>, label array<long>, tail array<long>, flag array<int>, vote array<long>, places array<int>, opens array<int>"


def lines_of(pages: DataFrame, id_col: str) -> DataFrame:
    """(id, host, mark of the content, path, label, tail, flag, vote, places, opens): what each page says of its lines."""
    kind = pages.schema[id_col].dataType.simpleString()
    host = F.xxhash64(F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^\s*(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]+)", 1)))
    src = pages.where(F.col("content").rlike(r"\S")).select(F.col(id_col).alias("id"), host.alias("host"), F.xxhash64("content").alias("mark"), "title", "url", "content")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            said = [described(c, t, u) for c, t, u in zip(pdf["content"], pdf["title"], pdf["url"])]
            said = [(*x, *votes_of(*x)) for x in said]
            out = pdf[["id", "host", "mark"]].copy()
            for k, name in enumerate(("path", "label", "tail", "flag", "vote", "places", "opens")):
                out[name] = [x[k] for x in said]
            yield out

    return spread(src).mapInPandas(run, LINES.format(kind))


def frame_paths(said: DataFrame, host_share: float = HOST_SHARE, pooled_share: float = POOLED_SHARE) -> DataFrame:
    """(host, inserts array<long>, closing array<long>): keys of the winning frame paths of each host.

    said: rows of lines_of.
    """
    each = said.select("host", "mark", F.explode(F.arrays_zip("vote", "places", "opens")).alias("x")).select("host", "mark", F.col("x.vote").alias("path"), "x.places", "x.opens")
    # pages of equal content say the same, so the largest is any of them
    seen = each.groupBy("host", "mark", "path").agg(F.max("places").alias("places"), F.max("opens").alias("opens"))
    votes = cut(seen.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("places").alias("places"), F.sum("opens").alias("opens")))
    page = F.col("path") == _NONE
    size = votes.where(page).select("host", F.col("n").alias("pages"))
    votes = votes.where(~page).join(size, "host")
    return _won(votes, size, host_share, pooled_share)


def _won(votes: DataFrame, size: DataFrame, host_share: float, pooled_share: float) -> DataFrame:
    every = size.agg(F.coalesce(F.sum("pages"), F.lit(0)).alias("all_pages"))
    pooled = votes.groupBy("path").agg(F.sum("n").alias("all_n"), F.sum("places").alias("all_places"), F.sum("opens").alias("all_opens"), F.count("*").alias("hosts"))
    least = F.col("all_pages") * pooled_share + SURE * F.sqrt(F.col("all_pages") * pooled_share * (1 - pooled_share))
    pooled = pooled.join(every).where((F.col("all_n") >= least) & (F.col("hosts") >= MIN_HOSTS)).select("path", "all_places", "all_opens")
    won = votes.join(pooled, "path", "left").where(((F.col("n") >= F.col("pages") * host_share) & (F.col("n") >= MIN_PAGES)) | F.col("all_places").isNotNull())
    insert = F.coalesce("all_opens", "opens") >= OPENS * F.coalesce("all_places", "places")
    return won.groupBy("host").agg(F.collect_list(F.when(insert, F.col("path"))).alias("inserts"), F.collect_list(F.when(~insert, F.col("path"))).alias("closing"))


def articles(pages: DataFrame, id_col: str = "page_id", salts: int = SALTS, host_share: float = HOST_SHARE, pooled_share: float = POOLED_SHARE) -> DataFrame:
    """(page_id, line_no) of the article's lines."""
    kind = pages.schema[id_col].dataType.simpleString()
    said = cut(lines_of(pages, id_col))
    won = frame_paths(said, host_share, pooled_share).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    rows = said.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int"))
    rows = rows.join(won, ["host", "salt"], "left").select("id", "path", "label", "tail", "flag", "inserts", "closing")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            out = []
            for i, paths, heads, tails, flags, ins, clo in zip(pdf["id"], pdf["path"], pdf["label"], pdf["tail"], pdf["flag"], pdf["inserts"], pdf["closing"]):
                a, b = (set() if x is None else set(x.tolist()) for x in (ins, clo))
                threes = list(zip(paths.tolist(), heads.tolist(), tails.tolist()))
                out += [(i, n) for n in article(flags.tolist(), [x in a or y in a or z in a for x, y, z in threes], [x in b or y in b or z in b for x, y, z in threes])]
            yield pd.DataFrame(out, columns=["id", "line_no"])

    return rows.mapInPandas(run, f"id {kind}, line_no int").withColumnRenamed("id", id_col)
