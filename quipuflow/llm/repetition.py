"""Problem 10: the share of repeated content within each document.

A table of thresholds, each a ratio of a text and the value from which it counts, is compiled into
one Spark projection; no user function and no shuffle. The ratios: words that lie in a repeated run
of n words, repeated lines, symbols, stop words, and the length itself.

A null or empty text has no words, so all its ratios are 0 and no rule that asks for at least some
share marks it. Repeated rows are judged each by itself; extra columns pass through, but for those named as a rule's.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipuflow.functions.text import let

RUN = 8
SHARE = 0.3
#: Frequent words of the corpus's languages.
STOP_WORDS = ("de", "la", "el", "en", "y", "a", "los", "las", "que", "con", "por", "su", "the", "of", "and", "in", "to", "o", "e", "do", "da", "et", "le", "les", "des")


@dataclass(frozen=True)
class Rule:
    """ratio: a key of RATIOS, or repeated_words:N for runs of N words."""

    name: str
    ratio: str
    at_least: float


#: The table of p10_found and p10_profile.
THRESHOLDS = (
    Rule("repeated", f"repeated_words:{RUN}", SHARE),
    Rule("repeated_lines", "repeated_lines", 0.3),
    Rule("symbols", "symbols", 0.1),
    Rule("few_stop_words", "other_words", 0.98),
)


def _accents() -> tuple[str, str]:
    """Single signs and the letters they consist of without their marks, for lowered text."""
    a, b = [], []
    for i in range(0xC0, 0x2000):
        d = unicodedata.normalize("NFD", chr(i))
        base = "".join(x for x in d if not unicodedata.category(x).startswith("M"))
        if len(base) == 1 and base != chr(i) and chr(i).lower() == chr(i):
            a.append(chr(i))
            b.append(base)
    return "".join(a), "".join(b)


def words(text: Column) -> Column:
    """array<string> of the words of a text."""
    low = F.lower(F.coalesce(text, F.lit("")))
    low = F.when(low.rlike(r"[^\x09-\x0d\x20-\x7e]"), F.translate(F.regexp_replace(low, r"[\p{M}\p{Cf}\x00-\x08\x0e-\x1b\x7f-\x84\x86-\x9f]+", ""), *_accents())).otherwise(low)
    return F.filter(F.split(low, r"[^\p{L}\p{N}]+"), lambda w: w != "")


def covered(starts: Column, n: int) -> Column:
    """Words covered by runs of n words that begin at starts, an ascending array."""
    return F.aggregate(
        starts,
        F.struct(F.lit(0).alias("sum"), F.lit(-n).alias("last")),
        lambda acc, s: F.struct((acc["sum"] + F.least(F.lit(n), s - acc["last"])).alias("sum"), s.alias("last")),
        lambda acc: acc["sum"],
    )


def runs(hashes: Column, n: int) -> Column:
    """Hash of each run of n words, in order of their beginnings; at least n + 1 words."""
    return F.transform(F.sequence(F.lit(1), F.size(hashes) - (n - 1)), lambda i: F.xxhash64(F.slice(hashes, i, n)))


def later(run_hashes: Column) -> Column:
    """Ascending places of the runs that equal one beginning earlier: all but the first of each hash."""

    def rest(placed: Column) -> Column:
        again = F.filter(F.sequence(F.lit(1), F.size(placed) - 1), lambda k: F.get(placed, k)["h"] == F.get(placed, k - 1)["h"])
        return F.array_sort(F.transform(again, lambda k: F.get(placed, k)["i"]))

    return let(F.sort_array(F.transform(run_hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), rest)


def repeated_words(text: Column, n: int, least: float) -> Column:
    """Share of the words that lie in repeated runs of n.

    A repeated run covers at most n words; where there are too few for the share `least`, the places
    needn't be found, and the share is given as 0.
    """

    def share(w: Column, r: Column) -> Column:
        again = F.size(r) - F.size(F.array_distinct(r))
        return F.when((again > 0) & (again * n >= F.size(w) * F.lit(least)), covered(later(r), n) / F.size(w)).otherwise(F.lit(0.0))

    hashed = F.transform(words(text), lambda w: F.xxhash64(w))
    return let(hashed, lambda w: F.when(F.size(w) > n, let(runs(w, n), lambda r: share(w, r))).otherwise(F.lit(0.0)))


def ratio(text: Column, rule: Rule, whole: bool) -> Column:
    body = F.coalesce(text, F.lit(""))
    if rule.ratio.startswith("repeated_words:"):
        return repeated_words(text, int(rule.ratio.split(":")[1]), 0.0 if whole else rule.at_least)
    if rule.ratio == "repeated_lines":
        lines = F.filter(F.split(body, r"[\r\n]+"), lambda x: F.trim(x) != "")
        return let(lines, lambda x: F.when(F.size(x) > 0, (F.size(x) - F.size(F.array_distinct(x))) / F.size(x)).otherwise(F.lit(0.0)))
    if rule.ratio == "symbols":
        return F.when(F.length(body) > 0, F.length(F.regexp_replace(body, r"[\p{L}\p{M}\p{N}\p{P}\s]+", "")) / F.length(body)).otherwise(F.lit(0.0))
    if rule.ratio == "other_words":
        return let(words(text), lambda w: F.when(F.size(w) > 0, 1 - F.size(F.filter(w, lambda x: x.isin(*STOP_WORDS))) / F.size(w)).otherwise(F.lit(0.0)))
    if rule.ratio == "length":
        return F.length(body).cast("double")
    raise ValueError(f"unknown ratio: {rule.ratio}")


def judge(df: DataFrame, rules: tuple[Rule, ...] = THRESHOLDS, text_col: str = "text", whole: bool = True) -> DataFrame:
    """df with two columns a rule: NAME_share and NAME, whether it is reached.

    whole: give the exact shares everywhere; without, a share surely below its threshold may be 0.
    """
    shares = [ratio(F.col(f"`{text_col}`"), r, whole).alias(f"{r.name}_share") for r in rules]
    made = {x for r in rules for x in (r.name, f"{r.name}_share")}
    keep = [F.col(f"`{c}`") for c in df.columns if c not in made]
    marks = [x for r in rules for x in (F.col(f"{r.name}_share"), (F.col(f"{r.name}_share") >= r.at_least).alias(r.name))]
    return df.select(*keep, *shares).select(*keep, *marks)
