"""Text functions as column expressions, with Unicode-aware white space, words and accents.

Java's defaults differ from the semantics wanted: trim() knows only the blank, \\s six signs, \\w ASCII.
WS lists all signs that count as white space here.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

WS = r"[\t-\r\x1c-\x20\x85\xa0  -     　]"
WORD = r"[\p{L}\p{N}_]"
#: Function words dropped from entity names.
STOP_WORDS = ("el", "la", "los", "las", "un", "una", "unos", "unas", "de", "del", "en", "con", "por", "para", "sin", "y", "e", "o", "u", "que", "como", "pero", "si")
#: Spanish months.
MONTHS = ("enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre")
#: Countries of the country report.
COUNTRIES = (
    "argentina", "bolivia", "brasil", "brazil", "chile", "colombia", "costa rica", "cuba", "ecuador", "el salvador", "guatemala",
    "honduras", "mexico", "nicaragua", "panama", "paraguay", "peru", "puerto rico", "republica dominicana", "uruguay", "venezuela",
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(c: Column) -> Column:
    """c without white space of any kind at its ends."""
    return F.regexp_replace(c, f"^{WS}+|{WS}+\\z", "")


def squeeze(c: Column) -> Column:
    """Each run of white space as one blank, none at the ends."""
    return strip(F.regexp_replace(c, f"{WS}+", " "))


def _accents() -> tuple[str, str]:
    a, b = [], []
    for i in range(0xC0, 0x2000):
        d = "".join(x for x in unicodedata.normalize("NFD", chr(i)) if unicodedata.category(x) != "Mn")
        if len(d) == 1 and d != chr(i):
            a.append(chr(i))
            b.append(d)
    return "".join(a), "".join(b)


def strip_accents(c: Column) -> Column:
    """c without combining marks; single signs become their base letters."""
    plain = F.translate(c, *_accents())
    return F.when(c.rlike(r"[^\x00-\x7f]"), F.regexp_replace(plain, r"\p{Mn}+", "")).otherwise(c)


def tokens(c: Column) -> Column:
    """Parts of c between white space."""
    return F.filter(F.split(c, f"{WS}+"), lambda w: w != "")


def normalize_entity(c: Column) -> Column:
    """Lower case, no accents, no function words unless it is one word or nothing else is left. Null gives null."""

    def chosen(low: Column, parts: Column) -> Column:
        kept = F.filter(parts, lambda w: ~w.isin(*STOP_WORDS))
        return F.when(F.size(parts) <= 1, F.array_join(parts, " ")).otherwise(let(kept, lambda k: F.when(F.size(k) > 0, F.array_join(k, " ")).otherwise(low)))

    return let(strip_accents(F.lower(strip(c))), lambda low: let(tokens(low), lambda parts: F.when(low.isNotNull(), chosen(low, parts))))


def iso_date(c: Column) -> Column:
    """yyyy-MM-dd of "5 de mayo de 1810", else the first year from 1000 to 2099, else null. Days aren't validated."""
    pattern = r"(?iu)(\p{Nd}{1,2})" + WS + r"+de" + WS + r"+([A-Za-záéíóúñ]+)" + WS + r"+de" + WS + r"+(\p{Nd}{4})"
    part = [F.regexp_extract(c, pattern, i) for i in (1, 2, 3)]
    months = F.create_map(*[F.lit(x) for i, m in enumerate(MONTHS, 1) for x in (m, i)], F.lit("setiembre"), F.lit(9))
    month = months[F.lower(part[1])]
    year = F.regexp_extract(c, r"(?U)\b(1[0-9]{3}|20[0-9]{2})\b", 1)
    return F.when(month.isNotNull(), F.concat_ws("-", F.lpad(part[2], 4, "0"), F.lpad(month.cast("string"), 2, "0"), F.lpad(part[0], 2, "0"))).when(year != "", year)


def safe_filename(c: Column) -> Column:
    """c as a file name: reserved signs as _, no dots at the end, a default for nothing."""
    s = F.regexp_replace(strip(F.regexp_replace(c, r'[<>:"|?*\\/]', "_")), r"\.+\z", "")
    return F.coalesce(F.nullif(s, F.lit("")), F.lit("unnamed_file"))


def file_key(c: Column) -> Column:
    """c with words, blanks and hyphens only, runs of the latter two as _."""
    return F.regexp_replace(strip(F.regexp_replace(c, r"[^\p{L}\p{N}_\-\t-\r\x1c-\x20\x85\xa0  -     　]", "")), f"(?:-|{WS})+", "_")


def url_quote(c: Column) -> Column:
    """c for use in a URL; blanks as %20."""
    return F.replace(F.url_encode(c), F.lit("+"), F.lit("%20"))


def preview(c: Column, n: int = 100) -> Column:
    """The first n characters, with dots if there are more."""
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit("..."))).otherwise(c)


def percent(part: Column, whole: Column) -> Column:
    """part in whole as "12.34%", rounded half to even; 0.00% of nothing."""
    return F.when(whole > 0, F.concat(F.format_string("%.2f", F.bround(part * 100.0 / whole, 2)), F.lit("%"))).otherwise(F.lit("0.00%"))


def country_of(relation: Column, head: Column, tail: Column) -> Column:
    """Country that a triple is about, or null: the tail of a country relation, else the first name in head or tail."""
    names = F.array(*[F.lit(c) for c in COUNTRIES])
    h, t = F.lower(F.coalesce(head, F.lit(""))), F.lower(F.coalesce(tail, F.lit("")))
    said = F.when(F.lower(F.coalesce(relation, F.lit(""))).contains("country") & t.isin(*COUNTRIES), t)
    return F.coalesce(said, F.get(F.filter(names, lambda n: F.contains(h, n) | F.contains(t, n)), F.lit(0)))
