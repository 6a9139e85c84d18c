"""Problem 5: spellings of one person or organisation.

Names are brought to a canonical form of three parts (given name, first and second surname; or kind,
name and place), which already joins reordered parts, titles, abbreviated kinds, legal forms, case and
accents. What is left are typos, initials, dropped parts and nicknames.

Typos are linked where two names differ by at most one edit a part, an exchange of neighbours being one. First the
distinct surnames (or names and places of bodies) within an edit of each other are found: they share what is left
without one sign. A name then stands in the block of its own two surnames and visits those of surnames that are near its
own and as frequent or more so, which for a typo are few and for a frequent surname hardly any. So any two names whose
surnames are near each other, in one or in both, meet in just one block, and only their given names (or kinds) are left to compare.

That is done in the metric space of the Levenshtein distance, in which neighbours that changed places are 2 apart, by pivots: of
each block at most PIVOTS names are sampled by their hashes, every name is assigned to its nearest pivot's cell and
replicated to all cells whose pivot is within its nearest distance and twice the radius. By the triangle inequality
two names within the radius meet in the home cell of either. In a cell they are joined where their distances from
the pivot differ by no more than the radius, by the metric itself. Cells of more than CELL names are partitioned
again, with pivots of their own. Pivots of the whole corpus would not do: random names lie so close
to equally far from all of them that each would be replicated to most cells; inside of the blocks
`replication` measures how many cells hold a name.

Links between two given names that are both common are refused, as those are different names. The typos of a name
then go with its best-attested form.

Names with an initial, a dropped part or a nickname are linked to the one entity that they fit, if
there is exactly one. Those with an initial or a dropped part that fit none are linked with each other by the same edits, where two
of their parts are full; initials and parts of one sign must be equal.

Everything joins on keys; no group of names is collected into one task, and nothing but scalars to the driver. Null and blank names, and
names of other types, have no links; equal strings are one name. Extra columns are left out.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipuflow.session import cut, spread

#: In Levenshtein distance, so that an exchange of neighbours is within it.
RADIUS = 2
#: Pivots of a block or cell, and members from which on a cell is partitioned again, at most LEVELS times.
PIVOTS, CELL, LEVELS = 8, 2000, 8
TYPES = ("per", "org")
#: A second token of four-part names is part of the given name if it stands with so many first surnames.
SECOND_NAMES = 3
#: A given name is common if it stands with so many first surnames. Of two common ones that are an edit
#: apart, one is a frequent typo of the other if it stands with less than this share of the other's surnames.
COMMON, TYPO_SHARE = 3, 0.2
#: Kinds of bodies.
KINDS = (
    "academia", "agencia", "archivo", "asociacion", "banco", "biblioteca", "camara", "centro", "centro cultural", "circulo", "club", "colegio", "comision", "comite", "compania", "conservatorio", "consejo", "cooperativa", "corporacion", "editorial", "empresa", "escuela", "escuela normal", "facultad", "federacion", "fundacion", "grupo", "hospital", "instituto", "liga", "ministerio", "museo", "observatorio", "oficina", "orquesta", "partido", "sindicato", "sociedad", "taller", "teatro", "union", "universidad",
)
#: Abbreviations of kinds that aren't their first letters.
SHORT_KINDS = {"cia": "compania", "cte": "comite", "assoc": "asociacion", "gpo": "grupo", "tlr": "taller", "mseo": "museo"}
LEGAL = frozenset("ac sa sc srl sl ltda iap sab cv sas spa inc corp ltd eirl abp rl sade sadecv".split())
TITLES = frozenset("don dona dr dra ing lic prof profa sr sra srta mtro mtra arq sir gral cap cnel fray sor padre phd".split())
PARTICLES = frozenset("de d del la el los las y e".split())
#: Common short forms of given names.
NICKNAMES = {
    "alejandra": "jandra ale sandra", "adriana": "nana adri", "agustin": "tincho agus", "alberto": "beto", "antonia": "tona toni tonia", "antonio": "tono toni", "aurelio": "yeyo lelo", "beatriz": "bety beti bea betty", "benjamin": "mincho benja", "carmen": "carmela menchu", "catalina": "cata lina", "concepcion": "concha conchita", "consuelo": "chelo", "cristobal": "tobo cris", "dolores": "lola", "domingo": "mingo", "eduardo": "lalo", "emilio": "milo", "enrique": "quique", "ernestina": "tina", "eusebio": "chebo", "federico": "fico fede", "filomena": "mena filo", "francisca": "paca pancha", "francisco": "paco pancho curro", "gabriela": "gaby gabi", "graciela": "chela", "gregorio": "goyo", "guadalupe": "lupe lupita", "guillermo": "memo", "hermenegilda": "gilda", "hilario": "layo", "ignacio": "nacho", "isabel": "chabela chabe isa", "jesus": "chuy chucho", "jose": "pepe", "josefina": "pepa fina josefa", "leopoldina": "poldi", "lucrecia": "quecha", "luis": "lucho", "manuel": "manolo", "manuela": "manolita manola", "mercedes": "meche merche", "miguel": "migue", "nicanor": "nica", "petronila": "petrona peta", "rafael": "rafa", "refugio": "cuca", "roberto": "beto", "rosario": "charo chayo", "salvador": "chava salva", "saturnino": "nino", "teresa": "tere", "vicente": "chente", "victoria": "vicky vicki toya", "ximena": "xime", "yolanda": "yoli yola", "zenaida": "zena",
}


def bare(t: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", t.lower()) if unicodedata.category(c) != "Mn")


def distance(a: str, b: str, most: int = 3) -> int:
    """Edits between two strings; neighbours that changed places count 1. Or most + 1."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before: list[int] = []
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            d = min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            new.append(d)
        if min(new) > most:
            return most + 1
        before, row = row, new
    return row[-1]


def _kind(tokens: list[str]) -> tuple[str, int] | None:
    """Kind that some first tokens stand for, and how many they are."""
    two = [k.split(" ") for k in KINDS if " " in k]
    if len(tokens) >= 3:
        for a, b in two:
            x, y = tokens[0], tokens[1]
            if (a.startswith(x) or distance(x, a, 1) <= 1) and (b.startswith(y) or distance(y, b, 1) <= 1) and len(x) + len(y) >= 4:
                return f"{a} {b}", 2
    if len(tokens) >= 2:
        for a, b in two:
            if distance(tokens[0], a + b, 1) <= 1:
                return f"{a} {b}", 1
        x = tokens[0]
        if x in SHORT_KINDS:
            return SHORT_KINDS[x], 1
        if x in KINDS:
            return x, 1
        short = [k for k in KINDS if " " not in k and k.startswith(x)] if len(x) >= 3 else []
        if len(short) == 1 or (short and len(x) >= 4):
            return short[0], 1
        close = [k for k in KINDS if " " not in k and len(x) >= 4 and distance(x, k, 1) <= 1]
        if close:
            return close[0], 1
        if short:
            # of several kinds, the most usual ones
            usual = [k for k in short if k in ("colegio", "comite", "compania", "asociacion", "camara")]
            return (usual or short)[0], 1
    return None


def parse(name: str, kinds: set[str], second: frozenset[str] = frozenset()) -> tuple[str, str, str, str]:
    """(type, part 1, core, rest) of a name; parts that are missing are ''."""
    text = bare(name).replace("’", "'")
    comma = [x.strip() for x in text.split(",")]
    if len(comma) > 1 and re.sub(r"[^a-z]", "", comma[-1]) in LEGAL:
        comma = comma[:-1]
    clean = lambda s: [t for t in re.split(r"[^\w']+", s) if t]
    parts = [clean(x) for x in comma if clean(x)]
    if not parts:
        return "", "", "", ""
    if len(parts) > 1:
        tail = [t for t in parts[1]]
        k = _kind([t for t in tail if t not in PARTICLES] + ["", ""]) if "org" in kinds else None
        if k and (len(tail) > k[1] or "per" not in kinds):
            rest = [t for t in tail if t not in PARTICLES][k[1] :]
            return "org", k[0], " ".join(t for t in parts[0] if t not in PARTICLES), " ".join(rest)
        tokens = [t for p in parts[1:] for t in p] + parts[0]
    else:
        tokens = parts[0]
    while len(tokens) > 2 and tokens[0] in TITLES:
        tokens = tokens[1:]
    solid = [t for t in tokens if t not in PARTICLES]
    if "org" in kinds:
        k = _kind(solid)
        if k and (len(solid) > k[1] or "per" not in kinds):
            rest = solid[k[1] :]
            return "org", k[0], rest[0] if rest else "", " ".join(rest[1:])
        if "per" not in kinds:
            return ("org", solid[0], solid[1] if len(solid) > 1 else "", " ".join(solid[2:])) if solid else ("", "", "", "")
    solid = [t for t in tokens if t not in PARTICLES or len(t) == 1 and t in "dey"] or tokens
    given = 1
    if len(solid) >= 3 and solid[1] in second:
        given = 2
    elif len(solid) >= 3 and len(solid[1]) == 1 and len(solid[0]) == 1 and len(solid) >= 4:
        given = 2
    elif len(solid) > 3:
        given = len(solid) - 2
    g, c, r = solid[:given], solid[given : given + 1], solid[given + 1 :]
    return "per", " ".join(g), c[0] if c else "", " ".join(r)


def _spellings(triples: DataFrame) -> DataFrame:
    """(name, kinds array<string>) of the distinct names that stand as persons or bodies."""
    both = triples.select(F.explode(F.array(F.struct(F.col("head").alias("name"), F.lower(F.trim("head_type")).alias("kind")), F.struct(F.col("tail").alias("name"), F.lower(F.trim("tail_type")).alias("kind")))).alias("x"))
    both = both.select("x.name", "x.kind").where(F.col("kind").isin(*TYPES) & (F.trim("name") != ""))
    return both.groupBy("name").agg(F.collect_set("kind").alias("kinds"))  # at most two kinds


class _Asked:
    """Stands for the set of second names and notes which token was looked up."""

    def __init__(self):
        self.token: str | None = None

    def __contains__(self, token: str) -> bool:
        self.token = token
        return False


def _evidence(name: str, kinds: set[str]) -> tuple[str | None, str | None]:
    """(second, third) token of a name of four full parts, where the second is part of the given name."""
    if "per" in kinds and "," not in name:
        t = [x for x in re.split(r"[^\w]+", bare(name)) if x and x not in PARTICLES and x not in TITLES]
        if len(t) == 4 and all(len(x) > 1 for x in t) and not _kind(t):
            return t[1], t[2]
    return None, None


FORMS = "name string, type string, a string, core string, rest string"


def canonical(names: DataFrame) -> DataFrame:
    """name, type, a, core, rest: the canonical form of each name.

    A second token that stands with many first surnames in names of four parts is a second given name
    in names of three parts too; what is known of a token is joined to the names that hold it.
    """

    def first(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = []
            for n, k in zip(pdf["name"], pdf["kinds"]):
                asked = _Asked()
                form = parse(n, set(k), asked)
                if form[0]:
                    rows.append((n, k, *form, asked.token, *_evidence(n, set(k))))
            yield pd.DataFrame(rows, columns=["name", "kinds", "type", "a", "core", "rest", "asked", "second", "third"])

    def again(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = [(n, *parse(n, set(k), frozenset((t,)))) for n, k, t in zip(pdf["name"], pdf["kinds"], pdf["asked"])]
            yield pd.DataFrame(rows, columns=["name", "type", "a", "core", "rest"])

    told = cut(names.mapInPandas(first, "name string, kinds array<string>, type string, a string, core string, rest string, asked string, second string, third string"))
    seen = told.where("second is not null").groupBy("second").agg(F.approx_count_distinct("third").alias("n")).where(F.col("n") >= SECOND_NAMES).select(F.col("second").alias("asked"))
    known = told.join(seen, "asked", "left_semi").select("name", "kinds", "asked").mapInPandas(again, FORMS)
    rest = told.join(seen, "asked", "left_anti").select("name", "type", "a", "core", "rest")
    return rest.unionByName(known)


def _whole(t: str, a: str, core: str, rest: str) -> bool:
    return min(len(a), len(core), len(rest)) > 1 and not (t == "per" and len(a.replace(" ", "")) == len(a.split()))


#: The point of a row, of the columns with a suffix; it is made where it is needed, so that shuffles carry keys only.
Point = Callable[[str], Column]


def _told(suffix: str) -> Column:
    return F.col("point" + suffix)


def _pivots(points: DataFrame, point: Point) -> DataFrame:
    """(block, pivots): of each block of two or more the points of smallest hash in each of PIVOTS buckets of another hash."""
    points = points.select("block", point("").alias("_p"))
    bucket = F.pmod(F.xxhash64("_p"), F.lit(PIVOTS))
    rank = F.struct(F.xxhash64(F.lit(1), "_p").alias("h"), F.col("_p").alias("p"))
    chosen = [F.min(F.when(bucket == i, rank)).alias(f"p{i}") for i in range(PIVOTS)]
    found = points.groupBy("block").agg(*chosen, F.count("*").alias("n")).where("n > 1")
    return found.select("block", F.transform(F.array_compact(F.array(*[f"p{i}" for i in range(PIVOTS)])), lambda x: x["p"]).alias("pivots"))


def _cells(points: DataFrame, radius: int, point: Point = _told) -> DataFrame:
    """points, each in its home cell and, by the triangle inequality, in those it may have partners in; none of a block of one.

    points: block, home and others. The block becomes the cell's; from: the distance from its pivot.
    """
    others = [c for c in points.columns if c not in ("block", "home", "from")]
    far = points.join(_pivots(points, point), "block").withColumn("_p", point(""))
    far = far.select("block", "home", *others, F.transform("pivots", lambda p, i: F.struct(F.levenshtein(F.col("_p"), p).alias("d"), i.alias("i"))).alias("far"))
    near = far.select("block", "home", *others, F.array_min("far").alias("best"), "far")
    met = near.select("block", "home", *others, "best", F.explode(F.filter("far", lambda x: x["d"] <= F.col("best.d") + 2 * radius)).alias("x"))
    return met.select(F.concat_ws("|", "block", "x.i").alias("block"), (F.col("home") & (F.col("x.i") == F.col("best.i"))).alias("home"), *others, F.col("x.d").alias("from"))


def near_pairs(points: DataFrame, radius: int = RADIUS, point: Point = _told) -> DataFrame:
    """Pairs of points of one block within the radius: what points hold, once as it is and once with a 2 behind.

    points: block and others, of which `point` makes the point, no two rows alike. An exact radius join: whatever the pivots, none is lost.
    """
    cells = cut(_cells(points.withColumn("home", F.lit(True)), radius, point))
    for _ in range(LEVELS):
        biggest = cells.groupBy("block").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
        if biggest <= CELL:
            break
        finer = cut(_cells(cells.drop("from"), radius, point))
        if finer.count() > 4 * cells.count():
            break  # names that no pivot parts
        cells = finer
    theirs = cells.where("home").select("block", *[F.col(c).alias(c + "2") for c in cells.columns if c not in ("block", "home")])
    met = cells.join(theirs, "block").where(F.abs(F.col("from") - F.col("from2")) <= radius)
    others = [c for c in points.columns if c != "block"]
    itself = F.struct(*others).eqNullSafe(F.struct(*[c + "2" for c in others]))
    # with a threshold the distance is -1 beyond it
    return met.where(~itself & (F.levenshtein(point(""), point("2"), radius) >= 0)).drop("block", "home", "from", "from2")


def replication(points: DataFrame, radius: int = RADIUS, point: Point = _told) -> float:
    """Cells that hold a point of a block of two or more, on the average."""
    cells = _cells(points.withColumn("home", F.lit(True)), radius, point)
    n = cells.agg(F.count("*").alias("all"), F.count_if("home").alias("home")).first()
    return n["all"] / n["home"] if n["home"] else 0.0


def _one_edit(x: str, y: str) -> bool:
    """Whether the distance is at most 1, in linear time."""
    if abs(len(x) - len(y)) > 1:
        return False
    i, n, m = 0, len(x), len(y)
    while i < min(n, m) and x[i] == y[i]:
        i += 1
    while i < min(n, m) and x[n - 1] == y[m - 1]:
        n, m = n - 1, m - 1
    return max(n, m) - i <= 1 or n - i == m - i == 2 and x[i:n] == y[i:m][::-1]


def _initials(a: str) -> bool:
    return len(a.replace(" ", "")) == len(a.split())


def _one_edit_each(x: str, y: str) -> bool:
    """Whether two keys differ by at most one edit in each part; initials and parts of one sign must be equal."""
    a, b = x.split("|"), y.split("|")
    if a[0] == "per" and a[1] != b[1] and (_initials(a[1]) or _initials(b[1])):
        return False
    return a[0] == b[0] and len(a) == len(b) and all(p == q or min(len(p), len(q)) > 1 and _one_edit(p, q) for p, q in zip(a[1:], b[1:]))


def _omissions(of: str, value: str) -> set[int]:
    """Hashes of a value and of what is left of it without any one sign, in linear time; of: what it is a value of."""
    mod, base = (1 << 61) - 1, 1_000_003_019
    to, powers = [sum(ord(c) << 7 * i for i, c in enumerate(of)) % mod], [1]
    for c in value:
        to.append((to[-1] * base + ord(c) + 1) % mod)
        powers.append(powers[-1] * base % mod)
    return {to[-1]} | {(to[-1] + (to[i] - to[i + 1]) * powers[-2 - i]) % mod for i in range(len(value))}


def near_values(keys: DataFrame) -> DataFrame:
    """(value, others): for type|part|value, part being core or rest, the values an edit away that as many keys or more have.

    Values of two signs or more. Of two near ones that as many keys have the larger one is the other's.
    Two strings an edit apart share what is left of either without some sign; a sign more or less
    makes but so many strings of it as there are signs and places, so no value has many partners.
    """

    def omit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = [(h, v, n) for v, n in zip(pdf["value"], pdf["n"]) for h in _omissions(*_of(v))]
            yield pd.DataFrame(rows, columns=["left", "value", "n"])

    def exact(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            yield pdf.loc[[_of(x)[0] == _of(y)[0] and _one_edit(_of(x)[1], _of(y)[1]) for x, y in zip(pdf["value"], pdf["other"])]]

    both = keys.select(F.explode(F.array(*[F.when(F.length(p) > 1, F.concat_ws("|", "type", F.lit(p), p)) for p in ("core", "rest")])).alias("value"))
    seen = both.where("value is not null").groupBy("value").agg(F.count("*").alias("n"))
    left = cut(seen.mapInPandas(omit, "left bigint, value string, n bigint"))
    met = left.join(left.select("left", F.col("value").alias("other"), F.col("n").alias("n2")), "left").where(F.struct("n", "value") < F.struct("n2", "other"))
    return met.select("value", "other").distinct().mapInPandas(exact, "value string, other string").groupBy("value").agg(F.collect_set("other").alias("others"))


def _of(value: str) -> tuple[str, str]:
    """(type|part, value)."""
    t, part, v = value.split("|")
    return f"{t}|{part}", v


def blocks(keys: DataFrame) -> DataFrame:
    """(block, key, cores, own_core, own_rest): keys by their two surnames or places and by near ones that are as frequent or more so.

    Two keys with surnames that are equal or near meet in the block of the more frequent first and the
    more frequent second one, which for either surname is at least one key's own; in no other block that is so.
    If neither is a key's own both are the other key's, so only blocks that are some key's are visited so.
    """
    near = cut(near_values(keys))
    told = keys.select("key", F.col("cores").cast("int").alias("cores"), "type", "core", "rest")
    for p in ("core", "rest"):
        others = F.transform(F.coalesce("others", F.array().cast("array<string>")), lambda x: F.substring_index(x, "|", -1))
        told = told.withColumn("value", F.concat_ws("|", "type", F.lit(p), p)).join(near, "value", "left").withColumn(f"near_{p}", others).drop("value", "others")
    told = cut(told)
    block = lambda core, rest: F.concat_ws("|", "type", core, rest)
    visits = lambda of, own_core, own_rest: told.select(F.explode(of).alias("block"), "key", "cores", F.lit(own_core).alias("own_core"), F.lit(own_rest).alias("own_rest"))
    home = visits(F.array(block("core", "rest")), True, True)
    by_core = visits(F.transform("near_core", lambda c: block(c, "rest")), False, True)
    by_rest = visits(F.transform("near_rest", lambda r: block("core", r)), True, False)
    both = visits(F.flatten(F.transform("near_core", lambda c: F.transform("near_rest", lambda r: block(c, r)))), False, False)
    return home.unionByName(by_core).unionByName(by_rest).unionByName(both.join(home.select("block").distinct(), "block", "left_semi"))


def _part(key: Column, n: int) -> Column:
    return F.element_at(F.split(key, r"\|"), n)


def varying(suffix: str) -> Column:
    """What of a key is left to compare in its block: the given name or kind."""
    return _part(F.col("key" + suffix), 2)


def edges(keys: DataFrame) -> DataFrame:
    """(key, other), both ways: keys that differ by an edit a part.

    keys: key, type, a, core, rest, cores (with how many first surnames the given name a stands).
    """

    def exact(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            yield pdf.loc[[_one_edit_each(x, y) for x, y in zip(pdf["key"], pdf["key2"])], ["key", "key2"]].rename(columns={"key2": "other"})

    met = near_pairs(blocks(keys), RADIUS, varying).where("(own_core or own_core2) and (own_rest or own_rest2)")
    few, many = F.least("cores", "cores2"), F.greatest("cores", "cores2")
    met = met.where((varying("") == varying("2")) | ~((few >= COMMON) & (few >= TYPO_SHARE * many)))
    return met.select("key", "key2").mapInPandas(exact, "key string, other string")


def hubs(keys: DataFrame, links: DataFrame) -> DataFrame:
    """(key, entity): each key's best-attested neighbour, and that one's.

    Attested best is a key known otherwise, then the one with most spellings, then with most neighbours; of several that are
    better than the key itself, the one that differs from it in the fewest parts; then the smallest. So the
    correct form is the hub of its typos, and two hops lead to it. keys: key, spellings, known.
    """
    degree = links.groupBy("key").agg(F.count("*").alias("degree"))
    worth = F.struct((~F.col("known")).alias("u"), (-F.col("spellings")).alias("s"), (-F.coalesce("degree", F.lit(0))).alias("d"))
    scored = cut(keys.join(degree, "key", "left").select("key", worth.alias("worth")))
    parts = F.size(F.filter(F.zip_with(F.split("key", r"\|"), F.split("other", r"\|"), lambda x, y: x != y), lambda differs: differs))
    met = links.join(scored.withColumnRenamed("key", "other"), "other")
    best = met.groupBy("key").agg(F.min(F.struct("worth", F.col("other").alias("k"))).alias("first"), F.min(F.struct("worth", parts.alias("n"), F.col("other").alias("k"))).alias("nearest"))
    own = F.struct("worth", F.col("key").alias("k"))
    better = F.when(F.col("nearest.worth") < F.col("worth"), F.col("nearest.k")).otherwise(F.least(own, F.coalesce("first", own))["k"])
    up = cut(scored.join(best, "key", "left").select("key", better.alias("up")))
    return up.join(up.select(F.col("key").alias("up"), F.col("up").alias("entity")), "up").select("key", "entity")


def _nick(given: str) -> set[str]:
    """Short forms of a given name: of the list, and its beginnings and ends of at least four signs."""
    out = set(NICKNAMES.get(given, "").split())
    if " " not in given:
        out |= {given[i:] for i in range(1, len(given) - 3)} | {given[:i] for i in range(4, len(given))}
    else:
        out.add(given.split(" ")[0])
    return out - {given}


def _nick_offers(t: str, a: str, c: str, r: str, cores: int) -> set[str]:
    """Nicknames under which a whole key can be meant."""
    known = t == "per" and (cores >= COMMON or " " in a or a in NICKNAMES)
    return {f"{n}|{c}|{r}" for n in _nick(a)} if known else set()


def _nick_asks(t: str, a: str, c: str, r: str, cores: int) -> set[str]:
    return {f"{a}|{c}|{r}"} if t == "per" and _whole(t, a, c, r) else set()


def _offers(t: str, a: str, c: str, r: str, cores: int) -> set[str]:
    """Shortened views under which a whole key can be meant."""
    return {f"{t}|short|{a}|{c}|", f"{t}|short|{a}|{c}|{r[0]}"} | ({f"{t}|initial|{a[0]}|{c}|{r}"} if t == "per" else set())


def _asks(t: str, a: str, c: str, r: str, cores: int) -> set[str]:
    """Views of a key that may be a shortened one."""
    if _whole(t, a, c, r) or len(c) < 2 or not a:
        return set()
    if t == "per" and len(a.replace(" ", "")) == len(a.split()):
        return {f"{t}|initial|{a[0]}|{c}|{r}"} if len(r) > 1 else set()
    return {f"{t}|short|{a}|{c}|{r[:1]}"} if len(r) <= 1 else set()


def _views(keys: DataFrame, of) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = [(v, k) for k, *x in zip(pdf["key"], pdf["type"], pdf["a"], pdf["core"], pdf["rest"], pdf["cores"]) for v in of(*x)]
            yield pd.DataFrame(rows, columns=["view", "key"])

    return keys.mapInPandas(run, "view string, key string")


def sets(triples: DataFrame) -> DataFrame:
    """(name, entity): names with the same entity are spellings of one."""
    names = spread(cut(_spellings(triples)))
    forms = cut(canonical(names).withColumn("key", F.concat_ws("|", "type", "a", "core", "rest")))
    keys = forms.groupBy("key", "type", "a", "core", "rest").agg(F.count("*").alias("spellings"))
    common = keys.where("type = 'per'").groupBy("a").agg(F.count_distinct("core").alias("cores"))
    keys = cut(keys.join(common, "a", "left").withColumn("cores", F.when(F.col("type") == "per", F.col("cores")).otherwise(F.lit(0))))
    single = F.length(F.replace("a", F.lit(" "), F.lit(""))) == F.size(F.split("a", " "))
    full = [(F.length("a") > 1) & ~((F.col("type") == "per") & single), F.length("core") > 1, F.length("rest") > 1]
    whole, partial = keys.where(full[0] & full[1] & full[2]), keys.where(~(full[0] & full[1] & full[2]))
    links = cut(edges(keys.where(sum(x.cast("int") for x in full) >= 2)))  # none between whole keys and others
    entity = cut(hubs(whole.select("key", "spellings", F.lit(False).alias("known")), links))

    # a nickname goes with the one name it fits, and takes the typos of which it is the hub with it
    # both have the same surnames, so keys that are alone with theirs neither ask nor offer
    shared = whole.where("type = 'per'").groupBy("core", "rest").agg(F.count("*").alias("n")).where("n > 1").select("core", "rest")
    namesakes = cut(whole.join(shared, ["core", "rest"], "left_semi"))
    nick = _fits(_views(namesakes, _nick_asks), _views(namesakes, _nick_offers), entity)
    moved = nick.join(entity, "key").groupBy("entity").agg(F.min("meant").alias("moved"))
    entity = cut(entity.join(moved, "entity", "left").select("key", F.coalesce("moved", "entity").alias("entity")))
    # initials and dropped parts likewise; those that fit none go with one that they are a typo of, and with what that one fits
    fits = cut(_fitted(_views(keys, _asks), _views(whole, _offers), entity))
    known = partial.join(fits.select("key", F.lit(True).alias("known")), "key", "left").select("key", "spellings", F.coalesce("known", F.lit(False)).alias("known"))
    hub = hubs(known, links.join(fits, "key", "left_anti"))
    short = hub.join(fits.where("n = 1").select(F.col("key").alias("entity"), "meant"), "entity", "left")
    linked = entity.unionByName(short.select("key", F.coalesce("meant", "entity").alias("entity")))
    return forms.join(linked, "key", "left").select("name", F.coalesce("entity", "key").alias("entity"))


def _fitted(asks: DataFrame, offers: DataFrame, entity: DataFrame) -> DataFrame:
    """(key, n, meant): how many entities a key's views fit, other than its own, and the smallest of them."""
    own = entity.withColumnRenamed("entity", "own")
    met = asks.join(own, "key", "left").join(offers.join(entity, "key").select("view", F.col("entity").alias("meant")), "view")
    met = met.where("own is null or own <> meant").select("key", "meant").distinct()
    return met.groupBy("key").agg(F.count("*").alias("n"), F.min("meant").alias("meant"))


def _fits(asks: DataFrame, offers: DataFrame, entity: DataFrame) -> DataFrame:
    """(key, meant): the entity that a key's views fit, other than its own, where it is one only."""
    return _fitted(asks, offers, entity).where("n = 1").select("key", "meant")


def variants(triples: DataFrame) -> DataFrame:
    """(name_a, name_b) of all pairs of spellings of one person or organisation."""
    s = cut(sets(triples))
    return s.select(F.col("name").alias("name_a"), "entity").join(s.select(F.col("name").alias("name_b"), "entity"), "entity").where("name_a < name_b").select("name_a", "name_b")


def classes(triples: DataFrame) -> DataFrame:
    """(name, entity, spellings, links): each name with its class, named by its smallest spelling, the spellings of the class and the name's links to others."""
    s = cut(sets(triples))
    per = s.groupBy("entity").agg(F.min("name").alias("first"), F.count("*").alias("spellings"))
    return s.join(per, "entity").select("name", F.col("first").alias("entity"), "spellings", (F.col("spellings") - 1).alias("links"))
