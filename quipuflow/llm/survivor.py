"""Problem 4: one surviving record of each group of duplicates.

A value counts if it is usable: not absent, no word or sign for absence, not visibly broken or cut
short, and not a mere beginning of another value of its field in the group.

Records are compared in three criteria: completeness (how many fields are usable), recency (extracted_at,
ties by the smaller copy_id) and trust. One dominates another that is nowhere better and somewhere
worse. Of the records of one trust and one set of usable fields only the latest stays, as it stands in
for all of them; a group has at most 2^fields of those for each trust level. Their skyline, those that
none dominates, is the first layer; without it the next skyline is the second, and so on.

`survivors` gives each field, by itself, its best value: of the records that offer the field those on their
skyline, of them by the policy: trust, then recency. As that policy follows the criteria, its choice always lies on
the skyline, which narrows the choice and cannot change it.

`records` builds one record a group: the policy takes the most complete, then most trusted, then latest
record of the first layer, and what it lacks is filled from the others in the order of the
layers. There the layers do change the choice: a value of an undominated record goes before one of
a record that the survivor's layer dominates, though that may be more complete or more trusted.

Groups of at most HOT records are gathered in one shuffle. Those of more are found by a count first; they are reduced to their
distinct rows, their values are sorted over many tasks to find beginnings, and only the records that stand in for others are
gathered. Both ways give the same rows.

Ties in trust and time go to the smallest copy_id. A group without a usable value gives null. An
unknown or null method counts as the lowest trust. Extra columns are left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipuflow.functions.text import let
from quipuflow.session import cut

FIELDS = ("head", "head_type", "tail")
#: Words and signs that stand for absence, in lower case.
ABSENT = ("null", "none", "nan", "nil", "na", "n/a", "n.a.", "s/d", "s/n", "s.d.", "unk", "unknown", "undefined", "missing", "desconocido", "desconocida", "sin datos", "sin dato", "no disponible", "ninguno", "ninguna", "tbd")
#: Two-sign traces of UTF-8 read as Latin-1 or Windows-1252.
MOJIBAKE = "[ÂÃ][\u0080-¿ŒœŠšŸŽžƒˆ˜–—‘-„†-•…‰‹›€™]"
#: Groups of more records than HOT are reduced before they are gathered.
HOT = 500
#: So many ids of hot groups are sent to all tasks; if there are more, they are joined.
LISTED = 10_000
LOWEST = -1


def well_formed(v: Column) -> Column:
    """Usable as far as the value itself tells."""
    t = F.trim(F.regexp_replace(v, r"^[\s ]+|[\s ]+$", ""))
    said = t.rlike(r"[\p{L}\p{N}]") & ~F.lower(t).isin(*ABSENT)
    broken = t.contains("�") | t.rlike(MOJIBAKE) | t.rlike(r"[\u0080-\u009f]")
    cut_ = t.rlike(r"(\.\.\.|…)$")
    return F.coalesce(said & ~broken & ~cut_, F.lit(False))


# rows and groups


def _rows(copies: DataFrame, trust: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """(g, trust, rank(at, neg_id), v: the fields as strings, ok: whether each is well formed)."""
    levels = trust.where(F.col("method").isNotNull()).groupBy("method").agg(F.max("trust").cast("int").alias("trust"))
    src = copies.select(F.col("group_id").alias("g"), "copy_id", "method", "extracted_at", *[F.col(f).cast("string").alias(f"f{i}") for i, f in enumerate(fields)])
    v = [F.col(f"f{i}") for i in range(len(fields))]
    return src.join(levels, "method", "left").select(
        "g",
        F.coalesce("trust", F.lit(LOWEST)).alias("trust"),
        F.struct(F.col("extracted_at").alias("at"), (-F.col("copy_id")).alias("neg_id")).alias("rank"),
        F.array(*v).alias("v"),
        F.array(*[well_formed(x) for x in v]).alias("ok"),
    )


def _hot(copies: DataFrame) -> DataFrame | None:
    """(g) of the groups of more than HOT records, or None."""
    hot = copies.groupBy("group_id").agg(F.count("*").alias("n")).where(F.col("n") > HOT).select(F.col("group_id").alias("g"))
    listed = hot.limit(LISTED + 1).collect()
    if not listed:
        return None
    if len(listed) > LISTED:
        return hot
    return F.broadcast(copies.sparkSession.createDataFrame(listed, hot.schema))


def _value(i: int) -> Callable[[Column], Column]:
    return lambda r: r["v"][i]


def _usable(i: int) -> Callable[[Column], Column]:
    return lambda r: r["ok"][i]


def _without_beginnings(records: Column, fields: int) -> Column:
    """records of one group, with ok false where a value begins another value of its field."""
    values = F.array(*[F.array_distinct(F.transform(records, _value(i))) for i in range(fields)])

    def marked(all_values: Column) -> Column:
        def begins(r: Column, i: int) -> Column:
            return F.coalesce(F.exists(all_values[i], lambda x: x.startswith(r["v"][i]) & (x != r["v"][i])), F.lit(False))

        def one(r: Column) -> Column:
            ok = F.array(*[r["ok"][i] & ~begins(r, i) for i in range(fields)])
            return F.struct(r["trust"].alias("trust"), r["rank"].alias("rank"), r["v"].alias("v"), ok.alias("ok"))

        return F.transform(records, one)

    return let(values, marked)


def _stand_ins(records: Column) -> Column:
    """Of the records of one trust and one set of usable fields the latest."""
    return F.filter(records, lambda a: ~F.exists(records, lambda b: (b["trust"] == a["trust"]) & (b["ok"] == a["ok"]) & ((b["rank"] > a["rank"]) | ((b["rank"] == a["rank"]) & (b["v"] > a["v"])))))


def _gathered(rows: DataFrame, fields: int) -> DataFrame:
    """(g, records): the records of each group that stand in for all."""
    groups = rows.groupBy("g").agg(F.collect_list(F.struct("trust", "rank", "v", "ok")).alias("records"))
    return groups.select("g", let(_without_beginnings(F.col("records"), fields), lambda r: F.array_distinct(_stand_ins(r))).alias("records"))


# hot groups


def _begun(values: DataFrame) -> DataFrame:
    """(g, field, value) of the values that begin another one of their field and group; values: distinct.

    In a sorted list a value stands right before one that it begins, if there is any. The list is sorted
    over as many tasks as there are shuffle partitions; the first value of each, few and collected, closes the gap to the
    one before.
    """
    spark = values.sparkSession
    parts = cut(values.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "g", "field", "value").sortWithinPartitions("g", "field", "value").withColumn("part", F.spark_partition_id()))
    firsts = {r.part: (r.x.g, r.x.field, r.x.value) for r in parts.groupBy("part").agg(F.min(F.struct("g", "field", "value")).alias("x")).collect()}
    after = {p: firsts[min(q for q in firsts if q > p)] for p in firsts if any(q > p for q in firsts)}
    kind = values.schema["g"].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        part = None
        for pdf in frames:
            out = []
            for g, f, v, part in zip(pdf["g"], pdf["field"], pdf["value"], pdf["part"]):
                g = None if pd.isna(g) else g
                if held and held[:2] == (g, f) and v.startswith(held[2]):
                    out.append(held)
                held = (g, f, v)
            yield pd.DataFrame(out, columns=["g", "field", "value"])
        if held and part in after and after[part][:2] == held[:2] and after[part][2].startswith(held[2]):
            yield pd.DataFrame([held], columns=["g", "field", "value"])

    return parts.mapInPandas(run, f"g {kind}, field int, value string")


def _reduced(rows: DataFrame, fields: int) -> DataFrame:
    """(g, records) of hot groups: distinct rows first, then those that stand in, then gathered."""
    rows = cut(rows.groupBy("g", "trust", "v", "ok").agg(F.max("rank").alias("rank")))
    values = rows.select("g", F.posexplode("v").alias("field", "value")).where("value is not null").distinct()
    begun = _begun(values)
    for i in range(fields):
        own = begun.where(F.col("field") == i).select(F.col("g").alias("_g"), F.col("value").alias("_v"))
        rows = rows.join(own, F.col("g").eqNullSafe(F.col("_g")) & (F.col("v")[i] == F.col("_v")), "left")
        ok = F.array(*[F.col("ok")[k] & F.col("_v").isNull() if k == i else F.col("ok")[k] for k in range(fields)])
        rows = rows.withColumn("ok", ok).drop("_g", "_v")
    best = rows.groupBy("g", "trust", "ok").agg(F.max(F.struct("rank", "v")).alias("b"))
    return best.groupBy("g").agg(F.collect_list(F.struct("trust", F.col("b.rank").alias("rank"), F.col("b.v").alias("v"), "ok")).alias("records"))


def _groups(copies: DataFrame, trust: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """(g, records): of each group the records that stand in for all; few, whatever the group's size."""
    rows = _rows(copies, trust, fields)
    hot = _hot(copies)
    if hot is None:
        return _gathered(rows, len(fields))
    same = rows["g"].eqNullSafe(hot["g"])
    return _gathered(rows.join(hot, same, "left_anti"), len(fields)).unionByName(_reduced(rows.join(hot, same, "left_semi"), len(fields)))


# skylines


def _complete(r: Column) -> Column:
    return F.size(F.filter(r["ok"], lambda x: x))


def dominates(a: Column, b: Column) -> Column:
    """Whether record a is nowhere worse than b in trust, recency and completeness, and somewhere better."""
    at_least = (a["trust"] >= b["trust"]) & (a["rank"] >= b["rank"]) & (_complete(a) >= _complete(b))
    return at_least & ((a["trust"] > b["trust"]) | (a["rank"] > b["rank"]) | (_complete(a) > _complete(b)))


def skyline(records: Column) -> Column:
    """The records that none dominates."""
    return F.filter(records, lambda a: ~F.exists(records, lambda b: dominates(b, a)))


def layers(records: Column) -> Column:
    """records in the order of the policy, as structs (layer, complete, trust, rank, v, ok): first the lowest layer, then the most complete, trusted, latest.

    A record lies one layer below the lowest of those that dominate it, which is what taking away
    one skyline after another comes to.
    """
    keyed = F.transform(records, lambda r: F.struct(r["trust"].alias("trust"), r["rank"].alias("rank"), _complete(r).alias("complete"), r["v"].alias("v"), r["ok"].alias("ok")))
    # whoever dominates a record comes before it
    ordered = F.reverse(F.array_sort(keyed))
    empty = F.filter(F.transform(ordered, lambda r: F.struct(F.lit(0).alias("neg_layer"), r["complete"].alias("complete"), r["trust"].alias("trust"), r["rank"].alias("rank"), r["v"].alias("v"), r["ok"].alias("ok"))), lambda r: F.lit(False))

    def place(done: Column, r: Column) -> Column:
        above = F.array_min(F.transform(F.filter(done, lambda a: dominates(a, r)), lambda a: a["neg_layer"]))
        return F.concat(done, F.array(F.struct((F.coalesce(above, F.lit(0)) - 1).alias("neg_layer"), r["complete"].alias("complete"), r["trust"].alias("trust"), r["rank"].alias("rank"), r["v"].alias("v"), r["ok"].alias("ok"))))

    return F.reverse(F.array_sort(F.aggregate(ordered, empty, place)))


def survivors(copies: DataFrame, trust: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """(group_id, fields): the best value of each field by itself; one row per group."""

    def best(i: int) -> Column:
        offers = F.filter(F.col("records"), _usable(i))
        return let(offers, lambda o: F.array_max(F.transform(skyline(o), lambda r: F.struct(r["trust"].alias("trust"), r["rank"].alias("rank"), r["v"][i].alias("value")))))["value"]

    return _groups(copies, trust, fields).select(F.col("g").alias("group_id"), *[best(i).alias(f) for i, f in enumerate(fields)])


def records(copies: DataFrame, trust: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """(group_id, copy_id, fields, deepest): one record per group, filled layer by layer.

    copy_id: the record that survives; deepest: the lowest layer, from 1, that gave a value, or 0 if none did.
    """
    found = _groups(copies, trust, fields).select("g", layers(F.col("records")).alias("r"))
    offer = [F.get(F.filter(F.col("r"), _usable(i)), F.lit(0)) for i in range(len(fields))]
    deepest = F.greatest(F.lit(0), *[-x["neg_layer"] for x in offer])
    return found.select(F.col("g").alias("group_id"), (-F.get(F.col("r"), F.lit(0))["rank"]["neg_id"]).alias("copy_id"), *[x["v"][i].alias(f) for i, (f, x) in enumerate(zip(fields, offer))], deepest.alias("deepest"))
