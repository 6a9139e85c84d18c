"""Entity resolution: exact groups by normal form, then similar names within a block.

The similarity of two normal forms is 0.6 of their tokens' Jaccard index and 0.4 of their matching
ratio. At a threshold t, two different names need a Jaccard index of at least (t - 0.4) / 0.6, so
pairs are found by an equi-join on their rarest tokens and never by comparing a block with itself.
All similar pairs are found. With a window given, blocks with more than four windows' entities compare
neighbours in (length, name) order only, which loses pairs; the original does so with WINDOW.

Leaders are the greedy choice in that order: an entity that isn't similar to an earlier leader leads.
This is the first maximal independent set of the similarity graph, found in rounds over its edges.

Null and blank entities are left out. All ties are resolved by score, length and name.
"""

from __future__ import annotations

import difflib
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipuflow.functions.text import normalize_entity, strip
from quipuflow.session import cut

THRESHOLD = 0.85
#: The original's window; none is the default here.
WINDOW = 50
#: Words of formal names.
FORMAL = ("república", "estado", "ciudad", "provincia", "departamento")
FRAGMENTS = ("de ", "del ", "la ", "el ", "los ", "las ")


def name_score(e: Column) -> Column:
    """How well a name represents its group. The points are fixed values."""
    low, n = F.lower(e), F.length(e)
    first = F.substring(e, 1, 1)
    score = F.when((e == low) & (e != F.upper(e)) & (n > 3), -20).otherwise(0)
    score += F.when((first == F.upper(first)) & (first != F.lower(first)) & ~((e == F.upper(e)) & (e != low)), 15).otherwise(0)
    score += F.when(e.contains("."), -10).otherwise(0)
    score += F.when(n < 3, -15).when(n < 5, -5).otherwise(0)
    score += F.when(n.between(5, 50), 10).when(n > 50, -5).otherwise(0)
    score -= 2 * F.length(F.regexp_replace(e, r"[\p{L}\p{N} \-]", ""))
    formal, part = F.lit(False), F.lit(False)
    for w in FORMAL:
        formal = formal | low.contains(w)
    for w in FRAGMENTS:
        part = part | e.startswith(w)
    return score + F.when(formal, 8).otherwise(0) + F.when(part, -10).otherwise(0)


def entities(triples: DataFrame) -> DataFrame:
    """(entity): the distinct heads and tails that aren't blank, as they stand."""
    e = triples.select(F.explode(F.array("head", "tail")).alias("entity"))
    return e.where(strip(F.coalesce(F.col("entity"), F.lit(""))) != "").distinct()


def exact_map(ents: DataFrame) -> DataFrame:
    """(entity, norm, representative): the best name of each normal form, by partial aggregation."""
    # one shuffle for the groups and the join, behind which names aren't normalized anew
    e = ents.withColumn("norm", normalize_entity(F.col("entity"))).repartition("norm")
    best = e.groupBy("norm").agg(F.min_by("entity", F.struct(-name_score(F.col("entity")), F.length("entity"), F.lower("entity"), F.col("entity"))).alias("representative"))
    return e.join(best, "norm")


def ranked(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """df with pos, the place in its group from 1, without sending a group to one task.

    The rows are sorted by range; a partition adds up the rows of the group in the partitions before
    it, of which there is one count per partition and group at its edges.
    """
    keyed = df.repartitionByRange(*by, *order).sortWithinPartitions(*by, *order)
    keyed = cut(keyed.withColumn("_p", F.spark_partition_id()).withColumn("_i", F.monotonically_increasing_id()))
    per = keyed.groupBy(*by, "_p").agg(F.count("*").alias("_n"), F.min("_i").alias("_from"))
    from pyspark.sql import Window

    w = Window.partitionBy(*by).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("_before", F.coalesce(F.sum("_n").over(w), F.lit(0))).drop("_n")
    return keyed.join(per, [*by, "_p"]).withColumn("pos", F.col("_i") - F.col("_from") + F.col("_before") + 1).drop("_p", "_i", "_from", "_before")


def _ratio(pairs: DataFrame, threshold: float) -> DataFrame:
    """Pairs whose similarity reaches the threshold; a is the earlier one."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            sim = [0.6 * j + 0.4 * difflib.SequenceMatcher(None, x, y).ratio() for x, y, j in zip(pdf["na"], pdf["nb"], pdf["jaccard"])]
            yield pdf.assign(similarity=sim)[lambda x: x["similarity"] >= threshold][["block", "a", "b", "similarity"]]

    return pairs.select("block", "a", "b", "na", "nb", "jaccard").mapInPandas(run, "block string, a long, b long, similarity double")


def candidates(ents: DataFrame, threshold: float = THRESHOLD, window: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(positions, pairs) of exact representatives: block, pos, entity, norm; block, a < b, na, nb, jaccard.

    All pairs of a block, within the window, whose Jaccard index lets them reach the threshold.
    """
    if threshold <= 0.4:
        raise ValueError("below 0.4 names without a common token could be similar; take a higher threshold")
    reps = exact_map(ents).where("entity = representative").select("entity", "norm")
    reps = reps.withColumn("block", F.coalesce(F.nullif(F.substring("norm", 1, 1), F.lit("")), F.lit("z"))).withColumn("len", F.length("norm"))
    pos = cut(ranked(reps, ["block"], ["len", "norm"]))
    toks = F.array_distinct(F.filter(F.split("norm", r"[^\p{L}\p{N}_]+"), lambda t: t != ""))
    need = (threshold - 0.4) / 0.6
    # prefix filter: two sets with a Jaccard index of j share one of the first n - ceil(j n) + 1 tokens, rarest first
    long = pos.select("block", "pos", F.size(toks).alias("n"), F.explode(toks).alias("t"))
    freq = long.groupBy("t").agg(F.count("*").alias("f"))
    order = long.join(freq, "t").groupBy("block", "pos", "n").agg(F.sort_array(F.collect_list(F.struct("f", "t"))).alias("ts"))
    pre = order.select("block", "pos", F.explode(F.slice("ts", F.lit(1), (F.col("n") - F.ceil(F.col("n") * need) + 1).cast("int"))).alias("x")).select("block", "pos", "x.t")
    met = pre.select("block", "t", F.col("pos").alias("a")).join(pre.select("block", "t", F.col("pos").alias("b")), ["block", "t"]).where("a < b").select("block", "a", "b").distinct()
    if window is not None:
        size = pos.groupBy("block").agg(F.count("*").alias("size"))
        met = met.join(size, "block").where((F.col("size") <= 4 * window) | (F.col("b") - F.col("a") <= window))
    side = pos.select("block", "pos", "norm", toks.alias("toks"))
    met = met.join(side.select("block", F.col("pos").alias("a"), F.col("norm").alias("na"), F.col("toks").alias("ta")), ["block", "a"]).join(side.select("block", F.col("pos").alias("b"), F.col("norm").alias("nb"), F.col("toks").alias("tb")), ["block", "b"])
    j = F.size(F.array_intersect("ta", "tb")) / F.size(F.array_union("ta", "tb"))
    return pos, met.withColumn("jaccard", j).where(F.col("jaccard") >= need)


def similar(ents: DataFrame, threshold: float = THRESHOLD, window: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(positions, edges) of exact representatives: block, pos, entity, norm; block, a < b, similarity."""
    pos, pairs = candidates(ents, threshold, window)
    return pos, _ratio(pairs, threshold)


def leaders(edges: DataFrame) -> DataFrame:
    """(block, b, a): each member and its earliest similar leader; leaders and lone entities don't appear.

    A round takes the entities that no open one stands before as leaders and covers their neighbours; only
    edges between open entities go on. There are as many rounds as the longest chain of entities that wait for one
    another, each with one checkpoint of what is left.
    """
    every = left = cut(edges.select("block", "a", "b"))
    covered = None
    while left.limit(1).count():
        waiting = left.select("block", F.col("b").alias("a")).distinct()
        told = left.join(waiting, ["block", "a"], "left_anti").select("block", F.col("b").alias("v")).distinct()
        covered = told if covered is None else covered.union(told)
        open_ = left
        for end in ("a", "b"):
            open_ = open_.join(told.withColumnRenamed("v", end), ["block", end], "left_anti")
        # the edges of the new leaders end in covered entities, so they are gone too
        left = cut(open_)
    if covered is None:
        return every
    covered = cut(covered)
    member = every.join(covered.withColumnRenamed("v", "b"), ["block", "b"], "left_semi").join(covered.withColumnRenamed("v", "a"), ["block", "a"], "left_anti")
    return member.groupBy("block", "b").agg(F.min("a").alias("a"))


def entity_map(triples: DataFrame, threshold: float = THRESHOLD, window: int | None = None) -> DataFrame:
    """(original, representative) of the entities whose name changes; single lookups, not transitive."""
    ents = cut(entities(triples))
    exact = exact_map(ents).where("entity <> representative").select(F.col("entity").alias("original"), "representative")
    pos, edges = similar(ents, threshold, window)
    led = leaders(edges)
    name = pos.select("block", "pos", "entity")
    group = led.select("block", F.col("a").alias("lead"), F.col("b").alias("pos")).union(led.select("block", F.col("a").alias("lead"), F.col("a").alias("pos")).distinct())
    group = group.join(name, ["block", "pos"])
    best = group.groupBy("block", "lead").agg(F.min_by("entity", F.struct(-name_score(F.col("entity")), F.col("pos"))).alias("representative"))
    fuzzy = group.join(best, ["block", "lead"]).where("entity <> representative").select(F.col("entity").alias("original"), "representative")
    return exact.unionByName(fuzzy)


def renamed(triples: DataFrame, mapping: DataFrame) -> DataFrame:
    """Triples with head and tail looked up once each, then normalized.

    The mapping grows with the entities, so how it is joined is left to the planner's statistics.
    """
    out = triples
    for c in ("head", "tail"):
        out = out.join(mapping.select(F.col("original").alias(f"_{c}"), F.col("representative").alias(f"_{c}_new")), out[c] == F.col(f"_{c}"), "left")
        out = out.withColumn(c, normalize_entity(F.coalesce(f"_{c}_new", c))).drop(f"_{c}", f"_{c}_new")
    return out
