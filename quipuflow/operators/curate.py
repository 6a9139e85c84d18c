"""Uniqueness, connectivity and deduplication of triples.

All take a total order column of unique integers (`ord`). Heads, relations and tails that are null
count as values of their own unless said otherwise. Extra columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quipuflow.functions.text import strip

#: Rows of one key that a task sorts at once; keys with more are cut into blocks of the order column.
BLOCK = 65_536


def unique_triples(df: DataFrame, margin: float = 0.05, ord_col: str = "ord", block: int = BLOCK) -> DataFrame:
    """One triple per (head, type): the first, replaced by a later one only if its confidence is more than `margin` higher.

    A null confidence counts as 0. NaN never wins, and a first NaN is never replaced. The result has
    the columns of df and first_ord, the place of the key's first triple.

    Only rows above all earlier ones of their key can win, as the kept confidence is never more than
    the margin below the highest so far. They are found in blocks of the order column first, so a hot
    key is spread over tasks; what is left of a key is a strictly rising sequence.
    """
    conf = F.coalesce(F.col("confidence"), F.lit(0.0))
    slim = df.select("head", "type", F.col(ord_col).alias("_o"), conf.alias("_c"), F.floor(F.col(ord_col) / block).alias("_b"))
    key = ["head", "type"]
    before = lambda *cols: Window.partitionBy(*cols).orderBy("_o").rowsBetween(Window.unboundedPreceding, -1)
    number = F.when(~F.isnan("_c"), F.col("_c"))
    for cols in ([*key, "_b"], key):
        slim = slim.withColumn("_m", F.max(number).over(before(*cols))).withColumn("_first", F.row_number().over(Window.partitionBy(*cols).orderBy("_o")) == 1)
        slim = slim.where(F.col("_first") | (~F.isnan("_c") & (F.col("_m").isNull() | (F.col("_c") > F.col("_m"))))).drop("_m", "_first")
    rising = slim.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("_o", "_c"))).alias("r"))
    kept = F.aggregate(
        F.slice("r", 2, F.size("r")),
        F.get("r", F.lit(0)),
        lambda k, x: F.when(~F.isnan(k["_c"]) & ~F.isnan(x["_c"]) & (x["_c"] > k["_c"] + F.lit(margin)), x).otherwise(k),
    )
    won = rising.select(kept["_o"].alias("_won"), F.get("r", F.lit(0))["_o"].alias("first_ord"))
    return df.drop("first_ord").join(won, F.col(ord_col) == F.col("_won")).drop("_won")


def degrees(df: DataFrame) -> DataFrame:
    """(entity, degree): appearances as stripped head or tail; blank ones don't count, a self-loop counts twice."""
    e = df.select(F.explode(F.array(strip(F.col("head")), strip(F.col("tail")))).alias("entity"))
    return e.where(F.coalesce(F.col("entity"), F.lit("")) != "").groupBy("entity").agg(F.count("*").alias("degree"))


def connected(df: DataFrame, least: int = 1) -> DataFrame:
    """Triples of which neither entity has fewer than `least` appearances; one pass, not a k-core."""
    if least <= 1:
        return df
    weak = degrees(df).where(F.col("degree") < least).select("entity")
    out = df
    for c in ("head", "tail"):
        out = out.join(weak.select(F.col("entity").alias("_e")), strip(F.col(c)) == F.col("_e"), "left_anti")
    return out


def degree_summary(df: DataFrame, least: int = 2) -> DataFrame:
    """One row: n_entities, min, max, mean and median degree, entities below `least` and their share in percent."""
    d = degrees(df)
    below = F.count_if(F.col("degree") < least)
    return d.agg(
        F.count("*").alias("n_entities"),
        F.min("degree").alias("min_degree"),
        F.max("degree").alias("max_degree"),
        F.round(F.avg("degree"), 6).alias("mean_degree"),
        F.percentile("degree", F.lit(0.5)).alias("median_degree"),
        below.alias("n_below"),
        F.round(F.when(F.count("*") > 0, below * 100.0 / F.count("*")), 6).alias("percent_below"),
    )


def degree_histogram(df: DataFrame, top: int = 20) -> DataFrame:
    """(degree, n): the `top` most frequent degrees; ties go to the smaller degree."""
    return degrees(df).groupBy("degree").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "degree").limit(top)


def distinct_triples(df: DataFrame, ord_col: str = "ord") -> DataFrame:
    """The first of each (head, type, tail); nulls equal each other and ''.

    The first is found by partial aggregation and joined back on its order, so a triple with many
    copies costs no task more than its own.
    """
    k = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("head", "type", "tail")]
    first = df.select(*k, F.col(ord_col).alias("_o")).groupBy("head", "type", "tail").agg(F.min("_o").alias("_o")).select("_o")
    return df.join(first, df[ord_col] == first["_o"], "left_semi")
