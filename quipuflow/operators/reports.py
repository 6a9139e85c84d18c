"""Reports on curated triples, and the predicates of their export.

Ties are resolved by first appearance in the order column. Percentages of an empty input are 0.
Nulls: entities are stripped and blank ones left out; a null relation counts as ''.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from quipuflow.functions.text import country_of, strip


@F.pandas_udf(StringType())
def float_text(x: pd.Series) -> pd.Series:
    """Doubles as Python prints them (0.0001, 1e-05, nan), which the JVM doesn't. A null comes in as NaN."""
    return pd.Series([repr(v) for v in x.tolist()], dtype=object)


def filtered(df: DataFrame, min_confidence: float | None = None, entity_types: list[str] | None = None, relations: list[str] | None = None, countries: list[str] | None = None) -> DataFrame:
    """Conjunction of the predicates given; an empty one is none. NaN has no confidence."""
    if min_confidence:
        c = F.coalesce(F.col("confidence"), F.lit(0.0))
        df = df.where(~F.isnan(c) & (c >= min_confidence))
    if entity_types:
        df = df.where(F.col("head_type").isin(*entity_types) | F.col("tail_type").isin(*entity_types))
    if relations:
        df = df.where(F.col("type").isin(*relations))
    if countries:
        hit: Column = F.lit(False)
        for name in countries:
            for c in ("head", "tail"):
                hit = hit | F.contains(F.lower(F.coalesce(F.col(c), F.lit(""))), F.lit(name.lower()))
        df = df.where(hit)
    return df


def basic(df: DataFrame) -> DataFrame:
    cols = [strip(F.coalesce(F.col(c), F.lit(""))).alias(n) for c, n in (("head", "entidad"), ("type", "relacion"), ("tail", "valor"))]
    return df.select(*cols).where("entidad <> '' and relacion <> '' and valor <> ''")


def extended(df: DataFrame) -> DataFrame:
    """All triples with the eight columns; missing values are '', a confidence that is a double is printed as by Python."""
    names = (("head", "entidad"), ("head_type", "tipo_entidad"), ("type", "relacion"), ("tail", "valor"), ("tail_type", "tipo_valor"), ("confidence", "confianza"), ("source_file", "archivo_fuente"), ("chunk_index", "indice_chunk"))
    real = {c for c, kind in df.dtypes if kind == "double"}
    shown = lambda c: F.when(F.col(c).isNotNull(), float_text(F.col(c))) if c in real else F.col(c).cast("string")
    return df.select(*[F.coalesce(shown(c), F.lit("")).alias(n) for c, n in names])


def entity_report(df: DataFrame, ord_col: str = "ord", placed: bool = False) -> DataFrame:
    """Per entity: first-seen type, appearances as head and as value, distinct relations of either role.

    placed: with _o, where the entity appears first, a head before the tail of its triple.
    """
    rel = F.coalesce(F.col("type"), F.lit(""))
    role = lambda c, t, k: F.struct(strip(F.coalesce(F.col(c), F.lit(""))).alias("e"), F.coalesce(F.col(t), F.lit("")).alias("t"), F.lit(k).alias("k"))
    rows = df.select(F.col(ord_col).alias("o"), rel.alias("rel"), F.explode(F.array(role("head", "head_type", 0), role("tail", "tail_type", 1))).alias("x"))
    rows = rows.select("o", "rel", "x.*").where("e <> ''")
    # a row per entity and relation first, so that a hot entity is partly aggregated before it is shuffled whole
    some = rows.groupBy("e", "rel").agg(F.min(F.struct("o", "k", "t")).alias("first"), F.count_if(F.col("k") == 0).alias("heads"), F.count_if(F.col("k") == 1).alias("tails"))
    out = some.groupBy("e").agg(
        F.min("first").alias("first"),
        F.sum("heads").alias("como_entidad"),
        F.sum("tails").alias("como_valor"),
        F.sum(F.col("heads") + F.col("tails")).alias("apariciones_totales"),
        F.count_if(F.col("heads") > 0).alias("relaciones_unicas_como_entidad"),
        F.count_if(F.col("tails") > 0).alias("relaciones_unicas_como_valor"),
        F.count("*").alias("total_relaciones_unicas"),
    )
    cols = [F.col("e").alias("entidad"), F.col("first.t").alias("tipo"), "como_entidad", "como_valor", "apariciones_totales", "relaciones_unicas_como_entidad", "relaciones_unicas_como_valor", "total_relaciones_unicas"]
    return out.select(*cols, F.struct("first.o", "first.k").alias("_o")) if placed else out.select(*cols)


def relation_report(df: DataFrame, ord_col: str = "ord", placed: bool = False) -> DataFrame:
    """Per relation: count, share of all triples in percent, most common types. Blank relations are left out.

    placed: with _o, where the relation appears first.
    """
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    rows = df.select(F.col(ord_col).alias("o"), strip(text("type")).alias("type"), text("head_type").alias("ht"), text("tail_type").alias("tt"))
    # all counts at once, of sets of columns; then one row per relation, and the total of all from the empty relation up
    sets = [["type", "ht"], ["type", "tt"], ["type", "ht", "tt"], ["type"]]
    some = rows.groupBy("type", "ht", "tt").agg(F.count("*").alias("n"), F.min("o").alias("o"))
    counted = some.groupingSets([[F.col(c) for c in s] for s in sets], "type", "ht", "tt").agg(F.sum("n").alias("n"), F.min("o").alias("o"), F.grouping_id().alias("of"))
    first = F.struct(F.col("n"), (-F.col("o")).alias("o"))
    mode = lambda of, value: F.max_by(F.when(F.col("of") == of, value), F.when(F.col("of") == of, first))
    per = counted.groupBy("type").agg(
        F.max(F.when(F.col("of") == 3, F.col("n"))).alias("cantidad"),
        F.min("o").alias("_o"),
        mode(1, F.col("ht")).alias("tipo_entidad_mas_comun"),
        mode(2, F.col("tt")).alias("tipo_valor_mas_comun"),
        mode(0, F.concat_ws(" -> ", "ht", "tt")).alias("par_tipos_mas_comun"),
    )
    out = per.join(F.broadcast(per.agg(F.sum("cantidad").alias("total")))).where("type <> ''")
    cols = [F.col("type").alias("relacion"), "cantidad", F.bround(F.col("cantidad") * 100.0 / F.col("total"), 2).alias("porcentaje"), "tipo_entidad_mas_comun", "tipo_valor_mas_comun", "par_tipos_mas_comun"]
    return out.select(*cols, "_o") if placed else out.select(*cols)


def country_report(df: DataFrame, ord_col: str = "ord") -> DataFrame:
    """Per country: triples, distinct entities and relations, and the first triple as an example."""
    rows = df.withColumn("pais", country_of(F.col("type"), F.col("head"), F.col("tail"))).where(F.col("pais").isNotNull())
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    rows = rows.select("pais", F.col(ord_col).alias("o"), text("head").alias("h"), text("type").alias("r"), text("tail").alias("t"))
    main = rows.groupBy("pais").agg(F.count("*").alias("cantidad_tripletas"), F.min(F.struct("o", "h", "r", "t")).alias("x"))
    ents = rows.select("pais", F.explode(F.array("h", "t")).alias("e")).where("e <> ''").distinct().groupBy("pais").agg(F.count("*").alias("entidades_unicas"))
    rels = rows.where("r <> ''").select("pais", "r").distinct().groupBy("pais").agg(F.count("*").alias("relaciones_unicas"))
    out = main.join(ents, "pais", "left").join(rels, "pais", "left")
    return out.select(F.initcap("pais").alias("pais"), "cantidad_tripletas", F.coalesce("entidades_unicas", F.lit(0)).alias("entidades_unicas"), F.coalesce("relaciones_unicas", F.lit(0)).alias("relaciones_unicas"), F.col("x.h").alias("entidad_ejemplo"), F.col("x.r").alias("relacion_ejemplo"), F.col("x.t").alias("valor_ejemplo"))


def reason_histogram(explained: DataFrame, top: int = 20, ord_col: str = "ord") -> DataFrame:
    """(reason, n): the `top` reasons; ties by first appearance."""
    r = explained.select(F.col(ord_col).alias("o"), F.explode("reasons").alias("reason"))
    return r.groupBy("reason").agg(F.count("*").alias("n"), F.min("o").alias("o")).orderBy(F.desc("n"), "o").limit(top).select("reason", "n")


def counts_by(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count("*").alias("n"))


def capped(df: DataFrame, by: str, order: list[str], most: int) -> DataFrame:
    """The first `most` rows of each group, where the cap is the feature (pages per category)."""
    w = Window.partitionBy(by).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= most).drop("_n")


def take_while(df: DataFrame, keep: Column, order: str, by: str | None = None) -> DataFrame:
    """Rows before the first that doesn't hold; the first failure is found by aggregation."""
    stop = df.where(~F.coalesce(keep, F.lit(False)))
    if by is None:
        at = stop.agg(F.min(order).alias("_stop"))
        return df.join(F.broadcast(at)).where(F.col("_stop").isNull() | (F.col(order) < F.col("_stop"))).drop("_stop")
    at = stop.groupBy(by).agg(F.min(order).alias("_stop"))
    return df.join(at, by, "left").where(F.col("_stop").isNull() | (F.col(order) < F.col("_stop"))).drop("_stop")
