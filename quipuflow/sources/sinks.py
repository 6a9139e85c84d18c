"""Sinks of the pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def csv(df: DataFrame, path: str) -> None:
    """CSV with a header, minimal quoting, doubled quotes, CRLF, nulls as nothing."""
    df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').option("emptyValue", "").option("nullValue", "").option("lineSep", "\r\n").csv(path)


def jsonl(df: DataFrame, path: str, by: str | None = None) -> None:
    w = df.write.mode("overwrite")
    (w.partitionBy(by) if by else w).json(path)


def parquet(df: DataFrame, path: str, by: str | None = None) -> None:
    w = df.write.mode("overwrite")
    (w.partitionBy(by) if by else w).parquet(path)


def categories(pages: DataFrame, path: str) -> None:
    """Distinct category names without their prefix, one a line."""
    from quipuflow.operators.clean import category_name

    pages.select(F.explode("categories").alias("c")).select(category_name(F.col("c")).alias("value")).where("value is not null").distinct().write.mode("overwrite").text(path)


def graph_tables(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) in the layout of bulk graph imports."""
    ends = df.select(F.explode(F.array(F.struct(F.col("head").alias("id"), F.col("head_type").alias("label")), F.struct(F.col("tail").alias("id"), F.col("tail_type").alias("label")))).alias("x")).select("x.*")
    nodes = ends.where("id is not null").groupBy("id").agg(F.min("label").alias("label"))
    edges = df.where("head is not null and tail is not null").select(F.col("head").alias(":START_ID"), F.col("tail").alias(":END_ID"), F.upper(F.regexp_replace("type", r"[^\p{L}\p{N}]+", "_")).alias(":TYPE"), F.col("confidence").alias("confidence:double"))
    return nodes.select(F.col("id").alias(":ID"), F.col("label").alias(":LABEL")), edges


def graph(df: DataFrame, path: str) -> None:
    nodes, edges = graph_tables(df)
    csv(nodes, f"{path}/nodes")
    csv(edges, f"{path}/edges")


def exported(df: DataFrame, kind: str, path: str) -> None:
    """One report as CSV, or the triples as parquet or graph."""
    from quipuflow.operators import reports

    made = {"basic": reports.basic, "extended": reports.extended, "entities": reports.entity_report, "relations": reports.relation_report, "countries": reports.country_report}
    order = {"entities": [F.desc("apariciones_totales"), "_o"], "relations": [F.desc("cantidad"), "_o"]}
    if kind in order:  # ties in the order of first appearance
        csv(made[kind](df, placed=True).orderBy(*order[kind]).drop("_o"), path)
    elif kind in made:
        out = made[kind](df)
        csv(out.orderBy("pais") if kind == "countries" else out, path)
    elif kind == "parquet":
        parquet(df, path)
    elif kind == "graph":
        graph(df, path)
    else:
        raise ValueError(f"unknown format: {kind}")
