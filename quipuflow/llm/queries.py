"""Queries of the training-data operators, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quipuflow.llm import boilerplate, encode, leakage, markup, names, repetition, sentences, splitting, structdedup, survivor
from quipuflow.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return sentences.sentences(table(spark, d, "raw_pages"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    items = splitting.items(table(spark, d, "interim_docs"), table(spark, d, "raw_pages"))
    cut = splitting.pieces(items, ["item_table", "item_key", "chunk_index"])
    return cut.where("piece_no = 1 and n_pieces > 1").select("item_table", "item_key", "chunk_index")


def p2_pieces(spark: SparkSession, d: str) -> DataFrame:
    items = splitting.items(table(spark, d, "interim_docs"), table(spark, d, "raw_pages"))
    return splitting.pieces(items, ["item_table", "item_key", "chunk_index"])


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return structdedup.copies(structdedup.all_records(table(spark, d, "triples"), table(spark, d, "triple_lines")))


def p3_records(spark: SparkSession, d: str) -> DataFrame:
    g = structdedup.groups(structdedup.all_records(table(spark, d, "triples"), table(spark, d, "triple_lines")))
    return g.select("first_id", "n_copies")


def p3_pages(spark: SparkSession, d: str) -> DataFrame:
    """Pages that are the same but for formatting in title, content, categories and the nested metadata."""
    return structdedup.tree_groups(table(spark, d, "raw_pages"), ["title", "content", "categories", "metadata"], "page_id")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return survivor.survivors(table(spark, d, "triple_copies"), table(spark, d, "trust_levels"))


def p4_records(spark: SparkSession, d: str) -> DataFrame:
    return survivor.records(table(spark, d, "triple_copies"), table(spark, d, "trust_levels"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return names.variants(table(spark, d, "typed_triples"))


def p5_classes(spark: SparkSession, d: str) -> DataFrame:
    return names.classes(table(spark, d, "typed_triples"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return boilerplate.articles(table(spark, d, "web_pages"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return markup.clean_blocks(table(spark, d, "markup_pages")).select("page_id", "kind", "block_text")


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return encode.token_ids(table(spark, d, "documents"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaks(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p9_edited(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaks(table(spark, d, "documents"), table(spark, d, "eval_items"), edits=1)


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    rules = tuple(r for r in repetition.THRESHOLDS if r.name == "repeated")
    return repetition.judge(table(spark, d, "documents").select("doc_id", "text"), rules, whole=False).where("repeated").select("doc_id")


def p10_profile(spark: SparkSession, d: str) -> DataFrame:
    return repetition.judge(table(spark, d, "documents").select("doc_id", "text")).drop("text")


def queries() -> dict[str, Query]:
    return {k: f for k, f in globals().items() if k[:1] == "p" and k[1:2].isdigit()}


def oracle_sql() -> dict[str, str]:
    from quipuflow.llm import oracles

    return oracles.all_sql()
