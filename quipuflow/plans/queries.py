"""Queries of the core operators over the test tables, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quipuflow.functions import text
from quipuflow.operators import clean, curate, extract, reports, resolve, rules, segment
from quipuflow.plans import pipeline
from quipuflow.sources import files, sinks
from quipuflow.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]

#: Lists for the configured rules; they are parameters, chosen to hit the test tables.
CONFIGURED = rules.RuleConfig(
    min_confidence=0.35,
    generic_entities=("mimbre", "cal", "cobre"),
    filtered_relations=("has part", "instance of"),
    incompatible_pairs=(("loc", "concept"), ("date", "date")),
    self_pairs=(("loc", "loc"),),
    compatibility={"country of citizenship": ("per",), "capital": ("loc",), "spouse": ("per",)},
    temporal_relations=("winner", "participant", "performer"),
    year_patterns=(r"^\d{4}$", r"^\w+ \d{4}$"),
)
STRICT = replace(CONFIGURED, min_confidence=0.5, generic_entities=("mimbre", "cal"))
UNIT = "\u001f"


def triples(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "triples").withColumn("ord", F.col("triple_id"))


def triple_reasons(spark, d):
    return rules.explained(triples(spark, d)).select("triple_id", F.array_join("reasons", ",").alias("reasons"))


def triple_reasons_configured(spark, d):
    return rules.explained(triples(spark, d), CONFIGURED).select("triple_id", F.array_join("reasons", ",").alias("reasons"))


def reason_histogram(spark, d):
    return reports.reason_histogram(rules.explained(triples(spark, d), CONFIGURED))


def strict_valid(spark, d):
    return triples(spark, d).where(rules.strict_valid(STRICT)).select("triple_id")


def normalized_entities(spark, d):
    return resolve.entities(triples(spark, d)).select("entity", text.normalize_entity(F.col("entity")).alias("norm"))


def exact_entity_map(spark, d):
    return resolve.exact_map(resolve.entities(triples(spark, d))).select("entity", "representative")


def entity_resolution(spark, d):
    """Exact and similar names together; not expressible in SQL."""
    return resolve.entity_map(triples(spark, d))


def unique_triples(spark, d):
    return curate.unique_triples(triples(spark, d)).select("triple_id", "first_ord")


def unique_events(spark, d):
    """The margin fold where one key has many rows of nearly equal confidence."""
    e = table(spark, d, "events").select(F.col("event_id").alias("ord"), F.concat(F.lit("User "), (F.col("user_id") % 7).cast("string")).alias("head"), F.col("event_type").alias("type"), (F.floor("value").cast("double") / 500).alias("confidence"))
    return curate.unique_triples(e).select("ord", "first_ord")


def entity_degree(spark, d):
    return curate.degrees(triples(spark, d))


def degree_summary(spark, d):
    return curate.degree_summary(triples(spark, d))


def degree_histogram(spark, d):
    return curate.degree_histogram(triples(spark, d))


def connected_triples(spark, d):
    return curate.connected(triples(spark, d), 3).select("triple_id")


def distinct_triples(spark, d):
    return curate.distinct_triples(triples(spark, d)).select("triple_id")


def entity_report(spark, d):
    return reports.entity_report(triples(spark, d))


def relation_report(spark, d):
    return reports.relation_report(triples(spark, d))


def country_report(spark, d):
    return reports.country_report(triples(spark, d))


def export_basic(spark, d):
    return reports.basic(triples(spark, d))


def export_extended(spark, d):
    """All eight columns of all triples."""
    return reports.extended(triples(spark, d))


def export_filtered(spark, d):
    df = reports.filtered(triples(spark, d), 0.6, ["per", "org"], ["country", "spouse", "capital", "country of citizenship"], ["México", "perú", "Chile", "cuba"])
    return df.select("triple_id")


def source_counts(spark, d):
    return reports.counts_by(triples(spark, d), "source_file")


def category_counts(spark, d):
    p = table(spark, d, "raw_pages").select(F.explode("categories").alias("c"))
    return reports.counts_by(p.select(clean.category_name(F.col("c")).alias("category")), "category")


def graph_nodes(spark, d):
    return sinks.graph_tables(triples(spark, d))[0].select(F.col("`:ID`").alias("id"), F.col("`:LABEL`").alias("label"))


def quality_pipeline(spark, d):
    """The curated triples of the whole pipeline; not expressible in SQL."""
    return pipeline.quality(triples(spark, d)).triples.select("triple_id", "head", "type", "tail")


def quality_triples(spark, d):
    """The same with exact names only."""
    return pipeline.quality(triples(spark, d), fuzzy=False).triples.select("triple_id", "head", "type", "tail")


def quality_stats(spark, d):
    return pipeline.quality(triples(spark, d), fuzzy=False).stats


def iso_dates(spark, d):
    t = table(spark, d, "raw_pages").select("page_id", "content")
    return t.select("page_id", text.iso_date(F.col("content")).alias("iso"))


def file_names(spark, d):
    return table(spark, d, "raw_pages").select("page_id", text.safe_filename(F.col("url")).alias("name"), text.file_key(F.col("title")).alias("key"))


def clean_pages(spark, d):
    return table(spark, d, "raw_pages").select("page_id", clean.clean_text(F.col("content")).alias("text"))


def clean_extracts(spark, d):
    return table(spark, d, "raw_pages").select("page_id", clean.clean_extract(F.col("content")).alias("text"))


def wikitext_plain(spark, d):
    return table(spark, d, "markup_pages").select("page_id", clean.wikitext_plain(F.col("content")).alias("text"))


def page_text(spark, d):
    """Main text of HTML; a tree walk, so not expressible in SQL."""
    return table(spark, d, "markup_pages").select("page_id", clean.html_to_text(F.col("content")).alias("text"), clean.paragraph_text(F.col("content")).alias("paragraphs"))


def sentences(spark, d):
    s = segment.sentence_array(F.col("text"))
    return table(spark, d, "documents").select("doc_id", F.posexplode(s).alias("n", "sentence"))


def chunks(spark, d):
    c = segment.chunk_array(F.col("text"), 2048)
    return table(spark, d, "documents").select("doc_id", F.posexplode(c).alias("chunk_index", "chunk"))


def simple_chunks(spark, d):
    c = segment.simple_chunk_array(F.col("text"), 600)
    return table(spark, d, "documents").select("doc_id", F.posexplode(c).alias("chunk_index", "chunk"))


def interim_chunks(spark, d):
    return segment.chunk_rows(table(spark, d, "interim_docs"))


def long_documents(spark, d):
    return pipeline.long_enough(table(spark, d, "documents"), "text").select("doc_id")


def pending_pages(spark, d):
    """Pages of the raw table that no valid segmented document has yet; one without a title has none."""
    have = table(spark, d, "interim_docs").select(F.col("metadata.title").alias("title"), F.col("metadata.text_length").alias("cleaned_length"))
    return files.pending(table(spark, d, "raw_pages").select("page_id", "title"), have, "title").select("page_id")


def parsed_lines(spark, d):
    return files.triple_lines(table(spark, d, "triple_lines")).select("line_id", "head", "type", "tail")


def parsed_triples(spark, d):
    """Only the rows that come back as they were, as its SQL states; parsed_triples_whole has all."""
    return _reparsed(_clean(triples(spark, d)))


def parsed_triples_whole(spark, d):
    """Every triple linearized and parsed again, which gives none, one or more; SQL has no parser."""
    return _reparsed(triples(spark, d))


def _reparsed(t: DataFrame) -> DataFrame:
    field = lambda c: F.coalesce(F.col(c), F.lit(""))
    line = F.concat(F.lit("tp_XX<triplet> "), field("head"), F.lit(" <"), field("head_type"), F.lit("> "), field("tail"), F.lit(" <"), field("tail_type"), F.lit("> "), field("type"), F.lit("</s>"))
    return t.select("triple_id", F.explode(extract.parsed(line)).alias("t")).select("triple_id", "t.*")


def _clean(t: DataFrame) -> DataFrame:
    word = r"^[\p{L}\p{N}.,-]+( [\p{L}\p{N}.,-]+)*$"
    ok = F.lit(True)
    for c in ("head", "type", "tail"):
        ok = ok & F.coalesce(F.col(c).rlike(word), F.lit(False))
    for c in ("head_type", "tail_type"):
        ok = ok & F.coalesce(F.col(c).rlike("^[a-z]+$"), F.lit(False))
    return t.where(ok)


def take_while(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("k"), "c_nationkey", "c_mktsegment")
    return reports.take_while(c, F.col("c_mktsegment") != "BUILDING", "k", "c_nationkey").select("k")


def capped_per_group(spark, d):
    return reports.capped(table(spark, d, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"], 3).select("o_orderkey")


def merged_sources(spark, d):
    html = table(spark, d, "web_pages").where("title is not null").groupBy(F.col("title").alias("source")).agg(F.min("page_id").alias("page_id")).withColumn("origin", F.lit("html"))
    api = table(spark, d, "interim_docs").where("metadata.title is not null").select(F.col("metadata.title").alias("source")).distinct().withColumn("origin", F.lit("api"))
    return files.merged_documents(html, api).select("source", "origin")


def similar_tokens(spark, d):
    """Pairs of names similar enough by their tokens to be compared in full."""
    pairs = resolve.candidates(resolve.entities(triples(spark, d)))[1]
    return pairs.select("na", "nb", F.round("jaccard", 6).alias("jaccard"))


def similar_tokens_window(spark, d):
    """The same among the neighbours that the original compares."""
    pairs = resolve.candidates(resolve.entities(triples(spark, d)), window=resolve.WINDOW)[1]
    return pairs.select("na", "nb", F.round("jaccard", 6).alias("jaccard"))


def chosen_content(spark, d):
    """Wiki text where enough is left of it, else the extract."""
    m = table(spark, d, "markup_pages").select("page_id", F.col("content").alias("wikitext"))
    r = table(spark, d, "raw_pages").select("page_id", F.col("content").alias("extract"))
    return m.join(r, "page_id", "left").select("page_id", clean.chosen_content(F.col("wikitext"), F.col("extract")).alias("text"))


def interim_documents(spark, d):
    docs = table(spark, d, "documents").withColumn("source", F.col("doc_id").cast("string"))
    return pipeline.interim(docs, "source", "text", "api_clean").select("source", F.col("metadata.num_chunks").alias("num_chunks"), F.col("metadata.text_length").alias("text_length"))


def chunk_previews(spark, d):
    return segment.chunk_rows(table(spark, d, "interim_docs")).select("source_file", "chunk_index", text.preview(F.col("chunk")).alias("shown"))


def relation_percent(spark, d):
    n = reports.counts_by(triples(spark, d).where("type is not null"), "type")
    return n.join(F.broadcast(n.agg(F.sum("n").alias("total")))).select("type", text.percent(F.col("n"), F.col("total")).alias("share"))


def quoted_titles(spark, d):
    return table(spark, d, "raw_pages").select("page_id", text.url_quote(F.col("title")).alias("quoted"))


def relaxed_reasons(spark, d):
    """The same rules with thresholds halved."""
    return rules.explained(triples(spark, d), CONFIGURED.relaxed(2.0)).select("triple_id", F.array_join("reasons", ",").alias("reasons"))


def queries() -> dict[str, Query]:
    fs = (
        triple_reasons, triple_reasons_configured, reason_histogram, strict_valid, normalized_entities, exact_entity_map, entity_resolution, unique_triples, unique_events,
        entity_degree, degree_summary, degree_histogram, connected_triples, distinct_triples, entity_report, relation_report, country_report, export_basic, export_extended,
        export_filtered, source_counts, category_counts, graph_nodes, quality_pipeline, quality_triples, quality_stats, iso_dates, file_names, clean_pages, clean_extracts, wikitext_plain,
        page_text, sentences, chunks, simple_chunks, interim_chunks, long_documents, pending_pages, parsed_lines, parsed_triples, parsed_triples_whole, take_while, capped_per_group, merged_sources,
        similar_tokens, similar_tokens_window, chosen_content, interim_documents, chunk_previews, relation_percent, quoted_titles, relaxed_reasons,
    )
    return {f.__name__: f for f in fs}


def oracle_sql() -> dict[str, str]:
    from quipuflow.plans import oracles

    return oracles.all_sql()
