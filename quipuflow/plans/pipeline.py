"""The stages of the pipeline, each a function of data frames, and their composition."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quipuflow.functions import text
from quipuflow.functions.text import strip
from quipuflow.operators import clean, curate, extract, reports, resolve, rules, segment
from quipuflow.session import cut
from quipuflow.sources import files, sinks

CHUNK_CHARS = 2048
LEAST_DOCUMENT = 100


def long_enough(df: DataFrame, col: str, least: int = LEAST_DOCUMENT) -> DataFrame:
    return df.where(F.length(strip(F.col(col))) >= least)


def interim(docs: DataFrame, source: str, text_col: str, method: str, budget: int = CHUNK_CHARS, improved: bool = True, extra: dict | None = None) -> DataFrame:
    """Segmented documents; short ones and ones without chunks are left out."""
    df = long_enough(docs, text_col).withColumn("_chunks", segment.segment(F.col(text_col), budget, improved)).where(F.size("_chunks") > 0)
    extra = extra or {}
    meta = F.struct(
        extra.get("original_length", F.length(text_col)).cast("int").alias("original_length"),
        F.length(text_col).cast("int").alias("text_length"),
        F.size("_chunks").alias("num_chunks"),
        F.lit(method).alias("processing_method"),
        extra.get("title", F.lit(None)).cast("string").alias("title"),
        extra.get("categories", F.lit(None)).cast("array<string>").alias("categories"),
        extra.get("url", F.lit(None)).cast("string").alias("url"),
    )
    return df.select(F.col(source).alias("source"), F.col("_chunks").alias("chunks"), meta.alias("metadata"))


def wiki(spark: SparkSession, mode: str, options: dict[str, str], **more: str) -> DataFrame:
    from quipuflow.sources.wiki import WikiSource

    spark.dataSource.register(WikiSource)
    return spark.read.format("wiki").options(mode=mode, **options, **more).load()


def ingest(spark: SparkSession, categories: list[str], out: str, limit: int = 300, method: str = "api", options: dict[str, str] | None = None) -> DataFrame:
    """Pages of categories, at most `limit` of each, that `out` doesn't hold yet, added to it; gives the rows that failed.

    method api: cleaned content of at least 200 characters; html: the page's HTML, of at least 50. The
    titles asked for are listed on the driver; they are as many as the limit of each category allows.
    """
    options = options or {}
    told = cut(wiki(spark, "members", options, categories="|".join(categories), limit=str(limit)))
    wanted = told.where("error is null").groupBy("title").agg(F.min("category").alias("category"))
    if exists(spark, out):
        have = spark.read.parquet(out)
        wanted = files.pending(wanted, have.select("title", F.coalesce(F.col("metadata.cleaned_length") if method == "api" else F.length("html"), F.lit(0)).alias("cleaned_length")), "title", least=200 if method == "api" else 50)
    wanted = cut(wanted)
    pages = cut(wiki(spark, "pages", options, titles="|".join(r.title for r in wanted.select("title").collect())))
    good = pages.where("error is null").join(wanted, "title")
    if method == "html":
        good = good.where(F.length("html") >= 50).select("title", text.safe_filename(F.col("title")).alias("stem"), "html")
    else:
        raw = clean.chosen_content(F.col("wikitext"), F.col("extract"))
        good = good.withColumn("_raw", raw).withColumn("content", clean.clean_extract(F.col("_raw"))).where(F.length("content") >= 200)
        meta = F.struct(
            F.lit("wikipedia_api_clean").alias("source"),
            F.lit(options.get("lang", "es")).alias("language"),
            F.col("category").alias("category_source"),
            F.length("_raw").alias("original_length"),
            F.length("content").alias("cleaned_length"),
            F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss").alias("extraction_date"),
        )
        good = good.select("title", text.file_key(F.col("title")).alias("stem"), "url", "content", "categories", meta.alias("metadata"))
    good.write.mode("append").parquet(out)
    return told.where("error is not null").select(F.col("category").alias("asked"), "error").unionByName(pages.where("error is not null").select(F.col("title").alias("asked"), "error"))


def preprocess(html: DataFrame, api: DataFrame, budget: int = CHUNK_CHARS) -> DataFrame:
    """Interim documents of HTML pages (stem, html) and API pages; of two with one key the API's stays."""
    a = interim(html.withColumn("_text", clean.html_to_text(F.col("html"))), "stem", "_text", "html_parser", budget, extra={"original_length": F.length("html")})
    b = interim(api, "stem", "content", "api_clean", budget, extra={"original_length": F.col("metadata.original_length"), "title": F.col("title"), "categories": F.col("categories"), "url": F.col("url")})
    return files.merged_documents(a, b)


def extracted(docs: DataFrame, model: extract.Extractor) -> DataFrame:
    """Triples of interim documents."""
    return extract.triples(extract.decoded(segment.chunk_rows(docs), model))


@dataclass
class Curated:
    triples: DataFrame
    stats: DataFrame
    reasons: DataFrame


def quality(triples: DataFrame, cfg: rules.RuleConfig = rules.RuleConfig(), relax: float = 1.0, ord_col: str = "ord", fuzzy: bool = True) -> Curated:
    """Validate, resolve entities, normalize, make unique, drop the unconnected and the repeated; with statistics.

    An empty input gives empty results and zero statistics.
    """
    cfg = cfg.relaxed(relax)
    told = rules.explained(triples, cfg)
    ok = cut(told.where(F.size("reasons") == 0).drop("reasons"))
    mapping = cut(resolve.entity_map(ok) if fuzzy else resolve.exact_map(resolve.entities(ok)).where("entity <> representative").select(F.col("entity").alias("original"), "representative"))
    unique = cut(curate.unique_triples(resolve.renamed(ok, mapping), cfg.unique_margin, ord_col))
    linked = curate.connected(unique, cfg.min_connections)
    done = cut(curate.distinct_triples(linked, ord_col))
    n = lambda df, name: df.agg(F.count("*").alias(name))
    stats = n(triples, "initial").join(n(ok, "validated")).join(n(mapping, "entity_mappings")).join(n(unique, "after_uniqueness")).join(n(done, "final"))
    stats = stats.withColumn("reduction_percent", F.when(F.col("initial") > 0, F.round((F.col("initial") - F.col("final")) * 100.0 / F.col("initial"), 2)).otherwise(F.lit(0.0)))
    return Curated(done, stats, reports.reason_histogram(told, ord_col=ord_col))


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a stage's output is complete."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def full(spark: SparkSession, raw: str, out: str, model: extract.Extractor, cfg: rules.RuleConfig = rules.RuleConfig(), relax: float = 1.0) -> DataFrame:
    """All stages over a folder of raw pages; a stage whose output is complete is skipped. Gives counts by stage."""
    if not exists(spark, f"{out}/interim"):
        sinks.parquet(preprocess(files.html_pages(spark, raw), files.api_pages(spark, raw)), f"{out}/interim")
    if not exists(spark, f"{out}/triples"):
        sinks.parquet(extracted(spark.read.parquet(f"{out}/interim"), model), f"{out}/triples")
    if not exists(spark, f"{out}/canon"):
        t = files.order_key(spark.read.parquet(f"{out}/triples"), "source_file", "chunk_index", "triple_index")
        sinks.parquet(quality(t, cfg, relax).triples, f"{out}/canon")
    count = lambda s: spark.read.parquet(f"{out}/{s}").agg(F.lit(s).alias("stage"), F.count("*").alias("n"))
    return count("interim").union(count("triples")).union(count("canon"))
