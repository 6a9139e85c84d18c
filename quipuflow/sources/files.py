"""Files of the pipeline's stages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quipuflow.functions.text import strip

METADATA = "struct<source:string,language:string,category_source:string,original_length:int,cleaned_length:int,extraction_date:string>"
PAGE = f"title string, url string, content string, categories array<string>, metadata {METADATA}"
INTERIM = "source string, chunks array<string>, metadata struct<original_length:int,text_length:int,num_chunks:int,processing_method:string,title:string,categories:array<string>,url:string>"
TRIPLE = "head string, head_type string, type string, tail string, tail_type string, confidence double, source_file string, chunk_index int, chunk_text string"


def categories(spark: SparkSession, path: str) -> DataFrame:
    """(name) of a list of categories, one a line; blank lines are left out."""
    return spark.read.text(path).select(strip(F.col("value")).alias("name")).where("name <> ''")


def html_pages(spark: SparkSession, path: str) -> DataFrame:
    """(stem, html) of the *.html files of a folder."""
    df = spark.read.text(path, wholetext=True, pathGlobFilter="*.html").select("value", F.col("_metadata.file_name").alias("f"))
    return df.select(F.regexp_replace(F.url_decode("f"), r"\.html$", "").alias("stem"), F.col("value").alias("html"))


def api_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages of *.json files, one object each; broken files are left out."""
    df = spark.read.schema(PAGE + ", _corrupt string").json(path, multiLine=True, mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt", pathGlobFilter="*.json")
    df = df.withColumn("stem", F.regexp_replace(F.url_decode("_metadata.file_name"), r"\.json$", ""))
    return df.where("_corrupt is null").drop("_corrupt")


def interim_docs(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.schema(INTERIM + ", _corrupt string").json(path, multiLine=True, mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt", pathGlobFilter="*.json")
    return df.where("_corrupt is null").drop("_corrupt")


def parse_lines(line: Column, schema: str = TRIPLE) -> Column:
    """Struct of a line that is a JSON object, else null; the reader alone would take lists apart."""
    s = strip(line)
    return F.when(s.startswith("{"), F.from_json(s, schema + ", _corrupt string", {"columnNameOfCorruptRecord": "_corrupt"}))


def triple_lines(lines: DataFrame, col: str = "line", schema: str = TRIPLE) -> DataFrame:
    """lines with the fields of their triples; blank, broken and other lines are left out."""
    keep = [F.col(c) for c in lines.columns if c != col]
    df = lines.select(*keep, parse_lines(F.col(col), schema).alias("_t")).where("_t is not null and _t._corrupt is null")
    have = set(lines.columns)
    return df.select(*[c for c in df.columns if c != "_t"], *[F.col(f"_t.{f.split()[0]}").alias(f.split()[0]) for f in schema.split(", ") if f.split()[0] not in have])


def invalid_lines(spark: SparkSession, path: str) -> DataFrame:
    """(reason, n): how many lines that aren't blank are no JSON object."""
    lines = spark.read.text(path).where(strip(F.col("value")) != "").select(parse_lines(F.col("value")).alias("t"))
    return lines.agg(F.count_if(F.col("t").isNull() | F.col("t._corrupt").isNotNull()).alias("n")).select(F.lit("invalid_format").alias("reason"), "n")


def read_triples(spark: SparkSession, path: str) -> DataFrame:
    """Triples of the JSONL files of a path."""
    return triple_lines(spark.read.text(path).withColumnRenamed("value", "line"))


def merged_documents(html: DataFrame, api: DataFrame, key: str = "source") -> DataFrame:
    """Both sets of documents; of two with one key the API's stays."""
    both = html.withColumn("_p", F.lit(1)).unionByName(api.withColumn("_p", F.lit(0)), allowMissingColumns=True)
    best = both.groupBy(key).agg(F.min("_p").alias("_best"))
    both = both.join(best, key).where("_p = _best").drop("_best", "_p")
    return both.dropDuplicates([key])


def pending(wanted: DataFrame, existing: DataFrame, key: str, length_col: str = "cleaned_length", least: int = 200) -> DataFrame:
    """Rows of wanted that have no valid counterpart yet."""
    return wanted.join(existing.where(F.col(length_col) >= least).select(key), key, "left_anti")


def order_key(df: DataFrame, *cols: str, name: str = "ord") -> DataFrame:
    """df with a dense integer order over cols, counted per range partition; no group goes to one task."""
    from quipuflow.operators.resolve import ranked

    return ranked(df.withColumn("_all", F.lit(0)), ["_all"], list(cols)).withColumnRenamed("pos", name).drop("_all")


