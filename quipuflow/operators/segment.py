"""Sentences and chunks of cleaned text, as column expressions.

Null and blank texts have no sentences and no chunks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipuflow.functions.text import WORD, WS, strip

#: Abbreviations after which no sentence ends.
ABBREVIATIONS = ("Sr", "Sra", "Dr", "Dra", "Prof", "Lic", "Ing", "Arq", "etc", "vs", r"p\.ej", "cf", "art", "núm", "pág", "vol", "ed", "coord", "dir")
LEAST_CHUNK = 50


def sentence_array(c: Column) -> Column:
    """Sentences: cut after . ! ? before white space, not after an abbreviation."""
    # the cheap test first, as it is made at every sign
    pattern = rf"(?iu)(?<=[.!?])(?<!(?<!{WORD})(?:{'|'.join(ABBREVIATIONS)})\.){WS}"
    return F.filter(F.transform(F.split(strip(c), pattern), strip), lambda s: s != "")


def _packed(parts: Column, state: Column, budget: int) -> Column:
    """Parts packed greedily; lengths count without the blanks between."""
    return F.aggregate(
        parts,
        state,
        lambda s, x: F.when(
            (s["n"] == 0) | (s["n"] + F.length(x) <= budget),
            F.struct(s["done"].alias("done"), F.when(s["cur"] == "", x).otherwise(F.concat_ws(" ", s["cur"], x)).alias("cur"), (s["n"] + F.length(x)).alias("n")),
        ).otherwise(F.struct(F.array_append(s["done"], s["cur"]).alias("done"), x.alias("cur"), F.length(x).alias("n"))),
    )


def chunk_array(c: Column, budget: int = 1800, least: int = LEAST_CHUNK) -> Column:
    """Sentences packed into chunks of at most `budget` characters.

    A longer sentence is flushed as its own chunks of parts between commas and semicolons, which are
    lost; a part without them stays whole. Chunks of fewer than `least` characters are dropped.
    """
    empty = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("cur"), F.lit(0).alias("n"))
    flush = lambda s: F.when(s["cur"] == "", s["done"]).otherwise(F.array_append(s["done"], s["cur"]))

    def step(s: Column, x: Column) -> Column:
        parts = F.filter(F.transform(F.split(x, "[,;]"), strip), lambda p: p != "")
        fresh = F.struct(flush(s).alias("done"), F.lit("").alias("cur"), F.lit(0).alias("n"))
        long = _packed(parts, fresh, budget)
        closed = F.struct(flush(long).alias("done"), F.lit("").alias("cur"), F.lit(0).alias("n"))
        fits = F.struct(s["done"].alias("done"), F.when(s["cur"] == "", x).otherwise(F.concat_ws(" ", s["cur"], x)).alias("cur"), (s["n"] + F.length(x)).alias("n"))
        opens = F.struct(flush(s).alias("done"), x.alias("cur"), F.length(x).alias("n"))
        return F.when(F.length(x) > budget, closed).when(s["n"] + F.length(x) <= budget, fits).otherwise(opens)

    chunks = F.aggregate(sentence_array(c), empty, step, flush)
    return F.filter(chunks, lambda x: F.length(strip(x)) >= least)


def simple_chunk_array(c: Column, budget: int = 1800) -> Column:
    """The simple segmenter: every ? and . ends a sentence, which gets a period again; greedy packing.

    As the original does, it gives an empty first chunk if the first sentence is over the budget.
    """
    t = F.replace(F.replace(c, F.lit("?!"), F.lit(".")), F.lit("?"), F.lit("."))
    sents = F.transform(F.filter(F.transform(F.split(t, r"\."), strip), lambda x: x != ""), lambda x: F.concat(x, F.lit(".")))
    none = F.lit(None).cast("string")
    empty = F.struct(F.array().cast("array<string>").alias("done"), none.alias("cur"), F.lit(0).alias("n"))
    out = F.aggregate(
        sents,
        empty,
        lambda s, x: F.when(
            s["n"] + F.length(x) <= budget, F.struct(s["done"].alias("done"), F.concat_ws(" ", s["cur"], x).alias("cur"), (s["n"] + F.length(x)).alias("n"))
        ).otherwise(F.struct(F.array_append(s["done"], F.coalesce(s["cur"], F.lit(""))).alias("done"), x.alias("cur"), F.length(x).alias("n"))),
        lambda s: F.when(s["cur"].isNull(), s["done"]).otherwise(F.array_append(s["done"], s["cur"])),
    )
    return F.when(strip(c) != "", out).otherwise(F.array().cast("array<string>"))


def segment(c: Column, budget: int = 1800, improved: bool = True) -> Column:
    return chunk_array(c, budget) if improved else simple_chunk_array(c, budget)


def chunk_rows(docs: DataFrame, chunks: str = "chunks", source: str = "source") -> DataFrame:
    """(source_file, chunk_index, chunk); blank chunks are left out, their index isn't used again."""
    rows = docs.select(F.col(source).alias("source_file"), F.posexplode(chunks).alias("chunk_index", "chunk"))
    return rows.where(strip(F.coalesce(F.col("chunk"), F.lit(""))) != "")
