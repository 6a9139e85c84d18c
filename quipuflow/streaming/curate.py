"""Curation of triples as they arrive.

The uniqueness rule is a keyed state: the triple kept for each (head, type), which a later one
replaces only if its confidence is more than the margin higher. Within a micro-batch rows are taken in
the order of `ord`; across batches in order of arrival, as the state can't know what comes later.
What comes out are changes: a row whenever a key's triple is kept or replaced, with the number of its batch in a table
of changes; `kept` gives the state of such a table, each key's latest.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quipuflow.operators.rules import RuleConfig, valid
from quipuflow.sources.files import TRIPLE

_OUT = "head string, type string, tail string, confidence double, ord long"


def triple_stream(spark: SparkSession, path: str, schema: str = TRIPLE + ", ord long") -> DataFrame:
    """Triples of JSONL files as they are put into a folder; broken lines give nulls and are left out."""
    return spark.readStream.schema(schema).json(path).where("head is not null or tail is not null")


def unique_stream(stream: DataFrame, margin: float = 0.05, cfg: RuleConfig | None = None) -> DataFrame:
    """Changes of the kept triples: a row whenever a key's triple is first kept or replaced."""
    src = valid(stream, cfg) if cfg else stream
    src = src.select(F.coalesce("head", F.lit("")).alias("head"), F.coalesce("type", F.lit("")).alias("type"), "tail", F.coalesce("confidence", F.lit(0.0)).alias("confidence"), "ord")

    def keep(key: tuple, frames: Iterator[pd.DataFrame], state: Any) -> Iterator[pd.DataFrame]:
        kept = state.get if state.exists else None
        before = kept
        # frame by frame, of which only rows above all earlier ones of their frame can win
        rising: list[tuple] = []
        for pdf in frames:
            pdf = pdf.sort_values("ord")
            top = pdf["confidence"].cummax().shift(fill_value=-float("inf"))
            won = pdf[(pdf["confidence"] > top) | (pdf["ord"] == pdf["ord"].min())]
            rising += zip(won["ord"].tolist(), won["tail"].tolist(), won["confidence"].tolist())
        for at, tail, conf in sorted(rising, key=lambda r: r[0]):
            if kept is None or conf > kept[1] + margin:
                kept = (tail, float(conf), int(at))
        state.update(kept)
        if kept != before:
            yield pd.DataFrame([(key[0], key[1], *kept)], columns=["head", "type", "tail", "confidence", "ord"])

    return src.groupBy("head", "type").applyInPandasWithState(keep, _OUT, "tail string, confidence double, ord long", "update", "NoTimeout")


def windowed_counts(stream: DataFrame, time_col: str, by: str, width: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Rows per tumbling window and value, with late rows up to the watermark."""
    return stream.withWatermark(time_col, late).groupBy(F.window(time_col, width), by).agg(F.count("*").alias("n"))


def into_table(stream: DataFrame, path: str, checkpoint: str):
    """The changes of each micro-batch as a part of a parquet table, with its number as batch; gives the running query.

    A batch that is repeated after a failure replaces its part.
    """

    def write(df: DataFrame, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    return stream.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write).start()


def kept(changes: DataFrame, keys: tuple[str, ...] = ("head", "type"), version: str = "batch") -> DataFrame:
    """The latest row of each key of a table of changes."""
    rest = [c for c in changes.columns if c not in keys]
    latest = changes.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(version)).alias("_r"))
    return latest.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest if c != version])
