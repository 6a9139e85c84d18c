"""Commands: scrape-categories, ingest, preprocess, extract, quality, pipeline, full-pipeline, filter, export.

    python -m quipuflow.cli quality --input triples/ --output canon/
"""

from __future__ import annotations

import argparse
import importlib

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="quipuflow")
    sub = p.add_subparsers(dest="command", required=True)
    made = {}
    for name in ("scrape-categories", "ingest", "preprocess", "extract", "quality", "pipeline", "full-pipeline", "filter", "export"):
        s = made[name] = sub.add_parser(name)
        s.add_argument("--input", required=name != "scrape-categories")
        s.add_argument("--output", required=True)
        s.add_argument("--config")
    for name in ("quality", "pipeline", "full-pipeline", "filter"):
        made[name].add_argument("--relax", type=float, default=1.0)
    for name in ("extract", "full-pipeline"):
        made[name].add_argument("--model", default="quipuflow.operators.extract:PatternExtractor", help="module:factory of an extractor")
    for name in ("scrape-categories", "ingest"):
        made[name].add_argument("--option", nargs="*", default=[], help="name=value for the wiki source")
    made["scrape-categories"].add_argument("--from", dest="prefixes", nargs="+", required=True)
    made["ingest"].add_argument("--limit", type=int, default=300)
    made["ingest"].add_argument("--method", choices=("api", "html"), default="api")
    made["filter"].add_argument("--explain", type=int, default=0, metavar="N", help="show N rejected triples with their reasons")
    made["filter"].add_argument("--rejected", help="write all rejected triples with their reasons")
    e = made["export"]
    e.add_argument("--format", default="all")
    e.add_argument("--min-confidence", type=float)
    for name in ("--entity-types", "--relations", "--countries"):
        e.add_argument(name, nargs="*")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    from quipuflow.operators import reports, rules
    from quipuflow.plans import pipeline
    from quipuflow.sources import files, sinks

    a = _parser().parse_args(argv)
    if spark is None:
        from quipuflow.session import local_session

        spark = local_session()
    cfg = rules.RuleConfig.from_yaml(a.config) if a.config else rules.RuleConfig()
    options = dict(x.split("=", 1) for x in getattr(a, "option", []))

    def model():
        module, _, name = a.model.partition(":")
        return getattr(importlib.import_module(module), name)()

    if a.command == "scrape-categories":
        found = pipeline.wiki(spark, "index", options, prefixes="|".join(a.prefixes)).where("error is null")
        sinks.categories(found.select(F.array("title").alias("categories")), a.output)
        return 0
    if a.command == "ingest":
        names = [r.name for r in files.categories(spark, a.input).collect()]
        pipeline.ingest(spark, names, a.output, a.limit, a.method, options).show(truncate=False)
        return 0
    if a.command == "preprocess":
        sinks.parquet(pipeline.preprocess(files.html_pages(spark, a.input), files.api_pages(spark, a.input)), a.output)
        return 0
    if a.command == "extract":
        sinks.jsonl(pipeline.extracted(spark.read.parquet(a.input), model()), a.output)
        return 0
    if a.command == "full-pipeline":
        pipeline.full(spark, a.input, a.output, model(), cfg, a.relax).show(truncate=False)
        return 0
    triples = files.order_key(files.read_triples(spark, a.input), "source_file", "chunk_index", "head", "type", "tail", "confidence")
    if a.command in ("quality", "pipeline"):
        done = pipeline.quality(triples, cfg, a.relax)
        sinks.jsonl(done.triples.drop("ord", "first_ord"), a.output)
        done.stats.show(truncate=False)
        done.reasons.unionByName(files.invalid_lines(spark, a.input)).show(truncate=False)
    elif a.command == "filter":
        told = rules.explained(triples, cfg.relaxed(a.relax))
        sinks.jsonl(told.where("size(reasons) = 0").drop("reasons", "ord"), a.output)
        refused = told.where("size(reasons) > 0")
        if a.rejected:
            sinks.jsonl(refused.drop("ord"), a.rejected)
        if a.explain:
            refused.orderBy("ord").select("head", "type", "tail", "confidence", "reasons").show(a.explain, truncate=False)
        reports.reason_histogram(told).unionByName(files.invalid_lines(spark, a.input)).show(truncate=False)
    else:
        df = reports.filtered(triples, a.min_confidence, a.entity_types, a.relations, a.countries)
        kinds = ["basic", "extended", "entities", "relations", "countries"] if a.format == "all" else [a.format]
        for kind in kinds:
            sinks.exported(df, kind, f"{a.output}/{kind}")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
