import json
import os
import time
from urllib.parse import parse_qs, urlparse

import pytest

from helpers import rows
from quipuflow import cli
from quipuflow.operators import extract
from quipuflow.plans import pipeline
from quipuflow.sources import files, sinks
from quipuflow.sources.wiki import WikiSource
from quipuflow.streaming import curate as stream

LINES = ["", "notjson", "[1,2]", '"str"', '[{"head":"arr"}]', '{"head":"A"}', ' {"head":"B","confidence":0.5} ', '{"head":"cut']


def fake(url):
    """A wiki of 120 titles in a category, for tests."""
    q = {k: v[0] for k, v in parse_qs(urlparse(url).query).items()}
    if q.get("list") == "categorymembers":
        if "rota" in q["cmtitle"]:
            raise OSError("down")
        at = int(q.get("cmcontinue", 0))
        got = [{"title": f"T{i}"} for i in range(at, min(120, at + int(q["cmlimit"])))]
        return {"query": {"categorymembers": got}} | ({"continue": {"cmcontinue": at + len(got)}} if at + len(got) < 120 else {})
    if q.get("list") == "allcategories":
        return {"query": {"allcategories": [{"category": c} for c in ("Chile", "Chile antiguo", "China", "Chile otra vez")]}}
    if q.get("list") == "search":
        return {"query": {"search": [{"title": q["srsearch"].upper()}]}}
    if q.get("action") == "parse":
        return {"parse": {"text": "<p>hola</p>"}}
    if q["titles"] == "Mal":
        raise OSError("down")
    if "clcontinue" in q:
        return {"query": {"pages": [{"title": q["titles"], "categories": [{"title": "Categoría:Y"}]}]}}
    if q["titles"] == "Nada":
        return {"query": {"pages": [{"title": "Nada", "missing": True}]}}
    return {"continue": {"clcontinue": "1"}, "query": {"pages": [{"title": q["titles"], "pageid": 7, "fullurl": "u", "extract": "e", "categories": [{"title": "Categoría:X"}], "revisions": [{"slots": {"main": {"content": "'''w'''"}}}]}]}}


def test_jsonl_lines(spark, tmp_path):
    p = tmp_path / "t"
    p.mkdir()
    (p / "a.jsonl").write_text("\n".join(LINES), encoding="utf-8")
    assert rows(files.read_triples(spark, str(p)), "head", "confidence") == [("A", None), ("B", 0.5)]


def test_wiki_source(spark):
    read = lambda **o: WikiSource(o | {"transport": "test_sources_and_streaming:fake", "pause": "0"}).reader(None)
    every = lambda r: [x for p in r.partitions() for x in r.read(p)]
    members = every(read(mode="members", categories="A|rota|B", limit="70"))
    assert len([r for r in members if r[3] is None]) == 140 and [r for r in members if r[3]] == [("rota", None, None, "OSError: down")]
    assert every(read(mode="search", queries="q")) == [("q", 0, "Q", None)]
    assert every(read(mode="index", prefixes="Chile")) == [("Chile", 0, "Chile", None), ("Chile", 1, "Chile antiguo", None)]
    assert every(read(mode="pages", titles="P|Nada|Mal")) == [("P", 7, "u", "'''w'''", "e", "<p>hola</p>", ["X", "Y"], None), ("Mal", None, None, None, None, None, None, "OSError: down")]
    assert every(read(mode="members")) == []
    with pytest.raises(ValueError):
        read(mode="other")


def test_merge_and_pending(spark):
    a = spark.createDataFrame([("x", "html"), ("y", "html")], "source string, m string")
    b = spark.createDataFrame([("x", "api")], "source string, m string")
    assert rows(files.merged_documents(a, b), "source", "m") == [("x", "api"), ("y", "html")]
    have = spark.createDataFrame([("x", 500), ("y", 10)], "source string, cleaned_length int")
    assert rows(files.pending(a, have, "source"), "source") == [("y",)]


def test_order_key_is_dense(spark):
    df = spark.range(1000).selectExpr("id % 37 as a", "id as b").repartition(7)
    got = rows(files.order_key(df, "a", "b"), "ord", "a", "b")
    want = sorted((r for r in rows(df, "a", "b")))
    assert [g[1:] for g in sorted(got)] == want and sorted(g[0] for g in got) == list(range(1, 1001))


def test_full_pipeline_and_exports(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    raw.mkdir()
    text = "Lima es capital de Perú. " * 8
    (raw / "Lima.html").write_text(f"<html><body><p>{text}</p></body></html>", encoding="utf-8")
    (raw / "Quito.json").write_text(json.dumps({"title": "Quito", "url": "u", "content": text.replace("Lima", "Quito"), "categories": ["c"], "metadata": {"original_length": 9}}), encoding="utf-8")
    (raw / "mala.json").write_text("{", encoding="utf-8")
    counts = dict(rows(pipeline.full(spark, str(raw), out, extract.PatternExtractor())))
    assert counts["interim"] == 2 and counts["canon"] == 2
    before = os.path.getmtime(f"{out}/canon/_SUCCESS")
    pipeline.full(spark, str(raw), out, extract.PatternExtractor())
    assert os.path.getmtime(f"{out}/canon/_SUCCESS") == before
    sinks.jsonl(spark.read.parquet(f"{out}/canon"), f"{out}/lines")
    assert cli.main(["export", "--input", f"{out}/lines", "--output", f"{out}/csv"], spark) == 0
    assert sorted(os.listdir(f"{out}/csv")) == ["basic", "countries", "entities", "extended", "relations"]
    assert cli.main(["filter", "--input", f"{out}/lines", "--output", f"{out}/kept"], spark) == 0
    with pytest.raises(ValueError):
        sinks.exported(spark.read.parquet(f"{out}/canon"), "xml", f"{out}/no")


def test_csv_dialect(spark, tmp_path):
    sinks.csv(spark.createDataFrame([('a "b"', None), ("x,y", "ñ")], "a string, b string").coalesce(1), str(tmp_path / "c"))
    part = next(p for p in (tmp_path / "c").iterdir() if p.name.endswith(".csv"))
    assert part.read_bytes().decode() == 'a,b\r\n"a ""b""",\r\n"x,y",ñ\r\n'


def test_stream_keeps_what_the_batch_keeps(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    confs = [0.5, 0.53, 0.58, 0.2, 0.9]
    for i, c in enumerate(confs):
        (src / f"{i}.json").write_text(json.dumps({"head": "a", "type": "r", "tail": f"t{i}", "confidence": c, "ord": i}), encoding="utf-8")
        os.utime(src / f"{i}.json", (time.time() + i, time.time() + i))
    q = stream.into_table(stream.unique_stream(stream.triple_stream(spark, str(src))), str(tmp_path / "out"), str(tmp_path / "cp"))
    q.processAllAvailable()
    q.stop()
    kept = spark.read.parquet(str(tmp_path / "out")).orderBy("confidence").collect()
    assert kept[-1].tail == "t4"
    assert rows(stream.kept(spark.read.parquet(str(tmp_path / "out"))), "head", "type", "tail", "ord") == [("a", "r", "t4", 4)]


def long_wiki(url):
    """A wiki whose pages have long texts, for the commands."""
    r = fake(url)
    for p in r.get("query", {}).get("pages", []):
        if "revisions" in p:
            p["revisions"] = [{"slots": {"main": {"content": f"'''{p['title']}''' es una ciudad de Perú. " * 12}}}]
    return r


def test_commands(spark, tmp_path, capsys):
    from quipuflow import cli

    env = spark.sparkContext.environment  # so that workers find this module
    env["PYTHONPATH"] = os.pathsep.join((os.path.dirname(os.path.abspath(__file__)), env["PYTHONPATH"]))
    at = lambda x: str(tmp_path / x)
    options = ["--option", "transport=test_sources_and_streaming:long_wiki", "pause=0"]
    cli.main(["scrape-categories", "--from", "Chile", "--output", at("cats"), *options], spark)
    assert sorted(r.value for r in spark.read.text(at("cats")).collect()) == ["Chile", "Chile antiguo"]
    ingest = ["ingest", "--input", at("cats"), "--output", at("pages"), "--limit", "5", *options]
    cli.main(ingest, spark)
    pages = spark.read.parquet(at("pages"))
    assert rows(pages, "title") == [(f"T{i}",) for i in range(5)]
    assert pages.select("metadata.cleaned_length", "metadata.category_source").first()[0] >= 200
    cli.main(ingest, spark)  # nothing is pending
    assert spark.read.parquet(at("pages")).count() == 5
    cli.main(["ingest", "--input", at("cats"), "--output", at("html"), "--method", "html", "--limit", "2", *options], spark)
    assert spark.read.parquet(at("html")).count() == 0  # HTML of under 50 characters
    docs = spark.createDataFrame([("d", ["Lima es capital de Perú. Quito es capital de Ecuador."])], "source string, chunks array<string>")
    docs.write.parquet(at("interim"))
    cli.main(["extract", "--input", at("interim"), "--output", at("triples")], spark)
    assert files.read_triples(spark, at("triples")).count() == 2
    (tmp_path / "triples" / "mala.json").write_text("no\n\n", encoding="utf-8")
    cli.main(["pipeline", "--input", at("triples"), "--output", at("canon")], spark)
    assert files.read_triples(spark, at("canon")).count() == 2
    bad = tmp_path / "bad"
    bad.mkdir()
    (bad / "x.jsonl").write_text('{"head":"A","type":"r","tail":"Lima"}\n[1]\n{"head":"Quito","type":"r","tail":"Lima"}\n', encoding="utf-8")
    capsys.readouterr()
    cli.main(["filter", "--input", at("bad"), "--output", at("kept"), "--explain", "5", "--rejected", at("refused")], spark)
    shown = capsys.readouterr().out
    assert "head_too_short" in shown and "invalid_format" in shown
    assert files.read_triples(spark, at("kept")).count() == 1 and spark.read.json(at("refused")).count() == 1
    with pytest.raises(SystemExit):
        cli.main(["other"], spark)


def test_exports_break_ties_by_first_appearance(spark, tmp_path):
    t = spark.createDataFrame([(1, "Zoe", "per", "z", "Ana", "per", 0.9), (2, "Beto", "per", "b", "Zoe", "per", 0.9), (3, "Ana", "per", "a", "Beto", "per", 0.9)], "ord long, head string, head_type string, type string, tail string, tail_type string, confidence double")
    for kind, col, want in (("entities", "entidad", ["Zoe", "Ana", "Beto"]), ("relations", "relacion", ["z", "b", "a"])):
        sinks.exported(t, kind, str(tmp_path / kind))
        assert [r[col] for r in spark.read.option("header", True).csv(str(tmp_path / kind)).collect()] == want
