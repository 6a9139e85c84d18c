"""A Spark data source over a MediaWiki action API.

    spark.dataSource.register(WikiSource)
    spark.read.format("wiki").option("mode", "members").option("categories", "A|B").load()

mode members: titles of a category, with continuation; search: titles of a full-text search; index: the
categories of the alphabetical index from a name on, as long as they contain it; pages: wiki text, extract, HTML and categories of titles. A partition is one category, query or
block of titles. A failed request doesn't stop the others: it gives a row whose error says what
failed, with what was asked for and nulls else; rows read have a null error. Continuations are followed, those of a
page's categories too.

The transport is a function of a URL that gives the decoded JSON; option transport names it as
module:function, so that tests and other clients need no network.
"""

from __future__ import annotations

import importlib
import itertools
import json
import time
from collections.abc import Callable, Iterator
from urllib.parse import urlencode

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

PAUSE_S = 0.2
SCHEMAS = {
    "members": "category string, position int, title string, error string",
    "index": "prefix string, position int, title string, error string",
    "search": "query string, position int, title string, error string",
    "pages": "title string, pageid long, url string, wikitext string, extract string, html string, categories array<string>, error string",
}


def http(url: str) -> dict:
    from urllib.request import Request, urlopen

    with urlopen(Request(url, headers={"User-Agent": "quipuflow/1.0"}), timeout=30) as r:
        return json.loads(r.read().decode("utf-8"))


class Part(InputPartition):
    def __init__(self, values: list[str]):
        self.values = values


class WikiSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "wiki"

    def schema(self) -> str:
        return SCHEMAS[self.options.get("mode", "members")]

    def reader(self, schema) -> DataSourceReader:
        return WikiReader(dict(self.options))


class WikiReader(DataSourceReader):
    def __init__(self, options: dict):
        self.mode = options.get("mode", "members")
        if self.mode not in SCHEMAS:
            raise ValueError(f"unknown mode: {self.mode}")
        self.api = options.get("api", f"https://{options.get('lang', 'es')}.wikipedia.org/w/api.php")
        self.limit = int(options.get("limit", "500"))
        self.pause = float(options.get("pause", str(PAUSE_S)))
        self.plain = options.get("extract", "text") != "html"  # whether extracts come as text
        self.transport = options.get("transport", "quipuflow.sources.wiki:http")
        key = {"members": "categories", "index": "prefixes", "search": "queries", "pages": "titles"}[self.mode]
        self.values = [v for v in options.get(key, "").split("|") if v.strip()]

    def partitions(self) -> list[Part]:
        size = 50 if self.mode == "pages" else 1
        return [Part(self.values[i : i + size]) for i in range(0, len(self.values), size)] or [Part([])]

    def _get(self) -> Callable[[str], dict]:
        module, _, name = self.transport.partition(":")
        return getattr(importlib.import_module(module), name)

    def _ask(self, **params) -> dict:
        return self._get()(self.api + "?" + urlencode({"action": "query", "format": "json", "formatversion": "2", **params}))

    def _titles(self, value: str) -> Iterator[str]:
        token: dict = {}
        left = self.limit
        while left > 0:
            n = min(50, left)
            if self.mode == "members":
                name = value if ":" in value else f"Categoría:{value}"
                r = self._ask(list="categorymembers", cmtitle=name, cmnamespace=0, cmlimit=n, **token)
                found = r.get("query", {}).get("categorymembers", [])
            elif self.mode == "index":
                r = self._ask(list="allcategories", acfrom=value, aclimit=n, **token)
                every = [{"title": x["category"]} for x in r.get("query", {}).get("allcategories", [])]
                found = list(itertools.takewhile(lambda x: value.lower() in x["title"].lower(), every))
                if len(found) < len(every):
                    r.pop("continue", None)
            else:
                r = self._ask(list="search", srsearch=value, srnamespace=0, srlimit=n, **token)
                found = r.get("query", {}).get("search", [])
            for x in found[:left]:
                yield x["title"]
            left -= len(found)
            token = r.get("continue", {})
            if not token or not found:
                return
            time.sleep(self.pause)

    def read(self, partition: Part):
        for value in partition.values:
            try:
                if self.mode == "pages":
                    yield from self._page(value)
                else:
                    for i, t in enumerate(self._titles(value)):
                        yield (value, i, t, None)
            except Exception as e:
                why = f"{type(e).__name__}: {e}"
                yield (value, *[None] * 6, why) if self.mode == "pages" else (value, None, None, why)

    def _page(self, title: str):
        asked = {"titles": title, "prop": "revisions|extracts|categories|info", "rvprop": "content", "rvslots": "main", "inprop": "url", "cllimit": "max"} | ({"explaintext": 1} if self.plain else {})
        r = self._ask(**asked)
        more, further = [], r
        while further.get("continue", {}).get("clcontinue"):
            time.sleep(self.pause)
            further = self._ask(titles=title, prop="categories", cllimit="max", **further["continue"])
            more += [c for p in further.get("query", {}).get("pages", []) for c in p.get("categories", [])]
        for p in r.get("query", {}).get("pages", []):
            if p.get("missing"):
                continue
            rev = (p.get("revisions") or [{}])[0]
            text = rev.get("slots", {}).get("main", {}).get("content") or rev.get("content") or ""
            html, why = "", None
            try:
                got = self._get()(self.api + "?" + urlencode({"action": "parse", "format": "json", "formatversion": "2", "prop": "text", "page": title}))
                html = got.get("parse", {}).get("text", "")
            except Exception as e:
                why = f"{type(e).__name__}: {e}"
            cats = [c["title"].replace("Categoría:", "") for c in [*p.get("categories", []), *more]]
            yield (p.get("title", title), p.get("pageid"), p.get("fullurl", ""), text, p.get("extract", ""), html, cats, why)
