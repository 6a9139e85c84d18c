"""What the named methods decide by themselves: ablations, held-out accuracy, recall and hard cases."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from helpers import rows
from quipuflow.llm import markup
from quipuflow.llm.crf import Crf

# 7 markup


def _page(rng, n):
    """A page in one of three markups, whose ## lines are headings in Markdown and nested items in wiki text."""
    kind = rng.choice(["md", "wiki", "html"])
    long = lambda: " ".join(rng.choice(["El", "agua", "corre", "lejos", "hoy"]) for _ in range(14)) + "."
    short = lambda: rng.choice(["Historia", "Música", "Ríos"]) + f" {rng.randrange(99)}"
    out = []
    for _ in range(n):
        if kind == "md":
            out += [f"## {short()} ##" if rng.random() < 0.5 else f"## {short()}", f"Un **gran** {long()}", "- a\n- b"]
        elif kind == "wiki":
            out += [f"== {short()} ==", f"Un '''gran''' {long()}", f"# {short()}\n## {short()}\n# {short()}"]
        else:
            out += [f"<h2>{short()}</h2>", f"<p>Un <b>gran</b> {long()}</p>", f"<ol><li>{short()}<li>{short()}</ol>"]
    return "\n\n".join(out)


def test_the_field_decides_where_a_sign_means_two_things():
    rng = random.Random(3)
    model = markup.train([_page(rng, 4) for _ in range(60)])
    # a heading of Markdown inside a page of wiki text: no rule on sign and page tells it from a nested item
    mixed = "Un '''gran''' [[río]] corre.\n\n## Historia ##\n\nOtro '''gran''' [[río]] corre.\n\n# uno\n## dos\n# tres"
    assert markup.leaves(mixed)[1] == "wiki"
    assert [k for k, _ in markup.blocks(mixed, model)] == ["paragraph", "heading", "paragraph", "item", "item", "item"]
    # kinds are told from ancestors, shape and neighbours alone on pages not learnt from
    alone = markup.train([_page(rng, 4) for _ in range(60)], own=False)
    right, every = markup.accuracy_without_tags([_page(rng, 4) for _ in range(30)], alone)
    assert every > 200 and right / every > 0.95


def test_commands_and_tables_of_any_depth():
    deep = "\\emph{" * 9 + "oro" + "}" * 9
    model = Crf(markup.KINDS).fit([[["bias"]]], [["paragraph"]])
    assert markup.blocks(f"\\section{{X}}\n\nEl {deep} y \\textbf{{sal}}.", model)[-1][1] == "El oro y sal."
    assert [t for _, t in markup.blocks("<p>uno</p><table><tr><td>dos</td><td>tres</td></tr></table>", model)] == ["uno", "dos", "tres"]
    ls, _ = markup.leaves("<div><ul><li>a</ul>b</div>\n\nc")
    assert [(x.text, x.path) for x in ls] == [("a", ("div", "ul")), ("b", ("div",)), ("c", ())]
    # a percent sign begins a comment in LaTeX only
    assert markup.blocks("\\section{Uno}\n\nEl \\emph{río} va % nota\ny 5\\% más.", model)[-1][1] == "El río va y 5% más."
    assert markup.blocks("<p>El 5% y breve</p>", model)[0][1] == "El 5% y breve"


def test_crf_without_some_labels():
    """Places without a label get the one that those around them imply."""
    rng = random.Random(1)
    seqs, tags = [], []
    for _ in range(80):
        kind = rng.choice("ab")
        seqs.append([[f"x={kind}"], ["?"], [f"x={kind}"]])
        tags.append([kind, kind if rng.random() < 0.3 else None, kind])
    m = Crf(("a", "b")).fit(seqs, tags)
    assert m.decode([["x=a"], ["?"], ["x=a"]])[1] == "a" and m.decode([["x=b"], ["?"], ["x=b"]])[1] == "b"


def test_the_field_on_whole_pages_differs_from_its_labels_rule(data):
    """On the test tables nearly all leaves are told without their tags, by a field that never saw the pages."""
    import pandas as pd

    pages = [c for c in pd.read_parquet(data.replace("sf0.001", "sf0.01") + "/markup_pages.parquet").content if c and c.strip()]
    half = markup.train(pages[: len(pages) // 2], own=False)
    right, every = markup.accuracy_without_tags(pages[len(pages) // 2 :], half)
    assert right / every > 0.97


# 8 encoding


def _library():
    tokenizers = pytest.importorskip("tokenizers")
    from quipuflow.llm import encode

    try:
        t = tokenizers.Tokenizer.from_file(encode.DEFAULT_PATH)
    except Exception:
        pytest.skip("no tokenizer files here")
    t.encode_special_tokens = True
    return t, encode


def test_words_of_one_hash_keep_their_own_ids():
    """A Thue-Morse word and its complement have one polynomial hash, whatever its base."""
    t, encode = _library()
    morse = "".join("ab"[bin(i).count("1") & 1] for i in range(2048))
    other = morse.translate(str.maketrans("ab", "ba"))
    want = [t.encode(x, add_special_tokens=False).ids for x in (morse, other)]
    assert want[0] != want[1]
    enc = encode.BpeEncoder(encode.read(encode.DEFAULT_PATH))
    for texts in ([morse, other], [other], [morse, "x", other, morse], [other, morse]):  # together, and after one another
        ids, n = encode.encode_batch(texts, enc)
        at = 0
        for x, k in zip(texts, n.tolist()):
            assert ids[at : at + k].tolist() == t.encode(x, add_special_tokens=False).ids
            at += k


def test_a_full_memory_and_other_tokenizers(monkeypatch):
    t, encode = _library()
    monkeypatch.setattr(encode, "REMEMBERED", 3)
    enc = encode.BpeEncoder(encode.read(encode.DEFAULT_PATH))
    for text in ["uno dos tres cuatro cinco", "seis uno", "siete ocho nueve diez once doce", "uno"] * 2:
        assert encode.encode_batch([text], enc)[0].tolist() == t.encode(text, add_special_tokens=False).ids
    with pytest.raises(ValueError):
        encode.BpeEncoder(b'{"model": {"type": "BPE", "vocab": {}, "merges": []}, "pre_tokenizer": {"type": "Whitespace"}}')


# 5 names


def _points(spark, rng):
    base = ["".join(rng.choice("abcde") for _ in range(rng.randint(0, 9))) for _ in range(25)]

    def typo(x):
        i = rng.randint(0, len(x))
        return rng.choice([x[:i] + rng.choice("abc") + x[i:], x[:i] + x[i + 1 :], x[:i] + x[i : i + 2][::-1] + x[i + 2 :]])

    rows_ = {(b, typo(x) if rng.random() < 0.6 else x) for b in "uvw" for x in base for _ in range(3)} | {("solo", "x"), ("leer", "")}
    return spark.createDataFrame(sorted(rows_), "block string, point string").withColumn("key", F.concat_ws("/", "block", "point"))


@pytest.mark.parametrize("cell, pivots", [(2000, 16), (12, 3), (1, 2)])
def test_the_radius_join_is_exact(spark, monkeypatch, cell, pivots):
    """Whatever the cells, all pairs within the radius are found, each once in either direction."""
    from quipuflow.llm import names

    monkeypatch.setattr(names, "CELL", cell)
    monkeypatch.setattr(names, "PIVOTS", pivots)
    points = _points(spark, random.Random(8))

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    all_ = [(r.block, r.point) for r in points.collect()]
    for radius in (1, 2):
        want = sorted((f"{b}/{p}", f"{b}/{q}") for b, p in all_ for c, q in all_ if b == c and p != q and distance(p, q) <= radius)
        assert rows(names.near_pairs(points, radius), "key", "key2") == want and want
    assert 1.0 <= names.replication(points) <= pivots
    assert rows(names.near_pairs(points.limit(0)), "key", "key2") == []


def test_classes_of_names(spark):
    from quipuflow.llm import names

    same = ["Adriana Rotrabel Difagra", "Adriana Rotrabel-Difagra", "adrina rotrabel difagra", "Dra. Adriana Rotrabel Difagra"]
    data = [(n, "per", None, None) for n in [*same, "Benita Rotrabel Difagra"]]
    df = spark.createDataFrame(data * 2, "head string, head_type string, tail string, tail_type string")
    assert rows(names.classes(df)) == sorted([(n, min(same), 4, 3) for n in same] + [("Benita Rotrabel Difagra", "Benita Rotrabel Difagra", 1, 0)])
    assert rows(names.classes(df.limit(0))) == []


def test_second_names_however_rare(spark):
    """A second name is known by the surnames it stands with, however small its share of all names is."""
    from quipuflow.llm import names

    crowd = [f"Ana Zul{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}x Bort{chr(97 + i // 7 % 26)}o" for i in range(400)]
    rare = [f"Luis Abel {x} Paz" for x in ("Riva", "Soto", "Mora")] + ["Juan Abel Vega"]
    df = spark.createDataFrame([(n, ["per"]) for n in crowd + rare], "name string, kinds array<string>")
    got = {r["name"]: (r.a, r.core, r.rest) for r in names.canonical(df).collect()}
    assert got["Juan Abel Vega"] == ("juan abel", "vega", "") and len(got) == len(set(crowd + rare))
    assert {r["name"]: r.a for r in names.canonical(df.where("name not like '%Mora%'")).collect()}["Juan Abel Vega"] == "juan"


def test_an_edit_in_any_part(spark):
    """Names an edit a part apart are linked though they share no part, or an edit is an exchange; names of two parts as well."""
    from quipuflow.llm import names

    sets = [
        ["Adriana Rotrabel Difagra", "Adriana Rotrabl Difgra"],
        ["Benita Mucresi Lotanfe", "Bentia Mucersi Lotnafe"],
        ["Museo Hodrepal de Zipanu", "Museo Hodrpeal de Zpanu"],
        ["Clarisa Podrilan", "Calrisa Podirlan"],
        ["D. Sundrebal Tofrina", "D. Sundrbeal Tofrnia"],
        ["E. Sundrebal Tofrina"],
        ["Gilda Gentrepo Alvunda", "Gilda Gentrepo", "Gidla Gentrepo"],
        ["Gilda Gentrego Marquina", "Gilda Gentrego"],  # fits a whole name, so it is no typo of Gentrepo
        ["Onorio"],
        ["Onoria"],
    ]
    data = [(n, "org" if n[:2] == "Mu" else "per", None, None) for s in sets for n in s]
    df = spark.createDataFrame(data, "head string, head_type string, tail string, tail_type string")
    assert set(rows(names.variants(df))) == {tuple(sorted(p)) for s in sets for p in itertools.combinations(s, 2)}


def test_edges_are_all_pairs_an_edit_a_part(spark):
    """Short parts of few signs, so that most blocks are visited, against brute force."""
    from quipuflow.llm import names

    rng = random.Random(3)
    word = lambda signs, least: "".join(rng.choice(signs) for _ in range(rng.randint(least, 4)))
    keys = sorted({(rng.choice(["per", "org"]), word("abñ中", 1), word("abc", 1), word("abc", 0)) for _ in range(250)})

    def near(t, x, y):
        initials = t == "per" and min(len(x[1]), len(y[1])) == 1 and x[1] != y[1]
        return not initials and all(p == q or min(len(p), len(q)) > 1 and names.distance(p, q, 1) <= 1 for p, q in zip(x[1:], y[1:]))

    df = spark.createDataFrame([("|".join(k), *k, 1) for k in keys], "key string, type string, a string, core string, rest string, cores long")
    want = sorted(("|".join(x), "|".join(y)) for x, y in itertools.permutations(keys, 2) if x[0] == y[0] and near(x[0], x, y))
    assert any(x.split("|")[2] != y.split("|")[2] and x.split("|")[3] != y.split("|")[3] for x, y in want)
    assert rows(names.edges(df)) == want
    assert rows(names.edges(df.limit(0))) == []


# 9 leakage


@pytest.mark.parametrize("edits", [1, 2])
@pytest.mark.parametrize("kind", ["substitution", "insertion", "deletion"])
def test_recall_of_edited_passages(kind, edits):
    """Passages after edits of one kind, amid other words, against brute force."""
    from quipuflow.llm import leakage

    rng = random.Random(4)
    word = lambda: f"w{rng.randrange(10**6)}"
    items = [[word() for _ in range(10)] for _ in range(200)]
    docs = []
    for w in items:
        w = list(w)
        for _ in range(edits):
            at = rng.randrange(1, len(w) - 1)
            w[at : at + (kind != "insertion")] = [] if kind == "deletion" else [word()]
        docs.append([word() for _ in range(5)] + w + [word() for _ in range(5)])
    assert all(min(leakage.edit_distance(d[5 : 5 + n], i, edits) for n in range(10 - edits, 11 + edits)) <= edits for d, i in zip(docs, items))
    found = leakage.ItemIndex(list(range(200)), [" ".join(i) for i in items], 10, edits, 0.99).search([" ".join(d) for d in docs])
    assert {(a, b) for a, b in found if a == b} == found
    assert len(found) >= 0.95 * 200


@pytest.mark.parametrize("edits", [0, 1])
def test_joined_items_give_the_same_leaks(spark, monkeypatch, edits):
    from quipuflow.llm import leakage

    rng = random.Random(9)
    word = lambda: rng.choice(["uno", "dos", "Trés", "cuatro", f"w{rng.randrange(50)}"])
    texts = [" ".join(word() for _ in range(rng.randint(0, 30))) for _ in range(30)]
    docs = [(i, t + " . " + rng.choice(texts)) for i, t in enumerate(texts)] + [(90, None), (91, ""), (0, texts[0])]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    e = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(95, None)], "item_id long, text string")
    whole = rows(leakage.leaks(d, e, window=6, edits=edits, recall=0.999))
    monkeypatch.setattr(leakage, "BLOCK_CHARS", 10)
    monkeypatch.setattr(leakage, "FILTER_BITS", 1 << 10)
    assert rows(leakage.leaks(d, e, window=6, edits=edits, recall=0.999)) == whole and whole
    assert rows(leakage.leaks(d.limit(0), e)) == [] == rows(leakage.leaks(d, e.limit(0)))


def test_an_index_is_that_of_its_own_search(spark):
    """Searches one after another in the same workers don't see each other's items."""
    from quipuflow.llm import leakage

    passages = [" ".join(f"p{k}x{i}" for i in range(12)) for k in range(4)]
    d = spark.createDataFrame(list(enumerate(passages)), "doc_id long, text string").coalesce(1)
    for k, p in enumerate(passages * 3):
        e = spark.createDataFrame([(7, p)], "item_id long, text string")
        assert rows(leakage.leaks(d, e)) == [(k % 4, 7)]


# 3 structural duplicates


def test_nested_records(spark):
    """Fields and map entries have no order, array elements do, at any depth; names and levels count."""
    from quipuflow.llm import structdedup

    kind = "id long, r struct<a:string, b:struct<c:array<string>, d:map<string,string>>>"
    data = [
        (1, ("La Paz", (["x", "Y"], {"k": "v", "l": "w"}))),
        (2, ("la-paz", (["X.", "y"], {"l": "W", "K": "v"}))),  # the same
        (3, ("La Paz", (["Y", "x"], {"k": "v", "l": "w"}))),  # another order
        (4, ("La Paz", (["x", "Y"], {"k": "w", "l": "v"}))),  # other pairs
        (5, ("La Paz", (["xY"], {"k": "v", "l": "w"}))),  # other elements
        (6, ("", (None, None))),
        (7, None),
        (8, (None, ([], {}))),
        (9, ("La Paz", (["x", "Y", None], {"k": "v", "l": "w"}))),
    ]
    df = spark.createDataFrame(data, kind)
    got = rows(structdedup.tree_groups(df, ["r"], "id"), "first_id", "n_copies")
    assert got == [(1, 2), (3, 1), (4, 1), (5, 1), (6, 3), (9, 1)]
    assert rows(structdedup.tree_groups(df.limit(0), ["r"], "id")) == []
    swapped = df.select("id", F.struct(F.col("r.b").alias("b"), F.col("r.a").alias("a")).alias("r"))
    one = lambda x: structdedup.tree(F.col("r"), x.schema["r"].dataType)["d"]
    assert df.select(one(df).alias("d")).collect() == swapped.select(one(swapped).alias("d")).collect()
