import re
import unicodedata

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import rows
from quipuflow.functions import text
from quipuflow.operators import rules, segment

SCHEMA = "head string, head_type string, type string, tail string, tail_type string, confidence double"


def one(spark, value, expr):
    return spark.createDataFrame([(value,)], "x string").select(expr(F.col("x")).alias("y")).first().y


def test_strip_and_squeeze_know_all_white_space(spark):
    assert one(spark, "    a  b　\x1c", text.strip) == "a  b"
    assert one(spark, " a \t\n  b ", text.squeeze) == "a b"


def test_normalize_entity(spark):
    cases = {"La": "la", "De La": "de la", "El Salvador": "salvador", "República de Cuba": "republica cuba", "São Paulo": "sao paulo", "Ñandú": "nandu", "  ": "", "": ""}
    df = spark.createDataFrame([(k,) for k in [*cases, None]], "x string")
    got = {r.x: r.y for r in df.select("x", text.normalize_entity(F.col("x")).alias("y")).collect()}
    assert got == cases | {None: None}


def test_iso_date(spark):
    cases = {"5 de mayo de 1810": "1810-05-05", "en 1999": "1999", "3 de foo de 2000": "2000", "sin fecha": None, "31 de FEBRERO de 1901": "1901-02-31", "1 de setiembre de 2020": "2020-09-01", "12345": None}
    df = spark.createDataFrame([(k,) for k in cases], "x string")
    assert {r.x: r.y for r in df.select("x", text.iso_date(F.col("x")).alias("y")).collect()} == cases


def test_file_names(spark):
    assert one(spark, ' a/b:c?.. ', text.safe_filename) == "a_b_c_"
    assert one(spark, "...", text.safe_filename) == "unnamed_file"
    assert one(spark, "Ñu - (x)  y", text.file_key) == "Ñu_x_y"


def test_percent_rounds_half_to_even(spark):
    df = spark.createDataFrame([(1, 800), (1, 3), (1, 0)], "a int, b int")
    assert [r.y for r in df.select(text.percent(F.col("a"), F.col("b")).alias("y")).collect()] == ["0.12%", "33.33%", "0.00%"]


def test_country(spark):
    df = spark.createDataFrame([("x", "a", "peruano"), ("Country", "a", "Chile"), ("x", "brasil y chile", "b"), (None, None, None)], "r string, h string, t string")
    assert [r.y for r in df.select(text.country_of(F.col("r"), F.col("h"), F.col("t")).alias("y")).collect()] == ["peru", "chile", "brasil", None]


def told(spark, data, cfg=rules.RuleConfig()):
    return [r.reasons for r in rules.explained(spark.createDataFrame(data, SCHEMA), cfg).collect()]


def test_reasons_at_the_edges(spark):
    ok = ("ab", "per", "r", "cd", "loc", 0.4)
    cases = [
        (ok, []),
        (("ab", "per", "r", "cd", "loc", None), []),
        (("ab", "per", "r", "cd", "loc", float("nan")), []),
        (("ab", "per", "r", "cd", "loc", 0.39), ["low_confidence"]),
        ((None, None, None, " ", None, 0.5), ["head_empty", "tail_empty"]),
        (("ñ", "per", "r", "𝔸" * 100, "loc", 0.5), ["head_too_short"]),
        (("a" * 101, "per", "r", "𝔸" * 101, "loc", 0.5), ["head_too_long", "tail_too_long"]),
        (("1999", "eve", "winner", "cd", "loc", 0.5), ["pure_year_invalid_event"]),
        (("1999", "per", "winner", "cd", "loc", 0.5), []),
    ]
    assert told(spark, [c[0] for c in cases]) == [c[1] for c in cases]


def test_configured_reasons(spark):
    cfg = rules.RuleConfig.from_mapping(
        {
            "generic_entities": ["Cosa"],
            "filtered_relations": ["es"],
            "incompatible_type_pairs": [["date", "date"], ["loc", "loc", "r", "self"], ["a", "b", "c", "other"]],
            "validation_patterns": {"temporal_consistency": {"temporal_incompatible_relations": ["winner"], "invalid_year_patterns": [r"^\w+ \d{4}$"]}, "semantic_validation": {"relation_entity_compatibility": {"capital": ["loc"]}}},
        }
    )
    data = [
        ("COSA", "per", "x", "cd", "loc", 1.0),
        ("ab", "per", "ES", "cd", "loc", 1.0),
        ("ab", "date", "x", "cd", "date", 1.0),
        ("Lima", "loc", "x", "lima", "loc", 1.0),
        ("ab", "per", "capital", "cd", "org", 1.0),
        ("marzo 2020", "eve", "winner", "cd", "per", 1.0),
        ("el año nuevo", "concept", "winner", "cd", "per", 1.0),
        ("ab", "time", "winner", "cd", "per", 1.0),
    ]
    assert told(spark, data, cfg) == [["generic_entity"], ["filtered_relation"], ["incompatible_types"], ["self_incompatible_type"], ["semantic_incompatibility"], ["year_classified_as_event"], ["temporal_concept_invalid_relation"], ["temporal_entity_invalid_relation"]]
    assert cfg.relaxed(2).min_confidence == cfg.min_confidence / 2 and cfg.relaxed(0.5) == cfg


def test_rules_over_nothing(spark):
    assert rules.valid(spark.createDataFrame([], SCHEMA)).count() == 0


# an independent model of the segmenter
def model_sentences(t):
    t = t.strip()
    abbr = {a.replace("\\", "").lower() for a in segment.ABBREVIATIONS}
    out, last = [], 0
    for m in re.finditer(r"[.!?](?=\s|\Z)", t):
        if m[0] == ".":
            word = re.search(r"(?:p\.)?\w*\Z", t[: m.start()])[0].lower()
            if word in abbr or word.rpartition(".")[2] in abbr - {"ej"} and "." not in word:
                continue
        out.append(t[last : m.end()].strip())
        last = m.end()
    rest = t[last:].strip()
    return [s for s in [*out, rest] if s]


def test_sentences(spark):
    df = spark.createDataFrame([("Dr. Paz vino. Fue.",), ("El Sr. y la Sra. Ruiz, p.ej. ayer. ¿Sí? ¡No! fin",), ("  ",), (None,), ("a.b c",)], "x string")
    got = [r.y for r in df.select(segment.sentence_array(F.col("x")).alias("y")).collect()]
    assert got == [["Dr. Paz vino.", "Fue."], ["El Sr. y la Sra. Ruiz, p.ej. ayer.", "¿Sí?", "¡No!", "fin"], [], None, ["a.b c"]]


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="ab.!? Drñ\n", max_size=30), min_size=20, max_size=60))
def test_sentences_as_the_model(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    got = [r.y for r in df.select(segment.sentence_array(F.col("x")).alias("y")).collect()]
    assert got == [model_sentences(t) for t in texts]


def test_chunks(spark):
    long = "x" * 3000
    semi = ";".join(["parte " + "y" * 900] * 6)
    df = spark.createDataFrame([("Dr. Paz vino. Fue.",), (long,), ("corto",), (semi,), (None,), ("",)], "x string")
    got = [r.y for r in df.select(segment.chunk_array(F.col("x"), 2048).alias("y")).collect()]
    assert got[0] == [] and got[1] == [long] and got[2] == [] and got[4] is None and got[5] == []
    assert len(got[3]) == 3 and ";" not in "".join(got[3])
    simple = [r.y for r in df.select(segment.segment(F.col("x"), 10, improved=False).alias("y")).collect()]
    assert simple[1] == ["", long + "."] and simple[2] == ["corto."] and simple[5] == []


def test_accents_as_unicode_has_them(spark):
    chars = "".join(chr(i) for i in range(0xC0, 0x250))
    want = "".join(c for c in unicodedata.normalize("NFD", chars) if unicodedata.category(c) != "Mn")
    assert one(spark, chars, text.strip_accents) == want


def test_rows_helper(spark):
    assert rows(spark.range(2)) == [(0,), (1,)]
