"""Problem 3: records that differ only in case, white space, punctuation or the order of fields.

A record is a tree of any depth, as its schema tells: structs and maps are nodes whose children have no order,
arrays are nodes whose children have one. From the leaves up, leaves are normalised to their letters and digits, each child's digest is
bound to its name or key, the digests of an unordered node's children are sorted before they are
hashed, and records are grouped by the digest of the root. The normal form of the whole tree is part of the
grouping key: that is the full comparison, so that equal digests of unequal records don't join them.

Groups are built with partial aggregation. To give every copy its group's first id, only groups of
two or more are joined back, and both sides are salted, so that one group of a third of all rows is
spread over many tasks.

A record of which a field is null or has no letter or digit is no case; lines that aren't one JSON
object neither. Ids that repeat count as copies of themselves. Extra columns are left out.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quipuflow.functions.text import let

FIELDS = ("head", "type", "tail")
SALTS = 16


def _composed() -> dict[str, str]:
    """Base letter and mark to the single sign, by rule over the alphabets that have such signs."""
    out = {}
    for i in [*range(0xC0, 0x250), *range(0x370, 0x530), *range(0x1E00, 0x2000)]:
        d = unicodedata.normalize("NFD", chr(i))
        if len(d) > 1 and unicodedata.normalize("NFC", d) == chr(i):
            out[d] = chr(i)
    return out


def leaf(value: Column) -> Column:
    """Letters, digits and accents of a value, in lower case; one form for either spelling of an accent."""
    pairs = F.from_json(F.lit(json.dumps(_composed())), "map<string,string>")  # folded into one literal
    bare = F.regexp_replace(F.lower(value), r"[^\p{L}\p{N}\p{M}]+|[︀-️]+", "")

    def composed(t: Column) -> Column:
        units = F.regexp_extract_all(t, F.lit(r"\P{M}\p{M}*"), 0)
        return F.when(t.rlike(r"\p{M}"), F.array_join(F.transform(units, lambda u: F.coalesce(pairs[u], u)), "")).otherwise(t)

    return let(bare, composed)


def usable(normal: Column) -> Column:
    return F.coalesce(normal.rlike(r"[\p{L}\p{N}]"), F.lit(False))


def digest(node: Column, name: str = "") -> Column:
    """64-bit digest of a named leaf."""
    return F.xxhash64(F.lit(name), node)


def root(children: list[Column], ordered: bool = False) -> Column:
    """Digest of a node from its children's; sorted where their order doesn't count."""
    arr = F.array(*children)
    return F.xxhash64(arr if ordered else F.array_sort(arr))


def tree(value: Column, kind: T.DataType) -> Column:
    """struct<d: digest, c: normal form> of a value of any type, from the leaves up.

    Null and what has no letter or digit are one. The normal form of an unordered node lists its children
    sorted, each with its name; signs that the leaves can't hold part them, so that different trees differ.
    """
    if isinstance(kind, T.StructType):
        children = [let(tree(value[f.name], f.dataType), _named(F.lit(f.name))) for f in kind.fields]
        return _node(F.array(*children), sort=True, open_="\u0003")
    if isinstance(kind, T.ArrayType):
        return _node(F.transform(value, lambda x: tree(x, kind.elementType)), sort=False, open_="\u0004")
    if isinstance(kind, T.MapType):

        def entry(e: Column) -> Column:
            return let(tree(e["key"], kind.keyType), lambda k: let(tree(e["value"], kind.valueType), lambda v: F.struct(F.xxhash64(k["d"], v["d"]).alias("d"), F.concat(k["c"], F.lit("\u0002"), v["c"]).alias("c"))))

        return _node(F.transform(F.map_entries(value), entry), sort=True, open_="\u0005")
    normal = let(leaf(value.cast("string")), lambda x: F.when(usable(x), x).otherwise(F.lit("")))
    return let(normal, lambda x: F.struct(F.xxhash64(x).alias("d"), x.alias("c")))


def _named(name: Column) -> Callable[[Column], Column]:
    return lambda t: F.struct(F.xxhash64(name, t["d"]).alias("d"), F.concat(name, F.lit("\u0002"), t["c"]).alias("c"))


def _node(children: Column, sort: bool, open_: str) -> Column:
    known = F.coalesce(children, F.array().cast("array<struct<d:bigint,c:string>>"))
    shown = lambda o: F.concat(F.lit(open_), F.array_join(F.transform(o, lambda x: x["c"]), "\u0006"), F.lit("\u0007"))
    return let(F.array_sort(known) if sort else known, lambda o: F.struct(F.xxhash64(F.lit(open_), F.transform(o, lambda x: x["d"])).alias("d"), shown(o).alias("c")))


def tree_groups(df: DataFrame, fields: list[str], id_col: str) -> DataFrame:
    """(first_id, n_copies) of each distinct record of some columns of any types."""
    part = T.StructType([df.schema[f] for f in fields])
    # exploding one struct keeps the tree from being computed anew
    rows = df.select(F.col(id_col).alias("id"), F.explode(F.array(tree(F.struct(*fields), part))).alias("n"))
    return rows.groupBy("n.d", "n.c").agg(F.min("id").alias("first_id"), F.count("*").alias("n_copies")).select("first_id", "n_copies")


def parsed_lines(lines: DataFrame, line_col: str = "line", id_col: str = "line_id", fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """(id, fields) of the lines that are one JSON object and nothing else; the parser goes 1,000 levels deep."""
    schema = T.StructType([T.StructField(f, T.StringType()) for f in (*fields, "_corrupt")])
    text = F.trim(F.regexp_replace(F.col(line_col), r"^[﻿\s]+|\s+$", ""))
    obj = F.from_json(text, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    # from_json ignores what follows the object; inside of a list and of an object alike only a comma or nothing
    # can follow, and no comma fits both, so a text that parses in either is one object, at any depth that is parsed
    one = F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1
    whole = text.startswith("{") & one & F.json_object_keys(F.concat(F.lit('{"k":'), text, F.lit("}"))).isNotNull()
    return lines.select(F.col(id_col).alias("id"), obj.alias("o"), whole.alias("whole")).where("whole and o._corrupt is null").select("id", *[F.col(f"o.{f}").alias(f) for f in fields])


def normalised(df: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """(id, root, canon): digest of the root and the normal form of each case; rows that are none are gone."""
    # exploding one struct keeps the filters from computing the leaves anew
    df = df.select("id", F.explode(F.array(F.struct(*[leaf(F.col(f)).alias(f) for f in fields]))).alias("n")).select("id", "n.*")
    for f in fields:
        df = df.where(usable(F.col(f)))
    return df.select("id", root([digest(F.col(f), f) for f in fields]).alias("root"), F.concat_ws("\u001f", *fields).alias("canon"))


def groups(records: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """One row per distinct record: root, canon, first_id, n_copies."""
    return normalised(records, fields).groupBy("root", "canon").agg(F.min("id").alias("first_id"), F.count("*").alias("n_copies"))


def copies(records: DataFrame, fields: tuple[str, ...] = FIELDS, salts: int = SALTS) -> DataFrame:
    """(first_id, copy_id) of every record but the first of its group."""
    rows = normalised(records, fields)
    again = rows.groupBy("root", "canon").agg(F.min("id").alias("first_id"), F.count("*").alias("n")).where("n > 1")
    again = again.select("root", "canon", "first_id", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int"))
    return rows.join(again, ["root", "canon", "salt"]).where("id <> first_id").select("first_id", F.col("id").alias("copy_id"))


def all_records(triples: DataFrame, lines: DataFrame) -> DataFrame:
    """(id, head, type, tail) of both tables, which share one id space."""
    return triples.select(F.col("triple_id").alias("id"), *FIELDS).unionByName(parsed_lines(lines))
