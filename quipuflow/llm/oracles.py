"""SQL for DuckDB that gives the rows of those queries that SQL can express."""

from __future__ import annotations

from quipuflow.llm.repetition import STOP_WORDS, THRESHOLDS
from quipuflow.llm.survivor import ABSENT


def _words(x: str) -> str:
    t = rf"regexp_replace(strip_accents(lower({x})), '[\p{{M}}\p{{Cf}}\x00-\x08\x0e-\x1b\x7f-\x{{84}}\x{{86}}-\x{{9f}}]+', '', 'g')"
    return rf"regexp_extract_all({t}, '[\p{{L}}\p{{N}}]+')"


def _windows(table: str, key: str, n: int) -> str:
    return f"""SELECT {key}, len(l) AS n, i, array_to_string(l[i:i + {n - 1}], ' ') AS k
      FROM (SELECT {key}, l, unnest(range(1, len(l) - {n} + 2)) AS i FROM (SELECT {key}, {_words('text')} AS l FROM {table}) WHERE len(l) >= {n})"""


def _leaf(x: str) -> str:
    return rf"regexp_replace(nfc_normalize(lower({x})), '[^\p{{L}}\p{{N}}\p{{M}}]+', '', 'g')"


def _told(x: str) -> str:
    return rf"CASE WHEN regexp_matches({_leaf(x)}, '[\p{{L}}\p{{N}}]') THEN {_leaf(x)} ELSE '' END"


RECORDS = rf"""SELECT id, {_leaf('head')} AS h, {_leaf('type')} AS r, {_leaf('tail')} AS t FROM (
    SELECT triple_id AS id, head, type, tail FROM triples
    UNION ALL SELECT line_id, line->>'head', line->>'type', line->>'tail' FROM triple_lines WHERE json_valid(line) AND json_type(line) = 'OBJECT')"""
CASES = rf"SELECT *, min(id) OVER (PARTITION BY h, r, t) AS first_id FROM ({RECORDS}) WHERE " + " AND ".join(rf"regexp_matches({c}, '[\p{{L}}\p{{N}}]')" for c in "hrt")


def _usable(f: str) -> str:
    absent = ", ".join("'" + a + "'" for a in ABSENT)
    return rf"""coalesce(regexp_matches(a.{f}, '[\p{{L}}\p{{N}}]') AND lower(trim(a.{f})) NOT IN ({absent}) AND NOT contains(a.{f}, chr(65533)) AND NOT regexp_matches(a.{f}, '[ÂÃ][\x{{80}}-\x{{bf}}]|[\x{{80}}-\x{{9f}}]') AND NOT regexp_matches(trim(a.{f}), '(\.\.\.|…)$')
      AND NOT EXISTS (SELECT 1 FROM triple_copies b WHERE b.group_id = a.group_id AND b.{f} <> a.{f} AND starts_with(b.{f}, a.{f})), false)"""


def _field(f: str) -> str:
    return rf"""(SELECT arg_max(v, k) FROM (SELECT a.{f} AS v, {{'t': coalesce(l.trust, -1), 'at': a.extracted_at, 'id': -a.copy_id}} AS k FROM triple_copies a LEFT JOIN trust_levels l USING (method)
      WHERE a.group_id = g.group_id AND {_usable(f)}))"""


def _records() -> str:
    first = lambda f: f"arg_min(CASE WHEN u_{f} THEN {f} END, k) FILTER (u_{f}) AS {f}"
    fields = ("head", "head_type", "tail")
    return rf"""WITH RECURSIVE v AS (SELECT a.*, coalesce(l.trust, -1) AS trust, {", ".join(f"{_usable(f)} AS u_{f}" for f in fields)} FROM triple_copies a LEFT JOIN trust_levels l USING (method)),
      rep AS (SELECT *, {" + ".join(f"u_{f}::INT" for f in fields)} AS complete FROM v
        QUALIFY row_number() OVER (PARTITION BY group_id, trust, {", ".join(f"u_{f}" for f in fields)} ORDER BY extracted_at DESC NULLS LAST, copy_id) = 1),
      dom AS (SELECT a.copy_id AS up, b.copy_id AS down FROM rep a JOIN rep b USING (group_id) WHERE a.copy_id <> b.copy_id AND a.trust >= b.trust AND a.complete >= b.complete
        AND (a.extracted_at > b.extracted_at OR (a.extracted_at = b.extracted_at AND a.copy_id < b.copy_id))),
      lay AS (SELECT copy_id, 1 AS n FROM rep UNION SELECT down, n + 1 FROM lay JOIN dom ON up = copy_id),
      l AS (SELECT *, {{'layer': layer, 'c': -complete, 't': -trust, 'at': -epoch_us(extracted_at), 'id': copy_id}} AS k FROM rep JOIN (SELECT copy_id, max(n) AS layer FROM lay GROUP BY copy_id) USING (copy_id))
      SELECT group_id, arg_min(copy_id, k) AS copy_id, {", ".join(first(f) for f in fields)},
        CAST(greatest({", ".join(f"coalesce(arg_min(layer, k) FILTER (u_{f}), 0)" for f in fields)}) AS INTEGER) AS deepest FROM l GROUP BY group_id"""


def _profile() -> str:
    stop = ", ".join("'" + w + "'" for w in STOP_WORDS)
    rules = {r.name: r.at_least for r in THRESHOLDS}
    shares = {
        "repeated": "coalesce(c.sum, 0) / w::DOUBLE",
        "repeated_lines": "CASE WHEN len(lines) > 0 THEN (len(lines) - len(list_distinct(lines))) / len(lines)::DOUBLE ELSE 0 END",
        "symbols": rf"CASE WHEN length(text) > 0 THEN length(regexp_replace(text, '[\p{{L}}\p{{M}}\p{{N}}\p{{P}}\s\x0b]+', '', 'g')) / length(text)::DOUBLE ELSE 0 END",
        "few_stop_words": f"CASE WHEN len(l) > 0 THEN 1 - len(list_filter(l, lambda x: x IN ({stop}))) / len(l)::DOUBLE ELSE 0 END",
    }
    shown = ", ".join(f"coalesce({x}, 0) AS {n}_share, coalesce({x}, 0) >= {rules[n]}::DOUBLE AS {n}" for n, x in shares.items())
    return rf"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {_words("coalesce(text, '')")} AS l FROM documents),
      g AS ({_windows('documents', 'doc_id', 8)}),
      r AS (SELECT doc_id, n, i FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, k ORDER BY i) AS rn FROM g) WHERE rn > 1),
      c AS (SELECT doc_id, sum(x) AS sum FROM (SELECT doc_id, n, least(8, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 8)) AS x FROM r) GROUP BY doc_id),
      t AS (SELECT doc_id, text, l, nullif(len(l), 0) AS w, list_filter(regexp_split_to_array(text, '[\r\n]+'), lambda x: trim(x, ' ') <> '') AS lines FROM d)
      SELECT doc_id, {shown} FROM t LEFT JOIN c USING (doc_id)"""


def all_sql() -> dict[str, str]:
    return {
        "p2_found": """
            SELECT 'interim_docs' AS item_table, source AS item_key, CAST(i - 1 AS INTEGER) AS chunk_index
              FROM (SELECT source, chunks, unnest(range(1, len(chunks) + 1)) AS i FROM interim_docs) WHERE length(chunks[i]) > 2048
            UNION ALL SELECT 'raw_pages', CAST(page_id AS VARCHAR), CAST(-1 AS INTEGER) FROM raw_pages WHERE length(content) > 2048""",
        "p3_found": f"SELECT first_id, id AS copy_id FROM ({CASES}) WHERE id <> first_id",
        "p3_records": f"SELECT first_id, count(*) AS n_copies FROM ({CASES}) GROUP BY first_id",
        "p3_pages": f"""SELECT min(page_id) AS first_id, count(*) AS n_copies FROM raw_pages GROUP BY {_told('title')}, {_told('content')}, list_transform(coalesce(categories, []), lambda c: {_told('c')}),
            {", ".join(_told(f"CAST(metadata.{f} AS VARCHAR)") for f in ("source", "language", "category_source", "original_length", "cleaned_length", "extraction_date"))}""",
        "p4_found": f"SELECT group_id, {_field('head')} AS head, {_field('head_type')} AS head_type, {_field('tail')} AS tail FROM (SELECT DISTINCT group_id FROM triple_copies) g",
        "p4_records": _records(),
        "p9_found": f"SELECT DISTINCT doc_id, item_id FROM ({_windows('documents', 'doc_id', 10)}) d JOIN ({_windows('eval_items', 'item_id', 10)}) e USING (k)",
        "p10_profile": _profile(),
        "p10_found": f"""WITH g AS ({_windows('documents', 'doc_id', 8)}),
            r AS (SELECT doc_id, n, i FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, k ORDER BY i) AS rn FROM g) WHERE rn > 1),
            c AS (SELECT doc_id, n, least(8, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 8)) AS x FROM r)
            SELECT doc_id FROM c GROUP BY doc_id, n HAVING sum(x) >= 0.3 * n""",
    }
