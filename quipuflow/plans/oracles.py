"""SQL for DuckDB that gives the rows of the core queries."""

from __future__ import annotations

from quipuflow.functions.text import COUNTRIES, MONTHS, STOP_WORDS
from quipuflow.operators.rules import CONTEST
from quipuflow.operators.segment import ABBREVIATIONS

WS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_WS = WS[1:-1]


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sub(x: str, pattern: str, by: str = "", flags: str = "g") -> str:
    return f"regexp_replace({x}, {q(pattern)}, {q(by)}, {q(flags)})"


def strip(x: str) -> str:
    return sub(x, f"^{WS}+|{WS}+$")


def squeeze(x: str) -> str:
    return strip(sub(x, f"{WS}+", " "))


def inlist(xs) -> str:
    return "(" + ", ".join(q(x) for x in xs) + ")"


def tokens(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, {q(WS + '+')}), lambda w: w <> '')"


def norm(x: str) -> str:
    low = f"strip_accents(lower({strip(x)}))"
    t = tokens(low)
    kept = f"list_filter({t}, lambda w: w NOT IN {inlist(STOP_WORDS)})"
    return f"CASE WHEN len({t}) <= 1 THEN array_to_string({t}, ' ') WHEN len({kept}) > 0 THEN array_to_string({kept}, ' ') ELSE {low} END"


def score(e: str) -> str:
    formal = " OR ".join(f"contains(lower({e}), {q(w)})" for w in ("república", "estado", "ciudad", "provincia", "departamento"))
    part = " OR ".join(f"starts_with({e}, {q(w)})" for w in ("de ", "del ", "la ", "el ", "los ", "las "))
    first = f"substring({e}, 1, 1)"
    return f"""((CASE WHEN {e} = lower({e}) AND {e} <> upper({e}) AND length({e}) > 3 THEN -20 ELSE 0 END)
      + (CASE WHEN {first} = upper({first}) AND {first} <> lower({first}) AND NOT ({e} = upper({e}) AND {e} <> lower({e})) THEN 15 ELSE 0 END)
      + (CASE WHEN contains({e}, '.') THEN -10 ELSE 0 END)
      + (CASE WHEN length({e}) < 3 THEN -15 WHEN length({e}) < 5 THEN -5 ELSE 0 END)
      + (CASE WHEN length({e}) BETWEEN 5 AND 50 THEN 10 WHEN length({e}) > 50 THEN -5 ELSE 0 END)
      - 2 * length({sub(e, '[' + chr(92) + 'p{L}' + chr(92) + 'p{N} ' + chr(92) + '-]')})
      + (CASE WHEN {formal} THEN 8 ELSE 0 END) + (CASE WHEN {part} THEN -10 ELSE 0 END))"""


def reasons_sql(cfg) -> str:
    """(triple_id, reasons) by a rule configuration."""
    cases = [("low_confidence", f"confidence IS NOT NULL AND NOT isnan(confidence) AND confidence < {cfg.min_confidence}::DOUBLE")]
    for n in "ht":
        name = {"h": "head", "t": "tail"}[n]
        cases += [(f"{name}_empty", f"{n} = ''"), (f"{name}_too_short", f"{n} <> '' AND length({n}) < {cfg.min_length}"), (f"{name}_too_long", f"length({n}) > {cfg.max_length}")]
    if cfg.generic_entities:
        cases.append(("generic_entity", f"lower(h) IN {inlist(cfg.generic_entities)} OR lower(t) IN {inlist(cfg.generic_entities)}"))
    if cfg.filtered_relations:
        cases.append(("filtered_relation", f"r <> '' AND lower(r) IN {inlist(cfg.filtered_relations)}"))
    typed = "ht <> '' AND tt <> ''"
    pair = lambda ps: "(" + " OR ".join(f"(ht = {q(a)} AND tt = {q(b)})" for a, b in ps) + ")"
    if cfg.incompatible_pairs:
        cases.append(("incompatible_types", f"{typed} AND {pair(cfg.incompatible_pairs)}"))
    if cfg.self_pairs:
        cases.append(("self_incompatible_type", f"{typed} AND lower(h) = lower(t) AND {pair(cfg.self_pairs)}"))
    for rel, ok in cfg.compatibility.items():
        cases.append(("semantic_incompatibility", f"r = {q(rel)} AND {typed} AND ht NOT IN {inlist(ok)} AND tt NOT IN {inlist(ok)}"))
    if cfg.temporal_relations:
        timed = f"r IN {inlist(cfg.temporal_relations)}"
        years = " OR ".join(f"regexp_matches(h, {q(p.replace(chr(92) + 'w', '[' + chr(92) + 'p{L}' + chr(92) + 'p{N}_]').replace(chr(92) + 'd', chr(92) + 'p{Nd}'))})" for p in cfg.year_patterns)
        cases.append(("year_classified_as_event", f"ht = 'eve' AND {timed} AND ({years})"))
        cases.append(("temporal_entity_invalid_relation", f"ht IN ('time', 'date', 'num') AND {timed}"))
        words = " OR ".join(f"contains(lower(h), {q(w)})" for w in ("año", "mes", "día", "fecha", "tiempo", "época", "periodo", "temporada"))
        cases.append(("temporal_concept_invalid_relation", f"ht = 'concept' AND {timed} AND ({words})"))
    cases.append(("pure_year_invalid_event", f"ht IN ('eve', 'concept', 'time', 'date', 'num') AND r IN {inlist(CONTEST)} AND regexp_matches(h, '^\\p{{Nd}}{{4}}$')"))
    arr = ", ".join(f"CASE WHEN {c} THEN {q(n)} END" for n, c in cases)
    inner = ", ".join(f"{strip(f'coalesce({c}, {q(str())})')} AS {a}" for c, a in (("head", "h"), ("tail", "t"), ("type", "r")))
    return f"""SELECT triple_id, coalesce(array_to_string(list_sort(list_distinct(list_filter([{arr}], lambda x: x IS NOT NULL))), ','), '') AS reasons
      FROM (SELECT triple_id, confidence, coalesce(head_type, '') AS ht, coalesce(tail_type, '') AS tt, {inner} FROM triples)"""


def fold_sql(rows: str, margin: float = 0.05) -> str:
    """(o, first_ord) of the kept rows of (head, type, o, c)."""
    better = f"NOT isnan(k.c) AND NOT isnan(x.c) AND x.c > k.c + {margin}::DOUBLE"
    return f"""SELECT list_reduce(l, lambda k, x: CASE WHEN {better} THEN x ELSE k END).o AS o, l[1].o AS first_ord
      FROM (SELECT list({{'o': o, 'c': c}} ORDER BY o) AS l FROM ({rows}) GROUP BY head, type)"""


def cleaned(x: str) -> str:
    t = sub(x, r"\[\p{Nd}+\]")
    t = sub(t, r"\[(?:cita requerida|sin referencias|¿cuándo\?|¿cuál\?|¿dónde\?)\]", "", "gi")
    t = sub(t, r"\[([^\]]+)\]\([^)]+\)", r"\1")
    t = sub(t, r"\|+[^\n]*?\|+", " ")
    t = sub(t, rf"\|{WS}*\|", " ")
    for a, b in (("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"')):
        t = f"replace({t}, {q(a)}, {q(b)})"
    nav = rf"^(?:(?:véase también|enlaces externos|referencias|categorías?):?{WS}*|tabla de contenidos?:?{WS}*|menú de navegación:?{WS}*|\|{WS}*|\p{{Nd}}+{WS}*)$"
    lines = f"list_transform(string_split({t}, chr(10)), lambda l: {strip('l')})"
    lines = f"list_filter({lines}, lambda l: length(l) >= 3 AND NOT regexp_matches(l, {q(f'^[|' + chr(92) + f'-=+{_WS}]*$')}) AND NOT regexp_matches(l, {q(nav)}, 'i'))"
    t = squeeze(f"array_to_string({lines}, ' ')")
    return squeeze(sub(t, rf"[^\p{{L}}\p{{N}}_{_WS}.,;:!?¿¡()\"'-áéíóúüñÁÉÍÓÚÜÑ]", " "))


def plain(x: str) -> str:
    t = sub(x, r"\{\{[^}]*\}\}", " ")
    for k in ("Archivo", "File", "Imagen", "Category", "Categoría"):
        t = sub(t, rf"(?s)\[\[{k}:.*?\]\]", " ")
    for p in (r"(?s)<ref[^>]*>.*?</ref>", r"<ref[^>]*/>", r"(?s)<.*?>", r"(?s)\{\|.*?\|\}"):
        t = sub(t, p, " ")
    for p, b in ((r"'''([^']+)'''", r"\1"), (r"''([^']+)''", r"\1"), (r"\[\[([^|\]]+)\|([^\]]+)\]\]", r"\2"), (r"\[\[([^\]]+)\]\]", r"\1"), (r"={2,6}([^=]+)={2,6}", r"\1"), (rf"\n{WS}*\n{WS}*\n+", "\n\n"), (r"[ \t]+", " ")):
        t = sub(t, p, b)
    return strip(t)


def sentence_list(x: str) -> str:
    t = sub(strip(x), rf"(^|[^\p{{L}}\p{{N}}_])({'|'.join(ABBREVIATIONS)})\.", "\\1\\2\u0002", "gi")
    t = sub(t, f"([.!?]){WS}", "\\1\u0001")
    return f"list_filter(list_transform(string_split({t}, chr(1)), lambda s: {strip('replace(s, chr(2), ' + q('.') + ')')}), lambda s: s <> '')"


def simple_list(x: str) -> str:
    t = f"replace(replace({x}, '?!', '.'), '?', '.')"
    return f"list_transform(list_filter(list_transform(string_split({t}, '.'), lambda s: {strip('s')}), lambda s: s <> ''), lambda s: s || '.')"


EMPTY = "{'done': []::VARCHAR[], 'cur': NULL::VARCHAR, 'n': 0}"


def chunk_sql() -> str:
    part = f"list_filter(list_transform(regexp_split_to_array(x, '[,;]'), lambda p: {strip('p')}), lambda p: p <> '')"
    # long sentences are cut first, each part with the number of its sentence; a part's sentence opens and closes its own chunks
    return f"""WITH s AS (SELECT doc_id, {sentence_list('text')} AS l FROM documents WHERE text IS NOT NULL),
      e AS (SELECT doc_id, i, l[i] AS x FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM s)),
      u AS (SELECT doc_id, i, 0 AS j, 0 AS long, x FROM e WHERE length(x) <= 2048
        UNION ALL SELECT doc_id, i, k AS j, i AS long, p[k] AS x FROM (SELECT doc_id, i, p, unnest(range(1, len(p) + 1)) AS k FROM (SELECT doc_id, i, {part} AS p FROM e WHERE length(x) > 2048))),
      o AS (SELECT doc_id, list({{'x': x, 'long': long}} ORDER BY i, j) AS l FROM u GROUP BY doc_id),
      c AS (SELECT doc_id, list_reduce(l, lambda a, b: CASE
          WHEN a.cur IS NOT NULL AND a.long = b.long AND a.n + length(b.x) <= 2048 THEN {{'done': a.done, 'cur': a.cur || ' ' || b.x, 'n': a.n + length(b.x), 'long': b.long, 'x': ''}}
          WHEN a.cur IS NULL THEN {{'done': a.done, 'cur': b.x, 'n': length(b.x), 'long': b.long, 'x': ''}}
          ELSE {{'done': list_append(a.done, a.cur), 'cur': b.x, 'n': length(b.x), 'long': b.long, 'x': ''}} END,
          {{'done': []::VARCHAR[], 'cur': NULL::VARCHAR, 'n': 0::BIGINT, 'long': 0::BIGINT, 'x': ''}}) AS r
        FROM (SELECT doc_id, list_transform(l, lambda z: {{'done': []::VARCHAR[], 'cur': NULL::VARCHAR, 'n': 0::BIGINT, 'long': z.long::BIGINT, 'x': z.x}}) AS l FROM o)),
      f AS (SELECT doc_id, list_filter(list_append(r.done, r.cur), lambda z: z IS NOT NULL AND length({strip('z')}) >= 50) AS ch FROM c)
      SELECT doc_id, CAST(i - 1 AS INTEGER) AS chunk_index, ch[i] AS chunk FROM (SELECT doc_id, ch, unnest(range(1, len(ch) + 1)) AS i FROM f)"""


def simple_chunk_sql(budget: int = 600) -> str:
    return f"""WITH s AS (SELECT doc_id, {simple_list('text')} AS l FROM documents WHERE {strip("coalesce(text, '')")} <> ''),
      c AS (SELECT doc_id, list_reduce(list_transform(l, lambda z: {{'done': []::VARCHAR[], 'cur': NULL::VARCHAR, 'n': 0::BIGINT, 'x': z}}), lambda a, b: CASE
          WHEN a.n + length(b.x) <= {budget} THEN {{'done': a.done, 'cur': CASE WHEN a.cur IS NULL THEN b.x ELSE a.cur || ' ' || b.x END, 'n': a.n + length(b.x), 'x': ''}}
          ELSE {{'done': list_append(a.done, coalesce(a.cur, '')), 'cur': b.x, 'n': length(b.x), 'x': ''}} END,
          {{'done': []::VARCHAR[], 'cur': NULL::VARCHAR, 'n': 0::BIGINT, 'x': ''}}) AS r FROM s),
      f AS (SELECT doc_id, CASE WHEN r.cur IS NULL THEN r.done ELSE list_append(r.done, r.cur) END AS ch FROM c)
      SELECT doc_id, CAST(i - 1 AS INTEGER) AS chunk_index, ch[i] AS chunk FROM (SELECT doc_id, ch, unnest(range(1, len(ch) + 1)) AS i FROM f)"""


ENTITIES = f"SELECT DISTINCT entity FROM (SELECT head AS entity FROM triples UNION ALL SELECT tail FROM triples) WHERE {strip('coalesce(entity, ' + q('') + ')')} <> ''"
DEGREES = f"SELECT entity, count(*) AS degree FROM (SELECT {strip('head')} AS entity FROM triples UNION ALL SELECT {strip('tail')} FROM triples) WHERE entity IS NOT NULL AND entity <> '' GROUP BY entity"
EXACT = f"""SELECT entity, first_value(entity) OVER (PARTITION BY norm ORDER BY {score('entity')} DESC, length(entity), lower(entity), entity) AS representative
  FROM (SELECT entity, {norm('entity')} AS norm FROM ({ENTITIES}))"""
FOLD = "SELECT head, type, triple_id AS o, coalesce(confidence, 0) AS c FROM triples"
OBJECT = """regexp_full_match(trim(line, chr(9) || chr(10) || chr(13) || ' '), '(?s)\\{.*\\}') AND json_valid(line)"""


def all_sql() -> dict[str, str]:
    from quipuflow.operators.resolve import WINDOW
    from quipuflow.operators.rules import RuleConfig
    from quipuflow.plans.queries import CONFIGURED, STRICT

    strict = STRICT
    pairs = lambda ps: "(" + " OR ".join(f"(head_type = {q(a)} AND tail_type = {q(b)})" for a, b in ps) + ")"
    told = reasons_sql(CONFIGURED)
    similar = rf"""WITH r AS (SELECT norm, coalesce(nullif(substring(norm, 1, 1), ''), 'z') AS b, length(norm) AS n, list_distinct(list_filter(regexp_split_to_array(norm, '[^\p{{L}}\p{{N}}_]+'), lambda t: t <> '')) AS t
        FROM (SELECT DISTINCT {norm('entity')} AS norm FROM ({ENTITIES}))),
      o AS (SELECT *, row_number() OVER (PARTITION BY b ORDER BY n, norm) AS nth, count(*) OVER (PARTITION BY b) AS size FROM r),
      p AS (SELECT x.norm AS na, y.norm AS nb, x.nth AS nth_a, y.nth AS nth_b, x.size AS size, len(list_intersect(x.t, y.t)) AS i, len(x.t) + len(y.t) AS u FROM o x JOIN o y ON x.b = y.b AND x.nth < y.nth WHERE len(x.t) > 0 AND len(y.t) > 0)
      SELECT na, nb, round(i / (u - i)::DOUBLE, 6) AS jaccard FROM p WHERE i / (u - i)::DOUBLE >= (0.85::DOUBLE - 0.4::DOUBLE) / 0.6::DOUBLE"""
    curated = f"""WITH ok AS (SELECT t.* FROM triples t JOIN ({reasons_sql(RuleConfig())}) r USING (triple_id) WHERE r.reasons = ''),
      m AS ({EXACT.replace('FROM triples', 'FROM ok')}), k AS (SELECT * FROM m WHERE entity <> representative),
      n AS (SELECT triple_id, {norm('coalesce(a.representative, ok.head)')} AS head, type, {norm('coalesce(b.representative, ok.tail)')} AS tail, confidence FROM ok LEFT JOIN k a ON a.entity = ok.head LEFT JOIN k b ON b.entity = ok.tail),
      u AS ({fold_sql(FOLD.replace('FROM triples', 'FROM n'))})"""
    text = lambda c: f"coalesce({c}, '')"
    modal = lambda cols, value: f"(SELECT type, arg_max({value}, [n, -o]) AS v FROM (SELECT type, {cols}, sum(n) AS n, min(o) AS o FROM grouped GROUP BY type, {cols}) GROUP BY type)"
    names = "[" + ", ".join(q(c) for c in COUNTRIES) + "]"
    country = f"coalesce(CASE WHEN contains(lower({text('type')}), 'country') AND lower({text('tail')}) IN {inlist(COUNTRIES)} THEN lower(tail) END, list_filter({names}, lambda n: contains(lower({text('head')}), n) OR contains(lower({text('tail')}), n))[1])"
    months = "CASE lower(m) " + " ".join(f"WHEN {q(m)} THEN '{i:02d}'" for i, m in enumerate(MONTHS, 1)) + " WHEN 'setiembre' THEN '09' END"
    date = rf"(\p{{Nd}}{{1,2}}){WS}+de{WS}+([A-Za-záéíóúñ]+){WS}+de{WS}+(\p{{Nd}}{{4}})"
    clean_cols = " AND ".join([rf"regexp_full_match({text(c)}, '[\p{{L}}\p{{N}}.,-]+( [\p{{L}}\p{{N}}.,-]+)*')" for c in ("head", "type", "tail")] + [f"regexp_full_match({text(c)}, '[a-z]+')" for c in ("head_type", "tail_type")])
    return {
        "triple_reasons": reasons_sql(RuleConfig()),
        "triple_reasons_configured": told,
        "reason_histogram": f"SELECT reason, count(*) AS n FROM (SELECT triple_id, unnest(string_split(reasons, ',')) AS reason FROM ({told}) WHERE reasons <> '') GROUP BY reason ORDER BY n DESC, min(triple_id) LIMIT 20",
        "strict_valid": f"""SELECT triple_id FROM triples WHERE NOT (confidence IS NOT NULL AND NOT isnan(confidence) AND confidence < 0.5::DOUBLE)
            AND length({text('head')}) BETWEEN 2 AND 100 AND length({text('tail')}) BETWEEN 2 AND 100
            AND lower({text('head')}) NOT IN {inlist(strict.generic_entities)} AND lower({text('tail')}) NOT IN {inlist(strict.generic_entities)}
            AND lower({text('type')}) NOT IN {inlist(strict.filtered_relations)} AND NOT coalesce({pairs(strict.incompatible_pairs)}, false)
            AND NOT coalesce({strip(f"lower({text('head')})")} = {strip(f"lower({text('tail')})")} AND {pairs(strict.self_pairs)}, false)
            AND {" AND ".join(f"NOT ({text('type')} = {q(rel)} AND {text('head_type')} <> '' AND {text('tail_type')} <> '' AND head_type NOT IN {inlist(ok)} AND tail_type NOT IN {inlist(ok)})" for rel, ok in strict.compatibility.items())}
            AND NOT ({text('tail_type')} = 'date' AND regexp_matches({text('tail')}, '(^|[^\\p{{L}}\\p{{N}}_])(1[2-4][0-9]{{2}}|21[1-9][0-9]|22[0-9]{{2}})($|[^\\p{{L}}\\p{{N}}_])'))""",
        "normalized_entities": f"SELECT entity, {norm('entity')} AS norm FROM ({ENTITIES})",
        "exact_entity_map": EXACT,
        "unique_triples": f"SELECT o AS triple_id, first_ord FROM ({fold_sql(FOLD)})",
        "unique_events": f"""SELECT o AS ord, first_ord FROM ({fold_sql("SELECT concat('User ', user_id % 7) AS head, event_type AS type, event_id AS o, floor(value)::DOUBLE / 500 AS c FROM events")})""",
        "entity_degree": DEGREES,
        "degree_summary": f"""SELECT count(*) AS n_entities, min(degree) AS min_degree, max(degree) AS max_degree, round(avg(degree), 6) AS mean_degree, quantile_cont(degree, 0.5)::DOUBLE AS median_degree,
            count(*) FILTER (degree < 2) AS n_below, round(count(*) FILTER (degree < 2) * 100.0::DOUBLE / count(*), 6) AS percent_below FROM ({DEGREES})""",
        "degree_histogram": f"SELECT degree, count(*) AS n FROM ({DEGREES}) GROUP BY degree ORDER BY n DESC, degree LIMIT 20",
        "connected_triples": f"""WITH weak AS (SELECT entity FROM ({DEGREES}) WHERE degree < 3)
            SELECT triple_id FROM triples WHERE NOT EXISTS (SELECT 1 FROM weak WHERE entity = {strip('head')}) AND NOT EXISTS (SELECT 1 FROM weak WHERE entity = {strip('tail')})""",
        "distinct_triples": f"SELECT min(triple_id) AS triple_id FROM triples GROUP BY {text('head')}, {text('type')}, {text('tail')}",
        "entity_report": f"""WITH r AS (SELECT triple_id AS o, {text('type')} AS rel, {strip(text('head'))} AS e, {text('head_type')} AS t, 0 AS k FROM triples
            UNION ALL SELECT triple_id, {text('type')}, {strip(text('tail'))}, {text('tail_type')}, 1 FROM triples)
            SELECT e AS entidad, arg_min(t, o * 2 + k) AS tipo, count(*) FILTER (k = 0) AS como_entidad, count(*) FILTER (k = 1) AS como_valor, count(*) AS apariciones_totales,
            count(DISTINCT rel) FILTER (k = 0) AS relaciones_unicas_como_entidad, count(DISTINCT rel) FILTER (k = 1) AS relaciones_unicas_como_valor, count(DISTINCT rel) AS total_relaciones_unicas
            FROM r WHERE e <> '' GROUP BY e""",
        "relation_report": f"""WITH grouped AS (SELECT {strip(text('type'))} AS type, {text('head_type')} AS ht, {text('tail_type')} AS tt, count(*) AS n, min(triple_id) AS o FROM triples GROUP BY ALL)
            SELECT p.type AS relacion, p.n::BIGINT AS cantidad, round_even(p.n * 100.0::DOUBLE / (SELECT sum(n) FROM grouped), 2) AS porcentaje, a.v AS tipo_entidad_mas_comun, b.v AS tipo_valor_mas_comun, c.v AS par_tipos_mas_comun
            FROM (SELECT type, sum(n) AS n FROM grouped GROUP BY type) p JOIN {modal('ht', 'ht')} a USING (type) JOIN {modal('tt', 'tt')} b USING (type) JOIN {modal('ht, tt', "ht || ' -> ' || tt")} c USING (type) WHERE p.type <> ''""",
        "country_report": f"""WITH r AS (SELECT *, {country} AS c FROM triples)
            SELECT array_to_string(list_transform(string_split(c, ' '), lambda w: upper(w[1]) || w[2:]), ' ') AS pais, n AS cantidad_tripletas, e AS entidades_unicas, l AS relaciones_unicas, x.h AS entidad_ejemplo, x.r AS relacion_ejemplo, x.t AS valor_ejemplo FROM (
            SELECT c, count(*) AS n, (SELECT count(DISTINCT z) FROM (SELECT head AS z FROM r i WHERE i.c = r.c UNION ALL SELECT tail FROM r i WHERE i.c = r.c) WHERE z <> '') AS e,
            count(DISTINCT type) FILTER (type <> '') AS l, arg_min({{'h': {text('head')}, 'r': {text('type')}, 't': {text('tail')}}}, triple_id) AS x FROM r WHERE c IS NOT NULL GROUP BY c)""",
        "export_basic": f"""SELECT * FROM (SELECT {strip(text('head'))} AS entidad, {strip(text('type'))} AS relacion, {strip(text('tail'))} AS valor FROM triples) WHERE entidad <> '' AND relacion <> '' AND valor <> ''""",
        "export_extended": f"""SELECT {text('head')} AS entidad, {text('head_type')} AS tipo_entidad, {text('type')} AS relacion, {text('tail')} AS valor, {text('tail_type')} AS tipo_valor, coalesce(confidence::VARCHAR, '') AS confianza,
            {text('source_file')} AS archivo_fuente, coalesce(chunk_index::VARCHAR, '') AS indice_chunk FROM triples""",
        "export_filtered": f"""SELECT triple_id FROM triples WHERE NOT isnan(coalesce(confidence, 0)) AND coalesce(confidence, 0) >= 0.6::DOUBLE AND (head_type IN ('per', 'org') OR tail_type IN ('per', 'org'))
            AND type IN ('country', 'spouse', 'capital', 'country of citizenship') AND (""" + " OR ".join(f"contains(lower({text(c)}), {q(n)})" for n in ("méxico", "perú", "chile", "cuba") for c in ("head", "tail")) + ")",
        "source_counts": "SELECT source_file, count(*) AS n FROM triples GROUP BY source_file",
        "category_counts": "SELECT replace(c, 'Categoría:', '') AS category, count(*) AS n FROM (SELECT unnest(categories) AS c FROM raw_pages) GROUP BY 1",
        "graph_nodes": "SELECT id, min(label) AS label FROM (SELECT head AS id, head_type AS label FROM triples UNION ALL SELECT tail, tail_type FROM triples) WHERE id IS NOT NULL GROUP BY id",
        "quality_triples": f"{curated} SELECT triple_id, head, type, tail FROM n JOIN u ON u.o = n.triple_id QUALIFY row_number() OVER (PARTITION BY coalesce(head, ''), coalesce(type, ''), coalesce(tail, '') ORDER BY triple_id) = 1",
        "quality_stats": f"""{curated},
            f AS (SELECT DISTINCT coalesce(head, ''), coalesce(type, ''), coalesce(tail, '') FROM n JOIN u ON u.o = n.triple_id)
            SELECT (SELECT count(*) FROM triples) AS initial, (SELECT count(*) FROM ok) AS validated, (SELECT count(*) FROM k) AS entity_mappings, (SELECT count(*) FROM u) AS after_uniqueness, (SELECT count(*) FROM f) AS final,
            round(((SELECT count(*) FROM triples) - (SELECT count(*) FROM f)) * 100.0::DOUBLE / (SELECT count(*) FROM triples), 2) AS reduction_percent""",
        "iso_dates": f"""SELECT page_id, CASE WHEN month IS NOT NULL THEN lpad(y, 4, '0') || '-' || month || '-' || lpad(d, 2, '0') ELSE nullif(year, '') END AS iso FROM (
            SELECT page_id, d, y, {months} AS month, year FROM (SELECT page_id, regexp_extract(content, {q(date)}, 1, 'i') AS d, regexp_extract(content, {q(date)}, 2, 'i') AS m, regexp_extract(content, {q(date)}, 3, 'i') AS y,
            regexp_extract(content, '(?:^|[^\\p{{L}}\\p{{N}}\\p{{M}}_])(1[0-9]{{3}}|20[0-9]{{2}})(?:$|[^\\p{{L}}\\p{{N}}\\p{{M}}_])', 1) AS year FROM raw_pages))""",
        "file_names": f"""SELECT page_id, coalesce(nullif({sub(strip(sub('url', '[<>:"|?*' + chr(92) * 2 + '/]', '_')), chr(92) + '.+$')}, ''), 'unnamed_file') AS name, {sub(strip(sub('title', '[^' + chr(92) + 'p{L}' + chr(92) + 'p{N}_' + chr(92) + '-' + _WS + ']')), '(?:-|' + WS + ')+', '_')} AS key FROM raw_pages""",
        "clean_pages": f"SELECT page_id, {cleaned('content')} AS text FROM raw_pages",
        "clean_extracts": f"""SELECT page_id, {squeeze(sub(sub('content', chr(92) + '[.*?' + chr(92) + ']', ' '), '==+ .*? ==+', ' '))} AS text FROM raw_pages""",
        "wikitext_plain": f"SELECT page_id, {plain('content')} AS text FROM markup_pages",
        "sentences": f"SELECT doc_id, CAST(i - 1 AS INTEGER) AS n, l[i] AS sentence FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT doc_id, {sentence_list('text')} AS l FROM documents))",
        "chunks": chunk_sql(),
        "simple_chunks": simple_chunk_sql(),
        "interim_chunks": f"""SELECT source AS source_file, CAST(i - 1 AS INTEGER) AS chunk_index, chunks[i] AS chunk FROM (SELECT source, chunks, unnest(range(1, len(chunks) + 1)) AS i FROM interim_docs) WHERE {strip("coalesce(chunks[i], '')")} <> ''""",
        "long_documents": f"SELECT doc_id FROM documents WHERE length({strip('text')}) >= 100",
        "pending_pages": "SELECT page_id FROM raw_pages WHERE title IS NULL OR title NOT IN (SELECT metadata.title FROM interim_docs WHERE metadata.title IS NOT NULL AND metadata.text_length >= 200)",
        "parsed_lines": "SELECT line_id, line->>'head' AS head, line->>'type' AS type, line->>'tail' AS tail FROM triple_lines WHERE json_valid(line) AND json_type(line) = 'OBJECT'",
        "parsed_triples": f"SELECT triple_id, head, head_type, type, tail, tail_type FROM triples WHERE {clean_cols}",
        "take_while": "SELECT c_custkey AS k FROM (SELECT *, max((c_mktsegment = 'BUILDING')::INT) OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS stopped FROM customer) WHERE stopped = 0",
        "capped_per_group": "SELECT o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n FROM orders) WHERE n <= 3",
        "merged_sources": """WITH a AS (SELECT DISTINCT metadata.title AS source FROM interim_docs WHERE metadata.title IS NOT NULL), h AS (SELECT DISTINCT title AS source FROM web_pages WHERE title IS NOT NULL)
            SELECT source, 'api' AS origin FROM a UNION ALL SELECT source, 'html' FROM h WHERE source NOT IN (SELECT source FROM a)""",
        "similar_tokens": similar,
        "similar_tokens_window": similar + f" AND (size <= {4 * WINDOW} OR nth_b - nth_a <= {WINDOW})",
        "chosen_content": f"""SELECT page_id, CASE WHEN length(w) > 200 THEN w ELSE e END AS text FROM (SELECT m.page_id, {plain('m.content')} AS w, {squeeze(sub(sub('r.content', chr(92) + '[.*?' + chr(92) + ']', ' '), '==+ .*? ==+', ' '))} AS e
            FROM markup_pages m LEFT JOIN raw_pages r USING (page_id))""",
        "interim_documents": f"SELECT doc_id::VARCHAR AS source, count(*)::INTEGER AS num_chunks, max(length(text))::INTEGER AS text_length FROM ({chunk_sql()}) c JOIN documents USING (doc_id) WHERE length({strip('text')}) >= 100 GROUP BY doc_id",
        "chunk_previews": f"""SELECT source AS source_file, CAST(i - 1 AS INTEGER) AS chunk_index, CASE WHEN length(chunks[i]) > 100 THEN substring(chunks[i], 1, 100) || '...' ELSE chunks[i] END AS shown
            FROM (SELECT source, chunks, unnest(range(1, len(chunks) + 1)) AS i FROM interim_docs) WHERE {strip("coalesce(chunks[i], '')")} <> ''""",
        "relation_percent": "SELECT type, printf('%.2f%%', round_even(n * 100.0::DOUBLE / sum(n) OVER (), 2)) AS share FROM (SELECT type, count(*) AS n FROM triples WHERE type IS NOT NULL GROUP BY type)",
        "quoted_titles": "SELECT page_id, url_encode(title) AS quoted FROM raw_pages",
        "relaxed_reasons": reasons_sql(CONFIGURED.relaxed(2.0)),
    }
