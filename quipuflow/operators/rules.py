"""Reasons to reject a triple, as one array column without user functions.

Null head, tail and types count as empty; a null or NaN confidence passes; the relation is compared
stripped and in lower case. Other columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipuflow.functions.text import WORD, strip

TEMPORAL = ("time", "date", "num")
#: Relations that a mere year can't have.
CONTEST = ("winner", "participant", "performer", "competitor", "champion")
#: Words that make a concept temporal.
TIME_WORDS = ("año", "mes", "día", "fecha", "tiempo", "época", "periodo", "temporada")


@dataclass(frozen=True)
class RuleConfig:
    """Thresholds and lists. `effective` is what runs by default; `configured` switches on every list given."""

    min_confidence: float = 0.4
    min_length: int = 2
    max_length: int = 100
    generic_entities: tuple[str, ...] = ()
    filtered_relations: tuple[str, ...] = ()
    incompatible_pairs: tuple[tuple[str, str], ...] = ()
    self_pairs: tuple[tuple[str, str], ...] = ()
    compatibility: dict[str, tuple[str, ...]] = field(default_factory=dict)
    temporal_relations: tuple[str, ...] = ()
    year_patterns: tuple[str, ...] = ()
    min_connections: int = 1
    unique_margin: float = 0.05

    @classmethod
    def from_mapping(cls, m: dict) -> "RuleConfig":
        """From the quality_control part of a YAML file."""
        time = m.get("validation_patterns", {}).get("temporal_consistency", {})
        sem = m.get("validation_patterns", {}).get("semantic_validation", {})
        pairs = [tuple(map(str, p)) for p in m.get("incompatible_type_pairs", [])]
        return cls(
            min_confidence=float(m.get("min_confidence_threshold", 0.4)),
            min_length=int(m.get("min_entity_length", 2)),
            max_length=int(m.get("max_entity_length", 100)),
            generic_entities=tuple(str(x).lower() for x in m.get("generic_entities", [])),
            filtered_relations=tuple(str(x).lower() for x in m.get("filtered_relations", [])),
            incompatible_pairs=tuple(p for p in pairs if len(p) == 2),
            self_pairs=tuple(p[:2] for p in pairs if len(p) >= 4 and p[3] == "self"),
            compatibility={k: tuple(v) for k, v in sem.get("relation_entity_compatibility", {}).items()},
            temporal_relations=tuple(time.get("temporal_incompatible_relations", [])) if time.get("year_as_event_filter", True) else (),
            year_patterns=tuple(time.get("invalid_year_patterns", [])),
            min_connections=int(m.get("min_connections_per_entity", 3)),
        )

    @classmethod
    def from_yaml(cls, path: str) -> "RuleConfig":
        import yaml

        with open(path, encoding="utf-8") as f:
            return cls.from_mapping(yaml.safe_load(f).get("quality_control", {}))

    def relaxed(self, factor: float) -> "RuleConfig":
        """Thresholds divided by a factor of at least 1."""
        k = max(1.0, factor)
        return replace(self, min_confidence=max(0.0, self.min_confidence / k), min_connections=max(0, int(self.min_connections / k)))


def _java(pattern: str) -> str:
    """A pattern of the configuration for Java, with Unicode words and digits."""
    return pattern.replace(r"\w", WORD).replace(r"\d", r"\p{Nd}").replace("$", r"(?=\n?\z)")


def reasons(cfg: RuleConfig = RuleConfig(), head: str = "head", tail: str = "tail", relation: str = "type", head_type: str = "head_type", tail_type: str = "tail_type", confidence: str = "confidence") -> Column:
    """array<string>, sorted and distinct; empty for a valid triple."""
    h, t, r = (strip(F.coalesce(F.col(c), F.lit(""))) for c in (head, tail, relation))
    ht, tt = (F.coalesce(F.col(c), F.lit("")) for c in (head_type, tail_type))
    lh, lt, lr = F.lower(h), F.lower(t), F.lower(r)
    conf = F.col(confidence)
    tests: list[tuple[str, Column]] = [("low_confidence", conf.isNotNull() & ~F.isnan(conf) & (conf < cfg.min_confidence))]
    for name, c in (("head", h), ("tail", t)):
        tests += [(f"{name}_empty", c == ""), (f"{name}_too_short", (c != "") & (F.length(c) < cfg.min_length)), (f"{name}_too_long", F.length(c) > cfg.max_length)]
    if cfg.generic_entities:
        tests.append(("generic_entity", lh.isin(*cfg.generic_entities) | lt.isin(*cfg.generic_entities)))
    if cfg.filtered_relations:
        tests.append(("filtered_relation", (r != "") & lr.isin(*cfg.filtered_relations)))
    typed = (ht != "") & (tt != "")
    if cfg.incompatible_pairs:
        tests.append(("incompatible_types", typed & F.concat_ws("\u001f", ht, tt).isin(*["\u001f".join(p) for p in cfg.incompatible_pairs])))
    if cfg.self_pairs:
        tests.append(("self_incompatible_type", typed & (lh == lt) & F.concat_ws("\u001f", ht, tt).isin(*["\u001f".join(p) for p in cfg.self_pairs])))
    for rel, allowed in cfg.compatibility.items():
        tests.append(("semantic_incompatibility", (r == rel) & typed & ~ht.isin(*allowed) & ~tt.isin(*allowed)))
    if cfg.temporal_relations:
        timed = r.isin(*cfg.temporal_relations)
        if cfg.year_patterns:
            year = F.lit(False)
            for p in cfg.year_patterns:
                year = year | h.rlike(_java(p))
            tests.append(("year_classified_as_event", (ht == "eve") & timed & year))
        tests.append(("temporal_entity_invalid_relation", ht.isin(*TEMPORAL) & timed))
        worded = F.lit(False)
        for w in TIME_WORDS:
            worded = worded | F.contains(lh, F.lit(w))
        tests.append(("temporal_concept_invalid_relation", (ht == "concept") & timed & worded))
    tests.append(("pure_year_invalid_event", ht.isin("eve", "concept", *TEMPORAL) & r.isin(*CONTEST) & h.rlike(r"^\p{Nd}{4}$")))
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in tests]))))


def explained(df: DataFrame, cfg: RuleConfig = RuleConfig()) -> DataFrame:
    return df.withColumn("reasons", reasons(cfg))


def valid(df: DataFrame, cfg: RuleConfig = RuleConfig()) -> DataFrame:
    return df.where(F.size(reasons(cfg)) == 0)


def strict_valid(cfg: RuleConfig = RuleConfig(min_confidence=0.5)) -> Column:
    """The stricter yes-or-no validator: nothing stripped but in comparing head and tail, and dates of implausible centuries rejected."""
    h, t = F.coalesce(F.col("head"), F.lit("")), F.coalesce(F.col("tail"), F.lit(""))
    r = F.coalesce(F.col("type"), F.lit(""))
    ht, tt = F.coalesce(F.col("head_type"), F.lit("")), F.coalesce(F.col("tail_type"), F.lit(""))
    pair = F.concat_ws("\u001f", ht, tt)
    ok = ~(F.col("confidence").isNotNull() & ~F.isnan("confidence") & (F.col("confidence") < cfg.min_confidence))
    ok &= F.length(h).between(cfg.min_length, cfg.max_length) & F.length(t).between(cfg.min_length, cfg.max_length)
    if cfg.generic_entities:
        ok &= ~F.lower(h).isin(*cfg.generic_entities) & ~F.lower(t).isin(*cfg.generic_entities)
    if cfg.filtered_relations:
        ok &= ~F.lower(r).isin(*cfg.filtered_relations)
    if cfg.incompatible_pairs:
        ok &= ~pair.isin(*["\u001f".join(p) for p in cfg.incompatible_pairs])
    if cfg.self_pairs:
        ok &= ~((strip(F.lower(h)) == strip(F.lower(t))) & pair.isin(*["\u001f".join(p) for p in cfg.self_pairs]))
    for rel, allowed in cfg.compatibility.items():
        ok &= ~((r == rel) & (ht != "") & (tt != "") & ~ht.isin(*allowed) & ~tt.isin(*allowed))
    return ok & ~((tt == "date") & t.rlike(r"(?U)\b(1[2-4][0-9]{2}|21[1-9][0-9]|22[0-9]{2})\b"))
