"""Triples from text: the parser of linearized model output, and the interface to a model.

Null and empty outputs give no triples.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipuflow.functions.text import WS, preview, strip

#: Marks of the model's vocabulary that carry nothing.
SPECIALS = ("<s>", "<pad>", "</s>", "tp_XX", "__en__")
TRIPLE = "struct<head:string,head_type:string,type:string,tail:string,tail_type:string>"


def parsed(decoded: Column) -> Column:
    """array<struct<head, head_type, type, tail, tail_type>> of a linearized output.

    Subject, object and relation collect plain tokens; <triplet> or <relation> opens a subject, other
    tags give the types. A triple is emitted when the next one opens, the last only if it is complete.
    """
    text = decoded
    for s in SPECIALS:
        text = F.replace(text, F.lit(s), F.lit(""))
    toks = F.filter(F.split(text, f"{WS}+"), lambda t: t != "")

    def made(st: Column) -> Column:
        return F.struct(strip(st["subj"]).alias("head"), st["subj_type"].alias("head_type"), strip(st["rel"]).alias("type"), strip(st["obj"]).alias("tail"), st["obj_type"].alias("tail_type"))

    def state(st: Column, **new: Column) -> Column:
        return F.struct(*[(new[k] if k in new else st[k]).alias(k) for k in ("at", "subj", "subj_type", "obj", "obj_type", "rel", "out")])

    def step(st: Column, t: Column) -> Column:
        opens = t.isin("<triplet>", "<relation>")
        tag = t.startswith("<") & t.endswith(">")
        body = F.substring(t, F.lit(2), F.length(t) - 2)
        emitted = F.when(st["rel"] != "", F.array_append(st["out"], made(st))).otherwise(st["out"])
        empty = F.lit("")
        word = lambda k: F.concat(st[k], F.lit(" "), t)
        return (
            F.when(opens, state(st, at=F.lit("t"), out=emitted, rel=empty, subj=empty))
            .when(tag & st["at"].isin("t", "o"), state(st, at=F.lit("s"), out=emitted, obj=empty, subj_type=body))
            .when(tag, state(st, at=F.lit("o"), obj_type=body, rel=empty))
            .when(st["at"] == "t", state(st, subj=word("subj")))
            .when(st["at"] == "s", state(st, obj=word("obj")))
            .when(st["at"] == "o", state(st, rel=word("rel")))
            .otherwise(st)
        )

    start = F.struct(F.lit("x").alias("at"), *[F.lit("").alias(k) for k in ("subj", "subj_type", "obj", "obj_type", "rel")], F.array().cast(f"array<{TRIPLE}>").alias("out"))
    whole = lambda st: (st["subj"] != "") & (st["rel"] != "") & (st["obj"] != "") & (st["subj_type"] != "") & (st["obj_type"] != "")
    return F.aggregate(toks, start, step, lambda st: F.when(whole(st), F.array_append(st["out"], made(st))).otherwise(st["out"]))


class Extractor(Protocol):
    """A model: decoded output and confidence of each chunk. Loaded once per worker by `load`."""

    def load(self) -> None: ...

    def run(self, chunks: list[str]) -> list[tuple[str, float]]: ...


class PatternExtractor:
    """A stand-in without a model, for tests: "A es B de C" gives A, B, C as one linearized triple."""

    def load(self) -> None:
        import re

        self.pattern = re.compile(r"(\w[\w ]*?) es (\w+) de (\w[\w ]*\w)")

    def run(self, chunks: list[str]) -> list[tuple[str, float]]:
        out = []
        for c in chunks:
            found = self.pattern.findall(c)
            out.append(("<s>" + "".join(f"<triplet> {a} <per> {t} <loc> {r} " for a, r, t in found) + "</s>", 0.5))
        return out


class Backend(Protocol):
    """A sequence model with its tokenizer, on one worker."""

    special: frozenset[int]

    def encode(self, text: str, most: int) -> list[int]: ...

    def generate(self, ids: list[int], most: int, beams: int) -> tuple[list[int], list[list[float]]]:
        """The best sequence and, step by step, the logits from which each token after the first was taken."""
        ...

    def decode(self, ids: list[int]) -> str: ...


class BeamExtractor:
    """A sequence-to-sequence model: chunks cut to `max_tokens` tokens, the best of `beams` beams, its mean token probability.

    backend: makes the backend; it is called once per worker, so it must be importable there. Special tokens don't count
    for the confidence; without any other token it is 0.95.
    """

    def __init__(self, backend: Callable[[], Backend], max_tokens: int = 256, beams: int = 3):
        self.make, self.max_tokens, self.beams, self.backend = backend, max_tokens, beams, None

    def load(self) -> None:
        self.backend = self.backend or self.make()

    def run(self, chunks: list[str]) -> list[tuple[str, float]]:
        b = self.backend
        out = []
        for c in chunks:
            sequence, logits = b.generate(b.encode(c, self.max_tokens), self.max_tokens, self.beams)
            told = [(np.asarray(x, dtype=float), t) for x, t in zip(logits, sequence[1:]) if t not in b.special]
            chance = [float(np.exp(x[t] - x.max()) / np.exp(x - x.max()).sum()) for x, t in told]
            out.append((b.decode(sequence), sum(chance) / len(chance) if chance else 0.95))
        return out


class TransformersBackend:
    """A backend of the library transformers, where it is installed; model: a name or a folder."""

    def __init__(self, model: str, source: str = "en_XX", target: str = "tp_XX"):
        import torch
        from transformers import AutoModelForSeq2SeqLM, AutoTokenizer

        self.torch, self.target = torch, target
        self.tokenizer = AutoTokenizer.from_pretrained(model, src_lang=source, tgt_lang=target)
        self.device = "cuda" if torch.cuda.is_available() else "cpu"
        self.model = AutoModelForSeq2SeqLM.from_pretrained(model).to(self.device)
        names = ("<s>", "</s>", "<pad>", "__en__", target)
        self.special = frozenset(self.tokenizer.convert_tokens_to_ids(n) for n in names)

    def encode(self, text: str, most: int) -> list[int]:
        return self.tokenizer(text, max_length=most, truncation=True)["input_ids"]

    def generate(self, ids: list[int], most: int, beams: int) -> tuple[list[int], list[list[float]]]:
        x = self.torch.tensor([ids], device=self.device)
        start = self.tokenizer.convert_tokens_to_ids(self.target)
        with self.torch.inference_mode():
            got = self.model.generate(x, attention_mask=self.torch.ones_like(x), decoder_start_token_id=start, max_length=most, num_beams=beams, length_penalty=0, forced_bos_token_id=None, return_dict_in_generate=True, output_scores=True)
        return got.sequences[0].tolist(), [s[0].tolist() for s in got.scores]

    def decode(self, ids: list[int]) -> str:
        return self.tokenizer.decode(ids, skip_special_tokens=False)


def sequence_confidence(scores: Column, special: Column) -> Column:
    """Mean probability of the generated tokens that aren't special; 0.95 where there is none.

    scores: array<struct<logits array<double>, token int>>, one per step.
    """

    def probability(x: Column) -> Column:
        top = F.array_max(x["logits"])
        z = F.aggregate(x["logits"], F.lit(0.0), lambda a, v: a + F.exp(v - top))
        return F.exp(F.get(x["logits"], x["token"]) - top) / z

    used = F.transform(F.filter(scores, lambda x: ~F.array_contains(special, x["token"])), probability)
    total = F.aggregate(used, F.lit(0.0), lambda a, v: a + v)
    return F.when(F.size(used) > 0, total / F.size(used)).otherwise(F.lit(0.95))


def decoded(chunks: DataFrame, extractor: Extractor, batch: int = 64) -> DataFrame:
    """chunks with decoded and confidence; a chunk on which the model fails gets nulls and the error's text."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chunks.schema)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        extractor.load()
        for pdf in frames:
            texts, got = pdf["chunk"].tolist(), []
            for i in range(0, len(texts), batch):
                part = texts[i : i + batch]
                try:
                    got += [(*x, None) for x in extractor.run(part)]
                except Exception:
                    for t in part:
                        try:
                            got.append((*extractor.run([t])[0], None))
                        except Exception as e:
                            got.append((None, None, str(e)))
            yield pdf.assign(decoded=[g[0] for g in got], confidence=[g[1] for g in got], error=[g[2] for g in got])

    return chunks.mapInPandas(run, f"{schema}, decoded string, confidence double, error string")


def triples(decoded_chunks: DataFrame, shown: int = 100) -> DataFrame:
    """One row per triple with its provenance; chunk_text is the chunk's beginning."""
    text = preview(F.col("chunk"), shown)
    rows = decoded_chunks.select("source_file", "chunk_index", text.alias("chunk_text"), "confidence", F.posexplode(parsed(F.col("decoded"))).alias("triple_index", "t"))
    return rows.select("t.*", "confidence", "source_file", "chunk_index", "chunk_text", "triple_index")
