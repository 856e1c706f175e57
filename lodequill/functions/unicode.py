"""What Spark has no expression for: Unicode normal forms, excerpts, text
scores and query understanding, as Arrow-batched pandas UDFs over plain
functions."""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import functions as F

from . import numbers
from .text import UNMARK_STEPS

_ALNUM = re.compile(r"[^\W_]+")
_NOT_ALNUM = re.compile(r"[\W_]+")


def tr_lower(text: str) -> str:
    return text.replace("İ", "i").replace("I", "ı").lower()


def normalize_text(text: str) -> str:
    return " ".join(unicodedata.normalize("NFKC", tr_lower(text)).split())


def match_form(text: str) -> str:
    """For matching: no marks, lower case, words parted by one space."""
    bare = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.category(c).startswith("M"))
    return _NOT_ALNUM.sub(" ", tr_lower(bare).replace("ı", "i")).strip()


def title_form(text: str) -> str:
    bare = unicodedata.normalize("NFD", tr_lower(text).replace("ı", "i"))
    return _NOT_ALNUM.sub(" ", "".join(c for c in bare if not unicodedata.category(c).startswith("M"))).strip()


def similarity_tokens(text: str, most: int = 8000) -> list[str]:
    return [w for w in _ALNUM.findall(unicodedata.normalize("NFKC", tr_lower(text))) if len(w) >= 3][:most]


def text_score(queries, value: str) -> float:
    """Best of the queries: equal 1, inside 0.9, else the longest run of
    shared words over the query's words of two characters or more."""
    own = match_form(value or "")
    if not own:
        return 0.0
    best, words = 0.0, own.split()
    for q in queries:
        q = match_form(q)
        if q == own:
            return 1.0
        if q in own:
            best = max(best, 0.9)
            continue
        asked = [w for w in q.split() if len(w) > 1]
        if not asked:
            continue
        run, longest = [0] * (len(words) + 1), 0
        for a in asked:
            run = [0] + [run[j] + 1 if a == w else 0 for j, w in enumerate(words)]
            longest = max(longest, *run)
        best = max(best, longest / len(asked))
    return best


def _plain(markdown: str) -> str:
    text = re.sub(r"(?m)^\s{0,3}#{1,6}(?:\s+|$)", "", markdown).replace("\r\n", "\n").replace("\r", "\n")
    for pattern, to in UNMARK_STEPS:
        text = re.sub(pattern, to.replace("$1", r"\1"), text)
    return " ".join(text.split())


def excerpt(markdown: str | None, least: int = 120, most: int = 220) -> str:
    """A short text whole, else the run of sentences of fitting length nearest
    the middle, else the words around it."""
    text = _plain(markdown or "")
    if len(text) <= most:
        return text
    parts = re.split(r"(?<=[.!?])\s+", text)
    starts = [0]
    for p in parts:
        starts.append(starts[-1] + len(p) + 1)
    best, middle = None, len(text) / 2
    for i in range(len(parts)):
        for j in range(i, len(parts)):
            size = starts[j + 1] - 1 - starts[i]
            if size > most:
                break
            if size >= least:
                off = abs((starts[i] + starts[j + 1] - 1) / 2 - middle)
                if best is None or off < best[0]:
                    best = off, " ".join(parts[i : j + 1])
    if best:
        return best[1]
    room = most - 6
    a = max(0, len(text) // 2 - room // 2)
    b = min(len(text), a + room)
    a = text.rfind(" ", 0, a + 1) + 1
    end = text.find(" ", b)
    b = end if end > a else b
    return (("..." if a else "") + text[a:b].strip() + ("..." if b < len(text) else ""))[:most]


@dataclass(frozen=True)
class Retrieval:
    """Configuration of query understanding and ranking."""

    languages: tuple = ("tr", "en")
    max_queries: int = 8
    aliases: tuple = ()  # (canonical, (alias, ...))
    corrections: dict = field(default_factory=lambda: {"ihlass": "ihlas", "riyaa": "riya"})
    vector_weight: float = 1.0
    title_weight: float = 0.25
    metadata_weight: float = 0.15
    alias_weight: float = 0.1
    entity_weight: float = 0.1
    reference_floor: float = 0.55
    reference_tolerance: float = 0.05
    metadata_fields: tuple = ("title", "book", "section", "subsection", "chapter", "surah", "verse", "verseNumber", "hadithNumber", "author", "headingPath")
    es_compat: bool = False  # word boundaries as ECMAScript has them: ASCII only


def load_retrieval(text: str | None) -> Retrieval:
    """From JSON; what it lacks, or any error, gives the defaults."""
    import json

    try:
        raw = json.loads(text or "")
        base = Retrieval()
        rank, pick = raw.get("ranking", {}), raw.get("candidateSelection", {})
        return Retrieval(
            tuple(raw.get("languages", base.languages)),
            int(raw.get("maxExpandedQueries", base.max_queries)),
            tuple((a["canonical"], tuple(a["aliases"])) for a in raw.get("aliases", ())),
            vector_weight=rank.get("vectorWeight", 1.0), title_weight=rank.get("titleWeight", 0.25), metadata_weight=rank.get("metadataWeight", 0.15),
            alias_weight=rank.get("aliasWeight", 0.1), entity_weight=rank.get("entityWeight", 0.1),
            reference_floor=pick.get("structuredReferenceFloor", 0.55), reference_tolerance=pick.get("structuredReferenceTolerance", 0.05),
            metadata_fields=tuple(raw.get("metadataFields", base.metadata_fields)),
        )
    except (ValueError, TypeError, KeyError, AttributeError):
        return Retrieval()


def normalize_query(text: str, corrections=None) -> str:
    corrections = Retrieval().corrections if corrections is None else corrections
    out = []
    for word in unicodedata.normalize("NFKC", text).split():
        m = re.fullmatch(r"([\W_]*)([^\W_]+)([\W_]*)", word)
        out.append(m[1] + corrections.get(tr_lower(m[2]), m[2]) + m[3] if m else word)
    return " ".join(out)


def entities(query: str, es_compat: bool = False) -> list[dict]:
    b = r"(?:(?<![A-Za-z0-9_])(?=[A-Za-z0-9_])|(?<=[A-Za-z0-9_])(?![A-Za-z0-9_]))" if es_compat else r"\b"
    kinds = (
        ("ordinal", rf"{b}\d{{1,4}}\s*\.", 0, lambda v: re.sub(r"\D", "", v)),
        ("reference", rf"{b}\d{{1,4}}(?::\d{{1,4}}(?:-\d{{1,4}})?)?\.?{b}", 0, lambda v: v.removesuffix(".")),
        ("roman-numeral", rf"{b}[IVXLCDM]+{b}", re.I, lambda v: str(numbers.roman_value(v) or v)),
        ("named-entity", None, 0, match_form),
    )
    found = []
    for kind, pattern, flags, form in kinds:
        for m in re.finditer(pattern, query, flags) if pattern else _names(query, es_compat):
            found.append({"type": kind, "value": m[0], "normalized_value": form(m[0]), "start": m.start(), "end": m.end()})
    return found


def _names(query: str, es_compat: bool):
    """Runs of capitalised words."""
    word = re.compile(r"[^\W\d_][\w'’-]*")
    runs, last = [], None
    for m in word.finditer(query):
        if not m[0][0].isupper() or es_compat and not m[0][0].isascii():
            last = None
            continue
        if last is not None and query[last[1] : m.start()].isspace():
            last[1] = m.end()
        else:
            runs.append(last := [m.start(), m.end()])
    return [re.compile(r"(?s).{%d}" % (b - a)).match(query, a) for a, b in runs]


def understand(query: str, config: Retrieval = Retrieval()) -> dict:
    """Normalised query, variants, entities and aliases."""
    own = re.sub(r"(\d)\.(?=[^\W\d_])", r"\1. ", normalize_query(query, config.corrections))
    variants = dict.fromkeys([own])

    def expand():
        for _ in range(2):
            for v in list(variants):
                variants.setdefault(numbers.digits_from_roman(v))
                for a in config.languages:
                    digits = numbers.digits_from_written(v, a)
                    variants.setdefault(digits)
                    for b in (a, *config.languages):
                        variants.setdefault(numbers.written_from_digits(digits, b))

    expand()
    matched = []
    for canonical, aliases in config.aliases:
        terms = (canonical, *aliases)
        hit = next((t for t in terms if match_form(t) in match_form(own)), None)
        if hit is None:
            continue
        matched.append({"canonical": canonical, "matched": hit})
        for v in list(variants):
            for t in terms:
                variants.setdefault(re.sub(re.escape(hit), lambda _, t=t: t, v, flags=re.I))
    expand()
    queries = [q for q in dict.fromkeys(normalize_query(v, config.corrections) for v in variants) if q]
    return {"original_query": query, "normalized_query": own, "expanded_queries": queries[: max(1, config.max_queries)], "detected_entities": entities(own, config.es_compat), "matched_aliases": matched}


PLAN_TYPE = "struct<original_query:string,normalized_query:string,expanded_queries:array<string>,detected_entities:array<struct<type:string,value:string,normalized_value:string,start:int,end:int>>,matched_aliases:array<struct<canonical:string,matched:string>>>"


def _text_udf(f, kind="string"):
    @F.pandas_udf(kind)
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else f(x))

    return run


def normalized(col):
    return _text_udf(normalize_text)(col)


def normalized_query(col):
    return _text_udf(normalize_query)(col)


def nfkc(col):
    return _text_udf(lambda x: unicodedata.normalize("NFKC", x))(col)


def matched(col):
    return _text_udf(match_form)(col)


def titled(col):
    return _text_udf(title_form)(col)


def excerpted(col):
    return _text_udf(excerpt)(col)


def scored(queries, value):
    @F.pandas_udf("double")
    def run(q: pd.Series, v: pd.Series) -> pd.Series:
        return pd.Series([text_score(a if a is not None else (), b) for a, b in zip(q, v)], dtype="float64")

    return run(queries, value)


def understood(col, config: Retrieval = Retrieval()):
    @F.pandas_udf(PLAN_TYPE)
    def run(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([understand(x or "", config) for x in s], columns=["original_query", "normalized_query", "expanded_queries", "detected_entities", "matched_aliases"])

    return run(col)
