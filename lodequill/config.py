"""Settings from a mapping such as os.environ."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields

PREFIX = "LODEQUILL_"
TRUE = ("1", "true", "yes", "on")


@dataclass(frozen=True)
class Settings:
    """Each field is read from PREFIX + its name in capitals; blank values are
    the default, and numbers that can't be read, or are negative, an error."""

    top_k: int = 8
    threshold: float = 0.0
    max_context_tokens: int = 6000
    chunk_tokens: int = 800
    chunk_most_tokens: int = 1000
    chunk_overlap_tokens: int = 150
    embedding_batch: int = 64
    embedding_retries: int = 3
    embedding_most_tokens: int = 8192
    crawl_languages: tuple = ()
    crawl_max_pages: int = 1000
    crawl_max_depth: int = 4
    crawl_retries: int = 2
    crawl_delay_ms: int = 1000
    respect_robots: bool = True
    quality_threshold: float = 45.0
    min_words: int = 120
    simhash_distance: int = 3
    source_collections: tuple = ()
    retrieval_config: str = ""

    def __post_init__(self):
        if self.threshold > 1:
            raise ValueError("threshold must be from 0 to 1")

    @classmethod
    def load(cls, env: Mapping[str, str]) -> Settings:
        given = {f.name: env.get(PREFIX + f.name.upper(), "") for f in fields(cls)}
        return cls(**{f.name: _value(f.name, type(f.default), given[f.name]) for f in fields(cls) if given[f.name].strip()})


def _value(name: str, kind: type, text: str):
    if kind is bool:
        return text.strip().lower() in TRUE
    if kind is tuple:
        return tuple(x for part in text.split(",") if (x := part.strip()))
    if kind is str:
        return text
    try:
        value = kind(text)
    except ValueError:
        raise ValueError(f"{name} must be a number, not {text!r}") from None
    if not 0 <= value < float("inf"):
        raise ValueError(f"{name} must be finite and not negative")
    return value
