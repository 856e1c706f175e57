"""Text scalars as Column expressions: no Python runs on the rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[\p{L}\p{N}]+"
WORD_APOSTROPHE = r"[\p{L}\p{N}]+(?:['’][\p{L}\p{N}]+)?"
SIMILARITY_WORD = r"[\p{L}\p{N}]{3,}"
# ECMAScript white space, which \s of the JVM does not cover
SPACE = r"[\s\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0))


def word_count_apostrophe(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_APOSTROPHE)), F.lit(0))


def token_count(text: Column) -> Column:
    """The deterministic offline counter: words and single other characters."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]")), F.lit(0))


def turkish_lower(text: Column) -> Column:
    return F.lower(F.translate(text, "Iİ", "ıi"))


def squeeze(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, SPACE + "+", " "))


def non_blank(text: Column) -> Column:
    """Null for blank text, else the text untrimmed."""
    return F.when(F.length(F.trim(text)) > 0, text)


def half_up(x: Column, digits: int = 0) -> Column:
    """Round half toward positive infinity."""
    scale = 10**digits
    return F.floor(x * scale + 0.5) / scale if digits else F.floor(x + 0.5)


def clamp(x: Column, lo: float, hi: float) -> Column:
    return F.least(F.lit(float(hi)), F.greatest(F.lit(float(lo)), x))


def short_hash(text: Column) -> Column:
    return F.substring(F.sha2(text.cast("binary"), 256), 1, 16)


def similarity_tokens(text: Column, most: int | None = 8000, form=lambda lower: lower) -> Column:
    """`form` is applied to the lower-case text; `unicode.nfkc` gives the
    tokens of `unicode.similarity_tokens`. None for `most`: those of the whole
    text."""
    every = F.regexp_extract_all(form(turkish_lower(text)), F.lit(SIMILARITY_WORD), F.lit(0))
    return every if most is None else F.slice(every, 1, most)


def duplicate_percentage(tokens: Column) -> Column:
    n = F.size(tokens)
    return F.when(n > 0, (n - F.size(F.array_distinct(tokens))) * 100.0 / n).otherwise(F.lit(0.0))


def _chain(text: Column, steps) -> Column:
    for pattern, to in steps:
        text = F.regexp_replace(text, pattern, to)
    return text


# The steps from Markdown to plain text.
PLAIN_STEPS = (
    (r"!\[([^\]]*)\]\([^)]+\)", "$1"),
    (r"\[([^\]]+)\]\([^)]+\)", "$1"),
    (r"(?m)^#{1,6}\s+", ""),
    (r"(?m)^ {0,3}>\s?", ""),
    (r"(?m)^(\s*)([-*+]|\d+[.)])\s+", "$1"),
    (r"[*_~`]+", ""),
    (r"\|", " "),
    (r"\r\n?", "\n"),
    (r"[ \t]+", " "),
    (r"\n{3,}", "\n\n"),
)
# The steps that take Markdown's marks out of a passage.
UNMARK_STEPS = (
    (r"!\[([^\]]*)\]\([^)]*\)", "$1"),
    (r"\[([^\]]+)\]\([^)]*\)", "$1"),
    (r"<[^>]+>", " "),
    (r"(?m)^\s*>\s?", ""),
    (r"(?m)^\s*(?:[-+*]|\d+[.)])\s+", ""),
    (r"`([^`]+)`", "$1"),
    (r"~~([^~]+)~~", "$1"),
    (r"[*_]+", ""),
    (r"\\([\\`*_\[\]{}()#+.!>-])", "$1"),
)


def plain_text(markdown: Column) -> Column:
    steps = [(pattern.replace(r"\s", SPACE), to) for pattern, to in PLAIN_STEPS]
    return F.regexp_replace(_chain(markdown, steps), rf"^{SPACE}+|{SPACE}+$", "")


def unmark(markdown: Column) -> Column:
    return _chain(markdown, UNMARK_STEPS)


def snippet(markdown: Column, most: int = 350) -> Column:
    """The first paragraph with text, without headings and marks, cut at its
    last sentence end or word that fits."""
    blocks = F.split(F.regexp_replace(markdown, r"\r\n?", "\n"), r"\n\s*\n")
    text = lambda b: squeeze(unmark(F.array_join(F.filter(F.split(b, "\n"), lambda x: ~x.rlike(r"^\s{0,3}#{1,6}(?:\s+|$)")), " ")))
    first = F.coalesce(F.try_element_at(F.filter(F.transform(blocks, text), lambda p: F.length(p) > 0), F.lit(1)), F.lit(""))
    head = F.substring(first, 1, most - 3)
    sentence = F.regexp_extract(head, r"(?s)^(.*[.!?])(?=\s|$)", 1)
    word = F.regexp_extract(head, r"(?s)^(.+) ", 1)
    return F.when(F.length(first) <= most, first).when(sentence != "", F.concat(sentence, F.lit("..."))).when(word != "", F.concat(F.rtrim(word), F.lit("..."))).otherwise(F.concat(F.rtrim(head), F.lit("...")))


def reading_minutes(words: Column) -> Column:
    return F.greatest(F.lit(1), F.ceil(words / 225).cast("int"))


def iso_date(raw: Column) -> Column:
    """ISO form where it parses, else the value itself."""
    return F.coalesce(F.date_format(F.try_to_timestamp(raw), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"), raw)


def page_number(url: Column, file: Column) -> Column:
    pick = lambda c, p: F.nullif(F.regexp_extract(c, p, 1), F.lit(""))
    return F.coalesce(pick(url, r"[?&]pageNo=(\d+)"), pick(file, r"page-(\d+)")).cast("int")


def html_escape(text: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def redact_url(url: Column) -> Column:
    """Nothing secret stays: user, password and the values of all parameters,
    each name once, are replaced."""
    hidden = "%5Bredacted%5D"
    user = F.regexp_replace(F.regexp_replace(url, r"^([A-Za-z][\w+.-]*://)[^/?#@:]+(?=[^/?#@]*@)", "$1" + hidden), r"^([A-Za-z][\w+.-]*://[^/?#@:]*:)[^/?#@]+@", "$1" + hidden + "@")
    asked = F.regexp_extract(user, r"^[^?#]*\?([^#]*)", 1)
    names = F.transform(F.filter(F.split(asked, "&"), lambda p: p != ""), lambda p: F.concat(F.substring_index(p, "=", 1), F.lit("=" + hidden)))
    head, rest = F.regexp_extract(user, r"^([^?#]*)", 1), F.regexp_extract(user, r"(#.*)$", 1)
    return F.when(asked == "", user).otherwise(F.concat(head, F.lit("?"), F.array_join(F.array_distinct(names), "&"), rest))


def error_category(message: Column, status: Column, code: Column) -> Column:
    """Category and whether to try again of a failed embedding call."""
    m, c = F.lower(message), F.lower(F.coalesce(code, F.lit("")))
    kind = (
        F.when((status == 429) | m.contains("rate limit"), "Rate limit")
        .when(c.contains("timeout") | m.contains("timed out") | m.contains("timeout"), "Timeout")
        .when(m.contains("maximum context") | m.contains("token limit"), "Token limit")
        .when(m.contains("serializ"), "Serialization")
        .when(status.isNotNull(), "API error")
        .otherwise("Other")
    )
    again = F.when(kind.isin("Token limit", "Serialization"), False).when(kind == "API error", status.isin(408, 409) | (status >= 500)).otherwise(True)
    return F.struct(kind.alias("category"), again.alias("retryable"))


def title_bonus(query: Column, title: Column) -> Column:
    """Of normalised query and title: equal, prefix, inside, or none."""
    return F.when((F.coalesce(query, F.lit("")) == "") | (F.coalesce(title, F.lit("")) == ""), 0.0).when(title == query, 0.25).when(F.startswith(title, query), 0.15).when(F.contains(title, query), 0.1).otherwise(0.0)


def answer_payload(content: Column) -> Column:
    """The JSON object in a model's reply with defaults for what it lacks."""
    kind = "struct<answer:string,usedChunkIds:array<string>,ignoredChunkIds:array<string>,answerSupported:boolean,conflictingEvidence:boolean,evidenceComplete:boolean>"
    p = F.from_json(F.regexp_extract(content, r"(?s)\{.*\}", 0), kind)
    none = F.array().cast("array<string>")
    return F.struct(
        p.answer.alias("answer"),
        F.coalesce(p.usedChunkIds, none).alias("used_chunk_ids"),
        F.coalesce(p.ignoredChunkIds, none).alias("ignored_chunk_ids"),
        F.coalesce(p.answerSupported, F.lit(True)).alias("answer_supported"),
        F.coalesce(p.conflictingEvidence, F.lit(False)).alias("conflicting_evidence"),
        F.coalesce(p.evidenceComplete, F.lit(True)).alias("evidence_complete"),
    )


def vector_id(chunk_id: Column) -> Column:
    """A UUID-shaped id from a chunk id's SHA-256."""
    h = F.sha2(chunk_id.cast("binary"), 256)
    part = lambda a, n: F.substring(h, a + 1, n)
    variant = F.conv(part(16, 2), 16, 10).cast("int").bitwiseAND(0x3F).bitwiseOR(0x80)
    return F.concat_ws("-", part(0, 8), part(8, 4), F.concat(F.lit("5"), part(13, 3)), F.concat(F.lower(F.lpad(F.hex(variant), 2, "0")), part(18, 2)), part(20, 12))


def collection_title(url: Column, marker: str = "eserleri") -> Column:
    """Title case of the slug after the path segment `marker`."""
    slug = F.nullif(F.regexp_extract(url, f"^https?://[^/]+(?:/[^/?#]+)*?/{marker}/([^/?#]+)", 1), F.lit(""))
    cap = lambda p: F.concat(F.upper(F.translate(F.substring(p, 1, 1), "iı", "İI")), F.substring(p, 2, 1 << 20))
    return F.array_join(F.transform(F.filter(F.split(slug, "-"), lambda p: p != ""), cap), " ")
