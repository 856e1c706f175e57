"""URL policy: normal form, admission and robots rules."""

from __future__ import annotations

from dataclasses import dataclass
from urllib.parse import parse_qsl, urlencode, urljoin, urlsplit

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What the policy removes and blocks.
DROPPED_PARAMS = ("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "fbclid", "gclid", "tmpl", "print", "layout")
BLOCKED_PATHS = ("/privacy-policy", "/privacy", "/terms-of-use", "/terms", "/search", "/login", "/logout", "/feed", "/rss", "/bize-yazin")
BLOCKED_PREFIXES = ("/component/", "/tag/")
BLOCKED_PARAMS = ("page", "start", "fbclid", "gclid", "mc_cid", "mc_eid")
BLOCKED_TOKENS = r"(?i)(?:^|[/_.-])(?:click|banner|adclick|advert|share|print)(?:[/_.-]|$)"


@dataclass(frozen=True)
class SourcePolicy:
    allowed_domains: tuple = ()
    include_paths: tuple = ()
    exclude_paths: tuple = ()
    include_patterns: tuple = ()
    exclude_patterns: tuple = ()
    languages: tuple = ()
    max_depth: int = 3


_PARTS = r"^\s*([hH][tT][tT][pP][sS]?)://(?:[^/?#@]*@)?([^/?#:]+)(?::(\d+))?([^?#]*)(?:\?([^#]*))?"


def _part(url: Column, k: int) -> Column:
    return F.regexp_extract(url, _PARTS, k)


def normalize_url(url: Column) -> Column:
    """Absolute http(s) URLs without fragment, user, tracking parameters,
    default port and trailing slash; others are null."""
    scheme, host, port, path, query = F.lower(_part(url, 1)), F.lower(_part(url, 2)), _part(url, 3), _part(url, 4), _part(url, 5)
    port = F.when((port == "") | ((scheme == "http") & (port == "80")) | ((scheme == "https") & (port == "443")), "").otherwise(F.concat(F.lit(":"), port))
    path = F.regexp_replace(path, "/+$", "")
    path = F.when(path == "", "/").otherwise(path)
    kept = F.array_join(F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.substring_index(p, "=", 1).isin(*DROPPED_PARAMS)), "&")
    return F.when(scheme != "", F.concat(scheme, F.lit("://"), host, port, path, F.when(kept == "", "").otherwise(F.concat(F.lit("?"), kept))))


def resolve_urls(url: Column, base: Column) -> Column:
    """The same with relative resolution and encoded queries, in Python."""

    @F.pandas_udf("string")
    def run(u: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([resolve_url(x, y) for x, y in zip(u, b)], dtype="object")

    return run(url, base)


def resolve_url(url: str | None, base: str | None = None) -> str | None:
    try:
        p = urlsplit(urljoin(base, url.strip()) if base else url.strip())
        if p.scheme not in ("http", "https") or not p.hostname:
            return None
        port = p.port if p.port and (p.scheme, p.port) not in (("http", 80), ("https", 443)) else None
        query = urlencode([(k, v) for k, v in parse_qsl(p.query, keep_blank_values=True) if k not in DROPPED_PARAMS])
        host = p.hostname.encode("idna").decode() if not p.hostname.isascii() else p.hostname
        return f"{p.scheme}://{host}{f':{port}' if port else ''}{p.path.rstrip('/') or '/'}{'?' + query if query else ''}"
    except (ValueError, AttributeError, UnicodeError):
        return None


def path_of(url: Column) -> Column:
    return _part(url, 4)


def url_language(url: Column) -> Column:
    """The first path segment in lower case."""
    return F.nullif(F.lower(F.regexp_extract(_part(url, 4), r"^/*([^/]+)", 1)), F.lit(""))


def is_infrastructure(url: Column) -> Column:
    path = F.lower(F.regexp_replace(_part(url, 4), "(?<=.)/+$", ""))
    keys = F.transform(F.filter(F.split(_part(url, 5), "&"), lambda p: p != ""), lambda p: F.lower(F.substring_index(p, "=", 1)))
    bad = F.exists(keys, lambda k: k.isin(*BLOCKED_PARAMS) | F.startswith(k, F.lit("utm_")))
    starts = F.lit(False)
    for p in BLOCKED_PREFIXES:
        starts = starts | F.startswith(path, F.lit(p))
    return path.isin(*BLOCKED_PATHS) | starts | path.rlike(BLOCKED_TOKENS) | bad


def _any(values, test) -> Column:
    out = F.lit(False)
    for v in values:
        out = out | test(v)
    return out


def host_of(url: Column) -> Column:
    return _part(normalize_url(url), 2)


def is_admitted(url: Column, depth: Column, policy: SourcePolicy, known_domain: Column | None = None) -> Column:
    """Whether the policy lets a crawl fetch the address. `known_domain` stands
    for the policy's list of domains where these are a table to join, by
    `host_of`, and not a short list."""
    own = normalize_url(url)
    path, language = _part(own, 4), url_language(own)
    domain = known_domain if known_domain is not None else _part(own, 2).isin(*[d.lower() for d in policy.allowed_domains])
    ok = own.isNotNull() & (depth <= policy.max_depth) & domain & ~is_infrastructure(own)
    if policy.include_paths:
        ok = ok & _any(policy.include_paths, lambda p: F.startswith(path, F.lit(p)))
    ok = ok & ~_any(policy.exclude_paths, lambda p: F.startswith(path, F.lit(p)))
    if policy.include_patterns:
        ok = ok & _any(policy.include_patterns, own.rlike)
    ok = ok & ~_any(policy.exclude_patterns, own.rlike)
    if policy.languages:
        ok = ok & (language.isNull() | language.isin(*policy.languages))
    return F.coalesce(ok, F.lit(False))


def rule_pattern(rule: Column) -> Column:
    """A robots rule as an anchored pattern: `*` is any run, a final `\\$` an end."""
    escaped = F.regexp_replace(rule, r"([.+?^${}()|\[\]\\])", r"\\$1")
    return F.concat(F.lit("^"), F.regexp_replace(F.replace(escaped, F.lit("*"), F.lit(".*")), r"\\\$$", r"\$"))


def robots_verdicts(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """urls (url, origin) with `allowed`: the longest matching Allow against
    the longest matching Disallow, ties allow. rules: (origin, kind, rule)."""
    hit = urls.select("url", "origin").distinct().join(rules.where("rule <> ''"), "origin").where(F.expr("true") & F.call_function("rlike", path_of(F.col("url")), rule_pattern(F.col("rule"))))
    best = hit.groupBy("url", "origin").agg(F.coalesce(F.max(F.when(F.col("kind") == "allow", F.length("rule"))), F.lit(0)).alias("a"), F.coalesce(F.max(F.when(F.col("kind") == "disallow", F.length("rule"))), F.lit(0)).alias("d"))
    return urls.join(best, ["url", "origin"], "left").withColumn("allowed", F.coalesce(F.col("a") >= F.col("d"), F.lit(True))).drop("a", "d")
