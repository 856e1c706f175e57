"""Language identification with interpolated Kneser-Ney character models.

Texts are read as symbols: lower-cased letters and marks, and one space for any
run of other characters. For each language the training sample gives counts of
n-grams of `ORDER` symbols; lower orders use continuation counts, and every
order is interpolated with the one below. The n-grams of all languages share
one sorted array of 64-bit hashes for each order, with one column of log
probabilities for each language, so a text is looked up once and not once a
language. An index over the leading bits of the hashes gives the place in the
sorted array. An n-gram that no language has seen falls back to the order
below with the languages' backoff weights.

The language with the lowest cross-entropy a symbol is chosen. The temperature
of the score and the entropy beyond which a text is rejected are fitted on a
part of the sample that isn't counted.

Sample: at most about `max_docs` documents a language (a documented bound on
what the classifier is fitted on; chosen by a hash of doc_id). Scoring reads
every text whole.

Defined results: null texts and texts without a letter are `und` with score 0;
without any labelled row all texts are. Ties go to the first language in code
point order. Rows are independent, repeated rows get equal results; a row with
a null doc_id is neither learned from nor held out. Rejection is a column of
its own (`rejected`) and, with `reject=True`, makes the language `und`. An
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_limits, mix64

ORDER, BITS, MAX_DOCS = 5, 12, 1000
SYMBOLS = 1 << BITS
SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double, entropy double, rejected boolean"


@lru_cache(maxsize=1)
def _symbols() -> tuple[np.ndarray, np.ndarray]:
    """Symbol and letter flag of each code point; 0 is what isn't text."""
    sym, letter = np.zeros(0x110000, np.uint16), np.zeros(0x110000, bool)
    for c in range(0x110000):
        kind = unicodedata.category(ch := chr(c))[0]
        if kind in "LM":
            low = ch.lower()
            v = ord(low) if len(low) == 1 else c
            sym[c] = v if v < 3072 else 3072 + v % 1024
            letter[c] = kind == "L"
    return sym, letter


def read(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All symbols with ORDER - 1 spaces before each text, each text's start
    among them (texts + 1), and whether it has a letter."""
    sym, letter = _symbols()
    pad = "\0" * (ORDER - 1)
    code = np.frombuffer("".join(pad + t for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    at = np.concatenate([[0], np.cumsum([len(t) + ORDER - 1 for t in texts])])
    s = sym[code]
    keep = s != 0
    keep[1:] |= s[:-1] != 0
    for j in range(ORDER - 1):
        keep[at[:-1] + j] = True
    # the run after the padding is already a space
    first = at[:-1] + ORDER - 1
    first = first[first < at[1:]]
    keep[first] = s[first] != 0
    marks = np.concatenate([[0], np.cumsum(letter[code])])
    kept = np.concatenate([[0], np.cumsum(keep)])
    return s[keep], kept[at], marks[at[1:]] > marks[at[:-1]]


def grams(s: np.ndarray) -> np.ndarray:
    """The n-gram ending at each symbol, packed."""
    x = s.astype(np.uint64)
    out = x.copy()
    for j in range(1, ORDER):
        out[j:] |= x[:-j] << np.uint64(BITS * j)
    return out


class Table:
    """A sorted hash array with rows of values."""

    def __init__(self, keys: np.ndarray, rows: np.ndarray):
        h = mix64(keys)
        order = np.argsort(h)
        self.h, self.rows = np.append(h[order], np.uint64(0)), rows[order]
        self.bits = max(1, int(len(keys)).bit_length())
        edges = np.arange((1 << self.bits) + 1, dtype=np.float64) * 2.0 ** (64 - self.bits)
        self.start = np.searchsorted(h[order], edges[:-1].astype(np.uint64)).astype(np.int32)
        self.start = np.append(self.start, np.int32(len(keys)))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key, or -1."""
        h = mix64(keys)
        bucket = (h >> np.uint64(64 - self.bits)).astype(np.int64)
        at = self.start[bucket].astype(np.int64)
        end = self.start[bucket + 1]
        out = np.where((self.h[at] == h) & (at < end), at, -1)
        left = np.flatnonzero((out < 0) & (at + 1 < end))
        while len(left):
            at[left] += 1
            hit = self.h[at[left]] == h[left]
            out[left[hit]] = at[left[hit]]
            left = left[~hit & (at[left] + 1 < end[left])]
        return out


class Model:
    def __init__(self, langs: list[str], lang: np.ndarray, keys: np.ndarray, counts: np.ndarray):
        """lang, keys, counts: the n-grams of the highest order."""
        self.langs = langs
        n_langs = len(langs)
        union, inv = np.unique(keys, return_inverse=True)
        c = np.zeros((len(union), n_langs))
        np.add.at(c, (inv, lang), counts)
        levels = [(union, c)]
        for n in range(ORDER - 1, 0, -1):  # continuation counts
            low, inv = np.unique(levels[-1][0] & np.uint64((1 << BITS * n) - 1), return_inverse=True)
            c = np.zeros((len(low), n_langs))
            np.add.at(c, inv, (levels[-1][1] > 0).astype(float))
            levels.append((low, c))
        below = None
        self.tables, self.backoff = [], []
        for n, (keys_n, c) in enumerate(reversed(levels), 1):
            ctx, inv = np.unique(keys_n >> np.uint64(BITS), return_inverse=True)
            total, kinds = np.zeros((len(ctx), n_langs)), np.zeros((len(ctx), n_langs))
            np.add.at(total, inv, c)
            np.add.at(kinds, inv, (c > 0).astype(float))
            n1, n2 = (c == 1).sum(0), (c == 2).sum(0)
            d = np.where(n1 > 0, n1 / np.maximum(n1 + 2 * n2, 1), 0.5).clip(0.1, 0.95)
            lam = np.where(total > 0, d * kinds / np.maximum(total, 1), 1.0)
            lower = 1.0 / SYMBOLS if below is None else below[1][np.searchsorted(below[0], keys_n & np.uint64((1 << BITS * (n - 1)) - 1))]
            p = np.maximum(c - d, 0) / np.maximum(total, 1)[inv] + lam[inv] * lower
            below = keys_n, p
            self.tables.append(Table(keys_n, np.log(p).astype(np.float32)))
            self.backoff.append(Table(ctx, np.log(lam).astype(np.float32)))
        self.temperature, self.worst = 1.0, np.inf

    def log_p(self, g: np.ndarray, n: int = ORDER) -> np.ndarray:
        """Log probability of each n-gram's last symbol, a column a language."""
        if n == 0:
            return np.full((len(g), len(self.langs)), -np.log(SYMBOLS), np.float32)
        at = self.tables[n - 1].find(g)
        out = self.tables[n - 1].rows[at]
        miss = np.flatnonzero(at < 0)
        if len(miss):
            own = g[miss]
            low = self.log_p(own & np.uint64((1 << BITS * (n - 1)) - 1), n - 1)
            ctx = self.backoff[n - 1].find(own >> np.uint64(BITS))
            low[ctx >= 0] += self.backoff[n - 1].rows[ctx[ctx >= 0]]
            out[miss] = low
        return out

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cross-entropy a symbol in each language, symbols, has a letter."""
        s, at, letter = read(texts)
        g = grams(s)
        out, size = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts), np.int64)
        step = max(1 << 14, (1 << 21) // len(self.langs))
        first, last = at[:-1] + ORDER - 1, at[1:]
        size[:] = last - first
        for a in range(0, len(g), step):
            b = min(len(g), a + step)
            lp = self.log_p(g[a:b])
            i, j = np.searchsorted(last, a, "right"), np.searchsorted(first, b, "left")
            lo, hi = np.maximum(first[i:j], a) - a, np.minimum(last[i:j], b) - a
            some = np.flatnonzero(hi > lo)
            if len(some):
                edges = np.stack([lo[some], hi[some]], 1).ravel()
                sums = np.add.reduceat(np.concatenate([lp, np.zeros((1, lp.shape[1]), lp.dtype)]).astype(np.float64), edges)[::2]
                out[i + some] -= sums
        return out / np.maximum(size, 1)[:, None], size, letter

    def calibrate(self, h: np.ndarray, size: np.ndarray, truth: np.ndarray) -> None:
        if not len(truth):
            return
        loss = {t: -np.log(np.maximum(1e-12, self.scores(h, size, t)[np.arange(len(truth)), truth])).mean() for t in (0.05, 0.1, 0.2, 0.3, 0.5, 0.7, 1.0)}
        self.temperature = min(loss, key=lambda t: (loss[t], t))
        own = h[np.arange(len(truth)), truth]
        self.worst = float(np.quantile(own, 0.99)) * 1.25

    def scores(self, h: np.ndarray, size: np.ndarray, temperature: float | None = None) -> np.ndarray:
        """Shares of the languages; long texts count as 200 symbols."""
        x = -h * np.minimum(size, 200)[:, None] * (temperature or self.temperature)
        x = np.exp(x - x.max(1, keepdims=True))
        return x / x.sum(1, keepdims=True)


def held_out(doc_id: Column, mod: int, part: int) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % mod == part, F.lit(False))


def fit(docs: DataFrame, max_docs: int = MAX_DOCS, mod: int = 4, part: int = 2) -> Model | None:
    """A model of the labelled rows that aren't held out."""
    arrow_limits(docs.sparkSession, 1000, 4)
    rows = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"), mod, part))
    counts = rows.groupBy("lang").count()
    share = {r["lang"]: max_docs / r["count"] for r in counts.collect()}  # one row a language
    if not share:
        return None
    langs = sorted(share, key=lambda x: x.encode())
    code = {x: i for i, x in enumerate(langs)}
    cut_at = F.create_map(*[y for x in langs for y in (F.lit(x), F.lit(int(min(1.0, share[x]) * 1_000_000)))])[F.col("lang")]
    dice = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1_000_000))
    sample = rows.where(dice < cut_at).select("lang", "text", (F.pmod(F.xxhash64("doc_id", F.lit("tune")), F.lit(10)) == 0).alias("tune"))

    def count(batches):
        for b in batches:
            by: dict = {}
            for x, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                by.setdefault(x, []).append(t)
            for x, texts in by.items():
                s, at, _ = read(texts)
                real = np.ones(len(s), bool)
                for j in range(ORDER - 1):
                    real[at[:-1] + j] = False
                k, c = np.unique(grams(s)[real], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), code[x], np.int32)), pa.array(k.view(np.int64)), pa.array(c.astype(np.int64))], ["lang", "gram", "n"])

    found = sample.where("NOT tune").select("lang", "text").mapInArrow(count, "lang int, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    if not found.num_rows:
        return None
    got = [found.column(i).to_numpy() for i in range(3)]
    order = np.lexsort((got[1], got[0]))
    m = Model(langs, got[0][order], got[1][order].view(np.uint64), got[2][order])
    shared = docs.sparkSession.sparkContext.broadcast(m)

    def tune(batches):
        for b in batches:
            texts = b.column(1).to_pylist()
            h, size, letter = shared.value.entropies(texts)
            yield pa.RecordBatch.from_arrays([pa.array([code[x] for x in b.column(0).to_pylist()], pa.int32()), pa.array(list(h), pa.list_(pa.float64())), pa.array(np.where(letter, size, 0))], ["lang", "h", "size"])

    tuned = sample.where("tune").select("lang", "text").mapInArrow(tune, "lang int, h array<double>, size long").where("size > 0").toArrow()
    if tuned.num_rows:
        m.calibrate(np.array(tuned.column(1).to_pylist()), tuned.column(2).to_numpy(), tuned.column(0).to_numpy())
    return m


def identify(docs: DataFrame, m: Model | None, mod: int = 4, part: int = 2, reject: bool = False) -> DataFrame:
    """doc_id, held_out, lang_pred, score, entropy, rejected for each row."""
    spark = docs.sparkSession
    arrow_limits(spark, 1000, 4)
    shared = spark.sparkContext.broadcast(m)

    def run(batches):
        m = shared.value
        for b in batches:
            texts = [t or "" for t in b.column(2).to_pylist()]
            n = len(texts)
            lang, score, entropy, bad = ["und"] * n, np.zeros(n), np.zeros(n), np.zeros(n, bool)
            if m is not None:
                h, size, letter = m.entropies(texts)
                best, share = h.argmin(1), m.scores(h, size)
                entropy = np.where(letter, h[np.arange(n), best], 0.0)
                score = np.where(letter, share[np.arange(n), best], 0.0)
                bad = letter & (entropy > m.worst)
                lang = [m.langs[k] if ok and not (reject and r) else "und" for k, ok, r in zip(best, letter, bad)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(lang, pa.string()), pa.array(score), pa.array(entropy), pa.array(bad)], ["doc_id", "held_out", "lang_pred", "score", "entropy", "rejected"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id"), mod, part).alias("held_out"), "text")
    return rows.mapInArrow(run, SCHEMA)
