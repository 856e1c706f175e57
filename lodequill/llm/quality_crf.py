"""Document quality from a linear-chain conditional random field over lines.

Every non-empty line is labelled good or bad. Its potential adds a weight for
the bin of each of its own features and of each feature of the lines before and
after it; transitions tie neighbouring labels. A document's quality is the mean
of its lines' forward-backward marginals weighted by their lengths, calibrated
by a logistic curve on labelled rows that the field wasn't trained on.

Training: a bounded sample of about `max_docs` labelled documents (a documented
bound, chosen by a hash of doc_id), whose lines take the document's label. Only
features of the sample reach the driver. Scoring reads every text whole.

Defined results: a text that is null or has only empty lines scores the share
of label 1 in the sample; without any labelled row every text scores 0.5. A
doc_id with several labels takes their mean, rounded up from 0.5; null labels
are none. Rows are independent: repeated rows and ties score alike, a null
doc_id is neither learned from nor held out. An empty table gives an empty
result; extra columns are ignored by `score` and carried by `good_rows`.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_limits, slices, utf8
from .language_id import held_out
from .shingles import word_hashes

MAX_DOCS, THRESHOLD, BINS = 4000, 0.3, 8
NAMES = "bytes letters upper digits spaces symbols shouts pipes stops word_bytes repeats distinct twice ended capital words runs".split()
SCHEMA = "doc_id long, held_out boolean, score double, predicted int"


def _flags(chars: bytes) -> np.ndarray:
    t = np.zeros(256, np.uint8)
    t[list(chars)] = 1
    return t


_UPPER = _flags(bytes(range(65, 91)))
_CLASSES = [_UPPER | _flags(bytes(range(97, 123))) | _flags(bytes(range(128, 256))), _UPPER, _flags(b"0123456789"), _flags(b" \t\r\x0b\x0c"), _flags(b"#$%&*@^~|\\<>{}[]=+_/"), _flags(b"!?"), _flags(b"|"), _flags(b".,;:")]
_END = _flags(b".!?:;\"')")


def line_features(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features and lengths of the non-empty lines of texts, and where each
    text's lines start among them (texts + 1)."""
    n = len(raw)
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    text = raw != 10
    starts = np.flatnonzero(text & (edge[:-1] | np.concatenate([[True], ~text[:-1]]))) if n else np.zeros(0, np.int64)
    ends = np.flatnonzero(text & (edge[1:] | np.concatenate([~text[1:], [True]]))) + 1 if n else starts
    at = np.searchsorted(starts, offs)
    size = ends - starts
    f = np.zeros((len(starts), len(NAMES)))
    if not len(starts):
        return f, size, at
    cuts = np.stack([starts, ends], 1).ravel()
    padded = np.append(raw, np.uint8(10))
    total = lambda x: np.add.reduceat(x, cuts, dtype=np.int64)[::2]
    counts = [total(c[padded]) for c in _CLASSES]
    letters = np.maximum(counts[0], 1)
    words, first = word_hashes(raw, np.concatenate([starts, [n]]))
    n_words = np.diff(first)
    line_of = np.repeat(np.arange(len(starts)), n_words)
    same = np.zeros(len(words), bool)
    same[1:] = (words[1:] == words[:-1]) & (line_of[1:] == line_of[:-1])
    keyed = np.sort((line_of.astype(np.uint64) << np.uint64(40)) | (words >> np.uint64(24)))
    fresh = np.ones(len(keyed), bool)
    fresh[1:] = keyed[1:] != keyed[:-1]
    distinct = np.bincount((keyed[fresh] >> np.uint64(40)).astype(np.int64), minlength=len(starts))
    sums = np.concatenate([[0], np.cumsum(words, dtype=np.uint64)]).astype(np.uint64)
    whole = (sums[first[1:]] - sums[first[:-1]]) >> np.uint64(24)
    doc_of = np.searchsorted(at, np.arange(len(starts)), "right") - 1
    key = (doc_of.astype(np.uint64) << np.uint64(40)) | whole
    _, inv, times = np.unique(key, return_inverse=True, return_counts=True)
    runs = _CLASSES[4][padded]
    runs[1:] &= padded[1:] == padded[:-1]
    runs[0] = 0
    f[:, 0] = np.log1p(size)
    f[:, 1] = counts[0] / size
    f[:, 2] = counts[1] / letters
    for i, k in enumerate((2, 3, 4, 5, 6, 7)):
        f[:, 3 + i] = counts[k] / size
    f[:, 9] = size / np.maximum(n_words, 1)
    f[:, 10] = np.bincount(line_of, same, len(starts)) / np.maximum(n_words, 1)
    f[:, 11] = distinct / np.maximum(n_words, 1)
    f[:, 12] = times[inv] > 1
    f[:, 13] = _END[raw[ends - 1]]
    f[:, 14] = _UPPER[raw[starts]] | (raw[starts] >= 0xC3)
    f[:, 15] = np.log1p(n_words)
    f[:, 16] = total(runs) / size
    return f, size, at


class Field:
    """Weights of the field and of the curve that calibrates it."""

    def __init__(self, edges: list[np.ndarray]):
        self.edges = edges
        self.w = np.zeros((3, len(edges), BINS))  # own, line before, line after
        self.stay = np.zeros((2, 2))
        self.curve, self.prior = (1.0, 0.0), 0.5

    def bins(self, f: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, f[:, i], "right") for i, e in enumerate(self.edges)], 1)

    @staticmethod
    def neighbours(at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The lines before and after each line in its text, or -1."""
        before, after = np.arange(n) - 1, np.arange(n) + 1
        own = at[:-1] < at[1:]
        before[at[:-1][own]] = -1
        after[at[1:][own] - 1] = -1
        return before, after

    def emissions(self, b: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Log odds of good for each line without its label's neighbours."""
        cols = np.arange(b.shape[1])
        before, after = self.neighbours(at, len(b))
        part = [self.w[k][cols, b].sum(1) for k in range(3)]
        return part[0] + np.where(before >= 0, part[1][before], 0.0) + np.where(after >= 0, part[2][after], 0.0)

    def marginals(self, e: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """P(good) of each line, expected transitions, log partition of each
        text. All texts go forward and backward line by line together."""
        n = np.diff(at)
        order = np.argsort(-n, kind="stable")
        n, first = n[order], at[:-1][order]
        score = np.stack([np.zeros(len(e)), e], 1)
        alpha, beta = np.zeros_like(score), np.zeros_like(score)
        steps = int(n[0]) if len(n) else 0
        active = np.searchsorted(-n, -np.arange(steps), "left") if steps else []
        for t in range(steps):
            i = first[: active[t]] + t
            alpha[i] = score[i] + (np.logaddexp(alpha[i - 1, 0][:, None] + self.stay[0], alpha[i - 1, 1][:, None] + self.stay[1]) if t else 0.0)
        pair = np.zeros((2, 2))
        z = np.zeros(len(at) - 1)
        some = n > 0
        last = first[some] + n[some] - 1
        z[order[some]] = np.logaddexp(alpha[last, 0], alpha[last, 1])
        for t in range(steps - 2, -1, -1):
            i = first[: active[t + 1]] + t
            out = self.stay[None] + (score[i + 1] + beta[i + 1])[:, None, :]
            beta[i] = np.logaddexp(out[:, :, 0], out[:, :, 1])
            pair += np.exp(alpha[i][:, :, None] + out - z[order[: active[t + 1]]][:, None, None]).sum(0)
        both = alpha + beta
        return 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -500, 500))), pair, z

    def train(self, b: np.ndarray, at: np.ndarray, label: np.ndarray, rounds: int = 120, rate: float = 0.1, ridge: float = 1e-3) -> None:
        """Maximise the penalised mean log-likelihood of the lines' labels."""
        n = np.diff(at)
        y = np.repeat(label, n).astype(float)
        before, after = self.neighbours(at, len(b))
        want = np.zeros((2, 2))
        for k in (0, 1):
            want[k, k] = np.maximum(n - 1, 0)[label == k].sum()
        at_bin = b + np.arange(b.shape[1]) * BINS
        shape, scale = self.w.shape, 1.0 / max(1, len(b))
        m, v = np.zeros(self.w.size + 4), np.zeros(self.w.size + 4)
        for step in range(1, rounds + 1):
            p, pair, _ = self.marginals(self.emissions(b, at), at)
            miss = y - p
            grad = np.zeros(shape)
            for k, rows in enumerate((None, before, after)):
                ok = slice(None) if rows is None else rows >= 0
                src = at_bin if rows is None else at_bin[rows[ok]]
                grad[k] = np.bincount(src.ravel(), np.repeat(miss[ok], b.shape[1]), shape[1] * BINS).reshape(shape[1:])
            g = np.concatenate([grad.ravel(), (want - pair).ravel()]) * scale - ridge * np.concatenate([self.w.ravel(), self.stay.ravel()])
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
            self.w += move[:-4].reshape(shape)
            self.stay += move[-4:].reshape(2, 2)

    def raw_scores(self, f: np.ndarray, size: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Length-weighted mean marginal of each text; NaN without lines."""
        p, _, _ = self.marginals(self.emissions(self.bins(f), at), at)
        weight = np.concatenate([[0.0], np.cumsum(size * p)])
        length = np.concatenate([[0], np.cumsum(size)])
        total = length[at[1:]] - length[at[:-1]]
        return np.where(total > 0, (weight[at[1:]] - weight[at[:-1]]) / np.maximum(total, 1), np.nan)

    def calibrate(self, q: np.ndarray, label: np.ndarray) -> None:
        ok = ~np.isnan(q)
        x, y = _logit(q[ok]), label[ok].astype(float)
        a, b = 1.0, 0.0
        for _ in range(50):  # Newton steps on the penalised logistic loss
            p = 1 / (1 + np.exp(-(a * x + b)))
            s = np.maximum(p * (1 - p), 1e-6)
            g = np.array([((y - p) * x).sum() - (a - 1), (y - p).sum() - b])
            h = np.array([[(s * x * x).sum() + 1, (s * x).sum()], [(s * x).sum(), s.sum() + 1]])
            d = np.clip(np.linalg.solve(h, g), -1, 1)
            a, b = max(0.05, a + d[0]), b + d[1]
        self.curve = a, b

    def scores(self, q: np.ndarray) -> np.ndarray:
        a, b = self.curve
        return np.where(np.isnan(q), self.prior, 1 / (1 + np.exp(-(a * _logit(np.nan_to_num(q, nan=0.5)) + b))))


def _logit(q: np.ndarray) -> np.ndarray:
    q = np.clip(q, 1e-3, 1 - 1e-3)
    return np.log(q / (1 - q))


def fit(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS, mod: int = 5, part: int = 0) -> Field | None:
    arrow_limits(docs.sparkSession, 1000, 4)
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), mod, part)).groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("y"))
    count = known.count()
    if not count:
        return None
    dice = F.pmod(F.xxhash64("doc_id", F.lit("quality")), F.lit(1_000_000))
    sample = F.broadcast(known.where(dice < int(min(1.0, max_docs / count) * 1_000_000)))  # about max_docs rows

    def features(batches):
        for b in batches:
            raw, offs = utf8(b.column(1))
            f, size, at = line_features(raw, offs)
            pick = [slice(a, z) for a, z in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array([f[s].tobytes() for s in pick], pa.binary()), pa.array([size[s].astype(np.int64).tobytes() for s in pick], pa.binary())], ["doc_id", "y", "f", "n"])

    got = docs.select("doc_id", "text").join(sample, "doc_id").mapInArrow(features, "doc_id long, y int, f binary, n binary").toArrow()
    if not got.num_rows:
        return None
    rows = sorted(zip(got.column(0).to_pylist(), got.column(1).to_pylist(), got.column(2).to_pylist(), got.column(3).to_pylist()))
    label = np.array([r[1] for r in rows])

    def stack(rows):
        f = np.frombuffer(b"".join(r[2] for r in rows)).reshape(-1, len(NAMES))
        size = np.frombuffer(b"".join(r[3] for r in rows), np.int64)
        return f, size, np.concatenate([[0], np.cumsum([len(r[3]) // 8 for r in rows])])

    tune = np.arange(len(rows)) % 4 == 3
    if len(set(label[tune])) < 2:
        tune[:] = False
    learn = [r for r, t in zip(rows, tune) if not t]
    f, size, at = stack(learn)
    if not len(f):
        return None
    field = Field([np.unique(np.quantile(f[:, i], np.linspace(0, 1, BINS + 1)[1:-1])) for i in range(len(NAMES))])
    # where most lines hold one value, other values still get bins of their own
    for i, e in enumerate(field.edges):
        rest = f[:, i][f[:, i] > e[-1]]
        if len(e) < BINS - 1 and len(rest):
            field.edges[i] = np.unique(np.concatenate([e, np.nextafter(e[-1:], np.inf), np.quantile(rest, np.linspace(0, 1, BINS - len(e))[1:-1])]))[: BINS - 1]
    field.train(field.bins(f), at, label[~tune])
    field.prior = float((label.sum() + 1) / (len(label) + 2))
    held = [r for r, t in zip(rows, tune) if t] or learn
    field.calibrate(field.raw_scores(*stack(held)), np.array([r[1] for r in held]))
    return field


def _scored(texts, field: Field | None) -> np.ndarray:
    raw, offs = utf8(texts)
    out = np.full(len(offs) - 1, 0.5)
    if field is not None:
        for i, j in slices(np.diff(offs), 1 << 20):
            own = offs[i : j + 1]
            out[i:j] = field.scores(field.raw_scores(*line_features(raw[own[0] : own[-1]], own - own[0])))
    return out


def score(docs: DataFrame, field: Field | None, threshold: float = THRESHOLD, mod: int = 5, part: int = 0) -> DataFrame:
    """doc_id, held_out, score, predicted for each row."""
    spark = docs.sparkSession
    arrow_limits(spark, 1000, 4)
    shared = spark.sparkContext.broadcast(field)

    def run(batches):
        for b in batches:
            s = _scored(b.column(2), shared.value)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(s), pa.array((s >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id"), mod, part).alias("held_out"), "text").mapInArrow(run, SCHEMA)


def good_rows(docs: DataFrame, field: Field | None, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, with all their columns, that are predicted good."""
    spark = docs.sparkSession
    arrow_limits(spark, 1000, 4)
    shared, at = spark.sparkContext.broadcast(field), docs.columns.index("text")

    def run(batches):
        for b in batches:
            yield b.filter(pa.array(_scored(b.column(at), shared.value) >= threshold))

    return docs.mapInArrow(run, docs.schema)
