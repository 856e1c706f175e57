"""Token counts with overlap resynchronisation.

A document of more than `chunk` characters is encoded in overlapping chunks.
Ids carry character offsets. Two neighbouring chunks are spliced inside their
overlap at a position where both have a boundary and the vocabulary proves it
stable: the characters on its two sides stand side by side in no piece, so no
symbol crosses it in either chunk or in the whole text. Where an overlap has no
such position it is widened, up to the rest of the document. Memory for
encoding is bounded by the chunk, not the document.

Smaller documents add up the counts of their marked words from a table of
distinct words where the vocabulary proves that pieces don't cross markers,
and are encoded whole otherwise.

Defined results: a null or empty text has 0 bytes and 0 tokens. Rows are
independent: ties, repeated rows and null doc_ids pass through. Extra columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_limits
from .pieces import Model, WordTable, default_model, marked_words, model

CHUNK, OVERLAP, LIMIT = 32_768, 256, 4096
SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def _encoded(m: Model, text: str, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of text[lo:hi] and the position in text after each id."""
    ids = np.array(m.sp.encode(text[lo:hi]), np.int64)
    return ids, lo - 1 + np.cumsum(m.width[ids])


def _common(m: Model, text: str, ends: np.ndarray, later: np.ndarray, lo: int, hi: int) -> int | None:
    """The stable position nearest the middle of (lo, hi) where both chunks
    have a boundary; that two chunks cut it alike is checked, not assumed."""
    both = np.intersect1d(ends, later)
    both = both[(both > lo) & (both < hi)]
    for p in both[np.argsort(np.abs(both - (lo + hi) // 2), kind="stable")].tolist():
        if m.stable(text[p - 1], text[p]):
            return p
    return None


def splice_ids(m: Model, text: str, chunk: int = CHUNK, overlap: int = OVERLAP):
    """Yield the ids of a whole text in pieces of about one chunk."""
    n, hi = len(text), chunk
    if m.sp.unk_id() >= 0 and not m.plain or n <= chunk:
        yield np.array(m.sp.encode(text), np.int64)
        return
    ids, ends = _encoded(m, text, 0, hi)
    start = 0  # what was spliced already ends here
    while hi < n:
        wide, p = overlap, None
        while p is None:
            lo, to = max(start, hi - wide), min(n, hi - min(wide, hi - start) + chunk + wide)
            to = max(to, min(n, hi + 1))
            after, later = _encoded(m, text, lo, to)
            p = _common(m, text, ends, later, lo, hi)
            if p is None and lo <= start:
                break
            wide *= 2
        if p is None:  # no stable position since the last splice: one longer chunk
            hi = min(n, hi + max(chunk, hi - start))
            ids, ends = _encoded(m, text, max(0, start - 1), hi)
            continue
        first = np.searchsorted(ends, start, "right") if start else 0
        yield ids[first : np.searchsorted(ends, p, "right")]
        ids, ends, hi, start = after, later, to, p
    yield ids[np.searchsorted(ends, start, "right") if start else 0 :]


def count_tokens(docs: DataFrame, model_path: str | None = None, limit: int = LIMIT, chunk: int = CHUNK, overlap: int = OVERLAP, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for each row."""
    path = model_path or default_model()
    arrow_limits(docs.sparkSession, 1000, 4)

    def json_counts(texts):
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        return lambda xs: [len(e.ids) for e in t.encode_batch(xs, add_special_tokens=False)]

    def run(batches):
        if path.endswith(".json"):
            many = json_counts(None)
        else:
            m = model(path)
            words = WordTable(m, len)

            def many(texts):
                out = [0] * len(texts)
                small = [k for k, t in enumerate(texts) if len(t) <= chunk]
                for k in set(range(len(texts))) - set(small):
                    out[k] = sum(len(x) for x in splice_ids(m, texts[k], chunk, overlap))
                if not m.marks_split:
                    for k in small:
                        out[k] = len(m.sp.encode(texts[k]))
                    return out
                for a in range(0, len(small), 256):
                    part = small[a : a + 256]
                    split = [marked_words(texts[k]) for k in part]
                    known = words.fill(set().union(*split))
                    for k, s in zip(part, split):
                        out[k] = sum([known[w] for w in s])
                return out

        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            n = np.array(many(texts), np.int64)
            size = np.array([len(t) if t.isascii() else len(t.encode()) for t in texts], np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array(size), pa.array(n), pa.array(n > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, SCHEMA)
