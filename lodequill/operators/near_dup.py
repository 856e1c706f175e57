"""SimHash and near-duplicate pages."""

from __future__ import annotations

import hashlib
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.readers import bounded
from ..sources.sinks import materialize

BLOCKS = (11, 11, 11, 11, 10, 10)  # bits of a SimHash, from the low end


def _counted(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Row, code and count of each row's distinct tokens, sorted by row, and the
    tokens of the codes."""
    words = lists.flatten().dictionary_encode()
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    width = max(1, len(words.dictionary))
    pairs, n = np.unique(np.repeat(np.arange(len(lists)), lengths) * width + words.indices.to_numpy(zero_copy_only=False), return_counts=True)
    return pairs // width, pairs % width, n, words.dictionary


def token_frequency(docs: DataFrame, tokens: Column, key: str) -> DataFrame:
    """(key, token, n) of each row. A row's tokens are at hand, so they are
    counted inside the row and nothing is shuffled."""
    kind = dict(docs.dtypes)[key]

    def run(batches):
        for b in batches:
            row, code, n, words = _counted(b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row)), words.take(pa.array(code)).cast(pa.string()), pa.array(n.astype(np.int64))], [key, "token", "n"])

    return bounded(docs).select(key, tokens.alias("tokens")).mapInArrow(run, f"`{key}` {kind}, token string, n long")


@lru_cache(maxsize=1 << 16)
def _bits(token: str) -> bytes:
    return hashlib.sha256(token.encode()).digest()[:8]


def _votes(lists: pa.Array) -> np.ndarray:
    """The signed 64 bits of each token list."""
    out = np.full(len(lists), -1, np.int64)
    row, code, n, words = _counted(lists)
    if not len(row):
        return out
    bits = np.frombuffer(b"".join(map(_bits, words.to_pylist())), np.uint8).reshape(-1, 8)
    starts = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
    ends = np.append(starts[1:], len(row))
    for a, z in zip(starts.tolist(), ends.tolist()):
        votes = n[a:z] @ np.unpackbits(bits[code[a:z]], axis=1)
        out[row[a]] = np.packbits(2 * votes >= n[a:z].sum()).view(">i8")[0]
    return out


def simhash_of(tokens: Column) -> Column:
    """Each distinct token votes with its frequency on 64 bits of its SHA-256;
    ties and texts without tokens set a bit. Votes are counted inside the row."""

    @F.arrow_udf("long")
    def run(rows: pa.Array) -> pa.Array:
        return pa.array(_votes(rows))

    return run(tokens)


def simhash(docs: DataFrame, tokens: Column, key: str) -> DataFrame:
    """(key, simhash) of each row."""
    return bounded(docs).select(key, simhash_of(tokens).alias("simhash"))


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def simhash_hex(x: Column) -> Column:
    return F.lower(F.lpad(F.hex(x), 16, "0"))


def classes(hashed: DataFrame, key: str) -> DataFrame:
    """(simhash, id): distinct values with their smallest key. Rows with equal
    values are one class, so a hot value is one row here."""
    return hashed.groupBy("simhash").agg(F.min(key).alias("id"))


def members(hashed: DataFrame, key: str) -> DataFrame:
    """(key, class_id) of each row: the class of its value."""
    return hashed.select(key, "simhash").join(classes(hashed, key), "simhash").select(key, F.col("id").alias("class_id"))


def near_pairs(hashed: DataFrame, key: str, distance: int = 3) -> DataFrame:
    """Pairs (a, b, distance) of classes at most `distance` <= 3 apart; `members`
    has the rows of each. Of six blocks of bits at least three agree in such a
    pair, so each value is filed under all 20 combinations of three blocks: keys
    of 32 or 33 bits, which few other values share. A pair counts under the first
    key that it shares. Both sides are shuffled: the estimate of one side's size
    knows nothing of the 20 keys, and would have it broadcast from the driver."""
    if not 0 <= distance <= len(BLOCKS) - 3:
        raise ValueError(f"the blocks find distances up to {len(BLOCKS) - 3}")
    starts = np.concatenate([[0], np.cumsum(BLOCKS)[:-1]]).tolist()
    masks = [sum(((1 << BLOCKS[i]) - 1) << starts[i] for i in three) for three in combinations(range(len(BLOCKS)), 3)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keys = F.posexplode(F.array(*[F.col("simhash").bitwiseAND(F.lit(m).cast("long")) for m in signed])).alias("table", "value")
    rows = materialize(classes(hashed, key)).select("id", "simhash", keys)  # both sides read it
    x, y = rows.alias("x"), rows.alias("y")
    d = hamming(F.col("x.simhash"), F.col("y.simhash"))
    apart = F.col("x.simhash").bitwiseXOR(F.col("y.simhash"))
    first = F.array_position(F.array(*[apart.bitwiseAND(F.lit(m).cast("long")) == 0 for m in signed]), True) - 1
    close = (F.col("x.table") == F.col("y.table")) & (F.col("x.value") == F.col("y.value")) & (F.col("x.id") < F.col("y.id")) & (d <= distance) & (F.col("x.table") == first)
    return x.join(y.hint("merge"), close).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"), d.alias("distance"))


def exact_groups(hashed: DataFrame, key: str, value: str) -> DataFrame:
    """Values that more than one row has, with how many and the first key."""
    return hashed.groupBy(value).agg(F.count(F.lit(1)).alias("copies"), F.min(key).alias("first_id")).where("copies > 1")


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of links (a, b): every round takes the smallest label
    among the neighbours and then jumps to that label's label."""
    both = materialize(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    labels = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")).withColumnRenamed("a", "id")
    while True:
        labels = materialize(labels)
        near = both.join(labels.withColumnRenamed("id", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        low = labels.join(near.withColumnRenamed("a", "id"), "id").select("id", "label", F.least("label", "near").alias("low"))
        up = labels.select(F.col("id").alias("low"), F.col("label").alias("higher"))
        new = materialize(low.join(up, "low", "left").select("id", "label", F.least("low", "higher").alias("new")))
        if new.where("new <> label").isEmpty():
            return new.select("id", F.col("label").alias("component"))
        labels = new.select("id", F.col("new").alias("label"))


def resolve(decisions: DataFrame, distance: int = 3) -> DataFrame:
    """Replay arrivals: decisions (page_id, url, indexable, quality_score,
    text_hash, simhash, fetched_at) gain status and duplicate_of.

    An arrival that matches a selected page (same text or close SimHash, the
    first selected one) loses against an equal or higher score and replaces a
    lower one. Order matters and similarity isn't transitive, so arrivals are
    replayed in the order (fetched_at, url), one task per component of
    candidates and only for components of more than one page. Arrivals stream
    past the selected pages of their component, which are all that is held."""
    decisions = materialize(decisions)  # measured once, read several times
    live = decisions.where("indexable")
    by_text = live.groupBy("text_hash").agg(F.min("page_id").alias("b")).join(live.select("text_hash", F.col("page_id").alias("a")), "text_hash").where("a <> b").select("a", "b")
    by_hash = live.groupBy("simhash").agg(F.min("page_id").alias("b")).join(live.select("simhash", F.col("page_id").alias("a")), "simhash").where("a <> b").select("a", "b")
    links = by_text.union(by_hash).union(near_pairs(live, "page_id", distance).select("a", "b"))
    groups = components(links).withColumnRenamed("id", "page_id")

    kind = dict(decisions.dtypes)["page_id"]
    columns = ["component", "page_id", "url", "text_hash", "simhash", "quality_score"]

    def replay(frames):
        own, at = None, 0
        chosen: dict = {}  # of the component at hand, by URL: arrival, page, text hash, SimHash and score

        for f in frames:
            out = []
            for component, page, url, *measures in zip(*(f[c].tolist() for c in columns)):
                if component != own:
                    out += [(c[1], c[0], "indexed", None) for c in chosen.values()]
                    own, chosen = component, {}
                at += 1
                text, value, score = measures
                hit = next((u for u, c in chosen.items() if u != url and (c[2] == text or ((c[3] ^ value) & 0xFFFFFFFFFFFFFFFF).bit_count() <= distance)), None)
                if hit is not None and chosen[hit][4] >= score:
                    out.append((page, at, "duplicate", hit))
                    continue
                if url in chosen:  # the same address again takes its place, both stay
                    out.append((chosen[url][1], chosen[url][0], "indexed", None))
                chosen[url] = (at, page, *measures)
                if hit is not None:
                    out.append((chosen.pop(hit)[1], at, "replaced", url))
            yield pd.DataFrame(out, columns=["page_id", "at", "status", "duplicate_of"])
        yield pd.DataFrame([(c[1], c[0], "indexed", None) for c in chosen.values()], columns=["page_id", "at", "status", "duplicate_of"])

    order = [F.asc("component"), F.asc_nulls_last("fetched_at"), F.asc_nulls_last("url"), F.asc("page_id")]
    arrivals = live.join(groups, "page_id").repartition("component").sortWithinPartitions(*order).select(*columns)
    said = bounded(arrivals).mapInPandas(replay, f"page_id {kind}, at long, status string, duplicate_of string")
    last = F.max_by(F.struct("status", "duplicate_of"), "at").alias("last")  # a page_id that arrives again
    played = said.groupBy("page_id").agg(last).select("page_id", "last.*")
    first = F.when(~F.col("indexable"), "skipped").otherwise(F.coalesce("status", F.lit("indexed")))
    return decisions.join(played, "page_id", "left").withColumn("status", first)
