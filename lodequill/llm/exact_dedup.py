"""Exact dedup by skew-safe combining.

Rows are combined three times, and full texts are compared each time because
the text is a grouping key beside its digest:

1. Locally: an input task combines its rows of one (digest, text) into one row,
   the map-side half of the first aggregation. Its salt is the task's number, so
   a task never sends one text twice.
2. Salted: the local rows of a hot digest are merged per (digest, salt, text),
   so that its copies are spread over `salts` tasks. A digest is hot if it has
   more than `hot` rows; the others need no salt, and are whole after this.
3. Globally: of a hot text at most `salts` winners meet, per (digest, text).

Which digests are hot is known from counts of bare digests. They are at most
rows / hot, broadcast while a count shows that they are few; beyond that every
digest is salted and goes through the third step. So a text crosses the network
once, unless it is hot, and a text that fills a third of all rows reaches a task
as one row an input task at most.

Defined results: a null text counts as empty; rows with equal texts form one
group whatever their other columns; the largest doc_id stays. Rows that repeat
both text and doc_id are one keeper and copies: exactly one of them is kept. A
null doc_id loses to any other; a group of nulls keeps one row with a null
keep_id. An empty table gives an empty result. Extra columns, maps among them,
are ignored by `exact_groups` and carried unchanged by `exact_keepers`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_KEYS, HOT, cut, hot_join, row_hash

SALTS = 64


def _digested(rows: DataFrame, text: str) -> DataFrame:
    return rows.withColumn("digest", F.unhex(F.sha2(F.col(text).cast("binary"), 256)))


def _salted(rows: DataFrame, salts: int, hot: int, most: int = BROADCAST_KEYS) -> tuple[DataFrame, DataFrame | None]:
    """rows (digest, ..) -> those of other digests, and those of hot ones (all
    if these are too many to broadcast) with the input task's salt, or None."""
    task = F.pmod(F.spark_partition_id(), F.lit(salts)).alias("salt")
    heavy = cut(rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot).select("digest"), "exact-hot")
    n = heavy.count()
    if not n:
        return rows, None
    if n > most:
        return rows.limit(0), rows.select("*", task)
    return rows.join(F.broadcast(heavy), "digest", "left_anti"), rows.join(F.broadcast(heavy), "digest", "left_semi").select("*", task)


def exact_groups(docs: DataFrame, salts: int = SALTS, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    base = _digested(docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")), "text")
    cold, warm = _salted(base, salts, hot)
    best = [F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")]
    merged = cold.groupBy("digest", "text").agg(*best)
    if warm is not None:
        salted = warm.groupBy("digest", "salt", "text").agg(*best)
        merged = merged.unionByName(salted.groupBy("digest", "text").agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")))
    # a digest with two texts would show here; its rows then match by text
    winners = cut(merged.groupBy("digest").agg(F.count(F.lit(1)).alias("texts"), F.max("keep_id").alias("keep_id"), F.max("group_size").alias("group_size")), "exact-winners")
    ids = base.groupBy("digest", "doc_id").agg(F.count(F.lit(1)).alias("rows"))
    clash = winners.where("texts > 1")
    one = winners.where("texts = 1").select("digest", "keep_id", "group_size", F.col("group_size").alias("copies"))
    out = hot_join(ids, one, "digest", "copies", F.col("doc_id"), hot=hot)
    if not clash.isEmpty():
        wide = base.join(clash.select("digest"), "digest", "left_semi")
        own = wide.groupBy("digest", "text").agg(*best)
        twins = wide.groupBy("digest", "text", "doc_id").agg(F.count(F.lit(1)).alias("rows"))
        out = out.unionByName(twins.join(own, ["digest", "text"]).drop("text"))
    return out.select(
        "doc_id", "keep_id", "group_size",
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))).alias("nth"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    ).select("doc_id", "keep_id", "group_size", (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)).alias("kept"), "text_sha256")


def exact_keepers(docs: DataFrame, salts: int = SALTS, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """The rows that stay, with all their columns: the winner's other columns
    travel through the combining as one struct, so texts move no further time.
    Among rows that tie on doc_id the largest hash of all columns stays."""
    rest = [c for c in docs.columns if c != text_col]
    base = docs.select(
        F.coalesce(F.col(text_col), F.lit("")).alias("k_text"),
        F.struct(F.col(id_col).alias("id"), row_hash(docs).alias("h"), F.col(text_col).isNull().alias("no_text"), F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row")).alias("v"),
    )
    order = F.struct(F.col("v.id"), F.col("v.h"))
    best = F.max_by("v", order).alias("v")
    cold, warm = _salted(_digested(base, "k_text"), salts, hot)
    merged = cold.groupBy("digest", "k_text").agg(best)
    if warm is not None:
        merged = merged.unionByName(warm.groupBy("digest", "salt", "k_text").agg(best).groupBy("digest", "k_text").agg(best))
    text = F.when(F.col("v.no_text"), F.lit(None)).otherwise(F.col("k_text")).alias(text_col)
    return merged.select(*[text if c == text_col else F.col("v.row").getField(c).alias(c) for c in docs.columns])


SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""
