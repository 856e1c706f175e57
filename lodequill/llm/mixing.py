"""Mixing sources to target weights by systematic sampling.

Sizes are words. A source's target is its share of `total` times all words by
its weight, stopped at `most` times its own words; what is cut off is shared
again by weight until no target is above its stop. That is a water level: a
source is stopped if its stop is at or under weight * level. Each round sums the
stopped and the free sources, which gives the next level, until no source is
stopped any more; a round returns one row. Sources are numbered in code point
order by ranges, so neither step brings all sources to one task.

Every document of a source expects target / source_size copies. With the
documents in a fixed order, r being a document's rank there and u one random
offset of the source, it is emitted floor(e r + u) - floor(e (r - 1) + u)
times: once for each integer boundary that the prefix sum crosses. The order is
by size class, then slice, then doc_id, so that large and small documents are
sampled alike and taken words come near the target.

The prefix sum has two levels. Ranks are taken inside (source, size class,
slice) and added to the counts of the slices before; slices are a fixed number
of hashes of doc_id, enough that a source, or one size, with a third of all rows
is spread out.

Defined results: a null or wordless text has size 0 and takes nothing; a null
source is a source, the last; rows that repeat a doc_id are separate documents;
null doc_ids come before others and are dealt to slices by their size. An empty
table gives an empty result. Extra columns, maps among them, are ignored by
`mix` and carried unchanged by `mixed_rows`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, hot_join, row_hash

WEIGHTS = (3, 1, 2)
TOTAL, MOST = 1.5, 2
SLICES = 1024
WORD = "[^\\x20\\x09-\\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def size_class(size: Column) -> Column:
    """Eight classes to each power of two; 0 for size 0."""
    e = F.length(F.bin(size)) - 1
    return F.when(size > 0, e * 8 + F.call_function("shiftright", size * 8, e)).otherwise(F.lit(0)).cast("long")


def numbered(sources: DataFrame) -> DataFrame:
    """sources with nth: their places from 0 in code point order, null last.
    Ranges are numbered inside and shifted by the counts of those before."""
    ordered = F.col("source").asc_nulls_last()
    ranged = cut(sources.repartitionByRange(ordered).withColumn("range", F.spark_partition_id()), "mix-ranges")
    counts = ranged.groupBy("range").agg(F.count(F.lit(1)).alias("n"))  # a row a task
    before = counts.select("range", F.coalesce(F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    inner = F.row_number().over(Window.partitionBy("range").orderBy(ordered)) - 1
    return ranged.withColumn("inner", inner).join(before, "range").withColumn("nth", F.col("before") + F.col("inner")).drop("range", "inner", "before")


def targets(sources: DataFrame, weights=WEIGHTS, total: float = TOTAL, most: int = MOST) -> DataFrame:
    """sources (source, source_size) -> with target, offset; one row a source."""
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (F.col("nth") % len(weights) + 1).cast("int"))
    rows = cut(numbered(sources).withColumn("w", weight).withColumn("stop", F.col("source_size") * most), "mix-sources")
    level, stopped = None, 0
    while True:
        over = F.lit(False) if level is None else F.col("stop") <= F.col("w") * F.lit(level)
        r = rows.agg(F.sum("source_size").alias("words"), F.sum(F.when(over, F.col("stop"))).alias("stops"), F.sum(F.when(~over, F.col("w"))).alias("free"), F.count_if(over).alias("n")).first()
        if level is not None and r.n == stopped or not r.free:
            level = level if r.free else None
            break
        level, stopped = (float(r.words) * total - float(r.stops or 0)) / float(r.free), r.n
    stop = F.col("stop").cast("double")
    target = stop if level is None else F.least(stop, F.col("w") * F.lit(level))
    u = F.conv(F.substring(F.md5(F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")).cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
    return rows.select("source", "source_size", target.alias("target"), u.alias("u"))


def mix(docs: DataFrame, weights=WEIGHTS, total: float = TOTAL, most: int = MOST, slices: int = SLICES) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, copies."""
    narrow = cut(docs.select("doc_id", "source", n_words(F.col("text")).alias("size")), "mix-sizes")
    return _sampled(narrow, weights, total, most, slices).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


def mixed_rows(docs: DataFrame, weights=WEIGHTS, total: float = TOTAL, most: int = MOST, slices: int = SLICES) -> DataFrame:
    """The mix itself: each row of docs as often as it is taken. Rows without
    words take nothing. Rows are told apart by 128 bits of all their columns;
    copies of rows that are equal in every column are added up and dealt to one
    of them."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    held = docs.select(row, row_hash(docs).alias("h"), row_hash(docs, 1).alias("h2"), F.col("doc_id").alias("k_id"), F.col("source").alias("k_source"), n_words(F.col("text")).alias("k_size"))
    narrow = cut(held.select(F.col("k_id").alias("doc_id"), F.col("k_source").alias("source"), F.col("k_size").alias("size"), "h", "h2"), "mix-sizes")
    counts = _sampled(narrow, weights, total, most, slices).groupBy("h", "h2").agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("n"), F.max("size").alias("size"))
    counts = cut(counts.where("copies > 0 AND size > 0").select("h", "h2", "copies", "n", F.col("n").alias("rows")), "mix-copies")
    picked = hot_join(held.select("row", "h", "h2"), counts, ["h", "h2"], "rows")
    if not counts.where("n > 1").isEmpty():
        twins = picked.where("n > 1").groupBy("h", "h2").agg(F.first("row").alias("row"), F.first("copies").alias("copies"))
        picked = picked.where("n = 1").select("row", "copies").unionByName(twins.select("row", "copies"))
    return picked.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")


def _sampled(narrow: DataFrame, weights, total: float, most: int, slices: int) -> DataFrame:
    name = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("n"), F.col("size").cast("string")))
    own = F.conv(F.substring(F.md5(name.cast("binary")), 1, 8), 16, 10).cast("long") % slices
    rows = narrow.withColumn("c", size_class(F.col("size"))).withColumn("s", own)
    cells = rows.groupBy("source", "c", "s").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("words"))
    sources = cells.groupBy("source").agg(F.sum("words").alias("source_size"))
    # classes of a source are few, and a class has at most `slices` cells, whatever its rows
    until = lambda *by: Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)
    classes = cells.groupBy("source", "c").agg(F.sum("n").alias("n")).select(F.col("source").alias("source_c"), F.col("c").alias("class"), F.coalesce(F.sum("n").over(until("source", "c")), F.lit(0)).alias("lower"))
    cells = cells.withColumn("before", F.coalesce(F.sum("n").over(until("source", "c", "s")), F.lit(0)))
    cells = cells.join(classes, F.col("source").eqNullSafe(F.col("source_c")) & (F.col("c") == F.col("class"))).withColumn("before", F.col("before") + F.col("lower")).drop("source_c", "class", "lower", "n", "words")
    goal = targets(sources, weights, total, most)
    goal = goal.withColumn("e", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)))
    cells = cells.join(goal, cells["source"].eqNullSafe(goal["source"])).select(cells["source"], "c", "s", "before", "source_size", "target", "e", "u")
    tie = ["doc_id", "size"] + [x for x in ("h", "h2") if x in narrow.columns]
    ranked = rows.withColumn("nth", F.row_number().over(Window.partitionBy("source", "c", "s").orderBy(*tie)))
    on = ranked["source"].eqNullSafe(cells["source"]) & (ranked["c"] == cells["c"]) & (ranked["s"] == cells["s"])
    joined = ranked.join(cells, on).select(*[ranked[x] for x in narrow.columns], (F.col("before") + F.col("nth")).alias("rank"), "source_size", "target", "e", "u")
    edge = lambda r: F.floor(F.col("e") * r + F.col("u"))
    crossed = F.least(edge(F.col("rank")) - edge(F.col("rank") - 1), F.lit(most).cast("long"))
    return joined.withColumn("copies", F.when(F.col("size") > 0, crossed).otherwise(F.lit(0).cast("long")))


SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
r AS (
  SELECT d.*, CASE WHEN size > 0 THEN (length(bin(size)) - 1) * 8 + ((size * 8) >> (length(bin(size)) - 1)) ELSE 0 END AS c,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'n' || size)), 1, 8))::UBIGINT % 1024 AS s FROM d),
src AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS nth FROM d GROUP BY source),
wt AS (SELECT *, CASE nth % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS w, source_size * 2 AS stop FROM src),
lv AS (
  SELECT *, row_number() OVER o AS k,
         (1.5::DOUBLE * sum(source_size) OVER ()::DOUBLE
          - coalesce(sum(stop) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
         / (sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM wt WINDOW o AS (ORDER BY stop * 6 / w, source NULLS LAST)),
goal AS (
  SELECT source, source_size, ('0x' || substr(md5(coalesce('s' || source, '')), 1, 8))::UBIGINT::DOUBLE / 4294967296.0::DOUBLE AS u,
         least(stop::DOUBLE, coalesce(w * (SELECT arg_min(level, k) FROM lv WHERE stop > w * level), stop::DOUBLE)) AS target
  FROM lv),
ranked AS (SELECT r.*, row_number() OVER (PARTITION BY source ORDER BY c, s, doc_id NULLS FIRST, size) AS rank FROM r),
e AS (
  SELECT ranked.*, source_size, target, u, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS e
  FROM ranked JOIN goal ON ranked.source IS NOT DISTINCT FROM goal.source)
SELECT doc_id, size, source_size, target,
       CASE WHEN size > 0 THEN least(floor(e * rank + u) - floor(e * (rank - 1) + u), 2) ELSE 0 END::BIGINT * size AS taken,
       CASE WHEN size > 0 THEN least(floor(e * rank + u) - floor(e * (rank - 1) + u), 2) ELSE 0 END::BIGINT AS copies
FROM e
"""
