"""Near-duplicate groups by a multi-index Hamming join of MinHash signatures.

A text's signature has 48 components of 16 bits; the distance of two signatures
is the number of components that differ. Split into 12 chunks of 4, signatures
within 23 have a chunk with at most one error (pigeonhole: 24 errors are needed
for two in each), and every allowed error is enumerated: a chunk gives four
keys, each without one of its components. So all pairs within 23 share a key.
Two sets of similarity 0.75 differ in 12 components on average; a pair misses
every key with a probability of 1e-7, and the distance up to which candidates
are confirmed, 28, is over five standard deviations above that average.

No bucket is expanded into its pairs:

1. Texts with equal shingle sets are one class (aggregation), its smallest
   doc_id the node.
2. Each node is compared with one other, the bucket head it shares most keys
   with. Confirmed links make a forest, contracted by pointer jumping. Joins on
   keys, heads, labels and classes that many rows may share deal a hot one's
   rows to several tasks (`hot_join`).
3. In buckets whose nodes are in several components, signatures are compared
   inside a task, block by block. A pair belongs to its first common key, so it
   is looked at once. What leaves is the list of nodes that have a candidate of
   another component there. Their texts come to the same blocks, their full
   sets are built there, every candidate is compared exactly, and only links
   that join two components of the block leave. Nothing is capped or sampled.

Links are confirmed on the full sets of 64-bit shingle hashes of both texts.
Similarity: 100 * intersection >= percent * union.

Defined results: a null or wordless text has an empty set and is linked with
nothing; fewer words than a shingle's are one shingle. doc_ids are identities:
rows that repeat one are one node and both carry its component. A row whose
doc_id is null takes no part unless its set is another row's, whose component
it then carries. An empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_limits, cut, hot_join, slices, utf8
from .shingles import set_digest, shingle_sets, signatures

WORDS, PERCENT = 5, 75
PARTS, CHUNK = 48, 4
REACH = 2 * (PARTS // CHUNK) - 1  # 23: distances that surely share a key
FAR = 28
BLOCK, TILE = 4096, 256
BLOCK_SHINGLES = 1 << 22
BROADCAST_IDS = 1 << 20


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, n_shingles, digest (d1, d2), signature of each row."""

    def run(batches):
        for b in batches:
            raw, offs = utf8(b.column(1))
            for i, j in slices(np.diff(offs), 1 << 20):
                own = offs[i : j + 1]
                sets = shingle_sets(raw[own[0] : own[-1]], own - own[0], words)
                full = [k for k, s in enumerate(sets) if len(s)]
                sig = signatures([sets[k] for k in full], PARTS)
                digest = [None] * len(sets)
                sigs: list = [None] * len(sets)
                for k, row in zip(full, sig):
                    digest[k], sigs[k] = set_digest(sets[k]), row.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), pa.array([len(s) for s in sets], pa.int64()), pa.array([d and d[0] for d in digest], pa.int64()), pa.array([d and d[1] for d in digest], pa.int64()), pa.array(sigs, pa.binary())],
                    ["doc_id", "n_shingles", "d1", "d2", "sig"],
                )

    return docs.mapInArrow(run, "doc_id long, n_shingles long, d1 long, d2 long, sig binary")


def _entries(classes: DataFrame) -> DataFrame:
    """(key, node) for every chunk and allowed error."""
    chunks = PARTS // CHUNK

    def run(batches):
        for b in batches:
            node, sig = b.column(0).to_numpy(), b.column(1).to_pylist()
            if not len(node):
                continue
            s = np.frombuffer(b"".join(sig), np.uint16).reshape(len(node), chunks, CHUNK).astype(np.int64)
            keys = np.empty((len(node), chunks, CHUNK), np.int64)
            for w in range(CHUNK):
                k = np.broadcast_to(np.arange(chunks, dtype=np.int64) * CHUNK + w, (len(node), chunks)).copy()
                for x in range(CHUNK):
                    if x != w:
                        k = (k << 16) | s[:, :, x]
                keys[:, :, w] = k
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(node, PARTS))], ["key", "node"])

    return classes.select("node", "sig").mapInArrow(run, "key long, node long")


def confirm(pairs: DataFrame, texts: DataFrame, percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough."""

    def run(batches):
        held: dict = {}
        for b in batches:
            ids = [b.column(0).to_pylist(), b.column(1).to_pylist()]
            keep = []
            for k, pair in enumerate(zip(*ids)):
                sets = []
                for side, i in enumerate(pair):
                    text = b.column(2 + side)[k].as_py()
                    key = (i, len(text))
                    if key not in held or held[key][0] != text:
                        if len(held) > 64:
                            held.clear()
                        data = np.frombuffer(text.encode(), np.uint8)
                        held[key] = text, shingle_sets(data, np.array([0, len(data)]), words)[0]
                    sets.append(held[key][1])
                x, y = sets
                both = len(np.intersect1d(x, y, assume_unique=True))
                if both and 100 * both >= percent * (len(x) + len(y) - both):
                    keep.append(k)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(keep, pa.int64())), b.column(1).take(pa.array(keep, pa.int64()))], ["a", "b"])

    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    with_a = pairs.select("a", "b").join(left, "a")  # a node is `a` once
    if pairs.isEmpty():
        return cut(with_a.select("a", "b"), "neardup-links")
    shared = pairs.groupBy("b").agg(F.count(F.lit(1)).alias("_n"))
    both = hot_join(with_a, right.join(shared, "b"), "b", "_n", F.col("a")).select("a", "b", "text_a", "text_b")
    return cut(both.mapInArrow(run, "a long, b long"), "neardup-links")


def roots(forest: DataFrame) -> DataFrame:
    """(node, label): pointer jumping over (node, parent), parent < node."""
    forest = forest.select("node", F.col("parent").alias("label"))
    while True:
        up = forest.select(F.col("node").alias("label"), F.col("label").alias("higher"))
        jumped = hot_join(forest, up, "label", None, F.col("node"), "left")
        forest = cut(jumped.select("node", F.coalesce("higher", "label").alias("label"), F.col("higher").isNotNull().alias("moved")), "neardup-roots")
        if forest.where("moved").isEmpty():
            return forest.select("node", "label")
        forest = forest.select("node", "label")


def _labelled(rows: DataFrame, labels: DataFrame, node: str, label: str) -> DataFrame:
    """rows with the label of `node`; a node has few rows here."""
    own = labels.select(F.col("node").alias(node), F.col("label").alias("found"))
    return rows.join(own, node, "left").withColumn(label, F.coalesce("found", node)).drop("found")


def _relabelled(edges: DataFrame, labels: DataFrame, node: str, label: str) -> DataFrame:
    """The same for edges, where one component may stand in any share of them."""
    own = labels.select(F.col("node").alias(node), F.col("label").alias("found"))
    other = "b" if node == "a" else "a"
    return hot_join(edges, own, node, None, F.col(other), "left").withColumn(label, F.coalesce("found", node)).drop("found")


def merge(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after more links: every component hooks to its smallest linked
    component, the forest is contracted, and what still differs goes on."""
    edges = _relabelled(_relabelled(links, labels, "a", "x"), labels, "b", "y").select("x", "y")
    while True:
        edges = cut(edges.where("x <> y").select(F.greatest("x", "y").alias("node"), F.least("x", "y").alias("parent")).distinct(), "neardup-edges")
        if edges.isEmpty():
            return labels
        up = roots(edges.groupBy("node").agg(F.min("parent").alias("parent")))
        new = up.join(labels.select("node"), "node", "left_anti")
        higher = up.select(F.col("node").alias("label"), F.col("label").alias("higher"))
        moved = hot_join(labels, higher, "label", None, F.col("node"), "left").select("node", F.coalesce("higher", "label").alias("label"))
        labels = cut(moved.unionByName(new), "neardup-labels")
        edges = _relabelled(_relabelled(edges.withColumnsRenamed({"node": "a", "parent": "b"}), up, "a", "x"), up, "b", "y").select("x", "y")


def _first_common(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distance of signature rows, and the number of their first common key
    (48 where they have none)."""
    off = (x != y).reshape(len(x), PARTS // CHUNK, CHUNK)
    errors = off.sum(2)
    good = errors <= 1
    first = good.argmax(1)
    at = np.arange(len(x))
    key = first * CHUNK + off[at, first].argmax(1)  # without the component that differs, or the first
    return errors.sum(1), np.where(good[at, first], key, PARTS)


def _candidates(number: int, side, node, n, label, sig, alone: bool, far: int, percent: int):
    """Yield (i, js): a row and its candidate partners in a block."""
    rows = np.arange(len(node)) if alone else np.flatnonzero(side == 0)
    cols = rows if alone else np.flatnonzero(side == 1)
    for a in range(0, len(rows), TILE):
        x = rows[a : a + TILE]
        ok = label[x][:, None] != label[cols][None, :]
        if not ok.any():
            continue
        ok &= 100 * np.minimum(n[x][:, None], n[cols][None, :]) >= percent * np.maximum(n[x][:, None], n[cols][None, :])
        if alone:
            ok &= node[x][:, None] < node[cols][None, :]
        i, j = np.nonzero(ok)
        keep = np.zeros(len(i), bool)
        for k in range(0, len(i), 1 << 16):
            d, first = _first_common(sig[x[i[k : k + (1 << 16)]]], sig[cols[j[k : k + (1 << 16)]]])
            keep[k : k + (1 << 16)] = (d <= far) & (first == number)
        i, j = i[keep], j[keep]
        edge = np.flatnonzero(np.diff(i)) + 1
        for own in np.split(np.arange(len(i)), edge) if len(i) else ():
            yield x[i[own[0]]], cols[j[own]]


def _blocks(batches):
    """Record batches sorted by (key, lo, hi) -> one table for each block."""
    held: list = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        ids = np.stack([b.column(i).to_numpy() for i in range(3)], 1)
        cuts = [0, *(np.flatnonzero((ids[1:] != ids[:-1]).any(1)) + 1).tolist(), len(ids)]
        for x, y in zip(cuts[:-1], cuts[1:]):
            own = tuple(ids[x])
            if held and own != last:
                yield pa.Table.from_batches(held)
                held = []
            last = own
            held.append(b.slice(x, y - x))
    if held:
        yield pa.Table.from_batches(held)


def _number(key: int) -> int:
    return int(key) >> 16 * (CHUNK - 1)


def _dealt(rows: DataFrame, count: str, shingles: Column, columns: list[str]) -> DataFrame:
    """Rows of (key, ...) dealt to pairs of blocks (lo, hi) of their bucket,
    sorted by them. Blocks are bounded in rows and in shingles."""
    blocks = F.greatest(F.ceil(F.col(count) / BLOCK), F.ceil(shingles / BLOCK_SHINGLES), F.lit(1)).cast("int")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    d = rows.withColumn("blocks", blocks).withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    d = d.select("key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), (F.col("own") > F.col("other")).cast("int").alias("side"), *columns)
    return d.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")


def _undecided(shared: DataFrame, nodes: DataFrame, labels: DataFrame, far: int = FAR, percent: int = PERCENT) -> DataFrame:
    """(key, node) of entries with a candidate of another component."""
    info = _labelled(nodes.select("node", "n", "sig"), labels, "node", "label")

    def run(batches):
        for t in _blocks(batches):
            key, lo, hi, side, node, n, label = (t.column(i).to_numpy() for i in range(7))
            if len(node) < 2 or (label == label[0]).all():
                continue
            sig = np.frombuffer(b"".join(t.column(7).to_pylist()), np.uint16).reshape(len(node), PARTS)
            hit = np.zeros(len(node), bool)
            for i, js in _candidates(_number(key[0]), side, node, n, label, sig, lo[0] == hi[0], far, percent):
                hit[i] = True
                hit[js] = True
            if hit.any():
                yield pa.RecordBatch.from_arrays([pa.array(key[hit]), pa.array(node[hit])], ["key", "node"])

    rows = shared.select("key", "node", "c").join(info, "node")
    found = _dealt(rows, "c", F.lit(0), ["node", "n", "label", "sig"]).mapInArrow(run, "key long, node long")
    return cut(found.distinct(), "neardup-undecided")


def _exact_links(undecided: DataFrame, nodes: DataFrame, labels: DataFrame, texts: DataFrame, far: int = FAR, percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """Links (a, b) that join components, confirmed on full sets block by block."""

    def run(batches):
        for t in _blocks(batches):
            key, lo, hi, side, node, n, label = (t.column(i).to_numpy() for i in range(7))
            if len(node) < 2:
                continue
            sig = np.frombuffer(b"".join(t.column(7).to_pylist()), np.uint16).reshape(len(node), PARTS)
            raw, offs = utf8(t.column(8))
            own = []
            for x, y in slices(np.diff(offs), 1 << 20):
                own += shingle_sets(raw[offs[x] : offs[y]], offs[x : y + 1] - offs[x], words)
            size = np.array([len(x) for x in own])
            _, flat = np.unique(np.concatenate(own), return_inverse=True)
            at = np.concatenate([[0], np.cumsum(size)])
            mark = np.zeros(int(flat.max(initial=0)) + 1, bool)
            up: dict = {}

            def root(x):
                while up.get(x, x) != x:
                    x = up[x]
                return x

            a, b = [], []
            for i, js in _candidates(_number(key[0]), side, node, n, label, sig, lo[0] == hi[0], far, percent):
                mark[flat[at[i] : at[i + 1]]] = True
                for k in range(0, len(js), 256):
                    part = js[k : k + 256]
                    gone = root(label[i])
                    part = part[[root(x) != gone for x in label[part]]]
                    if not len(part):
                        continue
                    took = np.concatenate([flat[at[j] : at[j + 1]] for j in part])
                    both = np.add.reduceat(mark[took].astype(np.int64), np.concatenate([[0], np.cumsum(size[part])[:-1]]))
                    for j in part[100 * both >= percent * (size[i] + size[part] - both)]:
                        x, y = root(label[i]), root(label[j])
                        if x != y:
                            up[max(x, y)] = min(x, y)
                            a.append(node[i])
                            b.append(node[j])
                mark[flat[at[i] : at[i + 1]]] = False
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    ids = undecided.select("node").distinct()
    info = _labelled(nodes.select("node", "n", "sig"), labels, "node", "label").join(ids, "node", "left_semi")
    size = undecided.join(nodes.select("node", "n"), "node").groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("s"))
    sized = hot_join(undecided, cut(size, "neardup-sizes").withColumn("_n", F.col("c")), "key", "_n", F.col("node"))
    joined = sized.join(info.join(texts, "node"), "node")  # a node has a text once, and few keys
    return cut(_dealt(joined, "c", F.col("s"), ["node", "n", "label", "sig", "text"]).mapInArrow(run, "a long, b long"), "neardup-links")


def _texts(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The nodes' texts. Their ids are broadcast while a count shows that they
    are few; else both sides are shuffled once."""
    ids = nodes.withColumnRenamed("node", "doc_id")
    ids = ids if nodes.count() > BROADCAST_IDS else F.broadcast(ids)
    return cut(docs.join(ids, "doc_id", "left_semi").select(F.col("doc_id").alias("node"), "text"), "neardup-texts")


def near_groups(docs: DataFrame, percent: int = PERCENT, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row."""
    spark = docs.sparkSession
    arrow_limits(spark, 1000, 4)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    prints = cut(fingerprints(rows, words), "neardup-prints")
    full, wordless = prints.where("n_shingles > 0"), prints.where("n_shingles = 0")
    classes = cut(full.groupBy("d1", "d2").agg(F.min("doc_id").alias("node"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig"), F.count(F.lit(1)).alias("copies")), "neardup-classes")
    nodes = classes.where("node IS NOT NULL")
    entries = _entries(nodes)
    heads = cut(entries.groupBy("key").agg(F.min("node").alias("head"), F.count(F.lit(1)).alias("c")).where("c > 1"), "neardup-heads")  # a node has a key once
    labels = spark.createDataFrame([], "node long, label long")
    if not heads.isEmpty():
        shared = hot_join(entries, heads.withColumn("_n", F.col("c")), "key", "_n", F.col("node"))
        labels = _linked(rows, nodes, cut(shared, "neardup-shared"), percent, words)
    comp = _labelled(classes.select("d1", "d2", "node", "copies"), labels, "node", "component_id").select("d1", "d2", "component_id", "copies")
    found = hot_join(full.drop("sig"), cut(comp, "neardup-components"), ["d1", "d2"], "copies", F.col("doc_id"))
    out = found.select("doc_id", "n_shingles", "component_id").unionByName(wordless.select("doc_id", "n_shingles", F.lit(None).cast("long").alias("component_id")))
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def _linked(rows: DataFrame, nodes: DataFrame, shared: DataFrame, percent: int, words: int) -> DataFrame:
    spark = rows.sparkSession
    common = shared.where("node <> head").repartition("node").groupBy("node", "head").agg(F.count(F.lit(1)).alias("keys"))
    best = common.groupBy("node").agg(F.max(F.struct("keys", -F.col("head"))).alias("m")).select(F.col("node").alias("a"), (-F.col("m").getField("col2")).alias("b"))
    tried = cut(best, "neardup-pairs")
    texts = _texts(rows, cut(shared.select("node").distinct(), "neardup-nodes"))  # heads that nobody chose among them
    links = confirm(tried, texts, percent, words)
    labels = roots(links.select(F.col("a").alias("node"), F.col("b").alias("parent"))) if not links.isEmpty() else spark.createDataFrame([], "node long, label long")
    undecided = _undecided(shared, nodes, labels, percent=percent)
    if undecided.isEmpty():
        return labels
    links = _exact_links(undecided, nodes, labels, texts, percent=percent, words=words)
    return labels if links.isEmpty() else merge(labels, links)


def near_keepers(docs: DataFrame, percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """The rows of docs, with all their columns, that are kept. Rows that
    repeat a kept doc_id all stay. A row without doc_id stays if its set is no
    other row's; it is recognised by its set and goes if that has a component."""
    groups = cut(near_groups(docs, percent, words).where("NOT kept"), "neardup-gone")
    gone = groups.where("doc_id IS NOT NULL").select(F.col("doc_id").alias("gone_id")).distinct()
    kept = docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")
    if groups.where("doc_id IS NULL").isEmpty():
        return kept
    return kept.where("doc_id IS NOT NULL").unionByName(_nameless(docs, words))


def _nameless(docs: DataFrame, words: int) -> DataFrame:
    """Rows without doc_id whose shingle set no row with a doc_id has."""
    text = F.coalesce("text", F.lit(""))
    mine = docs.where("doc_id IS NULL").select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), text.alias("text"), F.monotonically_increasing_id().alias("at"))
    mine = cut(mine, "neardup-nameless")
    own = fingerprints(mine.select("at", "text"), words).where("n_shingles > 0").select(F.col("doc_id").alias("at"), "d1", "d2")
    named = fingerprints(docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long"), text), words).where("n_shingles > 0").select("d1", "d2").distinct()
    lost = cut(own.join(named, ["d1", "d2"], "left_semi").select("at"), "neardup-lost")
    return mine.join(lost, "at", "left_anti").select("row.*")


