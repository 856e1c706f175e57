"""Helpers shared by the training-data operators."""

from __future__ import annotations

import re
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

HOT = 1024  # rows of a key that stay in one task
BROADCAST_KEYS = 1 << 18  # hot keys that may be broadcast
SALTS = 64  # of hot keys that are too many for it


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where
    the session has none and all tasks run on this machine (local tests), it is
    a temporary one; on a cluster that is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
        found = jdir.get() if jdir.isDefined() else None
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="lodequill-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/lodequill/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it again: the lineage ends at
    files that survive the loss of any executor."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hot_join(left: DataFrame, right: DataFrame, on: str | list[str], rows: str | None = None, spread: Column | None = None, how: str = "inner", hot: int = HOT, most: int = BROADCAST_KEYS) -> DataFrame:
    """left join right on `on`, where right has one row a key and a key may have
    any share of left's rows. `rows` names the column of right with that number
    (it is dropped); without it left's rows are counted, combined map-side.

    The right row of a key with more than `hot` rows is repeated, once for each
    `hot` rows, and left's rows are dealt to the copies by a hash of `spread`
    (a column of left) or, without one, by the input task. Hot keys are at most
    rows / hot. They are broadcast while a count shows that they are `most` at
    most; beyond it both sides are salted alike and shuffled. Null keys match
    nothing and must not be in left: their rows would meet in one task."""
    on = [on] if isinstance(on, str) else on
    if rows is None:
        rows, found = "_rows", left.groupBy(*on).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > hot)
        heavy = cut(found, "hot-keys")
    else:
        heavy = right.where(F.col(rows) > hot).select(*on, rows)
        right = right.drop(rows)
    n = heavy.count()
    if not n:
        return left.join(right, on, how)
    dice = F.xxhash64(spread) if spread is not None else F.xxhash64(F.spark_partition_id())
    if n <= most:
        parts = F.least(F.ceil(F.col(rows) / hot), F.lit(1 << 16)).cast("int")
        copies = F.broadcast(heavy.select(*on, parts.alias("_parts")))
        salted = left.join(copies, on, "left").withColumn("_salt", F.when(F.col("_parts").isNotNull(), F.pmod(dice, F.col("_parts"))).otherwise(F.lit(0)).cast("int")).drop("_parts")
        other = right.join(copies, on, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))).drop("_parts")
    else:
        salted = left.withColumn("_salt", F.pmod(dice, F.lit(SALTS)).cast("int"))
        other = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(other, [*on, "_salt"], how).drop("_salt")


def row_hash(df: DataFrame, seed: int = 0) -> Column:
    """A 64-bit hash of all columns; types that can't be hashed (maps) are
    taken as strings."""

    def plain(t) -> bool:
        if isinstance(t, T.StructType):
            return all(plain(f.dataType) for f in t.fields)
        return plain(t.elementType) if isinstance(t, T.ArrayType) else not isinstance(t, (T.MapType, T.VariantType))

    return F.xxhash64(F.lit(seed), *[F.col(f"`{f.name}`") if plain(f.dataType) else F.col(f"`{f.name}`").cast("string") for f in df.schema.fields])


def arrow_limits(spark: SparkSession, rows: int = 1000, mb: int = 8) -> None:
    """Bound what one Arrow batch brings into a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(mb << 20))


def filesystem(path: str):
    """The store and the path in it of a shared file or folder, as the workers
    see it."""
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", re.sub(r"^file:/+", "file:///", path)))
    return fs.LocalFileSystem(), path


def utf8(col) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (n + 1) of an Arrow string column; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    wide = pa.types.is_large_string(col.type)
    offs = np.frombuffer(col.buffers()[1], np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    data = col.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offs[0] : offs[-1]] if data is not None and len(offs) and offs[-1] else np.zeros(0, np.uint8)
    return raw, offs - offs[0] if len(offs) else np.zeros(1, np.int64)


def slices(lengths: np.ndarray, most: int):
    """Row ranges (i, j) whose lengths sum to about `most`; a longer row alone."""
    i, n, total = 0, len(lengths), 0
    for k in range(n):
        if k > i and total + lengths[k] > most:
            yield i, k
            i, total = k, 0
        total += int(lengths[k])
    if i < n:
        yield i, n


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finalizer of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
