"""Sinks: snapshots, replacement per document, page upserts and reports."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BUCKETS = 256


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. Where the
    session names none and runs on this machine alone (tests), a temporary one."""
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


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage at a table in the shared folder."""
    path = f"{shared_dir(df.sparkSession)}/lodequill/step-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def write_snapshot(df: DataFrame, root: str) -> str:
    """A new version beside the old ones, then the pointer to it: readers see a
    whole version or the one before."""
    spark = df.sparkSession
    version = f"v-{uuid.uuid4().hex}"
    df.write.parquet(f"{root}/{version}")
    fs, pointer = _fs(spark, f"{root}/CURRENT")
    out = fs.create(pointer, True)
    out.write(bytearray(version.encode()))
    out.close()
    return f"{root}/{version}"


def read_snapshot(spark: SparkSession, root: str, schema: str) -> DataFrame:
    fs, pointer = _fs(spark, f"{root}/CURRENT")
    if not fs.exists(pointer):
        return spark.createDataFrame([], schema)
    version = spark.read.text(f"{root}/CURRENT").first()[0]
    return spark.read.parquet(f"{root}/{version}")


def replace_documents(chunks: DataFrame, root: str, key: str = "source_file", buckets: int = BUCKETS) -> None:
    """Rewrite the buckets of the documents in `chunks`; other documents of
    those buckets are read and kept, other buckets aren't touched."""
    spark = chunks.sparkSession
    new = chunks.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
    fs, path = _fs(spark, root)
    if fs.exists(path):
        old = spark.read.parquet(root)
        kept = old.join(new.select("bucket").distinct(), "bucket", "left_semi").join(new.select(key).distinct(), key, "left_anti")
        stage = f"{root}-stage-{uuid.uuid4().hex}"
        new.unionByName(kept).write.parquet(stage)
        new = spark.read.parquet(stage)
    new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(root)
    if fs.exists(path) and "stage" in locals():
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(stage), True)


def append_pages(pages: DataFrame, root: str) -> None:
    pages.withColumn("saved_at", F.current_timestamp()).write.mode("append").parquet(root)


def current_pages(spark: SparkSession, root: str, key: str = "id") -> DataFrame:
    """The last saved row of each page."""
    w = Window.partitionBy(key).orderBy(F.desc("saved_at"))
    return spark.read.parquet(root).withColumn("n", F.row_number().over(w)).where("n = 1").drop("n")


def without_pages(pages: DataFrame, gone: DataFrame, key: str = "id") -> DataFrame:
    return pages.join(gone.select(key), key, "left_anti")


def write_report(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def reset(spark: SparkSession, root: str) -> None:
    fs, path = _fs(spark, root)
    if fs.exists(path):
        fs.delete(path, True)
    fs.mkdirs(path)


def markdown_table(df: DataFrame) -> str:
    """A report DataFrame as a Markdown table. Reports are summaries, whose size
    doesn't follow the data's; rows come one partition at a time."""
    line = lambda xs: "| " + " | ".join("" if x is None else str(x).replace("|", r"\|").replace("\n", " ") for x in xs) + " |"
    return "\n".join([line(df.columns), line(["---"] * len(df.columns)), *map(line, df.toLocalIterator())])


def html_table(df: DataFrame) -> str:
    """The same as an HTML table with everything escaped."""
    from html import escape

    cells = lambda xs, tag: "<tr>" + "".join(f"<{tag}>{'' if x is None else escape(str(x))}</{tag}>" for x in xs) + "</tr>"
    return "<table>" + cells(df.columns, "th") + "".join(cells(r, "td") for r in df.toLocalIterator()) + "</table>"


def write_reports(parts: dict[str, DataFrame], root: str, title: str) -> None:
    """Each part as JSON lines, and all in report.md and report.html."""
    from html import escape

    spark = next(iter(parts.values())).sparkSession
    for name, df in parts.items():
        write_report(df, f"{root}/{name}")
    md = "\n\n".join([f"# {title}", *[f"## {n}\n\n{markdown_table(df)}" for n, df in parts.items()]]) + "\n"
    page = f"<!doctype html><meta charset=utf-8><title>{escape(title)}</title><h1>{escape(title)}</h1>" + "".join(f"<h2>{escape(n)}</h2>{html_table(df)}" for n, df in parts.items())
    for name, text in (("report.md", md), ("report.html", page)):
        fs, path = _fs(spark, f"{root}/{name}")
        out = fs.create(path, True)
        out.write(bytearray(text.encode()))
        out.close()


def write_answers(rows: DataFrame, root: str, text: str, key: str = "query_id") -> None:
    """Prompts or answers: JSON lines with all columns in {root}/json, and the
    text of each in {root}/text/{key}=.., written by the tasks. A rerun replaces
    both."""
    rows.write.mode("overwrite").json(f"{root}/json")
    rows.select(key, F.col(text).cast("string").alias("value")).repartition(key).write.mode("overwrite").partitionBy(key).text(f"{root}/text")
