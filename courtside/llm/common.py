"""Helpers that the corpus operators share: durable intermediate tables, text access and grouping by links."""

from __future__ import annotations

import ctypes
import string
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = string.ascii_uppercase, string.ascii_lowercase
#: The white space of all word and line rules here: blank and \t \n \v \f \r.
BLANKS = " \t\n\x0b\x0c\r"
#: Stands for a null document id inside an operator: such rows come after all others.
NO_ID = (1 << 63) - 1


#: Texts of a slice hold together about so many bytes, and are at most so many.
SLICE_BYTES, SLICE_ROWS = 8 << 20, 1000


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or on one machine (tests) a local one if none is named."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="courtside-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def durable(df: DataFrame) -> DataFrame:
    """df written once as Parquet in the shared folder and read again: lineage ends here and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(spark: SparkSession, df: DataFrame) -> None:
    """Delete the files of a durable() table that no later step reads."""
    for name in df.inputFiles()[:1]:
        path = spark._jvm.org.apache.hadoop.fs.Path(name).getParent()
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def small_batches(spark: SparkSession) -> None:
    """Let no Arrow batch that goes to Python hold much more than SLICE_BYTES (one row at least), so that long texts don't add up
    outside the heap. The setting stays, as operators run when their results are read."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key, "64m").lower().removesuffix("b")
    if not now.isdigit() or int(now) > SLICE_BYTES:
        spark.conf.set(key, str(SLICE_BYTES))


def cut_by(batch: pa.RecordBatch, sizes: np.ndarray, rows: int, size: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices of at most ``rows`` rows whose sizes add up to about ``size`` (one row at least)."""
    if not batch.num_rows:
        yield batch
    ends, at = np.cumsum(sizes), 0
    while at < batch.num_rows:
        stop = int(np.searchsorted(ends, (int(ends[at - 1]) if at else 0) + size, "right"))
        stop = min(max(stop, at + 1), at + rows, batch.num_rows)
        yield batch.slice(at, stop - at)
        at = stop


def slices(batches: Iterator[pa.RecordBatch], column: int | str, rows: int = SLICE_ROWS, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in slices whose values of a string column hold about ``size`` bytes (one row at least) and that have
    at most ``rows`` rows; an empty batch is one slice. What the worker's earlier tasks have freed goes back to the system."""
    give_back()
    for batch in batches:
        yield from cut_by(batch, pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64), rows, size)
    give_back()


def give_back() -> None:
    """Return free memory of this process to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is; plain lower-casing does that where all are ASCII."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of edges(a, b); component is the smallest node that links reach.

    Each round maps a node to the smallest node of its neighbourhood and replaces both ends of every edge by that;
    edges within a node vanish. The smallest node of a component always maps to itself, so it is what is left.
    Hot nodes only appear as join keys (AQE splits them) and under min(), which combines before the shuffle.
    """
    spark = edges.sparkSession
    links = durable(edges.select("a", "b").where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    found: DataFrame | None = None
    while links.limit(1).count():
        both = links.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(links.select(F.col("b").alias("node"), F.col("a").alias("other")))
        parent = durable(both.groupBy("node").agg(F.least("node", F.min("other")).alias("parent")))
        step = links.join(parent.select(F.col("node").alias("a"), F.col("parent").alias("pa")), "a").join(parent.select(F.col("node").alias("b"), F.col("parent").alias("pb")), "b")
        after = durable(step.where("pa <> pb").select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct())
        if found is None:
            merged = parent.select("node", F.col("parent").alias("component"))
        else:
            merged = found.join(parent.select(F.col("node").alias("component"), "parent"), "component", "left").select("node", F.coalesce("parent", "component").alias("component"))
        kept = durable(merged)
        for old in (links, parent, *([found] if found is not None else [])):
            forget(spark, old)
        links, found = after, kept
    return found if found is not None else links.select(F.col("a").alias("node"), F.col("b").alias("component"))
