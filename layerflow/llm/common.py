"""Small helpers shared by the operators of this package.

All hand-over between steps is a Parquet table in the folder the session
names in ``spark.checkpoint.dir``; lost executors recompute from there.
"""

from __future__ import annotations

import ctypes
import gc

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from layerflow.session import checkpoint_root, shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back (cuts lineage)."""
    spark = df.sparkSession
    path = shared_dir(spark, name) + "/data"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, base: str) -> str:
    """A column name that no column of ``df`` has, whatever its case."""
    taken, name = {c.lower() for c in df.columns}, base
    while name.lower() in taken:
        name += "_"
    return name


def wrapped(df: DataFrame, **columns: Column) -> DataFrame:
    """All columns of ``df`` inside one struct ``row``, beside the named ones:
    joins and working columns cannot clash with the caller's columns."""
    return df.select(F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("row"),
                     *[c.alias(n) for n, c in columns.items()])


def utf8(column: str | Column) -> Column:
    """The text as UTF-8 bytes, null as no bytes."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit("")).cast("binary")


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves remainder 2 modulo 4."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def bounded(drawn: DataFrame, group: str, most: int) -> DataFrame:
    """Of a sample (``group``, hash, body) at most ``most`` rows of each group,
    those of the smallest hashes; rows equal in group and hash are one. Repeats
    collapse and the bound is applied before rows of a group meet."""
    once = drawn.groupBy(group, "hash").agg(F.min("body").alias("body"))
    return once.withColumn("no", F.row_number().over(Window.partitionBy(group).orderBy("hash"))).where(F.col("no") <= most).drop("no")


def parts_for(spark: SparkSession, amount: int, per_part: int) -> int:
    """Partitions so that each gets about ``per_part`` of ``amount``."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(amount) // per_part), 1)


def release() -> None:
    """Hand memory that earlier work of this worker process has freed back to
    the system: Spark reuses workers, and allocators keep what they once had."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _M1
        x = (x ^ (x >> np.uint64(27))) * _M2
        return x ^ (x >> np.uint64(31))


__all__ = ["bounded", "checkpoint_root", "fresh", "held_out", "mix64", "parts_for", "release", "shared_dir", "staged", "table", "utf8", "wrapped"]
