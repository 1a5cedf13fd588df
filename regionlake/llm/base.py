"""Helpers the operators share: tables in the shared folder, Python on executors, fixed-size bit sets."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from regionlake.session import scratch_path
from regionlake.sources.files import remove

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back.

    Cuts the lineage: a lost executor costs only the task that was reading, and a
    table used several times is computed once.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove a table that ``stored`` wrote and nothing reads again."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        remove(df.sparkSession, folder)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """``mapInArrow`` whose workers find this package where the driver found it.

    On a cluster the package is installed or sent with ``--py-files``; a path that an
    executor does not have is ignored there. A worker waits for its next task without the memory of the last.
    """
    env = df.sparkSession.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, ROOT])

    def released(batches):
        yield from fn(batches)
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(released, schema)


def texts_of(df: DataFrame, key: str, text: str) -> DataFrame:
    """Only the key and the text, under fixed names, so that other columns cannot clash."""
    return df.select(df[key].alias("key"), df[text].cast("string").alias("text"))


def table(columns: dict[str, np.ndarray | list | pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], names=list(columns))


def signed(a: np.ndarray) -> np.ndarray:
    """64-bit hashes as Spark's bigint."""
    return a.view(np.int64)


def binary(pieces: list[bytes]) -> pa.Array:
    return pa.array(pieces, pa.binary())


class BitSet:
    """A set of 64-bit hashes in 2**log_bits bits, two bits a member.

    Its size is fixed, whatever it holds, so it may be broadcast. It can report a hash it
    was not given; callers use it only where such an error costs time, not correctness.
    """

    def __init__(self, words: np.ndarray, log_bits: int):
        self.words, self.mask = words, np.uint64((1 << log_bits) - 1)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        hashes = hashes.view(np.uint64)
        found = np.ones(len(hashes), bool)
        for at in (hashes & self.mask, (hashes >> np.uint64(32)) & self.mask):
            found &= (self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) > 0
        return found

    @staticmethod
    def of(df: DataFrame, column: str, log_bits: int = 23) -> "BitSet":
        """At most 2**(log_bits-6) words reach the driver. ``log_bits`` is at most 32."""
        m = (1 << log_bits) - 1
        at = F.explode(F.array(F.col(column).bitwiseAND(F.lit(m)), F.shiftrightunsigned(F.col(column), 32).bitwiseAND(F.lit(m))))
        words = (
            df.where(F.col(column).isNotNull()).select(at.alias("at"))
            .groupBy(F.shiftright("at", 6).alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits")).toPandas()
        )
        bits = np.zeros(1 << max(0, log_bits - 6), np.int64)
        bits[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64)
        return BitSet(bits.view(np.uint64), log_bits)


def same(column: str, other: str) -> Column:
    return F.col(column).eqNullSafe(F.col(other))
