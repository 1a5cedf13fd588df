"""Parquet writers: yearly partitions, upserts, batch tables, counts observed while writing."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from regionlake import config as C
from regionlake.operators.merge import upserted
from regionlake.session import durable
from regionlake.sources.files import _hadoop_path, exists


def write_yearly(df: DataFrame, path: str, year: str = C.YEAR) -> None:
    """Overwrite only the years present in ``df``; one partitioned table serves both
    single-year and all-year readers.

    The rebalance hint lets adaptive execution cut a large year into several files of
    even size and put a small year into one.
    """
    df.hint("rebalance", year).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(year).parquet(path)


def write_batch(df: DataFrame, path: str, *partitions: str) -> None:
    """Write one micro-batch as its own partitions; a repeated batch replaces itself."""
    by = partitions or ("batch_id",)
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def snapshots(spark: SparkSession, path: str) -> list[str]:
    """Complete snapshots of a table, oldest first."""
    target, fs = _hadoop_path(spark, f"{path}/v=*/_SUCCESS")
    found = fs.globStatus(target) or []
    return sorted(s.getPath().getParent().toString() for s in found)


def write_snapshot(df: DataFrame, path: str) -> str:
    """Write the whole table beside the older ones; readers see it once it is complete."""
    spark = df.sparkSession
    done = snapshots(spark, path)
    number = int(done[-1].rsplit("v=", 1)[1]) + 1 if done else 1
    target = f"{path}/v={number:09d}"
    df.write.mode("overwrite").parquet(target)
    return target


def read_snapshot(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest complete snapshot, None before the first."""
    done = snapshots(spark, path)
    return spark.read.parquet(done[-1]) if done else None


def upsert_table(source: DataFrame, path: str, pk: list[str], version: list[str] | None = None) -> DataFrame:
    """Idempotent keyed upsert into a snapshot table; returns the new state.

    The older snapshot is read while the new one is written, never overwritten.
    """
    spark = source.sparkSession
    current = read_snapshot(spark, path)
    merged = source.limit(0) if current is None else current
    write_snapshot(upserted(merged, source, pk, version), path)
    return read_snapshot(spark, path)


HASHED = "_part"


def upsert_partitions(source: DataFrame, path: str, pk: list[str], by: str | None = None, buckets: int = 16,
                      version: list[str] | None = None) -> DataFrame:
    """Idempotent keyed upsert that reads and rewrites only the partitions its rows fall in; returns the table.

    ``by`` is a key column that the table is partitioned by, such as the year; without one the table has ``buckets``
    partitions by a hash of the key (``_part``). The merged rows are stored in the shared folder before
    the first partition is replaced, and Spark puts new files in place only once all are written.
    """
    if by is not None and by not in pk:
        raise ValueError(f"{by} must be part of the key, or a row could move to another partition")
    spark, column = source.sparkSession, by or HASHED
    # The key as text: the same whatever integer type it has in source and table.
    rows = source if by else source.withColumn(HASHED, F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in pk]), F.lit(buckets)).cast("int"))
    if exists(spark, path):
        # One row a partition, of which a table has few.
        touched = [r[0] for r in rows.select(column).distinct().collect()]
        place = F.col(column).isin([t for t in touched if t is not None])
        # A partition's name reads as a number wherever it can; the source says what it is.
        stored = spark.read.parquet(path).withColumn(column, F.col(column).cast(rows.schema[column].dataType))
        current = stored.where(place | F.col(column).isNull() if None in touched else place)
    else:
        current = rows.limit(0)
    write_batch(durable(upserted(current, rows, pk, version)), path, column)
    return spark.read.parquet(path).withColumn(column, F.col(column).cast(rows.schema[column].dataType)).drop(HASHED)


def observed(df: DataFrame, write: Callable[[DataFrame], None], rules: dict | None = None) -> dict:
    """Run ``write`` on ``df`` and return its ``rows`` and, by rule, the rows that break it.

    The counts come out of the write itself (``rules`` maps a name to a condition that must not be
    false), so a report costs no further job.
    """
    seen = Observation()
    broken = [F.count_if(~holds).alias(name) for name, holds in (rules or {}).items()]
    write(df.observe(seen, F.count(F.lit(1)).alias("rows"), *broken))
    found = seen.get
    return {"rows": found["rows"], "violations": {name: found[name] for name in rules or {}}}


def drop_expired(spark: SparkSession, path: str, as_of: date, days: int = C.RETENTION_DAYS, day: str = "jour") -> list[str]:
    """Remove the day partitions that lie wholly before ``as_of`` minus ``days``; their rows are not read.

    For tables that batch jobs write. The day of the limit itself stays whole.
    """
    target, fs = _hadoop_path(spark, f"{path}/{day}=*")
    limit = date.fromordinal(as_of.toordinal() - days).isoformat()
    gone = [s.getPath() for s in fs.globStatus(target) or [] if s.getPath().getName().split("=", 1)[1] < limit]
    names = sorted(p.getName() for p in gone)
    for p in gone:
        fs.delete(p, True)
    return names


def reload_table(df: DataFrame, path: str) -> None:
    """Replace a table by new content."""
    df.write.mode("overwrite").parquet(path)


def append_events(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)
