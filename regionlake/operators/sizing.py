"""Size checks that decide how a side of a join travels."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from regionlake import config as C
from regionlake.session import durable


@dataclass(frozen=True)
class Sized:
    """A stored table and whether its row count lies within the broadcast limit."""

    df: DataFrame
    small: bool

    def hinted(self) -> DataFrame:
        """Broadcast hint only below the limit; above it the join shuffles both sides."""
        return F.broadcast(self.df) if self.small else self.df


def sized(df: DataFrame, max_rows: int = C.BROADCAST_ROWS, bytes_of: Column | None = None, max_bytes: int = C.BROADCAST_BYTES) -> Sized:
    """Materialise a join side in the shared folder and measure it.

    Rows of fixed width are counted up to the limit; rows that hold arrays or texts give ``bytes_of`` each, and
    their sum decides too. The measure and the later join read the same stored rows, so checking the size
    does not compute the side twice.
    """
    stored = durable(df)
    if bytes_of is None:
        return Sized(stored, stored.limit(max_rows + 1).count() <= max_rows)
    n, size = stored.agg(F.count(F.lit(1)), F.coalesce(F.sum(bytes_of), F.lit(0))).first()
    return Sized(stored, n <= max_rows and size <= max_bytes)


def salted_join(left: DataFrame, right: DataFrame, on: list[str], salts: int, how: str = "inner") -> DataFrame:
    """Equi join that spreads every key of ``left`` over ``salts`` tasks.

    The salt hashes the whole left row and its partition number: a retried task salts
    the same way, and identical rows of different partitions still part. Each right row
    is repeated once per salt.
    """
    salt = F.pmod(F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in left.columns]), F.lit(salts))
    copies = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>"))
    joined = left.withColumn("_salt", salt).join(
        right.withColumn("_salt", copies), on=[*on, "_salt"], how=how
    )
    return joined.drop("_salt")


@dataclass(frozen=True)
class Spine:
    """The region dimension, always the left side of a coverage join.

    ``size`` is known when the spine is built, which bounds every table that has
    one row per region.
    """

    df: DataFrame
    key: str
    size: int

    @classmethod
    def numbered(cls, spark: SparkSession, n: int = C.N_REGIONS, key: str = C.REGION) -> "Spine":
        """Regions 1..n."""
        df = spark.range(1, n + 1, 1, max(1, n // 100_000)).select(F.col("id").cast("int").alias(key))
        return cls(df, key, n)

    @classmethod
    def of(cls, df: DataFrame, key: str = C.REGION) -> "Spine":
        """The distinct, non-null keys of a dimension table."""
        keys = durable(df.select(key).where(F.col(key).isNotNull()).distinct())
        return cls(keys, key, keys.count())

    def hinted(self, df: DataFrame) -> DataFrame:
        """Broadcast hint for a table that has at most one row per region."""
        return F.broadcast(df) if self.size <= C.BROADCAST_ROWS else df

    def members(self, df: DataFrame) -> DataFrame:
        """Rows whose key belongs to the spine."""
        return df.join(self.hinted(self.df), self.key, "left_semi")

    def attach(self, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
        """Left join of a table with one row per region onto the spine."""
        columns = keep or [c for c in df.columns if c != self.key]
        return self.df.join(df.select(self.key, *columns), self.key, "left")

    def literal(self, values: dict[int, float]) -> Column:
        """Default table lookup by region, null outside the table."""
        pairs = [F.lit(x) for kv in values.items() for x in kv]
        return F.try_element_at(F.create_map(*pairs), F.col(self.key).cast("int"))
