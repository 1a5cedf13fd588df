"""Long form of indicators and ordered caps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from regionlake import config as C
from regionlake.functions.cleaning import keyword_category, truncated


def long_indicators(
    wide: DataFrame, key: str = C.REGION, year: str = C.YEAR, source: str = "gold/indicateurs_custom",
) -> DataFrame:
    """One row per (region, indicator): name, category, value, source; missing values dropped."""
    ids = [c for c in (key, year) if c in wide.columns]
    if {"nom", "valeur"} <= set(wide.columns):
        long = wide
    else:
        values = [c for c in wide.columns if c not in ids]
        doubles = wide.select(*ids, *[F.col(c).cast("double").alias(c) for c in values])
        long = doubles.unpivot(ids, values, "nom", "valeur")
    if year not in long.columns:
        long = long.withColumn(year, F.lit(None).cast("int"))
    return long.where(F.col("valeur").isNotNull()).select(
        key,
        truncated("nom", 64).alias("nom"),
        keyword_category("nom").alias("categorie"),
        F.col("valeur").cast("double").alias("valeur"),
        F.lit(None).cast("string").alias("unite"),
        year,
        F.lit(source).alias("source"),
    )


def first_rows(df: DataFrame, order: list[str], max_rows: int | None = None) -> DataFrame:
    """All rows; the first ``max_rows`` in order only where the caller asks for so many."""
    return df if max_rows is None else df.orderBy(*order).limit(max_rows)


def newest(df: DataFrame, ts: str, limit: int, bounds: tuple[int, int], tie: list[str]) -> DataFrame:
    """Newest rows first, with a validated limit."""
    low, high = bounds
    if not low <= limit <= high:
        raise ValueError(f"limit must lie in {low}..{high}")
    return df.orderBy(F.col(ts).desc(), *[F.col(t).asc() for t in tie]).limit(limit)


def union_all(*tables: DataFrame | None) -> DataFrame | None:
    """UNION ALL by name of the tables that exist; missing columns become null."""
    present = [t for t in tables if t is not None]
    if not present:
        return None
    out = present[0]
    for t in present[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def first_of(df: DataFrame, base: str, *variants: str) -> DataFrame:
    """Merge suffixed copies of a column into one, first non-null wins."""
    found = [c for c in variants if c in df.columns]
    if not found:
        return df
    merged = F.coalesce(*[F.col(c) for c in found])
    return df.withColumn(base, merged).drop(*[c for c in found if c != base])
