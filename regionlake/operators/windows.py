"""Ordered analytics: change, rolling mean, latest, first, ranking, outliers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from regionlake import config as C
from regionlake.functions.cleaning import round_half_even


def with_variation(
    df: DataFrame, price: str = "prix_m2_median", key: str = C.REGION, period: str = C.YEAR,
    out: str = "prix_m2_variation_pct", digits: int | None = 1,
) -> DataFrame:
    """Percent change against the previous period present, missing prices padded forward.

    Runs on the yearly table, so a window holds one row per period of a region.
    """
    order = Window.partitionBy(key).orderBy(period)
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    padded = F.last(price, ignorenulls=True).over(so_far)
    change = (F.try_divide(F.col("_pad"), F.lag("_pad").over(order)) - F.lit(1.0)) * F.lit(100.0)
    df = df.withColumn("_pad", padded)
    return df.withColumn(out, change if digits is None else round_half_even(change, digits)).drop("_pad")


def rolling_mean(
    df: DataFrame, key: str, ts: str, value: str, out: str, hours: int = 24,
    slice_minutes: int = 60, scale: int = 15,
) -> DataFrame:
    """Every row with the mean of its key over [ts - hours, ts], rows of equal time included.

    A reading adds its value at its time and takes it away just after the window, so
    the mean is a running sum of these changes. Changes are combined per (key, time)
    before the shuffle; the running sum is taken inside short time slices, each slice
    starting from the total of the earlier ones. A key with a third of all rows is
    therefore spread over its slices. Values are added as decimals
    of ``scale`` places, so neither the order of addition nor the cancelling of expired values can
    change the result. NaN and infinite values count as missing; a sum beyond 38 digits raises an error (choose a smaller scale).
    """
    width_us = hours * 3_600_000_000 + 1
    slice_us = slice_minutes * 60_000_000
    finite = F.abs(F.col(value).cast("double")) < F.lit(float("inf"))  # NaN counts as larger than all numbers
    known = df.where(F.col(key).isNotNull() & F.col(ts).isNotNull() & finite)
    amount = F.col(value).cast("double").cast(f"decimal(38,{scale})")
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    changes = (
        known.select(
            F.col(key).alias("_key"),
            F.inline(
                F.array(
                    F.struct(at.alias("_at"), amount.alias("_s"), F.lit(1).alias("_in"), F.lit(0).alias("_out")),
                    F.struct((at + F.lit(width_us)).alias("_at"), (-amount).cast(f"decimal(38,{scale})").alias("_s"),
                             F.lit(0).alias("_in"), F.lit(1).alias("_out")),
                )
            ),
        )
        .withColumn("_slice", F.expr(f"_at div {slice_us}"))
        # The join below infers this for one side; stated here, both sides share one shuffle.
        .where(F.col("_slice").isNotNull())
        .groupBy("_key", "_slice", "_at")
        .agg(F.sum("_s").alias("_s"), F.sum("_in").alias("_in"), F.sum("_out").alias("_out"))
    )
    before = Window.partitionBy("_key").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    net = F.col("_in") - F.col("_out")
    carried = changes.groupBy("_key", "_slice").agg(F.sum("_s").alias("_ts"), F.sum(net).alias("_tn")).select(
        "_key", "_slice",
        F.coalesce(F.sum("_ts").over(before), F.lit(0)).alias("_cs"),
        F.coalesce(F.sum("_tn").over(before), F.lit(0)).alias("_cn"),
    )
    inside = Window.partitionBy("_key", "_slice").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    total = (F.col("_cs") + F.sum("_s").over(inside)).cast("double")
    count = F.col("_cn") + F.sum(net).over(inside)
    means = (
        changes.join(carried, ["_key", "_slice"])
        .select("_key", "_at", "_in", F.try_divide(total, count).alias(out))
        .where("_in > 0")
        .select("_key", "_at", out)
    )
    rows = df.withColumn("_key", F.col(key)).withColumn("_at", at)
    return rows.join(means, ["_key", "_at"], "left").drop("_key", "_at")


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Newest row of every key; keys compare null-safely, and a key without any time keeps a row.

    Two steps, so that the rows are never sorted: a hash aggregate finds the newest ``order[0]`` of each key, each task
    sending one small row a key, and the join back keeps rows of that time. Only these are ordered by the
    rest of ``order`` and the other columns.
    """
    first, *others = order
    ties = [*others, *[c for c in df.columns if c not in keys and c not in order]]
    newest = df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.max(first).alias("_newest"))
    same = F.col(first).eqNullSafe(F.col("_newest"))
    for i, k in enumerate(keys):
        same &= F.col(k).eqNullSafe(F.col(f"_k{i}"))
    rows = df.join(newest, same, "left_semi")
    if not ties:
        return rows.dropDuplicates(keys)
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in ties]))
    return rows.withColumn("_place", place).where("_place = 1").drop("_place")


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First row of every key in an explicit order; null keys form one group."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    oldest = F.min_by(F.struct(*rest), F.struct(*order, *[c for c in rest if c not in order]))
    return df.groupBy(*keys).agg(oldest.alias("_r")).select(*keys, "_r.*").select(*df.columns)


def ranked(
    df: DataFrame, score: str = "score_global", key: str = C.REGION, band: int = 3,
    rank_col: str = "rang", band_col: str = "bande",
) -> DataFrame:
    """Rank by score, best first, with the top and bottom bands marked.

    The input has one row per region, which bounds the single ordered window.
    """
    position = F.row_number().over(
        Window.orderBy(F.coalesce(F.col(score), F.lit(0.0)).desc(), F.col(key).asc())
    )
    size = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    marked = (
        F.when(F.col(rank_col) <= band, F.lit("top"))
        .when(F.col(rank_col) > F.col("_n") - band, F.lit("bottom"))
        .otherwise(F.lit("middle"))
    )
    return df.withColumn(rank_col, position).withColumn("_n", size).withColumn(band_col, marked).drop("_n")


def top_regions(df: DataFrame, n: int = 5, score: str = "score_global", key: str = C.REGION) -> DataFrame:
    return df.orderBy(F.coalesce(F.col(score), F.lit(0.0)).desc(), F.col(key).asc()).limit(n)


def outlier_bounds(df: DataFrame, value: str, sigmas: float = 3.0) -> Column:
    """One struct with count, mean, and the lower (never negative) and upper bound."""
    stats = df.agg(
        F.count(value).alias("n"), F.avg(value).alias("m"), F.stddev_samp(value).alias("s")
    ).select(
        F.struct(
            F.col("n"),
            F.col("m").alias("mean"),
            F.greatest(F.col("m") - F.lit(sigmas) * F.col("s"), F.lit(0.0)).alias("low"),
            (F.col("m") + F.lit(sigmas) * F.col("s")).alias("high"),
        ).alias("b")
    )
    return stats.scalar()


def outliers(
    df: DataFrame, value: str = "prix_m2_median", sigmas: float = 3.0, min_rows: int = C.MIN_OUTLIER_ROWS,
) -> DataFrame:
    """Rows outside mean ± sigmas·std of the whole table, none below ``min_rows`` values.

    Adds ``borne_moyenne``, ``borne_haute`` and ``severity``.
    """
    v = F.col(value)
    hit = (F.col("_b.n") >= min_rows) & ((v > F.col("_b.high")) | (v < F.col("_b.low")))
    return (
        df.withColumn("_b", outlier_bounds(df, value, sigmas))
        .where(v.isNotNull() & hit)
        .select(
            *df.columns,
            F.col("_b.mean").alias("borne_moyenne"),
            F.col("_b.high").alias("borne_haute"),
            F.when(v <= 0, F.lit("error")).otherwise(F.lit("warning")).alias("severity"),
        )
    )
