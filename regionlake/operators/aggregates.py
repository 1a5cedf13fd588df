"""Grouped statistics of sales, points, sensors and batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from regionlake import config as C
from regionlake.functions.cleaning import round_half_even
from regionlake.operators.quantiles import SKETCH_ACCURACY, group_medians


def price_stats(
    sales: DataFrame, kinds: tuple[str, ...] = C.SaleRules().kinds,
    key: str = C.REGION, year: str = C.YEAR, exact: bool = True, digits: int | None = 0,
) -> DataFrame:
    """Price, volume and kind counts by (region, year).

    ``exact=False`` takes the medians from a mergeable sketch: one pass, rank error
    at most 1 / 10000.
    """
    extra = [
        F.avg("prix_m2").alias("prix_m2_moyen"),
        F.count("prix_m2").alias("nb_transactions"),
        *kind_counts("type_local", kinds),
    ]
    known = sales.where(F.col(key).isNotNull() & F.col(year).isNotNull())
    wanted = {"prix_m2_median": "prix_m2", "surface_mediane": "surface_reelle_bati"}
    if exact:
        out = group_medians(known, [key, year], wanted, extra)
    else:
        sketches = [F.percentile_approx(c, 0.5, SKETCH_ACCURACY).alias(o) for o, c in wanted.items()]
        out = known.groupBy(key, year).agg(*sketches, *extra)
    if digits is not None:
        for c in ("prix_m2_median", "prix_m2_moyen"):
            out = out.withColumn(c, round_half_even(c, digits))
    return out.select(
        key, year, "prix_m2_median", "prix_m2_moyen", "nb_transactions", "surface_mediane", *kinds
    )


def kind_counts(column: str, values: tuple[str, ...]) -> list[Column]:
    """One conditional count per value; a value that never occurs still gets its zero column."""
    return [F.count_if(F.col(column) == F.lit(v)).alias(v) for v in values]


def pivot_counts(df: DataFrame, keys: list[str], column: str, values: tuple[str, ...]) -> DataFrame:
    """Rows per key and category as columns, zero-filled, in one aggregation."""
    return df.where(_present(keys)).groupBy(*keys).agg(*kind_counts(column, values))


def class_counts(df: DataFrame, column: str, names: dict[str, str], key: str = C.REGION) -> DataFrame:
    """Points per class by region, one wide row per region."""
    counts = [F.count_if(F.col(column) == F.lit(v)).alias(out) for v, out in names.items()]
    return df.where(_present([key])).groupBy(key).agg(*counts)


def count_by(df: DataFrame, keys: list[str], out: str) -> DataFrame:
    """Rows per key; rows without a key are dropped."""
    return df.where(_present(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def sum_by(df: DataFrame, keys: list[str], column: str, out: str) -> DataFrame:
    """Sum per key; a group without values sums to zero."""
    return df.where(_present(keys)).groupBy(*keys).agg(F.coalesce(F.sum(column), F.lit(0)).alias(out))


def mean_by(df: DataFrame, keys: list[str], names: dict[str, str]) -> DataFrame:
    """Means of several measures per key (``{output: input}``)."""
    return df.where(_present(keys)).groupBy(*keys).agg(*[F.avg(c).alias(o) for o, c in names.items()])


def median_by(df: DataFrame, keys: list[str], column: str, out: str) -> DataFrame:
    """Exact median per key."""
    return group_medians(df.where(_present(keys)), keys, {out: column})


def region_overview(gold: DataFrame, key: str = C.REGION, digits: int | None = 0) -> DataFrame:
    """Average yearly median and total volume per region, sorted."""
    mean = F.avg("prix_m2_median")
    return (
        gold.groupBy(key)
        .agg(
            (mean if digits is None else round_half_even(mean, digits)).alias("prix_m2_median_global"),
            F.sum("nb_transactions").alias("nb_transactions_total"),
        )
        .orderBy(key)
    )


def batch_stats(batch: DataFrame, key: str = C.REGION, *more: Column) -> DataFrame:
    """Count, median and mean price of one micro-batch by region, and ``more`` aggregates."""
    extra = [F.count("prix_m2").alias("nb_transactions"), F.avg("prix_m2").alias("prix_m2_moyen"), *more]
    return group_medians(batch.where(_present([key])), [key], {"prix_m2_median": "prix_m2"}, extra)


def consolidated(batches: DataFrame, key: str = C.REGION) -> DataFrame:
    """Totals over all micro-batches: sum of counts, median of medians, number of batches."""
    extra = [
        F.sum("nb_transactions").alias("nb_transactions_total"),
        F.count_distinct("batch_id").alias("nb_batchs"),
    ]
    out = group_medians(batches.where(_present([key])), [key], {"prix_m2_median_stream": "prix_m2_median"}, extra)
    return out.select(key, "nb_transactions_total", "prix_m2_median_stream", "nb_batchs")


def lake_statistics(gold: DataFrame, key: str = C.REGION, year: str = C.YEAR) -> DataFrame:
    """One row over the yearly table: rows, regions, years, volume, median of medians.

    The yearly table has one row per (region, year), so its single group is small.
    """
    return gold.agg(
        F.count(F.lit(1)).alias("gold_rows"),
        F.count_distinct(key).alias("arrondissements_covered"),
        F.array_sort(F.collect_set(year)).alias("years_covered"),
        F.coalesce(F.sum("nb_transactions"), F.lit(0)).alias("nb_transactions_total"),
        round_half_even(F.median("prix_m2_median"), 0).alias("prix_m2_median_paris"),
    )


def latest_year(df: DataFrame, year: str = C.YEAR) -> DataFrame:
    """Rows of the newest year."""
    return df.where(F.col(year) == df.agg(F.max(year)).scalar())


def volume_by_year(gold: DataFrame, year: str = C.YEAR) -> DataFrame:
    return gold.groupBy(year).agg(F.sum(F.coalesce("nb_transactions", F.lit(0))).alias("volume")).orderBy(year)


def city_kpis(
    gold: DataFrame, wanted: int, key: str = C.REGION, year: str = C.YEAR, region: int | None = None,
) -> DataFrame:
    """Key figures of one year: median price (zeros ignored), median change, volume, social share.

    With ``region`` the figures are that region's own, and its social stock stands in
    for a missing share. The share falls back to every year when the wanted one has none. Medians run over one row per region.
    """
    scope = gold if region is None else gold.where(F.col(key) == region)
    of_year = scope.where(F.col(year) == wanted)
    figures = of_year.agg(
        F.median(F.when(F.col("prix_m2_median") != 0, F.col("prix_m2_median"))).alias("prix_m2_median"),
        F.median("prix_m2_variation_pct").alias("variation_pct"),
        F.coalesce(F.sum("nb_transactions"), F.lit(0)).alias("nb_transactions"),
    )
    if "part_logements_sociaux_pct" not in gold.columns:
        return figures.withColumn("part_logements_sociaux_pct", F.lit(None).cast("double"))
    social = scope
    if "nb_logements_sociaux" in gold.columns:
        social = social.where(F.col("nb_logements_sociaux").isNotNull())
    else:
        social = social.where(F.col("part_logements_sociaux_pct").isNotNull())
    share = F.col("part_logements_sociaux_pct")
    if region is not None and "nb_logements_sociaux" in gold.columns:
        share = F.coalesce(share, F.col("nb_logements_sociaux").cast("double"))
    shares = social.agg(
        F.median(F.when(F.col(year) == wanted, share)).alias("own"),
        F.count_if(F.col(year) == wanted).alias("rows"),
        F.median(share).alias("any"),
    ).select(F.when(F.col("rows") > 0, F.col("own")).otherwise(F.col("any")).alias("s"))
    return figures.withColumn("part_logements_sociaux_pct", shares.scalar())


def colour_classes(df: DataFrame, value: str, stops: int = 10, key: str = C.REGION) -> DataFrame:
    """Linear position of a value between the table's extremes on a scale of ``stops`` stops."""
    bounds = df.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi")).alias("b")).scalar()
    share = F.try_divide(F.col(value) - F.col("_b.lo"), F.col("_b.hi") - F.col("_b.lo"))
    place = F.when(F.col(value).isNotNull(), F.floor(F.lit(stops - 1) * F.coalesce(share, F.lit(0.0))).cast("int"))
    return df.withColumn("_b", bounds).select(
        *df.columns,
        F.col("_b.lo").alias("valeur_min"),
        F.col("_b.hi").alias("valeur_max"),
        place.alias("classe"),
    )


def _present(keys: list[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def price_rollup(sales: DataFrame, key: str = C.REGION, year: str = C.YEAR) -> DataFrame:
    """Volume, mean price and turnover by (region, year), by region and for the city, from one scan.

    ``niveau`` says which of the three a row is; a missing region or year in the data stays
    apart from the one that a coarser level leaves out.
    """
    level = F.grouping_id()
    return sales.rollup(key, year).agg(
        level.alias("_level"), F.count("prix_m2").alias("nb_transactions"), F.avg("prix_m2").alias("prix_m2_moyen"),
        F.sum("valeur_fonciere").alias("valeur_totale"), F.min("prix_m2").alias("prix_m2_min"), F.max("prix_m2").alias("prix_m2_max"),
    ).select(
        F.when(F.col("_level") == 0, F.lit("arrondissement_annee")).when(F.col("_level") == 1, F.lit("arrondissement"))
        .otherwise(F.lit("ville")).alias("niveau"),
        key, year, "nb_transactions", "prix_m2_moyen", "valeur_totale", "prix_m2_min", "prix_m2_max",
    )
