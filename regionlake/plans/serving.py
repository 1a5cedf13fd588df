"""The public queries as DataFrame functions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from regionlake import config as C
from regionlake.functions.cleaning import finite, round_half_even
from regionlake.operators.joins import versus
from regionlake.operators.reshape import newest
from regionlake.operators.windows import latest_per_key

PRICE_COLUMNS = ["prix_m2_median", "prix_m2_moyen", "nb_transactions", "prix_m2_variation_pct"]


def check_region(region: int, n_regions: int = C.N_REGIONS) -> int:
    if not 1 <= region <= n_regions:
        raise ValueError(f"region must lie in 1..{n_regions}, got {region}")
    return region


def without_nan(df: DataFrame) -> DataFrame:
    """NaN and infinities of every double column become null."""
    doubles = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}
    return df.select(*[finite(f"`{c}`").alias(c) if c in doubles else F.col(f"`{c}`") for c in df.columns])


def region_detail(gold: DataFrame, region: int, year: int | None = None, key: str = C.REGION,
                  n_regions: int = C.N_REGIONS) -> DataFrame:
    """All years of a region, or one; a region outside the domain is refused."""
    rows = gold.where(F.col(key) == check_region(region, n_regions))
    if year is not None:
        rows = rows.where(F.col(C.YEAR) == year)
    return without_nan(rows.orderBy(C.YEAR))


def prices(gold: DataFrame, region: int | None = None, year_min: int = 2021, year_max: int = 2024,
           key: str = C.REGION) -> DataFrame:
    rows = gold.where(F.col(C.YEAR).between(year_min, year_max))
    if region is not None:
        rows = rows.where(F.col(key) == region)
    return without_nan(rows.select(key, C.YEAR, *PRICE_COLUMNS).orderBy(key, C.YEAR))


def price_history(gold: DataFrame, key: str = C.REGION) -> DataFrame:
    return without_nan(
        gold.select(key, C.YEAR, "prix_m2_median", "nb_transactions", "prix_m2_variation_pct").orderBy(C.YEAR, key)
    )


def indicators(table: DataFrame, region: int | None = None, key: str = C.REGION) -> DataFrame:
    rows = table if region is None else table.where(F.col(key) == region)
    return without_nan(rows.orderBy(key))


@dataclass(frozen=True)
class Comparison:
    prices: DataFrame
    indicators: DataFrame
    measures: DataFrame


def compare(gold: DataFrame, table: DataFrame, a: int, b: int, year: int = 2023, key: str = C.REGION,
            n_regions: int = C.N_REGIONS) -> Comparison:
    """Prices of one year and indicators of two regions, and who wins each measure."""
    for r in (a, b):
        check_region(r, n_regions)
    of_year = gold.where(F.col(key).isin(a, b) & (F.col(C.YEAR) == year))
    wanted = ["prix_m2_median", "nb_transactions", "nb_logements_sociaux", "part_logements_sociaux_pct",
              "revenu_median", "m2_par_revenu_annuel"]
    price_rows = of_year.select(key, C.YEAR, *[c for c in wanted if c in gold.columns]).orderBy(key)
    scores = table.where(F.col(key).isin(a, b)).orderBy(key)
    only_scores = table.drop(*[c for c in wanted if c in table.columns])
    return Comparison(price_rows, scores, versus(price_rows.drop(C.YEAR), only_scores, a, b, key))


def social_housing(gold: DataFrame, region: int | None = None, key: str = C.REGION) -> DataFrame:
    """Social stock per year; rows without the count (or, lacking it, the share) are left out."""
    count = next((c for c in ("nb_logements_sociaux", "nb_logements_sociaux_x") if c in gold.columns), None)
    share = next((c for c in ("part_logements_sociaux_pct", "part_ls_pct") if c in gold.columns), None)
    picked = [F.col(key), F.col(C.YEAR)]
    picked += [F.col(count).alias("nb_logements_sociaux")] if count else []
    picked += [F.col(share).alias("part_logements_sociaux_pct")] if share else []
    if not count and not share:
        return gold.select(*picked).limit(0)
    rows = gold.where(F.col(count or share).isNotNull())
    if region is not None:
        rows = rows.where(F.col(key) == region)
    return without_nan(rows.select(*picked).orderBy(key, C.YEAR))


def stream_latest(table: DataFrame | None, key: str = C.REGION) -> DataFrame | None:
    """Consolidated stream by region; None while no stream has run."""
    return None if table is None else without_nan(table.orderBy(key))


def indicators_long(table: DataFrame, region: int | None = None, category: str | None = None,
                    key: str = C.REGION) -> DataFrame:
    rows = table
    if region is not None:
        rows = rows.where(F.col(key) == region)
    if category is not None:
        rows = rows.where(F.col("categorie") == category)
    return rows.orderBy(key, "categorie", "nom")


def inventory(files: DataFrame, source: str, limit: int = 20) -> DataFrame:
    """Newest landed files of a source, payload left out."""
    rows = files.where(F.col("source") == source).drop("payload")
    return newest(rows, "ingested_at", limit, C.INVENTORY_LIMIT, ["path"])


def events(table: DataFrame, region: int | None = None, limit: int = 50, key: str = C.REGION,
           tie: list[str] | None = None) -> DataFrame:
    """Newest stream events, of one region or of all."""
    rows = table if region is None else table.where(F.col(key) == region)
    return newest(rows, "ingested_at", limit, C.EVENT_LIMIT, tie or [key])


@dataclass(frozen=True)
class AirSummary:
    readings: DataFrame
    alerts: DataFrame
    overview: DataFrame


def air_summary(table: DataFrame, as_of, hours: int = 24, alert_only: bool = False, key: str = C.REGION,
                n_regions: int = C.N_REGIONS, digits: int | None = 1) -> AirSummary:
    """Latest reading, window mean and count per region, active alerts, dominant source.

    Alerts are counted before ``alert_only`` narrows the readings; the dominant source
    is taken over the readings that remain (the smallest name on a tie).
    """
    low, high = C.WINDOW_HOURS
    if not low <= hours <= high:
        raise ValueError(f"hours must lie in {low}..{high}")
    moment = F.lit(as_of).cast("timestamp")
    inside = table.where(
        (F.col("type") == "air_quality")
        & (F.col("ingested_at") >= moment - F.expr(f"INTERVAL {int(hours)} HOURS"))
        & F.col(key).between(1, n_regions)
    )
    mean = F.avg("iqa")
    means = inside.groupBy(key).agg(
        (mean if digits is None else round_half_even(mean, digits)).alias("iqa_mean"), F.count(F.lit(1)).alias("n_mesures"))
    columns = ["iqa", "no2_µg_m3", "pm25_µg_m3", "alert_level", "source", "ingested_at"]
    latest = latest_per_key(inside.select(key, *columns), [key], ["ingested_at", "iqa", "source"]).join(means, key)
    readings = latest.select(
        key, F.col("iqa").alias("iqa_latest"), "iqa_mean", F.col("no2_µg_m3").alias("no2_latest"), F.col("pm25_µg_m3").alias("pm25_latest"),
        "alert_level", F.coalesce("source", F.lit("unknown")).alias("source"), F.col("ingested_at").alias("last_update"), "n_mesures",
    )
    alarmed = F.col("alert_level").isin(C.LEVEL_ORANGE, C.LEVEL_RED)
    alerts = readings.where(alarmed).select(
        key, F.col("iqa_latest").alias("iqa"), "alert_level", F.col("no2_latest").alias("no2"),
        F.col("pm25_latest").alias("pm25"), "last_update",
    ).orderBy(F.coalesce("iqa", F.lit(0.0)).desc(), key)
    shown = readings.where(alarmed) if alert_only else readings
    overview = readings.agg(
        F.count_if(alarmed).alias("alerts_active"),
        F.count(F.lit(1)).alias("regions"),
        (F.mode(F.when(alarmed, F.col("source")), deterministic=True) if alert_only
         else F.mode("source", deterministic=True)).alias("source"),
    ).select(
        F.lit(hours).alias("window_hours"), "alerts_active",
        F.coalesce("source", F.lit("unknown")).alias("source"),
        F.when(F.col("regions") == 0, F.lit("no reading in the window")).alias("message"),
    )
    return AirSummary(shown.orderBy(key), alerts, overview)


def latest_readings(table: DataFrame, key: str = C.REGION, ts: str = "ingested_at") -> DataFrame:
    return latest_per_key(table, [key], [ts])


def feature_table(regions: DataFrame, gold: DataFrame, table: DataFrame, year: int, indicator: str,
                  key: str = C.REGION) -> DataFrame:
    """One row per map feature with the year's prices, the scores, the social share and
    the value of the chosen indicator."""
    of_year = gold.where(F.col(C.YEAR) == year).select(key, *PRICE_COLUMNS)
    score_columns = [c for c in table.columns if c.startswith("score_")]
    out = regions.select(key).join(of_year, key, "left").join(table.select(key, *score_columns), key, "left")
    if "part_logements_sociaux_pct" in gold.columns:
        # The last year's share wins, as a map keeps the last row it reads per region.
        social = gold.where(F.col("part_logements_sociaux_pct").isNotNull()).groupBy(key).agg(
            F.max_by("part_logements_sociaux_pct", C.YEAR).alias("part_logements_sociaux_pct")
        )
        out = out.join(social, key, "left")
    value = finite(indicator) if indicator in out.columns else F.lit(None).cast("double")
    return out.withColumn("valeur", value)
