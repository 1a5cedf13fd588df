"""Air readings: fallback, alerts, rolling mean and event table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from regionlake import config as C
from regionlake.functions.cleaning import alert_level, first_truthy, region_of_code, round_half_even
from regionlake.operators.sizing import Spine
from regionlake.session import durable
from regionlake.streaming.sales import append_to
from regionlake.streaming.state import late_rows, rolling_stream

LIVE, FALLBACK = "airparif_live", "bronze_fallback"


def base_table(spine: Spine, index=C.AIR_INDEX_BASE, no2=C.AIR_NO2_BASE, pm25=C.AIR_PM25_BASE) -> DataFrame:
    """Reference reading per region."""
    lookup = lambda values: spine.literal(C.by_region(values))
    return spine.df.select(
        spine.key, lookup(index).alias("iqa_base"), lookup(no2).alias("no2_base"), lookup(pm25).alias("pm25_base")
    )


def spread_reading(readings: DataFrame, base: DataFrame, columns: dict[str, str], key: str = C.REGION,
                   digits: int | None = 1) -> DataFrame:
    """A territory-wide reading split over its regions in proportion to their base values.

    ``columns`` maps a reading column to its base column. The base table (one row per
    region) travels as one array, so every reading is exploded in place.
    """
    shares = base.agg(
        F.array_sort(F.collect_list(F.struct(key, *columns.values()))).alias("a"),
        *[F.avg(b).alias(f"m_{b}") for b in columns.values()],
    ).select(
        F.transform("a", lambda r: F.struct(r[key].alias(key), *[
            (r[b] / F.col(f"m_{b}")).alias(b) for b in columns.values()
        ])).alias("s")
    )
    rest = [c for c in readings.columns if c not in columns]
    exploded = readings.withColumn("_s", shares.scalar()).select(*readings.columns, F.explode("_s").alias("_r"))

    def part(c: str, b: str) -> Column:
        v = F.col(c).cast("double") * F.col(f"_r.{b}")
        return (v if digits is None else round_half_even(v, digits)).alias(c)

    return exploded.select(*rest, F.col(f"_r.{key}").alias(key), *[part(c, b) for c, b in columns.items()])


def live_readings(raw: DataFrame, spine: Spine) -> DataFrame:
    """Live records as (region, iqa, no2, pm25); a missing measure takes the region's base value."""
    code = F.coalesce(F.nullif("commune_code", F.lit("")), F.col("insee"))
    rest = [c for c in ("timestamp",) if c in raw.columns]
    rows = raw.select(
        *rest,
        region_of_code(code, C.COMMUNE_PREFIX, spine.size).alias(spine.key),
        first_truthy("indice", "iqa").try_cast("double").alias("iqa"),
        F.nullif(F.col("no2").try_cast("double"), F.lit(0.0)).alias("no2"),
        first_truthy("pm25", "pm2_5").try_cast("double").alias("pm25"),
    ).where(F.col(spine.key).isNotNull())
    return rows.select(
        *rest, spine.key,
        F.coalesce("iqa", spine.literal(C.by_region(C.AIR_INDEX_BASE))).alias("iqa"),
        F.coalesce("no2", spine.literal(C.by_region(C.AIR_NO2_BASE))).alias("no2"),
        F.coalesce("pm25", spine.literal(C.by_region(C.AIR_PM25_BASE))).alias("pm25"),
        F.lit(LIVE).alias("source"),
    )


def with_fallback(live: DataFrame, fallback: DataFrame, keys: list[str]) -> DataFrame:
    """Live rows, and fallback rows only for keys without a live one."""
    tagged = live.withColumn("source", F.lit(LIVE)).unionByName(fallback.withColumn("source", F.lit(FALLBACK)))
    best = F.min_by(
        F.struct(*[c for c in tagged.columns if c not in keys]),
        F.struct((F.col("source") != LIVE).alias("late"), *[c for c in tagged.columns if c not in keys]),
    )
    return tagged.groupBy(*keys).agg(best.alias("b")).select(*keys, "b.*").select(*tagged.columns)


def events_of(readings: DataFrame, ts: str = "timestamp", key: str = C.REGION, more: tuple[str, ...] = ()) -> DataFrame:
    """Readings as event rows with their alert level, and ``more`` of their columns; stateless, so it runs on streams."""
    return readings.select(
        F.lit("air_quality").alias("type"), "source", F.col(ts).cast("timestamp").alias("ingested_at"),
        F.col(ts).cast("timestamp").alias("timestamp"), key, "iqa",
        F.col("no2").alias("no2_µg_m3"), F.col("pm25").alias("pm25_µg_m3"), alert_level("iqa").alias("alert_level"), *more,
    )


def alerts_of(events: DataFrame, key: str = C.REGION) -> DataFrame:
    """Side output: events above a threshold with a readable message."""
    red = F.col("alert_level") == C.LEVEL_RED
    text = F.concat(
        F.when(red, F.lit("POLLUTION FORTE — Arr.")).otherwise(F.lit("Pollution modérée — Arr.")),
        F.col(key).cast("string"), F.lit(" IQA="), F.rint("iqa").cast("bigint").cast("string"),
        F.when(red, F.lit(f" > {int(C.ALERT_RED)}")).otherwise(F.lit(f" > {int(C.ALERT_ORANGE)}")),
    )
    return events.where(F.col("alert_level").isNotNull()).select(
        key, F.col("alert_level").alias("level"), "iqa", "ingested_at", text.alias("message")
    )


def sliding_means(stream: DataFrame, ts: str = "ingested_at", width: str = "24 hours", slide: str = "1 hour",
                  delay: str = "1 hour", key: str = C.REGION, value: str = "iqa") -> DataFrame:
    """Hourly refreshed 24 h means as a plain streaming aggregate (state per window, not per row)."""
    return (
        stream.where(F.col(key).isNotNull())
        .withWatermark(ts, delay)
        .groupBy(F.window(ts, width, slide).alias("w"), F.col(key))
        .agg(F.avg(value).alias("iqa_mean"), F.count(value).alias("n_mesures"))
        .select(F.col("w.start").alias("debut"), F.col("w.end").alias("fin"), key, "iqa_mean", "n_mesures")
    )


def run_air_stream(events: DataFrame, table: str, checkpoint: str, interval: str | None = None, hours: int = 24, key: str = C.REGION,
                   ts: str = "ingested_at", digits: int | None = 1, delay: str = "1 hour", unique: list[str] | None = None):
    """Store events with the rolling mean of their region, partitioned by day.

    The mean comes from keyed state, so nothing stored is read again. The file sink lists a batch's
    files once, so a repeated batch adds nothing.
    """
    means = rolling_stream(events, key, ts, "iqa", "iqa_24h_mean", hours, delay, unique)
    return _stored(means, table, checkpoint, interval, ts, digits)


def run_reading_stream(readings: DataFrame, table: str, checkpoint: str, interval: str | None = None, hours: int = 24, key: str = C.REGION,
                       ts: str = "timestamp", digits: int | None = 1, delay: str = "1 hour", unique: list[str] | None = None):
    """``run_air_stream`` of the events of readings; what follows from a reading alone is added after the keyed state."""
    rows = readings.select(F.col(ts).cast("timestamp").alias(ts), key, "source", "iqa", "no2", "pm25")
    means = rolling_stream(rows, key, ts, "iqa", "iqa_24h_mean", hours, delay, unique)
    return _stored(events_of(means, ts, key, ("iqa_24h_mean",)), table, checkpoint, interval, "ingested_at", digits)


def _stored(means: DataFrame, table: str, checkpoint: str, interval: str | None, ts: str, digits: int | None):
    if digits is not None:
        means = means.withColumn("iqa_24h_mean", round_half_even("iqa_24h_mean", digits))
    return append_to(means.withColumn("jour", F.col(ts).cast("date")), table, checkpoint, interval, "jour")


def run_alert_stream(spark: SparkSession, table: str, alerts: str, checkpoint: str, interval: str | None = None, key: str = C.REGION,
                     ts: str = "ingested_at"):
    """Side output: the stored events above a threshold, followed as a stream of their own."""
    events = spark.readStream.schema(spark.read.parquet(table).schema).parquet(table)
    return append_to(alerts_of(events, key).withColumn("jour", F.col(ts).cast("date")), alerts, checkpoint, interval, "jour")


def run_late_stream(events: DataFrame, table: str, checkpoint: str, interval: str | None = None, ts: str = "ingested_at", delay: str = "1 hour"):
    """Side table of the events that came too late for ``run_air_stream`` with the same source and ``delay``."""
    return append_to(late_rows(events, ts, delay), table, checkpoint, interval)


def live_cycles(raw: DataFrame) -> DataFrame:
    """(timestamp, iqa, no2, pm25) of each landed response: the feature with the newest date, the first on a tie; 0 where a measure misses."""
    place = lambda f, i: F.struct(F.coalesce(f["properties"]["date_ech"], F.lit("")).alias("at"), (-i).alias("i"), f["properties"].alias("p"))
    newest = F.array_max(F.transform(F.coalesce("features", F.array().cast(raw.schema["features"].dataType)), place))["p"]
    number = lambda c: F.coalesce(newest[c].try_cast("double"), F.lit(0.0))
    return raw.select("timestamp", number("valeur").alias("iqa"), number("val_no2").alias("no2"), number("val_pm25").alias("pm25"))


def live_events(raw: DataFrame, spine: Spine, fallback: DataFrame | None = None) -> DataFrame:
    """Responses as one reading per region: spread by the regions' base values where the index is positive, else the fallback's.

    Stateless: each response meets the spine's regions, then the base and fallback table (one row a region) through an equi join.
    ``fallback`` has the region, ``iqa_moyen``, ``no2_µg_m3`` and ``pm25_µg_m3``; what it lacks takes the base value.
    """
    key, measures = spine.key, {"iqa": "iqa_moyen", "no2": "no2_µg_m3", "pm25": "pm25_µg_m3"}
    base = base_table(spine)
    means = base.agg(F.struct(*[F.avg(f"{m}_base").alias(m) for m in measures]).alias("m")).scalar()
    known = base if fallback is None else base.join(fallback.select(key, *measures.values()), key, "left")
    static = durable(known.withColumn("_m", means).select(key, *[F.struct(
        (F.col(f"{m}_base") / F.col(f"_m.{m}")).alias("share"), F.col(f"{m}_base").alias("base"),
        F.coalesce(F.col(c).cast("double") if fallback is not None else F.lit(None).cast("double"), F.col(f"{m}_base")).alias("other"),
    ).alias(f"_{m}") for m, c in measures.items()]))
    regions = F.array(*[F.lit(r[0]) for r in spine.df.orderBy(key).collect()])  # one entry a region
    rows = live_cycles(raw).withColumn(key, F.explode(regions)).join(spine.hinted(static), key)
    live = F.col("iqa") > 0

    def reading(m: str) -> Column:
        spread = F.nullif(round_half_even(F.col(m) * F.col(f"_{m}.share"), 1), F.lit(0.0))
        return F.when(live, F.coalesce(spread, F.col(f"_{m}.base"))).otherwise(F.col(f"_{m}.other")).alias(m)

    return rows.select("timestamp", key, *[reading(m) for m in measures], F.when(live, F.lit(LIVE)).otherwise(F.lit(FALLBACK)).alias("source"))
