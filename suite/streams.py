"""Streaming jobs over the event table, run until the landed data is used up (T rows)."""

from pyspark.sql import functions as F

from regionlake import config as C
from regionlake.plans.serving import latest_readings
from regionlake.session import scratch_path, settings
from regionlake.sources.files import counted
from regionlake.sources.sinks import append_events
from regionlake.streaming import air, sales
from suite import domain as D
from suite.registry import FRAGMENTS, ROLLING, ROLLING_WINDOW, half_even, query, with_


BATCHES, FILES = 4, 16  # micro-batches of a stream, and landed files of each


def in_parts(events):
    """The events with ``_part``, the quarter of their time span."""
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    low, high = events.agg(F.min(at), F.max(at)).first()
    return events.withColumn("_part", F.floor((at - low) * BATCHES / F.lit(high - low + 1)))


def land(parts, folder):
    """One part after the other as ``FILES`` files, so that each becomes a micro-batch.

    Spark writes no file for a task without rows, so a part of few rows gets files without rows for those that lack.
    A part's shuffle files go with its write.
    """
    for part in range(BATCHES):
        rows = parts.where(F.col("_part") == part).drop("_part")
        with settings(parts.sparkSession, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true"):
            rows.repartition(FILES).write.mode("append").parquet(folder)
        for _ in range((part + 1) * FILES - counted(parts.sparkSession, f"{folder}/part-*.parquet")):
            rows.limit(0).coalesce(1).write.mode("append").parquet(folder)


def event_stream(spark, sf):
    """The event table as air readings that land in parts of equal time spans, one part a micro-batch."""
    events, folder = D.table(spark, sf, "events"), scratch_path(spark, "landed")
    land(in_parts(events), folder)
    return D.of_events(sales.read_stream(spark, folder, events.schema, files_per_batch=FILES))


FRAGMENTS["landed"] = (("readings",), f"""
    SELECT *, CAST(floor((epoch_us(ingested_at) - low) * {BATCHES} / (high - low + 1)) AS INT) AS batch_id
    FROM readings, (SELECT min(epoch_us(ingested_at)) AS low, max(epoch_us(ingested_at)) AS high FROM readings)""")


def finish(started):
    started.awaitTermination()
    if started.exception():
        raise started.exception()


def sales_run(spark, sf, log=None):
    out, mark = scratch_path(spark, "batches"), scratch_path(spark, "mark")
    stream = event_stream(spark, sf).select(
        C.REGION, F.col("iqa").alias("prix_m2"), F.col("ingested_at").alias("timestamp"))
    return sales.run_sales_stream(stream, out, mark, log=log), out


@query("t01_t03_micro_batch", with_("landed") + """
    SELECT arrondissement, count(iqa) AS nb_transactions, round(median(iqa), 8) AS prix_m2_median, round(avg(iqa), 8) AS prix_m2_moyen,
           batch_id FROM landed GROUP BY arrondissement, batch_id""")
def micro_batch(spark, sf):
    started, out = sales_run(spark, sf)
    finish(started)
    df = spark.read.parquet(out)
    return df.select(C.REGION, "nb_transactions", F.round("prix_m2_median", 8).alias("prix_m2_median"),
                     F.round("prix_m2_moyen", 8).alias("prix_m2_moyen"), "batch_id")


@query("s11_batch_log", with_("landed") + """
    SELECT batch_id, count(*) AS n_records, (SELECT count(DISTINCT arrondissement) FROM readings) AS regions, true AS timed FROM landed GROUP BY 1""")
def batch_log(spark, sf):
    """The log row of each batch as Spark's progress reports it, and the consolidated table over all."""
    path = scratch_path(spark, "log")
    log = sales.logged(spark, path, "batches")
    started, out = sales_run(spark, sf, log)
    log.finish(started)
    regions = sales.consolidate(spark, out).agg(F.count(F.lit(1))).scalar()
    timed = (F.col("elapsed_ms") > 0) & (F.col("output") == "batches") & F.col("ts").isNotNull()
    return spark.read.parquet(path).select("batch_id", "n_records", regions.alias("regions"), timed.alias("timed"))


@query("t02_tumbling_window", with_("readings") + """
    SELECT date_trunc('day', ingested_at) AS debut, arrondissement, count(iqa) AS nb_transactions, median(iqa) AS prix_m2_median,
           round(avg(iqa), 8) AS prix_m2_moyen FROM readings GROUP BY 1, 2
    HAVING date_trunc('day', ingested_at) + INTERVAL 1 DAY <= (SELECT max(ingested_at) - INTERVAL 10 MINUTES FROM readings)""")
def tumbling(spark, sf):
    out, mark = scratch_path(spark, "windows"), scratch_path(spark, "mark")
    stream = event_stream(spark, sf).select(C.REGION, F.col("iqa").alias("prix_m2"), F.col("ingested_at").alias("timestamp"))
    finish(sales.append_to(sales.windowed_stats(stream, width="1 day"), out, mark))
    return spark.read.parquet(out).select(
        F.col("debut").cast("timestamp_ntz").alias("debut"), C.REGION, "nb_transactions", "prix_m2_median",
        F.round("prix_m2_moyen", 8).alias("prix_m2_moyen"))


@query("t04_sliding_means", with_("readings") + """
    , w AS (SELECT arrondissement, iqa, unnest(range(date_trunc('day', ingested_at) - INTERVAL 24 HOURS, ingested_at + INTERVAL 1 MICROSECOND, INTERVAL 6 HOURS)) AS debut, ingested_at FROM readings)
    SELECT debut, arrondissement, round(avg(iqa), 8) AS iqa_mean, count(*) AS n_mesures FROM w
    WHERE debut <= ingested_at AND ingested_at < debut + INTERVAL 24 HOURS GROUP BY 1, 2
    HAVING debut + INTERVAL 24 HOURS <= (SELECT max(ingested_at) - INTERVAL 1 HOUR FROM readings)""")
def sliding(spark, sf):
    out, mark = scratch_path(spark, "sliding"), scratch_path(spark, "mark")
    means = air.sliding_means(event_stream(spark, sf), slide="6 hours")
    finish(sales.append_to(means, out, mark))
    return spark.read.parquet(out).select(
        F.col("debut").cast("timestamp_ntz").alias("debut"), C.REGION, F.round("iqa_mean", 8).alias("iqa_mean"), "n_mesures")


def air_stream(spark, sf):
    table, mark = scratch_path(spark, "events"), scratch_path(spark, "mark")
    finish(air.run_reading_stream(event_stream(spark, sf), table, mark, ts="ingested_at", digits=None))
    return table


@query("t04_exact_rolling_mean", with_("readings") + f"""
    SELECT ingested_at, arrondissement, iqa, no2, alert_level, {ROLLING} AS iqa_24h_mean FROM readings {ROLLING_WINDOW}""")
def exact_rolling(spark, sf):
    """Events stored by the stream with alert level and the rolling mean from keyed state."""
    return spark.read.parquet(air_stream(spark, sf)).select(
        F.col("ingested_at").cast("timestamp_ntz").alias("ingested_at"), C.REGION, "iqa", F.col("no2_µg_m3").alias("no2"),
        "alert_level", F.round("iqa_24h_mean", 8).alias("iqa_24h_mean"))


@query("t05_alert_output", with_("readings") + f"""
    SELECT arrondissement, alert_level AS level, iqa, ingested_at, CASE alert_level WHEN 'rouge' THEN 'POLLUTION FORTE' ELSE 'Pollution modérée' END
           || ' — Arr.' || arrondissement || ' IQA=' || CAST(CAST({half_even('iqa')} AS BIGINT) AS VARCHAR)
           || CASE alert_level WHEN 'rouge' THEN ' > 100' ELSE ' > 75' END AS message
    FROM readings WHERE alert_level IS NOT NULL""")
def alert_output(spark, sf):
    """Alerts follow the stored events as a stream of their own."""
    out, mark = scratch_path(spark, "alerts"), scratch_path(spark, "mark")
    finish(air.run_alert_stream(spark, air_stream(spark, sf), out, mark))
    return spark.read.parquet(out).select(
        C.REGION, "level", "iqa", F.col("ingested_at").cast("timestamp_ntz").alias("ingested_at"), "message")


def disturbed_stream(spark, sf):
    """The event stream with repeats and late rows: every tenth event lands twice, every seventh again with the
    next part, and every fiftieth lands in the last part with a time a year too early."""
    events, folder = in_parts(D.table(spark, sf, "events")), scratch_path(spark, "disturbed")
    k = F.col("event_id")
    again = events.where(k % 10 == 0)
    next_part = events.where((k % 7 == 0) & (F.col("_part") < BATCHES - 1)).withColumn("_part", F.col("_part") + 1)
    old = events.where(k % 50 == 3).withColumn("ts", F.col("ts") - F.expr("INTERVAL 365 DAYS")).withColumn("_part", F.lit(BATCHES - 1))
    old = old.withColumn("event_id", -k)
    land(events.unionByName(again).unionByName(next_part).unionByName(old), folder)
    return air.events_of(D.of_events(sales.read_stream(spark, folder, events.drop("_part").schema, files_per_batch=FILES)).withColumn(
        "source", F.col("event_id").cast("string")), "ingested_at")


@query("t08_deduplicated", with_("readings") + f"""
    SELECT event_id, ingested_at, arrondissement, iqa, {ROLLING} AS iqa_24h_mean FROM readings {ROLLING_WINDOW}""")
def deduplicated(spark, sf):
    """Repeats and late rows change neither the stored events nor their means."""
    table, mark = scratch_path(spark, "events"), scratch_path(spark, "mark")
    finish(air.run_air_stream(disturbed_stream(spark, sf), table, mark, digits=None, unique=["source"]))
    return spark.read.parquet(table).select(
        F.col("source").cast("bigint").alias("event_id"), F.col("ingested_at").cast("timestamp_ntz").alias("ingested_at"), C.REGION, "iqa",
        F.round("iqa_24h_mean", 8).alias("iqa_24h_mean"))


@query("t08_late_rows", with_("landed") + """
    , seen AS (SELECT batch_id + 1 AS batch_id, max(date_trunc('milliseconds', ingested_at)) - INTERVAL 1 HOUR AS mark FROM landed GROUP BY 1)
    SELECT l.event_id, l.ingested_at FROM landed l JOIN seen s ON s.batch_id = l.batch_id + 1
    WHERE l.event_id % 7 = 0 AND l.batch_id < 3 AND l.ingested_at < s.mark
    UNION ALL SELECT -event_id, ingested_at - INTERVAL 365 DAYS FROM landed WHERE event_id % 50 = 3""")
def late(spark, sf):
    """The side table: repeats that come a part too late, and rows a year old."""
    table, mark = scratch_path(spark, "late"), scratch_path(spark, "mark")
    finish(air.run_late_stream(disturbed_stream(spark, sf), table, mark))
    return spark.read.parquet(table).select(
        F.col("source").cast("bigint").alias("event_id"), F.col("ingested_at").cast("timestamp_ntz").alias("ingested_at"))


@query("s14_event_append", with_("readings") + """
    SELECT arrondissement, count(*) AS n, max(ingested_at) AS dernier FROM readings GROUP BY 1""")
def event_append(spark, sf):
    """The event stream appended through the file sink, plus a batch append of the consolidated rows."""
    path, mark = scratch_path(spark, "appended"), scratch_path(spark, "mark")
    stream = event_stream(spark, sf).where("source = 'view'").select("event_id", C.REGION, "ingested_at")
    finish(sales.append_to(stream, f"{path}/flux", mark))
    append_events(D.readings(spark, sf).where("source <> 'view'").select("event_id", C.REGION, "ingested_at"), f"{path}/lot")
    both = spark.read.parquet(f"{path}/flux").unionByName(spark.read.parquet(f"{path}/lot"))
    return both.groupBy(C.REGION).agg(
        F.count(F.lit(1)).alias("n"), F.max("ingested_at").cast("timestamp_ntz").alias("dernier"))


@query("t06_latest_state", with_("readings") + """
    SELECT arrondissement, iqa, source FROM readings QUALIFY row_number() OVER (PARTITION BY arrondissement ORDER BY ingested_at DESC) = 1""")
def latest_state(spark, sf):
    return latest_readings(D.readings(spark, sf).select(C.REGION, "ingested_at", "iqa", "source")).drop("ingested_at")


@query("t07_source_fallback", """
    WITH r AS (SELECT event_id, event_type, CAST(user_id % 20 + 1 AS INT) AS arrondissement, value FROM events)
    SELECT event_id, arrondissement, CASE WHEN event_type = 'click' THEN value ELSE value / 2e0 END AS iqa,
           CASE WHEN event_type = 'click' THEN 'airparif_live' ELSE 'bronze_fallback' END AS source FROM r""")
def source_fallback(spark, sf):
    """Only clicks have a live row; the fallback covers every key."""
    both = D.readings(spark, sf)
    rows = both.select("event_id", C.REGION, "iqa")
    live = both.where(F.col("source") == "click").select("event_id", C.REGION, "iqa")
    return air.with_fallback(live, rows.withColumn("iqa", F.col("iqa") / 2.0), [C.REGION, "event_id"])


@query("t07_live_normalised", """
    SELECT event_id, arrondissement, CASE WHEN event_id % 4 = 0 THEN [52,54,50,51,48,47,45,58,56,55,53,49,51,47,48,44,53,62,64,60][arrondissement]::DOUBLE ELSE value END AS iqa
    FROM (SELECT event_id, CAST(user_id % 20 + 1 AS INT) AS arrondissement, value FROM events)""")
def live_normalised(spark, sf):
    """Live records under one schema; a missing index takes the region's reference value."""
    r = D.readings(spark, sf)
    code = F.concat(F.lit("751"), F.lpad(F.col(C.REGION).cast("string"), 2, "0"))
    raw = r.select(
        F.col("event_id").alias("timestamp"), F.lit("").alias("commune_code"), code.alias("insee"),
        F.when(F.col("event_id") % 4 != 0, F.col("iqa").cast("string")).alias("indice"), F.lit(None).cast("string").alias("iqa"),
        F.lit("1").alias("no2"), F.lit(None).cast("string").alias("pm25"), F.lit("2").alias("pm2_5"))
    return air.live_readings(raw, D.spine(spark, 20)).select(F.col("timestamp").alias("event_id"), C.REGION, "iqa")


BASES = {"iqa": C.AIR_INDEX_BASE, "no2": C.AIR_NO2_BASE, "pm25": C.AIR_PM25_BASE}
SPREAD = {m: half_even(f"{m} * ({list(map(float, v))}[r] / {sum(v) / len(v)!r}::DOUBLE)", 1) for m, v in BASES.items()}


# Means over 32 readings lie on halves of the sixth decimal, where the sides' roundings differ: both cut at 0.7 there.
@query("t07_live_stream", f"""
    WITH cycles AS (
      SELECT ts, event_id % 4 <> 1 AND value > 0 AS live, CASE WHEN event_id % 4 = 1 THEN 0e0 ELSE value END AS iqa,
             CAST(user_id % 50 AS DOUBLE) AS no2, 7e0 AS pm25 FROM events),
    readings AS (
      SELECT ts AS ingested_at, r::INT AS arrondissement,
             CASE WHEN live THEN coalesce(nullif({SPREAD['iqa']}, 0), {list(map(float, C.AIR_INDEX_BASE))}[r]) WHEN r % 3 <> 0 THEN known ELSE {list(map(float, C.AIR_INDEX_BASE))}[r] END AS iqa,
             CASE WHEN live THEN coalesce(nullif({SPREAD['no2']}, 0), {list(map(float, C.AIR_NO2_BASE))}[r]) ELSE {list(map(float, C.AIR_NO2_BASE))}[r] END AS no2,
             CASE WHEN live THEN 'airparif_live' ELSE 'bronze_fallback' END AS source
      FROM cycles, range(1, 21) t(r) JOIN (SELECT c_nationkey + 1 AS region, max(c_acctbal) AS known FROM customer GROUP BY 1) k ON k.region = r)
    SELECT ingested_at, arrondissement, iqa, no2, source, floor((avg(iqa) OVER w) * 1e6 + 0.3::DOUBLE) / 1e6 AS iqa_24h_mean FROM readings {ROLLING_WINDOW}""")
def live_stream(spark, sf):
    """Raw responses to stored events: newest feature, spread over the regions, fallback where a response has no index, rolling mean."""
    events, folder = in_parts(D.table(spark, sf, "events")), scratch_path(spark, "responses")
    text = lambda c: F.col(c).cast("string")
    good = F.struct(text("ts").alias("date_ech"), text("value").alias("valeur"), (F.col("user_id") % 50).cast("string").alias("val_no2"), F.lit("7").alias("val_pm25"))
    older = F.struct(F.lit("2000-01-01").alias("date_ech"), F.lit("999").alias("valeur"), F.lit("1").alias("val_no2"), F.lit("1").alias("val_pm25"))
    features = F.when(F.col("event_id") % 4 == 1, F.array().cast("array<struct<properties: struct<date_ech: string, valeur: string, val_no2: string, val_pm25: string>>>")).otherwise(
        F.array(F.struct(older.alias("properties")), F.struct(good.alias("properties"))))
    raw = events.select(F.col("ts").cast("timestamp").alias("timestamp"), features.alias("features"), "_part")
    land(raw, folder)
    regions = D.customers(spark, sf).groupBy(C.REGION).agg(F.max("c_acctbal").alias("known")).select(
        C.REGION, F.when(F.col(C.REGION) % 3 != 0, F.col("known")).alias("iqa_moyen"), F.lit(None).cast("double").alias("no2_µg_m3"),
        F.lit(None).cast("double").alias("pm25_µg_m3"))
    responses = sales.read_stream(spark, folder, raw.drop("_part").schema, files_per_batch=FILES)
    table, mark = scratch_path(spark, "events"), scratch_path(spark, "mark")
    live = air.live_events(responses, D.spine(spark, 20), regions)
    finish(air.run_reading_stream(live, table, mark, digits=None))
    return spark.read.parquet(table).select(
        F.col("ingested_at").cast("timestamp_ntz").alias("ingested_at"), C.REGION, "iqa", F.col("no2_µg_m3").alias("no2"), "source",
        (F.floor(F.col("iqa_24h_mean") * 1e6 + F.lit(0.3)) / 1e6).alias("iqa_24h_mean"))
