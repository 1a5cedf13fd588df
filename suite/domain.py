"""The given tables seen as sales, points, sensors and files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from regionlake import config as C
from regionlake.functions.cleaning import alert_level
from regionlake.operators.sizing import Spine
from regionlake.plans import silver
from suite.registry import N


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf}/{name}.parquet")


def spine(spark: SparkSession, n: int = N) -> Spine:
    return Spine.numbered(spark, n)


def gapped(df: DataFrame) -> DataFrame:
    """All rows, with the last two regions' counted for the first two, so that two regions have none."""
    return df.withColumn(C.REGION, (F.col(C.REGION) - 1) % 23 + 1)


def longitude(key: str):
    return (F.lit(22500) + F.col(key) * 7919 % 1700) / F.lit(1e4)


def latitude(key: str):
    return (F.lit(488000) + F.col(key) * 104729 % 1200) / F.lit(1e4)


def raw_sales(spark: SparkSession, sf: str) -> DataFrame:
    """Every order line as a transaction of its customer's region."""
    lines, orders, customers = (table(spark, sf, t) for t in ("lineitem", "orders", "customer"))
    status, flag = F.col("o_orderstatus"), F.col("l_returnflag")
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            (F.col("l_orderkey") * 16 + F.col("l_linenumber")).alias("id"),
            (F.col("c_nationkey") + 1).alias(C.REGION),
            "c_custkey",
            F.year("o_orderdate").alias(C.YEAR),
            F.col("o_orderdate").cast("date").alias("date_mutation"),
            F.when(status == "F", "Vente").when(status == "O", "Echange").otherwise("Adjudication").alias("nature_mutation"),
            F.when(flag == "A", "Appartement").when(flag == "R", "Maison").otherwise("Local").alias("type_local"),
            F.col("l_extendedprice").alias("valeur_fonciere"),
            F.col("l_quantity").alias("surface_reelle_bati"),
            longitude("c_custkey").alias("longitude"),
            latitude("c_custkey").alias("latitude"),
            "l_partkey",
            "l_linenumber",
        )
    )


def priced_sales(spark: SparkSession, sf: str) -> DataFrame:
    return silver.priced(raw_sales(spark, sf))


def sales(spark: SparkSession, sf: str) -> DataFrame:
    """Dwellings sold, unit price in band."""
    rules = C.SaleRules()
    raw = raw_sales(spark, sf)
    return silver.priced(
        raw.where((F.col("nature_mutation") == rules.nature) & F.col("type_local").isin(*rules.kinds)), rules
    )


def landed_sales(spark: SparkSession, sf: str) -> DataFrame:
    """The same lines as strings, the way a yearly file delivers them."""
    raw = raw_sales(spark, sf)
    text = lambda c: F.translate(F.col(c).cast("string"), ".", ",")
    return raw.select(
        F.col("date_mutation").cast("string").alias("date_mutation"),
        "nature_mutation",
        text("valeur_fonciere").alias("valeur_fonciere"),
        F.concat(F.lit(C.POSTAL_PREFIX), F.lpad(F.col(C.REGION).cast("string"), 2, "0")).alias("code_postal"),
        "type_local",
        F.col("surface_reelle_bati").cast("string").alias("surface_reelle_bati"),
        F.col("l_linenumber").cast("string").alias("nombre_pieces_principales"),
        F.col("longitude").cast("string").alias("longitude"),
        F.col("latitude").cast("string").alias("latitude"),
        C.YEAR,
    )


def customers(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        "c_custkey", (F.col("c_nationkey") + 1).alias(C.REGION), "c_mktsegment", "c_acctbal",
        longitude("c_custkey").alias("lon"), latitude("c_custkey").alias("lat"),
    )


def suppliers(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "supplier").select(
        "s_suppkey", (F.col("s_nationkey") + 1).alias(C.REGION), "s_acctbal"
    )


def readings(spark: SparkSession, sf: str) -> DataFrame:
    """Events as air readings; region from the user, measures from value and props."""
    return of_events(table(spark, sf, "events"))


def of_events(events: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("double")
    return events.select(
        "event_id",
        (F.col("user_id") % 20 + 1).cast("int").alias(C.REGION),
        F.col("value").alias("iqa"),
        F.col("ts").cast("timestamp").alias("ingested_at"),
        F.col("event_type").alias("source"),
        k.alias("no2"),
        (k / 2.0).alias("pm25"),
        alert_level("value").alias("alert_level"),
    )


def air_events(spark: SparkSession, sf: str) -> DataFrame:
    return readings(spark, sf).select(
        F.lit("air_quality").alias("type"), "source", "ingested_at", F.col("ingested_at").alias("timestamp"),
        C.REGION, "iqa", F.col("no2").alias("no2_µg_m3"), F.col("pm25").alias("pm25_µg_m3"), "alert_level",
    )


AS_OF = "2024-01-25 12:00:00"


def region_features(spark: SparkSession, sf: str) -> DataFrame:
    """One GeoJSON FeatureCollection per nation: a pentagon with a square hole on a 5 x 5 grid."""
    n = table(spark, sf, "nation")
    col, row = F.col("n_nationkey") % 5, F.floor(F.col("n_nationkey") / 5)

    def at(dx: int, dy: int):
        x = (F.lit(22500) + col * 340 + dx) / F.lit(1e4)
        y = (F.lit(488000) + row * 240 + dy) / F.lit(1e4)
        return F.concat(F.lit("["), x.cast("string"), F.lit(","), y.cast("string"), F.lit("]"))

    ring = lambda pts: F.concat(F.lit("["), F.concat_ws(",", *[at(*p) for p in pts]), F.lit("]"))
    outer = ring([(0, 0), (340, 0), (340, 200), (170, 240), (0, 200), (0, 0)])
    hole = ring([(120, 80), (200, 80), (200, 140), (120, 140), (120, 80)])
    return n.select(
        F.concat(
            F.lit('{"type":"FeatureCollection","features":[{"properties":{"c_ar":"'),
            (F.col("n_nationkey") + 1).cast("string"), F.lit('","l_ar":"'), F.col("n_name"),
            F.lit('","surface":"'), ((F.col("n_nationkey") + 1) * 1000000).cast("string"),
            F.lit('"},"geometry":{"type":"Polygon","coordinates":['), outer, F.lit(","), hole, F.lit("]}}]}"),
        ).alias("doc")
    )


EDGES = """
    SELECT n_nationkey + 1 AS region, (22500 + n_nationkey % 5 * 340 + dx1) / 1e4 AS x1,
           (488000 + n_nationkey // 5 * 240 + dy1) / 1e4 AS y1,
           (22500 + n_nationkey % 5 * 340 + dx2) / 1e4 AS x2, (488000 + n_nationkey // 5 * 240 + dy2) / 1e4 AS y2
    FROM nation, (VALUES (0,0,340,0),(340,0,340,200),(340,200,170,240),(170,240,0,200),(0,200,0,0),
                         (120,80,200,80),(200,80,200,140),(200,140,120,140),(120,140,120,80)) e(dx1,dy1,dx2,dy2)"""
