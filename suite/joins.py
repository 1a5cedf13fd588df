"""Coverage, comparison and spatial joins (J rows)."""

from pyspark.sql import functions as F

from regionlake import config as C
from regionlake.operators import aggregates as A
from regionlake.operators import joins as J
from regionlake.operators import spatial as S
from regionlake.schemas import GEO
from regionlake.sources import documents
from suite import domain as D
from suite import scores
from suite.aggregation import yearly
from suite.registry import FRAGMENTS, query, with_


@query("j01_spine_coverage", with_("spine") + """
    SELECT s.arrondissement, t.nb_clients FROM spine s
    LEFT JOIN (SELECT c_nationkey % 23 + 1 AS a, count(*) AS nb_clients FROM customer GROUP BY 1) t ON a = s.arrondissement""")
def spine_coverage(spark, sf):
    """All customers; two regions of the spine have none."""
    return D.spine(spark).attach(A.count_by(D.gapped(D.customers(spark, sf)), [C.REGION], "nb_clients"))


FRAGMENTS["social_years"] = ((), """
    SELECT c_nationkey + 1 AS arrondissement, CAST(year(o_orderdate) AS INT) AS annee, count(*) AS nb_logements_sociaux
    FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderpriority = '2-HIGH' GROUP BY 1, 2""")


@query("j02_composite_key", with_("prices", "social_years") + """
    SELECT arrondissement, annee, prix_m2_median, nb_logements_sociaux FROM prices LEFT JOIN social_years USING (arrondissement, annee)""")
def composite_key(spark, sf):
    orders = D.table(spark, sf, "orders").where(F.col("o_orderpriority") == "2-HIGH")
    rows = orders.join(D.customers(spark, sf), F.col("o_custkey") == F.col("c_custkey"))
    social = A.count_by(rows.select(C.REGION, F.year("o_orderdate").alias(C.YEAR)), [C.REGION, C.YEAR], "nb_logements_sociaux")
    facts = yearly(spark, sf).select(C.REGION, C.YEAR, "prix_m2_median")
    return J.with_year_values(facts, social, [C.REGION, C.YEAR])


@query("j03_region_values_per_year", with_("prices") + """
    , r AS (SELECT s_nationkey + 1 AS arrondissement, s_suppkey, s_acctbal FROM supplier
            QUALIFY row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) = 1)
    SELECT arrondissement, annee, prix_m2_median, s_suppkey, s_acctbal FROM prices LEFT JOIN r USING (arrondissement)""")
def region_values(spark, sf):
    facts = yearly(spark, sf).select(C.REGION, C.YEAR, "prix_m2_median")
    return J.with_region_values(facts, D.suppliers(spark, sf), ["s_suppkey", "s_acctbal"], D.spine(spark), ["s_suppkey"])


def shapes(spark, sf):
    raw = documents.parse_json(D.region_features(spark, sf), "doc", GEO)
    return documents.polygons(raw, n_regions=25)


FRAGMENTS["edges"] = ((), D.EDGES)
FRAGMENTS["hits"] = (("edges", "customers"), """
    SELECT c_custkey, region FROM customers c, edges e GROUP BY c_custkey, region
    HAVING sum(CASE WHEN (y1 > lat) <> (y2 > lat) AND lon < (x2 - x1) * (lat - y1) / (y2 - y1) + x1 THEN 1 ELSE 0 END) % 2 = 1
       AND sum(CASE WHEN (x2 - x1) * (lat - y1) - (y2 - y1) * (lon - x1) = 0 AND lon BETWEEN least(x1, x2) AND greatest(x1, x2)
                     AND lat BETWEEN least(y1, y2) AND greatest(y1, y2) THEN 1 ELSE 0 END) = 0""")
LOCATED = with_("hits") + """
    SELECT c_custkey, c.lat, c.lon, min(region) AS region FROM customers c LEFT JOIN hits USING (c_custkey) GROUP BY 1, 2, 3"""


@query("j05_point_in_polygon", LOCATED)
def point_in_polygon(spark, sf):
    points = D.customers(spark, sf).select("c_custkey", "lat", "lon")
    return S.with_region(points, shapes(spark, sf), out="region")


@query("j05_point_in_polygon_salted", LOCATED)
def point_in_polygon_salted(spark, sf):
    """The same join with an index that is too large to broadcast."""
    points = D.customers(spark, sf).select("c_custkey", "lat", "lon")
    return S.with_region(points, shapes(spark, sf), out="region", broadcast_rows=10)


@query("j06_conditional_enrichment", with_("hits") + """
    SELECT c_custkey, min(CASE WHEN c_mktsegment = 'BUILDING' THEN c.arrondissement ELSE region END) AS arrondissement
    FROM customers c LEFT JOIN hits USING (c_custkey) GROUP BY 1""")
def conditional_enrichment(spark, sf):
    """Rows with a region keep it; the others take the one their point lies in."""
    known = F.col("c_mktsegment") == "BUILDING"
    df = D.customers(spark, sf).select(
        "c_custkey", F.when(known, F.col(C.REGION)).alias(C.REGION),
        F.when(~known, F.col("lat")).alias("lat"), F.when(~known, F.col("lon")).alias("lon"))
    return S.enriched(df, shapes(spark, sf)).select("c_custkey", C.REGION)


@query("j06_mostly_known", with_("hits") + """
    SELECT c_custkey, min(CASE WHEN c_custkey % 10 <> 0 THEN c.arrondissement ELSE region END) AS arrondissement
    FROM customers c LEFT JOIN hits USING (c_custkey) GROUP BY 1""")
def mostly_known(spark, sf):
    """Nine rows of ten have a region; the tenth still gets its own."""
    known = F.col("c_custkey") % 10 != 0
    df = D.customers(spark, sf).select("c_custkey", F.when(known, F.col(C.REGION)).alias(C.REGION), "lat", "lon")
    return S.enriched(df, shapes(spark, sf)).select("c_custkey", C.REGION)


DISTANCE = """sqrt(power(6378137.0::DOUBLE * (1e0 - 0.0066943799901413165::DOUBLE) / (w * sqrt(w)) * radians(latitude - 48.86::DOUBLE), 2)
            + power(6378137.0::DOUBLE / sqrt(w) * cos(phi) * radians(longitude - 2.34::DOUBLE), 2))"""


@query("j07_within_radius", with_("priced") + f"""
    , d AS (SELECT *, {DISTANCE} AS d FROM (SELECT *, 1e0 - 0.0066943799901413165::DOUBLE * sin(phi) * sin(phi) AS w
            FROM (SELECT *, radians((latitude + 48.86::DOUBLE) / 2e0) AS phi FROM priced)))
    SELECT id, arrondissement, l_partkey, round(d, 6) AS distance_m FROM d WHERE d <= 800
    ORDER BY d, id * 1000000 + l_partkey LIMIT 200""")
def within_radius(spark, sf):
    df = D.priced_sales(spark, sf).withColumn("ordre", F.col("id") * 1000000 + F.col("l_partkey"))
    near = S.within_radius(df, 48.86, 2.34, 800, tie="ordre")
    return near.select("id", C.REGION, "l_partkey", F.round("distance_m", 6).alias("distance_m"))


@query("j08_comparison", with_("prices", "income") + """
    , p AS (SELECT arrondissement, prix_m2_median, nb_transactions FROM prices WHERE annee = 1999),
    m AS (SELECT 1 AS ordre, 'prix_m2_median' AS mesure, true AS bas, arrondissement AS a, prix_m2_median::DOUBLE AS v FROM p
          UNION ALL SELECT 2, 'nb_transactions', false, arrondissement, nb_transactions::DOUBLE FROM p
          UNION ALL SELECT 3, 'score_global', false, arrondissement, revenu_median FROM income)
    SELECT ordre, mesure, max(v) FILTER (WHERE a = 3) AS valeur_1, max(v) FILTER (WHERE a = 8) AS valeur_2,
           CASE WHEN (max(v) FILTER (WHERE a = 3) < max(v) FILTER (WHERE a = 8)) = bool_and(bas) AND max(v) FILTER (WHERE a = 3) <> max(v) FILTER (WHERE a = 8) THEN 3
                WHEN max(v) FILTER (WHERE a = 3) <> max(v) FILTER (WHERE a = 8) THEN 8 END AS meilleur
    FROM m GROUP BY ordre, mesure""")
def comparison(spark, sf):
    prices = yearly(spark, sf).where(F.col(C.YEAR) == 1999).select(C.REGION, "prix_m2_median", "nb_transactions")
    table = scores.income(spark, sf).withColumnRenamed("revenu_median", "score_global")
    return J.versus(prices, table, 3, 8)


@query("j10_missing_members", with_("spine", "sales") + """
    , f AS (SELECT DISTINCT (arrondissement - 1) % 23 + 1 AS arrondissement, annee FROM sales),
    y AS (SELECT DISTINCT annee FROM f)
    SELECT s.arrondissement, y.annee FROM spine s, y WHERE NOT EXISTS (
        SELECT 1 FROM f WHERE f.arrondissement = s.arrondissement AND f.annee = y.annee)""")
def missing(spark, sf):
    return J.missing_members(D.gapped(D.sales(spark, sf)), D.spine(spark))
