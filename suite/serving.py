"""The public queries over the gold tables."""

from pyspark.sql import functions as F

from regionlake import config as C
from regionlake.plans import serving as V
from regionlake.operators.reshape import long_indicators
from regionlake.sources.documents import region_dimension
from suite import domain as D
from suite import scores
from suite.aggregation import batches, yearly
from suite.joins import shapes
from suite.registry import FRAGMENTS, half_even, query, with_
from regionlake.operators.aggregates import consolidated

PRICE = "prix_m2_median, prix_m2_moyen, nb_transactions, prix_m2_variation_pct"


def social_gold(spark, sf):
    return yearly(spark, sf).join(scores.social(spark, sf, D.gapped), C.REGION, "left")


@query("route_region_detail", with_("prices") + """
    SELECT arrondissement, annee, prix_m2_median, prix_m2_moyen, nb_transactions, surface_mediane, "Appartement", "Maison",
           prix_m2_variation_pct FROM prices WHERE arrondissement = 12 AND annee = 1998""")
def region_detail(spark, sf):
    return V.region_detail(yearly(spark, sf), 12, 1998, n_regions=25)


@query("route_prices", with_("prices") + f"SELECT arrondissement, annee, {PRICE} FROM prices WHERE annee BETWEEN 1996 AND 1999")
def prices(spark, sf):
    return V.prices(yearly(spark, sf), None, 1996, 1999)


@query("route_price_history", with_("prices") + """
    SELECT arrondissement, annee, prix_m2_median, nb_transactions, prix_m2_variation_pct FROM prices""")
def price_history(spark, sf):
    return V.price_history(yearly(spark, sf))


@query("route_indicators", with_("safety") + "SELECT * FROM safety WHERE arrondissement = 9")
def indicators(spark, sf):
    return V.indicators(scores.safety(spark, sf), 9)


@query("route_compare_prices", with_("prices", "gapped_social") + """
    SELECT arrondissement, annee, prix_m2_median, nb_transactions, nb_logements_sociaux, part_logements_sociaux_pct FROM prices
    LEFT JOIN gapped_social USING (arrondissement) WHERE arrondissement IN (3, 8) AND annee = 1999""")
def compare_prices(spark, sf):
    return V.compare(social_gold(spark, sf), scores.safety(spark, sf), 3, 8, 1999).prices


@query("route_compare_measures", with_("prices", "safety") + """
    , v AS (SELECT 1 AS o, 'prix_m2_median' AS m, prix_m2_median AS v, arrondissement AS a FROM prices WHERE annee = 1999
      UNION ALL SELECT 6, 'score_securite', score_securite, arrondissement FROM safety
      UNION ALL SELECT 7, 'nb_faits', nb_faits, arrondissement FROM safety)
    SELECT m AS mesure, max(v) FILTER (WHERE a = 4) AS valeur_1, max(v) FILTER (WHERE a = 8) AS valeur_2,
           CASE WHEN m = 'nb_faits' OR max(v) FILTER (WHERE a = 4) = max(v) FILTER (WHERE a = 8) THEN NULL
                WHEN (max(v) FILTER (WHERE a = 4) < max(v) FILTER (WHERE a = 8)) = (m = 'prix_m2_median') THEN 4
                WHEN (max(v) FILTER (WHERE a = 4) > max(v) FILTER (WHERE a = 8)) = (m = 'prix_m2_median') THEN 8 END AS meilleur
    FROM v GROUP BY m""")
def compare_measures(spark, sf):
    m = V.compare(yearly(spark, sf), scores.safety(spark, sf), 4, 8, 1999).measures
    return m.where(F.col("mesure").isin("prix_m2_median", "score_securite", "nb_faits")).drop("ordre")


@query("route_social_housing", with_("prices", "gapped_social") + """
    SELECT arrondissement, annee, nb_logements_sociaux, part_logements_sociaux_pct FROM prices
    JOIN gapped_social USING (arrondissement)""")
def social_housing(spark, sf):
    return V.social_housing(social_gold(spark, sf))


@query("route_stream_latest", with_("batches") + """
    SELECT arrondissement, CAST(sum(nb_transactions) AS BIGINT) AS nb_transactions_total,
           round(median(prix_m2_median), 6) AS prix_m2_median_stream, count(DISTINCT batch_id) AS nb_batchs FROM batches GROUP BY 1""")
def stream_latest(spark, sf):
    df = V.stream_latest(consolidated(batches(spark, sf)))
    return df.withColumn("prix_m2_median_stream", F.round("prix_m2_median_stream", 6))


@query("route_region_dimension", """
    SELECT n_nationkey + 1 AS code, n_name AS nom, CAST(n_nationkey + 1 AS DOUBLE) AS surface_km2 FROM nation""")
def region_dim(spark, sf):
    return region_dimension(shapes(spark, sf), D.spine(spark))


@query("route_indicators_long", with_("safety") + """
    SELECT arrondissement, nom, 'securite' AS categorie, valeur, NULL AS unite, NULL AS annee, 'gold/indicateurs_custom' AS source
    FROM (UNPIVOT (SELECT arrondissement, score_securite FROM safety) ON score_securite INTO NAME nom VALUE valeur)""")
def indicators_long(spark, sf):
    return V.indicators_long(long_indicators(scores.safety(spark, sf)), category="securite")


@query("route_inventory", """
    SELECT source, CAST(doc_id AS VARCHAR) AS path, n_chars AS size_bytes FROM documents WHERE source = 'src3'
    ORDER BY doc_id % 500 DESC, CAST(doc_id AS VARCHAR) LIMIT 20""")
def inventory(spark, sf):
    from suite.quality import catalogued

    df = catalogued(spark, sf).withColumn("payload", F.lit("x"))
    return V.inventory(df, "src3").select("source", "path", "size_bytes")


FRAGMENTS["window"] = (("readings",), f"""
    SELECT *, row_number() OVER (PARTITION BY arrondissement ORDER BY ingested_at DESC, iqa DESC, source DESC) AS rn,
           avg(iqa) OVER (PARTITION BY arrondissement) AS m, count(*) OVER (PARTITION BY arrondissement) AS n
    FROM readings WHERE ingested_at >= TIMESTAMP '{D.AS_OF}' - INTERVAL 72 HOURS""")


def summary(spark, sf, alert_only=False):
    return V.air_summary(D.air_events(spark, sf), D.AS_OF, 72, alert_only, digits=None)


@query("route_air_readings", with_("window") + """
    SELECT arrondissement, iqa AS iqa_latest, round(m, 8) AS iqa_mean, no2 AS no2_latest, pm25 AS pm25_latest, alert_level, source,
           n AS n_mesures, ingested_at AS last_update FROM window WHERE rn = 1""".replace("window", '"window"'))
def air_readings(spark, sf):
    df = summary(spark, sf).readings
    return df.withColumn("iqa_mean", F.round("iqa_mean", 8)).withColumn("last_update", F.col("last_update").cast("timestamp_ntz"))


@query("route_air_alerts", with_("window") + """
    SELECT arrondissement, iqa, alert_level, no2, pm25 FROM "window" WHERE rn = 1 AND alert_level IS NOT NULL""")
def air_alerts(spark, sf):
    return summary(spark, sf).alerts.drop("last_update")


@query("route_air_overview", with_("window") + """
    , l AS (SELECT * FROM "window" WHERE rn = 1)
    SELECT 72 AS window_hours, (SELECT count(*) FROM l WHERE alert_level IS NOT NULL) AS alerts_active,
           (SELECT source FROM l WHERE alert_level IS NOT NULL GROUP BY source ORDER BY count(*) DESC, source LIMIT 1) AS source, NULL AS message""")
def air_overview(spark, sf):
    return summary(spark, sf, alert_only=True).overview


@query("j09_feature_table", with_("prices", "safety", "gapped_social") + f"""
    SELECT n_nationkey + 1 AS arrondissement, {PRICE}, score_securite, part_logements_sociaux_pct, score_securite AS valeur
    FROM nation LEFT JOIN (SELECT * FROM prices WHERE annee = 1999) p ON p.arrondissement = n_nationkey + 1
    LEFT JOIN safety s ON s.arrondissement = n_nationkey + 1
    LEFT JOIN gapped_social c ON c.arrondissement = n_nationkey + 1""")
def feature_table(spark, sf):
    return V.feature_table(D.spine(spark).df, social_gold(spark, sf), scores.safety(spark, sf), 1999, "score_securite")
