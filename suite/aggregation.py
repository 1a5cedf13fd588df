"""Grouped statistics (A rows), ordering and reshaping (L rows), windows (W rows)."""

from pyspark.sql import functions as F

from regionlake import config as C
from regionlake.functions.cleaning import round_half_even
from regionlake.operators import aggregates as A
from regionlake.operators import reshape as R
from regionlake.operators import windows as W
from regionlake.plans import gold
from suite import domain as D
from suite.registry import FRAGMENTS, ROLLING, ROLLING_WINDOW, half_even, query, with_

KINDS = C.SaleRules().kinds


def yearly(spark, sf):
    return gold.yearly_prices(D.sales(spark, sf))


@query("gold_yearly_prices", with_("prices") + """
    SELECT arrondissement, annee, prix_m2_median, prix_m2_moyen, nb_transactions, surface_mediane,
           "Appartement", "Maison", prix_m2_variation_pct FROM prices""")
def gold_yearly_prices(spark, sf):
    return yearly(spark, sf)


@query("a01_price_stats", with_("priced") + """
    SELECT arrondissement, annee, median(prix_m2) AS prix_m2_median, round(avg(prix_m2), 6) AS prix_m2_moyen,
           count(prix_m2) AS nb_transactions, median(surface_reelle_bati) AS surface_mediane,
           count(*) FILTER (WHERE type_local = 'Appartement') AS "Appartement",
           count(*) FILTER (WHERE type_local = 'Maison') AS "Maison" FROM priced GROUP BY 1, 2""")
def price_stats(spark, sf):
    df = A.price_stats(D.priced_sales(spark, sf), KINDS, digits=None)
    return df.withColumn("prix_m2_moyen", F.round("prix_m2_moyen", 6))


@query("a01_price_stats_bracketed", with_("priced") + """
    SELECT arrondissement, round(median(prix_m2), 9) AS prix, median(surface_reelle_bati) AS surface,
           count(*) AS n FROM priced GROUP BY 1""")
def price_stats_bracketed(spark, sf):
    """The median of groups too large for one task: sketch, bracket, exact rank."""
    from regionlake.operators.quantiles import group_medians

    df = group_medians(
        D.priced_sales(spark, sf), [C.REGION], {"prix": "prix_m2", "surface": "surface_reelle_bati"},
        [F.count(F.lit(1)).alias("n")], group_rows=100)
    return df.withColumn("prix", F.round("prix", 9))


@query("a01_price_stats_sketch", with_("priced") + """
    SELECT arrondissement, annee, quantile_disc(prix_m2, 0.5) AS prix_m2_median, quantile_disc(surface_reelle_bati, 0.5) AS surface_mediane,
           count(prix_m2) AS nb_transactions FROM priced GROUP BY 1, 2""")
def price_stats_sketch(spark, sf):
    """One-pass medians from the sketch, which is lossless for groups below its accuracy."""
    df = A.price_stats(D.priced_sales(spark, sf), KINDS, exact=False, digits=None)
    return df.select(C.REGION, C.YEAR, "prix_m2_median", "surface_mediane", "nb_transactions")


@query("a02_kind_pivot", with_("raw_sales") + """
    SELECT arrondissement, annee, count(*) FILTER (WHERE type_local = 'Appartement') AS "Appartement",
           count(*) FILTER (WHERE type_local = 'Maison') AS "Maison", 0 AS "Terrain" FROM raw_sales GROUP BY 1, 2""")
def kind_pivot(spark, sf):
    return A.pivot_counts(D.raw_sales(spark, sf), [C.REGION, C.YEAR], "type_local", (*KINDS, "Terrain"))


@query("a03_count_by_region", with_("customers") + """
    SELECT arrondissement, count(*) AS nb FROM customers WHERE c_acctbal >= 0 GROUP BY 1""")
def count_by_region(spark, sf):
    """Customers in debt have no region here."""
    df = D.customers(spark, sf).withColumn(C.REGION, F.when(F.col("c_acctbal") >= 0, F.col(C.REGION)))
    return A.count_by(df, [C.REGION], "nb")


SEGMENTS = {"AUTOMOBILE": "nb_supermarches", "FURNITURE": "nb_pharmacies", "HOUSEHOLD": "nb_boulangeries",
            "MACHINERY": "nb_hopitaux", "BUILDING": "nb_medecins"}
FRAGMENTS["poi"] = (("customers",), "SELECT arrondissement, " + ", ".join(
    f"count(*) FILTER (WHERE c_mktsegment = '{k}') AS {v}" for k, v in SEGMENTS.items()) + " FROM customers GROUP BY 1")


@query("a04_class_counts", with_("poi") + "SELECT * FROM poi")
def class_counts(spark, sf):
    return A.class_counts(D.customers(spark, sf), "c_mktsegment", SEGMENTS)


@query("a05_sum_by_region", with_("raw_sales") + """
    SELECT arrondissement, CAST(sum(l_linenumber) AS BIGINT) AS nb_faits FROM raw_sales GROUP BY 1""")
def sum_by_region(spark, sf):
    return A.sum_by(D.raw_sales(spark, sf), [C.REGION], "l_linenumber", "nb_faits")


@query("a06_sensor_means", with_("readings") + """
    SELECT arrondissement, round(avg(iqa), 8) AS iqa, round(avg(no2), 8) AS no2, round(avg(pm25), 8) AS pm25
    FROM readings GROUP BY 1""")
def sensor_means(spark, sf):
    df = A.mean_by(D.readings(spark, sf), [C.REGION], {"iqa": "iqa", "no2": "no2", "pm25": "pm25"})
    return df.select(C.REGION, *[F.round(c, 8).alias(c) for c in ("iqa", "no2", "pm25")])


@query("a07_median_rent", """
    SELECT s_nationkey + 1 AS arrondissement, round(median(s_acctbal), 6) AS loyer_ref_m2 FROM supplier GROUP BY 1""")
def median_rent(spark, sf):
    df = A.median_by(D.suppliers(spark, sf), [C.REGION], "s_acctbal", "loyer_ref_m2")
    return df.withColumn("loyer_ref_m2", F.round("loyer_ref_m2", 6))


@query("a08_region_overview", with_("prices") + f"""
    SELECT arrondissement, {half_even('avg(prix_m2_median)')} AS prix_m2_median_global,
           CAST(sum(nb_transactions) AS BIGINT) AS nb_transactions_total FROM prices GROUP BY 1""")
def region_overview(spark, sf):
    return A.region_overview(yearly(spark, sf))


FRAGMENTS["batches"] = (("sales",), """
    SELECT arrondissement, CAST(year(date_mutation) * 100 + month(date_mutation) AS INT) AS batch_id,
           count(prix_m2) AS nb_transactions, median(prix_m2) AS prix_m2_median FROM sales GROUP BY 1, 2""")


def batches(spark, sf):
    month = (F.year("date_mutation") * 100 + F.month("date_mutation")).alias("batch_id")
    df = D.sales(spark, sf).select(C.REGION, month, "prix_m2")
    from regionlake.operators.quantiles import group_medians

    return group_medians(df, [C.REGION, "batch_id"], {"prix_m2_median": "prix_m2"},
                         [F.count("prix_m2").alias("nb_transactions")])


@query("a09_stream_consolidation", with_("batches") + """
    SELECT arrondissement, CAST(sum(nb_transactions) AS BIGINT) AS nb_transactions_total,
           round(median(prix_m2_median), 6) AS prix_m2_median_stream, count(DISTINCT batch_id) AS nb_batchs
    FROM batches GROUP BY 1""")
def stream_consolidation(spark, sf):
    df = A.consolidated(batches(spark, sf))
    return df.withColumn("prix_m2_median_stream", F.round("prix_m2_median_stream", 6))


@query("a12_lake_statistics", with_("prices") + f"""
    SELECT count(*) AS gold_rows, count(DISTINCT arrondissement) AS arrondissements_covered,
           string_agg(DISTINCT CAST(annee AS VARCHAR), ',' ORDER BY CAST(annee AS VARCHAR)) AS years_covered,
           CAST(sum(nb_transactions) AS BIGINT) AS nb_transactions_total,
           {half_even('median(prix_m2_median)')} AS prix_m2_median_paris FROM prices""")
def lake_statistics(spark, sf):
    df = A.lake_statistics(yearly(spark, sf))
    return df.withColumn("years_covered", F.array_join(F.col("years_covered").cast("array<string>"), ","))


@query("a13_latest_year", with_("prices") + """
    SELECT arrondissement, annee, prix_m2_median FROM prices WHERE annee = (SELECT max(annee) FROM prices)""")
def latest_year(spark, sf):
    return A.latest_year(yearly(spark, sf)).select(C.REGION, C.YEAR, "prix_m2_median")


@query("a14_city_kpis", with_("prices") + """
    SELECT median(nullif(prix_m2_median, 0)) AS prix_m2_median, round(median(prix_m2_variation_pct), 6) AS variation_pct,
           CAST(sum(nb_transactions) AS BIGINT) AS nb_transactions,
           (SELECT median(CAST(arrondissement % 7 AS DOUBLE)) FROM prices WHERE arrondissement > 3) AS part_logements_sociaux_pct
    FROM prices WHERE annee = 1998""")
def city_kpis(spark, sf):
    share = F.when((F.col(C.REGION) > 3) & (F.col(C.YEAR) != 1998), (F.col(C.REGION) % 7).cast("double"))
    # Every year but the wanted one has a share, so the fallback is in force.
    table = yearly(spark, sf).withColumn("part_logements_sociaux_pct", share)
    df = A.city_kpis(table, 1998).withColumn("variation_pct", F.round("variation_pct", 6))
    return df


@query("a15_volume_by_year", with_("prices") + """
    SELECT annee, CAST(sum(nb_transactions) AS BIGINT) AS volume FROM prices GROUP BY 1""")
def volume_by_year(spark, sf):
    return A.volume_by_year(yearly(spark, sf))


@query("a16_row_sum", with_("poi") + """
    SELECT arrondissement, CAST(coalesce(nullif(nb_supermarches, 0), 0) + nb_pharmacies + nb_boulangeries AS DOUBLE) AS nb_commerces,
           CAST(nb_hopitaux + nb_medecins AS DOUBLE) AS nb_sante FROM poi""")
def row_sum(spark, sf):
    from regionlake.functions.cleaning import row_sum as total

    df = A.class_counts(D.customers(spark, sf), "c_mktsegment", SEGMENTS)
    return df.select(
        C.REGION,
        total(F.nullif("nb_supermarches", F.lit(0)), "nb_pharmacies", "nb_boulangeries").alias("nb_commerces"),
        total("nb_hopitaux", "nb_medecins").alias("nb_sante"))


@query("a17_colour_classes", with_("prices") + """
    , y AS (SELECT arrondissement, prix_m2_median AS v FROM prices WHERE annee = 1999)
    SELECT arrondissement, v, (SELECT min(v) FROM y) AS valeur_min, (SELECT max(v) FROM y) AS valeur_max,
           CAST(floor(9 * ((v - (SELECT min(v) FROM y)) / ((SELECT max(v) FROM y) - (SELECT min(v) FROM y)))) AS INT) AS classe
    FROM y""")
def colour_classes(spark, sf):
    table = yearly(spark, sf).where(F.col(C.YEAR) == 1999).select(C.REGION, F.col("prix_m2_median").alias("v"))
    return A.colour_classes(table, "v")


@query("a18_price_rollup", with_("priced") + """
    SELECT CASE grouping_id(arrondissement, annee) WHEN 0 THEN 'arrondissement_annee' WHEN 1 THEN 'arrondissement' ELSE 'ville' END AS niveau,
           arrondissement, annee, count(prix_m2) AS nb_transactions, round(avg(prix_m2), 6) AS prix_m2_moyen, round(sum(valeur_fonciere), 2) AS valeur_totale,
           min(prix_m2) AS prix_m2_min, max(prix_m2) AS prix_m2_max
    FROM priced GROUP BY ROLLUP (arrondissement, annee)""")
def price_rollup(spark, sf):
    df = A.price_rollup(D.priced_sales(spark, sf))
    return df.withColumn("prix_m2_moyen", F.round("prix_m2_moyen", 6)).withColumn("valeur_totale", F.round("valeur_totale", 2))


# Windows.


@query("w01_variation", with_("prices") + f"""
    , gaps AS (SELECT arrondissement, annee, CASE WHEN (arrondissement + annee) % 4 = 0 THEN NULL ELSE prix_m2_median END AS p FROM prices),
    pad AS (SELECT *, last_value(p IGNORE NULLS) OVER (PARTITION BY arrondissement ORDER BY annee
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS f FROM gaps)
    SELECT arrondissement, annee, p AS prix_m2_median,
           {half_even('(f / lag(f) OVER (PARTITION BY arrondissement ORDER BY annee) - 1e0) * 1e2', 1)} AS variation FROM pad""")
def variation(spark, sf):
    holes = F.when((F.col(C.REGION) + F.col(C.YEAR)) % 4 != 0, F.col("prix_m2_median"))
    df = yearly(spark, sf).select(C.REGION, C.YEAR, holes.alias("prix_m2_median"))
    return W.with_variation(df, out="variation")


@query("w02_rolling_24h_mean", with_("readings") + f"""
    SELECT event_id, arrondissement, iqa, {ROLLING} AS iqa_24h_mean FROM readings {ROLLING_WINDOW}""")
def rolling_mean(spark, sf):
    df = D.readings(spark, sf).select("event_id", C.REGION, "iqa", "ingested_at")
    return W.rolling_mean(df, C.REGION, "ingested_at", "iqa", "iqa_24h_mean").drop("ingested_at").withColumn("iqa_24h_mean", F.round("iqa_24h_mean", 8))


@query("w03_latest_reading", with_("readings") + """
    SELECT arrondissement, event_id, iqa, source FROM readings
    QUALIFY row_number() OVER (PARTITION BY arrondissement ORDER BY ingested_at DESC, event_id DESC) = 1""")
def latest_reading(spark, sf):
    df = D.readings(spark, sf).select(C.REGION, "ingested_at", "event_id", "iqa", "source")
    return W.latest_per_key(df, [C.REGION], ["ingested_at", "event_id"]).drop("ingested_at")


@query("w04_keep_first", """
    SELECT o_custkey, o_orderkey, o_totalprice FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1""")
def keep_first(spark, sf):
    df = D.table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return W.keep_first(df, ["o_custkey"], ["o_orderkey"])


FRAGMENTS["volumes"] = (("raw_sales",), """
    SELECT arrondissement, CAST(count(*) AS DOUBLE) AS score_global FROM raw_sales GROUP BY 1""")


def volumes(spark, sf):
    return A.count_by(D.raw_sales(spark, sf), [C.REGION], "n").select(
        C.REGION, F.col("n").cast("double").alias("score_global"))


@query("w05_ranking", with_("volumes") + """
    SELECT *, CASE WHEN rang <= 3 THEN 'top' WHEN rang > (SELECT count(*) FROM volumes) - 3 THEN 'bottom' ELSE 'middle' END AS bande
    FROM (SELECT arrondissement, score_global, row_number() OVER (ORDER BY score_global DESC, arrondissement) AS rang FROM volumes)""")
def ranking(spark, sf):
    return W.ranked(volumes(spark, sf))


@query("w05_top_regions", with_("volumes") + """
    SELECT arrondissement, score_global FROM volumes ORDER BY score_global DESC, arrondissement LIMIT 5""")
def top_regions(spark, sf):
    return W.top_regions(volumes(spark, sf), 5)


@query("w06_outliers", """
    WITH s AS (SELECT avg(o_totalprice) AS m, stddev_samp(o_totalprice) AS d FROM orders)
    SELECT o_orderkey, o_totalprice, CASE WHEN o_totalprice <= 0 THEN 'error' ELSE 'warning' END AS severity
    FROM orders, s WHERE o_totalprice > m + 1.5e0 * d OR o_totalprice < greatest(m - 1.5e0 * d, 0)""")
def outliers(spark, sf):
    df = D.table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return W.outliers(df, "o_totalprice", sigmas=1.5).select("o_orderkey", "o_totalprice", "severity")


# Order, caps, union, long form, filters.


@query("l01_sorted_history", with_("prices") + "SELECT annee, arrondissement, prix_m2_median FROM prices ORDER BY 1, 2")
def sorted_history(spark, sf):
    return yearly(spark, sf).select(C.YEAR, C.REGION, "prix_m2_median").orderBy(C.YEAR, C.REGION)


@query("l02_newest_events", with_("readings") + """
    SELECT event_id, arrondissement, iqa FROM readings WHERE arrondissement = 7 ORDER BY ingested_at DESC, event_id LIMIT 50""")
def newest_events(spark, sf):
    from regionlake.plans.serving import events

    df = events(D.readings(spark, sf), 7, 50, tie=["event_id"])
    return df.select("event_id", C.REGION, "iqa")


@query("l03_sample_cap", with_("priced") + """
    SELECT id, l_partkey, valeur_fonciere FROM priced""")
def sample_cap(spark, sf):
    df = D.priced_sales(spark, sf).select("id", "l_partkey", "valeur_fonciere")
    return R.first_rows(df, ["id", "l_partkey", "valeur_fonciere"])


@query("l03_row_cap", with_("priced") + """
    SELECT id, l_partkey, valeur_fonciere FROM priced ORDER BY valeur_fonciere, id, l_partkey LIMIT 50000""")
def row_cap(spark, sf):
    """The cap that a caller of the relational load asks for."""
    df = D.priced_sales(spark, sf).select("id", "l_partkey", "valeur_fonciere")
    return R.first_rows(df, ["valeur_fonciere", "id", "l_partkey"], 50_000)


@query("l04_union_all", """
    SELECT kind, count(*) AS n, CAST(sum(k) AS BIGINT) AS cles FROM (
      SELECT 'commissariats' AS kind, s_suppkey AS k FROM supplier
      UNION ALL SELECT 'pompiers', c_custkey FROM customer UNION ALL SELECT 'pompiers', p_partkey FROM part) GROUP BY 1""")
def union_all(spark, sf):
    t = lambda name, key, kind: D.table(spark, sf, name).select(F.lit(kind).alias("kind"), F.col(key).alias("k"))
    df = R.union_all(t("supplier", "s_suppkey", "commissariats"), None, t("customer", "c_custkey", "pompiers"),
                     t("part", "p_partkey", "pompiers"))
    return df.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.sum("k").alias("cles"))


@query("l05_long_indicators", with_("poi") + """
    , wide AS (SELECT arrondissement, CAST(nb_supermarches AS DOUBLE) AS nb_transports,
               CAST(CASE WHEN arrondissement % 2 = 0 THEN nb_pharmacies END AS DOUBLE) AS nb_parcs,
               CAST(nb_hopitaux AS DOUBLE) AS score_securite FROM poi)
    SELECT arrondissement, nom, CASE nom WHEN 'nb_transports' THEN 'accessibilite' WHEN 'nb_parcs' THEN 'qualite_vie' ELSE 'securite' END AS categorie,
           valeur, NULL AS unite, NULL AS annee, 'gold/indicateurs_custom' AS source
    FROM (UNPIVOT wide ON nb_transports, nb_parcs, score_securite INTO NAME nom VALUE valeur)""")
def long_indicators(spark, sf):
    poi = A.class_counts(D.customers(spark, sf), "c_mktsegment", SEGMENTS)
    wide = poi.select(C.REGION, F.col("nb_supermarches").alias("nb_transports"),
                      F.when(F.col(C.REGION) % 2 == 0, F.col("nb_pharmacies")).alias("nb_parcs"),
                      F.col("nb_hopitaux").alias("score_securite"))
    return R.long_indicators(wide)


@query("l06_optional_filters", with_("prices") + """
    SELECT arrondissement, annee, prix_m2_median, prix_m2_moyen, nb_transactions, prix_m2_variation_pct FROM prices
    WHERE annee BETWEEN 1997 AND 1999 AND arrondissement = 4""")
def optional_filters(spark, sf):
    from regionlake.plans.serving import prices

    return prices(yearly(spark, sf), 4, 1997, 1999)


@query("x08_affordability", with_("prices") + f"""
    , inc AS (SELECT c_nationkey + 1 AS arrondissement, CAST(sum(CAST(round(c_acctbal * 100) AS BIGINT)) // count(*) AS DOUBLE) AS revenu_median
              FROM customer GROUP BY 1)
    SELECT arrondissement, annee, {half_even('revenu_median / prix_m2_median', 2)} AS m2_par_revenu_annuel,
           {half_even('prix_m2_median * 5e1 / revenu_median', 1)} AS annees_pour_50m2 FROM prices JOIN inc USING (arrondissement)""")
def affordability(spark, sf):
    from suite.scores import income

    df = yearly(spark, sf).join(income(spark, sf), C.REGION)
    return gold.with_affordability(df).select(C.REGION, C.YEAR, "m2_par_revenu_annuel", "annees_pour_50m2")
