"""Composite scores (X rows) and the final table."""

from pyspark.sql import functions as F

from regionlake import config as C
from regionlake.functions import cleaning as X
from regionlake.operators import aggregates as A
from regionlake.plans import gold, silver
from regionlake.session import durable
from regionlake.streaming import air
from suite import domain as D
from suite.aggregation import SEGMENTS, yearly
from suite.registry import FRAGMENTS, half_even, min_max, query, with_

CENTRALITY = (*C.CENTRALITY, 5, 5, 5, 5, 5)


def table_sql(values) -> str:
    return "[" + ",".join(f"{float(v)}::DOUBLE" for v in values) + "]"


def bound(fragment: str, column: str) -> tuple[str, str]:
    return f"(SELECT min({column}) FROM {fragment})", f"(SELECT max({column}) FROM {fragment})"


# Inputs.


def pois(spark, sf):
    return A.class_counts(D.customers(spark, sf), "c_mktsegment", SEGMENTS)


def income(spark, sf, view=lambda df: df):
    return view(D.customers(spark, sf)).groupBy(C.REGION).agg(
        F.expr("sum(cast(round(c_acctbal * 100) as bigint)) div count(*)").cast("double").alias("revenu_median"))


def sensors(spark, sf):
    """Mean level per region as whole hundredths; regions 21..25 have no sensor."""
    cents = F.expr("sum(cast(round(value * 100) as bigint)) div count(*)") / 100.0
    df = D.table(spark, sf, "events").select((F.col("user_id") % 22 + 1).cast("int").alias(C.REGION), "value")
    return df.groupBy(C.REGION).agg(cents.alias("iqa_moyen"))


def rents(spark, sf):
    return D.suppliers(spark, sf).select(C.REGION, (F.col("s_acctbal") / 100.0).alias("loyer_ref_m2"))


def security(spark, sf):
    kind = F.when(F.col("s_acctbal") < 3000, "pompiers").otherwise("commissariats")
    return D.suppliers(spark, sf).select(kind.alias("type"), C.REGION)


def crime(spark, sf):
    return D.gapped(D.raw_sales(spark, sf)).select(C.REGION, F.col("l_linenumber").cast("double").alias("nb_faits"))


FRAGMENTS["income"] = ((), """
    SELECT c_nationkey + 1 AS arrondissement, CAST(sum(CAST(round(c_acctbal * 100) AS BIGINT)) // count(*) AS DOUBLE) AS revenu_median
    FROM customer GROUP BY 1""")
FRAGMENTS["sensors"] = ((), """
    SELECT CAST(user_id % 22 + 1 AS INT) AS arrondissement, (sum(CAST(round(value * 100) AS BIGINT)) // count(*)) / 1e2 AS iqa_moyen
    FROM events GROUP BY 1""")
FRAGMENTS["access_base"] = (("spine", "poi"), """
    SELECT s.arrondissement, CAST(coalesce(t.n, 0) AS DOUBLE) AS nb_arrets, CAST(coalesce(p.nb_medecins, 0) AS DOUBLE) AS nb_ecoles,
           CAST(coalesce(p.nb_supermarches + p.nb_pharmacies + p.nb_boulangeries, 0) AS DOUBLE) AS nb_commerces,
           CAST(coalesce(p.nb_hopitaux + p.nb_medecins, 0) AS DOUBLE) AS nb_sante
    FROM spine s LEFT JOIN (SELECT s_nationkey + 1 AS a, count(*) AS n FROM supplier GROUP BY 1) t ON t.a = s.arrondissement
    LEFT JOIN poi p ON p.arrondissement = s.arrondissement""")
_a = "access_base"
FRAGMENTS["access"] = ((_a,), "SELECT arrondissement, " + half_even(
    " + ".join([
        f"{min_max('nb_arrets', *bound(_a, 'nb_arrets'))} * 0.4::DOUBLE", f"{min_max('nb_ecoles', *bound(_a, 'nb_ecoles'))} * 0.15::DOUBLE",
        f"{min_max('nb_commerces', *bound(_a, 'nb_commerces'))} * 0.2::DOUBLE", f"{min_max('nb_sante', *bound(_a, 'nb_sante'))} * 0.15::DOUBLE",
        f"{table_sql(CENTRALITY)}[arrondissement] * 0.1::DOUBLE"]), 2)
    + " AS score_accessibilite, nb_arrets, nb_ecoles, nb_commerces, nb_sante FROM access_base")


def access(spark, sf):
    schools = D.customers(spark, sf).where(F.col("c_mktsegment") == "BUILDING")
    return gold.access_scores(D.suppliers(spark, sf), schools, pois(spark, sf), D.spine(spark), CENTRALITY)


FRAGMENTS["gapped_income"] = ((), """
    SELECT c_nationkey % 23 + 1 AS arrondissement, CAST(sum(CAST(round(c_acctbal * 100) AS BIGINT)) // count(*) AS DOUBLE) AS revenu_median
    FROM customer GROUP BY 1""")
FRAGMENTS["noise"] = (("spine", "gapped_income"), f"""
    SELECT s.arrondissement, i.revenu_median / 1e4 AS lden_moyen, coalesce({min_max('i.revenu_median / 1e4',
        "(SELECT min(revenu_median / 1e4) FROM gapped_income)",
        "(SELECT max(revenu_median / 1e4) FROM gapped_income)", True)}, 5e0) AS score_bruit
    FROM spine s LEFT JOIN gapped_income i ON i.arrondissement = s.arrondissement""")
FRAGMENTS["flow"] = (("spine", "raw_sales"), """
    SELECT s.arrondissement, CAST(t.n AS DOUBLE) AS tmja_moyen FROM spine s
    LEFT JOIN (SELECT (arrondissement - 1) % 23 + 1 AS arrondissement, count(*) AS n FROM raw_sales GROUP BY 1) t USING (arrondissement)""")
FRAGMENTS["traffic"] = (("flow",), f"""
    SELECT arrondissement, {min_max('coalesce(tmja_moyen, (SELECT median(tmja_moyen) FROM flow))', *bound('flow', 'tmja_moyen'), True)}
           AS score_circulation, tmja_moyen FROM flow""")


def noise(spark, sf):
    means = income(spark, sf, D.gapped).select(
        C.REGION, (F.col("revenu_median") / 1e4).alias("lden_moyen"), F.lit(None).cast("double").alias("lnight"),
        F.lit(None).cast("double").alias("score_bruit_raw"))
    return silver.noise_scores(means, D.spine(spark))


def traffic(spark, sf):
    flow = A.count_by(D.gapped(D.raw_sales(spark, sf)), [C.REGION], "n").select(
        C.REGION, F.col("n").cast("double").alias("tmja_moyen"), F.lit(None).cast("double").alias("score_circulation"))
    return silver.traffic_scores(flow, D.spine(spark))


FRAGMENTS["life_base"] = (("spine", "sensors", "noise", "traffic"), f"""
    SELECT s.arrondissement, CAST(coalesce(p.n, 0) AS DOUBLE) AS nb_parcs,
           CASE WHEN a.iqa_moyen IS NULL THEN 0 ELSE greatest(least({half_even('greatest(least(1e2 - a.iqa_moyen, 1e2), 0)', 1)} / 1e1, 1e1), 0) END AS s_air,
           n.score_bruit AS s_bruit, t.score_circulation AS s_circ
    FROM spine s LEFT JOIN sensors a USING (arrondissement) LEFT JOIN noise n USING (arrondissement)
    LEFT JOIN traffic t USING (arrondissement)
    LEFT JOIN (SELECT c_nationkey + 1 AS arrondissement, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey
               WHERE o_orderpriority = '1-URGENT' GROUP BY 1) p USING (arrondissement)""")
FRAGMENTS["life"] = (("life_base",), "SELECT arrondissement, " + half_even(
    f"{min_max('nb_parcs', *bound('life_base', 'nb_parcs'))} * 0.3::DOUBLE + s_air * 0.25::DOUBLE + s_bruit * 0.25::DOUBLE + s_circ * 0.2::DOUBLE", 2)
    + " AS score_qualite_vie, nb_parcs FROM life_base")


def life(spark, sf):
    orders = D.table(spark, sf, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    parks = orders.join(D.customers(spark, sf), F.col("o_custkey") == F.col("c_custkey")).select(C.REGION)
    measured = silver.with_air_score(sensors(spark, sf))
    return gold.life_scores(parks, measured, noise(spark, sf), traffic(spark, sf), D.spine(spark))


FRAGMENTS["safety_counts"] = (("spine", "raw_sales"), """
    SELECT s.arrondissement, CAST(a.f AS DOUBLE) AS f, CAST(b.p AS DOUBLE) AS p, CAST(c.c AS DOUBLE) AS c FROM spine s
    LEFT JOIN (SELECT (arrondissement - 1) % 23 + 1 AS arrondissement, sum(l_linenumber) AS f FROM raw_sales GROUP BY 1) a USING (arrondissement)
    LEFT JOIN (SELECT s_nationkey + 1 AS arrondissement, count(*) AS p FROM supplier WHERE s_acctbal >= 3000 GROUP BY 1) b USING (arrondissement)
    LEFT JOIN (SELECT s_nationkey + 1 AS arrondissement, count(*) AS c FROM supplier WHERE s_acctbal < 3000 GROUP BY 1) c USING (arrondissement)""")
FRAGMENTS["safety_base"] = (("safety_counts",), """
    SELECT arrondissement, coalesce(f, (SELECT median(f) FROM safety_counts)) AS nb_faits, coalesce(p, 1e0) AS nb_commissariats,
           coalesce(c, 0e0) AS nb_casernes FROM safety_counts""")
_s = "safety_base"
FRAGMENTS["safety"] = ((_s,), "SELECT arrondissement, " + half_even(
    f"{min_max('nb_faits', *bound(_s, 'nb_faits'), True)} * 0.6::DOUBLE + {min_max('nb_commissariats', *bound(_s, 'nb_commissariats'))} * 0.25::DOUBLE"
    f" + {min_max('nb_casernes', *bound(_s, 'nb_casernes'))} * 0.15::DOUBLE", 2)
    + " AS score_securite, nb_faits, nb_commissariats, nb_casernes FROM safety_base")


def safety(spark, sf):
    return gold.safety_scores(crime(spark, sf), security(spark, sf), D.spine(spark))


FRAGMENTS["housing_base"] = (("spine", "prices", "income"), f"""
    SELECT s.arrondissement, i.revenu_median,
           coalesce(p.prix_m2_median, (SELECT median(prix_m2_median) FROM prices WHERE annee = (SELECT max(annee) FROM prices))) AS prix,
           r.loyer FROM spine s JOIN income i USING (arrondissement)
    LEFT JOIN (SELECT arrondissement, prix_m2_median FROM prices WHERE annee = (SELECT max(annee) FROM prices)) p USING (arrondissement)
    LEFT JOIN (SELECT s_nationkey + 1 AS arrondissement, median(s_acctbal / 1e2) AS loyer FROM supplier GROUP BY 1) r USING (arrondissement)""")
FRAGMENTS["housing_in"] = (("housing_base",), f"""
    SELECT arrondissement, revenu_median, {half_even('revenu_median / prix', 2)} AS m2_par_revenu,
           {half_even('loyer * 5e1 / (revenu_median / 12e0)', 2)} AS effort FROM housing_base""")
_h = "housing_in"
FRAGMENTS["housing"] = ((_h,), "SELECT arrondissement, " + half_even(
    f"{min_max('m2_par_revenu', *bound(_h, 'm2_par_revenu'))} * 0.6::DOUBLE + {min_max('effort', *bound(_h, 'effort'), True)} * 0.4::DOUBLE", 2)
    + " AS score_accessibilite_immo, revenu_median, m2_par_revenu FROM housing_in")


def housing(spark, sf, prices=None):
    return gold.housing_scores(yearly(spark, sf) if prices is None else prices, income(spark, sf), rents(spark, sf), D.spine(spark))


FRAGMENTS["indicators"] = (("access", "life", "safety", "housing"), "SELECT *, " + half_even(
    "(score_accessibilite + score_qualite_vie + score_securite + score_accessibilite_immo) / 4e0", 2) + """ AS score_global
    FROM access LEFT JOIN life USING (arrondissement) LEFT JOIN safety USING (arrondissement) LEFT JOIN housing USING (arrondissement)""")


def indicators(spark, sf, prices=None):
    return gold.indicators(access(spark, sf), life(spark, sf), safety(spark, sf), housing(spark, sf, prices))


@query("x01_min_max_scores", with_("poi") + f"""
    SELECT arrondissement, {min_max('nb_pharmacies', *bound('poi', 'nb_pharmacies'))} AS direct,
           {min_max('nb_hopitaux', *bound('poi', 'nb_hopitaux'), True)} AS inverse, 5e0 AS constante FROM poi""")
def min_max_scores(spark, sf):
    base = pois(spark, sf).withColumn("fixe", F.lit(3.0))
    return base.withColumn("_b", gold.bounds_of(["nb_pharmacies", "nb_hopitaux", "fixe"])).select(
        C.REGION, gold.scaled("nb_pharmacies").alias("direct"), gold.scaled("nb_hopitaux", inverse=True).alias("inverse"),
        gold.scaled("fixe").alias("constante"))


@query("x02_air_score", f"""
    SELECT event_id, value AS iqa_moyen, {half_even('greatest(least(1e2 - value, 1e2), 0)', 1)} AS score_air FROM events""")
def air_score(spark, sf):
    return silver.with_air_score(D.table(spark, sf, "events").select("event_id", F.col("value").alias("iqa_moyen")))


@query("x03_access_score", with_("access") + "SELECT * FROM access")
def access_score(spark, sf):
    return access(spark, sf)


@query("x04_life_score", with_("life") + "SELECT * FROM life")
def life_score(spark, sf):
    return life(spark, sf)


@query("x04_noise_score", with_("noise") + "SELECT * FROM noise")
def noise_score(spark, sf):
    return noise(spark, sf).drop("lnight", "score_bruit_raw")


@query("x04_traffic_score", with_("traffic") + "SELECT * FROM traffic")
def traffic_score(spark, sf):
    return traffic(spark, sf)


@query("x05_safety_score", with_("safety") + "SELECT * FROM safety")
def safety_score(spark, sf):
    return safety(spark, sf)


@query("x06_housing_score", with_("housing") + "SELECT * FROM housing")
def housing_score(spark, sf):
    return housing(spark, sf)


@query("x07_j04_indicators", with_("indicators") + "SELECT * FROM indicators")
def indicator_table(spark, sf):
    return indicators(spark, sf)


@query("x09_spread_reading", f"""
    WITH b AS (SELECT n_nationkey + 1 AS arrondissement, CAST(40 + n_nationkey * 7 % 23 AS DOUBLE) AS iqa_base FROM nation)
    SELECT event_id, arrondissement, {half_even('value * (iqa_base / (SELECT avg(iqa_base) FROM b))', 1)} AS iqa FROM events, b""")
def spread_reading(spark, sf):
    n = F.col("n_nationkey")
    base = D.table(spark, sf, "nation").select((n + 1).alias(C.REGION), (F.lit(40) + n * 7 % 23).cast("double").alias("iqa_base"))
    events = D.table(spark, sf, "events").select("event_id", F.col("value").alias("iqa"))
    return air.spread_reading(events, base, {"iqa": "iqa_base"})


@query("x10_alert_level", """
    SELECT event_id, value, CASE WHEN value > 100 THEN 'rouge' WHEN value > 75 THEN 'orange' END AS alert_level FROM events""")
def alerts(spark, sf):
    return D.table(spark, sf, "events").select("event_id", "value", X.alert_level("value").alias("alert_level"))


# The final table: yearly prices with social stock, income, rents, air and scores.

FRAGMENTS["social"] = ((), """
    SELECT s_nationkey + 1 AS arrondissement, CAST(count(*) AS INT) AS nb_logements_sociaux,
           CAST(min(s_suppkey) % 100 AS DOUBLE) AS part_logements_sociaux_pct FROM supplier GROUP BY 1""")
FRAGMENTS["gapped_social"] = ((), """
    SELECT s_nationkey % 23 + 1 AS arrondissement, CAST(count(*) AS INT) AS nb_logements_sociaux,
           CAST(min(s_suppkey) % 100 AS DOUBLE) AS part_logements_sociaux_pct FROM supplier GROUP BY 1""")


def social(spark, sf, view=lambda df: df):
    return view(D.suppliers(spark, sf)).groupBy(C.REGION).agg(
        F.count(F.lit(1)).cast("int").alias("nb_logements_sociaux"),
        (F.min("s_suppkey") % 100).cast("double").alias("part_logements_sociaux_pct"))


FRAGMENTS["gold_final"] = (("prices", "income", "social", "sensors", "indicators"), f"""
    SELECT p.*, nb_logements_sociaux, part_logements_sociaux_pct, i.revenu_median,
           {half_even('i.revenu_median / prix_m2_median', 2)} AS m2_par_revenu_annuel,
           {half_even('prix_m2_median * 5e1 / i.revenu_median', 1)} AS annees_pour_50m2, loyer_ref_median_m2,
           a.iqa_moyen, CASE WHEN a.iqa_moyen IS NOT NULL THEN {half_even('greatest(least(1e2 - a.iqa_moyen, 1e2), 0)', 1)} END AS score_air,
           score_accessibilite, nb_arrets, nb_ecoles, score_qualite_vie, nb_parcs, score_securite, nb_faits,
           score_accessibilite_immo, score_global
    FROM prices p LEFT JOIN social USING (arrondissement) LEFT JOIN income i USING (arrondissement)
    LEFT JOIN sensors a USING (arrondissement)
    LEFT JOIN (SELECT s_nationkey + 1 AS arrondissement, median(s_acctbal / 1e2) AS loyer_ref_median_m2 FROM supplier GROUP BY 1) r
      USING (arrondissement)
    LEFT JOIN indicators d USING (arrondissement)""")


def final(spark, sf):
    prices = durable(yearly(spark, sf))
    return gold.final_table(
        prices, D.spine(spark), social(spark, sf), income(spark, sf), rents(spark, sf),
        silver.with_air_score(sensors(spark, sf)), indicators(spark, sf, prices))


@query("gold_final", with_("gold_final") + "SELECT * REPLACE (round(loyer_ref_median_m2, 8) AS loyer_ref_median_m2) FROM gold_final")
def gold_final(spark, sf):
    return final(spark, sf).withColumn("loyer_ref_median_m2", F.round("loyer_ref_median_m2", 8))
