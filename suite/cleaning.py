"""Filters, codes, parsing and imputation (P rows)."""

from pyspark.sql import functions as F

from regionlake import config as C
from regionlake.functions import cleaning as X
from regionlake.functions.geo import grid_region
from regionlake.operators.reshape import first_of
from regionlake.plans import silver
from regionlake.plans.serving import without_nan
from regionlake.sources.delimited import normalized, renamed, resolve_aliases
from suite import domain as D
from suite.registry import half_even, query, with_


@query("p01_prefix_filter", """
    SELECT c_custkey, '750' || lpad(CAST(c_nationkey + 1 AS VARCHAR), 2, '0') AS code
    FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')""")
def prefix_filter(spark, sf):
    code = F.lpad(F.col(C.REGION).cast("string"), 2, "0")
    df = D.customers(spark, sf).withColumn(
        "code", F.when(F.col("c_mktsegment") == "MACHINERY", F.concat(F.lit("751"), code)).when(
            F.col("c_mktsegment") != "BUILDING", F.concat(F.lit("750"), code)))
    return df.where(X.has_prefix("code")).select("c_custkey", "code")


@query("p02_equality_in_filter", with_("raw_sales") + """
    SELECT nature_mutation, type_local, count(*) AS n, CAST(sum(l_linenumber) AS BIGINT) AS lignes FROM raw_sales
    WHERE nature_mutation = 'Vente' AND type_local IN ('Appartement', 'Maison') GROUP BY 1, 2""")
def equality_in(spark, sf):
    rules = C.SaleRules()
    raw = D.raw_sales(spark, sf)
    kept = raw.where((F.col("nature_mutation") == rules.nature) & F.col("type_local").isin(*rules.kinds))
    return kept.groupBy("nature_mutation", "type_local").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_linenumber").alias("lignes"))


@query("p03_decimal_comma", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice AS valeur,
           CASE WHEN l_linenumber = 1 THEN NULL ELSE l_quantity END AS quantite FROM lineitem""")
def decimal_comma(spark, sf):
    text = F.regexp_replace(F.col("l_extendedprice").cast("string"), r"\.", ",")
    broken = F.when(F.col("l_linenumber") == 1, F.lit("n/a")).otherwise(F.col("l_quantity").cast("string"))
    return D.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", X.number(text).alias("valeur"), X.number(broken).alias("quantite"))


@query("p04_p05_unit_price_bands", with_("priced") + f"""
    SELECT arrondissement, count(*) AS n, {half_even('min(prix_m2)', 4)} AS prix_min,
           {half_even('max(prix_m2)', 4)} AS prix_max, min(surface_reelle_bati) AS surface_min FROM priced GROUP BY 1""")
def bands(spark, sf):
    return D.priced_sales(spark, sf).groupBy(C.REGION).agg(
        F.count(F.lit(1)).alias("n"),
        X.round_half_even(F.min("prix_m2"), 4).alias("prix_min"),
        X.round_half_even(F.max("prix_m2"), 4).alias("prix_max"),
        F.min("surface_reelle_bati").alias("surface_min"))


@query("p06_p07_alias_resolution", """
    SELECT o_custkey AS arrondissement, o_orderpriority AS nb_pieces, o_totalprice AS loyer_max_m2,
           o_totalprice / 2e0 AS loyer_ref_m2, o_orderstatus AS annee, o_orderkey AS id FROM orders""")
def alias_resolution(spark, sf):
    landed = D.table(spark, sf, "orders").select(
        F.col("o_custkey").alias(" Arr "), F.col("o_orderpriority").alias("NB Pieces"),
        F.col("o_totalprice").alias("Plafond m2/mois"), (F.col("o_totalprice") / 2.0).alias("Loyer Reference"),
        F.col("o_orderstatus").alias("Annee"), F.col("o_orderkey").alias("ID"))
    clean = landed.toDF(*[normalized(c, underscores=True) for c in landed.columns])
    return renamed(clean, resolve_aliases(clean.columns, C.RENT_ALIASES))


@query("p08_region_from_code", with_("customers") + """
    SELECT c_custkey, CASE WHEN c_acctbal < 0 OR arrondissement > 20 THEN NULL ELSE arrondissement END AS region
    FROM customers""")
def region_from_code(spark, sf):
    code = F.concat(F.lit("750"), F.lpad(F.col(C.REGION).cast("string"), 2, "0"))
    odd = F.when(F.col("c_acctbal") < 0, F.concat(code, F.lit("9"))).otherwise(code)
    return D.customers(spark, sf).select("c_custkey", X.region_of_code(odd, "750").alias("region"))


@query("p09_commune_map", with_("customers") + """
    SELECT arrondissement AS region, count(*) AS n FROM customers WHERE arrondissement <= 20 GROUP BY 1""")
def commune_map(spark, sf):
    code = (F.col(C.REGION) + 75100).cast("string")
    df = D.customers(spark, sf).select(X.region_of_commune(code).alias("region"))
    return df.where(F.col("region").isNotNull()).groupBy("region").agg(F.count(F.lit(1)).alias("n"))


@query("p10_trailing_digits", """
    SELECT c_custkey, CAST(regexp_extract(c_name, '(\\d{1,2})$', 1) AS INT) AS fin,
           TRY_CAST(nullif(regexp_extract(c_mktsegment || CASE WHEN c_custkey % 3 = 0 THEN CAST(c_custkey AS VARCHAR) ELSE '' END,
                    '(\\d+)', 1), '') AS INT) AS premier FROM customer""")
def trailing_digits(spark, sf):
    mixed = F.concat("c_mktsegment", F.when(F.col("c_custkey") % 3 == 0, F.col("c_custkey").cast("string")).otherwise(""))
    return D.table(spark, sf, "customer").select(
        "c_custkey", X.last_digits("c_name").alias("fin"), X.first_digits(mixed).alias("premier"))


@query("p11_mixed_code", with_("customers") + """
    SELECT c_custkey, CASE WHEN arrondissement <= 20 THEN arrondissement END AS region FROM customers""")
def mixed_code(spark, sf):
    code = F.when(F.col("c_custkey") % 2 == 0, F.col(C.REGION) + 75100).otherwise(F.col(C.REGION))
    return D.customers(spark, sf).select("c_custkey", X.region_of_mixed(code.cast("string")).alias("region"))


@query("p12_first_truthy", """
    SELECT s_suppkey, coalesce(nullif(s_nationkey, 0), nullif(CAST(s_suppkey % 3 AS INT), 0), 99) AS n,
           coalesce(CASE WHEN s_suppkey % 2 = 1 THEN s_name END, 'sans nom') AS nom FROM supplier""")
def first_truthy(spark, sf):
    blank = F.when(F.col("s_suppkey") % 2 == 1, F.col("s_name")).otherwise(F.lit(""))
    return D.table(spark, sf, "supplier").select(
        "s_suppkey",
        X.first_truthy("s_nationkey", (F.col("s_suppkey") % 3).cast("int"), F.lit(99)).alias("n"),
        X.first_filled(blank, F.lit("sans nom")).alias("nom"))


@query("p13_bounding_box", with_("customers") + """
    SELECT c_custkey, lat, lon FROM customers
    WHERE lat BETWEEN 48.8::DOUBLE AND 48.92::DOUBLE AND lon BETWEEN 2.26::DOUBLE AND 2.42::DOUBLE""")
def bounding_box(spark, sf):
    return D.customers(spark, sf).where(X.in_box("lat", "lon")).select("c_custkey", "lat", "lon")


@query("p14_class_mapping", """
    SELECT CASE p_type WHEN 'ECONOMY' THEN 'supermarche' WHEN 'LARGE' THEN 'boulangerie' WHEN 'MEDIUM' THEN 'pharmacie'
                WHEN 'PROMO' THEN 'hopital' ELSE 'medecin' END AS categorie, count(*) AS n
    FROM part WHERE p_type <> 'STANDARD' GROUP BY 1""")
def class_mapping(spark, sf):
    """Part types as tags; standard parts have tags without a class."""
    t = F.col("p_type")
    shop = (F.when(t == "ECONOMY", "convenience").when(t == "LARGE", "bakery").when(t == "MEDIUM", "pharmacy")
            .when(t == "STANDARD", "kiosk"))
    amenity = F.when(t == "PROMO", "clinic").when(t == "SMALL", "doctors").when(t == "STANDARD", "bench")
    df = D.table(spark, sf, "part").select(X.poi_class(shop, amenity).alias("categorie"))
    return df.where(F.col("categorie").isNotNull()).groupBy("categorie").agg(F.count(F.lit(1)).alias("n"))


GRID_SQL = """
    CASE WHEN NOT (lat > 48.815::DOUBLE AND lat < 48.905::DOUBLE AND lon > 2.255::DOUBLE AND lon < 2.42::DOUBLE) THEN NULL
     WHEN lon < 2.33::DOUBLE THEN CASE WHEN lat > 48.855::DOUBLE THEN 16 ELSE 15 END
     WHEN lon < 2.35::DOUBLE THEN CASE WHEN lat > 48.88::DOUBLE THEN 17 WHEN lat > 48.86::DOUBLE THEN 8 WHEN lat > 48.84::DOUBLE THEN 7 ELSE 14 END
     WHEN lon < 2.365::DOUBLE THEN CASE WHEN lat > 48.875::DOUBLE THEN 9 WHEN lat > 48.855::DOUBLE THEN 1 WHEN lat > 48.835::DOUBLE THEN 6 ELSE 13 END
     WHEN lon < 2.38::DOUBLE THEN CASE WHEN lat > 48.875::DOUBLE THEN 10 WHEN lat > 48.855::DOUBLE THEN 4 WHEN lat > 48.835::DOUBLE THEN 5 ELSE 13 END
     WHEN lon < 2.395::DOUBLE THEN CASE WHEN lat > 48.875::DOUBLE THEN 19 WHEN lat > 48.86::DOUBLE THEN 11 WHEN lat > 48.84::DOUBLE THEN 12 ELSE 13 END
     ELSE CASE WHEN lat > 48.875::DOUBLE THEN 20 WHEN lat > 48.855::DOUBLE THEN 11 ELSE 12 END END"""


@query("p15_grid_region", with_("customers") + f"SELECT c_custkey, {GRID_SQL} AS region FROM customers")
def grid(spark, sf):
    return D.customers(spark, sf).select("c_custkey", grid_region("lat", "lon").alias("region"))


@query("p16_date_parsing", """
    SELECT CAST(year(o_orderdate) AS INT) AS an, count(*) AS n,
           count(*) FILTER (WHERE o_orderpriority <> '5-LOW') AS dates_lues FROM orders GROUP BY 1""")
def date_parsing(spark, sf):
    text = F.when(F.col("o_orderpriority") == "5-LOW", F.lit("31/02/x")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return D.table(spark, sf, "orders").select(F.year("o_orderdate").alias("an"), X.parsed_date(text).alias("d")).groupBy(
        "an").agg(F.count(F.lit(1)).alias("n"), F.count("d").alias("dates_lues"))


@query("p17_truncate_and_address", """
    SELECT c_custkey, substr(c_name || c_name || c_mktsegment, 1, 32) AS nom,
           CASE WHEN c_custkey % 4 = 0 THEN NULL WHEN c_custkey % 4 = 1 THEN CAST(c_nationkey AS VARCHAR)
                WHEN c_custkey % 4 = 2 THEN c_mktsegment ELSE CAST(c_nationkey AS VARCHAR) || ' ' || c_mktsegment END AS adresse
    FROM customer""")
def truncate(spark, sf):
    m = F.col("c_custkey") % 4
    return D.table(spark, sf, "customer").select(
        "c_custkey", X.truncated(F.concat("c_name", "c_name", "c_mktsegment"), 32).alias("nom"),
        X.address(F.when(m.isin(1, 3), F.col("c_nationkey")), F.when(m.isin(2, 3), F.col("c_mktsegment"))).alias("adresse"))


@query("p18_drop_incomplete", """
    SELECT l_returnflag, count(*) AS n FROM lineitem WHERE l_linenumber <> 1 AND l_quantity > 10 GROUP BY 1""")
def drop_incomplete(spark, sf):
    df = D.table(spark, sf, "lineitem").select(
        "l_returnflag", F.when(F.col("l_linenumber") != 1, F.col("l_extendedprice")).alias("v"),
        F.when(F.col("l_quantity") > 10, F.col("l_quantity")).alias("s"))
    return df.na.drop(subset=["v", "s"]).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))


@query("p19_impute", """
    WITH base AS (SELECT n_nationkey + 1 AS arrondissement, CAST(t.n AS DOUBLE) AS nb FROM nation
                  LEFT JOIN (SELECT s_nationkey % 23 AS s_nationkey, count(*) n FROM supplier GROUP BY 1) t
                  ON t.s_nationkey = n_nationkey)
    SELECT arrondissement, coalesce(nb, 5e0) AS par_constante,
           coalesce(nb, (SELECT median(nb) FROM base)) AS par_mediane,
           round(coalesce(nb, (SELECT avg(nb) FROM base)), 9) AS par_moyenne,
           CASE WHEN arrondissement <= 20 THEN [10,9.5,9,9.5,8.5,8.5,8,8,7.5,7,7.5,6.5,6,6,6.5,6,7,6.5,5.5,6][arrondissement] END::DOUBLE
             AS par_table
    FROM base""")
def impute(spark, sf):
    from regionlake.operators.aggregates import count_by
    from regionlake.plans.gold import filled

    sp = D.spine(spark)
    few = D.gapped(D.suppliers(spark, sf))
    base = sp.attach(count_by(few, [C.REGION], "nb")).withColumn("nb", F.col("nb").cast("double"))
    mean = base.agg(F.avg("nb")).scalar()
    df = base.withColumn("par_constante", F.coalesce("nb", F.lit(5.0))).withColumn("par_mediane", F.col("nb"))
    df = df.withColumn("par_moyenne", F.round(F.coalesce(F.col("nb"), mean), 9)).withColumn("vide", F.lit(None).cast("double"))
    df = filled(df, {"par_mediane": (F.lit(0.0), None), "vide": (sp.literal(C.by_region(C.CENTRALITY)), F.lit(0.0))})
    return df.select(C.REGION, "par_constante", "par_mediane", "par_moyenne", F.col("vide").alias("par_table"))


@query("p20_clip_and_scale", """
    SELECT event_id, greatest(least(100 - value, 100), 0) / 10 AS s FROM events""")
def clip_scale(spark, sf):
    return D.table(spark, sf, "events").select("event_id", (X.clip(F.lit(100.0) - F.col("value"), 0, 100) / 10.0).alias("s"))


@query("p21_keyword_category", """
    SELECT CASE WHEN contains(t, 'crim') OR contains(t, 'securite') THEN 'securite'
                WHEN contains(t, 'parc') THEN 'qualite_vie' WHEN contains(t, 'acces') THEN 'accessibilite'
                WHEN contains(t, 'prix') OR contains(t, 'als') THEN 'economique' ELSE 'autre' END AS categorie, count(*) AS n
    FROM (SELECT CASE p_size % 6 WHEN 0 THEN 'nb_crimes' WHEN 1 THEN 'nb_parcs' WHEN 2 THEN 'score_accessibilite_immo'
                 WHEN 3 THEN 'prix_m2' WHEN 4 THEN 'deals' ELSE 'score_zone' END AS t FROM part) GROUP BY 1""")
def keyword_category(spark, sf):
    m = F.col("p_size") % 6
    name = (F.when(m == 0, "NB_CRIMES").when(m == 1, "nb_parcs").when(m == 2, "score_accessibilite_immo")
            .when(m == 3, "Prix_m2").when(m == 4, "deals").otherwise("score_zone"))
    return D.table(spark, sf, "part").select(X.keyword_category(name).alias("categorie")).groupBy("categorie").agg(
        F.count(F.lit(1)).alias("n"))


@query("p22_nan_to_null", """
    SELECT l_returnflag, count(*) FILTER (WHERE l_linenumber > 2) AS connus, count(*) AS n FROM lineitem GROUP BY 1""")
def nan_to_null(spark, sf):
    n = F.col("l_linenumber")
    df = D.table(spark, sf, "lineitem").select(
        "l_returnflag",
        F.when(n == 1, F.lit(float("nan"))).when(n == 2, F.lit(float("-inf"))).otherwise(F.col("l_tax")).alias("v"))
    return without_nan(df).groupBy("l_returnflag").agg(F.count("v").alias("connus"), F.count(F.lit(1)).alias("n"))


@query("p23_combine_first", """
    SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice ELSE o_custkey END AS nb FROM orders""")
def combine_first(spark, sf):
    df = D.table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, F.col("o_totalprice")).alias("nb_x"),
        F.col("o_custkey").cast("double").alias("nb_y"))
    return first_of(df, "nb", "nb_x", "nb_y")


@query("silver_sales", with_("sales") + """
    SELECT date_mutation, annee, arrondissement, type_local, valeur_fonciere, surface_reelle_bati,
           prix_m2, CAST(l_linenumber AS DOUBLE) AS nombre_pieces_principales, longitude, latitude
    FROM sales WHERE arrondissement <= 20""")
def silver_sales(spark, sf):
    return silver.sales(D.landed_sales(spark, sf))
