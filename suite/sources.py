"""Readers and writers over files that Spark derives from the given tables (S rows)."""

from datetime import date

from pyspark.sql import functions as F

from regionlake import config as C
from regionlake.operators.reshape import first_rows
from regionlake.operators.spatial import polygon_edges
from regionlake.plans import gold, silver
from regionlake.plans.batch import Lake, overall_status, run_steps, step_rows, transactions
from regionlake.schemas import AIR, ELEMENTS, NOISE, SCHOOL, SHOPS, STOP, TRAFFIC, envelope
from regionlake.session import durable, scratch_path, settings
from regionlake.sources import delimited, documents, files, sinks
from suite import domain as D
from suite.aggregation import yearly
from suite.cleaning import GRID_SQL
from suite.joins import shapes
from suite.registry import FRAGMENTS, half_even, query, with_


WRITERS = 64  # years a task writes side by side, before it sorts its rows by year


@query("s01_yearly_csv_gz", with_("sales") + """
    SELECT annee, count(*) AS n, count(DISTINCT arrondissement) AS regions, CAST(sum(l_linenumber) AS DOUBLE) AS pieces
    FROM sales WHERE arrondissement <= 20 GROUP BY 1""")
def yearly_csv(spark, sf):
    """Lines landed as gzip CSV per year; requested years without a file are skipped."""
    folder = scratch_path(spark, "csv")
    D.landed_sales(spark, sf).write.partitionBy(C.YEAR).option("header", "true").option("compression", "gzip").csv(folder)
    raw = delimited.read_sales(spark, folder, range(1990, 2025), "annee={year}", partitions=8)
    return silver.sales(raw).groupBy(C.YEAR).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct(C.REGION).alias("regions"),
        F.sum("nombre_pieces_principales").alias("pieces"))


@query("s02_unknown_dialect", """
    SELECT c_custkey, 'Été ' || c_mktsegment AS nom, c_acctbal AS solde, c_nationkey + 1 AS arrondissement FROM customer""")
def unknown_dialect(spark, sf):
    """Latin-1 with commas under a header in capitals: separator and encoding are found out."""
    path = scratch_path(spark, "latin")
    D.customers(spark, sf).select(
        F.col("c_custkey").alias("CLE"), F.concat(F.lit("Été "), "c_mktsegment").alias(" Nom "),
        F.col("c_acctbal").alias("SOLDE"), F.col(C.REGION).alias("Arr"),
    ).write.option("header", "true").option("encoding", "ISO-8859-1").csv(path)
    df = delimited.read_delimited(spark, path)
    return df.select(F.col("cle").cast("bigint").alias("c_custkey"), "nom", F.col("solde").cast("double").alias("solde"),
                     F.col("arr").cast("int").alias(C.REGION))


@query("s02_quoted_semicolons", """
    SELECT c_custkey, 'a;' || c_mktsegment || '"b' AS nom, c_acctbal AS solde, c_nationkey + 1 AS arrondissement FROM customer""")
def quoted_semicolons(spark, sf):
    """Semicolons, with separators and quotes inside a header name and inside values."""
    path = scratch_path(spark, "quoted")
    D.customers(spark, sf).select(
        F.col("c_custkey").alias("Cle"), F.concat(F.lit("a;"), "c_mktsegment", F.lit('"b')).alias("Nom; prénom"),
        F.col("c_acctbal").alias("Solde"), F.col(C.REGION).alias("Arr/code"),
    ).write.option("header", "true").option("sep", ";").option("escape", '"').csv(path)
    df = delimited.read_delimited(spark, path, underscores=True)
    return df.select(F.col("cle").cast("bigint").alias("c_custkey"), F.col("`nom;_prénom`").alias("nom"), F.col("solde").cast("double").alias("solde"),
                     F.col("arr_code").cast("int").alias(C.REGION))


def bundled(df, size, record, wrap):
    """One JSON document per ``size`` consecutive keys; ``wrap`` turns the list into an envelope."""
    docs = df.select(F.floor(F.col("k") / size).alias("b"), record.alias("r"))
    return docs.groupBy("b").agg(F.collect_list("r").alias("rs")).select(wrap.alias("doc"))


def enveloped(df, record, size=50):
    """The three envelopes of record lists, in turn."""
    results, records_ = F.to_json(F.struct(F.col("rs").alias("results"))), F.to_json(F.struct(F.col("rs").alias("records")))
    wrap = F.when(F.col("b") % 3 == 0, results).when(F.col("b") % 3 == 1, records_).otherwise(F.to_json("rs"))
    return bundled(df, size, record, wrap)


@query("s03_record_envelopes", with_("customers") + """
    SELECT CASE WHEN c_acctbal < 0 THEN 'a' ELSE 'b' END || c_mktsegment AS nom, lat, lon, CASE WHEN c_acctbal > 5000 THEN 'Metro' ELSE '' END AS type,
           count(*) AS n FROM customers
    WHERE lat BETWEEN 48.8::DOUBLE AND 48.92::DOUBLE AND lon BETWEEN 2.26::DOUBLE AND 2.42::DOUBLE AND c_mktsegment <> 'MACHINERY' GROUP BY 1, 2, 3, 4""")
def record_envelopes(spark, sf):
    """Stops with several name and coordinate fields; one segment has no coordinates."""
    df = D.customers(spark, sf).withColumn("k", F.col("c_custkey"))
    seg, balance = F.col("c_mktsegment"), F.col("c_acctbal")
    geo, own = seg.isin("AUTOMOBILE", "BUILDING"), seg.isin("FURNITURE", "HOUSEHOLD")
    record = F.struct(
        F.when(balance < 0, F.concat(F.lit("a"), seg)).alias("nom_long"),
        F.when(balance >= 0, F.concat(F.lit("b"), seg)).alias("nom_arret"),
        F.when(geo, F.struct("lat", "lon")).alias("geo_point_2d"),
        F.when(own, F.col("lat").cast("string")).alias("stop_lat"),
        F.when(own, F.col("lon").cast("string")).alias("stop_lon"),
        F.when(balance > 5000, F.lit("Metro")).alias("mode"))
    raw = documents.parse_json(enveloped(df, record), "doc", envelope(STOP))
    return silver.stops(raw).groupBy("nom", "lat", "lon", "type").agg(F.count(F.lit(1)).alias("n"))


@query("s03_schools", with_("customers") + """
    SELECT c_mktsegment AS nom, '750' || lpad(CAST(arrondissement AS VARCHAR), 2, '0') AS code_postal, arrondissement, '' AS type,
           CASE WHEN c_custkey % 2 = 0 THEN 'Public' ELSE '' END AS statut, lat, lon, count(*) AS n FROM customers
    WHERE arrondissement <= 20 AND c_acctbal >= 0 GROUP BY ALL""")
def schools(spark, sf):
    df = D.customers(spark, sf).withColumn("k", F.col("c_custkey"))
    k = F.col("c_custkey")
    code = F.concat(F.when(F.col("c_acctbal") < 0, F.lit("751")).otherwise("750"), F.lpad(F.col(C.REGION).cast("string"), 2, "0"))
    record = F.struct(
        F.when(k % 2 == 0, code).alias("code_postal_uai"), F.when(k % 2 != 0, code).alias("code_postal"),
        F.col("c_mktsegment").alias("appellation_officielle"),
        F.when(k % 4 == 0, F.col("lat").cast("string")).alias("latitude"), F.when(k % 4 == 0, F.col("lon").cast("string")).alias("longitude"),
        F.when(k % 4 != 0, F.struct("lat", "lon")).alias("position"),
        F.when(k % 2 == 0, F.lit("Public")).alias("statut_public_prive"))
    raw = documents.parse_json(enveloped(df, record), "doc", envelope(SCHOOL))
    return silver.schools(raw).groupBy("nom", "code_postal", C.REGION, "type", "statut", "lat", "lon").agg(F.count(F.lit(1)).alias("n"))


@query("s04_map_document", f"""
    SELECT CAST(c_custkey % 20 + 1 AS INT) AS arrondissement, c_acctbal / 1e2 AS iqa_moyen, CAST(c_nationkey AS DOUBLE) AS "no2_µg_m3",
           NULL::DOUBLE AS "pm25_µg_m3", {half_even('greatest(least(1e2 - c_acctbal / 1e2, 1e2), 0)', 1)} AS score_air FROM customer""")
def map_document(spark, sf):
    """Region-keyed maps of twenty regions each."""
    df = D.table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), "c_custkey", "c_acctbal", "c_nationkey")
    record = F.struct((F.col("c_custkey") % 20 + 1).cast("string").alias("key"), F.struct(
        (F.col("c_acctbal") / 1e2).alias("iqa_moyen"), F.col("c_nationkey").alias("no2_µg_m3")).alias("value"))
    wrap = F.to_json(F.struct(F.lit("repli").alias("source"), F.map_from_entries("rs").alias("arrondissements")))
    return silver.air_quality(documents.parse_json(bundled(df, 20, record, wrap), "doc", AIR))


@query("s04_air_live_list", f"""
    SELECT arrondissement, iqa_moyen, "no2_µg_m3", "pm25_µg_m3", {half_even('greatest(least(1e2 - iqa_moyen, 1e2), 0)', 1)} AS score_air, n FROM (
      SELECT CAST(user_id % 20 + 1 AS INT) AS arrondissement, value AS iqa_moyen, CAST(user_id AS DOUBLE) AS "no2_µg_m3", 3e0 AS "pm25_µg_m3", count(*) AS n
      FROM events WHERE event_type <> 'error' GROUP BY ALL)""")
def air_live(spark, sf):
    """Live records in lists; errors belong to other communes."""
    df = D.table(spark, sf, "events").withColumn("k", F.col("event_id"))
    region = F.lpad((F.col("user_id") % 20 + 1).cast("string"), 2, "0")
    code = F.concat(F.when(F.col("event_type") == "error", F.lit("920")).otherwise("751"), region)
    odd = F.col("event_id") % 2 == 1
    record = F.struct(
        F.when(odd, code).alias("commune_code"), F.when(~odd, code).alias("insee"),
        F.when(odd, F.col("value")).alias("indice"), F.when(~odd, F.col("value").cast("string")).alias("iqa"),
        F.col("user_id").alias("no2"), F.lit(3).alias("pm2_5"))
    raw = documents.parse_json(bundled(df, 100, record, F.to_json("rs")), "doc", AIR)
    out = silver.air_quality(raw)
    return out.groupBy(*out.columns).agg(F.count(F.lit(1)).alias("n"))


OSM = """
    SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN lat + 0.001::DOUBLE ELSE lat END AS lat, lon, c_custkey % 3 AS m FROM customers"""


def element_documents(spark, sf):
    """Tagged elements; every fourth has a centre that differs from its own coordinate."""
    df = D.customers(spark, sf).withColumn("k", F.col("c_custkey"))
    k = F.col("c_custkey")
    name = F.when(k % 3 == 0, F.struct(F.lit("Parc").alias("name"), F.lit("garden").alias("leisure"), F.lit("bakery").alias("shop"))).when(
        k % 3 == 1, F.struct(F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("leisure"), F.lit("convenience").alias("shop")))
    record = F.struct(
        F.lit("node").alias("type"), k.alias("id"), "lat", "lon",
        F.when(k % 4 == 0, F.struct((F.col("lat") + F.lit(0.001)).alias("lat"), "lon")).alias("center"), name.alias("tags"))
    return bundled(df, 50, record, F.to_json(F.struct(F.col("rs").alias("elements"))))


@query("s05_park_elements", with_("customers") + f"""
    SELECT c_custkey AS osm_id, CASE WHEN m = 0 THEN 'Parc' ELSE 'Parc sans nom' END AS name, CASE WHEN m = 0 THEN 'garden' ELSE 'park' END AS type, lat, lon
    FROM ({OSM}) WHERE lat BETWEEN 48.8::DOUBLE AND 48.92::DOUBLE AND lon BETWEEN 2.26::DOUBLE AND 2.42::DOUBLE""")
def park_elements(spark, sf):
    return silver.parks(documents.parse_json(element_documents(spark, sf), "doc", ELEMENTS)).drop(C.REGION)


@query("s05_security_union", with_("customers") + f"""
    SELECT type, CASE WHEN m = 0 THEN 'Parc' ELSE '' END AS nom, lat, lon, count(*) AS n FROM ({OSM}), (VALUES ('commissariats'), ('pompiers')) t(type)
    WHERE lat BETWEEN 48.8::DOUBLE AND 48.92::DOUBLE AND lon BETWEEN 2.25::DOUBLE AND 2.42::DOUBLE GROUP BY ALL""")
def security_union(spark, sf):
    raw = documents.parse_json(element_documents(spark, sf), "doc", ELEMENTS)
    return silver.security(raw, raw).groupBy("type", "nom", "lat", "lon").agg(F.count(F.lit(1)).alias("n"))


@query("s05_shop_counts", with_("customers") + f"""
    , g AS (SELECT m, {GRID_SQL} AS region FROM ({OSM}) WHERE m < 2)
    SELECT n_nationkey + 1 AS arrondissement, CAST(count(*) FILTER (WHERE m = 1) AS INT) AS nb_supermarches, 0 AS nb_pharmacies,
           CAST(count(*) FILTER (WHERE m = 0) AS INT) AS nb_boulangeries, 0 AS nb_centres_commerciaux
    FROM nation LEFT JOIN g ON g.region = n_nationkey + 1 WHERE n_nationkey < 20 GROUP BY 1""")
def shop_counts(spark, sf):
    """Elements to classes, grid regions and counts for every region of the spine."""
    raw = documents.parse_json(element_documents(spark, sf), "doc", SHOPS)
    return silver.shops_and_health(raw, None, D.spine(spark, 20))


@query("s06_polygon_edges", D.EDGES + " ORDER BY 1")
def polygon_table(spark, sf):
    edges = polygon_edges(shapes(spark, sf)).select(F.col(C.REGION).alias("region"), F.inline("edges"))
    return edges.where((F.col("x1") != F.col("x2")) | (F.col("y1") != F.col("y2")))


FRAGMENTS["lden"] = (("spine",), """
    SELECT s.arrondissement, avg(CAST(floor(value) AS DOUBLE)) AS lden_moyen, avg(CAST(floor(value) AS DOUBLE) / 2e0) AS lnight FROM spine s
    LEFT JOIN events e ON e.user_id % 22 + 1 = s.arrondissement AND event_type <> 'error' AND floor(value) <> 0 GROUP BY 1""")


@query("s07_nested_records", with_("lden") + f"""
    SELECT arrondissement, round(lden_moyen, 8) AS lden_moyen, round(lnight, 8) AS lnight, NULL::DOUBLE AS score_bruit_raw,
           CASE WHEN lden_moyen IS NULL THEN 5e0 ELSE {half_even('1e1 - (lden_moyen - (SELECT min(lden_moyen) FROM lden)) / ((SELECT max(lden_moyen) FROM lden) - (SELECT min(lden_moyen) FROM lden)) * 1e1', 2)} END AS score_bruit
    FROM lden""")
def nested_records(spark, sf):
    """``records[].fields`` documents of noise stations."""
    whole = F.floor("value").cast("int")
    df = D.table(spark, sf, "events").withColumn("k", F.col("event_id")).where(whole != 0)
    region = F.lpad((F.col("user_id") % 22 + 1).cast("string"), 2, "0")
    code = F.concat(F.when(F.col("event_type") == "error", F.lit("920")).otherwise("751"), region)
    odd = F.col("event_id") % 2 == 1
    fields = F.struct(
        code.alias("commune_code"), F.when(odd, whole).alias("lden"), F.when(~odd, whole).alias("laeq"),
        F.when(odd, whole / 2.0).alias("lnight"), F.when(~odd, whole / 2.0).alias("ln"))
    wrap = F.to_json(F.struct(F.col("rs").alias("records")))
    raw = documents.parse_json(bundled(df, 100, F.struct(fields.alias("fields")), wrap), "doc", NOISE)
    out = silver.noise(raw, D.spine(spark))
    return out.select(C.REGION, F.round("lden_moyen", 8).alias("lden_moyen"), F.round("lnight", 8).alias("lnight"), "score_bruit_raw", "score_bruit")


@query("s07_traffic_records", """
    WITH t AS (SELECT n_nationkey + 1 AS arrondissement, avg(CAST(floor(value) AS DOUBLE)) AS tmja FROM nation
               LEFT JOIN events ON user_id % 22 + 1 = n_nationkey + 1 AND event_type <> 'signup' AND floor(value) <> 0 GROUP BY 1)
    SELECT arrondissement, round(tmja, 8) AS tmja_moyen FROM t""")
def traffic_records(spark, sf):
    whole = F.floor("value").cast("int")
    df = D.table(spark, sf, "events").withColumn("k", F.col("event_id")).where(whole != 0)
    region = F.lpad((F.col("user_id") % 22 + 1).cast("string"), 2, "0")
    odd = F.col("event_id") % 2 == 1
    record = F.struct(
        F.when(odd & (F.col("event_type") != "signup"), region).alias("arrondissement"),
        F.when(~odd & (F.col("event_type") != "signup"), region).alias("codearr"),
        F.when(odd, whole).alias("q"), F.when(~odd, whole.cast("string")).alias("tmja"))
    wrap = F.to_json(F.struct(F.lit("capteurs").alias("source"), F.col("rs").alias("records")))
    raw = documents.parse_json(bundled(df, 100, record, wrap), "doc", TRAFFIC)
    return silver.traffic(raw, D.spine(spark)).select(C.REGION, F.round("tmja_moyen", 8).alias("tmja_moyen"))


@query("s08_partial_sources", """
    WITH b AS (SELECT n_nationkey + 1 AS arrondissement, CAST(coalesce(n, 0) AS DOUBLE) AS nb_parcs FROM nation
               LEFT JOIN (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1) ON c_nationkey = n_nationkey)
    """ + f"""SELECT arrondissement, {half_even(
        "(CASE WHEN (SELECT min(nb_parcs) FROM b) = (SELECT max(nb_parcs) FROM b) THEN 5e0 ELSE " + half_even(
            "(nb_parcs - (SELECT min(nb_parcs) FROM b)) / ((SELECT max(nb_parcs) FROM b) - (SELECT min(nb_parcs) FROM b)) * 1e1", 2)
        + " END) * 0.3::DOUBLE + 5e0 * 0.25::DOUBLE + 5e0 * 0.25::DOUBLE + 5e0 * 0.2::DOUBLE", 2)} AS score_qualite_vie, nb_parcs FROM b""")
def partial_sources(spark, sf):
    """Three of the four tables were never produced; their parts score neutral."""
    missing = lambda name: files.optional_parquet(spark, f"{sf}/{name}.parquet")
    parks = files.optional_parquet(spark, f"{sf}/customer.parquet").select((F.col("c_nationkey") + 1).alias(C.REGION))
    return gold.life_scores(parks, missing("qualite_air"), missing("bruit"), missing("circulation"), D.spine(spark))


@query("s09_partitioned_sink", with_("sales") + """
    SELECT annee, count(*) AS n, min(id) AS premier FROM sales WHERE annee <> 1997 OR type_local = 'Maison' GROUP BY 1""")
def partitioned_sink(spark, sf):
    """All years are written, then one year is replaced without touching the others."""
    path = scratch_path(spark, "yearly")
    sales = D.sales(spark, sf).select("id", C.REGION, C.YEAR, "type_local", "prix_m2")
    sinks.write_yearly(sales, path)
    sinks.write_yearly(sales.where((F.col(C.YEAR) == 1997) & (F.col("type_local") == "Maison")), path)
    return spark.read.parquet(path).groupBy(C.YEAR).agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("premier"))


@query("s10_region_lines", """
    SELECT c_custkey, '751' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS code FROM customer WHERE c_acctbal >= 0""")
def region_lines(spark, sf):
    part = F.lpad((F.col(C.REGION) - 1).cast("string"), 2, "0")
    code = F.when(F.col("c_acctbal") >= 0, F.concat(F.lit("751"), part)).otherwise(F.concat(F.lit("013"), part))
    df = D.customers(spark, sf).select("c_custkey", code.alias("code"))
    return delimited.region_lines(df, "code")


@query("s12_upsert_table", """
    SELECT s_suppkey, CASE WHEN s_acctbal < 0 THEN 0e0 ELSE s_acctbal END AS s_acctbal FROM supplier""")
def upsert_table(spark, sf):
    """Two upserts into a stored snapshot table; the second is repeated."""
    path = scratch_path(spark, "upsert")
    rows = D.table(spark, sf, "supplier").select("s_suppkey", "s_acctbal")
    sinks.upsert_table(rows, path, ["s_suppkey"])
    change = rows.where(F.col("s_acctbal") < 0).withColumn("s_acctbal", F.lit(0.0))
    sinks.upsert_table(change, path, ["s_suppkey"])
    return sinks.upsert_table(change, path, ["s_suppkey"])


@query("s13_reload_sample", with_("priced") + """
    SELECT id, l_partkey, prix_m2, substr(type_local, 1, 5) AS type_local, annee FROM priced
    WHERE arrondissement BETWEEN 1 AND 20""")
def reload_sample(spark, sf):
    from regionlake.functions.cleaning import truncated

    path = scratch_path(spark, "sample")
    df = D.priced_sales(spark, sf).where(F.col(C.REGION).between(1, 20)).select(
        "id", "l_partkey", "prix_m2", truncated("type_local", 5).alias("type_local"), F.year("date_mutation").alias(C.YEAR))
    for _ in range(2):
        sinks.reload_table(first_rows(df, ["id", "l_partkey", "prix_m2"]), path)
    return spark.read.parquet(path)


@query("q04_lake_health", """
    SELECT 'bronze' AS couche, 'events' AS jeu, 'OK' AS statut, count(*) AS lignes FROM events
    UNION ALL SELECT 'bronze', 'orders', 'OK', count(*) FROM orders
    UNION ALL SELECT 'silver', 'vide', 'VIDE', 0 UNION ALL SELECT 'silver', 'abime', 'CORROMPU', NULL
    UNION ALL SELECT 'gold', 'absent', 'ABSENT', NULL""")
def lake_health(spark, sf):
    empty, broken = f"{scratch_path(spark, 'vide')}.parquet", f"{scratch_path(spark, 'abime')}.parquet"
    D.table(spark, sf, "orders").limit(0).write.parquet(empty)
    D.table(spark, sf, "nation").select("n_name").coalesce(1).write.text(broken)
    df = files.lake_health(spark, [
        ("bronze", "events", f"{sf}/events.parquet"), ("bronze", "orders", f"{sf}/orders.parquet"),
        ("silver", "vide", empty), ("silver", "abime", broken), ("gold", "absent", f"{sf}/absent.parquet")])
    return df.drop("taille_bytes")


@query("q06_run_report", with_("prices", "readings", "raw_sales") + """
    SELECT 'prix' AS etape, 'ok' AS statut, count(*) AS lignes, count(*) FILTER (WHERE nb_transactions < 10) AS v1, count(*) FILTER (WHERE prix_m2_median <= 0) AS v2,
           'error' AS bilan FROM prices
    UNION ALL SELECT 'evenements', 'ok', count(*), count(*) FILTER (WHERE NOT iqa BETWEEN 0 AND 200), count(*) FILTER (WHERE alert_level = 'rouge'), 'error' FROM readings
    UNION ALL SELECT 'ventes', 'ok', count(*), count(*) FILTER (WHERE nature_mutation = 'Vente'), 0, 'error' FROM raw_sales
    UNION ALL SELECT 'absente', 'partial', NULL, NULL, NULL, 'error' UNION ALL SELECT 'revenus', 'error', NULL, NULL, NULL, 'error'""")
def run_report(spark, sf):
    """The run's step table: rows and violations come out of the writes; one step misses its source, one fails, later ones still run."""
    path = lambda name: f"{root}/{name}"
    root = scratch_path(spark, "report")

    def store(name, df, **rules):
        return lambda: sinks.observed(df(spark, sf), lambda rows: sinks.reload_table(rows, path(name)), rules)

    results = run_steps([
        ("prix", "yearly prices", store("prix", yearly, v1=F.col("nb_transactions") >= 10, v2=F.col("prix_m2_median") > 0)),
        ("absente", "missing table", lambda: files.optional_parquet(spark, f"{sf}/absent.parquet") is not None),
        ("revenus", "housing without income", lambda: gold.housing_scores(spark.read.parquet(path("prix")), None, None, D.spine(spark)) is not None),
        ("evenements", "events", store("evenements", D.readings, v1=F.col("iqa").between(0, 200), v2=F.col("alert_level") != C.LEVEL_RED)),
        ("ventes", "sales", store("ventes", D.raw_sales, v1=F.col("nature_mutation") != "Vente", v2=F.col("id").isNotNull()))])
    sinks.append_events(step_rows(spark, "run", results), path("etapes"))
    return spark.read.parquet(path("etapes")).select(
        "etape", "statut", "lignes", F.col("violations")["v1"].alias("v1"), F.col("violations")["v2"].alias("v2"),
        F.lit(overall_status(results)).alias("bilan"))


@query("s12_upsert_partitions", with_("prices") + """
    SELECT arrondissement, annee, CASE WHEN annee = 1996 THEN -1e0 ELSE prix_m2_median END AS prix_m2_median, nb_transactions, annee = 1996 AS reecrit FROM prices
    UNION ALL SELECT arrondissement + 100, 1996, 5e0, NULL, true FROM prices WHERE annee = 1996""")
def upsert_partitions(spark, sf):
    """One year is upserted twice with fewer columns and new keys; only its partition gets new files."""
    path = scratch_path(spark, "years")
    prices = yearly(spark, sf).select(C.REGION, C.YEAR, "prix_m2_median", "nb_transactions")
    sinks.upsert_partitions(prices, path, [C.REGION, C.YEAR], C.YEAR)
    seen = lambda: spark.read.parquet(path).select(C.YEAR, F.input_file_name().alias("_file")).distinct()
    before = durable(seen())
    one = spark.read.parquet(path).where(F.col(C.YEAR) == 1996).select(C.REGION, C.YEAR)
    change = one.withColumn("prix_m2_median", F.lit(-1.0)).unionByName(
        one.withColumn(C.REGION, F.col(C.REGION) + 100).withColumn("prix_m2_median", F.lit(5.0)))
    change = durable(change)
    for _ in range(2):
        out = sinks.upsert_partitions(change, path, [C.REGION, C.YEAR], C.YEAR)
    fresh = seen().join(before, ["_file"], "left_anti").select(C.YEAR).distinct().withColumn("reecrit", F.lit(True))
    return out.join(fresh, C.YEAR, "left").withColumn("reecrit", F.coalesce("reecrit", F.lit(False)))


@query("s12_upsert_hashed", """
    SELECT s_suppkey, s_name, CASE WHEN s_acctbal < 0 THEN 0e0 ELSE s_acctbal END AS s_acctbal FROM supplier""")
def upsert_hashed(spark, sf):
    """Without a natural partition the key's hash places a row; names that the change lacks stay."""
    path = scratch_path(spark, "hashed")
    rows = D.table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    sinks.upsert_partitions(rows, path, ["s_suppkey"])
    change = rows.where(F.col("s_acctbal") < 0).select("s_suppkey", F.lit(0.0).alias("s_acctbal"))
    sinks.upsert_partitions(change, path, ["s_suppkey"])
    return sinks.upsert_partitions(change, path, ["s_suppkey"])


@query("s13_sales_load", with_("sales") + """
    SELECT arrondissement AS arrondissement_code, date_mutation, annee, valeur_fonciere, surface_reelle_bati, prix_m2, type_local,
           CAST(l_linenumber AS INT) AS nb_pieces, NULL::VARCHAR AS adresse, l_linenumber IS NOT NULL AS placed FROM sales WHERE arrondissement <= 20""")
def sales_load(spark, sf):
    """Cleaned yearly files to the relational sales table, reloaded twice."""
    folder, path = scratch_path(spark, "ventes"), scratch_path(spark, "transaction")
    sinks.write_yearly(silver.sales(D.landed_sales(spark, sf)), folder)
    for _ in range(2):
        sinks.reload_table(transactions(spark.read.parquet(folder), D.spine(spark, 20)), path)
    out = spark.read.parquet(path)
    return out.withColumn("placed", F.col("geom_point").rlike(r"^SRID=4326;POINT\([0-9.]+ [0-9.]+\)$")).drop("geom_point")


@query("s15_drop_days", """
    SELECT event_id, value FROM events WHERE CAST(ts AS DATE) >= DATE '2024-02-15' - INTERVAL 30 DAYS""")
def drop_days(spark, sf):
    """Whole day partitions past the retention go; the rows of the others are not touched."""
    path = scratch_path(spark, "jours")
    sinks.write_batch(D.table(spark, sf, "events").select("event_id", "value", F.col("ts").cast("date").alias("jour")), path, "jour")
    sinks.drop_expired(spark, path, date(2024, 2, 15))
    return spark.read.parquet(path).select("event_id", "value")


@query("a12_file_counts", with_("sales") + """
    SELECT count(DISTINCT annee) AS bronze, count(DISTINCT annee) FILTER (WHERE arrondissement <= 20) AS silver FROM sales""")
def file_counts(spark, sf):
    """Landed yearly files and yearly partitions of the cleaned table."""
    lake = Lake(spark, scratch_path(spark, "lac"))
    # One file a year, so one task a year; with a writer for each of its years it need not sort them.
    with settings(spark, spark__sql__maxConcurrentOutputFileWriters=WRITERS):
        D.landed_sales(spark, sf).repartition(C.YEAR).write.partitionBy(C.YEAR).option("header", "true").option("compression", "gzip").csv(lake.bronze("dvf"))
    raw = delimited.read_sales(spark, lake.bronze("dvf"), range(1990, 2025), "annee={year}", partitions=8)
    sinks.write_yearly(silver.sales(raw), lake.silver_path("dvf"))
    counts = {"bronze": files.counted(spark, lake.bronze("dvf/annee=*/*.csv.gz")), "silver": lake.file_counts()["dvf_silver_files"]}
    return spark.range(1).select(*[F.lit(n).cast("bigint").alias(k) for k, n in counts.items()])


FRAGMENTS["landed_json"] = ((), """
    SELECT source, doc_id // 200 AS bloc, count(*) AS n, max(lang = 'de' AND doc_id % 200 < 20) AS abime,
           '[' || string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id) || CASE WHEN max(lang = 'de' AND doc_id % 200 < 20) THEN '' ELSE ']' END || chr(10) AS body
    FROM documents GROUP BY 1, 2""")


@query("q02_inventory_errors", with_("landed_json") + """
    SELECT 'source=' || source AS source, bloc, 'json' AS format, CAST(strlen(body) AS BIGINT) AS size_bytes, sha256(body) AS checksum,
           CASE WHEN NOT abime THEN 'json' END AS payload_kind, CASE WHEN abime THEN 'unreadable JSON' END AS error,
           CASE WHEN NOT abime THEN least(n, 5) END AS echantillon, true AS recent FROM landed_json""")
def inventory_errors(spark, sf):
    """Landed files read, listed twice and upserted by path; a truncated file is listed with its error."""
    lake = land_json(spark, sf)
    lake.load_inventory("2024-01-01 00:00:00")
    found = lake.load_inventory("2024-01-02 00:00:00")
    return found.select(
        "source", F.regexp_extract("path", "bloc=([0-9]+)", 1).cast("bigint").alias("bloc"), "format", "size_bytes", "checksum", "payload_kind", "error",
        F.size("sample").cast("bigint").alias("echantillon"), (F.to_date("ingested_at") == F.lit("2024-01-02").cast("date")).alias("recent"))


def land_json(spark, sf):
    """One JSON list of document ids per source and 200 ids; lists whose first ids hold a German text are cut short."""
    docs = D.table(spark, sf, "documents").select(
        "source", F.floor(F.col("doc_id") / 200).alias("bloc"), "doc_id", ((F.col("lang") == "de") & (F.col("doc_id") % 200 < 20)).alias("cut"))
    lists = docs.groupBy("source", "bloc").agg(F.array_sort(F.collect_list("doc_id")).alias("ids"), F.max("cut").alias("cut"))
    text = F.concat(F.lit("["), F.array_join(F.col("ids").cast("array<string>"), ","), F.when(F.col("cut"), F.lit("")).otherwise(F.lit("]")))
    lake = Lake(spark, scratch_path(spark, "lac"))
    # A file costs milliseconds whatever it holds, so the tasks are a given number, not as many as the bytes ask for, and each commits its own.
    # By a hash of the keys: by the keys themselves Spark would keep the grouping's partitions, which it merges by their bytes.
    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))
    raw = lists.select("source", "bloc", text.alias("line")).repartition(spread, F.xxhash64("source", "bloc"))
    writer = raw.write.partitionBy("source", "bloc").option("mapreduce.fileoutputcommitter.algorithm.version", "2")
    writer.option("extension", "json").option("sep", "\u0001").csv(f"{lake.root}/bronze")
    return lake


@query("q03_catalog_chain", with_("landed_json") + """
    SELECT 'source=' || source AS source, 'source=' || source AS libelle, 'inconnu' AS fournisseur, count(*) AS nb_fichiers,
           CAST(sum(strlen(body)) AS BIGINT) AS taille_totale_bytes, 'json' AS formats, 31 AS fraicheur_jours, true AS complet FROM landed_json GROUP BY 1""")
def catalog_chain(spark, sf):
    """Files to inventory to stored catalog."""
    lake = land_json(spark, sf)
    lake.load_inventory("2024-01-01 00:00:00")
    df = lake.load_catalog("2024-02-01 00:00:00")
    return df.select("source", "libelle", "fournisseur", "nb_fichiers", "taille_totale_bytes", F.array_join("formats", ",").alias("formats"),
                     "fraicheur_jours", "complet")


@query("route_batch_status", with_("prices", "sales") + """
    SELECT 'error' AS status, 12 AS etapes, (SELECT count(*) FROM sales WHERE arrondissement <= 20) AS ventes,
           (SELECT count(*) FROM prices WHERE arrondissement <= 20) AS prix, 1 AS erreurs, 'gold_indicateurs' AS echec""")
def batch_status(spark, sf):
    """The last report of a nightly run over landed yearly files; the other sources are missing, and the scores need the income."""
    years = range(1995, 2002)
    lake = Lake(spark, scratch_path(spark, "lac"), years=years)
    landed, stage = D.landed_sales(spark, sf).where(F.col(C.YEAR).isin(*years)), scratch_path(spark, "annees")
    # The tables are joined once for all years.
    with settings(spark, spark__sql__maxConcurrentOutputFileWriters=WRITERS):
        landed.write.partitionBy(C.YEAR).parquet(stage)
    staged = spark.read.schema(landed.schema).parquet(stage)
    for year in years:
        staged.where(F.col(C.YEAR) == year).drop(C.YEAR).write.option("header", "true").option("compression", "gzip").csv(
            lake.bronze(f"dvf/dvf_75_{year}.csv.gz"))
    lake.run(dry_run=True)
    report = lake.last_run()
    failed = F.col("statut") == "error"
    return lake.steps_of(report["batch_id"]).agg(
        F.lit(report["status"]).alias("status"), F.count(F.lit(1)).alias("etapes"),
        F.max(F.when(F.col("etape") == "silver_dvf", F.col("lignes"))).alias("ventes"),
        F.max(F.when(F.col("etape") == "gold_agregats", F.col("lignes"))).alias("prix"),
        F.count_if(failed).alias("erreurs"), F.max(F.when(failed, F.col("etape"))).alias("echec"))
