"""Reports, constraints, catalog, upsert and retention (Q rows, S12, S15, A10, A11)."""

from pyspark.sql import functions as F

from regionlake import config as C
from regionlake.operators import catalog as K
from regionlake.operators import merge as M
from regionlake.operators import quality as Q
from regionlake.sources import files
from suite import domain as D
from regionlake.plans import gold
from suite.aggregation import yearly
from suite.registry import FRAGMENTS, half_even, query, with_

FRAGMENTS["gapped"] = (("sales",), f"""
    SELECT (arrondissement - 1) % 23 + 1 AS arrondissement, annee, {half_even('median(prix_m2)')} AS prix_m2_median, count(*) AS nb_transactions
    FROM sales GROUP BY 1, 2""")
FRAGMENTS["damaged"] = (("gapped",), """
    SELECT arrondissement, annee, CASE WHEN arrondissement = 2 THEN NULL WHEN arrondissement = 6 AND annee = 1997 THEN 90000
           WHEN arrondissement = 7 AND annee = 1997 THEN -5 ELSE prix_m2_median END AS prix_m2_median,
           CASE WHEN arrondissement = 4 THEN 3 ELSE nb_transactions END AS nb_transactions
    FROM gapped""")


def damaged(spark, sf):
    """The yearly table of all sales, without two regions, with planted nulls, low volumes and outliers."""
    r, y = F.col(C.REGION), F.col(C.YEAR)
    price = (F.when(r == 2, F.lit(None)).when((r == 6) & (y == 1997), 90000.0).when((r == 7) & (y == 1997), -5.0)
             .otherwise(F.col("prix_m2_median")))
    rows = gold.yearly_prices(D.gapped(D.sales(spark, sf)))
    return rows.select(r, y, price.alias("prix_m2_median"),
                       F.when(r == 4, F.lit(3)).otherwise(F.col("nb_transactions")).alias("nb_transactions"))


PLACE = "'Arr.' || arrondissement || ' ' || annee || ' : '"


def whole(e):
    return f"CAST(CAST({half_even(e)} AS BIGINT) AS VARCHAR)"


@query("q01_anomaly_report", with_("damaged", "spine") + f"""
    , b AS (SELECT count(prix_m2_median) AS n, avg(prix_m2_median) AS m, stddev_samp(prix_m2_median) AS s FROM damaged)
    SELECT 'arrondissement_manquant' AS type, 'warning' AS severity,
           'Année ' || annee || ' : arrondissements absents [' || string_agg(CAST(s.arrondissement AS VARCHAR), ', ' ORDER BY s.arrondissement) || ']' AS detail
    FROM (SELECT DISTINCT annee FROM damaged) y, spine s
    WHERE NOT EXISTS (SELECT 1 FROM damaged d WHERE d.annee = y.annee AND d.arrondissement = s.arrondissement) GROUP BY annee
    UNION ALL SELECT 'prix_aberrant', CASE WHEN prix_m2_median <= 0 THEN 'error' ELSE 'warning' END,
           {PLACE} || 'prix_m2_median=' || {whole('prix_m2_median')} || ' (μ=' || {whole('m')} || ', seuil 3σ=' || {whole('m + 3e0 * s')} || ')'
    FROM damaged, b WHERE n >= 5 AND (prix_m2_median > m + 3e0 * s OR prix_m2_median < greatest(m - 3e0 * s, 0))
    UNION ALL SELECT 'valeur_manquante', 'warning', (SELECT count(*) FROM damaged WHERE prix_m2_median IS NULL) || ' valeur(s) NaN dans la colonne « prix_m2_median »'
    UNION ALL SELECT 'volume_faible', 'info', {PLACE} || 'seulement ' || nb_transactions || ' transactions' FROM damaged WHERE nb_transactions < 10""")
def anomaly_report(spark, sf):
    return Q.anomalies(damaged(spark, sf), D.spine(spark))


FRAGMENTS["catalogued"] = ((), """
    SELECT source, CAST(doc_id AS VARCHAR) AS path, lang AS format, n_chars AS size_bytes,
           TIMESTAMP '2024-01-01 00:00:00' + INTERVAL 1 HOUR * CAST(doc_id % 500 AS INT) AS ingested_at FROM documents""")


def catalogued(spark, sf):
    """Documents as landed files."""
    landed = F.timestamp_seconds(F.unix_timestamp(F.lit("2024-01-01 00:00:00")) + F.col("doc_id") % 500 * 3600)
    return D.table(spark, sf, "documents").select(
        "source", F.col("doc_id").cast("string").alias("path"), F.col("lang").alias("format"),
        F.col("n_chars").alias("size_bytes"), landed.alias("ingested_at"))


SUMMARY = """
    SELECT source, count(*) AS nb_fichiers, CAST(sum(size_bytes) AS BIGINT) AS taille_totale_bytes, max(ingested_at) AS derniere_ingestion,
           string_agg(DISTINCT format, ',' ORDER BY format) AS formats, min(path) AS exemple_chemin FROM catalogued GROUP BY 1"""


@query("a10_source_summary", with_("catalogued") + SUMMARY)
def source_summary(spark, sf):
    return K.source_summary(catalogued(spark, sf)).withColumn("formats", F.array_join("formats", ","))


@query("q03_a11_catalog", with_("catalogued") + f"""
    , s AS ({SUMMARY})
    SELECT source, coalesce(CASE WHEN source = 'src1' THEN 'Première' END, source) AS libelle,
           coalesce(CASE WHEN source = 'src1' THEN 'Région' END, 'inconnu') AS fournisseur,
           coalesce(CASE WHEN source = 'src1' THEN 'Textes' END, '') AS description,
           nb_fichiers, taille_totale_bytes, derniere_ingestion, formats, exemple_chemin,
           CAST(floor((epoch_us(TIMESTAMP '2024-02-01 06:30:00') - epoch_us(derniere_ingestion)) / 86400000000.0) AS INT) AS fraicheur_jours,
           nb_fichiers > 0 AS complet FROM s""")
def catalog(spark, sf):
    entries = D.table(spark, sf, "documents").where(F.col("source") == "src1").select("source").distinct().select(
        "source", F.lit("Première").alias("libelle"), F.lit("Région").alias("fournisseur"), F.lit("Textes").alias("description"))
    df = K.catalog(catalogued(spark, sf), entries, F.lit("2024-02-01 06:30:00"))
    return df.withColumn("formats", F.array_join("formats", ","))


@query("q02_file_inventory", """
    SELECT source, 'doc-' || doc_id || '.' || f AS path, f AS format, CAST(strlen(body) AS BIGINT) AS size_bytes, sha256(body) AS checksum, kind AS payload_kind, features AS nb_features,
           colonnes, lignes AS nb_rows_sample, n AS sample_size FROM (
      SELECT doc_id, source, 'json' AS f, '[' || n_chars || ',' || doc_id || ']' AS body, 'json' AS kind, NULL AS features, NULL AS colonnes, NULL AS lignes, 2 AS n
      FROM documents WHERE lang = 'en'
      UNION ALL SELECT doc_id, source, 'geojson', '{"features":[{"id":' || doc_id || '}]}', 'geojson', 1, NULL, NULL, 1 FROM documents WHERE lang = 'fr'
      UNION ALL SELECT doc_id, source, 'csv', 'lang;taille' || chr(10) || lang || ';' || n_chars || chr(10), 'csv', NULL, 'lang,taille', 1, 1 FROM documents WHERE lang NOT IN ('en', 'fr'))""")
def file_inventory(spark, sf):
    """Describe one landed payload per document: kind, checksum, columns, sample."""
    english, french = F.col("lang") == "en", F.col("lang") == "fr"
    fmt = F.when(english, "json").when(french, "geojson").otherwise("csv")
    body = (
        F.when(english, F.concat(F.lit("["), F.col("n_chars"), F.lit(","), F.col("doc_id"), F.lit("]")))
        .when(french, F.concat(F.lit('{"features":[{"id":'), F.col("doc_id"), F.lit("}]}")))
        .otherwise(F.concat(F.lit("lang;taille\n"), F.col("lang"), F.lit(";"), F.col("n_chars"), F.lit("\n")))
    )
    docs = D.table(spark, sf, "documents").select(
        F.concat("source", F.lit("/doc-"), "doc_id", F.lit("."), fmt).alias("path"), fmt.alias("format"),
        F.encode(body, "utf-8").alias("content"), F.lit("2024-01-01").cast("timestamp").alias("ingested_at"),
    ).withColumn("size_bytes", F.length("content").cast("bigint"))
    df = files.described(docs)
    return df.select(
        "source", F.substring_index("path", "/", -1).alias("path"), "format", "size_bytes", "checksum", "payload_kind", "nb_features",
        F.array_join("columns", ",").alias("colonnes"), "nb_rows_sample", F.size("sample").alias("sample_size"))


@query("q05_constraints", with_("raw_sales") + """
    SELECT 'ck_annee' AS regle, count(*) FILTER (WHERE annee < 2000) AS violations, count(*) FILTER (WHERE annee < 2000) = 0 AS valide FROM raw_sales
    UNION ALL SELECT 'ck_prix_positif', count(*) FILTER (WHERE valeur_fonciere / surface_reelle_bati <= 0), count(*) FILTER (WHERE valeur_fonciere / surface_reelle_bati <= 0) = 0 FROM raw_sales
    UNION ALL SELECT 'nn_date', count(*) FILTER (WHERE date_mutation IS NULL), count(*) FILTER (WHERE date_mutation IS NULL) = 0 FROM raw_sales
    UNION ALL SELECT 'fk_region', count(*) FILTER (WHERE NOT connu), count(*) FILTER (WHERE NOT connu) = 0 FROM (
      SELECT arrondissement IN (SELECT s_nationkey % 23 + 1 FROM supplier) AS connu FROM raw_sales)""")
def constraints(spark, sf):
    sales = D.raw_sales(spark, sf).withColumn("prix_m2", F.col("valeur_fonciere") / F.col("surface_reelle_bati"))
    dimension = D.gapped(D.suppliers(spark, sf)).select(C.REGION)
    return Q.check_report(sales, Q.sale_checks(dimension))


@query("q05_primary_key", """
    SELECT 'pk' AS regle, count(*) AS violations, count(*) = 0 AS valide FROM (
      SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)""")
def primary_key(spark, sf):
    return Q.check_report(D.table(spark, sf, "lineitem"), [Q.Unique("pk", ("l_orderkey", "l_linenumber"))])


def broken(name: str, rule: str) -> str:
    return f"SELECT '{name}' AS regle, count(*) FILTER (WHERE {rule}) AS violations, count(*) FILTER (WHERE {rule}) = 0 AS valide FROM "


@query("q07_expectations", with_("prices", "raw_sales", "spine") + """
    , g AS (SELECT CASE WHEN arrondissement <> 5 THEN arrondissement END AS arrondissement, CASE WHEN annee <> 1996 THEN annee END AS annee,
                   prix_m2_variation_pct FROM prices),
    r AS (SELECT *, (valeur_fonciere - 2000) / surface_reelle_bati AS prix_m2, surface_reelle_bati - 2 AS surface FROM raw_sales)
    """ + " UNION ALL ".join([
    broken("cle_region", "arrondissement IS NULL") + "g", broken("cle_annee", "annee IS NULL") + "g",
    broken("variation_bornee", "NOT prix_m2_variation_pct BETWEEN -50 AND 100") + "g",
    broken("prix_positifs", "NOT prix_m2 > 0") + "r", broken("prix_plausibles", "NOT prix_m2 BETWEEN 500 AND 60000") + "r",
    broken("surface_positive", "NOT surface > 0") + "r", broken("annees_plausibles", "NOT annee BETWEEN 1996 AND 2025") + "r",
    broken("regions_valides", "(arrondissement + 1) NOT IN (SELECT arrondissement FROM spine)") + "r"]))
def expectations(spark, sf):
    """Keys that miss and rows as they land, not yet cut to the bands."""
    prices = yearly(spark, sf).select(
        F.when(F.col(C.REGION) != 5, F.col(C.REGION)).alias(C.REGION), F.when(F.col(C.YEAR) != 1996, F.col(C.YEAR)).alias(C.YEAR),
        "prix_m2_variation_pct")
    rows = D.raw_sales(spark, sf).select(
        ((F.col("valeur_fonciere") - 2000) / F.col("surface_reelle_bati")).alias("prix_m2"),
        (F.col("surface_reelle_bati") - 2).alias("surface_reelle_bati"), C.YEAR, (F.col(C.REGION) + 1).alias(C.REGION))
    return Q.check_report(prices, Q.yearly_expectations()).unionByName(
        Q.check_report(rows, Q.sale_expectations(D.spine(spark), years=(1996, 2025))))


@query("q07_coverage", with_("sales", "spine") + """
    SELECT count(DISTINCT annee) AS annees, (SELECT count(*) FROM spine WHERE arrondissement NOT IN (
           SELECT (arrondissement - 1) % 23 + 1 FROM sales)) AS regions_absentes FROM sales""")
def coverage(spark, sf):
    return Q.coverage(D.gapped(D.sales(spark, sf)), D.spine(spark))


@query("s12_upsert", """
    SELECT o_orderkey AS k, CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(year(o_orderdate) AS INT) END AS annee,
           CASE WHEN o_orderstatus = 'F' THEN -1e0 ELSE o_totalprice END AS valeur FROM orders
    UNION ALL SELECT o_orderkey + 100000000, CAST(year(o_orderdate) AS INT), 7e0 FROM orders WHERE o_orderpriority = '1-URGENT'""")
def upsert(spark, sf):
    """Filled orders are updated (null key parts included), urgent ones add keys, the run is repeated."""
    orders = D.table(spark, sf, "orders")
    year = F.when(F.col("o_orderpriority") != "5-LOW", F.year("o_orderdate")).alias("annee")
    target = orders.select(F.col("o_orderkey").alias("k"), year, F.col("o_totalprice").alias("valeur"))
    changed = orders.where(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").alias("k"), year, F.lit(-1.0).alias("valeur"))
    new = orders.where(F.col("o_orderpriority") == "1-URGENT").select(
        (F.col("o_orderkey") + 100000000).alias("k"), F.year("o_orderdate").alias("annee"), F.lit(7.0).alias("valeur"))
    source = changed.unionByName(new)
    once = M.upserted(target, source, ["k", "annee"])
    return M.upserted(once, source.unionByName(source), ["k", "annee"])


@query("s15_retention", """
    SELECT event_id, value FROM events WHERE ts >= TIMESTAMP '2024-02-15 00:00:00' - INTERVAL 30 DAYS""")
def retention(spark, sf):
    events = D.table(spark, sf, "events").withColumn("ingested_at", F.col("ts").cast("timestamp"))
    return M.retained(events, "2024-02-15 00:00:00").select("event_id", "value")
