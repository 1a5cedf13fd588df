"""The whole bronze -> gold run on small landed files, then the public queries over it."""

import gzip
import json
import random

import pytest
from pyspark.sql import functions as F

from regionlake.operators import quality as Q
from regionlake.operators.sizing import Spine
from regionlake.operators.spatial import within_radius
from regionlake.plans import gold, serving as V
from regionlake.plans.batch import Lake, overall_status, run_steps

YEARS = (2021, 2022, 2023)


def square(i):
    x, y = 2.26 + (i - 1) % 5 * 0.03, 48.81 + (i - 1) // 5 * 0.02
    return [[x, y], [x + 0.03, y], [x + 0.03, y + 0.02], [x, y + 0.02], [x, y]]


def centre(i):
    return 48.82 + (i - 1) // 5 * 0.02, 2.275 + (i - 1) % 5 * 0.03


def build(root):
    bronze = root / "bronze"
    (bronze / "dvf").mkdir(parents=True)
    rng = random.Random(1)
    for year in YEARS:
        with gzip.open(bronze / "dvf" / f"dvf_75_{year}.csv.gz", "wt") as f:
            f.write("date_mutation,nature_mutation,valeur_fonciere,code_postal,type_local,surface_reelle_bati,nombre_pieces_principales,longitude,latitude\n")
            for region in range(1, 21):
                if (region, year) == (20, 2022):
                    continue
                for _ in range(12 if region != 3 else 4):
                    surface = rng.randint(20, 90)
                    lat, lon = centre(region)
                    f.write(f"{year}-06-15,Vente,{surface * (9000 + 100 * region + 50 * (year - 2021))},{75000 + region},"
                            f"{rng.choice(['Appartement', 'Maison'])},{surface},3,{lon},{lat}\n")

    def put(name, doc):
        (bronze / name).write_text(doc if isinstance(doc, str) else json.dumps(doc, ensure_ascii=False))

    regions = range(1, 21)
    put("geo_arrondissements.geojson", {"type": "FeatureCollection", "features": [
        {"properties": {"c_ar": i, "l_ar": f"R{i}", "surface": i * 1e6}, "geometry": {"type": "Polygon", "coordinates": [square(i)]}} for i in regions]})
    put("transports_idf_arrets.json", {"results": [
        {"nom": f"S{i}", "geo_point_2d": dict(zip(("lat", "lon"), centre(i)))} for i in regions for _ in range(i)]})
    put("education_paris.json", [{"code_postal": f"750{i:02d}"} for i in regions for _ in range(21 - i)])
    put("parcs_paris_osm.json", {"elements": [
        {"type": "way", "id": i, "center": dict(zip(("lat", "lon"), centre(i))), "tags": {}} for i in regions if i % 2]})
    put("commissariats_paris.json", {"elements": [{"type": "node", "id": i, "lat": centre(i)[0], "lon": centre(i)[1]} for i in (1, 2, 2)]})
    put("criminalite_paris.csv", "arrondissement;code_commune;nb_faits;annee\n" + "".join(f"{i};751{i:02d};{i * 100};2023\n" for i in regions if i != 7))
    put("logements_sociaux_paris.csv", "arrondissement;code_postal;part_ls_pct;nb_logements_sociaux;annee\n" + "".join(f"{i};{75000 + i};{i}.5;{i * 10};2022\n" for i in regions))
    put("revenus_insee_paris.csv", "CODGEO;arrondissement;Q2;TP6020;annee\n" + "".join(f"{75100 + i};{i};{20000 + 500 * i};0.1;2021\n" for i in regions))
    put("loyers_reference_paris.csv", "arrondissement;loyer_ref_m2;loyer_ref_majore_m2;loyer_ref_minore_m2;annee\n" + "".join(f"{i};{20 + i};40;15;2023\n" for i in regions))
    put("qualite_air_paris.json", {"source": "x", "arrondissements": {str(i): {"iqa_moyen": 40 + i, "no2_µg_m3": 30, "pm25_µg_m3": 10} for i in regions}})
    put("commerces_paris.json", {"arrondissements": {str(i): {"supermarches": i, "pharmacies": 1, "boulangeries": 2, "centres_commerciaux": 0} for i in range(1, 22)}})
    put("bruit_paris.json", {"arrondissements": {str(i): {"lden_moyen": 50 + i, "lnight": 45} for i in regions}})
    return root


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    lake = Lake(spark, str(build(tmp_path_factory.mktemp("lake"))), years=YEARS)
    assert lake.last_run() == {"status": "never_run"}
    lake.report = lake.run()
    return lake


def test_report(lake):
    r = lake.report
    states = {k: v["status"] for k, v in r["steps"].items()}
    assert states.pop("silver_circulation") == "partial"  # never landed
    assert set(states.values()) == {"ok"}, r["steps"]
    assert r["status"] == "partial" and r["load"]["status"] == "ok" and r["errors_count"] == 0
    assert r["load"]["rows_updated"]["prix_median"] == 59 and r["load"]["rows_updated"]["arrondissement"] == 20
    assert r["stats"]["gold_rows"] == 59 and r["stats"]["arrondissements_covered"] == 20 and r["stats"]["years_covered"] == [2021, 2022, 2023]
    assert sorted({a["type"] for a in r["anomalies"]}) == ["arrondissement_manquant", "volume_faible"]
    assert lake.last_run()["batch_id"] == r["batch_id"]
    assert r["stats"]["dvf_bronze_files"] == r["stats"]["dvf_silver_files"] == 3
    steps = {s["etape"]: s for s in lake.steps_of(r["batch_id"]).collect()}
    assert steps["silver_dvf"]["lignes"] == lake.silver("dvf").count() and steps["silver_dvf"]["violations"] == {"prix_positifs": 0, "dates": 0}
    assert steps["gold_final"]["lignes"] == 59 and steps["silver_circulation"]["lignes"] is None and len(steps) == 12
    assert r["load"]["rows_updated"]["transaction"] == lake.silver("dvf").count()
    kept = lake.spark.read.parquet(f"{lake.root}/gold/anomalies")
    assert kept.count() == r["anomalies_count"] == len(r["anomalies"])


def test_care_of_the_lake(spark, lake):
    from datetime import date

    files = lake.load_inventory("2024-01-01 00:00:00")
    assert files.count() == 12 and files.where("error IS NOT NULL").count() == 0
    again = lake.load_inventory("2024-01-03 00:00:00")
    assert again.count() == 12 and again.select("ingested_at").distinct().count() == 1
    entries = {r["source"]: r for r in lake.load_catalog("2024-01-10 00:00:00").collect()}
    assert entries["bruit_paris.json"]["libelle"] == "Bruit" and entries["bruit_paris.json"]["fraicheur_jours"] == 7
    states = {(r["couche"], r["jeu"]): r["statut"] for r in lake.health().collect()}
    assert states["gold", "gold_final"] == "OK" and states["silver", "circulation"] == "ABSENT" and states["bronze", "sante_paris.json"] == "ABSENT"
    events = spark.createDataFrame([(1, date(2024, 1, 1)), (2, date(2024, 1, 31)), (3, date(2024, 2, 1))], "k int, jour date")
    events.write.partitionBy("jour").parquet(f"{lake.root}/gold/evenements")
    assert lake.retire_events(date(2024, 3, 1)) == ["jour=2024-01-01"]
    assert spark.read.parquet(f"{lake.root}/gold/evenements").count() == 2


def test_second_run_adds_no_rows(lake):
    again = lake.run()
    assert again["load"]["rows_updated"] == lake.report["load"]["rows_updated"]


def test_prices(lake):
    rows = {(r["arrondissement"], r["annee"]): r for r in lake.gold("agregats_arrondissements").collect()}
    assert rows[5, 2021]["prix_m2_median"] == 9500.0 and rows[5, 2021]["prix_m2_variation_pct"] is None
    assert rows[5, 2022]["prix_m2_variation_pct"] == 0.5
    assert rows[20, 2023]["prix_m2_variation_pct"] == round((11100 / 11000 - 1) * 100, 1)  # against 2021
    assert rows[5, 2021]["nb_transactions"] == rows[5, 2021]["Appartement"] + rows[5, 2021]["Maison"] == 12


def test_scores_are_complete_and_in_range(lake):
    table = lake.gold("indicateurs_custom")
    assert table.count() == 20
    assert all(r["violations"] == 0 for r in Q.check_report(table, Q.score_expectations(table.columns)).collect())
    rows = {r["arrondissement"]: r for r in table.collect()}
    assert rows[4]["nb_arrets"] == 4 and rows[4]["nb_ecoles"] == 17 and rows[4]["nb_commerces"] == 7
    assert rows[7]["nb_faits"] == 1100.0  # median of the others
    assert rows[2]["nb_commissariats"] == 2 and rows[9]["nb_commissariats"] == 1
    # No fire station landed: the default table.
    assert rows[15]["nb_casernes"] == 3
    # I1 of region 20: transport 10, schools 0, shops 10, health all equal (5), centrality 6.
    assert rows[20]["score_accessibilite"] == pytest.approx(10 * 0.4 + 0 + 10 * 0.2 + 5 * 0.15 + 0.6)


def test_final_table(lake):
    table = lake.gold("gold_final")
    row = table.where("arrondissement = 2 and annee = 2021").first()
    assert row["part_logements_sociaux_pct"] == 2.5 and row["nb_logements_sociaux"] == 20
    assert row["revenu_median"] == 21000.0 and row["m2_par_revenu_annuel"] == round(21000 / 9200, 2)
    assert row["loyer_ref_median_m2"] == 22.0 and row["score_air"] == 58.0
    assert all(r["valide"] for r in Q.check_report(table, Q.yearly_expectations()).collect())
    assert Q.coverage(table, lake.spine).first().asDict() == {"annees": 3, "regions_absentes": 0}
    sales = lake.silver("dvf")
    assert all(r["valide"] for r in Q.check_report(sales, Q.sale_expectations(lake.spine)).collect())


def test_public_queries(lake):
    table, scores = lake.gold("gold_final"), lake.gold("indicateurs_custom")
    assert V.region_detail(table, 3).count() == 3 and V.region_detail(table, 3, 2022).count() == 1
    for bad in (0, 21):
        with pytest.raises(ValueError):
            V.region_detail(table, bad)
        with pytest.raises(ValueError):
            V.compare(table, scores, bad, 1)
    assert V.prices(table).count() == 59 and V.prices(table, 3, 2022, 2023).count() == 2
    assert [r["annee"] for r in V.price_history(table).collect()][:20] == [2021] * 20
    both = V.compare(table, scores, 1, 2, 2023)
    assert both.prices.count() == 2 and both.indicators.count() == 2
    winners = {r["mesure"]: r["meilleur"] for r in both.measures.collect()}
    assert winners["prix_m2_median"] == 1 and winners["part_logements_sociaux_pct"] == 2 and winners["nb_faits"] is None
    same = V.compare(table, scores, 4, 4, 2023)
    assert same.prices.count() == 1 and {r["meilleur"] for r in same.measures.collect()} == {None}
    assert V.social_housing(table).count() == 59
    bare = table.drop("nb_logements_sociaux", "part_logements_sociaux_pct")
    assert V.social_housing(bare).count() == 0
    assert V.stream_latest(None) is None
    features = V.feature_table(lake.spine.df, table, scores, 2022, "prix_m2_median")
    assert features.count() == 20 and features.where("arrondissement = 20").first()["valeur"] is None
    near = within_radius(
        lake.silver("dvf").withColumn("id", F.monotonically_increasing_id()), *centre(8), 500)
    assert near.count() == 36 and near.first()["arrondissement"] == 8


def test_upserted_indicators_keep_one_row_per_null_year(spark, lake):
    table = spark.read.parquet(f"{lake.root}/gold/relational/indicateur")
    assert table.groupBy("arrondissement", "nom", "annee").count().where("count > 1").count() == 0


def test_dry_run_and_missing_sources(spark, tmp_path):
    lake = Lake(spark, str(tmp_path), years=YEARS)
    report = lake.run(dry_run=True)
    assert report["load"]["status"] == "skipped_dry_run" and report["status"] == "error"
    assert report["steps"]["gold_indicateurs"]["status"] == "error"  # income is required
    assert report["steps"]["silver_dvf"]["status"] == "partial"


def test_steps_go_on_after_a_failure():
    ran = []
    results = run_steps([("a", "A", lambda: 1 / 0), ("b", "B", lambda: ran.append(1) or True), ("c", "C", lambda: False)])
    assert [r["status"] for r in results.values()] == ["error", "ok", "partial"] and ran == [1]
    assert overall_status(results) == "error"
    assert overall_status({"b": {"status": "ok"}}) == "success"


def test_housing_without_rents_or_prices(spark):
    spine = Spine.numbered(spark, 3)
    income = spark.createDataFrame([(1, 30000.0), (2, 20000.0), (3, None)], "arrondissement int, revenu_median double")
    out = {r["arrondissement"]: r for r in gold.housing_scores(None, income, None, spine).collect()}
    assert out[3]["revenu_median"] == 25000.0 and out[1]["m2_par_revenu"] == round(30000 / 14000, 2)
    assert out[1]["score_accessibilite_immo"] == 8.0 and out[2]["score_accessibilite_immo"] == 2.0
    with pytest.raises(ValueError):
        gold.housing_scores(None, None, None, spine)
    empty = income.withColumn("revenu_median", F.lit(None).cast("double"))
    with pytest.raises(Exception, match="no median income"):
        gold.housing_scores(None, empty, None, spine).collect()


def test_life_scores_defaults(spark):
    spine = Spine.numbered(spark, 2)
    air = spark.createDataFrame([(1, 80.0), (1, 90.0)], "arrondissement int, score_air double")
    out = {r["arrondissement"]: r["score_qualite_vie"] for r in gold.life_scores(None, air, None, None, spine).collect()}
    # Parks constant (5); air 8 or missing (0); noise and traffic neutral.
    assert out == {1: 1.5 + 2.0 + 1.25 + 1.0, 2: 1.5 + 0.0 + 1.25 + 1.0}
