"""Readers on small landed files, one per envelope variant, and the writers."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from regionlake import schemas as T
from regionlake.operators.sizing import Spine
from regionlake.plans import silver
from regionlake.sources import delimited, documents, files, sinks


def put(path, text, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes((text if isinstance(text, str) else json.dumps(text, ensure_ascii=False)).encode(encoding))
    return str(path)


def by_region(df, column):
    return {r["arrondissement"]: r[column] for r in df.collect()}


HEADER = "id,date_mutation,nature_mutation,valeur_fonciere,code_postal,type_local,surface_reelle_bati,nombre_pieces_principales,longitude,latitude,extra\n"


def test_yearly_sales_files(spark, tmp_path):
    def gz(year, header, line):
        with gzip.open(tmp_path / f"dvf_75_{year}.csv.gz", "wt") as f:
            f.write(header + line)

    gz(2021, HEADER, "a,2021-05-01,Vente,\"300000,50\",75003,Maison,50,2,2.36,48.86,x\n")
    moved = ("latitude,longitude,nombre_pieces_principales,surface_reelle_bati,type_local,code_postal,valeur_fonciere,nature_mutation,date_mutation\n")
    gz(2023, moved, "48.86,2.36,2,50,Maison,75004,400000,Vente,2023-05-01\n")
    raw = delimited.read_sales(spark, str(tmp_path))
    got = sorted((r["annee"], r["arrondissement"], r["valeur_fonciere"]) for r in silver.sales(raw).collect())
    assert got == [(2021, 3, 300000.5), (2023, 4, 400000.0)]
    assert delimited.read_sales(spark, str(tmp_path / "nowhere")) is None


def test_dialects(spark, tmp_path):
    a = put(tmp_path / "a.csv", "Arrondissement;Nom Rue;X/Y;Été\n1;é;2;3\n", "latin-1")
    assert delimited.dialect(spark, a) == (";", "iso-8859-1")
    df = delimited.read_delimited(spark, a, underscores=True)
    assert df.columns == ["arrondissement", "nom_rue", "x_y", "été"] and df.first()["nom_rue"] == "é"
    b = put(tmp_path / "b.csv", "a,b,c,d\n1,2,3,4\n")
    assert delimited.dialect(spark, b) == (",", "utf-8")
    c = put(tmp_path / "c.csv", "a\n1\n")
    assert delimited.dialect(spark, c) == (",", "utf-8")
    with pytest.raises(ValueError):
        delimited.dialect(spark, c, 3, strict=True)


def test_reference_files(spark, tmp_path):
    social = delimited.read_delimited(spark, put(tmp_path / "s.csv", "arrondissement;code_postal;part_ls_pct;nb_logements_sociaux;annee\n1;75001;6.7;1250;2022\n21;75021;1;1;2022\nx;;;;\n"), 3)
    got = silver.social_housing(social).collect()
    assert [(r["arrondissement"], r["part_logements_sociaux_pct"], r["nb_logements_sociaux"], r["annee"]) for r in got] == [(1, 6.7, 1250.0, 2022)]
    income = delimited.read_delimited(spark, put(tmp_path / "i.csv", "CODGEO;arrondissement;Q2;TP6020;annee\n75101;1;35030;0,120;2021\n13001;1;9;9;2021\n"))
    assert [tuple(r) for r in silver.income(income).collect()] == [(1, 35030.0, 0.12)]
    rent = delimited.read_delimited(spark, put(tmp_path / "r.csv", "Arrondissement;loyer ref m2;loyer ref majore m2;annee\nParis 2e;25,3 €;30;2023\nx;1;1;1\n"), underscores=True)
    assert [(r["arrondissement"], r["loyer_ref_m2"], r["loyer_max_m2"]) for r in silver.rents(rent).collect()] == [(2, 25.3, 30.0)]
    crime = delimited.read_delimited(spark, put(tmp_path / "c.csv", "arrondissement;code_commune;nb_faits;annee\n1;75101;3200;2023\n;75102;x;2023\n"), 3)
    assert [(r["arrondissement"], r["nb_faits"]) for r in silver.crime(crime).collect()] == [(1, 3200.0), (None, None)]
    plain = spark.createDataFrame([("75", "4"), ("13", "5")], "dep string, total string")
    assert [(r["arrondissement"], r["nb_faits"]) for r in silver.crime(plain).collect()] == [(None, 4.0)]
    with pytest.raises(ValueError):
        silver.social_housing(plain)
    with pytest.raises(ValueError):
        silver.income(plain)


STOPS = [
    {"nom_long": "A", "geo_point_2d": {"lat": 48.86, "lon": 2.35}, "mode": "METRO"},
    {"stop_name": "B", "stop_lat": "48.85", "stop_lon": "2.34"},
    {"nom": "far", "stop_lat": 45.0, "stop_lon": 2.3},
    {"nom": "none"},
]


@pytest.mark.parametrize("wrap", [lambda r: r, lambda r: {"results": r}, lambda r: {"records": r}])
def test_stop_envelopes(spark, tmp_path, wrap):
    raw = documents.read_json(spark, put(tmp_path / "stops.json", wrap(STOPS)), T.envelope(T.STOP))
    got = sorted((r["nom"], r["lat"], r["lon"], r["type"]) for r in silver.stops(raw).collect())
    assert got == [("A", 48.86, 2.35, "METRO"), ("B", 48.85, 2.34, "")]


def test_school_codes(spark, tmp_path):
    rows = [
        {"code_postal_uai": "75011", "nom_etablissement": "X", "position": {"lat": 48.8, "lon": 2.3}, "statut_public_prive": "Public"},
        {"code_postal": "75116"}, {"code_postal": "75000"}, {"code_postal": "7501"}, {"code_postal": "75021"}, {},
        {"code_postal": "75002", "latitude": "48.87", "longitude": "2.34"},
    ]
    raw = documents.read_json(spark, put(tmp_path / "s.json", {"results": rows}), T.envelope(T.SCHOOL))
    got = sorted((r["arrondissement"], r["nom"], r["lat"], r["lon"], r["statut"]) for r in silver.schools(raw).collect())
    assert got == [(2, "", 48.87, 2.34, ""), (11, "X", 48.8, 2.3, "Public")]


def test_air_static_and_live(spark, tmp_path):
    static = put(tmp_path / "a.json", {"source": "x", "arrondissements": {"1": {"iqa_moyen": 68, "no2_µg_m3": 28, "pm25_µg_m3": 11}, "2": {"iqa_moyen": 130}}})
    got = by_region(silver.air_quality(documents.read_json(spark, static, T.AIR)), "score_air")
    assert got == {1: 32.0, 2: 0.0}
    live = put(tmp_path / "b.json", [{"commune_code": "75103", "indice": 40.25, "pm2_5": 9}, {"insee": "75104", "iqa": "55"}, {"insee": "92000", "iqa": 1}, {"insee": "75130"}])
    rows = {r["arrondissement"]: tuple(r) for r in silver.air_quality(documents.read_json(spark, live, T.AIR)).collect()}
    assert rows == {3: (3, 40.25, None, 9.0, 59.8), 4: (4, 55.0, None, None, 45.0)}


def test_noise_static_live_and_unknown(spark, tmp_path):
    spine = Spine.numbered(spark, 4)
    static = put(tmp_path / "a.json", {"arrondissements": {"1": {"lden_moyen": 60, "lnight": 50, "score_bruit": 3}, "2": {"lden_moyen": 70}, "3": {"score_bruit": 9}}})
    assert by_region(silver.noise(documents.read_json(spark, static, T.NOISE), spine), "score_bruit") == {1: 10.0, 2: 0.0, 3: 5.0, 4: 5.0}
    live = put(tmp_path / "b.json", {"records": [{"fields": {"commune_code": "75101", "lden": 60}}, {"fields": {"commune_code": "75101", "laeq": 64}},
                                                 {"fields": {"commune_code": "75102", "lden": 66}}, {"fields": {"commune_code": "92002", "lden": 1}}, {"fields": {}}]})
    rows = by_region(silver.noise(documents.read_json(spark, live, T.NOISE), spine), "lden_moyen")
    assert rows == {1: 62.0, 2: 66.0, 3: None, 4: None}
    raw_only = put(tmp_path / "c.json", {"arrondissements": {"1": {"score_bruit": 3.5}, "2": {}}})
    assert by_region(silver.noise(documents.read_json(spark, raw_only, T.NOISE), spine), "score_bruit") == {1: 3.5, 2: 5.0, 3: 5.0, 4: 5.0}


def test_traffic_static_live_and_default(spark, tmp_path):
    spine = Spine.numbered(spark, 3)
    read = lambda name, doc: silver.traffic(documents.read_json(spark, put(tmp_path / name, doc), T.TRAFFIC), spine)
    assert by_region(read("a.json", {"arrondissements": {"1": {"score_circulation": 2.8, "tmja_moyen": 9}}}), "score_circulation") == {1: 2.8, 2: 5.0, 3: 5.0}
    live = read("b.json", {"source": "x", "records": [{"arr": "01", "q": 100}, {"codearr": "1", "debit": "300"}, {"arrondissement": 2, "tmja": 600}, {"arr": "x", "q": 4}, {"q": 5}]})
    assert by_region(live, "score_circulation") == {1: 10.0, 2: 0.0, 3: 5.0}
    assert by_region(live, "tmja_moyen") == {1: 200.0, 2: 600.0, 3: None}
    assert by_region(read("c.json", {"source": "x", "records": [{"q": 5}]}), "score_circulation") == {1: 2.8, 2: 2.2, 3: 3.5}


ELEMENT = {"type": "node", "id": 1, "lat": 48.86, "lon": 2.345, "tags": {"shop": "bakery", "name": "B"}}


def test_elements_prefer_the_centre(spark, tmp_path):
    doc = {"version": 0.6, "elements": [
        {"type": "way", "id": 5, "center": {"lat": 48.85, "lon": 2.3}, "lat": 1.0, "lon": 1.0, "tags": {"name": "P", "leisure": "garden"}},
        {"type": "node", "id": 6, "lat": 48.86, "lon": 2.35}, {"type": "node", "id": 7}, {"type": "node", "id": 8, "lat": 33.6, "lon": -95.5}]}
    raw = documents.read_json(spark, put(tmp_path / "p.json", doc), T.ELEMENTS)
    assert sorted(tuple(r)[:5] for r in silver.parks(raw).collect()) == [(5, "P", "garden", 48.85, 2.3), (6, "Parc sans nom", "park", 48.86, 2.35)]
    assert sorted((r["type"], r["nom"]) for r in silver.security(raw, None).collect()) == [("commissariats", ""), ("commissariats", "P")]
    assert silver.security(None, None) is None


def test_shops_live_and_shifted_static(spark, tmp_path):
    spine = Spine.numbered(spark, 20)
    live = documents.read_json(spark, put(tmp_path / "l.json", {"elements": [ELEMENT, {**ELEMENT, "tags": {"shop": "zoo"}}, {**ELEMENT, "lat": 0.0}]}), T.SHOPS)
    static = {"arrondissements": {str(i): {"hopitaux": i, "medecins": 1, "dentistes": 0} for i in range(1, 22)}}
    health = documents.read_json(spark, put(tmp_path / "h.json", static), T.HEALTH)
    out = {r["arrondissement"]: r for r in silver.shops_and_health(live, health, spine).collect()}
    assert len(out) == 20 and out[8]["nb_boulangeries"] == 0 and sum(r["nb_boulangeries"] for r in out.values()) == 1
    assert out[20]["nb_hopitaux"] == 20 and out[1]["nb_supermarches"] == 0
    assert silver.shops_and_health(None, health, spine).columns == ["arrondissement", "nb_hopitaux", "nb_medecins", "nb_dentistes"]


def test_geojson(spark, tmp_path):
    ring = [[2.3, 48.8], [2.4, 48.8], [2.4, 48.9], [2.3, 48.8]]
    doc = {"type": "FeatureCollection", "features": [
        {"properties": {"c_ar": 1, "l_ar": "1er Ardt", "surface": 1824612.8}, "geometry": {"type": "Polygon", "coordinates": [ring]}},
        {"properties": {"c_arinsee": 75102}, "geometry": {"type": "MultiPolygon", "coordinates": [[ring], [ring]]}},
        {"properties": {"c_ar": 33}, "geometry": {"type": "Polygon", "coordinates": [ring]}}, {"properties": {}, "geometry": None}]}
    shapes = documents.read_polygons(spark, put(tmp_path / "g.geojson", doc))
    got = {r["arrondissement"]: (r["nom"], r["surface_km2"], len(r["parts"])) for r in shapes.collect()}
    assert got == {1: ("1er Ardt", pytest.approx(1.8246128), 1), 2: ("2e arrondissement", None, 2)}
    dim = documents.region_dimension(None, Spine.numbered(spark, 2)).collect()
    assert [tuple(r) for r in dim] == [(1, "1e arrondissement", None), (2, "2e arrondissement", None)]


def test_inventory(spark, tmp_path):
    put(tmp_path / "dvf" / "x.csv", "a;b\n" + "1;2\n" * 600)
    put(tmp_path / "geo.geojson", {"features": [{"id": i} for i in range(5)]})
    put(tmp_path / "list.json", list(range(9)))
    put(tmp_path / "object.json", {"a": 1})
    put(tmp_path / ".hidden.json", {})
    put(tmp_path / "skip.txt", "x")
    put(tmp_path / "skip.csv.gz", "x")
    put(tmp_path / "LOUD.CSV", "a,b\n1,2\n")
    got = {r["path"]: r for r in files.inventory(spark, str(tmp_path), "2024-01-01").collect()}
    assert set(got) == {"LOUD.CSV", "dvf/x.csv", "geo.geojson", "list.json", "object.json"}
    csv = got["dvf/x.csv"]
    assert (csv["source"], csv["columns"], csv["nb_rows_sample"], len(csv["sample"])) == ("dvf", ["a", "b"], 600, 5)
    assert (got["geo.geojson"]["payload_kind"], got["geo.geojson"]["nb_features"], len(got["geo.geojson"]["sample"])) == ("geojson", 5, 3)
    assert len(got["list.json"]["sample"]) == 5 and got["object.json"]["payload"] == '{"a": 1}'
    assert len(csv["checksum"]) == 64 and csv["size_bytes"] == (tmp_path / "dvf" / "x.csv").stat().st_size


def test_snapshots_and_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, 1.0), (2, 2.0)], "k int, v double")
    assert sinks.read_snapshot(spark, path) is None
    sinks.upsert_table(df, path, ["k"])
    out = sinks.upsert_table(df.where("k = 2").withColumn("v", F.lit(9.0)), path, ["k"])
    assert {tuple(r) for r in out.collect()} == {(1, 1.0), (2, 9.0)} and len(sinks.snapshots(spark, path)) == 2
    (tmp_path / "t" / "v=000000099").mkdir()  # an unfinished write is not seen
    assert sinks.read_snapshot(spark, path).count() == 2
    years = spark.createDataFrame([(1, 2021), (2, 2022)], "k int, annee int")
    sinks.write_yearly(years, str(tmp_path / "y"))
    sinks.write_yearly(years.where("annee = 2022").withColumn("k", F.lit(7)), str(tmp_path / "y"))
    assert {tuple(r) for r in spark.read.parquet(str(tmp_path / "y")).select("k", "annee").collect()} == {(1, 2021), (7, 2022)}


def test_unreadable_files_are_listed_with_their_error(spark, tmp_path):
    put(tmp_path / "cut.json", '{"features": [{"id": 1}')
    put(tmp_path / "bad.geojson", "{")
    put(tmp_path / "void.csv", "\n\n")
    put(tmp_path / "fine.json", '{"features": 3}')
    got = {r["path"]: r for r in files.inventory(spark, str(tmp_path), "2024-01-01").collect()}
    assert {p: r["error"] for p, r in got.items()} == {
        "cut.json": "unreadable JSON", "bad.geojson": "unreadable JSON", "void.csv": "no columns", "fine.json": None}
    assert got["cut.json"]["payload"] is None and got["cut.json"]["payload_kind"] is None and got["cut.json"]["size_bytes"] == 23
    assert got["fine.json"]["payload_kind"] == "json"


def test_names_of_a_header():
    assert delimited.names_of('a;"b;c";"d ""e"""', ";") == ["a", "b;c", 'd "e"'] and delimited.names_of("", ";") == []


def part_files(path):
    import os

    return {(d, f) for d in os.listdir(path) if "=" in d for f in os.listdir(os.path.join(path, d)) if f.endswith(".parquet")}


def test_upsert_rewrites_only_what_it_touches(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "k int, annee int, v double, w string"
    first = spark.createDataFrame([(1, 2021, 1.0, "a"), (2, 2021, 2.0, "b"), (1, 2022, 3.0, "c"), (3, None, 4.0, "d")], schema)
    sinks.upsert_partitions(first, path, ["k", "annee"], "annee")
    before = part_files(path)
    change = spark.createDataFrame([(1, 2022, 9.0), (7, 2022, 8.0), (3, None, 5.0)], "k int, annee int, v double")
    for _ in range(2):
        out = sinks.upsert_partitions(change, path, ["k", "annee"], "annee")
    assert {tuple(r) for r in out.select("k", "annee", "v", "w").collect()} == {
        (1, 2021, 1.0, "a"), (2, 2021, 2.0, "b"), (1, 2022, 9.0, "c"), (7, 2022, 8.0, None), (3, None, 5.0, "d")}
    after = part_files(path)
    assert {f for f in before if f[0] == "annee=2021"} <= after and not {f for f in before if f[0] != "annee=2021"} & after
    with pytest.raises(ValueError):
        sinks.upsert_partitions(change, path, ["k"], "annee")


def test_upsert_by_hash_keeps_types_and_the_newest_version(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("01", 1, 5.0), ("01", 2, 6.0), ("x", 1, 7.0)], "k string, at int, v double")
    out = sinks.upsert_partitions(rows, path, ["k"], version=["at"])
    assert {tuple(r) for r in out.collect()} == {("01", 2, 6.0), ("x", 1, 7.0)}
    named = str(tmp_path / "n")
    sinks.upsert_partitions(rows, named, ["k", "at"], "k")
    out = sinks.upsert_partitions(rows.where("at = 2").withColumn("v", F.lit(0.0)), named, ["k", "at"], "k")
    assert {tuple(r) for r in out.select("k", "at", "v").collect()} == {("01", 1, 5.0), ("01", 2, 0.0), ("x", 1, 7.0)}


def test_counts_observed_while_writing(spark, tmp_path):
    df = spark.createDataFrame([(1,), (-2,), (None,), (4,)], "v int").repartition(3)
    found = sinks.observed(df, lambda rows: sinks.reload_table(rows, str(tmp_path / "t")), {"positive": F.col("v") > 0, "known": F.col("v").isNotNull()})
    assert found == {"rows": 4, "violations": {"positive": 1, "known": 1}}
    assert sinks.observed(df.limit(0), lambda rows: sinks.reload_table(rows, str(tmp_path / "u"))) == {"rows": 0, "violations": {}}
    assert spark.read.parquet(str(tmp_path / "t")).count() == 4


def test_health_counts_all_tables_at_once(spark, tmp_path):
    good, later = str(tmp_path / "good.parquet"), tmp_path / "later.parquet"
    spark.range(5).repartition(2).write.parquet(good)
    spark.range(5).repartition(2).write.parquet(str(later))
    broken = sorted(later.glob("part-*.parquet"))[-1]
    broken.write_bytes(b"not a table")
    crc = broken.with_name(f".{broken.name}.crc")
    crc.write_bytes(b"")
    crc.unlink()
    sets = [("a", "good", good), ("b", "later", str(later)), ("c", "none", str(tmp_path / "none.parquet"))]
    got = {r["jeu"]: (r["statut"], r["lignes"]) for r in files.lake_health(spark, sets).collect()}
    assert got == {"good": ("OK", 5), "later": ("CORROMPU", None), "none": ("ABSENT", None)}
