import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from regionlake import config as C
from regionlake.functions import cleaning as X
from regionlake.functions.geo import ellipsoid_distance_m, grid_region
from regionlake.plans import silver
from regionlake.plans.serving import without_nan
from regionlake.sources.delimited import normalized, renamed, resolve_aliases


def one(spark, expr):
    return spark.range(1).select(expr.alias("v")).first()["v"]


def landed(spark, lines):
    cols = ("date_mutation nature_mutation valeur_fonciere code_postal type_local surface_reelle_bati "
            "nombre_pieces_principales longitude latitude").split()
    return spark.createDataFrame([(*x, 2022) for x in lines], ", ".join(f"{c} string" for c in cols) + ", annee int")


def sale(value="350000,50", surface="50", code="75011", nature="Vente", kind="Appartement", date="2022-03-01"):
    return (date, nature, value, code, kind, surface, "2", "2.35", "48.85")


def test_sales_bands_and_codes(spark):
    kept = silver.sales(landed(spark, [
        sale(),
        sale(surface="5"),  # strict surface
        sale(value="50000", surface="50"),  # exactly 1000 per m²
        sale(value="500000", surface="10"),  # exactly 50000 per m²
        sale(value="500001", surface="10"),
        sale(code="75116"),
        sale(code="75000"),
        sale(code="75099"),
        sale(code=None),
        sale(nature="Echange"),
        sale(kind="Local"),
        sale(value="abc"),
        sale(value=None),
        sale(date="2022-13-45"),
    ]))
    got = sorted((r["arrondissement"], r["prix_m2"], r["date_mutation"] is None) for r in kept.collect())
    assert got == [(11, 1000.0, False), (11, 7000.01, False), (11, 7000.01, True), (11, 50000.0, False)]
    assert kept.columns == ["date_mutation", "annee", "arrondissement", "type_local", "valeur_fonciere",
                            "surface_reelle_bati", "prix_m2", "nombre_pieces_principales", "longitude", "latitude"]


def test_rounding_matches_arrays(spark):
    values = [2.5, 3.5, -2.5, 0.125, 2.675, 10.005, 1.005, 5.015, 0.0, 1e9 + 0.5]
    for digits in (0, 1, 2):
        df = spark.createDataFrame([(v,) for v in values], "v double").select(X.round_half_even("v", digits).alias("r"))
        assert [r["r"] for r in df.collect()] == np.round(np.array(values), digits).tolist()
    assert one(spark, X.round_half_even(F.lit(None).cast("double"), 2)) is None


def test_numbers(spark):
    assert one(spark, X.number(F.lit("12,5"))) == 12.5
    assert one(spark, X.number(F.lit("x"))) is None
    assert one(spark, X.number(F.lit("nan"))) is None
    assert one(spark, X.first_number(F.lit("environ 25,3 €/m²"))) == 25.3
    assert one(spark, X.last_digits(F.lit("Paris 7"))) == 7
    assert one(spark, X.last_digits(F.lit("7e"))) is None
    assert one(spark, X.first_digits(F.lit("Arr 12e"))) == 12


def test_region_codes(spark):
    assert one(spark, X.region_of_code(F.lit("75120"), "751")) == 20
    assert one(spark, X.region_of_code(F.lit("751"), "751")) is None
    assert one(spark, X.region_of_code(F.lit("75121"), "751")) is None
    assert one(spark, X.region_of_commune(F.lit("75101"))) == 1
    assert one(spark, X.region_of_commune(F.lit("75100"))) is None
    assert one(spark, X.region_of_mixed(F.lit("75113"))) == 13
    assert one(spark, X.region_of_mixed(F.lit("13"))) == 13
    assert one(spark, X.region_of_mixed(F.lit("21"))) is None


def test_zero_and_blank_are_skipped(spark):
    assert one(spark, X.first_truthy(F.lit(0), F.lit(None).cast("int"), F.lit(4))) == 4
    assert one(spark, X.first_truthy(F.lit(""), F.lit("0"), F.lit("b"))) == "b"
    assert one(spark, X.first_filled(F.lit(""), F.lit("b"))) == "b"


def test_categories_keep_the_first_match(spark):
    want = {"nb_arrets": "autre", "score_accessibilite_immo": "accessibilite", "score_qualite_vie": "autre",
            "nb_parcs": "qualite_vie", "score_securite": "securite", "revenu_median": "economique", "Metro_prix": "accessibilite"}
    for name, category in want.items():
        assert one(spark, X.keyword_category(F.lit(name))) == category


@pytest.mark.parametrize("value,want", [(75.0, None), (75.1, "orange"), (100.0, "orange"), (100.1, "rouge"), (None, None)])
def test_alert_thresholds_are_strict(spark, value, want):
    assert one(spark, X.alert_level(F.lit(value).cast("double"))) == want


def test_min_max_score(spark):
    assert one(spark, X.min_max_score(F.lit(None).cast("double"), F.lit(3.0), F.lit(3.0))) == 5.0
    assert one(spark, X.min_max_score(F.lit(4.0), F.lit(3.0), F.lit(5.0), inverse=True)) == 5.0
    assert one(spark, X.min_max_score(F.lit(5.0), F.lit(3.0), F.lit(5.0), inverse=True)) == 0.0
    assert one(spark, X.min_max_score(F.lit(None).cast("double"), F.lit(None).cast("double"), F.lit(None).cast("double"))) is None


def test_grid_region(spark):
    for lat, lon, want in ((48.86, 2.30, 16), (48.85, 2.30, 15), (48.87, 2.34, 8), (48.83, 2.34, 14),
                           (48.90, 2.41, 20), (48.9, 2.43, None), (48.8, 2.3, None)):
        assert one(spark, grid_region(F.lit(lat), F.lit(lon))) == want


def test_distance_against_the_iterative_ellipsoid_formula(spark):
    def vincenty(lat1, lon1, lat2, lon2):
        a, f = 6378137.0, 1 / 298.257223563
        b = (1 - f) * a
        u1, u2 = (math.atan((1 - f) * math.tan(math.radians(x))) for x in (lat1, lat2))
        big = lam = math.radians(lon2 - lon1)
        for _ in range(100):
            s = math.hypot(math.cos(u2) * math.sin(lam),
                           math.cos(u1) * math.sin(u2) - math.sin(u1) * math.cos(u2) * math.cos(lam))
            if s == 0:
                return 0.0
            c = math.sin(u1) * math.sin(u2) + math.cos(u1) * math.cos(u2) * math.cos(lam)
            sigma = math.atan2(s, c)
            sa = math.cos(u1) * math.cos(u2) * math.sin(lam) / s
            ca = 1 - sa * sa
            cm = c - 2 * math.sin(u1) * math.sin(u2) / ca if ca else 0.0
            k = f / 16 * ca * (4 + f * (4 - 3 * ca))
            lam = big + (1 - k) * f * sa * (sigma + k * s * (cm + k * c * (-1 + 2 * cm * cm)))
        u = ca * (a * a - b * b) / (b * b)
        aa = 1 + u / 16384 * (4096 + u * (-768 + u * (320 - 175 * u)))
        bb = u / 1024 * (256 + u * (-128 + u * (74 - 47 * u)))
        d = bb * s * (cm + bb / 4 * (c * (-1 + 2 * cm * cm) - bb / 6 * cm * (-3 + 4 * s * s) * (-3 + 4 * cm * cm)))
        return b * aa * (sigma - d)

    for dlat, dlon in ((0, 0), (0.03, 0.0), (0.0, 0.06), (0.02, -0.04), (-0.001, 0.001)):
        got = one(spark, ellipsoid_distance_m(F.lit(48.86 + dlat), F.lit(2.34 + dlon), 48.86, 2.34))
        assert got == pytest.approx(vincenty(48.86 + dlat, 2.34 + dlon, 48.86, 2.34), abs=0.005)


def test_aliases_follow_file_order():
    cols = [normalized(c, True) for c in ("Arrondissement", "loyer_ref_m2", "loyer_ref_majore_m2", "loyer_ref_minore_m2", "annee")]
    assert resolve_aliases(cols, C.RENT_ALIASES) == {
        "arrondissement": "arrondissement", "loyer_ref_majore_m2": "loyer_max_m2", "loyer_ref_m2": "loyer_ref_m2"}
    assert resolve_aliases(["codgeo", "arrondissement", "q2", "tp6020", "annee"], C.INCOME_ALIASES) == {
        "q2": "revenu_median", "tp6020": "taux_pauvrete"}
    assert resolve_aliases(["arr", "part_nb"], C.SOCIAL_ALIASES, first_alias_wins=True) == {
        "arr": "arrondissement", "part_nb": "part_logements_sociaux_pct"}


def test_renaming_onto_an_existing_name(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert renamed(df, {"a": "b"}).columns == ["b"]
    assert renamed(df, {"a": "b"}).first()[0] == 1


def test_nan_and_infinity_become_null(spark):
    df = spark.createDataFrame([(float("nan"), 1), (float("inf"), 2), (3.5, 3)], "x double, k int")
    assert [r["x"] for r in without_nan(df).orderBy("k").collect()] == [None, None, 3.5]
