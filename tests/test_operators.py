"""Operators against plain Python on small data, including skewed groups and ties."""

import random
import statistics
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from regionlake.operators import aggregates as A
from regionlake.operators import joins as J
from regionlake.operators import merge as M
from regionlake.operators import quality as Q
from regionlake.operators import quantiles
from regionlake.operators import reshape as R
from regionlake.operators import spatial as S
from regionlake.operators import windows as W
from regionlake.operators.quantiles import group_medians
from regionlake.operators.sizing import Sized, Spine, salted_join, sized
from regionlake.session import durable

# A hot key with most of the rows, many ties, a null key, nulls and NaN.
RNG = random.Random(5)
SKEWED = (
    [("hot", round(RNG.gauss(100, 30), 1)) for _ in range(4000)]
    + [("hot", 100.0)] * 1500
    + [("pair", 1.0), ("pair", 4.0), ("one", 9.5), (None, 2.0), (None, 3.0), ("none", None), ("nan", float("nan"))]
    + [("tail", 10.0**i) for i in range(11)]
)


def medians_of(pairs):
    groups = {}
    for k, v in pairs:
        groups.setdefault(k, [])
        if v is not None and v == v:
            groups[k].append(v)
    return {k: (statistics.median(v) if v else None) for k, v in groups.items()}


@pytest.mark.parametrize("group_rows", [10_000, 1000, 5])
def test_medians_do_not_depend_on_the_path(spark, group_rows):
    df = spark.createDataFrame(SKEWED, "k string, v double").repartition(6)
    out = group_medians(df, ["k"], {"m": "v"}, [F.count("v").alias("n")], group_rows=group_rows)
    assert {r["k"]: r["m"] for r in out.collect()} == medians_of(SKEWED)


def test_medians_with_bounds_too_large_to_broadcast(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "sized", lambda df: Sized(durable(df), False))
    df = spark.createDataFrame(SKEWED, "k string, v double").repartition(6)
    out = group_medians(df, ["k"], {"m": "v"}, group_rows=1000, salts=4)
    assert {r["k"]: r["m"] for r in out.collect()} == medians_of(SKEWED)


def test_bracket_holds_the_median_of_a_large_group(spark):
    """Half a million rows: the sketch really compresses, and ranks still come out exact."""
    df = spark.range(0, 500_001, 1, 16).select(
        F.lit(1).alias("k"), ((F.col("id") * 7919) % 500_009).cast("double").alias("v"), (F.col("id") % 3).cast("double").alias("w"))
    got = group_medians(df, ["k"], {"m": "v", "w": "w"}, group_rows=1000).first()
    want = sorted((i * 7919) % 500_009 for i in range(500_001))[250_000]
    assert (got["m"], got["w"]) == (float(want), 1.0)


@pytest.mark.parametrize("order", ["up", "down", "mixed", "few"])
def test_medians_around_the_sketch_limit(spark, order):
    """Groups just below, at and above the size up to which the sketch's ranks are taken as exact, merged from many partitions."""
    rng, rows = random.Random(order), []
    for n in (1, 2, 3, 4998, 4999, 5000, 5001, 9999, 10_000, 10_001):
        values = [float(rng.randint(0, 7)) if order == "few" else rng.uniform(-1e9, 1e9) for _ in range(n)]
        values.sort(reverse=order == "down")
        if order in ("mixed", "few"):
            rng.shuffle(values)
        rows += [(str(n), v) for v in values]
    df = spark.createDataFrame(rows, "k string, v double").repartition(13)
    assert {r["k"]: r["m"] for r in group_medians(df, ["k"], {"m": "v"}).collect()} == medians_of(rows)


def test_a_bracket_that_misses_is_widened(spark, monkeypatch):
    """With no width at all, a compressed sketch brackets some other value."""
    monkeypatch.setattr(quantiles, "BRACKET_HALF_WIDTH", 0.0)
    monkeypatch.setattr(quantiles, "SKETCH_ACCURACY", 20)
    calls, bracketed = [], quantiles.bracketed
    monkeypatch.setattr(quantiles, "bracketed", lambda *a: calls.append(1) or bracketed(*a))
    df = spark.range(0, 60_000, 1, 9).select((F.col("id") % 2).alias("k"), ((F.col("id") * 7919) % 60_013).cast("double").alias("v"))
    got = {r["k"]: r["m"] for r in group_medians(df, ["k"], {"m": "v"}, [F.count("v").alias("n")]).collect()}
    rows = [(i % 2, float(i * 7919 % 60_013)) for i in range(60_000)]
    assert got == medians_of(rows) and len(calls) == 2


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(-50, 50)), min_size=1, max_size=60))
def test_bracketed_median_property(spark, pairs):
    df = spark.createDataFrame([(k, float(v)) for k, v in pairs], "k int, v double")
    out = group_medians(df, ["k"], {"m": "v"}, group_rows=1)
    assert {r["k"]: r["m"] for r in out.collect()} == medians_of([(k, float(v)) for k, v in pairs])


def brute_rolling(rows, hours):
    out = {}
    for i, k, t, v in rows:
        if k is None or t is None:
            out[i] = None
            continue
        vals = [w for _, k2, t2, w in rows if k2 == k and t2 is not None and w is not None and t - timedelta(hours=hours) <= t2 <= t]
        out[i] = sum(vals) / len(vals) if vals and v is not None else None
    return out


def test_rolling_mean_matches_brute_force(spark):
    rng, start = random.Random(3), datetime(2024, 1, 1)
    rows = []
    for i in range(400):
        key = 1 if rng.random() < 0.7 else rng.choice([2, 3, None])
        t = start + timedelta(minutes=rng.choice([0, 30, 60]) + 60 * rng.randrange(0, 72))
        rows.append((i, key, t, round(rng.uniform(0, 150), 2)))
    rows += [(400, 1, start + timedelta(hours=200), 10.0), (401, 1, start + timedelta(hours=224), 20.0),
             (402, 1, start + timedelta(hours=224, microseconds=1), 40.0), (403, 2, None, 1.0)]
    df = spark.createDataFrame(rows, "i int, k int, t timestamp, v double")
    got = {r["i"]: r["m"] for r in W.rolling_mean(df, "k", "t", "v", "m", 24).collect()}
    want = brute_rolling(rows, 24)
    assert got.keys() == want.keys()
    for i, w in want.items():
        assert got[i] == (None if w is None else pytest.approx(w, abs=1e-9)), i
    assert got[401] == 15.0  # a reading exactly 24 h old still counts
    assert got[402] == 30.0  # a microsecond later it does not


def test_variation_pads_and_skips_absent_years(spark):
    df = spark.createDataFrame(
        [(1, 2020, 100.0), (1, 2021, None), (1, 2022, 121.0), (1, 2024, 242.0), (2, 2020, 50.0), (3, 2020, None), (3, 2021, 5.0)],
        "arrondissement int, annee int, prix_m2_median double")
    got = {(r[0], r[1]): r[3] for r in W.with_variation(df).collect()}
    assert got == {(1, 2020): None, (1, 2021): 0.0, (1, 2022): 21.0, (1, 2024): 100.0, (2, 2020): None, (3, 2020): None, (3, 2021): None}


def test_latest_and_first_are_ordered(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 3, "y"), ("a", 1, "z"), (None, 5, "n"), (None, 4, "m")], "k string, t int, v string")
    assert {(r["k"], r["v"]) for r in W.latest_per_key(df, ["k"], ["t"]).collect()} == {("a", "y"), (None, "n")}
    assert {(r["k"], r["v"]) for r in W.keep_first(df, ["k"], ["t"]).collect()} == {("a", "z"), (None, "m")}


def test_outliers_need_five_values_and_never_a_negative_bound(spark):
    few = spark.createDataFrame([(i, v) for i, v in enumerate([1.0, 1.0, 1.0, 900.0])], "k int, prix_m2_median double")
    assert W.outliers(few).count() == 0
    many = spark.createDataFrame([(i, 100.0) for i in range(30)] + [(98, -1.0), (99, 5000.0)], "k int, prix_m2_median double")
    got = {r["k"]: r["severity"] for r in W.outliers(many).collect()}
    assert got == {98: "error", 99: "warning"}


def test_ranking_bands(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(1, 9)] + [(9, None)], "arrondissement int, score_global double")
    got = [(r["arrondissement"], r["bande"]) for r in W.ranked(df).orderBy("rang").collect()]
    assert got[:3] == [(8, "top"), (7, "top"), (6, "top")]
    assert got[-1] == (9, "bottom") and got[4][1] == "middle"
    assert [r[0] for r in W.top_regions(df, 2).collect()] == [8, 7]


def test_counts_and_sums_follow_array_libraries(spark):
    df = spark.createDataFrame([(1, None), (1, 2.0), (2, None), (None, 5.0)], "arrondissement int, v double")
    assert {tuple(r) for r in A.count_by(df, ["arrondissement"], "n").collect()} == {(1, 2), (2, 1)}
    assert {tuple(r) for r in A.sum_by(df, ["arrondissement"], "v", "s").collect()} == {(1, 2.0), (2, 0.0)}


def test_sketch_is_close(spark):
    df = spark.range(20_000).select(F.lit(1).alias("arrondissement"), F.lit(2022).alias("annee"), F.lit("Maison").alias("type_local"),
                                    F.col("id").cast("double").alias("prix_m2"), F.col("id").cast("double").alias("surface_reelle_bati"))
    got = A.price_stats(df, exact=False, digits=None).first()
    assert abs(got["prix_m2_median"] - 9999.5) <= 4 and got["Maison"] == 20_000 and got["Appartement"] == 0


def test_city_kpis(spark):
    df = spark.createDataFrame(
        [(1, 2023, 0.0, 1.0, 10, 5.0, 100), (2, 2023, 8.0, None, None, None, 300), (3, 2023, 10.0, 3.0, 5, 7.0, None), (1, 2022, 1.0, 1.0, 1, 9.0, 100)],
        "arrondissement int, annee int, prix_m2_median double, prix_m2_variation_pct double, nb_transactions int, part_logements_sociaux_pct double, nb_logements_sociaux int")
    assert tuple(A.city_kpis(df, 2023).first()) == (9.0, 2.0, 15, 5.0)
    assert tuple(A.city_kpis(df, 2023, region=2).first()) == (8.0, None, 0, 300.0)
    assert A.city_kpis(df, 2019).first()["part_logements_sociaux_pct"] == 7.0


def test_colour_classes(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 5.0), (3, 9.0), (4, None)], "arrondissement int, v double")
    assert [r["classe"] for r in A.colour_classes(df, "v").orderBy("arrondissement").collect()] == [0, 5, 9, None]
    same = spark.createDataFrame([(1, 3.0), (2, 3.0)], "arrondissement int, v double")
    assert {r["classe"] for r in A.colour_classes(same, "v").collect()} == {0}


def test_region_values_cannot_multiply_facts(spark):
    facts = spark.createDataFrame([(1, 2021), (1, 2022), (2, 2021)], "arrondissement int, annee int")
    table = spark.createDataFrame([(1, 5.0), (1, 6.0), (9, 7.0)], "arrondissement int, x double")
    out = J.with_region_values(facts, table, ["x"], Spine.numbered(spark, 3))
    assert sorted(tuple(r) for r in out.collect() if r["x"]) == [(1, 2021, 5.0), (1, 2022, 5.0)]
    assert out.count() == 3


def test_missing_members_per_year(spark):
    facts = spark.createDataFrame([(1, 2021), (2, 2021), (1, 2022)], "arrondissement int, annee int")
    got = {tuple(r) for r in J.missing_members(facts, Spine.numbered(spark, 3)).collect()}
    assert got == {(3, 2021), (2, 2022), (3, 2022)}


def test_salted_join_keeps_identical_rows(spark):
    left = spark.createDataFrame([(1, "x")] * 50 + [(2, "y"), (None, "n")], "k int, v string").repartition(5)
    right = spark.createDataFrame([(1, "one")], "k int, w string")
    got = salted_join(left, right, ["k"], 7, "left").groupBy("k", "v", "w").count().collect()
    assert {tuple(r) for r in got} == {(1, "x", "one", 50), (2, "y", None, 1), (None, "n", None, 1)}


def test_size_check(spark):
    assert sized(spark.range(10), 10).small and not sized(spark.range(11), 10).small


SQUARE = [[[[0.0, 0.0], [4.0, 0.0], [4.0, 4.0], [0.0, 4.0], [0.0, 0.0]]]]
HOLED = [[[[2.0, 2.0], [8.0, 2.0], [8.0, 8.0], [2.0, 8.0], [2.0, 2.0]], [[5.0, 5.0], [6.0, 5.0], [6.0, 6.0], [5.0, 6.0], [5.0, 5.0]]],
         [[[20.0, 20.0], [22.0, 20.0], [21.0, 23.0], [20.0, 20.0]]]]


@pytest.mark.parametrize("broadcast_rows", [1000, 1])
@pytest.mark.parametrize("cell", [None, 0.7, 50.0])
def test_point_in_polygon(spark, cell, broadcast_rows):
    shapes = spark.createDataFrame([(7, SQUARE), (3, HOLED)], "arrondissement int, parts array<array<array<array<double>>>>")
    cases = {(1.0, 1.0): 7, (3.0, 3.0): 3, (0.0, 1.0): None, (4.0, 1.0): None, (1.0, 4.0): None, (0.0, 0.0): None,
             (5.5, 5.5): None, (5.0, 5.5): None, (4.5, 5.5): 3, (21.0, 21.0): 3, (21.0, 23.0): None, (20.1, 22.9): None, (9.0, 9.0): None,
             (4.0, 3.0): 3, (None, 1.0): None, (1.0, None): None}
    points = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(cases)], "i int, lon double, lat double")
    got = {r["i"]: r["arrondissement"] for r in S.with_region(points, shapes, cell=cell, broadcast_rows=broadcast_rows).collect()}
    assert got == dict(enumerate(cases.values()))


def test_enrichment_rules(spark):
    shapes = spark.createDataFrame([(7, SQUARE)], "arrondissement int, parts array<array<array<array<double>>>>")
    known = spark.createDataFrame([(1.0, 1.0, 2)] * 9 + [(1.0, 1.0, None)], "lat double, lon double, arrondissement int")
    assert [r["arrondissement"] for r in S.enriched(known, shapes).orderBy("arrondissement").collect()] == [2] * 9 + [7]
    bare = spark.createDataFrame([(1,)], "x int")
    assert S.enriched(bare, shapes) is bare and S.enriched(known, None) is known
    some = spark.createDataFrame([(1.0, 1.0, 2), (None, 1.0, 5), (9.0, 9.0, 4), (3.0, 3.0, None)], "lat double, lon double, arrondissement int")
    assert sorted(str(r["arrondissement"]) for r in S.enriched(some, shapes).collect()) == ["2", "4", "5", "7"]


def test_radius_limits(spark):
    df = spark.createDataFrame([(1, 48.86, 2.34), (2, 48.8605, 2.34), (3, 48.9, 2.34), (4, None, 2.34)], "id int, latitude double, longitude double")
    got = S.within_radius(df, 48.86, 2.34, 100)
    assert [r["id"] for r in got.collect()] == [1, 2] and got.first()["distance_m"] == 0.0
    for bad in (9, 5001):
        with pytest.raises(ValueError):
            S.within_radius(df, 48.86, 2.34, bad)


def test_upsert_is_idempotent_with_null_keys(spark, rows):
    target = spark.createDataFrame([(1, None, 1.0), (1, 2020, 2.0), (2, 2020, 3.0)], "k int, annee int, v double")
    source = spark.createDataFrame([(1, None, 9.0), (3, None, 8.0), (3, None, 8.0)], "k int, annee int, v double")
    once = M.upserted(target, source, ["k", "annee"])
    want = sorted([(1, None, 9.0), (1, 2020, 2.0), (2, 2020, 3.0), (3, None, 8.0)], key=repr)
    assert rows(once) == want and rows(M.upserted(once, source, ["k", "annee"])) == want
    newer = spark.createDataFrame([(2, 2020, 1.0), (2, 2020, 5.0)], "k int, annee int, v double")
    assert (2, 2020, 5.0) in rows(M.upserted(target, newer, ["k", "annee"], version=["v"]))
    only = spark.createDataFrame([(1,), (4,), (4,)], "k int")
    assert rows(M.upserted(spark.createDataFrame([(1,)], "k int"), only, ["k"])) == [(1,), (4,)]


def test_retention_keeps_the_exact_limit(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1), 1), (datetime(2023, 12, 31, 23, 59, 59), 2)], "ingested_at timestamp, k int")
    assert [r["k"] for r in M.retained(df, "2024-01-31 00:00:00").collect()] == [1]
    assert [r["k"] for r in M.retained(df, datetime(2024, 1, 31)).collect()] == [1]


def test_anomaly_report(spark):
    table = spark.createDataFrame(
        [(1, 2021, 100.0, 50), (2, 2021, 100.0, 9), (1, 2022, None, 20), (3, 2022, 100.0, None)],
        "arrondissement int, annee int, prix_m2_median double, nb_transactions int")
    got = {tuple(r) for r in Q.anomalies(table, Spine.numbered(spark, 3)).collect()}
    assert got == {
        ("arrondissement_manquant", "warning", "Année 2021 : arrondissements absents [3]"),
        ("arrondissement_manquant", "warning", "Année 2022 : arrondissements absents [2]"),
        ("valeur_manquante", "warning", "1 valeur(s) NaN dans la colonne « prix_m2_median »"),
        ("valeur_manquante", "warning", "1 valeur(s) NaN dans la colonne « nb_transactions »"),
        ("volume_faible", "info", "Arr.2 2021 : seulement 9 transactions"),
    }


def test_constraints(spark):
    dim = spark.createDataFrame([(1,), (2,)], "arrondissement int")
    facts = spark.createDataFrame([(1, 2021, 5.0), (1, 2021, None), (9, 1999, -1.0)], "arrondissement int, annee int, prix_m2_median double")
    got = {r["regle"]: r["violations"] for r in Q.check_report(facts, Q.price_checks(dim)).collect()}
    assert got == {"ck_annee": 1, "ck_prix_positif": 1, "pk_region_annee": 1, "fk_region": 1}
    scores = spark.createDataFrame([(1, 5.0), (2, 11.0), (3, None)], "arrondissement int, score_x double")
    assert Q.check_report(scores, Q.score_expectations(scores.columns)).first()["violations"] == 2
    social = spark.createDataFrame([(1, 2022, 101.0), (2, 2022, None)], "arrondissement int, annee int, part_logements_sociaux_pct double")
    assert {r["regle"]: r["valide"] for r in Q.check_report(social, Q.social_checks()).collect()} == {
        "ck_annee": True, "ck_part": False, "pk_region_annee": True}


def test_long_form_and_limits(spark):
    wide = spark.createDataFrame([(1, 3, 2.5), (2, None, 1.0)], "arrondissement int, nb_parcs int, score_securite double")
    got = {(r["arrondissement"], r["nom"], r["categorie"], r["valeur"]) for r in R.long_indicators(wide).collect()}
    assert got == {(1, "nb_parcs", "qualite_vie", 3.0), (1, "score_securite", "securite", 2.5), (2, "score_securite", "securite", 1.0)}
    for bad in (0, 501):
        with pytest.raises(ValueError):
            R.newest(wide, "nb_parcs", bad, (1, 500), [])


def test_rolling_mean_takes_numbers_only(spark):
    rows = [(1, "2020-01-01 00:00:00", 2.0), (1, "2020-01-01 01:00:00", float("nan")), (1, "2020-01-01 02:00:00", float("-inf")), (1, "2020-01-01 03:00:00", 4.0)]
    df = spark.createDataFrame(rows, "k int, ts string, v double").withColumn("ts", F.to_timestamp("ts"))
    got = [r["m"] for r in W.rolling_mean(df, "k", "ts", "v", "m").orderBy("ts").collect()]
    assert got[0] == 2.0 and got[3] == 3.0


def test_rolling_mean_keeps_small_values(spark):
    df = spark.createDataFrame([(1, 1, 1e-7), (1, 2, 3e-7), (1, 3, 1e9)], "k int, s long, v double")
    df = df.withColumn("ts", F.timestamp_seconds("s"))
    got = [r["m"] for r in W.rolling_mean(df, "k", "ts", "v", "m").orderBy("ts").collect()]
    assert got == pytest.approx([1e-7, 2e-7, (1e9 + 4e-7) / 3], rel=1e-12)


def test_rollup_levels(spark):
    rows = [(1, 2021, 10.0, 100.0), (1, 2022, 20.0, 200.0), (2, 2021, 30.0, 300.0), (None, 2021, 40.0, 400.0)]
    df = spark.createDataFrame(rows, "arrondissement int, annee int, prix_m2 double, valeur_fonciere double")
    out = {(r["niveau"], r["arrondissement"], r["annee"]): (r["nb_transactions"], r["prix_m2_moyen"]) for r in A.price_rollup(df).collect()}
    assert out["ville", None, None] == (4, 25.0) and out["arrondissement", 1, None] == (2, 15.0)
    assert out["arrondissement", None, None] == (1, 40.0) and out["arrondissement_annee", None, 2021] == (1, 40.0) and len(out) == 8


def test_latest_row_of_ties_and_missing_times(spark):
    rows = [("a", 2, 1, "x"), ("a", 2, 5, "y"), ("a", 2, 5, "z"), ("a", None, 9, "q"), (None, 1, 1, "n"), ("b", None, 3, "b"), ("b", None, 4, "c")]
    df = spark.createDataFrame(rows, "k string, t int, i int, v string").repartition(3)
    got = {(r["k"], r["t"], r["i"], r["v"]) for r in W.latest_per_key(df, ["k"], ["t", "i"]).collect()}
    assert got == {("a", 2, 5, "z"), (None, 1, 1, "n"), ("b", None, 4, "c")}
    only = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "k string, t int")
    assert sorted(tuple(r) for r in W.latest_per_key(only, ["k"], ["t"]).collect()) == [("a", 1), ("b", 2)]


def test_upsert_with_fewer_columns_keeps_the_others(spark):
    target = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (None, "c", 3.0)], "k int, name string, v double")
    source = spark.createDataFrame([(2, 9.0), (None, 8.0), (4, 7.0)], "k int, v double")
    got = {tuple(r) for r in M.upserted(target, source, ["k"]).collect()}
    assert got == {(1, "a", 1.0), (2, "b", 9.0), (None, "c", 8.0), (4, None, 7.0)}


def test_index_too_wide_to_broadcast(spark):
    rows = spark.createDataFrame([([1] * 1000,), ([2] * 1000,)], "a array<int>")
    size = F.size("a") * 8
    assert sized(rows, 10, size, 100_000).small and not sized(rows, 10, size, 10_000).small and not sized(rows, 1, size, 100_000).small
