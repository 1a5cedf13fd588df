"""Silver -> gold: yearly prices, composite scores, final table.

Each score first reduces its sources to one row per region. Bounds, counts and medians over the regions are
windows over these few rows, so a score is one lazy plan that reads every source once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from regionlake import config as C
from regionlake.functions import cleaning as X
from regionlake.operators.aggregates import count_by, median_by, price_stats, sum_by, latest_year
from regionlake.operators.joins import attach_all, with_region_values
from regionlake.operators.sizing import Spine
from regionlake.operators.windows import keep_first, with_variation

WEIGHTS = C.ScoreWeights()


def over_regions(value: Column) -> Column:
    """An aggregate of a table that has one row per region, beside each row."""
    return value.over(Window.partitionBy())


def yearly_prices(sales: DataFrame, kinds=C.SaleRules().kinds, exact: bool = True,
                  digits: int | None = 0) -> DataFrame:
    """Median price, volume, kinds and change per (region, year)."""
    stats = price_stats(sales, tuple(kinds), exact=exact, digits=digits)
    return with_variation(stats, digits=None if digits is None else 1)


def bounds_of(columns: list[str]) -> Column:
    """Minimum and maximum over the regions of every score input."""
    parts = []
    for c in columns:
        parts += [over_regions(F.min(c)).alias(f"{c}_lo"), over_regions(F.max(c)).alias(f"{c}_hi")]
    return F.struct(*parts)


def scaled(c: str, inverse: bool = False) -> Column:
    return X.round_half_even(
        X.min_max_score(F.col(c).cast("double"), F.col(f"_b.{c}_lo").cast("double"),
                        F.col(f"_b.{c}_hi").cast("double"), inverse), 2
    )


def access_scores(stops: DataFrame | None, schools: DataFrame | None, shops_health: DataFrame | None,
                  spine: Spine, centrality=C.CENTRALITY, weights=WEIGHTS) -> DataFrame:
    """Accessibility: transport, schools, shops, health and a fixed centrality."""
    key = spine.key
    base = attach_all(spine, [
        count_by(t, [key], out)
        for t, out in ((stops, "nb_arrets"), (schools, "nb_ecoles")) if t is not None
    ])
    if shops_health is not None:
        have = shops_health.columns
        shop = [c for c in ("nb_supermarches", "nb_pharmacies", "nb_boulangeries") if c in have]
        care = [c for c in ("nb_hopitaux", "nb_medecins") if c in have]
        sums = [X.row_sum(*cols).alias(out) for cols, out in ((shop, "nb_commerces"), (care, "nb_sante")) if cols]
        base = base.join(shops_health.select(key, *sums), key, "left")
    counts = ["nb_arrets", "nb_ecoles", "nb_commerces", "nb_sante"]
    base = base.select(key, *[
        (F.coalesce(F.col(c).cast("double"), F.lit(0.0)) if c in base.columns else F.lit(0.0)).alias(c)
        for c in counts
    ])
    parts = {"transport": scaled("nb_arrets"), "schools": scaled("nb_ecoles"), "shops": scaled("nb_commerces"),
             "health": scaled("nb_sante"), "centrality": spine.literal(C.by_region(centrality))}
    score = X.round_half_even(X.weighted(weights.access, parts), 2)
    return base.withColumn("_b", bounds_of(counts)).select(
        key, score.alias("score_accessibilite"), *counts
    )


def life_scores(parks: DataFrame | None, air: DataFrame | None, noise: DataFrame | None,
                traffic: DataFrame | None, spine: Spine, weights=WEIGHTS) -> DataFrame:
    """Quality of life: parks, air, noise and traffic.

    A missing source scores neutral. Inside a present source a missing air row scores
    zero, a missing noise or traffic row neutral. Every source is reduced to one row
    per region first.
    """
    key, neutral = spine.key, F.lit(weights.neutral)
    base = spine.df if parks is None else spine.attach(count_by(parks, [key], "nb_parcs"))
    for t, c in ((air, "score_air"), (noise, "score_bruit"), (traffic, "score_circulation")):
        if t is not None and c in t.columns:
            base = base.join(keep_first(t.select(key, c), [key], [c]), key, "left")

    have = base.columns
    base = base.select(
        key,
        (F.coalesce(F.col("nb_parcs").cast("double"), F.lit(0.0)) if "nb_parcs" in have else F.lit(0.0)).alias("nb_parcs"),
        (F.coalesce(X.clip(F.col("score_air") / 10.0, 0, 10), F.lit(0.0)) if "score_air" in have else neutral).alias("s_air"),
        (F.coalesce("score_bruit", neutral) if "score_bruit" in have else neutral).alias("s_bruit"),
        (F.coalesce("score_circulation", neutral) if "score_circulation" in have else neutral).alias("s_circ"),
    )
    parts = {"parks": scaled("nb_parcs"), "air": F.col("s_air"), "noise": F.col("s_bruit"), "traffic": F.col("s_circ")}
    score = X.round_half_even(X.weighted(weights.life, parts), 2)
    return base.withColumn("_b", bounds_of(["nb_parcs"])).select(
        key, score.alias("score_qualite_vie"), "nb_parcs"
    )


def filled(base: DataFrame, specs: dict[str, tuple[Column, Column | None]]) -> DataFrame:
    """Fill gaps of several columns: ``{column: (default, fill)}``.

    A column without any value takes its default table; otherwise each gap takes
    ``fill``, or the column's median when that is None. The table has one row per region.
    """
    stats = F.struct(*[
        F.struct(over_regions(F.count(c)).alias("n"), over_regions(F.median(c)).alias("med")).alias(c) for c in specs
    ])
    out = base.withColumn("_f", stats)
    for c, (default, fill) in specs.items():
        gap = F.col(f"_f.{c}.med") if fill is None else fill
        known = F.coalesce(F.col(c).cast("double"), gap)
        out = out.withColumn(c, F.when(F.col(f"_f.{c}.n") == 0, default).otherwise(known))
    return out.drop("_f")


def safety_scores(crime: DataFrame | None, security: DataFrame | None, spine: Spine, weights=WEIGHTS,
                  offences=C.DEFAULT_OFFENCES, police=C.DEFAULT_POLICE, fire=C.DEFAULT_FIRE) -> DataFrame:
    """Safety: inverse offences, police stations, fire stations."""
    key = spine.key
    base = spine.df
    if crime is not None and key in crime.columns:
        base = base.join(sum_by(crime, [key], "nb_faits", "nb_faits"), key, "left")
    if security is not None and key in security.columns:
        located = security.where(F.col(key).isNotNull())
        for kind, out in (("commissariats", "nb_commissariats"), ("pompiers", "nb_casernes")):
            base = base.join(count_by(located.where(F.col("type") == kind), [key], out), key, "left")
    for c in ("nb_faits", "nb_commissariats", "nb_casernes"):
        if c not in base.columns:
            base = base.withColumn(c, F.lit(None).cast("double"))
    base = filled(base, {
        "nb_faits": (spine.literal(C.by_region(offences)), None),
        "nb_commissariats": (spine.literal(C.by_region(police)), F.lit(1.0)),
        "nb_casernes": (spine.literal(C.by_region(fire)), F.lit(0.0)),
    })
    inputs = ["nb_faits", "nb_commissariats", "nb_casernes"]
    parts = {"crime": scaled("nb_faits", inverse=True), "police": scaled("nb_commissariats"), "fire": scaled("nb_casernes")}
    score = X.round_half_even(X.weighted(weights.safety, parts), 2)
    return base.withColumn("_b", bounds_of(inputs)).select(key, score.alias("score_securite"), *inputs)


def rent_column(columns: list[str]) -> str | None:
    """The column the housing score takes as the rent."""
    return next((c for c in columns if "ref" in c or "med" in c or "loyer" in c), None)


def housing_scores(prices: DataFrame | None, income: DataFrame | None, rents: DataFrame | None, spine: Spine,
                   weights=WEIGHTS, default_prices=C.DEFAULT_PRICES) -> DataFrame:
    """Housing access: purchasing power and rent effort. Income is required."""
    key = spine.key
    if income is None or "revenu_median" not in income.columns:
        raise ValueError("the housing score needs the median income by region")
    base = spine.attach(keep_first(income.select(key, "revenu_median"), [key], ["revenu_median"]))
    if prices is not None and "prix_m2_median" in prices.columns:
        base = base.join(latest_year(prices).select(key, "prix_m2_median"), key, "left")
    else:
        base = base.withColumn("prix_m2_median", F.lit(None).cast("double"))
    rent = rent_column([c for c in rents.columns if c != key]) if rents is not None and key in rents.columns else None
    if rent:
        base = base.join(median_by(rents, [key], rent, "loyer_ref_m2"), key, "left")
    stats = F.struct(over_regions(F.median("revenu_median")).alias("inc"), over_regions(F.median("prix_m2_median")).alias("price"),
                     over_regions(F.count("prix_m2_median")).alias("n"))
    required = F.when(F.col("_f.inc").isNull(), F.raise_error(F.lit("no median income for any region")).cast("double"))
    base = base.withColumn("_f", stats).select(
        key,
        F.coalesce(required, F.col("revenu_median"), F.col("_f.inc")).alias("revenu_median"),
        F.when(F.col("_f.n") == 0, spine.literal(C.by_region(default_prices)))
        .otherwise(F.coalesce(F.col("prix_m2_median"), F.col("_f.price"))).alias("prix_m2_median"),
        *(["loyer_ref_m2"] if rent else []),
    )
    base = base.withColumn(
        "m2_par_revenu", X.round_half_even(F.try_divide(F.col("revenu_median"), F.col("prix_m2_median")), 2)
    )
    inputs = ["m2_par_revenu"]
    if rent:
        month = F.col("revenu_median") / 12.0
        base = base.withColumn(
            "effort_locatif",
            X.round_half_even(F.try_divide(F.col("loyer_ref_m2") * F.lit(weights.rent_surface), month), 2),
        )
        inputs.append("effort_locatif")
    parts = {"purchase": scaled("m2_par_revenu"),
             "effort": scaled("effort_locatif", inverse=True) if rent else F.lit(weights.neutral)}
    score = X.round_half_even(X.weighted(weights.housing, parts), 2)
    return base.withColumn("_b", bounds_of(inputs)).select(
        key, score.alias("score_accessibilite_immo"), "revenu_median", "m2_par_revenu"
    )


SCORES = ("score_accessibilite", "score_qualite_vie", "score_securite", "score_accessibilite_immo")


def indicators(access: DataFrame, life: DataFrame, safety: DataFrame, housing: DataFrame,
               key: str = C.REGION) -> DataFrame:
    """The four scores side by side with their mean."""
    wide = access.join(life, key, "left").join(safety, key, "left").join(housing, key, "left")
    return wide.withColumn("score_global", global_score(*SCORES))


def global_score(*scores: str) -> Column:
    total = F.col(scores[0])
    for s in scores[1:]:
        total = total + F.col(s)
    return X.round_half_even(total / F.lit(float(len(scores))), 2)


def with_affordability(df: DataFrame, surface: float = 50.0) -> DataFrame:
    """Square metres one yearly income buys, and years of income for ``surface`` m²."""
    price, income = F.col("prix_m2_median"), F.col("revenu_median")
    return df.withColumn("m2_par_revenu_annuel", X.round_half_even(F.try_divide(income, price), 2)).withColumn(
        "annees_pour_50m2", X.round_half_even(F.try_divide(price * F.lit(surface), income), 1)
    )


INCOME_COLUMNS = ["revenu_median", "revenu_d1", "revenu_d9", "taux_pauvrete", "gini"]
AIR_COLUMNS = ["iqa_moyen", "no2_µg_m3", "pm25_µg_m3", "score_air"]
COUNT_COLUMNS = ["nb_arrets", "nb_ecoles", "nb_parcs", "nb_faits"]


def final_table(prices: DataFrame, spine: Spine, social: DataFrame | None = None, income: DataFrame | None = None,
                rents: DataFrame | None = None, air: DataFrame | None = None,
                scores: DataFrame | None = None, rent: str = "loyer_ref_m2") -> DataFrame:
    """The yearly table with every regional value repeated per year."""
    out = prices.drop("nb_logements_sociaux")
    if social is not None:
        if "part_logements_sociaux_pct" not in social.columns and "part_ls_pct" in social.columns:
            social = social.withColumnRenamed("part_ls_pct", "part_logements_sociaux_pct")
        out = with_region_values(out, social, ["nb_logements_sociaux", "part_logements_sociaux_pct"], spine)
    out = with_region_values(out, income, INCOME_COLUMNS, spine)
    if "revenu_median" in out.columns:
        out = with_affordability(out)
    if rents is not None and rent in rents.columns:
        medians = median_by(rents, [spine.key], rent, "loyer_ref_median_m2")
        out = with_region_values(out, medians, ["loyer_ref_median_m2"], spine)
    out = with_region_values(out, air, AIR_COLUMNS, spine)
    if scores is not None:
        named = [c for c in scores.columns if c.startswith("score_") or c in COUNT_COLUMNS]
        out = with_region_values(out, scores, named, spine)
    return out.orderBy(spine.key, C.YEAR)
