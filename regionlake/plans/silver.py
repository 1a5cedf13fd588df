"""Landed files -> typed silver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from regionlake import config as C
from regionlake.functions import cleaning as X
from regionlake.functions.geo import grid_region
from regionlake.operators.aggregates import class_counts, mean_by
from regionlake.operators.sizing import Spine
from regionlake.operators.spatial import with_region
from regionlake.sources import documents as D
from regionlake.sources.delimited import renamed, resolve_aliases

SALE_DETAILS = ("nombre_pieces_principales", "longitude", "latitude")


def sales(raw: DataFrame, rules: C.SaleRules = C.SaleRules(), prefix: str = C.POSTAL_PREFIX,
          n_regions: int = C.N_REGIONS) -> DataFrame:
    """Cleaned transactions: territory, sales of dwellings, sane values, unit price in band.

    A region code outside the domain is dropped here, although a prefix test alone
    would let it through.
    """
    kept = raw.where(
        X.has_prefix("code_postal", prefix)
        & (F.col("nature_mutation") == rules.nature)
        & F.col("type_local").isin(*rules.kinds)
    )
    # The generator keeps the parsed numbers as columns: the bands below then compare
    # them instead of parsing the strings again in every pushed-down predicate.
    parsed = F.inline(F.array(F.struct(
        X.number("valeur_fonciere").alias("valeur_fonciere"),
        X.number("surface_reelle_bati").alias("surface_reelle_bati"),
        F.right("code_postal", F.lit(2)).try_cast("int").alias(C.REGION),
    )))
    typed = kept.select("date_mutation", C.YEAR, "type_local", parsed, *SALE_DETAILS)
    return priced(typed, rules).where(F.col(C.REGION).between(1, n_regions)).select(
        X.parsed_date("date_mutation").alias("date_mutation"),
        F.col(C.YEAR).cast("int").alias(C.YEAR),
        C.REGION, "type_local", "valeur_fonciere", "surface_reelle_bati", "prix_m2",
        *[X.number(c).alias(c) for c in SALE_DETAILS],
    )


def priced(df: DataFrame, rules: C.SaleRules = C.SaleRules(), value: str = "valeur_fonciere",
           surface: str = "surface_reelle_bati", out: str = "prix_m2") -> DataFrame:
    """Unit price with the sanity bands; rows without value or surface are dropped."""
    sane = (F.col(surface) > rules.min_surface) & (F.col(value) > rules.min_value)
    return (
        df.where(sane)
        .withColumn(out, X.unit_price(value, surface))
        .where(F.col(out).between(rules.min_unit_price, rules.max_unit_price))
    )


def stops(raw: DataFrame) -> DataFrame:
    """Transport stops inside the territory's box."""
    r = D.records(raw)
    geo_lat = X.first_truthy("geo_point_2d.lat", "geo_point_2d.latitude")
    geo_lon = X.first_truthy("geo_point_2d.lon", "geo_point_2d.longitude")
    own = geo_lat.isNull()
    lat = F.when(own, X.first_truthy("stop_lat", "latitude", "y")).otherwise(geo_lat)
    lon = F.when(own, X.first_truthy("stop_lon", "longitude", "x")).otherwise(geo_lon)
    points = r.select(
        F.coalesce(X.first_filled("nom_long", "stop_name", "nom_arret", "nom"), F.lit("")).alias("nom"),
        lat.try_cast("double").alias("lat"),
        lon.try_cast("double").alias("lon"),
        F.coalesce(X.first_filled("type_transport", "mode"), F.lit("")).alias("type"),
        F.lit(None).cast("int").alias(C.REGION),
    )
    return points.where(X.in_box("lat", "lon"))


def schools(raw: DataFrame, prefix: str = C.POSTAL_PREFIX, n_regions: int = C.N_REGIONS) -> DataFrame:
    """Schools with a valid postal code of the territory."""
    r = D.records(raw)
    code = F.coalesce(X.first_filled("code_postal_uai", "code_postal"), F.lit(""))
    geo = lambda *f: F.coalesce(X.first_truthy(*[f"position.{x}" for x in f]),
                                X.first_truthy(*[f"geo_point_2d.{x}" for x in f]))
    own_lat = X.first_truthy("latitude", "lat")
    lon = F.when(own_lat.isNull(), geo("lon", "longitude")).otherwise(X.first_truthy("longitude", "lon"))
    out = r.select(
        F.coalesce(X.first_filled("nom_etablissement", "appellation_officielle"), F.lit("")).alias("nom"),
        F.coalesce("type_etablissement", F.lit("")).alias("type"),
        code.alias("code_postal"),
        X.region_of_code(code, prefix, n_regions).alias(C.REGION),
        F.coalesce("statut_public_prive", F.lit("")).alias("statut"),
        F.coalesce(own_lat, geo("lat", "latitude")).try_cast("double").alias("lat"),
        lon.try_cast("double").alias("lon"),
    )
    return out.where(F.col(C.REGION).isNotNull())


def parks(raw: DataFrame) -> DataFrame:
    """Green spaces inside the box."""
    return (
        D.elements(raw)
        .select("osm_id", D.tag("name", "Parc sans nom").alias("name"), D.tag("leisure", "park").alias("type"),
                "lat", "lon", F.lit(None).cast("int").alias(C.REGION))
        .where(X.in_box("lat", "lon"))
    )


def security(police: DataFrame | None, fire: DataFrame | None) -> DataFrame | None:
    """Police and fire stations in one table."""
    parts = [
        D.elements(raw, truthy=True).select(
            F.lit(kind).alias("type"), D.tag("name").alias("nom"), "lat", "lon",
            F.lit(None).cast("int").alias(C.REGION),
        )
        for kind, raw in (("commissariats", police), ("pompiers", fire)) if raw is not None
    ]
    if not parts:
        return None
    both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return both.where(X.in_box("lat", "lon", C.SECURITY_BOX))


def crime(raw: DataFrame) -> DataFrame:
    """Recorded offences with the region and a numeric count, whatever the headers."""
    cols = raw.columns
    region = next((c for c in cols if "arr" in c), None)
    place = next((c for c in cols if "dep" in c or "cod" in c), None)
    count = next((c for c in cols if any(w in c for w in ("fait", "nombre", "valeur", "nb"))), cols[-1])
    df = raw
    if region is not None:
        df = df.withColumn("_region", X.first_digits(f"`{region}`"))
    else:
        if place is not None:
            df = df.where(X.has_prefix(f"`{place}`", "75"))
        df = df.withColumn("_region", F.lit(None).cast("int"))
    df = df.withColumn("_faits", F.col(f"`{count}`").try_cast("double"))
    kept = [c for c in cols if c not in (C.REGION, "nb_faits")]
    return df.select(*[F.col(f"`{c}`") for c in kept], F.col("_region").alias(C.REGION),
                     F.col("_faits").alias("nb_faits"))


def social_housing(raw: DataFrame, n_regions: int = C.N_REGIONS) -> DataFrame:
    """Social housing by region; refuses a file without a region column."""
    df = renamed(raw, resolve_aliases(raw.columns, C.SOCIAL_ALIASES, first_alias_wins=True))
    if C.REGION not in df.columns:
        raise ValueError("no region column in the social housing file")
    df = df.withColumn(C.REGION, X.in_domain(X.number(C.REGION).try_cast("int"), n_regions))
    for c in ("part_logements_sociaux_pct", "nb_logements_sociaux"):
        if c in df.columns:
            df = df.withColumn(c, F.col(c).try_cast("double"))
    if C.YEAR in df.columns:
        df = df.withColumn(C.YEAR, F.col(C.YEAR).try_cast("int"))
    return df.where(F.col(C.REGION).isNotNull())


def income(raw: DataFrame, n_regions: int = C.N_REGIONS) -> DataFrame:
    """Income measures of the territory's communes."""
    code = next((c for c in raw.columns if c in C.INCOME_CODE_COLUMNS), None)
    if code is None:
        raise ValueError("no commune code column in the income file")
    mapping = resolve_aliases(raw.columns, C.INCOME_ALIASES)
    df = raw.withColumn("_region", X.region_of_commune(code, n_regions=n_regions))
    measures = [X.number(f"`{c}`").alias(alias) for c, alias in mapping.items()]
    return df.where(F.col("_region").isNotNull()).select(F.col("_region").alias(C.REGION), *measures)


def rents(raw: DataFrame, rules=C.RENT_ALIASES, n_regions: int = C.N_REGIONS) -> DataFrame:
    """Reference rents; ``rules`` maps the file's headers."""
    df = renamed(raw, resolve_aliases(raw.columns, rules))
    if C.REGION in df.columns:
        df = df.withColumn(C.REGION, X.in_domain(X.first_digits(C.REGION), n_regions))
        df = df.where(F.col(C.REGION).isNotNull())
    for c in ("loyer_max_m2", "loyer_min_m2", "loyer_ref_m2"):
        if c in df.columns:
            df = df.withColumn(c, X.first_number(c))
    return df


def air_quality(raw: DataFrame, n_regions: int = C.N_REGIONS) -> DataFrame:
    """Air index by region with its 0..100 score, from a static document or live records."""
    static = D.map_rows(raw).select(C.REGION, "iqa_moyen", "no2_µg_m3", "pm25_µg_m3")
    code = F.coalesce(F.nullif("commune_code", F.lit("")), F.col("insee"))
    live = raw.where(F.col("arrondissements").isNull()).select(
        X.region_of_code(code, C.COMMUNE_PREFIX, n_regions).alias(C.REGION),
        X.first_truthy("indice", "iqa").try_cast("double").alias("iqa_moyen"),
        F.col("no2").try_cast("double").alias("no2_µg_m3"),
        X.first_truthy("pm25", "pm2_5").try_cast("double").alias("pm25_µg_m3"),
    ).where(F.col(C.REGION).isNotNull())
    return with_air_score(static.unionByName(live))


def with_air_score(df: DataFrame, index: str = "iqa_moyen", out: str = "score_air") -> DataFrame:
    return df.withColumn(out, X.round_half_even(X.clip(F.lit(100.0) - F.col(index), 0, 100), 1))


def noise(raw: DataFrame, spine: Spine) -> DataFrame:
    """Noise levels and the inverse 0..10 score for every region of the spine."""
    static = D.map_rows(raw).select(
        C.REGION, "lden_moyen", "lnight", F.col("score_bruit").alias("score_bruit_raw")
    )
    live = raw.where(F.col("arrondissements").isNull()).select(F.explode("records").alias("r")).select(
        X.region_of_code("r.fields.commune_code", C.COMMUNE_PREFIX, spine.size).alias(C.REGION),
        X.first_truthy("r.fields.lden", "r.fields.laeq").try_cast("double").alias("lden_moyen"),
        X.first_truthy("r.fields.lnight", "r.fields.ln").try_cast("double").alias("lnight"),
        F.lit(None).cast("double").alias("score_bruit_raw"),
    )
    means = mean_by(
        static.unionByName(live), [C.REGION],
        {"lden_moyen": "lden_moyen", "lnight": "lnight", "score_bruit_raw": "score_bruit_raw"},
    )
    return noise_scores(means, spine)


def noise_scores(means: DataFrame, spine: Spine) -> DataFrame:
    """Score from the level; from the delivered raw score when no level is known at all."""
    over = Window.partitionBy()  # one row per region
    of = F.struct(F.avg("lden_moyen").over(over).alias("avg"), F.min("lden_moyen").over(over).alias("lo"),
                  F.max("lden_moyen").over(over).alias("hi"), F.count("score_bruit_raw").over(over).alias("raw"))
    filled = F.coalesce("lden_moyen", F.col("_s.avg"))
    score = (
        F.when(F.col("_s.avg").isNotNull(),
               X.round_half_even(X.min_max_score(filled, F.col("_s.lo"), F.col("_s.hi"), inverse=True), 2))
        .when(F.col("_s.raw") > 0, F.coalesce("score_bruit_raw", F.lit(5.0)))
        .otherwise(F.lit(5.0))
    )
    scored = means.withColumn("_s", of).withColumn("score_bruit", score).drop("_s")
    return spine.attach(scored).withColumn("score_bruit", F.coalesce("score_bruit", F.lit(5.0)))


def traffic(raw: DataFrame, spine: Spine) -> DataFrame:
    """Traffic score by region from a static document or live counters."""
    static = D.map_rows(raw).select(C.REGION, "tmja_moyen", "score_circulation")
    live = raw.where(F.col("arrondissements").isNull()).select(F.explode("records").alias("r")).select(
        F.coalesce(*[
            F.nullif(F.trim(F.col(f"r.{f}")).try_cast("int"), F.lit(0))
            for f in ("arrondissement", "arr", "code_arr", "codearr")
        ]).alias(C.REGION),
        X.first_truthy("r.q", "r.debit", "r.tmja", "r.debit_moyen_journalier").try_cast("double").alias("t"),
    )
    counted = live.where(F.col("t").isNotNull() & F.col(C.REGION).between(1, spine.size))
    means = mean_by(counted, [C.REGION], {"tmja_moyen": "t"}).withColumn(
        "score_circulation", F.lit(None).cast("double")
    )
    return traffic_scores(static.unionByName(means), spine)


def traffic_scores(rows: DataFrame, spine: Spine, defaults=C.DEFAULT_TRAFFIC_SCORES) -> DataFrame:
    """Delivered score, else from the flow, else the default table; then neutral."""
    base, over = spine.attach(rows), Window.partitionBy()  # one row per region
    of = F.struct(F.count("score_circulation").over(over).alias("n"), F.median("tmja_moyen").over(over).alias("med"),
                  F.min("tmja_moyen").over(over).alias("lo"), F.max("tmja_moyen").over(over).alias("hi"))
    by_flow = X.round_half_even(
        X.min_max_score(F.coalesce("tmja_moyen", F.col("_s.med")), F.col("_s.lo"), F.col("_s.hi"), inverse=True), 2
    )
    score = (
        F.when(F.col("_s.n") > 0, F.col("score_circulation"))
        .when(F.col("_s.med").isNotNull(), by_flow)
        .otherwise(spine.literal(C.by_region(defaults)))
    )
    scored = base.withColumn("_s", of).withColumn("score_circulation", score)
    return scored.select(
        spine.key,
        X.round_half_even(F.coalesce("score_circulation", F.lit(5.0)), 2).alias("score_circulation"),
        "tmja_moyen",
    )


def located_pois(raw: DataFrame, polygons: DataFrame | None = None) -> DataFrame:
    """Classified points of interest with their region, from polygons or the coarse grid."""
    points = D.elements(raw, truthy=True).select(
        "lat", "lon", X.poi_class(D.tag("shop"), D.tag("amenity")).alias("categorie"), D.tag("name").alias("nom")
    ).where(F.col("categorie").isNotNull() & F.col("lat").isNotNull() & F.col("lon").isNotNull())
    if polygons is not None:
        return with_region(points, polygons)
    return points.withColumn(C.REGION, grid_region("lat", "lon"))


def shops_and_health(shops: DataFrame | None, health: DataFrame | None, spine: Spine,
                     polygons: DataFrame | None = None) -> DataFrame:
    """Counts per class and region for the whole spine, zero where nothing is known."""
    out = spine.df
    names: list[str] = []
    for raw, counted in ((shops, C.SHOP_COUNT_COLUMNS), (health, C.HEALTH_COUNT_COLUMNS)):
        if raw is None:
            continue
        pois = class_counts(located_pois(raw, polygons), "categorie", counted)
        columns = list(counted.values())
        static = D.map_rows(raw).select(
            C.REGION, *[F.col(c.removeprefix("nb_")).alias(c) for c in columns]
        )
        # A document is either a list of elements or a map of counts.
        merged = pois.unionByName(static).groupBy(C.REGION).agg(*[F.sum(c).alias(c) for c in columns])
        out = out.join(merged, C.REGION, "left")
        names += columns
    return out.select(spine.key, *[F.coalesce(c, F.lit(0)).cast("int").alias(c) for c in names])
