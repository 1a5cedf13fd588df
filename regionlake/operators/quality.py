"""Anomaly report, constraint checks and expectations."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from regionlake import config as C
from regionlake.operators.joins import missing_members
from regionlake.operators.sizing import Spine, sized
from regionlake.operators.windows import outliers
from regionlake.session import durable


def anomalies(
    gold: DataFrame, spine: Spine, year: str = C.YEAR, low_volume: int = C.LOW_VOLUME,
    critical: tuple[str, ...] = ("prix_m2_median", "nb_transactions"),
) -> DataFrame:
    """Anomalies of the yearly table as (type, severity, detail) rows."""
    key = spine.key
    # Stored once: four checks read the same small yearly table.
    gold = durable(gold.select(key, year, *[c for c in critical if c in gold.columns]))
    parts = []
    gaps = missing_members(gold, spine, year).groupBy(year).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(key)), lambda v: v.cast("string")), ", ").alias("m")
    )
    parts.append(
        _finding(gaps, "arrondissement_manquant", F.lit("warning"),
                 F.concat(F.lit("Année "), F.col(year).cast("string"),
                          F.lit(" : arrondissements absents ["), F.col("m"), F.lit("]")))
    )
    if "prix_m2_median" in gold.columns:
        far = outliers(gold)
        parts.append(
            _finding(far, "prix_aberrant", F.col("severity"),
                     F.concat(_place(key, year), F.lit("prix_m2_median="), _whole("prix_m2_median"),
                              F.lit(" (μ="), _whole("borne_moyenne"),
                              F.lit(", seuil 3σ="), _whole("borne_haute"), F.lit(")")))
        )
    present = [c for c in critical if c in gold.columns]
    if present:
        nulls = gold.agg(
            F.array(*[
                F.struct(F.lit(c).alias("c"), F.count_if(F.col(c).isNull()).alias("n")) for c in present
            ]).alias("a")
        ).select(F.inline("a")).where(F.col("n") > 0)
        parts.append(
            _finding(nulls, "valeur_manquante", F.lit("warning"),
                     F.concat(F.col("n").cast("string"), F.lit(" valeur(s) NaN dans la colonne « "),
                              F.col("c"), F.lit(" »")))
        )
    if "nb_transactions" in gold.columns:
        few = gold.where(F.col("nb_transactions") < low_volume)
        parts.append(
            _finding(few, "volume_faible", F.lit("info"),
                     F.concat(_place(key, year), F.lit("seulement "),
                              F.col("nb_transactions").cast("bigint").cast("string"),
                              F.lit(" transactions")))
        )
    return reduce(DataFrame.unionByName, parts)


def _finding(df: DataFrame, kind: str, severity: Column, detail: Column) -> DataFrame:
    return df.select(F.lit(kind).alias("type"), severity.alias("severity"), detail.alias("detail"))


def _place(key: str, year: str) -> Column:
    return F.concat(F.lit("Arr."), F.col(key).cast("int").cast("string"), F.lit(" "),
                    F.col(year).cast("int").cast("string"), F.lit(" : "))


def _whole(c: str) -> Column:
    return F.rint(F.col(c)).cast("bigint").cast("string")


@dataclass(frozen=True)
class Check:
    """A row predicate that must not be false; null passes, as in a CHECK constraint."""

    name: str
    holds: Column


@dataclass(frozen=True)
class Unique:
    name: str
    keys: tuple[str, ...]


@dataclass(frozen=True)
class Reference:
    """Every non-null key of the table occurs in the parent."""

    name: str
    column: str
    parent: DataFrame
    parent_column: str


def check_report(df: DataFrame, rules: list) -> DataFrame:
    """One row per rule: rows that break it and whether it holds.

    All predicates and references share one pass: the parent's distinct keys, broadcast only
    after a size check, are joined as a flag. A uniqueness rule counts keys with more than one
    row through a partial aggregate of its own.
    """
    parts = []
    checks = [r for r in rules if isinstance(r, Check)]
    rows = df
    for i, r in enumerate(r for r in rules if isinstance(r, Reference)):
        found = f"_parent_{i}"
        keys = r.parent.select(F.col(r.parent_column).alias(found)).where(F.col(found).isNotNull()).distinct()
        rows = rows.join(sized(keys).hinted(), F.col(r.column) == F.col(found), "left")
        checks.append(Check(r.name, F.col(r.column).isNull() | F.col(found).isNotNull()))
    if checks:
        counts = [
            F.struct(F.lit(r.name).alias("regle"), F.count_if(~r.holds).alias("violations")) for r in checks
        ]
        parts.append(rows.agg(F.array(*counts).alias("a")).select(F.inline("a")))
    for r in rules:
        if isinstance(r, Unique):
            repeated = df.groupBy(*r.keys).agg(F.count(F.lit(1)).alias("n"))
            parts.append(repeated.agg(F.count_if(F.col("n") > 1).alias("violations"))
                         .select(F.lit(r.name).alias("regle"), "violations"))
    report = reduce(DataFrame.unionByName, parts)
    return report.withColumn("valide", F.col("violations") == 0)


def region_checks(key: str = "code", n_regions: int = C.N_REGIONS) -> list:
    return [Check(f"ck_{key}_domaine", F.col(key).between(1, n_regions)), Unique(f"pk_{key}", (key,))]


def price_checks(dimension: DataFrame, key: str = C.REGION, year: str = C.YEAR, dim_key: str = C.REGION) -> list:
    return [
        Check("ck_annee", F.col(year) >= 2000),
        Check("ck_prix_positif", F.col("prix_m2_median") > 0),
        Unique("pk_region_annee", (key, year)),
        Reference("fk_region", key, dimension, dim_key),
    ]


def sale_checks(dimension: DataFrame, key: str = C.REGION, year: str = C.YEAR, dim_key: str = C.REGION) -> list:
    return [
        Check("ck_annee", F.col(year) >= 2000),
        Check("ck_prix_positif", F.col("prix_m2") > 0),
        Check("nn_date", F.col("date_mutation").isNotNull()),
        Reference("fk_region", key, dimension, dim_key),
    ]


def social_checks(key: str = C.REGION, year: str = C.YEAR) -> list:
    return [
        Check("ck_annee", F.col(year) >= 2000),
        Check("ck_part", F.col("part_logements_sociaux_pct").between(0, 100)),
        Unique("pk_region_annee", (key, year)),
    ]


def indicator_checks(key: str = C.REGION, year: str = C.YEAR) -> list:
    return [Unique("uq_region_nom_annee", (key, "nom", year))]


def sale_expectations(spine: Spine, key: str = C.REGION, year: str = C.YEAR,
                      years: tuple[int, int] = (2015, 2025)) -> list:
    return [
        Check("prix_positifs", F.col("prix_m2") > 0),
        Check("prix_plausibles", F.coalesce(F.col("prix_m2").between(500, 60000), F.lit(False))),
        Check("surface_positive", F.col("surface_reelle_bati") > 0),
        Check("annees_plausibles", F.coalesce(F.col(year).between(*years), F.lit(False))),
        Reference("regions_valides", key, spine.df, spine.key),
    ]


def score_expectations(columns: list[str]) -> list:
    return [
        Check(f"{c}_0_10", F.coalesce(F.col(c).between(0, 10), F.lit(False)))
        for c in columns if c.startswith("score_")
    ]


def yearly_expectations(key: str = C.REGION, year: str = C.YEAR) -> list:
    return [
        Check("cle_region", F.col(key).isNotNull()),
        Check("cle_annee", F.col(year).isNotNull()),
        Check("variation_bornee", F.col("prix_m2_variation_pct").between(-50, 100)),
    ]


def coverage(df: DataFrame, spine: Spine, year: str = C.YEAR) -> DataFrame:
    """One row: regions of the spine without any row, and distinct years."""
    absent = spine.df.join(df.select(spine.key).distinct(), spine.key, "left_anti")
    missing = absent.agg(F.count(F.lit(1)).alias("n")).scalar()
    return df.agg(F.count_distinct(year).alias("annees")).withColumn("regions_absentes", missing)
