"""Coverage joins, comparison and missing members."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from regionlake import config as C
from regionlake.operators.sizing import Spine
from regionlake.operators.windows import keep_first


def attach_all(spine: Spine, tables: list[DataFrame]) -> DataFrame:
    """Chain of left joins of one-row-per-region tables onto the spine."""
    out = spine.df
    for t in tables:
        out = out.join(t, spine.key, "left")
    return out


def with_region_values(facts: DataFrame, table: DataFrame | None, columns: list[str], spine: Spine,
                       order: list[str] | None = None) -> DataFrame:
    """Repeat one value per region on every (region, year) row.

    The table is reduced to its first row per region of the spine, so it cannot
    multiply the facts and its size is bounded by the spine. Columns the facts
    already have are kept as they are.
    """
    if table is None:
        return facts
    new = [c for c in columns if c in table.columns and c not in facts.columns]
    if not new:
        return facts
    first = keep_first(table.select(spine.key, *new), [spine.key], order or new)
    return facts.join(spine.hinted(spine.members(first)), spine.key, "left")


def with_year_values(facts: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on a composite key such as (region, year)."""
    return facts.join(table, keys, "left")


def missing_members(facts: DataFrame, spine: Spine, year: str = C.YEAR) -> DataFrame:
    """(region, year) pairs of the spine that the facts lack, for every year present.

    The distinct years arrive as one array, so the expected set is an explode of the
    spine rather than a product of two tables.
    """
    years = facts.agg(F.array_sort(F.collect_set(year)).alias("y")).scalar()
    expected = spine.df.select(spine.key, F.explode(years).alias(year))
    return expected.join(facts.select(spine.key, year).distinct(), [spine.key, year], "left_anti")


# Compared measure -> is a lower value better? Parts of the safety score
# are shown without a winner.
COMPARED = (
    ("prix_m2_median", True, True),
    ("nb_transactions", False, True),
    ("part_logements_sociaux_pct", False, True),
    ("score_accessibilite", False, True),
    ("score_qualite_vie", False, True),
    ("score_securite", False, True),
    ("nb_faits", True, False),
    ("nb_commissariats", False, False),
    ("nb_casernes", False, False),
    ("score_global", False, True),
)


def versus(prices: DataFrame, indicators: DataFrame, a: int, b: int, key: str = C.REGION,
           measures=COMPARED) -> DataFrame:
    """One row per measure with both regions' values and which one is better."""
    merged = (
        prices.where(F.col(key).isin(a, b))
        .join(indicators.where(F.col(key).isin(a, b)), key, "full")
    )
    present = [m for m in measures if m[0] in merged.columns]

    def side(name: str, region: int) -> Column:
        return F.max(F.when(F.col(key) == region, F.col(name).cast("double")))

    rows = [
        F.struct(
            F.lit(i).alias("ordre"),
            F.lit(name).alias("mesure"),
            side(name, a).alias("valeur_1"),
            side(name, b).alias("valeur_2"),
            F.lit(lower).alias("plus_bas_mieux"),
            F.lit(judged).alias("compare"),
        )
        for i, (name, lower, judged) in enumerate(present, start=1)
    ]
    table = merged.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))
    first_better = F.when(F.col("plus_bas_mieux"), F.col("valeur_1") < F.col("valeur_2")).otherwise(
        F.col("valeur_1") > F.col("valeur_2")
    )
    second_better = F.when(F.col("plus_bas_mieux"), F.col("valeur_2") < F.col("valeur_1")).otherwise(
        F.col("valeur_2") > F.col("valeur_1")
    )
    winner = F.when(
        F.col("compare"), F.when(first_better, F.lit(a)).when(second_better, F.lit(b))
    )
    return table.select("ordre", "mesure", "valeur_1", "valeur_2", winner.alias("meilleur"))
