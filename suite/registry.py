"""Query registry and SQL fragments shared by the oracle texts."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under a name, with its SQL text if there is one."""

    def keep(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return keep


def half_even(expr: str, digits: int = 0) -> str:
    """SQL for scale, nearest-even, unscale."""
    y = f"(({expr})::DOUBLE * 1e{digits})"
    return f"((CASE WHEN {y} - floor({y}) = 0.5 THEN 2 * round({y} / 2) ELSE round({y}) END) / 1e{digits})"


def min_max(expr: str, lo: str, hi: str, inverse: bool = False) -> str:
    """SQL for the 0..10 score with two decimals."""
    place = f"(({expr}) - ({lo})) / (({hi}) - ({lo})) * 1e1"
    if inverse:
        place = f"1e1 - {place}"
    return f"(CASE WHEN ({lo}) = ({hi}) THEN 5e0 ELSE {half_even(place, 2)} END)"


def with_(*names: str) -> str:
    """``WITH`` clause of the named fragments and everything they read."""
    order: list[str] = []

    def add(n: str) -> None:
        for d in FRAGMENTS[n][0]:
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    return "WITH " + ",\n".join(f'"{n}" AS ({FRAGMENTS[n][1]})' for n in order) + "\n"


# 24 h mean; both sides are compared to eight decimals, as this sum is of doubles.
ROLLING = "round(avg(iqa) OVER w, 8)"
ROLLING_WINDOW = """WINDOW w AS (PARTITION BY arrondissement ORDER BY ingested_at
           RANGE BETWEEN INTERVAL 24 HOURS PRECEDING AND CURRENT ROW)"""

N = 25

FRAGMENTS: dict[str, tuple[tuple[str, ...], str]] = {
    "spine": ((), "SELECT n_nationkey + 1 AS arrondissement FROM nation"),
    "raw_sales": ((), """
        SELECT l.l_orderkey * 16 + l.l_linenumber AS id, c.c_nationkey + 1 AS arrondissement, c.c_custkey,
               CAST(year(o.o_orderdate) AS INT) AS annee, CAST(o.o_orderdate AS DATE) AS date_mutation,
               CASE o.o_orderstatus WHEN 'F' THEN 'Vente' WHEN 'O' THEN 'Echange' ELSE 'Adjudication' END AS nature_mutation,
               CASE l.l_returnflag WHEN 'A' THEN 'Appartement' WHEN 'R' THEN 'Maison' ELSE 'Local' END AS type_local,
               l.l_extendedprice AS valeur_fonciere, l.l_quantity AS surface_reelle_bati,
               (22500 + c.c_custkey * 7919 % 1700) / 1e4 AS longitude,
               (488000 + c.c_custkey * 104729 % 1200) / 1e4 AS latitude,
               l.l_partkey, l.l_linenumber
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey"""),
    "priced": (("raw_sales",), """
        SELECT *, valeur_fonciere / surface_reelle_bati AS prix_m2 FROM raw_sales
        WHERE surface_reelle_bati > 5 AND valeur_fonciere > 1000
          AND valeur_fonciere / surface_reelle_bati BETWEEN 1000 AND 50000"""),
    "sales": (("priced",), """
        SELECT * FROM priced WHERE nature_mutation = 'Vente' AND type_local IN ('Appartement', 'Maison')"""),
    "stats": (("sales",), f"""
        SELECT arrondissement, annee, {half_even('median(prix_m2)')} AS prix_m2_median,
               {half_even('avg(prix_m2)')} AS prix_m2_moyen, count(prix_m2) AS nb_transactions,
               median(surface_reelle_bati) AS surface_mediane,
               count(*) FILTER (WHERE type_local = 'Appartement') AS "Appartement",
               count(*) FILTER (WHERE type_local = 'Maison') AS "Maison"
        FROM sales GROUP BY 1, 2"""),
    "prices": (("stats",), f"""
        SELECT *, {half_even('(prix_m2_median / lag(prix_m2_median) OVER (PARTITION BY arrondissement ORDER BY annee) - 1e0) * 1e2', 1)}
               AS prix_m2_variation_pct FROM stats"""),
    "customers": ((), """
        SELECT c_custkey, c_nationkey + 1 AS arrondissement, c_mktsegment, c_acctbal,
               (22500 + c_custkey * 7919 % 1700) / 1e4 AS lon, (488000 + c_custkey * 104729 % 1200) / 1e4 AS lat
        FROM customer"""),
    "readings": ((), """
        SELECT event_id, CAST(user_id % 20 + 1 AS INT) AS arrondissement, value AS iqa, ts AS ingested_at,
               event_type AS source, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS no2,
               CAST(json_extract_string(props, '$.k') AS DOUBLE) / 2e0 AS pm25,
               CASE WHEN value > 100 THEN 'rouge' WHEN value > 75 THEN 'orange' END AS alert_level
        FROM events"""),
}
