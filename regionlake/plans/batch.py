"""The nightly run: steps, anomalies, statistics and the report."""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from regionlake import config as C
from regionlake.functions.cleaning import address, truncated
from regionlake.operators import catalog as K
from regionlake.operators.aggregates import lake_statistics
from regionlake.operators.quality import anomalies
from regionlake.operators.reshape import first_rows
from regionlake.operators.sizing import Spine
from regionlake.plans import gold, silver
from regionlake.schemas import AIR, ELEMENTS, HEALTH, NOISE, SCHOOL, SHOPS, STOP, TRAFFIC, envelope
from regionlake.sources import delimited, documents, sinks
from regionlake.sources.files import counted, exists, inventory, lake_health, optional_parquet

# Anomalies that a report repeats; the table beside it has all.
REPORTED = 1000
STEPS = ("batch_id string, etape string, libelle string, statut string, lignes bigint, violations map<string, bigint>, "
         "duree_s double, erreur string")


def run_steps(steps: list[tuple[str, str, Callable[[], bool | dict]]]) -> dict:
    """Run the steps in order; one that fails is recorded and the later ones still run.

    A step returns whether it had all it needs, or what a write observed: rows and violations.
    """
    results = {}
    for name, label, step in steps:
        started = time.time()
        entry = {"label": label}
        try:
            done = step()
            entry["status"] = "ok" if done else "partial"
            entry |= done if isinstance(done, dict) else {}
        except Exception as problem:
            entry["status"], entry["error"] = "error", str(problem)
        entry["duration_s"] = round(time.time() - started, 2)
        results[name] = entry
    return results


def overall_status(results: dict) -> str:
    states = {r["status"] for r in results.values()}
    return "error" if "error" in states else "partial" if "partial" in states else "success"


def step_rows(spark: SparkSession, batch_id: str, results: dict) -> DataFrame:
    """The run's steps as a table, one row a step."""
    return spark.createDataFrame([
        (batch_id, name, r["label"], r["status"], r.get("rows"), r.get("violations"), r.get("duration_s"), r.get("error"))
        for name, r in results.items()], STEPS)


def transactions(sales: DataFrame, spine: Spine, max_rows: int | None = None) -> DataFrame:
    """Rows of the relational sales table; the first ``max_rows`` by date and region only where the caller asks for so many."""
    have = sales.columns
    part = lambda c: F.col(c) if c in have else F.lit(None).cast("string")
    place = F.concat(F.lit("SRID=4326;POINT("), F.col("longitude").cast("string"), F.lit(" "), F.col("latitude").cast("string"), F.lit(")"))
    rows = sales.where(F.col(spine.key).between(1, spine.size) & F.col("date_mutation").isNotNull()).select(
        F.col(spine.key).alias("arrondissement_code"), "date_mutation", F.year("date_mutation").alias(C.YEAR), "valeur_fonciere",
        "surface_reelle_bati", "prix_m2", truncated("type_local", 32).alias("type_local"),
        F.col("nombre_pieces_principales").cast("int").alias("nb_pieces"),
        address(part("adresse_numero"), part("adresse_nom_voie")).alias("adresse"), place.alias("geom_point"))
    return first_rows(rows, ["date_mutation", "arrondissement_code", "valeur_fonciere", "surface_reelle_bati"], max_rows)


class Lake:
    """Paths of one bronze / silver / gold tree, and the steps that fill it."""

    def __init__(self, spark: SparkSession, root: str, spine: Spine | None = None, years=C.YEARS):
        self.spark, self.root, self.years = spark, root.rstrip("/"), years
        self.spine = spine or Spine.numbered(spark)

    def bronze(self, name: str) -> str:
        return f"{self.root}/bronze/{name}"

    def silver_path(self, name: str) -> str:
        return f"{self.root}/silver/{name}.parquet"

    def gold_path(self, name: str) -> str:
        return f"{self.root}/gold/{name}.parquet"

    def silver(self, name: str) -> DataFrame | None:
        return optional_parquet(self.spark, self.silver_path(name))

    def gold(self, name: str) -> DataFrame | None:
        return optional_parquet(self.spark, self.gold_path(name))

    def document(self, name: str, schema: str) -> DataFrame | None:
        path = self.bronze(name)
        return documents.read_json(self.spark, path, schema) if exists(self.spark, path) else None

    def delimited(self, name: str, **options) -> DataFrame | None:
        path = self.bronze(name)
        return delimited.read_delimited(self.spark, path, **options) if exists(self.spark, path) else None

    def polygons(self) -> DataFrame | None:
        path = self.bronze("geo_arrondissements.geojson")
        return documents.read_polygons(self.spark, path) if exists(self.spark, path) else None

    def _store(self, df: DataFrame | None, name: str, rules: dict | None = None) -> dict | bool:
        """Write a silver table; its rows, and those that break a rule, are counted by the write."""
        if df is None:
            return False
        return sinks.observed(df, lambda rows: sinks.reload_table(rows, self.silver_path(name)), rules)

    def _gold(self, df: DataFrame, name: str, rules: dict | None = None) -> dict:
        return sinks.observed(df, lambda rows: sinks.reload_table(rows, self.gold_path(name)), rules)

    # Silver steps.

    def sales(self) -> dict | bool:
        spread = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        raw = delimited.read_sales(self.spark, self.bronze("dvf"), self.years, partitions=spread)
        if raw is None:
            return False
        rules = {"prix_positifs": F.col("prix_m2") > 0, "dates": F.col("date_mutation").isNotNull()}
        sales = silver.sales(raw, n_regions=self.spine.size)
        return sinks.observed(sales, lambda rows: sinks.write_yearly(rows, self.silver_path("dvf")), rules)

    def points(self) -> dict | bool:
        """Stops, schools, parks, stations and offences; regions come from the polygons."""
        from regionlake.operators.spatial import enriched

        shapes = self.polygons()
        stops = self.document("transports_idf_arrets.json", envelope(STOP))
        schools = self.document("education_paris.json", envelope(SCHOOL))
        parks = self.document("parcs_paris_osm.json", ELEMENTS)
        police = self.document("commissariats_paris.json", ELEMENTS)
        fire = self.document("pompiers_paris.json", ELEMENTS)
        crime = self.delimited("criminalite_paris.csv", min_columns=3)
        located = {
            "transports": None if stops is None else silver.stops(stops),
            "parcs": None if parks is None else silver.parks(parks),
            "securite_urbaine": silver.security(police, fire),
        }
        done = [
            self._store(None if t is None else enriched(t, shapes), name) for name, t in located.items()
        ]
        done.append(self._store(None if schools is None else silver.schools(schools, n_regions=self.spine.size),
                                "education"))
        done.append(self._store(None if crime is None else silver.crime(crime), "criminalite"))
        if not all(done) or shapes is None:
            return False
        return {"rows": sum(d["rows"] for d in done), "violations": {}}

    def social(self) -> dict | bool:
        raw = self.delimited("logements_sociaux_paris.csv", min_columns=3, strict=True)
        return self._store(None if raw is None else silver.social_housing(raw, self.spine.size), "logements_sociaux")

    def rents(self) -> dict | bool:
        raw = self.delimited("loyers_reference_paris.csv", underscores=True)
        return self._store(None if raw is None else silver.rents(raw, n_regions=self.spine.size), "loyers")

    def income(self) -> dict | bool:
        raw = self.delimited("revenus_insee_paris.csv")
        return self._store(None if raw is None else silver.income(raw, self.spine.size), "revenus")

    def air(self) -> dict | bool:
        raw = self.document("qualite_air_paris.json", AIR)
        return self._store(None if raw is None else silver.air_quality(raw, self.spine.size), "qualite_air")

    def shops(self) -> dict | bool:
        shops = self.document("commerces_paris.json", SHOPS)
        health = self.document("sante_paris.json", HEALTH)
        return self._store(silver.shops_and_health(shops, health, self.spine, self.polygons()), "commerces_sante")

    def noise(self) -> dict | bool:
        raw = self.document("bruit_paris.json", NOISE)
        return self._store(None if raw is None else silver.noise(raw, self.spine), "bruit")

    def traffic(self) -> dict | bool:
        raw = self.document("circulation_paris.json", TRAFFIC)
        return self._store(None if raw is None else silver.traffic(raw, self.spine), "circulation")

    # Gold steps.

    def prices(self) -> dict | bool:
        sales = self.silver("dvf")
        if sales is None:
            return False
        return self._gold(gold.yearly_prices(sales), "agregats_arrondissements", {"cle": F.col(self.spine.key).isNotNull()})

    def scores(self) -> dict | bool:
        s = self.silver
        table = gold.indicators(
            gold.access_scores(s("transports"), s("education"), s("commerces_sante"), self.spine),
            gold.life_scores(s("parcs"), s("qualite_air"), s("bruit"), s("circulation"), self.spine),
            gold.safety_scores(s("criminalite"), s("securite_urbaine"), self.spine),
            gold.housing_scores(self.gold("agregats_arrondissements"), s("revenus"), s("loyers"), self.spine),
            self.spine.key,
        )
        return self._gold(table, "indicateurs_custom", {c: F.coalesce(F.col(c).between(0, 10), F.lit(False)) for c in gold.SCORES})

    def final(self) -> dict | bool:
        prices = self.gold("agregats_arrondissements")
        if prices is None:
            return False
        s = self.silver
        table = gold.final_table(prices, self.spine, s("logements_sociaux"), s("revenus"), s("loyers"),
                                 s("qualite_air"), self.gold("indicateurs_custom"))
        return self._gold(table, "gold_final", {
            "cle": F.col(self.spine.key).isNotNull() & F.col(C.YEAR).isNotNull(), "variation": F.col("prix_m2_variation_pct").between(-50, 100)})

    def steps(self) -> list[tuple[str, str, Callable[[], bool]]]:
        return [
            ("silver_dvf", "sales", self.sales),
            ("silver_sources", "points of interest and offences", self.points),
            ("silver_logements", "social housing", self.social),
            ("silver_loyers", "reference rents", self.rents),
            ("silver_revenus", "income", self.income),
            ("silver_qualite_air", "air quality", self.air),
            ("silver_commerces_sante", "shops and health", self.shops),
            ("silver_bruit", "noise", self.noise),
            ("silver_circulation", "traffic", self.traffic),
            ("gold_agregats", "yearly prices", self.prices),
            ("gold_indicateurs", "scores", self.scores),
            ("gold_final", "final table", self.final),
        ]

    def run(self, dry_run: bool = False, load: Callable[[DataFrame], dict] | None = None) -> dict:
        """Run every step, then report status, statistics, anomalies and the load."""
        started, begun = time.time(), datetime.now(timezone.utc)
        batch_id = begun.strftime("%Y%m%d_%H%M%S_%f")
        results = run_steps(self.steps())
        table = self.gold("gold_final")
        found, n_found, stats = [], 0, self.file_counts()
        if table is not None:
            place = f"{self.root}/gold/anomalies"
            # Every run's anomalies are a partition of their own.
            n_found = sinks.observed(anomalies(table, self.spine).withColumn("batch_id", F.lit(batch_id)),
                                     lambda rows: sinks.write_batch(rows, place))["rows"]
            if n_found:
                kept = self.spark.read.parquet(place).where(F.col("batch_id") == batch_id).drop("batch_id")
                found = [r.asDict() for r in kept.orderBy("severity", "type", "detail").limit(REPORTED).collect()]
            stats |= lake_statistics(table, self.spine.key).first().asDict()
        loaded = {"status": "skipped_dry_run", "rows_updated": {}}
        if not dry_run:
            loaded = self._load(table, load)
        report = {
            "batch_id": batch_id,
            "start_time": begun.isoformat(),
            "end_time": datetime.now(timezone.utc).isoformat(),
            "duration_seconds": round(time.time() - started, 2),
            "status": overall_status(results),
            "dry_run": dry_run,
            "steps": results,
            "stats": stats,
            "load": loaded,
            "anomalies": found,
            "anomalies_count": n_found,
            "errors_count": sum(r["status"] == "error" for r in results.values()),
        }
        sinks.append_events(step_rows(self.spark, batch_id, results).coalesce(1), f"{self.root}/gold/batch_steps")
        self._write_report(report)
        return report

    def file_counts(self) -> dict:
        return {"dvf_bronze_files": counted(self.spark, self.bronze("dvf/*.csv.gz")),
                "dvf_silver_files": counted(self.spark, f"{self.silver_path('dvf')}/{C.YEAR}=*")}

    # Care of the lake, beside the nightly run.

    def load_inventory(self, as_of=None) -> DataFrame:
        """List what has landed, one row a file, replacing the rows of files listed before."""
        files = inventory(self.spark, f"{self.root}/bronze", as_of)
        return sinks.upsert_partitions(files, f"{self.root}/gold/inventaire", ["source", "path"], "source")

    def load_catalog(self, as_of) -> DataFrame:
        """One row per source of the inventory with its label and freshness."""
        files = self.spark.read.parquet(f"{self.root}/gold/inventaire")
        entries = K.catalog(files, K.catalog_entries(self.spark), F.lit(as_of).cast("timestamp"))
        sinks.reload_table(entries, f"{self.root}/gold/catalogue")
        return self.spark.read.parquet(f"{self.root}/gold/catalogue")

    def health(self) -> DataFrame:
        """State of every table that the run should leave."""
        silver_names = ["transports", "education", "parcs", "securite_urbaine", "criminalite", "logements_sociaux", "loyers", "revenus",
                        "qualite_air", "commerces_sante", "bruit", "circulation", "dvf"]
        gold_names = ["agregats_arrondissements", "indicateurs_custom", "gold_final"]
        bronze_names = [source for source, *_ in C.CATALOG_ENTRIES]
        return lake_health(self.spark, [("bronze", n, self.bronze(n)) for n in bronze_names]
                           + [("silver", n, self.silver_path(n)) for n in silver_names] + [("gold", n, self.gold_path(n)) for n in gold_names])

    def retire_events(self, as_of, days: int = C.RETENTION_DAYS) -> list[str]:
        """Drop stored events of days past the retention."""
        return sinks.drop_expired(self.spark, f"{self.root}/gold/evenements", as_of, days)

    def steps_of(self, batch_id: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/gold/batch_steps").where(F.col("batch_id") == batch_id)

    def _load(self, table: DataFrame | None, load) -> dict:
        if table is None:
            return {"status": "error: gold_final missing", "rows_updated": {}}
        try:
            return {"status": "ok", "rows_updated": (load or self.load_gold)(table)}
        except Exception as problem:
            return {"status": f"error: {problem}", "rows_updated": {}}

    def load_gold(self, table: DataFrame) -> dict:
        """Keyed upserts of the relational gold tables."""
        from regionlake.operators.reshape import long_indicators
        from regionlake.operators.windows import keep_first
        from regionlake.plans.serving import PRICE_COLUMNS

        key, year = self.spine.key, C.YEAR
        base = f"{self.root}/gold/relational"
        counts = {}

        def put(name: str, df: DataFrame, pk: list[str], by: str | None = None) -> None:
            counts[name] = sinks.upsert_partitions(df, f"{base}/{name}", pk, by).count()

        put("arrondissement", documents.region_dimension(self.polygons(), self.spine, key), ["code"])
        put("prix_median", table.select(key, year, *PRICE_COLUMNS), [key, year], year)
        social = [c for c in ("nb_logements_sociaux", "part_logements_sociaux_pct") if c in table.columns]
        if social:
            rows = table.select(key, year, *social).where(F.col(key).isNotNull() & F.col(year).isNotNull())
            put("logement_social", keep_first(rows, [key, year], social), [key, year], year)
        scores = self.gold("indicateurs_custom")
        if scores is not None:
            put("indicateur", long_indicators(scores, key), [key, "nom", year])
        sales = self.silver("dvf")
        if sales is not None:
            rows = transactions(sales, self.spine)
            counts["transaction"] = sinks.observed(rows, lambda r: sinks.reload_table(r, f"{base}/transaction"))["rows"]
        return counts

    def _write_report(self, report: dict) -> None:
        line = json.dumps(report, ensure_ascii=False, default=str)
        frame = self.spark.createDataFrame(
            [(report["batch_id"], report["start_time"], report["status"], line)],
            "batch_id string, start_time string, status string, report string",
        )
        sinks.append_events(frame, f"{self.root}/gold/batch_reports")

    def last_run(self) -> dict:
        """The newest report, or status ``never_run``."""
        path = f"{self.root}/gold/batch_reports"
        if not exists(self.spark, path):
            return {"status": "never_run"}
        newest = self.spark.read.parquet(path).orderBy(F.col("start_time").desc()).first()
        return json.loads(newest["report"]) if newest else {"status": "never_run"}
