"""Catalog and freshness of landed files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from regionlake import config as C


def source_summary(inventory: DataFrame, source: str = "source") -> DataFrame:
    """Files, bytes, newest landing, formats and an example path per source."""
    return inventory.groupBy(source).agg(
        F.count(F.lit(1)).alias("nb_fichiers"),
        F.sum("size_bytes").alias("taille_totale_bytes"),
        F.max("ingested_at").alias("derniere_ingestion"),
        F.array_sort(F.collect_set("format")).alias("formats"),
        F.min("path").alias("exemple_chemin"),
    )


def whole_days(newest: str, as_of: Column) -> Column:
    """Whole days elapsed; null without a landing time."""
    elapsed = F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(F.col(newest).cast("timestamp"))
    return F.floor(elapsed / F.lit(86_400_000_000)).cast("int")


def catalog_entries(spark: SparkSession) -> DataFrame:
    """The default label table of known sources."""
    return spark.createDataFrame(
        list(C.CATALOG_ENTRIES), "source string, libelle string, fournisseur string, description string"
    )


def catalog(inventory: DataFrame, entries: DataFrame, as_of: Column) -> DataFrame:
    """Catalog rows with labels, freshness and completeness, ordered by source."""
    joined = source_summary(inventory).join(entries, "source", "left")
    return joined.select(
        "source",
        F.coalesce("libelle", "source").alias("libelle"),
        F.coalesce("fournisseur", F.lit(C.UNKNOWN_PROVIDER)).alias("fournisseur"),
        F.coalesce("description", F.lit("")).alias("description"),
        "nb_fichiers", "taille_totale_bytes", "derniere_ingestion", "formats", "exemple_chemin",
        whole_days("derniere_ingestion", as_of).alias("fraicheur_jours"),
        (F.col("nb_fichiers") > 0).alias("complet"),
    ).orderBy("source")
