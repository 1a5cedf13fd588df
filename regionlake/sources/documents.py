"""JSON envelopes, map-keyed documents, tagged elements and GeoJSON polygons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from regionlake import config as C
from regionlake.functions.cleaning import region_of_mixed, truncated
from regionlake.schemas import GEO, _fields


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Documents under an explicit superset schema; a top-level list gives one row per element."""
    return spark.read.schema(schema).option("multiLine", "true").json(path)


def parse_json(df: DataFrame, column: str, schema: str) -> DataFrame:
    """The same shape from documents held in a string column, lists included."""
    nested = f"array<struct<{', '.join(_fields(schema))}>>"
    is_list = F.startswith(F.ltrim(column), F.lit("["))
    one = F.array(F.from_json(column, schema))
    return df.select(F.inline(F.when(is_list, F.from_json(column, nested)).otherwise(one)))


def records(raw: DataFrame) -> DataFrame:
    """Records of a list, ``results`` or ``records`` envelope."""
    fields = [c for c in raw.columns if c not in ("results", "records")]
    bare = F.array(F.struct(*fields))
    return raw.select(F.inline(F.coalesce("results", "records", bare)))


def map_rows(raw: DataFrame, column: str = "arrondissements", key: str = C.REGION) -> DataFrame:
    """Rows of a ``{region: {measure: value}}`` document."""
    exploded = raw.where(F.col(column).isNotNull()).select(F.explode(column).alias("_k", "_v"))
    return exploded.select(F.col("_k").try_cast("int").alias(key), "_v.*").where(F.col(key).isNotNull())


def elements(raw: DataFrame, truthy: bool = False) -> DataFrame:
    """Tagged elements as points, centre preferred over the node's own coordinate.

    With ``truthy`` a zero coordinate counts as missing, otherwise only null does.
    """
    def pick(axis: str) -> Column:
        centre, own = F.col(f"center.{axis}"), F.col(axis)
        return F.coalesce(F.nullif(centre, F.lit(0.0)), F.nullif(own, F.lit(0.0))) if truthy else F.coalesce(centre, own)

    flat = raw.where(F.col("elements").isNotNull()).select(F.inline("elements"))
    return flat.select(
        F.col("id").alias("osm_id"), pick("lat").alias("lat"), pick("lon").alias("lon"),
        F.coalesce("tags", F.create_map().cast("map<string,string>")).alias("tags"),
    )


def tag(name: str, default: str = "") -> Column:
    return F.coalesce(F.try_element_at("tags", F.lit(name)), F.lit(default))


def read_polygons(spark: SparkSession, path: str) -> DataFrame:
    return polygons(read_json(spark, path, GEO))


def polygons(raw: DataFrame, key: str = C.REGION, n_regions: int = C.N_REGIONS) -> DataFrame:
    """Regions of a FeatureCollection: code, name, area in km² and polygon parts."""
    feature = raw.select(F.inline("features"))
    prop = lambda n: F.try_element_at("properties", F.lit(n))
    text = F.col("geometry.coordinates")
    single = F.array(F.from_json(text, "array<array<array<double>>>"))
    multi = F.from_json(text, "array<array<array<array<double>>>>")
    kind = F.col("geometry.type")
    code = F.coalesce(*[F.nullif(prop(n), F.lit("")) for n in ("c_ar", "c_arinsee", "code", C.REGION)])
    region = region_of_mixed(code, n_regions=n_regions)
    area = F.coalesce(prop("surface"), prop("surface_km2")).try_cast("double")
    return feature.select(
        region.alias(key),
        truncated(F.coalesce(F.nullif(prop("l_ar"), F.lit("")), F.nullif(prop("nom"), F.lit("")),
                             F.concat(region.cast("string"), F.lit("e arrondissement"))), 64).alias("nom"),
        (F.nullif(area, F.lit(0.0)) / F.lit(1_000_000.0)).alias("surface_km2"),
        F.when(kind == "Polygon", single).when(kind == "MultiPolygon", multi).alias("parts"),
    ).where(F.col(key).isNotNull())


def region_dimension(shapes: DataFrame | None, spine, key: str = C.REGION) -> DataFrame:
    """Code, name and area by region; plain numbered names when no polygons landed."""
    if shapes is None:
        return spine.df.select(
            F.col(key).alias("code"),
            F.concat(F.col(key).cast("string"), F.lit("e arrondissement")).alias("nom"),
            F.lit(None).cast("double").alias("surface_km2"),
        ).orderBy("code")
    return shapes.select(F.col(key).alias("code"), "nom", "surface_km2").orderBy("code")
