"""Path checks, optional tables, file inventory and lake health."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from regionlake.session import durable, settings

LISTERS = 2  # tasks of a folder listing for each core


def _hadoop_path(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    """Does a file, folder or glob match anything?"""
    target, fs = _hadoop_path(spark, path)
    found = fs.globStatus(target)
    return found is not None and len(found) > 0


def size_bytes(spark: SparkSession, path: str) -> int:
    target, fs = _hadoop_path(spark, path)
    return int(fs.getContentSummary(target).getLength())


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder; one that is not there is no error."""
    target, fs = _hadoop_path(spark, path)
    fs.delete(target, True)


def optional_parquet(spark: SparkSession, path: str) -> DataFrame | None:
    """The table, or None when it was never produced, so that a run can go on without it."""
    return spark.read.parquet(path) if exists(spark, path) else None


def inventory(spark: SparkSession, root: str, as_of=None) -> DataFrame:
    """One row per landed .json, .geojson or .csv file: size, SHA-256, kind and a sample.

    Each file is read and hashed inside the task that lists it; JSON payloads are kept. Spark's scan leaves out files of
    zero bytes.
    """
    target, fs = _hadoop_path(spark, root)
    base = fs.getFileStatus(target).getPath().toString().rstrip("/")
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option(
        "pathGlobFilter", "*.{[jJ][sS][oO][nN],[cC][sS][vV],[gG][eE][oO][jJ][sS][oO][nN]}")
    # A task lists many folders: by default each folder is a task of its own.
    with settings(spark, spark__sql__sources__parallelPartitionDiscovery__parallelism=LISTERS * spark.sparkContext.defaultParallelism):
        landed = reader.load(root)
    files = (
        landed
        .withColumn("path", F.substr(F.col("path"), F.lit(len(base) + 2)))
        .withColumn("format", F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)))
        .where(F.col("format").isin("json", "csv", "geojson"))
        .where(~F.regexp_extract("path", r"([^/]+)$", 1).startswith("."))
    )
    return described(files.select(
        "path", "format", F.col("length").alias("size_bytes"), "content",
        (F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")).alias("ingested_at"),
    ))


def described(files: DataFrame, payload_limit: int | None = None, sample_rows: int | None = None) -> DataFrame:
    """Checksum, kind, columns, sample and error of files given as (path, format, size_bytes, content, ingested_at).

    JSON is parsed once, into a VARIANT, whatever its shape. A file that does not parse is listed with ``error`` and without
    payload or sample. Payloads are kept and rows counted in full unless the caller sets a limit.
    """
    kept = F.lit(True) if payload_limit is None else F.col("size_bytes") < payload_limit
    rows = F.size("_lines") - 1
    rows = rows if sample_rows is None else F.least(rows, F.lit(sample_rows))
    text = F.make_valid_utf8(F.col("content").cast("string"))
    is_json, is_csv = F.col("format").isin("json", "geojson"), F.col("format") == "csv"
    lines = F.filter(F.split(F.regexp_replace("_text", "\r", ""), "\n"), lambda x: x != "")
    header = F.get("_lines", F.lit(0))
    comma = F.size(F.split(header, ",")) > F.size(F.split(header, ";"))
    columns = F.when(comma, F.split(header, ",")).otherwise(F.split(header, ";"))
    as_list = lambda path: F.try_variant_get("_json", path, "array<variant>")
    checked = (
        files.withColumn("checksum", F.sha2("content", 256))
        .withColumn("_text", text)
        .withColumn("_json", F.when(is_json, F.try_parse_json("_text")))
        .withColumn("_features", as_list("$.features"))
        .withColumn("_items", as_list("$"))
        .withColumn("_lines", F.when(is_csv, lines))
    )
    readable = F.col("_json").isNotNull()
    sample = lambda c, n: F.transform(F.slice(c, 1, n), lambda v: F.to_json(v))
    return checked.select(
        F.regexp_extract("path", r"^([^/]+)", 1).alias("source"),
        "path", "format", "size_bytes", "checksum", "ingested_at",
        F.when(F.col("_features").isNotNull(), F.lit("geojson")).when(readable, F.lit("json")).when(is_csv, F.lit("csv")).alias("payload_kind"),
        F.size("_features").alias("nb_features"),
        F.when(readable & F.col("_features").isNull() & kept, F.col("_text")).alias("payload"),
        F.when(F.col("_lines").isNotNull(), columns).alias("columns"),
        F.when(F.col("_lines").isNotNull(),
               rows).alias("nb_rows_sample"),
        F.when(F.col("_features").isNotNull(), sample("_features", 3))
        .when(F.col("_items").isNotNull(), sample("_items", 5))
        .when(readable, F.array("_text"))
        .when(F.col("_lines").isNotNull(), F.slice("_lines", 2, 5)).alias("sample"),
        F.when(is_json & ~readable, F.lit("unreadable JSON")).when(is_csv & (F.size("_lines") == 0), F.lit("no columns")).alias("error"),
    )


def counted(spark: SparkSession, pattern: str) -> int:
    """Files or folders that match a pattern; nothing is opened."""
    target, fs = _hadoop_path(spark, pattern)
    return len(fs.globStatus(target) or [])


def lake_health(spark: SparkSession, datasets: list[tuple[str, str, str]]) -> DataFrame:
    """(layer, label, path) -> status ABSENT, VIDE, CORROMPU or OK with size and rows.

    The driver looks at folders and at one footer a table; all row counts come from one union, which counts in the footers.
    """
    shape = "couche string, jeu string, statut string, taille_bytes bigint, lignes bigint"
    rows, counts = [], []
    for layer, label, path in datasets:
        if not exists(spark, path):
            rows.append((layer, label, "ABSENT", None, None))
            continue
        size = size_bytes(spark, path)
        if not path.rstrip("/").endswith(".parquet"):
            rows.append((layer, label, "OK" if size else "VIDE", size, None))
            continue
        try:
            table = spark.read.parquet(path)
        except Exception:  # an unreadable table is a finding, not a failure of the report
            rows.append((layer, label, "CORROMPU", size, None))
            continue
        n = F.count(F.lit(1))
        counts.append((layer, label, size, table.agg(n.alias("lignes")).select(
            F.lit(layer).alias("couche"), F.lit(label).alias("jeu"), F.when(F.col("lignes") > 0, F.lit("OK")).otherwise(F.lit("VIDE")).alias("statut"),
            F.lit(size).cast("bigint").alias("taille_bytes"), "lignes")))
    looked = spark.createDataFrame(rows, shape)
    if not counts:
        return looked
    try:
        return durable(reduce(DataFrame.union, [c[-1] for c in counts], looked))
    except Exception:  # some later file of a table does not read: find out which
        return reduce(DataFrame.union, [_counted_alone(spark, c, shape) for c in counts], looked)


def _counted_alone(spark: SparkSession, one: tuple, shape: str) -> DataFrame:
    layer, label, size, count = one
    try:
        return durable(count)
    except Exception:
        return spark.createDataFrame([(layer, label, "CORROMPU", size, None)], shape)
