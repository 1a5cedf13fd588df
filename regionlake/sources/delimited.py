"""Delimited text: yearly sales files and small reference files of unknown dialect."""

from __future__ import annotations

import csv
import re

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructType

from regionlake import config as C
from regionlake.schemas import SALES_COLUMNS
from regionlake.sources.files import exists

# A separator that occurs in no line, so that a line arrives as one column.
NO_SEPARATOR = "\u0001"


def raw_lines(spark: SparkSession, path: str, encoding: str = "utf-8") -> DataFrame:
    return (
        spark.read.option("sep", NO_SEPARATOR).option("encoding", encoding).option("quote", "")
        .schema("line string").csv(path)
    )


def header_of(spark: SparkSession, path: str, encoding: str = "utf-8") -> str:
    first = raw_lines(spark, path, encoding).first()
    return (first["line"] if first else "").lstrip("﻿")


def names_of(header: str, sep: str) -> list[str]:
    """Column names of a header line; a separator inside quotes belongs to the name."""
    return next(csv.reader([header], delimiter=sep), [])


def texts(names: list[str]) -> StructType:
    """A schema of strings, whatever characters the names hold."""
    out = StructType()
    for n in names:
        out.add(n, StringType())
    return out


def decodes(spark: SparkSession, path: str, encoding: str) -> bool:
    """Does the whole file decode without replacement characters?"""
    return raw_lines(spark, path, encoding).where(F.col("line").contains("�")).limit(1).count() == 0


def dialect(
    spark: SparkSession, path: str, min_columns: int = 4, separators: tuple[str, ...] = (";", ","),
    encodings: tuple[str, ...] = ("utf-8", "iso-8859-1"), strict: bool = False,
) -> tuple[str, str]:
    """(separator, encoding): the first encoding that decodes, the first separator that
    gives enough header columns. Without one, the last separator unless ``strict``.

    Every byte decodes as ISO-8859-1, so no third encoding would ever be tried.
    """
    encoding = next((e for e in encodings if decodes(spark, path, e)), encodings[-1])
    header = header_of(spark, path, encoding)
    for sep in separators:
        if len(names_of(header, sep)) >= min_columns:
            return sep, encoding
    if strict:
        raise ValueError(f"no separator gives {min_columns} columns in {path}")
    return separators[-1], encoding


def normalized(name: str, underscores: bool = False) -> str:
    name = name.strip().strip('"').lower().strip()
    return re.sub(r"[\s/]", "_", name) if underscores else name


def unique_names(names: list[str]) -> list[str]:
    """Repeated header names get a numbered suffix."""
    seen: dict[str, int] = {}
    out = []
    for n in names:
        seen[n] = seen.get(n, 0) + 1
        out.append(n if seen[n] == 1 else f"{n}.{seen[n] - 1}")
    return out


def read_delimited(
    spark: SparkSession, path: str, min_columns: int = 4, strict: bool = False, underscores: bool = False,
) -> DataFrame:
    """All columns as strings under normalised header names."""
    sep, encoding = dialect(spark, path, min_columns, strict=strict)
    names = unique_names([normalized(n, underscores) for n in names_of(header_of(spark, path, encoding), sep)])
    reader = spark.read.option("sep", sep).option("encoding", encoding).option("header", "true").option("escape", '"')
    return reader.schema(texts(names)).csv(path)


def resolve_aliases(columns: list[str], rules, first_alias_wins: bool = False) -> dict[str, str]:
    """Column -> alias: for each alias the first column, in file order, containing any pattern.

    A column claimed twice goes to the later alias, or to the earlier one on request.
    Works on names only.
    """
    mapping: dict[str, str] = {}
    for alias, patterns in rules:
        found = next((c for c in columns if any(p in c for p in patterns)), None)
        if found and not (first_alias_wins and found in mapping):
            mapping[found] = alias
    return mapping


def renamed(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename; an unmapped column that already bears an alias gives way to it."""
    taken = set(mapping.values())
    kept = [c for c in df.columns if c in mapping or c not in taken]
    return df.select(*[F.col(f"`{c}`").alias(mapping.get(c, c)) for c in kept])


def read_sales(
    spark: SparkSession, folder: str, years=C.YEARS, pattern: str = "dvf_75_{year}.csv.gz",
    partitions: int | None = None,
) -> DataFrame | None:
    """Yearly sales files as strings plus the file's year; absent years are skipped.

    The header is read per file, so files may order their columns differently and only
    the needed ones are parsed. A gzip file is one split: pass ``partitions`` to spread
    its rows before the heavier steps.
    """
    frames = []
    for year in years:
        path = f"{folder}/{pattern.format(year=year)}"
        if not exists(spark, path):
            continue
        names = [n.strip() for n in names_of(header_of(spark, path), ",")]
        df = spark.read.option("header", "true").schema(texts(names)).csv(path)
        wanted = [F.col(c) if c in names else F.lit(None).cast("string").alias(c) for c in SALES_COLUMNS]
        frames.append(df.select(*wanted, F.lit(int(year)).alias(C.YEAR)))
    if not frames:
        return None
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    # By a hash of the row: dealing rows out in turn would first sort every whole file.
    return out.repartition(partitions, F.xxhash64(*out.columns)) if partitions else out


def region_lines(df: DataFrame, code: str, prefix: str = C.COMMUNE_PREFIX) -> DataFrame:
    """Rows of a national file whose commune code starts with the territory's prefix."""
    return df.where(F.col(code).startswith(prefix))
