"""How the given tables land as files: spread over tasks, joined once, unsorted, and the same rows."""

import glob
import re

import pytest
from pyspark.sql import functions as F

from regionlake.session import settings
from regionlake.sources import delimited
from regionlake.sources.files import inventory
from suite import domain as D
from suite import sources, streams

SF = "/root/testdata/sf0.001"


def test_json_lists_are_written_by_many_tasks(spark, tmp_path):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.col("id") % 3).alias("source"), F.lit("en").alias("lang"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    lake = sources.land_json(spark, str(tmp_path))
    found = glob.glob(f"{lake.root}/bronze/source=*/bloc=*/*.json")
    assert len(found) == 30  # one file a list
    assert len({re.search(r"part-(\d+)-", f)[1] for f in found}) > 1
    listed = inventory(spark, f"{lake.root}/bronze", "2024-01-01")
    assert listed.count() == 30 and listed.where("error is null").count() == 30


def test_settings_are_put_back(spark):
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key, None)
    with pytest.raises(ValueError), settings(spark, spark__sql__maxConcurrentOutputFileWriters=7):
        assert spark.conf.get(key) == "7"
        raise ValueError
    assert spark.conf.get(key, None) == before


@pytest.mark.parametrize("counts", [(200, 3, 0, 40)])
def test_each_part_lands_as_as_many_files(spark, tmp_path, rows, counts):
    folder = str(tmp_path / "landed")
    ids = [(i, p) for p, n in enumerate(counts) for i in range(p * 1000, p * 1000 + n)]
    streams.land(spark.createDataFrame(ids, "id bigint, _part bigint"), folder)
    assert len(glob.glob(f"{folder}/part-*.parquet")) == streams.BATCHES * streams.FILES
    assert spark.read.parquet(folder).groupBy(F.input_file_name()).count().count() > len(counts)
    seen = []
    stream = streams.sales.read_stream(spark, folder, "id bigint", files_per_batch=streams.FILES)
    streams.finish(streams.sales.start(stream, lambda batch, i: seen.append((i, sorted(r[0] for r in batch.collect()))), str(tmp_path / "mark")))
    assert [s for s in seen if s[1]] == [(p, [i for i, q in ids if q == p]) for p, n in enumerate(counts) if n]


def test_yearly_files_are_spread_without_a_sort(spark, tmp_path, rows):
    sold = [(f"2020-01-{d:02d}", str(1000 * d)) for d in range(1, 29)] * 2
    spark.createDataFrame(sold, "date_mutation string, valeur_fonciere string").coalesce(1).write.option("header", "true").option(
        "compression", "gzip").csv(f"{tmp_path}/dvf_75_2020.csv.gz")
    df = delimited.read_sales(spark, str(tmp_path), [2020], partitions=5)
    plan = df._jdf.queryExecution().toString()
    assert "hashpartitioning" in plan and "RoundRobinPartitioning" not in plan
    assert rows(df.select("date_mutation", "valeur_fonciere")) == sorted(sold, key=repr)


def test_file_counts_writes_its_years_unsorted(spark, monkeypatch):
    real, seen = D.landed_sales, []
    monkeypatch.setattr(sources.D, "landed_sales", lambda *a: seen.append(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) or real(*a))
    assert sources.file_counts(spark, SF).first()["bronze"] == 7
    assert seen == [str(sources.WRITERS)]


def test_batch_status_joins_the_tables_once(spark, monkeypatch):
    real, passed = D.landed_sales, spark.sparkContext.accumulator(0)

    def counted(*a):
        df = real(*a)

        def through(batches):
            for b in batches:
                passed.add(b.num_rows)
                yield b

        return df.mapInArrow(through, df.schema)

    monkeypatch.setattr(sources.D, "landed_sales", counted)
    sources.batch_status(spark, SF).collect()
    assert passed.value == real(spark, SF).count()
