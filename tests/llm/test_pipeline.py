import os
import subprocess
import sys

import pyarrow as pa

import corpus_pipeline

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))


def test_stages_keep_columns_and_edges(spark, edges):
    docs = edges.drop("component_id")
    counts = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        counts.append(out.count())
        assert out.where("doc_id is null").count() == 1 and out.where("doc_id = 10").count() == 1
    assert counts[2] == 8  # 5, 6, 6, 7, 9 are copies


def test_python_workers_get_texts_in_bounded_batches(spark, docs):
    """Texts of 1 MB reach the workers of a stage's result a few at a time."""
    sizes = lambda df: max(r.n for r in df.repartition(1).mapInArrow(
        lambda batches: (pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in batches), "n long").collect())
    rows = docs([(i, "word " * 200_000) for i in range(12)]).drop("component_id")
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    try:
        assert sizes(rows) > 10 << 20
        corpus_pipeline.toxicity_stage(spark, rows, SF)
        assert sizes(rows) <= corpus_pipeline.BATCH_BYTES + (2 << 20)
    finally:
        spark.conf.unset(limit)


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert 0 < len(rows) < 200 and all(r.n_tokens == len(r.ids) for r in rows)


def test_entry_without_the_package():
    """The entry module imports when the operators cannot be found."""
    code = ("import sys; sys.modules['regionlake.llm'] = None; sys.modules['corpus_pipeline'] = None; "
            "import __spark_entry__ as e; assert not [n for n in e.queries() if n.startswith('op') or n == 'pipeline']; e.oracle_sql()")
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)
