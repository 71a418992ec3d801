import shutil

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyforge.llm import decontaminate, minmax_dedup, mixing, toxicity_pu
from tallyforge.llm.common import fold


@pytest.fixture(scope="module")
def steps(spark, sf):
    """The documents that go into each stage, and the last result."""
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        out.append(docs)
        docs = stage(spark, docs, sf).cache()
    return [*out, docs]


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_stages_take_effect(spark, sf, steps):
    raw, calm, unique, clean, mixed, sharded = steps
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "mixing", "sharding"]
    assert all(s.columns == raw.columns for s in steps[:-1]) and sharded.columns[:len(raw.columns)] == raw.columns
    held = fold("doc_id", 5) == 0
    confirmed, prior = toxicity_pu.confirmed_toxic(spark.read.parquet(f"{sf}/labels.parquet"), held)
    assert ids(calm) == ids(toxicity_pu.score_toxicity(raw, confirmed, prior, held).where("predicted = 0"))
    assert ids(unique) == ids(minmax_dedup.near_duplicates(calm).where("kept"))
    found = decontaminate.find_passages(unique, spark.read.parquet(f"{sf}/benchmark.parquet"))
    assert ids(clean) == sorted(set(ids(unique)) - set(ids(found)))
    plan = {r.doc_id: r.copies for r in mixing.mix_sources(clean).collect()}
    assert ids(mixed) == sorted(k for k, n in plan.items() for _ in range(n))
    assert ids(sharded) == ids(mixed)
    slots = sharded.groupBy("shard").agg(F.count("*").alias("n"), F.max("slot").alias("top"), F.countDistinct("slot").alias("d")).collect()
    assert all(r.n == r.top + 1 == r.d for r in slots)


def test_run_equals_the_stages(spark, sf, steps):
    assert sorted(map(str, corpus_pipeline.run(spark, sf).select("doc_id", "text").collect())) == sorted(
        map(str, steps[-1].select("doc_id", "text").collect()))


@pytest.mark.parametrize("with_pipeline", [False, True])
def test_the_rest_works_without_the_subpackage(tmp_path, with_pipeline):
    """A copy without the subpackage and its tests, with and without the pipeline, still lists the other queries."""
    import pathlib
    import subprocess
    import sys

    home = pathlib.Path(corpus_pipeline.__file__).parent
    for folder in ("tallyforge", "tests"):
        shutil.copytree(home / folder, tmp_path / folder, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", *(["corpus_pipeline.py"] if with_pipeline else [])):
        shutil.copy(home / name, tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 100 and 'pipeline' not in q; e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)
