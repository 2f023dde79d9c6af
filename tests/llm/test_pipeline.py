"""The pipeline against its parts, and the properties of every stage's result."""

import corpus_pipeline
import pytest
from haulframe.llm import decontaminate
from haulframe.llm.landed import landed
from haulframe.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = landed(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        out.append(docs)
    return out


def test_columns_stay(stages):
    for docs in stages[1:-1]:
        assert docs.dtypes == stages[0].dtypes


def test_filters_only_drop(stages):
    for before, after in zip(stages[:3], stages[1:4], strict=True):
        assert after.exceptAll(before).count() == 0 and after.count() > 0
    assert stages[3].count() < stages[0].count()


def test_decisions_take_effect(spark, sf_dir, stages):
    from haulframe.llm import minhash

    assert minhash.near_duplicates(stages[2], size=5).where("NOT kept").count() == 0
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    assert decontaminate.quoted(stages[3], bench).count() == 0
    kept = {r.doc_id for r in stages[2].collect()}
    lost = {r.doc_id for r in stages[1].collect()} - kept
    groups = minhash.near_duplicates(stages[1], size=5).collect()
    assert lost == {r.doc_id for r in groups if not r.kept}


def test_rows_without_id_and_with_repeated_ids_are_judged(spark, sf_dir, stages):
    """A copied and a leaked row go whether or not they have an id of their own; clean ones stay."""
    from haulframe.llm import minhash

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").where("length(text) > 40").orderBy("item_id").first().text
    clean = [" ".join(f"{w}{k}" for k in range(40)) for w in ("p", "q", "r")]
    rows = [(None, "so " + item + " so"), (None, clean[0]), (None, clean[0]), (7, clean[1]), (7, clean[1]), (7, clean[2]), (3, clean[0])]
    more = spark.createDataFrame(rows, "doc_id bigint, text string")
    for name in docs.columns:
        if name not in more.columns:
            more = more.selectExpr("*", f"CAST(NULL AS {dict(docs.dtypes)[name]}) AS `{name}`")
    more = more.select(docs.columns).withColumn("_row", more.doc_id)

    def left(df):
        return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)

    one = minhash.one_of_each(more, size=5)
    assert left(one) == sorted([(3, clean[0]), (7, clean[1]), (7, clean[2]), (None, rows[0][1])], key=str)
    assert one.columns == more.columns
    unquoted = decontaminate.clean(more, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    assert left(unquoted.where("doc_id IS NULL AND text LIKE 'so %'")) == [] and (None, clean[0]) in left(unquoted)


def test_last_stage_encodes_the_mixture(stages):
    mixture, encoded = stages[4], stages[5]
    assert encoded.count() == mixture.count()
    rows = encoded.orderBy("start").collect()
    assert [r.start for r in rows] == [sum(x.n_tokens for x in rows[:k]) for k in range(len(rows))]
    assert sorted(r.doc_id for r in rows) == [r.doc_id for r in rows] == sorted(r.doc_id for r in mixture.collect())


def test_run_gives_the_last_stage(spark, sf_dir, stages):
    got = {tuple(r) for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert got == {tuple(r) for r in stages[-1].collect()}
    assert corpus_pipeline.ORACLE_SQL is None and "pipeline" not in ORACLES and len(QUERIES) == 13


def test_entry_without_the_corpus_operators(spark, tmp_path):
    """The rest of the library imports and lists its queries when the folder is gone."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(corpus_pipeline.__file__).parent
    copy = tmp_path / "copy"
    shutil.copytree(root, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 100 and 'pipeline' not in q; assert set(q) == set(e.oracle_sql())"
    subprocess.run([sys.executable, "-c", code], cwd=copy, check=True)
