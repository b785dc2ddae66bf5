"""Registered queries against their SQL, and the pipeline stage by stage."""

import pytest

import corpus_pipeline
from zoneflow.llm import oracle, queries
from zoneflow.session import materialize

duckdb = pytest.importorskip("duckdb")


@pytest.mark.parametrize("name", list(oracle.oracle_sql()))
def test_query_equals_its_sql(spark, sf_dir, name):
    duck = duckdb.connect()
    for table in ("documents", "embeddings", "pages"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    found = queries.queries()[name](spark, sf_dir)
    columns = sorted(found.columns)
    result = duck.execute(oracle.oracle_sql()[name])
    order = [[c[0] for c in result.description].index(c) for c in columns]
    assert sorted((tuple(r[c] for c in columns) for r in found.collect()), key=repr) == sorted(
        (tuple(r[i] for i in order) for r in result.fetchall()), key=repr)


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, kept = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES[:4]:
        kept.append(materialize(stage(spark, kept[-1], sf_dir)))
        assert kept[-1].columns == columns, name
    raw, known, single, apart, mixed = kept
    assert known.count() >= 0.99 * raw.count()
    assert single.select("text").distinct().count() == single.count() == known.select("text").distinct().count()
    assert set(apart.columns) == set(columns) and 0 < apart.count() <= single.count()
    size = "size(filter(split(text, '[ \\t-\\r]+'), w -> w <> '')) AS n"
    before, after = (d.selectExpr(size).agg({"n": "sum"}).first()[0] for d in (apart, mixed))
    assert after == pytest.approx(1.5 * before, rel=0.03)
    packed = corpus_pipeline.STAGES[4][1](spark, mixed, sf_dir)
    assert packed.groupBy("sequence_id").agg({"length": "sum"}).agg({"sum(length)": "max"}).first()[0] <= 4096


def test_pipeline_of_no_documents_and_of_odd_ones(spark, tmp_path):
    rows = [(1, None, "en", "s", None), (2, "", "en", None, 0), (3, "the of and is that with", "en", "s", 23), (None, "der die und das ist", None, None, None),
            (3, "the of and is that with", "en", "s", 23)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, some in (("some", docs), ("none", docs.limit(0))):
        some.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        found = corpus_pipeline.run(spark, f"{tmp_path}/{name}").collect()
        assert {r.doc_id for r in found} <= {3, None} and bool(found) == (name == "some")


def test_near_copies_go_by_row(spark):
    words = [f"w{i}" for i in range(100)]
    near, other = " ".join(words), " ".join(f"x{i}" for i in range(100))
    rows = [(None, near), (None, near + " a"), (5, near + " b"), (5, other), (7, other + " a"), (7, other + " b"), (None, "alone")]
    docs = materialize(spark.createDataFrame(rows, "doc_id long, text string"))
    kept = {tuple(r) for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()}
    assert kept == {(5, near + " b"), (5, other), (None, "alone")}
    alike = materialize(spark.createDataFrame([(None, near), (None, near + " a"), (3, other), (3, other + " a")], docs.schema))
    found = corpus_pipeline.drop_near_copies(spark, alike, "").collect()
    assert len(found) == 2 and {r.doc_id for r in found} == {None, 3}
