"""Registered queries with SQL against DuckDB; and the pipeline's stages on the smallest table."""

import duckdb
import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", ["op4_line_frequency", "op5_byte_shards", "op9_arc_to_warc"])
def test_oracles(spark, con, name):
    from siltstone.llm import queries

    got = queries.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    want = con.sql(queries.ORACLE[name]).project(", ".join(columns)).fetchall()
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got.select(*columns).collect())


def test_pipeline(spark):
    import corpus_pipeline as c

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {r.doc_id for r in docs.collect()}
    for name, stage in c.STAGES[:-1]:
        after = c.staged(stage(spark, docs, SF), "test")
        assert after.columns == docs.columns
        ids = {r.doc_id for r in after.collect()}
        assert ids <= kept and len(ids) > 0.5 * len(kept)
        docs, kept = after, ids
    packed = c.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == kept


@pytest.mark.parametrize("number", range(4))
def test_stages_keep_columns_with_names_of_their_own(spark, docs, number):
    import corpus_pipeline as c

    for name in ("dropped", "leaking", "row_number", "_row_number", "gone_row", "Score", "a.b", "doc", "found", "component_id", "same", "n", "hashes"):
        if name.lower() not in {x.lower() for x in docs.columns}:
            from pyspark.sql import functions as F

            docs = docs.withColumn(name, F.lit(name))
    docs = c.staged(docs, "odd-columns")
    after = c.STAGES[number][1](spark, docs, SF)
    assert after.columns == docs.columns and after.schema["text"].dataType == docs.schema["text"].dataType
    kept = after.collect()
    assert 0 < len(kept) <= docs.count() and all(r["a.b"] == "a.b" and r["dropped"] == "dropped" for r in kept)
    assert c.STAGES[number][1](spark, docs.where("false"), SF).count() == 0
    # Null ids are rows of their own: one that goes takes no other with it.
    assert any(r.doc_id is None and (r.text or "").startswith("an id that is null") for r in kept)


def test_near_dedup_keeps_the_order_of_null_ids(spark):
    import corpus_pipeline as c

    df = c.staged(spark.createDataFrame([(None, "a b c d e f", "x"), (None, "a b c d e f", "y"), (None, "q r s t u v", "z"), (5, "q r s t u v", "w")], "doc_id long, text string, row string").coalesce(1), "nulls")
    assert sorted(r["row"] for r in c.drop_near_copies(spark, df, SF).collect()) == ["w", "x"]
