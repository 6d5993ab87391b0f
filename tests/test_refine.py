import pytest
from pyspark.sql import functions as F

from lamina import domain
from lamina.operators import refine
from lamina.sources import ingest, layers
from tests.conftest import rows


def test_csv_text_and_audit(spark, tmp_path):
    path = tmp_path / "financial_impact.csv"
    path.write_text('incident_id,total_loss_usd\n1,$12\n2,12\n3,\n4,""\n')
    first = ingest.read_raw(spark, ingest.ingest(spark, str(path), str(tmp_path / "raw")))
    assert dict(first.dtypes)["total_loss_usd"] == "string"
    assert [r[0] for r in first.orderBy("incident_id").select("total_loss_usd").collect()] == ["$12", "12", None, None]
    tags = {tuple(r) for r in first.select(*domain.AUDIT_COLUMNS[:3]).collect()}
    assert len(tags) == 1 and next(iter(tags))[:2] == ("financial_impact.csv", 4)
    second = ingest.read_raw(spark, ingest.ingest(spark, str(path), str(tmp_path / "raw2")))
    assert second.first()["meta_hash_ingestao"] != first.first()["meta_hash_ingestao"]
    assert dict(first.dtypes)["meta_data_carga"] == "timestamp"
    typed = first.select(F.col("incident_id"), "total_loss_usd")
    assert rows(refine.rejected_values(typed, ["total_loss_usd"])) == [("total_loss_usd", 1)]


def test_reader_options_reach_the_source(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('a;b\n1;"two\nlines"\n')
    got = ingest.read_raw(spark, ingest.ingest(spark, str(path), str(tmp_path / "raw"), sep=";", multiLine="true"))
    assert [(r["a"], r["b"]) for r in got.collect()] == [("1", "two\nlines")]


def test_inferred_types(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("a,b\n1,1.5\n2,$5\n")
    assert dict(ingest.read_csv(spark, str(path), infer=True).dtypes) == {"a": "int", "b": "string"}


def raw_pair(spark):
    incidents = spark.createDataFrame(
        [(1, "A", None, "5", "3", "x", "n"), (2, None, "t", "$5", "z", "y", "n"), (3, "B", "t", "6", None, "y", "n"), (9, "B", "t", "6", None, "y", "n")],
        "incident_id int, industry_primary string, data_type string, company_revenue_usd string, confidence_tier string, company_name string, notes string",
    )
    financial = spark.createDataFrame(
        [(1, "10.5", "1"), (2, "20", "1"), (3, "$30", "1"), (None, "4", "1")],
        "incident_id int, total_loss_usd string, direct_loss_usd string",
    )
    return incidents, financial


def test_refine(spark):
    incidents, financial = (
        ingest.with_audit(df, "f.csv", 4) for df in raw_pair(spark)
    )
    out = refine.refine(incidents, financial)
    assert out.columns == ["industry_primary", "data_type", "company_revenue_usd", "confidence_tier", "total_loss_usd", "row_key"]
    assert rows(out) == [
        ("A", "Desconhecido", 5.0, 3.0, 10.5, 1),
        (None, "t", None, None, 20.0, 2),
    ]
    full = refine.inner_join_all(incidents, financial)
    assert full.count() == 3 and full.select("meta_arquivo_origem").count() == 3


def test_join_coverage_counts_like_joins(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (3,), (None,)], "incident_id int")
    b = spark.createDataFrame([(1,), (2,), (2,), (4,), (None,)], "incident_id int")
    c = spark.createDataFrame([(1,), (4,), (5,), (5,)], "incident_id int")
    got = {r["join_kind"]: r["rows"] for r in refine.join_coverage(a, b, c).collect()}
    k = "incident_id"
    assert got == {
        "inner_inner": a.join(b, k).join(c, k).count(),
        "inner_left": a.join(b, k).join(c, k, "left").count(),
        "left_left": a.join(b, k, "left").join(c, k, "left").count(),
        "full_outer": a.join(b, k, "full").join(c, k, "full").count(),
    }


def test_null_profile_and_inventory(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (3, None), (4, None)], "a int, b string")
    assert rows(refine.null_profile(df)) == [("b", 3, 75.0)]
    assert rows(refine.null_profile(df, only_with_nulls=False)) == [("a", 0, 0.0), ("b", 3, 75.0)]
    assert not refine.has_no_nulls(df) and refine.has_no_nulls(df.select("a"))
    assert rows(ingest.layer_inventory({"t": df, "u": df.select("a")})) == [("t", 4, 2), ("u", 4, 1)]


def test_tolerant_projections(spark):
    df = spark.createDataFrame([(1, 2)], "a int, `b.c` int")
    assert refine.keep_existing(df, ["x", "b.c"]).columns == ["b.c"]
    assert refine.drop_existing(df, ["x", "a"]).columns == ["b.c"]


def test_a_killed_write_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "layer")
    layers.write_layer(spark.range(100), path, counted=True)
    reader = layers.read_layer(spark, path)
    broken = spark.range(1000).select((F.when(F.col("id") < 900, F.col("id")).otherwise(F.raise_error(F.lit("lost")))).alias("id"))
    with pytest.raises(Exception, match="lost"):
        layers.write_layer(broken, path, counted=True)
    assert layers.read_layer(spark, path).count() == 100 and [v.rows for v in layers.versions(spark, path)] == [100]
    layers.write_layer(layers.read_layer(spark, path).where("id >= 40"), path, counted=True)
    assert layers.read_layer(spark, path).count() == 60 and reader.count() == 100
    layers.write_layer(layers.read_layer(spark, path).where("id >= 90"), path)
    kept = layers.versions(spark, path)
    assert [(v.number, v.rows) for v in kept] == [(2, 60), (3, None)]
    assert sorted(p.name for p in (tmp_path / "layer").glob("data-*")) == sorted(v.data.rsplit("/", 1)[1] for v in kept)
    # a data folder without a commit, as a killed driver leaves it, is not read
    spark.range(7).write.parquet(path + "/data-lost")
    assert layers.read_layer(spark, path).count() == 10
    layers.write_layer(spark.range(0), path, counted=True)
    assert layers.read_layer(spark, path).count() == 0 and layers.versions(spark, path)[-1].rows == 0


def test_plain_parquet_is_a_layer(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "plain"))
    assert layers.versions(spark, str(tmp_path / "plain")) == []
    assert layers.read_layer(spark, str(tmp_path / "plain")).count() == 3


def test_ingest_reads_the_text_once(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("a,b\n1,x\n2,y\n,z\n")
    raw = ingest.read_raw(spark, ingest.ingest(spark, str(path), str(tmp_path / "raw")))
    assert raw.columns == ["a", "b", *domain.AUDIT_COLUMNS]
    assert {r["meta_qtd_linhas"] for r in raw.collect()} == {3}
    # the rows are what was written: the text may change or go
    path.unlink()
    assert raw.count() == 3
