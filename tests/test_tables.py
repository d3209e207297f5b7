import json

import pytest
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F, types as T

from featherline.functions import keys, vectors
from featherline.operators import tables
from featherline.sources import export

FEATURES = T.StructType().add("label", T.DoubleType()).add("features", VectorUDT())


def test_ownership(spark):
    prefix = "shared/run1"
    own = ["shared/run1", "shared/run1/part-00000-abc.pbr", "shared/run1.manifest.txt", "shared/run1_$folder$"]
    other = ["shared/run10/part-0", "shared/run1000", "shared/run1-extra/part-0", "other/x", "shared/run"]
    df = spark.createDataFrame([(k,) for k in own + other], ["key"])
    rows = {r["key"]: r["o"] for r in df.select("key", keys.owned_by(F.col("key"), prefix).alias("o")).collect()}
    assert [k for k, o in rows.items() if o] == own
    prefixes = spark.createDataFrame([(prefix,), ("shared/run10",), ("nothing",)], ["prefix"])
    pairs = {(r["key"], r["prefix"]) for r in keys.owners(df, prefixes).collect()}
    assert pairs == {(k, prefix) for k in own} | {("shared/run10/part-0", "shared/run10")}


def test_markers(spark):
    df = spark.createDataFrame([("a_$folder$",), ("_SUCCESS",), ("part-0",), ("x_SUCCESS",)], ["n"])
    assert [r[0] for r in df.filter(~keys.is_marker(F.col("n"))).collect()] == ["part-0", "x_SUCCESS"]


def test_object_uri(spark):
    df = spark.createDataFrame([("s3://bucket/a/b.txt",), ("s3a://other/",)], ["u"])
    rows = [tuple(r[0]) for r in df.select(keys.split_object_uri(F.col("u"))).collect()]
    assert rows == [("bucket", "a/b.txt"), ("other", "")]
    with pytest.raises(Exception, match="object URI"):
        spark.createDataFrame([("http://x/y",)], ["u"]).select(keys.split_object_uri(F.col("u"))).collect()


def test_violations_and_requirement(spark):
    rows = [(0.0, Vectors.dense([1.0, 2.0])), (None, Vectors.dense([1.0, 2.0])), (5.0, Vectors.sparse(3, [0], [1.0])),
            (float("nan"), Vectors.dense([float("inf"), 0.0])), (0.5, None)]
    df = spark.createDataFrame(rows, FEATURES)
    counts = tables.violations(df, label="label", feature_dim=2, num_classes=2).first().asDict()
    assert counts == {"n_rows": 5, "null_features": 1, "nonfinite_features": 1, "wrong_size": 1, "null_label": 1,
                      "nonfinite_label": 1, "label_out_of_range": 3}
    with pytest.raises(ValueError, match="bad rows"):
        tables.require_valid(df, label="label")
    with pytest.raises(ValueError, match="vector column other"):
        tables.violations(df, "other")


def test_append_or_replace(spark):
    df = spark.createDataFrame([(1.5,)], ["double"])
    columns = {"string": F.col("double").cast("string")}
    assert tables.append(df, columns).columns == ["double", "string"]
    assert tables.append(df, columns, keep_input=False).columns == ["string"]


def test_projection(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["a", "b", "c"])
    assert tables.project(df, ["c", "a"]).columns == ["c", "a"]
    assert tables.project(df, None).columns == tables.project(df, []).columns == ["a", "b", "c"]


def test_first_rows_need_an_order(spark):
    assert [r[0] for r in tables.first_rows(spark.range(100), 3, F.col("id").desc()).collect()] == [99, 98, 97]
    with pytest.raises(ValueError):
        tables.first_rows(spark.range(3), 1)


def test_export_and_manifest(spark, tmp_path):
    path = str(tmp_path / "set")
    df = spark.range(1000).select("id", F.lit("x").alias("other"))
    export.export(df, path, "parquet", columns=["id"], shards=4)
    names = sorted(p.name for p in (tmp_path / "set").iterdir() if not p.name.startswith("."))
    assert len(names) == 4 and all(n.startswith("part-") for n in names)
    assert spark.read.parquet(path).columns == ["id"]
    (tmp_path / "set" / "sub").mkdir()
    (tmp_path / "set" / "sub" / "extra").write_text("x")
    (tmp_path / "set" / "dir_$folder$").write_text("")
    document = json.loads(open(export.write_manifest(spark, path, "s3://bucket/objectPath")).read())
    assert document[0] == {"prefix": "s3://bucket/objectPath/"} and document[1:] == sorted([*names, "extra"])
    with pytest.raises(Exception):
        export.export(df, path, "parquet")
    vectors_df = df.select(vectors.vector_of("id").alias("features"))
    export.export(vectors_df, str(tmp_path / "records"))
    with pytest.raises(FileExistsError):
        export.export(vectors_df, str(tmp_path / "records"))


def test_manifest_of_nothing_fails(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "_SUCCESS").write_text("")
    with pytest.raises(Exception, match="no data files"):
        export.write_manifest(spark, str(tmp_path / "empty"))


def test_replicated_export_is_not_repartitioned(spark, tmp_path):
    path = str(tmp_path / "r")
    export.export(spark.range(0, 10, 1, 2), path, "parquet", shards=5, distribution=export.REPLICATED)
    assert len([p for p in (tmp_path / "r").iterdir() if p.name.startswith("part-")]) == 2
    with pytest.raises(ValueError):
        export.export(spark.range(1), path + "x", "parquet", distribution="Elsewhere")


def test_libsvm_sink_projects(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.0, Vectors.dense([1.0, 0.0]))], ["name", "y", "v"])
    export.write_libsvm(df, str(tmp_path / "l"), "y", "v")
    row = export.read_libsvm(spark, str(tmp_path / "l"), 2).first()
    assert row["label"] == 1.0 and row["features"].toArray().tolist() == [1.0, 0.0]
