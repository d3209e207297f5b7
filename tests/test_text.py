import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from featherline.functions import text
from featherline.operators import codecs, tables
from featherline.sources import export

SPARSE = Vectors.sparse(31, [4, 30], [0.75, -12.5])
DENSE = Vectors.dense([3.5, 0.25, -8.0, 61.0])


def one(spark, rows, names, column):
    return spark.createDataFrame(rows, names).select(column.alias("x")).first()["x"]


def test_libsvm_lines(spark):
    line = text.libsvm_line(F.col("features"), F.col("label"))
    assert one(spark, [(1.0, SPARSE)], ["label", "features"], line) == "1.0 5:0.75 31:-12.5\n"
    assert one(spark, [(7.0, DENSE)], ["label", "features"], line) == "7.0 1:3.5 2:0.25 3:-8.0 4:61.0\n"
    extra = [(19, 1.0, SPARSE, True)]
    assert one(spark, extra, ["order id", "label", "features", "paid"], line) == "1.0 5:0.75 31:-12.5\n"
    assert one(spark, [(SPARSE,)], ["features"], text.libsvm_line(F.col("features"))) == "0.0 5:0.75 31:-12.5\n"


def test_dense_zeros_are_written(spark):
    line = text.libsvm_line(F.col("features"))
    assert one(spark, [(Vectors.dense([0.0, 1.0]),)], ["features"], line) == "0.0 1:0.0 2:1.0\n"


def test_csv_line(spark):
    line = text.csv_line(F.col("features"))
    assert one(spark, [(DENSE,)], ["features"], line) == "3.5,0.25,-8.0,61.0\n"
    cells = one(spark, [(SPARSE,)], ["features"], line).strip().split(",")
    assert len(cells) == 31 and cells[4] == "0.75" and cells[30] == "-12.5" and set(cells[5:30]) == {"0.0"}


def test_encode_equals_the_scanned_file(spark, tmp_path):
    lines = ["2.0 6:0.5 19:-3.25", "0.0 88:4.0", "-5.0 7:1.5", "0.5"]
    path = tmp_path / "in.txt"
    path.write_text("\n".join(lines) + "\n")
    scanned = export.read_libsvm(spark, str(path), 100)
    encoded = [r["x"] for r in scanned.select(text.libsvm_line(F.col("features"), F.col("label")).alias("x")).collect()]
    assert sorted(encoded) == sorted(line + "\n" for line in lines)
    decoded = text.parse_libsvm(spark.read.text(str(path)), 100)
    assert {(r["label"], r["features"]) for r in decoded.collect()} == {(r["label"], r["features"]) for r in scanned.collect()}


def test_decode_of_lines_that_differ_in_length(spark):
    held = {float(n): {k: (k + 0.5) * (-1) ** k for k in range(n % 7, 60, n + 1)} for n in range(40)}
    rows = [(" ".join([str(label), *[f"{k + 1}:{v}" for k, v in entries.items()]]),) for label, entries in held.items()]
    for row in text.parse_libsvm(spark.createDataFrame(rows, ["value"]), 60).collect():
        assert row["features"] == Vectors.sparse(60, held[row["label"]])


def test_plus_signs(spark):
    row = text.parse_libsvm(spark.createDataFrame([("+4 +2:+0.5 3:-1",)], ["value"]), 3, mode="PERMISSIVE").first()
    assert (row["label"], row["features"], row["bad_row"]) == (4.0, Vectors.sparse(3, [1, 2], [0.5, -1.0]), None)


BAD = [("label 2:7", 9), ("2.5 3:seven", 9), ("2.5 third:7", 9), ("2.5 :7", 9), ("2.5 3:", 9), ("2.5 4:1.0", 3), ("2.5 0:1.0", 3),
       ("0.0 5:1.0 4:1.0", 9), ("0.0 4:1.0 4:2.0", 9), ("", 9)]


@pytest.mark.parametrize("line,dim", BAD)
def test_bad_lines(spark, line, dim):
    df = spark.createDataFrame([("1.0 1:2.0",), (line,)], ["value"])
    with pytest.raises(Exception, match="malformed"):
        text.parse_libsvm(df, dim).collect()
    rows = text.parse_libsvm(df, dim, mode="PERMISSIVE").collect()
    assert [r["bad_row"] for r in rows] == [None, line]
    assert rows[0]["features"] == Vectors.sparse(dim, [0], [2.0]) and rows[1]["features"] is None and rows[1]["label"] is None


def test_negative_dimension():
    with pytest.raises(ValueError):
        codecs.LibSVMDecoder(-1)


def test_random_round_trip(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(300):
        chosen = np.flatnonzero(rng.random(40) < 0.3)
        rows.append((float(i), Vectors.sparse(40, chosen.tolist(), rng.normal(scale=10.0 ** rng.integers(-9, 9), size=len(chosen)).tolist())))
    df = spark.createDataFrame(rows, ["label", "features"])
    lines = df.select(F.rtrim(text.libsvm_line(F.col("features"), F.col("label")), F.lit("\n")).alias("value"))
    assert {r["label"]: r["features"] for r in text.parse_libsvm(lines, 40).collect()} == dict(rows)


def test_csv_numbers(spark):
    got = text.csv_numbers(spark.createDataFrame([(" 1.5,2,-3e-4\n",)], ["body"])).orderBy("position").collect()
    assert [r["prediction"] for r in got] == [1.5, 2.0, -3e-4]
    with pytest.raises(Exception):
        text.csv_numbers(spark.createDataFrame([("1,x",)], ["body"])).collect()


def test_zeros_are_dropped_by_value(spark):
    entries = F.array(*[F.struct(F.lit(i).alias("index"), F.lit(v).alias("value")) for i, v in ((1, 10.0), (2, 0.0), (3, 20.0))])
    kept = spark.range(1).select(text.without_zeros(entries).alias("x")).first()["x"]
    assert [e["index"] for e in kept] == [1, 3]


@pytest.mark.parametrize("encoder", [codecs.LibSVMEncoder(), codecs.CSVEncoder(), codecs.RecordEncoder(),
                                     codecs.UnlabeledLibSVMEncoder()])
def test_encoders_check_the_schema(spark, encoder):
    encoder.validate(spark.createDataFrame([(1.0, DENSE)], ["label", "features"]).schema)
    with pytest.raises(ValueError, match="features"):
        encoder.validate(spark.createDataFrame([(1.0, "x")], ["label", "features"]).schema)


def test_label_must_be_double(spark):
    schema = spark.createDataFrame([("a", DENSE)], ["label", "features"]).schema
    with pytest.raises(ValueError, match="label"):
        tables.require_columns(schema, "features", "label")
