import struct

import numpy as np
import pytest
from pyspark.ml.linalg import DenseMatrix, MatrixUDT, SparseMatrix, Vectors, VectorUDT
from pyspark.sql import functions as F, types as T

from featherline.functions import records, vectors, wire
from featherline.sources import files, recordio

DENSE = Vectors.dense([0.25 * (k * k % 37) - 3.0 for k in range(64)])
SPARSE = Vectors.sparse(5000, [k * k for k in range(2, 70, 5)], [0.5 - k for k in range(2, 70, 5)])


def parsed(df, *columns):
    matrix = df.schema["features"].dataType == MatrixUDT()
    body = records.record_bytes(*[F.col(c) for c in columns], matrix=matrix)
    return df.select(records.parse_record(body).alias("r")).first()["r"]


def test_dense_vector_with_label(spark):
    row = parsed(spark.createDataFrame([(-7.5, DENSE)], ["label", "features"]), "features", "label")
    tensor = row["features"]["values"]["float32"]
    assert tensor["values"] == list(DENSE.values) and tensor["keys"] == [] and tensor["shape"] == []
    assert row["label"]["values"]["float32"]["values"] == [-7.5]


def test_sparse_vector_without_label(spark):
    row = parsed(spark.createDataFrame([(SPARSE,)], ["features"]), "features")
    tensor = row["features"]["values"]["float32"]
    assert tensor["keys"] == list(SPARSE.indices) and tensor["shape"] == [5000]
    assert tensor["values"] == list(SPARSE.values) and row["label"] == {}


@pytest.mark.parametrize("transposed", [False, True])
def test_dense_matrix_is_row_major(spark, transposed):
    matrix = DenseMatrix(7, 3, [0.5 * (k * 5 % 21) for k in range(21)], transposed)
    tensor = parsed(spark.createDataFrame([(matrix,)], ["features"]), "features")["features"]["values"]["float32"]
    assert tensor["shape"] == [7, 3]
    assert tensor["values"] == list(matrix.toArray().ravel())


@pytest.mark.parametrize("transposed", [False, True])
def test_sparse_matrix_keys(spark, transposed):
    """A key is row * columns + column, in the order in which the matrix holds its entries."""
    entries = [(0, 4), (1, 0), (1, 3), (3, 2), (3, 4)] if transposed else [(1, 0), (3, 2), (1, 3), (0, 4), (3, 4)]
    lines = 4 if transposed else 5
    pointers = [sum(1 for r, c in entries if (r if transposed else c) < k) for k in range(lines + 1)]
    matrix = SparseMatrix(4, 5, pointers, [c if transposed else r for r, c in entries], [2.5 * k + 1 for k in range(5)], transposed)
    tensor = parsed(spark.createDataFrame([(matrix,)], ["features"]), "features")["features"]["values"]["float32"]
    assert tensor["keys"] == [r * 5 + c for r, c in entries] and tensor["values"] == [2.5 * k + 1 for k in range(5)] and tensor["shape"] == [4, 5]


def test_record_and_frame_sizes(spark):
    df = spark.createDataFrame([(1.0, Vectors.dense([1.0, 2.0, 3.0, 4.0]))], ["label", "features"])
    body = records.record_bytes(F.col("features"), F.col("label"))
    row = df.select(F.octet_length(body).alias("body"), F.octet_length(records.frame(body)).alias("frame")).first()
    assert (row["body"], row["frame"]) == (52, 60)


@pytest.mark.parametrize("size", [0, 4, 1, 5])
def test_frame_pads_to_four(spark, size):
    body = bytes(range(1, size + 1))
    framed = spark.createDataFrame([(body,)], ["b"]).select(records.frame(F.col("b")).alias("f")).first()["f"]
    assert bytes(framed) == struct.pack("<Ii", 0xCED7230A, size) + body + b"\0" * (-size % 4)


def test_bad_magic_fails(spark):
    df = spark.createDataFrame([(bytes([1, 2, 3, 4, 5, 6, 7, 8]),)], ["p"])
    with pytest.raises(Exception, match="magic"):
        records.unframe(df, "p").collect()


def test_unframe_keeps_order(spark):
    bodies = [b"", b"a", b"abcd", b"xyz12", b"q", b"r"]
    payload = b"".join(struct.pack("<Ii", 0xCED7230A, len(b)) + b + b"\0" * (-len(b) % 4) for b in bodies)
    rows = records.unframe(spark.createDataFrame([(payload,)], ["p"]), "p").orderBy("position").collect()
    assert [bytes(r["body"]) for r in rows] == bodies


def varint(n):
    out = b""
    while True:
        byte, n = n & 0x7F, n >> 7
        out += bytes([byte | (0x80 if n else 0)])
        if not n:
            return out


def field(number, body):
    return varint(number * 8 + 2) + varint(len(body)) + body


def tensor(values, keys=(), shape=()):
    out = field(1, np.array(values, "<f4").tobytes()) if values else b""
    out += field(2, b"".join(map(varint, keys))) if keys else b""
    return out + (field(3, b"".join(map(varint, shape))) if shape else b"")


def entry(side, name, body):
    return field(side, field(1, name.encode()) + field(2, field(2, body)))


SCHEMA = T.StructType().add("score", T.DoubleType()).add("mix", VectorUDT())


def decode(spark, bodies, schema=SCHEMA, keys=None):
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "i int, body binary")
    rows = df.select("i", records.decode_outputs(F.col("body"), schema, keys).alias("o")).orderBy("i").collect()
    return [r["o"] for r in rows]


def test_decode_named_outputs(spark):
    body = (entry(2, "mix", tensor([10, 11, 12], [1, 2, 3], [10])) + entry(2, "score", tensor([7]))
            + entry(2, "score", tensor([8])) + entry(2, "other", tensor([1, 2])))
    dense = entry(2, "score", tensor([1.5])) + entry(2, "mix", tensor([10, 11, 12]))
    one = entry(2, "score", tensor([2])) + entry(2, "mix", tensor([3]))
    out = decode(spark, [body, dense, one])
    assert out[0]["score"] == 7.0 and out[0]["mix"] == Vectors.sparse(10, [1, 2, 3], [10.0, 11.0, 12.0])
    assert out[1]["mix"] == Vectors.dense([10.0, 11.0, 12.0])
    assert out[2]["mix"] == Vectors.dense([3.0])


def test_decode_with_other_wire_names(spark):
    body = entry(2, "a", tensor([1])) + entry(2, "b", tensor([2, 3]))
    assert decode(spark, [body], keys=["a", "b"])[0]["mix"] == Vectors.dense([2.0, 3.0])
    with pytest.raises(ValueError):
        records.decode_outputs(F.col("body"), SCHEMA, ["a"])


@pytest.mark.parametrize("body", [
    entry(2, "score", tensor([1])),
    entry(2, "score", tensor([])) + entry(2, "mix", tensor([1])),
    entry(2, "score", tensor([1, 2])) + entry(2, "mix", tensor([1])),
    entry(2, "score", tensor([1])) + entry(2, "mix", tensor([1, 2], [0, 1], [2, 2])),
    bytes([1, 2, 3, 4]),
])
def test_decode_rejects(spark, body):
    with pytest.raises(Exception):
        decode(spark, [body])


def test_other_kinds_of_values(spark):
    double = field(1, np.array([1.5, 2.5], "<f8").tobytes())
    whole = field(1, varint((1 << 64) - 3) + varint(5))
    raw = field(1, b"ab") + field(1, b"c") + field(2, b"image/jpeg")
    body = b"".join(
        field(1, field(1, name.encode()) + field(2, field(arm, part)))
        for name, arm, part in (("d", 3, double), ("i", 7, whole), ("b", 9, raw))
    ) + field(3, b"id-1") + field(4, b"{}")
    df = spark.createDataFrame([(body,)], "body binary")
    row = df.select(records.parse_record(F.col("body")).alias("r")).first()["r"]
    assert row["features"]["d"]["float64"]["values"] == [1.5, 2.5]
    assert row["features"]["i"]["int32"]["values"] == [-3, 5]
    assert [bytes(b) for b in row["features"]["b"]["bytes"]["value"]] == [b"ab", b"c"]
    assert row["uid"] == "id-1" and row["metadata"] == "{}" and row["configuration"] is None


def test_random_vectors_round_trip(spark, tmp_path):
    rng = np.random.default_rng(7)
    rows = []
    for i in range(600):
        size = int(rng.integers(0, 300))
        values = np.float32(rng.normal(size=size)).astype(float)
        if i % 3:
            chosen = np.flatnonzero(rng.random(size) < 0.2)
            vector = Vectors.sparse(size, chosen.tolist(), values[chosen].tolist()) if len(chosen) else Vectors.dense(values)
        else:
            vector = Vectors.dense(values)
        rows.append((str(i), float(i) if i % 5 else None, vector))
    df = spark.createDataFrame(rows, T.StructType().add("uid", "string").add("label", "double").add("features", VectorUDT()))
    path = str(tmp_path / "out")
    df.repartition(5).write.format("recordio").option("uidColumnName", "uid").mode("append").save(path)
    back = spark.read.format("recordio").option("uidColumnName", "uid").option("readBytes", "1000").load(path)
    assert {r["uid"]: (r["label"], r["features"]) for r in back.collect()} == {r[0]: r[1:] for r in rows}
    assert back.schema["features"].dataType == VectorUDT()


def test_writer_options(spark, tmp_path):
    df = spark.createDataFrame([(1.0, "x", Vectors.dense([10.0, 20.0, 30.0]))], ["target", "name", "vec"])
    write = lambda: df.write.format("recordio").mode("append")
    with pytest.raises(Exception, match="features"):
        write().save(str(tmp_path / "a"))
    with pytest.raises(Exception, match="label"):
        write().option("featuresColumnName", "vec").option("labelColumnName", "nope").save(str(tmp_path / "b"))
    path = str(tmp_path / "c")
    write().option("featuresColumnName", "vec").option("compression", "gzip").save(path)
    row = spark.read.format("recordio").load(path).first()
    assert row["label"] is None and row["features"] == Vectors.dense([10.0, 20.0, 30.0])
    path = str(tmp_path / "d")
    write().option("featuresColumnName", "vec").option("labelColumnName", "target").save(path)
    assert spark.read.format("recordio").load(path).first()["label"] == 1.0


def test_overwrite_replaces_and_files_roll(spark, tmp_path):
    path = tmp_path / "out"
    df = spark.range(2000).select(F.col("id").cast("double").alias("label"), vectors.vector_of("id").alias("features"))
    df.coalesce(1).write.format("recordio").mode("append").save(str(path))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        df.coalesce(1).write.format("recordio").option("maxFileBytes", "20000").mode("overwrite").save(str(path))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    names = [p.name for p in path.iterdir()]
    assert len(names) > 2 and all(n.endswith(".pbr") for n in names)
    assert spark.read.format("recordio").load(str(path)).agg(F.count("*"), F.sum("label")).first()[:] == (2000, 1999000.0)


def test_long_vector(spark, tmp_path):
    path = str(tmp_path / "long")
    df = spark.range(2).select(
        F.col("id").cast("double").alias("label"),
        vectors.from_array(F.transform(F.sequence(F.lit(1), F.lit(1000000)), lambda x: x.cast("double"))).alias("features"),
    )
    df.write.format("recordio").mode("append").save(path)
    for row in spark.read.format("recordio").load(path).collect():
        assert row["features"].size == 1000000 and row["features"][999999] == 1000000.0


def test_null_features_fail(spark, tmp_path):
    df = spark.createDataFrame([(1.0, None)], T.StructType().add("label", "double").add("features", VectorUDT()))
    with pytest.raises(Exception, match="null"):
        df.write.format("recordio").mode("append").save(str(tmp_path / "n"))


def test_matrix_file(spark, tmp_path):
    path = str(tmp_path / "m")
    spark.createDataFrame([(2.0, DenseMatrix(2, 2, [1.0, 2.0, 3.0, 4.0]))], ["label", "features"]).write.format(
        "recordio").mode("append").save(path)
    row = spark.read.format("recordio").option("layout", "records").load(path).first()
    assert row["features"]["values"]["float32"]["values"] == [1.0, 3.0, 2.0, 4.0]
    assert row["label"]["values"]["float32"]["values"] == [2.0]


def test_uniform_frames_are_one_run():
    data = np.frombuffer(b"".join(struct.pack("<Ii", wire.MAGIC, 4) + b"abcd" for _ in range(5)), np.uint8)
    starts, lengths, end = wire.frame_spans(data)
    assert starts.tolist() == [8, 20, 32, 44, 56] and end == len(data)
    with pytest.raises(ValueError):
        wire.frame_spans(data[:-2])


def test_payloads_of_several_frames(spark):
    frame = lambda b: struct.pack("<Ii", wire.MAGIC, len(b)) + b + b"\0" * (-len(b) % 4)
    payloads = [[b"aa", b"bbbb"], [], [b"c"], [b"", b"dd", b"e" * 9]]
    df = spark.createDataFrame([(i, b"".join(map(frame, p))) for i, p in enumerate(payloads)], "i int, p binary").coalesce(1)
    rows = df.select("i", records.split_frames(F.col("p")).alias("b")).orderBy("i").collect()
    assert [[bytes(b) for b in r["b"]] for r in rows] == payloads
    # The first payload's last frame claims bytes of the next payload.
    cut = spark.createDataFrame([(frame(b"x" * 40)[:-8],), (frame(b"yyyy"),)], "p binary").coalesce(1)
    with pytest.raises(Exception, match="truncated|magic"):
        cut.select(records.split_frames(F.col("p"))).collect()


def test_ranges_of_a_file(spark, tmp_path):
    """Magic numbers inside bodies, with lengths behind them, at every place in a word; ranges from smaller than a frame up."""
    magic, length = np.frombuffer(np.array([wire.MAGIC, 16], "<u4").tobytes(), "<f4").astype(float)
    rows = [(float(k), Vectors.dense([float(k)] * (k % 5) + [magic, length] * (k % 4) + [1.0] * (k % 3))) for k in range(400)] + [(400.0, Vectors.dense([2.5] * 3000))]
    path = str(tmp_path / "one")
    spark.createDataFrame(rows, ["label", "features"]).coalesce(1).write.format("recordio").option("labelColumnName", "label").mode("append").save(path)
    (file, size), = files.data_files(path)
    for part in (8, 52, 1000, 16_000, size, 0):
        for chunk in (16, 1 << 20):
            if part < 100 and chunk == 16:
                continue
            reader = recordio.RecordReader({"path": path, "rangeBytes": str(part), "readBytes": str(chunk)}, recordio.RecordSource({"path": path}).schema())
            got = [label for p in reader.partitions() for batch in reader.read(p) for label in batch.column("label").to_pylist()]
            assert got == [label for label, _ in rows], (part, chunk)
    back = spark.read.format("recordio").option("rangeBytes", "2000").load(path)
    assert {(r.label, r.features) for r in back.collect()} == {(y, Vectors.dense(np.float32(x.toArray()).astype(float))) for y, x in rows}
    with open(file, "r+b") as held:
        held.truncate(size - 4)
    with pytest.raises(Exception, match="truncated"):
        spark.read.format("recordio").option("rangeBytes", "2000").load(path).count()


def test_no_task_of_the_ranges_query_has_the_whole_table(spark, monkeypatch):
    from featherline.plans import encoding
    from featherline.workspace import new_path

    paths = []
    monkeypatch.setattr(encoding, "WHOLE_FILE", 50_000)
    monkeypatch.setattr(encoding, "new_path", lambda session, name: paths.append(new_path(session, name)) or paths[-1])
    rows = encoding.recordio_ranges(spark, "/root/testdata/sf0.01").collect()
    assert len(files.data_files(paths[0])) > 1 and {r.keys for r in rows} == {r.n for r in rows}


def test_frames_of_a_chunk_are_decoded_a_bounded_number_at_a_time(spark, tmp_path):
    df = spark.range(40_000).select(F.col("id").cast("double").alias("label"), vectors.vector_of("id").alias("features"))
    df.coalesce(1).write.format("recordio").mode("append").save(str(tmp_path))
    for part in ("0", "400000"):
        source = recordio.RecordSource({"path": str(tmp_path), "rangeBytes": part})
        reader = source.reader(source.schema())
        batches = [batch for p in reader.partitions() for batch in reader.read(p)]
        assert max(b.num_rows for b in batches) <= recordio.FRAMES
        assert sorted(x for b in batches for x in b.column("label").to_pylist()) == list(range(40_000))
