import numpy as np
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from featherline.algorithms import kmeans
from featherline.functions import vectors
from featherline.sources import files
from featherline.streaming.decayed import DecayedKMeans
from featherline.streaming.scoring import score_stream, write_records


def arrivals(spark, tmp_path, batches):
    path = str(tmp_path / "in")
    for rows in batches:
        spark.createDataFrame(rows, "id int, x array<double>").coalesce(1).write.mode("append").parquet(path)
    return (spark.readStream.schema("id int, x array<double>").option("maxFilesPerTrigger", 1).parquet(path)
            .select("id", vectors.from_array("x").alias("features")))


BATCHES = [[(i + 10 * b, [float(i), float(b)]) for i in range(10)] for b in range(3)]


def test_stream_equals_batch(spark, tmp_path):
    stream = arrivals(spark, tmp_path, BATCHES)
    model = kmeans.KMeansTableModel.of(np.array([[0.0, 0.0], [9.0, 2.0]]))
    score_stream(model, stream, str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination()
    batch = spark.createDataFrame([r for b in BATCHES for r in b], "id int, x array<double>").select(
        "id", vectors.from_array("x").alias("features"))
    want = {r["id"]: r["closest_cluster"] for r in model.transform(batch).collect()}
    assert {r["id"]: r["closest_cluster"] for r in spark.read.parquet(str(tmp_path / "out")).collect()} == want


def test_record_stream_and_replay(spark, tmp_path):
    stream = arrivals(spark, tmp_path, BATCHES).withColumn("label", F.col("id").cast("double"))
    out = str(tmp_path / "out")
    write_records(stream, out, str(tmp_path / "c")).awaitTermination()
    read = lambda: sorted(r["label"] for r in spark.read.format("recordio").load(out).collect())
    assert read() == [float(i) for i in range(30)]
    assert all("/batch-" in path for path, _ in files.data_files(out))
    # Progress of the last batch is lost: it runs again and replaces its files.
    (tmp_path / "c" / "commits" / "2").unlink()
    crc = tmp_path / "c" / "commits" / ".2.crc"
    if crc.exists():
        crc.unlink()
    write_records(stream, out, str(tmp_path / "c")).awaitTermination()
    assert read() == [float(i) for i in range(30)]


def test_decay(spark, tmp_path):
    batches = [[(0, [0.0]), (1, [2.0])], [(2, [4.0]), (3, [4.0])]]
    stream = arrivals(spark, tmp_path, batches)
    learner = DecayedKMeans(spark, str(tmp_path / "state"), np.array([[1.0], [100.0]]), half_life=2)
    learner.start(stream, str(tmp_path / "c")).awaitTermination()
    centers, weight = learner.state(1)
    # First batch: mean 1, weight 2. It halves to 1; then two rows at 4: (1*1 + 4*2) / 3.
    assert centers.tolist() == [[3.0], [100.0]] and weight.tolist() == [3.0, 0.0]
    # A batch that runs twice gives the same state.
    learner.update(spark.createDataFrame([(Vectors.dense([4.0]),)] * 2, ["features"]), 1)
    assert learner.state(1)[0].tolist() == [[3.0], [100.0]]


def test_no_decay_is_a_running_mean(spark, tmp_path):
    learner = DecayedKMeans(spark, str(tmp_path / "state"), np.array([[0.0]]))
    for batch, rows in enumerate([[1.0, 2.0], [6.0]]):
        learner.update(spark.createDataFrame([(Vectors.dense([x]),) for x in rows], ["features"]), batch)
    assert learner.state(1)[0].tolist() == [[3.0]]


def test_tables_as_streams_whether_file_or_folder(spark, tmp_path):
    from featherline.plans.streams import streamed

    rows = spark.range(40)
    rows.repartition(4).write.parquet(str(tmp_path / "events.parquet"))
    rows.repartition(2).write.parquet(str(tmp_path / "elsewhere"))
    rows.coalesce(1).write.parquet(str(tmp_path / "single"))
    next((tmp_path / "single").glob("part-*")).rename(tmp_path / "embeddings.parquet")
    for name in ("events", "embeddings"):
        out, progress = str(tmp_path / f"out-{name}"), str(tmp_path / f"progress-{name}")
        writer = streamed(spark, str(tmp_path), name).writeStream.format("parquet").option("checkpointLocation", progress)
        writer.trigger(availableNow=True).start(out).awaitTermination()
        assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(40))
