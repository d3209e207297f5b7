"""Queries over streams: each runs to the end of what is there, and its output is read back."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from featherline.algorithms import kmeans
from featherline.functions import vectors
from featherline.plans.models import ENTRIES, NEAREST, embedded, mean_centers
from featherline.plans.registry import query, table
from featherline.streaming.decayed import DecayedKMeans
from featherline.streaming.scoring import score_stream, write_records
from featherline.operators.ordered import running
from featherline.workspace import new_path, written


def streamed(spark, folder: str, name: str) -> DataFrame:
    """A table of the folder as a stream of its files: a pattern of the one name, as a stream's plain path must be a folder and a table may be a file."""
    schema = table(spark, folder, name).schema
    return spark.readStream.schema(schema).parquet(f"{folder}/[{name[0]}]{name[1:]}.parquet")


@query("stream_score", f"""WITH {ENTRIES}, {NEAREST}
    SELECT vec_id, round(d, 6) AS distance_to_cluster, cluster::DOUBLE AS closest_cluster FROM nearest""")
def stream_score(spark, folder):
    model = kmeans.KMeansTableModel.of(mean_centers(embedded(spark, folder)))
    stream = streamed(spark, folder, "embeddings").select("vec_id", vectors.from_array("embedding").alias("features"))
    path = new_path(spark, "scores")
    score_stream(model, stream, path, new_path(spark, "progress")).awaitTermination()
    return spark.read.parquet(path).select(
        "vec_id", F.round("distance_to_cluster", 6).alias("distance_to_cluster"), "closest_cluster")


@query("stream_recordio", "SELECT event_id::VARCHAR AS event_id, value::FLOAT::DOUBLE AS label, user_id::DOUBLE AS x FROM events")
def stream_recordio(spark, folder):
    stream = streamed(spark, folder, "events").select(
        F.col("event_id").cast("string").alias("event_id"), F.col("value").alias("label"), vectors.vector_of("user_id").alias("features"))
    path = new_path(spark, "stream-records")
    write_records(stream, path, new_path(spark, "progress"), {"uidColumnName": "event_id"}).awaitTermination()
    back = spark.read.format("recordio").option("uidColumnName", "event_id").load(path)
    return back.select("event_id", "label", vectors.to_array("features")[0].alias("x"))


HALF_LIFE = 200
BATCHES = 3


def decayed_sql() -> str:
    """One batch after the other as CTEs: closest center, means, decayed weights, moved centers."""
    steps = [ENTRIES, f"part AS (SELECT vec_id, ntile({BATCHES}) OVER (ORDER BY vec_id) - 1 AS batch FROM embeddings)",
             "s0 AS (SELECT cluster, i, c, 0::DOUBLE AS w FROM centers)"]
    for b in range(BATCHES):
        steps += [
            f"""d{b} AS (SELECT e.vec_id, s.cluster, sum((e.v - s.c) ^ 2) AS d FROM entries e JOIN part p ON e.vec_id = p.vec_id
                AND p.batch = {b} JOIN s{b} s ON e.i = s.i GROUP BY e.vec_id, s.cluster)""",
            f"""n{b} AS (SELECT vec_id, cluster FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, cluster) AS rn
                FROM d{b}) WHERE rn = 1)""",
            f"""m{b} AS (SELECT n.cluster, e.i, avg(e.v) AS mean, count(*) AS n FROM n{b} n JOIN entries e ON n.vec_id = e.vec_id
                GROUP BY n.cluster, e.i)""",
            f"""s{b + 1} AS (SELECT cluster, i, CASE WHEN w + n = 0 THEN c ELSE (c * w + mean * n) / (w + n) END AS c, w + n AS w FROM (
                SELECT s.cluster, s.i, s.c, s.w * 0.5 ^ ((SELECT count(*) FROM n{b}) / {HALF_LIFE}::DOUBLE) AS w,
                    coalesce(m.mean, s.c) AS mean, coalesce(m.n, 0) AS n
                FROM s{b} s LEFT JOIN m{b} m ON s.cluster = m.cluster AND s.i = m.i))""",
        ]
    return f"""WITH {', '.join(steps)}
    SELECT cluster::BIGINT AS cluster, (i - 1)::INTEGER AS position, round(c, 6) AS center, round(w, 6) AS weight FROM s{BATCHES}"""


# Files of a batch; their number, not their size, is what a trigger of the stream counts.
FILES = 4


def feed(df: DataFrame, path: str, batches: int) -> None:
    """Write ``vec_id, x`` in equal parts by rank of the key, ``FILES`` files each, as a feed would bring them."""
    ranked = written(running(
        df.select("vec_id", vectors.to_array("features").alias("x")), [], [F.col("vec_id")], {"rank": F.lit(1)}), "ranked")
    rows = ranked.count()
    sizes = [rows // batches + (1 if b < rows % batches else 0) for b in range(batches)]
    bounds = [0, *np.cumsum(sizes).tolist()]
    for low, high in zip(bounds, bounds[1:]):
        part = ranked.filter((F.col("rank") > low) & (F.col("rank") <= high)).select("vec_id", "x")
        part.repartition(FILES).write.mode("append").parquet(path)


@query("stream_decay", decayed_sql())
def stream_decay(spark, folder):
    """Three files of embeddings, one batch each, moving the label means."""
    df = embedded(spark, folder)
    source = new_path(spark, "arrivals")
    feed(df, source, BATCHES)
    stream = spark.readStream.schema("vec_id bigint, x array<double>").option("maxFilesPerTrigger", FILES).parquet(source)
    learner = DecayedKMeans(spark, new_path(spark, "centers"), mean_centers(df), HALF_LIFE)
    learner.start(stream.select(vectors.from_array("x").alias("features")), new_path(spark, "progress")).awaitTermination()
    state = spark.read.parquet(learner._path(BATCHES - 1))
    return state.select("cluster", F.posexplode("center").alias("position", "center"), F.round("weight", 6).alias("weight")).withColumn(
        "center", F.round("center", 6))
