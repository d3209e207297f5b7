import struct
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F, types as T

from featherline.operators import packing


class IntEncoder:
    content_type = "application/octet-stream"

    def validate(self, schema):
        if "a" not in schema.fieldNames():
            raise ValueError("column a expected")

    def encode(self):
        return F.unhex(F.lpad(F.hex("a"), 8, "0"))


class IntDecoder:
    schema = T.StructType([T.StructField("int", T.IntegerType())])
    accepts = "application/octet-stream"

    def decode(self, body):
        numbers = [n for (n,) in struct.iter_unpack(">i", body)]
        return pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32())], names=["int"])


def doubled(payload):
    return b"".join(struct.pack(">i", 2 * n) for (n,) in struct.iter_unpack(">i", payload))


def ints(spark):
    return spark.range(33).select(F.col("id").cast("int").alias("a")).coalesce(1)


@pytest.mark.parametrize("bounds", [{"max_bytes": b} for b in (4, 5, 8, 9)] + [{"max_records": r} for r in (1, 4)] + [{}])
def test_rows_keep_their_answers(spark, bounds):
    rows = packing.score_payloads(ints(spark), IntEncoder(), IntDecoder(), doubled, **bounds).collect()
    assert [(r["a"], r["int"]) for r in rows] == [(i, 2 * i) for i in range(33)]


def test_predictions_alone(spark):
    scored = packing.score_payloads(ints(spark), IntEncoder(), IntDecoder(), doubled, keep_input=False)
    assert scored.columns == ["int"] and [r["int"] for r in scored.collect()] == [2 * i for i in range(33)]


def test_row_above_the_bound_fails(spark):
    with pytest.raises(Exception, match="above the payload bound"):
        packing.score_payloads(ints(spark), IntEncoder(), IntDecoder(), doubled, max_bytes=3).collect()


@pytest.mark.parametrize("bounds", [{"max_bytes": 0}, {"max_records": 0}])
def test_bounds_below_one(spark, bounds):
    with pytest.raises(ValueError):
        packing.score_payloads(ints(spark), IntEncoder(), IntDecoder(), doubled, **bounds)


@pytest.mark.parametrize("broken", [lambda p: doubled(p)[:-4], lambda p: doubled(p) + b"\0\0\0\0"])
def test_other_number_of_answers_fails(spark, broken):
    with pytest.raises(Exception, match="came back"):
        packing.score_payloads(ints(spark), IntEncoder(), IntDecoder(), broken).collect()


@pytest.mark.parametrize("records,sizes", [(1, [1] * 33), (4, [4] * 8 + [1]), (40, [33])])
def test_record_bound_is_exact(spark, records, sizes):
    df = ints(spark).select(IntEncoder().encode().alias("body"))
    rows = packing.pack_partitions(df, max_records=records).orderBy("batch_id").collect()
    assert [r["n_rows"] for r in rows] == sizes and [r["batch_id"] for r in rows] == list(range(len(sizes)))


def test_partitions_are_not_shuffled(spark):
    df = spark.range(0, 100, 1, 4).select(F.col("id").cast("string").alias("body"))
    packed = packing.pack_partitions(df)
    assert packed.count() == 4 and "Exchange" not in packed._jdf.queryExecution().executedPlan().toString()


def greedy(sizes, groups, max_bytes, max_records):
    out, previous = [], None
    for size, group in zip(sizes, groups):
        if out and group == previous and out[-1][0] + size <= max_bytes and out[-1][1] < max_records:
            out[-1] = (out[-1][0] + size, out[-1][1] + 1)
        else:
            out.append((size, 1))
        previous = group
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 9), st.booleans()), max_size=60), st.integers(9, 30), st.integers(1, 8),
       st.lists(st.integers(1, 15), min_size=1, max_size=6))
def test_filler_equals_the_row_by_row_walk(rows, max_bytes, max_records, steps):
    sizes = [s for s, _ in rows]
    starts = [bool(f) or i == 0 for i, (_, f) in enumerate(rows)]
    groups = np.cumsum(starts).tolist()
    filler, payloads, position, turn = packing.Filler(max_bytes, max_records), [], 0, 0
    while position < len(sizes):
        stop = min(len(sizes), position + steps[turn % len(steps)])
        fresh = np.array(starts[position:stop])
        fresh[0] = fresh[0] and position > 0 or position == 0
        for begin, end, opens in filler.stretches(np.array(sizes[position:stop]), fresh):
            used = sum(sizes[position + begin : position + end])
            if opens:
                payloads.append((used, end - begin))
            else:
                payloads[-1] = (payloads[-1][0] + used, payloads[-1][1] + end - begin)
        position, turn = stop, turn + 1
    assert payloads == greedy(sizes, groups, max_bytes, max_records)


def test_groups_and_shards(spark):
    rng = np.random.default_rng(5)
    # One group holds most rows; shards split it.
    rows = [(("hot" if i % 3 else f"g{i % 7}"), i, bytes(int(rng.integers(0, 50)))) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, i int, body binary")
    packed = packing.pack_groups(df, ["g"], ["i"], max_bytes=200, max_records=9, shards=F.col("i") % 5)
    got = {(r["g"], r["shard"], r["batch_id"]): (r["n_bytes"], r["n_rows"]) for r in packed.collect()}
    want = {}
    for key in {(g, i % 5) for g, i, _ in rows}:
        sizes = [len(b) for g, i, b in rows if (g, i % 5) == key]
        for number, payload in enumerate(greedy(sizes, [0] * len(sizes), 200, 9)):
            want[(*key, number)] = payload
    assert got == want


def test_rows_of_a_large_group_get_their_shards_in_many_tasks(spark):
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 10 == 0, "fr").otherwise("en").alias("lang"))
    kept = {name: spark.conf.get(name) for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        for name, value in zip(kept, ("-1", "false")):
            spark.conf.set(name, value)
        found = packing.with_shards(df, ["lang"], "doc_id", 100).withColumn("task", F.spark_partition_id()).collect()
    finally:
        for name, value in kept.items():
            spark.conf.set(name, value)
    assert len(found) == 4000 and all(r.shard_of == r.doc_id % (4 if r.lang == "fr" else 36) for r in found)
    most = max(Counter(r.task for r in found if r.lang == "en").values())
    assert most < 3600 / 3
