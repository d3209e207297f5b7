"""A fixed-size sample in hash order, the same on every run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

HEX_DIGITS = 4


def hash_sample(df: DataFrame, n: int, *key: str | Column) -> DataFrame:
    """The ``n`` rows whose key hashes lowest (all rows, if there are no more).

    ``key`` tells rows apart; rows it does not tell apart should be alike. Rows are counted by the first digits of their hash; whole digit
    buckets below the cut need no order, and only the bucket at the cut is sorted.
    """
    if n < 1:
        raise ValueError("sample size must be at least 1")
    digest = F.md5(F.concat_ws("|", *[(F.col(k) if isinstance(k, str) else k).cast("string") for k in key]))
    hashed = df.withColumn("_hash", digest).withColumn("_bucket", F.substring("_hash", 1, HEX_DIGITS))
    counts = {r["_bucket"]: r["n"] for r in hashed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("n")).collect()}
    taken, cut = 0, None
    for bucket in sorted(counts):
        if taken + counts[bucket] > n:
            cut = bucket
            break
        taken += counts[bucket]
    if cut is None:
        return df
    whole = hashed.filter(F.col("_bucket") < cut).select(*df.columns)
    if taken == n:
        return whole
    partial = hashed.filter(F.col("_bucket") == cut).orderBy("_hash", *key).limit(n - taken).select(*df.columns)
    return whole.unionByName(partial)
