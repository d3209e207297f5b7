"""Mixing sources to target weights: blocks of equally many words, allocated by Sainte-Laguë quotients.

Targets: sources in code point order (null last) weigh 1, 2, 3, 1, 2, 3 ... and share all words; a target
stops at ``most`` times its source's words and the excess goes to the others by weight, until none is above.

Shards: a source is dealt by a seeded hash into as many shards as its size asks for, and shards of many
sources meet in the same groups, so no task holds more than a bounded part of a source. There is a group for every
``GROUP_SHARDS`` shards, so the mix follows from the documents alone and not from the cluster. In every group
the blocks that its targets come to are allocated one by one to the source with the highest quotient
target / (2 * blocks held + 1); ties go to the source first in order. The quota of a source in a shard is
an integer number of blocks.

Selection: the documents of a source and shard, in the order of a seeded hash, make a line of words.
The mix takes the line from its start, block by block, and begins again at its end, ``most`` times at
most; a last block that passes the end of the last round is cut there.

A null text has no words; null sources are one source; empty tables give empty results; repeated rows are
separate documents. A text of any length is one document of the line, taken in part where the mix ends within it. Extra columns pass through untouched, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from featherline.operators.ordered import running
from featherline.workspace import written

WORD = r"[^\x20\x09-\x0D]+"
BLOCK_WORDS, SHARD_WORDS, MOST, SEED = 16, 1_000_000, 3, 20_240
GROUP_SHARDS = 256


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, most: int = MOST) -> DataFrame:
    """``source, source_size`` with ``weight`` and ``target``; one row per source comes in and goes out."""
    place = running(
        sizes.withColumn("_none", F.col("source").isNull()), [], [F.col("_none"), F.col("source")], {"_place": F.lit(1)})
    table = written(place.select(
        "source", "source_size", (F.lit(most) * F.col("source_size")).cast("double").alias("_most"),
        ((F.col("_place") - 1) % 3 + 1).cast("double").alias("weight")), "sources")
    whole = float(table.agg(F.sum("source_size")).first()[0] or 0)
    rate, capped = 0.0, -1
    while True:
        above = F.col("weight") * F.lit(rate) > F.col("_most")
        found = table.agg(
            F.coalesce(F.sum(F.when(above, F.col("_most"))), F.lit(0.0)), F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0.0)),
            F.count(F.when(above, 1))).first()
        if found[2] == capped or not found[1]:
            break
        rate, capped = (whole - found[0]) / found[1], found[2]
    return table.select("source", "source_size", "weight", F.least(F.col("weight") * F.lit(rate), F.col("_most")).alias("target"))


def apportion(votes: np.ndarray, blocks: int) -> np.ndarray:
    """Sainte-Laguë: ``blocks`` seats to the highest quotients votes / (2 * seats + 1), ties to the first.

    The seats that any allocation by quotients contains are found from a divisor; the rest go one by one.
    """
    seats = np.zeros(len(votes), np.int64)
    total = votes.sum()
    if not len(votes) or total <= 0 or blocks <= 0:
        return seats
    low, high = 0.0, float(blocks + len(votes)) / total * 2
    for _ in range(80):
        middle = (low + high) / 2
        if np.floor(votes * middle + 0.5).sum() <= blocks:
            low = middle
        else:
            high = middle
    seats = np.floor(votes * low + 0.5).astype(np.int64)
    # Votes that are level to rounding may have taken a tied seat or left one.
    while seats.sum() > blocks:
        last = np.where(seats > 0, votes / np.maximum(2 * seats - 1, 1), np.inf)
        seats[len(votes) - 1 - np.argmin(last[::-1])] -= 1
    while seats.sum() < blocks:
        seats[np.argmax(votes / (2 * seats + 1))] += 1
    return seats


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, most: int = MOST,
        seed: int = SEED, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all by default) as struct ``row`` with ``size``, ``source_size``, ``target``, ``taken``."""
    sized = docs.select(
        F.struct(*[docs[c] for c in keep or docs.columns]).alias("row"), docs["doc_id"].alias("_id"), docs["source"].alias("_source"),
        word_count(docs["text"]).alias("size"))
    totals = docs.select("source", word_count(docs["text"]).alias("_words")).groupBy("source").agg(F.sum("_words").alias("source_size"))
    sources = source_targets(totals, most)
    shards = F.greatest(F.lit(1), F.ceil(F.col("source_size") / F.lit(shard_words))).cast("long")
    groups = max(1, -(-(sources.agg(F.sum(shards)).first()[0] or 0) // GROUP_SHARDS))
    facts = sources.select(
        F.col("source").alias("_of"), "source_size", "target", shards.alias("_shards"),
        F.pmod(F.xxhash64(F.lit(seed), F.col("source")), F.lit(groups)).alias("_begin"))
    placed = sized.join(facts, F.col("_source").eqNullSafe(F.col("_of"))).withColumn(
        "_shard", F.pmod(F.xxhash64(F.lit(seed + 1), F.col("_id"), F.col("size")), F.col("_shards"))).drop("_of")
    held = placed.groupBy("_source", "_shard").agg(
        F.sum("size").alias("_held"), F.first("target").alias("_target"), F.first("source_size").alias("_all"),
        F.first("_begin").alias("_begin"))
    votes = held.select(
        "_source", "_shard", "_held", F.pmod(F.col("_begin") + F.col("_shard"), F.lit(groups)).cast("int").alias("_group"),
        F.when(F.col("_all") > 0, F.col("_target") * F.col("_held") / F.col("_all")).otherwise(0.0).alias("_votes"))

    def allocate(group: pd.DataFrame) -> pd.DataFrame:
        group = group.assign(_none=group["_source"].isna()).sort_values(["_none", "_source", "_shard"]).reset_index(drop=True)
        v = group["_votes"].to_numpy()
        group["_blocks"] = apportion(v, int(np.floor(v.sum() / block_words + 0.5)))
        return group[["_source", "_shard", "_held", "_blocks"]]

    quotas = votes.groupBy("_group").applyInPandas(allocate, "_source string, _shard long, _held long, _blocks long").select(
        F.col("_source").alias("_s"), F.col("_shard").alias("_h"), "_held",
        F.least(F.col("_blocks") * block_words, F.col("_held") * most).alias("_quota"))
    line = Window.partitionBy("_source", "_shard").orderBy(F.xxhash64(F.lit(seed + 2), F.col("_id")), "_id", "size")
    lined = placed.withColumn("_end", F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    chosen = lined.join(quotas, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_shard") == F.col("_h")))
    rounds = F.when(F.col("_held") > 0, F.expr("_quota div _held")).otherwise(F.lit(0))
    left = F.col("_quota") - rounds * F.col("_held")
    part = F.greatest(F.lit(0), F.least(F.col("size"), left - (F.col("_end") - F.col("size"))))
    return chosen.select("row", "size", "source_size", "target", (rounds * F.col("size") + part).cast("long").alias("taken"))


def mixed_texts(docs: DataFrame, **parameters) -> DataFrame:
    """The mix itself: a row of ``docs`` for every whole copy taken, and one with the first words of a part taken."""
    mixed = mix(docs, **parameters).withColumn("_copies", F.when(F.col("size") > 0, F.ceil(F.col("taken") / F.col("size"))).otherwise(0).cast("int"))
    each = mixed.where("_copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    left = (F.col("taken") - (F.col("_copy") - 1) * F.col("size")).cast("int")
    head = F.array_join(F.slice(F.regexp_extract_all(F.col("row.text"), F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0)), F.lit(1), left), "")
    text = F.when(left < F.col("size"), head).otherwise(F.col("row.text"))
    return each.select(*[(text if c == "text" else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
