"""Histogram sort: shards of near-equal bytes in key order, with splitters found by counting."""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.common import load, ranked, staged

#: A splitter may miss its place by this part of a shard; by the second where that keeps equal texts together.
TOLERANCE, GROUP_TOLERANCE = 0.001, 0.01
#: Bits by which each round refines the probes, most significant first; together the 64 of a key.
ROUNDS = (12, 12, 12, 12, 12, 4)
_LOW, _MASK = -(1 << 63), (1 << 64) - 1


def _prefix(key: str, shift: int) -> Column:
    """A key without its ``shift`` lowest bits, unsigned and in the key's signed order."""
    return F.shiftrightunsigned(F.col(key).bitwiseXOR(F.lit(_LOW)), shift)


def _probe(rows: DataFrame, key: str, goals: list[float], below: int, shard: float, last: float):
    """Boundaries of ``key`` below which the rows come to ``goals`` bytes, ``below`` being there already.

    Each round counts the exact bytes between the probes that divide every cell with an open goal into up
    to 4096 parts; only these counts reach the driver. A goal is settled once a probe lies near enough, or
    lies within ``last`` of the rows of a single key around the goal. Returns {goal: boundary} and, for goals
    left inside a single key, {goal: (key, bytes below it)}.
    """
    settled: dict[float, int] = {}
    stuck: dict[float, tuple[int, int]] = {}
    cells, shift = {0: (below, goals)}, 64
    for bits in ROUNDS:
        near = rows if shift == 64 else rows.filter(_prefix(key, shift).isin(list(cells)))
        shift -= bits
        parts: dict[int, list[tuple[int, int, int, int]]] = {cell: [] for cell in cells}
        counts = near.groupBy(_prefix(key, shift).alias("p")).agg(F.sum("size"), F.min(key), F.max(key))
        for prefix, size, least, most in counts.collect():
            prefix &= _MASK
            parts[prefix >> bits].append((prefix, size, least - _LOW, most - _LOW))
        inside = {}
        for cell, (begin, open_goals) in cells.items():
            found = sorted(parts[cell])
            sums = list(accumulate((size for _, size, _, _ in found), initial=begin))
            for goal in open_goals:
                at = min(bisect_right(sums, goal) - 1, len(found) - 1)
                before, after = goal - sums[at], sums[at + 1] - goal
                prefix, _, least, most = found[at]
                if min(before, after) <= (last if least == most else TOLERANCE) * shard:
                    settled[goal] = least if before <= after else most + 1
                elif least == most:
                    stuck[goal] = (least, sums[at])
                else:
                    inside.setdefault(prefix, (sums[at], []))[1].append(goal)
        cells = inside
        if not cells:
            break
    return settled, stuck


def splitters(rows: DataFrame, shards: int) -> list[tuple[int, int]]:
    """The smallest (key1, key2) of shards 1, 2, ... for rows (key1, key2, size), sizes above 0.

    Rows of one key1 stay together where that moves a splitter by no more than ``GROUP_TOLERANCE``; a larger
    group is cut by key2. Rows that agree in both keys can't be cut.
    """
    whole = rows.agg(F.sum("size")).first()[0]
    if not whole:
        return []
    shard = whole / shards
    first, stuck = _probe(rows, "key1", [whole * j / shards for j in range(1, shards)], 0, shard, GROUP_TOLERANCE)
    found = {goal: (key, 0) for goal, key in first.items()}
    for value, begin in sorted(set(stuck.values())):
        goals = [goal for goal, where in stuck.items() if where[0] == value]
        group = rows.filter(F.col("key1") == F.lit(value + _LOW))
        # A single row larger than a shard: either side of it is as near as one can get.
        second, rest = _probe(group, "key2", goals, begin, shard, float("inf"))
        found |= {goal: (value, key) if key <= _MASK else (value + 1, 0) for goal, key in second.items()}
        assert not rest
    return [(key1 + _LOW, key2 + _LOW) for _, (key1, key2) in sorted(found.items()) if key1 <= _MASK]


def shard_rows(rows: DataFrame, shards: int = 16) -> DataFrame:
    """``rows`` with shard and slot, given key1, key2 (long) and size (above 0).

    The rows are exchanged once, by the sort that also numbers them; the sort deals by sampled ranges and so
    uses all tasks, however few the shards. Rows that agree in both keys share a shard and may swap slots.
    """
    shard = F.lit(0)
    for key1, key2 in splitters(rows.select("key1", "key2", "size"), shards):
        above = (F.col("key1") > key1) | ((F.col("key1") == key1) & (F.col("key2") >= F.lit(key2)))
        shard = shard + above.cast("int")
    order = ranked(rows.withColumn("shard", shard), [F.col("key1"), F.col("key2")])
    begins = order.groupBy("shard").agg(F.min("rank").alias("begin"))
    return (order.join(F.broadcast(begins), "shard")  # a row for each shard
            .withColumn("slot", F.col("rank") - F.col("begin")).drop("rank", "begin"))


def text_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, size (UTF-8 bytes plus 1), text_crc32 and the sort keys: a hash of the text, then one of the id.

    A null text has no bytes and counts as equal to an empty one; rows with null or equal ids are ordinary.
    """
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    return docs.select(F.col(id_col).alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("key1"),
                       F.xxhash64(F.lit("id"), F.col(id_col)).alias("key2"))


def shard_documents(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, size, text_crc32, shard and slot of every row: shards hold near-equal bytes.

    Equal texts are neighbours in the sort, so they share a shard unless that would unbalance it. Where
    single texts outweigh a shard, sizes come as near as uncut rows allow, and shards may stay empty. An
    empty table gives an empty result; other columns are ignored.
    """
    return shard_rows(staged(text_rows(docs, id_col, text_col)), shards).withColumnRenamed("id", id_col)


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document under the law of equal bytes."""
    return shard_documents(load(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
