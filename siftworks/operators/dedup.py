"""Removing what is known already: by key, by content, by perceptual hash."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import hamming


def first_by_key(df: DataFrame, key: Column, order: Sequence[str], name: str = "key") -> DataFrame:
    """One row per key, the first by ``order``; rows with a null key are dropped.

    A grouped minimum of a struct, so a key of any frequency is reduced before the shuffle.
    """
    rest = [c for c in df.columns if c not in order]
    row = F.struct(*order, *rest)
    picked = df.withColumn(name, key).where(F.col(name).isNotNull()).groupBy(name).agg(F.min_by(row, F.struct(*order)).alias("_row"))
    return picked.select(name, *(F.col(f"_row.{c}").alias(c) for c in df.columns))


def last_by_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """One row per key, the last by ``order``, as when entries overwrite each other."""
    row = F.struct(*(c for c in df.columns if c != key))
    picked = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(row, F.col(order)).alias("_row"))
    return picked.select(*(key if c == key else F.col(f"_row.{c}").alias(c) for c in df.columns))


def new_by_key(df: DataFrame, index: DataFrame, key: str) -> DataFrame:
    """Rows whose key the index does not hold; a null key is never held."""
    return df.join(index.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")


def near_seed(items: DataFrame, seeds: DataFrame, group: str, item_id: str, code: str = "code") -> DataFrame:
    """Items of a group with their distance to the group's seeds (columns seed_id, seed_code)."""
    joined = items.join(seeds.withColumnRenamed(code, "seed_code"), group)
    return joined.where(F.col(item_id) != F.col("seed_id")).withColumn("distance", hamming(F.col(code), F.col("seed_code")))


def without_seed_copies(items: DataFrame, seeds: DataFrame, group: str, item_id: str, threshold: int = 2) -> DataFrame:
    """Items that are no copies (``threshold`` bits) of one of their group's seeds."""
    gone = near_seed(items, seeds, group, item_id).where(F.col("distance") <= threshold).select(item_id).distinct()
    return items.join(gone, item_id, "left_anti")


def representatives(codes: DataFrame, id_col: str = "id", code: str = "code") -> DataFrame:
    """(id, representative): every item with the smallest id of its code."""
    least = codes.groupBy(code).agg(F.min(id_col).alias("representative"))
    return codes.select(id_col, code).join(least, code).select(id_col, "representative")


def banded_pairs(codes: DataFrame, radius: int, id_col: str = "id", code: str = "code", block: int = 512) -> DataFrame:
    """Pairs (a, b, distance) of different codes within ``radius`` bits, by the smallest ids of both: with radius + 1 bands, one of a pair's bands is equal.

    A band's value that many codes share is split into squares of about ``block`` by
    ``block`` codes, each its own group. Copies are not expanded: ``representatives`` tells
    which items a code stands for.
    """
    bands = radius + 1
    edges = [64 * k // bands for k in range(bands + 1)]
    part = lambda lo, hi: F.shiftrightunsigned(code, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1 if hi - lo < 64 else -1))
    own = codes.where(F.col(code).isNotNull()).groupBy(code).agg(F.min(id_col).alias("rep"))
    keyed = own.select(code, "rep", F.posexplode(F.array(*(part(lo, hi) for lo, hi in zip(edges, edges[1:])))).alias("band", "value"))
    sizes = keyed.groupBy("band", "value").agg(F.count("*").alias("n")).where("n > 1").withColumn("last", F.ceil(F.col("n") / block).cast("int") - 1)
    many = F.broadcast(sizes.where("last > 0"))  # at most bands * codes / block rows
    single = keyed.join(many.select("band", "value"), ["band", "value"], "left_anti").select("band", "value", code, "rep", F.lit(0).alias("at"), F.lit(0).alias("last"))
    split = keyed.join(many, ["band", "value"]).select("band", "value", code, "rep", F.pmod(F.xxhash64(code), F.col("last") + 1).cast("int").alias("at"), "last")
    placed = single.union(split)
    low = placed.select("band", "value", code, "rep", F.col("at").alias("x"), F.explode(F.sequence("at", "last")).alias("y"))
    high = placed.select("band", "value", F.col(code).alias("other"), F.col("rep").alias("other_rep"), F.explode(F.sequence(F.lit(0), "at")).alias("x"), F.col("at").alias("y"))
    once = (F.col("x") < F.col("y")) | (F.col(code) < F.col("other"))
    near = low.join(high, ["band", "value", "x", "y"]).where(once & (F.col(code) != F.col("other")) & (hamming(F.col(code), F.col("other")) <= radius))
    return near.select(F.least("rep", "other_rep").alias("a"), F.greatest("rep", "other_rep").alias("b"), hamming(F.col(code), F.col("other")).alias("distance")).distinct()
