"""Limits, orders and counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..staging import stage


def limit_per_group(df: DataFrame, group: str, order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` of each group; Spark limits groups before the shuffle already."""
    w = W.partitionBy(group).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= n).drop("_n")


def limit_kept(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows; all for 0."""
    if n < 0:
        raise ValueError("a limit is not negative")
    return df.orderBy(*order).limit(n) if n else df


def limit_candidates(df: DataFrame, order: Sequence[str], n: int | None) -> DataFrame:
    """The first ``n`` rows, none for 0, all for None."""
    if n is not None and n < 0:
        raise ValueError("a limit is not negative")
    return df if n is None else df.orderBy(*order).limit(n)


def by_components(path: Column) -> Column:
    """Sort key that compares paths component by component."""
    return F.split(path, "/")


def _ranged(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """``df`` dealt out by ranges of ``order``, with each row's range; written, so that every use sees the same ranges."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stage(df.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()), "ranged")


def ordinal(df: DataFrame, order: Sequence[str], name: str = "ordinal") -> DataFrame:
    """Rows numbered from 0 in ``order``: ranks within ranges plus the ranges' offsets, so no task gets all rows."""
    ranged = _ranged(df, order)
    inner = ranged.withColumn("_n", F.row_number().over(W.partitionBy("_part").orderBy(*order)))
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_size"))
    firsts = sizes.withColumn("_first", F.sum("_size").over(W.orderBy("_part")) - F.col("_size")).select("_part", "_first")  # a row for each range
    return inner.join(F.broadcast(firsts), "_part").withColumn(name, F.col("_first") + F.col("_n") - 1).drop("_part", "_n", "_first")


def with_collision_suffix(df: DataFrame, name: str, order: Sequence[str]) -> DataFrame:
    """Equal names get -01, -02, ... from the second on. A frequent name is spread over ranges, numbered there and shifted by what came before."""
    ranged = _ranged(df, [name, *order])
    inner = ranged.withColumn("_n", F.row_number().over(W.partitionBy("_part", name).orderBy(*order)) - 1)
    sizes = ranged.groupBy("_part", name).agg(F.count("*").alias("_size"))  # a name has as many rows here as ranges
    before = sizes.select("_part", F.col(name).alias("_name"), (F.sum("_size").over(W.partitionBy(name).orderBy("_part")) - F.col("_size")).alias("_before"))
    ends = ranged.groupBy("_part").agg(F.min(name).alias("_name"))  # only a range's first name can go on from the range before
    shift = before.join(ends, ["_part"]).where(before["_name"].eqNullSafe(ends["_name"])).select("_part", before["_name"].alias("_name"), "_before")
    both = inner.join(F.broadcast(shift.withColumnRenamed("_part", "_p")), (F.col("_part") == F.col("_p")) & F.col(name).eqNullSafe(F.col("_name")), "left")
    both = both.withColumn("_n", F.col("_n") + F.coalesce("_before", F.lit(0)))
    named = F.when((F.col("_n") == 0) | F.col(name).isNull(), F.col(name)).otherwise(F.format_string("%s-%02d", F.col(name), F.col("_n")))
    return both.withColumn(name, named).select(*df.columns)


def saved_counts(df: DataFrame, group: str, saved: Column) -> DataFrame:
    """Saved items per group and, with a null group, in total."""
    return df.rollup(group).agg(F.count_if(saved).alias("n_saved"), F.count("*").alias("n_seen"))


def error_rows(errors: DataFrame, key: str = "id", message: str = "error") -> DataFrame:
    """(key, message): each failing id once, with its smallest message."""
    return errors.groupBy(key).agg(F.min(message).alias(message))


def error_count(errors: DataFrame, key: str = "id", message: str = "error") -> DataFrame:
    """(count, n_messages): failing ids, and those with a message."""
    return error_rows(errors, key, message).agg(F.count("*").alias("count"), F.count(message).alias("n_messages"))


def error_report(errors: DataFrame, key: str = "id", message: str = "error") -> DataFrame:
    """(count, errors) with all failing ids in one map: for reports that a person reads; ``error_rows`` for tables of any size."""
    return error_rows(errors, key, message).agg(F.count("*").alias("count"), F.map_from_entries(F.collect_list(F.struct(key, message))).alias("errors"))


def counted(df: DataFrame, **conditions: Column) -> tuple[DataFrame, Observation]:
    """``df`` and its counters, filled by the action that computes it: rows, and those that meet each condition."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *(F.count_if(c).alias(k) for k, c in conditions.items())), seen
