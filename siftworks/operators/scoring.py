"""Scores of items against a few constant vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import cosine

#: Names of the five prompts whose vectors items are compared with.
PROMPTS = ("indoor", "outdoor", "tidy", "messy", "moderate")


def prompt_scores(items: DataFrame, prompts: DataFrame, vector: str = "embedding", names: tuple[str, ...] = PROMPTS) -> DataFrame:
    """``items`` with a cosine column for each named prompt of ``prompts`` (name, prompt_vector).

    The prompts become one row of a struct, whose size is the number of names; it is joined
    once, so items are neither multiplied nor shuffled.
    """
    one = prompts.where(F.col("name").isin(*names)).agg(*(F.first(F.when(F.col("name") == n, F.col("prompt_vector")), ignorenulls=True).alias(f"_{n}") for n in names))
    joined = items.crossJoin(F.broadcast(one))
    return joined.withColumns({n: cosine(F.col(vector), F.col(f"_{n}")) for n in names}).drop(*(f"_{n}" for n in names))


def route(keep: Column) -> Column:
    return F.when(keep, "keep").otherwise("reject")
