"""Versions of the prompts that a judge is asked with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def versions(spark: SparkSession, folder: str) -> DataFrame:
    """(name, version, prompt) of the files ``<name>_v<version>.txt`` in a folder."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", "*_v*.txt").load(folder)
    name = lambda k: F.regexp_extract("path", r"([^/]*)_v([0-9]+)\.txt$", k)
    return raw.select(name(1).alias("name"), name(2).cast("int").alias("version"), F.decode("content", "UTF-8").alias("prompt")).where("version is not null")


def prompt(known: DataFrame, name: str, version: int | None = None) -> str:
    """The prompt of a version, by default the latest."""
    own = known.where(F.col("name") == name)
    row = (own if version is None else own.where(F.col("version") == version)).orderBy(F.desc("version")).first()
    if row is None:
        raise KeyError(f"no prompt {name}, version {version}")
    return row.prompt
