"""The deduplication index: rebuilding it from what is there, and comparing two states."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import choose_sha1, truthy, url_key
from .dedup import last_by_key


#: File names of the two kinds of index, in the order in which they are looked for.
NAMES = {"filtered": "_filtered_index.jsonl", "global": "_global_index.jsonl"}


def mode(path: str, first_fields: Iterable[str] | None = None) -> str:
    """``filtered`` or ``global``, by the file's own name, else by the first entry's fields: target before path."""
    name = path.rstrip("/").rpartition("/")[2]
    for kind, known in NAMES.items():
        if name == known:
            return kind
    return "filtered" if "target" in set(first_fields or ()) else "global"


def find_index(root: str, exists: Callable[[str], bool], explicit: str | None = None) -> str:
    """The index of a folder: the given one, else the one that is there, else by the folder's name."""
    if explicit:
        return explicit
    root = root.rstrip("/")
    for name in NAMES.values():
        if exists(f"{root}/{name}"):
            return f"{root}/{name}"
    return f"{root}/{NAMES['filtered' if 'filter' in root.rpartition('/')[2].lower() else 'global']}"


def rebuild(images: DataFrame, previous: DataFrame, run_ts: Column) -> DataFrame:
    """An entry (sha1, url_md5, url, path, timestamp) for each image (path, meta_sha1, final_url, source, meta_ts[, content]).

    What the sidecar lacks comes from the previous entry of the same sha1, else of the same
    path, else a default; of several previous entries the last by ``line_no`` counts.
    """
    content = F.col("content") if "content" in images.columns else None
    own = images.withColumn("sha1", choose_sha1(truthy(F.col("meta_sha1")), F.col("path"), content))
    entry = lambda key, alias: last_by_key(previous, key, "line_no").select(F.col(key).alias(f"{alias}_key"), F.struct("url", "timestamp").alias(alias))
    both = own.join(entry("sha1", "p1"), F.col("sha1") == F.col("p1_key"), "left").join(entry("path", "p2"), F.col("path") == F.col("p2_key"), "left")
    prev = F.coalesce("p1", "p2")
    url = F.coalesce(truthy(F.col("final_url")), truthy(F.col("source")), prev["url"])
    return both.select("sha1", url_key(url).alias("url_md5"), url.alias("url"), "path", F.coalesce("meta_ts", prev["timestamp"], run_ts).alias("timestamp"))


def changes(old: DataFrame, new: DataFrame, key: str = "path") -> DataFrame:
    """(key, change) with added, removed, updated or same, over the last entries of both states."""
    row = lambda df, name: df.select(F.col(key), F.struct(*sorted(c for c in df.columns if c != key)).alias(name))
    both = row(old, "o").join(row(new, "n"), key, "full_outer")
    kind = F.when(F.col("o").isNull(), "added").when(F.col("n").isNull(), "removed").when(F.col("o").eqNullSafe(F.col("n")), "same").otherwise("updated")
    return both.select(key, kind.alias("change"))


def summary(changed: DataFrame) -> DataFrame:
    """One row with the number of each change."""
    return changed.agg(*(F.count_if(F.col("change") == k).alias(k) for k in ("added", "removed", "updated", "same")))


def key_difference(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Numbers of keys only in the new state, only in the old one, and in both."""
    both = old.select(key).distinct().withColumn("o", F.lit(1)).join(new.select(key).distinct().withColumn("n", F.lit(1)), key, "full_outer")
    return both.agg(F.count_if(F.col("o").isNull()).alias("only_new"), F.count_if(F.col("n").isNull()).alias("only_old"), F.count_if(F.col("o").isNotNull() & F.col("n").isNotNull()).alias("in_both"))
