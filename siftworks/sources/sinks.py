"""Writing results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import limits


def append_index(entries: DataFrame, path: str) -> None:
    """Index entries as JSON lines, added to what is there."""
    entries.write.mode("append").option("ignoreNullFields", "false").json(path)


def rewrite_index(entries: DataFrame, path: str, order: str = "path", dry_run: bool = False) -> DataFrame:
    """The whole index anew, sorted; returns what was written (the entries, for a dry run).

    It is written beside the old one, which then moves aside before the new one takes its
    place and goes last. After a crash between the moves, the next call puts the old one back.
    """
    if dry_run:
        return entries.orderBy(order)
    spark, base = entries.sparkSession, path.rstrip("/")
    jvm = spark._jvm.org.apache.hadoop.fs.Path
    here, fresh, old = jvm(base), jvm(base + ".new"), jvm(base + ".old")
    fs = here.getFileSystem(spark._jsc.hadoopConfiguration())
    restore_index(spark, path)
    schema = entries.schema
    entries.orderBy(order).write.mode("overwrite").option("ignoreNullFields", "false").json(base + ".new")
    fs.delete(old, True)
    if fs.exists(here) and not fs.rename(here, old):
        raise OSError(f"could not move {base} aside")
    if not fs.rename(fresh, here):
        raise OSError(f"could not put the new index at {base}; the old one is at {base}.old")
    fs.delete(old, True)
    return spark.read.schema(schema).json(path)


def restore_index(spark: SparkSession, path: str) -> bool:
    """Puts an index back that a crash left moved aside; returns whether."""
    base, jvm = path.rstrip("/"), spark._jvm.org.apache.hadoop.fs.Path
    fs = jvm(base).getFileSystem(spark._jsc.hadoopConfiguration())
    return not fs.exists(jvm(base)) and fs.exists(jvm(base + ".old")) and fs.rename(jvm(base + ".old"), jvm(base))


def score_log(kept: DataFrame, path: str) -> None:
    """Kept rows' scores as CSV with a header and CRLF line ends, replacing the last run's."""
    kept.write.mode("overwrite").option("header", True).option("lineSep", "\r\n").csv(path)


def verdicts(results: DataFrame, path: str, key: str = "id") -> None:
    """Verdicts as JSON lines in the order of their ids, over as many sorted files as there are ranges."""
    results.orderBy(key, "image_path").write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def errors(failed: DataFrame, path: str) -> bool:
    """One JSON line per failure; only written where there are any. Returns whether."""
    if failed.isEmpty():
        return False
    failed.write.mode("overwrite").json(path)
    return True


def error_document(failed: DataFrame) -> DataFrame:
    """One row (json) with the document {count, errors: {id: message}} that a person reads."""
    return limits.error_report(failed).select(F.to_json(F.struct("count", "errors")).alias("json"))


def errors_path(output: str) -> str:
    head, _, tail = output.rpartition("/")
    return f"{head}/" * bool(head) + (tail.rsplit(".", 1)[0] if "." in tail else tail) + ".errors.json"


def routed(items: DataFrame, keep: Column, path: str) -> None:
    """Items below route=keep and route=reject."""
    items.withColumn("route", F.when(keep, "keep").otherwise("reject")).write.mode("overwrite").partitionBy("route").parquet(path)


def contents(items: DataFrame, path: str) -> None:
    """Images by content: sha1, ending and bytes, laid out by the first two digits of the sha1, each content once."""
    named = items.select(F.sha1("content").alias("sha1"), F.lower(F.regexp_extract("path", r"(\.[^./]+)$", 1)).alias("ending"), "content")
    named.dropDuplicates(["sha1"]).withColumn("shard", F.substring("sha1", 1, 2)).write.mode("append").partitionBy("shard").parquet(path)


def sidecar_json(items: DataFrame, columns: tuple[str, ...] = ("source", "sha1", "content_type", "status", "final_url", "width", "height", "format")) -> DataFrame:
    """(sha1, json): the sidecar of each item."""
    return items.select("sha1", F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("json"))


def run_folder(root: str, name: str, stamp: str | None = None, taken: frozenset[str] = frozenset()) -> str:
    """root/name, or root/name/stamp, with -01, -02, ... if a run with this stamp is there."""
    base = f"{root.rstrip('/')}/{name}" + (f"/{stamp}" if stamp else "")
    if not stamp or base not in taken:
        return base
    return next(p for k in range(1, 10_000) if (p := f"{base}-{k:02d}") not in taken)
