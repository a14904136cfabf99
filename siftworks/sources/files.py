"""Reading files: permissive indexes, fail-fast manifests, images with sidecars, query lists, score logs."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import identifier, stem, truthy
from ..operators.filters import comment_or_blank
from ..staging import shared_dir

IMAGE_ENDINGS = ("jpg", "jpeg", "png", "webp", "bmp")
INDEX = "sha1 string, url_md5 string, url string, path string, source string, target string, timestamp double"
SIDECAR = "source string, sha1 string, content_type string, status int, final_url string, width int, height int, format string"
SCORE_LOG = "path string, indoor double, outdoor double, tidy double, messy double, moderate double, object_count int"
BUILT_IN_QUERIES = (
    "室内 场景 日常 杂物",
    "家居 室内 生活 场景 自然 光线",
    "客厅 室内 生活 气息 真实",
    "厨房 室内 桌面 杂物",
    "卧室 室内 稍微 凌乱",
    "书房 室内 桌面 物品",
    "工作室 室内 工具 生活化",
)


def _typed(raw: Column, key: str, kind: str) -> Column:
    """A field of a variant if its stored type is right, without coercion."""
    field = F.try_variant_get(raw, f"$.{key}", "variant")
    types = ("STRING",) if kind == "string" else ("DOUBLE", "BIGINT", "FLOAT", "DECIMAL")
    stored = F.schema_of_variant(field)
    fits = F.lit(False)
    for t in types:
        fits = fits | F.coalesce(stored.startswith(t), F.lit(False))
    return F.when(fits, F.try_variant_get(raw, f"$.{key}", kind))


def _visible(spark: SparkSession, path: str) -> str:
    """A path that Spark lists: files whose name starts with _ or . are hidden to it, so such a file is copied to another name in the shared folder."""
    name = path.rstrip("/").rpartition("/")[2]
    if name[:1] not in ("_", "."):
        return path
    where = shared_dir(spark)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    source, target = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, f"{where.rstrip('/')}/{uuid.uuid4().hex}{name.lstrip('_.')}"))
    jvm.org.apache.hadoop.fs.FileUtil.copy(source.getFileSystem(conf), source, target.getFileSystem(conf), target, False, conf)
    return target.toString()


def index(spark: SparkSession, path: str) -> DataFrame:
    """Index entries of JSON lines, with ``line_no`` within a file; blank, broken and non-object lines are dropped, fields of other types are null."""
    lines = spark.read.text(_visible(spark, path)).select("value", F.monotonically_increasing_id().alias("line_no")).where(F.trim("value") != "")
    raw = lines.withColumn("raw", F.try_parse_json("value")).where(F.schema_of_variant("raw").startswith("OBJECT"))
    fields = [f.strip().split() for f in INDEX.split(",")]
    return raw.select(*(_typed(F.col("raw"), k, t).alias(k) for k, t in fields), "line_no")


def _path_or_error(raw: Column) -> Column:
    path = F.coalesce(*(truthy(F.try_variant_get(raw, f"$.{k}", "string")) for k in ("image_path", "image", "path")))
    return F.coalesce(path, F.raise_error(F.concat(F.lit("manifest entry without an image path: "), F.to_json(raw))).cast("string"))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """(id, image_path, extra): JSON lines for .jsonl, else a JSON array, or an object of ids. Broken input fails the job.

    ``extra`` is the entry's JSON. Elements of an array that are no objects are dropped; in an
    object of ids a scalar value is the image path, and a value's own id goes first.
    """
    if path.lower().endswith(".jsonl"):
        lines = spark.read.text(path).select("value", F.monotonically_increasing_id().alias("at")).where(F.trim("value") != "")
        found = lines.select(F.parse_json("value").alias("raw"), F.lit(None).cast("string").alias("key"), "at")
    else:
        whole = spark.read.text(path, wholetext=True).select(F.parse_json("value").alias("v"))
        kind = F.schema_of_variant("v")
        good = whole.withColumn("v", F.when(kind.startswith("ARRAY") | kind.startswith("OBJECT"), F.col("v")).otherwise(F.raise_error(F.lit("a manifest is an array or an object")).cast("variant")))
        found = spark.sql("SELECT e.value AS raw0, e.key AS key, e.pos AS at FROM {good}, LATERAL variant_explode(v) AS e", good=good)
        scalar = ~F.schema_of_variant("raw0").startswith("OBJECT")
        found = found.where(~scalar | F.col("key").isNotNull())
        found = found.select(F.when(scalar, F.parse_json(F.to_json(F.struct(F.col("raw0").alias("image_path"))))).otherwise(F.col("raw0")).alias("raw"), "key", "at")
    ids = [F.try_variant_get("raw", f"$.{k}", "string") for k in ("id", "identifier")] + [F.col("key")]
    return found.select(identifier(ids, F.col("at")).alias("id"), _path_or_error(F.col("raw")).alias("image_path"), F.to_json("raw").alias("extra"))


def images(spark: SparkSession, root: str, endings: Sequence[str] = IMAGE_ENDINGS, name_glob: str | None = None, with_content: bool = True) -> DataFrame:
    """(path, modificationTime, length[, content]) below ``root`` by ending, whatever its case; ``name_glob`` limits file names instead."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    df = (reader.option("pathGlobFilter", name_glob) if name_glob else reader).load(root)
    if not name_glob:
        df = df.where(F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)).isin(*endings))
    return df if with_content else df.drop("content")


def sidecars(spark: SparkSession, root: str) -> DataFrame:
    """(folder, stem, meta struct) of the JSON files below ``root``; broken ones have a null struct."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").load(root)
    meta = F.from_json(F.decode("content", "UTF-8"), SIDECAR)
    return raw.select(folder(F.col("path")).alias("folder"), stem(F.col("path")).alias("stem"), meta.alias("meta"))


def folder(path: Column) -> Column:
    return F.regexp_extract(path, "^(.*)/[^/]*$", 1)


def with_sidecar(items: DataFrame, metas: DataFrame) -> DataFrame:
    """Items with their sidecar's struct, null where there is none."""
    keyed = items.withColumns({"folder": folder(F.col("path")), "stem": stem(F.col("path"))})
    return keyed.join(metas, ["folder", "stem"], "left").drop("folder", "stem")


def queries(spark: SparkSession, given: Sequence[str] = (), lines: DataFrame | None = None, built_in: bool = False) -> DataFrame:
    """(ordinal, query): given ones, then a file's lines (value) without blanks and comments, then the built-in ones; repeats stay."""
    def numbered(values: Sequence[str], part: int) -> DataFrame:
        return spark.createDataFrame([(part, i, v) for i, v in enumerate(values)], "part int, at long, query string")

    df = numbered(given, 0)
    if lines is not None:
        df = df.union(lines.where(~comment_or_blank(F.col("value"))).select(F.lit(1).alias("part"), F.monotonically_increasing_id().alias("at"), F.trim("value").alias("query")))
    if built_in:
        df = df.union(numbered(BUILT_IN_QUERIES, 2))
    return df.select(F.struct("part", "at").alias("ordinal"), "query")


def score_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, schema=SCORE_LOG, header=True, mode="PERMISSIVE", multiLine=False)
