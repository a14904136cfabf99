"""The curation stages end to end, composed of the operators; every option is a parameter.

Each stage takes and returns DataFrames. What touches the outside (fetching, models, codecs) is
a function given by the caller; what writes is left to ``siftworks.sources.sinks``.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import models, text, vectors, verdict
from ..operators import dedup, filters, index, limits, scoring
from ..sources import files, pages
from ..staging import stage

Fetch = Callable[[str, int, int], dict]


def keyword_crawl(
    spark: SparkSession,
    fetch: Fetch,
    queries: Sequence[str],
    known: DataFrame | None = None,
    limit_per_query: int = 200,
    page_size: int = 30,
    debug: bool = False,
    dimensions: tuple[int, int] = filters.DIMENSIONS,
    download: Callable[[DataFrame], DataFrame] | None = None,
    run_ts: Column | None = None,
) -> DataFrame:
    """New items of keyword searches: (query, slug, url, url_md5[, what ``download`` adds, sha1, timestamp]).

    Page after page per query, until each has its limit of saved items or has ended; the first
    valid URL of each entry; URLs seen before or in the index go. ``download`` adds content (and width, height): then the size rule holds unless
    ``debug``, contents seen before go, and each query is cut to its exact limit.
    """
    order = ["query", "page", "position"]

    def saved(names: list[str], first: int, n: int, before: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        read = stage(pages.read(spark, fetch, names, "keyword_pages", pagesize=page_size, first=first, pages=n), "entries")
        items = pages.keyword_urls(read).withColumns({"slug": text.slug(F.col("query")), "url_md5": text.url_key(F.col("url"))})
        items = dedup.first_by_key(items, F.col("url_md5"), order, "_k").drop("_k")
        for index_ in (known, before):
            items = dedup.new_by_key(items, index_, "url_md5") if index_ is not None else items
        if download is not None:
            items = _distinct_contents(download(items), [known, before], order, run_ts)
            if {"width", "height"} <= set(items.columns):
                items = items.where(filters.size_and_aspect(F.col("width"), F.col("height"), dimensions, active=not debug))
        return items, read

    return _until_saved(saved, list(queries), "query", order[1:], limit_per_query, -(-limit_per_query // page_size))


def _until_saved(saved: Callable[[list[str], int, int, DataFrame | None], tuple[DataFrame, DataFrame]], names: list[str], group: str, order: list[str], limit: int, pages_: int, idle: int = 0) -> DataFrame:
    """Rounds of pages, each round twice as long, until every name has ``limit`` saved items, has ended, or had ``idle`` pages without one (0: never).

    Names are the caller's list; of what was saved the driver sees a count and a page for each.
    """
    first, out, left, n = 0, None, sorted(set(names)), max(1, pages_)
    have: dict[str, tuple[int, int]] = {}
    while True:
        items, read = saved(left, first, n, out)
        items = stage(items, "saved")
        out = items if out is None else stage(out.unionByName(items), "saved")
        ended = {r.query for r in read.where("position = -1").select("query").distinct().collect()}
        for r in out.groupBy(group).agg(F.count("*").alias("n"), F.max("page").alias("last")).collect():
            have[r[group]] = (r.n, r.last)
        first, n = first + n, 2 * n
        left = [q for q in left if q not in ended and have.get(q, (0, -1))[0] < limit and not (idle and first - 1 - have.get(q, (0, -1))[1] >= idle)]
        if not left:
            return limits.limit_per_group(out, group, order, limit)


def _distinct_contents(items: DataFrame, known: Sequence[DataFrame | None], order: list[str], run_ts: Column | None) -> DataFrame:
    items = items.where("content is not null").withColumn("sha1", text.content_key(F.col("content")))
    items = items.withColumn("timestamp", run_ts if run_ts is not None else F.unix_timestamp().cast("double"))
    items = dedup.first_by_key(items, F.col("sha1"), order, "_k").drop("_k")
    for index_ in known:
        items = dedup.new_by_key(items, index_, "sha1") if index_ is not None else items
    return items


def reverse_search(
    spark: SparkSession,
    fetch: Fetch,
    seeds: DataFrame,
    known: DataFrame | None = None,
    limit_per_seed: int = 150,
    page_size: int = 30,
    idle_pages: int = 20,
    phash: bool = True,
    dedup_urls: bool = True,
    dhash_threshold: int = 18,
    dhash_min_distance: int = 4,
    download: Callable[[DataFrame], DataFrame] | None = None,
    run_ts: Column | None = None,
) -> DataFrame:
    """New items like each seed (seed, code): (seed, url, ...[content, code, distance]).

    A seed's perceptual code keeps what is near it and no copy of it; that comes before the
    limit and before anything is recorded, so no entry points at a dropped item.
    """
    names = [r.seed for r in seeds.select("seed").distinct().collect()]  # the caller's list of queries
    size = min(60, max(30, page_size))
    order = ["seed", "page", "position"]

    def saved(left: list[str], first: int, n: int, before: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        read = stage(pages.read(spark, fetch, left, "similar_pages", pagesize=size, first=first, pages=n, tries=1), "entries")
        items = pages.similar_urls(read).withColumnRenamed("query", "seed").withColumn("url_md5", text.url_key(F.col("url")))
        items = dedup.first_by_key(items, F.col("url_md5"), order, "_k").drop("_k")
        for index_ in (known if dedup_urls else None, before):
            items = dedup.new_by_key(items, index_, "url_md5") if index_ is not None else items
        if download is not None:
            items = _distinct_contents(download(items), [known if dedup_urls else None, before], order, run_ts)
            if phash:
                near = items.join(seeds.select("seed", F.col("code").alias("seed_code")), "seed")
                near = near.withColumn("distance", vectors.hamming(F.col("code"), F.col("seed_code")))
                items = near.where(filters.hash_band(F.col("distance"), dhash_threshold, dhash_min_distance)).drop("seed_code")
        return items, read

    return _until_saved(saved, names, "seed", order[1:], limit_per_seed, -(-limit_per_seed // size), idle_pages)


def prefilter(
    items: DataFrame,
    prompts: DataFrame,
    embed: Callable[[Column], Column],
    detect: Callable[[Column], Column] | None = None,
    known: DataFrame | None = None,
    indoor_margin: float = 0.02,
    moderate_margin: float | None = None,
    object_count_min: int | None = None,
    object_count_max: int | None = None,
    detector_threshold: float = 0.5,
    limit: int = 0,
) -> DataFrame:
    """Kept items (path, content[, meta_sha1]) with sha1, the five scores and object_count.

    The detector runs on what the scores keep only: its column is made after that filter and
    Catalyst does not move a Python function below it.
    """
    filters.count_range(F.lit(0), object_count_min, object_count_max)
    known_sha1 = F.col("meta_sha1") if "meta_sha1" in items.columns else F.lit(None).cast("string")
    own = items.withColumn("sha1", F.coalesce(text.truthy(known_sha1), text.content_key(F.col("content"))))
    own = dedup.first_by_key(own, F.col("sha1"), ["path"], "_k").drop("_k")
    if known is not None:
        own = dedup.new_by_key(own, known, "sha1")
    scored = scoring.prompt_scores(own.withColumn("embedding", embed(F.col("content"))), prompts).drop("embedding")
    kept = scored.where(filters.indoor(F.col("indoor"), F.col("outdoor"), indoor_margin))
    if moderate_margin is not None:
        kept = kept.where(filters.moderate(F.col("moderate"), F.col("tidy"), F.col("messy"), moderate_margin))
    if detect is not None:
        kept = kept.withColumn("object_count", vectors.object_count(detect(F.col("content")), detector_threshold))
        kept = kept.where(filters.count_range(F.col("object_count"), object_count_min, object_count_max))
    return limits.limit_kept(kept, ["path"], limit)


def fine_filter(
    candidates: DataFrame,
    model: Callable[[bytes, str], str],
    prompt: str,
    min_score: float = 0.6,
    tries: int = 3,
    limit: int | None = None,
    response_of: Callable[[Column], Column] | None = None,
    workers: int = 2,
    wait: Callable[[float], None] = time.sleep,
) -> tuple[DataFrame, DataFrame]:
    """(results, errors) of candidates (id, image_path, content): a verdict and a route each, or an error row; never both."""
    asked = models.judge(limits.limit_candidates(candidates, ["id", "image_path"], limit), model, prompt, tries, workers, wait)
    said = response_of(F.col("response")) if response_of else F.col("response")
    out = stage(asked.withColumn("v", verdict.normalise(said)).drop("response"), "verdicts")  # written: results and errors are of one run of the model
    good = F.col("error").isNull() & F.col("v.ok")
    results = out.where(good).select("id", "image_path", *(f"v.{c}" for c in ("decision", "score", "reason", "room_tags", "object_tags", "raw_response")))
    routed = results.withColumn("route", scoring.route(verdict.final_keep(F.col("decision"), F.col("score"), min_score)))
    errors = out.where(~good).select("id", "image_path", F.coalesce("error", "v.error").alias("error"))
    return routed, errors


def rebuild_index(spark: SparkSession, root: str, index_path: str | None = None, run_ts: Column | None = None, kind: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(entries, changes against the index at ``index_path``) of the images below ``root``; writing them is the caller's (a dry run does not).

    Kind ``filtered`` gives entries (sha1, source, target, timestamp), else (sha1, url_md5, url, path, timestamp).
    """
    if kind is None:
        first = files.index(spark, index_path).orderBy("line_no").first() if index_path else None
        kind = index.mode(index_path or root, [k for k, v in first.asDict().items() if v is not None] if first else None)
    now = run_ts if run_ts is not None else F.unix_timestamp().cast("double")
    found = files.with_sidecar(files.images(spark, root), files.sidecars(spark, root))
    shown = text.relative_path(F.regexp_replace("path", "^file:/*", "/"), root)
    own = found.select(shown.alias("path"), F.col("meta.sha1").alias("meta_sha1"), F.col("meta.final_url").alias("final_url"), F.col("meta.source").alias("source"), F.unix_timestamp("modificationTime").cast("double").alias("meta_ts"), "content")
    empty = spark.createDataFrame([], files.INDEX + ", line_no long")
    old = files.index(spark, index_path) if index_path else empty
    where = "target" if kind == "filtered" else "path"
    previous = old.select("sha1", F.col(where).alias("path"), F.coalesce("url", "source").alias("url"), "timestamp", "line_no")
    entries = index.rebuild(own, previous, now)
    last = dedup.last_by_key(previous, "path", "line_no").select("path", "sha1")
    changed = index.changes(last, entries.select("path", "sha1"))
    if kind == "filtered":
        entries = entries.select("sha1", F.col("url").alias("source"), F.col("path").alias("target"), "timestamp")
    return entries, changed


def remove_seed_duplicates(items: DataFrame, seeds: DataFrame, threshold: int = 2) -> tuple[DataFrame, DataFrame]:
    """(survivors, removed per seed and in total) of items (path, slug, code) against seeds (seed_id, slug, code)."""
    own = seeds.select("seed_id", "slug", "code")
    near = dedup.near_seed(items, own, "slug", "path").where(F.col("distance") <= threshold)
    gone = near.select("path").distinct()
    counts = near.select("seed_id", "path").distinct().rollup("seed_id").agg(F.count_distinct("path").alias("n_removed"))
    return items.join(gone, "path", "left_anti"), counts
