"""Paged search results as a Python data source over captured pages, or over a service by a given fetch function."""

from __future__ import annotations

import html
import json
import random
import re
import time
from collections.abc import Callable, Iterator
from urllib.parse import quote, urlencode

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.text import entry_image, first_truthy_url, first_valid_url
from ..operators.filters import still_image

SCHEMA = "query string, page int, position int, entry string"
ENTRY = "hoverURL string, objURL string, thumbURL string, middleURL string, replaceUrl array<struct<ObjURL:string,FromURL:string>>"


def backoff(attempt: int, base: float = 0.8, factor: float = 2.0, jitter: float = 0.2, low: float = 0.1, high: float = 10.0, rand: Callable[[float, float], float] = random.uniform) -> float:
    """Seconds to wait before another attempt: exponential, jittered, never below ``low``."""
    return max(low, min(base * factor**attempt * (1 + rand(-jitter, jitter)), high))


def attempts(call: Callable[[], dict], tries: int = 3, wait: Callable[[float], None] = time.sleep) -> dict:
    """What ``call`` gives, within ``tries``; {} where all fail."""
    for n in range(tries):
        try:
            return call()
        except Exception:  # noqa: BLE001  any failure of a service is retried
            if n + 1 < tries:
                wait(backoff(n))
    return {}


def crawl(fetch: Callable[[str, int, int], dict], query: str, size: int = 30, limit: int = 0, empty_pages: int = 1, first: int = 0, pages: int = 0, tries: int = 3) -> Iterator[tuple[str, int, int, str | None]]:
    """Entries of one query, page after page from ``first``, until ``limit`` entries, ``pages`` pages (0: none of both counts) or ``empty_pages`` pages in a row without an entry.

    Where the query has ended, a last row has position -1 and no entry.
    """
    got = empty = 0
    page = first
    while not (limit and got >= limit) and not (pages and page >= first + pages):
        entries = [e for e in attempts(lambda: fetch(query, page * size, size), tries).get("data", []) if isinstance(e, dict) and e]
        empty = 0 if entries else empty + 1
        if empty >= empty_pages:
            yield query, page, -1, None
            return
        for k, e in enumerate(entries[: limit - got] if limit else entries):
            yield query, page, k, json.dumps(e, ensure_ascii=False)
        got, page = got + len(entries), page + 1


class _Query(InputPartition):
    def __init__(self, query: str) -> None:
        self.query = query


class _Reader(DataSourceReader):
    def __init__(self, options: dict, fetch: Callable[[str, int, int], dict], warm_up: Callable[[], object] | None) -> None:
        self.options, self.fetch, self.warm_up = options, fetch, warm_up

    def partitions(self) -> list[InputPartition]:
        return [_Query(q) for q in json.loads(self.options.get("queries", "[]"))]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        if self.warm_up is not None:
            try:
                self.warm_up()
            except Exception:  # noqa: BLE001  a warm-up only fetches what helps later
                pass
        number = lambda key, default: int(self.options.get(key, default))
        yield from crawl(self.fetch, partition.query, number("pagesize", 30), number("limit", 0), number("emptypages", 1), number("first", 0), number("pages", 0), number("tries", 3))


def source(fetch: Callable[[str, int, int], dict], name: str = "search_pages", warm_up: Callable[[], object] | None = None) -> type[DataSource]:
    """A data source whose tasks each page through one query with ``fetch(query, offset, size)``, after ``warm_up``, whose failure is ignored."""

    class Pages(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return SCHEMA

        def reader(self, schema) -> DataSourceReader:  # noqa: ANN001
            return _Reader(self.options, fetch, warm_up)

    return Pages


def read(spark: SparkSession, fetch: Callable[[str, int, int], dict], queries: list[str], name: str = "search_pages", warm_up: Callable[[], object] | None = None, **options: int) -> DataFrame:
    """Entries of all queries, and a row without an entry for each that has ended (see ``crawl`` for the options)."""
    spark.dataSource.register(source(fetch, name, warm_up))
    return spark.read.format(name).options(queries=json.dumps(queries), **{k: str(v) for k, v in options.items()}).load()


def similar_request(context: dict, page: int, base: str) -> str | None:
    """URL of a page of similar images by a context's ajax parameters: page from 1, size within 30 to 60, ``next`` only if it is there; None without parameters."""
    params = dict(context.get("ajax_params") or {})
    if not params:
        return None
    try:
        size = int(params.get("page_size") or params.get("pagesize") or 30)
    except ValueError:
        size = 30
    number = max(1, page + 1)
    params |= {"page": str(number), "page_size": str(min(60, max(30, size)))}
    if "next" in params:
        params["next"] = str(number + 1)
    return f"{base}?{urlencode(params, quote_via=quote)}"


def fallback_request(context: dict, page: int, base: str, carousel: str = "5038") -> str | None:
    """URL of the HTML page of similar images for a context without ajax parameters; None without image or token."""
    if not context.get("image") or not context.get("token"):
        return None
    params = {"entrance": "GENERAL", "tpl_from": "pc", "sign": context.get("sign") or "", "carousel": context.get("carousel") or carousel, "token": context["token"], "queryImageUrl": context["image"], "pn": str(page * 30), "rn": "60"}
    return f"{base}?{urlencode(params, quote_via=quote)}"


def fallback_entries(page: str) -> list[dict]:
    """Entries of such an HTML page: its distinct image URLs, sorted."""
    found = re.findall(r'(?i)(?:data-imgurl|data-src|src)="(https?://[^"]+)"', page)
    return [{"middleURL": u} for u in sorted({html.unescape(u) for u in found})]


def similar_fetch(contexts: dict[str, dict], get_json: Callable[[str], dict], get_text: Callable[[str], str], ajax: str, fallback: str) -> Callable[[str, int, int], dict]:
    """A fetch function over seeds' contexts: JSON pages where there are ajax parameters, else HTML pages."""

    def fetch(seed: str, offset: int, size: int) -> dict:
        context, page = contexts.get(seed, {}), offset // size
        if url := similar_request(context, page, ajax):
            data = get_json(url).get("data")
            return {"data": data.get("list", []) if isinstance(data, dict) else []}
        if url := fallback_request(context, page, fallback):
            return {"data": fallback_entries(get_text(url))}
        return {}

    return fetch


def captured(pages: dict[str, list[list[dict]]]) -> Callable[[str, int, int], dict]:
    """A fetch function over captured pages by query."""

    def fetch(query: str, offset: int, size: int) -> dict:
        own = pages.get(query, [])
        return {"data": own[offset // size]} if offset // size < len(own) else {}

    return fetch


def keyword_urls(entries: DataFrame) -> DataFrame:
    """(query, page, position, url): the first valid URL of each entry; entries without one are dropped."""
    e = F.from_json("entry", ENTRY)
    url = first_valid_url([e["hoverURL"], e["objURL"], e["thumbURL"], e["middleURL"]], e["replaceUrl"])
    return entries.select("query", "page", "position", url.alias("url")).where("url is not null")


def similar_urls(entries: DataFrame) -> DataFrame:
    """(query, page, position, url): the image URL of each still image; entries without one are dropped. Entries of HTML pages hold it as middleURL alone."""
    get = lambda path, kind="string": F.try_variant_get(F.col("raw"), f"$.{path}", kind)  # noqa: E731  (names that differ by case only)
    parsed = entries.withColumn("raw", F.try_parse_json("entry"))
    own = entry_image(get("objUrl"), get("thumbUrl"), get("middleUrl"))
    plain = F.when(F.coalesce(get("objUrl"), get("objURL"), get("thumbUrl"), get("thumbURL"), get("middleUrl")).isNull(), get("middleURL"))
    url = first_truthy_url([F.coalesce(own, plain)])
    still = parsed.where(still_image(get("typeInfo.type"), get("isVideo", "boolean")))
    return still.select("query", "page", "position", url.alias("url")).where("url is not null")
