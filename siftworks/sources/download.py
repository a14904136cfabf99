"""Fetching contents: a result or an error for each item, never a failed job."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import DataFrame

from .pages import backoff

#: What a download adds; ``content`` is null where ``error`` is not.
FIELDS = "content binary, ending string, width int, height int, format string, content_type string, status int, final_url string, error string"
_NAMES = [f.split()[0] for f in FIELDS.split(", ")]


def _one(value: str, get: Callable[[str], dict], normalise: Callable[[bytes], tuple] | None, tries: int, wait: Callable[[float], None]) -> dict:
    error = None
    for n in range(max(1, tries)):
        try:
            got = dict(get(value))
            if normalise is not None:
                try:
                    got |= dict(zip(("content", "ending", "width", "height", "format"), normalise(got["content"])))
                except Exception as e:  # noqa: BLE001  a content that can't be read won't get better
                    return {"error": repr(e)}
            return {k: v for k, v in got.items() if k in _NAMES and k != "error"}
        except Exception as e:  # noqa: BLE001  any failure of a service is retried
            error = repr(e)
            if n + 1 < tries:
                wait(backoff(n))
    return {"error": error}


def download(items: DataFrame, get: Callable[[str], dict], url: str = "url", normalise: Callable[[bytes], tuple] | None = None, tries: int = 3, workers: int = 8, wait: Callable[[float], None] = time.sleep) -> DataFrame:
    """``items`` plus FIELDS, columns of those names replaced: what ``get(url)`` gives (a dict with content and, if known, content_type, status, final_url), normalised by a codec (content, ending, width, height, format).

    A task fetches ``workers`` items at a time, so tasks times workers bounds the load on
    services. Failures are retried with growing pauses; what still fails, or what the codec
    refuses, is a row with its error. A null URL is an error row.
    """
    items = items.drop(*_NAMES)
    names = items.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(max(1, workers)) as pool:
            for b in batches:
                got = list(pool.map(lambda u: _one(u, get, normalise, tries, wait) if isinstance(u, str) else {"error": "no URL"}, b[url]))
                out = b[names].copy()
                for k in _NAMES:
                    out[k] = pd.Series([g.get(k) for g in got], index=b.index, dtype="Int32" if k in ("width", "height", "status") else object)
                yield out

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema.fields)
    return items.mapInPandas(run, f"{fields}, {FIELDS}")


def upload(items: DataFrame, post: Callable[[bytes, str], str], content: str = "content", path: str = "path", tries: int = 1, wait: Callable[[float], None] = time.sleep) -> DataFrame:
    """``items`` plus payload and error: a service's JSON answer to each item's content and name; ``functions.text.upload_context`` reads it."""
    names = items.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [_one(k, lambda k: {"content": post(b[content].iloc[k], b[path].iloc[k])}, None, tries, wait) for k in range(len(b))]
            yield b[names].assign(payload=[g.get("content") for g in got], error=[g.get("error") for g in got])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema.fields)
    return items.mapInPandas(run, f"{fields}, payload string, error string")
