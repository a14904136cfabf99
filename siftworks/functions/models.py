"""Plug points for models and codecs: batches in, batches or an error per item out."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _each(model: Callable[[list[bytes]], list], contents: list[bytes]) -> list[tuple[list | None, str | None]]:
    """The model's answers to a batch; where the batch fails, to each item alone, so that an item fails by itself."""
    try:
        return [(x, None) for x in model(contents)]
    except Exception:  # noqa: BLE001
        out: list[tuple[list | None, str | None]] = []
        for c in contents:
            try:
                out.append((model([c])[0], None))
            except Exception as e:  # noqa: BLE001
                out.append((None, repr(e)))
        return out


def _plug(model: Callable[[list[bytes]], list], kind: str, with_errors: bool) -> Callable[[Column], Column]:
    if with_errors:

        @F.pandas_udf(f"value {kind}, error string")
        def run(content: pd.Series) -> pd.DataFrame:
            return pd.DataFrame(_each(model, content.tolist()), columns=["value", "error"])
    else:

        @F.pandas_udf(kind)
        def run(content: pd.Series) -> pd.Series:
            return pd.Series([x for x, _ in _each(model, content.tolist())], dtype=object)

    return run.asNondeterministic()  # else a filter on the result runs the model twice


def embed(model: Callable[[list[bytes]], list[list[float]]], with_errors: bool = False) -> Callable[[Column], Column]:
    """Contents to vectors; the model is called once per Arrow batch. A failing item is null, or with_errors a struct (value, error)."""
    return _plug(model, "array<float>", with_errors)


def detect(model: Callable[[list[bytes]], list[list[float]]], with_errors: bool = False) -> Callable[[Column], Column]:
    """Contents to the scores of the objects seen; failing items as in ``embed``."""
    return _plug(model, "array<double>", with_errors)


def judge_pause(attempt: int, base: float = 1.5, factor: float = 1.8) -> float:
    """Seconds before attempt ``attempt`` + 1 (from 1)."""
    return base * factor ** (attempt - 1)


def judge(items: DataFrame, model: Callable[[bytes, str], str], prompt: str, tries: int = 3, workers: int = 2, wait: Callable[[float], None] = time.sleep) -> DataFrame:
    """``items`` (with content) and response and error: a failing item is an error row, never a failed job.

    A task asks ``workers`` items at a time; failures are retried after growing pauses. Time
    limits are the model function's.
    """
    names, schema = items.columns, items.schema

    def ask(content: bytes) -> tuple[str | None, str | None]:
        error = None
        for n in range(1, max(1, tries) + 1):
            try:
                return model(content, prompt), None
            except Exception as e:  # noqa: BLE001  any failure of the model is the item's
                error = repr(e)
                if n < tries:
                    wait(judge_pause(n))
        return None, error

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(max(1, workers)) as pool:
            for b in batches:
                got = list(pool.map(ask, b["content"]))
                yield b[names].assign(response=[g[0] for g in got], error=[g[1] for g in got])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return items.mapInPandas(run, f"{fields}, response string, error string")


def normalise_image(decode: Callable[[bytes], tuple[bytes, str, int, int, str]]) -> Callable[[Column], Column]:
    """A codec's output per content: ok, content, ending, width, height, format; any exception is not ok."""
    kind = "ok boolean, content binary, ending string, width int, height int, format string"

    @F.pandas_udf(kind)
    def run(content: pd.Series) -> pd.DataFrame:
        rows = []
        for c in content:
            try:
                rows.append((True, *decode(c)))
            except Exception:  # noqa: BLE001
                rows.append((False, None, None, None, None, None))
        return pd.DataFrame(rows, columns=[k.split()[0] for k in kind.split(", ")])

    return run


def grey_pixels(decode: Callable[[bytes], list[int]]) -> Callable[[Column], Column]:
    """A codec's 9x8 grey pixels in rows, null where it fails."""

    @F.pandas_udf("array<int>")
    def run(content: pd.Series) -> pd.Series:
        def one(c: bytes) -> list[int] | None:
            try:
                return decode(c)
            except Exception:  # noqa: BLE001
                return None

        return content.map(one)

    return run
