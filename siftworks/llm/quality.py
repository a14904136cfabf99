"""Quality classifier: regularised quadratic discriminant over document statistics."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .batches import by_rows, tidied
from .staging import stage

NAMES = ("log_words", "mean_word", "sd_word", "distinct_words", "repeated_next", "upper", "digit", "symbol", "beyond_ascii", "entropy", "sentence_ends", "symbol_ends", "distinct_lines", "words_per_line", "top_word")

_BYTES = np.arange(256)
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
_LOWER = (_BYTES >= 97) & (_BYTES <= 122)
_DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
_SPACE = (_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13))
_BEYOND = _BYTES >= 128
_SYMBOL = ~(_UPPER | _LOWER | _DIGIT | _SPACE | _BEYOND)


def _logit(part: float, whole: float) -> float:
    """A share on an unbounded scale, smoothed so that 0 and 1 stay finite."""
    return float(np.log((part + 0.5) / (max(whole - part, 0) + 0.5)))


def statistics(text: str | None) -> list[float]:
    """The NAMES statistics of a whole text, transformed towards normality."""
    b = (text or "").encode("utf-8", "surrogatepass")
    words = b.split()
    n = len(words)
    seen = np.bincount(np.frombuffer(b, np.uint8), minlength=256)
    inked = int(seen[~_SPACE].sum())
    lens = np.fromiter(map(len, words), np.int64, n)
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    p = seen[seen > 0] / max(len(b), 1)
    ends = [w[-1] for w in words]
    stops = sum(map(ends.count, b".?!"))
    marks = int(_SYMBOL[ends].sum()) if n else 0
    lines = [x for x in b.split(b"\n") if x]
    return [
        float(np.log1p(n)), float(lens.mean()) if n else 0.0, float(lens.std()) if n else 0.0,
        _logit(len(counts), n), _logit(sum(map(eq, words, words[1:])), n),
        _logit(int(seen[_UPPER].sum()), inked), _logit(int(seen[_DIGIT].sum()), inked), _logit(int(seen[_SYMBOL].sum()), inked), _logit(int(seen[_BEYOND].sum()), inked),
        float(-(p * np.log2(p)).sum()), _logit(stops, n), _logit(marks, n),
        _logit(len(set(lines)), len(lines)), float(np.log1p(n / max(len(lines), 1))), _logit(max(counts.values(), default=0), n),
    ]


def features(docs: DataFrame) -> DataFrame:
    """(doc_id, x): the statistics of every row's whole text; a null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_rows(batches):
            x = pa.array([statistics(t) for t in b.column(1).to_pylist()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([b.column(0), x], ["doc_id", "x"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(tidied(run), "doc_id long, x array<double>")


def held_out(fold: int = 5) -> Column:
    """Whether crc32 of doc_id as text is a multiple of ``fold``; false for a null doc_id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % fold == 0, F.lit(False))


@dataclass(frozen=True)
class Model:
    """Class log priors, means and inverse Cholesky factors; ``None`` factors: only the prior is known."""

    log_prior: tuple[float, float]
    means: np.ndarray | None = None
    factors: np.ndarray | None = None
    log_dets: np.ndarray | None = None
    #: Calibration of the log-odds.
    scale: float = 1.0
    shift: float = 0.0

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 for each row of x."""
        return 1 / (1 + np.exp(-np.clip(self.scale * self.log_odds(x) + self.shift, -700, 700)))

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        """Difference of the classes' log densities and priors."""
        gap = np.full(len(x), self.log_prior[1] - self.log_prior[0])
        if self.factors is not None and len(x):
            for k, sign in ((0, -1), (1, 1)):
                z = (x - self.means[k]) @ self.factors[k].T  # squared length: Mahalanobis distance
                gap += sign * (-0.5 * (z * z).sum(1) - self.log_dets[k])
        return gap


def calibrate(gap: np.ndarray, y: np.ndarray, n: np.ndarray, steps: int = 100) -> tuple[float, float]:
    """Scale and shift of log-odds by regularised logistic regression on counted (gap, y), by Newton steps."""
    x, b, ridge = np.stack([gap, np.ones_like(gap)], 1), np.array([1.0, 0.0]), np.array([1.0, 0.01])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        slope = x.T @ (n * (p - y)) + ridge * (b - [1.0, 0.0])
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + np.diag(ridge), slope)
        b = b - np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-9:
            break
    return (float(b[0]), float(b[1])) if b[0] > 0 else (1.0, 0.0)


def fit(feats: DataFrame, labels: DataFrame, to_pooled: float = 0.3, to_diagonal: float = 0.2) -> Model:
    """Learns from all rows of ``feats`` (doc_id, x) that ``labels`` (doc_id, quality) marks.

    Counts, sums and products by class are summed in parts, so the driver receives a fixed
    number of values however many rows there are. Each class covariance is shrunk towards the
    pooled one by ``to_pooled`` and then towards the pooled diagonal by ``to_diagonal``. The
    log-odds, too sure of themselves in the tails, are calibrated on counts of their tenths.
    Several labels of a document count as their majority; null labels are ignored. With a
    class missing, every score is the (smoothed) share of class 1.
    """
    d = len(NAMES)
    marks = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("y"))
    rows = stage(feats.join(marks, "doc_id").select("y", "x"), "labelled")

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 + d + d * d))
        for b in batches:
            if b.num_rows:
                y, x = b.column(0).to_numpy(), b.column(1).flatten().to_numpy().reshape(-1, d)
                for k in (0, 1):
                    own = x[y == k]
                    total[k] += np.concatenate([[len(own)], own.sum(0), (own.T @ own).ravel()])
        k, i = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(k.ravel()), pa.array(i.ravel()), pa.array(total.ravel())], ["y", "i", "v"])

    sums = np.zeros((2, 1 + d + d * d))
    for y, i, v in rows.mapInArrow(tidied(moments), "y long, i long, v double").groupBy("y", "i").agg(F.sum("v")).collect():
        sums[y, i] = v
    n = sums[:, 0]
    log_prior = tuple(np.log((n + 1) / (n.sum() + 2)).tolist())
    if n.min() < 2:
        return Model(log_prior)
    means = sums[:, 1 : d + 1] / n[:, None]
    covs = np.stack([sums[k, d + 1 :].reshape(d, d) / n[k] - np.outer(means[k], means[k]) for k in (0, 1)])
    pooled = (n[0] * covs[0] + n[1] * covs[1]) / n.sum()
    diagonal = np.diag(np.maximum(np.diag(pooled), 1e-6))
    shrunk = [(1 - to_diagonal) * ((1 - to_pooled) * c + to_pooled * pooled) + to_diagonal * diagonal for c in covs]
    lower = [np.linalg.cholesky(c) for c in shrunk]
    model = Model(log_prior, means, np.stack([np.linalg.inv(c) for c in lower]), np.array([np.log(np.diag(c)).sum() for c in lower]))

    def tenths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            gap = model.log_odds(b.column(1).flatten().to_numpy().reshape(-1, d))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.round(np.clip(gap, -50, 50) * 10).astype(np.int64))], ["y", "tenth"])

    counts = np.array(rows.mapInArrow(tidied(tenths), "y int, tenth long").groupBy("y", "tenth").count().collect(), np.float64)
    scale, shift = calibrate(counts[:, 1] / 10, counts[:, 0], counts[:, 2])
    return replace(model, scale=scale, shift=shift)


def score(feats: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) for every row of ``feats``."""
    d = len(NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_rows(batches):
            x = b.column(1).flatten().to_numpy().reshape(-1, d)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.scores(x))], ["doc_id", "score"])

    return feats.select("doc_id", "x").mapInArrow(tidied(run), "doc_id long, score double")


def with_score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with all its columns and ``score`` (replaced if there): no shuffle, one pass over the texts."""
    docs = docs.drop("score")
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_rows(batches):
            x = np.array([statistics(t) for t in b.column(names.index("text")).to_pylist()]).reshape(-1, len(NAMES))
            yield pa.RecordBatch.from_arrays(b.columns + [pa.array(model.scores(x))], [*names, "score"])

    return docs.mapInArrow(tidied(run), T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())]))
