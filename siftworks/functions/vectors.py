"""Vector, perceptual-hash and count functions as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hamming(a: Column, b: Column) -> Column:
    """Differing bits of two 64-bit codes."""
    return F.bit_count(a.bitwiseXOR(b))


def pack_bits(bits: Column) -> Column:
    """A long from an array of booleans, the first in the lowest bit."""
    flags = F.transform(bits, lambda b, i: F.when(b, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long")))
    return F.aggregate(flags, F.lit(0).cast("long"), lambda s, x: s.bitwiseOR(x))


def difference_hash(pixels: Column, width: int = 8) -> Column:
    """64-bit difference hash of row-major grey pixels, ``width`` + 1 in a row: bit i is set where a pixel exceeds the next."""
    at = lambda i: F.floor(i / width).cast("int") * (width + 1) + i % width
    cells = F.sequence(F.lit(0), F.lit(width * width - 1))
    return F.when(F.size(pixels) >= width * (width + 1), pack_bits(F.transform(cells, lambda i: F.get(pixels, at(i)) > F.get(pixels, at(i) + 1))))


def circular_hash(vector: Column) -> Column:
    """64-bit code of a vector: bit i is set where a component exceeds the next, the last before the first."""
    n = F.size(vector)
    return pack_bits(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(vector, i) > F.get(vector, (i + 1) % n)))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))


def object_count(scores: Column, threshold: float = 0.5) -> Column:
    """Detections of at least ``threshold``; none for null."""
    return F.coalesce(F.size(F.filter(scores, lambda s: s >= threshold)), F.lit(0))
