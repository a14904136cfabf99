"""Predicates that keep or drop items."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DIMENSIONS, ASPECTS = (400, 6000), (0.4, 2.5)


def size_and_aspect(width: Column, height: Column, dimensions: tuple[int, int] = DIMENSIONS, aspects: tuple[float, float] = ASPECTS, active: bool = True) -> Column:
    """Both sides and their ratio within inclusive bounds; everything where not ``active``."""
    if not active:
        return F.lit(True)
    return width.between(*dimensions) & height.between(*dimensions) & (width / height).between(*aspects)


def non_empty_entry(entry: Column) -> Column:
    """A JSON object with at least one field."""
    kind = F.schema_of_variant(F.try_parse_json(entry))
    return F.coalesce(kind.startswith("OBJECT<") & (kind != "OBJECT<>"), F.lit(False))


def still_image(kind: Column, is_video: Column) -> Column:
    return F.coalesce(F.lower(kind), F.lit("")).isin("", "image", "pic", "picture") & ~F.coalesce(is_video, F.lit(False))


def _number(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def indoor(indoor_: Column, outdoor: Column, margin: float = 0.02) -> Column:
    """The first score reaches the second and a margin; a missing or NaN score is refused."""
    return F.coalesce(~(_number(indoor_) < _number(outdoor) + F.lit(margin)), F.lit(False))


def moderate(moderate_: Column, tidy: Column, messy: Column, margin: float = 0.0) -> Column:
    """An optional rule, off by default: the middle score reaches both extremes and a margin."""
    return F.coalesce(_number(moderate_) >= F.greatest(_number(tidy), _number(messy)) + margin, F.lit(False))


def count_range(count: Column, low: int | None = None, high: int | None = None) -> Column:
    if low is not None and high is not None and low > high:
        raise ValueError("low is above high")
    keep = F.lit(True)
    if low is not None:
        keep = keep & (count >= low)
    if high is not None:
        keep = keep & (count <= high)
    return keep


def hash_band(distance: Column, threshold: int = 18, low: int = 4) -> Column:
    """Near a seed but no copy of it: above ``low``, at most ``threshold``; unknown distances stay."""
    low = min(max(low, 0), threshold)
    return distance.isNull() | ((distance > low) & (distance <= threshold))


def comment_or_blank(line: Column) -> Column:
    return (F.trim(line) == "") | line.startswith("#")
