"""Normalising a model's verdicts: JSON of any shape into typed columns, or an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import once, strip, truthy

TAG_BREAKS = r"[;,/、|｜\n]+"
ROOM_TAGS, OBJECT_TAGS, REASON = 8, 10, 160


def decision(c: Column) -> Column:
    """keep or reject; anything else is reject."""
    d = F.lower(strip(F.coalesce(c.cast("string"), F.lit(""))))
    return F.when(d.isin("keep", "reject"), d).otherwise("reject")


def score(c: Column) -> Column:
    """A number in [0, 1]; 0 where there is none. NaN counts as 1, as it compares above everything."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(c.try_cast("double"), F.lit(0.0))))


def reason(c: Column, most: int = REASON) -> Column:
    return F.substring(strip(F.coalesce(c.cast("string"), F.lit(""))), 1, most)


def tags(items: Column, most: int) -> Column:
    """Stripped, lower-cased, without empty and repeated ones, the first ``most`` in order."""
    clean = F.filter(F.transform(items, lambda x: F.lower(strip(x))), lambda x: x.isNotNull() & (x != ""))
    return F.coalesce(F.slice(F.array_distinct(clean), 1, most), F.array().cast("array<string>"))


def tags_of_text(c: Column, most: int) -> Column:
    return tags(F.split(c, TAG_BREAKS), most)


def _tags(raw: Column, key: str, most: int) -> Column:
    """Tags of a list, or of a string with separators; none of anything else. Null items are dropped."""
    kind = F.schema_of_variant(F.try_variant_get(raw, f"$.{key}", "variant"))
    listed = F.try_variant_get(raw, f"$.{key}", "array<string>")
    return F.when(kind == "STRING", tags_of_text(F.try_variant_get(raw, f"$.{key}", "string"), most)).when(kind.startswith("ARRAY"), tags(listed, most)).otherwise(F.array().cast("array<string>"))


FIELDS = ("decision", "score", "reason", "room_tags", "object_tags")


def normalise(json: Column) -> Column:
    """A verdict struct from JSON text: ok, error, the five fields, and raw_response, the object with the five fields in it replaced; null where the text is no JSON object.

    The text is parsed once.
    """

    def fields(raw: Column) -> Column:
        get = lambda key: F.try_variant_get(raw, f"$.{key}", "string")
        return F.struct(decision(get("decision")).alias("decision"), score(get("score")).alias("score"), reason(get("reason")).alias("reason"), _tags(raw, "room_tags", ROOM_TAGS).alias("room_tags"), _tags(raw, "object_tags", OBJECT_TAGS).alias("object_tags"))

    def overlaid(raw: Column, own: Column) -> Column:
        mapped = lambda v: F.try_variant_get(v, "$", "map<string,variant>")
        rest = F.map_filter(mapped(raw), lambda k, _: ~k.isin(*FIELDS))
        return F.to_json(F.map_concat(rest, mapped(F.parse_json(F.to_json(own)))))

    def whole(raw: Column) -> Column:
        ok = F.coalesce(F.schema_of_variant(raw).startswith("OBJECT"), F.lit(False))
        own = once(F.when(ok, raw), lambda r: F.when(r.isNotNull(), fields(r)))
        return once(own, lambda x: F.struct(ok.alias("ok"), F.when(~ok, F.lit("no JSON object")).alias("error"), *(x[k].alias(k) for k in FIELDS), F.when(ok, overlaid(raw, x)).alias("raw_response")))

    return once(F.try_parse_json(json), whole)


def response_text(response: Column) -> Column:
    """The model's JSON in a service's response: the first non-blank text of any part of any output, else the other shapes in use."""

    def found(raw: Column) -> Column:
        array = lambda v, path: F.coalesce(F.try_variant_get(v, path, "array<variant>"), F.array().cast("array<variant>"))
        plain = lambda v, path: F.when(F.schema_of_variant(F.try_variant_get(v, path, "variant")) == "STRING", truthy(strip(F.try_variant_get(v, path, "string"))))
        parts = F.flatten(F.transform(array(raw, "$.output"), lambda o: array(o, "$.content")))
        texts = F.transform(parts, lambda p: F.coalesce(plain(p, "$.text"), plain(p, "$.text.value")))
        first = F.get(F.filter(texts, lambda t: t.isNotNull()), 0)
        return F.coalesce(first, *(plain(raw, p) for p in ("$.output_text", "$.message.content", "$.response")))

    return once(F.try_parse_json(response), found)


def final_keep(decision_: Column, score_: Column, min_score: float = 0.6) -> Column:
    return (decision_ == "keep") & (score_ >= min_score)
