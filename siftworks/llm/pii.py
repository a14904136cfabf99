"""Personal data in texts: patterns propose spans, checksums confirm them, context words adjust scores.

Built-in SQL functions only; one pass over the documents, no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_LOCAL = "A-Za-z0-9._%+-"
_PART = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"

# Possessive forms of the base patterns. They match the same spans: what follows each
# repeated class is outside it, so giving characters back never helps, and a leftmost match
# starts where its first class begins to match or where the match before it ended (\G).
EMAIL = rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}+"
CARD = r"[0-9](?:[\x20-]?[0-9]){12,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}+(?![A-Za-z0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
TEL = r"(?<![0-9+(-])(?:\([0-9]{3}\)\x20|[0-9]{3}[.\x20-])[0-9]{3}[.\x20-][0-9]{4}(?![0-9-])"

#: Matches whose positions are summed together, and characters of a text that are cut together: a text with very many matches takes time in proportion.
BLOCK, CUT = 256, 1024
#: Characters before a span in which context words count.
NEAR = 40


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(s: Column) -> Column:
    """Whether the digits of ``s`` pass the Luhn check."""
    d = _digits(s)

    def add(acc: Column, i: Column) -> Column:
        x = F.substring(d, -i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return acc + x - F.when(x > 9, 9).otherwise(0)

    return F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(d), F.lit(1))), F.lit(0), add) % 10 == 0


def mod97(s: Column) -> Column:
    """Whether ``s``, an account number with letters and spaces, passes the mod-97 check."""
    bare = F.replace(s, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(bare, F.lit(5), F.length(bare)), F.substring(bare, 1, 4))

    def add(acc: Column, c: Column) -> Column:
        x = F.ascii(c)
        return F.when(x >= 65, acc * 100 + x - 55).otherwise(acc * 10 + x - 48) % 97

    return F.aggregate(F.split(turned, ""), F.lit(0), lambda a, c: F.when(c == "", a).otherwise(add(a, c))) == 1


@dataclass(frozen=True)
class Kind:
    """A kind of personal data: its pattern, the check that confirms a match, and its score."""

    name: str
    pattern: str
    confirmed: Callable[[Column], Column]
    score: float
    context: str
    base: bool = True
    #: Texts without this can't match.
    needs: str = "[0-9]"


def _between(lo: int, hi: int) -> Callable[[Column], Column]:
    return lambda s: F.length(_digits(s)).between(lo, hi)


KINDS = (
    Kind("email", EMAIL, lambda s: F.lit(True), 0.9, "mail|contact|write", needs="@"),
    Kind("ip", IP, lambda s: s.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"), 0.6, "address|host|server|login"),
    Kind("card", CARD, lambda s: F.when(F.length(_digits(s)).between(13, 19), luhn(s)).otherwise(False), 0.7, "card|credit|visa|payment"),
    Kind("phone", PHONE, _between(9, 15), 0.7, "phone|call|tel|mobile|fax"),
    Kind("iban", IBAN, mod97, 0.8, "iban|account|bank", base=False),
    Kind("ssn", SSN, lambda s: ~s.rlike("^(?:000|666|9)|-00-|-0000$"), 0.4, "ssn|social security", base=False),
    Kind("tel", TEL, lambda s: F.lit(True), 0.4, "phone|call|tel|mobile|fax", base=False),
)


def _starts(pieces: Column, matches: Column) -> Column:
    """Where each match starts, in code points: the lengths of all pieces up to it and of the matches before it."""
    n = F.size(matches)
    gaps = F.zip_with(F.slice(pieces, F.lit(1), n), matches, lambda a, b: F.struct(F.length(a).alias("gap"), F.length(b).alias("len")))
    blocks = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / BLOCK).cast("int")), lambda k: F.slice(gaps, k * BLOCK + 1, F.lit(BLOCK)))
    Pos = "struct<at:int,out:array<int>>"

    def walk(first: Column, items: Column) -> Column:
        start = F.struct(first.alias("at"), F.array().cast("array<int>").alias("out")).cast(Pos)
        return F.aggregate(items, start, lambda acc, g: F.struct((acc["at"] + g["gap"] + g["len"]).alias("at"), F.concat(acc["out"], F.array(acc["at"] + g["gap"])).alias("out")).cast(Pos))

    sizes = F.transform(blocks, lambda b: F.struct(F.aggregate(b, F.lit(0), lambda s, g: s + g["gap"] + g["len"]).alias("gap"), F.lit(0).alias("len")))
    firsts = walk(F.lit(0), sizes)["out"]
    ends = F.zip_with(firsts, sizes, lambda e, s: e - s["gap"])
    return F.flatten(F.zip_with(ends, blocks, lambda at, b: walk(at, b)["out"]))


def find_spans(docs: DataFrame, threshold: float = 0.6, kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """``docs`` plus ``spans``: array of (kind, start, end, value, score), by kind as in ``kinds``, then start.

    Positions are code points, end exclusive. Each kind takes leftmost matches that don't
    overlap; a match that its check refuses is dropped and not searched again. Base kinds stay
    whatever their score; others stay from ``threshold``, which context words in the NEAR
    characters before a span (as far back as the kind's second match before it) help to reach. Null and empty texts have no spans; repeated rows
    are treated alike; columns of ``docs`` pass through, and an input column named ``spans``
    is replaced. Columns named ``_pii_*`` are the operator's own.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    df = docs.withColumn("_pii_t", text).withColumns({"_pii_d": F.col("_pii_t").rlike("[0-9]"), "_pii_a": F.contains(F.col("_pii_t"), F.lit("@"))})
    t, none = F.col("_pii_t"), F.array().cast("array<string>")
    may = {"@": F.col("_pii_a"), "[0-9]": F.col("_pii_d")}
    df = df.withColumns({f"_pii_m_{k.name}": F.when(may[k.needs], F.regexp_extract_all(t, F.lit(k.pattern), F.lit(0))).otherwise(none) for k in kinds})
    some = {k.name: F.size(f"_pii_m_{k.name}") > 0 for k in kinds}
    df = df.withColumns({f"_pii_p_{k.name}": F.when(some[k.name], F.split(t, k.pattern, -1)) for k in kinds})
    df = df.withColumns({f"_pii_s_{k.name}": F.when(some[k.name], _starts(F.col(f"_pii_p_{k.name}"), F.col(f"_pii_m_{k.name}"))) for k in kinds})

    def spans(k: Kind) -> Column:
        at, match, piece = (F.col(f"_pii_{c}_{k.name}") for c in "smp")
        near = lambda c: F.right(c, F.lit(NEAR))

        def one(i: Column) -> Column:
            before = near(F.concat(F.when(i > 0, F.concat(near(F.get(piece, i - 1)), near(F.get(match, i - 1)))).otherwise(""), near(F.get(piece, i))))
            value = F.get(match, i)
            fields = {"kind": F.lit(k.name), "start": F.get(at, i), "end": F.get(at, i) + F.length(value), "value": value}
            return F.struct(*(v.alias(c) for c, v in fields.items()), (F.lit(k.score) + F.when(F.lower(before).rlike(k.context), 0.3).otherwise(0.0)).alias("score"))

        found = F.filter(F.transform(F.sequence(F.lit(0), F.size(match) - 1), one), lambda x: k.confirmed(x["value"]))
        kept = found if k.base else F.filter(found, lambda x: x["score"] >= threshold)
        return F.when(some[k.name], kept).otherwise(F.array().cast("array<struct<kind:string,start:int,end:int,value:string,score:double>>"))

    df = df.withColumns({f"_pii_x_{k.name}": spans(k) for k in kinds})
    df = df.withColumn("spans", F.concat(*(F.col(f"_pii_x_{k.name}") for k in kinds)))
    return df.drop(*(c for c in df.columns if c.startswith("_pii_")))


def written(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def _with_runs(df: DataFrame, some: Column) -> DataFrame:
    """``df`` plus _pii_r: the spans in order as runs (kind of the first, start, end) that don't overlap.

    Each step is a column of its own, so that no step is computed again for each element of the next.
    """
    Span = "struct<start:int,end:int,kind:string,far:int>"
    c = lambda k: F.col(f"_pii_{k}")
    by_start = F.array_sort(F.transform("spans", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))))
    df = df.withColumn("_pii_o", F.when(some, by_start))
    df = df.withColumn("_pii_k", F.transform(F.sequence(F.lit(0), F.floor((F.size(c("o")) - 1) / BLOCK).cast("int")), lambda k: F.slice(c("o"), k * BLOCK + 1, F.lit(BLOCK))))
    df = df.withColumn("_pii_e", F.transform(c("k"), lambda b: F.array_max(F.transform(b, lambda x: x["end"]))))
    df = df.withColumn("_pii_f", F.transform(c("k"), lambda b, k: F.coalesce(F.array_max(F.slice(c("e"), F.lit(1), k)), F.lit(0))))

    def walk(block: Column, far: Column) -> Column:
        """Each span with the farthest end before it."""
        begin = F.struct(far.alias("far"), F.array().cast(f"array<{Span}>").alias("out"))
        return F.aggregate(block, begin, lambda acc, x: F.struct(F.greatest(acc["far"], x["end"]).alias("far"), F.concat(acc["out"], F.array(F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"), acc["far"].alias("far")))).alias("out")))["out"]

    df = df.withColumn("_pii_h", F.filter(F.flatten(F.zip_with(c("k"), c("f"), walk)), lambda x: x["start"] >= x["far"]))
    df = df.withColumn("_pii_l", F.array_max(c("e")))
    run = F.transform(c("h"), lambda x, i: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), F.coalesce(F.get(c("h"), i + 1)["far"], c("l")).alias("end")))
    return df.withColumn("_pii_r", run)


def mask_text(docs: DataFrame) -> DataFrame:
    """Replaces every span of ``docs`` (with text, spans) by ``<kind>``; spans that overlap become one, named after the first.

    Texts without spans, null ones among them, stay as they are; other columns pass through.
    """
    some = F.size("spans") > 0
    df = _with_runs(docs, some)
    df = df.withColumn("_pii_b", F.when(some, F.regexp_extract_all("text", F.lit("(?s).{1,%d}" % CUT), F.lit(0))))
    r, n, blocks = F.col("_pii_r"), F.size("_pii_r"), F.col("_pii_b")

    def between(a: Column, b: Column) -> Column:
        """Characters a to b of the text, cut out of its blocks."""
        first, last = F.floor(a / CUT).cast("int"), F.floor(b / CUT).cast("int")
        inner = F.array_join(F.slice(blocks, first + 2, F.greatest(last - first - 1, F.lit(0))), "")
        head = F.substring(F.coalesce(F.get(blocks, first), F.lit("")), a % CUT + 1, F.lit(CUT))
        tail = F.substring(F.coalesce(F.get(blocks, last), F.lit("")), F.lit(1), b % CUT)
        return F.when(first == last, F.substring(F.coalesce(F.get(blocks, first), F.lit("")), a % CUT + 1, b - a)).otherwise(F.concat(head, inner, tail))

    def piece(i: Column) -> Column:
        begin = F.when(i > 0, F.get(r, i - 1)["end"]).otherwise(0)
        end = F.when(i < n, F.get(r, i)["start"]).otherwise(F.length("text"))
        return F.concat(between(begin, end), F.when(i < n, F.concat(F.lit("<"), F.get(r, i)["kind"], F.lit(">"))).otherwise(""))

    return df.withColumn("text", F.when(some, F.array_join(F.transform(F.sequence(F.lit(0), n), piece), "")).otherwise(F.col("text"))).drop(*(f"_pii_{k}" for k in "okefhlrb"))
