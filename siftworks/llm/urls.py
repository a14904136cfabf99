"""URL filter: host and path rules, and a ratio of two character language models for the rest.

Built-in SQL functions only. The models see 33 kinds of characters and contexts of two, so each
has 33**3 parameters at most, whatever the input; they reach the scan as one constant array.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (verdict, host, path) of the default rules.
RULES = (
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
)

_AZ = "abcdefghijklmnopqrstuvwxyz"
#: The kinds of characters; "^" stands before a URL, "0" for digits, "?" for query marks, "~" for all others.
KINDS = "^" + _AZ + "0/.-?~"
SIZE = len(KINDS)
#: Weight of the shorter context, parts of a nat in an integer weight, bins of the calibration in a nat.
BACKOFF, MICRO, BINS = 1.0, 1_000_000, 100


def _after(url: Column) -> Column:
    """What follows the first ``://``; empty without one or for null."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(_after(url), "^[^/?#]*", 0), _AZ.upper(), _AZ)


def path(url: Column) -> Column:
    return F.regexp_extract(_after(url), "^[^/?#]*([^?#]*)", 1)


def rule(host_: Column, path_: Column, rules: tuple[tuple[str, str, str], ...] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as host and path together, and its verdict; null where none fits."""
    name = verdict = F.lit(None).cast("string")
    for what, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host_ == h) | host_.endswith("." + h)) & path_.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, what).otherwise(verdict)
    return name, verdict


def _codes(url: Column) -> Column:
    """The kinds of a URL's characters after ``://``, two start kinds first."""
    kinds = F.translate(F.translate(_after(url), _AZ.upper() + "123456789_&=#", _AZ + "000000000-???"), "^", "~")
    chars = F.filter(F.split(kinds, ""), lambda c: c != "")
    code = lambda c: F.when(F.instr(F.lit(KINDS), c) > 0, F.instr(F.lit(KINDS), c) - 1).otherwise(SIZE - 1)
    return F.concat(F.array(F.lit(0), F.lit(0)), F.transform(chars, code))


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it occurs there; else every step of a lambda would compute it anew."""
    return F.get(F.transform(F.array(value), use), 0)


def _grams(url: Column) -> Column:
    def of(codes: Column) -> Column:
        n = F.size(codes) - 2
        return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(codes, i) * SIZE**2 + F.get(codes, i + 1) * SIZE + F.get(codes, i + 2))).otherwise(F.array().cast("array<int>"))

    return _once(_codes(url), of)


@dataclass(frozen=True)
class Model:
    """Log-likelihood differences by context and character, in millionths of a nat, and the least mean accepted."""

    weights: tuple[int, ...]
    threshold: float

    def score(self, url: Column) -> Column:
        """Mean log-likelihood difference per character, accepted less rejected; 0 for an empty URL."""
        table = F.split(F.lit(",".join(map(str, self.weights))), ",").cast("array<int>")  # folded to a constant
        mean = lambda g: F.aggregate(g, F.lit(0).cast("long"), lambda s, x: s + F.get(table, x)) / F.greatest(F.size(g), F.lit(1)) / MICRO
        return F.coalesce(_once(_grams(url), mean), F.lit(0.0))


def _ratio(counts: DataFrame) -> DataFrame:
    """(g, w) for all SIZE**3 grams from (g, accepted, rejected): smoothed, shorter contexts where longer ones are rare."""
    spark = counts.sparkSession
    grid = spark.range(SIZE**3).select(F.col("id").cast("int").alias("g"))
    full = grid.join(F.broadcast(counts), "g", "left").na.fill(0)
    for c in ("accepted", "rejected"):
        full = full.withColumnRenamed(c, f"n3_{c}")
    full = full.withColumns({"ab": F.floor(F.col("g") / SIZE), "bc": F.col("g") % SIZE**2, "b": F.floor(F.col("g") / SIZE) % SIZE, "c": F.col("g") % SIZE})
    both = ("accepted", "rejected")
    sums = lambda key, name: full.groupBy(key).agg(*(F.sum(f"n3_{k}").alias(f"{name}_{k}") for k in both))
    for key, name in (("ab", "t2"), ("bc", "n2"), ("b", "t1"), ("c", "n1")):
        full = full.join(F.broadcast(sums(key, name)), key)
    whole = full.agg(*(F.sum(f"n3_{k}").alias(f"t0_{k}") for k in both))
    full = full.crossJoin(F.broadcast(whole))  # one row

    def p(k: str) -> Column:
        p0 = (F.col(f"n1_{k}") + 1.0) / (F.col(f"t0_{k}") + float(SIZE))
        p1 = (F.col(f"n2_{k}") + BACKOFF * p0) / (F.col(f"t1_{k}") + BACKOFF)
        return (F.col(f"n3_{k}") + BACKOFF * p1) / (F.col(f"t2_{k}") + BACKOFF)

    return full.select("g", F.round((F.log(p("accepted")) - F.log(p("rejected"))) * MICRO).cast("int").alias("w"))


def fit(urls: DataFrame) -> Model:
    """Learns from all rows of (url, accepted boolean).

    Grams of both classes are counted with partial sums, so at most SIZE**3 rows leave the
    shuffle, whatever one host or URL contributes. URLs whose md5 starts with 0, 1 or 2 are
    kept out of the counts; the threshold is the edge, in hundredths of a nat, that splits
    these with the highest balanced accuracy (the least of equals). Without both classes among
    them the threshold is 0. Null URLs and null marks are ignored.
    """
    urls = urls.where("url is not null and accepted is not null").withColumn("kept_out", F.substring(F.md5("url"), 1, 1).isin("0", "1", "2"))
    one = lambda c: F.sum(F.when(c, 1).otherwise(0))
    grams = urls.where("not kept_out").select("accepted", F.explode(_grams(F.col("url"))).alias("g"))
    counts = grams.groupBy("g").agg(one(F.col("accepted")).alias("accepted"), one(~F.col("accepted")).alias("rejected"))
    weights = tuple(r.w for r in sorted(_ratio(counts).collect()))
    model = Model(weights, 0.0)
    bins = F.greatest(F.least(F.floor(model.score(F.col("url")) * BINS), F.lit(2000)), F.lit(-2000))
    held = urls.where("kept_out").groupBy(bins.alias("bin")).agg(one(F.col("accepted")).alias("a"), one(~F.col("accepted")).alias("r")).orderBy("bin").collect()
    all_a, all_r = sum(x.a for x in held), sum(x.r for x in held)
    if not all_a or not all_r:
        return model
    best, threshold, a, r = -1.0, 0.0, 0, 0
    for x in held:
        if (got := ((all_a - a) / all_a + r / all_r) / 2) > best:
            best, threshold = got, x.bin / BINS
        a, r = a + x.a, r + x.r
    return Model(weights, threshold)


def judge(pages: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES, model: Model | None = None) -> DataFrame:
    """``pages`` with host, path, rule, score and verdict (replaced where the names are taken).

    Rules decide first; what no rule fits is allowed from the model's threshold. Without a
    model, one is learned from the URLs that rules decide. A null URL, or one without
    ``://``, has empty host and path, fits no rule and scores 0. Repeated rows are judged alike.
    """
    df = pages.withColumn("url", F.col("url").cast("string")) if dict(pages.dtypes)["url"] != "string" else pages
    found = df.withColumns({"host": F.coalesce(host(F.col("url")), F.lit("")), "path": F.coalesce(path(F.col("url")), F.lit(""))})
    name, verdict = rule(F.col("host"), F.col("path"), rules)
    found = found.withColumns({"rule": name, "verdict": verdict})
    if model is None:
        model = fit(found.select("url", (F.col("verdict") == "allow").alias("accepted")))
    found = found.withColumn("score", model.score(F.col("url")))
    return found.withColumn("verdict", F.coalesce("verdict", F.when(F.col("score") >= model.threshold, "allow").otherwise("block")))


def oracle_sql(rules: tuple[tuple[str, str, str], ...] = RULES) -> str:
    """DuckDB SQL for the rows of ``judge`` with the model it learns from the rules."""
    longest = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    fits = lambda h, p: f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"
    names = " ".join(f"WHEN {fits(h, p)} THEN '{h}{p}'" for _, h, p in longest)
    verdicts = " ".join(f"WHEN {fits(h, p)} THEN '{v}'" for v, h, p in longest)
    k = SIZE
    p = lambda c: f"((n3{c} + {BACKOFF} * ((n2{c} + {BACKOFF} * ((n1{c} + 1.0) / (t0{c} + {k}.0))) / (t1{c} + {BACKOFF}))) / (t2{c} + {BACKOFF}))"
    over = lambda n, by: ", ".join(f"sum(n3{c}) OVER ({by}) AS {n}{c}" for c in "ar")
    return f"""
WITH u AS (SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS tail FROM pages),
hp AS (SELECT page_id, url, tail, translate(regexp_extract(tail, '^[^/?#]*'), '{_AZ.upper()}', '{_AZ}') AS host, regexp_extract(tail, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
j AS (SELECT row_number() OVER () AS i, *, CASE {names} END AS rule, CASE {verdicts} END AS verdict, substr(md5(url), 1, 1) IN ('0', '1', '2') AS kept_out,
      list_transform(list_filter(string_split(translate(translate(tail, '{_AZ.upper()}123456789_&=#', '{_AZ}000000000-???'), '^', '~'), ''), lambda c: c <> ''),
                     lambda c: CASE WHEN strpos('{KINDS}', c) > 0 THEN strpos('{KINDS}', c) - 1 ELSE {k - 1} END) AS codes FROM hp),
ch AS (SELECT i, verdict, kept_out, unnest(codes) AS c, generate_subscripts(codes, 1) AS pos FROM j),
gr AS (SELECT i, verdict, kept_out, coalesce(lag(c, 2) OVER w, 0) * {k * k} + coalesce(lag(c, 1) OVER w, 0) * {k} + c AS g FROM ch WINDOW w AS (PARTITION BY i ORDER BY pos)),
cnt AS (SELECT g, count(*) FILTER (verdict = 'allow') AS a, count(*) FILTER (verdict = 'block') AS r FROM gr WHERE NOT kept_out AND verdict IS NOT NULL GROUP BY g),
grid AS (SELECT x AS g, coalesce(a, 0) AS n3a, coalesce(r, 0) AS n3r FROM range({k**3}) t(x) LEFT JOIN cnt ON g = x),
sums AS (SELECT *, {over("t2", f"PARTITION BY g // {k}")}, {over("n2", f"PARTITION BY g % {k * k}")}, {over("t1", f"PARTITION BY (g // {k}) % {k}")}, {over("n1", f"PARTITION BY g % {k}")}, {over("t0", "")} FROM grid),
model AS (SELECT g, CAST(round((ln({p("a")}) - ln({p("r")})) * {MICRO}) AS BIGINT) AS w FROM sums),
sc AS (SELECT j.i, any_value(j.page_id) AS page_id, any_value(host) AS host, any_value(path) AS path, any_value(rule) AS rule, any_value(j.verdict) AS verdict, any_value(j.kept_out) AS kept_out,
       CAST(coalesce(sum(w), 0) AS DOUBLE) / greatest(count(w), 1) / {MICRO} AS score FROM j LEFT JOIN gr ON gr.i = j.i LEFT JOIN model USING (g) GROUP BY j.i),
bins AS (SELECT CAST(greatest(least(floor(score * {BINS}), 2000), -2000) AS BIGINT) AS bin, count(*) FILTER (verdict = 'allow') AS a, count(*) FILTER (verdict = 'block') AS r FROM sc WHERE kept_out AND verdict IS NOT NULL GROUP BY 1),
acc AS (SELECT bin, (sum(a) OVER (ORDER BY bin ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) / sum(a) OVER () + coalesce(sum(r) OVER (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / sum(r) OVER ()) / 2 AS got, sum(a) OVER () AS na, sum(r) OVER () AS nr FROM bins),
th AS (SELECT coalesce((SELECT CASE WHEN na > 0 AND nr > 0 THEN bin / {BINS}.0 END FROM acc ORDER BY got DESC, bin LIMIT 1), 0.0) AS t)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule, coalesce(verdict, CASE WHEN score >= t THEN 'allow' ELSE 'block' END) AS verdict, round(score, 9) AS score FROM sc, th
"""
