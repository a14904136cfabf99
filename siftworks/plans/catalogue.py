"""Registered queries over the driver tables and the SQL that must agree with them."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import models, text, vectors, verdict
from ..operators import dedup, filters, index, limits, scoring
from ..session import table
from ..sources import download, files, pages, sinks
from ..staging import shared_dir
from ..streaming import ingest
from . import stages

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def _query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name, with the SQL that gives the same rows."""

    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


@_query("""
WITH first AS (SELECT sha1(text) AS sha1, min(doc_id) AS doc_id, arg_min(n_chars, doc_id) AS n_chars FROM documents GROUP BY 1),
     new AS (SELECT * FROM first WHERE doc_id NOT IN (SELECT doc_id FROM labels))
SELECT CASE WHEN least(1.0, n_chars / 2000.0) >= 0.6 THEN 'keep' ELSE 'reject' END AS route, count(*) AS n_docs FROM new GROUP BY 1""")
def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First copy of each text, absent from the labels index, scored and routed; documents per route."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars").withColumn("sha1", text.content_key(F.col("text"))).drop("text")
    new = dedup.new_by_key(dedup.first_by_key(docs, F.col("sha1"), ["doc_id"]), table(spark, sf_dir, "labels"), "doc_id")
    score = F.least(F.lit(1.0), F.col("n_chars") / 2000)
    return new.groupBy(scoring.route(score >= 0.6).alias("route")).agg(F.count("*").alias("n_docs"))


@_query("SELECT sha1(text) AS sha1, min(doc_id) AS doc_id FROM documents GROUP BY 1")
def exact_dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", text.content_key(F.col("text")).alias("sha1"))
    return dedup.first_by_key(docs, F.col("sha1"), ["doc_id"]).select("sha1", "doc_id")


@_query("SELECT md5(url) AS url_md5, min(page_id) AS page_id FROM pages WHERE md5(url) NOT IN (SELECT md5(url) FROM pages WHERE starts_with(url, 'https://')) GROUP BY 1")
def url_key_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", text.url_key(F.col("url")).alias("url_md5"))
    known = pages.where(F.col("url").startswith("https://"))
    return dedup.first_by_key(dedup.new_by_key(pages, known, "url_md5"), F.col("url_md5"), ["page_id"], "k").select("url_md5", "page_id")


@_query("SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def anti_join_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.new_by_key(table(spark, sf_dir, "documents").select("doc_id", "source"), table(spark, sf_dir, "labels"), "doc_id")


_TITLE = "regexp_extract(html, '<title>([^<]*)</title>', 1)"
_SLUG = "regexp_replace(regexp_replace(regexp_replace(lower(trim({0}, ' \t\n\r')), '[^\\p{{L}}\\p{{N}}_\\-]+', '-', 'g'), '-{{2,}}', '-', 'g'), '^[-_]+|[-_]+$', '', 'g')"


@_query(f"""
WITH t AS (SELECT 'page' AS kind, page_id AS id, {_TITLE} AS name FROM pages UNION ALL SELECT 'part', p_partkey, p_type FROM part)
SELECT kind, id, CASE WHEN {_SLUG.format("name")} = '' THEN substr(sha1(name), 1, 12) ELSE {_SLUG.format("name")} END AS slug FROM t""")
def slug(spark: SparkSession, sf_dir: str) -> DataFrame:
    titles = table(spark, sf_dir, "pages").select(F.lit("page").alias("kind"), F.col("page_id").alias("id"), F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("name"))
    parts = table(spark, sf_dir, "part").select(F.lit("part"), "p_partkey", "p_type")
    return titles.union(parts).select("kind", "id", text.slug(F.col("name")).alias("slug"))


@_query("SELECT page_id, unnest(list_distinct(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1))) AS href FROM pages")
def html_url_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.explode(text.links(F.col("html"))).alias("href"))


@_query("SELECT count(DISTINCT href) AS n_targets, count(*) AS n_hits FROM (SELECT unnest(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1)) AS href FROM pages)")
def link_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = table(spark, sf_dir, "pages").select(F.explode(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))).alias("href"))
    return hits.groupBy("href").agg(F.count("*").alias("n")).agg(F.count("*").alias("n_targets"), F.sum("n").alias("n_hits"))


@_query("""
WITH h AS (SELECT page_id, url, unnest(list_distinct(regexp_extract_all(html, 'href="([^"]*)"', 1))) AS href FROM pages)
SELECT DISTINCT page_id, CASE WHEN regexp_matches(href, '^[a-z]+:') THEN href WHEN starts_with(href, '//') THEN regexp_extract(url, '^([a-z]+):', 1) || ':' || href
  WHEN starts_with(href, '/') THEN regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || href ELSE regexp_extract(url, '^([a-z]+://[^/?#]*(?:/[^/?#]*)*/)[^/?#]*', 1) || href END AS target FROM h""")
def resolved_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "pages").select("page_id", "url", F.explode(text.links(F.col("html"))).alias("href"))
    return found.select("page_id", text.resolve(F.col("href"), F.col("url")).alias("target")).distinct()


_FIELDS = "CASE WHEN page_id % 3 = 0 THEN 'ftp://x' || page_id END AS hover, CASE WHEN page_id % 5 <> 0 THEN url ELSE '' END AS obj, CASE WHEN page_id % 2 = 0 THEN 'http://thumb/' || page_id END AS thumb"


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("page_id")
    pages = table(spark, sf_dir, "pages")
    return pages.select(
        "page_id",
        F.when(i % 3 == 0, F.concat(F.lit("ftp://x"), i)).alias("hover"),
        F.when(i % 5 != 0, F.col("url")).otherwise("").alias("obj"),
        F.when(i % 2 == 0, F.concat(F.lit("http://thumb/"), i)).alias("thumb"),
        F.when(i % 7 == 0, F.array(F.struct(F.lit(None).cast("string").alias("ObjURL"), F.concat(F.lit("https://from/"), i).alias("FromURL")))).alias("replaced"),
    )


@_query(f"""
WITH c AS (SELECT page_id, {_FIELDS}, CASE WHEN page_id % 7 = 0 THEN 'https://from/' || page_id END AS again FROM pages)
SELECT page_id, CASE WHEN regexp_matches(hover, '^https?://') THEN hover WHEN regexp_matches(obj, '^https?://') THEN obj WHEN regexp_matches(thumb, '^https?://') THEN thumb
  WHEN regexp_matches(again, '^https?://') THEN again END AS url FROM c""")
def first_valid_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = [F.col(c) for c in ("hover", "obj", "thumb")]
    return _candidates(spark, sf_dir).select("page_id", text.first_valid_url(fields, F.col("replaced")).alias("url"))


@_query(f"""
WITH c AS (SELECT page_id, {_FIELDS} FROM pages), f AS (SELECT page_id, coalesce(nullif(hover, ''), nullif(obj, ''), nullif(thumb, '')) AS u FROM c)
SELECT page_id, u AS url FROM f WHERE regexp_matches(u, '^https?://')""")
def first_truthy_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = text.first_truthy_url([F.col(c) for c in ("hover", "obj", "thumb")])
    return _candidates(spark, sf_dir).select("page_id", url.alias("url")).where("url is not null")


@_query("""
WITH q AS (SELECT page_id, regexp_extract(url, '\\?([^#]*)', 1) AS q FROM pages), p AS (SELECT page_id, unnest(string_split(q, '&')) AS kv FROM q WHERE q <> '')
SELECT page_id, string_split(kv, '=')[1] AS key, url_decode(replace(substr(kv, strpos(kv, '=') + 1), '+', ' ')) AS value FROM p""")
def query_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.explode(text.query_map(F.col("url"))).alias("key", "value"))


@_query("""
SELECT page_id, lower(to_hex(page_id * 30)) AS gsm, 'https://search.invalid/s?word=' || replace(replace(replace(url_encode(url), '%20', '+'), '%2A', '*'), '~', '%7E') || '&pn=' || (page_id * 30) AS request FROM pages""")
def page_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form encoding keeps ``*`` and encodes ``~``; the SQL adapts its encoder."""
    i = (F.col("page_id") * 30).cast("long")
    return table(spark, sf_dir, "pages").select("page_id", text.hex_offset(i).alias("gsm"), text.build_url("https://search.invalid/s", [("word", F.col("url")), ("pn", i.cast("string"))]).alias("request"))


@_query("""
SELECT p_partkey, CAST(least(60, greatest(30, coalesce(TRY_CAST(CASE WHEN p_partkey % 4 = 0 THEN 'x' ELSE CAST(p_size * 2 AS VARCHAR) END AS INT), 30))) AS BIGINT) AS page_size,
  coalesce(nullif(CASE WHEN p_partkey % 2 = 0 THEN p_brand ELSE '' END, ''), printf('row-%05d', p_partkey)) AS identifier,
  'data:application/octet-stream;base64,' || base64(encode(p_name || repeat(p_type, 5))) AS data_url FROM part""")
def item_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    part, k = table(spark, sf_dir, "part"), F.col("p_partkey")
    size = F.when(k % 4 == 0, "x").otherwise((F.col("p_size") * 2).cast("string"))
    name = F.when(k % 2 == 0, F.col("p_brand")).otherwise("")
    content = F.encode(F.concat("p_name", F.repeat("p_type", F.lit(5))), "UTF-8")
    return part.select("p_partkey", text.page_size(size).cast("long").alias("page_size"), text.identifier([name], k).alias("identifier"), text.data_url(content, F.col("p_name")).alias("data_url"))


@_query("""
WITH p AS (SELECT doc_id, source || '/' || CASE WHEN doc_id % 3 = 0 THEN upper(sha1(text)) ELSE 'img' || doc_id END || '.jpg' AS path, text FROM documents)
SELECT doc_id, CASE WHEN starts_with(path, 'src1/') THEN substr(path, 6) ELSE path END AS relative, CASE WHEN doc_id % 5 = 0 THEN 'known' || doc_id ELSE sha1(text) END AS sha1 FROM p""")
def sha1_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("doc_id")
    path = F.concat("source", F.lit("/"), F.when(i % 3 == 0, F.upper(F.sha1("text"))).otherwise(F.concat(F.lit("img"), i)), F.lit(".jpg"))
    docs = table(spark, sf_dir, "documents").select("doc_id", path.alias("path"), F.when(i % 5 == 0, F.concat(F.lit("known"), i)).alias("known"), F.encode("text", "UTF-8").alias("content"))
    return docs.select("doc_id", text.relative_path(F.col("path"), "src1").alias("relative"), text.choose_sha1(F.col("known"), F.col("path"), F.col("content")).alias("sha1"))


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings")


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cosines of every vector with the first vectors of labels 0 to 4, standing for the five prompts."""
    items = _vectors(spark, sf_dir)
    names = F.array(*map(F.lit, scoring.PROMPTS))
    first = items.where("label < 5").groupBy("label").agg(F.min_by("embedding", "vec_id").alias("prompt_vector"))
    return scoring.prompt_scores(items, first.select(F.get(names, F.col("label")).alias("name"), "prompt_vector"))


_COS = "WITH a AS (SELECT label, arg_min(embedding, vec_id)::DOUBLE[] AS p FROM embeddings WHERE label < 5 GROUP BY label), s AS (SELECT vec_id, e.label AS label, " + ", ".join(f"list_cosine_similarity(embedding::DOUBLE[], (SELECT p FROM a WHERE label = {k})) AS {n}" for k, n in enumerate(scoring.PROMPTS)) + " FROM embeddings e) "


@_query(_COS + "SELECT vec_id, " + ", ".join(f"round({n}, 6) AS {n}" for n in scoring.PROMPTS) + " FROM s")
def cosine_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scores(spark, sf_dir).select("vec_id", *(F.round(n, 6).alias(n) for n in scoring.PROMPTS))


@_query(_COS + "SELECT vec_id FROM s WHERE NOT (indoor < outdoor + 0.02)")
def indoor_margin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scores(spark, sf_dir).where(filters.indoor(F.col("indoor"), F.col("outdoor"))).select("vec_id")


@_query(_COS + "SELECT vec_id FROM s WHERE moderate >= greatest(tidy, messy) + 0.01")
def moderate_margin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scores(spark, sf_dir).where(filters.moderate(F.col("moderate"), F.col("tidy"), F.col("messy"), 0.01)).select("vec_id")


@_query("WITH c AS (SELECT vec_id, len(list_filter(embedding, lambda x: x >= 0.15)) AS n FROM embeddings) SELECT vec_id, CAST(n AS BIGINT) AS object_count FROM c WHERE n BETWEEN 5 AND 9")
def object_count_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = _vectors(spark, sf_dir).select("vec_id", vectors.object_count(F.col("embedding"), 0.15).cast("long").alias("object_count"))
    return counted.where(filters.count_range(F.col("object_count"), 5, 9))


_BITS = "list_sum(list_transform(range(64), lambda i: CASE WHEN embedding[i + 1] > embedding[(i + 1) % 64 + 1] THEN CASE WHEN i = 63 THEN -(CAST(9223372036854775808 AS HUGEINT)) ELSE CAST(1 AS HUGEINT) << CAST(i AS INT) END ELSE 0 END))"
_CODES = f"WITH c AS (SELECT vec_id, label, CAST({_BITS} AS BIGINT) AS code FROM embeddings) "


@_query(_CODES + "SELECT vec_id, code FROM c")
def dhash_bits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _vectors(spark, sf_dir).select("vec_id", vectors.circular_hash(F.col("embedding")).alias("code"))


@_query("""
WITH p AS (SELECT vec_id, list_transform(range(72), lambda i: CAST(floor((embedding[i % 64 + 1] + 1) * 128) AS INT)) AS px FROM embeddings)
SELECT vec_id, CAST(list_sum(list_transform(range(64), lambda i: CASE WHEN px[i // 8 * 9 + i % 8 + 1] > px[i // 8 * 9 + i % 8 + 2] THEN CASE WHEN i = 63 THEN -(CAST(9223372036854775808 AS HUGEINT)) ELSE CAST(1 AS HUGEINT) << CAST(i AS INT) END ELSE 0 END)) AS BIGINT) AS dhash FROM p""")
def difference_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    pixels = F.transform(F.sequence(F.lit(0), F.lit(71)), lambda i: F.floor((F.get("embedding", i % 64).cast("float") + F.lit(1).cast("float")) * F.lit(128).cast("float")).cast("int"))
    return _vectors(spark, sf_dir).select("vec_id", pixels.alias("px")).select("vec_id", vectors.difference_hash(F.col("px")).alias("dhash"))


_PLANTED = _CODES + ", s AS (SELECT label, arg_min(code, vec_id) AS seed_code, min(vec_id) AS seed_id FROM c GROUP BY label), i AS (SELECT * FROM c UNION ALL SELECT 1000000 + seed_id, label, xor(seed_code, 5) FROM s), d AS (SELECT i.vec_id, seed_id, CAST(bit_count(xor(code, seed_code)) AS BIGINT) AS distance FROM i JOIN s USING (label) WHERE i.vec_id <> seed_id) "


def _planted(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Codes by label with each label's first vector as seed, and one planted copy of each seed two bits away."""
    codes = _vectors(spark, sf_dir).select("vec_id", "label", vectors.circular_hash(F.col("embedding")).alias("code"))
    seeds = codes.groupBy("label").agg(F.min_by("code", "vec_id").alias("code"), F.min("vec_id").alias("seed_id"))
    copies = seeds.select((F.col("seed_id") + 1_000_000).alias("vec_id"), "label", F.col("code").bitwiseXOR(F.lit(5)).alias("code"))
    return codes.union(copies), seeds


@_query(_PLANTED + "SELECT vec_id, seed_id, distance FROM d WHERE distance > 20 AND distance <= 28")
def seed_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    items, seeds = _planted(spark, sf_dir)
    near = dedup.near_seed(items, seeds, "label", "vec_id").withColumn("distance", F.col("distance").cast("long"))
    return near.where(filters.hash_band(F.col("distance"), 28, 20)).select("vec_id", "seed_id", "distance")


@_query(_PLANTED + "SELECT vec_id, label FROM i WHERE vec_id NOT IN (SELECT vec_id FROM d WHERE distance <= 2)")
def seed_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    items, seeds = _planted(spark, sf_dir)
    return dedup.without_seed_copies(items, seeds, "label", "vec_id").select("vec_id", "label")


@_query(_PLANTED + ", r AS (SELECT code, min(vec_id) AS rep FROM i GROUP BY code) SELECT least(x.rep, y.rep) AS a, greatest(x.rep, y.rep) AS b, CAST(bit_count(xor(x.code, y.code)) AS BIGINT) AS distance FROM r x JOIN r y ON x.code < y.code AND bit_count(xor(x.code, y.code)) <= 2")
def banded_hamming_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    items, _ = _planted(spark, sf_dir)
    return dedup.banded_pairs(items, 2, "vec_id").withColumn("distance", F.col("distance").cast("long"))


@_query(_PLANTED + "SELECT vec_id, min(vec_id) OVER (PARTITION BY code) AS representative FROM i")
def code_representatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.representatives(_planted(spark, sf_dir)[0], "vec_id")


@_query("SELECT doc_id FROM documents WHERE n_chars BETWEEN 400 AND 6000 AND length(text) BETWEEN 400 AND 6000 AND n_chars::DOUBLE / length(text) BETWEEN 0.4 AND 2.5")
def size_aspect_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").where(filters.size_and_aspect(F.col("n_chars"), F.length("text"))).select("doc_id")


_VERDICT_JSON = """'{"decision": "' || CASE WHEN event_type = 'purchase' THEN ' KEEP ' ELSE event_type END || '", "score": ' || CAST(props->>'$.k' AS INT) / 50.0 || ', "reason": " ' || repeat(event_type, 40) || ' ", "room_tags": "A; b/' || event_type || '、b", "object_tags": ["X", "' || event_type || '", "x"]}'"""


def _said(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict's JSON for each event, every tenth broken."""
    kind, k = F.col("event_type"), F.get_json_object("props", "$.k").cast("int") / 50.0
    said = F.when(kind == "purchase", " KEEP ").otherwise(kind)
    json = F.to_json(F.struct(said.alias("decision"), k.alias("score"), F.concat(F.lit(" "), F.repeat(kind, F.lit(40)), F.lit(" ")).alias("reason"), F.concat(F.lit("A; b/"), kind, F.lit("、b")).alias("room_tags"), F.array(F.lit("X"), kind, F.lit("x")).alias("object_tags"), F.col("event_id").alias("own")))
    return table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 10 == 0, "[no object").otherwise(json).alias("json"))


_VERDICTS = f"""
WITH j AS (SELECT event_id, event_id % 10 <> 0 AS ok, CAST({_VERDICT_JSON} AS JSON) AS v FROM events),
n AS (SELECT event_id, ok, CASE WHEN lower(trim(v->>'$.decision')) IN ('keep', 'reject') THEN lower(trim(v->>'$.decision')) ELSE 'reject' END AS decision,
  round(greatest(0.0, least(1.0, CAST(v->>'$.score' AS DOUBLE))), 9) AS score, substr(trim(v->>'$.reason'), 1, 160) AS reason,
  'a,b,' || regexp_extract(v->>'$.room_tags', '/(.*)、', 1) AS room_tags, 'x,' || (v->>'$.object_tags[1]') AS object_tags FROM j) """


@_query(_VERDICTS + "SELECT event_id, ok, CASE WHEN ok THEN decision END AS decision, CASE WHEN ok THEN score END AS score, CASE WHEN ok THEN reason END AS reason, CASE WHEN ok THEN room_tags END AS room_tags, CASE WHEN ok THEN object_tags END AS object_tags FROM n")
def verdict_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _said(spark, sf_dir).select("event_id", verdict.normalise(F.col("json")).alias("v"))
    return out.select("event_id", "v.ok", "v.decision", F.round("v.score", 9).alias("score"), "v.reason", F.array_join("v.room_tags", ",").alias("room_tags"), F.array_join("v.object_tags", ",").alias("object_tags"))


@_query(_VERDICTS + "SELECT event_id, decision, room_tags, reason, CAST(event_id AS VARCHAR) AS own FROM n WHERE ok")
def raw_response(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw object with its five fields replaced: those, and one that stays."""
    raw = F.try_parse_json("raw")
    get = lambda k: F.try_variant_get(raw, f"$.{k}", "string")
    out = _said(spark, sf_dir).select("event_id", verdict.normalise(F.col("json"))["raw_response"].alias("raw")).where("raw is not null")
    return out.select("event_id", get("decision").alias("decision"), F.array_join(F.try_variant_get(raw, "$.room_tags", "array<string>"), ",").alias("room_tags"), get("reason").alias("reason"), get("own").alias("own"))


@_query("SELECT event_id, CASE WHEN event_id % 6 = 5 THEN NULL ELSE 'a' || event_id END AS said FROM events")
def response_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers in each of the shapes in use; some have other outputs and blank parts before the text, some have none."""
    i = F.col("event_id")
    shapes = ('{"output":[{"type":"reasoning"},{"content":[{"text":" "},{"text":"@"},{"text":"z"}]}]}', '{"output":[{"content":[{"text":{"value":"@"}}]}],"output_text":"z"}', '{"output":[],"output_text":" @ "}', '{"message":{"content":"@"},"response":"z"}', '{"response":"@"}', '{"response":" "}')
    said = F.replace(F.get(F.array(*map(F.lit, shapes)), (i % 6).cast("int")), F.lit("@"), F.concat(F.lit("a"), i))
    return table(spark, sf_dir, "events").select("event_id", verdict.response_text(said).alias("said"))


@_query("""
WITH t AS (SELECT doc_id, regexp_split_to_array(replace(text, ' ', ';'), '[;,/、|｜\\n]+') AS a FROM documents), u AS (SELECT doc_id, unnest(a) AS x, generate_subscripts(a, 1) AS i FROM t),
c AS (SELECT doc_id, lower(regexp_replace(x, '^[ \\t\\n\\x0B\\f\\r]+|[ \\t\\n\\x0B\\f\\r]+$', '', 'g')) AS x, i FROM u), f AS (SELECT doc_id, x, min(i) AS i FROM c WHERE x <> '' GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS n FROM f), g AS (SELECT doc_id, string_agg(x, ',' ORDER BY i) AS tags FROM r WHERE n <= 8 GROUP BY 1)
SELECT doc_id, coalesce(tags, '') AS tags FROM documents LEFT JOIN g USING (doc_id)""")
def tag_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of whole texts as a tag string, as a verdict would hold it; the first eight tags are the feature."""
    words = F.replace("text", F.lit(" "), F.lit(";"))
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(verdict.tags_of_text(words, 8), ",").alias("tags"))


@_query("""
SELECT CASE WHEN quality = 1 AND least(1.0, n_chars / 2000.0) >= 0.6 THEN 'keep' ELSE 'reject' END AS route, CASE WHEN quality = 1 THEN 'keep' ELSE 'reject' END AS decision, count(*) AS n_docs
FROM documents JOIN labels USING (doc_id) GROUP BY 1, 2""")
def keep_reject_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = table(spark, sf_dir, "documents").select("doc_id", "n_chars").join(table(spark, sf_dir, "labels"), "doc_id")
    said = verdict.decision(F.when(F.col("quality") == 1, "keep"))
    route = scoring.route(verdict.final_keep(said, F.least(F.lit(1.0), F.col("n_chars") / 2000)))
    return both.groupBy(route.alias("route"), said.alias("decision")).agg(F.count("*").alias("n_docs"))


def _states(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two states of an index over the documents: some gone, some new, some changed."""
    docs, i = table(spark, sf_dir, "documents"), F.col("doc_id")
    path = F.concat("source", F.lit("/"), i).alias("path")
    old = docs.where(i % 3 != 0).select(path, F.sha1("text").alias("sha1"))
    return old, docs.where(i % 5 != 0).select(path, F.sha1(F.when(i % 7 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text"))).alias("sha1"))


_STATES = "WITH o AS (SELECT source || '/' || doc_id AS path, sha1(text) AS sha1 FROM documents WHERE doc_id % 3 <> 0), n AS (SELECT source || '/' || doc_id AS path, sha1(CASE WHEN doc_id % 7 = 0 THEN text || '!' ELSE text END) AS sha1 FROM documents WHERE doc_id % 5 <> 0) "


@_query(_STATES + "SELECT count(*) FILTER (o.path IS NULL) AS added, count(*) FILTER (n.path IS NULL) AS removed, count(*) FILTER (o.sha1 <> n.sha1) AS updated, count(*) FILTER (o.sha1 = n.sha1) AS same FROM o FULL JOIN n USING (path)")
def index_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.summary(index.changes(*_states(spark, sf_dir)))


@_query(_STATES + "SELECT (SELECT count(*) FROM (SELECT path FROM n EXCEPT SELECT path FROM o)) AS only_new, (SELECT count(*) FROM (SELECT path FROM o EXCEPT SELECT path FROM n)) AS only_old, (SELECT count(*) FROM (SELECT path FROM o INTERSECT SELECT path FROM n)) AS in_both")
def key_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.key_difference(*_states(spark, sf_dir), "path")


@_query("""
WITH i AS (SELECT doc_id, sha1(text) AS sha1, source || '/' || doc_id AS path, CASE WHEN doc_id % 4 = 0 THEN 'http://final/' || doc_id END AS fin, CASE WHEN doc_id % 3 = 0 THEN 'http://source/' || doc_id END AS src, CASE WHEN doc_id % 2 = 0 THEN doc_id * 1.0 END AS ts FROM documents),
p AS (SELECT doc_id, sha1(text) AS sha1, source || '/' || (doc_id + 1) AS path, 'http://prev/' || doc_id AS url, doc_id + 0.5 AS ts FROM documents WHERE doc_id % 6 = 1),
s AS (SELECT sha1, arg_max(url, doc_id) AS url, max(doc_id) + 0.5 AS ts FROM p GROUP BY sha1), q AS (SELECT path, arg_max(url, doc_id) AS url, max(doc_id) + 0.5 AS ts FROM p GROUP BY path)
SELECT i.sha1, md5(coalesce(fin, src, coalesce(s.url, q.url))) AS url_md5, coalesce(fin, src, s.url, q.url) AS url, i.path, CAST(coalesce(i.ts, s.ts, q.ts, 7.0) AS DOUBLE) AS timestamp
FROM i LEFT JOIN s ON i.sha1 = s.sha1 LEFT JOIN q ON i.path = q.path""")
def index_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, i = table(spark, sf_dir, "documents"), F.col("doc_id")
    path = lambda k: F.concat("source", F.lit("/"), k)
    images = docs.select(path(i).alias("path"), F.sha1("text").alias("meta_sha1"), F.when(i % 4 == 0, F.concat(F.lit("http://final/"), i)).alias("final_url"), F.when(i % 3 == 0, F.concat(F.lit("http://source/"), i)).alias("source"), F.when(i % 2 == 0, i.cast("double")).alias("meta_ts"))
    previous = docs.where(i % 6 == 1).select(F.sha1("text").alias("sha1"), path(i + 1).alias("path"), F.concat(F.lit("http://prev/"), i).alias("url"), (i + 0.5).cast("double").alias("timestamp"), i.alias("line_no"))
    return index.rebuild(images, previous, F.lit(7.0))


@_query("SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS n FROM documents) WHERE n <= 10")
def limit_per_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return limits.limit_per_group(table(spark, sf_dir, "documents").select("source", "doc_id"), "source", ["doc_id"], 10)


@_query("SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 25")
def limit_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "documents").select("doc_id", "n_chars").withColumn("neg", -F.col("n_chars"))
    return limits.limit_kept(df, ["neg", "doc_id"], 25).drop("neg")


@_query("SELECT source, count(*) FILTER (n_chars >= 1000) AS n_saved, count(*) AS n_seen FROM documents GROUP BY ROLLUP (source)")
def saved_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return limits.saved_counts(table(spark, sf_dir, "documents").select("source", "n_chars"), "source", F.col("n_chars") >= 1000)


@_query("SELECT n_name AS query, count(*) AS n FROM (SELECT n_name FROM nation UNION ALL SELECT r_name FROM region UNION ALL SELECT n_name FROM nation) GROUP BY 1")
def query_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "nation").select(F.col("n_name").alias("query"))
    return names.union(table(spark, sf_dir, "region").select("r_name")).union(names).groupBy("query").agg(F.count("*").alias("n"))


@_query("SELECT page_id, row_number() OVER (ORDER BY string_split(url, '/'), page_id) - 1 AS ordinal FROM pages")
def path_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = table(spark, sf_dir, "pages").select("page_id", limits.by_components(F.col("url")).alias("parts"))
    return limits.ordinal(keyed, ["parts", "page_id"]).select("page_id", F.col("ordinal").cast("long").alias("ordinal"))


@_query("SELECT p_partkey, CASE WHEN n = 1 THEN p_type ELSE printf('%s-%02d', p_type, n - 1) END AS name FROM (SELECT p_partkey, p_type, row_number() OVER (PARTITION BY p_type ORDER BY p_partkey) AS n FROM part)")
def collision_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return limits.with_collision_suffix(table(spark, sf_dir, "part").select("p_partkey", F.col("p_type").alias("name")), "name", ["p_partkey"])


@_query("SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id")
def last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.last_by_key(table(spark, sf_dir, "events").select("user_id", "event_id", "event_type"), "user_id", "event_id")


def _failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").where("event_type = 'error'").select(F.col("user_id").alias("id"), F.col("props").alias("error"))


@_query("SELECT user_id AS id, min(props) AS error FROM events WHERE event_type = 'error' GROUP BY 1")
def error_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return limits.error_rows(_failed(spark, sf_dir))


@_query("SELECT count(DISTINCT user_id) AS count, count(DISTINCT user_id) AS n_messages FROM events WHERE event_type = 'error'")
def error_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return limits.error_count(_failed(spark, sf_dir))


@_query("SELECT DISTINCT user_id, props FROM events")
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a file stream, the first of each key kept by stream state, run to its end."""
    folder = _folder(spark, "stream")
    stream = ingest.file_stream(spark, sf_dir, table(spark, sf_dir, "events").schema, glob="events.parquet").select("user_id", "props")
    ingest.run_to_end(ingest.distinct_stream(stream, ["user_id", "props"]), f"{folder}/out", f"{folder}/state")
    return spark.read.parquet(f"{folder}/out")


@_query("SELECT doc_id, CAST(length(text) AS DOUBLE) AS n, CAST(1 AS BIGINT) AS n_objects FROM documents")
def model_udf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in models behind the Arrow plug points."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.encode("text", "UTF-8").alias("content"))
    embed = models.embed(lambda batch: [[float(len(c.decode()))] for c in batch])
    detect = models.detect(lambda batch: [[0.9, 0.2] for _ in batch])
    return docs.select("doc_id", F.get(embed(F.col("content")), 0).cast("double").alias("n"), vectors.object_count(detect(F.col("content"))).cast("long").alias("n_objects"))


@_query("SELECT CAST(0 AS BIGINT) AS part, n AS at, q AS query FROM (VALUES (0, 'a'), (1, 'a')) t(n, q) UNION ALL SELECT 2, CAST(r_regionkey AS BIGINT) , 'x' FROM region WHERE FALSE")
def given_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = files.queries(spark, ["a", "a"])
    return out.select(F.col("ordinal.part").cast("long").alias("part"), F.col("ordinal.at").alias("at"), "query")


def _folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared one."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


@_query("""
SELECT page_id, 'http://img12.host.com/' || page_id || '.jpg' AS image, md5(url) AS token, CAST(5000 + page_id % 100 AS VARCHAR) AS carousel, CAST(page_id AS VARCHAR) AS sign,
  CASE WHEN page_id % 2 = 0 THEN 'a&b=' || page_id ELSE '' END AS next FROM pages""")
def page_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a result page's scripts tell: image, token, carousel, sign and ajax parameters, which scripts escape."""
    i, slash = F.col("page_id"), chr(92)
    ajax = F.when(i % 2 == 0, F.concat(F.lit(f'"https:{slash}/{slash}/h.com{slash}/ajax{slash}/similar?page=1{slash}u0026next=a%26b%3D'), i, F.lit('"'))).otherwise("")
    page = F.concat(F.lit('<script>"token": "'), F.md5("url"), F.lit('", carousel: '), 5000 + i % 100, F.lit(' "image":"http://img12.host.com/'), i, F.lit('.jpg" '), ajax)
    context = text.page_context(page, main_url=F.concat(F.lit("http://h/?sign="), i))
    own = table(spark, sf_dir, "pages").select("page_id", context.alias("c"))
    return own.select("page_id", "c.image", "c.token", "c.carousel", "c.sign", F.coalesce(F.col("c.ajax_params")["next"], F.lit("")).alias("next"))


@_query("SELECT page_id, 'a&b=' || url || '/' || page_id || '\\x' AS plain FROM pages")
def unescaped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URLs with UTF-16 escapes decoded; other escapes stay."""
    b = chr(92)
    said = F.concat(F.lit(f"a{b}u0026b{b}u003D"), F.replace("url", F.lit("/"), F.lit(f"{b}/")), F.lit(f"{b}u002f"), F.col("page_id"), F.lit(f"{b}x"))
    return table(spark, sf_dir, "pages").select("page_id", text.unescape_backslashes(said).alias("plain"))


@_query("""
SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'https://i/' || page_id WHEN 1 THEN 'http://t/' || page_id WHEN 2 THEN 'http://m/' || page_id || '?a=1&b' END AS image, page_id % 4 <> 3 AS filled FROM pages""")
def entry_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Image URLs of similar-search entries, and whether an entry has fields at all."""
    i = F.col("page_id")
    obj = F.when(i % 4 == 0, F.concat(F.lit("http://h/?imgurl=%2F%2Fi%2F"), i))
    entry = F.to_json(F.struct(obj.alias("o"), F.when(i % 4 == 1, F.concat(F.lit("http://t/"), i)).alias("t"), F.when(i % 4 == 2, F.concat(F.lit("http://m/"), i, F.lit("?a=1&amp;b"))).alias("m")))
    get = lambda k: F.get_json_object("entry", f"$.{k}")
    return table(spark, sf_dir, "pages").select("page_id", entry.alias("entry")).select("page_id", text.entry_image(get("o"), get("t"), get("m")).alias("image"), filters.non_empty_entry(F.col("entry")).alias("filled"))


@_query("SELECT event_id FROM events WHERE event_type IN ('click', 'view') AND event_id % 3 <> 0")
def still_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("event_type") == "click", "Pic").when(F.col("event_type") == "view", "").otherwise(F.col("event_type"))
    return table(spark, sf_dir, "events").where(filters.still_image(kind, F.col("event_id") % 3 == 0)).select("event_id")


@_query("SELECT c_custkey, c_name FROM customer WHERE c_custkey % 3 <> 0")
def query_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a query file without comments and blanks."""
    line = F.when(F.col("c_custkey") % 6 == 0, F.concat(F.lit("#"), "c_name")).when(F.col("c_custkey") % 3 == 0, " ").otherwise(F.col("c_name"))
    return table(spark, sf_dir, "customer").where(~filters.comment_or_blank(line)).select("c_custkey", "c_name")


@_query("SELECT doc_id, CAST(octet_length(encode(text)) AS INT) AS width, '.txt' AS ending, 'TXT' AS format FROM documents WHERE doc_id % 7 <> 0")
def normalised_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stand-in codec; what it refuses is not ok."""

    def decode(content: bytes) -> tuple[bytes, str, int, int, str]:
        if content == b"bad":
            raise ValueError("no image")
        return content, ".txt", len(content), 1, "TXT"

    norm = models.normalise_image(decode)
    content = F.when(F.col("doc_id") % 7 == 0, F.encode(F.lit("bad"), "UTF-8")).otherwise(F.encode("text", "UTF-8"))
    out = table(spark, sf_dir, "documents").select("doc_id", norm(content).alias("x"))
    return out.where("x.ok").select("doc_id", "x.width", "x.ending", "x.format")


@_query("SELECT doc_id, CASE WHEN doc_id % 7 <> 0 THEN sha1(text) END AS sha1, CASE WHEN doc_id % 7 = 0 THEN 'ValueError(''gone'')' END AS error FROM documents")
def downloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A result or an error for each item; the service is a stand-in that echoes."""

    def get(url: str) -> dict:
        if url == "gone":
            raise ValueError("gone")
        return {"content": url.encode(), "status": 200}

    items = table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 7 == 0, "gone").otherwise(F.col("text")).alias("url"))
    return download.download(items, get, wait=lambda s: None).select("doc_id", F.sha1("content").alias("sha1"), "error")


@_query("SELECT doc_id, 'q' || doc_id AS sign, 'http://h/s?sign=q' || doc_id AS page_url FROM documents")
def uploads(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "documents").select("doc_id", F.col("doc_id").cast("string").alias("path"), F.encode(F.col("doc_id").cast("string"), "UTF-8").alias("content"))
    out = download.upload(items, lambda content, name: '{"data":{"querySign":"q%s"}}' % content.decode())
    return out.select("doc_id", text.upload_context(F.col("payload"), "http://h/s?sign={sign}").alias("c")).select("doc_id", "c.sign", "c.page_url")


def _names(spark: SparkSession, sf_dir: str) -> list[str]:
    return [r.n_name for r in table(spark, sf_dir, "nation").select("n_name").collect()]  # 25 at every size, the caller's list


def _shelf(query: str, offset: int, size: int) -> dict:
    """A stand-in service: a query has ten results for each letter of its name."""
    return {"data": [{"objURL": f"http://h/{query}/{k}"} for k in range(offset, min(offset + size, 10 * len(query)))]}


@_query("SELECT n_name AS query, CAST(k // 30 AS INT) AS page, CAST(k % 30 AS INT) AS position, 'http://h/' || n_name || '/' || k AS url FROM nation, range(0, 200) t(k) WHERE k < 10 * length(n_name)")
def paged_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.keyword_urls(pages.read(spark, _shelf, _names(spark, sf_dir), "shelf"))


@_query("""
WITH e AS (SELECT n_name AS query, k, 'http://h/' || n_name || '/' || k AS url FROM nation, range(0, 200) t(k) WHERE k < 10 * length(n_name) AND k >= 2 * length(n_name)),
r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY k) AS n FROM e) SELECT query, url, md5(url) AS url_md5 FROM r WHERE n <= 50""")
def keyword_crawl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New items of each query up to its limit, where the first ones are known already."""
    names = _names(spark, sf_dir)
    known = spark.createDataFrame([(q, k) for q in names for k in range(2 * len(q))], "q string, k int").select(F.md5(F.concat(F.lit("http://h/"), "q", F.lit("/"), F.col("k"))).alias("url_md5"))
    return stages.keyword_crawl(spark, _shelf, names, known, limit_per_query=50).select("query", "url", "url_md5")


@_query("""
WITH e AS (SELECT n_name AS seed, k, bit_count(k) AS distance FROM nation, range(0, 60) t(k) WHERE k < 5 * length(n_name)) SELECT seed, 'http://i/' || seed || '/' || k AS url, distance FROM e WHERE distance > 1 AND distance <= 4""")
def reverse_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items like each seed by their code's distance, which excludes copies."""

    def fetch(seed: str, offset: int, size: int) -> dict:
        return {"data": [{"thumbUrl": f"http://i/{seed}/{k}"} for k in range(offset, min(offset + size, 5 * len(seed)))]}

    seeds = table(spark, sf_dir, "nation").select(F.col("n_name").alias("seed"), F.lit(0).cast("long").alias("code"))
    coded = lambda df: df.withColumns({"content": F.encode("url", "UTF-8"), "code": F.regexp_extract("url", "([0-9]+)$", 1).cast("long")})
    out = stages.reverse_search(spark, fetch, seeds, dhash_threshold=4, dhash_min_distance=1, download=coded)
    return out.select("seed", "url", F.col("distance").cast("int").alias("distance"))


@_query(_COS + "SELECT vec_id, round(indoor, 6) AS indoor, CAST(len(list_filter(embedding, lambda x: x >= 0.15)) AS INT) AS object_count FROM s JOIN embeddings USING (vec_id) WHERE NOT (indoor < outdoor + 0.02) AND len(list_filter(embedding, lambda x: x >= 0.15)) >= 5")
def prefilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole pre-filter; contents are the vectors' bytes and the stand-in models read them."""
    import struct

    unpack = lambda c: list(struct.unpack(f">{len(c) // 4}f", c))
    vectors_ = _vectors(spark, sf_dir)
    pack = F.udf(lambda v: struct.pack(f">{len(v)}f", *v), "binary")
    items = vectors_.select(F.lpad(F.col("vec_id").cast("string"), 12, "0").alias("path"), pack("embedding").alias("content"))
    names = F.array(*map(F.lit, scoring.PROMPTS))
    prompts = vectors_.where("label < 5").groupBy("label").agg(F.min_by("embedding", "vec_id").alias("prompt_vector")).select(F.get(names, F.col("label")).alias("name"), "prompt_vector")
    out = stages.prefilter(items, prompts, models.embed(lambda b: [unpack(c) for c in b]), models.detect(lambda b: [unpack(c) for c in b]), object_count_min=5, detector_threshold=0.15)
    return out.select(F.col("path").cast("long").alias("vec_id"), F.round("indoor", 6).alias("indoor"), F.col("object_count").cast("int").alias("object_count"))


@_query("SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'error' WHEN doc_id % 5 = 1 THEN 'reject' WHEN doc_id % 10 < 5 THEN 'keep' ELSE 'reject' END AS route FROM documents")
def fine_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts, routes and errors of a stand-in judge."""

    def model(content: bytes, prompt: str) -> str:
        k = int(content)
        if k % 5 == 0:
            raise ValueError("no answer")
        return json.dumps({"decision": "reject" if k % 5 == 1 else "keep", "score": 0.9 if k % 10 < 5 else 0.1})

    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), F.col("source").alias("image_path"), F.encode(F.col("doc_id").cast("string"), "UTF-8").alias("content"))
    results, errors = stages.fine_filter(docs, model, "", wait=lambda s: None)
    return results.select("id", "route").union(errors.select("id", F.lit("error"))).select(F.col("id").cast("long").alias("doc_id"), "route")


@_query(_PLANTED + "SELECT seed_id, count(*) AS n_removed FROM d WHERE distance <= 2 GROUP BY ROLLUP (seed_id) HAVING count(*) > 0")
def removed_per_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    items, seeds = _planted(spark, sf_dir)
    own = items.select(F.col("vec_id").cast("string").alias("path"), F.col("label").cast("string").alias("slug"), "code")
    own_seeds = seeds.select(F.col("seed_id").cast("string").alias("seed_id"), F.col("label").cast("string").alias("slug"), "code")
    return stages.remove_seed_duplicates(own, own_seeds)[1].select(F.col("seed_id").cast("long").alias("seed_id"), "n_removed")


@_query("SELECT sha1(text) AS sha1, source || '/' || doc_id AS path, CAST(doc_id AS DOUBLE) AS timestamp FROM documents ORDER BY path")
def index_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An index appended in two parts, read, rewritten in order and read again."""
    path, i = _folder(spark, "index"), F.col("doc_id")
    entries = table(spark, sf_dir, "documents").select(F.sha1("text").alias("sha1"), F.concat("source", F.lit("/"), i).alias("path"), i.cast("double").alias("timestamp"), (i % 2).alias("part"))
    for part in (0, 1):
        sinks.append_index(entries.where(F.col("part") == part).drop("part"), path)
    return sinks.rewrite_index(files.index(spark, path).select("sha1", "path", "timestamp"), path)


@_query("SELECT vec_id, CAST(label AS INT) AS object_count FROM embeddings WHERE label < 5")
def score_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score log with a header and CRLF line ends, read back."""
    path = _folder(spark, "log")
    none = [F.lit(0.5).alias(n) for n in scoring.PROMPTS]
    sinks.score_log(_vectors(spark, sf_dir).where("label < 5").select(F.col("vec_id").alias("path"), *none, F.col("label").alias("object_count")), path)
    return files.score_log(spark, path).select(F.col("path").cast("long").alias("vec_id"), "object_count")


@_query("SELECT doc_id, CASE WHEN n_chars >= 1000 THEN 'keep' ELSE 'reject' END AS route, sha1(text) AS sha1 FROM documents")
def routed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _folder(spark, "routed")
    sinks.routed(table(spark, sf_dir, "documents").select("doc_id", "n_chars", F.sha1("text").alias("sha1")), F.col("n_chars") >= 1000, path)
    return spark.read.parquet(path).select("doc_id", "route", "sha1")


@_query("SELECT DISTINCT sha1(text) AS sha1, '.jpg' AS ending, CAST(octet_length(encode(text)) AS INT) AS length FROM documents")
def content_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _folder(spark, "contents")
    sinks.contents(table(spark, sf_dir, "documents").select(F.concat(F.col("doc_id"), F.lit(".JPG")).alias("path"), F.encode("text", "UTF-8").alias("content")), path)
    return spark.read.parquet(path).select("sha1", "ending", F.length("content").alias("length"))


@_query("SELECT doc_id, sha1(text) AS sha1, CAST(n_chars AS INT) AS width FROM documents")
def sidecar_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sidecars as JSON, joined to their items again."""
    none = lambda k: F.lit(None).cast("string").alias(k)
    docs = table(spark, sf_dir, "documents").select("doc_id", F.sha1("text").alias("sha1"), F.col("n_chars").cast("int").alias("width"), *map(none, ("source", "content_type", "status", "final_url", "height", "format")))
    written = sinks.sidecar_json(docs).dropDuplicates(["sha1"])
    metas = written.select(F.lit("d").alias("folder"), F.col("sha1").alias("stem"), F.from_json("json", files.SIDECAR).alias("meta"))
    items = docs.select("doc_id", F.concat(F.lit("d/"), "sha1", F.lit(".jpg")).alias("path"))
    return files.with_sidecar(items, metas).select("doc_id", "meta.sha1", "meta.width")


@_query("SELECT p_partkey, coalesce(nullif(CASE WHEN p_partkey % 3 = 0 THEN '' ELSE 'id' || p_partkey END, ''), 'x' || p_partkey) AS id, p_name AS image_path FROM part")
def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A manifest of JSON lines with the alternative names of its fields."""
    path, k = _folder(spark, "manifest") + ".jsonl", F.col("p_partkey")
    parts = table(spark, sf_dir, "part").select(F.when(k % 3 == 0, "").otherwise(F.concat(F.lit("id"), k)).alias("id"), F.concat(F.lit("x"), k).alias("identifier"), F.when(k % 2 == 0, F.col("p_name")).alias("image"), F.when(k % 2 == 1, F.col("p_name")).alias("path"), k.alias("own"))
    parts.write.json(path)
    out = files.manifest(spark, path)
    return out.select(F.get_json_object("extra", "$.own").cast("long").alias("p_partkey"), "id", "image_path")


@_query("SELECT user_id, min(event_id) AS event_id FROM events GROUP BY 1")
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream's events appended to an index by key; a second run adds nothing."""
    folder = _folder(spark, "ingest")
    stream = lambda: ingest.file_stream(spark, sf_dir, table(spark, sf_dir, "events").schema, glob="events.parquet").select("user_id", "event_id")
    for _ in range(2):
        ingest.ingest_new(stream(), f"{folder}/index", "user_id", ["event_id"], f"{folder}/state").awaitTermination()
    return spark.read.parquet(f"{folder}/index").select("user_id", "event_id")


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
